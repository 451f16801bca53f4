"""Personal data by a skip-chain conditional random field.

The base spans are fixed patterns (e-mail, IP, card, phone), found left to right without overlap per
kind. The field adds what the patterns miss. Its nodes are the tokens of a document that could be
personal data at all: those with a digit or an at sign, of any length, between white space, quotes,
brackets and other delimiters. Neighbouring nodes are linked along the chain. Mentions with the same
digits or the same address, however far apart, are linked by skip edges to a common node of their
group; groups of similar things (numbers that end in the same seven digits, addresses with the same
name before the at sign) are linked to a common node of their own. So n alike mentions make n edges.
Node potentials come from the shape of a token and from the labels that its form (digits and letter
runs written as one sign) had in training; a form that training has not met says little, so only other
mentions can give it a label. Alike mentions that no pattern labels share one
potential in equal parts, as repeating a token is no further evidence about it. Edge potentials come
from how often labels meet on such edges; base spans are evidence, which no message changes. Loopy,
damped sum-product passing runs document by document until no message of a document changes by more
than a tolerance, so a document's result does not depend on what it is computed with. A token outside
the base spans that is labelled confidently becomes a span of its own, named ``<kind>_like`` so that
the base spans stay recognisable.

Training is piecewise, in numpy, on a bounded sample of documents: node weights by softmax
regression of the base labels on shapes, edge potentials from smoothed counts of label pairs
(neighbours; a mention and the label of its group; two similar groups).

Defined cases: a null text is an empty one and has no spans; the hash of no spans is that of the
empty string; repeated rows each have their own result; other columns are ignored; an empty table
gives an empty result. Digit runs of any length are handled in linear time. A document whose messages
have not settled after ``rounds`` keeps the spans of its last beliefs and is marked (``settled`` false).
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, hashed_share, slices

#: Kinds in the order in which spans at the same start are listed; label 0 is "none of them".
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NODE = re.compile(r"[0-9@]")
_AT = re.compile(r"[(\[{]at[)\]}]|@", re.I)
#: What ends a token besides white space: not the brackets of a written address or a number, thousands separators, times, dates and apostrophes.
_CUT = re.compile(r"""["`<>|=&;\\]|(?<![A-Za-z])'|'(?![A-Za-z])|[:/](?![0-9])|(?<![0-9])[:/]|(?<![0-9]),|,(?![0-9]{3}(?![0-9]))|(?<=[0-9]{4}),"""
                  r"""|[\[{](?!(?:at|dot)[)\]}])|(?<![(\[{]at)(?<![(\[{]dot)[\]}]|\((?!(?:at|dot)[)\]}]|[0-9])|(?<![(\[{]at)(?<![(\[{]dot)(?<![0-9])\)""", re.I)
_DOT = re.compile(r"[(\[{]dot[)\]}]", re.I)


@dataclass(frozen=True)
class PiiSpec:
    sample: int = 4000         # documents among which the field is fitted
    max_chars: int = 20_000    # longer texts are not fitted on; all are searched whole
    epochs: int = 60
    rounds: int = 1000         # of message passing at most; a document that needs more is marked
    tolerance: float = 1e-4    # change of a log message below which passing has settled
    damping: float = 0.3
    confidence: float = 0.5    # of a label, for a span outside the base spans
    unmet: float = 1.0         # log odds of "none of them" for a form that training has not met
    form_weight: float = 1.0   # of the shape against one token of the same form
    seed: int = 23


@dataclass(frozen=True)
class Field:
    node: np.ndarray           # shapes x labels, log potentials
    chain: np.ndarray          # labels x labels, log potentials
    skip: np.ndarray           # labels of a mention x labels of its group
    kin: np.ndarray | None = None   # of a group x of what similar groups have in common; none: half of skip
    forms: dict | None = None       # labels that each form had; none: shapes alone count


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in code points, sorted; matches that fail their check are dropped."""
    found = []
    if "@" in text:
        free, at = 0, text.find("@")
        while at >= 0:
            m = _DOMAIN.match(text, at)
            if m:
                start = at
                while start > free and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    found.append((start, 0, m.end()))
                    free = m.end()
                    at = text.find("@", free)
                    continue
            at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def render(spans: list[tuple[int, int, int]], names: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


#: What a shape says; the columns of ``shape`` in order.
SHAPES = ("any", "at", "at_and_dotted_host", "written_at", "plus_first", "three_dots", "digits_1_2", "digits_3_4", "digits_5_9", "digits_10_13", "digits_14_19",
          "digits_over_19", "luhn_of_14_or_more", "letters_and_digits", "only_digits", "separators", "year_like", "bracketed")


def shape(token: str) -> list[bool]:
    digits = "".join(c for c in token if "0" <= c <= "9")
    n, letters = len(digits), any(c.isalpha() for c in token)
    core = token.strip(".,;:!?")
    at = "@" in token
    return [True, at, bool(at and "." in core.rpartition("@")[2]), bool(not at and _AT.search(token)), token[0] == "+", core.count(".") == 3 and not letters,
            1 <= n <= 2, 3 <= n <= 4, 5 <= n <= 9, 10 <= n <= 13, 14 <= n <= 19, n > 19, 14 <= n <= 19 and luhn(digits), bool(letters and n),
            n == len(core) > 0, "-" in core or "." in core, n == 4 == len(core), core[:1] in "([{"]


def form(token: str) -> str:
    """The token with every digit as 9 and every run of letters as a, and whether its digits pass Luhn and its dotted parts are bytes."""
    core = token.strip(".,;:!?")
    plain = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", core[:64]))
    digits = "".join(c for c in core if "0" <= c <= "9")
    parts = core.split(".")
    return plain + " luhn" * (14 <= len(digits) <= 19 and luhn(digits)) + " bytes" * (len(parts) == 4 and all(x.isdigit() and len(x) < 4 and int(x) <= 255 for x in parts))


def alike(token: str) -> str | None:
    """What mentions of the same thing have in common: an address however written, or seven digits or more."""
    plain = _DOT.sub(".", _AT.sub("@", token)).strip(".,;:!?()[]{}<>\"'").lower()
    if "@" in plain:
        return plain
    digits = "".join(c for c in token if "0" <= c <= "9")
    return "#" + digits if len(digits) >= 7 else None


def similar(key: str) -> str:
    """What the keys of similar things have in common: the name of an address, the last seven digits of a number."""
    return key[-7:] if key[0] == "#" else "@" + key.partition("@")[0]


@dataclass
class Graph:
    """Candidate tokens of some documents: place, shape, base label, chain and skip edges."""
    start: list
    end: list
    label: np.ndarray
    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    owner: np.ndarray
    root: np.ndarray           # the first node alike
    kin: np.ndarray            # the first node of a similar thing
    form: list
    settled: np.ndarray | None = None   # of each document, once inferred

    def hubs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owners of the common nodes, edges mention to group, edges group to similar groups); common nodes are numbered after the mentions."""
        n = len(self.root)
        heads, group, size = np.unique(self.root, return_inverse=True, return_counts=True)
        shared, family, groups = np.unique(self.kin[heads], return_inverse=True, return_counts=True)
        wide = groups > 1
        used = (size > 1) | wide[family]
        at = n + np.cumsum(used) - 1
        above = n + used.sum() + np.cumsum(wide) - 1
        member, low = np.flatnonzero(used[group]), np.flatnonzero(wide[family])
        return (np.concatenate([self.owner[heads[used]], self.owner[shared[wide]]]),
                np.stack([member, at[group[member]]], 1), np.stack([at[low], above[family[low]]], 1))


def tokens(text: str):
    """(start, end) of the runs between white space; runs that may hold personal data are split at delimiters too."""
    for m in _TOKEN.finditer(text):
        at, end = m.span()
        if _NODE.search(text, at, end) or _AT.search(text, at, end):
            for cut in _CUT.finditer(text, at, end):
                if cut.start() > at:
                    yield at, cut.start()
                at = cut.end()
        if end > at:
            yield at, end


def graph(texts: list[str], spans: list[list[tuple[int, int, int]]]) -> Graph:
    start, end, label, shapes, owner, chain, skip, root, kin, forms = [], [], [], [], [], [], [], [], [], []
    cache: dict[str, tuple] = {}
    for d, (text, found) in enumerate(zip(texts, spans)):
        seen: dict[str, int] = {}
        families: dict[str, int] = {}
        before, index, at, n = -2, -1, 0, len(found)
        for left, right in tokens(text):
            index += 1
            token = text[left:right]
            if not _NODE.search(token) and not _AT.search(token):
                continue
            hit = cache.get(token)
            if hit is None:
                hit = shape(token), alike(token), form(token)
                if len(token) <= 256:
                    cache[token] = hit
            me = len(start)
            while at < n and found[at][2] <= left:
                at += 1
            y, key = 0, hit[1]
            for s, k, e in found[at:at + 4]:
                if s < right and e > left:
                    y = k + 1
                    if k >= 2:      # a number of several tokens is one thing
                        key = "#" + "".join(c for c in text[s:e] if c.isdigit())
                    break
            start.append(left), end.append(right), label.append(y), shapes.append(hit[0]), owner.append(d)
            if before == index - 1:
                chain.append((me - 1, me))
            before = index
            root.append(me)
            forms.append(hit[2])
            kin.append(me if key is None else families.setdefault(similar(key), me))
            if key is not None:
                if key in seen:
                    skip.append((seen[key], me))
                    root[me] = root[seen[key]]
                seen[key] = me
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return Graph(start, end, np.array(label, np.int64), np.array(shapes, bool).reshape(-1, len(SHAPES)), pairs(chain), pairs(skip),
                 np.array(owner, np.int64), np.array(root, np.int64), np.array(kin, np.int64), forms)


def fit_field(graphs: list[Graph], spec: PiiSpec) -> Field:
    """Softmax regression for the nodes, pointwise information of label pairs for the edges."""
    k = len(KINDS) + 1
    x = np.concatenate([g.shape for g in graphs]).astype(float) if graphs else np.zeros((0, len(SHAPES)))
    y = np.concatenate([g.label for g in graphs]) if graphs else np.zeros(0, np.int64)
    w = np.zeros((len(SHAPES), k))
    past = np.full(w.shape, 1e-3)
    for _ in range(spec.epochs if len(y) else 0):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        g = x.T @ p / len(y) + 1e-4 * w
        past += g * g
        w -= 0.5 * g / np.sqrt(past)

    def potentials(pairs, prior=0.0):
        c = np.full((k, k), 0.5) + prior * np.eye(k)
        for e in pairs:
            np.add.at(c, (e[:, 0], e[:, 1]), 1.0)
        c = c + c.T
        if prior:       # common nodes have no potential of their own, so equal labels must be as good for every label
            return np.log(c / np.sqrt(np.outer(c.diagonal(), c.diagonal())))
        share = c / c.sum()
        return np.log(share / np.outer(share.sum(1), share.sum(0)))

    chain, skip, kin = [], [], []
    for g in graphs:
        top = np.zeros(len(g.root), np.int64)
        np.maximum.at(top, g.root, g.label)                     # the label of a group, at its first node
        chain.append(g.label[g.chain])
        again = np.flatnonzero(g.root != np.arange(len(g.root)))
        skip.append(np.stack([g.label[again], top[g.root[again]]], 1))
        other = np.flatnonzero((g.root == np.arange(len(g.root))) & (g.kin != g.root))
        kin.append(np.stack([top[other], top[g.kin[other]]], 1))
    forms: dict[str, np.ndarray] = {}
    for g in graphs:
        for f, label in zip(g.form, g.label.tolist()):
            forms.setdefault(f, np.zeros(k))[label] += 1
    # alike and similar things agree unless counts say otherwise
    return Field(w, potentials(chain), potentials(skip, 20), potentials(kin, 20), forms)


def infer(g: Graph, field: Field, spec: PiiSpec) -> np.ndarray:
    """Beliefs (node x label) after loopy sum-product over chain, skip and similarity edges; base labels are evidence."""
    k, n = len(KINDS) + 1, len(g.root)
    owners, skip, kin = g.hubs()
    owner = np.concatenate([g.owner, owners])
    unary = np.zeros((len(owner), k))
    for f, weight in enumerate(field.node):                     # in a fixed order, so that a row does not depend on the others
        unary[:n] += g.shape[:, f, None] * weight
    if field.forms is not None:
        share = np.exp(unary[:n] - unary[:n].max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        seen = [field.forms.get(f) for f in g.form]
        new = np.array([c is None for c in seen], bool)
        count = np.array([np.zeros(k) if c is None else c for c in seen]).reshape(-1, k)
        unary[:n] = np.log((count + spec.form_weight * share) / (count.sum(axis=1, keepdims=True) + spec.form_weight) + 1e-9)
        unary[:n][new] = np.eye(k)[0] * spec.unmet
    bare = g.label == 0
    unary[:n] /= np.maximum(1, np.bincount(g.root[bare], minlength=n))[g.root][:, None]
    unary -= unary.max(axis=1, keepdims=True)
    known = np.flatnonzero(g.label)
    unary[known] = -12.0
    unary[known, g.label[known]] = 0.0
    pair = np.concatenate([g.chain, skip, kin])
    above = field.skip / 2 if field.kin is None else field.kin
    tables = np.exp(np.stack([field.chain, field.skip, above]))
    which = np.repeat(np.arange(3), [len(g.chain), len(skip), len(kin)])
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
    a, b = np.concatenate([pair[:, 0], pair[:, 1]]), np.concatenate([pair[:, 1], pair[:, 0]])
    table, doc = np.concatenate([which, which + 3]), owner[a]
    back = np.concatenate([np.arange(len(pair)) + len(pair), np.arange(len(pair))])
    fixed = np.zeros(len(owner), bool)
    fixed[known] = True
    m = np.zeros((len(a), k))

    def totals(edges):
        total = unary.copy()
        for c in range(k):
            total[:, c] += np.bincount(b[edges], weights=m[edges, c], minlength=len(unary))
        return total

    docs = int(owner.max()) + 1 if len(owner) else 0
    open_, moving = np.arange(len(a)), np.zeros(docs, bool)
    moving[doc] = True
    for _ in range(spec.rounds):
        if not len(open_):
            break
        e = open_
        out = np.where(fixed[a[e], None], unary[a[e]], totals(e)[a[e]] - m[back[e]])
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.zeros((len(e), k))
        for j in range(k):
            new += out[:, j, None] * tables[table[e], j]
        new = np.log(new + 1e-12)
        new -= new.mean(axis=1, keepdims=True)
        new = spec.damping * m[e] + (1 - spec.damping) * new
        change = np.zeros(docs)
        np.maximum.at(change, doc[e], np.abs(new - m[e]).max(axis=1))
        m[e] = new
        moving &= change >= spec.tolerance
        open_ = e[moving[doc[e]]]
    g.settled = ~moving
    total = totals(np.arange(len(a)))[:n]
    total[known] = unary[known]
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_pii(docs: DataFrame, spec: PiiSpec = PiiSpec()) -> Field:
    """A field fitted on those of about ``sample`` documents that hold a digit or an at sign."""
    rows = hashed_share(doc_frame(docs), spec.sample, docs.count(), "doc_id")
    rows = rows.filter((F.length("text") <= spec.max_chars) & F.col("text").rlike("[0-9@]")).select("text").orderBy(F.xxhash64("text"), "text").limit(2 * spec.sample)
    texts = sorted(r["text"] for r in rows.collect())
    return fit_field([graph(texts, [base_spans(t) for t in texts])] if texts else [], spec)


NAMES = KINDS + tuple(f"{k}_like" for k in KINDS)


def find_spans(texts: list[str], field: Field, spec: PiiSpec) -> tuple[list, list]:
    """(base spans, all spans) of each text."""
    return search(texts, field, spec)[:2]


def search(texts: list[str], field: Field, spec: PiiSpec) -> tuple[list, list, np.ndarray]:
    """(base spans, all spans, whether message passing has settled) of each text."""
    base = [base_spans(t) for t in texts]
    g = graph(texts, base)
    every, settled = [list(b) for b in base], np.ones(len(texts), bool)
    if len(g.start):
        belief = infer(g, field, spec)
        best = belief.argmax(axis=1)
        settled[:len(g.settled)] = g.settled
        for i in np.flatnonzero((best > 0) & (g.label == 0) & (belief.max(axis=1) >= spec.confidence)).tolist():
            text = texts[g.owner[i]]
            s, e = g.start[i], g.end[i]
            while e > s + 1 and text[e - 1] in ".,;:!?":
                e -= 1
            if not any(x < e and y > s for x, _, y in base[g.owner[i]]):
                every[g.owner[i]].append((s, len(KINDS) + int(best[i]) - 1, e))
    for x in every:
        x.sort()
    return base, every, settled


def _possible(text: pa.Array) -> np.ndarray:
    """Whether a text has a character that any span needs."""
    return np.asarray(pc.match_substring_regex(text, r"[0-9@]|[(\[{][aA][tT][)\]}]"), bool)


def detect(docs: DataFrame, field: Field, spec: PiiSpec = PiiSpec()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, settled) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    none = hashlib.sha256(b"").hexdigest()
    frame = doc_frame(docs)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "settled"]

    def run(batches):
        for batch in slices(batches):
            text = batch.column("text")
            some = np.flatnonzero(_possible(text))
            count = np.zeros((len(text), len(KINDS)), np.int64)
            digest, spans, added, calm = [none] * len(text), [""] * len(text), np.zeros(len(text), np.int64), np.ones(len(text), bool)
            base, every, calm[some] = search(text.take(pa.array(some)).to_pylist(), shared.value, spec)
            for i, b, x in zip(some.tolist(), base, every):
                if x:
                    for _, k, _ in b:
                        count[i, k] += 1
                    digest[i], spans[i], added[i] = hashlib.sha256(render(b).encode()).hexdigest(), render(x, NAMES), len(x) - len(b)
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(count[:, k]) for k in range(len(KINDS))], pa.array(digest, pa.string()),
                                   pa.array(spans, pa.string()), pa.array(added), pa.array(calm)], names=names)

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long, settled boolean")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans by that of the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k % len(KINDS)].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def masked_documents(docs: DataFrame, field: Field, spec: PiiSpec = PiiSpec()) -> DataFrame:
    """The rows of ``docs`` with personal data masked in the text, and n_chars brought up to date."""
    shared, columns = docs.sparkSession.sparkContext.broadcast(field), docs.columns
    at = columns.index("text")

    def run(batches):
        for batch in slices(batches):
            text = batch.column(at)
            filled = pc.fill_null(text, "")
            some = np.flatnonzero(_possible(filled)).tolist()
            new = text.to_pylist()
            for i, x in zip(some, find_spans([new[i] for i in some], shared.value, spec)[1]):
                if x:
                    new[i] = mask(new[i], x)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, text.type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out
