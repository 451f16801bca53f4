"""Personal data and quality rules against plain definitions, and their defined cases."""

import hashlib
import itertools
import re

import numpy as np
import pytest

from umbral.llm import linecrf, pii

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, spans string, kept string"
TEXTS = ["Write to jo.do@mail.example.com, a@b.c@d.e or x@y; +1 (389) 555-0101 at 10.0.0.255 not 10.0.0.256",
         "1.2.3.4.5.6.7.8 and 4111 1111 1111 1111 then 4111-1111-1111-1112 +12 no", "", None, "9" * 30_000, "a" * 20_000 + "@b.cd", "1." * 20_000, "+1 " + " " * 5000,
         "é jo@é.com jö@x.de  b@c.d", "+1(2)3-4.5 6789012 x +123456789012345 +1234567890123456", "00000000000000 999.1.1.1 0255.1.1.01"]


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    for t in TEXTS:
        if t and len(t) < 6000:
            assert pii.base_spans(t) == plain_spans(t), t[:80]
    assert pii.base_spans("a" * 20_000 + "@b.cd") == [(0, 0, 20_005)]
    assert pii.base_spans("9" * 30_000) == []


def test_detect_handles_every_row(spark):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], None, None), (None, TEXTS[1], None, None)], DOCS)
    rows = pii.detect(docs, pii.fit_pii(docs)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        t = (TEXTS[r["doc_id"]] if r["doc_id"] is not None else TEXTS[1]) or ""
        base = pii.base_spans(t)
        assert r["base_sha256"] == hashlib.sha256(pii.render(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(filter(None, pii.render(base).split(","))) <= set(r["spans"].split(","))
    assert pii.detect(docs.filter("false"), pii.fit_pii(docs.filter("false"))).count() == 0


def test_alike_mentions_take_the_label():
    train = [f"mail u{i}@h{i}.example.com now and card 41111111111111{i:02d} or +1 (389) 555-01{i:02d} in 19{i:02d} for {i} items" for i in range(60)]
    field = pii.fit_field([pii.graph(train, [pii.base_spans(t) for t in train])], pii.PiiSpec())
    texts = ["Ask jo.do@mail.example.com first. Later jo.do(at)mail.example.com again, in 1999.", "Ask jo(at)mail.example.com.", "There were 12345678 and 12345678 of them"]
    every = pii.find_spans(texts, field, pii.PiiSpec())[1]
    assert [(texts[0][s:e], pii.NAMES[k]) for s, k, e in every[0]] == [("jo.do@mail.example.com", "email"), ("jo.do(at)mail.example.com", "email_like")]
    assert every[1] == [] and every[2] == []


@pytest.mark.parametrize("last", [False, True])
def test_evidence_reaches_every_mention(last):
    """The only pattern match stands fifty mentions from the furthest one, which takes its label all the same."""
    train = [f"mail u{i}@h{i}.example.com now and card 41111111111111{i:02d} or +1 (389) 555-01{i:02d} in 19{i:02d} for {i} items" for i in range(60)]
    field = pii.fit_field([pii.graph(train, [pii.base_spans(t) for t in train])], pii.PiiSpec())
    parts = ["Ask jo.do@mail.example.com first."] + ["Later jo.do(at)mail.example.com again."] * 50
    text = " ".join(parts[::-1] if last else parts)
    every = pii.find_spans([text], field, pii.PiiSpec())[1][0]
    assert [(text[s:e], pii.NAMES[k]) for s, k, e in every if k >= len(pii.KINDS)] == [("jo.do(at)mail.example.com", "email_like")] * 50
    assert "jo.do" not in pii.mask(text, every)


def test_tokens_end_at_delimiters():
    cut = lambda t: [t[a:b] for a, b in pii.tokens(t)]
    assert cut('{"a":"jo(at)x[dot]com","n":[4111111111111111,12]} 1,234,567 +1(389)555-0101 12:30 x|y') == [
        "a", "jo(at)x[dot]com", "n", "4111111111111111", "12", "1,234,567", "+1(389)555-0101", "12:30", "x|y"]
    assert cut("(389) mailto:jo@x.com?b=1,jo@y.de o'do@x.com") == ["(389)", "mailto", "jo@x.com?b", "1", "jo@y.de", "o'do@x.com"]


def test_mentions_in_text_without_white_space():
    """A written address in minified JSON of over 256 characters is a span of its own, and a long token has its shape and key."""
    train = [f"mail u{i}@h{i}.example.com now and card 41111111111111{i:02d} or +1 (389) 555-01{i:02d} in 19{i:02d} for {i} items" for i in range(60)]
    field = pii.fit_field([pii.graph(train, [pii.base_spans(t) for t in train])], pii.PiiSpec())
    text = '{"mail":"jo.do@mail.example.com","rows":[' + '"abc",' * 100 + '"jo.do(at)mail.example.com"],"n":1}'
    every = pii.find_spans([text], field, pii.PiiSpec())[1][0]
    assert [(text[s:e], pii.NAMES[k]) for s, k, e in every] == [("jo.do@mail.example.com", "email"), ("jo.do(at)mail.example.com", "email_like")]
    long = "a" * 300 + "@mail.example.com " + "a" * 300 + "(at)mail.example.com"
    assert [pii.NAMES[k] for _, k, _ in pii.find_spans([long], field, pii.PiiSpec())[1][0]] == ["email", "email_like"]


def test_one_pair_of_nodes_is_exact():
    """With one edge, message passing is exact: beliefs equal the sums over all labellings."""
    rng = np.random.default_rng(0)
    k = len(pii.KINDS) + 1
    field = pii.Field(rng.normal(size=(len(pii.SHAPES), k)), rng.normal(size=(k, k)), rng.normal(size=(k, k)))
    g = pii.graph(["12 34"], [[]])
    assert len(g.chain) == 1 and not len(g.skip)
    unary = g.shape.astype(float) @ field.node
    joint = np.exp(unary[0][:, None] + unary[1][None, :] + field.chain)
    joint /= joint.sum()
    got = pii.infer(g, field, pii.PiiSpec(rounds=40))
    assert np.allclose(got[0], joint.sum(1), atol=1e-6) and np.allclose(got[1], joint.sum(0), atol=1e-6)


def test_masking_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd now", 13, "x"), (2, None, None, None), (3, "none", 4, "y")], "doc_id long, text string, n_chars long, n_email string")
    out = {r["doc_id"]: r for r in pii.masked_documents(docs, pii.fit_pii(docs)).collect()}
    assert out[1]["text"] == "to <EMAIL> now" and out[1]["n_chars"] == 14 and out[1]["n_email"] == "x"
    assert out[2]["text"] is None and out[2]["n_chars"] is None and out[3]["text"] == "none"


def plain_rules(t):
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_base_measures_and_cases(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcd"), rng.integers(1, 60))) for _ in range(40)]
    texts += ["x\n y\nx\n\n \nx\n y", "", None, "  　", "é " * 30, ("one two three\n" * 700), "w " * 9000, "a\tb\x0bc\x0cd\re", "|".join("abc")]
    docs = spark.createDataFrame([(i, t, "c", "c") for i, t in enumerate(texts)] + [(None, "a b", None, None), (1, texts[1], None, None)], DOCS)
    for r in linecrf.judge(docs, linecrf.untrained()).collect():
        t = (texts[r["doc_id"]] if r["doc_id"] is not None else "a b") or ""
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_rules(t)
        assert r["kept"] == (not r["base_failed"])
    assert linecrf.judge(docs.filter("false"), linecrf.untrained()).count() == 0


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(3)
    model = linecrf.ChainModel(np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    sizes = [0, 1, 5, 3, 0, 8, 8]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    score = rng.normal(size=(offsets[-1], 2))
    got = linecrf.viterbi(score, offsets, model)

    def value(s, y):
        return model.start[y[0]] + sum(s[i, y[i]] for i in range(len(y))) + sum(model.transition[a, b] for a, b in zip(y, y[1:]))
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b > a:
            s = score[a:b]
            best = max(value(s, y) for y in itertools.product((0, 1), repeat=int(b - a)))
            assert value(s, got[a:b]) == pytest.approx(best)
            assert (linecrf._viterbi_one(s[:, 1] - s[:, 0], model) == got[a:b]).all()


def test_trained_field_tells_lines_apart(spark):
    rng = np.random.default_rng(4)
    good = lambda: "\n".join(" ".join(["Word"] + ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(9)]) + "." for _ in range(4))
    bad = lambda: "\n".join(" ".join("".join(rng.choice(list("abcdefgh"), 5)) + "###" for _ in range(10)) for _ in range(4))
    docs = spark.createDataFrame([(i, good() if i % 2 else bad(), None, None) for i in range(80)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = linecrf.fit_lines(docs, labels)
    rows = linecrf.judge(docs, model).collect()
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in rows)
    assert {r["doc_id"] for r in linecrf.kept_documents(docs, model).collect()} == set(range(1, 80, 2))


def every_labelling(g, field, spec):
    """Beliefs by summing over all labellings of mentions and common nodes."""
    k, n = len(pii.KINDS) + 1, len(g.root)
    owners, skip, kin = g.hubs()
    total = n + len(owners)
    unary = np.zeros((total, k))
    unary[:n] = g.shape.astype(float) @ field.node
    for i in range(n):
        unary[i] /= max(1, sum(g.root[j] == g.root[i] and g.label[j] == 0 for j in range(n)))
    belief = np.zeros((total, k))
    choice = [[int(g.label[i])] if i < n and g.label[i] else range(k) for i in range(total)]
    for y in itertools.product(*choice):
        value = sum(unary[i, y[i]] for i in range(n) if not g.label[i])
        for edges, table in ((g.chain, field.chain), (skip, field.skip), (kin, field.kin)):
            value += sum(table[y[a], y[b]] for a, b in edges)
        for i, label in enumerate(y):
            belief[i, label] += np.exp(value)
    return (belief / belief.sum(axis=1, keepdims=True))[:n]


def test_a_loopy_graph_is_close_to_all_labellings():
    """Chain and skip edges close loops here; a graph without loops is met exactly."""
    k, rng = len(pii.KINDS) + 1, np.random.default_rng(5)
    for text, chained, limit in (("5551234 x5551234 x 5551234", True, 0.03), ("5551234 a 5551234 b 9875551234", False, 1e-4), ("5551234 9875551234 5551234", True, 0.03)):
        for _ in range(4):
            field = pii.Field(rng.normal(size=(len(pii.SHAPES), k)) / 3, rng.normal(size=(k, k)) / 3, rng.normal(size=(k, k)) / 2, rng.normal(size=(k, k)) / 2)
            g = pii.graph([text], [[]])
            assert bool(len(g.chain)) == chained and len(g.hubs()[1])
            assert np.abs(pii.infer(g, field, pii.PiiSpec()) - every_labelling(g, field, pii.PiiSpec())).max() < limit
            assert g.settled.all()


TRAIN = [f"mail u{i}@h{i}.example.com now, card 4{i:015d} or +1 (389) 555-01{i:02d} in 19{i:02d} for {i} items, 10.2.3.{i} or {i},500" for i in range(100)]


def trained():
    return pii.fit_field([pii.graph(TRAIN, [pii.base_spans(t) for t in TRAIN])], pii.PiiSpec())


def added(text, field):
    return [(text[s:e], pii.NAMES[k]) for s, k, e in pii.find_spans([text], field, pii.PiiSpec())[1][0] if k >= len(pii.KINDS)]


def test_the_field_decides_more_than_equal_keys():
    """Two cards in a row and a phone before an address fail their patterns; their forms tell, without another mention."""
    field = trained()
    assert added("Pay by 4111111111111111 4111111111111111 now", field) == [("4111111111111111", "card_like")] * 2
    assert [x for x, _ in added("Call +1 (826) 555-4081 190.137.223.20 soon", field)] == ["+1", "(826)", "555-4081"]
    # the same number written without its country code is similar, not equal
    assert added("Call +1 (389) 555-0101. Again: 389-555-0101 or 389-555-0101.", field) == [("389-555-0101", "phone_like")] * 2
    for clean in ("On 2023-10-05 at 12:30 we met 5.000.000 people in 1999.", "Version 1.2.3.4567 of 12345678", "Again: 389/555/0199 x@y", "4111111111111112 4111111111111112"):
        assert added(clean, field) == []


def test_a_document_does_not_depend_on_its_neighbours():
    field = trained()
    texts = TRAIN[:20] + ["a@b.cd " + "a(at)b.cd 12 " * 30, "", "Call +1 (389) 555-0101. Again: 389-555-0101"] + ["7 " * 500]
    together = pii.search(texts, field, pii.PiiSpec())
    for order in (range(len(texts)), range(len(texts) - 1, -1, -1)):
        alone = [pii.infer(pii.graph([texts[i]], [pii.base_spans(texts[i])]), field, pii.PiiSpec()) for i in order if texts[i]]
        g = pii.graph([texts[i] for i in order], [pii.base_spans(texts[i]) for i in order])
        assert np.array_equal(pii.infer(g, field, pii.PiiSpec()), np.concatenate(alone))
    assert together[1] == [pii.find_spans([t], field, pii.PiiSpec())[1][0] for t in texts]


def test_a_document_that_does_not_settle_is_marked(spark):
    docs = spark.createDataFrame([(1, "a@b.cd 12 a(at)b.cd 13", None, None), (2, "none", None, None)], DOCS)
    rows = {r["doc_id"]: r["settled"] for r in pii.detect(docs, trained(), pii.PiiSpec(rounds=1)).collect()}
    assert rows == {1: False, 2: True}
    assert all(r["settled"] for r in pii.detect(docs, trained()).collect())
