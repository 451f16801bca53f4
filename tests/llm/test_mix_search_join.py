"""Mixing, nearest neighbours, the Jaccard join and the pipeline against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from umbral.llm import jaccard, mixing, neighbours

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIX = "doc_id long, text string, source string, size string, taken string"


def water_fill(sizes, weights, total, epochs):
    """Clamp, share the excess again by weight, until nothing is above its clamp."""
    full, target = set(), {}
    while True:
        left = Fraction(total - sum(epochs * sizes[s] for s in full))
        free = sum(weights[s] for s in sizes if s not in full)
        target = {s: Fraction(epochs * sizes[s]) if s in full else left * weights[s] / free for s in sizes} if free else {s: Fraction(epochs * sizes[s]) for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > epochs * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("hot", [1, 40])
def test_mix_meets_its_targets(spark, hot):
    rng = random.Random(hot)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randint(0, 30))), rng.choice(["a", "b", "é", "Z", None] + ["a"] * hot), "x", "y") for i in range(300)]
    rows += [(900, None, "empty", None, None), (901, "", "empty", None, None), (5, rows[5][1], rows[5][2], None, None), (None, "one two", "b", None, None)]
    docs = spark.createDataFrame(rows, MIX)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_fill(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, sum(sizes.values()), 3)
    source_of = {(r[0], len(WORD.findall(r[1] or ""))): r[2] for r in rows}
    taken = Counter()
    for r in got:
        s = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(float(want[s]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) < 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    # the documents of the mix are whole: each as often as its words taken say, to the nearest whole number
    out = mixing.mixed_documents(docs.withColumn("_words", F.lit(1)).withColumn("_row", F.lit(2)))
    assert out.columns == docs.columns + ["_words", "_row"]
    text_of = {(r[0], len(WORD.findall(r[1] or ""))): r[1] for r in rows}
    times = Counter()
    for r in got:
        if r["size"]:
            times[r["doc_id"], text_of[r["doc_id"], r["size"]]] += int(Fraction(r["taken"], r["size"]) + Fraction(1, 2))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == +times
    longest = max(r["size"] for r in got)
    mixed = Counter({r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()})
    assert all(abs(mixed[s] - want[s]) <= longest / 2 + 1 for s in sizes)
    assert mixing.mix(docs.filter("false")).count() == 0 and mixing.mixed_documents(docs.filter("false")).count() == 0


def nearest(x, ids, q, own, k):
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != own][:k]
    return [(int(ids[i]), d[i]) for i in order]


def test_search_recall_order_and_cases(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:900] = x[100]                       # one vector that is very common
    rows = [(i, [float(v) for v in x[i]], 0.0) for i in range(len(x))]
    rows += [(4000, None, 1.0), (4001, [0.0] * 16, 1.0), (4002, [float("nan")] + [1.0] * 15, 1.0), (4003, [None] + [1.0] * 15, 1.0), (4004, [float("inf")] * 16, 1.0),
             (4100, [1.0, 2.0], 1.0), (4200, [], 1.0), (None, [1.0] * 16, 1.0), rows[300], rows[301]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    spec = neighbours.TreeSpec(block=256)
    got = neighbours.search(vectors, F.col("vec_id") % 100 == 0, spec).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 3000, 100))
    wide, ids = x.astype(float), np.arange(3000)
    hits = 0
    for q, found in by.items():
        want = nearest(wide, ids, wide[q], q, 10)
        assert len(found) == 10 and [(s, v) for v, s in found] == sorted((s, v) for v, s in found)
        assert all(s == pytest.approx(float(np.sqrt(((wide[v] - wide[q]) ** 2).sum())), abs=1e-12) for v, s in found)
        hits += len({v for v, _ in want} & {v for v, _ in found})
        if 100 <= q < 900:
            assert found == [(v, 0.0) for v in range(100, 112) if v != q][:10]
    assert hits / (10 * len(by)) >= 0.9
    few = neighbours.search(vectors.filter("vec_id < 4"), F.col("vec_id") == 0, spec).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3]
    assert neighbours.search(vectors.filter("false"), F.col("vec_id") == 0, spec).count() == 0
    assert neighbours.search(vectors.filter("vec_id > 3500"), F.col("vec_id") == 4100, spec).count() == 0


def test_repeated_rows_take_one_place(spark):
    """Rows 0 (a query) and 1 (a near candidate) stand twelve times, row 2 with twelve vectors; no two distances are equal."""
    rng = np.random.default_rng(3)
    x = {i: [rng.normal(size=8) * (0.1 + 0.05 * i)] for i in range(40)}
    x[2] = [x[0][0] + rng.normal(size=8) * 0.01 for _ in range(12)]
    rows = [(i, v.tolist()) for i, vs in x.items() for v in vs] + 11 * [(i, x[i][0].tolist()) for i in (0, 1)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    for q in (0, 20):
        d = {i: min(float(np.sqrt(((v - x[q][0]) ** 2).sum())) for v in vs) for i, vs in x.items() if i != q}
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [v for _, v, _ in found] == sorted(d, key=d.get)[:10]
        assert [s for *_, s in found] == pytest.approx(sorted(d.values())[:10])


def test_leaves_are_opened_until_they_hold_enough_ids(spark):
    """Around query 0 stand forty vectors of one id, over several leaves; with one visit, leaves are opened by the ids they hold."""
    rng = np.random.default_rng(4)
    rows = [(0, [0.0, 0.1])] + [(1, (rng.normal(size=2)).tolist()) for _ in range(40)] + [(i, (rng.normal(size=2) + 50 + i).tolist()) for i in range(2, 15)]
    spec = neighbours.TreeSpec(leaf_size=4, recall=0.0)
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, spec).collect()
    assert len({r["vec_id"] for r in got}) == len(got) == 10


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(docs):
    ids = list({d for d, _ in docs if d is not None})
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    sets = [(d, shingles(t)) for d, t in docs if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


@pytest.fixture(scope="module")
def copies():
    """Groups of exact and near copies, a passage that most documents share, chains and odd texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=4)) for _ in range(400)]
    passage = rng.choices(vocabulary, k=60)
    docs = []
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.randint(20, 120))
        for _ in range(rng.choice([1, 2, 6, 40])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append(" ".join(w))
    for _ in range(60):
        docs.append(" ".join(rng.choices(vocabulary, k=rng.randint(5, 60)) + passage))
    chain = rng.choices(vocabulary, k=60)
    docs += [" ".join(chain[i:i + 40]) for i in range(0, 12, 2)]
    docs += ["", "", None, "two words", "Two WORDS", "two words more", "É a b c d", "é a b c d", "same " * 9, "same " * 400, "　x y z"]
    rng.shuffle(docs)
    return [(i * 7 + 3, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("spec", [jaccard.JaccardSpec(), jaccard.JaccardSpec(block=8, leaf=4, star_rounds=1, common=16), jaccard.JaccardSpec(star_rounds=0, groups=8, block=16)])
def test_components_equal_brute_force(spark, copies, spec):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in copies], "doc_id long, text string, cls string, n int")
    want = plain_components(copies)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs, spec).collect()}
    assert got == {i: (len(shingles(t)), want[i]) for i, t in copies}


def test_join_cases(spark):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "g h i j k l"), (3, "a b c d e f"), (None, "a b c d e f"), (4, ""), (5, None), (6, "x y"), (7, "x y"), (2, "g h i j k l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 2, 1), (0, 2, None), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6)], key=str)
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in jaccard.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, "a b c d e f"), (0, "a b c d e f"), (4, ""), (5, None), (6, "x y")], key=str)
    assert jaccard.near_duplicates(docs.filter("false")).count() == 0


def shuffled_bytes(spark):
    """Bytes that the stages of the session have written to shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_only_texts_to_be_compared_are_shuffled(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.randbytes(30).hex() for _ in range(100)) for _ in range(400)]
    texts += [texts[7] + " tail", texts[9] + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before, key = shuffled_bytes(spark), "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")           # as if the ids of the texts were many
    try:
        got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    finally:
        spark.conf.unset(key)
    assert got == {i: {400: 7, 401: 9}.get(i, i) for i in range(402)}
    assert shuffled_bytes(spark) - before < sum(map(len, texts))


def test_among_loses_no_row(spark):
    docs = spark.range(500).selectExpr("if(id % 50 = 0, null, id % 300) AS doc_id", "cast(id AS string) AS text")
    ids = spark.range(0, 900, 7).withColumnRenamed("id", "doc_id")
    want = set(map(tuple, docs.join(ids, "doc_id", "left_semi").collect()))
    few, many = (jaccard.among(docs, ids.union(ids), "doc_id", words).collect() for words in (1, 1 << 17))
    assert want and want <= set(map(tuple, few)) and len(few) < 500
    assert sorted(map(tuple, many)) == sorted(want)
    assert jaccard.among(docs, ids.filter("false"), "doc_id").count() == 0


def test_words_are_hashed_together(monkeypatch):
    rng = random.Random(4)
    words = ["ab" * k + c for k in range(40) for c in ("", "x", "y", "\0", "é")] + ["".join(rng.choices("abc", k=rng.randint(1, 30))) for _ in range(3000)]
    for kind in (pa.string(), pa.large_string()):
        for part in (pa.array(words, kind), pa.array(["drop", *words, "drop"], kind).slice(1, len(words)), pa.array(words, kind).slice(5, 0)):
            found = dict(zip(part.to_pylist(), jaccard.word_hashes(part).tolist()))
            assert len(set(found.values())) == len(found)
            assert [found[w] for w in part.to_pylist()] == jaccard.word_hashes(part).tolist()
    monkeypatch.setattr(jaccard, "xxhash", None)        # no call a word, unless it is a long one
    offsets, h = jaccard.shingle_sets(pa.array(["A b c d e f", "a B c d e", "", "a b", "a b c d e f"]), 5)
    assert offsets.tolist() == [0, 2, 3, 3, 4, 6] and h[2] in h[:2] and h[:2].tolist() == h[4:].tolist()


def test_tree_bounds_never_lose_a_pair():
    rng = np.random.default_rng(1)
    spec = jaccard.JaccardSpec(groups=16, leaf=4)
    base = rng.integers(0, 9, (8, 16))
    vec = np.maximum(base[rng.integers(0, 8, 200)] + rng.integers(-1, 2, (200, 16)) * (rng.random((200, 16)) < 0.1), 0).astype(np.uint16)
    n, comp = vec.sum(axis=1).astype(np.int64), rng.integers(0, 60, 200)
    for side in (np.zeros(200, np.int64), rng.integers(0, 2, 200)):
        i, j = jaccard.tree_pairs(vec, n, comp, n, side, spec)
        got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
        want = set()
        for a in range(200):
            for b in range(a + 1, 200):
                if comp[a] != comp[b] and (side.max() == 0 or side[a] != side[b]):
                    shared = np.minimum(vec[a], vec[b]).sum()
                    if 180 * shared >= 80 * (n[a] + n[b]) and 100 * max(n[a], n[b]) * 0.8 <= 100 * min(n[a], n[b]):
                        want.add((a, b))
        assert got == want and want


def test_pipeline_takes_effect(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    rng = random.Random(9)
    rows = []
    for i in range(60):
        w = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(rng.randint(25, 80))]
        rows.append((i, "Start " + " ".join(w) + f" mail u{i}@host.example.com.", "en", f"s{i % 4}", None))
    rows += [(100 + i, rows[i][1], "en", "s1", 5) for i in range(10)] + [(200, "short", None, None, None), (201, None, None, None, None), (202, "again and " * 200, "en", "s0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    seen = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen, folder).write.parquet(f"{folder}/out/{name}")
        seen = spark.read.parquet(f"{folder}/out/{name}")
        kept[name] = seen.collect()
        if name != "packing":
            assert seen.columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "packing"]
    assert sorted(r["doc_id"] for r in kept["quality_rules"]) == sorted([*range(60), *range(100, 110)])
    assert sorted(r["doc_id"] for r in kept["near_duplicates"]) == list(range(60))
    assert all("@" not in r["text"] and "<EMAIL>" in r["text"] for r in kept["personal_data"]) and len(kept["personal_data"]) == 60
    words = sum(len(WORD.findall(r["text"])) for r in kept["personal_data"])
    assert abs(sum(len(WORD.findall(r["text"])) for r in kept["source_mix"]) - words) <= 4
    assert {r["doc_id"] for r in kept["packing"]} == {r["doc_id"] for r in kept["source_mix"]}
    assert corpus_pipeline.run(spark, folder).count() == len(kept["packing"])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), folder).count() == 0
