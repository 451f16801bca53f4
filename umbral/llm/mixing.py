"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

Every source has a weight and a size (words). Targets share a total by weight; a source whose share
would exceed ``max_epochs`` times its size is clamped there, and the excess is shared again among
the others by weight until no target is above its clamp. The water level only rises from round to
round, so a round is one aggregate over the sources: the words of those clamped at the present level
and the weight of the rest.

A source then takes floor(target / size) whole repetitions of every document, and for the fraction
left, documents in the order of a seeded hash until the target is met; of the one that crosses it the
words up to the target count as taken, and ``mixed_documents``, whose texts stay whole, takes it or not,
whichever is nearer. The crossing is found from a histogram of hash buckets per source, so only one bucket
of a source is ever ordered, and a source that holds a third of all rows is summed like any other.

Defined cases: null or wordless texts have size 0 and are never taken; a null source is a source of
its own, after all others; a source of size 0 keeps its weight until it is clamped at 0; repeated
rows count each time; a null doc_id hashes like an empty one; other columns are ignored unless they
are asked for; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbral.llm.common import delete_path, materialise
from umbral.operators.graph import number_globally

#: A word: a run of characters other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSpec:
    weights: tuple[int, ...] = (1, 2, 3)   # given to the sources in turn
    max_epochs: int = 3
    seed: int = 17
    buckets: int = 3                       # hex digits of the hash that make a bucket


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, total: int) -> float:
    """The level at which targets least(level * weight, clamp) sum to ``total``; sources has (weight, clamp)."""
    level, clamped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > F.col("clamp")
        r = sources.agg(F.sum(F.when(over, F.col("clamp"))).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("free"),
                        F.count_if(over).alias("n")).first()
        if r["n"] == clamped or not r["free"]:
            return level
        clamped, level = r["n"], (total - int(r["full"] or 0)) / int(r["free"])


def mix(docs: DataFrame, spec: MixSpec = MixSpec(), keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, *keep) of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("source").alias("_source"), word_count(F.col("text")).alias("size"),
                       F.md5(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_hash"), *keep)
    rows, _ = materialise(rows)
    bucket = F.substring("_hash", 1, spec.buckets)
    parts, parts_path = materialise(rows.groupBy("_source", bucket.alias("_bucket")).agg(F.sum("size").alias("_words")))
    sources = parts.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    n = len(spec.weights)
    weights = F.element_at(F.array(*[F.lit(w) for w in spec.weights]), (F.col("_at") % n + 1).cast("int"))
    sources, sources_path = materialise(number_globally(sources, [F.col("_source").asc_nulls_last()], "_at")
                                        .select("_source", "source_size", weights.alias("weight"),
                                                (F.col("source_size") * spec.max_epochs).alias("clamp")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, int(total))
    over = F.lit(level) * F.col("weight") > F.col("clamp")
    goal = sources.select(F.col("_source").alias("_s"), "source_size", F.when(over, F.col("clamp").cast("double")).otherwise(F.lit(level) * F.col("weight")).alias("target"))
    goal = (goal.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
            .withColumn("_rest", F.floor("target").cast("long") - F.col("_whole") * F.col("source_size")))
    # the bucket in which each source's fraction ends; a source has at most 16 ** buckets of them
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (parts.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
            .join(goal, F.col("_source").eqNullSafe(F.col("_s")))
            .groupBy("_s", "source_size", "target", "_whole", "_rest")
            .agg(F.max_by("_bucket", F.when(F.col("_before") < F.col("_rest"), F.col("_bucket"))).alias("_end"),
                 F.max(F.when(F.col("_before") < F.col("_rest"), F.col("_before"))).alias("_start")))
    ends, _ = materialise(ends)
    delete_path(spark, parts_path)
    delete_path(spark, sources_path)
    known = rows.join(ends, F.col("_source").eqNullSafe(F.col("_s")))
    at = F.coalesce(bucket == F.col("_end"), F.lit(False))
    clear = known.filter(~at).withColumn("_extra", F.when(bucket < F.col("_end"), F.col("size")).otherwise(F.lit(0)))
    run = Window.partitionBy("_source").orderBy("_hash", "doc_id", F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest") - F.col("_start") - F.coalesce(F.sum("size").over(run), F.lit(0))
    split = known.filter(at).withColumn("_extra", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    return clear.unionByName(split).select("doc_id", "size", "source_size", "target",
                                           (F.col("_whole") * F.col("size") + F.col("_extra")).cast("long").alias("taken"), *keep)


def mixed_documents(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, texts whole.

    Where a source's target ends inside a document, that document is taken once more or not, whichever
    is nearer to the target (once more where both are as near), so a source misses its target by at most half a document.
    """
    columns = [F.col(c) for c in docs.columns]
    taken = mix(docs.select("doc_id", "source", "text", F.struct(*columns).alias("_row")), spec, ("_row",))
    # the nearest whole number of times
    times = F.when(F.col("size") > 0, F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))).otherwise(F.lit(0)).cast("int")
    return taken.filter(times > 0).select(F.explode(F.array_repeat("_row", times)).alias("_row")).select("_row.*")


def mix_sql(spec: MixSpec = MixSpec()) -> str:
    """The same rows in SQL: the level is the first one, by rising clamp per weight, that leaves its source unclamped."""
    weights = "[" + ", ".join(map(str, spec.weights)) + "]"
    return rf"""
WITH rows AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('{spec.seed}:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
src AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         {weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(spec.weights)} + 1] AS w
  FROM rows GROUP BY source),
ordered AS (
  SELECT *, {spec.max_epochs} * source_size AS clamp,
         (SELECT SUM(source_size) FROM src) AS total, (SELECT SUM(w) FROM src) AS weight_all,
         COALESCE(SUM({spec.max_epochs} * source_size) OVER lower_ones, 0) AS full_words, COALESCE(SUM(w) OVER lower_ones, 0) AS full_weight
  FROM src WINDOW lower_ones AS (ORDER BY {spec.max_epochs} * source_size * 1.0 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT CAST(total - full_words AS DOUBLE) / CAST(weight_all - full_weight AS DOUBLE) AS level FROM ordered
  WHERE CAST(total - full_words AS DOUBLE) / CAST(weight_all - full_weight AS DOUBLE) * w <= clamp
  ORDER BY clamp * 1.0 / w, source NULLS LAST LIMIT 1),
goal AS (
  SELECT source, source_size, CASE WHEN level * w > {spec.max_epochs} * source_size THEN CAST({spec.max_epochs} * source_size AS DOUBLE) ELSE level * w END AS target
  FROM src, levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
run AS (
  SELECT r.*, p.source_size, p.target, p.whole, CAST(floor(p.target) AS BIGINT) - p.whole * p.source_size AS rest,
         COALESCE(SUM(r.size) OVER (PARTITION BY r.source ORDER BY r.h, r.doc_id, r.size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + GREATEST(0, LEAST(size, rest - before)) AS BIGINT) AS taken FROM run"""
