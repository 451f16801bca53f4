"""Origin repair: calls made on an extended circle mapped back onto the record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.session import cut


def resolve_twins(calls: DataFrame, record: str = "plasmid_id", call: str = "call_id", start: str = "start",
                  end: str = "end", strand: str = "strand", partial: str = "partial", length: str = "length",
                  extended: str = "extended", bin_width: int = 5_000) -> DataFrame:
    """Kept calls with ``origin_spanning`` and record coordinates (``start > end`` across the cut).

    A call that reaches into the appended copy and a call one molecule length earlier, on the
    same strand and in the same frame, are twins if they overlap; the one farther from the ends
    of the extended text stays (equal margins keep the record's call). A partial call without a
    twin goes, and so does a complete call inside the copy without a twin that overlaps a kept
    call. Both lookups are equi-joins on (record, coordinate bin), not a pairing of all calls.
    """
    s, e, L = F.col(start), F.col(end), F.col(length)
    margin = F.least(s - 1, F.col(extended) - e)
    base = calls.select(record, call, F.col(start).alias("s"), F.col(end).alias("e"), F.col(strand).alias("st"),
                        (F.col(partial).cast("int") != 0).alias("p"), L.alias("L"), margin.alias("mg"))
    base = cut(base)
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / bin_width), F.floor(b / bin_width)))
    first = lambda a1, a2: F.floor(F.greatest(a1, a2) / bin_width) == F.col("_bin")
    b = (base.filter("e > L").select(record, F.col(call).alias("jb"), (F.col("s") - F.col("L")).alias("bs"),
                                     (F.col("e") - F.col("L")).alias("be"), F.col("st").alias("bst"), F.col("mg").alias("bmg"))
         .withColumn("_bin", bins(F.col("bs"), F.col("be"))))
    a = base.withColumn("_bin", bins(F.col("s"), F.col("e")))
    tw = a.join(b, [record, "_bin"]).filter(
        (F.col(call) != F.col("jb")) & (F.col("st") == F.col("bst")) & (F.pmod(F.col("e") - F.col("be"), F.lit(3)) == 0)
        & (F.col("s") <= F.col("be")) & (F.col("bs") <= F.col("e")) & first(F.col("s"), F.col("bs")))
    lost = F.when(F.col("bmg") > F.col("mg"), F.col(call)).otherwise(F.col("jb"))
    fate = (tw.select(record, F.explode(F.array(
        F.struct(F.col(call).alias("c"), (lost == F.col(call)).cast("int").alias("d")),
        F.struct(F.col("jb").alias("c"), (lost == F.col("jb")).cast("int").alias("d")))).alias("x"))
        .groupBy(record, F.col("x.c").alias(call)).agg(F.max("x.d").alias("_drop")))
    m = cut(base.join(fate, [record, call], "left"))
    lone = F.col("_drop").isNull()
    alive = m.filter((F.coalesce("_drop", F.lit(0)) == 0) & ~(lone & F.col("p")))
    in_copy = alive.filter(lone & (F.col("s") > F.col("L")))
    rest = alive.join(in_copy.select(record, call), [record, call], "left_anti")
    at = F.explode(F.array(F.lit(0), F.col("L"))).alias("_shift")
    kept = (rest.select(record, "s", "e", at).select(record, (F.col("s") - F.col("_shift")).alias("ks"), (F.col("e") - F.col("_shift")).alias("ke"))
            .withColumn("_bin", bins(F.col("ks"), F.col("ke"))))
    probe = in_copy.select(record, call, (F.col("s") - F.col("L")).alias("cs"), (F.col("e") - F.col("L")).alias("ce")).withColumn(
        "_bin", bins(F.col("cs"), F.col("ce")))
    clash = probe.join(kept, [record, "_bin"]).filter((F.col("ks") <= F.col("ce")) & (F.col("cs") <= F.col("ke"))).select(
        record, call).distinct()
    final = rest.unionByName(in_copy.join(clash, [record, call], "left_anti"), allowMissingColumns=True)
    back = lambda c: F.when(F.col(c) > F.col("L"), F.col(c) - F.col("L")).otherwise(F.col(c))
    return final.select(record, call, back("s").alias(start), back("e").alias(end), F.col("st").alias(strand),
                        F.col("p").cast("int").alias(partial),
                        ((F.col("s") <= F.col("L")) & (F.col("e") > F.col("L"))).cast("int").alias("origin_spanning"))
