"""Ordered neighbours on linear and circular records, without a task per record.

A record may hold a third of all items, so nothing here scans a large record in one window.
``ordinals`` cuts a large record at measured splitters into bins of about equal count, ranks inside
a bin and adds the counts of the bins before it. ``tiles`` then cuts the ordinals into runs of ``tile_rows`` items with a
halo of ``w`` items on both sides (across the origin of a circle too), and the windows run per
(record, tile). A record shorter than a tile is one tile, so the common case costs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbral.functions.coords import segments
from umbral.session import cut

#: Items of a record above which it is cut into bins, and the most bins it is cut into.
BIN_ROWS = 200_000
MAX_BINS = 1024
TILE_ROWS = 200_000
_PER_BIN = 16


def splitters(items: DataFrame, large: DataFrame, record: str, key: Column, per_bin: int = _PER_BIN) -> DataFrame:
    """(record, _cuts): ascending values of ``key`` that cut each record of ``large`` (record, _rows, _bins) into bins of about equal count.

    They are every ``per_bin``-th of about as many sampled keys per bin. A row is in the sample by a hash of its
    key, so a record's sample has the size the bins ask for and not the record's.
    """
    share = F.least(F.lit(1.0), F.col("_bins") * float(per_bin) / F.col("_rows"))
    drawn = (items.select(record, key.alias("_k")).join(large, record)
             .filter(F.pmod(F.xxhash64("_k"), F.lit(1 << 30)) < share * (1 << 30)).select(record, "_k").distinct())
    return drawn.groupBy(record).agg(F.sort_array(F.collect_list("_k")).alias("_s")).select(
        record, F.filter("_s", lambda x, i: i % per_bin == per_bin - 1).alias("_cuts"))


def bin_of(key: Column, cuts: str = "_cuts") -> Column:
    """How many cuts are at most ``key``: steps of 32 first, then single ones."""
    step = F.size(F.filter(cuts, lambda x, i: (i % 32 == 31) & (x <= key))) * 32
    return F.coalesce(step + F.size(F.filter(F.slice(cuts, step + 1, F.lit(32)), lambda x: x <= key)), F.lit(0))


def ordinals(items: DataFrame, record: str = "plasmid_id", order=("start", "end"), name: str = "ord",
             count: str | None = "n_items", bin_rows: int = BIN_ROWS, first: Column | None = None) -> DataFrame:
    """Zero-based position ``name`` in ``order`` within each record, and the record's size.

    ``first`` marks items that precede all others whatever their order (items that span the origin).
    Records of at most ``bin_rows`` items are ranked as they are. Larger ones are cut by
    :func:`splitters`, on all order columns together and whatever their type, so neither clustered
    coordinates nor coordinates that repeat fill one bin.
    """
    lead = [] if first is None else [F.when(first, F.lit(0)).otherwise(F.lit(1))]
    by = lead + [F.col(c) for c in order]
    known = items.filter(F.col(record).isNotNull())
    per = Window.partitionBy(record)
    rows = known.groupBy(record).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > bin_rows)
    large = cut(rows.withColumn("_bins", F.least(F.lit(MAX_BINS), F.ceil(F.col("_rows") / bin_rows).cast("int"))))
    if large.limit(1).count() == 0:
        out = known.withColumn(name, (F.row_number().over(per.orderBy(*by)) - 1).cast("bigint"))
        return out.withColumn(count, F.count(F.lit(1)).over(per)) if count else out
    key = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(by)])
    cuts = cut(splitters(known, large, record, key))
    binned = known.join(cuts, record, "left").withColumn("_bin", bin_of(key)).drop("_cuts")
    sizes = binned.groupBy(record, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = per.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(record, "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(per).alias("_size"))
    inside = Window.partitionBy(record, "_bin").orderBy(*by)
    out = (binned.join(offsets, [record, "_bin"])
           .withColumn(name, (F.col("_before") + F.row_number().over(inside) - 1).cast("bigint")))
    if count:
        out = out.withColumn(count, F.col("_size").cast("bigint"))
    return out.drop("_bin", "_before", "_size")


def assign_ordinals(items: DataFrame, record: str = "plasmid_id", order=("start", "end"),
                    item: str = "orf_id", bin_rows: int = BIN_ROWS) -> DataFrame:
    """Item ids '<record>|<n>', numbered once from 1; an already numbered input is refused."""
    if item in items.columns:
        raise ValueError(f"{item} is already assigned; numbering again would rename the items")
    o = ordinals(items, record, order, "_ord", None, bin_rows)
    return o.withColumn(item, F.concat_ws("|", F.col(record).cast("string"), (F.col("_ord") + 1).cast("string"))).drop("_ord")


def genomic_order(items: DataFrame, record: str = "plasmid_id", order=("start", "end"),
                  spans: str = "spans_origin", bin_rows: int = BIN_ROWS) -> DataFrame:
    """Position from 1, origin-spanning items first, and the padded '<record>_<position>' id.

    '_' in a record id becomes '-'. :func:`genomic_name_clashes` finds ids this would merge.
    """
    o = ordinals(items, record, order, "_ord", None, bin_rows, first=F.col(spans).cast("int") == 1)
    safe = F.replace(F.col(record).cast("string"), F.lit("_"), F.lit("-"))
    pos = (F.col("_ord") + 1).cast("string")
    padded = F.when(F.length(pos) < 5, F.lpad(pos, 5, "0")).otherwise(pos)
    return o.withColumn("position", F.col("_ord") + 1).withColumn("gembase_id", F.concat_ws("_", safe, padded)).drop("_ord")


def genomic_name_clashes(items: DataFrame, record: str = "plasmid_id") -> DataFrame:
    """Records whose ids differ only in '_' against '-'."""
    r = items.select(record).distinct().withColumn(
        "replicon", F.replace(F.col(record).cast("string"), F.lit("_"), F.lit("-")))
    return r.groupBy("replicon").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def tiles(ordered: DataFrame, w: int, circular: Column, record: str = "plasmid_id",
          tile_rows: int = TILE_ROWS) -> DataFrame:
    """Each item once as ``_core`` and again in every tile whose halo it falls in.

    ``_at`` is the item's ordinal as that tile sees it: across the origin it is shifted by the
    record size, so inside a tile neighbours are always consecutive. A copy is only made where
    the item is within ``w`` of a core item and within ``w`` or n-1 steps of it.
    """
    o, n = F.col("ord"), F.col("n_items")
    wraps = F.when(circular, F.array(F.lit(0), F.lit(-1), F.lit(1))).otherwise(F.array(F.lit(0)))
    seen_at = F.transform(wraps, lambda s: o + s * n)
    near = F.filter(seen_at, lambda a: (a >= -w) & (a <= n - 1 + w))
    last = F.floor((n - 1) / tile_rows)
    clip = lambda t: F.greatest(F.lit(0).cast("bigint"), F.least(last, t))
    placed = F.array_distinct(F.flatten(F.transform(near, lambda a: F.transform(
        F.array(a - w, a, a + w), lambda p: F.struct(clip(F.floor(p / tile_rows)).alias("_tile"), a.alias("_at"))))))
    ex = ordered.withColumn("_p", F.explode(placed)).select("*", "_p._tile", "_p._at").drop("_p")
    # A copy is worth keeping only inside the tile's core plus halo.
    lo, hi = F.col("_tile") * tile_rows, F.least((F.col("_tile") + 1) * tile_rows, n) - 1
    ex = ex.filter((F.col("_at") >= lo - w) & (F.col("_at") <= hi + w))
    return ex.withColumn("_core", (F.col("_at") == F.col("ord")) & (F.col("_at") >= lo) & (F.col("_at") <= hi))


def flanks(ordered: DataFrame, w: int, circular: Column, fields, record: str = "plasmid_id",
           tile_rows: int = TILE_ROWS) -> DataFrame:
    """Items with ``left`` and ``right``: arrays of struct(fields), nearest first.

    ``ordered`` comes from :func:`ordinals`. A linear record truncates; a circle of n items
    gives at most n-1 on each side and the two sides may share items.
    """
    t = tiles(ordered, w, circular, record, tile_rows)
    win = Window.partitionBy(record, "_tile").orderBy("_at")
    payload = F.struct(*fields)
    k = F.when(circular, F.least(F.lit(w).cast("bigint"), F.col("n_items") - 1)).otherwise(F.lit(w).cast("bigint"))
    left = F.array(*[F.lag(payload, d).over(win) for d in range(1, w + 1)])
    right = F.array(*[F.lead(payload, d).over(win) for d in range(1, w + 1)])
    keep = lambda c: F.filter(F.slice(F.col(c), F.lit(1), F.greatest(F.lit(1), k).cast("int")), lambda x: x.isNotNull())
    out = t.withColumn("_l", left).withColumn("_r", right).filter("_core")
    empty = lambda c: F.when(k > 0, keep(c)).otherwise(F.slice(F.col(c), 1, 0))
    return out.withColumn("left", empty("_l")).withColumn("right", empty("_r")).drop("_l", "_r", "_tile", "_at", "_core")


def strand_relative(df: DataFrame, minus: Column) -> DataFrame:
    """Left and right on the item's own strand."""
    both = F.when(minus, F.struct(F.col("right").alias("l"), F.col("left").alias("r"))).otherwise(
        F.struct(F.col("left").alias("l"), F.col("right").alias("r")))
    return df.withColumn("_lr", both).withColumn("left", F.col("_lr.l")).withColumn("right", F.col("_lr.r")).drop("_lr")


def neighbour_pairs(ordered: DataFrame, w: int, circular: Column, item: str, record: str = "plasmid_id") -> DataFrame:
    """(record, item, d, side, neighbour): the ±w neighbour relation as rows.

    An equi-join on (record, ordinal): each item is looked up at most 2w times, and the key is
    unique on the looked-up side, so no record size matters.
    """
    n, o = F.col("n_items"), F.col("ord")
    steps = F.array(*[F.lit(s * d) for d in range(1, w + 1) for s in (-1, 1)])
    reach = F.when(F.col("_c"), F.least(F.lit(w), n - 1)).otherwise(F.lit(w))
    asked = (ordered.select(record, item, "ord", "n_items", circular.alias("_c"))
             .withColumn("_step", F.explode(steps)).filter(F.abs("_step") <= reach)
             .withColumn("_to", F.when(F.col("_c"), F.pmod(o + F.col("_step"), n)).otherwise(o + F.col("_step"))))
    other = ordered.select(record, F.col("ord").alias("_to"), F.col(item).alias("neighbour"))
    return asked.join(other, [record, "_to"]).select(
        record, item, F.abs("_step").alias("d"),
        F.when(F.col("_step") < 0, "left").otherwise("right").alias("side"), "neighbour")


def window_cover(pairs: DataFrame, ordered: DataFrame, item: str, record: str = "plasmid_id") -> DataFrame:
    """Per item: whether its window holds every other item of the record."""
    near = pairs.groupBy(record, item).agg(F.count_distinct("neighbour").alias("n_near"))
    return ordered.select(record, item, "n_items").join(near, [record, item], "left").select(
        record, item, (F.coalesce("n_near", F.lit(0)) == F.col("n_items") - 1).cast("int").alias("covers"))


def directons(ordered: DataFrame, max_gap: int, circular: Column, length: Column, record: str = "plasmid_id",
              start: str = "start", end: str = "end", strand: str = "strand",
              tile_rows: int = TILE_ROWS, counted: dict[str, Column] | None = None) -> DataFrame:
    """Items with ``unit`` (ordinal of the unit's first item) and ``unit_size``.

    A unit continues while the strand repeats and the gap to the *previous* item's end is at
    most ``max_gap``. On a circle the last unit joins the first when the gap across the origin
    fits and they are not the same unit; the joined unit takes the last unit's number. The
    running maximum that names units is taken per tile and carried over by the tiles' own
    maxima, one row per tile. ``counted`` (name: condition) adds how many items of the unit meet each condition.
    """
    counted = counted or {}
    lin = tiles(ordered, 1, F.lit(False), record, tile_rows)
    win = Window.partitionBy(record, "_tile").orderBy("_at")
    gap = F.col(start) - F.lag(end).over(win) - 1
    same = F.coalesce((F.lag(strand).over(win) == F.col(strand)) & (gap <= max_gap), F.lit(False))
    cores = lin.withColumn("_new", ~same).filter("_core").withColumn("_mark", F.when(F.col("_new"), F.col("ord")))
    upto = win.rowsBetween(Window.unboundedPreceding, 0)
    # written once: read for the ends, for the sizes and for the result
    units = cut(cores.withColumn("_seen", F.max("_mark").over(upto)).drop("_at", "_core", "_new"))
    if units.filter("_tile > 0").limit(1).count():
        marks = units.groupBy(record, "_tile").agg(F.max("_mark").alias("_m"))
        prior = Window.partitionBy(record).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
        carried = marks.select(record, "_tile", F.max("_m").over(prior).alias("_carry")).filter("_tile > 0")
        units = units.join(carried, [record, "_tile"], "left").withColumn("unit", F.coalesce("_seen", "_carry")).drop("_carry")
    else:   # the first item of a record opens a unit, so nothing is carried into a first tile
        units = units.withColumn("unit", F.col("_seen"))
    units = units.drop("_tile", "_mark", "_seen")
    ends = (units.filter(circular & ((F.col("ord") == 0) | (F.col("ord") == F.col("n_items") - 1)))
            .groupBy(record).agg(F.min_by(F.struct(start, strand), "ord").alias("_f"),
                                 F.max_by(F.struct(start, end, strand, F.col("unit").alias("u")), "ord").alias("_z"),
                                 F.max(length).alias("_len")))
    over = F.when(F.col(f"_z.{start}") > F.col(f"_z.{end}"), F.col(f"_f.{start}") - F.col(f"_z.{end}") - 1).otherwise(
        F.col("_len") - F.col(f"_z.{end}") + F.col(f"_f.{start}") - 1)
    last = ends.filter((F.col(f"_f.{strand}") == F.col(f"_z.{strand}")) & (over <= max_gap) & (F.col("_z.u") > 0)).select(
        record, F.col("_z.u").alias("_last"))
    sums = {"unit_size": F.lit(1), **{n: F.coalesce(c, F.lit(False)).cast("int") for n, c in counted.items()}}
    sizes = units.groupBy(record, "unit").agg(*[F.sum(c.cast("bigint")).alias(n) for n, c in sums.items()])
    merged = (sizes.join(last, record, "left")
              .withColumn("_final", F.when((F.col("unit") == 0) & F.col("_last").isNotNull(), F.col("_last")).otherwise(F.col("unit"))))
    total = Window.partitionBy(record, "_final")
    named = merged.select(record, "unit", "_final", *[F.sum(n).over(total).alias(n) for n in sums])
    return units.join(named, [record, "unit"]).withColumn("unit", F.col("_final")).drop("_final")


def surroundings(items: DataFrame, circular: Column, length: Column, window: int, max_gap: int, fields, counted: dict[str, Column] | None = None,
                 record: str = "plasmid_id", strand: str = "strand", order=("start", "end")) -> DataFrame:
    """Items in order with their unit and their flanks: :func:`directons`, then :func:`flanks` whose entries carry ``fields`` and their unit ``u``.

    Units come first and travel on, so neither the units nor what a neighbour's unit is has to be joined to the flanks.
    """
    o = ordinals(items, record, order)
    units = directons(o, max_gap, circular, length, record, strand=strand, counted=counted)
    return flanks(units, window, circular, [*fields, F.col("unit").alias("u")], record)


#: Interval lengths grow by this factor from level to level.
LEVEL_FACTOR = 8


def level_widths(finest: int) -> list[int]:
    """Bin widths level by level, up to the largest coordinate a 64-bit integer holds."""
    out = [finest]
    while out[-1] < 2 ** 62 // LEVEL_FACTOR:
        out.append(out[-1] * LEVEL_FACTOR)
    return out


def interval_overlap_join(items: DataFrame, elements: DataFrame, record: str = "plasmid_id",
                          start: str = "start", end: str = "end", bin_width: int = 1_000,
                          elements_prefix: str = "el_", length: str | None = None) -> DataFrame:
    """Every (item, element) pair that overlaps on the same record; both may wrap the origin.

    Both sides are cut into segments. A segment has one home: the bin its start lies in, at the lowest
    level whose bins (``bin_width``, then eight times as wide from level to level) are as wide as the
    segment is long. What overlaps it and is not longer than that level's bins starts in its home, a bin
    before or after; so of two segments the one of the lower level asks for the other at the other's level, in at
    most three bins, and only levels that the data have are asked for. A pair of segments meets in one
    place, and how often a segment is copied depends on the number of levels and not on its length. A
    pair of features is emitted by its first overlapping segments only, so no distinct over the result
    is needed. An origin-spanning feature reaches to the record's last coordinate: ``length`` names
    that column of the items (and of the elements, if they have it), else it is the largest coordinate seen.
    """
    el = elements.select(*[F.col(c).alias(c if c == record else elements_prefix + c) for c in elements.columns])
    es, ee = elements_prefix + start, elements_prefix + end
    if length is None:
        reach = lambda d, a, b: d.groupBy(record).agg(F.max(F.greatest(a, b)).alias("_L"))
        tops = reach(items, start, end).unionByName(reach(el, es, ee)).groupBy(record).agg(F.max("_L").alias("_L"))
        left, right = items.join(tops, record), el.join(tops, record)
    else:
        left = items.withColumn("_L", F.col(length))
        own = elements_prefix + length
        right = (el.withColumn("_L", F.col(own)) if own in el.columns else
                 el.join(items.groupBy(record).agg(F.max(length).alias("_L")), record))
    widths = level_widths(bin_width)

    def placed(df, a, b, tag):
        seg = segments(F.col(a), F.col(b), F.col("_L"))
        lo, hi = F.col(f"_{tag}a"), F.col(f"_{tag}b")
        level = sum((F.when(hi - lo >= w, 1).otherwise(0) for w in widths[1:-1]), F.when(hi - lo >= widths[0], 1).otherwise(0))
        return (df.withColumn(f"_{tag}all", seg).select("*", F.explode(f"_{tag}all").alias(f"_{tag}s"))
                .withColumn(f"_{tag}a", F.col(f"_{tag}s.seg_start").cast("bigint")).withColumn(f"_{tag}b", F.col(f"_{tag}s.seg_end").cast("bigint"))
                .drop(f"_{tag}s", "_L").filter(lo <= hi).withColumn("_level", level))

    l, r = placed(left, start, end, "x"), placed(right, es, ee, "y")
    # a few small numbers per side: the levels that occur
    levels = lambda d: sorted(v.asDict()["_level"] for v in d.select("_level").distinct().collect())
    held_l, held_r = levels(l), levels(r)

    def meet(df, tag, asks_own, other, turn):
        """Homes in the turn of the side that is asked, probes in the other turn, as rows (turn, level, bin)."""
        lo, hi, own = F.col(f"_{tag}a"), F.col(f"_{tag}b"), F.col("_level")
        width = F.element_at(F.array(*[F.lit(w) for w in widths]), own + 1)
        place = lambda t, n, k: F.struct(F.lit(t).alias("_turn"), n.cast("int").alias("_at"), k.cast("bigint").alias("_bin"))
        home = F.array(place(1 - turn, own, F.floor(lo / width)))
        asked = lambda n: F.transform(F.sequence(F.floor((lo - widths[n]) / widths[n]), F.floor(hi / widths[n])), lambda k: place(turn, F.lit(n), k))
        none = F.array().cast("array<struct<_turn:int,_at:int,_bin:bigint>>")
        probes = [F.when((F.lit(n) >= own) if asks_own else (F.lit(n) > own), asked(n)).otherwise(none) for n in other]
        return df.withColumn("_p", F.explode(F.flatten(F.array(home, *probes)))).select("*", "_p.*").drop("_p", "_level")

    a, b = meet(l, "x", True, held_r, 0), meet(r, "y", False, held_l, 1)
    over = (F.col("_xa") <= F.col("_yb")) & (F.col("_xb") >= F.col("_ya"))
    # Earlier segment pairs of the same two features that also overlap would emit the pair twice.
    earlier = F.exists("_xall", lambda p: F.exists("_yall", lambda q: (
        (p["seg_start"] <= q["seg_end"]) & (p["seg_end"] >= q["seg_start"])
        & (F.struct(p["seg_start"], q["seg_start"]) < F.struct(F.col("_xa"), F.col("_ya"))))))
    j = a.join(b, [record, "_turn", "_at", "_bin"]).filter(over & ~earlier)
    return j.drop("_turn", "_at", "_bin", "_xall", "_yall", "_xa", "_xb", "_ya", "_yb")
