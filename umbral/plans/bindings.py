"""How the driver's tables play the engine's roles, in Spark and in SQL side by side.

``occ``: events are items on records (users), ``hits``: order lines are hits of tiers against
entities (parts). Every row of the tables is used; the modulo expressions assign roles
(topology, size class, cluster ids) and never select rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.plans.catalog import Tables
from umbral.session import gather, spread
from umbral.specs import ContextSpec, Thresholds, TierSpec

#: Length of every record: 30 days in seconds.
LENGTH = 2_592_000
#: Rows of a table that one task works on at most.
TASK_ROWS = 500_000
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CONTEXT = ContextSpec(max_gap=43_200, window=3)


def occ(t: Tables) -> DataFrame:
    """The items; the written table where a query has asked for it by :func:`keep_occ`."""
    kept = t.kept("occ")
    return _occ(t) if kept is None else kept


def keep_occ(t: Tables) -> DataFrame:
    """The items, written once: for queries that read them many times."""
    return t.once("occ", lambda: _occ(t))


def _occ(t: Tables) -> DataFrame:
    gap = "(ts - TIMESTAMP_NTZ '2024-01-01 00:00:00')"
    sec = (f"extract(DAY FROM {gap}) * 86400 + extract(HOUR FROM {gap}) * 3600 + extract(MINUTE FROM {gap}) * 60"
           f" + floor(extract(SECOND FROM {gap}))")
    u = F.col("user_id")
    kind = F.array_position(F.array(*[F.lit(e) for e in EVENT_TYPES]), F.col("event_type")) - 1
    k = F.get_json_object("props", "$.k").cast("bigint")
    stop = F.col("start") + F.floor("value").cast("bigint")
    return (spread(t.events, TASK_ROWS).select(u.alias("plasmid_id"), F.col("event_id").alias("orf_id"), (F.expr(sec).cast("bigint") + 1).alias("start"),
                            "value", kind.cast("bigint").alias("t"), k.alias("k"), "event_type")
            .select("plasmid_id", "orf_id", "start",
                    F.when((F.col("plasmid_id") % 2 == 0) & (stop > LENGTH), stop - LENGTH).otherwise(stop).alias("end"),
                    F.when(F.col("event_type").isin("click", "view", "signup"), 1).otherwise(-1).alias("strand"),
                    (F.col("k") * 5 + F.col("t")).alias("seq_id"), "k", "t",
                    (F.col("k") % 20).alias("family_id"), (F.col("k") % 50).alias("close_id"),
                    F.floor(F.col("plasmid_id") / F.lit(3)).cast("bigint").alias("lineage"),
                    F.nullif(F.col("plasmid_id") % 7, F.lit(0)).alias("mob_cluster"),
                    F.when(F.col("k") % 3 == 0, "FUNCTIONAL").when(F.col("k") % 3 == 1, "NONE")
                    .otherwise("UNCHARACTERIZED_HOMOLOG").alias("functional_class"),
                    (F.col("k") % 3 != 0).alias("dark"), (F.col("plasmid_id") % 3 == 0).alias("small"),
                    (F.col("plasmid_id") % 2 == 0).alias("circular"), F.lit(LENGTH).cast("bigint").alias("length")))


OCC = f"""occ AS (
  SELECT plasmid_id, orf_id, start,
    CASE WHEN plasmid_id % 2 = 0 AND start + v > {LENGTH} THEN start + v - {LENGTH} ELSE start + v END AS "end",
    strand, k*5 + t AS seq_id, k, t, k % 20 AS family_id, k % 50 AS close_id,
    CAST(floor(plasmid_id / 3.0) AS BIGINT) AS lineage, NULLIF(plasmid_id % 7, 0) AS mob_cluster,
    CASE k % 3 WHEN 0 THEN 'FUNCTIONAL' WHEN 1 THEN 'NONE' ELSE 'UNCHARACTERIZED_HOMOLOG' END AS functional_class,
    k % 3 <> 0 AS dark, plasmid_id % 3 = 0 AS small, plasmid_id % 2 = 0 AS circular, CAST({LENGTH} AS BIGINT) AS length
  FROM (SELECT user_id AS plasmid_id, event_id AS orf_id,
          CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) - 1704067200 + 1 AS start, CAST(floor(value) AS BIGINT) AS v,
          CAST(list_position(['click','error','purchase','signup','view'], event_type) - 1 AS BIGINT) AS t,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
          CASE WHEN event_type IN ('click','view','signup') THEN 1 ELSE -1 END AS strand
        FROM events))"""

#: Items in order with their ordinal and record size.
ORD = OCC + """, ord AS (
  SELECT *, row_number() OVER (PARTITION BY plasmid_id ORDER BY start, "end", orf_id) - 1 AS ord,
         count(*) OVER (PARTITION BY plasmid_id) AS n FROM occ)"""

#: The ±3 neighbour relation, circles wrapping.
NEAR = ORD + """, near AS (
  SELECT a.plasmid_id, a.orf_id, a.seq_id, a.family_id, a.close_id, a.lineage, a.strand, a.small, d.d, b.orf_id AS nb, b.seq_id AS nb_seq,
         b.functional_class AS nb_class, b.family_id AS nb_family, b.close_id AS nb_close, b.k AS nb_k
  FROM ord a JOIN (VALUES (-3),(-2),(-1),(1),(2),(3)) d(d)
    ON abs(d.d) <= CASE WHEN a.circular THEN least(3, a.n - 1) ELSE 3 END
  JOIN ord b ON b.plasmid_id = a.plasmid_id
    AND b.ord = CASE WHEN a.circular THEN (a.ord + d.d + 3 * a.n) % a.n ELSE a.ord + d.d END)"""

#: Units of same-strand runs, first and last joined across the origin.
UNITS = """, flagged AS (
  SELECT *, CASE WHEN lag(strand) OVER w = strand AND start - lag("end") OVER w - 1 <= 43200 THEN 0 ELSE 1 END AS isnew
  FROM ord WINDOW w AS (PARTITION BY plasmid_id ORDER BY ord)),
 lin AS (SELECT *, max(CASE WHEN isnew = 1 THEN ord END) OVER (PARTITION BY plasmid_id ORDER BY ord) AS u0 FROM flagged),
 edge AS (SELECT z.plasmid_id, z.u0 AS last_u FROM lin z JOIN lin f ON f.plasmid_id = z.plasmid_id AND f.ord = 0
          WHERE z.ord = z.n - 1 AND z.circular AND z.u0 > 0 AND f.strand = z.strand
            AND CASE WHEN z.start > z."end" THEN f.start - z."end" - 1 ELSE z.length - z."end" + f.start - 1 END <= 43200),
 units AS (SELECT lin.*, CASE WHEN lin.u0 = 0 AND edge.last_u IS NOT NULL THEN edge.last_u ELSE lin.u0 END AS unit
           FROM lin LEFT JOIN edge USING (plasmid_id)),
 unit_size AS (SELECT plasmid_id, unit, count(*) AS unit_size, count(*) FILTER (functional_class = 'FUNCTIONAL') AS nf
               FROM units GROUP BY ALL)"""

TIERS = (TierSpec("T1", "pfam", None), TierSpec("T2", "swissprot", 5e-6), TierSpec("T3", "nr", 8e-6, skip_if_named_by=("pfam",)))
THR = Thresholds()
TIE = ("label", "coverage", "target_coverage", "evalue")


def hits(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_name", "p_size", "p_type")
    n, size = F.col("l_linenumber"), F.col("p_size")
    vague = (F.when(n <= 2, "hypothetical protein").when(n == 3, F.concat(F.lit("DUF"), size.cast("string")))
             .when(n == 4, "conserved protein").when(n == 5, F.concat(F.lit("uncharacterised "), F.col("p_name")))
             .otherwise("putative protein"))
    domain = F.concat("p_name", F.lit(" domain-containing protein"))
    full = F.concat_ws(" ", "p_name", F.lower("p_type"), F.col("l_returnflag"))
    label = (F.when(size % 5 == 0, vague).when(size % 5 == 1, F.when(n % 2 == 0, vague).otherwise(domain))
             .otherwise(F.when(n <= 3, vague).when(n == 4, domain).otherwise(full)))
    spanless = (F.col("l_linestatus") == "F") & (F.col("l_tax") == 0.08)
    tier = F.when(F.col("l_returnflag") == "R", "T1").when(F.col("l_returnflag") == "A", "T2").otherwise("T3")
    ev = F.when(F.col("l_tax") == 0.07, "NA").otherwise(F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("e-6")))
    start = F.floor("l_quantity").cast("int")
    return gather(t.lineitem, "l_partkey", TASK_ROWS // 2).join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("seq_id"), tier.alias("tier"),
        F.when(tier == "T1", "pfam").when(tier == "T2", "swissprot").otherwise("nr").alias("source"),
        label.alias("label"), ev.alias("evalue"), F.when(~spanless, start).alias("start"), F.when(~spanless, start + n * 5).alias("end"),
        F.round(F.col("l_quantity") / 50, 4).alias("coverage"), F.round(F.col("l_tax") * 10, 4).alias("target_coverage"))


def lengths(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("seq_id"), (F.col("p_size") + 85).alias("qlen"))


_VAGUE = """CASE WHEN l_linenumber <= 2 THEN 'hypothetical protein' WHEN l_linenumber = 3 THEN 'DUF' || p_size
   WHEN l_linenumber = 4 THEN 'conserved protein' WHEN l_linenumber = 5 THEN 'uncharacterised ' || p_name ELSE 'putative protein' END"""

UNINFORMATIVE_RE2 = (r"(?i)hypothetical|uncharacteri[sz]ed|(^|[^a-z])(DUF|UPF)[0-9]*($|[^a-z])|unknown function|unnamed protein"
                     r"|(^|^\S*\d\S*\s+|:\s*|Full=)(putative|predicted|conserved) protein\s*($|;|\[)")

HITS = rf"""raw_hits AS (
  SELECT l_partkey AS seq_id, CASE l_returnflag WHEN 'R' THEN 'T1' WHEN 'A' THEN 'T2' ELSE 'T3' END AS tier,
    CASE l_returnflag WHEN 'R' THEN 'pfam' WHEN 'A' THEN 'swissprot' ELSE 'nr' END AS source,
    CASE WHEN p_size % 5 = 0 THEN {_VAGUE}
         WHEN p_size % 5 = 1 THEN CASE WHEN l_linenumber % 2 = 0 THEN {_VAGUE} ELSE p_name || ' domain-containing protein' END
         ELSE CASE WHEN l_linenumber <= 3 THEN {_VAGUE} WHEN l_linenumber = 4 THEN p_name || ' domain-containing protein'
              ELSE p_name || ' ' || lower(p_type) || ' ' || l_returnflag END END AS label,
    CASE WHEN l_tax = 0.07 THEN 'NA' ELSE CAST(round(l_discount * 100) AS INTEGER) || 'e-6' END AS evalue,
    CASE WHEN NOT (l_linestatus = 'F' AND l_tax = 0.08) THEN CAST(floor(l_quantity) AS INTEGER) END AS start,
    CASE WHEN NOT (l_linestatus = 'F' AND l_tax = 0.08) THEN CAST(floor(l_quantity) AS INTEGER) + l_linenumber * 5 END AS "end",
    round(l_quantity / 50, 4) AS coverage, round(l_tax * 10, 4) AS target_coverage
  FROM lineitem JOIN part ON l_partkey = p_partkey),
 adm AS (
  SELECT *, CASE tier WHEN 'T1' THEN 0 WHEN 'T2' THEN 1 ELSE 2 END AS tier_idx,
    coalesce(TRY_CAST(evalue AS DOUBLE), 'inf'::DOUBLE) AS ev,
    (trim(label) <> '' AND NOT regexp_matches(label, '{UNINFORMATIVE_RE2}')) AS informative,
    (start IS NOT NULL AND "end" IS NOT NULL) AS spanned
  FROM raw_hits WHERE tier = 'T1' OR TRY_CAST(evalue AS DOUBLE) <= CASE tier WHEN 'T2' THEN 5e-6 ELSE 8e-6 END),
 lens AS (SELECT p_partkey AS seq_id, p_size + 85 AS qlen FROM part)"""

#: Merged coverage per entity and kind of hit.
COVER = """, merged AS (
  SELECT seq_id, informative, sum(greatest(0, "end" - greatest(start, coalesce(prev, 0) + 1) + 1)) AS covered
  FROM (SELECT *, max("end") OVER (PARTITION BY seq_id, informative ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
        FROM adm WHERE spanned) GROUP BY ALL),
 cov AS (
  SELECT lens.seq_id, qlen, coalesce(round(a.covered / qlen, 4), 0.0) AS explained_fraction,
         coalesce(round(b.covered / qlen, 4), 0.0) AS dark_covered_fraction
  FROM lens LEFT JOIN merged a ON a.seq_id = lens.seq_id AND a.informative
            LEFT JOIN merged b ON b.seq_id = lens.seq_id AND NOT b.informative)"""

#: The classification of every entity, as relation ``annotation``.
CLASSIFY = HITS + COVER + r""",
 ranked AS (
  SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY NOT informative, tier_idx, ev, label, coverage, target_coverage, evalue) AS r1,
    row_number() OVER (PARTITION BY seq_id ORDER BY NOT informative, CASE WHEN informative THEN ev ELSE tier_idx END,
                       CASE WHEN informative THEN tier_idx ELSE ev END, label, coverage, target_coverage, evalue) AS r2 FROM adm),
 s AS (
  SELECT seq_id, max(CASE WHEN r1 = 1 THEN tier END) AS annot_tier, max(CASE WHEN r1 = 1 THEN label END) AS annot_label,
    max(CASE WHEN r1 = 1 THEN coverage END) AS annot_qcov, max(CASE WHEN r1 = 1 THEN target_coverage END) AS annot_tcov,
    max(CASE WHEN r1 = 1 THEN evalue END) AS annot_evalue, max(CASE WHEN r2 = 1 THEN label END) AS best_evalue_label,
    max(CASE WHEN r2 = 1 THEN tier END) AS best_evalue_tier, coalesce(min(tier_idx) FILTER (informative), min(tier_idx)) + 1 AS homology_depth,
    count(*) FILTER (informative) AS n_inf, count(*) FILTER (NOT informative) AS n_un,
    coalesce(bool_and(regexp_matches(label, '(?i)domain[- ]containing protein|\bfamily protein\b')) FILTER (informative), false) AS dom,
    bool_or(informative AND NOT spanned) AS fam, bool_or(NOT informative AND spanned) AS dspan,
    count(DISTINCT tier_idx) FILTER (NOT informative) AS n_dark_databases,
    min(CASE WHEN regexp_matches(label, '(?i)(^|[^a-z])(DUF|UPF)[0-9]*($|[^a-z])') THEN 0
             WHEN regexp_matches(label, '(?i)\bconserved\b') THEN 1 ELSE 2 END) FILTER (NOT informative) AS rung
  FROM ranked GROUP BY seq_id),
 annotation AS (
  SELECT cov.seq_id, 'self' AS annot_source, annot_tier, annot_label,
    CASE WHEN s.seq_id IS NULL THEN 'NONE' WHEN n_inf = 0 THEN 'UNCHARACTERIZED_HOMOLOG'
         WHEN (explained_fraction >= 0.5 OR fam) AND NOT dom THEN 'FUNCTIONAL' ELSE 'DOMAIN_ONLY' END AS functional_class,
    homology_depth, annot_qcov, annot_tcov, annot_evalue, coalesce(n_inf, 0) AS n_informative_hits, best_evalue_label, best_evalue_tier,
    CAST(coalesce(dom, false) AS INTEGER) AS named_by_domain_only, explained_fraction,
    CASE WHEN coalesce(fam, false) AND explained_fraction = 0 THEN 'NOT_MEASURED' WHEN explained_fraction >= 0.8 THEN 'FULL'
         WHEN explained_fraction >= 0.5 THEN 'PARTIAL' WHEN explained_fraction > 0 THEN 'FRAGMENT' ELSE 'NONE' END AS annot_completeness,
    dark_covered_fraction,
    CASE WHEN NOT (coalesce(dspan, false) OR coalesce(n_un, 0) = 0) THEN 'NOT_MEASURED' WHEN dark_covered_fraction >= 0.8 THEN 'FULL'
         WHEN dark_covered_fraction >= 0.5 THEN 'PARTIAL' WHEN dark_covered_fraction > 0 THEN 'FRAGMENT' ELSE 'NONE' END AS dark_completeness,
    CASE rung WHEN 0 THEN 'CURATED_FAMILY' WHEN 1 THEN 'CONSERVED' WHEN 2 THEN 'PREDICTED_ONLY' ELSE 'NONE' END AS dark_evidence,
    coalesce(n_dark_databases, 0) AS n_dark_databases, 0.5 AS thr_min_coverage, 0.7 AS thr_narrow_at, 0.8 AS thr_full_at, 0.5 AS thr_partial_at
  FROM cov LEFT JOIN s ON s.seq_id = cov.seq_id)"""
