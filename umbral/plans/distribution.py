"""Queries over families, their distribution over lineages, pairs, curves and distribution tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from umbral.operators import curves as U
from umbral.operators import families as M
from umbral.operators import pairs as P
from umbral.plans.bindings import OCC, occ
from umbral.plans.catalog import Tables, query
from umbral.specs import PairSpec, RaritySpec

# Two resolutions; a cluster's representative is its smallest entity.
_MEM = """mem AS (
  SELECT DISTINCT seq_id, 'intermediate' AS resolution, min(seq_id) OVER (PARTITION BY family_id) AS representative FROM occ
  UNION ALL SELECT DISTINCT seq_id, 'close', min(seq_id) OVER (PARTITION BY close_id) FROM occ),
 cls AS (SELECT DISTINCT seq_id, CASE WHEN k % 7 = 0 THEN 'NOT_SEARCHED' ELSE functional_class END AS functional_class, k % 7 <> 0 AND k % 3 <> 0 AND t <> 4 AS dark FROM occ),
 reach AS (SELECT seq_id, count(*) AS n_copies, bool_or(small) AS on_small, bool_or(NOT small) AS on_large FROM occ GROUP BY 1)"""


def members(t: Tables):
    return t.once("members", lambda: _members(t))


def _members(t: Tables):
    o = occ(t).select("seq_id", "family_id", "close_id").distinct()
    rep = lambda c, name: o.join(o.groupBy(c).agg(F.min("seq_id").alias("representative")), c).select(
        "seq_id", F.lit(name).alias("resolution"), "representative")
    return rep("family_id", "intermediate").unionByName(rep("close_id", "close"))


def classes(t: Tables):
    return t.once("classes", lambda: _classes(t))


def _classes(t: Tables):
    k = F.col("k")
    return occ(t).select("seq_id", F.when(k % 7 == 0, "NOT_SEARCHED").otherwise(F.col("functional_class")).alias("functional_class"),
                         ((k % 7 != 0) & (k % 3 != 0) & (F.col("t") != 4)).alias("dark")).distinct()


def reach(t: Tables):
    return t.once("reach", lambda: M.entity_reach(occ(t), F.col("small")))


def families(t: Tables):
    c = classes(t)
    return M.protein_families(members(t), reach(t), c.select("seq_id", "functional_class"), c.filter("dark"))


_FAM = f"""{OCC}, {_MEM}, fam AS (
  SELECT resolution || ':' || representative AS family_id, resolution AS family_resolution, representative, family_size, n_orfs, dark_member_count, annotated_member_count,
    family_size - dark_member_count - annotated_member_count - n_not_searched AS n_unnamed_excluded, round(100.0 * dark_member_count / family_size, 2) AS percentage_dark_in_family,
    CASE WHEN family_size = 1 THEN 'ORPHAN' ELSE 'FAMILY' END AS family_class, CAST(annotated_member_count = 0 AND dark_member_count > 0 AS INTEGER) AS dark_only,
    n_small_members, n_large_members, n_small_dark, n_not_searched,
    CASE WHEN n_large_members > 0 THEN 'mixed' ELSE 'small_only' END || CASE WHEN annotated_member_count > 0 THEN '_known' ELSE '_unknown' END AS scope,
    CASE WHEN ns > 0 AND nl > 0 THEN 'both' WHEN ns > 0 THEN 'small' WHEN nl > 0 THEN 'large' ELSE '' END AS known_from
  FROM (SELECT resolution, representative, count(*) AS family_size, CAST(sum(n_copies) AS BIGINT) AS n_orfs, count(*) FILTER (dark) AS dark_member_count,
      count(*) FILTER (functional_class = 'FUNCTIONAL') AS annotated_member_count, count(*) FILTER (functional_class = 'NOT_SEARCHED') AS n_not_searched,
      count(*) FILTER (on_small) AS n_small_members, count(*) FILTER (on_large) AS n_large_members, count(*) FILTER (on_small AND dark) AS n_small_dark,
      count(*) FILTER (on_small AND functional_class = 'FUNCTIONAL') AS ns, count(*) FILTER (on_large AND functional_class = 'FUNCTIONAL') AS nl
    FROM mem JOIN cls USING (seq_id) JOIN reach USING (seq_id) GROUP BY 1, 2) WHERE n_small_members > 0)"""


@query("protein_families", f"WITH {_FAM} SELECT * FROM fam")
def protein_families(t: Tables):
    return families(t)


_DARK = f"""{_FAM}, darkfam AS (
  SELECT f.* EXCLUDE (representative), CASE WHEN s.self THEN f.representative ELSE s.first END AS representative, w.n_plasmids, w.n_mob_clusters FROM fam f
  JOIN (SELECT representative, bool_or(seq_id = representative) AS self, min(seq_id) AS first FROM mem JOIN cls USING (seq_id) JOIN reach USING (seq_id)
    WHERE resolution = 'intermediate' AND dark AND on_small GROUP BY 1) s USING (representative)
  JOIN (SELECT representative, count(DISTINCT plasmid_id) AS n_plasmids, count(DISTINCT mob_cluster) AS n_mob_clusters FROM mem JOIN occ USING (seq_id)
    WHERE resolution = 'intermediate' GROUP BY 1) w ON w.representative = f.representative
  WHERE family_resolution = 'intermediate' AND n_small_dark > 0)"""


def dark(t: Tables):
    o, c = occ(t), classes(t)
    return M.dark_families(t.once("families", lambda: families(t)), members(t), reach(t), c.filter("dark"), o.select("seq_id", "plasmid_id"),
                           o.select("plasmid_id", "mob_cluster").distinct(), "intermediate")


@query("dark_families", f"WITH {_DARK} SELECT * FROM darkfam")
def dark_families(t: Tables):
    return dark(t)


@query("dark_members", f"""WITH {_DARK} SELECT darkfam.family_id, mem.seq_id, CAST(on_small AS INTEGER) AS on_small FROM darkfam JOIN mem ON darkfam.family_id = 'intermediate:' || mem.representative AND mem.resolution = 'intermediate'
  JOIN cls USING (seq_id) JOIN reach USING (seq_id) WHERE dark""")
def dark_members(t: Tables):
    return M.dark_members(dark(t), members(t), reach(t), classes(t).filter("dark"), "intermediate")


# Records are users; nations give hosts (a region is a genus), part of them unnamed.
_REG = """reg AS (
  SELECT DISTINCT plasmid_id, CASE WHEN plasmid_id % 4 <> 3 AND c_nationkey % 5 <> 4 THEN n_name END AS species, CASE WHEN plasmid_id % 4 <> 3 THEN r_name END AS genus,
    CASE WHEN c_nationkey % 3 = 0 THEN r_name || ',' || c_mktsegment END AS predicted_host_range, mob_cluster, c_mktsegment AS hab_top,
    CASE WHEN plasmid_id % 2 = 0 THEN 'A;B, ' || r_name ELSE 'A' END AS sources
  FROM occ JOIN customer ON c_custkey = plasmid_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def registry(t: Tables):
    return t.once("registry", lambda: _registry(t))


def _registry(t: Tables):
    u = F.col("plasmid_id")
    return (occ(t).select("plasmid_id", "mob_cluster").distinct().join(t.customer, u == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("plasmid_id", F.when((u % 4 != 3) & (F.col("c_nationkey") % 5 != 4), F.col("n_name")).alias("species"),
                    F.when(u % 4 != 3, F.col("r_name")).alias("genus"),
                    F.when(F.col("c_nationkey") % 3 == 0, F.concat_ws(",", "r_name", "c_mktsegment")).alias("predicted_host_range"),
                    "mob_cluster", F.col("c_mktsegment").alias("hab_top"),
                    F.when(u % 2 == 0, F.concat(F.lit("A;B, "), "r_name")).otherwise("A").alias("sources")))


def _fam_members(t: Tables):
    return members(t).select(F.concat_ws(":", "resolution", F.col("representative").cast("string")).alias("family_id"), "seq_id")


def recurrence_(t: Tables):
    o, r = occ(t), registry(t)
    src = r.select("plasmid_id", F.explode(F.filter(F.transform(F.split("sources", "[,;]"), F.trim), lambda s: s != "")).alias("source"))
    return M.recurrence(_fam_members(t), o.select("seq_id", "plasmid_id"), r.drop("sources"), o.select("plasmid_id", "lineage").distinct(), src)


_REC = f"""{OCC}, {_MEM}, {_REG}, fm AS (SELECT resolution || ':' || representative AS family_id, seq_id FROM mem),
 fr AS (SELECT fm.family_id, plasmid_id, any_value(lineage) AS lineage, count(*) AS n_copies FROM fm JOIN occ USING (seq_id) GROUP BY 1, 2),
 rec AS (SELECT a.*, coalesce(b.database_source_count, 0) AS database_source_count FROM (
   SELECT family_id, CAST(sum(n_copies) AS BIGINT) AS plasmid_occurrence_count, count(*) AS unique_plasmid_count, count(DISTINCT lineage) AS independent_plasmid_cluster_count,
     count(DISTINCT species) AS host_count, count(DISTINCT genus) AS genus_count, count(genus) AS n_plasmids_with_host, count(species) AS n_plasmids_with_species,
     count(predicted_host_range) AS n_plasmids_with_predicted_range, count(DISTINCT predicted_host_range) AS predicted_host_range_count,
     coalesce(string_agg(DISTINCT predicted_host_range, ';' ORDER BY predicted_host_range), '') AS predicted_host_ranges, count(DISTINCT mob_cluster) AS "MOB_count",
     count(DISTINCT hab_top) AS habitat_count, CASE WHEN count(lineage) > 0 THEN 'SUCCESS' ELSE 'NOT_RUN' END AS independent_cluster_status,
     CASE WHEN count(genus) > 0 THEN 'SUCCESS' ELSE 'NOT_MEASURED' END AS host_count_status
   FROM fr LEFT JOIN reg USING (plasmid_id) GROUP BY 1) a
  LEFT JOIN (SELECT family_id, count(DISTINCT trim(s)) AS database_source_count FROM fr JOIN (SELECT plasmid_id, unnest(regexp_split_to_array(sources, '[,;]')) AS s FROM reg) USING (plasmid_id)
    WHERE trim(s) <> '' GROUP BY 1) b USING (family_id))"""


@query("recurrence", f"WITH {_REC} SELECT * FROM rec")
def recurrence(t: Tables):
    return recurrence_(t)


@query("redundancy_ratio", f"""WITH {_REC} SELECT family_id, round(unique_plasmid_count / independent_plasmid_cluster_count, 4) AS ratio FROM rec
ORDER BY unique_plasmid_count / independent_plasmid_cluster_count DESC, family_id LIMIT 1""")
def redundancy_ratio(t: Tables):
    return M.redundancy_ratio(recurrence_(t))


_RAR = f"""{_REC}, rr AS (SELECT *, split_part(family_id, ':', 1) AS family_resolution FROM rec),
 thr AS (SELECT family_resolution, quantile_disc(independent_plasmid_cluster_count, 0.8) AS threshold FROM rr WHERE independent_plasmid_cluster_count > 0 GROUP BY 1),
 rar AS (SELECT family_id, family_resolution, concat_ws(',', CASE WHEN l > 0 AND l <= 2 THEN 'RARE' END, CASE WHEN l = 1 THEN 'LINEAGE_SPECIFIC' END,
   CASE WHEN l > 0 AND l >= threshold THEN 'WIDESPREAD' END, CASE WHEN "MOB_count" = 1 THEN 'SINGLE_MOB' END, CASE WHEN "MOB_count" >= 2 THEN 'CROSS_MOB' END,
   CASE WHEN host_count = 1 AND n_plasmids_with_species = unique_plasmid_count THEN 'SINGLE_HOST' END, CASE WHEN host_count >= 2 THEN 'CROSS_HOST' END,
   CASE WHEN genus_count >= 2 THEN 'CROSS_TAXON' END) AS rarity_labels, l AS independent_plasmid_cluster_count, unique_plasmid_count, "MOB_count", host_count, genus_count,
   n_plasmids_with_species, 2 AS rare_max_lineages, 80 AS widespread_percentile, threshold AS widespread_min_lineages
  FROM (SELECT *, independent_plasmid_cluster_count AS l FROM rr) JOIN thr USING (family_resolution))"""


def rarity_(t: Tables, rec=None):
    rec = (recurrence_(t) if rec is None else rec).withColumn("family_resolution", F.substring_index("family_id", ":", 1))
    return M.rarity(rec, RaritySpec(widespread_percentile=80))


@query("rarity", f"WITH {_RAR} SELECT * FROM rar")
def rarity(t: Tables):
    return rarity_(t)


@query("rarity_counts", f"""WITH {_RAR} SELECT label, count(*) AS n FROM (SELECT unnest(string_split(CASE WHEN rarity_labels = '' THEN '(none)' ELSE rarity_labels END, ',')) AS label FROM rar) GROUP BY 1""")
def rarity_counts(t: Tables):
    return M.rarity_counts(rarity_(t))


# ---- pairs --------------------------------------------------------------------------------

_PAIR = f"""{OCC}, pres AS (SELECT DISTINCT lineage, plasmid_id, seq_id FROM occ WHERE dark),
 lcnt AS (SELECT seq_id, count(DISTINCT lineage) AS n FROM pres GROUP BY 1), el AS (SELECT * FROM pres WHERE seq_id IN (SELECT seq_id FROM lcnt WHERE n >= 2)),
 tog AS (SELECT a, b, count(*) AS k FROM (SELECT DISTINCT x.lineage, x.seq_id AS a, y.seq_id AS b FROM el x JOIN el y ON x.plasmid_id = y.plasmid_id AND x.seq_id < y.seq_id) GROUP BY 1, 2),
 tot AS (SELECT count(DISTINCT lineage) AS N FROM occ),
 tri AS (SELECT DISTINCT k, least(ca.n, cb.n) AS lo_, greatest(ca.n, cb.n) AS hi_, tot.N FROM tog JOIN lcnt ca ON ca.seq_id = a JOIN lcnt cb ON cb.seq_id = b, tot),
 pt AS (SELECT k, lo_, hi_, any_value(N) AS N, least(1.0, sum(exp(lgamma(lo_ + 1) - lgamma(i + 1) - lgamma(lo_ - i + 1) + lgamma(N - lo_ + 1) - lgamma(hi_ - i + 1) - lgamma(N - lo_ - hi_ + i + 1)
     - lgamma(N + 1) + lgamma(hi_ + 1) + lgamma(N - hi_ + 1)))) AS p
   FROM (SELECT tri.*, unnest(range(greatest(k, lo_ + hi_ - N), lo_ + 1)) AS i FROM tri) GROUP BY k, lo_, hi_),
 prs AS (SELECT a AS seq_a, b AS seq_b, ca.n AS n_lineages_a, cb.n AS n_lineages_b, k AS n_lineages_together, pt.N AS n_lineages_total, pt.p
   FROM tog JOIN lcnt ca ON ca.seq_id = a JOIN lcnt cb ON cb.seq_id = b JOIN pt USING (k) WHERE pt.lo_ = least(ca.n, cb.n) AND pt.hi_ = greatest(ca.n, cb.n)),
 rk AS (SELECT *, p * (SELECT count(*) FROM prs) / count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS raw FROM (SELECT * REPLACE (CAST(printf('%.12e', p) AS DOUBLE) AS p) FROM prs)),
 qv AS (SELECT *, least(1.0, min(raw) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS q FROM rk),
 cooc AS (SELECT seq_a, seq_b, n_lineages_a, n_lineages_b, n_lineages_together, n_lineages_total, round(n_lineages_together / n_lineages_a, 4) AS fraction_of_a,
   round(n_lineages_together / n_lineages_b, 4) AS fraction_of_b, round(n_lineages_a * n_lineages_b / n_lineages_total, 4) AS expected_together,
   p AS p_value, q AS q_value FROM qv WHERE n_lineages_together >= 2)"""


def pairs_(t: Tables):
    o = occ(t)
    return P.cooccurrence(o.filter("dark").select("plasmid_id", "seq_id"), o.select("plasmid_id", "lineage").distinct(), PairSpec())


@query("cooccurrence", f"WITH {_PAIR} SELECT * REPLACE (round(p_value, 7) AS p_value, round(q_value, 6) AS q_value) FROM cooc")
def cooccurrence(t: Tables):
    return pairs_(t).withColumns({"p_value": F.round("p_value", 7), "q_value": F.round("q_value", 6)})


@query("partners", f"""WITH {_PAIR}, bi AS (SELECT seq_a AS seq_id, seq_b AS partner, fraction_of_a AS fraction, p_value, q_value, n_lineages_together FROM cooc
  UNION ALL SELECT seq_b, seq_a, fraction_of_b, p_value, q_value, n_lineages_together FROM cooc),
 fb AS (SELECT f.family_id, bi.* REPLACE (round(q_value, 9) AS q_value, round(p_value, 9) AS p_value) FROM bi JOIN (SELECT DISTINCT seq_id, family_id FROM occ) f USING (seq_id))
SELECT family_id, count(DISTINCT CASE WHEN q_value <= 0.2 THEN partner END) AS n_cooccurring_partners, arg_min(partner, (q_value, p_value, -n_lineages_together, partner, -fraction)) AS top_cooccurring_partner,
  round(min(q_value), 6) AS top_cooccurring_partner_q, arg_min(fraction, (q_value, p_value, -n_lineages_together, partner, -fraction)) AS top_cooccurring_partner_fraction FROM fb GROUP BY 1""")
def partners(t: Tables):
    # Both engines compare p and q at nine decimals, so that the last digits of a tail cannot pick the partner.
    pr = pairs_(t).withColumns({"p_value": F.round("p_value", 9), "q_value": F.round("q_value", 9)})
    out = P.family_partners(pr, occ(t).select("seq_id", "family_id").distinct(), 0.2)
    return out.withColumn("top_cooccurring_partner_q", F.round("top_cooccurring_partner_q", 6))


@query("eligible_entities", f"WITH {_PAIR} SELECT seq_id, n AS n_lin FROM lcnt WHERE n >= 2")
def eligible_entities(t: Tables):
    o = occ(t)
    pres = P.presence(o.filter("dark"), o.select("plasmid_id", "lineage").distinct())
    counts, el = P.eligible_presence(pres.select("plasmid_id", "seq_id", "lineage"), 2)
    return counts.join(el.select("seq_id").distinct(), "seq_id")


# ---- curves -------------------------------------------------------------------------------

_CURVE = f"""{OCC}, axis AS (SELECT DISTINCT lineage FROM occ WHERE small), found AS (SELECT DISTINCT lineage, seq_id AS family_id FROM occ WHERE small AND dark),
 sizes AS (SELECT DISTINCT CAST(floor(N * i / 10) AS BIGINT) AS s, N FROM (SELECT count(*) AS N FROM axis), range(1, 11) r(i)),
 hist AS (SELECT f, count(*) AS m FROM (SELECT family_id, count(*) AS f FROM found GROUP BY 1) GROUP BY 1),
 curve AS (SELECT s AS n_lineages, round(sum(m * (1 - CASE WHEN N - f < s THEN 0 ELSE exp(lgamma(N - f + 1) - lgamma(N - f - s + 1) - lgamma(N + 1) + lgamma(N - s + 1)) END)), 4) AS mean_families
   FROM sizes, hist WHERE s > 0 GROUP BY 1)"""


def _axis_found(t: Tables):
    o = occ(t).filter("small")
    return o.select("lineage").distinct(), o.filter("dark").select("lineage", F.col("seq_id").alias("family_id")).distinct()


@query("rarefaction_expected", f"WITH {_CURVE} SELECT * FROM curve")
def rarefaction_expected(t: Tables):
    return U.rarefaction_expected(*_axis_found(t))


@query("saturation", f"""WITH {_CURVE}, p AS (SELECT *, row_number() OVER (ORDER BY n_lineages) AS i, count(*) OVER () AS c,
   (lead(mean_families) OVER (ORDER BY n_lineages) - mean_families) / (lead(n_lineages) OVER (ORDER BY n_lineages) - n_lineages) AS slope FROM curve)
SELECT CASE WHEN max(c) >= 3 AND max(CASE WHEN i = 1 THEN slope END) > 0 THEN round(max(CASE WHEN i = c - 1 THEN slope END) / max(CASE WHEN i = 1 THEN slope END), 4) END AS saturation FROM p""")
def saturation(t: Tables):
    return U.saturation(U.rarefaction_expected(*_axis_found(t)))


@query("rarefaction_ranked", f"""WITH {_CURVE}, rk AS (SELECT replicate, lineage, row_number() OVER (PARTITION BY replicate ORDER BY md5(replicate || ':' || lineage), lineage) AS r FROM axis, range(1, 21) x(replicate)),
 seen AS (SELECT replicate, family_id, min(r) AS first FROM found JOIN rk USING (lineage) GROUP BY 1, 2),
 k AS (SELECT n_lineages, replicate, count(first) AS k FROM (SELECT s AS n_lineages, replicate FROM sizes, range(1, 21) x(replicate) WHERE s > 0) LEFT JOIN seen USING (replicate) WHERE first IS NULL OR first <= n_lineages GROUP BY 1, 2)
SELECT n_lineages, round(avg(k), 2) AS mean_families, min(k) AS min_families, max(k) AS max_families, 20 AS n_replicates FROM k GROUP BY 1""")
def rarefaction_ranked(t: Tables):
    key = lambda l, r: F.md5(F.concat_ws(":", r.cast("string"), l.cast("string")))
    return U.rarefaction_sampled(*_axis_found(t), order=key)


@query("stratified_sample", """SELECT c_custkey, c_mktsegment, c_nationkey, turn FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY md5('7:' || c_custkey), c_custkey) AS turn FROM customer)
ORDER BY turn, c_mktsegment, c_nationkey LIMIT 100""")
def stratified_sample(t: Tables):
    key = F.md5(F.concat(F.lit("7:"), F.col("c_custkey").cast("string")))
    return U.stratified_sample(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey"), ["c_mktsegment", "c_nationkey"], 100, [key, F.col("c_custkey")])


# ---- distribution tables ------------------------------------------------------------------

@query("family_size_histogram", f"WITH {_FAM} SELECT family_resolution, family_size, count(*) AS n_families FROM fam GROUP BY ALL")
def family_size_histogram(t: Tables):
    return U.size_histogram(families(t))


@query("dark_fraction_histogram", f"WITH {_DARK} SELECT CAST(least(19, floor(percentage_dark_in_family / 5.0)) AS INTEGER) AS bin, count(*) AS n_families FROM darkfam WHERE family_size >= 2 GROUP BY 1")
def dark_fraction_histogram(t: Tables):
    return U.fraction_histogram(dark(t))


@query("family_class_counts", f"WITH {_DARK} SELECT family_class, CASE dark_only WHEN 1 THEN 'dark-only' ELSE 'mixed' END AS darkness, count(*) AS n_families FROM darkfam GROUP BY ALL")
def family_class_counts(t: Tables):
    return U.class_counts(dark(t))


@query("length_histogram", """WITH m AS (SELECT max(n_chars) AS top FROM documents)
SELECT lang, CAST(least(39, floor(round(ln(n_chars / 20.0) / ln(top / 20.0) * 40, 9))) AS INTEGER) AS bin, count(*) AS n FROM documents, m WHERE n_chars >= 20 GROUP BY 1, 2""")
def length_histogram(t: Tables):
    return U.log_length_histogram(t.documents, "lang", "n_chars")


@query("length_medians", """SELECT lang, n_chars AS median, n FROM (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE i = n // 2""")
def length_medians(t: Tables):
    return U.upper_median(t.documents, "lang", "n_chars")


@query("class_crosstab", """SELECT coalesce(CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, 'NOT_IN_PS') AS ps_class, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en,
  count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def class_crosstab(t: Tables):
    d = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").withColumn(
        "ps_class", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor"))
    return U.crosstab(d, "ps_class", "lang", ["de", "en", "es", "fr"])
