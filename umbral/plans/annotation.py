"""Queries over the annotation cascade: order lines as hits, parts as entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from umbral import checks
from umbral.functions.predicates import is_informative, soft_masked_fraction
from umbral.operators import classify as C
from umbral.operators import coverage as V
from umbral.operators import dedup as D
from umbral.plans.bindings import CLASSIFY, HITS, THR, TIE, TIERS, hits, lengths
from umbral.plans.catalog import ORACLES, Tables, query

# ---- exact identity -----------------------------------------------------------------------


@query("dereplicate_exact", """
SELECT substr(sha256(rtrim(text, '*')), 1, 32) AS seq_id, min(text) AS seq, count(*) AS n_items, min(doc_id) AS first_item
FROM documents GROUP BY 1""")
def dereplicate_exact(t: Tables):
    return D.dereplicate(t.documents, "text", "doc_id")


@query("entity_map", "SELECT substr(sha256(rtrim(text, '*')), 1, 32) AS seq_id, doc_id, lang FROM documents")
def entity_map(t: Tables):
    return D.entity_map(t.documents, "text", ["doc_id", "lang"])


@query("identity_join", """
SELECT substr(sha256(rtrim(text, '*')), 1, 32) AS seq_id, conv_id, turn FROM conversations
WHERE substr(sha256(rtrim(text, '*')), 1, 32) IN (SELECT substr(sha256(rtrim(text, '*')), 1, 32) FROM conversations WHERE role = 'user')""")
def identity_join(t: Tables):
    ours = t.conversations.filter("role = 'user'").select(D.sequence_id("text").alias("seq_id"))
    return D.identity_join(t.conversations.select("conv_id", "turn", "text"), ours, "text").select("seq_id", "conv_id", "turn")


# ---- transferred classes ------------------------------------------------------------------

_PS = r"""ps AS (
  SELECT p_partkey AS seq_id, l_orderkey, l_linenumber, l_suppkey, l_quantity,
    CASE WHEN l_linenumber = 1 THEN 'DUF' || p_size || ',' || p_name WHEN l_linenumber = 2 THEN 'DUF' || p_size ELSE '-' END AS pfams,
    CASE WHEN l_linenumber = 3 THEN 'K' || l_suppkey || ',K1' ELSE '-' END AS kegg_ko,
    CASE WHEN l_linenumber = 4 THEN '1.1.1.' || l_suppkey ELSE '-' END AS ec,
    CASE WHEN l_linenumber IN (2, 5) THEN 'COG' || l_suppkey ELSE '-' END AS cog_id
  FROM lineitem JOIN part ON l_partkey = p_partkey),
 psc AS (SELECT *, CASE WHEN len(list_filter(string_split(pfams, ','), lambda x: pfams <> '-' AND trim(x) <> '' AND NOT regexp_matches(x, '(?i)(^|[^a-z])(DUF|UPF)[0-9]*($|[^a-z])'))) > 0
      OR kegg_ko <> '-' OR ec <> '-' THEN 'ANNOTATED' WHEN pfams <> '-' OR cog_id <> '-' THEN 'UNKNOWN_ORTHOLOG' ELSE 'NONE' END AS ps_class FROM ps)"""


def _ps(t: Tables):
    from umbral.functions.text import transfer_class
    n, s = F.col("l_linenumber"), F.col("l_suppkey").cast("string")
    duf = F.concat(F.lit("DUF"), F.col("p_size").cast("string"))
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("seq_id"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
        F.when(n == 1, F.concat_ws(",", duf, "p_name")).when(n == 2, duf).otherwise("-").alias("pfams"),
        F.when(n == 3, F.concat(F.lit("K"), s, F.lit(",K1"))).otherwise("-").alias("kegg_ko"),
        F.when(n == 4, F.concat(F.lit("1.1.1."), s)).otherwise("-").alias("ec"),
        F.when(n.isin(2, 5), F.concat(F.lit("COG"), s)).otherwise("-").alias("cog_id"))
        .withColumn("ps_class", transfer_class("pfams", "cog_id", "kegg_ko", "ec")))


@query("transfer_class_counts", f"WITH {_PS} SELECT ps_class, count(*) AS n FROM psc GROUP BY 1")
def transfer_class_counts(t: Tables):
    return _ps(t).groupBy("ps_class").agg(F.count(F.lit(1)).alias("n"))


@query("best_class_reduce", f"""WITH {_PS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY CASE ps_class WHEN 'ANNOTATED' THEN 0 WHEN 'UNKNOWN_ORTHOLOG' THEN 1 ELSE 2 END,
    l_orderkey, l_linenumber, l_suppkey, l_quantity, pfams, kegg_ko, ec, cog_id) AS r, count(*) OVER (PARTITION BY seq_id) AS n_rows,
    max(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id) AS product_named FROM psc)
SELECT seq_id, ps_class, nullif(pfams, '-') AS pfams, nullif(kegg_ko, '-') AS kegg_ko, nullif(ec, '-') AS ec, nullif(cog_id, '-') AS cog_id, n_rows, product_named,
  coalesce(CASE WHEN pfams <> '-' THEN list_filter(string_split(pfams, ','), lambda x: NOT regexp_matches(x, '(?i)(^|[^a-z])(DUF|UPF)[0-9]*($|[^a-z])'))[1] END,
    CASE WHEN kegg_ko <> '-' THEN string_split(kegg_ko, ',')[1] END, CASE WHEN ec <> '-' THEN ec END, '') AS annot_label FROM r WHERE r = 1""")
def best_class_reduce(t: Tables):
    from umbral.functions.text import first_informative_label
    rows = _ps(t).withColumn("product_named", (F.col("l_quantity") > 49).cast("int"))
    f = ["pfams", "kegg_ko", "ec", "cog_id"]
    out = D.best_class_reduce(rows, "seq_id", "ps_class", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", *f], f, "product_named")
    out = out.withColumns({c: F.nullif(F.col(c), F.lit("-")) for c in f})
    return out.withColumn("annot_label", first_informative_label("pfams", "kegg_ko", "ec"))


# ---- coverage and classes -----------------------------------------------------------------

@query("interval_union", f"""WITH {HITS}, p AS (
  SELECT *, max("end") OVER (PARTITION BY seq_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM raw_hits WHERE start IS NOT NULL),
 m AS (SELECT seq_id, sum(greatest(0, "end" - greatest(start, coalesce(prev, 0) + 1) + 1)) AS covered FROM p GROUP BY 1)
SELECT lens.seq_id, qlen, CAST(coalesce(covered, 0) AS BIGINT) AS covered, coalesce(round(covered / qlen, 4), 0.0) AS covered_fraction
FROM lens LEFT JOIN m USING (seq_id)""")
def interval_union(t: Tables):
    return V.coverage(hits(t), lengths(t), "seq_id", "qlen")


@query("classify_entities", f"WITH {CLASSIFY} SELECT * FROM annotation")
def classify_entities(t: Tables):
    return C.classify(hits(t), lengths(t), TIERS, THR, tie=TIE)


@query("ordered_labels", f"""WITH {HITS}, f AS (
  SELECT seq_id, informative, label, tier, min((tier_idx, ev, label)) AS pos FROM adm GROUP BY ALL),
 l AS (SELECT seq_id, informative, label, min(pos) AS pos FROM f GROUP BY ALL), tt AS (SELECT seq_id, informative, tier, min(pos) AS pos FROM f GROUP BY ALL),
 lj AS (SELECT seq_id, coalesce(string_agg(label, ' | ' ORDER BY pos, label) FILTER (informative), '') AS informative_labels,
   coalesce(string_agg(label, ' | ' ORDER BY pos, label) FILTER (NOT informative), '') AS uninformative_labels FROM l GROUP BY 1),
 tj AS (SELECT seq_id, coalesce(string_agg(tier, ',' ORDER BY pos, tier) FILTER (informative), '') AS informative_tiers,
   coalesce(string_agg(tier, ',' ORDER BY pos, tier) FILTER (NOT informative), '') AS uninformative_tiers FROM tt GROUP BY 1)
SELECT * FROM lj JOIN tj USING (seq_id)""")
def ordered_labels(t: Tables):
    return C.ordered_distinct_concat(C.admit_hits(hits(t), TIERS))


_SEL = """sel AS (
  SELECT p_partkey AS seq_id, CASE WHEN p_size = 50 THEN 'artefact_antifam' WHEN p_brand = 'Brand#1' THEN 'plasmidscope'
    WHEN p_size > 45 THEN 'not_selected' WHEN p_partkey % 10 = 9 THEN 'member' ELSE 'representative' END AS role,
    CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END AS search_representative FROM part),
 sel2 AS (SELECT a.seq_id, CASE WHEN a.role = 'member' AND coalesce(b.role, '') <> 'representative' THEN 'not_selected' ELSE a.role END AS role, a.search_representative
   FROM sel a LEFT JOIN sel b ON b.seq_id = a.search_representative)"""


def _selection(t: Tables):
    k = F.col("p_partkey")
    s = t.part.select(k.alias("seq_id"), F.when(F.col("p_size") == 50, "artefact_antifam").when(F.col("p_brand") == "Brand#1", "plasmidscope")
                      .when(F.col("p_size") > 45, "not_selected").when(k % 10 == 9, "member").otherwise("representative").alias("role"),
                      F.when(k % 10 == 9, k - 1).otherwise(k).alias("search_representative"))
    r = s.select(F.col("seq_id").alias("search_representative"), F.col("role").alias("_r"))
    return s.join(r, "search_representative", "left").select("seq_id", F.when(
        (F.col("role") == "member") & (F.coalesce("_r", F.lit("")) != "representative"), "not_selected").otherwise(F.col("role")).alias("role"),
        "search_representative")


_THR_SQL = ", ".join(f"{getattr(THR, n)} AS thr_{n}" for n in ("min_coverage", "narrow_at", "full_at", "partial_at"))


@query("resolve_annotation", f"""WITH {CLASSIFY}, {_SEL}, lists AS ({ORACLES["ordered_labels"]}),
 own AS (SELECT a.*, lists.* EXCLUDE (seq_id) FROM annotation a JOIN sel2 ON sel2.seq_id = a.seq_id LEFT JOIN lists ON lists.seq_id = a.seq_id WHERE role = 'representative')
SELECT *, NULL::BIGINT AS annot_representative FROM own
UNION ALL BY NAME SELECT own.* REPLACE (sel2.seq_id AS seq_id, 'representative' AS annot_source), own.seq_id AS annot_representative FROM sel2 JOIN own ON own.seq_id = sel2.search_representative WHERE role = 'member'
UNION ALL BY NAME SELECT p_partkey AS seq_id, 'plasmidscope' AS annot_source, 'PS' AS annot_tier, p_name AS annot_label, 'FUNCTIONAL' AS functional_class, 1 AS n_informative_hits, p_name AS informative_labels,
  'PS' AS informative_tiers, 'NOT_MEASURED' AS annot_completeness, {_THR_SQL} FROM part WHERE p_brand = 'Brand#1' AND p_size <> 50
UNION ALL BY NAME SELECT seq_id, CASE role WHEN 'not_selected' THEN 'not_searched' ELSE role END AS annot_source, 'NOT_SEARCHED' AS functional_class, {_THR_SQL}
  FROM sel2 WHERE role IN ('not_selected', 'artefact_antifam')""")
def resolve_annotation(t: Tables):
    sel = _selection(t)
    found = hits(t)
    own = (C.classify(found, lengths(t), TIERS, THR, tie=TIE).join(C.ordered_distinct_concat(C.admit_hits(found, TIERS)), "seq_id", "left")
           .join(sel.filter("role = 'representative'").select("seq_id"), "seq_id", "left_semi"))
    ps = t.part.select(F.col("p_partkey").alias("seq_id"), F.when(F.col("p_brand") == "Brand#1", "ANNOTATED").otherwise("NONE").alias("transfer_class"),
                       F.col("p_name").alias("transfer_label"))
    out = C.resolve_annotation(own, sel, ps, THR)
    return out.withColumn("annot_representative", F.col("annot_representative").cast("bigint"))


@query("tier_residual", f"""WITH {HITS}, t1 AS (SELECT * FROM adm WHERE tier_idx = 0 AND informative AND spanned),
 m AS (SELECT seq_id, sum(greatest(0, "end" - greatest(start, coalesce(prev, 0) + 1) + 1)) AS covered FROM (
   SELECT *, max("end") OVER (PARTITION BY seq_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM t1) GROUP BY 1)
SELECT lens.seq_id, CAST(NOT EXISTS (SELECT 1 FROM adm a WHERE a.seq_id = lens.seq_id AND a.tier_idx = 0 AND a.informative AND a.source = 'pfam') AS INTEGER) AS searched_next
FROM lens LEFT JOIN m USING (seq_id) WHERE coalesce(round(covered / qlen, 4), 0) < 0.3""")
def tier_residual(t: Tables):
    adm = C.admit_hits(hits(t), TIERS[:1])
    cov = C.explained(adm, lengths(t))
    left = C.residual(lengths(t).select("seq_id"), cov, 0.3)
    free = C.skip_if_named_by(left, adm, TIERS[2].skip_if_named_by).withColumn("_f", F.lit(1))
    return left.join(free, "seq_id", "left").select("seq_id", F.coalesce("_f", F.lit(0)).alias("searched_next"))


_FAMSEL = """m AS (SELECT p_partkey AS seq_id, p_name AS family_id, p_size >= 40 AS skipped, p_size % 10 = 0 AS on_small, p_size = 50 AS antifam,
  p_size BETWEEN 45 AND 49 AS ps FROM part)"""


@query("open_families", f"""WITH {_FAMSEL} SELECT seq_id, family_id FROM m WHERE NOT skipped AND family_id IN (SELECT family_id FROM m WHERE NOT skipped AND on_small)""")
def open_families(t: Tables):
    return C.open_families(_members(t)).select("seq_id", "family_id")


def _members(t: Tables):
    s = F.col("p_size")
    return t.part.select(F.col("p_partkey").alias("seq_id"), F.col("p_name").alias("family_id"), (s >= 40).alias("skipped"),
                         (s % 10 == 0).alias("on_small"), (s == 50).alias("antifam"), s.between(45, 49).alias("ps"))


@query("selection_roles", f"""WITH {_FAMSEL}, o AS (SELECT seq_id, family_id, min(seq_id) OVER (PARTITION BY family_id) AS rep FROM m
  WHERE NOT skipped AND family_id IN (SELECT family_id FROM m WHERE NOT skipped AND on_small))
SELECT m.seq_id, o.rep AS search_representative, CASE WHEN antifam THEN 'artefact_antifam' WHEN ps THEN 'plasmidscope' WHEN o.rep = m.seq_id THEN 'representative'
  WHEN o.rep IS NOT NULL THEN 'member' ELSE 'not_selected' END AS role FROM m LEFT JOIN o USING (seq_id)""")
def selection_roles(t: Tables):
    m = _members(t)
    o = C.open_families(m)
    rep = o.groupBy("family_id").agg(F.min("seq_id").alias("search_representative"))
    o = o.select("seq_id", "family_id").join(rep, "family_id").select("seq_id", "search_representative")
    return m.join(o, "seq_id", "left").select("seq_id", "search_representative", C.assign_role(
        F.col("antifam"), F.col("ps"), F.col("search_representative"), F.col("seq_id")).alias("role"))


# ---- flags, eligibility, dark set ---------------------------------------------------------

_ART = f"""art AS (
  SELECT p_partkey AS seq_id, CAST(fam IS NOT NULL OR lc > 0.5 AS INTEGER) AS artefact_flag, fam AS antifam_family, ev AS antifam_ievalue, lc AS low_complexity_fraction,
    concat_ws(',', CASE WHEN fam IS NOT NULL THEN 'antifam' END, CASE WHEN lc > 0.5 THEN 'low_complexity' END) AS artefact_reason
  FROM (SELECT p_partkey, round(length(regexp_replace(p_name || p_type, '[^a-z]', '', 'g')) / length(p_name || p_type), 4) AS lc FROM part)
  LEFT JOIN (SELECT l_partkey, fam, ev FROM (SELECT l_partkey, 'AF' || l_suppkey AS fam, CAST(1 + round(l_tax * 100) AS INTEGER) || 'e-' || CAST(round(l_discount * 100) AS INTEGER) * l_linenumber AS ev FROM lineitem)
    WHERE CAST(ev AS DOUBLE) <= 5e-70 QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(ev AS DOUBLE), fam, ev) = 1) ON l_partkey = p_partkey)"""


def _artefacts(t: Tables):
    ent = t.part.select(F.col("p_partkey").alias("seq_id"), soft_masked_fraction(F.concat("p_name", "p_type")).alias("low_complexity_fraction"))
    power = F.round(F.col("l_discount") * 100).cast("int") * F.col("l_linenumber")
    fam = t.lineitem.select(
        F.col("l_partkey").alias("seq_id"), F.concat(F.lit("AF"), F.col("l_suppkey").cast("string")).alias("family"),
        F.concat((F.round(F.col("l_tax") * 100) + 1).cast("int").cast("string"), F.lit("e-"), power.cast("string")).alias("evalue"))
    return C.artefact_flags(ent, fam, max_evalue=5e-70)


@query("artefact_flags", f"WITH {_ART} SELECT * FROM art")
def artefact_flags(t: Tables):
    return _artefacts(t)


_ELIG = f"""{CLASSIFY}, {_ART}, elig AS (
  SELECT a.seq_id, functional_class, coalesce(artefact_flag, 0) AS is_artefact, CAST(coalesce(artefact_flag, 0) = 0 AND functional_class IN ('UNCHARACTERIZED_HOMOLOG', 'NONE') AS INTEGER) AS target_eligible,
    concat_ws(',', CASE WHEN artefact_flag = 1 THEN 'artefact' END, CASE WHEN functional_class = 'NOT_SEARCHED' THEN 'not_searched'
      WHEN functional_class NOT IN ('UNCHARACTERIZED_HOMOLOG', 'NONE') THEN 'annotated' END) AS exclusion_reason
  FROM annotation a LEFT JOIN art USING (seq_id))"""


def _flags(t: Tables):
    return C.eligibility(C.classify(hits(t), lengths(t), TIERS, THR, tie=TIE), _artefacts(t))


@query("eligibility", f"WITH {_ELIG} SELECT * FROM elig")
def eligibility(t: Tables):
    return _flags(t)


@query("eligibility_summary", f"""WITH {_ELIG} SELECT count(*) AS n_entities, CAST(sum(is_artefact) AS BIGINT) AS n_artefact, CAST(sum(target_eligible) AS BIGINT) AS n_eligible,
  count(*) FILTER (target_eligible = 1 AND functional_class = 'NONE') AS n_no_homologue FROM elig""")
def eligibility_summary(t: Tables):
    return C.eligibility_summary(_flags(t))


@query("dark_set", f"""WITH {_ELIG} SELECT seq_id FROM elig WHERE target_eligible = 1 AND seq_id NOT IN (
  SELECT l_partkey FROM lineitem GROUP BY 1 HAVING bool_and(l_linestatus <> 'O' OR l_linenumber > 1))""")
def dark_set(t: Tables):
    items = t.lineitem.select(F.col("l_partkey").alias("seq_id"), ((F.col("l_linestatus") != "O") | (F.col("l_linenumber") > 1)).cast("int").alias("partial"))
    return C.dark_set(_flags(t), items)


# ---- arg-best -----------------------------------------------------------------------------

@query("best_hit", f"""WITH {HITS} SELECT seq_id, label, tier, evalue FROM raw_hits
QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY coalesce(TRY_CAST(evalue AS DOUBLE), 'inf'::DOUBLE), label, tier, evalue) = 1""")
def best_hit(t: Tables):
    return C.best_hit(hits(t), "seq_id", ["label", "tier"], ["label", "tier", "evalue"])


@query("expand_to_items", f"""WITH {CLASSIFY}, {_ART} SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l.l_partkey AS seq_id, functional_class, annot_label, artefact_flag
FROM lineitem l LEFT JOIN annotation a ON a.seq_id = l_partkey LEFT JOIN art ON art.seq_id = l_partkey""")
def expand_to_items(t: Tables):
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.col("l_partkey").alias("seq_id"))
    ann = C.classify(hits(t), lengths(t), TIERS, THR, tie=TIE).select("seq_id", "functional_class", "annot_label")
    return C.expand_to_items(items, ann, _artefacts(t).select("seq_id", "artefact_flag"))


@query("working_subset", f"""WITH {CLASSIFY} SELECT seq_id FROM annotation WHERE functional_class IN ('FUNCTIONAL', 'DOMAIN_ONLY')
  AND seq_id NOT IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#1')""")
def working_subset(t: Tables):
    ann = C.classify(hits(t), lengths(t), TIERS, THR, tie=TIE)
    named = ann.filter(F.col("functional_class").isin("FUNCTIONAL", "DOMAIN_ONLY"))
    return C.working_subset(ann.select("seq_id"), named, t.part.filter("p_brand = 'Brand#1'").select(F.col("p_partkey").alias("seq_id")))


@query("orthology_union", """
SELECT p.p_partkey AS seq_id, CASE WHEN p_brand = 'Brand#1' THEN p_type WHEN s.k IS NOT NULL THEN 'L' || s.k ELSE '' END AS cog_category,
  CASE WHEN p_brand = 'Brand#1' THEN 'plasmidscope' WHEN s.k IS NOT NULL THEN 'emapper' ELSE '' END AS orthology_source
FROM part p LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS k FROM lineitem GROUP BY 1) s ON s.l_partkey = p_partkey""")
def orthology_union(t: Tables):
    named = t.part.select(F.col("p_partkey").alias("seq_id"))
    transferred = t.part.filter("p_brand = 'Brand#1'").select(F.col("p_partkey").alias("seq_id"), F.col("p_type").alias("cog_category"))
    searched = t.lineitem.groupBy(F.col("l_partkey").alias("seq_id")).agg(
        F.concat(F.lit("L"), F.min("l_suppkey").cast("string")).alias("cog_category"))
    return C.orthology_union(named, transferred, searched, ["cog_category"])


@query("set_agreement", """SELECT count(*) FILTER (p_partkey IS NOT NULL AND k IS NOT NULL) AS n_both, count(*) FILTER (k IS NULL) AS n_left_only,
  count(*) FILTER (p_partkey IS NULL) AS n_right_only FROM part FULL OUTER JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem) ON k = p_partkey""")
def set_agreement(t: Tables):
    return checks.set_agreement(t.part.select(F.col("p_partkey").alias("k")), t.lineitem.select(F.col("l_partkey").alias("k")), "k")


@query("drift_check", """SELECT CAST(1000 AS DOUBLE) AS declared, count(*) AS actual, round(abs(1000 - count(*)) / count(*), 6) AS drift,
  CAST(abs(1000 - count(*)) / count(*) > 0.02 AS INTEGER) AS exceeds FROM documents""")
def drift_check(t: Tables):
    return checks.drift(t.documents, 1000)


@query("informative_labels", f"""WITH {HITS} SELECT label, informative, count(*) AS n FROM (SELECT label,
  (trim(label) <> '' AND NOT regexp_matches(label, '(?i)hypothetical|uncharacteri[sz]ed|(^|[^a-z])(DUF|UPF)[0-9]*($|[^a-z])|(^|:\\s*|Full=)(putative|predicted|conserved) protein\\s*($|;|\\[)')) AS informative
  FROM raw_hits) GROUP BY ALL""")
def informative_labels(t: Tables):
    return hits(t).groupBy("label", is_informative("label").alias("informative")).agg(F.count(F.lit(1)).alias("n"))
