"""Queries over graphs, hierarchies, record scope and label rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from umbral.operators import classify as C
from umbral.operators import curves as U
from umbral.operators import graph as G
from umbral.operators import labels as L
from umbral.operators import registry as R
from umbral.operators import similarity as Y
from umbral.plans.bindings import CLASSIFY, OCC, TASK_ROWS, THR, TIE, TIERS, hits, lengths, occ
from umbral.plans.catalog import Tables, query
from umbral.plans.ordered import _LABELS, entity_labels
from umbral.session import cut, spread
from umbral.sources import files as S
from umbral.specs import ClusterSpec, NetworkSpec, SketchSpec

# ---- components ---------------------------------------------------------------------------
# Orders and parts are nodes; an order line is a distance row between them.


def _distances(t: Tables):
    return t.lineitem.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("a"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("b"),
                             F.col("l_discount").alias("distance"), F.col("l_tax").alias("pvalue"))


_EDGE = """edge AS (SELECT DISTINCT 'o' || l_orderkey AS a, 'p' || l_partkey AS b FROM lineitem WHERE l_discount <= 0.05 AND l_tax <= 0.02),
 node AS (SELECT 'o' || o_orderkey AS id FROM orders UNION SELECT 'p' || p_partkey FROM part UNION SELECT a FROM edge UNION SELECT b FROM edge)"""


@query("edge_filter", "SELECT 'o' || l_orderkey AS a, 'p' || l_partkey AS b FROM lineitem WHERE l_discount <= 0.05 AND l_tax <= 0.02")
def edge_filter(t: Tables):
    return S.filter_edges(_distances(t), 0.05, 0.02)


def _graph(t: Tables):
    e = cut(S.filter_edges(_distances(t), 0.05, 0.02).distinct())
    n = (t.orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"))
         .unionByName(t.part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id")))
         .unionByName(e.select(F.col("a").alias("id"))).unionByName(e.select(F.col("b").alias("id"))))
    return n, e


@query("connected_components", f"""WITH RECURSIVE {_EDGE}, sym AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
 lab AS (SELECT 0 AS i, id, id AS c FROM node
   UNION ALL SELECT i + 1, id, min(c) FROM (SELECT i, id, c FROM lab UNION ALL SELECT lab.i, sym.b, lab.c FROM lab JOIN sym ON sym.a = lab.id) WHERE i < 60 GROUP BY i, id)
SELECT id, c AS component FROM lab WHERE i = 60""")
def connected_components(t: Tables):
    return G.connected_components(*_graph(t))


# ---- hierarchy ----------------------------------------------------------------------------
# Parts form a binary tree (parent = half the key); the target is part 3.

_TREE = """tree AS (SELECT p_partkey AS taxid, p_partkey // 2 AS parent FROM part)"""


def _tree(t: Tables):
    return t.part.select(F.col("p_partkey").alias("taxid"), F.floor(F.col("p_partkey") / F.lit(2)).cast("bigint").alias("parent"))


@query("taxonomy_closure", f"""WITH RECURSIVE {_TREE}, down AS (SELECT taxid FROM tree WHERE taxid = 3 UNION SELECT c.taxid FROM tree c JOIN down d ON c.parent = d.taxid WHERE c.taxid <> c.parent)
SELECT taxid, taxid IN (SELECT taxid FROM down) AS under FROM tree""")
def taxonomy_closure(t: Tables):
    return R.ancestor_closure(_tree(t), 3)


_NAMES = f"""{_TREE}, nm AS (SELECT p_partkey AS taxid, p_name || ' ' || p_brand AS name, CASE WHEN p_size % 2 = 0 THEN 'synonym' WHEN p_size % 3 = 0 THEN 'authority' ELSE 'scientific name' END AS cls FROM part),
 keys AS (SELECT DISTINCT taxid, unnest(CASE WHEN cls IN ('synonym', 'authority') THEN [name, string_split(name, ' ')[1], array_to_string(string_split(name, ' ')[1:2], ' ')] ELSE [name] END) AS name FROM nm),
 down AS (SELECT taxid FROM tree WHERE taxid = 3 UNION SELECT c.taxid FROM tree c JOIN down d ON c.parent = d.taxid WHERE c.taxid <> c.parent),
 euk AS (SELECT name FROM keys GROUP BY 1 HAVING bool_and(taxid IN (SELECT taxid FROM down)))"""


def _under(t: Tables):
    names = t.part.select(F.col("p_partkey").alias("taxid"), F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.when(F.col("p_size") % 2 == 0, "synonym")
                          .when(F.col("p_size") % 3 == 0, "authority").otherwise("scientific name").alias("name_class"))
    keys = R.name_keys(names)
    return R.names_under(keys.select("name"), keys, R.ancestor_closure(_tree(t), 3))


@query("names_under", f"WITH RECURSIVE {_NAMES} SELECT name FROM euk")
def names_under(t: Tables):
    return _under(t)


@query("exclude_by_ancestor", f"""WITH RECURSIVE {_NAMES} SELECT p_partkey FROM part WHERE (p_name || ' ' || p_brand) NOT IN (SELECT name FROM euk)""")
def exclude_by_ancestor(t: Tables):
    rec = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("host"))
    return R.exclude_by_ancestor(rec, _under(t))[0].select("p_partkey")


@query("excluded_per_host", f"""WITH RECURSIVE {_NAMES} SELECT p_name || ' ' || p_brand AS host, count(*) AS n_removed FROM part WHERE (p_name || ' ' || p_brand) IN (SELECT name FROM euk) GROUP BY 1""")
def excluded_per_host(t: Tables):
    rec = t.part.select(F.concat_ws(" ", "p_name", "p_brand").alias("host"))
    return R.exclude_by_ancestor(rec, _under(t))[1]


# ---- scope and registry -------------------------------------------------------------------

@query("scope_filter", """SELECT c_custkey, round(c_acctbal * 10) < 20000 AS small, c_nationkey % 4 IN (0, 1) AS circular FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def scope_filter(t: Tables):
    m = t.customer.select("c_custkey", F.col("c_mktsegment").alias("hab_top"), F.round(F.col("c_acctbal") * 10).alias("size_bp"),
                          F.get(F.array(F.lit(" Circular"), F.lit("direct terminal repeat"), F.lit("linear"), F.lit("inverted terminal repeat")),
                                F.col("c_nationkey") % 4).alias("topology"))
    return R.scope_filter(m, ["BUILDING"], 20_000).select("c_custkey", "small", "circular")


_HOSTS = ("Escherichia coli", "Klebsiella_pneumoniae", "uncultured bacterium", "Bacillus sp. X1", "Candidatus Liberibacter asiaticus", "Enterobacteriaceae bacterium",
          "NA", "[Clostridium] innocuum, Bacteroides fragilis", "unknown, Vibrio cholerae", "onion yellows phytoplasma", "Plautia stali symbiont", "Salmonella phage virus", "")
_HOST_SQL = "[" + ", ".join(f"'{h}'" for h in _HOSTS) + "]"
_NORM = """CASE {n} WHEN 0 THEN 'Escherichia coli|Escherichia' WHEN 1 THEN 'Klebsiella pneumoniae|Klebsiella' WHEN 3 THEN '|Bacillus' WHEN 4 THEN 'Candidatus Liberibacter asiaticus|Candidatus Liberibacter'
  WHEN 7 THEN '[Clostridium] innocuum|[Clostridium]' WHEN 8 THEN 'Vibrio cholerae|Vibrio' WHEN 9 THEN '|Candidatus Phytoplasma' ELSE '|' END"""


def _host(i):
    return F.get(F.array(*[F.lit(h) for h in _HOSTS]), (i % len(_HOSTS)).cast("int"))


@query("normalise_host", f"""SELECT c_custkey, split_part(v, '|', 1) AS species, split_part(v, '|', 2) AS genus FROM (SELECT c_custkey, {_NORM.format(n='c_custkey % 13')} AS v FROM customer)""")
def normalise_host(t: Tables):
    from umbral.functions.text import normalise_host as norm
    return t.customer.select("c_custkey", norm(_host(F.col("c_custkey"))).alias("h")).select("c_custkey", "h.*")


@query("record_registry", f"""WITH v AS (SELECT c_custkey, c_mktsegment, c_nationkey, {_NORM.format(n='c_custkey % 13')} AS a, {_NORM.format(n='c_nationkey % 13')} AS b,
   CASE WHEN c_mktsegment = 'MACHINERY' THEN '|' ELSE {_NORM.format(n='(c_custkey + 5) % 13')} END AS c FROM customer)
SELECT c_custkey AS plasmid_id, CASE WHEN c_nationkey <> 3 THEN 'm' || c_nationkey END AS mob_cluster,
  split_part(CASE WHEN split_part(a, '|', 2) <> '' THEN a WHEN split_part(b, '|', 2) <> '' THEN b ELSE c END, '|', 1) AS species,
  split_part(CASE WHEN split_part(a, '|', 2) <> '' THEN a WHEN split_part(b, '|', 2) <> '' THEN b ELSE c END, '|', 2) AS genus,
  CASE WHEN split_part(a, '|', 2) <> '' THEN 'plsdb' WHEN split_part(b, '|', 2) <> '' THEN 'plasmidscope' WHEN split_part(c, '|', 2) <> '' THEN 'organism' ELSE '' END AS host_source,
  CASE WHEN c_nationkey % 2 = 0 THEN 'phylum' END AS predicted_host_range, 'circular' AS topology, c_mktsegment AS hab_top FROM v""")
def record_registry(t: Tables):
    n = F.col("c_nationkey")
    m = t.customer.select(F.col("c_custkey").alias("plasmid_id"), F.when(n == 3, "NA").otherwise(F.concat(F.lit(" m"), n.cast("string"))).alias("mob_cluster"),
                          _host(F.col("c_custkey")).alias("plsdb_species"), F.when(n % 2 == 0, "phylum ").otherwise("").alias("mob_host_range"),
                          F.lit("circular").alias("topology"), F.col("c_mktsegment").alias("hab_top"))
    ps = t.customer.select(F.col("c_custkey").alias("plasmid_id"), _host(n).alias("host"))
    ws = t.customer.select(F.col("c_custkey").alias("plasmid_id"), _host(F.col("c_custkey") + 5).alias("organism"),
                           F.when(F.col("c_mktsegment") == "MACHINERY", "metagenomic").otherwise("isolate").alias("lifestyle"))
    return R.record_registry(m, ps, ws)


@query("record_class", """SELECT o_orderkey AS plasmid_id, coalesce(min_cls, 'pMOBless') AS class FROM orders LEFT JOIN (
  SELECT l_orderkey, CASE min(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END) WHEN 0 THEN 'pCONJ' WHEN 1 THEN 'pdCONJ' ELSE 'pMOB' END AS min_cls
  FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def record_class(t: Tables):
    r = F.col("l_returnflag")
    s = t.lineitem.select(F.col("l_orderkey").alias("plasmid_id"),
                                                   F.when(r == "A", "Plasmids/T4SS_typeF").when(r == "R", "dCONJ_typeG").otherwise("MOB").alias("system"))
    return R.record_class(t.orders.select(F.col("o_orderkey").alias("plasmid_id")), s)


@query("record_flag", """WITH v AS (SELECT l_orderkey, string_agg(DISTINCT l_orderkey || '|provirus_' || l_linenumber, ',' ORDER BY l_orderkey || '|provirus_' || l_linenumber) AS genomad_virus FROM lineitem GROUP BY 1),
 h AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_discount = 0.1 AND l_tax = 0.08 GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS plasmid_id, coalesce(genomad_virus, '') AS genomad_virus, coalesce(n, 0) AS n_virus_hallmarks, CAST(genomad_virus IS NOT NULL OR coalesce(n, 0) >= 1 AS INTEGER) AS phage_plasmid
FROM orders LEFT JOIN v ON v.l_orderkey = o_orderkey LEFT JOIN h ON h.l_orderkey = o_orderkey""")
def record_flag(t: Tables):
    o = F.col("l_orderkey").cast("string")
    calls = S.virus_calls(t.lineitem.select(F.concat(o, F.lit("|provirus_"), F.col("l_linenumber").cast("string")).alias("seq_name")))
    genes = t.lineitem.select(F.concat_ws("_", o, F.col("l_linenumber").cast("string")).alias("gene"),
                              ((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)).cast("int").alias("virus_hallmark"))
    return R.record_flag(t.orders.select(F.col("o_orderkey").cast("string").alias("plasmid_id")), calls, S.hallmark_counts(genes))


@query("component_records", f"""WITH {OCC} SELECT orf_id FROM occ WHERE plasmid_id IN (SELECT plasmid_id FROM occ WHERE seq_id IN (SELECT seq_id FROM occ WHERE k = 13 AND t = 1))""")
def component_records(t: Tables):
    o = occ(t)
    c = R.propagate_components(o.filter("k = 13 AND t = 1").select("seq_id"), o.select("orf_id", "plasmid_id", "seq_id"))
    return R.candidate_records(c, o.select("orf_id", "plasmid_id")).select("orf_id")


_CONC = f"""{OCC}, ours AS (SELECT *, 'g' || (plasmid_id % 2) AS grp, "end" - start AS len FROM occ WHERE t < 4),
 theirs AS (SELECT plasmid_id, strand, 'g' || (plasmid_id % 2) AS grp, CASE WHEN t % 2 = 0 THEN seq_id ELSE seq_id + 1000 END AS seq_id, CASE WHEN strand = 1 THEN "end" ELSE start END AS stop FROM occ WHERE t > 0),
 k AS (SELECT grp, len, CASE WHEN EXISTS (SELECT 1 FROM theirs x WHERE x.plasmid_id = ours.plasmid_id AND x.seq_id = ours.seq_id) THEN 'IDENTICAL'
   WHEN EXISTS (SELECT 1 FROM theirs x WHERE x.plasmid_id = ours.plasmid_id AND x.strand = ours.strand AND x.stop = CASE WHEN ours.strand = 1 THEN ours."end" ELSE ours.start END) THEN 'SAME_STOP' ELSE 'ABSENT' END AS kind FROM ours)"""


@query("concordance", f"""WITH {_CONC}, p AS (SELECT grp, kind, count(*) AS n, median(len) AS median_length FROM k GROUP BY 1, 2)
SELECT grp AS "group", kind, n, median_length, CAST(sum(n) OVER (PARTITION BY grp) AS BIGINT) AS n_ours, b.n_theirs, b.n_theirs_matched, round(n / sum(n) OVER (PARTITION BY grp), 4) AS share FROM p JOIN (
  SELECT grp, count(*) AS n_theirs, count(*) FILTER (EXISTS (SELECT 1 FROM ours o WHERE o.plasmid_id = theirs.plasmid_id AND o.seq_id = theirs.seq_id)) AS n_theirs_matched FROM theirs GROUP BY 1) b USING (grp)""")
def concordance(t: Tables):
    o = occ(t).withColumn("group", F.concat(F.lit("g"), (F.col("plasmid_id") % 2).cast("string")))
    ours = o.filter("t < 4").select("group", "plasmid_id", "seq_id", "strand", "start", "end", (F.col("end") - F.col("start")).alias("length"))
    theirs = o.filter("t > 0").select("group", "plasmid_id", "strand", "start", "end", F.when(F.col("t") % 2 == 0, F.col("seq_id")).otherwise(F.col("seq_id") + 1000).alias("seq_id"))
    return R.concordance(ours, theirs)


# ---- labels -------------------------------------------------------------------------------
# Order lines are hits of parts (queries) on suppliers (reference keys).

_LH = """lh AS (SELECT l_partkey AS query, l_suppkey AS key, round(100 - 400 * l_discount, 2) AS pident, round(60 + 0.8 * l_quantity, 2) AS qcov, round(100 - 300 * l_tax, 2) AS scov,
  l_extendedprice / 128 AS bitscore, CASE WHEN l_linenumber = 1 THEN 1 ELSE 2 END AS sstart, CAST(l_quantity AS INTEGER) AS send, CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE 99 END AS slen FROM lineitem)"""


def _label_hits(t: Tables):
    q = F.col("l_quantity").cast("int")
    return t.lineitem.select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("key"), F.round(100 - 400 * F.col("l_discount"), 2).alias("pident"),
                             F.round(60 + 0.8 * F.col("l_quantity"), 2).alias("qcov"), F.round(100 - 300 * F.col("l_tax"), 2).alias("scov"),
                             (F.col("l_extendedprice") / 128).alias("bitscore"), F.when(F.col("l_linenumber") == 1, 1).otherwise(2).alias("sstart"),
                             q.alias("send"), F.when(F.col("l_linestatus") == "F", q).otherwise(99).alias("slen"))


_TIER = "CASE WHEN pident >= 80 AND least(qcov, scov) >= 90 THEN 1 WHEN pident > 60 AND least(qcov, scov) > 70 THEN 2 END"


@query("identity_tier", f"WITH {_LH} SELECT {_TIER} AS tier, count(*) AS n FROM lh GROUP BY 1")
def identity_tier(t: Tables):
    return _label_hits(t).groupBy(L.identity_tier("pident", "qcov", "scov").alias("tier")).agg(F.count(F.lit(1)).alias("n"))


_BTH = f"""{_LH}, bth AS (SELECT query, {_TIER} AS tier, key, bitscore FROM lh WHERE {_TIER} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query ORDER BY {_TIER}, bitscore DESC, key) = 1)"""


@query("best_tiered_hit", f"WITH {_BTH} SELECT * FROM bth")
def best_tiered_hit(t: Tables):
    return L.best_tiered_hit(_label_hits(t), fields=("bitscore",))


@query("label_rows", f"""WITH {_BTH} SELECT query AS seq_id, 'tadb' AS source, 'tadb_ta' AS label_kind, label, '' AS sub_label, CAST(tier AS VARCHAR) AS tier, s_name AS subject, '3.0' AS database_version
FROM bth JOIN supplier ON s_suppkey = key, (VALUES ('type I toxin'), ('regulator')) v(label) WHERE label = 'regulator' OR s_nationkey % 2 = 0""")
def label_rows(t: Tables):
    one = lambda s: F.struct(F.lit(s).alias("label"), F.lit("").alias("sub_label"))
    e = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("subject"),
                          F.when(F.col("s_nationkey") % 2 == 0, F.array(one("type I toxin"), one("regulator"))).otherwise(F.array(one("regulator"))).alias("labels"))
    return L.label_rows(L.best_tiered_hit(_label_hits(t), fields=()), e, "tadb", "3.0").drop("cut_off", "pident", "qcov", "scov", "bitscore")


@query("curated_call", f"""WITH {_LH}, m AS (SELECT s_suppkey AS key, s_acctbal / 16 + 300 AS cut_off FROM supplier WHERE s_nationkey <> 3),
 g AS (SELECT query, key, cut_off, bitscore, CASE WHEN pident = 100 AND sstart = 1 AND send = slen THEN 'Perfect' WHEN bitscore >= cut_off THEN 'Strict' END AS call FROM lh JOIN m USING (key))
SELECT query, call, key, cut_off, bitscore FROM g WHERE call IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query ORDER BY CASE call WHEN 'Perfect' THEN 0 ELSE 1 END, bitscore DESC, key) = 1""")
def curated_call(t: Tables):
    m = t.supplier.filter("s_nationkey <> 3").select(F.col("s_suppkey").alias("key"), (F.col("s_acctbal") / 16 + 300).alias("cut_off"))
    return L.curated_call(_label_hits(t), m, fields=("bitscore",))


_LROW = """lr AS (
  SELECT l_partkey AS query, CASE l_returnflag WHEN 'R' THEN 'pfam' WHEN 'A' THEN 'swissprot' ELSE 'pharokka' END AS source, 'T' || l_linenumber AS tier, CAST(round(l_discount * 100) AS INTEGER) || 'e-7' AS evalue,
    CAST(l_tax AS VARCHAR) AS coverage, p_name, p_type, p_brand, p_size, l_suppkey, l_linenumber FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <> 7),
 le AS (
  SELECT query, source, tier, evalue, coverage, 'pfam_family' AS kind, p_name AS label, 'A' || l_suppkey AS accession FROM lr WHERE source = 'pfam'
  UNION ALL SELECT query, source, tier, evalue, coverage, 'pfam_description', 'about ' || p_name, 'A' || l_suppkey FROM lr WHERE source = 'pfam' AND p_name LIKE 'red%'
  UNION ALL SELECT query, source, tier, evalue, coverage, 'pfam_clan', 'CL7', 'A' || l_suppkey FROM lr WHERE source = 'pfam' AND p_name LIKE 'red%'
  UNION ALL SELECT query, source, tier, evalue, coverage, 'swissprot_product', 'Toxin ' || p_type, CASE WHEN l_linenumber = 1 THEN 'A' || l_suppkey ELSE 'P' || l_suppkey || '.1' END FROM lr WHERE source = 'swissprot'
  UNION ALL SELECT query, source, tier, evalue, coverage, 'pharokka_annotation', p_type, CASE WHEN l_linenumber = 1 THEN '' ELSE 'A' || l_suppkey END FROM lr WHERE source = 'pharokka'
  UNION ALL SELECT query, source, tier, evalue, coverage, 'pharokka_category', p_brand, CASE WHEN l_linenumber = 1 THEN '' ELSE 'A' || l_suppkey END FROM lr WHERE source = 'pharokka' AND p_size % 2 = 0)"""


def _label_entries(t: Tables):
    r, s, n = F.col("l_returnflag"), F.col("l_suppkey").cast("string"), F.col("l_linenumber")
    src = F.when(r == "R", "pfam").when(r == "A", "swissprot").otherwise("pharokka")
    h = spread(t.lineitem, TASK_ROWS).join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_partkey").alias("query"), src.alias("source"), F.concat(F.lit("T"), n.cast("string")).alias("tier"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("e-7")).alias("evalue"), F.col("l_tax").cast("string").alias("coverage"),
        F.when(src == "pfam", F.col("p_name")).when(src == "swissprot", F.concat(F.lit("P"), s, F.lit(".1 RecName: Full=Toxin "), "p_type", F.lit("; AltName: Full=x [E. coli]")))
        .otherwise(F.col("p_type")).alias("label"),
        F.when((src == "swissprot") & (n > 1) | (src == "pharokka") & (n == 1), "").otherwise(F.concat(F.lit("A"), s)).alias("target_accession"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("").alias("category"), (n != 7).alias("informative"))
    meta = t.part.filter("p_name LIKE 'red%'").select(F.col("p_name").alias("name"), F.concat(F.lit("about "), "p_name").alias("description"), F.lit("CL7").alias("clan")).distinct()
    return L.labels_from_hits(h, meta)


@query("labels_explode", f"WITH {_LROW} SELECT * FROM le")
def labels_explode(t: Tables):
    return _label_entries(t)


@query("merge_labels", f"""WITH {_LROW}, b AS (SELECT *, row_number() OVER w AS r, row_number() OVER (PARTITION BY query, source, kind, label ORDER BY accession = '', CAST(evalue AS DOUBLE), tier, accession) AS ra FROM le
  WINDOW w AS (PARTITION BY query, source, kind, label ORDER BY CAST(evalue AS DOUBLE), tier, accession, coverage))
SELECT query AS protein_id, source, max(CASE WHEN r = 1 THEN tier END) AS tier, kind, label, '' AS sub_label, max(CASE WHEN ra = 1 AND accession <> '' THEN accession END) AS accession,
  max(CASE WHEN r = 1 THEN evalue END) AS evidence_evalue, max(CASE WHEN r = 1 THEN coverage END) AS evidence_coverage, CASE source WHEN 'pfam' THEN 'Pfam-A' WHEN 'swissprot' THEN 'Swiss-Prot' ELSE 'PHROGs' END AS database,
  CASE source WHEN 'pfam' THEN '37' WHEN 'swissprot' THEN '2026' ELSE '4' END AS database_version, CAST(NULL AS VARCHAR) AS via_representative FROM b GROUP BY query, source, kind, label""")
def merge_labels(t: Tables):
    rows = _label_entries(t).withColumnsRenamed({"query": "protein_id", "evalue": "evidence_evalue", "coverage": "evidence_coverage"})
    rel = {"pfam": ("Pfam-A", "37"), "swissprot": ("Swiss-Prot", "2026"), "pharokka": ("PHROGs", "4")}
    return L.merge_labels(rows, rel)


@query("labels_of_members", """SELECT p_partkey AS protein_id, p_brand AS source, p_name AS label, CAST(NULL AS BIGINT) AS via_representative FROM part
UNION ALL SELECT m.p_partkey, r.p_brand, r.p_name, r.p_partkey FROM part m JOIN part r ON r.p_partkey = m.p_partkey - m.p_partkey % 10 WHERE m.p_partkey % 10 <> 0""")
def labels_of_members(t: Tables):
    k = F.col("p_partkey")
    rows = t.part.select(k.alias("protein_id"), F.col("p_brand").alias("source"), F.col("p_name").alias("label"))
    members = t.part.filter(k % 10 != 0).select(k.alias("seq_id"), (k - k % 10).alias("search_representative"))
    return L.copy_labels_to_members(rows, members)


@query("labels_by_type", f"""WITH {OCC}, {_LABELS}, v AS (SELECT DISTINCT seq_id, split_part(term, ':', 1) AS ty, source || ':' || label AS v FROM term WHERE term IS NOT NULL)
SELECT seq_id, {", ".join(f"coalesce(string_agg(v, '; ' ORDER BY v) FILTER (ty = '{x}'), '') AS {x}_labels" for x in ("amr", "metal", "ta", "conj_role", "mge", "antidefence"))} FROM v GROUP BY 1""")
def labels_by_type(t: Tables):
    return L.labels_by_type(entity_labels(t))


@query("labels_from_orthology", """SELECT p_partkey AS seq_id, 'eggnog' AS source, 'emapper' AS tier, kind, label FROM (
  SELECT p_partkey, 'gene_symbol' AS kind, p_name AS label FROM part WHERE p_size % 3 = 0 UNION ALL SELECT p_partkey, 'cog_category', unnest(['L','K','V']) FROM part WHERE p_size % 2 = 0
  UNION ALL SELECT p_partkey, 'cog_id', 'COG' || p_size FROM part UNION ALL SELECT p_partkey, 'eggnog_pfam', unnest([p_type, p_brand]) FROM part UNION ALL SELECT p_partkey, 'go', 'GO:' || p_size FROM part WHERE p_size > 25
  UNION ALL SELECT p_partkey, 'eggnog_description', p_name || ' thing' FROM part)""")
def labels_from_orthology(t: Tables):
    s = F.col("p_size")
    txt = s.cast("string")
    r = t.part.select(F.col("p_partkey").alias("seq_id"), F.when(s % 3 == 0, F.col("p_name")).otherwise("").alias("preferred_name"), F.when(s % 2 == 0, "LKV").alias("cog_category"),
                      F.concat(F.lit("COG"), txt, F.lit("@2,2QV1F@1224")).alias("eggnog_ogs"), F.concat_ws(", ", "p_type", "p_brand").alias("pfams"),
                      F.when(s > 25, F.concat(F.lit("GO:"), txt)).alias("gos"), F.lit("").alias("ec"), F.lit(None).cast("string").alias("kegg_ko"),
                      F.concat("p_name", F.lit(" thing")).alias("eggnog_description"), F.lit("emapper").alias("orthology_source"))
    return L.labels_from_orthology(r)


@query("stage_status", """SELECT s_name AS source, CASE WHEN s_nationkey % 5 = 0 THEN 'NOT_RUN' WHEN n IS NULL THEN 'NO_HIT' ELSE 'SUCCESS' END AS status, CASE WHEN s_nationkey % 5 <> 0 THEN 'v' || s_nationkey END AS version,
  CASE WHEN s_nationkey % 5 <> 0 THEN coalesce(n, 0) END AS n_entities FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""")
def stage_status(t: Tables):
    exp = t.supplier.select(F.col("s_suppkey"), F.col("s_name").alias("source"), F.concat(F.lit("v"), F.col("s_nationkey").cast("string")).alias("version"), (F.col("s_nationkey") % 5 != 0).alias("ran"))
    found = t.lineitem.join(exp.select(F.col("s_suppkey").alias("l_suppkey"), "source"), "l_suppkey").select("source", F.col("l_partkey").alias("seq_id"))
    return L.stage_status(found, exp)


# ---- networks -----------------------------------------------------------------------------
# Order lines are hits between brands of parts and suppliers, both drawn from one name space.

_NET = """nh AS (SELECT 'n' || l_partkey % 400 AS query, 'n' || l_suppkey AS target, CAST(round(l_discount * 100) AS INTEGER) * 1e-5 AS evalue, l_quantity / 50 AS qcov, l_tax * 10 AS tcov FROM lineitem),
 k4 AS (SELECT * FROM nh WHERE query <> target AND evalue < 1e-4 AND greatest(qcov, tcov) >= 0.5 QUALIFY row_number() OVER (PARTITION BY query ORDER BY evalue, target) <= 4),
 ne AS (SELECT least(query, target) AS source, greatest(query, target) AS target, min(evalue) AS evalue FROM k4 GROUP BY 1, 2)"""


def _net_edges(t: Tables):
    n = lambda c: F.concat(F.lit("n"), c.cast("string"))
    h = t.lineitem.select(n(F.col("l_partkey") % 400).alias("query"), n(F.col("l_suppkey")).alias("target"), (F.round(F.col("l_discount") * 100).cast("int") * F.lit(1e-5)).alias("evalue"),
                          (F.col("l_quantity") / 50).alias("qcov"), (F.col("l_tax") * 10).alias("tcov"))
    return G.top_k_edges(h)


def _comm(nodes: str) -> str:
    """Weighted label propagation over ``ne`` from the node ids in ``nodes`` (u), to its fixed point or two-round cycle."""
    return f"""nw AS (SELECT source, target, CASE WHEN evalue > 0 THEN -log10(evalue) ELSE 300.0 END AS w FROM ne),
 adj AS (SELECT source AS u, target AS v, w FROM nw UNION ALL SELECT target, source, w FROM nw),
 st AS (SELECT 0 AS i, u, u AS l, CAST(NULL AS VARCHAR) AS p FROM ({nodes})
   UNION ALL SELECT i + 1, u, n, l FROM (SELECT st.i, st.u, st.l, st.p, coalesce(b.n, st.l) AS n, count(*) FILTER (coalesce(b.n, st.l) IS DISTINCT FROM st.p) OVER () AS moved FROM st LEFT JOIN (
     SELECT u, l AS n FROM (SELECT adj.u, x.l, round(sum(w), 9) AS s FROM adj JOIN st x ON x.u = adj.v GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY u ORDER BY s DESC, l) = 1) b ON b.u = st.u) WHERE moved > 0),
 fin AS (SELECT u, CASE WHEN p IS NULL THEN l ELSE least(l, p) END AS l FROM st WHERE i = (SELECT max(i) FROM st)),
 num AS (SELECT l, row_number() OVER (ORDER BY count(*) DESC, min(u)) - 1 AS community_id FROM fin GROUP BY 1),
 comm AS (SELECT u AS node_id, community_id FROM fin JOIN num USING (l))"""


_ENDS = "SELECT source AS u FROM ne UNION SELECT target FROM ne"


@query("top_k_edges", f"WITH {_NET} SELECT source, target, evalue, CASE WHEN evalue > 0 THEN round(-log10(evalue), 3) ELSE 300.0 END AS weight FROM ne")
def top_k_edges(t: Tables):
    return _net_edges(t).withColumn("weight", F.round(G.edge_weight("evalue"), 3))


_NODE = f"""{CLASSIFY}, {_NET}, nm AS (SELECT 'n' || p_partkey % 400 AS node_id, p_partkey AS seq_id FROM part),
 nodes AS (SELECT a.*, coalesce(r.n_plasmids, 0) AS n_plasmids, round(b.br, 4) AS brightness, l.label, coalesce(d.degree, 0) AS degree, CAST(b.br <= 0.3 AS INTEGER) AS dark FROM (
   SELECT node_id, count(*) AS n_members, CAST(sum(coalesce(c, 0)) AS BIGINT) AS n_orfs, round(avg(CASE WHEN functional_class IN ('NONE', 'UNCHARACTERIZED_HOMOLOG') THEN 1 ELSE 0 END), 4) AS dark_fraction
   FROM nm JOIN annotation USING (seq_id) LEFT JOIN (SELECT l_partkey, count(*) AS c FROM lineitem GROUP BY 1) ON l_partkey = seq_id GROUP BY 1) a
  LEFT JOIN (SELECT node_id, count(DISTINCT l_orderkey) AS n_plasmids FROM nm JOIN lineitem ON l_partkey = seq_id GROUP BY 1) r USING (node_id)
  LEFT JOIN (SELECT node_id, max(CASE WHEN functional_class = 'FUNCTIONAL' AND annot_completeness = 'NOT_MEASURED' THEN 1.0 ELSE explained_fraction END) AS br FROM nm JOIN annotation USING (seq_id) GROUP BY 1) b USING (node_id)
  LEFT JOIN (SELECT node_id, arg_min(annot_label, (-c, annot_label)) AS label FROM (SELECT node_id, annot_label, count(*) AS c FROM nm JOIN annotation USING (seq_id)
     WHERE functional_class IN ('FUNCTIONAL', 'DOMAIN_ONLY') GROUP BY 1, 2) GROUP BY 1) l USING (node_id)
  LEFT JOIN (SELECT node_id, count(*) AS degree FROM (SELECT source AS node_id FROM ne UNION ALL SELECT target FROM ne) GROUP BY 1) d USING (node_id)),
 {_comm("SELECT DISTINCT node_id AS u FROM nm UNION " + _ENDS)}"""


def _nodes(t: Tables, edges):
    ann = cut(C.classify(hits(t), lengths(t), TIERS, THR, tie=TIE))
    mem = t.part.select(F.concat(F.lit("n"), (F.col("p_partkey") % 400).cast("string")).alias("node_id"), F.col("p_partkey").alias("seq_id"))
    reach = t.lineitem.groupBy(F.col("l_partkey").alias("seq_id")).agg(F.count(F.lit(1)).alias("n_copies"))
    rec = t.lineitem.select(F.col("l_partkey").alias("seq_id"), F.col("l_orderkey").alias("plasmid_id"))
    dk = ann.filter(F.col("functional_class").isin("NONE", "UNCHARACTERIZED_HOMOLOG")).select("seq_id")
    ids = mem.select("node_id").unionByName(edges.select(F.col("source").alias("node_id"))).unionByName(edges.select(F.col("target").alias("node_id"))).distinct()
    return G.network_nodes(mem, reach, rec, ann, dk, edges, G.communities(ids, edges), NetworkSpec(dark_brightness=0.3))


@query("network_nodes", f"WITH RECURSIVE {_NODE} SELECT nodes.*, community_id FROM nodes LEFT JOIN comm USING (node_id)")
def network_nodes(t: Tables):
    return _nodes(t, cut(_net_edges(t)))


@query("network_summary", f"""WITH RECURSIVE {_NODE}, adj2 AS (SELECT source AS x, target AS y FROM ne UNION ALL SELECT target, source FROM ne),
 br AS (SELECT x AS node_id, max(CASE WHEN dark = 0 THEN 1 ELSE 0 END) AS b FROM adj2 JOIN nodes ON nodes.node_id = y GROUP BY 1),
 a AS (SELECT count(*) AS nodes, count(*) FILTER (dark IS NULL) AS nm, count(*) FILTER (dark = 1) AS dn, count(*) FILTER (dark = 1 AND degree > 0) AS dc, count(*) FILTER (dark = 1 AND degree > 0 AND b = 1) AS db,
   count(*) FILTER (n_members = 1 AND dark_fraction = 1) AS sg, count(*) FILTER (n_members = 1 AND dark_fraction = 1 AND degree > 0) AS sge FROM nodes LEFT JOIN br USING (node_id))
SELECT metric, CAST(value AS DOUBLE) AS value FROM (SELECT unnest(['nodes', 'nodes_not_measured', 'dark_nodes', 'dark_nodes_connected', 'dark_connected_to_bright', 'dark_family_singletons', 'dark_family_singletons_with_edge', 'edges',
   'share_dark_nodes_connected', 'share_dark_connected_to_bright', 'min_cov_either_protein', 'max_evalue', 'max_out_edges', 'dark_brightness', 'communities_2plus']) AS metric,
  unnest([nodes, nm, dn, dc, db, sg, sge, (SELECT count(*) FROM ne), round(dc / nullif(dn, 0), 4), round(db / nullif(dc, 0), 4), 0.5, 1e-4, 4, 0.3, (SELECT count(*) FROM (SELECT count(*) AS k FROM nodes JOIN comm USING (node_id) GROUP BY community_id) WHERE k >= 2)]::DOUBLE[]) AS value FROM a)""")
def network_summary(t: Tables):
    e = cut(_net_edges(t))
    return G.network_summary(cut(_nodes(t, e)), e, NetworkSpec(dark_brightness=0.3))


@query("degree_counts", f"""WITH {_NET}, d AS (SELECT node_id, count(*) AS degree FROM (SELECT source AS node_id FROM ne UNION ALL SELECT target FROM ne) GROUP BY 1) SELECT degree, count(*) AS n_nodes FROM d GROUP BY 1""")
def degree_counts(t: Tables):
    e = _net_edges(t)
    ends = e.select(F.col("source").alias("node_id")).unionByName(e.select(F.col("target").alias("node_id")))
    return U.value_counts(U.value_counts(ends, "node_id", "degree"), "degree")


@query("community_sizes", f"WITH RECURSIVE {_NET}, {_comm(_ENDS)} SELECT size, count(*) AS n_communities FROM (SELECT count(*) AS size FROM comm GROUP BY community_id) GROUP BY 1")
def community_sizes(t: Tables):
    return U.community_sizes(communities(t))


@query("communities", f"WITH RECURSIVE {_NET}, {_comm(_ENDS)} SELECT * FROM comm")
def communities(t: Tables):
    e = cut(_net_edges(t))
    n = e.select(F.col("source").alias("node_id")).unionByName(e.select(F.col("target").alias("node_id"))).distinct()
    return G.communities(n, e)


# ---- sketches -----------------------------------------------------------------------------

_SPEC = SketchSpec(k=21, size=200)
_SKETCH = """km AS (SELECT doc_id, CAST('0x' || substr(md5(substr(text, i, 21)), 1, 15) AS BIGINT) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 19)) AS i FROM documents WHERE length(text) >= 21)),
 sk AS (SELECT doc_id, h FROM (SELECT DISTINCT doc_id, h FROM km) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY h) <= 200)"""


@query("sketches", f"WITH {_SKETCH} SELECT doc_id, count(*) AS n, min(h) AS smallest, max(h) AS largest FROM sk GROUP BY 1")
def sketches(t: Tables):
    return Y.sketch(t.documents, "doc_id", "text", _SPEC, Y.portable_hash).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("smallest"), F.max("h").alias("largest"))


_LINK = f"""{_SKETCH}, arr AS (SELECT doc_id, list(h ORDER BY h) AS s FROM sk GROUP BY 1),
 cand AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sk a JOIN sk b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
 u AS (SELECT a, b, x.s AS sa, y.s AS sb, list_sort(list_distinct(list_concat(x.s, y.s)))[1:200] AS un FROM cand JOIN arr x ON x.doc_id = a JOIN arr y ON y.doc_id = b
   WHERE c >= 0.2 * greatest(len(x.s), len(y.s))),
 v AS (SELECT a, b, len(un) AS compared, len(list_filter(list_intersect(sa, sb), lambda h: h <= un[-1])) AS shared FROM u),
 link AS (SELECT a, b, shared, compared, CASE WHEN shared = 0 THEN 1.0 ELSE greatest(0.0, -ln(2 * (shared / compared) / (1 + shared / compared)) / 21) END AS d FROM v),
 ln AS (SELECT doc_id, 1 / (1 + pow(4.0, 21) / length(text)) AS p FROM documents),
 near AS (SELECT link.* FROM link JOIN ln x ON x.doc_id = a JOIN ln y ON y.doc_id = b WHERE d <= 0.05 AND (shared > 1 OR compared * (x.p * y.p / (x.p + y.p - x.p * y.p)) <= 1e-10))"""


@query("lineage_min_id", f"""WITH RECURSIVE {_LINK}, sym AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
 reach AS (SELECT a AS id, a AS root FROM sym UNION SELECT sym.b, reach.root FROM reach JOIN sym ON sym.a = reach.id), comp AS (SELECT id, min(root) AS root FROM reach GROUP BY 1)
SELECT doc_id, coalesce(root, doc_id) AS lineage, 0.05 AS max_distance, 1e-10 AS max_pvalue, 21 AS kmer_size, 200 AS sketch_size FROM documents LEFT JOIN comp ON comp.id = doc_id""")
def lineage_min_id(t: Tables):
    return Y.minhash_lineage(t.documents.select("doc_id", "text"), "doc_id", "text", _SPEC, hash_=Y.portable_hash)


@query("minhash_pairs", f"""WITH {_LINK}, sig AS (SELECT doc_id, CAST(s AS VARCHAR) AS g FROM arr), heads AS (SELECT min(doc_id) AS doc_id FROM sig GROUP BY g)
SELECT a, b, shared, compared, round(shared / compared, 6) AS jaccard, round(d, 6) AS distance FROM near WHERE (a IN (SELECT doc_id FROM heads) AND b IN (SELECT doc_id FROM heads))
  OR (SELECT g FROM sig WHERE doc_id = b) = (SELECT g FROM sig WHERE doc_id = a) AND a IN (SELECT doc_id FROM heads)""")
def minhash_pairs(t: Tables):
    return Y.minhash_edges(t.documents.select("doc_id", "text"), "doc_id", "text", _SPEC, Y.portable_hash).drop("p_value")


def _search_sql(queries: str, references: str, k: int) -> str:
    """K-mer similarity of two (id, text) relations."""
    prof = lambda n, src: f"""{n}k AS (SELECT id, substr(text, i, {k}) AS h, count(*) AS c FROM (SELECT id, text, unnest(range(1, length(text) - {k} + 2)) AS i FROM ({src}) WHERE length(text) >= {k}) GROUP BY 1, 2),
 {n}t AS (SELECT id, count(*) AS n, sum(c) AS t FROM {n}k GROUP BY 1)"""
    return f"""{prof('q', queries)}, {prof('r', references)},
 hit AS (SELECT q.id AS query, r.id AS target, count(*) AS shared, sum(q.c) AS qs, sum(r.c) AS rs FROM qk q JOIN rk r ON q.h = r.h AND q.id <> r.id GROUP BY 1, 2),
 sim AS (SELECT query, target, shared, round(100 * pow(shared / least(a.n, b.n), 1 / {k}.0), 4) AS pident, round(100.0 * qs / a.t, 4) AS qcov, round(100.0 * rs / b.t, 4) AS scov FROM hit JOIN qt a ON a.id = query JOIN rt b ON b.id = target)"""


@query("similarity_search", f"""WITH {_search_sql("SELECT -1 - item_id AS id, text FROM benchmark", "SELECT doc_id AS id, text FROM documents", 12)} SELECT *, row_number() OVER (PARTITION BY query ORDER BY shared DESC, target) AS rank FROM sim WHERE pident >= 60 AND qcov >= 70
QUALIFY row_number() OVER (PARTITION BY query ORDER BY shared DESC, target) <= 25""")
def similarity_search(t: Tables):
    return Y.similarity_search(t.benchmark.select((-1 - F.col("item_id")).alias("id"), "text"), t.documents, "id", "doc_id", top_k=25)


@query("representatives", f"""WITH RECURSIVE {_search_sql("SELECT doc_id AS id, text FROM documents", "SELECT doc_id AS id, text FROM documents", 21)}, ent AS (SELECT doc_id AS id, length(text) AS len FROM documents), o AS (SELECT id, row_number() OVER (ORDER BY len DESC, id) AS pos FROM ent),
 ok AS (SELECT m.pos AS m, r.pos AS r FROM sim JOIN o m ON m.id = query JOIN o r ON r.id = target WHERE pident >= 90 AND qcov >= 80 AND r.pos < m.pos),
 walk AS (SELECT 0 AS i, CAST([] AS BIGINT[]) AS reps UNION ALL
   SELECT i + 1, CASE WHEN EXISTS (SELECT 1 FROM ok WHERE ok.m = i + 1 AND list_contains(reps, ok.r)) THEN reps ELSE list_append(reps, i + 1) END FROM walk WHERE i < (SELECT count(*) FROM o)),
 fin AS (SELECT unnest(reps) AS pos FROM walk WHERE i = (SELECT count(*) FROM o))
SELECT rep.id AS representative, mem.id AS member FROM o mem JOIN (SELECT m, min(r) AS r FROM ok WHERE r IN (SELECT pos FROM fin) AND m NOT IN (SELECT pos FROM fin) GROUP BY 1) a ON a.m = mem.pos JOIN o rep ON rep.pos = a.r
UNION ALL SELECT o.id, o.id FROM o JOIN fin USING (pos)""")
def representatives(t: Tables):
    d = t.documents.select(F.col("doc_id").alias("id"), "text")
    found = Y.similarity_search(d, d, "id", "id", k=21, min_identity=90, min_cov=80, top_k=None)
    return Y.cluster_representatives(found, d.select("id", F.length("text").alias("length")), ClusterSpec("close", 90, 80), "id")
