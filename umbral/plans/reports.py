"""The evidence reports over the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from umbral.functions import fixed as FIXED
from umbral.operators import report as E
from umbral.plans import distribution as X
from umbral.plans import ordered as O
from umbral.plans import texts as W
from umbral.plans.bindings import OCC, keep_occ, occ
from umbral.plans.catalog import ORACLES, Tables, query
from umbral.session import cut

# Families with a rate status and a structure, so that every line and dimension can fire.
_EVID = """ev AS (SELECT p_partkey AS family_id, CASE p_size % 4 WHEN 0 THEN 'MEASURED' WHEN 1 THEN 'TOO_SHORT' WHEN 2 THEN '' END AS dnds_status, round(p_size / 50.0, 4) AS dnds_median,
  p_size % 5 AS n_members, p_size % 3 AS independent_plasmid_cluster_count, CASE WHEN p_type = 'PROMO' THEN p_brand ELSE '' END AS structural_match FROM part)"""


def _evidence(t: Tables):
    s = F.col("p_size")
    return t.part.select(F.col("p_partkey").alias("family_id"), F.when(s % 4 == 0, "MEASURED").when(s % 4 == 1, "TOO_SHORT").when(s % 4 == 2, "").alias("dnds_status"),
                         F.round(s / 50.0, 4).alias("dnds_median"), (s % 5).alias("n_members"), (s % 3).alias("independent_plasmid_cluster_count"),
                         F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise("").alias("structural_match"))


@query("reality_lines", f"""WITH {_EVID}, f AS (SELECT *, coalesce(dnds_status = 'MEASURED' AND dnds_median < 0.5, false) AS p, independent_plasmid_cluster_count >= 2 AS m, n_members >= 3 AS i, structural_match <> '' AS s FROM ev)
SELECT family_id, CAST(p AS INTEGER) + CAST(m AS INTEGER) + CAST(i AND NOT p AS INTEGER) + CAST(s AS INTEGER) AS reality_n,
  coalesce(nullif(concat_ws('+', CASE WHEN p THEN 'purifying_selection' END, CASE WHEN m THEN 'multi_lineage' END, CASE WHEN i AND NOT p THEN 'is_family' END, CASE WHEN s THEN 'folds' END), ''), 'none') AS reality_lines,
  CASE WHEN i AND p THEN 'is_family' ELSE 'none' END AS reality_lines_implied, CASE WHEN s THEN 'DARK_FOLD_KNOWN' ELSE 'DARK_NO_STRUCTURE' END AS darkness_state FROM f""")
def reality_lines(t: Tables):
    return E.reality_lines(_evidence(t)).select("family_id", "reality_n", "reality_lines", "reality_lines_implied", "darkness_state")


@query("evidence_dimensions", """WITH e AS (SELECT p_partkey AS family_id, p_size % 2 AS artefact_screened, p_size % 3 AS cascade_searched, p_size % 4 = 0 AS egg, CASE WHEN p_size % 5 = 0 THEN 0.0 END AS ctx, CASE WHEN p_size % 7 = 0 THEN 'TOO_FEW_LINEAGES' WHEN p_size % 7 = 1 THEN 'NO_CONTEXT' END AS syn,
   p_size % 6 = 0 AS dn, p_size % 8 = 0 AS dist, p_size > 25 AS struc, p_size AS len, p_size * 2 AS h FROM part)
SELECT family_id, concat_ws(',', CASE WHEN artefact_screened > 0 THEN 'ORF_QC' END, CASE WHEN cascade_searched > 0 THEN 'SEQUENCE_HOMOLOGY' END, CASE WHEN egg THEN 'ORTHOLOGY' END, CASE WHEN ctx IS NOT NULL OR syn = 'NO_CONTEXT' THEN 'GENOMIC_CONTEXT' END,
   CASE WHEN dn THEN 'EVOLUTIONARY_CONSERVATION' END, CASE WHEN dist THEN 'DISTRIBUTION' END, CASE WHEN struc THEN 'STRUCTURAL_RELATIONSHIP' END, CASE WHEN len > 0 THEN 'PROTEIN_PROPERTIES' END) AS evidence_dimensions_present,
  CAST(artefact_screened > 0 AS INTEGER) + CAST(cascade_searched > 0 AS INTEGER) + CAST(egg AS INTEGER) + CAST(ctx IS NOT NULL OR coalesce(syn, '') = 'NO_CONTEXT' AS INTEGER) + CAST(dn AS INTEGER) + CAST(dist AS INTEGER) + CAST(struc AS INTEGER) + CAST(len > 0 AS INTEGER) AS evidence_dimension_count,
  h AS supporting_observations_count, 1 AS supporting_observations_are_not_independent FROM e""")
def evidence_dimensions(t: Tables):
    s = F.col("p_size")
    r = t.part.select(F.col("p_partkey").alias("family_id"), (s % 2).alias("artefact_screened"), (s % 3).alias("cascade_searched"), (s % 4 == 0).cast("int").alias("eggnog_searched"),
                      F.when(s % 5 == 0, 0.0).alias("cons_annotated_neighbour"), F.when(s % 7 == 0, "TOO_FEW_LINEAGES").when(s % 7 == 1, "NO_CONTEXT").alias("synteny_status"), F.lit(None).cast("string").alias("cooccurrence_status"),
                      F.when(s % 6 == 0, "TOO_SHORT").alias("dnds_status"), F.lit("").alias("rnacode_status"), F.when(s % 8 == 0, "SUCCESS").otherwise("NOT_RUN").alias("independent_cluster_status"),
                      (s > 25).cast("int").alias("structure_searched"), s.alias("representative_length_aa"), (s * 2).alias("n_informative_hits"))
    return E.evidence_dimensions(r).select("family_id", "evidence_dimensions_present", "evidence_dimension_count", "supporting_observations_count", "supporting_observations_are_not_independent")


@query("measured_inputs", """WITH m AS (SELECT p_name AS family_id, p_partkey AS seq_id, min(p_partkey) OVER (PARTITION BY p_name) AS rep, p_size, p_type FROM part)
SELECT family_id, max(CAST(p_type = 'PROMO' AS INTEGER)) AS artefact_screened, max(CAST(p_size > 10 AS INTEGER)) AS cascade_searched, max(CAST(p_type = 'LARGE' AND p_size = 7 AS INTEGER)) AS eggnog_searched,
  CAST(coalesce(sum(p_size) FILTER (p_size > 10), 0) AS BIGINT) AS n_informative_hits, rep + 50 AS representative_length_aa FROM m GROUP BY family_id, rep""")
def measured_inputs(t: Tables):
    p = t.part.select(F.col("p_name").alias("family_id"), F.col("p_partkey").alias("seq_id"), "p_size", "p_type")
    reps = p.groupBy("family_id").agg(F.min("seq_id").alias("representative"))
    ann = p.select("seq_id", F.when(F.col("p_size") > 10, "FUNCTIONAL").otherwise("NOT_SEARCHED").alias("functional_class"), F.col("p_size").alias("n_informative_hits"))
    return E.measured_inputs(p.select("family_id", "seq_id").join(reps, "family_id"), p.filter("p_type = 'PROMO'").select("seq_id"), ann,
                             p.filter("p_type = 'LARGE' AND p_size = 7").select("seq_id"), p.select("seq_id", (F.col("seq_id") + 50).alias("length")))


# ---- the family report --------------------------------------------------------------------

SYNTENY_MIN_LINEAGES = 2
_SYN_COLS = tuple(m for m in O._MEAS if m != "status")
_CODING = ("rnacode_p", "rnacode_p_antisense", "rnacode_status", "coding_signal")
_RATES = ("n_pairs", "dnds_median", "dnds_min", "under_purifying_selection", "dnds_status")
_RECURRENCE = ("plasmid_occurrence_count", "unique_plasmid_count", "independent_plasmid_cluster_count", "independent_cluster_status", "host_count", "genus_count",
               "n_plasmids_with_host", "n_plasmids_with_species", "host_count_status", "n_plasmids_with_predicted_range", "predicted_host_range_count",
               "predicted_host_ranges", "MOB_count", "habitat_count", "database_source_count")
_CONTEXT = tuple(f"cons_{c}" for c in FIXED.CONTEXT_FEATURES)
_MEASURED = ("artefact_screened", "cascade_searched", "eggnog_searched", "n_informative_hits", "representative_length_aa")
_BASE = ("representative", "family_class", "n_members", "n_orfs", "n_plasmids", "n_mob_clusters", "dark_member_count", "annotated_member_count",
         "percentage_dark_in_family", "dark_only", "n_small_members", "n_large_members", "scope", "known_from")
_PARTNERS = ("n_cooccurring_partners", "top_cooccurring_partner", "top_cooccurring_partner_q", "top_cooccurring_partner_fraction")

#: Every column of the family report, side by side.
FAMILY_COLS = ("family_id", *_BASE, "representative_length_aa", "reality_n", "reality_lines", "reality_lines_implied", *_RATES, *_CODING,
               *(f"small_{c}" for c in (*_RATES, *_CODING)), "consensus_status", "consensus_hit", "consensus_label", "collectively_novel",
               "darkness_state", "structural_match", "structural_description", "structure_evalue", *_CONTEXT, *_RECURRENCE, *_SYN_COLS, "synteny_status",
               "synteny_min_lineages", *(f"small_{c}" for c in _SYN_COLS), "small_synteny_status", "cooccurrence_status", *_PARTNERS, "cooccurrence_fdr",
               "cooccurrence_min_lineages", "rarity_labels", "evidence_dimensions_present", "evidence_dimension_count", "supporting_observations_count",
               "supporting_observations_are_not_independent")


def _coding(t: Tables):
    """Coding scores of a family's alignment, over all members and over small-record ones; one part in five was not scored."""
    s = F.col("p_size")
    side = lambda p, n: [(n / 1000).alias(f"{p}rnacode_p"), ((n + 7) % 60 / 1000).alias(f"{p}rnacode_p_antisense"), F.when(n % 5 == 0, "TOO_SHORT").otherwise("SUCCESS").alias(f"{p}rnacode_status"),
                         ((n / 1000 < 0.05) & (n / 1000 < (n + 7) % 60 / 1000)).cast("int").alias(f"{p}coding_signal")]
    return t.part.select(F.col("p_partkey").alias("family_id"), *side("", s), *side("small_", s + 1))


def family_table(t: Tables):
    keep_occ(t)
    O.kept_around(t)   # the contexts and the synteny read it
    fam = cut(X.dark(t).withColumnRenamed("family_size", "n_members").withColumn("structure_searched", F.lit(1)))
    rec = cut(X.recurrence_(t))
    rar = X.rarity_(t, rec)
    # the context, synteny and partner tables number families; the report names them by resolution and representative
    firsts = cut(occ(t).groupBy(F.col("family_id").alias("_f")).agg(F.concat(F.lit("intermediate:"), F.min("seq_id").cast("string")).alias("fid")))
    by_number = lambda df: cut(df.withColumn("_f", F.col("family_id").cast("bigint")).join(firsts, "_f").drop("family_id", "_f").withColumnRenamed("fid", "family_id"))
    by_representative = lambda df: df.withColumn("family_id", F.concat(F.lit("intermediate:"), F.col("family_id").cast("string")))
    syn = by_number(O.kept_synteny(t).filter("level = 'intermediate'")).withColumn("synteny_min_lineages", F.lit(SYNTENY_MIN_LINEAGES))
    rates, coding, consensus = (by_representative(x) for x in (W.pairwise_rates(t), _coding(t), W.consensus_label(t)))
    struct = by_representative(t.part.filter("p_type = 'PROMO'").select(
        F.col("p_partkey").alias("family_id"), F.col("p_brand").alias("structural_match"), F.col("p_name").alias("structural_description"), (F.col("p_size") / 1e6).alias("structure_evalue")))
    e = F.col("seq_id")
    mem = X.members(t).filter("resolution = 'intermediate'").select("seq_id", "representative", F.concat(F.lit("intermediate:"), F.col("representative").cast("string")).alias("family_id"))
    every = X.classes(t).withColumn("n_informative_hits", e % 4)
    measured = E.measured_inputs(mem, every.filter(e % 2 == 0).select("seq_id"), every, every.filter(e % 9 == 0).select("seq_id"), every.select("seq_id", (e + 50).alias("length")))
    measured = measured.join(fam.select("family_id"), "family_id", "left_semi")
    both = lambda cols: (*cols, *(f"small_{c}" for c in cols))
    sides = {
        "measured inputs": (measured, _MEASURED, {}),
        "rates": (rates, both(_RATES), {}),
        "coding": (coding, both(_CODING), {}),
        "consensus": (consensus, ("consensus_status", "consensus_hit", "consensus_label", "collectively_novel"), {}),
        "structure": (struct, ("structural_match", "structural_description", "structure_evalue"), {}),
        "context": (by_number(O.rates(t)), _CONTEXT, {}),
        "recurrence": (rec, _RECURRENCE, {}),
        "synteny": (syn, (*both((*_SYN_COLS, "status")), "synteny_min_lineages"), {"status": "synteny_status", "small_status": "small_synteny_status"}),
        "partners": (by_number(X.partners(t)), _PARTNERS, {}),
        "rarity": (rar, ("rarity_labels",), {}),
    }
    return E.family_report(fam, sides, cooccurrence_fdr=0.2, catalogue=FAMILY_COLS)


def _prefixed(alias: str, cols, rename=None) -> str:
    return ", ".join(f'{alias}."{c}"' + (f" AS {rename[c]}" if rename and c in rename else "") for c in cols)


_BOTH_SYN = [*_SYN_COLS, "status", *(f"small_{c}" for c in (*_SYN_COLS, "status"))]
_CODING_SQL = ", ".join(f"{n} / 1000 AS {p}rnacode_p, ({n} + 7) % 60 / 1000 AS {p}rnacode_p_antisense, CASE WHEN {n} % 5 = 0 THEN 'TOO_SHORT' ELSE 'SUCCESS' END AS {p}rnacode_status, "
                        f"CAST({n} / 1000 < 0.05 AND {n} / 1000 < ({n} + 7) % 60 / 1000 AS INTEGER) AS {p}coding_signal" for p, n in (("", "p_size"), ("small_", "(p_size + 1)")))
_REPORT = f"""{X._DARK}, fid AS (SELECT family_id AS f, 'intermediate:' || min(seq_id) AS family_id FROM occ GROUP BY 1),
 rec AS ({ORACLES["recurrence"]}), rar AS ({ORACLES["rarity"]}), synq AS ({ORACLES["synteny_conservation"]}), ctx AS ({ORACLES["context_rates"]}),
 pr AS ({ORACLES["pairwise_rates"]}), con AS ({ORACLES["consensus_label"]}), cod AS (SELECT p_partkey AS family_id, {_CODING_SQL} FROM part),
 par AS (WITH {X._PAIR}, bi AS (SELECT seq_a AS seq_id, seq_b AS partner, fraction_of_a AS fraction, round(p_value, 9) AS p_value, round(q_value, 9) AS q_value, n_lineages_together FROM cooc
     UNION ALL SELECT seq_b, seq_a, fraction_of_b, round(p_value, 9), round(q_value, 9), n_lineages_together FROM cooc)
   SELECT x.family_id AS f, count(DISTINCT CASE WHEN q_value <= 0.2 THEN partner END) AS n_cooccurring_partners, arg_min((partner, q_value, fraction), (q_value, p_value, -n_lineages_together, partner, -fraction)) AS w
   FROM bi JOIN (SELECT DISTINCT seq_id, family_id FROM occ) x USING (seq_id) GROUP BY 1),
 mi AS (SELECT representative, max(CAST(seq_id % 2 = 0 AS INTEGER)) AS artefact_screened, max(CAST(functional_class <> 'NOT_SEARCHED' AS INTEGER)) AS cascade_searched, max(CAST(seq_id % 9 = 0 AS INTEGER)) AS eggnog_searched,
     CAST(coalesce(sum(seq_id % 4) FILTER (functional_class <> 'NOT_SEARCHED'), 0) AS BIGINT) AS n_informative_hits FROM mem JOIN cls USING (seq_id) WHERE resolution = 'intermediate' GROUP BY 1),
 j AS (SELECT d.* EXCLUDE (family_size, family_resolution, n_unnamed_excluded, n_small_dark, n_not_searched), d.family_size AS n_members, mi.* EXCLUDE (representative), rr.seq_id + 50 AS representative_length_aa,
     {_prefixed("pr", (*_RATES, *(f"small_{c}" for c in _RATES)))}, {_prefixed("cod", (*_CODING, *(f"small_{c}" for c in _CODING)))}, con.consensus_status, con.consensus_hit, con.consensus_label, con.collectively_novel,
     st.p_brand AS structural_match, st.p_name AS structural_description, st.p_size / 1e6 AS structure_evalue, {_prefixed("ctx", _CONTEXT)}, {_prefixed("rec", _RECURRENCE)},
     {_prefixed("synq", _BOTH_SYN, {"status": "synteny_status", "small_status": "small_synteny_status"})}, CASE WHEN synq.family_id IS NOT NULL THEN {SYNTENY_MIN_LINEAGES} END AS synteny_min_lineages,
     CASE WHEN par.f IS NULL THEN 'TOO_FEW_LINEAGES' ELSE 'SUCCESS' END AS cooccurrence_status, coalesce(par.n_cooccurring_partners, 0) AS n_cooccurring_partners, par.w[1] AS top_cooccurring_partner,
     round(par.w[2], 6) AS top_cooccurring_partner_q, par.w[3] AS top_cooccurring_partner_fraction, 0.2 AS cooccurrence_fdr, 2 AS cooccurrence_min_lineages, rar.rarity_labels,
     coalesce(pr.dnds_status = 'MEASURED' AND pr.dnds_median < 0.5, false) AS l_p, coalesce(rec.independent_plasmid_cluster_count >= 2, false) AS l_m, d.family_size >= 3 AS l_i, coalesce(st.p_brand, '') <> '' AS l_s
   FROM darkfam d LEFT JOIN (SELECT DISTINCT seq_id FROM cls) rr ON rr.seq_id = split_part(d.family_id, ':', 2)::BIGINT LEFT JOIN mi ON 'intermediate:' || mi.representative = d.family_id
     LEFT JOIN rec USING (family_id) LEFT JOIN rar USING (family_id) LEFT JOIN fid USING (family_id)
     LEFT JOIN synq ON synq.level = 'intermediate' AND synq.family_id = CAST(fid.f AS VARCHAR) LEFT JOIN ctx ON ctx.family_id = fid.f LEFT JOIN par ON par.f = fid.f
     LEFT JOIN pr ON 'intermediate:' || pr.family_id = d.family_id LEFT JOIN con ON 'intermediate:' || con.family_id = d.family_id LEFT JOIN cod ON 'intermediate:' || cod.family_id = d.family_id
     LEFT JOIN part st ON st.p_type = 'PROMO' AND 'intermediate:' || st.p_partkey = d.family_id),
 dim AS (SELECT *, [CASE WHEN artefact_screened > 0 THEN 'ORF_QC' END, CASE WHEN cascade_searched > 0 THEN 'SEQUENCE_HOMOLOGY' END, CASE WHEN eggnog_searched > 0 THEN 'ORTHOLOGY' END,
     CASE WHEN cons_annotated_neighbour IS NOT NULL OR coalesce(synteny_status, 'TOO_FEW_LINEAGES') <> 'TOO_FEW_LINEAGES' OR cooccurrence_status <> 'TOO_FEW_LINEAGES' THEN 'GENOMIC_CONTEXT' END,
     CASE WHEN coalesce(dnds_status, '') <> '' OR coalesce(rnacode_status, '') <> '' THEN 'EVOLUTIONARY_CONSERVATION' END, CASE WHEN independent_cluster_status = 'SUCCESS' THEN 'DISTRIBUTION' END,
     'STRUCTURAL_RELATIONSHIP', CASE WHEN representative_length_aa > 0 THEN 'PROTEIN_PROPERTIES' END] AS dims FROM j)
SELECT * EXCLUDE (l_p, l_m, l_i, l_s, dims, artefact_screened, cascade_searched, eggnog_searched, n_informative_hits), CAST(l_p AS INTEGER) + CAST(l_m AS INTEGER) + CAST(l_i AND NOT l_p AS INTEGER) + CAST(l_s AS INTEGER) AS reality_n,
  coalesce(nullif(concat_ws('+', CASE WHEN l_p THEN 'purifying_selection' END, CASE WHEN l_m THEN 'multi_lineage' END, CASE WHEN l_i AND NOT l_p THEN 'is_family' END, CASE WHEN l_s THEN 'folds' END), ''), 'none') AS reality_lines,
  CASE WHEN l_i AND l_p THEN 'is_family' ELSE 'none' END AS reality_lines_implied, CASE WHEN l_s THEN 'DARK_FOLD_KNOWN' ELSE 'DARK_NO_STRUCTURE' END AS darkness_state,
  array_to_string(list_filter(dims, lambda x: x IS NOT NULL), ',') AS evidence_dimensions_present, CAST(len(list_filter(dims, lambda x: x IS NOT NULL)) AS INTEGER) AS evidence_dimension_count,
  n_informative_hits AS supporting_observations_count, 1 AS supporting_observations_are_not_independent FROM dim"""


@query("family_report", f"WITH {_REPORT}")
def family_report(t: Tables):
    return family_table(t)


# ---- the item report ----------------------------------------------------------------------

_ITEM = f"""{OCC}, {X._MEM}, {X._REG}, {O._LABELS}, isl AS (SELECT plasmid_id, orf_id AS is_id, 'F' || (k % 7) AS family, start, "end" + 20000 AS e0, "end" AS e1, circular FROM occ WHERE t = 1),
 isl2 AS (SELECT plasmid_id, family, start, CASE WHEN circular AND e0 > 2592000 AND start <= e1 THEN e0 - 2592000 ELSE e0 END AS "end" FROM isl),
 iel AS (SELECT orf_id, string_agg(DISTINCT family, ',' ORDER BY family) AS is_element FROM occ o JOIN isl2 i ON i.plasmid_id = o.plasmid_id WHERE CASE WHEN o.start <= o."end" AND i.start <= i."end" THEN o.start <= i."end" AND o."end" >= i.start
     WHEN o.start <= o."end" THEN o."end" >= i.start OR o.start <= i."end" WHEN i.start <= i."end" THEN i."end" >= o.start OR i.start <= o."end" ELSE true END GROUP BY 1),
 tl AS (SELECT DISTINCT seq_id, split_part(term, ':', 1) AS ty, source || ':' || label AS v FROM term WHERE term IS NOT NULL),
 lt AS (SELECT seq_id, string_agg(v, '; ' ORDER BY v) FILTER (ty = 'amr') AS amr_labels, string_agg(v, '; ' ORDER BY v) FILTER (ty = 'ta') AS ta_labels FROM tl GROUP BY 1),
 dk AS (SELECT mem.representative, 'intermediate:' || mem.representative AS family_id, bool_or(dark AND on_small) AS d FROM mem JOIN cls USING (seq_id) JOIN reach USING (seq_id) WHERE resolution = 'intermediate' GROUP BY 1, 2)"""


@query("item_report", f"""WITH {_ITEM} SELECT o.orf_id, o.plasmid_id, o.start, o."end", o.seq_id, o.functional_class, coalesce(iel.is_element, '') AS is_element, reg.species AS host_species, reg.genus AS host_genus, reg.predicted_host_range,
  coalesce(lt.amr_labels, '') AS amr_labels, coalesce(lt.ta_labels, '') AS ta_labels, CASE o.plasmid_id % 4 WHEN 0 THEN 'pCONJ' WHEN 1 THEN 'pMOB' ELSE 'pMOBless' END AS plasmid_conjscan_class, dk.family_id
FROM occ o LEFT JOIN reg USING (plasmid_id) LEFT JOIN iel USING (orf_id) LEFT JOIN lt USING (seq_id) LEFT JOIN mem ON mem.seq_id = o.seq_id AND mem.resolution = 'intermediate'
  JOIN cls ON cls.seq_id = o.seq_id LEFT JOIN dk ON dk.representative = mem.representative AND dk.d AND cls.dark""")
def item_report(t: Tables):
    from umbral.operators import labels as L
    from umbral.operators import registry as R
    o = keep_occ(t).select("orf_id", "plasmid_id", "start", "end", "seq_id", "functional_class")
    hit = O.overlaps(t).filter("el_name = 'is_element'")
    iel = hit.select("orf_id", "el_family").distinct().groupBy("orf_id").agg(F.array_join(F.sort_array(F.collect_list("el_family")), ",").alias("is_element"))
    reg = X.registry(t).select("plasmid_id", F.col("species").alias("host_species"), F.col("genus").alias("host_genus"), "predicted_host_range")
    lab = L.labels_by_type(O.entity_labels(t)).select("seq_id", "amr_labels", "ta_labels")
    recs = occ(t).select("plasmid_id").distinct()
    u = F.col("plasmid_id")
    sysd = recs.filter(u % 4 < 2).select("plasmid_id", F.when(u % 4 == 0, "Plasmids/T4SS_typeI").otherwise("MOB").alias("system"))
    cls = R.record_class(recs, sysd).withColumnRenamed("class", "plasmid_conjscan_class")
    fam = X.dark(t).select("family_id")
    mem = (X.members(t).filter("resolution = 'intermediate'").select("seq_id", F.concat(F.lit("intermediate:"), F.col("representative").cast("string")).alias("family_id"))
           .join(X.classes(t).filter("dark").select("seq_id"), "seq_id", "left_semi").join(fam, "family_id", "left_semi"))
    out = E.item_report(o, [("plasmid_id", reg), ("orf_id", iel), ("seq_id", lab), ("plasmid_id", cls), ("seq_id", mem)], fam)
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("is_element", "amr_labels", "ta_labels")})


# ---- every field of an item ---------------------------------------------------------------

_LABEL_TYPES = ("amr", "metal", "ta", "conj_role", "mge", "antidefence")
_CLOSE = {"modal_synteny": "close_modal_synteny", "lineage_synteny_conservation": "close_lineage_synteny_conservation", "n_lineages": "close_n_lineages", "status": "close_synteny_status"}
_CARRIED = ("scope", "reality_n", "reality_lines", "darkness_state", "dnds_median", "dnds_status", "coding_signal", "collectively_novel", "structural_match", "structural_description")

_EVERY = f"""item AS ({ORACLES["item_report"]}), fr AS ({ORACLES["family_report"]}), syc AS ({ORACLES["synteny_conservation"]}), {OCC}, {O._LABELS},
 tl AS (SELECT DISTINCT seq_id, split_part(term, ':', 1) AS ty, source || ':' || label AS v FROM term WHERE term IS NOT NULL),
 lt AS (SELECT seq_id, {", ".join(f"string_agg(v, '; ' ORDER BY v) FILTER (ty = '{x}') AS {x}_labels" for x in _LABEL_TYPES)} FROM tl GROUP BY 1)
SELECT item.* EXCLUDE (amr_labels, ta_labels), {", ".join(f"coalesce(lt.{x}_labels, '') AS {x}_labels" for x in _LABEL_TYPES)},
  p_brand AS cog_category, p_type AS kegg_pathways, p_name AS preferred_name, p_name || ' ' || p_type AS eggnog_description,
  CASE WHEN occ.k % 13 = 0 THEN 'T' || (occ.k % 2) ELSE '' END AS conj_system, CASE WHEN occ.k % 13 = 0 THEN 'c' || occ.t ELSE '' END AS conj_component,
  CASE WHEN occ.plasmid_id % 5 = 0 THEN 'phage_plasmid' WHEN occ.plasmid_id % 5 < 4 THEN 'no' END AS plasmid_phage_plasmid,
  {", ".join(f"syc.{c} AS {n}" for c, n in _CLOSE.items())}, {", ".join(f"fr.{c}" for c in _CARRIED)}
FROM item JOIN occ USING (orf_id) LEFT JOIN lt ON lt.seq_id = item.seq_id LEFT JOIN part ON p_partkey = item.seq_id LEFT JOIN syc ON syc.level = 'close' AND syc.family_id = CAST(occ.close_id AS VARCHAR)
  LEFT JOIN fr ON fr.family_id = item.family_id"""


@query("item_evidence", f"WITH {_EVERY}")
def item_evidence(t: Tables):
    """The item report with every label type, orthology, conjugation systems, the record's phage call, the close level's synteny and the family's evidence."""
    from umbral.operators import labels as L
    o = keep_occ(t)
    items = item_report(t).drop("amr_labels", "ta_labels")
    O.kept_around(t)
    labels = L.labels_by_type(O.entity_labels(t)).select("seq_id", *[f"{x}_labels" for x in _LABEL_TYPES])
    ortho = t.part.select(F.col("p_partkey").alias("seq_id"), F.col("p_brand").alias("cog_category"), F.col("p_type").alias("kegg_pathways"), F.col("p_name").alias("preferred_name"),
                          F.concat_ws(" ", "p_name", "p_type").alias("eggnog_description"))
    systems = o.filter(F.col("k") % 13 == 0).select("orf_id", F.concat(F.lit("T"), (F.col("k") % 2).cast("string")).alias("conj_system"), F.concat(F.lit("c"), F.col("t").cast("string")).alias("conj_component"))
    u = F.col("plasmid_id")
    phage = o.filter(u % 5 < 4).select("plasmid_id", F.when(u % 5 == 0, "phage_plasmid").otherwise("no").alias("plasmid_phage_plasmid")).distinct()
    close = O.kept_synteny(t).filter("level = 'close'").select(F.col("family_id").cast("bigint").alias("close_id"), *[F.col(c).alias(n) for c, n in _CLOSE.items()])
    of_entity = o.select("seq_id", "close_id").distinct().join(close, "close_id").drop("close_id")
    carried = family_table(t).select("family_id", *_CARRIED)
    out = E.item_report(items, [("seq_id", labels), ("seq_id", ortho), ("orf_id", systems), ("plasmid_id", phage), ("seq_id", of_entity)], carried)
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in (*[f"{x}_labels" for x in _LABEL_TYPES], "conj_system", "conj_component")})
