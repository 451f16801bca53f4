"""Labels: what each source said, tagged with the kind of statement it is."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.functions import bind
from umbral.functions import fixed as X
from umbral.functions.predicates import as_evalue, blank
from umbral.functions.text import comma_list, context_term, parse_title, text_or_empty
from umbral.specs import LabelSource


def identity_tier(pident, qcov, scov) -> Column:
    """1 (>= 80 identity and >= 90 coverage of both), 2 (> 60 and > 70), else NULL."""
    i, q, s = (c if isinstance(c, Column) else F.col(c) for c in (pident, qcov, scov))
    cov = F.least(q, s)
    return (F.when((i >= X.TIER1_IDENTITY) & (cov >= X.TIER1_COVERAGE), 1)
            .when((i > X.TIER2_IDENTITY) & (cov > X.TIER2_COVERAGE), 2))


def best_tiered_hit(hits: DataFrame, query: str = "query", key: str = "key",
                    fields: Sequence[str] = ("pident", "qcov", "scov", "bitscore")) -> DataFrame:
    """Per query the better tier, then the higher bitscore, then the smaller numeric key."""
    graded = hits.withColumn("tier", identity_tier("pident", "qcov", "scov")).filter("tier IS NOT NULL")
    rank = F.struct("tier", (-F.col("bitscore")).alias("_b"), F.col(key).cast("bigint").alias("_k"))
    return graded.groupBy(query).agg(F.min_by(F.struct("tier", key, *fields), rank).alias("_w")).select(query, "_w.*")


def curated_call(hits: DataFrame, models: DataFrame, query: str = "query", key: str = "key",
                 fields: Sequence[str] = ("pident", "bitscore")) -> DataFrame:
    """Per query a Perfect hit (identical over the whole reference) or the strongest Strict one.

    Strict needs the model's own bit-score cut. Hits to unknown models are ignored.
    """
    perfect = (F.col("pident") == 100.0) & (F.col("sstart") == 1) & (F.col("send") == F.col("slen"))
    graded = (hits.join(models.select(key, "cut_off"), key)
              .withColumn("call", F.when(perfect, "Perfect").when(F.col("bitscore") >= F.col("cut_off"), "Strict"))
              .filter("call IS NOT NULL"))
    rank = F.struct((F.col("call") != "Perfect").alias("_c"), (-F.col("bitscore")).alias("_b"),
                    F.col(key).cast("bigint").alias("_k"))
    return graded.groupBy(query).agg(
        F.min_by(F.struct("call", key, "cut_off", *fields), rank).alias("_w")).select(query, "_w.*")


def label_rows(best: DataFrame, entries: DataFrame, source: LabelSource | str, version: str | None = None,
               grade: str = "tier", key: str = "key", query: str = "query") -> DataFrame:
    """One row per label of the winning entry. ``entries``: key, subject, labels ARRAY<(label, sub_label)>.

    A known database goes by its name; any other brings its own :class:`LabelSource`.
    """
    src = source if isinstance(source, LabelSource) else LabelSource(source, X.LABEL_KIND[source], version)
    optional = lambda c: F.col(c).cast("string") if c in best.columns else F.lit("")
    return (best.join(entries.select(key, "subject", "labels"), key)
            .select(F.col(query).alias("seq_id"), F.lit(src.name).alias("source"),
                    F.lit(src.kind).alias("label_kind"), F.inline("labels"),
                    F.col(grade).cast("string").alias("tier"),
                    *[optional(c).alias(c) for c in ("cut_off", "pident", "qcov", "scov", "bitscore")],
                    "subject", F.lit(src.version).cast("string").alias("database_version")))


def _entry(kind, label, accession) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
                    label.alias("label"), accession.alias("accession"))


def lookup_metadata(rows: DataFrame, meta: DataFrame, label: str = "label", name: str = "name") -> DataFrame:
    """Hit label to (description, clan). An unknown name keeps its row with NULLs."""
    m = meta.select(F.col(name).alias(label), "description", "clan")
    return rows.join(m, label, "left")


def labels_from_hits(hits: DataFrame, meta: DataFrame | None = None, key: str = "query") -> DataFrame:
    """Labels of informative hits: (key, source, tier, evalue, coverage, kind, label, accession).

    The source decides the kind; an undeclared source raises inside the plan. A family name
    without metadata is still emitted.
    """
    rows = lookup_metadata(hits, meta) if meta is not None else hits.withColumns(
        {"description": F.lit(None).cast("string"), "clan": F.lit(None).cast("string")})
    label, acc, cat = text_or_empty("label"), text_or_empty("target_accession"), text_or_empty("category")
    source = F.trim("source")
    # Parsed once per row, and only where a branch below asks for it.
    titled = lambda kind: bind(parse_title("label"), lambda p: F.array(_entry(
        kind, p["product"], F.when(acc != "", acc).otherwise(p["accession"]))))
    fam = lambda a, b: F.array(_entry(a, label, acc), _entry(b, cat, acc))
    unknown = F.raise_error(F.concat(F.lit("hit source not declared: "), F.coalesce(source, F.lit("NULL"))))
    entries = (
        F.when(source == "pfam", F.array(_entry("pfam_family", label, acc),
                                         _entry("pfam_description", F.coalesce("description", F.lit("")), acc),
                                         _entry("pfam_clan", F.coalesce("clan", F.lit("")), acc)))
        .when(source == "pharokka", fam("pharokka_annotation", "pharokka_category"))
        .when(source == "card", fam("card_gene_family", "card_mechanism"))
        .when(source == "vfdb", F.array(_entry("vfdb_factor", label, acc)))
        .when(source == "swissprot", titled("swissprot_product"))
        .when(source == "nr", titled("nr_product"))
        .otherwise(unknown.cast("array<struct<kind:string,label:string,accession:string>>")))
    return (rows.filter("informative").filter(label != "")
            .select(key, source.alias("source"), "tier", "evalue", "coverage",
                    F.inline(F.filter(entries, lambda x: x["label"] != ""))))


def labels_from_orthology(rows: DataFrame, key: str = "seq_id") -> DataFrame:
    """One row per controlled term: symbol, COG letters, COG ids, families, GO, EC, KO, description."""
    as_list = lambda kind, arr: F.transform(arr, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("label")))
    one = lambda kind, c: as_list(kind, F.filter(F.array(text_or_empty(c)), lambda v: v != ""))
    letters = F.filter(F.split(text_or_empty("cog_category"), ""), lambda v: v.rlike(r"^\p{L}$"))
    groups = F.filter(F.transform(comma_list("eggnog_ogs"), lambda g: F.substring_index(g, "@", 1)),
                      lambda g: g.startswith("COG"))
    entries = F.flatten(F.array(
        one("gene_symbol", "preferred_name"), as_list("cog_category", letters), as_list("cog_id", groups),
        as_list("eggnog_pfam", comma_list("pfams")), as_list("go", comma_list("gos")),
        as_list("ec", comma_list("ec")), as_list("kegg_ko", comma_list("kegg_ko")),
        one("eggnog_description", "eggnog_description")))
    return rows.select(key, F.lit("eggnog").alias("source"), F.col("orthology_source").alias("tier"), F.inline(entries))


def merge_labels(rows: DataFrame, releases: Mapping[str, tuple[str, str]], key: str = "protein_id",
                 tie: Sequence[str] = ("tier", "accession", "evidence_coverage", "via_representative"), kinds: Sequence[str] = X.KINDS) -> DataFrame:
    """One row per (entity, source, kind, label, sub_label); the best E-value gives its evidence.

    The accession is that of the best row, or of the best row that has one. An undeclared kind
    raises. ``releases`` maps a source to (database, version); it is configuration, so it
    becomes a CASE rather than a join.
    """
    for c in ("sub_label", "accession", "evidence_evalue", "evidence_coverage", "via_representative"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit("" if c == "sub_label" else None).cast("string"))
    known = F.when(F.col("kind").isin(*kinds), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("undeclared label kind "), F.col("kind"))).cast("string"))
    rank = F.struct(as_evalue("evidence_evalue").alias("_e"), *[F.col(c) for c in tie])
    acc_rank = F.when(~blank("accession"), rank)
    best = rows.withColumn("kind", known).groupBy(key, "source", "kind", "label", "sub_label").agg(
        F.min_by(F.struct("tier", "evidence_evalue", "evidence_coverage", "via_representative"), rank).alias("_w"),
        F.min_by("accession", acc_rank).alias("accession"))
    db = F.coalesce(*[F.when(F.col("source") == s, F.lit(d)) for s, (d, _) in releases.items()],
                    F.lit(None).cast("string"))
    ver = F.coalesce(*[F.when(F.col("source") == s, F.lit(v)) for s, (_, v) in releases.items()],
                     F.lit(None).cast("string"))
    return best.select(key, "source", "_w.tier", "kind", "label", "sub_label", "accession",
                       "_w.evidence_evalue", "_w.evidence_coverage", db.alias("database"),
                       ver.alias("database_version"), "_w.via_representative")


def copy_labels_to_members(rows: DataFrame, members: DataFrame, key: str = "protein_id",
                           member: str = "seq_id", rep: str = "search_representative") -> DataFrame:
    """A representative's labels repeated on its members, marked via_representative."""
    m = members.select(F.col(member).alias("_m"), F.col(rep).alias(key))
    copied = (rows.join(m, key).withColumn("via_representative", F.col(key))
              .withColumn(key, F.col("_m")).drop("_m"))
    return rows.unionByName(copied, allowMissingColumns=True)


def labels_by_type(labels: DataFrame, key: str = "seq_id", kind: str = "label_kind") -> DataFrame:
    """Per entity one column per term type holding its sorted 'source:label' list, '; '-joined."""
    term = context_term(kind, "label", "sub_label")
    typed = (labels.withColumn("_type", F.substring_index(term, ":", 1)).filter("_type IS NOT NULL")
             .select(key, "_type", F.concat_ws(":", "source", "label").alias("_v")).distinct())
    cols = [F.concat_ws("; ", F.sort_array(F.collect_list(F.when(F.col("_type") == t, F.col("_v"))))).alias(f"{t}_labels")
            for t in X.TERM_TYPES]
    return typed.groupBy(key).agg(*cols)


def stage_status(found: DataFrame, expected: DataFrame, source: str = "source", key: str = "seq_id",
                 version: str = "version", ran: str = "ran") -> DataFrame:
    """Per expected source: NOT_RUN, NO_HIT or SUCCESS, its version and how many entities it labelled."""
    n = found.groupBy(source).agg(F.count_distinct(key).alias("_n"))
    status = (F.when(~F.col(ran), X.NOT_RUN).when(F.coalesce("_n", F.lit(0)) == 0, X.NO_HIT).otherwise(X.SUCCESS))
    return expected.join(n, source, "left").select(
        source, status.alias("status"), F.when(F.col(ran), F.col(version)).alias("version"),
        F.when(F.col(ran), F.coalesce("_n", F.lit(0))).alias("n_entities"))
