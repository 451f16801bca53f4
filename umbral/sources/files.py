"""Readers. Each is one Spark scan of whole files plus column expressions; rows never pass through Python."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umbral.functions import fixed as X
from umbral.functions.predicates import absent
from umbral.functions.text import comma_list
from umbral.operators.neighbours import ordinals


# ---- sequence files -----------------------------------------------------------------------

def fasta_rows(raw: DataFrame, value: str = "value") -> DataFrame:
    """(header, body) of text already cut at every line-initial '>'."""
    v = F.regexp_replace(F.col(value), r"^>", "")
    rows = raw.filter(F.col(value).rlike(r"\S")).select(*[c for c in raw.columns if c != value],
                                                       F.regexp_extract(v, r"^([^\n]*)", 1).alias("header"),
                                                       F.regexp_replace(v, r"^[^\n]*\n?", "").alias("body"))
    return rows


def in_file_order(raw: DataFrame, name: str) -> DataFrame:
    """``raw`` as read, with ``name``: a key that sorts rows as they stand in their files.

    A task may read several splits of a file in any order, so a row number alone does not; the place
    of its split does, and within a split the number rises.
    """
    return raw.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                    F.monotonically_increasing_id().alias("row")).alias(name))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(plasmid_id, seq); gzip by suffix. The id is the header up to white space; an empty header raises."""
    raw = spark.read.text(path, lineSep="\n>")
    rows = fasta_rows(raw)
    id_ = F.regexp_extract("header", r"^\s*(\S+)", 1)
    id_ = F.when(id_ == "", F.raise_error(F.lit("empty FASTA header")).cast("string")).otherwise(id_)
    return rows.select(id_.alias("plasmid_id"), F.regexp_replace("body", r"\s", "").alias("seq"))


def read_fasta_full(spark: SparkSession, path: str) -> DataFrame:
    """(header, seq, file_order): whole header, upper-case letters, no white space, no final '*'."""
    raw = in_file_order(spark.read.text(path, lineSep="\n>"), "file_order")
    seq = F.regexp_replace(F.upper(F.regexp_replace("body", r"\s", "")), r"\*+$", "")
    return fasta_rows(raw).select(F.trim("header").alias("header"), seq.alias("seq"), "file_order")


# ---- tables -------------------------------------------------------------------------------

def read_tsv(spark: SparkSession, path, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """Headered TSV. Without a schema every column is a string; quotes are ordinary characters."""
    r = spark.read.option("sep", "\t").option("header", header).option("quote", "")
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    return r.csv(path)


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """(seq_id, orf_id): the 'entity TAB item,item' file, exploded."""
    return explode_map(spark.read.text(path))


def explode_map(raw: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    return raw.select(f[0].alias("seq_id"), F.explode(F.split(f[1], ",")).alias("orf_id"))


def read_huge_tsv(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """TSV with fields of any size. A gzip file is one split, so the rows are spread at once."""
    df = (spark.read.option("sep", "\t").option("header", True).option("quote", "")
          .option("maxCharsPerColumn", -1).csv(path))
    n = partitions or spark.sparkContext.defaultParallelism
    return df.repartition(n) if str(path).endswith(".gz") else df


def read_domtbl(spark: SparkSession, path: str) -> DataFrame:
    """Domain table: white-space columns, '#' comments, coverage from the coordinates."""
    return domtbl_hits(spark.read.text(path))


def domtbl_hits(raw: DataFrame) -> DataFrame:
    f = F.split(F.trim("value"), r"\s+")
    n = lambda i: f[i].cast("int")
    return raw.filter(~F.col("value").startswith("#") & F.col("value").rlike(r"\S")).select(
        f[0].alias("query"), f[3].alias("label"), f[4].alias("target_accession"),
        F.coalesce(F.round((n(18) - n(17) + 1) / F.nullif(n(2), F.lit(0)), 4), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.round((n(16) - n(15) + 1) / F.nullif(n(5), F.lit(0)), 4), F.lit(0.0)).alias("target_coverage"),
        f[12].alias("evalue"), f[13].alias("bitscore"), n(17).alias("start"), n(18).alias("end"),
        n(2).alias("qlen"), n(5).alias("target_length"))


#: The two tabular hit layouts.
M8_13 = ("query", "target_accession", "label", "qcov", "tcov", "evalue", "start", "end", "qlen", "identity",
         "align_length", "bitscore", "target_length")
M8_9 = ("query", "key", "pident", "qcov", "scov", "bitscore", "sstart", "send", "slen")


def read_m8(spark: SparkSession, path: str) -> DataFrame:
    """13-column tabular hits: coverages and identity as fractions."""
    return m8_hits(spark.read.text(path))


def m8_hits(raw: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    c = {name: f[i] for i, name in enumerate(M8_13)}
    pct = lambda x: F.round(x.cast("double") / 100, 4)
    return raw.filter(F.col("value").rlike(r"\S")).select(
        c["query"].alias("query"), c["label"].alias("label"), c["target_accession"].alias("target_accession"),
        pct(c["qcov"]).alias("coverage"), pct(c["tcov"]).alias("target_coverage"), c["evalue"].alias("evalue"),
        c["start"].cast("int").alias("start"), c["end"].cast("int").alias("end"), c["qlen"].cast("int").alias("qlen"),
        (c["identity"].cast("double") / 100).alias("identity"), c["align_length"].cast("int").alias("align_length"),
        c["bitscore"].alias("bitscore"), c["target_length"].cast("int").alias("target_length"))


def read_m8_subjects(spark: SparkSession, path: str) -> DataFrame:
    """9-column variant with subject coordinates (label databases)."""
    kinds = dict.fromkeys(("pident", "qcov", "scov", "bitscore"), "double") | dict.fromkeys(("sstart", "send", "slen"), "int")
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in M8_9)
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)


def unpivot_merged_hits(wide: DataFrame) -> DataFrame:
    """One wide row per query to at most three hits (phage family, AMR, virulence).

    Sentinels are absence; a family hit is recognised by an integer; of its two E-values the
    smaller present one is kept as written. No coordinates exist.
    """
    have = lambda c: ~F.coalesce(F.trim(c), F.lit("")).isin(*X.MERGED_ABSENT)
    t = lambda *cs: F.coalesce(*[F.when(F.trim(c) != "", F.trim(c)) for c in cs], F.lit(""))
    a, b = F.trim("mmseqs_eVal"), F.trim("pyhmmer_evalue")
    low = (F.when(have("mmseqs_eVal") & have("pyhmmer_evalue"), F.when(b.try_cast("double") < a.try_cast("double"), b).otherwise(a))
           .when(have("mmseqs_eVal"), a).when(have("pyhmmer_evalue"), b).otherwise(F.lit("")))
    hit = lambda src, fam, label, cat, ev: F.struct(F.lit(src).alias("source"), fam.alias("family_id"), label.alias("label"),
                                                    cat.alias("category"), ev.alias("evalue"))
    entries = F.array(
        F.when(F.trim("phrog").rlike(r"^\d+$"), hit("pharokka", F.concat(F.lit("phrog_"), F.trim("phrog")), t("annot"), t("category"), low)),
        F.when(have("CARD_hit"), hit("card", t("ARO_Accession"), t("AMR_Gene_Family", "CARD_short_name"), t("Resistance_Mechanism"), t("CARD_eVal"))),
        F.when(have("vfdb_hit"), hit("vfdb", t("vfdb_hit"), t("vfdb_description", "vfdb_short_name"), F.lit(""), t("vfdb_eVal"))))
    return wide.select(F.col("ID").alias("query"), F.col("length").cast("int").alias("query_length"),
                       F.inline(F.filter(entries, lambda x: x.isNotNull())))


def read_emapper(spark: SparkSession, path: str) -> DataFrame:
    """Orthology annotations: '##' banners skipped, header at '#query', '-' is absence, lists as arrays."""
    raw = spark.read.text(path)
    head = raw.filter(F.col("value").startswith("#query")).limit(1).collect()
    if not head:
        raise ValueError(f"{path}: no #query header")
    cols = head[0].value.lstrip("#").split("\t")
    cols[0] = "query"
    f = F.split("value", "\t")
    rows = raw.filter(~F.col("value").startswith("#") & F.col("value").rlike(r"\S"))
    # A short row lacks its last fields: they are absent, not an error.
    return emapper_records(rows.select(*[F.get(f, F.lit(i)).alias(c) for i, c in enumerate(cols)]))


def emapper_records(rows: DataFrame) -> DataFrame:
    """The declared fields of named orthology columns, with absence as NULL or an empty array."""
    one = lambda c: absent(c, X.NO_VALUE) if c in rows.columns else F.lit(None).cast("string")
    many = lambda c: comma_list(one(c))
    return rows.filter(one("query").isNotNull()).select(
        one("query").alias("query"), one("COG_category").alias("cog_category"), many("KEGG_Pathway").alias("kegg_pathways"),
        one("Preferred_name").alias("preferred_name"), one("Description").alias("description"), one("eggNOG_OGs").alias("eggnog_ogs"),
        many("PFAMs").alias("pfams"), many("GOs").alias("gos"), many("EC").alias("ec"), many("KEGG_ko").alias("kegg_ko"))


def read_commented_tsv(spark: SparkSession, path, columns: Sequence[str]) -> DataFrame:
    """Tables that open with '#' lines and blanks, over a glob; a comment-only file has no rows.

    The header repeats per file and may order its columns differently, so rows meet their own
    file's header by file name: one small row per file.
    """
    raw = in_file_order(spark.read.text(path), "_n").withColumn("_f", F.col("_n.file"))
    raw = raw.filter(~F.col("value").startswith("#") & F.col("value").rlike(r"\S"))
    head = raw.groupBy("_f").agg(F.min(F.struct("_n", "value")).alias("_h"))
    rows = raw.join(head, "_f").filter(F.col("_n") != F.col("_h._n"))
    names, vals = F.split("_h.value", "\t"), F.split("value", "\t")
    pick = lambda c: F.get(vals, (F.array_position(names, c) - 1).cast("int"))
    return rows.select(*[F.when(F.array_position(names, c) > 0, pick(c)).otherwise(F.lit("")).alias(c) for c in columns])


def component_hits(systems: DataFrame) -> DataFrame:
    """Component hits of an all-systems table: rows without a hit id are dropped."""
    return systems.filter(F.coalesce("hit_id", F.lit("")) != "").select(
        F.col("hit_id").alias("seq_id"), F.col("gene_name").alias("component"), F.col("model_fqn").alias("model"),
        F.col("hit_i_eval").alias("hit_evalue"))


def read_integrons(spark: SparkSession, path) -> DataFrame:
    """Integron elements; a row with another column count raises."""
    raw = spark.read.text(path).filter(~F.col("value").startswith("#") & F.col("value").rlike(r"\S")
                                       & ~F.col("value").startswith(X.INTEGRON_COLUMNS[0] + "\t"))
    f = F.split("value", "\t")
    n = len(X.INTEGRON_COLUMNS)
    f = F.when(F.size(f) == n, f).otherwise(F.raise_error(F.concat(
        F.lit(f"expected {n} columns, got "), F.size(f).cast("string"))).cast("array<string>"))
    r = raw.withColumn("_f", f).select(*[F.col("_f")[i].alias(c) for i, c in enumerate(X.INTEGRON_COLUMNS)])
    return r.select(F.col("ID_replicon").alias("plasmid_id"), F.col("ID_integron").alias("integron_id"), "element",
                    F.col("pos_beg").cast("int").alias("start"), F.col("pos_end").cast("int").alias("end"),
                    F.col("type").alias("integron_type"), "annotation", "type_elt")


def read_is_elements(spark: SparkSession, path) -> DataFrame:
    """Insertion elements numbered '<record>|IS<n>' in file order."""
    raw = in_file_order(read_tsv(spark, path), "_n")
    return number_elements(raw, ["_n"]).drop("_n")


def number_elements(raw: DataFrame, order: Sequence[str], record: str = "seqID") -> DataFrame:
    """Elements numbered from 1 within their record; a record of any size is numbered in bins of it."""
    numbered = ordinals(raw, record, order, "_number", None)
    return numbered.select(
        F.col(record).alias("plasmid_id"), F.concat(F.col(record).cast("string"), F.lit("|IS"), (F.col("_number") + 1).cast("string")).alias("is_id"),
        "family", "cluster", F.col("isBegin").cast("int").alias("start"), F.col("isEnd").cast("int").alias("end"),
        F.trim(F.coalesce("strand", F.lit(""))).alias("strand"), (F.col("type") == "c").cast("int").alias("complete"),
        F.col("`E-value`").alias("evalue"), F.when(F.col("tir") == "-:-", "").otherwise(F.coalesce("tir", F.lit(""))).alias("tir"),
        *[c for c in order if c.startswith("_")])


def virus_calls(summary: DataFrame, name: str = "seq_name") -> DataFrame:
    """(plasmid_id, name): the record is the call's name up to the first '|'."""
    return summary.select(F.substring_index(name, "|", 1).alias("plasmid_id"), F.col(name).alias("name"))


def hallmark_counts(genes: DataFrame, gene: str = "gene", mark: str = "virus_hallmark") -> DataFrame:
    """(plasmid_id, n): hallmark genes per record; the record is the gene name without its last '_n'."""
    rec = F.regexp_replace(F.col(gene), r"_[^_]*$", "")
    return genes.filter(F.col(mark).cast("string") == "1").groupBy(rec.alias("plasmid_id")).agg(F.count(F.lit(1)).alias("n"))


def read_edges(spark: SparkSession, path, max_distance: float = 0.05, max_pvalue: float = 1e-10) -> DataFrame:
    """(a, b) of a distance table; self pairs dropped, a malformed row raises."""
    schema = "a string, b string, distance double, pvalue double, shared string"
    d = spark.read.schema(schema).option("sep", "\t").option("mode", "FAILFAST").csv(path)
    return filter_edges(d, max_distance, max_pvalue)


def filter_edges(d: DataFrame, max_distance: float, max_pvalue: float) -> DataFrame:
    return d.filter((F.col("a") != F.col("b")) & (F.col("distance") <= max_distance) & (F.col("pvalue") <= max_pvalue)).select("a", "b")


def read_stockholm(spark: SparkSession, path) -> DataFrame:
    """(name, description, clan) of a '//'-separated family file; '' where a family has none."""
    return stockholm_records(spark.read.text(path, lineSep="//\n"))


def stockholm_records(raw: DataFrame) -> DataFrame:
    # A tag given twice in a record keeps its last value.
    tag = lambda t: F.trim(F.regexp_extract("value", rf"(?s)^(?:.*\n)?#=GF {t}\s+([^\n]+)", 1))
    return raw.select(tag("ID").alias("name"), tag("DE").alias("description"), tag("CL").alias("clan")).filter("name <> ''")


def read_models_json(spark: SparkSession, path) -> DataFrame:
    """Protein homolog models: key, subject, sequence, cut_off, labels (one per gene family)."""
    return models_from_json(spark.read.text(path, wholetext=True))


#: The nested layout of the model file.
MODEL_STRUCT = ("struct<model_type:string,model_name:string,ARO_accession:string,"
                "ARO_category:map<string,struct<category_aro_name:string,category_aro_class_name:string>>,"
                "model_sequences:struct<sequence:map<string,struct<protein_sequence:struct<sequence:string>>>>,"
                "model_param:struct<blastp_bit_score:struct<param_value:string>>>")


def models_from_json(raw: DataFrame, value: str = "value") -> DataFrame:
    """Each map entry is parsed on its own, so a bookkeeping entry of another shape does no harm."""
    m = raw.select(F.explode(F.from_json(value, "map<string,string>")).alias("key", "_j")).filter(~F.col("key").startswith("_"))
    m = m.select("key", F.from_json("_j", MODEL_STRUCT).alias("m")).filter("m.model_type = 'protein homolog model'")
    fams = F.sort_array(F.array_distinct(F.transform(F.filter(
        F.map_values("m.ARO_category"), lambda c: c["category_aro_class_name"] == "AMR Gene Family"), lambda c: c["category_aro_name"])))
    return m.select("key", F.concat(F.lit("ARO:"), "m.ARO_accession").alias("subject"),
                    F.upper(F.map_values("m.model_sequences.sequence")[0]["protein_sequence"]["sequence"]).alias("sequence"),
                    F.col("m.model_param.blastp_bit_score.param_value").cast("double").alias("cut_off"),
                    F.transform(fams, lambda f: F.struct(f.alias("label"), F.col("m.model_name").alias("sub_label"))).alias("labels"))


def read_taxdump(spark: SparkSession, names: str, nodes: str) -> tuple[DataFrame, DataFrame]:
    """(names, nodes): (taxid, name, name_class) and (taxid, parent)."""
    cut_ = lambda p: spark.read.text(p).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))
    n = cut_(names).select(F.col("f")[0].cast("bigint").alias("taxid"), F.col("f")[1].alias("name"), F.col("f")[3].alias("name_class"))
    return n, cut_(nodes).select(F.col("f")[0].cast("bigint").alias("taxid"), F.col("f")[1].cast("bigint").alias("parent"))


def element_calls(table: DataFrame, version: str | None) -> DataFrame:
    """Label rows of the AMR element table; 'NA' is absence, an unknown (type, subtype) raises."""
    v = lambda c: F.when(F.col(f"`{c}`") == "NA", F.lit(None)).otherwise(F.col(f"`{c}`"))
    pair = F.concat_ws("/", v("Type"), v("Subtype"))
    ok = pair.isin(*["/".join(p) for p in X.ELEMENT_TYPES])
    sub = F.when(ok, pair).otherwise(F.raise_error(F.concat(F.lit("unknown element type "), pair)).cast("string"))
    return table.select(v("Protein id").alias("seq_id"), F.lit("amrfinder").alias("source"), F.lit(X.LABEL_KIND["amrfinder"]).alias("label_kind"),
                        v("Element symbol").alias("label"), sub.alias("sub_label"), v("Method").alias("tier"),
                        v("% Identity to reference").alias("pident"), v("% Coverage of reference").alias("scov"),
                        v("Closest reference accession").alias("subject"), F.lit(version).cast("string").alias("database_version"))
