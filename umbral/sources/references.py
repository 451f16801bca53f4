"""Header grammars of the label reference files: header to (subject, labels)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbral.operators.graph import number_globally
from umbral.sources.files import read_fasta_full


def _label(label: Column, sub: Column) -> Column:
    return F.struct(label.alias("label"), sub.alias("sub_label"))


def _fail(message: str, header: Column, type_: str) -> Column:
    return F.raise_error(F.concat(F.lit(message + ": "), header)).cast(type_)


def _evidence(detail: Column, evidence: Column) -> Column:
    """'<detail>; evidence=<class>', or only the evidence where there is no detail."""
    return F.when(F.coalesce(detail, F.lit("")) == "", F.concat(F.lit("evidence="), evidence)).otherwise(
        F.concat(detail, F.lit("; evidence="), evidence))


def _first(h: Column) -> Column:
    return F.substring_index(h, " ", 1)


def _field(h: Column, name: str) -> Column:
    """Value of a 'name=value' token behind the first word; the last one wins; '' when absent."""
    return F.regexp_extract(h, rf"^\S+(?:.*?\s)?(?:.*\s)?{name}=(\S*)", 1)


def tadb(h: Column) -> tuple[Column, Column]:
    """'<id>|<file stem> ...' where the stem names type and role, or is 'regulator'."""
    subject, stem = F.substring_index(_first(h), "|", 1), F.substring_index(_first(h), "|", -1)
    kind, role = (F.regexp_extract(stem, r"^type_([IVX]+)_(AT|T)$", i) for i in (1, 2))
    text = (F.when(stem == "regulator", "regulator")
            .when(kind != "", F.concat_ws(" ", F.lit("type"), kind, F.when(role == "AT", "antitoxin").otherwise("toxin")))
            .otherwise(_fail("header names no type and role", h, "string")))
    return subject, F.array(_label(text, F.lit("")))


def bacmet(h: Column, compounds: Column) -> tuple[Column, Column]:
    """'<id>|<gene>|...' with its compound list: one label per compound, '[class: ...]' into the sub-label."""
    f = F.split(h, r"\|")
    subject, gene = f[0], f[1]

    def one(part: Column) -> Column:
        p = F.regexp_replace(F.trim(part), r"\.+$", "")
        name = F.trim(F.substring_index(p, "[class:", 1))
        cls = F.regexp_replace(F.regexp_extract(p, r"\[class:(.*)$", 1), r"^[ \]]+|[ \]]+$", "")
        return _label(name, F.when(cls != "", F.concat(gene, F.lit("; class="), cls)).otherwise(gene))

    out = F.sort_array(F.array_distinct(F.filter(F.transform(F.split(compounds, ", "), one), lambda x: x["label"] != "")))
    return subject, F.when(compounds.isNull(), _fail("no compounds for header", h, out_type)).otherwise(out)


out_type = "array<struct<label:string,sub_label:string>>"

#: Role per file prefix.
ORIT_ROLES = {"relaxase": "relaxase", "auxiliary": "auxiliary protein", "t4cp": "T4CP"}


def oritdb(h: Column) -> tuple[Column, Column]:
    """'<role>_<n> <entry> ... <family> id=...': the family is the token before 'id=' when it is not the entry's own name."""
    t = F.split(h, r"\s+")
    prefix = F.substring_index(t[0], "_", 1)
    role = _fail("header starts with no role", h, "string")
    for k, v in ORIT_ROLES.items():
        role = F.when(prefix == k, F.lit(v)).otherwise(role)
    own = F.slice(t, F.lit(2), F.greatest(F.size(t), F.lit(1)))
    at = F.array_position(F.transform(own, lambda x: x.startswith("id=")), True).cast("int")
    before = F.when(at > 0, at - 1).otherwise(F.size(own))
    family = F.when(before > 2, F.try_element_at(own, before)).otherwise("")
    return F.try_element_at(own, F.lit(1)), F.array(_label(role, F.when(family == "_", "").otherwise(family)))


def mobileog(h: Column) -> tuple[Column, Column]:
    """'id|name|accession|major|minor|element|evidence'."""
    f = F.split(h, r"\|")
    return f[0], F.array(_label(f[3], _evidence(F.when(f[4] == "NA", "").otherwise(f[4]), f[6])))


def dbapis(h: Column) -> tuple[Column, Column]:
    """'<accession> gene= family= evidence= ...': one label per comma-joined family."""
    gene, fam, ev = (_field(h, n) for n in ("gene", "family", "evidence"))
    detail = _evidence(F.when(gene == "NA", "").otherwise(gene), ev)
    labels = F.transform(F.split(fam, ","), lambda x: _label(x, detail))
    return _first(h), F.when((fam == "") | (ev == ""), _fail("header lacks family= or evidence=", h, out_type)).otherwise(labels)


def acrdb(h: Column) -> tuple[Column, Column]:
    """'<id> family= type= acc= evidence='."""
    fam, typ, ev = (_field(h, n) for n in ("family", "type", "evidence"))
    return _first(h), F.when((fam == "") | (ev == ""), _fail("header lacks family= or evidence=", h, out_type)).otherwise(
        F.array(_label(fam, _evidence(typ, ev))))


GRAMMARS = {"tadb": tadb, "oritdb": oritdb, "mobileog": mobileog, "dbapis": dbapis, "acrdb": acrdb}


def parse_headers(df: DataFrame, source: str, header: str = "header", compounds: DataFrame | None = None) -> DataFrame:
    """``df`` with subject and labels ARRAY<STRUCT<label, sub_label>>."""
    h = F.col(header)
    if source == "bacmet":
        c = compounds.select(F.col("BacMet_ID").alias("_id"), F.col("Compound").alias("_compound"))
        df = df.withColumn("_id", F.split(h, r"\|")[0]).join(c, "_id", "left")
        subject, labels = bacmet(h, F.col("_compound"))
        return df.withColumns({"subject": subject, "labels": labels}).drop("_id", "_compound")
    subject, labels = GRAMMARS[source](h)
    return df.withColumns({"subject": subject, "labels": labels})


def reference_entries(spark: SparkSession, source: str, path: str, compounds: DataFrame | None = None) -> DataFrame:
    """key (number in file order), subject, seq and labels of every entry of one reference file."""
    e = parse_headers(read_fasta_full(spark, path), source, compounds=compounds)
    return number_globally(e, [F.asc("file_order")], "key").drop("file_order")
