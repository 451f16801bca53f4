"""Label, title, host-name and feature-text grammars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from umbral.functions import bind
from umbral.functions import fixed as X
from umbral.functions.coords import is_minus
from umbral.functions.predicates import is_informative


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def text_or_empty(c) -> Column:
    return F.coalesce(F.regexp_replace(_c(c), r"^\s+|\s+$", ""), F.lit(""))


def comma_list(c) -> Column:
    """Comma-separated field to an array of trimmed, non-blank parts; NULL gives an empty one."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def parse_title(title) -> Column:
    """Struct(accession, product, organism) of a reference protein title.

    A final ``[...]`` is the organism; a first word with a dot is the accession; in a
    ``RecName:`` title the product is the first ``Full=`` name, behind any qualifier that
    precedes ``RecName:``. Whatever matches nothing stays whole as the product.
    """
    return bind(text_or_empty(title), _title_parts)


def _title_parts(t: Column) -> Column:
    bracketed = t.rlike(r"(?s)\[.*\]$")
    organism = F.when(bracketed, F.trim(F.regexp_extract(t, r"(?s)\[([^\[]*)\]$", 1))).otherwise("")
    body = F.when(bracketed, F.trim(F.regexp_replace(t, r"(?s)\[[^\[]*\]$", ""))).otherwise(t)
    split = bind(body, lambda b: bind(F.instr(b, F.lit(" ")), lambda at: F.when(
        (at > 0) & F.substring_index(b, " ", 1).contains(".") & (F.length(b) > at),
        F.struct(F.substring_index(b, " ", 1).alias("acc"), F.trim(F.substring(b, at + 1, F.length(b))).alias("product")))
        .otherwise(F.struct(F.lit("").alias("acc"), b.alias("product")))))
    return bind(split, lambda p: F.struct(p["acc"].alias("accession"), _recommended(p["product"]).alias("product"),
                                          organism.alias("organism")))


def _recommended(product: Column) -> Column:
    """The first ``Full=`` name behind ``RecName:``, with whatever stands before it."""
    prefix = F.regexp_extract(product, r"(?s)^(.*?)RecName:", 1)
    name = bind(F.trim(F.regexp_extract(product, r"(?s)RecName:\s*([^;]*)", 1)), lambda n: F.when(
        n.startswith("Full="), F.trim(F.substring(n, F.lit(6), F.length(n)))).otherwise(n))
    return F.when(product.contains("RecName:"), F.concat(prefix, name)).otherwise(product)


def _host(species, genus) -> Column:
    lit = lambda c: c if isinstance(c, Column) else F.lit(c)
    return F.struct(lit(species).alias("species"), lit(genus).alias("genus"))


def _one_host(raw: Column) -> Column:
    return bind(F.trim(F.replace(raw, F.lit("_"), F.lit(" "))), lambda name: (
        F.when(~name.rlike("[A-Za-z]") | name.rlike(X.NOT_AN_ORGANISM), _host("", ""))
        .when(F.lower(name).contains("phytoplasma") & ~name.startswith("Candidatus"), _host("", "Candidatus Phytoplasma"))
        .otherwise(bind(F.split(name, r"\s+"), _from_words))))


def _from_words(words: Column) -> Column:
    candidatus = (words[0] == "Candidatus") & (F.size(words) > 1)
    kept = F.when(candidatus, F.slice(words, F.lit(2), F.size(words))).otherwise(words)
    prefix = F.when(candidatus, "Candidatus ").otherwise("")

    def named(w: Column) -> Column:
        second, last = F.try_element_at(w, F.lit(2)), F.try_element_at(w, F.lit(-1))
        not_genus = (~w[0].rlike(X.GENUS) | w[0].rlike(X.HIGHER_RANK) | F.coalesce(second.isin(*X.UNNAMED_MEMBER), F.lit(False))
                     | ((F.size(w) > 2) & last.isin("symbiont", "endosymbiont")))
        genus = F.concat(prefix, w[0])
        species = F.when(second.isNull() | second.isin(*X.NOT_A_SPECIES), "").otherwise(F.concat_ws(" ", genus, second))
        return F.when(not_genus, _host("", "")).otherwise(_host(species, genus))

    return bind(kept, named)


def normalise_host(name) -> Column:
    """Struct(species, genus) of a recorded host name; '' where it names none.

    Of a comma-separated list the first part that names an organism counts.
    """
    parts = F.transform(F.split(F.coalesce(_c(name), F.lit("")), ","), _one_host)
    return F.coalesce(F.try_element_at(F.filter(parts, lambda p: p["genus"] != ""), F.lit(1)), _host("", ""))


def first_source_wins(*candidates: tuple[str, Column]) -> Column:
    """Struct(species, genus, host_source) of the first source that names an organism."""
    tried = F.array(*[F.struct(F.lit(source).alias("source"), _c(name).cast("string").alias("name")) for source, name in candidates])
    found = F.transform(tried, lambda c: bind(normalise_host(c["name"]), lambda h: F.struct(
        h["species"].alias("species"), h["genus"].alias("genus"), c["source"].alias("host_source"))))
    nothing = F.struct(*[F.lit("").alias(n) for n in ("species", "genus", "host_source")])
    return F.coalesce(F.try_element_at(F.filter(found, lambda h: h["genus"] != ""), F.lit(1)), nothing)


def transfer_class(pfams, cog_id, kegg_ko, ec) -> Column:
    """ANNOTATED / UNKNOWN_ORTHOLOG / NONE from transferred orthology fields ('-' is absence)."""
    has = lambda c: F.coalesce(_c(c) != X.NO_VALUE, F.lit(False))
    named = has(pfams) & F.exists(F.split(_c(pfams), ","), is_informative)
    return (F.when(named | has(kegg_ko) | has(ec), "ANNOTATED")
            .when(has(pfams) | has(cog_id), "UNKNOWN_ORTHOLOG").otherwise("NONE"))


def first_informative_label(pfams, kegg_ko, ec) -> Column:
    """First informative family name, else the first KO, else the first EC number, else ''."""
    named = F.try_element_at(F.filter(F.split(F.coalesce(_c(pfams), F.lit("")), ","), is_informative), F.lit(1))
    head = lambda c: F.when(F.coalesce(_c(c), F.lit("")) != "", F.substring_index(_c(c), ",", 1))
    return F.coalesce(named, head(kegg_ko), head(ec), F.lit(""))


def context_term(kind, label, sub_label) -> Column:
    """'<type>:<label>' for a label kind that gives a context term, else NULL.

    An AMR element decides by the tokens of its sub-label; without a known element type the
    expression raises, because any choice would be a guess.
    """
    k, l = _c(kind), _c(label)
    fixed_prefix = F.lit(None).cast("string")
    for name, prefix in X.TERM_PREFIX.items():
        fixed_prefix = F.when(k == name, F.lit(prefix)).otherwise(fixed_prefix)
    tokens = F.split(F.upper(F.coalesce(_c(sub_label), F.lit(""))), "[^A-Z]+")
    has = lambda t: F.array_contains(tokens, t)
    element = (F.when(has("AMR"), F.concat(F.lit("amr:"), l))
               .when(has("STRESS"), F.when(has("METAL") | has("BIOCIDE"), F.concat(F.lit("metal:"), l)))
               .when(has("VIRULENCE"), F.lit(None).cast("string"))
               .otherwise(F.raise_error(F.concat(F.lit("no element type in sub_label "),
                                                 F.coalesce(_c(sub_label), F.lit("NULL")))).cast("string")))
    return (F.when(fixed_prefix.isNotNull(), F.concat(fixed_prefix, F.lit(":"), l))
            .when(k == X.LABEL_KIND["amrfinder"], element))


def system_term(prefix: str, system) -> Column:
    """'<prefix>:<last path part>' of a system model name."""
    return F.concat(F.lit(prefix + ":"), F.substring_index(_c(system), "/", -1))


# ---- feature-file text --------------------------------------------------------------------

def gff3_escape(c) -> Column:
    out = _c(c).cast("string")
    for raw, coded in X.GFF3_ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(coded))
    return out


def gff3_attributes(*pairs: tuple[str, Column]) -> Column:
    """Column nine: escaped ``key=value`` in the given order, empty values left out."""
    parts = [F.when(_c(v).isNotNull() & (_c(v).cast("string") != ""),
                    F.concat(gff3_escape(F.lit(k)), F.lit("="), gff3_escape(v))) for k, v in pairs]
    return F.concat_ws(";", *parts)


def genbank_location(start, end, strand, length, partial_begin, partial_end) -> Column:
    """A feature location; the complement wraps the whole join of an origin-spanning feature."""
    s, e = _c(start), _c(end)
    first = F.concat(F.when(_c(partial_begin), "<").otherwise(""), s.cast("string"))
    last = F.concat(F.when(_c(partial_end), ">").otherwise(""), e.cast("string"))
    span = F.when(s <= e, F.concat(first, F.lit(".."), last)).otherwise(
        F.concat(F.lit("join("), first, F.lit(".."), _c(length).cast("string"), F.lit(",1.."), last, F.lit(")")))
    return F.when(is_minus(strand), F.concat(F.lit("complement("), span, F.lit(")"))).otherwise(span)


def genbank_quote(c) -> Column:
    return F.concat(F.lit('"'), F.replace(_c(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
