"""Lineage-string functions (native column expressions, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaframe.functions.util import as_col

# Fixed values that must equal the reference's for identical output.
UNCLASSIFIED_LINEAGE = (
    "k__Unclassified;p__Unclassified;c__Unclassified;o__Unclassified;"
    "f__Unclassified;g__Unclassified;s__Unclassified"
)
UNCLASSIFIED = "Unclassified"
# Bracken level name -> taxonomy_lvl code
LEVEL_CODES = {
    "species": "S", "genus": "G", "family": "F", "order": "O",
    "class": "C", "phylum": "P", "kingdom": "K",
}
# Rank prefixes walked (deepest first) when a display label is built; "k" is not among them.
LABEL_RANKS = ["d", "p", "c", "o", "f", "g", "s"]
# Full rank order of a lineage, shallowest first (all-rank roll-up)
LINEAGE_RANKS = ["k", "p", "c", "o", "f", "g", "s", "t"]


def lineage_sep(c) -> Column:
    """marker-tool pipe separator -> ';'."""
    return F.replace(as_col(c), F.lit("|"), F.lit(";"))


def domain_to_kingdom(c) -> Column:
    """every literal 'd__' becomes 'k__'."""
    return F.replace(as_col(c), F.lit("d__"), F.lit("k__"))


def bracken_taxid(name) -> Column:
    """'s__' + name with blanks as '_' (species prefix at every level)."""
    return F.concat(F.lit("s__"), F.replace(as_col(name), F.lit(" "), F.lit("_")))


def unknown_species(c) -> Column:
    """'s__Unknown…' up to the next ';' becomes 's__Unclassified'."""
    return F.regexp_replace(as_col(c), r"s__Unknown[^;]*", "s__Unclassified")


def genus_of(c) -> Column:
    """first usable 'g__' part of a ';' lineage, else 'Unclassified'.

    A part qualifies when it starts with 'g__' and, with every 'g__' removed and
    blanks trimmed, is neither empty nor 'Unclassified'. Null lineage -> 'Unclassified'.
    """
    parts = F.split(as_col(c), ";")
    genera = F.transform(
        F.filter(parts, lambda p: p.startswith("g__")),
        lambda p: F.trim(F.replace(p, F.lit("g__"), F.lit(""))),
    )
    usable = F.filter(genera, lambda g: (g != "") & (g != UNCLASSIFIED))
    return F.coalesce(F.try_element_at(usable, F.lit(1)), F.lit(UNCLASSIFIED))


def deepest_label(c, ranks=LABEL_RANKS) -> Column:
    """deepest classified rank as 'r__value', else 'd__Unclassified'.

    Text after the first '|' (an ASV sequence) is ignored; parts are trimmed;
    a part 'x__v' sets rank x to v, the last repeat wins.
    """
    head = F.split_part(as_col(c), F.lit("|"), F.lit(1))
    parts = F.filter(F.transform(F.split(head, ";"), lambda p: F.trim(p)), lambda p: F.instr(p, "__") > 0)
    pairs = F.transform(
        parts,
        lambda p: F.struct(
            F.trim(F.substring_index(p, "__", 1)).alias("k"),
            F.trim(p.substr(F.instr(p, "__") + 2, F.lit(1 << 30))).alias("v"),
        ),
    )
    def value_of(rank: str) -> Column:
        return F.try_element_at(F.filter(pairs, lambda e: e["k"] == F.lit(rank)), F.lit(-1))["v"]

    picks = []
    for r in reversed(ranks):
        v = value_of(r)
        picks.append(F.when(v.isNotNull() & (v != "") & (v != UNCLASSIFIED), F.concat(F.lit(f"{r}__"), v)))
    return F.coalesce(*picks, F.lit(f"{ranks[0]}__{UNCLASSIFIED}"))


def has_pipe(c) -> Column:
    """F7 (per row): the lineage carries an ASV sequence after a pipe."""
    return F.coalesce(F.contains(as_col(c), F.lit("|")), F.lit(False))


def finite_or_zero(c) -> Column:
    """null, NaN and +-inf -> 0."""
    v = as_col(c).cast("double")
    return F.when(v.isNull() | F.isnan(v) | v.isin(float("inf"), float("-inf")), F.lit(0.0)).otherwise(v)


def round2_text(c, decimals: int = 2) -> Column:
    """numbers written as plain decimals are rounded half-even; other text is kept."""
    s = as_col(c)
    return F.when(
        s.rlike(r"^-?[0-9]+(\.[0-9]+)?$"),
        F.format_string(f"%.{decimals}f", F.bround(s.cast("double"), decimals)),
    ).otherwise(s)


def kingdom_of(c) -> Column:
    """First ';' part of a lineage (the kingdom/domain token)."""
    return F.split_part(as_col(c), F.lit(";"), F.lit(1))


def lineage_prefixes(c) -> Column:
    """Every prefix of a ';' lineage: 'a;b;c' -> ['a', 'a;b', 'a;b;c']."""
    parts = F.split(as_col(c), ";")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), ";"),
    )
