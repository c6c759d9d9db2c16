"""DuckDB SQL building blocks shared by oracle texts (independent re-statements of the
operators in plain SQL; they are never executed by Spark)."""

from taxaframe.functions.lineage import UNCLASSIFIED_LINEAGE

U = UNCLASSIFIED_LINEAGE

# Marker-tool profile -> standard long table ``std(sample, tax_id, abundance)``.
STD_MARKER = f"""
m_rows AS (
  SELECT sample, replace(clade_name,'|',';') AS tax_id, relative_abundance AS abundance FROM fx_profile_marker
   WHERE regexp_matches(clade_name,'s__|clade') AND NOT contains(clade_name,'t__')
  UNION ALL
  SELECT sample, '{U}' AS tax_id, max(CAST(trunc(relative_abundance) AS DOUBLE)) AS abundance FROM fx_profile_marker
   WHERE clade_name='UNCLASSIFIED' GROUP BY sample HAVING max(CAST(trunc(relative_abundance) AS DOUBLE)) > 0),
m_merged AS (SELECT sample, tax_id, sum(abundance) AS abundance FROM m_rows GROUP BY 1,2),
std AS (SELECT sample, tax_id, coalesce(abundance / nullif(sum(abundance) OVER (PARTITION BY sample), 0), 0) AS abundance FROM m_merged)
"""

# F5 genus extraction of a ';' lineage expression ``{x}``.
GENUS = (
    "coalesce(list_filter(list_transform(list_filter(string_split({x},';'), lambda p: starts_with(p,'g__')), "
    "lambda p: trim(replace(p,'g__',''))), lambda g: g <> '' AND g <> 'Unclassified')[1], 'Unclassified')"
)


def genus(x: str) -> str:
    return GENUS.replace("{x}", x)


def deepest_label(x: str) -> str:
    """F6 in DuckDB list functions."""
    pairs = (
        f"list_transform(list_filter(list_transform(string_split(split_part({x},'|',1),';'), lambda p: trim(p)), "
        "lambda p: instr(p,'__') > 0), lambda p: {'k': trim(split_part(p,'__',1)), 'v': trim(substr(p, instr(p,'__')+2))})"
    )
    picks = []
    for r in ["s", "g", "f", "o", "c", "p", "d"]:
        v = f"(list_filter({pairs}, lambda e: e.k = '{r}')[-1]).v"
        picks.append(f"CASE WHEN {v} IS NOT NULL AND {v} <> '' AND {v} <> 'Unclassified' THEN '{r}__' || {v} END")
    return "coalesce(" + ", ".join(picks) + ", 'd__Unclassified')"


# Mock evaluation inputs: reference genus composition ``ref(genus, reference)`` (synonyms applied),
# observed mock genera ``obs(sample, genus, abundance)`` and the table's genus universe ``uni(genus)``.
MOCK = f"""
syn AS (SELECT trim(name) AS name, max(trim(canonical_name)) AS canonical_name FROM fx_synonyms GROUP BY 1),
ref_rows AS (SELECT a.asv, a.mock_reference, coalesce(s.canonical_name, t.genus) AS genus
  FROM fx_mock_abundance a LEFT JOIN fx_mock_taxa t ON a.asv=t.asv LEFT JOIN syn s ON t.genus = s.name),
ref0 AS (SELECT genus, sum(mock_reference) AS reference FROM ref_rows WHERE genus IS NOT NULL GROUP BY 1),
ref AS (SELECT genus, coalesce(reference / nullif((SELECT sum(reference) FROM ref0),0), 0) AS reference FROM ref0),
std_g AS (SELECT s.sample, coalesce(y.canonical_name, s.g) AS genus, s.abundance
  FROM (SELECT sample, {genus('tax_id')} AS g, abundance FROM std) s LEFT JOIN syn y ON s.g = y.name),
obs0 AS (SELECT sample, genus, sum(abundance) AS abundance FROM std_g WHERE regexp_matches(sample,'Mock\\d+','i') GROUP BY 1,2),
obs AS (SELECT sample, genus, coalesce(abundance / nullif(sum(abundance) OVER (PARTITION BY sample),0),0) AS abundance FROM obs0),
uni AS (SELECT DISTINCT genus FROM std_g)
"""
