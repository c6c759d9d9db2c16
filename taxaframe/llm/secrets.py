"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Patterns give candidate spans. The hash of each candidate's secret part is aggregated over
the whole corpus by distinct repositories and distinct owners: a value seen with many owners
or in many repositories is a widely copied example, one seen with a single owner is
specific to it and looks live.

Spans come from splitting a text at a pattern and summing the lengths of the parts, so they
are code points and leftmost non-overlapping. Only texts with a match take part in a shuffle.

A private key is its whole block and its value the body without line layout, so every key has a
hash of its own; a header without a body is no secret.

Null text counts as empty and has no span; null owners or repositories count as one unknown
value; repeated rows are scanned each; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaframe.llm.common import stored


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # leftmost non-overlapping matches
    value_group: int = 0  # the secret part
    least: int = 1  # matches with a shorter secret part are dropped
    fold: str | None = None  # left out of the secret part: layout that differs between copies of a value
    hints: tuple[str, ...] = ()  # a text with a match (lower-cased if the pattern begins with (?i)) holds one of these strings; none given: any text may match


BASE = (
    Kind("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, hints=("passw", "secret", "token", "apikey", "api_key")),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16, hints=("AKIA",)),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: A private key: what stands before its END line; without one, the run of base64 after the header.
_KEY = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_KEY_END = r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_KEY_BODY = rf"[^-]*+(?:-(?!----)[^-]*+)*+(?={_KEY_END})"
_KEY_LINES = r"""(?:(?:\\[nrt]|[\s"'+,>#*])*+(?:(?:Proc-Type|DEK-Info|Version|Comment):[^\n\\]*+|[A-Za-z0-9/+]{16,}+={0,2}))*+(?:(?:\\[nrt]|\s)*+[A-Za-z0-9/+]++(?:={1,2}|\z))?+"""
#: Kinds that the ownership method adds to the base ones.
MORE = (
    Kind("bearer", r"(?i)bearer\x20+([A-Za-z0-9+/_.=-]{20,})", 1, 20, hints=("bearer ",)),
    Kind("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D/:@]++:([^\x20\x09-\x0D/:@]{6,}+)@", 1, 6, hints=("://",)),
    # begins a run of its characters and gives nothing back, so that a run is read once
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 20, hints=("eyJ",)),
    Kind("prefixed", r"(?:gh[pousr]_|sk_live_|xox[abprs]-)[A-Za-z0-9-]{16,}", 0, 20, hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk_live_", "xox")),
    Kind("private_key", f"{_KEY}({_KEY_BODY}|{_KEY_LINES})(?:{_KEY_END})?+", 1, 1, fold=r"""\\[nrt]|[\s"',]""", hints=("-----BEGIN ",)),
)


def _holds(strings: tuple[str, ...]):
    return lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(s)) for s in strings])


def _any_match(text: Column, kinds: tuple[Kind, ...]) -> Column:
    """Whether a text holds a match of any kind. Strings that a match needs are looked for first, as that costs far less than a pattern."""
    out = F.lit(False)
    for k in kinds:
        hint = F.lit(True)
        if k.hints:
            holds = _holds(k.hints)
            # an array of one keeps the lower-cased text, which is made once
            hint = F.exists(F.array(F.lower(text)), holds) if k.pattern.startswith("(?i)") else holds(text)
        out |= hint & text.rlike(k.pattern)
    return F.coalesce(out, F.lit(False))


def _found(text: Column, kind: Kind) -> Column:
    """Array of (before, length, value): gap before each match, the match and its secret part."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value_group)) if kind.value_group else whole
    if kind.fold:
        value = F.transform(value, lambda v: F.regexp_replace(v, kind.fold, ""))
    gaps = F.split(text, kind.pattern, -1)
    return F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda x: F.struct(F.length(x["gap"]).alias("before"), F.length(x["whole"]).alias("size"), x["value"].alias("value")),
    )


def _numbered(matches: Column, kind: Kind, rank: int) -> Column:
    named = lambda m, i: F.struct(F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), F.lit(kind.least).alias("least"), i.alias("i"), m.alias("m"))
    return F.transform(matches, named)


def _spans(docs: DataFrame, kinds: tuple[Kind, ...], id_col: str, text_col: str, owner: Column | None, repository: Column | None) -> DataFrame:
    """One row per match of any kind, stored; a row without a kind for texts that have none.
    ``ok`` is false for matches whose secret part is too short."""
    own = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("t"),
        F.xxhash64(text_col).alias("key"),
        F.coalesce((F.lit("") if owner is None else owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce((F.lit("") if repository is None else repository).cast("string"), F.lit("")).alias("repository"),
    )
    per_kind = F.flatten(F.array(*[_numbered(_found(F.col("t"), k), k, r) for r, k in enumerate(kinds)]))
    spans = own.select("row", "doc_id", "key", "owner", "repository", F.explode_outer(F.when(_any_match(F.col("t"), kinds), per_kind)).alias("s"))
    upto = Window.partitionBy("row", "s.rank").orderBy("s.i")
    end = F.sum(F.col("s.m.before") + F.col("s.m.size")).over(upto)
    return stored(
        spans.select("row", "doc_id", "key", "owner", "repository", "s", end.alias("end")).select(
            "row", "doc_id", "key", "owner", "repository", F.col("s.kind").alias("kind"), F.col("s.rank").alias("rank"),
            (F.col("end") - F.col("s.m.size")).alias("start"), "end", F.sha2(F.col("s.m.value"), 256).alias("value_hash"),
            F.coalesce(F.length("s.m.value") >= F.col("s.least"), F.lit(False)).alias("ok"),
        ),
        "spans",
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """Per value_hash the distinct owners and repositories over the whole corpus. Repeats are
    folded before the shuffle, so a value in a third of all rows costs one row per task."""
    pairs = candidates.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    # a repository belongs to its owner: equal names under two owners are two repositories
    return owners.groupBy("value_hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"), F.sum("n").alias("uses"))


def find_secrets(
    docs: DataFrame,
    kinds: tuple[Kind, ...] = BASE + MORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    example_owners: int = 3,
    example_repositories: int = 5,
) -> DataFrame:
    """One row per span: row (a number of the input row), doc_id, kind, rank (place of the kind),
    key (hash of the text), start, end (code points, end exclusive), value_hash, owners, repositories, uses, class.

    ``class`` is 'example' for values of at least ``example_owners`` owners or
    ``example_repositories`` repositories, else 'live'. Rows with ``ok`` false are no spans:
    they stand for dropped matches and for documents without a match.
    """
    spans = _spans(docs, kinds, id_col, text_col, owner, repository)
    stats = ownership(spans.filter("ok"))
    example = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    # rows without a span get keys of their own, so that they spread over the tasks of the join
    key = F.when(F.col("ok"), F.col("value_hash")).otherwise(F.concat(F.lit("-"), F.col("row").cast("string")))
    return (
        spans.withColumn("value_hash", key)
        .join(stats, "value_hash", "left")
        .withColumn("class", F.when(F.col("ok"), F.when(example, "example").otherwise("live")))
    )


def scan_documents(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + MORE, **columns) -> DataFrame:
    """One row per document: counts and spans of its secrets, and how many are live or examples."""
    found = find_secrets(docs, kinds=kinds, **columns)
    ok, base = F.col("ok"), F.col("ok") & (F.col("rank") < len(BASE))
    span = F.struct("start", "rank", F.concat_ws(":", "kind", "start", "end").alias("text"))
    per_doc = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count(F.when(ok & (F.col("kind") == k.name), 1)).alias(f"n_{k.name}") for k in BASE],
        F.array_sort(F.collect_list(F.when(base, span))).alias("base"),
        F.array_sort(F.collect_list(F.when(ok, span))).alias("all"),
        F.count(F.when(F.col("class") == "live", 1)).alias("n_live"),
        F.count(F.when(F.col("class") == "example", 1)).alias("n_example"),
    )
    joined = lambda c: F.concat_ws(",", F.col(f"{c}.text"))
    return per_doc.select("doc_id", *[f"n_{k.name}" for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"), "n_live", "n_example")


def redact(docs: DataFrame, mark: str = "[secret]", kinds: tuple[Kind, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """``docs`` (all rows and columns) with live-looking spans replaced by ``mark``; a column n_chars
    follows the new text. Only texts with a match are shuffled."""
    found = find_secrets(docs, kinds=kinds, id_col=id_col, text_col=text_col, **columns)
    live = found.filter("class = 'live'").groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    text = F.col(text_col)
    any_of = _any_match(text, kinds)
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    step = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(F.concat(acc["out"], part(acc["at"], s["start"]), F.lit(mark)).alias("out"), s["end"].alias("at"))).otherwise(
        F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))
    )
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rebuilt = F.aggregate("__spans", zero, step, lambda acc: F.concat(acc["out"], part(acc["at"], F.length(text).cast("long"))))
    touched = docs.filter(any_of).withColumn("__key", F.xxhash64(text))
    touched = touched.join(live.withColumnRenamed("__key", "__key2"), touched[id_col].eqNullSafe(live["__id"]) & (touched["__key"] == F.col("__key2")), "left")
    touched = touched.withColumn(text_col, F.when(F.col("__spans").isNull(), text).otherwise(rebuilt))
    if "n_chars" in docs.columns:
        touched = touched.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length(text_col).cast(docs.schema["n_chars"].dataType)))
    return docs.filter(~any_of).unionByName(touched.select(docs.columns))
