"""Licence scans by canonical digests.

Texts are normalised: case, punctuation, copyright lines and equivalent spellings. The digest of a whole
normalised text, of each of its paragraphs and of each of its lines is joined with the digests of known
licence texts and notices, so what is found is equal in full, never a fragment or a resemblance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelmetrics.llm.common import text_or_empty
from duelmetrics.llm.licence_texts import known

#: Lines left out: a copyright mark behind comment marks at most.
COPYRIGHT = r"^[^\p{L}\p{N}©]*(?:copyright\b|\(c\) ?[0-9]{4}|©|all rights reserved)"
#: No copyright mark but a sentence of the terms, as line breaks place it: these words follow. Marks of a text's
#: own publisher belong to the text too.
TERMS = (
    r"^[^\p{L}\p{N}©]*copyright(?:\s*[.,;/\"”]|\s+(?:notices?|holders?|owners?|owned|laws?|licen[cs]es?|licen[cs]ing|interests?|statements?"
    r"|disclaimers?|permissions?|ownership|treat(?:y|ies)|protection|doctrines?|terms?|rights?|status|resulting|to|and|or|in|on|is|of|for|as"
    r"|by (?:applicable|the following)|infringement|works?|material|permission|year|years|line|lines|under|that|which|may|can|applies|does|the software"
    r"|law|act|legislation|related|if|the library)\b|\s*(?:\(c\)|©)?[\s0-9,-]*(?:<?year>?)?\s*(?:free software|<?name of author)|\s*(?:\(c\))?\s*$)"
)
#: Runs of anything but letters and digits.
SEPARATORS = r"[^\p{L}\p{N}]+"
# Spellings and what they are taken for, applied in this order to words between blanks.
SPELLINGS = [
    ("licences?", "license"),
    ("licenses", "license"),
    ("licenced", "licensed"),
    ("sub licens(e|ed|ing)", "sublicens\\1"),
    ("non infringement", "noninfringement"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("(?:version|v) ?([0-9]+)", "\\1"),
    ("https", "http"),
]
#: Those of several words, which a line break may part, once more when lines are joined.
PARTED = [s for s in SPELLINGS if " " in s[0]]
SCOPES = ("text", "paragraph", "line")


def _spelt(plain: Column, spellings: list[tuple[str, str]]) -> Column:
    for spelling, taken_for in spellings:
        plain = F.regexp_replace(plain, f" {spelling} ", f" {taken_for} ".replace("\\1", "$1"))
    return plain


def normal_line(line: Column) -> Column:
    """A line in canonical form; a copyright line is empty."""
    low = F.lower(line)
    plain = _spelt(F.concat(F.lit(" "), F.regexp_replace(low, SEPARATORS, " "), F.lit(" ")), SPELLINGS)
    return F.when(low.rlike(COPYRIGHT) & ~low.rlike(TERMS), F.lit("")).otherwise(
        F.regexp_replace(F.trim(plain), " +", " ")
    )


def _marked(text: Column) -> Column:
    """The normalised lines; blank lines, which end paragraphs, are line breaks."""
    blank = lambda line: F.trim(F.regexp_replace(line, r"\s+", " ")) == ""
    return F.transform(
        F.split(text, "\r?\n|\r", -1),
        lambda line: F.when(blank(line), F.lit("\n")).otherwise(normal_line(line)),
    )


def licence_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """digest and licence of known texts; texts that are equal in canonical form go to the first name."""
    rows = spark.createDataFrame(texts if texts is not None else known(), "licence string, text string")
    return (
        rows.select("licence", whole(F.col("text")).alias("canonical"))
        .filter("canonical <> ''")
        .groupBy(F.sha2(F.col("canonical").cast("binary"), 256).alias("digest"))
        .agg(F.min("licence").alias("licence"))
    )


def _squeeze(joined: Column) -> Column:
    plain = F.concat(F.lit(" "), F.regexp_replace(joined, r"[ \n]+", " "), F.lit(" "))
    return F.trim(F.regexp_replace(_spelt(plain, PARTED), " +", " "))


def whole(text: Column) -> Column:
    """A whole text in canonical form."""
    return _squeeze(F.array_join(F.transform(F.split(text, "\r?\n|\r", -1), normal_line), " "))


def scan(
    df: DataFrame,
    digests: DataFrame | None = None,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per document, scope and licence: id, scope, licence, units and first (number of the first unit).

    Scope "text" is the whole text, "paragraph" a stretch between blank lines, "line" a line; units count
    from 0. The scopes are apart: a text of one line that is a notice is found in each of them. Null texts are empty; empty units match nothing. Rows that repeat an id are counted
    together.
    """
    if digests is None:  # as many rows as licence_texts lists
        digests = F.broadcast(licence_digests(df.sparkSession))
    rows = df.select(F.col(id_column).alias("id"), text_or_empty().alias("text")).select(
        "id", _marked(F.col("text")).alias("marked")
    )
    joined = F.array_join("marked", " ")
    paragraphs = F.transform(F.split(joined, "(?: *\n *)+", -1), _squeeze)
    tagged = F.concat(
        F.array(F.struct(F.lit("text").alias("scope"), F.lit(0).alias("nth"), _squeeze(joined).alias("unit"))),
        F.transform(
            paragraphs, lambda p, k: F.struct(F.lit("paragraph").alias("scope"), k.alias("nth"), p.alias("unit"))
        ),
        F.transform(
            "marked",
            lambda x, k: F.struct(F.lit("line").alias("scope"), k.alias("nth"), _squeeze(x).alias("unit")),
        ),
    )
    found = (
        rows.select("id", F.explode(tagged).alias("u"))
        .filter("u.unit <> ''")
        .select("id", "u.scope", "u.nth", F.sha2(F.col("u.unit").cast("binary"), 256).alias("digest"))
        .join(digests, "digest")
    )
    return found.groupBy("id", "scope", "licence").agg(
        F.count("*").alias("units"), F.min("nth").cast("long").alias("first")
    )


def licences(df: DataFrame) -> DataFrame:
    """doc_id, scope, licence, units, first."""
    return scan(df).withColumnRenamed("id", "doc_id")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The scan of `documents` as SQL for comparison."""
    line = "' ' || regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', ' ', 'g') || ' '"
    for spelling, taken_for in SPELLINGS:
        line = f"regexp_replace({line}, {_quoted(f' {spelling} ')}, {_quoted(f' {taken_for} ')}, 'g')"
    normal = (
        f"CASE WHEN regexp_matches(lower(x), {_quoted(COPYRIGHT)}) AND NOT regexp_matches(lower(x), {_quoted(TERMS)}) THEN '' "
        f"ELSE regexp_replace(trim({line}), ' +', ' ', 'g') END"
    )
    joined = "' ' || regexp_replace({}, '[ \\n]+', ' ', 'g') || ' '"
    for spelling, taken_for in PARTED:
        joined = f"regexp_replace({joined}, {_quoted(f' {spelling} ')}, {_quoted(f' {taken_for} ')}, 'g')"
    squeeze = f"trim(regexp_replace({joined}, ' +', ' ', 'g'))".format
    lines = "regexp_split_to_array({}, '\\r?\\n|\\r')".format
    texts = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in known())
    return f"""
        WITH known(licence, text) AS (VALUES {texts}),
        digests AS (
            SELECT digest, min(licence) AS licence FROM (
                SELECT licence, {squeeze(f"array_to_string(list_transform({lines('text')}, lambda x: {normal}), ' ')")} AS canonical
                FROM known
            ), LATERAL (SELECT sha256(canonical) AS digest) WHERE canonical <> '' GROUP BY digest
        ), marked AS (
            SELECT doc_id, list_transform({lines("coalesce(text, '')")},
                lambda x: CASE WHEN trim(regexp_replace(x, '\\s+', ' ', 'g')) = '' THEN chr(10) ELSE {normal} END) AS marked
            FROM documents
        ), paragraphed AS (
            SELECT *, regexp_split_to_array(array_to_string(marked, ' '), '(?: *\\n *)+') AS paragraphs FROM marked
        ), units AS (
            SELECT doc_id, 'text' AS scope, 0 AS nth, {squeeze("array_to_string(marked, ' ')")} AS unit FROM marked
            UNION ALL
            SELECT doc_id, 'paragraph', nth - 1, {squeeze("paragraphs[nth]")}
            FROM paragraphed, LATERAL (SELECT unnest(range(1, len(paragraphs) + 1)) AS nth)
            UNION ALL
            SELECT doc_id, 'line', nth - 1, {squeeze("marked[nth]")}
            FROM marked, LATERAL (SELECT unnest(range(1, len(marked) + 1)) AS nth)
        )
        SELECT doc_id, scope, licence, count(*) AS units, min(nth)::BIGINT AS first
        FROM units JOIN digests ON sha256(unit) = digest
        WHERE unit <> '' GROUP BY doc_id, scope, licence
    """
