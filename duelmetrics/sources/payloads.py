"""Landed JSON payloads to raw rows.

Fetching is someone else's job: payloads land as one JSON object per line in
``username=<u>/year=<y>/month=<m>/`` (archives) and ``username=<u>/`` (profiles
and stats). A fetch that failed leaves no file and so contributes no row.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.functions.text import last_segment
from duelmetrics.schemas import ARCHIVE, PROFILE, STATS

Paths = str | Sequence[str]
CORRUPT = "_corrupt"


def _listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def landing_order(path: Column, modified: Column) -> Column:
    """What tells which of two payloads landed later.

    First the date that a folder ``landed=<date>`` names, which a copy of the
    landing zone keeps; then when the file was written, which it may not; then
    its path.
    """
    day = F.regexp_extract(path, r"/landed=([^/]+)/", 1)
    return F.struct(day.alias("day"), modified.alias("at"), path.alias("path"))


def read_payloads(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType,
    root: str | None = None,
    strict: bool = False,
    timed: bool = False,
) -> DataFrame:
    """Payload lines with a declared schema.

    The partition columns are part of the schema, so a numeric user name stays
    text. ``paths`` may name single partition folders if ``root`` names the
    folder they lie in. A value of another type than declared reads as NULL and
    a line that is not JSON as NULLs; ``count_lines`` counts and
    ``rejected_lines`` lists both. With ``strict`` the first one ends the job.
    ``timed`` adds ``landed``, see ``landing_order``.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if root is not None:
        reader = reader.option("basePath", root)
    rows = reader.json(_listed(paths))
    if not timed:
        return rows
    order = landing_order(F.col("_metadata.file_path"), F.col("_metadata.file_modification_time"))
    return rows.withColumn("landed", order)


def read_archives(spark: SparkSession, paths: Paths, root: str | None = None) -> DataFrame:
    return read_payloads(spark, paths, ARCHIVE, root)


def with_content(profiles: DataFrame) -> DataFrame:
    """Profiles with any content; a player whose profile is empty is left out."""
    return profiles.na.drop("all", subset=[name for name in PROFILE.names if name != "username"])


def read_profiles(spark: SparkSession, paths: Paths, root: str | None = None) -> DataFrame:
    """Profiles with any content; a player whose profile is empty is left out."""
    return with_content(read_payloads(spark, paths, PROFILE, root, timed=True))


def read_stats(spark: SparkSession, paths: Paths, root: str | None = None) -> DataFrame:
    return read_payloads(spark, paths, STATS, root, timed=True)


PARTITIONS = ("username", "year", "month")


def selected(players: Sequence[str] | None, months: Sequence[str] | None, columns: Sequence[str]) -> Column:
    """Rows of the named players and months (like 2025-01), as far as the folders tell; None names all."""
    keep = F.lit(True)
    if players is not None:
        keep &= F.col("username").isin(*players)
    if months is not None and "month" in columns:
        keep &= F.concat_ws("-", "year", "month").isin(*months)
    return keep


def _lines(spark: SparkSession, paths: Paths, schema: T.StructType, keep: Column | None = None) -> DataFrame:
    """Lines that are not blank, ``rejected`` if ``schema`` cannot read them in full.

    The lines are parsed one by one: the JSON reader itself would take a line
    that starts an array for rows and not count it. ``keep`` is a condition on
    the partition columns, so folders it rules out are not read.
    """
    parsed = F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
    reader = spark.read.format("text")
    if keep is not None:
        folders = [f for f in schema.fields if f.name in PARTITIONS]
        reader = reader.schema(T.StructType([T.StructField("value", T.StringType()), *folders]))
    lines = reader.load(_listed(paths))
    lines = lines if keep is None else lines.filter(keep)
    return lines.filter(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("line"),
        parsed[CORRUPT].isNotNull().alias("rejected"),
    )


def parsed_files(spark: SparkSession, files: Sequence[str], schema: T.StructType, root: str) -> DataFrame:
    """The lines of some files below ``root``, each parsed once: content, partition columns, line, rejected, landed.

    ``line`` is there where it is ``rejected``. A value of another type than
    declared reads as NULL, a line that is not JSON as NULLs. ``landed`` is as
    in ``read_payloads``.
    """
    folders = [f for f in schema.fields if f.name in PARTITIONS]
    content = [f for f in schema.fields if f.name not in PARTITIONS]
    if not files:
        order = [("day", T.StringType()), ("at", T.TimestampType()), ("path", T.StringType())]
        landed = T.StructType([T.StructField(*f) for f in order])
        more = [("path", T.StringType()), ("line", T.StringType()), ("rejected", T.BooleanType()), ("landed", landed)]
        every = [*content, *folders, *[T.StructField(*f) for f in more]]
        return spark.createDataFrame([], T.StructType(every))
    lines = (
        spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *folders]))
        .option("basePath", root)
        .format("text")
        .load(list(files))
    )
    wanted = _with_corrupt(T.StructType(content))
    parsed = F.from_json("value", wanted, {"columnNameOfCorruptRecord": CORRUPT})
    rejected = F.col(f"parsed.{CORRUPT}").isNotNull()
    return (
        lines.filter(F.trim("value") != "")
        .withColumns({"parsed": parsed, "path": F.col("_metadata.file_path"), "at": F.col("_metadata.file_modification_time")})
        .select(
            *[F.col(f"parsed.{f.name}") for f in content],
            *[f.name for f in folders],
            "path",
            F.when(rejected, F.col("value")).alias("line"),
            rejected.alias("rejected"),
            landing_order(F.col("path"), F.col("at")).alias("landed"),
        )
    )


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified, username, year, month) of every landed file, from its folder's listing alone."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    named = {c: F.nullif(F.regexp_extract("path", f"/{c}=([^/]+)", 1), F.lit("")) for c in PARTITIONS}
    return listed.select("path", "length", F.col("modificationTime").alias("modified")).withColumns(named)


def count_lines(
    spark: SparkSession, paths: Paths, schema: T.StructType, keep: Column | None = None
) -> tuple[int, int]:
    """How many lines there are, and how many of them are rejected."""
    counts = _lines(spark, paths, schema, keep).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("rejected").alias("rejected")
    )
    row = counts.first()
    return row["lines"], row["rejected"]


def rejected_lines(
    spark: SparkSession, paths: Paths, schema: T.StructType, keep: Column | None = None
) -> DataFrame:
    """(path, line) for every line that ``schema`` cannot read in full."""
    return _lines(spark, paths, schema, keep).filter("rejected").select("path", "line")


def flatten_archives(archives: DataFrame, ingested_at: str) -> DataFrame:
    """One raw row per game, tagged with the tracked player.

    An absent or empty ``games`` array gives no row; an absent side gives NULLs.
    ``ingested_at`` is the load time of the batch as ISO text.
    """
    games = archives.select("username", F.inline("games"))
    return games.select(
        F.col("url").alias("game_url"),
        "username",
        "time_class",
        "time_control",
        "rated",
        "pgn",
        *[
            F.col(f"{side}.{field}").alias(f"{side}_{field}")
            for side in ("white", "black")
            for field in ("username", "rating", "result")
        ],
        "end_time",
        F.lit(ingested_at).alias("ingested_at"),
    )


def _newest(payloads: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One payload per player, the one landed last.

    Without a landing time, and among payloads of one file, the greatest content
    decides, so that a task that is run again chooses the same payload.
    """
    content = F.struct(*fields)
    order = F.struct("landed", content) if "landed" in payloads.columns else content
    return payloads.groupBy("username").agg(F.max_by(content, order).alias("newest"))


def flatten_players(profiles: DataFrame, stats: DataFrame, ingested_at: str) -> DataFrame:
    """One raw row per player with a profile; without stats the ratings are NULL.

    Of profiles and of stats that landed more than once the newest is taken
    before the join, so ratings may fall and a player stays one row.
    """
    formats = ("rapid", "blitz", "bullet")
    ratings = _newest(
        stats.withColumns({f: F.col(f"chess_{f}.last") for f in formats}), formats
    ).withColumnRenamed("newest", "last")
    content = [c for c in PROFILE.names if c != "username"]
    joined = _newest(profiles, content).select("username", "newest.*").join(
        ratings, "username", "left"
    )
    return joined.select(
        "username",
        "player_id",
        "title",
        "name",
        last_segment(F.col("country")).alias("country"),
        "location",
        "followers",
        F.coalesce("is_streamer", F.lit(False)).alias("is_streamer"),
        *[F.col(f"last.{f}.rating").alias(f"{f}_rating") for f in formats],
        *[F.col(f"last.{f}.rd").alias(f"{f}_games") for f in formats],
        F.lit(ingested_at).alias("ingested_at"),
    )
