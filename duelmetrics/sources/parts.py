"""Tables in parts: an upsert by key that rewrites only the parts its keys fall into.

A part is a hash bucket of the key, or a value of a column such as a month. A
version's log entry lists the folders of all parts; a load writes new folders
for the parts it touches and names the others' folders again, so parts that no
key of it falls into are neither read nor written. The commit is that of
``sources.tables``: one entry, whole or absent, for all parts of a load.
"""

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.operators.latest import latest_per_key
from duelmetrics.sources.scratch import scratch_dir
from duelmetrics.sources.tables import Version, _filesystem, commit, current_version

PART = "part"
#: What became of a row in the load that wrote its folder: stayed as it was, came with it, or was replaced by it.
STAYED, CAME, WENT = "stayed", "came", "went"
BUCKETS = 64


def bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def part_of(folder: str) -> str:
    return folder.rsplit(f"{PART}=", 1)[1]


def read_folders(spark: SparkSession, path: str, folders: Iterable[str], schema: T.StructType) -> DataFrame:
    """The rows of some folders of the table, in the order of the schema's columns."""
    named = [f"{path}/{f}" for f in folders]
    return spark.read.schema(schema).parquet(*named) if named else spark.createDataFrame([], schema)


def read_parts(spark: SparkSession, path: str, schema: T.StructType, parts: Iterable[str] | None = None) -> DataFrame:
    """The current rows, of some parts or of all; a table that was never written has none."""
    version = current_version(spark, path)
    chosen = None if parts is None else set(parts)
    folders = [f for f in (version.folders if version else []) if chosen is None or part_of(f) in chosen]
    return read_folders(spark, path, folders, schema)


def written_folders(spark: SparkSession, path: str, folder: str) -> list[str]:
    """The part folders below ``folder`` of the table; empty if nothing was written."""
    fs, make = _filesystem(spark, path)
    found = fs.globStatus(make(f"{path}/{folder}/{PART}=*")) or []
    return sorted(f"{folder}/{s.getPath().getName()}" for s in found)


def distinct_parts(rows: DataFrame) -> list[str]:
    """The parts that occur: at most as many as the table has buckets or months."""
    return sorted(r[PART] for r in rows.select(PART).distinct().collect())


def change_parts(
    spark: SparkSession,
    path: str,
    since: Version | None,
    replaced: Iterable[str],
    folders: Sequence[str],
    note: str = "",
) -> Version:
    """Commit ``folders`` in place of all folders of the replaced parts, and beside those of the others."""
    gone = set(replaced)
    kept = [f for f in (since.folders if since else []) if part_of(f) not in gone]
    return commit(spark, path, [*kept, *folders], since, note)


def upsert(
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    newest: Sequence[str],
    tiebreak: Sequence[str] = (),
    buckets: int = BUCKETS,
    cluster_by: Sequence[str] = (),
) -> Version | None:
    """Put rows into a table that holds one row per key, the latest; None if there were no rows.

    Latest means as in ``latest_per_key``, over the table's row and the load's.
    The load is made unique first, with a group limit below its shuffle, so a key
    that a third of its rows share costs one row per task; what is shuffled then
    has at most two rows per key. The number of buckets must stay what it was when
    the table was first written. ``changes`` tells what the load did.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    since = current_version(spark, path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    staged = scratch_dir(spark, "load")
    latest_per_key(rows, keys, newest, tiebreak).withColumn(PART, bucket(keys, buckets)).write.parquet(staged)
    load = spark.read.parquet(staged)
    touched = distinct_parts(load)
    if not touched:
        return None
    before = [f for f in (since.folders if since else []) if part_of(f) in set(touched)]
    old = read_folders(spark, path, before, schema).withColumn(PART, bucket(keys, buckets)).withColumn("_new", F.lit(False))
    both = old.unionByName(load.withColumn("_new", F.lit(True))).repartition(PART)
    order = [*[F.col(c).desc_nulls_last() for c in newest], *[F.col(c).asc_nulls_first() for c in tiebreak], F.col("_new")]
    same = Window.partitionBy(PART, *keys)
    ranked = both.withColumns(
        {"_rank": F.row_number().over(same.orderBy(*order)), "_came": F.max("_new").over(same)}
    )
    kind = F.when(F.col("_rank") == 1, F.when(F.col("_new"), CAME).otherwise(STAYED)).when(~F.col("_new"), WENT)
    name = f"version-{uuid.uuid4().hex}"
    (
        ranked.withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .select("kind", *schema.names, PART)
        .sortWithinPartitions("kind", PART, *cluster_by)
        .write.partitionBy("kind", PART)
        .parquet(f"{path}/{name}")
    )
    folders = [f for k in (STAYED, CAME) for f in written_folders(spark, path, f"{name}/kind={k}")]
    version = change_parts(spark, path, since, touched, folders, note=name)
    _forget(spark, path, {name, since.note if since else ""})
    return version


def _forget(spark: SparkSession, path: str, kept: set[str]) -> None:
    """Remove the replaced rows of loads before the kept ones."""
    fs, make = _filesystem(spark, path)
    for status in fs.globStatus(make(f"{path}/version-*/kind={WENT}")) or []:
        if status.getPath().getParent().getName() not in kept:
            fs.delete(status.getPath(), True)


def write_parts(rows: DataFrame, path: str) -> list[str]:
    """Write rows with a column ``part`` to a new folder of the table, not yet part of it; its part folders.

    The rebalance hint gathers a part's rows into few files and splits large parts.
    """
    name = f"version-{uuid.uuid4().hex}"
    rows.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{path}/{name}")
    return written_folders(rows.sparkSession, path, name)


def append_parts(rows: DataFrame, path: str) -> Version:
    """Add rows with a column ``part`` to the table; nothing of it is read or written again."""
    spark, path = rows.sparkSession, path.rstrip("/")
    return change_parts(spark, path, current_version(spark, path), [], write_parts(rows, path))


def changes(spark: SparkSession, path: str, version: Version, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows that came with the load of this version, and those it replaced."""
    return tuple(
        read_folders(spark, path, written_folders(spark, path, f"{version.note}/kind={kind}"), schema)
        for kind in (CAME, WENT)
    )
