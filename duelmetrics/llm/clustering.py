"""Centroid clustering with subvector dictionaries.

Vectors are quantised to whole numbers. Each block of neighbouring dimensions of a chunk of vectors is
encoded without loss: a dictionary of its distinct subvectors, and each vector's code in it. The encoded
chunks are written once. A round computes the exact squared distances of each dictionary's entries to the
centroids once, and a vector's distance is the sum of its codes' partial distances. A dictionary covers one
chunk, as those of a columnar file cover a row group: its size is bounded whatever the vectors are, copies
of a vector cost one entry a chunk, and no vector moves between tasks. A task sends one sum for each
centroid and dimension, so a round shuffles the same for one vector or a billion.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.sources.scratch import scratch_dir

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
#: A component x becomes floor(SCALE * x).
SCALE = 256
SEED = "2"
#: Dimensions of a block, and vectors of a chunk: dictionaries hold at most CHUNK subvectors.
BLOCK = 2
CHUNK = 4_096
#: Quantised components up to this are added without overflow: 64 squares of twice it fit in a long.
LARGEST = 1 << 27


def quantised(vectors: DataFrame, column: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """Rows whose vector has exactly ``dims`` components, none null or non-finite, as whole numbers in ``q``.

    A component beyond LARGEST ends the job: its distances would not fit in a long.
    """
    given = F.col(column)
    whole = F.transform(given, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    usual = F.forall(
        given,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    fits = F.forall(given, lambda x: F.abs(x.cast("double")) * F.lit(float(scale)) < float(LARGEST))
    beyond = F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}")).cast("array<bigint>")
    return vectors.filter(given.isNotNull() & (F.size(given) == dims) & usual).withColumn(
        "q", F.when(fits, whole).otherwise(beyond)
    )


def first_centroids(kept: DataFrame, id_column: str, count: int, seed: str) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``; ties by the vector; rows without id come last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")).cast("binary"), 256)
    first = kept.select(key.alias("key"), "q").orderBy(F.col("key").asc_nulls_last(), "q").limit(count)
    return np.array([r["q"] for r in first.collect()], dtype=np.int64)


def encode_chunk(matrix: np.ndarray, block: int) -> tuple[bytes, bytes, list[int]]:
    """Codes (block x vector), the blocks' dictionaries one after the other, and their sizes."""
    codes, entries, sizes = [], [], []
    for at in range(0, matrix.shape[1], block):
        distinct, code = np.unique(matrix[:, at : at + block], axis=0, return_inverse=True)
        codes.append(code.reshape(-1).astype(np.uint16))
        entries.append(distinct.astype(np.int32).tobytes())
        sizes.append(len(distinct))
    return np.concatenate(codes).tobytes(), b"".join(entries), sizes


@dataclass
class Chunk:
    """An encoded chunk: ``codes`` (block x vector), a dictionary of subvectors for each block."""

    codes: np.ndarray
    dictionaries: list[np.ndarray]

    @staticmethod
    def read(count: int, codes: bytes, entries: bytes, sizes: list[int], dims: int, block: int) -> Chunk:
        every, at, found = np.frombuffer(entries, dtype=np.int32), 0, []
        for k, size in enumerate(sizes):
            width = min(block, dims - k * block)
            found.append(every[at : at + size * width].reshape(size, width).astype(np.int64))
            at += size * width
        return Chunk(np.frombuffer(codes, dtype=np.uint16).reshape(len(sizes), count), found)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector (ties: the smaller) and its squared distance."""
        total = np.zeros((self.codes.shape[1], len(centroids)), dtype=np.int64)
        at = 0
        for code, entries in zip(self.codes, self.dictionaries):
            part = np.zeros((len(entries), len(centroids)), dtype=np.int64)
            for k in range(entries.shape[1]):
                part += (entries[:, k, None] - centroids[None, :, at + k]) ** 2
            total += part[code]
            at += entries.shape[1]
        best = total.argmin(axis=1)
        return best, total[np.arange(len(best)), best]

    def sums(self, cluster: np.ndarray, count: int) -> np.ndarray:
        """Sum of the vectors of each cluster: entries, weighted by how often each cluster has their code."""
        columns = []
        for code, entries in zip(self.codes, self.dictionaries):
            times = np.bincount(cluster * len(entries) + code, minlength=count * len(entries))
            columns.append(times.reshape(count, len(entries)) @ entries)
        return np.concatenate(columns, axis=1)


_ENCODED = [("n", T.LongType()), ("codes", T.BinaryType()), ("entries", T.BinaryType()), ("sizes", T.ArrayType(T.IntegerType()))]


def encode(kept: DataFrame, id_column: str, dims: int, block: int, chunk: int) -> DataFrame:
    """One row a chunk: ids, n, codes, entries, sizes."""
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(kept.schema[id_column].dataType)), *[T.StructField(*f) for f in _ENCODED]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                ids, vectors = part.column(0), part.column(1)
                matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dims)
                codes, entries, sizes = encode_chunk(matrix, block)
                lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                columns = [lists, pa.array([len(ids)]), pa.array([codes]), pa.array([entries]), pa.array([sizes], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.select(id_column, "q").mapInArrow(run, schema)


def _chunks(batch: pa.RecordBatch, dims: int, block: int) -> Iterator[Chunk]:
    for n, codes, entries, sizes in zip(*(batch.column(c) for c in ("n", "codes", "entries", "sizes"))):
        yield Chunk.read(n.as_py(), codes.as_py(), entries.as_py(), sizes.as_py(), dims, block)


def next_centroids(encoded: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """One round: centroids moved to the floor of their vectors' means; those without vectors stay."""
    count, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, dims), dtype=np.int64)
        members = np.zeros(count, dtype=np.int64)
        for batch in batches:
            for piece in _chunks(batch, dims, block):
                cluster, _ = piece.nearest(centroids)
                total += piece.sums(cluster, count)
                members += np.bincount(cluster, minlength=count)
        at = np.flatnonzero(members)
        if len(at):
            table = np.column_stack([members[at], total[at]])
            rows, place = np.indices(table.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[rows.ravel()]), pa.array(place.ravel()), pa.array(table.ravel())],
                names=["cluster", "place", "total"],
            )

    parts = encoded.select("n", "codes", "entries", "sizes").mapInArrow(run, "cluster long, place long, total long")
    moved = [[int(x) for x in row] for row in centroids]
    sums: dict[int, dict[int, int]] = {}
    # at most a row for each centroid and dimension
    for cluster, place, total in parts.groupBy("cluster", "place").agg(F.sum("total")).collect():
        sums.setdefault(cluster, {})[place] = total
    for cluster, found in sums.items():
        moved[cluster] = [found[d + 1] // found[0] for d in range(dims)]
    return np.array(moved, dtype=np.int64)


def assign(encoded: DataFrame, centroids: np.ndarray, block: int, id_column: str) -> DataFrame:
    """One row per vector: its id, cluster, distance."""
    id_type = encoded.schema["ids"].dataType.elementType.simpleString()
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            for k, piece in enumerate(_chunks(batch, dims, block)):
                cluster, distance = piece.nearest(centroids)
                columns = [ids.slice(k, 1).flatten(), pa.array(cluster, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_column, "cluster", "distance"])

    return encoded.mapInArrow(run, f"`{id_column}` {id_type}, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    dims: int = DIMS,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of each vector, and the final centroids in the order of their numbers.

    vectors: an id and a vector column; other columns play no part, whatever their names. Vectors of another
    length, null, or with a null, NaN or infinite component are left out. Equal ids are rows of their own;
    a row without id is clustered, and is a first centroid only if there are too few others. Fewer vectors
    than ``count`` give as many centroids; an empty table gives no rows and no centroids.
    """
    if chunk > 1 << 16:
        raise ValueError("codes are 16 bits wide: a chunk holds at most 65,536 vectors")
    spark = vectors.sparkSession
    kept = quantised(vectors.select(id_column, column), column, dims, scale)
    centroids = first_centroids(kept, id_column, count, seed)
    if not len(centroids):
        id_type = vectors.schema[id_column].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_column}` {id_type}, cluster int, distance long"), centroids
    path = scratch_dir(spark, "vector-chunks")
    # files as large as their rows, so that a split of them, and so an Arrow batch, has a bounded size
    plain = {"compression": "none", "parquet.enable.dictionary": "false"}
    encode(kept, id_column, dims, block, chunk).write.options(**plain).parquet(path)
    encoded = spark.read.parquet(path)
    for _ in range(rounds):
        centroids = next_centroids(encoded, centroids, block)
    return assign(encoded, centroids, block, id_column), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256.

    The sums are one row per cluster, as many as there are centroids, and are joined as such.
    """
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()
    every = sum(r["total"] for r in sums)
    names = [",".join(str(int(x)) for x in row) for row in centroids]
    rows = [(r["cluster"], r["total"], every, names[r["cluster"]]) for r in sums]
    known = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid string"
    )
    return assigned.join(F.broadcast(known), "cluster").select(
        *assigned.columns, "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256")
    )


def clusters(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector.

    The assignment is computed twice from the encoded chunks rather than written: once for the sums.
    """
    assigned, centroids = cluster_vectors(vectors)
    return with_inertia(assigned, centroids)


def oracle_sql(dims: int = DIMS, count: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same in DuckDB SQL, one pair of CTEs a round."""
    place = f"range(1, {dims + 1})"
    distance = f"list_sum(list_transform({place}, lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        near{k} AS MATERIALIZED (
            SELECT * FROM (SELECT v.row, v.vec_id, v.q, c.cluster, {distance} AS distance FROM kept v CROSS JOIN centre{k} c)
            QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
        )""")
        if k < rounds:
            steps.append(f"""
        centre{k + 1} AS MATERIALIZED (
            SELECT c.cluster, coalesce(m.q, c.q) AS q FROM centre{k} c LEFT JOIN (
                SELECT cluster, list(mean ORDER BY i) AS q FROM (
                    SELECT cluster, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
                    FROM (SELECT cluster, unnest(q) AS x, unnest({place}) AS i FROM near{k}) GROUP BY cluster, i
                ) GROUP BY cluster
            ) m USING (cluster)
        )""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
            FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
        ), centre0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, q) - 1)::INTEGER AS cluster, q
            FROM kept QUALIFY cluster < {count}
        ), {",".join(steps)}
        SELECT vec_id, cluster, distance,
               sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(c.q, ',')) AS centroid_sha256
        FROM near{rounds} n JOIN centre{rounds} c USING (cluster)
    """
