"""Exact deduplication by content sort.

Sampled splitters range-partition the rows by their normalised bytes, an external sort places equal
texts side by side, and each row is compared in full with its neighbour. The identifier takes part in
the splitters, so a text that a third of all rows share is spread over many partitions; what such a
text loses at the partition borders is put together from the first and last run of each partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.llm.common import cut, text_or_empty

#: Bytes of the text that take part in the splitters, so that samples stay small; a digest of the whole
#: text and the identifier follow, and equality is always decided on whole texts.
HEAD_BYTES = 16


def _runs(firsts_only: bool):
    """Mark the runs of equal neighbours in a sorted partition."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the open run, without its text
        last_text, seen_run, opened = None, False, False
        run_rows = 0

        def close(parts: list[pa.RecordBatch], rows: int, edge: bool):
            first_id = parts[0].column("id")[0]
            for k, part in enumerate(parts):
                n = part.num_rows
                first = np.zeros(n, dtype=bool)
                first[0] = k == 0
                yield _with(part, pa.array([first_id.as_py()] * n, first_id.type), [rows] * n, first, [edge] * n)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            text = batch.column("text")
            rest = batch.drop_columns(["text"])
            new = np.ones(n, dtype=bool)
            new[1:] = ~pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
            new[0] = not opened or text[0].as_py() != last_text
            last_text, opened = text[n - 1].as_py(), True
            starts = np.flatnonzero(new)
            if not len(starts):
                run_rows += n
                if not firsts_only:
                    held.append(rest)
                continue
            if held:
                run_rows += int(starts[0])
                if starts[0] and not firsts_only:
                    held.append(rest.slice(0, int(starts[0])))
                yield from close(held, run_rows, edge=not seen_run)
                seen_run = True
            begin, end = int(starts[0]), int(starts[-1])
            if end > begin:
                bounds = starts - begin
                sizes = np.diff(bounds)
                inner = rest.slice(begin, end - begin)
                lead = np.repeat(bounds[:-1], sizes)
                first = np.zeros(end - begin, dtype=bool)
                first[bounds[:-1]] = True
                edge = np.zeros(end - begin, dtype=bool)
                if not seen_run:
                    edge[: sizes[0]] = True
                out = _with(inner, inner.column("id").take(pa.array(lead)), np.repeat(sizes, sizes), first, edge)
                yield out.filter(pa.array(first)) if firsts_only else out
                seen_run = True
            held, run_rows = [rest.slice(end, 1 if firsts_only else n - end)], n - end
        if held:
            yield from close(held, run_rows, edge=True)

    return mark


def _with(part: pa.RecordBatch, lead: pa.Array, size, first, edge) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*part.columns, lead, pa.array(size, pa.int64()), pa.array(first), pa.array(edge)],
        names=[*part.schema.names, "lead", "size", "first", "edge"],
    )


def content_sort(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
    carry: Sequence[str] = (),
    kept_only: bool = False,
) -> DataFrame:
    """Groups of equal normalised texts.

    Returns per row: id, sha256 of the normalised text, keep_id, group_size, kept and the struct `row`
    with the `carry` columns. `keep` is "smallest" or "largest" identifier. Null texts count as empty;
    empty texts equal each other. Among rows equal in text and identifier exactly one is kept. A null
    identifier is kept only if its group has no other. `kept_only` leaves the dropped rows out (their
    texts need not be buffered then). Other columns of `df` play no part, whatever their names are.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    text = text_or_empty(text_column)
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    # the text itself travels once: where it is carried as it is, only its nullness comes along
    twice = normalise is None and text_column in carry
    carried = [
        F.col(c).isNull().alias(c) if twice and c == text_column else F.col(c) for c in carry
    ]
    rows = df.select(
        F.col(id_column).alias("id"),
        text.alias("text"),
        (F.struct(*carried) if carried else F.struct(F.lit(True).alias("none"))).alias("row"),
    ).withColumn("sha256", F.sha2(F.col("text").cast("binary"), 256))
    by_id = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    head = F.substring(F.col("text").cast("binary"), 1, HEAD_BYTES)
    placed = (
        rows.repartitionByRange(head, F.col("sha256"), by_id)
        .sortWithinPartitions(head, F.col("sha256"), F.col("text"), by_id)
    )
    if twice:
        placed = placed.withColumn("copy", F.col("text"))
    kept_columns = [f for f in placed.schema.fields if f.name != "text"]
    schema = T.StructType(
        [
            *kept_columns,
            T.StructField("lead", rows.schema["id"].dataType),
            T.StructField("size", T.LongType()),
            T.StructField("first", T.BooleanType()),
            T.StructField("edge", T.BooleanType()),
        ]
    )
    local = cut(placed.mapInArrow(_runs(kept_only), schema))
    best = F.max("lead") if keep == "largest" else F.min("lead")
    # at most two runs of each partition: a broadcast whose size the number of partitions bounds
    borders = (
        local.filter("edge and first")
        .groupBy(F.col("sha256").alias("border_sha"))
        .agg(best.alias("border_lead"), F.sum("size").alias("border_size"))
    )
    at_border = F.col("edge") & F.col("border_size").isNotNull()
    joined = local.join(F.broadcast(borders), F.col("sha256") == F.col("border_sha"), "left")
    keep_id = F.when(at_border, F.col("border_lead")).otherwise(F.col("lead"))
    result = joined.select(
        "id",
        "sha256",
        keep_id.alias("keep_id"),
        F.when(at_border, F.col("border_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("first") & F.col("lead").eqNullSafe(keep_id)).alias("kept"),
        (
            F.struct(
                *[
                    F.when(~F.col("row")[c], F.col("copy")).alias(c)
                    if twice and c == text_column
                    else F.col("row")[c].alias(c)
                    for c in carry
                ]
            )
            if carry
            else F.lit(None)
        ).alias("row"),
    )
    return result.filter("kept") if kept_only else result


def exact_groups(df: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return content_sort(df, keep=keep).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("sha256").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of df, all columns, with one row of each group of equal texts."""
    return content_sort(df, keep=keep, carry=df.columns, kept_only=True).select("row.*")
