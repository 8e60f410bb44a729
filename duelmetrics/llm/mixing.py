"""Mixing sources to target weights by weighted fair queueing, DataFrame functions only.

Every document queues behind the documents of its source in a shuffled order; a source's queue is
served twice at most. A document's virtual finish time is the number of words its source has sent by
then, divided by the source's weight. All sends of all sources are range-sorted by finish time and the
queue is cut at the moment at which the total budget is spent: totals per range tell the range in which
that is, a running sum within it tells where. What has finished by then is taken whole, the document of
each source that is in service at that moment in part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelmetrics.llm.common import cut, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
#: Documents per slice of a source's queue; slices are summed side by side.
SLICE_ROWS = 20_000
#: Bits of the order columns; the leading bits of the first name the slice.
ORDER_BITS = 60
#: The first order column of all rows without doc_id; the second column cuts their slice.
UNNAMED_ORDER = int(hashlib.md5(b"mix:null").hexdigest()[: ORDER_BITS // 4], 16)
#: Share of the budget by which sums of floats may be off.
ROUNDING = 1e-9


def word_count(column: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.regexp_count(text_or_empty(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def digest_number(column: Column) -> Column:
    """The first 60 bits of the MD5 of a text, as a number that other SQL engines can compute too."""
    digits = F.substring(F.md5(column.cast("binary")), 1, ORDER_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def shuffled_order() -> list[Column]:
    """The default order of a queue: by a digest of doc_id, then of the text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return [
        digest_number(F.concat(F.lit("mix:"), doc_id)),
        digest_number(text_or_empty("text")),
    ]


def source_targets(
    totals: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """totals: source, total (one row each). Adds weight, target and the level of virtual time.

    Sources take the weights in code-point order, null last, starting again after the last weight.
    A source is full when it has sent `repeats` times its size; what it can't take goes to the others
    by weight. Sorted by the time at which they fill, the first source that isn't full yet gives the
    level. The windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    room = totals.withColumn("weight", weight).withColumn("room", (F.col("total") * repeats).cast("double"))
    filled = room.withColumn("fills", F.col("room") / F.col("weight"))
    by_fill = Window.orderBy("fills", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("total").over(every) * float(share) - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    return (
        filled.withColumn("open", level)
        .withColumn(
            "level",
            F.coalesce(
                F.min_by("open", F.when(F.col("open") <= F.col("fills"), F.col("fills"))).over(every),
                F.max("fills").over(every),
            ),
        )
        .withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("room")))
        .select("source", "total", "weight", "level", "target")
    )


#: A slice of a queue, in keys without null.
_QUEUE = ["queue_name", "queue_unnamed", "slice", "cell"]


def _with_queue(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {
            "queue_name": F.coalesce(F.col(source).cast("string"), F.lit("")),
            "queue_unnamed": F.col(source).isNull(),
        }
    )


def _with_slice(df: DataFrame, bits: int) -> DataFrame:
    """Adds slice and cell, which follow the queue's order; rows without doc_id spread over 2^bits cells."""
    shift, order = ORDER_BITS - bits, F.col("order0")
    cell = F.lit(-1)
    if "order1" in df.columns:
        cell = (
            F.when(order < UNNAMED_ORDER, F.lit(-1))
            .when(order > UNNAMED_ORDER, F.lit(1 << bits))
            .otherwise(F.shiftright("order1", shift))
        )
    return df.withColumns({"slice": F.shiftright("order0", shift), "cell": cell.cast("long")})


def _with_sent(df: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds total, weight and target of the source, and sent: its words up to and with this row.

    The running sums and the join with the slices' starts share one shuffle of the rows.
    """
    within = (
        Window.partitionBy(*_QUEUE)
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _with_queue(df, "source")
        .withColumn("sent", F.sum("size").over(within))
        .join(starts, _QUEUE)
        .withColumn("sent", F.col("start") + F.col("sent"))
    )


def sends(queued: DataFrame, repeats: int) -> DataFrame:
    """The global queue, range-sorted: finish and part (number of the range) of each send of a document.

    The last send of a source also carries the source's weight and all the words it can send, which are
    0 elsewhere. Documents without words are never sent.
    """
    last = (F.col("sent") == F.col("total")) & (F.col("copy") == repeats - 1)
    return (
        queued.filter("size > 0")
        .withColumn("copy", F.explode(F.array(*[F.lit(k).cast("long") for k in range(repeats)])))
        .select(
            ((F.col("sent") + F.col("copy") * F.col("total")) / F.col("weight")).alias("finish"),
            "order0",
            F.when(last, F.col("weight")).otherwise(0.0).alias("closes"),
            F.when(last, F.col("total") * repeats).otherwise(0).cast("long").alias("closed_words"),
        )
        .repartitionByRange("finish", "order0")
        .sortWithinPartitions("finish", "order0")
        .withColumn("part", F.spark_partition_id())
    )


def spent_at(queue: DataFrame, budget: float, weight: float) -> float:
    """The virtual time at which the sources have sent `budget` words, from the sorted queue.

    weight: of all sources. Until a source's last send the sources together send as many words per unit
    of time as their weights add up to; the words of a source that has closed are known. So the words sent
    by the end of a range follow from running sums over the ranges (a row each), and within the range in
    which the budget is spent from running sums over its rows. The driver sees two ranges and the time. A
    budget above all that can be sent is spent at the last finish; an empty queue gives 0.
    """
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        queue.groupBy("part")
        .agg(F.max("finish").alias("finish"), F.sum("closes").alias("w"), F.sum("closed_words").alias("n"))
        .withColumns({"closes": F.sum("w").over(so_far), "words": F.sum("n").over(so_far)})
        .withColumn("spent", F.col("words") + F.col("finish") * (F.lit(weight) - F.col("closes")))
    )
    # floats may place a budget that ends with a range on either side of its end
    near = ranges.filter(F.col("spent") >= budget * (1 - ROUNDING)).orderBy("part").limit(2).collect()
    if near:
        before = Window.partitionBy("part").orderBy("finish", "order0").rowsBetween(
            Window.unboundedPreceding, -1
        )
        first = {r["part"]: (r["closes"] - r["w"], r["words"] - r["n"]) for r in near}
        closes, words = (
            F.coalesce(*[F.when(F.col("part") == p, F.lit(v[k])) for p, v in first.items()])
            + F.coalesce(F.sum(c).over(before), F.lit(0))
            for k, c in enumerate(("closes", "closed_words"))
        )
        found = (
            queue.filter(F.col("part").isin(list(first)))
            .withColumn("moment", (F.lit(float(budget)) - words) / (F.lit(weight) - closes))
            .filter("moment <= finish")
            .agg(F.min(F.struct("finish", "order0", "moment")).alias("first"))
            .first()["first"]
        )
        if found is not None:
            return found["moment"]
    return queue.agg(F.max("finish")).first()[0] or 0.0


def mix(
    df: DataFrame,
    source_column: str = "source",
    size: Column | None = None,
    order_by: Sequence[Column] | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Each row of df with its part in the mix: struct `row` (all columns of df) and mix columns.

    size: words (default: of `text`, null counts 0). order_by: shuffled order, default by digests of
    doc_id and text; the first column holds evenly spread numbers of 60 bits. Adds size, source_size,
    target, finish (virtual time at which the first copy has been sent) and taken (words of all copies).
    Rows are range-sorted by finish. Null sources form one source of their own; sizes of 0 are never
    taken; an empty table gives an empty mix. Rows equal in every order column may change places, which
    changes no count of theirs in total; only such rows (without doc_id and of one text, or repeating
    both) can't be spread over slices.
    """
    order_by = order_by or shuffled_order()
    rows = df.select(
        F.struct(*[F.col(c) for c in df.columns]).alias("row"),
        F.col(source_column).alias("source"),
        (word_count() if size is None else size).alias("size"),
        *[c.alias(f"order{k}") for k, c in enumerate(order_by)],
    )
    keys = [f"order{k}" for k in range(len(order_by))]
    narrow = cut(rows.drop("row"))
    counted = cut(
        _with_slice(narrow, 8).groupBy("source", "slice", "cell")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    )
    totals = counted.groupBy("source").agg(F.sum("words").alias("total"))
    targets = cut(source_targets(totals, weights, share, repeats))
    # slices of a queue: more of them for larger sources, each a range of the shuffled order
    largest = counted.agg(F.max("rows")).first()[0] or 0
    bits = min(24, 8 + max(0, (int(largest) // slice_rows).bit_length()))
    sums = (
        counted
        if bits == 8
        else _with_slice(narrow, bits).groupBy("source", "slice", "cell").agg(F.sum("size").alias("words"))
    )
    earlier = (
        Window.partitionBy("source")
        .orderBy("slice", "cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(
        targets.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))
    )
    starts = cut(_with_queue(starts, "source").select(*_QUEUE, "start", "total", "weight", "target"))
    queue = cut(sends(_with_sent(_with_slice(narrow, bits), starts, keys), repeats))
    whole = targets.agg(F.sum("total").alias("words"), F.sum("weight").alias("weight")).first()
    moment = spent_at(queue, (whole["words"] or 0) * float(share), whole["weight"] or 0.0)
    # words of the source that are sent by then; a send is taken as far as it lies before
    words = F.round(F.least(F.col("weight") * moment, (F.col("total") * repeats).cast("double"))).cast("long")
    taken = sum(
        (
            F.greatest(
                F.lit(0),
                F.least(
                    F.col("size"), words - (F.col("sent") - F.col("size")) - F.col("total") * copy
                ),
            )
            for copy in range(repeats)
        ),
        F.lit(0),
    )
    served = _with_sent(_with_slice(rows, bits), starts, keys).select(
        "row",
        "size",
        F.col("total").alias("source_size"),
        "target",
        taken.cast("long").alias("taken"),
        (F.col("sent") / F.col("weight")).alias("finish"),
        *keys,
    )
    return (
        served.repartitionByRange("finish", *keys)
        .sortWithinPartitions("finish", *keys)
        .drop(*keys)
    )


def mix_counts(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, finish."""
    narrow = df.select(
        "doc_id",
        F.col("source"),
        word_count().alias("size"),
        *[c.alias(f"key{k}") for k, c in enumerate(shuffled_order())],
    )
    mixed = mix(cut(narrow), size=F.col("size"), order_by=[F.col("key0"), F.col("key1")])
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "finish"
    )


def take_mix(df: DataFrame) -> DataFrame:
    """The documents that the mix takes, with all their columns and size, source_size, target, taken, finish.

    An added column whose name a document's column has (in any case) gets as many `mix_` before it as needed.
    """
    mixed = mix(df).filter("taken > 0")
    used = {c.lower() for c in df.columns}
    names = {}
    for c in ("size", "source_size", "target", "taken", "finish"):
        name = c
        while name in used:
            name = f"mix_{name}"
        used.add(name)
        names[c] = name
    return mixed.select(
        *[F.col("row")[c].alias(c) for c in df.columns],
        *[F.col(c).alias(name) for c, name in names.items()],
    )
