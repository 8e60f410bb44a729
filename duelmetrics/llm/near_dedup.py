"""Near-duplicate detection with ProbMinHash.

Shingles of five words (of five characters in scripts that set no blanks), weighted by 1 + ln of how often a text has them, arrive in a Poisson process whose
rate is the weight; each arrival falls into one of `registers` registers, and the first one there stays. An
element is followed only until its next arrival comes later than every register's. Two texts agree in
a register with a probability equal to the probability Jaccard similarity of their weighted shingles.
A text that repeats a shingle has a second signature with all weights 1, whose registers agree with the
plain Jaccard similarity; without repetition the two are the same. Links count by either similarity, so
the bands of both signatures name buckets, in one set of names.

Bands of registers name buckets. Each member of a bucket is compared exactly with the bucket's first
document; documents of a bucket that this leaves in different classes are compared with each other in
blocks of bounded size, so that no link is lost and no bucket is held in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelmetrics.llm.common import (
    cut,
    mix64,
    normal_bytes,
    shingle_hashes,
    text_or_empty,
    word_hashes,
)

WORDS = 5
SIMILARITY = 0.8
#: 24 bands of 5 registers: a pair at similarity 0.8, weighted or plain, shares no band with probability 0.00007.
BANDS, ROWS = 24, 5
MOST_BANDS = 32
#: Standard errors below the threshold at which a register estimate rules a pair out.
MARGIN = 4.5
#: Documents of a block, and shingles that are handled in one go.
BLOCK, GROUP = 256, 300_000
_ARRIVAL = np.uint64(0xD6E8FEB86659FD93)


def _weighted(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(shingles, return_counts=True)
    return keys, 1.0 + np.log(counts)


def weighted_shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a whole text, sorted, and their weights 1 + ln(occurrences).

    The logarithm keeps a line that a text repeats many times from outweighing the rest of it.
    """
    return _weighted(shingle_hashes(word_hashes(normal_bytes(text)), words))


def probability_jaccard(a, b) -> float:
    """Exact probability Jaccard similarity of two weighted sets (sorted keys, weights); 0 if one is empty.

    The sum over common elements i of 1 / sum over j of max(a_j / a_i, b_j / b_i). Sorted by the ratio
    b/a, the elements before i count with a and the others with b.
    """
    (x, u), (y, v) = a, b
    if not len(x) or not len(y):
        return 0.0
    common, at, bt = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    p, q = u[at].astype(float), v[bt].astype(float)
    order = np.argsort(q / p, kind="stable")
    p, q = p[order], q[order]
    ratio = q / p
    only_a, only_b = u.sum() - p.sum(), v.sum() - q.sum()
    # elements of a alone have ratio 0, of b alone an infinite one; equal ratios count either way
    first = np.searchsorted(ratio, ratio, side="left")
    below = np.concatenate([[0.0], np.cumsum(p)])[first] + only_a
    above = q.sum() - np.concatenate([[0.0], np.cumsum(q)])[first] + only_b
    return float((1.0 / (below / p + above / q)).sum())


def similarity(a, b) -> float:
    """The larger of the probability Jaccard similarity and the Jaccard similarity of the plain sets."""
    common = len(np.intersect1d(a[0], b[0], assume_unique=True))
    plain = common / max(1, len(a[0]) + len(b[0]) - common)
    return max(plain, probability_jaccard(a, b))


def prob_minhash(keys: list[np.ndarray], weights: list[np.ndarray], registers: int) -> np.ndarray:
    """Signatures (one row for each non-empty weighted set): in each register the element that came first."""
    count = len(keys)
    sizes = np.array([len(k) for k in keys])
    element = np.concatenate(keys)
    rate = np.concatenate(weights).astype(float)
    doc = np.repeat(np.arange(count, dtype=np.int64), sizes)
    first = np.full(count * registers, np.inf)
    winner = np.zeros(count * registers, dtype=np.uint64)
    single = np.flatnonzero(sizes == 1)  # a lone element comes first everywhere
    if len(single):
        winner.reshape(count, registers)[single] = element[np.cumsum(sizes)[single] - 1][:, None]
        first.reshape(count, registers)[single] = 0.0
        live = sizes[doc] > 1
        element, rate, doc = element[live], rate[live], doc[live]
    clock = np.zeros(len(element))
    turn = np.uint64(0)
    while len(element):
        turn += np.uint64(1)
        with np.errstate(over="ignore"):
            drawn = mix64(element ^ (turn * _ARRIVAL))
        clock = clock - np.log1p(-(drawn >> np.uint64(11)).astype(float) * 2.0**-53) / rate
        slot = (drawn & np.uint64(2047)).astype(np.int64) * registers >> 11
        place = doc * registers + slot
        np.minimum.at(first, place, clock)
        won = first[place] == clock
        winner[place[won]] = element[won]
        latest = first.reshape(count, registers).max(axis=1)
        live = clock < latest[doc]
        element, rate, doc, clock = element[live], rate[live], doc[live], clock[live]
    return winner.reshape(count, registers)


def _bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A bucket number for each band of each signature; its low bits are the number of the band."""
    count, registers = signature.shape
    parts = signature.reshape(count, registers // rows, rows)
    total = np.broadcast_to(np.arange(registers // rows, dtype=np.uint64), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            total = mix64(total ^ parts[:, :, k])
    number = np.arange(registers // rows, dtype=np.uint64)
    return (total & ~np.uint64(MOST_BANDS - 1) | number).view(np.int64)


def _grouped_texts(texts, words: int):
    """Stretches of a batch with a bounded number of shingles: begin, end, word hashes and weighted sets."""
    at = 0
    while at < len(texts):
        begin, total, sequences, sets = at, 0, [], []
        while at < len(texts) and total < GROUP:
            hashes = word_hashes(normal_bytes(texts[at].as_py()))
            sequences.append(hashes)
            sets.append(_weighted(shingle_hashes(hashes, words)) if len(hashes) else None)
            total += len(hashes)
            at += 1
        yield begin, at, sequences, sets


def _signed(sets, registers: int) -> tuple[np.ndarray, dict[int, np.ndarray], list[int]]:
    """Signatures of the sets that aren't None, plain ones of those that repeat something, each one's row."""
    rows = [k for k, s in enumerate(sets) if s is not None]
    if not rows:
        return np.zeros((0, registers), dtype=np.uint64), {}, rows
    signature = prob_minhash([sets[k][0] for k in rows], [sets[k][1] for k in rows], registers)
    again = [n for n, k in enumerate(rows) if (sets[k][1] > 1).any()]
    if not again:
        return signature, {}, rows
    keys = [sets[rows[n]][0] for n in again]
    plain = prob_minhash(keys, [np.ones(len(k)) for k in keys], registers)
    return signature, dict(zip(again, plain)), rows


def _sign(bands: int, rows: int, words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, sequences, sets in _grouped_texts(batch.column("text"), words):
                signature, plain, owners = _signed(sets, bands * rows)
                prints: list = [None] * (end - begin)
                buckets: list = [None] * (end - begin)
                for n, (o, named) in enumerate(zip(owners, _bands(signature, rows))):
                    prints[o] = blake2b(sequences[o].tobytes(), digest_size=16).digest()
                    if n in plain:
                        named = np.union1d(named, _bands(plain[n][None], rows))
                    buckets[o] = named
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(prints, pa.binary()),
                        pa.array(buckets, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "print", "bands"],
                )

    return sign


def signatures(df: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, text_hash, print of the word sequence and the buckets of its bands."""
    if bands > MOST_BANDS:
        raise ValueError(f"at most {MOST_BANDS} bands")
    texts = df.select(
        "doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text")
    )
    id_type = df.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        _sign(bands, rows, words),
        f"doc_id {id_type}, text_hash long, print binary, bands array<bigint>",
    )


def _pack(bands: int, rows: int, words: int):
    """The registers of each text (marks; the plain ones behind them if they differ), and the text packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for begin, end, _, sets in _grouped_texts(texts, words):
                signature, plain, _ = _signed(sets, bands * rows)
                marks = [
                    m.tobytes() + (plain[n].astype(np.uint32).tobytes() if n in plain else b"")
                    for n, m in enumerate(signature.astype(np.uint32))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("print").slice(begin, end - begin),
                        pa.array(marks, pa.binary()),
                        pa.array(
                            [zlib.compress(normal_bytes(texts[k].as_py()), 1) for k in range(begin, end)],
                            pa.binary(),
                        ),
                    ],
                    names=["print", "marks", "packed"],
                )

    return pack


def _unpacked(packed: bytes, words: int) -> tuple[np.ndarray, np.ndarray]:
    return _weighted(shingle_hashes(word_hashes(zlib.decompress(packed)), words))


def _verify(threshold: float, words: int):
    """Keep the pairs whose exact similarity reaches the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = lru_cache(maxsize=64)(lambda packed: _unpacked(packed, words))
        for batch in batches:
            found = [
                similarity(_unpacked(a.as_py(), words), shingles(b.as_py())) >= threshold
                for a, b in zip(batch.column("packed"), batch.column("other"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return verify


def _registers(marks: bytes, registers: int) -> np.ndarray:
    """Weighted and plain registers, one row each."""
    own = np.frombuffer(marks, np.uint32).reshape(-1, registers)
    return own[[0, -1]]


def _cross(threshold: float, least: float, bands: int, rows: int, words: int):
    """Links between texts of different classes in one block of a bucket; one for each text and class."""

    def cross(block: pd.DataFrame) -> pd.DataFrame:
        every = block[block.role == 1].reset_index(drop=True)
        lone = block[block.role == 0].reset_index(drop=True)
        links = []
        if len(every) and len(lone):
            signs = np.stack([_registers(m, bands * rows) for m in every.marks])
            repeats = (signs[:, 0] != signs[:, 1]).any()
            band = int(block.bucket.iloc[0]) & (MOST_BANDS - 1)
            classes = every.label.map(bytes).to_numpy()
            names = every.print.map(bytes).to_numpy()
            sets: dict = {}

            def shingles(k):
                if k not in sets:
                    sets[k] = _unpacked(every.packed[k], words)
                return sets[k]

            for k in range(len(lone)):
                signed = _registers(lone.marks[k], bands * rows)
                same = signs[:, 0] == signed[0]
                near = same.mean(axis=1)
                # a pair that shares several bands is handled in the first of them
                shared = same.reshape(len(same), bands, rows).all(axis=2)
                if repeats or (signed[0] != signed[1]).any():
                    # buckets are shared by either signature, the similarities compare like with like
                    for i, j in ((0, 1), (1, 0), (1, 1)):
                        same = signs[:, i] == signed[j]
                        shared |= same.reshape(len(same), bands, rows).all(axis=2)
                    near = np.maximum(near, same.mean(axis=1))
                here = np.flatnonzero(
                    (near >= least) & shared.any(axis=1) & (shared.argmax(axis=1) == band)
                )
                own, linked = bytes(lone.label[k]), set()
                mine = None
                for j in here[np.argsort(-near[here], kind="stable")]:
                    if classes[j] == own or classes[j] in linked:
                        continue
                    mine = mine or _unpacked(lone.packed[k], words)
                    if similarity(mine, shingles(j)) >= threshold:
                        linked.add(classes[j])
                        links.append((bytes(lone.print[k]), names[j]))
        return pd.DataFrame(links, columns=["a", "b"])

    return cross


def components(links: DataFrame) -> DataFrame:
    """links: a, b. Returns node and label, the smallest node of its connected component.

    Each round takes the smallest label among the neighbours and then the label of that label, so long
    chains halve; it ends when a round changes nothing.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("label"))
    )
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("label").alias("low")
        )
        lower = labels.join(seen, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("was"), F.least("label", "low").alias("label")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = cut(
            lower.join(jump, F.col("label") == F.col("via"), "left").select(
                "node", "was", F.least("label", F.coalesce("far", "label")).alias("label")
            )
        )
        changed = not after.filter("was <> label").isEmpty()
        labels = after.select("node", "label")
        if not changed:
            return labels


def near_classes(
    df: DataFrame,
    threshold: float = SIMILARITY,
    words: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (smallest doc_id of the class), class_size, texts, kept.

    Documents are linked if the exact similarity of their word shingles (probability Jaccard of the
    weighted ones, or Jaccard of the plain sets if that is larger) is at least `threshold`; a class is a connected component of links. Texts of the same words (lower
    case, without punctuation) are one text. Texts without any word, null and empty ones included, are
    classes of their own. Texts of fewer than `words` words have one shingle, all their words. Rows
    without doc_id belong to classes like others, but name them only if no other row does. kept marks
    the representative: smallest doc_id, then smallest text_hash; rows that repeat it are marked too.
    """
    signed = cut(signatures(df, bands, rows, words))
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    # one row of each text; texts of one print have the same bands
    nodes = cut(
        signed.filter("print is not null")
        .groupBy("print")
        .agg(F.min(rep).alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    )
    # buckets and texts by number while there are many of them; a number that two prints share only
    # adds a candidate
    number = F.xxhash64("print")
    spread = nodes.select(number.alias("number"), F.explode("bands").alias("bucket"))
    shared = (
        spread.groupBy("bucket")
        .agg(F.min("number").alias("low"), F.max("number").alias("high"))
        .filter("low <> high")
        .select("bucket")
    )
    members = cut(
        spread.join(shared, "bucket").join(
            nodes.select("print", number.alias("number")), "number"
        ).select("bucket", "print")
    )
    texts = _texts(df, members, nodes)
    known = cut(
        texts.mapInArrow(_pack(bands, rows, words), "print binary, marks binary, packed binary")
    )

    pivots = members.groupBy("bucket").agg(F.min("print").alias("b"))
    pairs = (
        members.join(pivots, "bucket")
        .filter("print <> b")
        .select(F.col("print").alias("a"), "b")
        .distinct()
    )
    left = known.select(F.col("print").alias("a"), "packed")
    right = known.select(F.col("print").alias("b"), F.col("packed").alias("other"))
    links = cut(
        pairs.join(left, "a").join(right, "b").mapInArrow(_verify(threshold, words), "a binary, b binary")
    )
    labels = components(links)

    # members of one bucket in several classes: compare those outside its largest class with all
    placed = cut(
        members.join(labels.withColumnRenamed("node", "print"), "print", "left")
        .select("print", "bucket", F.coalesce("label", "print").alias("label"))
    )
    mixed = placed.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")
    ).filter("low <> high")
    by_class = placed.join(mixed.select("bucket", "size"), "bucket").groupBy("bucket", "label").agg(
        F.count("*").alias("of_class"), F.first("size").alias("size")
    )
    largest = by_class.groupBy("bucket").agg(
        F.max(F.struct("of_class", "label")).alias("top"), F.first("size").alias("size")
    ).select(
        "bucket",
        F.col("top.label").alias("top"),
        F.ceil(F.col("size") / block).cast("int").alias("blocks"),
        F.ceil((F.col("size") - F.col("top.of_class")) / block).cast("int").alias("lone_blocks"),
    )
    sized = placed.join(largest, "bucket").withColumn("lone", F.col("label") != F.col("top"))
    turn = F.xxhash64("print", "bucket")
    every = sized.select(
        "print", "bucket", "label",
        F.explode(F.sequence(F.lit(0), F.col("lone_blocks") - 1)).alias("lone_block"),
        F.pmod(turn, F.col("blocks")).cast("int").alias("block"),
        F.lit(1).alias("role"),
    )
    lone = sized.filter("lone").select(
        "print", "bucket", "label",
        F.pmod(turn, F.col("lone_blocks")).cast("int").alias("lone_block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(0).alias("role"),
    )
    least = threshold - MARGIN * (threshold * (1 - threshold) / (bands * rows)) ** 0.5
    more = cut(
        every.unionByName(lone)
        .join(known, "print")
        .groupBy("bucket", "lone_block", "block")
        .applyInPandas(_cross(threshold, least, bands, rows, words), "a binary, b binary")
    )
    if not more.isEmpty():
        # links between classes: join the classes by their labels
        flat = labels.select(F.col("node"), F.col("label"))
        named = (
            more.join(flat.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
            .join(flat.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
            .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        )
        merged = components(named)
        nodes_of = labels.select("node", "label").union(
            more.select(F.col("a").alias("node"), F.col("a").alias("label"))
            .union(more.select("b", "b"))
            .distinct()
            .join(labels.select("node"), "node", "left_anti")
        )
        labels = cut(
            nodes_of.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label"))
        )

    classed = nodes.join(labels.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "rep", "copies", F.coalesce("label", "print").alias("label")
    )
    totals = classed.groupBy("label").agg(
        F.min("rep").alias("first"), F.sum("copies").alias("class_size"), F.count("*").alias("texts")
    )
    of_text = classed.select("print", "label").join(totals, "label").select(
        "print", "first", "class_size", "texts"
    )
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    return (
        signed.select("doc_id", "text_hash", "print")
        .join(of_text, "print", "left")
        .select(
            "doc_id",
            "text_hash",
            F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
            F.coalesce("class_size", F.lit(1)).alias("class_size"),
            F.coalesce("texts", F.lit(1)).alias("texts"),
            (F.col("print").isNull() | own.eqNullSafe(F.col("first"))).alias("kept"),
        )
    )


#: What tells rows apart, in join keys that a later grouping can reuse: null ids have no name.
_ROW_KEY = ["key_hash", "key_id", "key_none"]


def _with_row_key(df: DataFrame, doc_id: str, text_hash: str) -> DataFrame:
    return df.withColumns(
        {
            "key_hash": F.col(text_hash),
            "key_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
            "key_none": F.col(doc_id).isNull(),
        }
    )


def _texts(df: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """print and text of each text that shares a bucket with another; the one shuffle of whole texts."""
    wanted = members.select("print").distinct().join(nodes.select("print", "rep"), "print")
    wanted = _with_row_key(wanted, "rep.doc_id", "rep.text_hash").select("print", *_ROW_KEY)
    rows = df.select("doc_id", text_or_empty().alias("text")).withColumn("hash", F.xxhash64("text"))
    found = _with_row_key(rows, "doc_id", "hash").join(wanted, _ROW_KEY)
    # rows that repeat the same text and id meet in one partition of the join
    return found.dropDuplicates([*_ROW_KEY, "print"]).select("print", "text")


def drop_near_copies(df: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of df, all columns, with one row of each class."""
    stays = _with_row_key(near_classes(df, threshold).filter("kept"), "doc_id", "text_hash")
    row = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    rows = df.select(row, F.col("doc_id").alias("id"), F.xxhash64(text_or_empty()).alias("hash"))
    # rows equal in id and text meet in one partition of the join; one of them stays
    same = Window.partitionBy(*_ROW_KEY).orderBy(F.lit(1))
    return (
        _with_row_key(rows, "id", "hash")
        .join(stays.select(*_ROW_KEY), _ROW_KEY, "left_semi")
        .withColumn("nth", F.row_number().over(same))
        .filter("nth = 1")
        .select("row.*")
    )
