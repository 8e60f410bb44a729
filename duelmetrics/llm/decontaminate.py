"""Benchmark decontamination with SimHash windows.

Every benchmark item gets a window size by its length, and SimHash fingerprints of all its windows of
that size. Documents are cut into windows of the same sizes at a fixed step; blocks of the fingerprint
bits index the items' fingerprints, so every pair within the Hamming radius shares a block and is found.
A found window aligns the item with the document, where the exact similarity of their weighted word
shingles decides. The item index is broadcast in slices of bounded size, each a pass of its own; nothing
of the documents is shuffled.

Why a window is always found: an item of n shingles reaches similarity s only if at most
k = n (1 - s) / (1 + s) shingles are missing, and a changed word inside the item costs five of them. So
the longest unchanged run of its words has a known least length, and the window size is chosen such that
every unchanged run of that length holds a whole window of the document, at distance 0. Words inserted or
deleted before it move the start by k at most, so all starts within k are compared.

Items of two to four words are one shingle of all their words, as in `near_dedup`. Within prose such a
run is no evidence, so they are found where they are all the words of a line; items of one word where
they are all the words of a document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.llm.common import (
    normal_bytes,
    shingle_hashes,
    span_hashes,
    text_or_empty,
    word_hashes,
    word_spans,
)

WORDS = 5
SIMILARITY = 0.8
#: Hamming radius; the 64 bits are cut into one block more than that.
RADIUS = 3
#: Words of benchmark items in one slice of the index (about 100 bytes of index a word).
SLICE_WORDS = 1_000_000
#: Words of a document whose bit sums are held at once.
STRETCH = 32_768
#: Words by which an aligned item may be shifted in the exact comparison, whatever its length.
SHIFT = 2


def most_missing(shingles: int, similarity: float = SIMILARITY) -> int:
    """Shingles of an item that a passage of the similarity may lack."""
    return floor(shingles * (1 - similarity) / (1 + similarity) + 1e-9)


def window_size(length: int, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[int, int]:
    """Window size and step for an item of so many words; sizes form a coarse scale."""
    missing = most_missing(length - words + 1, similarity)
    inner = missing // words  # words that may be changed inside the item
    run = max((length - missing) if not inner else (length - missing % words - inner) // (inner + 1), words)
    best = (words, 1)
    size = words
    while size + max(1, size // 4) - 1 <= run:
        best = (size, max(1, size // 4))
        size += max(1, size // 4)
    return best


def bit_sums(shingles: np.ndarray, most: int) -> np.ndarray:
    """Running sums of each of the 64 hash bits, for windows of at most `most` shingles.

    Sums of eight bits share a number, a byte each. They overflow into each other, but the difference of
    two numbers is that of the sums, byte by byte, if no window counts more than a byte holds.
    """
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)
    bits = bits.view(np.uint64) if most < 256 else bits.astype(np.int32)
    sums = np.zeros((len(bits) + 1, bits.shape[1]), dtype=bits.dtype)
    np.cumsum(bits, axis=0, out=sums[1:])
    return sums


def simhashes(sums: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of `size` neighbouring shingles from each start; a shingle weighs as often as it occurs."""
    votes = sums[starts + size] - sums[starts]
    if votes.dtype == np.uint64:
        votes = votes.view(np.uint8)
    return np.packbits(votes >= (size + 1) // 2, axis=1).view(np.uint64).ravel()


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger counts of two lists of shingles."""
    x, u = np.unique(a, return_counts=True)
    y, v = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = np.minimum(u[i], v[j]).sum()
    return float(shared / (len(a) + len(b) - shared)) if len(a) + len(b) else 0.0


def shifted_jaccard(have: np.ndarray, wanted: np.ndarray, first: int, last: int) -> np.ndarray:
    """weighted_jaccard of wanted and as many shingles of `have` from each start of first to last.

    An occurrence counts for the starts from which it isn't preceded by as many as wanted has.
    """
    size = len(wanted)
    low, high = max(0, first), max(0, min(len(have), last + size))
    keys, counts = np.unique(wanted, return_counts=True)
    kind = np.minimum(np.searchsorted(keys, have[low:high]), len(keys) - 1)
    place = np.flatnonzero(keys[kind] == have[low:high])
    place = place[np.argsort(kind[place], kind="stable")]
    kind = kind[place]
    before = np.arange(len(place)) - counts[kind]  # the occurrence that fills the count, if of this kind
    full = (before >= 0) & (kind[np.maximum(before, 0)] == kind)
    place = place + low
    begin = np.maximum(np.where(full, place[np.maximum(before, 0)], first - 1), place - size) + 1
    change = np.zeros(last - first + 2, dtype=np.int64)
    end = np.minimum(place, last)
    begin = np.maximum(begin, first)
    some = begin <= end
    np.add.at(change, begin[some] - first, 1)
    np.add.at(change, end[some] + 1 - first, -1)
    shared = np.cumsum(change)[:-1]
    starts = np.arange(first, last + 1)
    held = np.maximum(0, np.minimum(len(have), starts + size) - np.maximum(0, starts))
    return shared / (held + size - shared)


def run_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The one shingle of `size` words, fewer than five, from each start."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    return shingle_hashes(words, size)[starts]


class ItemIndex:
    """Fingerprints of the windows of items, found by block, and the shingles of short items."""

    def __init__(self, items, radius: int, words: int, similarity: float):
        self.words, self.similarity, self.radius = words, similarity, radius
        self.items = []
        self.short: dict = {}  # number of words -> shingle -> items
        prints: dict = defaultdict(list)
        for item_id, text in items:
            hashes = word_hashes(normal_bytes(text))
            if len(hashes) < words:
                if len(hashes):
                    one = shingle_hashes(hashes, words)
                    self.short.setdefault(len(hashes), {}).setdefault(int(one[0]), []).append(len(self.items))
                    self.items.append((item_id, one))
                continue
            shingles = shingle_hashes(hashes, words)
            size, step = window_size(len(hashes), words, similarity)
            span = size - words + 1
            offsets = np.arange(len(shingles) - span + 1)
            prints[size, step].append((len(self.items), offsets, simhashes(bit_sums(shingles, span), span, offsets)))
            self.items.append((item_id, shingles))
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [
            (np.uint64(int(a)), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges, edges[1:])
        ]
        self.classes = []
        for (size, step), found in sorted(prints.items()):
            fingers = np.concatenate([f for _, _, f in found])
            owner = np.concatenate([np.full(len(o), i) for i, o, _ in found])
            offset = np.concatenate([o for _, o, _ in found])
            tables = []
            for shift, mask in self.blocks:
                value = (fingers >> shift & mask).astype(np.int64)
                order = np.argsort(value, kind="stable")
                first = np.searchsorted(value[order], np.arange(int(mask) + 2))
                tables.append((order, first))
            self.classes.append((size, step, fingers, owner, offset, tables))

    def short_matches(self, codes, starts, hashes) -> dict[int, list[tuple[int, int, float]]]:
        """Short item -> places, given a text's bytes as numbers and the starts and hashes of its words."""
        found: dict = defaultdict(list)
        if not len(hashes):
            return found
        line = np.searchsorted(np.flatnonzero(codes == 10), starts)
        firsts = np.flatnonzero(np.diff(line, prepend=-1))
        counts = np.diff(firsts, append=len(line))
        for size, known in self.short.items():
            whole = firsts[counts == size] if size > 1 else np.zeros(int(len(hashes) == 1), dtype=np.int64)
            for at, one in zip(whole.tolist(), run_hashes(hashes, whole, size).tolist()):
                for item in known.get(one, ()):
                    found[item].append((at, size - self.words + 1, 1.0))
        return found

    def aligned(self, texts: list[np.ndarray]) -> dict[int, set[tuple[int, int]]]:
        """text -> (item, start) for each window of a text within the radius of an item's window."""
        found: dict = defaultdict(set)
        overlap = 2 * max((size for size, *_ in self.classes), default=0)
        pieces = [  # long texts in pieces that overlap by more than a window
            (k, begin, shingles[begin : begin + STRETCH + overlap])
            for k, shingles in enumerate(texts)
            for begin in range(0, max(1, len(shingles) - overlap), STRETCH)
        ]
        at = 0
        while at < len(pieces):
            group, total = [], 0
            while at < len(pieces) and (not group or total + len(pieces[at][2]) <= 2 * STRETCH):
                group.append(pieces[at])
                total += len(pieces[at][2])
                at += 1
            self._search(group, found)
        return found

    def _search(self, group, found) -> None:
        owners = np.array([k for k, _, _ in group])
        begins = np.array([b for _, b, _ in group])
        lengths = np.array([len(s) for _, _, s in group])
        firsts = np.cumsum(lengths) - lengths
        most = max(size - self.words + 1 for size, *_ in self.classes)
        sums = bit_sums(np.concatenate([s for _, _, s in group]), most)
        for size, step, fingers, owner, offset, tables in self.classes:
            span = size - self.words + 1
            windows = np.maximum(0, (lengths - span) // step + 1)
            windows[lengths < span] = 0
            if not windows.any():
                continue
            piece = np.repeat(np.arange(len(group)), windows)
            inner = (np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)) * step
            starts = firsts[piece] + inner
            own = simhashes(sums, span, starts)
            for (shift, mask), (order, first) in zip(self.blocks, tables):
                value = (own >> shift & mask).astype(np.int64)
                low = first[value]
                count = first[value + 1] - low
                hits = int(count.sum())
                if not hits:
                    continue
                window = np.repeat(np.arange(len(own)), count)
                entry = order[
                    np.arange(hits) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                ]
                near = np.bitwise_count(own[window] ^ fingers[entry]) <= self.radius
                window, entry = window[near], entry[near]
                place = begins[piece[window]] + inner[window] - offset[entry]
                for k, item, start in zip(
                    owners[piece[window]].tolist(), owner[entry].tolist(), place.tolist()
                ):
                    found[k].add((item, start))

    def matches(self, shingles: np.ndarray, aligned) -> dict[int, list[tuple[int, int, float]]]:
        """item -> places (first shingle, shingles, similarity) that reach the threshold, by start."""
        found = defaultdict(dict)
        for item, start in aligned:
            wanted = self.items[item][1]
            reach = max(SHIFT, most_missing(len(wanted), self.similarity))
            scores = shifted_jaccard(shingles, wanted, start - reach, start + reach)
            moved = np.flatnonzero(scores == scores.max()) - reach
            best = int(moved[np.abs(moved).argmin()])  # the nearest, of two the first
            if scores[best + reach] >= self.similarity:
                found[item][max(0, start + best)] = float(scores[best + reach])
        return {
            item: [(at, len(self.items[item][1]), score) for at, score in sorted(places.items())]
            for item, places in found.items()
        }


def _search(known: ItemIndex, texts) -> Iterator[tuple[int, int, list]]:
    """(row, item, places) for each text of a batch and item that it holds."""
    at = 0
    while at < len(texts):
        begin, some, total, short = at, [], 0, {}
        while at < len(texts) and total < 8 * STRETCH:
            codes, starts, ends = word_spans(normal_bytes(texts[at].as_py()))
            hashes = span_hashes(codes, starts, ends)
            if known.short:
                short[len(some)] = known.short_matches(codes, starts, hashes)
            enough = len(hashes) >= known.words
            some.append(shingle_hashes(hashes, known.words) if enough else hashes[:0])
            total += len(some[-1])
            at += 1
        aligned = known.aligned(some) if known.classes else {}
        for k in sorted(aligned.keys() | short.keys()):
            places = known.matches(some[k], aligned[k]) if k in aligned else {}
            for item, found in sorted({**places, **short.get(k, {})}.items()):
                yield begin + k, item, found


def _find(index, names: list[str]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: ItemIndex = index.value
        for batch in batches:
            rows = []
            for k, item, places in _search(known, batch.column("text")):
                score, first, count = max((p[2], -p[0], p[1]) for p in places)
                end = -first + count + known.words - 1
                rows.append((k, known.items[item][0], score, -first, end, [p[0] for p in places]))
            if not rows:
                continue
            k, items, scores, firsts, ends, starts = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(k)),
                    pa.array(items),
                    pa.array(scores, pa.float64()),
                    pa.array(firsts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array(starts, pa.list_(pa.int64())),
                ],
                names=names,
            )

    return find


def _clean(index):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.ones(batch.num_rows, dtype=bool)
            for k, _, _ in _search(index.value, batch.column("row").field("text")):
                stays[k] = False
            yield batch.filter(pa.array(stays))

    return clean


def _slices(benchmark: DataFrame, slice_words: int) -> list[DataFrame]:
    """The items in slices of a bounded number of words (one longer item is a slice of its own size).

    A word is put at four characters, and a character of three bytes, as scripts without blanks have, at one.
    """
    items = benchmark.select("item_id", text_or_empty().alias("text"))
    length = F.length("text")
    total = items.agg(F.sum(length + 2 * (F.octet_length("text") - length)).alias("n")).first()["n"] or 0
    count = max(1, -(-int(total) // (slice_words * 4)))
    if count == 1:
        return [items]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [items.filter(part == k) for k in range(count)]


def _indexes(benchmark: DataFrame, radius: int, words: int, similarity: float, slice_words: int):
    """A broadcast index of each slice; a slice has a bounded number of words, whatever the benchmark's size."""
    context = benchmark.sparkSession.sparkContext
    for part in _slices(benchmark, slice_words):
        items = sorted((r.item_id, r.text) for r in part.filter("item_id is not null").collect())
        yield context.broadcast(ItemIndex(items, radius, words, similarity))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: list[str] | None = None,
    radius: int = RADIUS,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """Documents that hold a benchmark item: one row per document row and item.

    Returns the struct `row` (the key columns of docs, default doc_id), item_id, similarity and first
    and last word (exclusive) of its best place, and starts, the first words of all its places.
    Similarity is the weighted Jaccard of five-word shingles (lower case, punctuation apart) between
    the item and as many words of the document; in scripts without blanks each character counts as a word.
    Items of two to four words match lines of just these words, items of one word documents of just this
    word, with similarity 1; items and documents without words match nothing. Null is empty, items without
    item_id are left out. Repeated rows and
    repeated items give repeated results; of equal places the first is the best. The whole text of every document is searched.
    """
    key = key or ["doc_id"]
    rows = docs.select(F.struct(*[F.col(c) for c in key]).alias("row"), text_or_empty().alias("text"))
    id_type = benchmark.schema["item_id"].dataType
    schema = T.StructType(
        [
            T.StructField("row", rows.schema["row"].dataType),
            T.StructField("item_id", id_type),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("end_word", T.LongType()),
            T.StructField("starts", T.ArrayType(T.LongType())),
        ]
    )
    result = None
    for index in _indexes(benchmark, radius, words, similarity, slice_words):
        found = rows.mapInArrow(_find(index, schema.names), schema)
        result = found if result is None else result.union(found)
    return result


def leaked_spans(text: str | None, first_word: int, end_word: int) -> str:
    """The words of a place in their normal form, for reports."""
    data = normal_bytes(text)
    _, starts, ends = word_spans(data)
    stop = min(end_word, len(ends))
    return data[starts[first_word] : ends[stop - 1]].decode("utf-8", "replace") if stop > first_word else ""


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item: doc_id, item_id, similarity, first_word, end_word, starts."""
    return find_leaks(docs, benchmark).select(
        "row.doc_id", "item_id", "similarity", "first_word", "end_word", "starts"
    )


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    radius: int = RADIUS,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item; each row is judged by its own text."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    for index in _indexes(benchmark, radius, words, similarity, slice_words):
        rows = rows.mapInArrow(_clean(index), rows.schema)
    return rows.select("row.*")
