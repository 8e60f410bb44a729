"""Quality rules: base counts, and tokeniser fertility in bands per language or script.

Public vocabularies encode every word of each text. A vocabulary made for ordinary text takes a narrow range of
characters per token, needs few byte tokens and spreads its tokens evenly; junk, encoded data and text of
another language do not. Three measures a vocabulary (logarithm of the characters per token, share of tokens
that hold bytes rather than whole characters, entropy of the tokens against the largest that so many tokens
can have) are compared with the band of their group: the document's language, or the script of its letters
where it has none, and the power of two of its words, because entropy falls with length (of words, not tokens: junk
that takes many tokens is held against ordinary texts of as many words). A band reaches
WIDTH times the distance between the quartiles beyond them, over the group's distinct texts that pass the
base rules. Quartiles come from exact counts per step of a thousandth, so they are the same in every run and
merge before they shuffle.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.llm.common import text_or_empty
from duelmetrics.sources.scratch import scratch_dir

#: Vocabulary files that the driver reads: ranks of a byte-level BPE, and a BPE with byte fallback.
VOCABULARIES = ("/opt/tokenizers/byte_bpe_multi_50k.tiktoken", "/opt/tokenizers/piece_bpe_32k.model")
#: How byte-level vocabularies cut a text into pieces (the public pattern of their tokenizer).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer words are encoded in stretches of so many characters.
STRETCH = 1_000
#: Texts are taken together until they have so many characters; a longer text is taken alone.
TOGETHER = 2_000_000
#: Bands: distance between the quartiles that counts at least, by measure, and how often it fits beyond them.
MEASURES = {"fertility": 0.25, "bytes": 0.02, "entropy": 0.05}
WIDTH = 3.0
#: Measures are counted in steps of 1 / STEPS.
STEPS = 1_000

_WORD = re.compile(r"[^ \t-\r]+")
_BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Base rules: least words, and most words in repeated windows of 100.
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Gives the token ids of each word of a list.
Encoder = Callable[[list[str]], list[list[int]]]


class Words:
    """The words of a few texts, numbered alike where they are equal: ``ids`` and, for each, its text in ``owner``."""

    def __init__(self, texts: Sequence[str]):
        known: dict[str, int] = {}
        found = []
        for text in texts:
            found.append(np.array([known.setdefault(w, len(known)) for w in _WORD.findall(text)], dtype=np.int64))
        self.distinct = list(known)
        self.lengths = np.fromiter(map(len, self.distinct), np.int64, len(known))
        self.texts = len(texts)
        self.owner = np.repeat(np.arange(len(texts)), [len(x) for x in found])
        self.ids = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def per_text(self, values: np.ndarray | None = None) -> np.ndarray:
        """How many words each text has, or the sum of their values."""
        return np.bincount(self.owner, values, minlength=self.texts).astype(np.int64)

    def repeated(self, window: int = WINDOW) -> np.ndarray:
        """Words of each text inside windows of ``window`` words that occur twice or more in it.

        Runs of 1, 2, 4 and 8 words are numbered, equal ones alike: a run's number stands for the pair of its halves.
        """
        inside = np.zeros(len(self.ids), dtype=np.int64)
        run, size = self.ids, 1
        while size < window and len(run) > size:
            pair = run[: len(run) - size] * (int(run.max()) + 1) + run[size:]
            _, run = np.unique(pair, return_inverse=True)
            size *= 2
        if size == window:
            starts = np.flatnonzero(self.owner[: len(run)] == self.owner[window - 1 :])
            if len(starts):
                own = self.owner[starts] * (int(run.max()) + 1) + run[starts]
                _, kind, times = np.unique(own, return_inverse=True, return_counts=True)
                again = starts[times[kind] > 1]
                edge = np.zeros(len(self.ids) + 1, dtype=np.int64)
                edge[again] += 1
                edge[again + window] -= 1
                inside = (np.cumsum(edge)[:-1] > 0).astype(np.int64)
        return self.per_text(inside)


def line_counts(text: str) -> tuple[int, int]:
    """n_symbols and n_dup_lines of a whole text."""
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


@lru_cache(maxsize=1 << 16)
def _script_of(letter: str) -> str:
    """The first word of a letter's Unicode name, such as LATIN or HIRAGANA."""
    return unicodedata.name(letter, "OTHER").split(" ")[0].split("-")[0]


def script(text: str) -> str:
    """The script of most of the letters, the first by name among equals; empty without letters."""
    if text.isascii():
        return "LATIN" if any(map(str.isalpha, text)) else ""
    codes, times = np.unique(np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32), return_counts=True)
    found: dict[str, int] = {}
    for code, n in zip(codes.tolist(), times.tolist()):
        if chr(code).isalpha():
            name = _script_of(chr(code))
            found[name] = found.get(name, 0) + n
    return min(found, key=lambda name: (-found[name], name), default="")


def _whole_characters(piece: bytes) -> bool:
    try:
        piece.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def load_vocabulary(name: str, content: bytes) -> tuple[Encoder, np.ndarray]:
    """Encoder of a vocabulary file, and for each id whether it stands for bytes rather than characters."""
    if name.endswith(".tiktoken"):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        partial = np.zeros(max(ranks.values()) + 1, dtype=bool)
        partial[[rank for piece, rank in ranks.items() if not _whole_characters(piece)]] = True
        return lambda words: [encoding.encode_ordinary(" " + w) for w in words], partial
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=content)
        partial = np.array([pieces.IsByte(k) or pieces.IsUnknown(k) for k in range(len(pieces))])
        return lambda words: pieces.encode(words, num_threads=1), partial
    raise ValueError(f"not a known kind of vocabulary: {name}")


def _tokens_of(words: Sequence[str], encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words, one after the other, and how many each has; very long words go in stretches."""
    found = encoder([w.encode("utf-8", "replace").decode("utf-8") if len(w) <= STRETCH else "" for w in words])
    for k, word in enumerate(words):
        if len(word) > STRETCH:
            clean = word.encode("utf-8", "replace").decode("utf-8")
            parts = encoder([clean[at : at + STRETCH] for at in range(0, len(clean), STRETCH)])
            found[k] = [token for part in parts for token in part]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((t for tokens in found for t in tokens), np.int64, int(sizes.sum())), sizes


def fertility(words: Words, encoder: Encoder, partial: np.ndarray) -> list[np.ndarray]:
    """Tokens of each text and its three measures; a text without tokens has 0, 0, 0, 1.

    A word that occurs often in these texts is encoded once, with the blank before it.
    """
    flat, sizes = _tokens_of(words.distinct, encoder)
    firsts = np.cumsum(sizes) - sizes
    length = sizes[words.ids]
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length - firsts[words.ids], length)
    key, times = np.unique(np.repeat(words.owner, length) * len(partial) + flat[at], return_counts=True)
    owner, token = key // len(partial), key % len(partial)
    total = words.per_text(length)
    some = np.maximum(total, 1)
    p = times / some[owner]
    entropy = -np.bincount(owner, p * np.log2(p), minlength=words.texts)
    most = np.log2(np.minimum(some, len(partial)))
    chars = words.per_text(words.lengths[words.ids])
    return [
        total,
        np.where(total > 0, np.log2(np.maximum(chars, 1) / some), 0.0),
        np.bincount(owner, times * partial[token], minlength=words.texts) / some,
        np.where(total > 1, entropy / np.where(most > 0, most, 1.0), 1.0),
    ]


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure_names(count: int) -> list[str]:
    return [f"{measure}_{k}" for k in range(count) for measure in MEASURES]


def _groups(texts: Iterator[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def measure_texts(texts: Sequence[str], vocabularies: Sequence[tuple[Encoder, np.ndarray]]) -> list:
    """Columns script, the base counts, tokens of the first vocabulary and the measures of each."""
    words = Words(texts)
    lines = [line_counts(t) for t in texts]
    base = [words.per_text(), words.per_text(words.lengths[words.ids]), *zip(*lines), words.repeated()]
    found = [fertility(words, *v) for v in vocabularies]
    tokens = found[0][0] if found else np.zeros(len(texts), dtype=np.int64)
    return [[script(t) for t in texts], *base, tokens, *(m for one in found for m in one[1:])]


def measured(docs: DataFrame, vocabularies: Sequence[str] = VOCABULARIES) -> DataFrame:
    """One row per document: doc_id, lang, script, text_hash, the base counts, tokens and measures of each vocabulary.

    Null text counts as empty. The vocabularies' files, of a few MB, are read by the driver and sent to all.
    """
    files = []
    for name in vocabularies:
        with open(name, "rb") as file:
            files.append((name, file.read()))
    sent = docs.sparkSession.sparkContext.broadcast(files)
    names = _measure_names(len(files))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang", T.StringType()),
            T.StructField("text_hash", T.LongType()),
            T.StructField("script", T.StringType()),
            *[T.StructField(c, T.LongType()) for c in _BASE],
            T.StructField("tokens", T.LongType()),
            *[T.StructField(c, T.DoubleType()) for c in names],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = [load_vocabulary(*file) for file in sent.value]
        kinds = [pa.string(), *[pa.int64()] * (len(_BASE) + 1), *[pa.float64()] * len(names)]
        for batch in batches:
            at = 0
            for group in _groups(text.as_py() for text in batch.column("text")):
                columns = [pa.array(c, t) for c, t in zip(measure_texts(group, loaded), kinds)]
                own = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([*(own.column(k) for k in range(3)), *columns], names=schema.names)
                at += len(group)

    text = text_or_empty()
    return docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    ).mapInArrow(run, schema)


def base_failed() -> Column:
    words = F.col("n_words")
    return (words < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > words * MOST_REPEATED)


def _group() -> list[Column]:
    """Language, or script where there is none, and the power of two of the words."""
    language = F.when(F.trim(F.col("lang")) != "", F.concat(F.lit("lang:"), "lang"))
    size = F.when(F.col("n_words") > 0, F.floor(F.log2("n_words"))).otherwise(-1)
    return [F.coalesce(language, F.concat(F.lit("script:"), "script")).alias("group"), size.cast("int").alias("size")]


def bands(measures: DataFrame, width: float = WIDTH) -> DataFrame:
    """One row per group and size: group, size, and for each measure the least and largest value within its band.

    Copies of a text count once. A quartile is the least step at or below which lie that part of the texts.
    """
    names = [c for c in measures.columns if c.rsplit("_", 1)[0] in MEASURES]
    texts = measures.filter(~base_failed()).select(*_group(), "text_hash", *names).dropDuplicates(["group", "size", "text_hash"])
    steps = [F.struct(F.lit(c).alias("measure"), F.round(F.col(c) * STEPS).cast("int").alias("step")) for c in names]
    counts = (
        texts.select("group", "size", F.explode(F.array(*steps)).alias("at"))
        .groupBy("group", "size", "at.measure", "at.step")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # a row for each step that occurs, so at most some thousands a measure and group
    ordered = counts.groupBy("group", "size", "measure").agg(
        F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("step", "n"))).alias("steps")
    )
    upto = F.transform(
        "steps", lambda x, k: F.struct(x["step"], F.aggregate(F.slice("steps", 1, k + 1), F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("sum"))
    )

    def quartile(part: int) -> Column:
        return F.filter("upto", lambda x: x["sum"] * 4 >= F.col("total") * part)[0]["step"]

    least = F.element_at(F.create_map(*[F.lit(x) for c in names for x in (c, MEASURES[c.rsplit("_", 1)[0]] * STEPS)]), F.col("measure"))
    reach = F.greatest(F.col("q3") - F.col("q1"), least) * width
    quartiles = ordered.withColumn("upto", upto).select("group", "size", "measure", quartile(1).alias("q1"), quartile(3).alias("q3"))
    limits = quartiles.select("group", "size", "measure", ((F.col("q1") - reach) / STEPS).alias("low"), ((F.col("q3") + reach) / STEPS).alias("high"))
    return limits.groupBy("group", "size").agg(
        *[F.max(F.when(F.col("measure") == c, F.col(side))).alias(f"{c}_{side}") for c in names for side in ("low", "high")]
    )


def quality(docs: DataFrame, vocabularies: Sequence[str] = VOCABULARIES, width: float = WIDTH) -> DataFrame:
    """One row per document: doc_id, lang, script, base counts, base_failed, tokens, measures, outside, kept.

    docs: doc_id, text, lang (other columns play no part). Null and empty texts have no words, so they fail the
    base rules. ``outside`` lists the measures beyond their band; base failures are not judged by bands, theirs is
    empty. A share of byte tokens is never too small. Repeated rows and ids are rows of their own. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "fertility")
    measured(docs, vocabularies).write.parquet(folder)
    measures = spark.read.parquet(folder)
    limits = scratch_dir(spark, "bands")
    bands(measures, width).write.parquet(limits)
    names = [c for c in measures.columns if c.rsplit("_", 1)[0] in MEASURES]
    failed = base_failed()
    beyond = [
        F.when(
            (F.col(c) > F.col(f"{c}_high")) | (F.col(c) < F.col(f"{c}_low") if not c.startswith("bytes") else F.lit(False)),
            F.lit(c),
        )
        for c in names
    ]
    # bands are few, read from a written table: Spark knows their size and decides on a broadcast
    judged = measures.select("*", *_group()).join(spark.read.parquet(limits), ["group", "size"], "left")
    outside = F.when(failed, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*beyond)))
    return judged.select(
        "doc_id", "lang", "script", *_BASE, failed.alias("base_failed"), "tokens", *names, outside.alias("outside")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))


def quality_flags(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, kept, and which measures lie outside."""
    return quality(docs).select("doc_id", *_BASE, "base_failed", "kept", F.concat_ws(",", "outside").alias("outside"))
