"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Golden-ratio step and multipliers of the public splitmix64 mixer.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x100000001B3)


def use_shared_folder(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir; where it is unset, on a local master, to a temporary folder.

    The session's own folder in it is removed when the session ends.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-shared-")
        context.setCheckpointDir(folder)
    own = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
    own.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(own)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder, so that later jobs neither repeat nor lose the work."""
    use_shared_folder(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each 64-bit value."""
    with np.errstate(over="ignore"):
        z = x + _STEP
        z = (z ^ (z >> np.uint64(30))) * _MIX1
        z = (z ^ (z >> np.uint64(27))) * _MIX2
        return z ^ (z >> np.uint64(31))


_BYTE_HASH = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED27))
#: First and last code point of the blocks of scripts that set no blanks between words.
UNSPACED = (
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x1950, 0x19FF),  # Tai Le, New Tai Lue, Khmer symbols
    (0x1A20, 0x1AAF),  # Tai Tham
    (0x2E80, 0x2FDF),  # radicals
    (0x3005, 0x3007),  # iteration mark, closing mark, zero
    (0x3021, 0x312F),  # numerals, Hiragana, Katakana, Bopomofo
    (0x31A0, 0x31FF),  # Bopomofo, strokes, Katakana extensions
    (0x3400, 0x4DBF),  # ideographs
    (0x4E00, 0xA4CF),  # ideographs, Yi
    (0xA980, 0xA9FF),  # Javanese, Myanmar
    (0xAA60, 0xAADF),  # Myanmar, Tai Viet
    (0xF900, 0xFAFF),  # compatibility ideographs
    (0xFF66, 0xFF9F),  # half-width Katakana
    (0x16FE0, 0x18DFF),  # Tangut, Khitan
    (0x1AFF0, 0x1B2FF),  # Kana extensions, Nushu
    (0x20000, 0x3FFFF),  # ideographs
)
_BREAK, _LETTER, _UNIT = 0, 1, 2
#: Zero-width space and byte-order mark, which part words though they are format characters.
_ZERO_WIDTH = (0x200B, 0xFEFF)
#: By byte: part of no word, part of a word, or the first byte of a code point that must be looked up.
_BYTE_KIND = np.array(
    [
        int(chr(b).isalnum()) if b < 128 else 2 if b == 0xC2 or b >= 0xCC else 1
        for b in range(256)
    ],
    dtype=np.uint8,
)


@lru_cache(maxsize=1)
def _code_point_kinds() -> np.ndarray:
    """Of each code point: _BREAK (punctuation, blanks, controls), _UNIT (a word of its own) or _LETTER."""
    kinds = np.array(
        [_BREAK if unicodedata.category(chr(c))[0] in "PZ" else _LETTER for c in range(0x110000)],
        dtype=np.uint8,
    )
    kinds[0x80:0xA0] = _BREAK
    kinds[list(_ZERO_WIDTH)] = _BREAK
    for first, last in UNSPACED:
        block = kinds[first : last + 1]
        block[block == _LETTER] = _UNIT
    return kinds


#: Odd powers by offset within a word; extended on demand.
_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 64)
        steps = np.full(size, _ODD, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def _code_points(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and number of bytes of the UTF-8 sequences of two bytes and more that begin at `at`."""
    lead = codes[at].astype(np.int64)
    length = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0x7F >> length)
    for k in (1, 2, 3):
        more = length > k
        point[more] = point[more] << 6 | codes[at[more] + k] & 0x3F
    return point, length


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as numbers, and start and end of each word, of a text in UTF-8.

    A word is a maximal run of ASCII letters and digits and of other code points but punctuation, blanks
    and controls. In scripts that set no blanks between words each code point is a word of its own.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    kind = _BYTE_KIND[codes]
    looked_up = np.flatnonzero(kind == 2)
    inside = kind > 0
    if not len(looked_up):
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        return codes, edges[0::2], edges[1::2]
    point, length = _code_points(codes, looked_up)
    kinds = _code_point_kinds()[point]
    for k in range(4):
        inside[looked_up[(kinds == _BREAK) & (length > k)] + k] = False
    units = kinds == _UNIT
    cuts = np.zeros(len(codes) + 1, dtype=bool)  # a word ends and another begins here
    cuts[looked_up[units]] = cuts[looked_up[units] + length[units]] = True
    begins = inside & (cuts[:-1] | ~np.concatenate([[False], inside[:-1]]))
    ends = inside & (cuts[1:] | ~np.concatenate([inside[1:], [False]]))
    return codes, np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text given as lower-case UTF-8."""
    return span_hashes(*word_spans(data))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum()), dtype=np.int64)
    offset = at - np.repeat(firsts, lengths)
    letters = codes[np.repeat(starts, lengths) + offset]
    with np.errstate(over="ignore"):
        terms = _BYTE_HASH[letters] * _powers_to(int(lengths.max()))[offset]
        return mix64(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash of each run of `size` words; of all words if there are fewer; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = words[:count].copy()
        for k in range(1, size):
            total = total * _MIX1 + words[k : k + count]
        return mix64(total)


def normal_bytes(text: str | None) -> bytes:
    """Lower-case UTF-8; null is empty, lone surrogates are replaced."""
    return (text or "").lower().encode("utf-8", "replace")
