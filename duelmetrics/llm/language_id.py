"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover every document that may be learned from. The weights are learned with
follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on a bounded sample: shards of
the sample learn side by side from the same state, and Spark averages their states after each pass. A
temperature fitted on sample rows kept apart calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.llm.common import cut, text_or_empty

#: N-grams of 1 to 3 characters, hashed to 2**FEATURE_BITS features.
GRAMS = 3
FEATURE_BITS = 15
#: Bound of the training sample: about so many distinct texts of each label. All labels are learned;
#: each takes 0.5 MB of the training state.
ROWS_PER_LABEL = 2_000
SHARDS = 8
PASSES = 3
#: FTRL-proximal: learning rate, its smoothing, L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
#: Part of the sample that fits the temperature.
CALIBRATION = 0.2
#: Characters of a text that are counted at once.
STRETCH = 1_000_000
UNKNOWN = "und"


#: ASCII characters other than letters tell nothing about a language and count as blanks.
_BLANK = np.array([not chr(c).isalpha() for c in range(128)])
_SPACE = np.uint32(32)


def _letters(text: str) -> np.ndarray:
    """Code points in lower case; a run of blanks is one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    blank = (codes < 128) & _BLANK[np.minimum(codes, 127)]
    codes = np.where(blank, _SPACE, codes)
    again = np.zeros(len(codes), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    return codes[~again]


def gram_counts(text: str) -> np.ndarray:
    """How often each feature occurs in the whole text."""
    codes = _letters(text)
    total = np.zeros(1 << FEATURE_BITS, dtype=np.int64)
    for begin in range(0, max(1, len(codes)), STRETCH):
        piece = codes[begin : begin + STRETCH + GRAMS - 1]
        value = np.zeros(len(piece), dtype=np.uint32)
        for n in range(1, GRAMS + 1):
            if len(piece) < n:
                break
            with np.errstate(over="ignore"):
                value = value[: len(piece) - n + 1] * np.uint32(0x01000193) ^ piece[n - 1 :]
                hashed = (value ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            hashed = hashed >> np.uint32(32 - FEATURE_BITS)
            total += np.bincount(hashed[:STRETCH], minlength=len(total))
    return total


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the TF-IDF vector, of length 1."""
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    value = (1.0 + np.log(counts[at])) * idf[at]
    length = float(np.sqrt((value * value).sum()))
    return at, value / length if length else value


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """labels, weights (feature x label), inverse document frequencies and temperature."""

    labels: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.labels or not has_letter(text):
            return UNKNOWN, 0.0
        at, value = features(text, self.idf)
        p = softmax((value @ self.weights[at]) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def proximal(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights of an FTRL state; small leaders are exactly 0."""
    return np.where(
        np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    )


def learn(z: np.ndarray, n: np.ndarray, rows) -> None:
    """One pass over rows (indices, values, label number), updating the state in place."""
    for at, value, label in rows:
        w = proximal(z[at], n[at])
        p = softmax(value @ w)
        p[label] -= 1.0
        g = value[:, None] * p[None, :]
        grown = n[at] + g * g
        z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
        n[at] = grown


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(1 << FEATURE_BITS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            total += gram_counts(text.as_py()) > 0
            rows += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], names=["feature", "n"]
    )


def _shard(labels: list[str], shared):
    number = {label: k for k, label in enumerate(labels)}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        idf, z, n = shared.value
        own_z, own_n = z.copy(), n.copy()
        ordered = rows.sort_values(["h", "text"])
        learn(
            own_z,
            own_n,
            ((*features(t, idf), number[x]) for t, x in zip(ordered.text, ordered.label)),
        )
        changed = np.flatnonzero((own_n != n).any(axis=1))
        return pd.DataFrame(
            {
                "feature": changed,
                "z": list(own_z[changed] - z[changed]),
                "n": list(own_n[changed] - n[changed]),
            }
        )

    return run


def _logits(labels: list[str], idf: np.ndarray, weights: np.ndarray):
    number = {label: k for k, label in enumerate(labels)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for text, label in zip(rows.text, rows.label):
                at, value = features(text, idf)
                found.append((number[label], list(value @ weights[at])))
            yield pd.DataFrame(found, columns=["label", "logits"])

    return run


def fit_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(label)), label], 1e-12)).mean())

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(
    df: DataFrame,
    text_column: str = "text",
    label_column: str = "lang",
    rows_per_label: int = ROWS_PER_LABEL,
) -> Model:
    """Learn from the texts of df with a label.

    Rows without label, or whose text has no letter, teach nothing. The sample takes about
    `rows_per_label` texts of each label (in expectation at most so many), by a hash of the text. Its rate
    follows from the label's distinct texts, so copies neither fill nor empty it; document frequencies
    cover all rows. Without any labelled row the model has no labels and predicts `und`.
    """
    spark = df.sparkSession
    rows = df.select(
        text_or_empty(text_column).alias("text"), F.col(label_column).cast("string").alias("label")
    ).filter(r"label is not null and text rlike '\\p{L}'")
    h = F.xxhash64("text", F.lit(7))
    # as many rows as there are labels, all of which are learned
    counts = rows.groupBy("label").agg(F.count_distinct(h).alias("texts"))
    known = {r["label"]: int(r["texts"]) for r in counts.collect()}
    labels = sorted(known)
    size = 1 << FEATURE_BITS
    if not labels:
        return Model([], np.zeros((size, 0)), np.ones(size))

    frequency = (
        rows.select("text")
        .mapInArrow(_document_frequency, "feature long, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most 2**FEATURE_BITS + 1 rows
    )
    df_of = {r["feature"]: r["n"] for r in frequency}
    documents = df_of.pop(-1, 0)
    idf = np.full(size, np.log(1 + documents) + 1.0)
    for feature, n in df_of.items():
        idf[feature] = np.log((1 + documents) / (1 + n)) + 1.0

    share = F.element_at(
        F.create_map(
            *[F.lit(v) for x in labels for v in (x, min(1.0, rows_per_label / known[x]))]
        ),
        F.col("label"),
    )
    sample = cut(
        rows.filter(F.col("label").isin(labels))
        .withColumn("h", h)
        .filter((F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) < share)
        .dropDuplicates(["h", "label"])
    )
    part = F.pmod(F.xxhash64("text", F.lit(13)), F.lit(100))
    learned = sample.filter(part >= int(CALIBRATION * 100)).withColumn(
        "shard", F.pmod(F.xxhash64("text", F.lit(17)), F.lit(SHARDS))
    )
    z = np.zeros((size, len(labels)))
    n = np.zeros((size, len(labels)))
    for _ in range(PASSES):
        # as large as the model: 2**FEATURE_BITS x labels numbers
        state = spark.sparkContext.broadcast((idf, z, n))
        steps = learned.groupBy("shard").applyInPandas(
            _shard(labels, state), "feature long, z array<double>, n array<double>"
        )
        # the state after a pass: the mean of the shards' states, as large as the model
        mean = (
            steps.select("feature", F.posexplode(F.arrays_zip("z", "n")).alias("k", "zn"))
            .groupBy("feature", "k")
            .agg(F.sum("zn.z").alias("z"), F.sum("zn.n").alias("n"))
            .toPandas()
        )
        z[mean.feature, mean.k] += mean.z / SHARDS
        n[mean.feature, mean.k] += mean.n / SHARDS
        state.unpersist()
    weights = proximal(z, n)
    apart = (
        sample.filter(part < int(CALIBRATION * 100))
        .select("text", "label")
        .mapInPandas(_logits(labels, idf, weights), "label int, logits array<double>")
        .toPandas()
    )
    logits = np.array(apart.logits.tolist()) if len(apart) else np.zeros((0, len(labels)))
    temperature = fit_temperature(logits, apart.label.to_numpy())
    return Model(labels, weights.astype(np.float32), idf.astype(np.float32), temperature)


def _predict(shared, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            row = batch.column("row")
            found = [model.predict(t.as_py()) for t in row.field(text_column)]
            yield pa.RecordBatch.from_arrays(
                [row, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    return run


def predict(df: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The struct `row` of all columns of df, lang_pred and score of each row.

    lang_pred is a learned label; `und` with score 0 if the text is null or has no letter, or nothing was
    learned. score is the calibrated probability of the label. Equal scores go to the first label in
    code-point order. Texts are read whole.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # 2**FEATURE_BITS x labels numbers
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return rows.mapInArrow(_predict(shared, text_column), schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept from learning; false without an id."""
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def languages(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Rows without doc_id aren't learned from."""
    model = train(df.filter(~held_out() & F.col("doc_id").isNotNull()))
    found = predict(df.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


#: A document stays if its language is known with at least this probability.
LEAST_SCORE = 0.3


def keep_known(df: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of df, all columns, whose language is one of the learned ones with enough probability.

    Texts without a letter go, null and empty ones among them. Where nothing could be learned, all others
    stay.
    """
    model = train(df.filter(~held_out() & F.col("doc_id").isNotNull()))
    if not model.labels:
        return df.filter(text_or_empty().rlike(r"\p{L}"))
    found = predict(df, model)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
    return found.filter(known).select("row.*")
