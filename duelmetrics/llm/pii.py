"""Personal data by weak supervision.

Base patterns and looser ones propose spans. Labelers (format, gazetteer, context, boundary, spread) vote
on each; expectation-maximisation over the counted vote patterns of the whole corpus estimates how
reliable each labeler is, and the posteriors train a logistic regression that judges the spans. Base
spans always stay; of the looser ones those stay that the classifier is sure of.

Texts are read once. What the driver sees are counts of vote and feature patterns, whose number the
code lists below bound, not the corpus.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.llm.common import cut, text_or_empty

# The kinds of the base patterns in their order, then the kinds of the looser ones.
BASE_KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("iban", "id_number", "masked_email", "name", "local_phone")
KINDS = BASE_KINDS + LOOSE_KINDS
# Gazetteers.
TOP_DOMAINS = frozenset([
    "com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "de", "fr", "es", "it", "uk",
    "us", "eu", "ch", "at", "nl", "be",
])
TITLES = frozenset([
    "mr", "mrs", "ms", "dr", "prof",
])
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "2", "34", "37", "6")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44",
                 "45", "46", "47", "48", "49", "51", "52", "55", "61", "64", "81", "82", "86", "90", "91")
IBAN_COUNTRIES = frozenset([
    "AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT",
    "SE",
])
# Words near a span.
FOR_WORDS = frozenset([
    "email", "mail", "contact", "phone", "call", "tel", "telephone", "mobile", "fax", "card",
    "visa", "credit", "payment", "ip", "host", "server", "address", "ssn", "social", "iban",
    "account", "bank", "name", "dear", "patient", "customer",
])
AGAINST_WORDS = frozenset([
    "version", "release", "isbn", "issn", "order", "invoice", "page", "figure", "table", "section",
    "chapter", "id", "build", "commit", "total", "price", "temperature", "latitude", "longitude",
])

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"))
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOSE = {
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "id_number": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "masked_email": re.compile(
        r"(?<![\w.+-])[\w.+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[\w-]{1,63}"
        r"(?:(?: ?[\[(] ?(?:dot|DOT) ?[\])] ?|\.)[\w-]{2,63}){1,4}"
    ),
    "name": re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof)\.? [^\W\d_a-z]\w{1,30}(?: [^\W\d_a-z]\w{1,30})?"),
    "local_phone": re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])"),
}
#: A looser span is kept if the classifier gives it at least this probability.
SURE = 0.9
LABELERS = 5
#: Letters before a span that are looked at for words.
NEAR = 40


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a host after an at sign and the longest run of local characters before it."""
    done = 0
    for host in EMAIL_HOST.finditer(text):
        at = host.start()
        if at < done:
            continue
        start = _run_start(text, done, at)
        if start < at:
            yield start, host.end()
            done = host.end()


def _run_start(text: str, low: int, at: int) -> int:
    """Where the run of local characters that ends before `at` begins, not before `low`."""
    step, begin = 64, at
    while begin > low:
        piece = text[max(low, begin - step) : begin]
        kept = len(piece.rstrip(LOCAL))
        begin -= len(piece) - kept
        if kept:
            break
        step *= 2
    return begin


def base_spans(text: str, has_at=True, has_digit=True, has_plus=True) -> dict[str, list[tuple[int, int]]]:
    """Base spans by kind, in code points, end exclusive."""
    found: dict = {kind: [] for kind in BASE_KINDS}
    if has_at:
        found["email"] = list(emails(text))
    if has_digit:
        found["ip"] = [
            m.span()
            for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))
        ]
        for m in CARD.finditer(text):
            if 16 <= m.end() - m.start() <= 37 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found["card"].append(m.span())
    if has_plus:
        found["phone"] = [
            m.span() for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15
        ]
    return found


def loose_spans(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Looser spans that overlap neither a base span nor each other."""
    blocked: list = []  # disjoint stretches, sorted
    for a, b in sorted(taken):
        if blocked and a <= blocked[-1][1]:
            blocked[-1] = (blocked[-1][0], max(b, blocked[-1][1]))
        else:
            blocked.append((a, b))
    for kind in LOOSE_KINDS:
        for m in LOOSE[kind].finditer(text):
            start, end = m.span()
            at = bisect_left(blocked, (start, end))
            if (at and blocked[at - 1][1] > start) or (at < len(blocked) and blocked[at][0] < end):
                continue
            blocked.insert(at, (start, end))
            yield kind, start, end


def votes(kind: str, text: str, start: int, end: int) -> list[int]:
    """Each labeler's vote: 1 for personal data, -1 against, 0 abstains."""
    span = text[start:end]
    digits = digits_of(span)
    words = set(re.findall(r"[a-z]+", text[max(0, start - NEAR) : start].lower()))
    before, after = text[start - 1 : start], text[end : end + 1]
    return [_format(kind, span, digits), _gazetteer(kind, span, digits), _context(words),
            _boundary(before, after), _spread(kind, digits)]


def _format(kind: str, span: str, digits: str) -> int:
    if kind in BASE_KINDS:
        return 1
    if kind == "iban":
        packed = span.replace(" ", "")
        moved = "".join(str(int(c, 36)) for c in packed[4:] + packed[:4])
        return 1 if 15 <= len(packed) <= 34 and int(moved) % 97 == 1 else -1
    if kind == "id_number":
        return 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" else -1
    if kind == "local_phone":
        return 1 if digits[0] not in "01" and digits[3] not in "01" else -1
    return 0


def _gazetteer(kind: str, span: str, digits: str) -> int:
    if kind in ("email", "masked_email"):
        return 1 if re.split(r"\W+", span.lower().rstrip(")] "))[-1] in TOP_DOMAINS else 0
    if kind == "card":
        return 1 if digits.startswith(CARD_STARTS) else 0
    if kind == "phone":
        return 1 if digits.startswith(COUNTRY_CODES) else 0
    if kind == "iban":
        return 1 if span[:2] in IBAN_COUNTRIES else -1
    if kind == "name":
        return 1 if span.split(" ")[0].rstrip(".").lower() in TITLES and span.count(" ") == 2 else 0
    return 0


def _context(words: set[str]) -> int:
    return (1 if words & FOR_WORDS else 0) or (-1 if words & AGAINST_WORDS else 0)


def _boundary(before: str, after: str) -> int:
    return -1 if before.isalnum() or after.isalnum() else 1


def _spread(kind: str, digits: str) -> int:
    if kind in ("email", "masked_email", "name"):
        return 0
    return 1 if len(set(digits)) >= 3 else -1


def span_features(kind: str, text: str, start: int, end: int) -> int:
    """Features of a span as bits; the kind is apart."""
    span = text[start:end]
    line = text.rfind("\n", 0, start) + 1
    before = text[max(0, start - 2) : start]
    bits = (
        start == line,
        before.endswith((": ", "=", ":", "<", '"')),
        text[end : end + 1] in ("", "\n", ".", ",", ">", '"'),
        end - start > 20,
        " " in span,
        "-" in span,
        bool(set(re.findall(r"[a-z]+", text[max(0, start - NEAR) : start].lower())) & FOR_WORDS),
        bool(set(re.findall(r"[a-z]+", text[end : end + NEAR].lower())) & AGAINST_WORDS),
    )
    return sum(1 << k for k, b in enumerate(bits) if b)


FEATURES = 8


def _encode(vote: list[int]) -> int:
    return sum((v + 1) * 3**k for k, v in enumerate(vote))


def _decode(code: int) -> list[int]:
    return [code // 3**k % 3 - 1 for k in range(LABELERS)]


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        digit, at, plus = (
            pc.match_substring_regex(column, p).to_pylist() for p in ("[0-9]", "@", r"\+")
        )
        other = pc.match_substring_regex(
            column, r"[\[(] ?(?:at|AT) ?[\])]|(?:Mr|Mrs|Ms|Dr|Prof)\.? "
        ).to_pylist()
        out = []
        for k in range(batch.num_rows):
            spans: list = []
            if digit[k] or at[k] or plus[k] or other[k]:
                text = column[k].as_py()
                base = base_spans(text, at[k], digit[k], plus[k])
                found = [(kind, *s, True) for kind in BASE_KINDS for s in base[kind]]
                taken = [(s, e) for _, s, e, _ in found]
                found += [(*s, False) for s in loose_spans(text, taken)]
                for kind, start, end, is_base in found:
                    spans.append(
                        {
                            "kind": kind,
                            "start": start,
                            "end": end,
                            "base": is_base,
                            "votes": _encode(votes(kind, text, start, end)),
                            "features": span_features(kind, text, start, end),
                        }
                    )
            out.append(spans)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(out, _SPANS)], names=["row", "spans"]
        )


_SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
         ("votes", pa.int32()), ("features", pa.int32())]
    )
)


@dataclass
class LabelModel:
    """Reliability of each labeler and prior of each kind."""

    accuracy: np.ndarray
    prior: dict[str, float] = field(default_factory=dict)

    def posterior(self, kind: str, vote: list[int]) -> float:
        p = self.prior.get(kind, 0.5)
        odds = np.log(p) - np.log(1 - p)
        for v, a in zip(vote, self.accuracy):
            odds += v * (np.log(a) - np.log(1 - a))
        return float(1 / (1 + np.exp(-np.clip(odds, -40, 40))))


def fit_labelers(patterns: list[tuple[str, list[int], int]], rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over counted vote patterns (kind, votes, count).

    A labeler is right with the same probability for all kinds; both that and the priors are smoothed
    with two made-up counts, so nothing becomes certain. It starts from labelers that are right in 0.75
    of their votes. Without patterns it stays there.
    """
    model = LabelModel(np.full(LABELERS, 0.75), {kind: 0.5 for kind in KINDS})
    for _ in range(rounds):
        right, cast = np.full(LABELERS, 1.5), np.full(LABELERS, 2.0)
        good, all_of = {k: 1.0 for k in KINDS}, {k: 2.0 for k in KINDS}
        for kind, vote, count in patterns:
            p = model.posterior(kind, vote)
            good[kind] += count * p
            all_of[kind] += count
            for k, v in enumerate(vote):
                if v:
                    cast[k] += count
                    right[k] += count * (p if v > 0 else 1 - p)
        # a labeler is taken to be better than chance, else its votes could swap their meaning
        model = LabelModel(
            np.clip(right / cast, 0.55, 0.99), {k: good[k] / all_of[k] for k in KINDS}
        )
    return model


def _design(kind: str, vote: list[int], bits: int) -> np.ndarray:
    return np.array(
        [1.0, *[float(kind == k) for k in KINDS], *[float(bits >> k & 1) for k in range(FEATURES)], *vote]
    )


def fit_classifier(
    rows: list[tuple[str, list[int], int, int]], labels: LabelModel, rounds: int = 30
) -> np.ndarray:
    """Weights of a logistic regression on counted patterns (kind, votes, features, count).

    The targets are the label model's posteriors; ridge-penalised Newton steps.
    """
    width = 1 + len(KINDS) + FEATURES + LABELERS
    weights = np.zeros(width)
    if not rows:
        return weights
    x = np.stack([_design(kind, vote, bits) for kind, vote, bits, _ in rows])
    y = np.array([labels.posterior(kind, vote) for kind, vote, _, _ in rows])
    n = np.array([float(count) for *_, count in rows])
    n = n / n.sum() * min(n.sum(), 1e6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (y - p)) - weights
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def judge(weights: np.ndarray, kind: str, vote: list[int], bits: int) -> float:
    return float(1 / (1 + np.exp(-np.clip(_design(kind, vote, bits) @ weights, -30, 30))))


def _join(spans) -> str:
    order = {k: n for n, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1], x[2])))


def _decide(scores: dict, sure: float):
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict = {k: [] for k in BASE_KINDS}
            digests, every, added = [], [], []
            for spans in batch.column("spans").to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in spans if s["base"]]
                more = [
                    (s["kind"], s["start"], s["end"])
                    for s in spans
                    if not s["base"] and scores[s["kind"], s["votes"], s["features"]] >= sure
                ]
                for kind in BASE_KINDS:
                    counts[kind].append(sum(b[0] == kind for b in base))
                digests.append(hashlib.sha256(_join(base).encode()).hexdigest())
                every.append(_join(base + more))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS],
                    pa.array(digests, pa.string()),
                    pa.array(every, pa.string()),
                    pa.array(added, pa.int64()),
                ],
                names=["row", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_added"],
            )

    return decide


def find_personal_data(df: DataFrame, carry: list[str] | None = None, sure: float = SURE) -> DataFrame:
    """Per row of df: the struct `row` of the `carry` columns (default: doc_id) and what was found.

    n_email, n_ip, n_card, n_phone count base spans; base_sha256 digests them; spans lists base and added
    spans as kind:start:end in code points; n_added counts the added ones. Null texts are empty. Added
    spans overlap no base span. Repeated rows give repeated results. Without any span nothing is learned.
    """
    rows = df.select(F.struct(*[F.col(c) for c in (carry or ["doc_id"])]).alias("row"), text_or_empty().alias("text"))
    spans = T.StructType.fromDDL(
        "spans array<struct<kind:string,start:bigint,end:bigint,base:boolean,votes:int,features:int>>"
    )
    schema = T.StructType([rows.schema["row"], *spans])
    proposed = cut(rows.mapInArrow(_propose, schema))
    # patterns are bounded by kinds x 3**LABELERS x 2**FEATURES, whatever the number of spans
    seen = (
        proposed.select(F.explode("spans").alias("s"))
        .groupBy("s.kind", "s.votes", "s.features")
        .count()
        .collect()
    )
    patterns = sorted((r["kind"], r["votes"], r["features"], r["count"]) for r in seen)
    labels = fit_labelers([(kind, _decode(v), n) for kind, v, _, n in patterns])
    weights = fit_classifier([(kind, _decode(v), bits, n) for kind, v, bits, n in patterns], labels)
    scores = {
        (kind, v, bits): judge(weights, kind, _decode(v), bits) for kind, v, bits, _ in patterns
    }
    result = T.StructType(
        [
            rows.schema["row"],
            *[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
            T.StructField("n_added", T.LongType()),
        ]
    )
    return proposed.mapInArrow(_decide(scores, sure), result)


def personal_data(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    return find_personal_data(df).select("row.doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_added")
