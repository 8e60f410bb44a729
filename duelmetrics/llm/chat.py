r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole, turn by turn:

    ### role:
    text</turn>

with `\` before every backslash, and before every `###` and `</turn>` inside a text, so it reads back
exactly. The rendered text is encoded once, with offsets; the sorted spans of the assistant's texts are
intersected with the sorted token spans by binary search. Tokens that touch such a span are under the
loss mask; their parts inside the span are the loss text.

A turn's last line break and the next turn's mark never meet in one token, so conversations are cut there:
one with more than CHUNK_TURNS turns, or CHUNK_CHARS characters, gives several rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.llm.common import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
MARK, END = "### ", "</turn>"
LOSS_ROLE = "assistant"
CHUNK_TURNS = 512
CHUNK_CHARS = 1 << 20
_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ROLE_CONTROL = re.compile(r"[\\#<:\n]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n((?:\\.|(?!</turn>)[^\\])*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A rendered turn and where its text begins and ends in it."""
    head = f"{MARK}{_ROLE_CONTROL.sub(lambda m: chr(92) + m[0], role or '')}:\n"
    body = escape(text or "")
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_turns(rendered: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn; fails on anything that isn't a rendered conversation."""
    at = 0
    while at < len(rendered):
        turn = _TURN.match(rendered, at)
        if not turn:
            raise ValueError(f"no turn at character {at}")
        yield unescape(turn[1]), unescape(turn[2])
        at = turn.end()


def intersect(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray):
    """Loss mask over tokens, and the covered parts of sorted disjoint spans, joined where they meet."""
    mask = np.zeros(len(starts), dtype=bool)
    parts: list[list[int]] = []
    for begin, end in spans:
        first = int(np.searchsorted(ends, begin, side="right"))
        last = int(np.searchsorted(starts, end, side="left"))
        low, high = np.maximum(starts[first:last], begin), np.minimum(ends[first:last], end)
        some = high > low
        mask[first:last] |= some
        for a, b in zip(low[some].tolist(), high[some].tolist()):
            if parts and a <= parts[-1][1]:
                parts[-1][1] = max(parts[-1][1], b)
            else:
                parts.append([a, b])
    return mask, parts


def load_tokenizer(definition: str):
    """A tokenizer whose offsets keep leading blanks, and that reads special tokens as text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.processors import ByteLevel

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True
    if (json.loads(definition).get("pre_tokenizer") or {}).get("type") == "ByteLevel":
        tokenizer.post_processor = ByteLevel(trim_offsets=False)
    return tokenizer


_FIELDS = [
    ("chunk", pa.int64()),
    ("part", pa.int32()),
    ("n_turns", pa.int64()),
    ("formatted", pa.string()),
    ("token_ids", pa.list_(pa.int32())),
    ("loss_mask", pa.list_(pa.bool_())),
    ("loss_starts", pa.list_(pa.int64())),
    ("loss_ends", pa.list_(pa.int64())),
]


def _format(definition, loss_role: str, chunk_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(definition.value)
        pieces, spans, key, part, size, turns = [], [], None, 0, 0, 0

        def flush() -> pa.RecordBatch:
            text = "".join(pieces)
            encoded = tokenizer.encode(text, add_special_tokens=False)
            offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
            mask, loss = intersect(spans, offsets[:, 0], offsets[:, 1])
            row = {
                "conv_id": key[0],
                "chunk": key[1],
                "part": part,
                "n_turns": turns,
                "formatted": text,
                "token_ids": encoded.ids,
                "loss_mask": mask,
                "loss_starts": [a for a, _ in loss],
                "loss_ends": [b for _, b in loss],
            }
            return pa.RecordBatch.from_pylist([row], pa.schema([("conv_id", id_type), *_FIELDS]))

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "chunk", "role", "text")]
            for conv_id, chunk, role, text in zip(*columns):
                if turns and (key != (conv_id, chunk) or size >= chunk_chars):
                    yield flush()
                    part = part + 1 if key == (conv_id, chunk) else 0
                    pieces, spans, size, turns = [], [], 0, 0
                key = (conv_id, chunk)
                rendered, begin, end = render_turn(role, text)
                if role == loss_role and end > begin:
                    spans.append((size + begin, size + end))
                pieces.append(rendered)
                size += len(rendered)
                turns += 1
        if turns:
            yield flush()

    return run


def format_conversations(
    conversations: DataFrame,
    tokenizer_path: str = TOKENIZER,
    loss_role: str = LOSS_ROLE,
    chunk_turns: int = CHUNK_TURNS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """Rendered conversations with token ids and loss mask.

    conversations: conv_id, turn, role, text (other columns play no part). Turns come in order of turn,
    null last; equal turns in order of role and text. Null text and role are empty; rows without conv_id
    make one conversation. Returns conv_id, chunk, part, n_turns, formatted, token_ids, loss_mask (one
    for each token), loss_starts and loss_ends (code points of formatted). An empty table gives no rows.
    The tokenizer file is read by the driver, so the other machines needn't have it.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = conversations.sparkSession.sparkContext.broadcast(file.read())
    id_type = conversations.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", id_type),
            T.StructField("chunk", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            T.StructField("loss_mask", T.ArrayType(T.BooleanType())),
            T.StructField("loss_starts", T.ArrayType(T.LongType())),
            T.StructField("loss_ends", T.ArrayType(T.LongType())),
        ]
    )
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return (
        conversations.select(
            "conv_id",
            F.floor(F.col("turn") / chunk_turns).cast("long").alias("chunk"),
            "turn",
            F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
        )
        .repartition("conv_id", "chunk")
        .sortWithinPartitions("conv_id", F.col("chunk").asc_nulls_last(), *order)
        .mapInArrow(_format(definition, loss_role, chunk_chars), schema)
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, what its rows say when read back; rows of a conversation follow each other."""
    open_id, state, done = None, None, []

    def close():
        done.append(
            {
                "conv_id": open_id,
                "n_turns": state["turns"],
                "turns_sha256": state["all"].hexdigest(),
                "loss_chars": state["loss_chars"],
                "loss_sha256": state["loss"].hexdigest(),
                "formatted_chars": state["chars"],
            }
        )

    def batch_of(schema):
        return pa.RecordBatch.from_pylist(
            done,
            pa.schema(
                [
                    ("conv_id", schema.field("conv_id").type), ("n_turns", pa.int64()),
                    ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                ]
            ),
        )

    schema = None
    for batch in batches:
        schema = batch.schema
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_starts", "loss_ends")]
        for conv_id, formatted, starts, ends in zip(*columns):
            if state is None or conv_id != open_id:
                if state is not None:
                    close()
                open_id = conv_id
                state = {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
            for role, text in read_turns(formatted):
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for a, b in zip(starts, ends):
                text = unescape(formatted[a:b])
                state["loss"].update(text.encode("utf-8", "surrogatepass"))
                state["loss_chars"] += len(text)
            state["chars"] += len(formatted)
        if len(done) > 1000:
            yield batch_of(schema)
            done.clear()
    if state is not None:
        close()
        yield batch_of(schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest of a conversation runs over its rows in order, one row in memory at a time.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    return (
        formatted.select("conv_id", "chunk", "part", "formatted", "loss_starts", "loss_ends")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("chunk").asc_nulls_last(), "part")
        .mapInArrow(
            _digest,
            f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long",
        )
    )


#: A conversation whose texts hold the template's own control strings.
CONTROL_ID, CONTROL_TEXT = -7, "\\### Assistant: </turn> ok"


def formatted_digests(conversations: DataFrame, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """All conversations and the control conversation, formatted and read back."""
    spark = conversations.sparkSession
    names = ["conv_id", "turn", "role", "text"]
    schema = T.StructType([conversations.schema[n] for n in names])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    control = spark.createDataFrame(
        [(CONTROL_ID, k, role, CONTROL_TEXT) for k, role in enumerate(("user", "assistant"))], schema
    )
    rows = conversations.select(*names).unionByName(control)
    return read_back(cut(format_conversations(rows, tokenizer_path)))
