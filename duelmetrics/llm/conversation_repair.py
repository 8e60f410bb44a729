"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation and the role pattern ``(s?(ua)+)?`` span a lattice: a node for each place between rows and
state of the pattern, an arc for each edit with its whole-number cost. The auction algorithm keeps a price at
each node and a path from the origin: at the path's end it either lowers nothing and extends along an arc that
is tight (price = cost + next price), or raises the end's price to the least such sum and contracts. When the
path reaches the sink, the origin's price is the least cost, and exactly the paths of tight arcs attain it;
the one with the ASCII-least initials is traced through them.

Places that the lattice narrows to (one node per state) cut a conversation into blocks of BLOCK_ROWS rows,
solved from the last to the first: the prices a block ends with are the sink arcs of the block before. So the
work grows with the rows, and of a conversation only one code a row and the prices at its cuts are held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs of the edits; an undeleted truncated row adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows solved at once.
BLOCK_ROWS = 8
#: What is not blank, and how a whole text ends.
WHITE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")

#: States of the pattern: nothing yet, after system, after user, after assistant.
STATES = 4
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: Least cost from a state to an accepting one after the last row; only insertions are left then.
_FREE_END = (0, None, None, 0)

#: A row's code: its role initial (s, u, a or other) and whether it must go or is truncated.
_MUST_GO = 8


def row_code(initial: str, fault: str | None) -> int:
    """blank and duplicate rows are alike: they can only be deleted."""
    if fault in ("blank", "duplicate"):
        return _MUST_GO
    return "sua".find(initial if initial else "-") % 4 + 4 * (fault == "truncated")


def _lattice(codes: bytes, ends: tuple[int | None, ...], closing: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs (initial, next node, cost) of each node; node row * STATES + state, the sink last.

    Insertions belong to the place before a row; those after the last row are added in the closing block.
    """
    rows, sink = len(codes), (len(codes) + 1) * STATES
    arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(sink + 1)]
    for place in range(rows + 1):
        for state in range(STATES):
            here = arcs[place * STATES + state]
            added = 2 if state != 2 else 3
            if place < rows:
                code, after = codes[place], (place + 1) * STATES
                here.append(("D", after + state, DELETE))
                if code != _MUST_GO:
                    more = TRUNCATED if code >= 4 else 0
                    target = _NEXT[state].get("sua-"[code % 4])
                    if target is not None:
                        here.append(("K", after + target, more))
                    here.append(("R", after + added, REROLE + more))
            if place < rows or closing:
                here.append(("I", place * STATES + added, INSERT))
            if place == rows and ends[state] is not None:
                here.append(("", sink, ends[state]))
    return arcs


def auction(arcs: Sequence[Sequence[tuple[str, int, int]]], origin: int, sink: int, prices: list[int]) -> int:
    """Raises ``prices`` until the origin's is the least cost to the sink, and returns it.

    Prices must be feasible (none above cost + next price for any arc) and stay so. Needs cycles of positive cost.
    """
    path = [origin]
    while path[-1] != sink:
        node = path[-1]
        best, follow = min((cost + prices[target], target) for _, target, cost in arcs[node])
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(follow)
    return prices[origin] - prices[sink]


def _trace(arcs, prices: list[int], origin: int, sink: int) -> tuple[str, int]:
    """The ASCII-least initials along tight arcs from origin to sink, and the node before the sink.

    Tight arcs of nodes the path never met may lead nowhere, so those that reach the sink are found first.
    An initial determines where it leads, so the least path is found step by step.
    """
    tight = [[(label, j) for label, j, cost in out if prices[i] == cost + prices[j]] for i, out in enumerate(arcs)]
    back: list[list[int]] = [[] for _ in arcs]
    for i, out in enumerate(tight):
        for _, j in out:
            back[j].append(i)
    reach, stack = {sink}, [sink]
    while stack:
        for i in back[stack.pop()]:
            if i not in reach:
                reach.add(i)
                stack.append(i)
    initials, node = [], origin
    while True:
        label, follow = min((label, j) for label, j in tight[node] if j in reach)
        if follow == sink:
            return "".join(initials), node
        initials.append(label)
        node = follow


@lru_cache(maxsize=1 << 16)
def solve_block(codes: bytes, ends: tuple[int | None, ...], closing: bool) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Least cost from each entry state, and for each the ASCII-least initials and the state they end in."""
    arcs = _lattice(codes, ends, closing)
    sink = len(arcs) - 1
    prices = [min(e for e in ends if e is not None)] * sink + [0]
    costs = tuple(auction(arcs, state, sink, prices) for state in range(STATES))
    traces = (_trace(arcs, prices, state, sink) for state in range(STATES))
    return costs, tuple((initials, node % STATES) for initials, node in traces)


def cheapest_edits(codes: bytes, block_rows: int = BLOCK_ROWS) -> tuple[int, str]:
    """Cost and initials of the cheapest edits of a conversation, ASCII-least among equally cheap ones."""
    starts = range(0, max(1, len(codes)), block_rows)
    ends, base = _FREE_END, 0
    cuts = []  # the prices each block ends with, the last block's first, less their least
    for at in reversed(starts):
        cuts.append(ends)
        costs, _ = solve_block(codes[at : at + block_rows], ends, at == starts[-1])
        least = min(costs)
        base += least
        ends = tuple(c - least for c in costs)
    state, initials = 0, []
    for at, cut in zip(starts, reversed(cuts)):
        _, traces = solve_block(codes[at : at + block_rows], cut, at == starts[-1])
        part, state = traces[state]
        initials.append(part)
    return base + ends[0], "".join(initials)


def _one_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls of role and text as one space, hurt by crc32 of ``conv_id:turn``.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it
    the user's. Null ids and turns count as one space in the checksum.
    """
    kind = F.crc32(F.encode(F.concat(_one_space("conv_id"), F.lit(":"), _one_space("turn")), "utf-8")) % 20
    text = _one_space("text")
    rows = conversations.select("conv_id", "turn", _one_space("role").alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(SENTENCE_ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _order() -> list[Column]:
    """The order of a conversation's rows; equal turns by role, then by a digest of role and text."""
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("content").asc()]


def _rows(conversations: DataFrame) -> DataFrame:
    """The rows with ``content``, a digest that is equal for equal role and text; null roles and texts are one space."""
    role, text = _one_space("role"), _one_space("text")
    length = F.octet_length(role).cast("string")
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.sha2(F.concat(length, F.lit(":"), role, text).cast("binary"), 256).alias("content"),
    )


def _faults(rows: DataFrame) -> DataFrame:
    """Rows without their text, with their first fault; the text stays behind in the scan stage."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    looks = (
        F.when(bare == "", "blank")
        .when(F.substring(bare, -1, 1).isin(*SENTENCE_ENDS), None)
        .otherwise("truncated")
    )
    return rows.select("conv_id", "turn", "role", "content", looks.alias("looks"))


#: The counts of a conversation, in the order of their columns.
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDITED = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
_LEGAL = {"su", "ua", "au"}


class _Audit:
    """What is known of the conversation whose rows are passing: one code a row, and counts."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.counts = dict.fromkeys(COUNTS, 0)
        self.turns, self.first, self.last, self.initial = 0, None, None, ""
        self.seen: set[str] = set()

    def add(self, turn: int | None, role: str, content: str, looks: str | None) -> None:
        fault = "duplicate" if looks != "blank" and content in self.seen else looks
        self.seen.add(content)
        if fault:
            self.counts[fault] += 1
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.codes and self.initial + role[:1] not in _LEGAL:
            self.counts["illegal"] += 1
        self.initial = role[:1]
        self.codes.append(row_code(role[:1], fault))

    def result(self) -> tuple:
        if self.turns:
            self.counts["gaps"] = self.last - self.first + 1 - self.turns
        self.counts["cost"], initials = cheapest_edits(bytes(self.codes))
        return (self.conv_id, *self.counts.values(), initials)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's marker comes first, then its rows in order."""
    now, done, id_type = None, [], None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [id_type, *[pa.int64()] * len(COUNTS), pa.string()]
        names = ["conv_id", *COUNTS, "audit"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "after", "turn", "role", "content", "looks"))
        for conv_id, after, *row in zip(*columns):
            if after:
                now.add(*row)
            else:
                if now is not None:
                    done.append(now.result())
                now = _Audit(conv_id)
        if done:
            yield batch_of(done)
            done = []
    if now is not None:
        yield batch_of([now.result()])


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    rows: conv_id, turn, role, text (other columns play no part). Rows come by turn, null first, equal turns by
    role and a digest of the text; null role and text count as one space; rows without conv_id are one
    conversation. Of a row's faults the first counts: blank, duplicate (role and text seen earlier), truncated.
    Roles that begin with neither s, u nor a, and empty ones, fit nowhere until changed. ``ids`` has the conv_id
    of all conversations where some may have no rows: those have zeros and an empty audit. An empty table gives
    no rows. The texts themselves are not shuffled. A conversation's rows pass through one task in order, which
    holds a code and a digest for each.
    """
    ids = (rows if ids is None else ids).select("conv_id").distinct()
    id_type = rows.schema["conv_id"].dataType.simpleString()
    marked = _faults(_rows(rows)).withColumn("after", F.lit(1))
    return (
        marked.unionByName(ids.withColumn("after", F.lit(0)), allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "after", *_order())
        .mapInArrow(_audit, f"conv_id {id_type}, {_AUDITED}")
    )


def edited_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows; ``rows`` are drawn as the audit comes to them."""
    state = 0
    for initial in audit:
        role, text = ("", "") if initial == "I" else next(rows)
        if initial == "D":
            continue
        if initial in "IR":
            role = "assistant" if state == 2 else "user"
        state = _NEXT[state][role[:1]]
        yield role, text


def _with_audits(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit and counts in ``known``, then its rows in order."""
    first = audited.select("conv_id", F.struct("audit", *COUNTS).alias("known"), F.lit(0).alias("after"))
    return (
        _rows(rows)
        .withColumn("after", F.lit(1))
        .unionByName(first, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "after", *_order())
        .select("conv_id", "known", "role", "text")
    )


def _conversations(batches: Iterator[pa.RecordBatch], kinds: dict) -> Iterator[tuple]:
    """(conv_id, known, repaired rows) of each conversation; its rows must be drawn before the next one."""

    def passing():
        for batch in batches:
            kinds.update((c, batch.schema.field(c).type) for c in ("conv_id", "known"))
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "known", "role", "text")))

    rows = passing()
    for conv_id, known, _, _ in rows:
        yield conv_id, known, edited_rows(known["audit"], ((role, text) for _, _, role, text in rows))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds: dict = {}
    done = []

    def batch_of() -> pa.RecordBatch:
        types = (kinds["conv_id"], kinds["known"], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), types)], names=["conv_id", "known", "repaired_sha256"]
        )

    for conv_id, known, repaired in _conversations(batches, kinds):
        digest, between = hashlib.sha256(), ""
        for role, text in repaired:
            digest.update(f"{between}{role}:{text}".encode("utf-8", "surrogatepass"))
            between = "\n"
        done.append((conv_id, known, digest.hexdigest()))
        if len(done) == 1_000:
            yield batch_of()
            done.clear()
    if done:
        yield batch_of()


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, place, role, text. Inputs as in ``audits``."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict = {}
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            types = (kinds["conv_id"], pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv_id", "place", "role", "text"]
            )

        for conv_id, _, repaired in _conversations(batches, kinds):
            for place, (role, text) in enumerate(repaired):
                out.append((conv_id, place, role, text))
                if len(out) == 1_000:
                    yield batch_of()
                    out.clear()
        if out:
            yield batch_of()

    schema = f"conv_id {id_type}, place long, role string, text string"
    return _with_audits(rows, audits(rows)).mapInArrow(run, schema)


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: the columns of ``audits`` and repaired_sha256, a digest of the repaired rows.

    Arguments, nulls and ties are those of ``audits``; a conversation without rows has the digest of nothing.
    A digest runs over a conversation's rows in order, one row in memory at a time.
    """
    audited = audits(rows, ids)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    known = f"struct<audit: string, {', '.join(f'{c}: bigint' for c in COUNTS)}>"
    hashed = _with_audits(rows, audited).mapInArrow(_hash, f"conv_id {id_type}, known {known}, repaired_sha256 string")
    return hashed.select("conv_id", *[f"known.{c}" for c in COUNTS], "known.audit", "repaired_sha256")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations), conversations)


def oracle_sql() -> str:
    """The same in DuckDB SQL: the least (cost, initials) of each state, row after row."""
    white = "||".join(f"chr({ord(c)})" for c in WHITE)
    return f"""
        WITH RECURSIVE polynomial AS (
            SELECT list_transform(range(256), lambda n: list_reduce(
                [n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS t
        ), checked AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(
                       [4294967295::BIGINT] || list_transform(
                           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                           lambda c: ord(c)::BIGINT),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 20 AS kind
            FROM conversations, polynomial
        ), hurt AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM checked WHERE kind <> 0
        ), placed AS (
            SELECT *, rtrim(text, {white}) AS bare, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                sha256(strlen(role) || ':' || role || text), copy) AS place
            FROM hurt
        ), faulty AS MATERIALIZED (
            SELECT conv_id, turn, role, text, place, left(role, 1) AS initial,
                   CASE WHEN bare = '' THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                        WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
            FROM placed
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
            FROM faulty GROUP BY conv_id
        ), keeps(state, initial, follows) AS (
            VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
        ), inserts(state, follows, more, added) AS (
            VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
                   (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')
        ), best AS (
            SELECT conv_id, 0::BIGINT AS place, follows AS state, {{'c': more::BIGINT, 'a': added}} AS least
            FROM counted, inserts WHERE state = 0
            UNION ALL
            SELECT s.conv_id, s.place + 1, i.follows, min({{'c': s.cost + i.more, 'a': s.audit || i.added}})
            FROM (
                SELECT b.conv_id, b.place, b.state, b.least.c + 4 AS cost, b.least.a || 'D' AS audit
                FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.place = b.place + 1
                UNION ALL
                SELECT b.conv_id, b.place, CASE WHEN b.state = 2 THEN 3 ELSE 2 END,
                       b.least.c + CASE WHEN f.fault = 'truncated' THEN 6 ELSE 3 END, b.least.a || 'R'
                FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.place = b.place + 1
                WHERE f.fault IS NULL OR f.fault = 'truncated'
                UNION ALL
                SELECT b.conv_id, b.place, k.follows, b.least.c + CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END, b.least.a || 'K'
                FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.place = b.place + 1
                JOIN keeps k ON k.state = b.state AND k.initial = f.initial
                WHERE f.fault IS NULL OR f.fault = 'truncated'
            ) s JOIN inserts i ON i.state = s.state GROUP BY ALL
        ), solved AS (
            SELECT c.conv_id, min(b.least) AS least
            FROM counted c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.place = c.n
            WHERE b.state IN (0, 3) GROUP BY c.conv_id
        ), edits AS (
            SELECT conv_id, unnest(string_split(least.a, '')) AS edit, unnest(range(1, length(least.a) + 1)) AS k
            FROM solved WHERE least.a <> ''
        ), applied AS (
            SELECT e.*, count(*) FILTER (edit <> 'I') OVER upto AS place, count(*) FILTER (edit <> 'D') OVER upto AS emitted
            FROM edits e WINDOW upto AS (PARTITION BY conv_id ORDER BY k)
        ), roles AS (
            SELECT a.*, f.role, f.text, coalesce(max((emitted = 1 AND edit = 'K' AND f.initial = 's')::INTEGER) OVER (PARTITION BY a.conv_id), 0) AS led
            FROM applied a LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.place = a.place AND a.edit <> 'I'
        ), repaired AS (
            SELECT conv_id, string_agg(
                CASE WHEN edit = 'K' THEN role WHEN (emitted - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || coalesce(text, ''), chr(10) ORDER BY k) FILTER (edit <> 'D') AS rows
            FROM roles GROUP BY conv_id
        )
        SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(s.least.c, 0) AS cost, coalesce(s.least.a, '') AS audit, sha256(coalesce(r.rows, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) i
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
        LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM i.conv_id
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id
    """
