"""Repair of conversation structure by alignment with the grammar ``(s?(ua)+)?`` of role initials.

The rows of a conversation are aligned, in the manner of Wagner and Fischer, with every feasible target: the alternating strings
``ua``, ``uaua``, ... of each length, with or without a system turn before them.  All targets of one ending share their
suffixes, so one table of rows left by target left holds the cost of every length.  Keeping a turn costs 0, giving it another
role 2, deleting it 3 (the only choice for blank and duplicate turns), inserting an empty turn 2; an undeleted truncated turn costs 1
more.  The table is computed in Ukkonen's bands: cells that even at best exceed the cost of the incumbent are left out, and the
incumbent's bound doubles until a length within it is found.  The lengths that tie are traced back, and their audits (the initials of
the edits) are compared; at a tie the ASCII-least goes on.

A conversation of up to ``PIECE_ROWS`` rows is one piece.  Longer ones (and those of many bytes) are range-partitioned by
turn, so one conversation may span many tasks, and cut into pieces.  A piece is aligned between every two states of the grammar
(nothing yet, after s, after u, after a), and pieces are joined from the right: of two audits of equal cost for the same rows
neither begins with the other, so the best of a whole is made of the best of its pieces.  Only the digest of the repaired text walks
through a conversation in one stream, one row of a piece at a time.

Edge cases: a null conversation id is a conversation of its own; null roles and texts are one space; a null turn sorts first; turns
of equal number stand in the order of role and text; an empty role has no initial and is never legal; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import stored, table

PIECE_ROWS = 256
PIECE_BYTES = 8 << 20
LONG_ROWS, LONG_BYTES = 4096, 32 << 20  # beyond either, a conversation is cut over tasks
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 40  # cost of what can't be
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3  # first fault of a row
NAMES = {"u": "user", "a": "assistant"}
STATES = "-sua"  # after nothing, s, u, a

RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class Turn(NamedTuple):
    role: str
    text: str
    fault: int


def align(turns: list[Turn], last: str, every: bool = True) -> "Alignment":
    """Alignment of the turns with all alternating targets that end in ``last``, in bands around the incumbent.

    every: the best of each way to begin is wanted, not of all together.
    """
    bound = 8
    while True:
        found = Alignment(turns, last, bound)
        if bound >= DELETE * len(turns) + 4 * INSERT:
            return found
        best = found.best()
        if (max if every else min)(best.values()) <= bound:
            return found
        bound *= 2


class Alignment:
    """``cost[i][k]``: least cost of turns i and later against the last k characters of the target; ``opened[i][k]``: with an s before them."""

    def __init__(self, turns: list[Turn], last: str, bound: int):
        n = len(turns)
        other = "u" if last == "a" else "a"
        self.turns, self.last = turns, last
        most = n + bound // INSERT
        cost = [[FAR] * (most + 1) for _ in range(n + 1)]
        opened = [[FAR] * (most + 1) for _ in range(n + 1)]
        for k in range(most + 1):
            cost[n][k] = INSERT * k
        for i in range(n - 1, -1, -1):
            turn, left = turns[i], n - i
            bad = turn.fault in (BLANK, DUPLICATE)
            extra = TRUNCATED if turn.fault == CUT_OFF else 0
            initial = turn.role[:1]
            row, below, s_row, s_below = cost[i], cost[i + 1], opened[i], opened[i + 1]
            # Ukkonen's band: a cell that needs more deletes or inserts than the bound pays for stays out.
            low, high = max(0, left - bound // DELETE - 1), min(most, left + bound // INSERT)
            for k in range(low, high + 1):
                value = below[k] + DELETE
                if k:
                    value = min(value, row[k - 1] + INSERT)
                    if not bad:
                        step = extra if initial == (last if k % 2 else other) else REROLE + extra
                        value = min(value, below[k - 1] + step)
                row[k] = min(value, FAR)
                value = s_below[k] + DELETE
                if not bad and initial == "s":
                    value = min(value, below[k] + extra)
                s_row[k] = min(value, FAR)
        self.cost, self.opened = cost, opened

    def lengths(self, first: str) -> Iterator[int]:
        """Numbers of characters after which a target that begins with ``first`` ends in ``last``; 0 stands for nothing."""
        return range(1 if first == self.last else 2, len(self.cost[0]), 2)

    def best(self) -> dict[str, int]:
        """Least cost of the targets that begin with u, with a, with s and then u."""
        of = lambda row, ks: min((row[k] for k in ks), default=FAR)
        n = len(self.turns)
        out = {c: of(self.cost[0], self.lengths(c)) for c in "ua"}
        # An opening s may not be there at all; the bound need not wait for it then.
        if any(t.role[:1] == "s" and t.fault not in (BLANK, DUPLICATE) for t in self.turns):
            out["s"] = of(self.opened[0], self.lengths("u"))
        return {c: min(v, DELETE * n + 4 * INSERT) for c, v in out.items()}

    def trace(self, k: int, opening: bool = False) -> str:
        """The ASCII-least audit of the target's last k characters, with an s before them if asked for."""
        audit, i, n = [], 0, len(self.turns)
        other = "u" if self.last == "a" else "a"
        while i < n or k or opening:
            here = (self.opened if opening else self.cost)[i][k]
            turn = self.turns[i] if i < n else None
            extra = TRUNCATED if turn and turn.fault == CUT_OFF else 0
            if turn and (self.opened if opening else self.cost)[i + 1][k] + DELETE == here:
                audit.append("D")
                i += 1
            elif opening:
                audit.append("K")
                i, opening = i + 1, False
            elif k and self.cost[i][k - 1] + INSERT == here:
                audit.append("I")
                k -= 1
            else:
                audit.append("K" if turn.role[:1] == (self.last if k % 2 else other) and self.cost[i + 1][k - 1] + extra == here else "R")
                i, k = i + 1, k - 1
        return "".join(audit)

    def least(self, first: str) -> tuple[int, str] | None:
        """Cost and audit of the best target that begins with u, with a, or with s and then u."""
        row = self.opened[0] if first == "s" else self.cost[0]
        ks = list(self.lengths("u" if first == "s" else first))
        low = min((row[k] for k in ks), default=FAR)
        if low >= FAR:
            return None
        return low, min(self.trace(k, first == "s") for k in ks if row[k] == low)


def _nothing(turns: list[Turn]) -> tuple[int, str]:
    return DELETE * len(turns), "D" * len(turns)


def _only_s(turns: list[Turn]) -> tuple[int, str] | None:
    """One turn is kept, as the opening s."""
    n = len(turns)
    ways = [(DELETE * (n - 1) + (TRUNCATED if t.fault == CUT_OFF else 0), "D" * k + "K" + "D" * (n - k - 1)) for k, t in enumerate(turns) if t.role[:1] == "s" and t.fault not in (BLANK, DUPLICATE)]
    return min(ways, default=None)


def whole(turns: list[Turn]) -> tuple[int, str]:
    """Least cost and its audit for a conversation in one piece."""
    by_a = align(turns, "a", every=False)
    return min(x for x in (_nothing(turns), by_a.least("u"), by_a.least("s")) if x)


def between(turns: list[Turn]) -> dict[str, tuple[int, str]]:
    """Least cost and its audit from each state of the grammar to each other: keys are two of ``STATES``."""
    ends = {c: align(turns, c) for c in "ua"}
    out: dict[str, list[tuple[int, str] | None]] = {x + x: [_nothing(turns)] for x in STATES}
    for y, found in ends.items():
        for x in STATES:
            out.setdefault(x + y, []).append(found.least("a" if x == "u" else "u"))
        out["-" + y].append(found.least("s"))
    out["-s"] = [_only_s(turns)]
    return {k: min(x for x in v if x) for k, v in out.items() if any(v)}


class Chain(NamedTuple):
    """Audits of the pieces of a conversation from one on."""

    audit: str
    state: str  # in which the piece is entered
    after: "Chain | None"


def _less(a: Chain | None, b: Chain | None) -> bool:
    """Whether the audits of one chain come before those of the other."""
    x, y = "", ""
    while True:
        if not x and not y and a is b:
            return False
        if not x:
            if a is None:
                return bool(y) or b is not None
            x, a = a.audit, a.after
        if not y:
            if b is None:
                return False
            y, b = b.audit, b.after
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def joined(pieces: list[dict[str, tuple[int, str]]]) -> tuple[int, Chain | None]:
    """The best way through all pieces, from nothing to nothing or to an a."""
    best: dict[str, tuple[int, Chain | None]] = {"-": (0, None), "a": (0, None)}
    for piece in reversed(pieces):
        now: dict[str, tuple[int, Chain | None]] = {}
        for key, (cost, audit) in piece.items():
            x, y = key
            if y not in best:
                continue
            total, chain = cost + best[y][0], Chain(audit, x, best[y][1])
            if x not in now or total < now[x][0] or total == now[x][0] and _less(chain, now[x][1]):
                now[x] = (total, chain)
        best = now
    return best["-"]


class Repaired:
    """The digest of a repaired conversation, fed with turns and their edits."""

    def __init__(self) -> None:
        self.sha, self.state, self.lines = hashlib.sha256(), "-", 0

    def add(self, turns: list[Turn], audit: str) -> None:
        at = iter(turns)
        for edit in audit:
            turn = next(at) if edit != "I" else None
            if edit == "D":
                continue
            if edit == "K":
                role, self.state = turn.role, turn.role[:1]
            else:
                self.state = "a" if self.state == "u" else "u"
                role = NAMES[self.state]
            line = f"{role}:{turn.text if turn else ''}"
            self.sha.update(("\n" if self.lines else "").encode() + line.encode())
            self.lines += 1


class Counts:
    """Counters of a conversation over its rows after damage, in order; those of later rows may be joined on."""

    def __init__(self) -> None:
        self.first: int | None = None
        self.last: int | None = None
        self.distinct = 0
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.opens: str | None = None
        self.closes: str | None = None

    def row(self, turn: int | None, role: str, fault: int) -> None:
        if turn is not None:
            self.distinct += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.faults[fault] += 1
        initial = role[:1]
        if self.closes is not None:
            self.illegal += self.closes + initial not in ("su", "ua", "au")
        else:
            self.opens = initial
        self.closes = initial

    def join(self, later: "Counts") -> None:
        if later.first is not None:
            self.distinct += later.distinct - (later.first == self.last)
            self.first = later.first if self.first is None else self.first
            self.last = later.last
        self.faults = [a + b for a, b in zip(self.faults, later.faults, strict=True)]
        self.illegal += later.illegal
        if later.opens is not None:
            if self.closes is not None:
                self.illegal += self.closes + later.opens not in ("su", "ua", "au")
            else:
                self.opens = later.opens
            self.closes = later.closes

    def values(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT_OFF], self.illegal


# ---------------------------------------------------------------- on tables

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as the rule damages them, under names of their own: _conv, _turn, _role, _text, _copies (0: dropped), _fault (blank, truncated or 0)."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    named = conversations.select(
        F.col("conv_id").cast("long").alias("_conv"), F.col("turn").cast("long").alias("_turn"),
        F.coalesce("role", F.lit(" ")).alias("_role"), F.coalesce("text", F.lit(" ")).alias("_text"),
        (F.crc32(key.cast("binary")) % 20).alias("_rule"),
    )
    rule = F.col("_rule")
    text = F.when(rule < 2, "").when(rule == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    out = named.select(
        "_conv", "_turn", F.when(rule == 0, "").when(rule == 4, "user").otherwise(F.col("_role")).alias("_role"), text.alias("_text"),
        F.when(rule == 0, 0).when(rule == 3, 2).otherwise(1).alias("_copies"),
    )
    end = F.substring(F.rtrim(F.translate("_text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), CUT_OFF).otherwise(0)
    return out.withColumn("_fault", fault)


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("_conv", "_turn", "_role", "_text")]


def _same(a: list, b: list) -> bool:
    return all(x == y for x, y in zip(a, b, strict=True))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


OUT = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
AT_A_TIME = 512  # results in a batch


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations, sorted, none longer than the limits."""
    out: list[tuple] = []

    def close(conv: int | None, rows: list[tuple]) -> tuple:
        counts, turns, seen = Counts(), [], set()
        for _, turn, role, text, copies, fault in rows:
            for _ in range(copies):
                mark = fault if fault == BLANK or (role, text) not in seen else DUPLICATE
                seen.add((role, text))
                counts.row(turn, role, mark)
                turns.append(Turn(role, text, mark))
        if len(turns) <= PIECE_ROWS:
            cost, audit = whole(turns)
            pieces = [(turns, audit)]
        else:
            cuts = [turns[k : k + PIECE_ROWS] for k in range(0, len(turns), PIECE_ROWS)]
            cost, chain = joined([between(c) for c in cuts])
            pieces = []
            for c in cuts:
                pieces.append((c, chain.audit))
                chain = chain.after
            audit = "".join(a for _, a in pieces)
        repaired = Repaired()
        for part, edits in pieces:
            repaired.add(part, edits)
        return (conv, *counts.values(), cost, audit, repaired.sha.hexdigest())

    held: list[tuple] = []
    for row in _rows(batches):
        if held and held[0][0] != row[0]:
            out.append(close(held[0][0], held))
            held = []
            if len(out) == AT_A_TIME:
                yield _batch(out, OUT)
                out = []
        held.append(row)
    if held:
        out.append(close(held[0][0], held))
    if out:
        yield _batch(out, OUT)


PIECE = pa.schema(
    [("_conv", pa.int64()), ("_part", pa.int32()), ("_nth", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("distinct", pa.int64()), ("faults", pa.list_(pa.int64())), ("illegal", pa.int64()),
     ("opens", pa.string()), ("closes", pa.string()), ("ways", pa.list_(pa.string())), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)
PIECE_SCHEMA = "_conv bigint, _part int, _nth bigint, first bigint, last bigint, distinct bigint, faults array<bigint>, illegal bigint, opens string, closes string, ways array<string>, costs array<bigint>, audits array<string>, roles array<string>, texts array<string>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the conversations of one range of rows; a conversation may go on in the next range."""
    from pyspark import TaskContext

    part, nth = TaskContext.get().partitionId(), 0

    def close(conv: int | None, counts: Counts, turns: list[Turn]) -> pa.RecordBatch:
        ways = between(turns)
        row = (conv, part, nth, counts.first, counts.last, counts.distinct, counts.faults, counts.illegal, counts.opens, counts.closes,
               list(ways), [c for c, _ in ways.values()], [a for _, a in ways.values()], [t.role for t in turns], [t.text for t in turns])
        return _batch([row], PIECE)

    open_at: list | None = None
    before: list = []
    counts, turns, size = Counts(), [], 0
    for conv, turn, role, text, copies, fault, earlier in _rows(batches):
        if open_at is not None and open_at != [conv]:
            yield close(open_at[0], counts, turns)
            counts, turns, size, nth, before = Counts(), [], 0, nth + 1, []
        open_at = [conv]
        for _ in range(copies):
            if turns and (len(turns) >= PIECE_ROWS or size >= PIECE_BYTES):
                yield close(conv, counts, turns)
                counts, turns, size, nth = Counts(), [], 0, nth + 1
            again = bool(before) and _same(before, [turn, role, text])
            mark = fault if fault == BLANK or not (earlier or again) else DUPLICATE
            before = [turn, role, text]
            counts.row(turn, role, mark)
            turns.append(Turn(role, text, mark))
            size += len(text)
    if open_at is not None:
        yield close(open_at[0], counts, turns)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their pieces: first come the tables of all pieces of a conversation, then their turns, both in order."""
    conv: list | None = None
    ways: list[dict[str, tuple[int, str]]] = []
    counts, repaired, chain, cost, audit = Counts(), Repaired(), None, 0, ""
    for batch in batches:
        for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
            if conv != [row["_conv"]]:
                if conv is not None:
                    yield _batch([(conv[0], *counts.values(), cost, audit, repaired.sha.hexdigest())], OUT)
                conv, ways, counts, repaired, chain = [row["_conv"]], [], Counts(), Repaired(), None
            if not row["_turns"]:
                later = Counts()
                later.first, later.last, later.distinct, later.faults = row["first"], row["last"], row["distinct"], row["faults"]
                later.illegal, later.opens, later.closes = row["illegal"], row["opens"], row["closes"]
                counts.join(later)
                ways.append({w: (c, a) for w, c, a in zip(row["ways"], row["costs"], row["audits"], strict=True)})
                continue
            if ways:
                cost, chain = joined(ways)
                edits, at = [], chain
                while at is not None:
                    edits.append(at.audit)
                    at = at.after
                audit, ways = "".join(edits), []
            repaired.add([Turn(r, t, 0) for r, t in zip(row["roles"], row["texts"], strict=True)], chain.audit)
            chain = chain.after
    if conv is not None:
        yield _batch([(conv[0], *counts.values(), cost, audit, repaired.sha.hexdigest())], OUT)


def repair(conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = damaged(conversations)
    size = rows.groupBy("_conv").agg(F.sum(F.greatest("_copies", F.lit(1))).alias("n"), F.sum(F.octet_length("_text")).alias("bytes"))
    longs = stored(size.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select(F.col("_conv").alias("_long"), F.lit(1).alias("_is_long")), "long-conversations", large=False)
    known = rows.join(longs, F.col("_conv").eqNullSafe(F.col("_long")), "left")
    columns = ["_conv", "_turn", "_role", "_text", "_copies", "_fault"]
    schema = "conv_id bigint, " + RESULT
    short = known.filter("_is_long is null").select(*columns).repartition("_conv").sortWithinPartitions(*_order()).mapInArrow(_short, schema)
    if longs.isEmpty():
        return short
    long = known.filter("_is_long = 1").select(*columns, F.sha2(F.concat_ws(":", F.length("_role"), "_role", "_text"), 256).alias("_says"))
    # The first turn that says it: a least value, added up before the shuffle; a null turn is before all others.
    first = long.filter("_copies > 0").groupBy("_conv", "_says").agg(F.min(F.struct(F.col("_turn").isNotNull().alias("t"), F.coalesce("_turn", F.lit(0)).alias("v"))).alias("_first"))
    first = first.select(F.col("_conv").alias("_c"), F.col("_says").alias("_s"), "_first")
    mine = F.struct(F.col("_turn").isNotNull().alias("t"), F.coalesce("_turn", F.lit(0)).alias("v"))
    marked = long.join(first, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_says") == F.col("_s")), "left").select(*columns, F.coalesce(mine > F.col("_first"), F.lit(False)).alias("_earlier"))
    marked = stored(marked, "long-conversation-rows")
    n = max(1, int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = stored(marked.repartitionByRange(n, *_order()).sortWithinPartitions(*_order()).mapInArrow(_cut, PIECE_SCHEMA), "conversation-pieces")
    tables = pieces.withColumns({"_turns": F.lit(False), "roles": F.lit(None).cast("array<string>"), "texts": F.lit(None).cast("array<string>")})
    turns = pieces.withColumns({"_turns": F.lit(True), "ways": F.lit(None).cast("array<string>"), "costs": F.lit(None).cast("array<bigint>"), "audits": F.lit(None).cast("array<string>")})
    stream = tables.unionByName(turns).repartition("_conv").sortWithinPartitions(F.col("_conv").asc_nulls_first(), "_turns", "_part", "_nth")
    return short.unionByName(stream.mapInArrow(_joined, schema))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after the rule's damage, repaired at least cost."""
    return repair(table(spark, sf_dir, "conversations"))


#: Another way to the same rows: a walk over the states of the grammar, row by row, that keeps the cheapest edits of each state.
ORACLE = r"""
WITH RECURSIVE steps(i, step, c) AS (
    SELECT i, 0, i::BIGINT FROM range(256) r(i)
    UNION ALL
    SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE step = 8),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
),
ruled AS (
    SELECT keyed.*, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(k) + 1), lambda p: ascii(k[p])::BIGINT),
                        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS rule
    FROM keyed, crc
),
kept AS (
    SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
           CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM ruled, range(2) copies(n)
    WHERE rule <> 0 AND (n = 0 OR rule = 3)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final
    FROM kept
),
heard AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS said FROM placed),
turns AS (
    SELECT *, coalesce(conv_id, -9223372036854775808) AS c, left(role, 1) AS ini,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS ini_before,
           CASE WHEN final = '' THEN 1 WHEN said > 1 THEN 2 WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
    FROM heard
),
counted AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
           count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
           count(*) FILTER (i > 1 AND ini_before || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM turns GROUP BY c
),
inserts(state, more, price, goes, lines) AS (
    VALUES (0, '', 0, 0, []::VARCHAR[]), (1, '', 0, 1, []), (2, '', 0, 2, []), (3, '', 0, 3, []),
           (0, 'I', 2, 2, ['user:']), (0, 'II', 4, 3, ['user:', 'assistant:']), (1, 'I', 2, 2, ['user:']),
           (1, 'II', 4, 3, ['user:', 'assistant:']), (2, 'I', 2, 3, ['assistant:']), (3, 'I', 2, 2, ['user:'])
),
edits(state, ini, edit, price, goes, role) AS (
    VALUES (0, 's', 'K', 0, 1, NULL), (0, 'u', 'K', 0, 2, NULL), (1, 'u', 'K', 0, 2, NULL), (3, 'u', 'K', 0, 2, NULL), (2, 'a', 'K', 0, 3, NULL),
           (0, NULL, 'R', 2, 2, 'user'), (1, NULL, 'R', 2, 2, 'user'), (3, NULL, 'R', 2, 2, 'user'), (2, NULL, 'R', 2, 3, 'assistant'),
           (0, NULL, 'D', 3, 0, NULL), (1, NULL, 'D', 3, 1, NULL), (2, NULL, 'D', 3, 2, NULL), (3, NULL, 'D', 3, 3, NULL)
),
walk(c, i, state, best) AS (
    SELECT c, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} FROM counted
    UNION ALL
    SELECT w.c, w.i + 1, e.goes,
           min({'cost': w.best.cost + s.price + e.price + CASE WHEN e.edit <> 'D' AND t.fault = 3 THEN 1 ELSE 0 END,
                'audit': w.best.audit || s.more || e.edit,
                'lines': w.best.lines || s.lines || CASE WHEN e.edit = 'D' THEN []::VARCHAR[] ELSE [coalesce(e.role, t.role) || ':' || t.text] END})
    FROM walk w
    JOIN turns t ON t.c = w.c AND t.i = w.i + 1
    JOIN inserts s ON s.state = w.state
    JOIN edits e ON e.state = s.goes AND (e.ini IS NULL OR e.ini = t.ini) AND (e.edit = 'D' OR t.fault NOT IN (1, 2))
    GROUP BY w.c, w.i, e.goes
),
ended AS (
    SELECT w.c, min({'cost': w.best.cost + s.price, 'audit': w.best.audit || s.more, 'lines': w.best.lines || s.lines}) AS best
    FROM walk w JOIN counted n ON n.c = w.c AND n.n = w.i JOIN inserts s ON s.state = w.state
    WHERE s.goes IN (0, 3)
    GROUP BY w.c
)
SELECT o.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(n.duplicate, 0)::BIGINT AS duplicate,
       coalesce(n.truncated, 0)::BIGINT AS truncated, coalesce(n.illegal, 0)::BIGINT AS illegal, coalesce(d.best.cost, 0)::BIGINT AS cost,
       coalesce(d.best.audit, '') AS audit, sha256(coalesce(array_to_string(d.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON n.c = coalesce(o.conv_id, -9223372036854775808)
LEFT JOIN ended d ON d.c = n.c
"""
