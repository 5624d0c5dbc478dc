"""Packing of documents into training windows by minimum bin slack.

Documents are encoded and closed with an end id.  A document is a row of full windows and a rest of under ``capacity`` ids.  What
is to be packed is then known from how many pieces there are of each length, ``capacity`` counts at most however large the corpus
is.  ``plan`` fills window after window from these counts: the longest piece left is set, and a subset-sum dynamic program over bit
sets finds the multiset of remaining lengths that comes closest to the capacity; tracing it back gives how many pieces of
each length the window takes.  A filling is repeated as often as its counts last, so hot lengths cost one step.  Where a filling
leaves slack, one more piece is cut to close it and its remainder goes back to the counts.  The ids of the last, unfilled window
are cut into sequences of powers of two, so nothing is padded.

Pieces find their place without meeting each other: a piece's number among those of its length is its number within its part of
the corpus plus the counts of the parts before, and the plan says for ranges of such numbers which sequence and offset they get.
Only rows of three small columns are joined; ids are carried along for lengths that the plan cuts, and the checksums of all other
pieces are known from the encoding pass.

Edge cases: null and empty texts have one id, the end; null ids come back null; repeated rows are packed each for itself; a text of
any length becomes full windows and a rest; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitspark.llm.common import id_text, real_id, stored, table
from pitspark.llm.subwords import encoded, subwords

CAPACITY = 1024

#: Pieces ``first`` to ``last - 1`` of length ``size``: ``each`` of them in a sequence, from ``sequence`` on, at ``offset``; ``taken`` ids of each, the rest being pieces of their own from number ``rest`` on.
PLAN_COLUMNS = ("size", "first", "last", "each", "sequence", "offset", "taken", "rest")


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, the longest among them, whose sum comes closest to the capacity."""
    sizes = sorted((s for s, n in counts.items() if n), reverse=True)
    anchor, mask = sizes[0], (1 << (capacity + 1)) - 1
    reach, steps = 1 << anchor, []
    for size in sizes:
        most = min(counts[size] - (size == anchor), (capacity - anchor) // size)
        if most <= 0:
            continue
        steps.append((size, most, reach))
        at = 1
        while most > 0:
            reach |= reach << (min(at, most) * size) & mask
            most -= at
            at *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    chosen = Counter({anchor: 1})
    for size, most, before in reversed(steps):
        n = next(n for n in range(most + 1) if total >= n * size and before >> (total - n * size) & 1)
        if n:
            chosen[size] += n
            total -= n * size
    return dict(chosen)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces of each length go, as rows of ``PLAN_COLUMNS``."""
    left = {s: n for s, n in counts.items() if n}
    used: Counter = Counter()  # pieces of a length that have their place
    made = Counter(left)  # pieces of a length there are, remainders included
    out: list[tuple[int, ...]] = []
    sequence = 0

    def place(size: int, n: int, each: int, offset: int, taken: int) -> None:
        rest = made[size - taken] if taken < size else -1
        out.append((size, used[size], used[size] + n, each, sequence, offset, taken, rest))
        used[size] += n
        left[size] -= n
        if not left[size]:
            del left[size]
        if taken < size:
            made[size - taken] += n
            left[size - taken] = left.get(size - taken, 0) + n

    while left:
        chosen = fill(left, capacity)
        slack = capacity - sum(s * n for s, n in chosen.items())
        spare = [s for s, n in left.items() if n > chosen.get(s, 0)]
        if slack and not spare:
            break
        need = Counter(chosen)
        cut = max(spare, key=lambda s: (left[s] // (chosen.get(s, 0) + 1), s)) if slack else 0
        if cut:
            need[cut] += 1
        times = min(left[s] // n for s, n in need.items())
        offset = 0
        for size, n in sorted(chosen.items(), reverse=True):
            place(size, n * times, n, offset, size)
            offset += n * size
        if cut:
            place(cut, times, 1, offset, slack)
        sequence += times
    while left:  # under one window: sequences of powers of two
        room = 1 << (sum(s * n for s, n in left.items()).bit_length() - 1)
        offset = 0
        while offset < room:
            size = max(left)
            taken = min(size, room - offset)
            place(size, 1, 1, offset, taken)
            offset += taken
        sequence += 1
    return np.array(sorted(out), dtype=np.int64).reshape(-1, len(PLAN_COLUMNS))


def _encode_part(tokenizer_path: str, end_id: int, capacity: int):
    """Encode the documents of a part and number their pieces by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        wide = subwords(tokenizer_path).dtype
        end = np.array([end_id], dtype=wide)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            names = batch.column("_id")
            for at, to, ids, first in encoded(batch, tokenizer_path):
                total = np.diff(first) + 1
                ids = np.insert(ids, first[1:], end)
                stop = np.cumsum(total)
                full, rest = total // capacity, total % capacity
                # Number of each document's rest among the rests of that length in this part, and of its first full window.
                order = np.argsort(rest, kind="stable")
                by_size = rest[order]
                begin = np.searchsorted(by_size, by_size)
                nth = np.empty(len(rest), dtype=np.int64)
                nth[order] = np.arange(len(rest)) - begin + seen[by_size]
                seen[:capacity] += np.bincount(rest, minlength=capacity)
                nth_full = seen[capacity] + np.cumsum(full) - full
                seen[capacity] += full.sum()
                four = memoryview(ids.astype("<u4").tobytes())
                crcs, rest_crc, tails = [], [], []
                for a, n, f in zip((stop - total).tolist(), total.tolist(), full.tolist(), strict=True):
                    crcs.append([zlib.crc32(four[4 * (a + k) : 4 * (a + k + capacity)]) for k in range(0, f * capacity, capacity)])
                    a, b = a + f * capacity, a + n
                    rest_crc.append(zlib.crc32(four[4 * a : 4 * b]))
                    tails.append(ids[a:b].tobytes())
                cols = [names.slice(at, to - at), np.full(to - at, part, dtype=np.int32), total, full, nth_full, rest, nth]
                yield pa.RecordBatch.from_arrays(
                    [*(c if isinstance(c, pa.Array) else pa.array(c) for c in cols), pa.array(crcs, pa.list_(pa.int64())), pa.array(rest_crc, pa.int64()), pa.array(tails, pa.binary())],
                    names=["_id", "part", "doc_tokens", "full", "nth_full", "rest", "nth", "crcs", "rest_crc", "tail"],
                )

    return run


PART_SCHEMA = "_id bigint, part int, doc_tokens bigint, full bigint, nth_full bigint, rest bigint, nth bigint, crcs array<bigint>, rest_crc bigint, tail binary"


def _place(rows: np.ndarray, capacity: int, wide: np.dtype):
    """Give every piece its sequence and offset by the plan."""
    size = rows[:, 0]
    key = size << 48 | rows[:, 1]  # of each range: its length and first number

    def look_up(lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(key, lengths << 48 | numbers, side="right") - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc_tokens", "full", "nth_full", "rest", "nth")}
            n = batch.num_rows
            doc = np.repeat(np.arange(n), col["full"])
            k = np.arange(len(doc)) - np.repeat(np.cumsum(col["full"]) - col["full"], col["full"])
            at = look_up(np.full(len(doc), capacity, dtype=np.int64), col["nth_full"][doc] + k)
            number = col["nth_full"][doc] + k - rows[at, 1]
            crcs = batch.column("crcs").flatten().to_numpy(zero_copy_only=False)
            parts = [(doc, k * capacity, np.full(len(doc), capacity), crcs, rows[at, 4] + number, rows[at, 5])]
            # Rests: a cut one leaves a piece that is looked up again.
            doc = np.flatnonzero(col["rest"])
            length, number = col["rest"][doc], col["nth"][doc]
            start = col["full"][doc] * capacity
            crc = batch.column("rest_crc").to_numpy(zero_copy_only=False)
            tails = batch.column("tail")
            while len(doc):
                at = look_up(length, number)
                _, first, _, each, sequence, offset, taken, rest = rows[at].T
                nth = number - first
                whole = (taken == length) & (length == col["rest"][doc])
                sums = np.where(whole, crc[doc], 0)
                for i in np.flatnonzero(~whole).tolist():
                    d = int(doc[i])
                    a = int(start[i] - col["full"][d] * capacity)
                    sums[i] = zlib.crc32(np.frombuffer(tails[d].as_py(), dtype=wide)[a : a + int(taken[i])].astype("<u4").tobytes())
                parts.append((doc, start, taken, sums, sequence + nth // each, offset + nth % each * taken))
                go = taken < length
                doc, start, length, number = doc[go], (start + taken)[go], (length - taken)[go], (rest + nth)[go]
            doc, start, taken, sums, sequence, offset = (np.concatenate(c) for c in zip(*parts, strict=True))
            cols = [batch.column("_id").take(pa.array(doc)), *map(pa.array, (start, taken, sums.astype(np.int64), col["doc_tokens"][doc], sequence, offset))]
            yield pa.RecordBatch.from_arrays(cols, names=["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if not 2 <= capacity < 1 << 15:
        raise ValueError("a window holds 2 to 32767 ids")
    parts = stored(id_text(docs, id_col, text_col).mapInArrow(_encode_part(tokenizer_path, end_id, capacity), PART_SCHEMA), "packing-parts")
    sizes = F.array(F.struct(F.lit(capacity).cast("long").alias("size"), F.col("full").alias("n")), F.struct(F.col("rest").alias("size"), F.signum("rest").cast("long").alias("n")))
    counts = parts.select("part", F.inline(sizes)).filter("n > 0").groupBy("part", "size").agg(F.sum("n").alias("n"))
    counts = stored(counts, "packing-counts", large=False)
    held = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most one row a length
    rows = plan(held, capacity)
    before = counts.select("part", "size", (F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")).alias("before"))
    # Numbers in the corpus: those in the part plus the pieces of that length in the parts before.
    of_part = before.groupBy("part").agg(
        F.max(F.when(F.col("size") == capacity, F.col("before"))).alias("full_before"), F.map_from_entries(F.collect_list(F.struct("size", "before"))).alias("rest_before")
    )  # a part has at most one entry for each length
    cut = sorted(set(rows[rows[:, 6] < rows[:, 0], 0].tolist()))
    numbered = parts.join(of_part, "part").select(
        "_id", "doc_tokens", "full", "rest", "crcs", "rest_crc",
        (F.col("nth_full") + F.coalesce("full_before", F.lit(0))).alias("nth_full"),
        (F.col("nth") + F.coalesce(F.col("rest_before")[F.col("rest")], F.lit(0))).alias("nth"),
        F.when(F.col("rest").isin(cut), F.col("tail")).alias("tail"),
    )
    out = numbered.mapInArrow(_place(rows, capacity, subwords(tokenizer_path).dtype), "_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
    return out.select(real_id().alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
