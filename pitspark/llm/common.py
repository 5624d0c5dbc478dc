"""Helpers shared by the operators of this subpackage: tables, shared storage, vectorised text hashing."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = -(2**63)  # stands for a null id inside an operator; such rows sort first and come out with a null id again
WORD_BREAKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)  # fixed values: what separates words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 1 << 20  # text handled by one round of numpy calls; bounds the memory of a task
BATCH_ROWS = 700  # rows that Spark hands to Python at once in operators on whole texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir`` of the session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/")


def stored(df: DataFrame, name: str, large: bool = True) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later readers start from files, not from its lineage.

    After a large table the shuffle files that led to it are released at once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    del df
    if large:
        release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs now; its cleaner otherwise waits for the driver's next collection."""
    for _ in range(2):  # at first the listeners of the job that has just ended may still hold its plan
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand at most ``BATCH_ROWS`` rows at once to Python: a batch of whole texts is held on both sides, by every task at work.

    The session's own number stays where it is smaller.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:  # 0 and less: no limit
        spark.conf.set(key, str(BATCH_ROWS))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what an operator reads, under names of its own, so that no other column can clash."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )


def real_id(col: str = "_id") -> Column:
    return F.when(F.col(col) != F.lit(NULL_ID), F.col(col))


def held_out(col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % folds == 0


# ---------------------------------------------------------------- text as numpy arrays

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible finalizer)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _S30)) * _M1
        h = (h ^ (h >> _S27)) * _M2
        return h ^ (h >> _S31)


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(WORD_BREAKS)] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 4096)
        steps = np.full(size, _BASE, dtype=np.uint64)
        back = np.full(size, pow(_BASE, -1, 2**64), dtype=np.uint64)
        steps[0] = back[0] = 1
        with np.errstate(over="ignore"):
            _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums c and inverse powers d: bytes [s, e) hash to mix((c[e] - c[s]) * d[s])."""
    up, down = powers(len(data) + 1)
    c = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_VALUES[data] * up[:-1], out=c[1:])
    return c, down


def range_hash(c: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((c[end] - c[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """Words of a block of texts: ``hash[i]``, byte range ``start[i]:end[i]`` in the block, ``doc[i]``; document d owns ``first[d]:first[d + 1]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, within: np.ndarray | None = None, accents: bool = False):
        """data: bytes of the texts in a row; bounds: len(texts) + 1 offsets; within: by byte, whether it belongs to words; accents: lower-case accented Latin letters too."""
        low = _FOLD[data]
        if accents:
            at = np.flatnonzero(low[:-1] == 0xC3) + 1
            at = at[(low[at] >= 0x80) & (low[at] <= 0x9E) & (low[at] != 0x97)]
            low[at] += 0x20
        inside = (~_BREAK if within is None else within)[low]
        edge = np.zeros(len(low) + 1, dtype=bool)
        edge[bounds] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:] | edge[1:-1]
        self.low = low
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        self.sums, self.down = prefix_hash(low)
        self.hash = self.range_hash(self.start, self.end)
        self.first = np.searchsorted(self.start, bounds)
        self.doc = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return range_hash(self.sums, self.down, start, end)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word runs within a text, and the text of each; a text of fewer words (one at least) gives one run of all of them."""
        w, first = self.hash, self.first
        if len(w) >= n:
            h = w[: len(w) - n + 1].copy()
            with np.errstate(over="ignore"):
                for j in range(1, n):
                    h = mix(h * np.uint64(0xD1342543DE82EF95) + w[j : len(w) - n + 1 + j])
            keep = self.doc[: len(w) - n + 1] == self.doc[n - 1 :]
            h, d = h[keep], self.doc[: len(w) - n + 1][keep]
        else:
            h, d = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        count = np.diff(first)
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            more = np.zeros(len(short), dtype=np.uint64)
            for k, doc in enumerate(short):
                x = int(count[doc])
                for v in w[first[doc] : first[doc + 1]].tolist():
                    x = (x * 0xD1342543DE82EF95 + v) & (2**64 - 1)
                    x ^= x >> 29
                more[k] = x
            h, d = np.concatenate([h, mix(more)]), np.concatenate([d, short])
            order = np.argsort(d, kind="stable")
            h, d = h[order], d[order]
        return h, d


def text_blocks(batch: pa.RecordBatch, column: str = "_text", limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into row ranges of about ``limit`` bytes (a longer text is a range of its own): first row, last row + 1, bytes, offsets."""
    col = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield at, to, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def distinct_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal byte ranges found by their hashes and compared byte by byte: an index of one range of each kind, and the kind of every range."""
    order = np.argsort(hashes, kind="stable")
    in_order = hashes[order]
    new = np.ones(len(order), dtype=bool)
    np.not_equal(in_order[1:], in_order[:-1], out=new[1:])
    one = order[new]
    kind = np.empty(len(order), dtype=np.int64)
    kind[order] = np.cumsum(new) - 1
    rep = one[kind]
    long = end - start
    same = np.array_equal(long, long[rep])
    if same:
        at = np.repeat(start - np.cumsum(long) + long, long) + np.arange(int(long.sum()))
        same = np.array_equal(data[at], data[at + np.repeat(start[rep] - start, long)])
    if not same:  # two ranges with one hash: count them by their bytes
        raw = data.tobytes()
        seen: dict[bytes, int] = {}
        kind = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)], dtype=np.int64)
        one = np.unique(kind, return_index=True)[1]
    return one, kind
