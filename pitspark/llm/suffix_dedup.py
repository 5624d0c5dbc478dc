"""Removal of repeated byte strings with a distributed, sampled suffix array.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts earlier (smaller id, or same document and earlier
start).  Not every suffix is sorted: each window of ``LENGTH`` bytes picks the suffix that starts at the least hash among its
``GRAM``-byte grams, so equal windows pick suffixes at equal offsets, and about one suffix in thirty is kept.

1. Splitters sampled from the leading bytes of suffixes cut them into ranges; a range goes to one task, which sorts it by
   gram, context and position.  Suffixes that share their leading bytes are never cut apart, so comparing
   neighbours inside a range is complete across ranges as well.  The context of a suffix is all bytes of the windows that
   picked it.
2. Among sorted neighbours, a suffix whose context occurred earlier is repeated with all its windows.
3. Where different contexts share a gram, the first suffix of each context lists its windows one by one; these are sorted
   once more by hash, id and start, and each window that equals its neighbour is a later copy.  Both passes stream over
   sorted rows, so a group of any size takes no more memory than one row.
4. Windows found repeated are merged per document and cut out.

Contexts, grams and windows are compared by 64-bit hashes under a common gram.  Matches never cross documents.

Edge cases: null text is empty; texts shorter than ``LENGTH`` stay whole; rows that repeat an id and a text count as one document;
rows that repeat an id with other texts are ordered by a hash of the text; null ids come first and come back null; an empty table
gives an empty result; other columns are not read by the query and pass through ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import NULL_ID, id_text, mix, prefix_hash, range_hash, real_id, stored, table, text_blocks

LENGTH = 100
GRAM = 40
SPAN = LENGTH - GRAM + 1  # grams in a window
SPLIT_DOCS = 2_000  # documents sampled for splitters
RANGES_A_TASK = 8


def picks(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Picked suffixes of a block: text number, start in the block, first and last window, gram hash, leading bytes; and the prefix sums."""
    n = len(data)
    c, down = prefix_hash(data)
    none = np.zeros(0, dtype=np.int64)
    out = {"doc": none, "at": none, "lo": none, "hi": none, "gram": none.astype(np.uint64), "lead": none.astype(np.uint64), "sums": c, "down": down}
    if n < LENGTH:
        return out
    starts = np.arange(n - GRAM + 1)
    gram = range_hash(c, down, starts, starts + GRAM)
    bits = np.uint64(n.bit_length())
    least = ((gram >> bits) << bits) | starts.astype(np.uint64)  # equal hashes: the leftmost
    width = 1
    while width * 2 <= SPAN:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = SPAN - width
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    first, last = bounds[:-1], bounds[1:] - LENGTH
    whole = np.flatnonzero(last >= first)
    if not len(whole):
        return out
    counts = (last - first + 1)[whole]
    windows = np.repeat(first[whole] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    owner = np.repeat(whole, counts)
    at = (least[windows] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    at = at[heads]
    lead = np.zeros(len(at), dtype=np.uint64)
    for k in range(8):
        lead = (lead << np.uint64(8)) | data[at + k].astype(np.uint64)
    return out | {"doc": owner[heads], "at": at, "lo": windows[heads], "hi": windows[tails], "gram": gram[at], "lead": lead}


def _ordered(lead: np.ndarray) -> np.ndarray:
    """Unsigned leading bytes as signed integers of the same order."""
    return (lead ^ np.uint64(1 << 63)).view(np.int64)


def _sample_leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, bounds in text_blocks(batch):
            yield pa.RecordBatch.from_arrays([pa.array(_ordered(picks(data, bounds)["lead"])[::16])], names=["lead"])


#: place: start of the suffix, bytes from the first window to it, windows after the first (31, 7 and 7 bits).
_SUFFIX = "bucket int, gram bigint, context bigint, _id bigint, _th bigint, place bigint"


def _suffixes(splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
            for row, _, data, bounds in text_blocks(batch):
                p = picks(data, bounds)
                if not len(p["at"]):
                    continue
                context = range_hash(p["sums"], p["down"], p["lo"], p["hi"] + LENGTH)
                context = mix(context + ((p["at"] - p["lo"]) << 16).astype(np.uint64))
                doc = p["doc"] + row
                place = ((p["at"] - bounds[p["doc"]]) << 14) | ((p["at"] - p["lo"]) << 7) | (p["hi"] - p["lo"])
                bucket = np.searchsorted(splitters, _ordered(p["lead"])).astype(np.int32)
                cols = [bucket, p["gram"].view(np.int64), context.view(np.int64), ids[doc], th[doc], place]
                # Combined before the shuffle: of equal contexts in the block only the first meets the other blocks, the rest
                # are repeats already.  They are dealt anywhere, marked by a negative place.
                order = np.lexsort((place, cols[4], cols[3], cols[2], cols[1]))
                again = order[1:][(cols[1][order[1:]] == cols[1][order[:-1]]) & (cols[2][order[1:]] == cols[2][order[:-1]])]
                bucket[again] = -1 - (again % 4096 + row) % 4096
                place[again] = -1 - place[again]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=[f.split(" ")[0] for f in _SUFFIX.split(", ")])

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over sorted suffixes: repeated suffixes (gram null), and the first suffix of each context where a gram has several."""
    names = ["gram", "context", "_id", "_th", "place"]
    last: list[np.ndarray] | None = None  # the latest suffix
    head: list[np.ndarray] | None = None  # the latest first-of-its-context
    told = False  # whether head is out already

    def out(cols: list[np.ndarray], where: np.ndarray, repeated: bool) -> pa.RecordBatch:
        place = cols[4][where]
        at = place >> 14
        lo = at - (place >> 7 & 127)
        gram = pa.nulls(len(where), pa.int64()) if repeated else pa.array(cols[0][where])
        spots = [pa.array(x.astype(np.int32)) for x in (at, lo, lo + (place & 127))]
        return pa.RecordBatch.from_arrays([gram, pa.array(cols[2][where]), pa.array(cols[3][where]), *spots], names=["gram", "_id", "_th", "at", "lo", "hi"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in names]
        known = cols[4] < 0  # found before the shuffle
        if known.any():
            marked = [c[known] for c in cols]
            marked[4] = -1 - marked[4]
            yield out(marked, np.arange(len(marked[4])), True)
            cols = [c[~known] for c in cols]
            if not len(cols[4]):
                continue
        before = [np.concatenate([b[:1] if last is None else a, b[:-1]]) for a, b in zip(last or cols, cols, strict=True)]
        same = (cols[0] == before[0]) & (cols[1] == before[1])
        same[0] &= last is not None
        last = [c[-1:] for c in cols]
        repeats = np.flatnonzero(same)
        if len(repeats):
            yield out(cols, repeats, True)
        heads = [c[~same] for c in cols]
        if not len(heads[0]):
            continue
        carried = head is not None
        if carried:
            heads = [np.concatenate([a, b]) for a, b in zip(head, heads, strict=True)]
        alike = heads[0][1:] == heads[0][:-1]  # with the head after it
        shared = np.zeros(len(heads[0]), dtype=bool)
        shared[1:] |= alike
        shared[:-1] |= alike
        where = np.flatnonzero(shared[1:]) + 1 if carried and told else np.flatnonzero(shared)
        if len(where):
            yield out(heads, where, False)
        told = bool(shared[-1])
        head = [c[-1:] for c in heads]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every window of the listed suffixes."""
    for batch in batches:
        picked = batch.column("picked")
        edges = np.asarray(picked.offsets)
        flat = picked.values
        gram, at, lo, hi = (np.asarray(flat.field(c)).astype(np.int64) for c in ("gram", "at", "lo", "hi"))
        ids, th = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        for row, to, data, bounds in text_blocks(batch):
            own = slice(edges[row], edges[to])
            doc = np.repeat(np.arange(row, to), np.diff(edges[row : to + 1]))
            n = hi[own] - lo[own] + 1
            if not len(n):
                continue
            c, down = prefix_hash(data)
            start = np.arange(n.sum()) + np.repeat(lo[own] - (np.cumsum(n) - n), n)
            doc = np.repeat(doc, n)
            s = start + bounds[doc - row]
            near = np.repeat(at[own], n) - start
            h = mix(range_hash(c, down, s, s + LENGTH) + near.astype(np.uint64)) ^ np.repeat(gram[own], n).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[doc]), pa.array(th[doc]), pa.array(start.astype(np.int32))], names=["window", "_id", "_th", "start"])


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over sorted windows: those that equal the one before, as (start, end)."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("window").to_numpy()
        before = np.concatenate([h[:1] if last is None else last, h[:-1]])
        same = h == before
        same[0] &= last is not None
        last = h[-1:]
        where = np.flatnonzero(same)
        start = batch.column("start").to_numpy()[where]
        yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[where]) for c in ("_id", "_th")] + [pa.array(start), pa.array(start + np.int32(LENGTH))], names=["_id", "_th", "start", "end"])


def repeated_spans(plain: DataFrame) -> DataFrame:
    """plain: _id, _th, _text.  Later repeated windows of every document as ``spans``, unordered (start, end) byte ranges."""
    spark = plain.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = plain.count()
    part = plain if n <= SPLIT_DOCS else plain.filter(F.pmod(F.xxhash64("_id"), F.lit(n // SPLIT_DOCS)) == 0)
    leads = part.mapInArrow(_sample_leads, "lead bigint")
    cuts = [k / (tasks * RANGES_A_TASK) for k in range(1, tasks * RANGES_A_TASK)]
    splitters = np.array(leads.agg(F.percentile_approx("lead", cuts, 10_000)).first()[0] or [], dtype=np.int64)
    splitters = np.unique(splitters)

    suffixes = plain.mapInArrow(_suffixes(splitters), _SUFFIX)
    sorted_ = suffixes.repartition(tasks, "bucket").sortWithinPartitions("bucket", "gram", "context", "_id", "_th", "place")
    found = stored(sorted_.mapInArrow(_neighbours, "gram bigint, _id bigint, _th bigint, at int, lo int, hi int"), "suffixes")
    whole = found.filter("gram is null").select("_id", "_th", F.col("lo").alias("start"), (F.col("hi") + LENGTH).alias("end"))

    listed = found.filter("gram is not null").groupBy("_id", "_th").agg(F.collect_list(F.struct("gram", "at", "lo", "hi")).alias("picked"))
    texts = plain.join(listed, ["_id", "_th"]).select("_id", "_th", "_text", "picked")
    windows = texts.mapInArrow(_windows, "window bigint, _id bigint, _th bigint, start int")
    windows = windows.repartition(tasks, "window").sortWithinPartitions("window", "_id", "_th", "start")
    single = stored(windows.mapInArrow(_repeats, "_id bigint, _th bigint, start int, end int"), "windows")
    return whole.unionByName(single).groupBy("_id", "_th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _tie(plain: DataFrame) -> F.Column:
    """What tells documents of one id apart: a hash of the text, or 0 where no id repeats."""
    most = plain.groupBy("_id").count().agg(F.max("count")).first()[0]
    return F.lit(0).cast("long") if most in (None, 1) else F.xxhash64("_text")


def _spans(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, F.Column]:
    plain = id_text(docs, id_col, text_col)
    tie = _tie(plain)
    keyed = plain.withColumn("_th", tie)
    return repeated_spans(keyed if "_text" not in str(tie) else keyed.dropDuplicates(["_id", "_th"])), tie


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``kept`` (remaining bytes) and ``removed`` (byte ranges), all columns passed through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_merged(s) for s in batch.column("spans").to_pylist()]
            kept = [_cut(t.encode(), s) for t, s in zip(batch.column("_text").to_pylist(), spans, strict=True)]
            removed = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            rest = [batch.column(k) for k, c in enumerate(batch.schema.names) if c.startswith("_c")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(kept, pa.binary()), removed], names=[*(f"_c{k}" for k in range(len(rest))), "kept", "removed"])

    at = docs.columns
    spans, tie = _spans(docs, id_col, text_col)
    rows = docs.select(*(F.col(c).alias(f"_c{k}") for k, c in enumerate(at)), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_th", tie)
    kinds = ", ".join(f"{c} {t}" for c, t in rows.drop("_id", "_text", "_th").dtypes)
    both = rows.join(spans, ["_id", "_th"], "left").select(*(f"_c{k}" for k in range(len(at))), "_text", "spans")
    out = both.mapInArrow(run, f"{kinds}, kept binary, removed array<struct<start:bigint,end:bigint>>")
    return out.select(*(F.col(f"_c{k}").alias(c) for k, c in enumerate(at)), "kept", "removed")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: bytes, removed bytes, removed runs, and the SHA-256 of what remains."""
    docs = table(spark, sf_dir, "documents")
    spans_of, tie = _spans(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, runs, sha = [], [], [], []
            for t, s in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw, spans = t.encode(), _merged(s)
                kept = _cut(raw, spans)
                size.append(len(raw))
                gone.append(len(raw) - len(kept))
                runs.append(len(spans))
                sha.append(hashlib.sha256(kept).hexdigest())
            cols = [batch.column("_id"), *(pa.array(x, pa.int64()) for x in (size, gone, runs)), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    both = id_text(docs).withColumn("_th", tie).join(spans_of, ["_id", "_th"], "left").select("_id", "_text", "spans")
    out = both.mapInArrow(run, "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.select(real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
