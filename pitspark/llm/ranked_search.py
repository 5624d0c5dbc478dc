"""Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt to owners, ``OWNERS`` stages by the length of a term: long terms, which are rare, come first.
One pass over the documents writes an inverted index of the items' terms, cut into blocks of documents and split by owner.  A bundle
of up to ``BUNDLE_ITEMS`` items then passes through the owners' stages for each block of documents: it carries sparse accumulators
(item, document, score so far) and meets, by cogroup on (block, bundle), the postings of the stage's owner, whose integer
contributions are added.  Before a bundle goes on, an accumulator is left behind if even the greatest contribution of all terms
still to come cannot lift its document to the block's tenth best score so far; what later stages add for such a document stays below that
score, so it never comes back.  The last stage selects the best of each block, and a window the best of all.

The documents are read once.  The filter of that pass is a bit map of term hashes of fixed size, exact terms are matched in the
stages.  Counts of documents and terms are sums over the index.  Bundles reach the blocks by a join on (bundle, salt), so no
broadcast grows with the items.

Edge cases: null and empty texts have no term; a document row is one document, whatever its id; null ids come back null and sort first;
an item is a distinct pair of id and text; items without a known term and empty tables give no rows; a long text is read in pieces
cut between terms; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitspark.llm.common import LOWER, UPPER, Words, distinct_runs, id_text, real_id, shared_dir, stored, table, text_blocks

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # fixed value
OWNER_BYTES = (9, 7, 5)  # a term of so many bytes or more belongs to owner 0, 1, 2; shorter ones to the last
OWNERS = len(OWNER_BYTES) + 1
TOP = 10
BUNDLE_ITEMS = 256
BLOCK_DOCS = 4096  # documents of a block, and so the width of an item's accumulators
BLOCK_POSTINGS = 1 << 20
PIECE_BYTES = 1 << 20
MAP_BITS = 20

_IN_TERM = np.ones(256, dtype=bool)
_IN_TERM[:128] = False
_IN_TERM[48:58] = _IN_TERM[65:91] = _IN_TERM[97:123] = True

INDEX_SCHEMA = "owner int, block bigint, ids array<bigint>, lengths array<bigint>, terms array<string>, counts array<int>, docs array<int>, tfs array<bigint>"
INDEX = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])


def owner_of(term: Column) -> Column:
    size, out = F.octet_length(term), F.lit(len(OWNER_BYTES))
    for k, least in reversed(list(enumerate(OWNER_BYTES))):
        out = F.when(size >= least, k).otherwise(out)
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _term_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, bounds in text_blocks(batch, "term"):
            bit = _bits(Words(data, bounds, within=_IN_TERM).hash)
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 6), pa.array(np.left_shift(np.int64(1), bit & 63))], names=["word", "bits"])


def _pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A range of texts as it is, or a long text in pieces cut between terms: number of the first text, bytes, offsets."""
    if len(data) <= 2 * PIECE_BYTES or len(bounds) > 2:
        yield 0, data, bounds
        return
    at = 0
    while at < len(data):
        to = min(len(data), at + PIECE_BYTES)
        while to < len(data):  # to the end of the term that is cut
            stop = np.flatnonzero(~_IN_TERM[data[to : to + PIECE_BYTES]])
            to = to + int(stop[0]) if len(stop) else min(len(data), to + PIECE_BYTES)
            if len(stop):
                break
        yield 0, data[at:to], np.array([0, to - at])
        at = to


class _Block:
    """Postings of a block of documents on their way to the index."""

    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.docs = self.postings = 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # term number, document, times
        self.terms: dict[bytes, int] = {}

    def add(self, ids: np.ndarray, data: np.ndarray, bounds: np.ndarray, wanted: np.ndarray) -> None:
        length = np.zeros(len(ids), dtype=np.int64)
        for first, piece, cut in _pieces(data, bounds):
            words = Words(piece, cut, within=_IN_TERM)
            length[first : first + len(cut) - 1] += np.diff(words.first)
            bit = _bits(words.hash)
            hit = np.flatnonzero(wanted[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1))
            if not len(hit):
                continue
            start, end = words.start[hit], words.end[hit]
            one, kind = distinct_runs(words.low, start, end, words.hash[hit])
            raw = words.low.tobytes()
            number = np.array([self.terms.setdefault(raw[a:b], len(self.terms)) for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)], dtype=np.int64)
            pair, times = np.unique(number[kind] << 32 | (words.doc[hit] + first + self.docs), return_counts=True)
            self.parts.append((pair >> 32, pair & 0xFFFFFFFF, times))
            self.postings += len(pair)
        self.ids.append(ids)
        self.lengths.append(length)
        self.docs += len(ids)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        ids, lengths = np.concatenate(self.ids), np.concatenate(self.lengths)
        out = [(-1, block, ids, lengths, [], [], [], [])]
        if self.parts:
            term, doc, times = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            key = term << 32 | doc  # pieces of a long text repeat a pair
            order = np.argsort(key, kind="stable")
            new = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
            times = np.add.reduceat(times[order], new)
            term, doc = term[order][new], doc[order][new]
            words = list(self.terms)
            owner = np.array([next((k for k, least in enumerate(OWNER_BYTES) if len(w) >= least), len(OWNER_BYTES)) for w in words])
            for k in range(OWNERS):
                mine = owner[term] == k
                if not mine.any():
                    continue
                number, count = np.unique(term[mine], return_counts=True)
                out.append((k, block, [], [], [words[t].decode() for t in number.tolist()], count, doc[mine], times[mine]))
        for row in out:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, INDEX, strict=True)], schema=INDEX)


def _index(wanted: bytes, block_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted, dtype=np.uint64)
        part, nth, block = TaskContext.get().partitionId(), 0, _Block()
        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            for at, to, data, bounds in text_blocks(batch):
                while at < to:  # a block holds so many documents at most
                    n = min(to - at, block_docs - block.docs)
                    block.add(ids[at : at + n], data[bounds[0] : bounds[n]], bounds[: n + 1] - bounds[0], bits)
                    at, bounds = at + n, bounds[n:]
                    if block.docs >= block_docs or block.postings >= BLOCK_POSTINGS:
                        yield from block.rows(part << 32 | nth)
                        nth, block = nth + 1, _Block()
        if block.docs:
            yield from block.rows(part << 32 | nth)

    return run


BUNDLE_SCHEMA = "block bigint, bundle long, ids array<bigint>, m array<bigint>, load array<struct<owner int, terms array<string>, weights array<bigint>, holders array<array<int>>>>, n_items int, acc_item array<int>, acc_doc array<int>, acc_score array<bigint>"
FOUND_SCHEMA = "bundle long, item int, _id bigint, score long"


def _best(scores: np.ndarray, top: int) -> np.ndarray:
    """The top-th highest score of each row above 0, 0 where fewer are."""
    if scores.shape[1] <= top:
        return scores.min(axis=1) if scores.shape[1] == top else np.zeros(len(scores), dtype=np.int64)
    return np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]


def _stage(owner: int, top: int):
    """Add the contributions of an owner's terms to the accumulators that a bundle carries."""

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        last = owner == OWNERS - 1
        kinds = pa.schema([("bundle", pa.int64()), ("item", pa.int32()), ("_id", pa.int64()), ("score", pa.int64())]) if last else bundle.schema
        if not bundle.num_rows:
            return kinds.empty_table()
        carried = {n: bundle.column(n)[0].values for n in ("ids", "m", "acc_item", "acc_doc", "acc_score")}
        ids, m = (carried[n].to_numpy(zero_copy_only=False) for n in ("ids", "m"))
        n_items = bundle.column("n_items")[0].as_py()
        load = {x["owner"]: x for x in bundle.column("load")[0].as_py()}
        scores = np.zeros((n_items, len(ids)), dtype=np.int64)
        scores[carried["acc_item"].to_numpy(zero_copy_only=False), carried["acc_doc"].to_numpy(zero_copy_only=False)] = carried["acc_score"].to_numpy(zero_copy_only=False)
        mine = load.pop(owner, None)
        if mine and postings.num_rows:
            terms = postings.column("terms")[0].as_py()
            stop = np.cumsum(postings.column("counts")[0].values.to_numpy(zero_copy_only=False), dtype=np.int64)
            docs, tfs = (postings.column(n)[0].values.to_numpy(zero_copy_only=False) for n in ("docs", "tfs"))
            share = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[docs])
            place = {t: k for k, t in enumerate(terms)}
            for term, weight, holders in zip(mine["terms"], mine["weights"], mine["holders"], strict=True):
                k = place.get(term)
                if k is not None and weight:
                    a, b = int(stop[k - 1]) if k else 0, int(stop[k])
                    scores[np.ix_(holders, docs[a:b])] += weight * share[a:b]
        if last:
            least = _best(scores, top)
            # Ties at the last place go to the lower ids: all of them are looked at.
            item, doc = np.nonzero((scores >= np.maximum(least, 1)[:, None]))
            score, name = scores[item, doc], ids[doc]
            order = np.lexsort((name, -score, item))
            item, score, name = item[order], score[order], name[order]
            begin = np.searchsorted(item, np.arange(n_items))
            keep = np.arange(len(item)) - begin[item] < top
            cols = [np.full(int(keep.sum()), bundle.column("bundle")[0].as_py()), item[keep].astype(np.int32), name[keep], score[keep]]
            return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds, strict=True)], schema=kinds)
        rest = np.zeros(n_items, dtype=np.int64)  # what all later terms may add at most
        for x in load.values():
            for weight, holders in zip(x["weights"], x["holders"], strict=True):
                rest[holders] += weight * 1_000_000
        item, doc = np.nonzero((scores > 0) & (scores + rest[:, None] >= _best(scores, top)[:, None]))
        new = {"acc_item": item.astype(np.int32), "acc_doc": doc.astype(np.int32), "acc_score": scores[item, doc], "load": list(load.values())}
        cols = [pa.array([new[f.name]], f.type) if f.name in new else bundle.column(f.name).combine_chunks() for f in kinds]
        return pa.Table.from_arrays(cols, schema=kinds)

    return run


class RankedSearch:
    """Index of the documents for the terms of some items, and the items' best documents."""

    def __init__(self, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_docs: int = BLOCK_DOCS, bundle_items: int = BUNDLE_ITEMS):
        spark = docs.sparkSession
        named = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("item_text")).distinct()
        n_items = named.count()
        bundles = max(1, -(-n_items // bundle_items))
        hashed = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(bundles))
        nth = F.row_number().over(Window.partitionBy("bundle").orderBy("item_id", "item_text"))
        self.items = stored(named.withColumn("bundle", hashed).withColumn("item", (nth - 1).cast("int")), "search-items", large=False)
        words = F.regexp_extract_all(F.translate("item_text", UPPER, LOWER), F.lit(TERM), F.lit(0))
        self.terms = self.items.select("bundle", "item", F.explode(F.array_distinct(words)).alias("term"))
        bits = self.terms.select("term").distinct().mapInArrow(_term_bits, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        wanted = np.zeros(1 << MAP_BITS - 6, dtype=np.int64)
        found = bits.toArrow()  # at most one row for each word of the map
        wanted[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        path = f"{shared_dir(spark)}/search-index-{uuid.uuid4().hex}"
        index = id_text(docs, id_col, text_col).mapInArrow(_index(wanted.tobytes(), block_docs), INDEX_SCHEMA)
        index.write.partitionBy("owner").option("compression", "zstd").parquet(path)
        self.index = spark.read.schema(INDEX_SCHEMA).parquet(path)
        self.bundles = bundles

    def best(self, top: int = TOP) -> DataFrame:
        """item_id, item_text, rank, doc_id, score."""
        blocks = self.index.filter("owner = -1").select("block", "ids", "lengths")
        total = blocks.agg(F.sum(F.size(F.filter("lengths", lambda n: n > 0))), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
        n_docs, n_terms = int(total[0] or 0), int(total[1] or 0)
        df = self.index.filter("owner >= 0").select(F.inline(F.arrays_zip("terms", "counts"))).groupBy("terms").agg(F.sum("counts").cast("long").alias("df"))
        weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
        weighed = self.terms.join(df.withColumnRenamed("terms", "term"), "term").select("bundle", "item", "term", weight.alias("weight"), owner_of(F.col("term")).alias("owner"))
        by_term = weighed.groupBy("bundle", "owner", "term").agg(F.first("weight").alias("weight"), F.collect_list("item").alias("holders"))
        by_owner = by_term.groupBy("bundle", "owner").agg(F.array_sort(F.collect_list(F.struct("term", "weight", "holders"))).alias("l"))
        load = by_owner.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("owner", F.col("l.term").alias("terms"), F.col("l.weight").alias("weights"), F.col("l.holders").alias("holders")))).alias("load"))
        load = load.join(self.items.groupBy("bundle").agg(F.count("*").cast("int").alias("n_items")), "bundle")
        salts = max(1, int(self.index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        load = stored(load, "search-bundles", large=False).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        of_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.bundles - 1).cast("long")))
        m = F.expr(f"transform(lengths, n -> 10L + (90L * n * {n_docs}L) div {max(1, n_terms)}L)")
        nothing = [F.array().cast(f"array<{kind}>").alias(c) for c, kind in (("acc_item", "int"), ("acc_doc", "int"), ("acc_score", "bigint"))]
        on_way = (
            blocks.select("block", "ids", m.alias("m"), of_block.alias("bundle"), F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"))
            .join(load.hint("merge"), ["bundle", "salt"])  # one copy of a bundle a salt: small on the wire, not in memory, so never broadcast
            .select("block", "bundle", "ids", "m", "load", "n_items", *nothing)
        )
        for owner in range(OWNERS):
            mine = self.index.filter(F.col("owner") == owner).select(F.col("block").alias("at_block"), of_block.alias("at_bundle"), "terms", "counts", "docs", "tfs")
            on_way = on_way.groupBy("block", "bundle").cogroup(mine.groupBy("at_block", "at_bundle")).applyInArrow(_stage(owner, top), FOUND_SCHEMA if owner == OWNERS - 1 else BUNDLE_SCHEMA)
        rank = F.row_number().over(Window.partitionBy("bundle", "item").orderBy(F.desc("score"), "_id"))
        ranked = on_way.withColumn("rank", rank).filter(F.col("rank") <= top)
        return ranked.join(self.items, ["bundle", "item"]).select("item_id", "item_text", "rank", real_id().alias("doc_id"), "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of each benchmark item."""
    return RankedSearch(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).best().select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH terms AS (
    SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
),
sizes AS (SELECT d, doc_id, len(t) AS n FROM terms WHERE len(t) > 0),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM terms) GROUP BY d, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, n_docs),
items AS (
    SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
scores AS (
    SELECT item_id, i.text, s.d, s.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM items i JOIN tf USING (term) JOIN weights USING (term) JOIN sizes s ON s.d = tf.d, total
    GROUP BY item_id, i.text, s.d, s.doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
"""
