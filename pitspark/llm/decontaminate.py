"""Benchmark decontamination: a BM25 index of the benchmark items with block-max WAND.

The items are the indexed side.  Every training document is cut into overlapping passages, sized so that any item fits whole
into one of them, and every passage is a query: all items whose BM25 score reaches ``share`` of the item's own (self) score
are retrieved.  Postings are grouped in blocks of ``BLOCK_ITEMS`` items with the largest impact of a term in each block.  A
first bound over whole blocks is computed for all passages of a batch at once; a passage goes on only to blocks whose bound
reaches the least threshold in the block, and there the posting lists are walked with WAND pivots under block maxima.
Retrieved pairs are verified on words: of the 5-word runs of the item's question (all but its last sentence) and of its
answer (the last sentence) at least ``overlap`` must occur in the passage.

The index is broadcast in slices of at most ``SLICE_ITEMS`` items, so its size is bounded whatever the number of items.

Edge cases: null or empty documents have no passage and stay clean; null or wordless items are not indexed; equal items
are indexed each; repeated document rows keep a row each; an empty benchmark leaves all documents clean; extra columns
pass through; long documents are cut into as many passages as they need.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import Words, id_text, real_id, table, text_blocks

SHARE = 0.6  # of an item's self score
OVERLAP = 0.75  # of the 5-word runs of question and of answer
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
SLICE_ITEMS = 20_000
SENTENCE_ENDS = frozenset(b".?!")
_WORDISH = np.zeros(256, dtype=bool)  # letters, digits and all beyond ASCII; punctuation stuck to a word is not part of it
_WORDISH[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(128, 256)]] = True


class ItemIndex:
    """Impact-ordered-by-item postings of a slice of the benchmark, and what verification needs."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        words = Words(data, np.cumsum([0, *map(len, raw)]), _WORDISH, True)
        kept = [k for k in range(len(ids)) if words.first[k + 1] > words.first[k]]
        self.ids = [ids[k] for k in kept]
        bags = [words.hash[words.first[k] : words.first[k + 1]] for k in kept]
        n = len(bags)
        self.n = n
        self.longest = max(map(len, bags), default=0)
        self.terms = np.unique(np.concatenate(bags)) if n else np.zeros(0, np.uint64)
        v = len(self.terms)
        mean = sum(map(len, bags)) / max(n, 1)
        per_item = [np.unique(np.searchsorted(self.terms, b), return_counts=True) for b in bags]
        df = np.bincount(np.concatenate([t for t, _ in per_item]), minlength=v) if n else np.zeros(0)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        self.own = np.zeros(n)
        rows: dict[tuple[int, int], list[tuple[int, float]]] = {}  # by term and block
        for item, (t, tf) in enumerate(per_item):
            impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(bags[item]) / mean))
            self.own[item] = impact.sum()
            for term, x in zip(t.tolist(), impact.tolist(), strict=True):
                rows.setdefault((term, item // BLOCK_ITEMS), []).append((item, x))
        self.postings = rows
        self.blocks = -(-n // BLOCK_ITEMS)
        self.block_max = np.zeros((v, self.blocks), dtype=np.float32)
        for (term, b), row in rows.items():
            self.block_max[term, b] = np.nextafter(np.float32(max(x for _, x in row)), np.float32(np.inf))
        self.question, self.answer = [], []
        for k in kept:
            lo, hi = int(words.first[k]), int(words.first[k + 1])
            ends = [w for w in range(lo, hi - 1) if data[words.end[w]] in SENTENCE_ENDS]
            cut = ends[-1] + 1 if ends else lo  # one sentence: all of it is the answer
            self.question.append(self._runs(words.hash[lo:cut]))
            self.answer.append(self._runs(words.hash[cut:hi]))

    @staticmethod
    def _runs(words: np.ndarray) -> tuple[int, list[bytes]]:
        """Length of the word runs and the distinct runs; a part of fewer words is one run."""
        n = min(SHINGLE, len(words))
        return n, sorted({words[i : i + n].tobytes() for i in range(len(words) - n + 1)}) if n else []

    def overlap(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and of the answer's runs that the passage holds (1 for an empty part)."""
        out = []
        for n, runs in (self.question[item], self.answer[item]):
            if not runs:
                out.append(1.0)
                continue
            held = {passage[i : i + n].tobytes() for i in range(len(passage) - n + 1)}
            out.append(sum(r in held for r in runs) / len(runs))
        return out[0], out[1]

    def wand(self, terms: list[int], block: int, least: np.ndarray) -> list[tuple[int, float]]:
        """Items of a block whose score over the terms reaches their threshold, by WAND pivots over the posting lists."""
        lo, hi = block * BLOCK_ITEMS, min((block + 1) * BLOCK_ITEMS, self.n)
        floor = float(least[lo:hi].min())
        lists = []
        for t in terms:
            lists.append([self.postings[t, block], 0, float(self.block_max[t, block])])
        out = []
        while lists:
            lists.sort(key=lambda c: c[0][c[1]][0])
            bound, pivot = 0.0, None
            for k, c in enumerate(lists):
                bound += c[2]
                if bound >= floor:
                    pivot = k
                    break
            if pivot is None:
                break
            item = lists[pivot][0][lists[pivot][1]][0]
            if lists[0][0][lists[0][1]][0] == item:
                score = 0.0
                for c in lists:
                    if c[0][c[1]][0] == item:
                        score += c[0][c[1]][1]
                        c[1] += 1
                if score >= least[item] - 1e-9:
                    out.append((item, score))
            else:
                for c in lists[:pivot]:
                    while c[1] < len(c[0]) and c[0][c[1]][0] < item:
                        c[1] += 1
            lists = [c for c in lists if c[1] < len(c[0])]
        return out

    def search(self, words: Words, share: float, overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, question share, answer share) of all verified passages of a block of texts."""
        if not self.n or not len(words.hash):
            return
        least = share * self.own
        step = max(self.longest, 1)
        at = np.minimum(np.searchsorted(self.terms, words.hash), len(self.terms) - 1)
        known = self.terms[at] == words.hash
        term = np.where(known, at, -1)
        # Strides of `step` words; a passage is a stride and the one after it, so it holds any item that begins in the stride.
        count = np.diff(words.first)
        strides = -(-count // step)
        owner = np.repeat(np.arange(len(count)), strides)
        if not len(owner):
            return
        begin = words.first[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(strides) - strides, strides)) * step
        end = np.minimum(begin + 2 * step, words.first[owner + 1])
        rows = np.flatnonzero(known)
        stride_of = np.searchsorted(begin, rows, side="right") - 1
        # A term counts once in a passage; within a stride duplicates are dropped before the bound is summed.
        pair = np.unique(stride_of.astype(np.int64) * len(self.terms) + term[rows])
        s, t = pair // len(self.terms), pair % len(self.terms)
        floor = np.array([least[b * BLOCK_ITEMS : (b + 1) * BLOCK_ITEMS].min() for b in range(self.blocks)], dtype=np.float32)
        # Bound of each stride and block; a passage's bound is the sum over its two strides.
        firsts = np.searchsorted(s, np.arange(len(begin) + 1))
        has = np.flatnonzero(np.diff(firsts))
        for lo in range(0, len(has), 2048):
            part = has[lo : lo + 2049]  # one stride over, for the last passage
            sums = np.add.reduceat(self.block_max[t[firsts[part[0]] : firsts[part[-1] + 1]]], firsts[part] - firsts[part[0]], axis=0)
            bound = sums.copy()
            follows = np.flatnonzero((np.diff(part) == 1) & (owner[part[1:]] == owner[part[:-1]]))
            bound[follows] += sums[follows + 1]
            own = part[: 2048]
            for k, b in zip(*np.nonzero(bound[: len(own)] >= floor - 1e-3), strict=True):
                p = own[k]
                inside = term[begin[p] : end[p]]
                inside = inside[inside >= 0]
                terms = np.unique(inside[self.block_max[inside, b] > 0]).tolist()
                for item, score in self.wand(terms, int(b), least):
                    q, a = self.overlap(item, words.hash[begin[p] : end[p]])
                    if q >= overlap and a >= overlap:
                        yield int(owner[p]), item, score, q, a


def _slices(items: DataFrame) -> Iterator[ItemIndex]:
    """The benchmark in slices of bounded size, in id order."""
    rows = items.filter("_text != ''").orderBy("_id", "_text")
    part: list[tuple[int, str]] = []
    for r in rows.toLocalIterator():
        part.append((r["_id"], r["_text"]))
        if len(part) == SLICE_ITEMS:
            yield ItemIndex([i for i, _ in part], [t for _, t in part])
            part = []
    if part:
        yield ItemIndex([i for i, _ in part], [t for _, t in part])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, overlap: float = OVERLAP) -> DataFrame:
    """Pairs of document and benchmark item with their best passage: doc_id, item_id, score, question and answer overlap."""
    plain = id_text(docs, id_col, text_col)
    schema = "_id bigint, _item bigint, score double, question double, answer double"
    found = None
    for index in _slices(id_text(benchmark, "item_id", "text")):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column("_id")
                best: dict[tuple[int, int], tuple[float, float, float]] = {}
                for at, _, data, bounds in text_blocks(batch):
                    for doc, item, score, q, a in index.search(Words(data, bounds, _WORDISH, True), share, overlap):
                        key = (at + doc, item)
                        best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, q, a))
                cols = [[ids[d].as_py() for d, _ in best], [index.ids[i] for _, i in best], *([v[k] for v in best.values()] for k in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.float64()) for k, c in enumerate(cols)], names=["_id", "_item", "score", "question", "answer"])

        hits = plain.mapInArrow(run, schema)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    best = found.groupBy("_id", "_item").agg(F.max(F.struct("score", "question", "answer")).alias("m"))
    return best.select(real_id().alias("doc_id"), real_id("_item").alias("item_id"), "m.score", "m.question", "m.answer")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item.  Rows are told apart by their texts, so ids may be null or repeat."""
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    hits = contaminated(docs.select(key.alias("_key"), F.col(text_col).alias("_body")), benchmark, "_key", "_body").select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hits, key == F.col("_hit"), "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
