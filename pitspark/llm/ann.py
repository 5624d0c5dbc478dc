"""Approximate nearest neighbours by multi-index hashing.

Vectors are lifted by one coordinate so that the largest inner product is the smallest angle, and coded by the signs of
``ROTATIONS`` learned rotations (iterative quantization, fitted on at most ``FIT_ROWS`` rows chosen by id hash).  A code is split
into 8-bit substrings, each with a table of buckets.  Codes within Hamming distance r of a query agree with it in at least
one substring up to r // (number of substrings) bits (pigeonhole), so probing those buckets and checking the full distance
retrieves every code within r; where the buckets hold most of a shard, all its distances are computed instead.  Rows that share
substrings (or the nearest codes) give a first k-th best; the radius covers its angle with a margin of ``MARGIN`` standard
deviations of the code distance at that angle, and all vectors within are reranked by exact double-precision inner products.

All rows are indexed.  They are dealt into shards of bounded size; queries are dealt into blocks, and every block meets every
shard (a stated query set against all rows); the best k of each shard are merged.

Edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no part;
equal vectors rank by id; rows that repeat an id are candidates each; a query never meets rows of its own id; fewer than k
candidates give fewer rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitspark.llm.common import table

FIT_ROWS = 20_000  # bound on the rows that the rotations are fitted on
ROTATIONS = 3
MARGIN = 2.0
SHARD_ROWS = 16_384
QUERY_BLOCK = 512
NEAR = [np.flatnonzero(np.bitwise_count(np.arange(256)) <= r) for r in range(9)]  # substring differences of up to r bits


class Coder:
    """Lift to equal norms, then signs under learned rotations."""

    def __init__(self, sample: np.ndarray, top: float, seed: int = 7):
        self.top = top  # largest squared norm of all rows
        rng = np.random.default_rng(seed)
        x = self.lift(sample)
        x /= np.sqrt(top)
        self.rotations = []
        for _ in range(ROTATIONS):
            r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
            for _ in range(20):  # the rotation that brings the vectors nearest to the corners of a cube
                u, _, w = np.linalg.svd(np.sign(x @ r).T @ x)
                r = (u @ w).T
            self.rotations.append(r)
        bits = x.shape[1] * ROTATIONS
        self.bits = bits // 64 * 64 or 64

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0.0))
        return np.column_stack([x, rest])

    def code(self, x: np.ndarray, lifted: bool) -> np.ndarray:
        """Bytes of the codes; a query gets a zero as its extra coordinate."""
        x = self.lift(x) if lifted else np.column_stack([x, np.zeros(len(x))])
        signs = np.concatenate([x @ r for r in self.rotations], axis=1)[:, : self.bits] > 0
        signs = np.pad(signs, ((0, 0), (0, self.bits - signs.shape[1])))
        return np.packbits(signs, axis=1)


class Shard:
    """Codes of a shard with one bucket table for each substring."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, coder: Coder):
        self.ids, self.x, self.coder = ids, x, coder
        self.codes = coder.code(x, True)
        self.parts = self.codes.shape[1]
        self.words = self.codes.view(np.uint64)
        self.order = np.argsort(self.codes, axis=0, kind="stable")
        self.edges = [np.concatenate([[0], np.cumsum(np.bincount(self.codes[:, p], minlength=256))]) for p in range(self.parts)]

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray | None:
        """Rows of the buckets that codes within the radius can lie in (pigeonhole); None if that is most of the shard."""
        buckets = NEAR[min(radius // self.parts, 8)]
        held = sum(int((e[1:] - e[:-1])[buckets ^ c].sum()) for e, c in zip(self.edges, code.tolist(), strict=True))
        if 2 * held >= len(self.ids):
            return None
        found = [self.order[e[b] : e[b + 1], p] for p, (e, c) in enumerate(zip(self.edges, code.tolist(), strict=True)) for b in (buckets ^ c).tolist() if e[b + 1] > e[b]]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)

    def distance(self, code: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Hamming distances of the given rows, or of all."""
        held = self.words if rows is None else self.words[rows]
        return np.bitwise_count(held ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)

    def search(self, query_id: int, q: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best found, best first."""
        bits = self.coder.bits
        scale = np.sqrt((q * q).sum() * self.coder.top)

        def best(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rows = rows[self.ids[rows] != query_id]
            scores = (self.x[rows] * q).sum(axis=1)
            top = np.lexsort((self.ids[rows], -scores))[:k]
            return rows[top], scores[top]

        # The rows that share whole substrings, or else those of the nearest codes, give a first bound on the angle.
        near = self.probe(code, self.parts - 1)
        far = None
        if near is None or len(near) <= k:
            far = self.distance(code, None)
            near = np.argpartition(far, 4 * k)[: 4 * k] if len(far) > 4 * k else np.arange(len(far))
        rows, scores = best(near)
        if len(rows) < k:
            return self._out(best(np.arange(len(self.ids))))
        share = np.arccos(np.clip(scores[-1] / scale, -1.0, 1.0)) / np.pi
        radius = min(int(np.ceil(share * bits + MARGIN * np.sqrt(bits * share * (1 - share)))), bits)
        held = self.probe(code, radius) if far is None else None
        if far is None:
            far = self.distance(code, held)
        within = np.flatnonzero(far <= radius)
        return self._out(best(within if held is None else held[within]))

    def _out(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[found[0]], found[1]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (_id, _v) that take part, of any length."""
    v = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast("array<double>").alias("_v")).filter("_id is not null and _v is not null")
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("_v", lambda x: x != 0)
    return v.filter(fine)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col)
    # One length for both sides, the most frequent one among the candidates: other vectors have no inner product with them.
    size = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows, asked = (v.filter(F.size("_v") == (size["n"] if size else 0)) for v in (rows, asked))
    schema = "query_id bigint, vec_id bigint, score double"
    facts = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS).collect()  # at most FIT_ROWS rows
    coder = Coder(np.array([r["_v"] for r in sample]), facts["top"])
    n_shards = -(-facts["n"] // SHARD_ROWS)
    n_blocks = -(-asked.count() // QUERY_BLOCK) or 1

    def run(key: tuple, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        shard = Shard(mine["_id"].to_numpy(), np.stack(mine["_v"].to_numpy()), coder)
        q = np.stack(theirs["_v"].to_numpy())
        out = []
        for qid, x, code in zip(theirs["_id"].tolist(), q, coder.code(q, False), strict=True):
            ids, scores = shard.search(qid, x, code, k)
            out.append(pd.DataFrame({"query_id": qid, "vec_id": ids, "score": scores}))
        return pd.concat(out)

    held = rows.withColumn("shard", F.pmod(F.xxhash64("_id", "_v"), F.lit(n_shards).cast("long")))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    sought = asked.withColumn("block", F.pmod(F.xxhash64("_id"), F.lit(n_blocks)).cast("int"))
    sought = sought.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))))
    found = held.groupBy("shard", "block").cogroup(sought.groupBy("shard", "block")).applyInPandas(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)
