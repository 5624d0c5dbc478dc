"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct 5-word shingles (64-bit hashes).  Two documents link when 100 * overlap >= 75 * union.

1. Documents of equal sets form one class (a 128-bit digest of the sorted set); its least id stands for it from then on.
2. Prefix index: under one order of all shingles, linked sets share a shingle among the first n - ceil(0.75 n) + 1 of each.
   The order puts shingles found to be frequent last (by frequency, then hash), the others by hash.  Frequent ones come from
   per-task counts over all documents, merged; the ``FREQUENT`` most frequent are kept (a bounded broadcast).  The order
   decides speed only: any order gives the same links.
3. Index lists are skipped by position: a shingle at positions i and j of sets of n and m leaves at most
   1 + min(n - i - 1, m - j - 1) in common and costs i + j differences, so most entries of a list, and whole blocks of it, are
   passed over.
4. Answers are derived through similar sets.  First each set meets only its neighbours in the lists; verified links
   join them to classes.  A set of a class has its answers within the class from its neighbours, so a list is searched in
   full only where different classes meet in it, and only across classes.  What passes the skipping bounds there is verified as
   well.  Before texts are compared, small parity maps of the sets rule out most candidates: their differing bits are a lower
   bound on the differences of the sets.  No list is expanded into all its pairs, and no link between different classes is lost.

Edge cases: null or wordless text has an empty set and links with nothing; equal rows fall into one class and keep a row each;
a null id never stands for others; an empty table gives an empty result; other columns are not read; texts of any length count whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import Words, small_batches, stored, table, text_blocks
from pitspark.llm.components import components

SHINGLE = 5
NEED, OF = 75, 100  # link when OF * overlap >= NEED * union
FREQUENT = 1 << 18  # bound on the shingles that are known to be frequent
LEAST_FREQUENT = 8
LIST_BLOCK = 4096  # entries of a list that one task holds at a time
FOLDED = 64  # bytes of the least parity map
CARRIED = 1 << 10  # bytes of a parity map that an entry of a list takes along at most
PAIR_BYTES = 1 << 22  # parity maps compared by one numpy call
NO_ID = 2**63 - 1  # stands for a null id, so that it is never the least


def _sets(words: Words) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    h, d = words.shingles(SHINGLE)
    edges = np.searchsorted(d, np.arange(len(words.first)))
    for k in range(len(words.first) - 1):
        own = np.sort(h[edges[k] : edges[k + 1]])
        if len(own) > 1:
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        yield own


def _key(own: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def parity_map(own: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of shingles hash to i; as many bits as the next power of two from the set's size, 512 at least."""
    bits = 1 << max(9, len(own).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound on the differences of two sets: each changes one bit.  The larger map folds to the smaller one's size."""
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    if len(a) < len(b):
        a, b = b, a
    a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def _folded(bits: bytes) -> bytes:
    """The map folded to 512 bits."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, dtype=np.uint8).reshape(-1, FOLDED), axis=0).tobytes()


def carried_map(bits: str) -> F.Column:
    """The parity map that goes with every entry of a set: none where the folded map says as much, or where it has more than ``CARRIED`` bytes, so that an entry stays small."""
    return F.when(F.octet_length(bits).between(FOLDED + 1, CARRIED), F.col(bits)).otherwise(F.lit(b""))


def maps_differ(maps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``least_difference`` of the maps of the pairs (a, b), for many pairs at once; 0 where one of them has no map."""
    width = np.array([len(m) for m in maps], dtype=np.int64)
    out = np.zeros(len(a), dtype=np.int64)
    common = np.minimum(width[a], width[b])
    for w in np.unique(common[common > 0]).tolist():
        pairs = np.flatnonzero(common == w)
        entries, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        rows = np.stack([np.bitwise_xor.reduce(np.frombuffer(maps[e], dtype=np.uint64).reshape(-1, w // 8), axis=0) for e in entries.tolist()])
        at = at.reshape(2, -1)
        some = max(1, PAIR_BYTES // w)
        for s in range(0, len(pairs), some):  # in pieces, so that the rows of many pairs stay small
            x, y = at[:, s : s + some]
            out[pairs[s : s + some]] = np.bitwise_count(rows[x] ^ rows[y]).sum(axis=1, dtype=np.int64)
    return out


def _unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops candidate pairs whose parity maps differ in more bits than linked sets can."""
    for batch in batches:
        n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
        most = n + m - 2 * _least_overlap(n, m)
        least = [least_difference(x.as_py(), y.as_py()) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
        at = pa.array(np.flatnonzero(np.array(least, dtype=np.int64) <= most))
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])


def _trim(token: np.ndarray, n: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Heavy hitters: lower all counts by the first one beyond the limit, and drop what is left at nothing."""
    if len(token) > limit:
        n = n - np.partition(n, len(n) - limit - 1)[len(n) - limit - 1]
        token, n = token[n > 0], n[n > 0]
    return token, n


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of every set; at the end of the task, its frequent shingles."""
    names = ["_id", "n", "k1", "k2", "bits", "fold", "token", "hits"]
    seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        sizes, keys, maps = [], [], []
        for _, _, data, bounds in text_blocks(batch):
            own = list(_sets(Words(data, bounds)))
            sizes += map(len, own)
            keys += [_key(x) for x in own]
            maps += [parity_map(x) for x in own]
            token, n = np.unique(np.concatenate(own), return_counts=True)
            token, n = token[n > 1], n[n > 1]  # what a block holds once is no candidate
            both, at = np.unique(np.concatenate([seen, token]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)
            seen, counts = _trim(both, counts, FREQUENT)
        none = pa.nulls(len(sizes), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sizes, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(maps, pa.binary()), pa.array([_folded(m) for m in maps], pa.binary()), none, none], names=names)
    if len(seen):
        none = pa.nulls(len(seen), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(seen), pa.binary()), pa.nulls(len(seen), pa.binary()), pa.array(seen.view(np.int64)), pa.array(counts)], names=names)


def _prefix_size(n: int) -> int:
    return n - -(-NEED * n // OF) + 1


def _least_overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return -(-NEED * (n + m) // (OF + NEED))


def _may_link(n: np.ndarray, i: np.ndarray, m: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets of n and m whose first common shingle is at i and j can link."""
    need = _least_overlap(n, m)
    return (1 + np.minimum(n - i, m - j) - 1 >= need) & (i + j <= n + m - 2 * need) & (need <= np.minimum(n, m))


def _postings(frequent: np.ndarray, rank: np.ndarray):
    """Prefix entries (token, rep, size, pos) of the representative sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for at, _, data, bounds in text_blocks(batch):
                tokens, reps, sizes, places = [], [], [], []
                for k, own in enumerate(_sets(Words(data, bounds)), at):
                    if _key(own) != (k1[k], k2[k]):  # another text under the same id
                        continue
                    take = _prefix_size(len(own))
                    if len(frequent):
                        where = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                        hot = frequent[where] == own
                        prefix = own[~hot][:take]
                        if len(prefix) < take:
                            late = np.lexsort((own[hot], rank[where[hot]]))
                            prefix = np.concatenate([prefix, own[hot][late[: take - len(prefix)]]])
                    else:
                        prefix = own[:take]
                    tokens.append(prefix)
                    reps.append(np.full(len(prefix), ids[k]))
                    sizes.append(np.full(len(prefix), len(own), dtype=np.int32))
                    places.append(np.arange(len(prefix), dtype=np.int32))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(reps)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                        names=["token", "rep", "size", "pos"],
                    )

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over entries sorted by token and size: candidate pairs of entries at most two apart in a list, and the entries of lists of four or more.

    Holds three entries of the current list beside the batch.
    """
    names = ["token", "rep", "size", "pos", "other"]
    carry = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64)]
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = [batch.column(c).to_numpy() for c in names[:4]]
        token, rep, size, pos = (np.concatenate([a, b]) for a, b in zip(carry, fresh, strict=False))
        old, total = len(carry[0]), len(token)
        starts = np.ones(total, dtype=bool)
        starts[1:] = token[1:] != token[:-1]
        first = np.maximum.accumulate(np.where(starts, np.arange(total), 0))
        nth = np.arange(total) - first
        if old:  # the carried entries are the last of a list
            nth[token == token[0]] += carry[4][0]
        cols = []
        for gap in (1, 2):
            if total <= gap:
                continue
            b = np.arange(max(old, gap), total)
            a = b - gap
            ok = (token[a] == token[b]) & (rep[a] != rep[b])
            a, b = a[ok], b[ok]
            ok = _may_link(size[a], pos[a], size[b], pos[b])
            a, b = a[ok], b[ok]
            cols.append((np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])))
        if cols:
            lo, hi = np.concatenate([c[0] for c in cols]), np.concatenate([c[1] for c in cols])
            if len(lo):
                none = pa.nulls(len(lo), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(lo), none.cast(pa.int32()), none.cast(pa.int32()), pa.array(hi)], names=names)
        where = np.arange(total)
        fourth = where + 3 - nth  # place of the list's fourth entry
        seen = np.minimum(np.maximum(fourth, 0), total - 1)
        late = (nth < 3) & (fourth < total) & (token[seen] == token) & (seen >= old)
        out = np.flatnonzero(late | ((nth >= 3) & (where >= old)))
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(token[out]), pa.array(rep[out]), pa.array(size[out]), pa.array(pos[out]), pa.nulls(len(out), pa.int64())], names=names)
        keep = np.flatnonzero(token == token[-1])[-3:]
        carry = [token[keep], rep[keep], size[keep], pos[keep], nth[keep]]


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over lists in a shuffled order: candidate pairs of different classes at most four entries apart."""
    carry: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy() for c in ("token", "rep", "size", "pos", "root")]
        old = len(carry[0]) if carry is not None else 0
        if carry is not None:
            now = [np.concatenate([a, b]) for a, b in zip(carry, now, strict=True)]
        token, rep, size, pos, root = now
        for gap in range(1, 5):
            b = np.arange(max(old, gap), len(token))
            a = b - gap
            ok = (token[a] == token[b]) & (root[a] != root[b])
            a, b = a[ok], b[ok]
            ok = _may_link(size[a], pos[a], size[b], pos[b])
            a, b = a[ok], b[ok]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep[a], rep[b])), pa.array(np.maximum(rep[a], rep[b]))], names=["a", "b"])
        carry = [x[-4:] for x in now]


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over entries sorted by (token, lo, hi): candidate pairs of different classes within one block pair of a list."""
    held: list[np.ndarray] | None = None
    cols = ["token", "lo", "hi", "rep", "size", "pos", "root", "own"]

    def search(group: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        _, lo, hi, rep, size, pos, root, own, fold, bits = group
        order = np.lexsort((pos, size))
        rep, size, pos, root, own, fold, bits = (x[order] for x in (rep, size, pos, root, own, fold, bits))
        split = lo[0] != hi[0]
        step = 256
        blocks = [(s, min(s + step, len(rep))) for s in range(0, len(rep), step)]
        for x, (a0, a1) in enumerate(blocks):
            for b0, b1 in blocks[x:]:
                # Sizes grow along the list and a block's least position bounds the differences: skip whole blocks.
                if NEED * int(size[b0]) > OF * int(size[a1 - 1]):
                    break
                top, low = int(size[b1 - 1]) + int(size[a1 - 1]), int(pos[a0:a1].min()) + int(pos[b0:b1].min())
                if low > top - 2 * -(-NEED * top // (OF + NEED)) + 1:
                    continue
                a, b = np.nonzero(root[a0:a1, None] != root[None, b0:b1])
                a, b = a + a0, b + b0
                ok = a < b
                if split:
                    ok &= own[a] != own[b]
                a, b = a[ok], b[ok]
                ok = _may_link(size[a], pos[a], size[b], pos[b])
                a, b = a[ok], b[ok]
                most = size[a] + size[b] - 2 * _least_overlap(size[a], size[b])
                ok = np.bitwise_count(fold[a] ^ fold[b]).sum(axis=1, dtype=np.int64) <= most
                a, b, most = a[ok], b[ok], most[ok]
                ok = maps_differ(bits, a, b) <= most  # the folded maps of long texts are full and tell nothing
                a, b = a[ok], b[ok]
                if len(a):
                    yield np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])

    def emit(group: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a, b in search(group):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy() for c in cols]
        now.append(np.frombuffer(b"".join(batch.column("fold").to_pylist()), dtype=np.uint64).reshape(-1, 8))
        now.append(_objects(batch.column("bits").to_pylist()))
        if held is not None:
            now = [np.concatenate([a, b]) for a, b in zip(held, now, strict=True)]
        change = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]) | (now[2][1:] != now[2][:-1])) + 1
        edges = [0, *change.tolist()]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            yield from emit([x[s:e] for x in now])
        held = [x[edges[-1] :] for x in now]
    if held is not None:
        yield from emit(held)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among candidate pairs with both texts."""
    for batch in batches:
        lefts = (x for _, _, data, bounds in text_blocks(batch, "_text") for x in _sets(Words(data, bounds)))
        rights = (x for _, _, data, bounds in text_blocks(batch, "_other") for x in _sets(Words(data, bounds)))
        keep, shared, total = [], [], []
        for k, (x, y) in enumerate(zip(lefts, rights, strict=True)):
            both = np.concatenate([x, y])
            both.sort()
            inter = int((both[1:] == both[:-1]).sum())
            union = len(both) - inter
            if inter and OF * inter >= NEED * union:
                keep.append(k)
                shared.append(inter)
                total.append(union)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), pa.array(shared, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "overlap", "union"])


class JaccardJoin:
    """The join over one table: ``classes`` (a row for each row of the input) and ``links`` (verified pairs of representatives)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        spark = docs.sparkSession
        small_batches(spark)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        scan = stored(plain.mapInArrow(_scan, "_id bigint, n bigint, k1 bigint, k2 bigint, bits binary, fold binary, token bigint, hits bigint"), "sets")
        sets = scan.filter("k1 is not null").select("_id", "n", "k1", "k2", "bits", "fold")
        top = scan.filter("token is not null").groupBy("token").agg(F.sum("hits").alias("hits")).filter(F.col("hits") >= LEAST_FREQUENT)
        top = top.orderBy(F.desc("hits"), "token").limit(FREQUENT).toArrow()  # at most FREQUENT rows of 16 bytes
        token = top.column("token").to_numpy().view(np.uint64)
        order = np.argsort(token)
        frequent, rank = token[order], top.column("hits").to_numpy()[order]
        self.frequent, self.rank = frequent, rank

        reps = sets.filter("n > 0").groupBy("k1", "k2").agg(F.min(F.struct("_id", "n", "bits", "fold")).alias("least"))
        reps = stored(reps.select("k1", "k2", F.col("least._id").alias("rep"), "least.n", "least.bits", "least.fold"), "reps", large=False)
        rep_texts = plain.join(reps.select(F.col("rep").alias("_id"), "k1", "k2"), "_id")
        postings = rep_texts.select("_id", "_text", "k1", "k2").mapInArrow(_postings(frequent, rank), "token bigint, rep bigint, size int, pos int")
        lists = postings.repartition(tasks, "token").sortWithinPartitions("token", "size", "rep")
        found = stored(lists.mapInArrow(_neighbours, "token bigint, rep bigint, size int, pos int, other bigint"), "lists")

        def verify(pairs: DataFrame, name: str) -> DataFrame:
            maps = reps.select("rep", "n", "bits")
            pairs = pairs.join(maps.toDF("a", "n", "x"), "a").join(maps.toDF("b", "m", "y"), "b").select("a", "b", "n", "x", "m", "y")
            pairs = stored(pairs.mapInArrow(_unlike, "a bigint, b bigint"), "alike")
            asked = pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
            texts = plain.join(asked, "_id", "left_semi")
            texts = stored(texts.dropDuplicates(["_id"]) if self.repeats else texts, "texts")
            left = pairs.join(texts, pairs["a"] == texts["_id"]).select("a", "b", "_text")
            right = texts.select(F.col("_id").alias("_b"), F.col("_text").alias("_other"))
            both = left.join(right, left["b"] == right["_b"]).select("a", "b", "_text", "_other")
            return stored(both.mapInArrow(_verified, "a bigint, b bigint, overlap bigint, union bigint"), name)

        self.repeats = sets.count() > sets.select("_id").distinct().count()
        near = found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")).distinct()
        first = verify(near, "links")
        roots = stored(components(first.select("a", "b")), "roots", large=False)

        index = found.filter("other is null").select("token", "rep", "size", "pos")

        def mixed(roots: DataFrame) -> DataFrame:
            """The entries, with their classes, of the lists in which classes meet."""
            own = index.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
            lists = own.groupBy("token").agg(F.count("*").alias("size_of_list"), F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
            return own.join(lists.select("token", "size_of_list"), "token")

        # Once more among neighbours, in another order and only across classes: this brings the parts of large classes together.
        shuffled = mixed(roots).repartition(tasks, "token").sortWithinPartitions("token", F.xxhash64("token", "rep"))
        met = shuffled.select("token", "rep", "size", "pos", "root").mapInArrow(_borders, "a bigint, b bigint").distinct().join(near, ["a", "b"], "left_anti")
        met = stored(met, "met", large=False)
        middle = verify(met, "links")
        first = first.unionByName(middle)
        roots = stored(components(first.select("a", "b")), "roots", large=False)

        index = mixed(roots).join(reps.select("rep", "fold", carried_map("bits").alias("bits")), "rep")
        parts = F.ceil(F.col("size_of_list") / LIST_BLOCK).cast("int")
        index = index.withColumn("own", F.pmod(F.xxhash64("rep"), parts).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
        index = index.select("token", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"), "rep", "size", "pos", "root", "own", "fold", "bits")
        index = index.repartition(tasks, "token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")
        far = index.mapInArrow(_across, "a bigint, b bigint").distinct().join(near.unionByName(met), ["a", "b"], "left_anti")
        second = verify(far, "links")

        self.links = first.unionByName(second)
        roots = components(self.links.select("a", "b"))
        own = sets.drop("bits", "fold").join(reps.select("k1", "k2", "rep"), ["k1", "k2"], "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        real = lambda c: F.when(c != F.lit(NO_ID), c)
        self.classes = own.select(real(F.col("_id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(F.coalesce("root", "rep", "_id")).alias("component_id"))


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """The documents with ``_key``, their id where it is theirs alone, and whether others had to be made.

    Rows with a null id, or with an id that other rows have too, get a number beyond 2**62 from their id and text, so that rows of
    one id and different texts are different documents.
    """
    own = F.col(id_col).cast("long")
    shared = stored(docs.groupBy(own.alias("_shared")).agg(F.count("*").alias("n")).filter("n > 1 or _shared is null").select("_shared", F.lit(True).alias("_made")), "shared-ids", large=False)
    if shared.isEmpty():
        return docs.withColumn("_key", own), False
    made = F.lit(1 << 62) + F.xxhash64(own, F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1))
    marked = docs.join(shared, own.eqNullSafe(F.col("_shared")), "left")
    return marked.withColumn("_key", F.when(F.col("_made"), made).otherwise(own)).drop("_shared", "_made"), True


def document_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, the least id of the class."""
    keyed, made = row_keys(docs.select(id_col, text_col), id_col, text_col)
    classes = JaccardJoin(keyed, "_key", text_col).classes
    if not made:
        return classes
    rows = keyed.select("_key", F.col(id_col).cast("long").alias("doc_id")).join(classes.distinct().withColumnRenamed("doc_id", "_key"), "_key")
    least = rows.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with only one of each class kept: that of the least id, null ids last; of rows that repeat id and text, one."""
    keyed, made = row_keys(docs, id_col, text_col)
    classes = JaccardJoin(keyed, "_key", text_col).classes
    if not made:
        kept = classes.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept"))
        return docs.join(kept, F.col(id_col).cast("long") == F.col("_kept"), "left_semi")
    rows = keyed.select("_key", F.col(id_col).cast("long").alias("_own")).join(classes.distinct().withColumnRenamed("doc_id", "_key"), "_key")
    best = rows.groupBy("component_id").agg(F.min(F.struct(F.col("_own").isNull().alias("none"), "_own", "_key")).alias("best"))
    return keyed.join(best.select(F.col("best._key").alias("_kept")), F.col("_key") == F.col("_kept"), "left_semi").dropDuplicates(["_key"]).drop("_key")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links of Jaccard similarity 0.75 or more on 5-word shingles."""
    return document_classes(table(spark, sf_dir, "documents"))
