"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over the words of all documents.  Words that look disguised (digits or symbols among
letters, a letter three or more times in a row, single letters kept apart by spaces or marks) become a lattice: each
character offers the letters it may stand for, or nothing.  Viterbi decoding under the trigram model picks the most likely
spelling.  The restored text is then scored by a classifier over whole words and word beginnings.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows (those with the least id hash), in one task of that bounded
size: which features speak for a label is read off document counts, and a logistic curve over two summaries of a document
(its strongest feature, its number of strong features), each computed without the document's own count, gives the score.
Everything else covers all rows.

Edge cases: null and empty texts get the score of a document without evidence; labels that are null, or that contradict each
other for one id, are not learned from; without any label of both kinds every score is 0; repeated rows and null ids keep a row
each; extra columns pass through ``judge`` untouched; texts of any length are scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import Words, held_out, id_text, mix, small_batches, table, text_blocks

FIT_ROWS = 20_000  # bound on the labelled rows that the classifier is fitted on
PREFIXES = (4, 5, 6, 7, 8)  # lengths in bytes of the word beginnings that count as features
PRIOR = 10.0  # rows' worth of doubt about a feature's precision
STRONG = 0.5  # a feature counts as evidence from this precision on
EDGE, OTHER = 26, 27  # symbols beside the 26 letters
SYMBOLS = 28

# Letters that a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
APART = " .-_*~'"  # marks that may keep the letters of a word apart
SIGNS = "".join(re.escape(c) for c in STANDS_FOR)
#: Disguised words.  The second form begins where a run of its characters does, so a run is read once and not from each of its characters.
DISGUISED = re.compile(
    rf"(?<!\S)[^\W_](?:[{re.escape(APART)}](?:[^\W_]|[{SIGNS}])){{3,}}(?!\S)"  # letters kept apart
    rf"|(?<![^\W_])(?<![@$!])(?:[^\W_]|[@$!])*(?:[^\W\d_](?:[{SIGNS}]|[-._*~'](?=[^\W\d_]))|[{SIGNS}][^\W\d_]|([^\W\d_])\1\1)(?:[^\W_]|[{SIGNS}]|[-._*~'](?=[^\W\d_]))*",
    re.IGNORECASE,
)

#: A cheap test of a whole text, true wherever DISGUISED matches: a sign beside a letter, a mark before one, a letter three times in a row, or characters kept apart.
SUSPECT = re.compile(
    rf"[{SIGNS}\-._*~'](?=[^\W\d_])|[^\W\d_][{SIGNS}]|([^\W\d_])\1\1"
    rf"|(?<!\S)[^\W_](?:[{re.escape(APART)}](?:[^\W_]|[{SIGNS}])){{3}}",
    re.IGNORECASE,
)

_CLASS = np.full(256, EDGE, dtype=np.int64)
_CLASS[128:] = OTHER
_CLASS[65:91] = _CLASS[97:123] = np.arange(26)
_LETTERS = _CLASS != EDGE


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of symbol triples in the words of all documents: a fixed table of 28 x 28 x 28."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for _, _, data, bounds in text_blocks(batch):
                low = _CLASS[data]
                cut = np.full(len(low) + 2 * len(bounds) + 2, EDGE, dtype=np.int64)  # a gap at each text's edge
                cut[np.arange(len(low)) + 2 * np.repeat(np.arange(1, len(bounds)), np.diff(bounds))] = low
                code = (cut[:-2] * SYMBOLS + cut[1:-1]) * SYMBOLS + cut[2:]
                total += np.bincount(code, minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    got = docs.select("_text").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()  # at most 21,952 rows
    table_ = np.zeros(SYMBOLS**3, dtype=np.float64)
    for code, n in got:
        table_[code] = n
    return table_.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


class Channel:
    """Restores disguised words under the trigram model."""

    def __init__(self, counts: np.ndarray):
        smooth = counts + 0.1
        self.cost = -np.log(smooth / smooth.sum(axis=2, keepdims=True))
        self.memory: dict[str, str] = {}

    @staticmethod
    def options(word: str) -> list[list[tuple[str, float]]]:
        """The lattice: for each character its readings with their channel costs; an empty reading drops it."""
        out = []
        run = 0
        for k, c in enumerate(word):
            run = run + 1 if k and c == word[k - 1] else 0
            if c in APART:
                out.append([("", 0.0)])
            elif c in STANDS_FOR:
                out.append([(x, 1.0) for x in STANDS_FOR[c]] + [("", 6.0)])
            elif run == 0:
                out.append([(c, 0.0)])
            else:
                out.append([(c, 0.5), ("", 0.7 if run == 1 else 0.0)])
        return out

    def restore(self, word: str) -> str:
        """Most likely spelling of one disguised word."""
        known = self.memory.get(word)
        if known is not None:
            return known
        symbol = lambda x: ord(x) - 97 if "a" <= x <= "z" else OTHER
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
        for readings in self.options(word.lower()):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (p, q), (total, path) in best.items():
                for x, price in readings:
                    if x:
                        s = symbol(x)
                        state, value, way = (q, s), total + price + self.cost[p, q, s], (x, path)
                    else:
                        state, value, way = (p, q), total + price, path
                    if state not in new or value < new[state][0]:
                        new[state] = (value, way)
            best = new
        total, path = min(((v + self.cost[p, q, EDGE], way) for (p, q), (v, way) in best.items()), key=lambda x: x[0])
        out = []
        while path is not None:
            out.append(path[0])
            path = path[1]
        if len(self.memory) >= 500_000:
            self.memory.clear()
        self.memory[word] = "".join(reversed(out))
        return self.memory[word]

    def restore_text(self, text: str) -> str:
        if not SUSPECT.search(text):
            return text
        return DISGUISED.sub(lambda m: self.restore(m.group(0)), text)


def _features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct features of each text, and the text of each."""
    words = Words(data, bounds, _LETTERS)
    parts, docs = [mix(words.hash ^ np.uint64(0x5851F42D4C957F2D))], [words.doc]
    for k in PREFIXES:
        long = np.flatnonzero(words.end - words.start > k)
        parts.append(words.range_hash(words.start[long], words.start[long] + k))
        docs.append(words.doc[long])
    f, d = np.concatenate(parts), np.concatenate(docs)
    return f, d


def _join_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])


def _summaries(n: int, f: np.ndarray, d: np.ndarray, known: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Per text: the strongest weight among its features, and log(1 + its number of distinct known features)."""
    out = np.zeros((n, 2))
    if len(known) and len(f):
        at = np.minimum(np.searchsorted(known, f), len(known) - 1)
        hit = known[at] == f
        pairs = np.unique(d[hit] * len(known) + at[hit])
        doc, w = pairs // len(known), weight[pairs % len(known)]
        np.maximum.at(out[:, 0], doc, w)
        out[:, 1] = np.log1p(np.bincount(doc, minlength=n))
    return out


class Judge:
    """A fitted classifier: known features with weights, and a logistic curve."""

    def __init__(self, known: np.ndarray, weight: np.ndarray, curve: list[float]):
        self.known, self.weight, self.curve = known, weight, curve

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.known):
            return np.full(len(texts), 1 / (1 + math.exp(-self.curve[0])) if self.curve else 0.0)
        out, part, size = [], [], 0
        for t in [*texts, None]:
            if part and (t is None or size > 1 << 20):
                f, d = _features(*_join_texts(part))
                x = _summaries(len(part), f, d, self.known, self.weight)
                out.append(1 / (1 + np.exp(-np.clip(self.curve[0] + x @ np.array(self.curve[1:]), -30, 30))))
                part, size = [], 0
            if t is not None:
                part.append(t)
                size += len(t)
        return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[str], labels: np.ndarray) -> Judge:
    """Fit on restored texts; the labels are 0 and 1."""
    n, n_pos = len(texts), int(labels.sum())
    if not n_pos or n_pos == n:
        return Judge(np.zeros(0, np.uint64), np.zeros(0), [])
    base = n_pos / n

    def distinct(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        f, d = _features(*_join_texts(some))
        order = np.lexsort((f, d))
        f, d = f[order], d[order]
        first = np.ones(len(f), dtype=bool)
        first[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
        return f[first], d[first]

    # Only features of toxic documents can speak for toxicity; the others are never kept.
    toxic = [t for t, y in zip(texts, labels, strict=True) if y]
    known, pos = np.unique(np.concatenate([distinct(toxic[at : at + 200])[0] for at in range(0, len(toxic), 200)]), return_counts=True)
    known, pos = known[pos >= 3], pos[pos >= 3].astype(float)
    neg = np.zeros(len(known))
    hits = []
    for at in range(0, n, 200):
        f, d = distinct(texts[at : at + 200])
        place = np.minimum(np.searchsorted(known, f), max(len(known) - 1, 0))
        hit = known[place] == f if len(known) else np.zeros(len(f), dtype=bool)
        hits.append((place[hit].astype(np.int32), (d[hit] + at).astype(np.int32)))
        np.add.at(neg, hits[-1][0][labels[hits[-1][1]] == 0], 1)
    precision = lambda p, q: (p + PRIOR * base) / (p + q + PRIOR)
    logit = lambda p: np.log(p / (1 - p))
    strong = np.flatnonzero(precision(pos, neg) >= STRONG)
    place = np.full(len(known), -1)
    place[strong] = np.arange(len(strong))
    x = np.zeros((n, 2))
    for at, d in hits:  # each document is judged without its own count
        own = labels[d]
        p = precision(pos[at] - own, neg[at] - (1 - own))
        keep = p >= STRONG
        np.maximum.at(x[:, 0], d[keep], logit(p[keep]) - logit(STRONG) + 1)
        x[:, 1] += np.bincount(d[keep], minlength=n)
    x[:, 1] = np.log1p(x[:, 1])
    design = np.column_stack([np.ones(n), x])
    beta = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (labels - p) - 1e-2 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    weight = logit(precision(pos[strong], neg[strong])) - logit(STRONG) + 1
    return Judge(known[strong], weight, beta.tolist())


def fit_judge(docs: DataFrame, labels: DataFrame, channel: Channel, rows: int = FIT_ROWS) -> Judge:
    """Fit on the labelled rows that are not held out, at most ``rows`` of them. docs: _id, _text; labels: _id, _label."""
    sample = labels.filter(~held_out("_id", 5)).groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_top")).filter("_label = _top")
    sample = sample.orderBy(F.xxhash64("_id"), "_id").limit(rows).select("_id", "_label")
    texts = docs.join(F.broadcast(sample), "_id").dropDuplicates(["_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, labels = [], [], []
        for batch in batches:
            ids += batch.column("_id").to_pylist()
            labels += batch.column("_label").to_pylist()
            texts += [channel.restore_text(t) for t in batch.column("_text").to_pylist()]
        order = sorted(range(len(ids)), key=ids.__getitem__)
        judge = fit([texts[k] for k in order], np.array([labels[k] for k in order], dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([judge.known.tobytes()]), pa.array([judge.weight.tobytes()]), pa.array([judge.curve], pa.list_(pa.float64()))], names=["known", "weight", "curve"])

    got = texts.repartition(1).mapInArrow(run, "known binary, weight binary, curve array<double>").collect()  # one row, bounded by ``rows``
    if not got:
        return Judge(np.zeros(0, np.uint64), np.zeros(0), [])
    return Judge(np.frombuffer(got[0].known, dtype=np.uint64), np.frombuffer(got[0].weight), list(got[0].curve))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", restored: bool = True) -> DataFrame:
    """The documents with ``score`` (0 to 1) and, if asked for, ``restored`` (text without disguise)."""
    small_batches(docs.sparkSession)
    plain = id_text(docs, id_col, text_col)
    marks = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).filter("_id is not null and _label in (0, 1)")
    channel = Channel(trigram_counts(plain))
    model = fit_judge(plain, marks, channel)
    at = docs.columns
    text_at = at.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                texts = [channel.restore_text(t or "") for t in batch.column(text_at).to_pylist()]
                more = [pa.array(texts, pa.string())] * restored + [pa.array(model.score(texts), pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *["_restored"] * restored, "_score"])

    renamed = docs.select(*(F.col(c).alias(f"_c{k}") for k, c in enumerate(at)))
    kinds = ", ".join([f"{c} {t}" for c, t in renamed.dtypes] + ["_restored string"] * restored + ["_score double"])
    out = renamed.mapInArrow(run, kinds)
    return out.select(*(F.col(f"_c{k}").alias(c) for k, c in enumerate(at)), *[F.col("_restored").alias("restored")] * restored, F.col("_score").alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the score of their restored text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, table(spark, sf_dir, "labels"), restored=False)
    return out.select("doc_id", held_out("doc_id", 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
