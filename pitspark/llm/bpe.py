"""Byte-level BPE encoding and decoding by a prefix-sharing trie walk.

A greedy-merge (BPE) encoding has two properties.  Every prefix of an encoding is itself the encoding of the bytes it
covers, and a sequence of tokens is an encoding exactly when every two neighbours are: no merge ever crosses the seam
between them.  So the encoding of a byte string is known from one *last token* for each of its prefixes, and the last
token of a prefix is the one vocabulary entry that ends there and fits behind the last token of the shorter prefix.

The distinct words of a batch are walked in sorted order, which is the depth-first order of their trie: the last tokens of
the path shared with the word before stay on the stack, so a shared prefix is solved once.

Edge cases: null text counts as empty (no ids, empty decoded text); rows are independent, so repeated rows, null ids and
ties need no rule; a text of any length is one row of the batch; extra columns are ignored unless
``keep`` names them; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import id_text, real_id, table

# White space and the word pattern of the byte-level pre-tokenizer.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
CACHE_WORDS = 150_000  # distinct words a Python worker remembers; on reaching it the memory is emptied, results do not change
CACHE_PAIRS = 600_000  # the same for pairs of tokens; dear to find and soon all known
GROUP_CHARS = 500_000  # text that is cut into words at once
PLAIN_WORD_CACHE = 1_000_000  # the same, where only the ids of a word are kept


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TrieBpe:
    """Encoder and decoder for the vocabulary and merges of a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: raw(s) for s, i in vocab.items()}
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.bytes_of.update({i: s.encode() for s, i in self.added.items()})
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, token)
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            self.joined.setdefault((x, y), (rank, t))
            self.halves.setdefault(t, (x, y))
        self.rank = {t: self.joined[p][0] for t, p in self.halves.items()}
        self.fits: dict[int, bool] = {}
        # An entry is of use only if its own bytes encode to it.
        self.entry: dict[bytes, int] = {}
        for t in sorted(vocab.values(), key=lambda t: self.rank.get(t, -1)):
            own = self.halves.get(t)
            if own is None and len(self.bytes_of[t]) > 1 or own and self._crossing(*own) != self.rank[t]:
                continue
            self.entry[self.bytes_of[t]] = t
        self._automaton()
        self.split_added = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(WORD)
        self.memory: dict[str, tuple[str, int, bytes]] = {}

    def _automaton(self) -> None:
        """States are prefixes of entries; ``ends[s]`` lists the entries that end in state s, longest first."""
        prefixes = {b""} | {e[:k] for e in self.entry for k in range(1, len(e) + 1)}
        self.state = {p: k for k, p in enumerate(sorted(prefixes, key=len))}
        self.name = list(self.state)
        self.step: dict[int, int] = {}  # state << 8 | byte -> state, filled as needed
        ends: list[list[tuple[int, int]]] = [[] for _ in self.name]
        for k, p in enumerate(self.name[1:], 1):
            own = [(self.entry[p], len(p))] if p in self.entry else []
            ends[k] = own + ends[self._suffix(p[1:])]
        self.ends = ends

    def _suffix(self, tail: bytes) -> int:
        while tail not in self.state:
            tail = tail[1:]
        return self.state[tail]

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at a token's right (1) or left (0) edge while it is built, each with the rank that consumes it.

        Walked anew each time: kept for all tokens, the edges would be larger than the vocabulary.
        """
        edge, halves, rank = [(token, float("inf"))], self.halves, self.rank
        own = halves.get(token)
        while own is not None:
            until, token = rank[token], own[side]
            edge.append((token, until))
            own = halves.get(token)
        return edge

    def _crossing(self, a: int, b: int) -> float:
        """Rank of the first merge over the seam between a and b; infinite if there is none."""
        first = float("inf")
        joined = self.joined
        right = self._edge(b, 0)
        for x, x_until in self._edge(a, 1):
            for y, y_until in right:
                hit = joined.get((x, y))
                if hit is not None and hit[0] < x_until and hit[0] <= y_until:
                    first = min(first, hit[0])
        return first

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words, solved together: one last token for each node of their trie."""
        fits, step, ends = self.fits, self.step, self.ends
        out: dict[bytes, list[int]] = {}
        last: list[int] = [-1]  # last[i]: last token of the first i bytes of the current path
        size: list[int] = [0]
        states: list[int] = [0]
        before = b""
        for word in sorted(words):
            n = len(word)
            shared = 0
            for x, y in zip(word, before):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], size[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for i in range(shared + 1, n + 1):
                key = state << 8 | word[i - 1]
                to = step.get(key)
                if to is None:
                    to = step[key] = self._suffix(self.name[state] + word[i - 1 : i])
                state = to
                states.append(state)
                for t, k in ends[state]:
                    if k < i:
                        pair = last[i - k] << 32 | t
                        ok = fits.get(pair)
                        if ok is None:
                            ok = fits[pair] = self._crossing(last[i - k], t) == float("inf")
                        if not ok:
                            continue
                    last.append(t)
                    size.append(k)
                    break
                else:
                    raise ValueError(f"no token ends at byte {i} of {word!r}")
            ids, i = [], n
            while i:
                ids.append(last[i])
                i -= size[i]
            out[word] = ids[::-1]
            before = word
        if len(fits) > CACHE_PAIRS:
            fits.clear()
        return out

    def pieces(self, text: str) -> list[str]:
        """Words of a text, which encode independently; added tokens stand alone."""
        if not any(x in text for x in self.added):
            return self.words.findall(text)
        out = []
        for part in self.split_added.split(text):
            out.extend([part] if part in self.added else self.words.findall(part))
        return out

    def learn(self, pieces: set[str]) -> None:
        """Put the given words into the memory: decimal ids, their number, and the bytes that the ids decode to."""
        new = {p for p in pieces if p not in self.memory}
        if len(self.memory) + len(new) > CACHE_WORDS:
            self.memory.clear()
            new = pieces
        text = {w.encode(): w for w in new if w not in self.added}
        for raw, ids in self.encode_words(text).items():
            self.memory[text[raw]] = (",".join(map(str, ids)), len(ids), b"".join(map(self.bytes_of.__getitem__, ids)))
        for w in (w for w in self.added if w in new):
            self.memory[w] = (str(self.added[w]), 1, self.bytes_of[self.added[w]])

    def encode(self, text: str) -> list[int]:
        ps = self.pieces(text)
        self.learn(set(ps))
        return [int(i) for p in ps for i in self.memory[p][0].split(",")]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, TrieBpe] = {}


def codec(path: str) -> TrieBpe:
    """One codec for each Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = TrieBpe(path)
    return _LOADED[path]


def _groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def digests(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            n_tokens, ids_sha, text_sha = [], [], []
            for texts in _groups(batch.column("_text").to_pylist()):
                cut = [bpe.pieces(t) for t in texts]
                bpe.learn({p for ps in cut for p in ps})
                memory = bpe.memory
                for ps in cut:
                    known = [memory[p] for p in ps]
                    n_tokens.append(sum(k[1] for k in known))
                    ids_sha.append(hashlib.sha256(",".join([k[0] for k in known]).encode()).hexdigest())
                    decoded = b"".join([k[2] for k in known]).decode("utf-8", "replace")
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.memory.clear()  # the worker lives on, with other tasks to do

    return run


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document with ``ids`` (array of int), ``n_tokens`` and ``decoded`` (text of the ids), and the ``keep`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            ids, decoded = [], []
            for texts in _groups(batch.column("_text").to_pylist()):
                for t in texts:
                    got = bpe.encode(t)
                    ids.append(got)
                    decoded.append(bpe.decode(got))
            rest = [batch.column(f"_keep{k}") for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *rest, pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64()), pa.array(decoded, pa.string())],
                names=["_id", *(f"_keep{k}" for k in range(len(keep))), "ids", "n_tokens", "decoded"],
            )

    source = docs.select(F.col(id_col).alias("_id"), *(F.col(c).alias(f"_keep{k}") for k, c in enumerate(keep)), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kinds = ", ".join(f"{c} {t}" for c, t in source.drop("_text").dtypes)
    out = source.mapInArrow(run, f"{kinds}, ids array<int>, n_tokens bigint, decoded string")
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_keep{k}").alias(c) for k, c in enumerate(keep)), "ids", "n_tokens", "decoded")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of ids and SHA-256 of the ids and of the decoded text of every document, without moving the ids out of the task."""
    out = id_text(docs, id_col, text_col).mapInArrow(digests(path), "_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.select(real_id().alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the 50k byte-level vocabulary."""
    import public_tokenizers

    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
