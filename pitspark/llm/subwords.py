"""Subword ids of whole texts by a byte-level vocabulary file, as the ``tokenizers`` library gives them.

A text is cut where its words surely end: before white space that follows other characters, and between an ASCII letter and an
ASCII sign.  Equal pieces of a block are encoded once, and a worker remembers pieces over blocks.  New pieces go through one call
on a text made of all of them; pieces whose characters may be classed otherwise by another library's tables (from U+0280 on, odd
white space), and texts that hold a special token, are given to the ``tokenizers`` library itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pitspark.llm.bpe import WORD, byte_alphabet
from pitspark.llm.common import distinct_runs, prefix_hash, range_hash, text_blocks

REMEMBERED = 600_000  # pieces a worker remembers; on reaching it the memory is emptied, results do not change
CALL_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.ones(256, dtype=bool)
_SIGN[128:] = _SIGN[48:58] = False
_SIGN &= ~_SPACE & ~_LETTER
#: Pieces that only the library itself encodes.
_ODD = rb"[\xca-\xff]|\xc2[\x85\xa0]|[\t-\r ]\Z|\A[^\x00-/:-@\[-`{-\x7f]"


class Subwords:
    """``encode`` gives ids of a block of texts; ``wide`` is the number of bytes that hold any id."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in s): i for s, i in spec["model"]["vocab"].items() if all(c in alphabet for c in s)}
        added = spec.get("added_tokens", [])
        self.added = [a["content"].encode() for a in added]
        self.odd = re.compile(b"|".join([_ODD, *map(re.escape, self.added)]))
        special = {a["id"] for a in added}
        ranks = {s: i for s, i in vocab.items() if i not in special}
        size = 1 + max([*vocab.values(), *special])
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.long = np.zeros(size, dtype=np.int64)
        for s, i in ranks.items():
            self.long[i] = len(s)
        # The merge order of such a file is the order of its ids; where it is not, every piece goes to the library.
        merges = [a.split(" ") if isinstance(a, str) else a for a in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in merges]
        self.fast = tiktoken.Encoding("pieces", pat_str=WORD, mergeable_ranks=ranks, special_tokens={}) if made == sorted(made) else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin = np.zeros(1 << 12, dtype=np.int64)  # where a piece's ids begin in the pool, and after the last the end
        self.pool = np.zeros(1 << 16, dtype=self.dtype)

    def _keep(self, pieces: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        first = len(self.known)
        at = int(self.begin[first])
        while at + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[at : at + len(ids)] = ids
        while first + len(pieces) >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.begin[first + 1 : first + 1 + len(pieces)] = at + np.cumsum(size)
        self.known.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def _learn(self, pieces: list[bytes]) -> None:
        odd = list(filter(self.odd.search, pieces)) if self.fast else pieces
        held = set(odd)
        plain = [p for p in pieces if p not in held]
        while plain:
            call, bulk = [], 0
            while plain and bulk < CALL_BYTES:
                call.append(plain.pop())
                bulk += len(call[-1])
            # A piece that opens with a sign stands behind a letter, as in its text: a word " a" goes before it.
            lead = [b"" if p[0] in b"\t\n\v\f\r " else b" a" for p in call]
            raw = b"".join([x for pair in zip(lead, call, strict=True) for x in pair])
            ids = np.asarray(self.fast.encode_to_numpy(raw.decode()))
            ends = np.cumsum(self.long[ids])
            leads, longs = np.array([len(x) for x in lead]), np.array([len(x) for x in call])
            stop = np.cumsum(leads + longs)
            a, b = np.searchsorted(ends, stop - longs, side="right"), np.searchsorted(ends, stop, side="right")
            if not (np.array_equal(ends[b - 1], stop) and all(x == 0 or ends[x - 1] == y for x, y in zip(a.tolist(), (stop - longs).tolist(), strict=True))):
                odd += call
                continue
            inside = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(inside, a, 1)
            np.add.at(inside, b, -1)
            self._keep(call, ids[np.cumsum(inside)[:-1] > 0], b - a)
        for at in range(0, len(odd), 1024):
            call = odd[at : at + 1024]
            found = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in call], add_special_tokens=False)]
            self._keep(call, np.array([i for x in found for i in x], dtype=self.dtype), np.array([len(x) for x in found]))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """data: bytes of the texts in a row, bounds: their offsets.  Ids of all texts, and where each text's ids begin (one more entry at the end)."""
        n = len(data)
        if not n:
            return np.zeros(0, dtype=self.dtype), np.zeros(len(bounds), dtype=np.int64)
        space = _SPACE[data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[1:n] = space[1:] & ~space[:-1] | _SIGN[data[1:]] & _LETTER[data[:-1]]
        after = np.flatnonzero(cut[:n] & np.append(False, data[:-1] >= 0x80))
        if len(after):  # white space may go on from a wide white space character
            x, y, z = data[np.maximum(after - 3, 0)].astype(np.int64), data[np.maximum(after - 2, 0)].astype(np.int64), data[after - 1].astype(np.int64)
            two, three = y << 8 | z, x << 16 | y << 8 | z
            wide = np.isin(two, [0xC285, 0xC2A0]) | np.isin(three, [0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]) | (three >= 0xE28080) & (three <= 0xE2808A)
            cut[after[wide]] = False
        raw = data.tobytes()
        for added in self.added:
            at = raw.find(added)
            while at >= 0:  # such a text is one piece
                d = int(np.searchsorted(bounds, at, side="right")) - 1
                cut[bounds[d] : bounds[d + 1]] = False
                at = raw.find(added, int(bounds[d + 1]))
        cut[bounds] = True
        cut[n] = True
        edge = np.flatnonzero(cut)
        start, end = edge[:-1], edge[1:]
        one, kind = distinct_runs(data, start, end, range_hash(*prefix_hash(data), start, end))
        pieces = [raw[a:b] for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)]
        if len(self.known) + len(pieces) > REMEMBERED:
            self._forget()
        known = self.known
        slot = [known.get(p, -1) for p in pieces]
        new = [k for k, s in enumerate(slot) if s < 0]
        if new:
            self._learn([pieces[k] for k in new])
            for k in new:
                slot[k] = known[pieces[k]]
        where = np.array(slot, dtype=np.int64)
        begin, size = self.begin[where][kind], (self.begin[where + 1] - self.begin[where])[kind]
        run = np.cumsum(size)
        ids = self.pool[np.repeat(begin - run + size, size) + np.arange(int(run[-1]))]
        return ids, np.concatenate([[0], run])[np.searchsorted(start, bounds)]


_OPEN: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """The worker's encoder for a vocabulary file."""
    if path not in _OPEN:
        _OPEN[path] = Subwords(path)
    return _OPEN[path]


def encoded(batch: pa.RecordBatch, path: str, column: str = "_text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with their ids: first row, last row + 1, ids, where each row's ids begin."""
    codec = subwords(path)
    for at, to, data, bounds in text_blocks(batch, column):
        yield at, to, *codec.encode(data, bounds)
