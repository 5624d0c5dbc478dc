"""Ranked search, packing and conversation repair against brute force, with nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pitspark.llm import conversations, packing, ranked_search, subwords
from pitspark.llm.conversations import Turn

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, _id string, block int, size string, term string"
ODD = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "²", ".", ",", "'s", "'t", "'", "\xa0", " ", "　", "中", "\x00", "\x1c", "\x85", "<|endoftext|>", "ß", "!", "​", "\r\n", "😀", "́", "٣", "ª"]


def _prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "ing", "an", "re", "on", "é"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [_prose(rng, rng.choice([1, 5, 60, 400, 3000])) for _ in range(50)]
    texts += [texts[3], texts[3].upper(), "", None, " \n\t", "<|endoftext|> x<|endoftext|>", "word " * 5000, "x" * 3_000, _prose(rng, 150_000), "".join(rng.choice(ODD) for _ in range(500))]
    out = [(k * 7, t, "i", 1, "s", "t") for k, t in enumerate(texts)]
    return [*out, out[4], out[4], (None, texts[0], None, None, None, None), (None, texts[1], None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_subwords_equal_library():
    rng = random.Random(4)
    texts = ["", *("".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(4000))]
    library = Tokenizer.from_file(TOKENIZER)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["_text"])
    got = [ids[first[k] : first[k + 1]].tolist() for at, to, ids, first in subwords.encoded(batch, TOKENIZER) for k in range(to - at)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


# ---------------------------------------------------------------- packing

def test_fill_comes_closest():
    rng = random.Random(5)
    for _ in range(200):
        cap = rng.randint(5, 40)
        counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(1, 8)))
        longest = max(counts)
        pieces = list(counts.elements())
        pieces.remove(longest)
        best = max(longest + sum(c) for n in range(len(pieces) + 1) for c in itertools.combinations(pieces, n) if longest + sum(c) <= cap)
        chosen = packing.fill(dict(counts), cap)
        assert sum(s * n for s, n in chosen.items()) == best and not Counter(chosen) - counts


def test_plan_places_every_piece_once():
    rng = random.Random(6)
    for counts in [{}, {1: 1}, {700: 1}, {600: 100_001}, {1023: 999, 5: 3}, {s: rng.randint(0, 50) for s in range(1, 1024)}]:
        rows = packing.plan(counts)
        made = Counter({s: n for s, n in counts.items() if n})
        for size, first, last, _, _, _, taken, rest in rows.tolist():
            if taken < size:
                assert rest >= counts.get(size - taken, 0)
                made[size - taken] += last - first
        for size, n in made.items():  # the ranges of a length are the numbers 0 to n - 1
            spans = sorted((a, b) for s, a, b, *_ in rows.tolist() if s == size)
            assert [0, *(b for _, b in spans)] == [*(a for a, _ in spans), n]
        assert len(rows) < 20_000  # a hot length takes one step


def _packed(docs, rows, capacity):
    library = Tokenizer.from_file(TOKENIZER)
    got = packing.pack_documents(docs, TOKENIZER, capacity).collect()
    want = defaultdict(list)
    for r in rows:
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[r[0]].append(ids)
    sequences = defaultdict(list)
    for p in got:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0
    assert sum(p["length"] for p in got) == sum(len(i) for v in want.values() for i in v)
    expected = Counter()
    for p in got:  # copies of an id may be cut in different ways
        assert any(len(i) == p["doc_tokens"] and zlib.crc32(i[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for i in want[p["doc_id"]])
        expected[p["doc_id"]] += p["length"]
    assert expected == {k: sum(map(len, v)) for k, v in want.items()}
    return sequences


@pytest.mark.parametrize("capacity", [16, 1000, 1024])
def test_packing(docs, rows, capacity):
    sequences = _packed(docs, rows, capacity)
    assert sum(sum(n for _, n in s) != capacity for s in sequences.values()) <= capacity.bit_length()


def test_packing_of_nothing_and_of_copies(spark, empty):
    assert packing.pack_documents(empty, TOKENIZER).collect() == []
    copies = [(k, "one two three four five six", None, None, None, None) for k in range(300)]
    _packed(spark.createDataFrame(copies, SCHEMA).repartition(5), copies, 16)


# ---------------------------------------------------------------- conversations

def _walk(turns):
    """Least cost, audit and lines by a walk over the grammar's states with whole strings."""
    goes = {0: 2, 1: 2, 2: 3, 3: 2}

    def close(best):
        for _ in range(2):
            for x, (c, a, lines) in list(best.items()):
                y = goes[x]
                cand = (c + 2, a + "I", (*lines, ("user:" if y == 2 else "assistant:")))
                best[y] = min(best.get(y, cand), cand)
        return best

    best = close({0: (0, "", ())})
    for t in turns:
        new = {}
        for x, (c, a, lines) in best.items():
            ways = [(x, 3, "D", ())]
            if t.fault not in (1, 2):
                extra, y = int(t.fault == 3), goes[x]
                own = (f"{t.role}:{t.text}",)
                if t.role[:1] == " sua"[y]:
                    ways.append((y, extra, "K", own))
                if x == 0 and t.role[:1] == "s":
                    ways.append((1, extra, "K", own))
                ways.append((y, 2 + extra, "R", (("user:" if y == 2 else "assistant:") + t.text,)))
            for y, cost, edit, line in ways:
                cand = (c + cost, a + edit, lines + line)
                new[y] = min(new.get(y, cand), cand)
        best = close(new)
    return min(best[x] for x in (0, 3) if x in best)


def _turns(rng, n):
    wild = rng.random()
    roles = ["user", "assistant", "system", "tool", "", "sys", "u", " "]
    return [Turn(rng.choice(roles) if rng.random() < wild else ("user", "assistant")[k % 2], f"t{k}.", rng.choice([0, 0, 0, 1, 2, 3]) if rng.random() < wild else 0) for k in range(n)]


def test_alignment_equals_walk():
    rng = random.Random(9)
    for _ in range(1500):
        turns = _turns(rng, rng.choice([0, 1, 2, 3, 5, 8, 12, 20]))
        cost, audit, lines = _walk(turns)
        assert conversations.whole(turns) == (cost, audit)
        repaired = conversations.Repaired()
        repaired.add(turns, audit)
        assert repaired.sha.hexdigest() == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        width = rng.choice([1, 2, 3, 7])
        total, chain = conversations.joined([conversations.between(turns[k : k + width]) for k in range(0, len(turns), width)])
        joined = ""
        while chain:
            joined, chain = joined + chain.audit, chain.after
        assert (total, joined) == (cost, audit)


CONV = "conv_id long, turn long, role string, text string, _conv string, n int"


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(10)
    says = ["Yes.", "No!", "open", "", None, " \n", "a?b.", "Why? ", "　"]
    out = []
    for conv in [*range(120), None]:
        for turn in range(rng.choice([1, 2, 3, 6, 9, 40])):
            out.append((conv, rng.choice([turn, turn, turn, turn // 2, None]), rng.choice(["user", "assistant", "system", None, "", "tool"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2], rng.choice(says), "c", 1))
    out += [(500, k % 900, ("user", "assistant")[k % 2], f"line {k % 1100}." if k % 13 else "open end", "c", 1) for k in range(1500)]
    return [*out, out[0], out[5], out[5]]


def _by_hand(rows):
    groups = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        groups[conv].append((turn, role, text))
    want = {}
    for conv, members in groups.items():
        after = []
        for turn, role, text in members:
            rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
            after += [(turn, "user" if rule == 4 else role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)
        after.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        turns, seen = [], set()
        for _, role, text in after:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            turns.append(Turn(role, text, 1 if not words else 2 if (role, text) in seen else 3 if words[-1] not in ".!?" else 0))
            seen.add((role, text))
        cost, audit, lines = _walk(turns)
        numbers = [t for t, _, _ in after if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults = Counter(t.fault for t in turns)
        illegal = sum(a.role[:1] + b.role[:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        want[conv] = (gaps, faults[1], faults[2], faults[3], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return want


@pytest.mark.parametrize("limits", [{}, {"long_rows": 3}, {"long_bytes": 40}])
def test_conversations(spark, talk, limits):
    """All limits give the same rows, whether a conversation is read by one task or cut over many."""
    got = conversations.repair(spark.createDataFrame(talk, CONV).repartition(4), **limits).collect()
    assert len(got) == len({r[0] for r in talk})
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == _by_hand(talk)


def test_no_conversations(spark):
    assert conversations.repair(spark.createDataFrame([], CONV)).collect() == []


# ---------------------------------------------------------------- ranked search

def _ranked(rows, items, top=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    bags = [(r[0], Counter(terms(r[1]))) for r in rows]
    bags = [b for b in bags if b[1]]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    want = {}
    for item in set(items):
        scored = []
        for doc, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // n_terms
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in set(terms(item[1])) if t in bag)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        want[item] = [(k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 3}, {"block_docs": 7, "bundle_items": 2}])
def test_ranked_search(spark, docs, rows, sizes):
    rng = random.Random(11)
    items = [(k, " ".join(rng.sample(re.findall(r"\w+", rng.choice(rows[:50])[1]) * 9, 9))) for k in range(12)]
    items += [(12, "THERE the re an on."), (12, "another text of that id"), (None, items[0][1]), (13, None), (14, ""), (15, "qqqq zzzz"), (16, "word x" + "x" * 2999), items[1]]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = defaultdict(list)
    for r in ranked_search.RankedSearch(docs, table, **sizes).best().collect():
        got[(r["item_id"], r["item_text"])].append((r["rank"], r["doc_id"], r["score"]))
    assert {k: sorted(v) for k, v in got.items()} == _ranked(rows, items)


def test_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame([(1, "there")], "item_id long, text string")
    assert ranked_search.RankedSearch(empty, items).best().collect() == []
    assert ranked_search.RankedSearch(docs, items.limit(0)).best().collect() == []


def test_long_texts_are_cut_between_terms():
    data = np.frombuffer(("ab cd, " * 700_000 + "z" * 3_000_000).encode(), dtype=np.uint8)
    pieces = [p for _, p, _ in ranked_search._pieces(data, np.array([0, len(data)]))]
    assert len(pieces) > 3 and np.array_equal(np.concatenate(pieces), data)
    inside = ranked_search._IN_TERM
    assert not any(inside[a[-1]] and inside[b[0]] for a, b in itertools.pairwise(pieces))
