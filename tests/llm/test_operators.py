"""The operators on small fixtures against brute force, with nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitspark.llm import ann, bpe, components, decontaminate, jaccard, language_model, line_dedup, secrets, suffix_dedup, token_files, toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, runs int, spans int, score int"


def _prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "ing", "an", "re", "on", "é"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [_prose(rng, rng.choice([3, 30, 120, 400])) for _ in range(40)]
    texts += [texts[2], texts[2], texts[5] + " one more word at the end", texts[7].replace("th", "TH"), "", None, " \n\t ", "<|endoftext|> a<|endoftext|>"]
    texts += ["x = 1\n" + texts[9], 'password: "hunter2hunter2" AKIA' + "A" * 16 + " " + "0f" * 12 + " token=abc", _prose(rng, 20_000)]
    out = [(k * 3, t, "en", "s", len(t or ""), "c", "d", 1, 2, 3) for k, t in enumerate(texts)]
    return [*out, out[4], out[4], (None, texts[1], None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_equals_library_and_round_trips(docs, rows, empty):
    library = Tokenizer.from_file(TOKENIZER)
    got = bpe.encode_documents(docs, TOKENIZER, keep=("lang",)).collect()
    assert len(got) == len(rows)
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids for r in rows}
    assert all(r["ids"] == want[r["doc_id"]] and r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in got)
    digest = _by_id(bpe.encode_digests(docs, TOKENIZER))
    assert all(digest[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items())
    assert bpe.encode_digests(empty, TOKENIZER).collect() == []


def test_bpe_codec_stays_small():
    library = Tokenizer.from_file(TOKENIZER)
    codec = bpe.TrieBpe(TOKENIZER)
    fresh = {k for k, v in vars(codec).items() if v == {}}
    words = [f" {n}" for n in range(200_000)]
    for at in range(0, len(words), 20_000):
        codec.learn(set(words[at : at + 20_000]))
    assert len(codec.memory) <= 150_000
    assert fresh <= {"fits", "memory", "added", "step"}  # nothing else grows from empty; step is bounded by the automaton
    batch = pa.RecordBatch.from_pydict({"_id": [1], "_text": ["what a task has learned"]})
    assert sum(b.num_rows for b in bpe.digests(TOKENIZER)(iter([batch]))) == 1 and not bpe.codec(TOKENIZER).memory
    for text in (" ".join(map(str, range(0, 200_000, 1009))), "Internationalization of unbelievable counterrevolutionaries"):
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files_round_trip(spark, docs, rows, empty, planes, tmp_path):
    library = Tokenizer.from_file(TOKENIZER)
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, TOKENIZER, planes=planes)
    got = sorted(token_files.read_token_files(spark, path, planes, with_ids=True).collect(), key=lambda r: r["start"])
    at = 0
    for r, want in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = [*library.encode(want[1] or "", add_special_tokens=False).ids, 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (want[0], at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)
    token_files.write_token_files(empty, str(tmp_path / "none"), TOKENIZER)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).collect() == []


def test_line_dedup_against_brute_force(docs, rows, empty):
    seen, want = set(), {}
    for doc, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = (text or "").split("\n"), set()
        for p in range(len(lines) - line_dedup.MIN_LINES + 1):
            window = tuple(lines[p : p + line_dedup.MIN_LINES])
            gone |= set(range(p, p + line_dedup.MIN_LINES)) if window in seen else set()
            seen.add(window)
        want[doc] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    out = line_dedup.dedup_lines(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    assert all((r["n_removed"], r["text"] or "") == want[r["doc_id"]] for r in got)
    assert any(v[0] for v in want.values())
    assert line_dedup.dedup_lines(empty).collect() == []


def test_suffix_dedup_against_brute_force(docs, rows, empty):
    seen, want = set(), {}
    for doc, text in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw, gone = text.encode(), np.zeros(len(text.encode()), dtype=bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        want[doc] = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
    got = suffix_dedup.dedup(docs).collect()
    assert len(got) == len(rows)
    assert all(bytes(r["kept"]) == want[r["doc_id"]] for r in got)
    assert sum(len(r["removed"]) for r in got) > 3
    assert suffix_dedup.dedup(empty).collect() == []


def test_secrets_against_regex(spark, docs, rows, empty):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r["doc_id"]) or ""
        want = sorted((m.start(), no, kind, m.end()) for no, (kind, p, group, least) in enumerate(secrets.RULES) for m in re.finditer(p, text, re.ASCII) if len(m.group(group)) >= least)
        assert [tuple(s) for s in r["spans"]] == want
    assert any(len(r["spans"]) == 3 for r in got)
    # A ledger that holds every blob leaves nothing to scan, and its findings are used.
    ledger = secrets.scan_new(secrets.address(docs))
    assert secrets.scan_new(secrets.address(docs), ledger).count() == 0
    again = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs, ledger).collect()}
    assert again == {r["doc_id"]: r["spans"] for r in got}
    assert secrets.find_secrets(empty).collect() == []


def test_jaccard_classes_against_brute_force(spark, empty):
    rng = random.Random(5)
    texts = [_prose(rng, 60).split() for _ in range(12)]
    rows = []
    for k in range(150):
        words = list(rng.choice(texts))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = "new%d" % rng.randrange(50)
        rows.append((k, " ".join(words)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "ONE  two"), (None, rows[0][1]), rows[1]]
    own = {}
    for doc, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
        own[doc] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    root = {d: d for d in own if d is not None}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if own[a] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = jaccard.JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string")).classes.collect()
    assert len(got) == len(rows)
    assert all(r["n_shingles"] == len(own[r["doc_id"]]) for r in got)
    assert all(r["component_id"] == root[r["doc_id"] if r["doc_id"] is not None else 0] for r in got)
    assert jaccard.JaccardJoin(empty).classes.collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 500 for k in range(500, 560)}


def test_decontamination(spark, rows, docs, empty):
    items = spark.createDataFrame([(1, "Er ingan thre onon anre. Reer thing."), (2, None), (3, ""), (4, "Solo answer"), (4, "Solo answer")], "item_id long, text string")
    more = [(7000, "Words before er ingan thre onon anre. reer thing### and after", "en"), (7001, "er ingan other onon", "en"), (7002, "it is a SOLO, answer!", None), (7003, None, None)]
    both = spark.createDataFrame(more, "doc_id long, text string, lang string").unionByName(docs.select("doc_id", "text", "lang"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(both, items).collect()}
    assert got == {(7000, 1), (7002, 4)}
    assert both.count() - decontaminate.drop_contaminated(both, items).count() == 2
    assert decontaminate.contaminated(empty, items).collect() == []
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(rows)


def test_nearest_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 24))
    x[50] = x[60] = x[40]
    rows = [(k, [float(v) for v in x[k]]) for k in range(400)] + [(1000, None), (1020, [0.0] * 24), (1040, [float("nan")] * 24), (1060, [1.0]), (1080, [None] * 24)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 10).collect()
    hit = 0
    for q in range(0, 400, 20):
        scores = (x * x[q]).sum(axis=1)
        best = [k for k in np.lexsort((np.arange(400), -scores)) if k != q][:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(m[2] == scores[m[1]] for m in mine)
        hit += len({m[1] for m in mine} & set(best))
    assert hit >= 0.9 * 200
    assert {r["query_id"] for r in got} == set(range(0, 400, 20))
    assert ann.nearest(vectors.limit(0), vectors, 5).collect() == []


def test_toxicity_learns_and_restores(spark, empty):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        words = _prose(rng, 40).split(" ")
        bad = k % 4 == 0
        if bad:
            words.insert(5, rng.choice(["wretched", "vermin"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    rows += [(1001, "on an wr3tch3d thing"), (1002, "an w r e t c h e d er"), (1003, "vermiiiin"), (1004, None), (1005, ""), (None, "an er")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (3, 1), (9999, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.judge(docs, marks).collect()}
    assert len(got) == len(rows)
    assert got[1001]["restored"] == "on an wretched thing" and got[1002]["restored"] == "an wretched er"
    assert all(got[k]["score"] >= 0.5 for k in (1001, 1002))
    assert all(got[k]["score"] < 0.5 for k in (1004, 1005, None))
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(got[k]["score"] >= 0.5) == (k % 4 == 0) for k in held]) > 0.95
    assert toxicity.judge(empty, marks).collect() == []
    assert all(r["score"] == 0 for r in toxicity.judge(docs, marks.limit(0)).collect())


def test_language_model_baseline_and_probabilities(spark, docs, rows, empty):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    got = language_model.score_documents(docs, path, pattern).collect()
    assert len(got) == len(rows)
    counts, out = {}, lambda k: zlib.crc32((str(k) if k is not None else "").encode()) % 10 == 0
    words = lambda t: [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""]
    for r in rows:
        if not out(r[0]):
            for w in words(r[1]):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        own = words(text)
        want = sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert r["held_out"] == out(r["doc_id"]) and r["n_tokens"] == len(own) and r["train_tokens"] == n
        assert r["n_known"] == sum(w in counts for w in own)
        assert r["base_score"] == pytest.approx(want)
        assert r["score"] < 0
    assert language_model.score_documents(empty, path, pattern).collect() == []


def test_attention_gradient():
    rng = np.random.default_rng(0)
    net = language_model.Attention()
    inputs = rng.integers(0, language_model.INPUTS, (2, language_model.CONTEXT))
    classes = rng.integers(0, language_model.CLASSES, inputs.shape)
    scored = rng.random(inputs.shape) < 0.7
    start = net.w.astype(np.float64)
    net.w = start.copy()
    g, _ = net.gradient(inputs, classes, scored)
    for cut in net.cut.values():
        k = int(rng.integers(cut.start, cut.stop))
        near = []
        for step in (1e-4, -1e-4):
            net.w = start.copy()
            net.w[k] += step
            near.append(net.gradient(inputs, classes, scored)[1])
        assert (near[0] - near[1]) / 2e-4 == pytest.approx(g[k], rel=1e-3, abs=1e-4)


def test_model_is_a_distribution():
    counts = np.random.default_rng(1).integers(0, 50, 2001).astype(float)
    classes = language_model.Classes(counts, np.arange(2000) % 3 == 0)
    classes.add_pairs(np.array([1, 1, 2]), np.array([5, 9, 7]), np.array([3, 1, 2]))
    h = np.random.default_rng(2).standard_normal((1, language_model.WIDTH)).astype(np.float32)
    net = language_model.Attention()
    ids = np.arange(2001)
    total = np.exp(net.log_classes(h)[0, classes.outputs] + classes.log_within(np.ones(2001, dtype=int), ids)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_attention_learns_from_every_window_of_every_bucket(spark):
    rng = np.random.default_rng(4)
    ways = [(np.arange(40) * 7 + 3) % 40, (np.arange(40) * 11 + 9) % 40 + 40]  # each bucket's texts go their own way through their own ids

    def walk(k):
        ids = [int(rng.integers(40)) + 40 * k]
        for _ in range(200):
            ids.append(int(ways[k][ids[-1] % 40]))
        return ids

    texts = [[walk(k) for _ in range(1500)] for k in range(2)]
    piles = [language_model.Ids(np.arange(len(t) + 1) * 201, np.array(t, dtype=np.int32).ravel()) for t in texts]
    classes = language_model.Classes(np.bincount(np.concatenate([p.ids for p in piles]), minlength=1001).astype(float), np.zeros(1000, dtype=bool))
    for p in piles:
        again = language_model.Ids.unpack(p.pack())
        assert (again.ids == p.ids).all() and (again.first == p.first).all()
        got = list(language_model._batches(p, classes, [0, 1]))
        assert sum(int(scored[:, language_model.OVERLAP :].sum()) for _, _, scored in got) == len(p.ids)  # each id is learned once a round
    n = [int((-(-np.diff(p.first) // language_model.STRIDE)).sum()) for p in piles]
    taught = spark.createDataFrame([(k, p.pack(), n[k]) for k, p in enumerate(piles)], "bucket int, windows binary, n long")
    net = language_model.Attention(language_model._train(taught, classes))
    loss = [np.mean([net.gradient(*b)[1] for b in language_model._batches(p, classes, [9])]) for p in piles]
    assert max(loss) < 2 and abs(loss[0] - loss[1]) < 0.3


def test_attention_decides_frequent_ids_from_a_long_context():
    rng = np.random.default_rng(6)
    counts = np.zeros(5001)
    counts[:300] = 1000 + rng.permutation(300)
    counts[300:] = 1
    classes = language_model.Classes(counts, np.arange(5000) % 2 == 0)
    classes.add_pairs(np.zeros(300, dtype=int), np.arange(300), np.ones(300, dtype=int))
    assert len(set(classes.outputs[:300])) == 300
    assert np.abs(classes.log_within(np.zeros(300, dtype=int), np.arange(300))).max() < 1e-9  # nothing is left to the counted factor
    text = language_model.Ids(np.array([0, 400]), rng.integers(0, 300, 400).astype(np.int32))
    place, owner = text.windows(np.array([0]))
    inputs, _, scored = text.read(place, owner)
    before = np.cumsum(inputs >= 0, axis=1)
    at = place[:, None] - language_model.OVERLAP + np.arange(language_model.CONTEXT)
    assert (before[scored] >= np.minimum(at[scored], 16)).all() and before[scored].max() >= 63


def test_line_dedup_of_long_lines_against_brute_force(spark):
    rng = random.Random(6)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    pool = [line(n) for n in (1, 5, 20, 25, 29, 30, 49, 50, 51, 70, 432)] + ["", " \t ".join(["x"] * 50)]
    texts = ["\n".join(rng.choice(pool) if rng.random() < 0.6 else line(rng.choice([2, 30])) for _ in range(rng.choice([1, 1, 2, 3, 6, 12]))) for _ in range(120)]
    texts += [pool[8], pool[8], pool[3] + "\n" + pool[4], pool[3] + "\n" + pool[4], pool[6], pool[6], None, ""]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, pool[9]), (5, texts[5])]
    seen, want = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = (text or "").split("\n"), set()
        for p in range(len(lines)):
            for size in range(1, 4):
                window = tuple(lines[p : p + size])
                if len(window) == size and (size == 3 or len(" ".join(window).split()) >= 50):
                    gone |= set(range(p, p + size)) if window in seen else set()
                    seen.add(window)
        want[doc] = (len(gone), sum(k - 1 not in gone for k in gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    assert all((r["n_removed"], len(r["removed_runs"]), r["text"] or "") == want[r["doc_id"]] for r in got)
    assert sum(v[2] == "" and v[0] > 0 for v in want.values()) >= 3


def test_secrets_of_repeated_rows(spark):
    text = "a token=abcdef12 and password: hunter2hunter2 " + "0f" * 12
    rows = [(1, text), (1, text), (None, text + " x"), (None, text + " x"), (None, text), (2, "AKIA" + "A" * 16), (2, "AKIA" + "A" * 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["blob"], [tuple(s) for s in r["spans"]]) for r in secrets.find_secrets(docs).collect()]
    want = [
        (doc, hashlib.sha256(t.encode()).hexdigest(), sorted((m.start(), no, kind, m.end()) for no, (kind, p, group, least) in enumerate(secrets.RULES) for m in re.finditer(p, t, re.ASCII) if len(m.group(group)) >= least))
        for doc, t in rows
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert secrets.scan_new(secrets.address(docs)).count() == 3


def test_every_disguised_word_makes_its_text_suspect():
    rng = random.Random(8)
    some = ["a55", "sh17", "dumba55", "b55", "i d ! o t", "x-y_z*w", "i.d-i~o't", "fr$", "a!", "a b c d", "sooo", "a @ $ $", "it's", "é55"]
    signs = "".join(toxicity.STANDS_FOR) + toxicity.APART
    some += ["".join(rng.choice("aBzé7_\n" + signs) for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    hit = [t for t in some if toxicity.DISGUISED.search(t)]
    assert set(some[:5]) <= set(hit) and len(hit) > 1000
    assert [t for t in hit if not toxicity.SUSPECT.search(t)] == []
