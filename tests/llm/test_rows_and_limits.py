"""Ids that are null or shared, vectors of two lengths, and adversarial long texts."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitspark.llm import ann, decontaminate, jaccard, secrets, toxicity

WORDS = [f"w{k}" for k in range(4000)]


def _text(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def shared(spark):
    rng = random.Random(21)
    a, b, c, d = (_text(rng) for _ in range(4))
    rows = [(5, a), (5, b), (6, b + " tail"), (None, c), (None, d), (None, a + " end"), (7, None), (7, ""), (8, c + " x"), (9, d), (9, d)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_classes_of_shared_and_null_ids(shared):
    """Rows of one id and different texts are different documents; a link of either counts."""
    _, docs = shared
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.document_classes(docs).collect()), key=str)
    want = [(5, 56, 5), (5, 56, 5), (6, 57, 5), (None, 56, 8), (None, 56, 9), (None, 57, 5), (7, 0, 7), (7, 0, 7), (8, 57, 8), (9, 56, 9), (9, 56, 9)]
    assert got == sorted(want, key=str)


def test_one_of_each_keeps_unrelated_rows(spark, shared):
    rows, docs = shared
    got = {(r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect()}
    assert got == {rows[0], rows[1], rows[8], rows[9], (7, None)} or got == {rows[0], rows[1], rows[8], rows[9], (7, "")}
    rng = random.Random(22)
    alone = spark.createDataFrame([(None, _text(rng)) for _ in range(3)], "doc_id long, text string")
    assert jaccard.one_of_each(alone).count() == 3


def test_one_contaminated_row_takes_only_itself(spark):
    rng = random.Random(23)
    item, clean, other = _text(rng, 40), _text(rng), _text(rng)
    docs = spark.createDataFrame([(None, item), (None, clean), (4, other), (4, "before " + item + " after")], "doc_id long, text string")
    got = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r["text"] for r in got.collect()} == {clean, other}


def test_vectors_of_two_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(60)] + [(k, rng.standard_normal(5).tolist()) for k in range(100, 130)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.filter("vec_id = 3 or vec_id >= 100")  # most queries are of the other length
    got = ann.nearest(df, asked, 5).orderBy("rank").collect()
    x = {k: np.array(v) for k, v in rows[:60]}
    want = sorted((k for k in x if k != 3), key=lambda k: (-float((x[k] * x[3]).sum()), k))[:5]
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(3, k) for k in want]


LONG = 1 << 20


@pytest.mark.parametrize("text", ["-----BEGIN " + "A " * (LONG // 2), "eyJabcdefgh" * (LONG // 11), "password" * (LONG // 8), "password " + " " * LONG, "AKIA" * (LONG // 4), "a1" * (LONG // 2), "ghp_" * (LONG // 4), "xoxb-" * (LONG // 5), "token=" * (LONG // 6)])
def test_secret_rules_on_long_texts(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    secrets.find_secrets(df).select(F.size("spans")).collect()
    assert time.time() - began < 30


@pytest.mark.parametrize("text", ["a1 " + "b" * LONG, "a1 " + "ab" * (LONG // 2), "a.b.c.d." * (LONG // 8) + "zz", "a b c " * (LONG // 6) + "zz", "!" * LONG, "a1 " + "x-" * (LONG // 2), "aaa" + "é" * LONG])
def test_disguises_are_found_in_one_pass(text):
    began = time.time()
    for m in toxicity.DISGUISED.finditer(text):
        assert m.end() > m.start()
    assert time.time() - began < 5


def test_disguises_are_the_same_as_without_the_anchor():
    loose = toxicity.re.compile(toxicity.DISGUISED.pattern.replace(r"(?<![^\W_])(?<![@$!])", ""), toxicity.re.IGNORECASE)
    assert loose.pattern != toxicity.DISGUISED.pattern
    rng = random.Random(24)
    for _ in range(20_000):
        text = "".join(rng.choice("aab1$!@+(|-._ é*~'5") for _ in range(rng.randint(1, 25)))
        assert [m.span() for m in loose.finditer(text)] == [m.span() for m in toxicity.DISGUISED.finditer(text)]
