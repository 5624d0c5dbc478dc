"""Op1's full search of a list: what the parity maps that go with its entries rule out."""

import numpy as np
import pyarrow as pa

from pitspark.llm import common, jaccard


def _list(sets):
    """The entries of one list, each set in a class of its own."""
    maps = [jaccard.parity_map(s) for s in sets]
    n = len(sets)
    return pa.RecordBatch.from_pydict({
        "token": [7] * n, "lo": [0] * n, "hi": [0] * n, "rep": list(range(n)), "size": [len(s) for s in sets], "pos": [0] * n, "root": list(range(n)), "own": [0] * n,
        "fold": [jaccard._folded(m) for m in maps], "bits": maps,
    })


def test_long_sets_that_share_little_are_no_candidates():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 2**63, 1300).astype(np.uint64)) for _ in range(40)]
    like = np.concatenate([sets[0][:-50], np.unique(draw.integers(0, 2**63, 50).astype(np.uint64))])  # links with the first
    found = {(a, b) for batch in jaccard._across(iter([_list([*sets, like])])) for a, b in zip(*(batch.column(c).to_pylist() for c in "ab"), strict=True)}
    assert found == {(0, 40)}


def test_maps_differ_as_pair_by_pair():
    draw = np.random.default_rng(4)
    maps = jaccard._objects([*(jaccard.parity_map(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (5, 600, 1100, 1500, 5000)), b""])
    a, b = (x.ravel() for x in np.meshgrid(range(6), range(6)))
    want = [jaccard.least_difference(maps[i], maps[j]) if maps[i] and maps[j] else 0 for i, j in zip(a, b, strict=True)]
    assert jaccard.maps_differ(maps, a, b).tolist() == want


def test_whole_texts_reach_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    try:
        for given, want in (("700", 700), ("10000", common.BATCH_ROWS), ("-1", common.BATCH_ROWS), ("0", common.BATCH_ROWS)):
            spark.conf.set(key, given)
            common.small_batches(spark)
            assert int(spark.conf.get(key)) == want
        sizes = spark.range(5000).coalesce(1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r["n"] for r in sizes) == 5000 and max(r["n"] for r in sizes) <= common.BATCH_ROWS
    finally:
        spark.conf.set(key, was)
