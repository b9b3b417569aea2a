"""What is shuffled for the Jaccard join stays narrow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from milldam.llm import jaccard, linking


def test_bitmaps_follow_the_size():
    """Bitmaps never overstate a difference, whatever the two sizes, and tell long sets apart that share most of their members."""
    rng = np.random.default_rng(7)
    for n in (0, 1, 5, 512, 513, 4000, 5000, 40_000):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for gone in (0, n // 100, n // 3):
            other = np.unique(np.concatenate((base[gone:], rng.integers(0, 1 << 63, gone + n // 4, dtype=np.uint64))))
            bits = linking.differing([linking.bitmap(base), b"\0" * 128], [linking.bitmap(other), b"\0" * 8192])
            assert bits[1] == 0 and bits[0] <= len(np.setxor1d(base, other))
    u, v = (np.unique(np.concatenate((np.arange(2500, dtype=np.uint64) << np.uint64(9), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)))) for _ in range(2))
    assert linking.differing([linking.bitmap(u)], [linking.bitmap(v)])[0] > 7000 * 20 // 180  # similarity 0.56


def test_long_sets_are_told_apart_before_they_are_got(spark):
    """Sets of 3,000 members without a common one are not asked for whole."""
    sets = {fp: np.random.default_rng(fp).integers(0, 1 << 63, 3000, dtype=np.uint64) for fp in range(4)}
    maps = spark.createDataFrame([(fp, 3000, bytearray(linking.bitmap(x))) for fp, x in sets.items()], "fp long, n long, bits binary")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (3, 1), (2, 3)], "u long, v long")

    def whole(fps):
        raise AssertionError("got whole")

    assert linking.verified(pairs, linking.Sets(maps, whole), 80).count() == 0


@pytest.mark.parametrize("sizes", [(300, 300), (2100, 300), (2600, 2400)])
def test_groups_meet_heads_of_any_size(sizes):
    """A group's sets have bitmaps of several sizes."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, max(sizes), dtype=np.uint64))
    sets = [base[: sizes[0]], base[: sizes[1]], rng.integers(0, 1 << 63, sizes[1], dtype=np.uint64)]
    tables = [pa.table({"fp": ids, "n": [len(sets[i]) for i in ids], "comp": ids, "bits": [linking.bitmap(sets[i]) for i in ids]}) for ids in ([1, 2], [0])]
    found = linking._near(80)(*tables)
    assert found.column("u").to_pylist() == ([1] if min(sizes) * 100 >= 80 * max(sizes) else []) and set(found.column("v").to_pylist()) <= {0}


def test_keys_are_narrow_and_shuffled_once(spark):
    """A key and its kind take six bytes, and the row that is shuffled and written holds them once."""
    texts = [" ".join(f"w{k // 2}-{i}" for i in range(60)) for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard.keys_of_texts(docs, 5, 80, np.empty(0, np.uint64))
    low, high = rows.select(F.explode("keys").alias("k")).agg(F.min("k"), F.max("k")).first()
    assert 0 <= low and high < 1 << 48
    found = jaccard.shared_keys(rows)
    assert found.columns == ["packed", "fp", "own"] and found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert found.where("packed is null").count() == 4
    assert jaccard.told(found).columns == ["key", "fp", "lower", "worth"]
