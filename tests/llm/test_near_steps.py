"""The steps of near_duplicates() are those of the named method: fingerprints, deletion variants, components, then the exact check."""

import time
from pathlib import Path

import pytest

from milldam.llm import jaccard, simhash


def test_fingerprints_give_candidates(spark, monkeypatch):
    """Without a single key of minima, near copies within two bits are still found; fingerprints that are near by chance are told apart by sets."""
    words = [f"w{i}" for i in range(3000)]
    near = " ".join([*words[:-1], "other"])
    texts = [" ".join(words), near, " ".join(words[:2000]), " ".join(f"v{i}" for i in range(50))]
    prints = [simhash.fingerprint(t.encode(), 5) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= 2
    monkeypatch.setattr(simhash, "BANDS", 0)
    monkeypatch.setattr(simhash, "_factors", simhash._factors[:0])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}


def test_alike(spark):
    """Sets with fingerprints within two bits, over others, and equal ones."""
    sets = spark.createDataFrame([(10, 0), (11, 0b11), (12, 0b1111), (13, 0xFFFF), (14, 0xFFFF), (15, 1 << 40 | 0xF0F000)], "fp long, sim long")
    assert {(r.u, r.v) for r in simhash.alike(sets).collect()} == {(11, 10), (12, 10), (14, 13)}


@pytest.mark.parametrize("operator", [jaccard.grouped, simhash.near_duplicates])
def test_shuffle_files_go_with_their_step(spark, operator):
    """The disk holds one step's shuffles at a time, without a garbage collection of the driver; the session's setting stays as it was."""
    local = Path(spark.conf.get("spark.local.dir"))
    written = lambda: {p.name for p in local.rglob("shuffle_*.data")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = written(), spark.conf.get(setting)
    texts = [" ".join(f"w{k // 2}-{i}" for i in range(40 + k % 2)) for k in range(60)]
    found = operator(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    until = time.monotonic() + 20
    while len(written() - before) > 4 and time.monotonic() < until:
        time.sleep(0.2)
    assert len(written() - before) <= 4 and spark.conf.get(setting) == own
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(k, k - k % 2) for k in range(60)]
