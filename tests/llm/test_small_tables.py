"""Steps over small tables do not take a task and a file for each shuffle partition of the session."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from milldam.llm import common, components, simhash

SETTINGS = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def many(spark):
    """Many shuffle partitions, and a count of the files of written tables."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    common.durable(spark.range(1))  # the folder is there
    folder = Path(spark.sparkContext._jsc.getCheckpointDir().get().removeprefix("file:"))
    yield lambda: sum(1 for _ in folder.rglob("part-*"))
    for k, v in before.items():
        spark.conf.set(k, v)


def test_compact(spark, many, monkeypatch):
    """Few numbers are one partition, nothing is lost, and rows are counted; many rows, texts and arrays stay as they were dealt."""
    dealt = spark.range(1000).select((F.col("id") % 7).alias("u"), F.col("id").alias("v")).repartition(40, "v")
    small, rows = common.compact(dealt)
    assert rows == small.count() == 1000 and small.rdd.getNumPartitions() == 1
    assert "Exchange" not in small.groupBy("u").count()._jdf.queryExecution().executedPlan().toString()
    assert common.compact(small.where("u > 7"))[1] == common.compact(small.where("u > 7").join(dealt, "u"))[1] == 0
    for wide in (dealt.withColumn("x", F.array("u")), dealt.withColumn("x", F.col("u").cast("string"))):
        out, rows = common.compact(wide)
        assert rows == out.count() == 1000 and out.rdd.getNumPartitions() == 40
    monkeypatch.setattr(common, "LEAST_BYTES", 16 * 999)
    assert common.compact(dealt)[0].rdd.getNumPartitions() == 40


def test_rounds_over_few_edges(spark, many):
    """Only the first table of edges is written by all partitions."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)], "u long, v long")
    before = many()
    assert {(r.u, r.root) for r in components.components(edges).collect()} == {(i, 0) for i in range(501)}
    assert many() - before <= 40 + 20  # 40 for each round, without compact()


def test_near_duplicates_of_few_texts(spark, many):
    texts = [" ".join(f"w{k // 2}-{i}" for i in range(40 + k % 2)) for k in range(60)]
    before = many()
    found = simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    files = many() - before
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(k, k - k % 2) for k in range(60)]
    assert files <= 800, files
