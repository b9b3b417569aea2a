"""Work is dealt over tasks by rows: a file of one block, or one frequent name, is not left to one task."""

import time
from contextlib import contextmanager

from pyspark.sql import functions as F

from milldam.operators import analytics, learned, search
from milldam.plans import monitoring
from milldam.plans.views import raw_st, table
from milldam.sources import payloads


@contextmanager
def settings(spark, **values):
    """Settings of the planner for a while; _ stands for a dot."""
    names = {k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def largest_share(df):
    """The part of all rows that the task with most of them puts out."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_name_join_deals_a_frequent_name(spark):
    """All pairs of rows whose names are alike, repeated keys as often as they are there; no task has most of them."""
    rows = spark.range(0, 3000, 1, 1).select((F.col("id") % 2990).alias("k"), F.when(F.col("id") < 2999, "blue ring").otherwise("").alias("nombre"))
    queries = spark.range(0, 700, 1, 1).select(F.col("id").alias("qid"), F.when(F.col("id") < 699, "Blue  ring").alias("query"))
    with settings(spark, spark_sql_adaptive_coalescePartitions_enabled="false"):
        found = search.name_join(rows, queries, "k", digits=4).persist()
        assert found.count() == 2999 * 699 and found.where("similarity = 1.0").count() == 2999 * 699
        assert found.distinct().count() == 2990 * 699
        assert largest_share(found) < 0.6
        found.unpersist()


def test_stations_are_dealt_by_rows(spark, sf_dir, tmp_path):
    """A customer table of one block becomes several tasks, whatever its bytes; rows stay whole."""
    table(spark, sf_dir, "nation").write.parquet(f"{tmp_path}/nation.parquet")
    rows = spark.range(0, 20_000, 1, 1).select(F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey"))
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    made = raw_st(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() > 1 and largest_share(made) < 0.5
    assert made.select("k").distinct().count() == 20_000 == made.count()


def test_stamps_are_dealt_and_parsed_once(spark, tmp_path):
    """Events of one block become several tasks; a bad stamp voids all spans, a missing one its own."""
    rows = spark.range(0, 70_000, 1, 1).selectExpr("id as event_id", "id as user_id", "'view' as event_type", "timestamp_seconds(id) as ts", "1.0D as value", "'{}' as props")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    made = monitoring.timing_breakdown(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() > 1 and largest_share(made) < 0.6 and made.count() == 70_000
    names = list(dict.fromkeys(x for span in analytics.SPANS.values() for x in span))
    stamps = [("2024-01-01T00:00:00Z", "2024-01-01T00:00:01.5Z", "", "2024-01-01T00:00:03Z", "2024-01-01T00:00:04Z"), (None, "2024-01-01T00:00:01Z", "x", None, None)]
    df = spark.createDataFrame(stamps, ", ".join(f"{n} string" for n in names))
    got = [tuple(r[n] for n in analytics.SPANS) for r in analytics.timing(df).collect()]
    assert sorted(got, key=str) == sorted([(1500, None, 1000, 4000), (None,) * 4], key=str)
    assert df.columns == analytics.timing(df).columns[: len(df.columns)]


def test_names_are_matched_once(monkeypatch):
    """The stand-in for a model matches a list of names once, not for each record."""
    calls = []
    match = learned.best_match
    monkeypatch.setattr(learned, "best_match", lambda names: calls.append(names) or match(names))
    learned._picked.cache_clear()
    out = learned.stub_client(['{"codigo":"%d","nombre":"x"}' % i for i in range(20)])
    assert [r["raw_id"] for r in out] == [str(i) for i in range(20)] and len(calls) == 1


def test_csv_headers_and_lines_are_cut_once(spark):
    """The work for a CSV payload grows with its cells, not with lines times the square of its columns; repeated names take their first place."""
    wide, lines = 1500, 20
    text = "\n".join([",".join(f"h{i}" for i in range(wide)), *[",".join(f"{k}-{i}" for i in range(wide)) for k in range(lines)]])
    raw = spark.createDataFrame([("m", "galicia", "csv", text), ("n", "galicia", "csv", 'a,b,a\n1,"x ""y"", z"\n3,,5,6')], "message_id string, source string, format string, payload string")
    started = time.monotonic()
    found = payloads.fan_out(raw)
    got = found.where("message_id = 'm'").select("ordinal", "total", F.size("fields"), F.size("truthy"), F.col("fields")[f"h{wide - 1}"]).collect()
    assert time.monotonic() - started < 25
    assert sorted(map(tuple, got)) == [(k, lines, wide, wide, f"{k}-{wide - 1}") for k in range(lines)]
    small = found.where("message_id = 'n'").orderBy("ordinal").collect()
    assert [(r.fields, r.truthy, r.total) for r in small] == [({"a": "1", "b": 'x "y", z'}, {"a": "1", "b": 'x "y", z'}, 2), ({"a": "3", "b": ""}, {"a": "3"}, 2)]
