"""Cleaning, duplicates, mapping and the stream on small fixtures."""

import pytest
from pyspark.sql import functions as F

from milldam.functions import clean, similarity
from milldam.operators import dedup, generate, learned


def one(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_cleaning(spark):
    assert one(spark, clean.opt_string, " a ", "", "  ", None) == ["a", None, None, None]
    assert one(spark, clean.parse_float, "41,5", " -2.5 ", "n/a", "", None, "1e3") == [41.5, -2.5, None, None, None, 1000.0]
    assert one(spark, clean.clean_phone, "+34 911", "34911222333", "911-222-333", "12", "") == ["+34911", "+34911222333", "+34911222333", "12", None]
    assert one(spark, clean.clean_postal, "08001", "8001", "E-08001", None) == ["08001", None, "08001", None]
    assert one(spark, clean.collapse, " a \t b ") == ["a b"]


def test_similarity():
    assert similarity.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert similarity.jaro_winkler("a", "a") == 1.0


@pytest.mark.parametrize("way", [dedup.id_name, dedup.id_name_fold])
def test_ordered_duplicates(spark, way):
    """A refused row registers nothing; both ways decide alike."""
    rows = [(0, "A", "X"), (1, "a", "Y"), (2, "B", "Y"), (3, "C", "x"), (4, "D", "y"), (5, "E", "Z")]
    df = spark.createDataFrame([("m", i, s, n, None) for i, s, n in rows], "message_id string, ordinal int, station_id string, name string, city string")
    got = {r.ordinal: r.dup for r in way(df).collect()}
    assert [got[i] for i in range(6)] == [None, dedup.ID, None, dedup.NAME, dedup.NAME, None]


def test_generators(spark):
    assert generate.mixed_sizes(1001, 0.3) == (701, 300)
    made = generate.valid(spark, 300)
    assert made.count() == 300 and made.select("raw_id", "source").distinct().count() == 300
    assert made.exceptAll(generate.valid(spark, 300)).count() == 0
    assert {r[0] for r in generate.invalid(spark, 100).select("error_type").distinct().collect()} == set(generate.ERRORS)
    with pytest.raises(ValueError):
        generate.mixed(spark, 10, 1.5)


def test_learned_rules():
    assert learned.learn([{"nombre": "ITV", "tel": "9"}], [{"name": "ITV", "phone": "9", "city": None}]) == {"nombre": "name", "tel": "phone", "city": "city"}
    assert learned.learn([], []) == {}
    with pytest.raises(learned.ModelError) as e:
        learned.stub_client(["[1]"])
    assert e.value.reason == "llm_invalid_json"


def test_stream_reads_a_folder_and_a_file(spark, sf_dir, tmp_path):
    from milldam.plans.ingestion import stream_vs_batch

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(2).write.parquet(f"{tmp_path}/events.parquet")
    file, folder = (sorted(map(tuple, stream_vs_batch(spark, d).collect())) for d in (sf_dir, str(tmp_path)))
    assert len(file) == 3 and folder == file
