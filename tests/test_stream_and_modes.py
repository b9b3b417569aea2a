"""The stream under failures, the keyed table, the way by model, and operators that no query runs."""

import base64
import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from milldam.config import EngineConfig
from milldam.functions import clean
from milldam.operators import analytics, checks, dedup, fuzzy, generate, learned, mapping, ranks, routing, search, store
from milldam.sources import payloads
from milldam.streaming import pipeline

QUICK = EngineConfig(sink_base_ms=1)
STEPS = ("route", "normalized", "rejected", "dead_letter", "audit", "stations")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Two files, so two batches: valid stations of three sources, and messages without stations or source."""
    folder = str(tmp_path_factory.mktemp("raw"))
    for i in range(2):
        made = generate.payloads(generate.valid(spark, 30, seed=i)).withColumn("message_id", F.concat_ws("-", F.lit(i), "message_id"))
        odd = spark.createDataFrame([(f"{i}-none", "valencia", "json", "[]"), (f"{i}-lost", "", "json", "{}")], "message_id string, source string, format string, payload string")
        made.unionByName(odd).coalesce(1).write.mode("append").json(folder)
    return folder


def ran(spark, raw, tmp_path, fail=None):
    config = EngineConfig(sink_base_ms=1, files_per_trigger=1)
    run = pipeline.start(pipeline.read_messages(spark, raw, config), f"{tmp_path}/out", f"{tmp_path}/state", config, fail, availableNow=True)
    run.awaitTermination()
    read = lambda name: spark.read.schema("message_id string, batch int").json(f"{tmp_path}/out/{name}")
    table = store.KeyedTable(spark, f"{tmp_path}/out/stations").read()
    stored = sorted((r.fuente_origen, r.id_en_fuente) for r in table.collect()) if table is not None else []
    return {n: sorted(r.message_id for r in read(n).collect()) if (tmp_path / "out" / n).exists() else [] for n in STEPS[1:5]}, stored


@pytest.fixture(scope="module")
def calm(spark, raw, tmp_path_factory):
    return ran(spark, raw, tmp_path_factory.mktemp("calm"))


def test_stream(calm):
    out, stored = calm
    assert out["rejected"] == ["0-none", "1-none"] and out["dead_letter"] == ["0-lost", "1-lost"]
    assert len(out["normalized"]) == 60 and set(out["audit"]) == set(out["normalized"]) and len(stored) == 30


@pytest.mark.parametrize("step", ["normalized", "stations"])
def test_a_failed_attempt_changes_nothing(spark, raw, calm, tmp_path, step):
    failed = set()

    def fail(at, batch):
        if at == step and batch not in failed:
            failed.add(batch)
            raise OSError("once")

    assert ran(spark, raw, tmp_path, fail) == calm and failed == {0, 1}


@pytest.mark.parametrize("step", ["stations"])
def test_a_batch_that_keeps_failing_is_taken_back(spark, raw, calm, tmp_path, step):
    def fail(at, batch):
        if at == step and batch == 1:
            raise OSError("always")

    out, stored = ran(spark, raw, tmp_path, fail)
    ids = lambda names: {m for n in names for m in out[n]}
    dead = set(out["dead_letter"])
    assert len({m[0] for m in ids(["normalized", "rejected"])}) == 1 and not ids(["normalized", "rejected"]) & dead
    every = {m for n in ("normalized", "rejected", "dead_letter") for m in calm[0][n]}
    assert ids(["normalized", "rejected", "dead_letter"]) == every and len(stored) == 30


def test_table_outlives_a_failed_write(spark, tmp_path):
    table = store.FileTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.current() == -1
    one, two = spark.range(4), spark.range(7)
    assert table.write(one, 0) and not table.write(two, 0) and table.read().count() == 4
    boom = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error("disk full").cast("long")).alias("id"))
    with pytest.raises(Exception, match="disk full"):
        table.write(boom, 1)
    assert table.current() == 0 and table.read().count() == 4
    assert table.write(two, 1) and table.current() == 1 and table.read().count() == 7
    assert table.write(one, 2) and table.read().count() == 4 and not (tmp_path / "t" / "b0").exists()


def test_long_chain_in_one_message(spark):
    """5,000 rows, each in conflict with the one before: the fold in plain Python."""
    rng = random.Random(4)
    rows, ids, names, want = [], set(), set(), []
    for i in range(5000):
        station, name = (f"S{i // 2}", f"N{(i + 1) // 2}") if i < 4000 else (f"S{rng.randrange(3000)}", f"N{rng.randrange(3000)}")
        rows.append(("m", i, station, name, None))
        why = dedup.ID if station in ids else dedup.NAME if name in names else None
        want.append(why)
        if why is None:
            ids.add(station)
            names.add(name)
    df = spark.createDataFrame(rows, "message_id string, ordinal int, station_id string, name string, city string").repartition(5)
    assert [r.dup for r in dedup.id_name(df).orderBy("ordinal").collect()] == want


# ---- by model and by names -------------------------------------------------------------------------------------------


def valencia(spark, *stations, message="m"):
    payload = json.dumps({"estaciones": list(stations)})
    return payloads.fan_out(spark.createDataFrame([(message, "valencia", "json", payload)], "message_id string, source string, format string, payload string"))


def station(i, **more):
    return {"codigo": f"{i}", "nombre": f"ITV {i}", "direccion": "Calle 1", "poblacion": "Valencia", "provincia": "Valencia", "codigo_postal": "46001", "telefono": f"96123456{i}"} | more


def test_way_by_model(spark):
    calls = []
    fanned = valencia(spark, station(1), station(2, codigo=""), station(3, nombre=None), station(4, nombre="x" * 300))
    out = learned.transformed(fanned)
    assert [r.reason for r in out["rows"].orderBy("ordinal").collect()] == [None, "missing_raw_id", "missing_name", "llm_pydantic_validation_error"]
    rule = out["rules"].first()
    assert (rule.source_system, rule.province_type, rule.is_active) == ("valencia", "valencia", True) and rule.field_mapping["codigo"] == "raw_id"
    assert out["metrics"].first().asDict() == {"llm_rule_cache_hit": 0, "llm_rule_cache_miss": 1, "llm_rule_generation_calls": 1, "llm_pydantic_validation_errors": 1, "llm_last_error_reason": None}
    rules = spark.createDataFrame(out["rules"].collect(), out["rules"].schema)

    def never(records):
        raise AssertionError(calls)

    again = learned.transformed(fanned, rules, client=never)
    assert [r.reason for r in again["rows"].orderBy("ordinal").collect()][0] is None and again["metrics"].first().llm_rule_cache_hit == 1


def test_model_errors(spark):
    fanned = valencia(spark, *[station(i) for i in range(7)])

    def short(records):
        return [] if len(records) == 1 and '"3"' in records[0] else learned.stub_client(records)[: 1 if len(records) == 1 else -1]

    def slow(records):
        raise learned.ModelError("llm_timeout")

    def broken(records):
        raise ZeroDivisionError

    errors = lambda client: [r.model_error for r in learned.call_model(fanned, client).orderBy("ordinal").collect()]
    assert errors(short) == [None] * 3 + ["llm_transform_failed"] + [None] * 3
    assert set(errors(slow)) == {"llm_timeout"} and set(errors(broken)) == {"llm_unexpected_error"}
    paused = learned.call_model(fanned, pause=lambda s: None, config=EngineConfig(model_callers=2))
    assert paused.count() == 7 and paused.rdd.getNumPartitions() == 2


def test_strict_answers(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(['[{"a":1}]', "[]", ' [{"a":1},2]', '{"a":1}', "text", None, '[{"a":1}] more'])], "i int, x string")
    assert [r.y for r in rows.select("i", learned.strict_array(F.col("x")).alias("y")).orderBy("i").collect()] == [True, True, False, False, False, False, False]


def test_doubtful_fields_are_reported(spark):
    record = {k if k != "telefono" else "phones": v for k, v in station(1).items()} | {"latitud": "39.4", "longitud": "-0.3"}
    messages = spark.createDataFrame([("m", "valencia", "json", json.dumps([record]))], "message_id string, source string, format string, payload string")
    out = routing.run(messages, EngineConfig(mode="FUZZY", fuzzy_high=0.99))
    assert out["accepted"].count() == 1 and [r.reason for r in out["rejected"].collect()] == ["fuzzy_low_confidence"]
    rows = routing.normalise(messages, config=EngineConfig(mode="FUZZY", fuzzy_high=0.99))
    found = fuzzy.metrics(rows).first()
    assert found.low_confidence_count == 1 and 0.9 < found.confidence_mean <= 1 and found.rejected_by_fuzzy_count == 0


# ---- sources ---------------------------------------------------------------------------------------------------------


def test_files_and_queue(spark, tmp_path):
    for name, text in {"a": '{"a":1}', "b": "{", "c": ""}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "d").write_bytes(b"\xff\xfe")
    found = {r.path[-1]: r.refused for r in payloads.scan_files(spark, str(tmp_path), "application/json; charset=utf-8").collect()}
    assert found == {"a": None, "b": "malformed_file", "d": "not_utf8"}
    assert {r.refused for r in payloads.scan_files(spark, str(tmp_path), "image/png").collect()} == {"unsupported_media_type"}
    assert "file_too_large" in {r.refused for r in payloads.scan_files(spark, str(tmp_path), "text/csv", EngineConfig(max_file_bytes=1)).collect()}
    raw = spark.createDataFrame([('{"message_id":"1","source":"galicia","payload":"x"}',), ("[1]",), ("no",)], "value string")
    good, dead = payloads.decode_queue(raw)
    assert [tuple(r) for r in good.collect()] == [("1", "galicia", "json", "x")] and dead.count() == 2
    assert payloads.drained(raw, 2).count() == 2 and raw.count() == 3
    with pytest.raises(ValueError):
        payloads.drained(raw, 0)
    sent = json.dumps({"header": {"message_id": "7", "source": " Galicia", "format": "CSV"}, "payload": {"raw_content": base64.b64encode("a,ñ".encode()).decode()}})
    assert tuple(payloads.decode_envelopes(spark.createDataFrame([(sent,)], "value string")).first()) == ("7", "galicia", "csv", "a,ñ")
    marked = payloads.injected(raw, "mixed", seed=3, rate=0.5).first().injection
    assert marked.type == "mixed" and marked.metadata == {"seed": "3", "rate": "0.5"}


def fanned(spark, source, form, payload, strict=True):
    df = spark.createDataFrame([("m", source, form, payload)], "message_id string, source string, format string, payload string")
    return payloads.fan_out(df, strict)


def test_fan_out_forms(spark):
    rows = fanned(spark, "valencia", "json", '{"stations":[{"id":"1"}]}').collect()
    assert [r.ordinal for r in rows] == [None]  # another source's wrapper
    rows = fanned(spark, "valencia", "json", '{"stations":[{"id":"1"}, 5, "{}"]}', strict=False).orderBy("ordinal").collect()
    assert [(r.ordinal, r.is_object) for r in rows] == [(0, True), (1, False), (2, False)]
    checked = checks.checked(mapping.cleaned(mapping.mapped(fanned(spark, "valencia", "json", "[5]", strict=False))))
    assert checked.first().reason == "invalid_station_payload_type"
    record = fanned(spark, "galicia", "json", '[{"id":0,"nome":"a","cp":false,"lat":10.0,"tags":[],"more":{"x":[1]}}]').first()
    assert record.fields == {"id": "0", "nome": "a", "cp": "False", "lat": "10.0", "tags": "[]", "more": '{"x":[1]}'} and sorted(record.truthy) == ["lat", "more", "nome"]
    csv = fanned(spark, "galicia", "csv", 'id,nome\r\n1,"a, ""b""\nc"\r\n\r\n2,d').orderBy("ordinal").collect()
    assert [r.fields for r in csv] == [{"id": "1", "nome": 'a, "b"\nc'}, {"id": "2", "nome": "d"}]
    xml = payloads.lineage(fanned(spark, "catalunya", "xml", '<?xml version="1.0"?><estacions any="2024"><station><id>1</id><nom>a &amp; b</nom></station></estacions>'))
    assert xml.first().payload == '<estacions any="2024"><station><id>1</id><nom>a &amp; b</nom></station></estacions>'
    assert fanned(spark, "valencia", "json", '[{"codigo":"1"}').first().ordinal is None


# ---- the sink and the log ---------------------------------------------------------------------------------------------


def test_sink(spark):
    good = {"station_id": "VAL_1", "name": "ITV", "latitude": 39.4, "longitude": -0.3}
    raw = spark.createDataFrame([(json.dumps(x),) for x in (good, good | {"latitude": 80.0}, good | {"name": ""}, {"name": "x"}, [1])], "value string")
    fits, dead = store.revalidated(raw, "station_id string, name string, latitude double, longitude double")
    assert fits.count() == 1 and dead.count() == 4
    now = F.lit("2024-05-01 10:00:00").cast("timestamp")
    batch = spark.createDataFrame([(None, "valencia", "7", "VAL_7")], "message_id string, source_system string, raw_id string, station_id string")
    failed = store.audit_failure(batch, 3, "persist", "e" * 900, now).first()
    assert failed.status == "failed" and len(failed.error_message) == 500 and failed.metadata.error_in_step == "persist" and failed.message_id == "fallback-valencia-7-20240501100000000"
    table = spark.createDataFrame([("valencia", "VAL_1", None), ("valencia", "VAL_2", 5), ("galicia", "GAL_1", None)], "fuente_origen string, id_en_fuente string, id long")
    assert sorted(r.id for r in store.with_ids(table).collect()) == [5, 6, 7]
    assert store.without(table, "valencia", "VAL_1").count() == 2 and store.emptied(table).count() == 0
    assert store.evolved(table, spark.createDataFrame([("x",)], "fuente_origen string")).where("id is null").count() == 3


def test_texts_and_places(spark):
    one = lambda f, x, kind="string": spark.createDataFrame([(x,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y
    assert one(clean.minify, '{ "a" : [1, 2] }') == '{"a":[1,2]}' and one(clean.minify, "<a>\n <b>x  y</b> </a>") == "<a><b>x y</b></a>"
    kinds = {None: "none", "null": "none", "{}": "dict", "[1]": "list", "true": "bool", "3": "int", "3.5": "float", '"a"': "str", "a b": "str"}
    assert {x: one(clean.payload_kind, x) for x in kinds} == kinds
    import struct

    df = spark.createDataFrame([(39.4, -0.375), (0.0, 4.25), (None, 1.0)], "lat double, lon double")
    want = [struct.pack("<BII2d", 1, 0x20000001, 4326, lon, lat) if lat is not None else None for lat, lon in ((39.4, -0.375), (0.0, 4.25), (None, 1.0))]
    assert [r.w and bytes(r.w) for r in df.select(clean.wkb_point(F.col("lat"), F.col("lon")).alias("w")).collect()] == want
    assert generate.payloads(generate.valid(spark, 5)).count() > 0 and mapping.supported("galicia", "csv") and not mapping.supported("galicia", "xml")


def test_percentiles_and_ranks(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.randrange(50), rng.randrange(100000)]) for _ in range(997)]
    df = spark.createDataFrame([("a" if v % 3 else "b", v) for v in values], "g string, v long").repartition(3)
    s = sorted(values)
    at = lambda p: s[int((len(s) - 1) * p)] + (s[min(int((len(s) - 1) * p) + 1, len(s) - 1)] - s[int((len(s) - 1) * p)]) * ((len(s) - 1) * p % 1)
    assert list(analytics.percentiles(df, "v", 0.5, 0.95, 1.0).first()) == pytest.approx([at(0.5), at(0.95), s[-1]])
    got = {r.g: r.x for r in analytics.nearest_rank_rows(df, ["g"], "v", 0.95, "x").collect()}
    assert got == {g: (t := sorted(v for v in values if ("a" if v % 3 else "b") == g))[int(len(t) * 0.95)] for g in "ab"}
    assert list(analytics.percentiles(df.limit(0), "v", 0.5).first()) == [0.0]
    placed = ranks.numbered_by(df, "v", ("g",)).collect()
    for g in "ab":
        mine = sorted((r._place, r.v) for r in placed if r.g == g)
        assert [p for p, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)


def test_name_join_is_all_pairs(spark):
    rng = random.Random(9)
    names = [" ".join(rng.choice("alpha beta gamma delta epsilon station itv north".split()) for _ in range(rng.randrange(1, 4))) for _ in range(80)] + ["", None, "x"]
    df = spark.createDataFrame(list(enumerate(names)), "k int, nombre string")
    queries = df.where("k % 7 = 0").select(F.col("k").alias("qid"), F.col("nombre").alias("query"))

    def grams(text):
        return {f"  {w} "[i : i + 3] for w in (text or "").split() for i in range(len(w) + 1)}

    for least in (0.3, 0.6, 1.0):
        want = {(q, k) for q, a in enumerate(names) if q % 7 == 0 for k, b in enumerate(names) if grams(a) and grams(b) and len(grams(a) & grams(b)) >= least * len(grams(a) | grams(b)) - 1e-12}
        assert {(r.qid, r.k) for r in search.name_join(df, queries, "k", least=least).collect()} == want


# ---- rules, redelivery, provenance, folders ---------------------------------------------------------------------------


def test_rules_come_from_all_records(spark):
    """The first record has blanks; the rule is none the poorer, and the next batch is mapped by it."""
    first = valencia(spark, station(1, nombre="", telefono=None), station(2, telefono=None), station(3))
    out = learned.transformed(first)
    rule = out["rules"].first().field_mapping
    assert rule["nombre"] == "name" and rule["codigo"] == "raw_id" and rule["telefono"] == "phone" and "name" not in rule
    rules = spark.createDataFrame(out["rules"].collect(), out["rules"].schema)

    def never(records):
        raise AssertionError(records)

    again = learned.transformed(valencia(spark, *[station(i) for i in range(4, 8)], message="n"), rules, client=never)
    assert [r.reason for r in again["rows"].collect()] == [None] * 4
    blank = learned.transformed(valencia(spark, station(1, nombre=""), station(2, nombre=" ")))
    assert blank["rules"].count() == 0  # no record shows where the name stands: the model is asked again


def test_a_message_without_stations_costs_no_other(spark):
    rows = spark.createDataFrame([("none", "valencia", "json", "[]"), ("m", "valencia", "json", json.dumps({"estaciones": [station(i) for i in range(3)]}))], "message_id string, source string, format string, payload string")
    seen = []

    def client(records):
        assert all(isinstance(x, str) for x in records), seen
        if any('"codigo": "1"' in x or '"codigo":"1"' in x for x in records):
            raise ValueError("bad record")
        return learned.stub_client(records)

    got = learned.call_model(payloads.fan_out(rows).coalesce(1), client).where("ordinal is not null").orderBy("ordinal").collect()
    assert [r.model_error for r in got] == [None, "llm_unexpected_error", None] and all(r.llm_inference_ms >= 0 for r in got)


def test_slow_model(spark):
    def slow(records):
        import time

        time.sleep(3)

    got = learned.call_model(valencia(spark, station(1)), slow, EngineConfig(model_provider="openai", model_timeout_s=1)).first()
    assert got.model_error == "llm_timeout"


def write_messages(spark, folder, name, *rows):
    text = [json.dumps(r) for r in rows]
    (folder / name).write_text("\n".join(text))


def raw_message(i, *stations, **more):
    return {"message_id": i, "source": "valencia", "format": "json", "payload": json.dumps({"estaciones": list(stations)})} | more


def test_stream_keeps_rules_and_drops_what_comes_again(spark, tmp_path):
    """Three batches: the model is asked once for a kind of province; a message that comes again is left out."""
    folder, asked = tmp_path / "in", tmp_path / "asked"
    folder.mkdir()
    asked.mkdir()
    marked = {"injection": {"type": "mixed", "metadata": {"seed": "3"}}, "gateway_ingested_at": "2024-05-01T10:00:00.000Z", "parent_message_id": "p", "station_sequence": 4, "total_stations": 9}
    write_messages(spark, folder, "a.json", raw_message("m1", station(1), **marked))
    write_messages(spark, folder, "b.json", raw_message("m2", station(2)), raw_message("m1", station(1)))
    write_messages(spark, folder, "c.json", raw_message("m3", station(3)), raw_message(None, station(4)), raw_message(None, station(5)))
    import os

    for k, name in enumerate("abc"):
        os.utime(folder / f"{name}.json", (1e9 + k, 1e9 + k))
    place = str(asked)

    def client(records):
        import pathlib

        pathlib.Path(place, "once").touch(exist_ok=False)  # a second call fails
        return learned.stub_client(records)

    config = EngineConfig(mode="LLM", sink_base_ms=1, files_per_trigger=1, table_folders=16)
    pipeline.start(pipeline.read_messages(spark, str(folder), config), f"{tmp_path}/out", f"{tmp_path}/state", config, client=client, availableNow=True).awaitTermination()
    stored = store.KeyedTable(spark, f"{tmp_path}/out/stations", folders=16).read()
    assert sorted(r.id_en_fuente for r in stored.collect()) == [f"VAL_{i}" for i in range(1, 6)]
    log = spark.read.json(f"{tmp_path}/out/audit").collect()
    assert sorted(r.message_id for r in log if r.message_id in ("m1", "m2", "m3")) == ["m1", "m2", "m3"] and len(log) == 5
    one = next(r for r in log if r.message_id == "m1").metadata
    assert one.injection.type == "mixed" and one.injection.metadata.seed == "3" and one.model.llm_inference_ms >= 0
    context = one.timing_context
    assert (context.parent_message_id, context.station_sequence, context.total_stations) == ("p", 4, 9) and context.gateway_ingested_at.startswith("2024-05-01") and context.normalizer_started_at <= context.normalizer_completed_at
    assert store.FileTable(spark, f"{tmp_path}/out/rules").read().where("is_active").count() == 1


def test_upsert_touches_its_own_folders(spark, tmp_path):
    table = store.KeyedTable(spark, str(tmp_path / "t"), folders=32)
    rows = lambda *ks, city="a": spark.createDataFrame([("v", f"S{k}", f"n{k}{city}", "46001", k) for k in ks], "fuente_origen string, id_en_fuente string, nombre string, codigo_postal string, o int")
    now = F.lit("2024-05-01 10:00:00").cast("timestamp")
    assert table.read() is None and table.upsert(rows(*range(500)), "o", now, 0) and not table.upsert(rows(1), "o", now, 0)
    before = set(table.read().inputFiles())
    assert len(before) == 32
    later = rows(*range(495, 505), city="b")
    own = {r[0] for r in later.select(table.folder()).distinct().collect()}
    assert table.upsert(later, "o", F.lit("2024-05-02 10:00:00").cast("timestamp"), 1)
    after = set(table.read().inputFiles())
    written = {int(f.split("of32=")[1].split("/")[0]) for f in after - before}
    assert written == own and len(own) < 32 and {int(f.split("of32=")[1].split("/")[0]) for f in table.read(sorted(own)).inputFiles()} == own
    got = {r.id_en_fuente: r for r in table.read().collect()}
    assert len(got) == 505 and got["S499"].nombre == "n499b" and got["S1"].nombre == "n1a"
    assert got["S499"].fecha_creacion < got["S499"].fecha_actualizacion and got["S1"].fecha_creacion == got["S1"].fecha_actualizacion
    found = table.lookup(fuente_origen="v", id_en_fuente="S499")
    assert found.count() == 1 and len(found.inputFiles()) == 1 and table.lookup(fuente_origen="v", id_en_fuente="none").count() == 0
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "EqualTo(id_en_fuente,S499)" in plan.split("PushedFilters")[1]
    boom = rows(1, 2).withColumn("nombre", F.raise_error("disk full").cast("string"))
    with pytest.raises(Exception, match="disk full"):
        table.upsert(boom, "o", now, 2)
    assert table.current() == 1 and table.read().count() == 505
    for batch in (3, 4, 5):
        table.upsert(rows(1, 2, city=str(batch)), "o", now, batch)
    assert table.read().count() == 505 and {r.nombre for r in table.read().where("id_en_fuente in ('S1', 'S2')").collect()} == {"n15", "n25"}
    kept = [p for p in (tmp_path / "t").glob("batch=*/of32=*") if any(p.glob("*.parquet"))]
    assert len(kept) <= 2 * 32


def test_revisions_up_and_down(spark):
    steps = [store.adds("estado", "string", "activa"), store.renames("nombre", "nombre_itv"), store.retypes("id", "int", "bigint")]
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, nombre string")
    top = store.revised(rows, steps, 0, 3)
    assert top.dtypes == [("id", "bigint"), ("nombre_itv", "string"), ("estado", "string")] and {r.estado for r in top.collect()} == {"activa"}
    back = store.revised(top, steps, 3, 0)
    assert back.dtypes == rows.dtypes and sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)
    assert store.revised(top, steps, 3, 1).columns == ["id", "nombre", "estado"]
    with pytest.raises(ValueError):
        store.revised(rows, steps, 0, 4)


def test_xml_with_any_tags(spark):
    record = "<codigo>7</codigo><nam>ITV</nam><direccion>Calle 1</direccion><cityname>Valencia</cityname><provincia>Valencia</provincia><zip>46001</zip><tel>961234567</tel>"
    messages = spark.createDataFrame([("m", "catalunya", "xml", f'<?xml version="1.0"?>\n<feed v="2">\n <station>\n{record}\n</station><station k="1"/><station>{record.replace("7", "8", 1)}</station></feed>'.replace("><dir", ">\n  <dir"))], "message_id string, source string, format string, payload string")
    rows = routing.normalise(messages, config=EngineConfig(mode="FUZZY")).orderBy("ordinal").collect()
    assert [(r.raw_id, r.name, r.city, r.phone, r.reason) for r in rows] == [("7", "ITV", "VALENCIA", "+34961234567", None), (None, None, None, None, "fuzzy_mapping_failure"), ("8", "ITV", "VALENCIA", "+34961234567", None)]
    single = spark.createDataFrame([("m", "catalunya", "xml", f"<estacion>{record}</estacion>"), ("n", "galicia", "json", "id,nome\n1,x"), ("o", "galicia", "csv", '[{"id":"1","nome":"x"}]'), ("p", "galicia", "xml", "<a/>")], messages.schema)
    loose = {r.message_id: r for r in routing.normalise(single, strict=False, config=EngineConfig(mode="FUZZY")).collect()}
    assert (loose["m"].raw_id, loose["n"].name, loose["o"].raw_id, loose["p"].reason) == ("7", "x", "1", "invalid_station_payload_type")
    assert {r.ordinal for r in routing.normalise(single, config=EngineConfig(mode="FUZZY")).collect() if r.message_id != "o"} == {None}
    nested = fanned(spark, "catalunya", "xml", "<r><station><id>01</id><geo><lat>1</lat><lon>2</lon></geo><t>1</t><t>2</t></station></r>").first()
    assert nested.fields == {"id": "01", "geo": "<lat>1</lat><lon>2</lon>", "t": "2"}
    assert [r.ordinal for r in fanned(spark, "catalunya", "xml", "<r><station><id>1</id></r>").collect()] == [None]


def test_files_by_ending(spark, tmp_path):
    for name, text in {"a.json": '{"a":1}', "b.xml": "<a/>", "c.csv": "a\nb", "d.png": "x", "e.json": "{" + " " * 50}.items():
        (tmp_path / name).write_text(text)
    found = {r.path.rsplit("/", 1)[1]: (r.refused, r.payload) for r in payloads.scan_files(spark, str(tmp_path), config=EngineConfig(max_file_bytes=20)).collect()}
    assert {k: v[0] for k, v in found.items()} == {"a.json": None, "b.xml": None, "c.csv": None, "d.png": "unsupported_media_type", "e.json": "file_too_large"} and found["e.json"][1] is None


def test_counters_without_a_pass(spark, tmp_path):
    """The figures of counters() come with the first output that is written."""
    rows = [("a", "valencia", "json", json.dumps({"estaciones": [station(1), station(1), station(2, codigo="")]})), ("b", "valencia", "json", "[]")]
    messages = spark.createDataFrame(rows, "message_id string, source string, format string, payload string")
    found, seen = routing.normalise(messages).persist(), Observation()
    out = routing.outputs(found, messages, seen=seen)
    out["accepted"].write.json(f"{tmp_path}/a")
    assert seen.get == routing.counters(routing.deduplicated(found)).first().asDict() == {"processed": 1, "stations_rejected": 2, "messages_rejected": 1}


def test_ellipsoid(spark):
    """Published lines: Flinders Peak to Buninyong, and a degree along the equator and along a meridian from it."""
    from milldam.functions.similarity import vincenty_m

    deg = lambda d, m, s: d + m / 60 + s / 3600
    lines = [(-deg(37, 39, 10.1561), deg(143, 55, 35.3839), -deg(37, 57, 3.7203), deg(144, 25, 29.5244), 54972.271), (0.0, 1.0, 0.0, 0.0, 111319.491), (1.0, 0.0, 0.0, 0.0, 110574.389), (0.0, 0.0, 0.0, 0.0, 0.0)]
    for lat, lon, lat0, lon0, want in lines:
        df = spark.createDataFrame([(lat, lon)], "latitud double, longitud double")
        assert abs(df.select(vincenty_m(F.col("latitud"), F.col("longitud"), lat0, lon0).alias("m")).first().m - want) < 0.01
    east = spark.createDataFrame([(0.0, 1.0)], "latitud double, longitud double")
    assert search.within(east, 0.0, 0.0, 111_250).count() == 1 and search.within(east, 0.0, 0.0, 111_250, ellipsoid=True).count() == 0


def test_ranks_of_one_common_value(spark):
    """One value in nine tenths of the rows is split over ranges, and all places are right."""
    rng = random.Random(1)
    rows = [("ab"[rng.random() < 0.3], 7 if rng.random() < 0.9 else rng.randrange(100), i) for i in range(3000)] + [(None, 5, 9000), (None, 3, 9001)]
    df = spark.createDataFrame(rows, "g string, v long, i long").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranks.ranged(df.withColumn("t", F.xxhash64("i")), "v", "t").groupBy("_range").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1200
        placed = ranks.numbered_by(df, "v", ("g",)).collect()
        counts = ranks.running_counts(df, ["g"], "v").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in ("a", "b", None):
        values = sorted(v for x, v, _ in rows if x == g)
        mine = sorted((r._place, r.v) for r in placed if r.g == g)
        assert mine == list(enumerate(values))
        assert sorted((r.v, r._upto) for r in counts if r.g == g) == sorted({v: k + 1 for k, v in enumerate(values)}.items())


def test_overlay_and_log_metadata(spark):
    rows = spark.createDataFrame([("VAL_1", "a", "valencia", "Calle", "X", "P", "7", {"city": "Y", "more": "z"}), ("VAL_2", "b", "valencia", None, None, None, "8", None)], "station_id string, name string, source_system string, address string, city string, province string, raw_id string, extra map<string,string>")
    got = [json.loads(r.o) for r in rows.select(mapping.overflow(rows, F.col("extra")).alias("o")).collect()]
    assert (got[0]["city"], got[0]["more"], got[0]["province"], got[0]["normalized_snapshot"]["city"]) == ("Y", "z", "P", "X")
    assert "city" not in got[1] and got[1]["raw_id"] == "8" and got[1] == json.loads(rows.select(mapping.overflow(rows).alias("o")).collect()[1].o)
    assert rows.select(mapping.unmapped(rows).alias("u")).first().u.asDict() == {"city": "X", "province": "P", "raw_id": "7"}
    log = store.audit_success(rows.withColumn("message_id", F.col("raw_id")), 3, F.lit("2024-05-01").cast("timestamp"))
    rejected = spark.createDataFrame([("7", "a"), ("7", "a"), ("7", "b")], "message_id string, reason string")
    full = store.with_rejections(store.with_injection_type(store.with_timing(log, total_ms=F.lit(12)), F.lit("mixed")), rejected)
    one = {r.message_id: r.metadata for r in full.collect()}
    assert one["7"].rejection_summary == {"a": 2, "b": 1} and one["8"].rejection_summary == {} and one["7"].batch == 3 and one["7"].timing.total_ms == 12 and one["8"].injection_type == "mixed"
