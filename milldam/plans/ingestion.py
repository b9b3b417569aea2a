"""Ingestion: fan-out, mapping by rules, names and learned rules, generators, and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milldam.config import EngineConfig
from milldam.dims import ALIASES, CANONICAL, REGISTRY
from milldam.durable import shared_folder
from milldam.functions.similarity import field_name
from milldam.operators import analytics, fuzzy, generate, learned, routing, store
from milldam.plans.registry import Registry
from milldam.plans.views import CONTACT_CTE, DEDUP_CTE, messages, raw_st, stations_sql, table
from milldam.sources import payloads

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

_NUMBERED = "numbered AS (SELECT *, source || '-' || CAST(message_id AS VARCHAR) AS mid, ROW_NUMBER() OVER (PARTITION BY source, message_id ORDER BY ordinal) AS seq, COUNT(*) OVER (PARTITION BY source, message_id) AS total FROM reasoned)"


def _mapped(source: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = routing.normalise(messages(spark, sf_dir).where(F.col("source") == source))
        return rows.select(F.col("message_id").alias("mid"), (F.col("ordinal") + 1).alias("seq"), "station_id", "name", "city", "province", "postal_code", "latitude", "longitude", "phone", "email", "reason")

    return run


for _source in REGISTRY:
    QUERIES[f"rules_map_{_source}"] = _mapped(_source)
    ORACLE_SQL[f"rules_map_{_source}"] = stations_sql(f"SELECT mid, seq, station_id, name, city, province, postal_code, latitude, longitude, phone, email, reason FROM numbered WHERE source = '{_source}'", _NUMBERED)


@query(stations_sql("SELECT source, COUNT(*) FILTER (reason IS NULL) AS valid, COUNT(*) FILTER (reason IS NOT NULL) AS rejected, COUNT(*) AS total, ROUND(COUNT(*) FILTER (reason IS NULL) * 100.0 / COUNT(*), 2) AS pass_rate, CASE WHEN COUNT(*) FILTER (reason IS NULL) * 100.0 / COUNT(*) >= 20 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM reasoned GROUP BY source"))
def quality_summary(spark, sf_dir):
    """End to end: raw XML, JSON and CSV payloads are fanned out, parsed, mapped, cleaned and checked."""
    return analytics.quality_summary(routing.normalise(messages(spark, sf_dir)))


@query(stations_sql("SELECT mid AS parent_message_id, seq AS station_sequence, total AS total_stations, source FROM numbered", _NUMBERED))
def fanout_lineage(spark, sf_dir):
    return payloads.lineage(payloads.fan_out(messages(spark, sf_dir))).select("parent_message_id", "station_sequence", "total_stations", "source")


@query(stations_sql("SELECT mid AS parent_message_id, seq AS station_sequence, station_id FROM numbered", _NUMBERED))
def fanout_rewrapped(spark, sf_dir):
    """Each station in a message of its own, parsed again."""
    singles = payloads.lineage(payloads.fan_out(messages(spark, sf_dir)))
    again = routing.normalise(singles)
    return again.select("parent_message_id", "station_sequence", "station_id")


_PAYLOADS = {
    0: '[{{"id":"{k}","nom":"x"}}, 3, "s", null, {{"id":"y"}}]',
    1: '{{"stations":[{{"codigo":"{k}"}}]}}',
    2: '{{"codigo":"{k}","nombre":"x"}}',
    3: '{{"estaciones":[{{"codigo":"{k}"}}, [1], {{}}]}}',
    4: "not json {k}",
    5: '{{"other":1}}',
}


@query("SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END AS stations FROM orders")
def fanout_json_filter(spark, sf_dir):
    """Objects only, the source's own wrapper only, single stations by their fields; nothing else."""
    text = F.lit("")
    for i, pattern in _PAYLOADS.items():
        before, after = pattern.replace("{{", "\x01").replace("}}", "\x02").split("{k}") if "{k}" in pattern else (pattern.replace("{{", "\x01").replace("}}", "\x02"), None)
        shape = lambda s: F.lit(s.replace("\x01", "{").replace("\x02", "}"))
        text = F.when(F.col("k") % 6 == i, F.concat(shape(before), F.col("k").cast("string"), shape(after)) if after is not None else shape(before)).otherwise(text)
    raw = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).select("k", F.col("k").alias("message_id"), F.lit("valencia").alias("source"), F.lit("json").alias("format"), text.alias("payload"))
    return payloads.fan_out(raw).groupBy("k").agg(F.count("ordinal").cast("int").alias("stations"))


@query("SELECT l_orderkey AS message_id, COUNT(*) AS stations FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1")
def message_cardinality(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("message_id"), F.col("l_linenumber").alias("ordinal"))
    return routing.cardinality_violations(lines)


@query("SELECT CASE k % 5 WHEN 0 THEN 'source_missing' WHEN 1 THEN 'payload_missing' WHEN 2 THEN 'source_unknown' WHEN 3 THEN 'format_unknown' END AS dead, COUNT(*) AS n FROM (SELECT o_orderkey AS k FROM orders) GROUP BY 1")
def message_check(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    raw = table(spark, sf_dir, "orders").select(
        F.when(k == 0, "").when(k == 2, "aragon").otherwise("galicia").alias("source"), F.when(k == 3, "yaml").otherwise("csv").alias("format"), F.when(k == 1, F.lit(None)).otherwise("x").alias("payload")
    )
    return payloads.check_messages(raw).groupBy("dead").agg(F.count("*").alias("n"))


# ---- names -----------------------------------------------------------------------------------------------------------

# Field names that a feed might use.
NAMES = ("telefon", "telefono_movil", "nombre_estacion", "Código Postal", "lat", "longitude_deg", "ciudad", "provincia", "e-mail", "identificador", "direccio", "cityish")
_CANON = "(VALUES " + ", ".join(f"('{n}', '{field_name(n)}')" for n in NAMES) + ") n(name, plain), (VALUES " + ", ".join(f"('{t}')" for t in CANONICAL) + ") t(target)"
_ALIAS = "(VALUES " + ", ".join(f"('{t}', '{a}')" for t, names in ALIASES.items() for a in names) + ")"
_SCORES = f"scores AS (SELECT name, target, CASE WHEN plain = target OR EXISTS (SELECT 1 FROM {_ALIAS} a(of_target, alias_name) WHERE of_target = target AND alias_name = plain) THEN 1.0 ELSE jaro_winkler_similarity(plain, target) END AS score FROM {_CANON})"
_ORDER = "(VALUES " + ", ".join(f"('{n}', {i})" for i, n in enumerate(NAMES)) + ") o(oname, place)"
_RANKED = f"ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY score DESC, place) AS rn FROM scores JOIN {_ORDER} ON name = oname)"


def _names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(list(NAMES),)], "keys array<string>")


@query(f"WITH {_SCORES} SELECT name, target, ROUND(score, 4) AS score FROM scores")
def fuzzy_field_scores(spark, sf_dir):
    """Field names stand in records of a table; each distinct one is scored."""
    place = F.col("n_nationkey") % len(NAMES) + 1
    rows = table(spark, sf_dir, "nation").select(F.element_at(F.array(*[F.lit(n) for n in NAMES]), place.cast("int")).alias("name"))
    return fuzzy.field_scores(rows).withColumn("score", F.round("score", 4))


@query(f"WITH {_SCORES}, {_RANKED} SELECT target, name AS source_field, ROUND(score, 4) AS score FROM ranked WHERE rn = 1")
def fuzzy_best_match(spark, sf_dir):
    trace = fuzzy.matches(_names(spark)).select(F.explode("trace").alias("t"))
    return trace.select(F.col("t.target_field").alias("target"), "t.source_field", F.round("t.score", 4).alias("score"))


@query(f"WITH {_SCORES}, {_RANKED} SELECT target, rn, name, ROUND(score, 4) AS score FROM ranked WHERE rn <= 3 AND score > 0")
def fuzzy_top3(spark, sf_dir):
    trace = fuzzy.matches(_names(spark)).select(F.explode("trace").alias("t"))
    tops = trace.select(F.col("t.target_field").alias("target"), F.posexplode("t.candidates").alias("rn", "c"))
    return tops.select("target", (F.col("rn") + 1).cast("bigint").alias("rn"), F.col("c.field").alias("name"), F.col("c.score").alias("score"))


@query(f"WITH {_SCORES}, {_RANKED} SELECT COUNT(*) FILTER (score < 0.85) AS low, ROUND(AVG(score), 4) AS confidence FROM ranked WHERE rn = 1 AND score >= 0.7")
def fuzzy_confidence(spark, sf_dir):
    mean = F.aggregate("scores", F.lit(0.0), lambda s, x: s + x) / F.size("scores")
    return fuzzy.matches(_names(spark)).select(F.size("low").cast("bigint").alias("low"), F.round(mean, 4).alias("confidence"))


@query(stations_sql("SELECT mid, seq, station_id, name, city, postal_code, phone, CASE WHEN raw_id IS NULL OR name_given = '' THEN 'fuzzy_mapping_failure' WHEN reason = 'schema_validation_failed' THEN 'fuzzy_mapping_failure' ELSE reason END AS reason, 1.0 AS confidence FROM numbered WHERE source = 'valencia'", _NUMBERED))
def fuzzy_map_valencia(spark, sf_dir):
    """All field names of this feed are aliases, so the result is that of the rules."""
    fanned = payloads.fan_out(messages(spark, sf_dir).where("source = 'valencia'"))
    padded = fanned.withColumn("fields", F.map_concat("fields", F.map_filter(F.create_map(*[x for n in REGISTRY["valencia"].fields.values() for x in (F.lit(n[0]), F.lit(None).cast("string"))]), lambda k, v: ~F.map_contains_key("fields", k))))
    rows = fuzzy.checked(fuzzy.mapped(padded))
    return rows.select(F.col("message_id").alias("mid"), (F.col("ordinal") + 1).alias("seq"), "station_id", "name", "city", "postal_code", "phone", "reason", "confidence")


_XML_NAMES = {"raw_id": "codigo", "name": "nombre", "address": "direccion", "city": "poblacion", "province": "provincia", "postal_code": "zip", "latitude": "lat", "longitude": "lng", "phone": "tel", "email": "correo"}


@query(stations_sql("SELECT k, station_id, name, city, postal_code, phone, CASE WHEN raw_id IS NULL OR name_given = '' OR reason = 'schema_validation_failed' THEN 'fuzzy_mapping_failure' ELSE reason END AS reason FROM reasoned"))
def fuzzy_map_xml(spark, sf_dir):
    """XML with tags that no rule knows, nested in a feed of its own, mapped by names: each message has one station."""
    rows = raw_st(spark, sf_dir)
    escaped = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    tags = [F.concat(F.lit(f"<{n}>"), escaped(F.col(f"in_{t}")), F.lit(f"</{n}>")) for t, n in _XML_NAMES.items()]
    text = F.concat(F.lit('<?xml version="1.0"?><feed v="2"><station>'), *tags, F.lit("<more><note>n</note></more></station></feed>"))
    found = routing.normalise(rows.select(F.col("k").alias("message_id"), "source", F.lit("xml").alias("format"), text.alias("payload")), config=EngineConfig(mode="FUZZY"))
    return found.select(F.col("message_id").alias("k"), "station_id", "name", "city", "postal_code", "phone", "reason")


_NAMES_BY_REGION = [NAMES[i::5] for i in range(5)]
_REGION_NAMES = "(VALUES " + ", ".join(f"({i}, '{n}', {k})" for i, names in enumerate(_NAMES_BY_REGION) for k, n in enumerate(names)) + ") rn(region, rname, rplace)"


@query(f"WITH {_SCORES}, tops AS (SELECT region, target, name, score, ROW_NUMBER() OVER (PARTITION BY region, target ORDER BY score DESC, rplace) AS rn FROM scores JOIN {_REGION_NAMES} ON name = rname) SELECT n_nationkey, target, rn, name, ROUND(score, 4) AS score FROM tops JOIN nation ON n_regionkey = region WHERE rn <= 3 AND score > 0")
def fuzzy_top3_records(spark, sf_dir):
    """The candidates of each record's names; each distinct list of names is matched once."""
    lists = F.array(*[F.array(*[F.lit(n) for n in names]) for names in _NAMES_BY_REGION])
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.element_at(lists, (F.col("n_regionkey") + 1).cast("int")).alias("keys"))
    tops = rows.join(fuzzy.matches(rows), "keys").select("n_nationkey", F.explode("trace").alias("t")).select("n_nationkey", F.col("t.target_field").alias("target"), F.posexplode("t.candidates").alias("rn", "c"))
    return tops.select("n_nationkey", "target", (F.col("rn") + 1).cast("bigint").alias("rn"), F.col("c.field").alias("name"), F.col("c.score").alias("score"))


# ---- learned rules ---------------------------------------------------------------------------------------------------

_RULES = [("galicia", "lugo", True, "2024-01-01"), ("galicia", "lugo", False, "2023-12-01"), ("galicia", "unknown", True, "2024-01-01"), ("valencia", "alicante", False, "2024-01-01")]
_RULES_SQL = "(VALUES " + ", ".join(f"('{s}', '{p}', {a}, TIMESTAMP '{t}')" for s, p, a, t in _RULES) + ") r(source_system, province_type, is_active, generated_at)"


def _rules(spark: SparkSession) -> DataFrame:
    mapping = {"id": "raw_id", "nombre": "name", "localidad": "city"}
    rows = [(s, p, mapping, "stub", "v1", 0.95, None, a, t, t) for s, p, a, t in _RULES]
    text = learned.RULE.replace("generated_at timestamp", "generated_at string").replace("updated_at timestamp", "updated_at string")
    return spark.createDataFrame(rows, text).withColumns({c: F.col(c).cast("timestamp") for c in ("generated_at", "updated_at")})


@query(f"SELECT n.n_nationkey AS message_id, r.source_system IS NOT NULL AS hit FROM nation n LEFT JOIN {_RULES_SQL} ON r.is_active AND r.source_system = 'galicia' AND r.province_type = CASE n_nationkey % 3 WHEN 0 THEN 'lugo' WHEN 1 THEN 'unknown' ELSE 'ourense' END")
def rule_lookup(spark, sf_dir):
    third = F.col("n_nationkey") % 3
    record = F.when(third == 0, '{"provincia":" Lugo "}').when(third == 1, '{"id":"1"}').otherwise('{"PROVINCIA":"OURENSE"}')
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("message_id"), F.lit("galicia").alias("source"), F.lit(0).alias("ordinal"), record.alias("raw_fragment"))
    return learned.lookup(learned.batch_keys(rows), _rules(spark)).select("message_id", F.col("field_mapping").isNotNull().alias("hit"))


@query("SELECT n_nationkey AS k, CAST(n_nationkey AS VARCHAR) AS raw_id, n_name AS name, 'Santiago' AS city FROM nation")
def rule_apply(spark, sf_dir):
    record = F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("nombre"), F.lit("Santiago").alias("localidad")))
    rule = F.create_map(*[F.lit(x) for pair in (("id", "raw_id"), ("nombre", "name"), ("localidad", "city")) for x in pair])
    out = table(spark, sf_dir, "nation").select("n_nationkey", learned.apply_rule(record, rule).alias("m"))
    return out.select(F.col("n_nationkey").alias("k"), F.col("m")["raw_id"].alias("raw_id"), F.col("m")["name"].alias("name"), F.col("m")["city"].alias("city"))


@query(f"SELECT source_system, province_type, is_active AND NOT (source_system = 'galicia' AND province_type = 'lugo') AS is_active, generated_at FROM {_RULES_SQL} UNION ALL SELECT 'galicia', 'lugo', TRUE, TIMESTAMP '2024-02-01'")
def rule_scd(spark, sf_dir):
    new = _rules(spark).where("province_type = 'lugo' and is_active").withColumn("generated_at", F.lit("2024-02-01").cast("timestamp"))
    return learned.upsert_rules(_rules(spark), new).select("source_system", "province_type", "is_active", "generated_at")


@query(f"SELECT source_system, province_type FROM {_RULES_SQL} WHERE is_active AND NOT (source_system = 'galicia' AND province_type = 'unknown')")
def rule_invalidate(spark, sf_dir):
    left, _ = learned.invalidate(_rules(spark), "galicia", "unknown")
    return learned.listing(left).select("source_system", "province_type")


_KINDS = "SELECT source, kind, MIN(ts) AS first_at, MAX(ts) AS last_at FROM (SELECT CASE user_id % 3 WHEN 0 THEN 'catalunya' WHEN 1 THEN 'valencia' ELSE 'galicia' END AS source, event_type AS kind, ts FROM events) GROUP BY source, kind"


def _event_rules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rules of two generations for each source and event type of the log: known at its first event, learned again at its last."""
    source = F.element_at(F.array(*[F.lit(x) for x in ("catalunya", "valencia", "galicia")]), (F.col("user_id") % 3 + 1).cast("int"))
    kinds = table(spark, sf_dir, "events").groupBy(source.alias("source_system"), F.col("event_type").alias("province_type")).agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
    rule = lambda at: kinds.select("source_system", "province_type", F.create_map(F.lit("id"), F.lit("raw_id")).alias("field_mapping"), F.lit(True).alias("is_active"), F.col(at).alias("generated_at"), F.col(at).alias("updated_at"))
    return rule("first_at"), rule("last_at")


@query(f"WITH kinds AS ({_KINDS}) SELECT source AS source_system, kind AS province_type, kind = 'error' AND source <> 'galicia' AS is_active, first_at AS generated_at FROM kinds WHERE kind = 'error' UNION ALL SELECT source, kind, kind <> 'error' AND source <> 'galicia', first_at FROM kinds WHERE kind <> 'error' UNION ALL SELECT source, kind, source <> 'galicia', last_at FROM kinds WHERE kind <> 'error'".replace("kind <> 'error' AND source <> 'galicia', first_at", "FALSE, first_at"))
def rule_history(spark, sf_dir):
    """Rules of a log's kinds learned anew (but for one kind), then one source's invalidated: all generations are listed."""
    old, new = _event_rules(spark, sf_dir)
    rules = learned.upsert_rules(old, new.where("province_type <> 'error'"))
    left, _ = learned.invalidate(rules, "galicia")
    return learned.listing(left, active_only=False).select("source_system", "province_type", "is_active", "generated_at")


@query(f"WITH kinds AS ({_KINDS}) SELECT source AS source_system, kind AS province_type, last_at AS generated_at FROM kinds WHERE NOT (source = 'galicia' AND kind = 'click')")
def rule_listing(spark, sf_dir):
    """The active rules after one kind of a source was invalidated."""
    old, new = _event_rules(spark, sf_dir)
    left, _ = learned.invalidate(learned.upsert_rules(old, new), "galicia", "click")
    return learned.listing(left).select("source_system", "province_type", "generated_at")


@query("""SELECT event_id, LEFT(SHA256(CASE event_id % 4 WHEN 0 THEN '["k"]' WHEN 1 THEN '["a", "k"]' WHEN 2 THEN '["b", "k", "z"]' ELSE '[]' END), 16) AS signature FROM events""")
def schema_signature(spark, sf_dir):
    four, inner = F.col("event_id") % 4, F.regexp_extract("props", r"^\{(.*)\}$", 1)
    record = F.when(four == 0, F.col("props")).when(four == 1, F.concat(F.lit("{"), inner, F.lit(',"a":1}'))).when(four == 2, F.concat(F.lit('{"z":[1],'), inner, F.lit(',"b":null}'))).otherwise("{}")
    return table(spark, sf_dir, "events").select("event_id", learned.signature(record).alias("signature"))


@query(stations_sql("SELECT mid, seq, station_id, name, city, phone FROM numbered WHERE source = 'valencia'", _NUMBERED))
def model_map_valencia(spark, sf_dir):
    """Through the stand-in for a model, which maps by names."""
    from milldam.operators import mapping

    fanned = payloads.fan_out(messages(spark, sf_dir).where("source = 'valencia'")).drop("fields", "truthy")
    answered = learned.call_model(fanned)
    rows = mapping.cleaned(learned.build(answered))
    return rows.select(F.col("message_id").alias("mid"), (F.col("ordinal") + 1).alias("seq"), "station_id", "name", "city", "phone")


# ---- generators and stream -------------------------------------------------------------------------------------------


@query("SELECT source, CAST(COUNT(*) AS BIGINT) AS total, CAST(COUNT(*) AS BIGINT) AS valid FROM (SELECT CASE range % 3 WHEN 0 THEN 'catalunya' WHEN 1 THEN 'valencia' ELSE 'galicia' END AS source FROM range(3000)) GROUP BY source")
def synth_valid_invariants(spark, sf_dir):
    """Generated stations, as payloads through the whole chain: all are accepted."""
    rows = routing.deduplicated(routing.normalise(generate.payloads(generate.valid(spark, 3000))))
    return rows.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("valid"))


@query("SELECT e.error_type, CAST(100 AS BIGINT) AS n, e.error_type <> 'coordinates_outside_province' AS rejected_all FROM (VALUES " + ", ".join(f"('{e}')" for e in generate.ERRORS) + ") e(error_type)")
def synth_invalid_reasons(spark, sf_dir):
    """Whether the checks refuse all of each error: coordinates outside a province pass where the province has no box."""
    from milldam.operators import checks, mapping

    made = generate.invalid(spark, 1000).withColumn("is_object", F.lit(True))
    rows = checks.checked(mapping.cleaned(mapping.settled(made, {f"in_{t}": F.col(t).cast("string") for t in CANONICAL})))
    return rows.groupBy("error_type").agg(F.count("*").alias("n"), F.min(F.col("reason").isNotNull()).alias("rejected_all"))


@query("SELECT CAST(701 AS BIGINT) AS good, CAST(300 AS BIGINT) AS bad")
def synth_mixed_counts(spark, sf_dir):
    made = generate.mixed(spark, 1001, 0.3)
    return made.agg(F.count_if(F.col("error_type").isNull()).alias("good"), F.count_if(F.col("error_type").isNotNull()).alias("bad"))


@query("SELECT range AS sample, range % 5 AS r_regionkey FROM range(1000)")
def fixture_resample(spark, sf_dir):
    return payloads.resample(table(spark, sf_dir, "region"), 1000, "r_regionkey").select("sample", F.col("r_regionkey").cast("bigint").alias("r_regionkey"))


@query("SELECT c_custkey AS k, 'ITV ' || c_name AS payload FROM customer")
def envelope_decode(spark, sf_dir):
    raw = F.base64(F.encode(F.concat(F.lit("ITV "), "c_name"), "UTF-8"))
    value = F.to_json(F.struct(F.struct(F.col("c_custkey").cast("string").alias("message_id"), F.lit("Galicia ").alias("source"), F.lit("CSV").alias("format")).alias("header"), F.struct(raw.alias("raw_content")).alias("payload")))
    got = payloads.decode_envelopes(table(spark, sf_dir, "customer").select(value.alias("value")))
    return got.where("source = 'galicia' and format = 'csv'").select(F.col("message_id").cast("bigint").alias("k"), "payload")


@query("SELECT source, CAST(COUNT(*) AS BIGINT) AS total, CAST(COUNT(*) FILTER (event_type NOT IN ('error', 'signup')) AS BIGINT) AS successful FROM (SELECT event_type, CASE user_id % 3 WHEN 0 THEN 'catalunya' WHEN 1 THEN 'valencia' ELSE 'galicia' END AS source FROM events) GROUP BY source")
def stream_vs_batch(spark, sf_dir):
    """The log's totals, gathered by a stream that runs until its input is used up."""
    import uuid

    from milldam.plans.views import LOG

    schema = table(spark, sf_dir, "events").schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        stream = reader.parquet(f"{sf_dir}/events.parquet")
    else:  # a stream reads folders only
        stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = spark.sql(LOG, events=stream)
    sums = rows.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "success").alias("successful"))
    shared = shared_folder(spark)
    name = "stream_" + uuid.uuid4().hex
    run = sums.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{shared}/{name}").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.table(name)


# ---- routes: by rules, names, model, and as a stream ------------------------------------------------------------------

_ONE = "source || '-' || CAST(message_id AS VARCHAR)"
_ENDED = (
    DEDUP_CTE.format(keep="k", scope=_ONE, source="reasoned WHERE reason IS NULL"),
    "kept AS (SELECT c.* FROM reasoned c JOIN walk ON c.k = walk.k WHERE walk.dup IS NULL)",
    CONTACT_CTE.format(scope=_ONE, source="kept"),
    "ended AS (SELECT k, dup FROM walk WHERE dup IS NOT NULL UNION ALL SELECT k, dup2 FROM ranked_e)",
)


def _routes_sql(reason: str = "reason", where: str = "TRUE") -> str:
    return stations_sql(
        f"SELECT source, CASE WHEN reason IS NULL AND dup IS NULL THEN 'accepted' ELSE 'rejected' END AS route, COALESCE({reason}, dup, '-') AS reason, COUNT(*) AS n FROM reasoned LEFT JOIN ended ON reasoned.k = ended.k WHERE {where} GROUP BY 1, 2, 3",
        *_ENDED,
        recursive=True,
    )


def _routes(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Stations by source, route and reason."""
    good = accepted.select(F.col("source_system").alias("source"), F.lit("accepted").alias("route"), F.lit("-").alias("reason"))
    return good.unionByName(rejected.select("source", F.lit("rejected").alias("route"), "reason")).groupBy("source", "route", "reason").agg(F.count("*").alias("n"))


@query(_routes_sql())
def route_by_rules(spark, sf_dir):
    out = routing.run(messages(spark, sf_dir))
    return _routes(out["accepted"], out["rejected"])


@query(_routes_sql("CASE WHEN reason IN ('missing_raw_id', 'schema_validation_failed') THEN 'fuzzy_mapping_failure' ELSE reason END", "source = 'valencia'"))
def route_by_names(spark, sf_dir):
    out = routing.run(messages(spark, sf_dir).where("source = 'valencia'"), EngineConfig(mode="FUZZY"))
    return _routes(out["accepted"], out["rejected"])


@query(_routes_sql("CASE WHEN reason = 'schema_validation_failed' THEN CASE WHEN name_given = '' THEN 'missing_name' ELSE 'llm_pydantic_validation_error' END ELSE reason END", "source = 'valencia'"))
def route_by_model(spark, sf_dir):
    """The stand-in for a model maps what no learned rule does."""
    out = routing.run(messages(spark, sf_dir).where("source = 'valencia'"), EngineConfig(mode="LLM"))
    return _routes(out["accepted"], out["rejected"])


@query(
    stations_sql(
        "SELECT 'valencia' AS source_system, kind AS province_type, TRUE AS is_active, 'name' AS of_nombre FROM (SELECT COALESCE(LOWER(NULLIF(TRIM(in_province), '')), 'unknown') AS kind, ROW_NUMBER() OVER (PARTITION BY message_id ORDER BY ordinal) AS place FROM raw_st WHERE source = 'valencia') WHERE place = 1 AND kind <> 'madrid' GROUP BY kind UNION ALL SELECT 'valencia', 'madrid', TRUE, 'renamed'"
    )
)
def model_rules(spark, sf_dir):
    """Rules after a batch: one is known before, the others are learned from the model's answers."""
    known = spark.createDataFrame([("valencia", "madrid", {"codigo": "raw_id", "nombre": "renamed"}, True)], "source_system string, province_type string, field_mapping map<string,string>, is_active boolean")
    out = learned.transformed(payloads.fan_out(messages(spark, sf_dir).where("source = 'valencia'")), known)
    return learned.listing(out["rules"]).select("source_system", "province_type", "is_active", F.col("field_mapping")["nombre"].alias("of_nombre"))


_MESSAGES = {
    1: ('{"other":1}', "rejected", "message", "no_stations_extracted"),
    2: ('{"codigo":"@","nombre":"x"}', "rejected", "station", "insufficient_contact_or_location"),
    3: ('{"codigo":"@","nombre":"ITV @","direccion":"Calle @","poblacion":"Valencia","provincia":"Valencia","codigo_postal":"46001","telefono":"961234567"}', "accepted", "station", "-"),
    0: ("", "dead", "message", "payload_missing"),
}


@query("SELECT r.route, r.level, r.reason, COUNT(*) AS n FROM orders JOIN (VALUES " + ", ".join(f"({k}, '{a}', '{b}', '{c}')" for k, (_, a, b, c) in _MESSAGES.items()) + ") r(kind, route, level, reason) ON o_orderkey % 4 = r.kind GROUP BY 1, 2, 3")
def route_messages(spark, sf_dir):
    """All three ways, at the level of messages and of stations."""
    k = F.col("o_orderkey")
    text = F.lit("")
    for kind, (shape, *_) in _MESSAGES.items():
        text = F.when(k % 4 == kind, F.replace(F.lit(shape), F.lit("@"), k.cast("string"))).otherwise(text)
    raw = table(spark, sf_dir, "orders").select(k.cast("string").alias("message_id"), F.lit("valencia").alias("source"), F.lit("json").alias("format"), text.alias("payload"))
    out = routing.run(raw)
    ways = [
        out["accepted"].select(F.lit("accepted").alias("route"), F.lit("station").alias("level"), F.lit("-").alias("reason")),
        out["rejected"].select(F.lit("rejected"), "rejection_level", "reason"),
        out["dead"].select(F.lit("dead"), F.lit("message"), "dead"),
    ]
    return ways[0].union(ways[1]).union(ways[2]).groupBy("route", "level", "reason").agg(F.count("*").alias("n"))


@query("SELECT COUNT(*) FILTER (o_orderkey % 4 = 3) AS processed, COUNT(*) FILTER (o_orderkey % 4 = 2) AS stations_rejected, COUNT(*) FILTER (o_orderkey % 4 = 1) AS messages_rejected FROM orders")
def routing_counters(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.lit(None).cast("string")
    for kind, (shape, *_) in _MESSAGES.items():
        text = F.when(k % 4 == kind, F.replace(F.lit(shape), F.lit("@"), k.cast("string"))).otherwise(text)
    raw = table(spark, sf_dir, "orders").select(k.cast("string").alias("message_id"), F.lit("valencia").alias("source"), F.lit("json").alias("format"), text.alias("payload"))
    return routing.counters(routing.deduplicated(routing.normalise(raw)))


@query(
    stations_sql(
        "SELECT source AS source_system, 'batch-' || CAST(message_id % 7 AS VARCHAR) AS seed, COUNT(*) AS n, SUM(message_id) AS gateway_s FROM reasoned LEFT JOIN ended ON reasoned.k = ended.k WHERE reason IS NULL AND dup IS NULL GROUP BY 1, 2",
        *_ENDED,
        recursive=True,
    )
)
def audit_provenance(spark, sf_dir):
    """What messages say of how they came about, from the raw message through the chain to the log's rows."""
    number = F.substring_index("message_id", "-", -1).cast("bigint")
    marked = messages(spark, sf_dir).withColumns({
        "injection": F.struct(F.lit("mixed").alias("type"), F.create_map(F.lit("seed"), F.concat(F.lit("batch-"), (number % 7).cast("string"))).alias("metadata")),
        "gateway_ingested_at": F.timestamp_seconds(number),
    })
    logged = store.audit_success(routing.run(marked)["accepted"], 1, F.lit("2024-05-01").cast("timestamp")).where("metadata.injection.type = 'mixed'")
    return logged.groupBy("source_system", F.col("metadata.injection.metadata")["seed"].alias("seed")).agg(F.count("*").alias("n"), F.sum(F.unix_seconds("metadata.timing_context.gateway_ingested_at")).alias("gateway_s"))


@query(_routes_sql())
def stream_routes(spark, sf_dir):
    """The same messages from files, through the stream and its sinks."""
    import uuid

    from milldam.streaming import pipeline

    folder = f"{shared_folder(spark)}/stream_routes_{uuid.uuid4().hex}"
    messages(spark, sf_dir).write.json(f"{folder}/in")
    run = pipeline.start(pipeline.read_messages(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/state", availableNow=True)
    run.awaitTermination()
    accepted = spark.read.schema("source_system string").json(f"{folder}/out/normalized")
    return _routes(accepted, spark.read.schema("source string, reason string").json(f"{folder}/out/rejected"))
