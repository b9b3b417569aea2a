"""Monitoring: the audit log, reject reports, load and evaluation summaries, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from milldam.functions import clean
from milldam.operators import analytics as A
from milldam.operators.mapping import settled
from milldam.plans.registry import Registry
from milldam.plans.stations import reasoned
from milldam.plans.views import dealt, log, log_sql, stations_sql, table
from milldam.operators.ranks import numbered_by

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

_WINDOW = "win AS (SELECT * FROM log WHERE processed_at >= (SELECT MAX(processed_at) - INTERVAL 72 HOUR FROM log))"


def window(spark, sf_dir):
    return A.window_start(log(spark, sf_dir), 72)


@query(
    log_sql(
        """SELECT COUNT(*) AS total, COUNT(*) FILTER (status = 'success') AS successful, COUNT(*) FILTER (status = 'failed') AS failed,
  COALESCE(ROUND(AVG(NULLIF(total_ms, 0)), 2), 0.0) AS avg_ms, COALESCE(ROUND(QUANTILE_CONT(NULLIF(total_ms, 0)::DOUBLE, 0.95), 2), 0.0) AS p95_ms, COALESCE(ROUND(QUANTILE_CONT(NULLIF(total_ms, 0)::DOUBLE, 0.99), 2), 0.0) AS p99_ms FROM win""",
        _WINDOW,
    )
)
def metrics_window(spark, sf_dir):
    return A.global_metrics(window(spark, sf_dir))


@query(log_sql("SELECT source, COUNT(*) AS total, COUNT(*) FILTER (status = 'success') AS successful, COUNT(*) FILTER (status <> 'success') AS failed FROM win GROUP BY source", _WINDOW))
def metrics_by_source(spark, sf_dir):
    return A.by_source(window(spark, sf_dir))


@query(log_sql("SELECT ROUND(QUANTILE_CONT(total_ms::DOUBLE, 0.5), 4) AS p50, ROUND(QUANTILE_CONT(total_ms::DOUBLE, 0.95), 4) AS p95, ROUND(QUANTILE_CONT(total_ms::DOUBLE, 0.99), 4) AS p99 FROM log"))
def latency_percentiles(spark, sf_dir):
    found = A.percentiles(log(spark, sf_dir), "total_ms", 0.5, 0.95, 0.99)
    return found.select(*[F.round(c, 4).alias(c) for c in found.columns])


@query(
    log_sql(
        "SELECT reason, CAST(n AS BIGINT) AS count, ROUND(n * 100 / SUM(n) OVER (), 2) AS percentage FROM (SELECT reason, SUM(c) AS n FROM (SELECT 'missing_' || source AS reason, message_id % 3 + 1 AS c FROM log WHERE status = 'failed' UNION ALL SELECT 'invalid_' || status, 1 FROM log WHERE message_id % 7 = 0) GROUP BY reason) ORDER BY n DESC, reason LIMIT 4"
    )
)
def top_rejections(spark, sf_dir):
    entry = lambda cond, name, n: F.when(cond, F.struct(name.alias("k"), n.cast("bigint").alias("v")))
    rows = log(spark, sf_dir).select(
        F.map_from_entries(
            F.array_compact(
                F.array(
                    entry(F.col("status") == "failed", F.concat(F.lit("missing_"), "source"), F.col("message_id") % 3 + 1),
                    entry(F.col("message_id") % 7 == 0, F.concat(F.lit("invalid_"), "status"), F.lit(1)),
                )
            )
        ).alias("rejection_summary")
    )
    return A.top_rejections(rows, top=4)


@query(log_sql("SELECT message_id, source, status, total_ms FROM log WHERE message_id = 77"))
def status_lookup(spark, sf_dir):
    return A.status_lookup(log(spark, sf_dir), 77).select("message_id", "source", "status", "total_ms")


@query(log_sql("SELECT message_id, '{\"missing_' || source || '\":' || CAST(message_id % 3 + 1 AS VARCHAR) || '}' AS rejection_summary FROM log WHERE message_id = 77"))
def rejection_details(spark, sf_dir):
    summary = F.create_map(F.concat(F.lit("missing_"), "source"), F.col("message_id") % 3 + 1)
    rows = log(spark, sf_dir).withColumn("metadata", F.to_json(F.struct(summary.alias("rejection_summary"))))
    return A.rejection_details(rows, 77)


@query(log_sql("SELECT COUNT(*) AS sent, ROUND((EPOCH_US(MAX(processed_at)) - EPOCH_US(MIN(processed_at))) / 1e6, 3) AS seconds, ROUND(COUNT(*) / ((EPOCH_US(MAX(processed_at)) - EPOCH_US(MIN(processed_at))) / 1e6), 2) AS per_second FROM log"))
def load_throughput(spark, sf_dir):
    rows = log(spark, sf_dir).withColumn("at", F.col("processed_at").cast("timestamp"))
    return A.throughput(rows, "at", "at").withColumn("seconds", F.round("seconds", 3))


@query("SELECT COUNT(*) AS messages, CAST((SELECT COUNT(*) FROM conversations) AS BIGINT) AS parse_errors FROM (SELECT 1 FROM events UNION ALL SELECT 1 FROM conversations)")
def reject_parse_errors(spark, sf_dir):
    both = table(spark, sf_dir, "events").select(F.col("props").alias("value")).union(table(spark, sf_dir, "conversations").select("text"))
    return A.parse_errors(both)


_STAMPS = {
    "gateway_ingested_at": (0, "message_id % 50 = 49"),
    "normalizer_started_at": (1, "false"),
    "normalizer_completed_at": (3, "message_id % 20 = 19"),
    "persister_started_at": (3, "false"),
    "persister_completed_at": (4, "false"),
}


@query(
    log_sql(
        "SELECT message_id, "
        + ", ".join(f"CASE WHEN message_id % 40 <> 13 AND NOT (message_id % 50 = 49 AND {g}) AND NOT (message_id % 20 = 19 AND {c}) THEN CAST({ms} AS BIGINT) END AS {n}" for n, g, c, ms in (("gateway_latency_ms", "true", "false", "1000 + message_id % 7 * 10"), ("normalizer_duration_ms", "false", "true", "2000 + message_id % 7 * 20"), ("persister_duration_ms", "false", "false", "1000 + message_id % 7 * 10"), ("total_ms", "true", "false", "4000 + message_id % 7 * 40")))
        + " FROM log"
    )
)
def timing_breakdown(spark, sf_dir):
    rows = dealt(log(spark, sf_dir).select("message_id", F.col("processed_at").cast("timestamp")), "message_id", 1 << 15)

    def stamp(seconds: int, missing: str):
        at = F.timestamp_micros(F.unix_micros("processed_at") + seconds * (1_000_000 + F.col("message_id") % 7 * 10_000))
        return F.when(F.expr(missing), F.lit(None)).otherwise(F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))

    stamps = {k: stamp(*v) for k, v in _STAMPS.items()}
    stamps["persister_started_at"] = F.when(F.col("message_id") % 40 == 13, "yesterday").otherwise(stamps["persister_started_at"])
    return A.timing(settled(rows, stamps)).select("message_id", *A.SPANS)


@query(log_sql("SELECT message_id, source, status FROM log ORDER BY processed_at DESC, message_id DESC LIMIT 10"))
def latest_log(spark, sf_dir):
    return A.latest(log(spark, sf_dir)).select("message_id", "source", "status")


# ---- rejects ---------------------------------------------------------------------------------------------------------

_FAMILY = """CASE WHEN reason = 'no_stations_extracted' THEN 'message_empty' WHEN reason IN ('station_transform_exception', 'schema_validation_failed') THEN 'processing' WHEN reason LIKE 'missing\\_%' ESCAPE '\\' THEN 'missing_data'
  WHEN reason LIKE 'invalid\\_station\\_%' ESCAPE '\\' THEN 'invalid_payload' WHEN reason LIKE 'invalid\\_%' ESCAPE '\\' OR reason = 'validation_failed' THEN 'validation' WHEN reason LIKE 'duplicate\\_%' ESCAPE '\\' THEN 'duplicate_detection'
  WHEN reason LIKE 'coordinates\\_%' ESCAPE '\\' OR reason LIKE 'postal\\_code\\_%' ESCAPE '\\' THEN 'business_rules' ELSE 'other' END"""
_REJECTS = "rejects AS (SELECT k, source, reason, CASE k % 3 WHEN 0 THEN '[1]' WHEN 1 THEN '{\"a\":1}' ELSE 'text' END AS raw_payload, CASE k % 3 WHEN 0 THEN 'list' WHEN 1 THEN 'dict' ELSE 'str' END AS kind, TIMESTAMP '2024-01-01' + INTERVAL (k) SECOND AS rejected_at FROM reasoned WHERE reason IS NOT NULL)"


def rejects(spark, sf_dir):
    third = F.col("k") % 3
    return reasoned(spark, sf_dir).where("reason is not null").select(
        "k", "source", "reason", F.lit("json").alias("format"), F.lit("station").alias("rejection_level"),
        F.when(third == 0, "[1]").when(third == 1, '{"a":1}').otherwise("text").alias("raw_payload"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")) + F.col("k")).alias("rejected_at"),
    )


@query(stations_sql(f"SELECT k, {_FAMILY} AS family FROM rejects", _REJECTS))
def reason_family(spark, sf_dir):
    return rejects(spark, sf_dir).select("k", A.reason_family(F.col("reason")).alias("family"))


@query(
    stations_sql(
        "SELECT dimension, value, COUNT(*) AS count FROM ("
        + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {v} AS value FROM rejects" for d, v in (("reason", "reason"), ("family", _FAMILY), ("source", "source"), ("format", "'json'"), ("level", "'station'"), ("payload_type", "kind")))
        + ") GROUP BY 1, 2",
        _REJECTS,
    )
)
def reject_report(spark, sf_dir):
    return A.reject_report(rejects(spark, sf_dir))


@query(stations_sql("SELECT MIN(rejected_at) AS first_at, MAX(rejected_at) AS last_at, COUNT(*) AS total FROM rejects", _REJECTS))
def reject_window(spark, sf_dir):
    return A.reject_window(rejects(spark, sf_dir))


@query(stations_sql("SELECT reason, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM rejects), 1) AS percentage, ARG_MIN(raw_payload, k) AS sample FROM rejects GROUP BY reason", _REJECTS))
def first_sample_per_reason(spark, sf_dir):
    return A.first_samples(rejects(spark, sf_dir), "k", "raw_payload")


@query(stations_sql("SELECT source, COUNT(*) FILTER (reason IS NULL) AS valid, COUNT(*) FILTER (reason IS NOT NULL) AS rejected, COUNT(*) AS total, ROUND(COUNT(*) FILTER (reason IS NULL) * 100.0 / COUNT(*), 2) AS pass_rate, CASE WHEN COUNT(*) FILTER (reason IS NULL) * 100.0 / COUNT(*) >= 20 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM reasoned GROUP BY source"))
def quality_by_source(spark, sf_dir):
    return A.quality_summary(reasoned(spark, sf_dir))


# ---- load and evaluation ---------------------------------------------------------------------------------------------

_RUNS = "runs AS (SELECT source, status = 'success' AS ok, message_id % 9 = 0 AS invalid, total_ms / 10.0 AS ms FROM log)"


def runs(spark, sf_dir):
    return log(spark, sf_dir).select("source", (F.col("status") == "success").alias("ok"), (F.col("message_id") % 9 == 0).alias("invalid"), (F.col("total_ms") / 10).alias("ms"))


@query(
    log_sql(
        "SELECT source, COUNT(*) AS sent, COUNT(*) FILTER (ok) AS accepted, COUNT(*) FILTER (NOT ok) AS failed, COUNT(*) FILTER (invalid) AS invalid, ROUND(MIN(ms), 2) AS min_ms, ROUND(AVG(ms), 2) AS avg_ms, ROUND(MAX(ms), 2) AS max_ms, list_sort(list(ms))[CAST(FLOOR(COUNT(*) * 0.95) AS BIGINT) + 1] AS p95_ms FROM runs GROUP BY source",
        _RUNS,
    )
)
def load_summary(spark, sf_dir):
    return A.load_summary(runs(spark, sf_dir))


@query(log_sql("SELECT list_sort(list(ms))[CAST(FLOOR(COUNT(*) * 0.95) AS BIGINT) + 1] AS p95_ms FROM runs", _RUNS))
def p95_nearest_rank(spark, sf_dir):
    return A.nearest_rank_rows(runs(spark, sf_dir), [], "ms", 0.95, "p95_ms")


@query(
    log_sql(
        "SELECT source, CAST(SUM(size) AS BIGINT) AS total, CAST(SUM(LEAST(outputs, size)) AS BIGINT) AS valid, ROUND(SUM(LEAST(outputs, size)) * 1.0 / SUM(size), 4) AS ratio, ROUND(SUM(batch_ms) * 1.0 / SUM(size), 4) AS mean_ms FROM (SELECT source, i - i % 5 AS b, COUNT(*) AS size, MAX(outputs) AS outputs, MAX(batch_ms) AS batch_ms FROM (SELECT source, ROW_NUMBER() OVER (PARTITION BY source ORDER BY message_id) - 1 AS i, message_id % 4 AS outputs, total_ms AS batch_ms FROM log) GROUP BY 1, 2) GROUP BY source"
    )
)
def eval_microbatch(spark, sf_dir):
    rows = numbered_by(log(spark, sf_dir), "message_id", ("source",)).select("source", F.col("_place").alias("i"), (F.col("message_id") % 4).alias("outputs"), F.col("total_ms").alias("batch_ms"))
    return A.evaluation(rows, 5)


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS n, ROUND(SUM(value), 4) AS value_sum FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    """An extension: the reference has no windows of event time."""
    rolled = A.event_windows(table(spark, sf_dir, "events"))
    return rolled.withColumn("value_sum", F.round("value_sum", 4))


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_props_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.expr("cast(variant_get(try_parse_json(props), '$.k', 'string') as bigint)").alias("k"))


@query("SELECT kind, COUNT(*) AS n FROM (SELECT 'dict' AS kind FROM events UNION ALL SELECT 'str' FROM conversations) GROUP BY kind")
def payload_type(spark, sf_dir):
    both = table(spark, sf_dir, "events").select("props").union(table(spark, sf_dir, "conversations").select("text"))
    return both.select(clean.payload_kind(F.col("props")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT page_id, starts_with(LTRIM(html), '<') AS looks_xml, OCTET_LENGTH(ENCODE(html)) AS n_bytes FROM pages")
def html_text_scan(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.ltrim("html").startswith("<").alias("looks_xml"), F.octet_length("html").cast("bigint").alias("n_bytes"))


@query("SELECT CASE WHEN l.doc_id IS NULL THEN 'dead_letter' WHEN quality = 1 AND toxic = 0 THEN 'accepted' ELSE 'rejected' END AS route, COUNT(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def doc_quality_route(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").withColumn("l", F.lit(1)), "doc_id", "left")
    route = F.when(F.col("l").isNull(), "dead_letter").when((F.col("quality") == 1) & (F.col("toxic") == 0), "accepted").otherwise("rejected")
    return joined.groupBy(route.alias("route")).agg(F.count("*").alias("n"))
