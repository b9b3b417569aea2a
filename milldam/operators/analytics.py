"""Monitoring queries over the audit log and the reject stream, each one declarative plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milldam.config import bounded
from milldam.functions.clean import parse_time, payload_kind, text_or
from milldam.operators.mapping import settled
from milldam.operators.ranks import running_counts

# Spans between the stamps of a message's way.
SPANS = {
    "gateway_latency_ms": ("gateway_ingested_at", "normalizer_started_at"),
    "normalizer_duration_ms": ("normalizer_started_at", "normalizer_completed_at"),
    "persister_duration_ms": ("persister_started_at", "persister_completed_at"),
    "total_ms": ("gateway_ingested_at", "persister_completed_at"),
}


def timing(df: DataFrame, strict: bool = False) -> DataFrame:
    """Adds the milliseconds of each span between the stamps (columns of text), cut towards zero; a bad stamp voids all of them. strict: so
    does a missing first one. Each stamp is parsed once."""
    stamps = list(dict.fromkeys(x for span in SPANS.values() for x in span))
    parsed = settled(df, {f"_{k}": F.unix_micros(parse_time(F.col(k))) for k in stamps})
    sound = F.lit(True)
    for k in stamps:
        sound = sound & (F.col(k).isNull() | (F.col(k) == "") | F.col(f"_{k}").isNotNull())
    if strict:
        sound = sound & F.col("gateway_ingested_at").isNotNull()
    spans = {name: F.when(sound, ((F.col(f"_{b}") - F.col(f"_{a}")) / 1000).cast("bigint")) for name, (a, b) in SPANS.items()}
    return settled(parsed, spans).drop(*[f"_{k}" for k in stamps])


def status_lookup(log: DataFrame, message_id) -> DataFrame:
    """By a message's own id or its parent's."""
    hit = F.col("message_id") == message_id
    return log.where(hit | (F.col("parent_message_id") == message_id) if "parent_message_id" in log.columns else hit)


def window_start(log: DataFrame, period_hours: int, now: Column | None = None) -> DataFrame:
    """Rows of the look-back window, by the given end or the log's last stamp."""
    bounded("period_hours", period_hours, 1, 8760)
    hours = F.make_interval(hours=F.lit(period_hours))
    if now is not None:
        return log.where(F.col("processed_at") >= now - hours)
    last = log.agg((F.max("processed_at") - hours).alias("_from"))
    return log.join(F.broadcast(last), F.col("processed_at") >= F.col("_from")).drop("_from")


def global_metrics(log: DataFrame) -> DataFrame:
    """Totals and latencies; latencies of 0 or null do not count; an empty window gives zeros."""
    d = F.nullif(F.col("total_ms"), F.lit(0)).cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    tails = percentiles(log.select(d.alias("ms")), "ms", 0.95, 0.99, names=("p95_ms", "p99_ms"))
    return log.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        zero(F.round(F.avg(d), 2)).alias("avg_ms"),
    ).join(tails.select(*[F.round(c, 2).alias(c) for c in tails.columns]))


def by_source(log: DataFrame) -> DataFrame:
    """Here, failed is whatever is no success."""
    ok = F.col("status") == "success"
    return log.groupBy("source").agg(F.count("*").alias("total"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"))


def percentiles(df: DataFrame, value: str, *ps: float, names: tuple[str, ...] = ()) -> DataFrame:
    """Linear interpolation between neighbours; 0 if there is no value."""
    running = running_counts(df, [], value)
    joined = running.join(F.broadcast(running.agg(F.sum("_n").alias("_all"))))
    names = names or tuple(f"p{round(p * 100)}" for p in ps)
    at = [(F.col("_all") - 1) * p for p in ps]
    value_at = lambda k: F.min(F.when(F.col("_upto") > k, F.col(value).cast("double")))
    ends = [x for i, a in enumerate(at) for x in (value_at(F.floor(a)).alias(f"_l{i}"), value_at(F.ceil(a)).alias(f"_h{i}"), F.max(a - F.floor(a)).alias(f"_s{i}"))]
    found = joined.agg(*ends)
    return found.select(*[F.coalesce(F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_s{i}"), F.lit(0.0)).alias(n) for i, n in enumerate(names)])


def top_rejections(df: DataFrame, summary: str = "rejection_summary", top: int = 10) -> DataFrame:
    """Sums of reason counts, with their share; ties by reason."""
    sums = df.select(F.explode(summary).alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("count"))
    whole = sums.agg(F.sum("count").alias("_all"))
    return sums.join(F.broadcast(whole)).select("reason", "count", F.round(F.col("count") * 100 / F.col("_all"), 2).alias("percentage")).orderBy(F.desc("count"), "reason").limit(top)


def rejection_details(log: DataFrame, message_id, metadata: str = "metadata") -> DataFrame:
    return log.where(F.col("message_id") == message_id).select("message_id", F.get_json_object(metadata, "$.rejection_summary").alias("rejection_summary"))


def latest_stations(stations: DataFrame, limit: int = 5000) -> DataFrame:
    """The newest rows, with empty texts and a default type where values are missing."""
    bounded("limit", limit, 1, 20_000)
    texts = [c for c in ("nombre", "direccion", "codigo_postal", "telefono", "email") if c in stations.columns]
    return (
        stations.orderBy(F.desc("id"))
        .limit(limit)
        .select(F.col("id").cast("string").alias("id"), *[F.coalesce(c, F.lit("")).alias(c) for c in texts], F.coalesce(F.nullif(F.col("tipo"), F.lit("")), F.lit("Fija")).alias("tipo"))
    )


def latest(log: DataFrame, n: int = 10, key: str = "message_id") -> DataFrame:
    return log.orderBy(F.desc("processed_at"), F.desc(key)).limit(n)


def reason_family(x: Column) -> Column:
    starts = lambda p: x.startswith(p)
    return (
        F.when(x == "no_stations_extracted", "message_empty")
        .when(x.isin("station_transform_exception", "schema_validation_failed"), "processing")
        .when(starts("missing_"), "missing_data")
        .when(starts("invalid_station_"), "invalid_payload")
        .when(starts("invalid_") | (x == "validation_failed"), "validation")
        .when(starts("duplicate_"), "duplicate_detection")
        .when(starts("coordinates_") | starts("postal_code_"), "business_rules")
        .otherwise("other")
    )


def reject_report(rejects: DataFrame) -> DataFrame:
    """Counts by reason, family, source, format, level and payload type, in one pass: (dimension, value, count)."""
    reason = text_or(F.col("reason"))
    dims = {
        "reason": reason,
        "family": reason_family(reason),
        "source": text_or(F.col("source")),
        "format": text_or(F.col("format")),
        "level": text_or(F.col("rejection_level")),
        "payload_type": payload_kind(F.col("raw_payload")),
    }
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("value")) for k, v in dims.items()]))
    return rejects.select(stacked.alias("d")).select("d.*").groupBy("dimension", "value").agg(F.count("*").alias("count"))


def reject_window(rejects: DataFrame) -> DataFrame:
    return rejects.agg(F.min("rejected_at").alias("first_at"), F.max("rejected_at").alias("last_at"), F.count("*").alias("total"))


def first_samples(rejects: DataFrame, order: str, sample: str) -> DataFrame:
    """The first sample of each reason, with its share of all rejects."""
    sums = rejects.groupBy("reason").agg(F.count("*").alias("count"), F.min_by(sample, order).alias("sample"))
    whole = rejects.agg(F.count("*").alias("_all"))
    return sums.join(F.broadcast(whole)).select("reason", "count", F.round(F.col("count") * 100 / F.col("_all"), 1).alias("percentage"), "sample")


def nearest_rank_rows(df: DataFrame, group: list[str], value: str, p: float, name: str) -> DataFrame:
    """The value at place int(n * p) of the sorted ones, from 0, as load reports define it."""
    running = running_counts(df, group, value)
    sizes = running.groupBy(*group).agg(F.sum("_n").alias("_all"))
    joined = running.join(F.broadcast(sizes), group) if group else running.join(F.broadcast(sizes))
    return joined.where(F.col("_upto") > F.floor(F.col("_all") * p)).groupBy(*group).agg(F.min(value).alias(name))


def throughput(runs: DataFrame, started: str = "started_at", finished: str = "finished_at") -> DataFrame:
    """Requests, seconds from the first start to the last end, and requests a second (0 where no time passed)."""
    span = (F.unix_micros(F.max(finished)) - F.unix_micros(F.min(started))) / 1_000_000
    sums = runs.agg(F.count("*").alias("sent"), F.coalesce(span, F.lit(0.0)).alias("seconds"))
    return sums.withColumn("per_second", F.when(F.col("seconds") > 0, F.round(F.col("sent") / F.col("seconds"), 2)).otherwise(F.lit(0.0)))


def parse_errors(raw: DataFrame, value: str = "value") -> DataFrame:
    """How many queued rejects are no JSON object, and so are counted by nothing else."""
    fits = F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.lit(False))
    return raw.agg(F.count("*").alias("messages"), F.count_if(~fits).alias("parse_errors"))


def load_summary(runs: DataFrame) -> DataFrame:
    """(source, ok, invalid, ms): by source, sent, accepted, failed, invalid and latencies."""
    sums = runs.groupBy("source").agg(
        F.count("*").alias("sent"),
        F.count_if("ok").alias("accepted"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count_if("invalid").alias("invalid"),
        F.round(F.min("ms"), 2).alias("min_ms"),
        F.round(F.avg("ms"), 2).alias("avg_ms"),
        F.round(F.max("ms"), 2).alias("max_ms"),
    )
    return sums.join(nearest_rank_rows(runs, ["source"], "ms", 0.95, "p95_ms"), "source", "left")


def evaluation(rows: DataFrame, batch: int) -> DataFrame:
    """(source, i, outputs, batch_ms) with i from 0: micro-batches of a size; a row is valid if its place is below its batch's outputs."""
    placed = rows.withColumns({"b": F.floor(F.col("i") / batch), "place": F.col("i") % batch})
    sized = placed.groupBy("source", "b").agg(F.count("*").alias("size"), F.max("outputs").alias("outputs"), F.max("batch_ms").alias("batch_ms"))
    return sized.groupBy("source").agg(
        F.sum("size").alias("total"),
        F.sum(F.least("outputs", "size")).alias("valid"),
        F.round(F.sum(F.least("outputs", "size")) / F.sum("size"), 4).alias("ratio"),
        F.round(F.sum("batch_ms") / F.sum("size"), 4).alias("mean_ms"),
    )


def quality_summary(rows: DataFrame, least: float = 20.0) -> DataFrame:
    """(source, reason): valid, rejected, pass rate and verdict by source."""
    ok = F.col("reason").isNull()
    rate = F.count_if(ok) * 100 / F.count("*")
    return rows.groupBy("source").agg(
        F.count_if(ok).alias("valid"), F.count_if(~ok).alias("rejected"), F.count("*").alias("total"), F.round(rate, 2).alias("pass_rate"), F.when(rate >= least, "PASS").otherwise("FAIL").alias("verdict")
    )


def sample_valid(rows: DataFrame, order: str, n: int = 2) -> DataFrame:
    """The first n valid rows of each source. Rank limits reach below the shuffle, so no source is gathered."""
    w = Window.partitionBy("source").orderBy(order)
    return rows.where("reason is null").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def event_windows(events: DataFrame, time: str = "ts", width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Roll-ups by event time with a watermark; an extension, for batch and stream alike."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value_sum")).select(F.col("w.start").alias("window_start"), "event_type", "n", "value_sum")
