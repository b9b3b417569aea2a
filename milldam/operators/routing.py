"""The batch- and stream-agnostic chain from raw messages to accepted, rejected and dead rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from milldam.config import EngineConfig
from milldam.durable import durable
from milldam.operators import checks, dedup, fuzzy, learned, mapping
from milldam.sources import payloads

STATION = ("station_id", "name", "source_system", "address", "city", "province", "postal_code", "latitude", "longitude", "phone", "email", "raw_id")


#: What a message may say of how it came about; it stays with its stations up to the log.
PROVENANCE = ("gateway_ingested_at", "parent_message_id", "normalizer_started_at", "normalizer_completed_at")
MODEL = ("llm_inference_start", "llm_inference_end", "llm_inference_ms")


def normalised(messages: DataFrame, strict: bool = True, config: EngineConfig = EngineConfig(), rules: DataFrame | None = None, client: Callable | None = None) -> dict[str, DataFrame]:
    """rows: one for each record, with its reason of rejection (null: none yet), mapped as config.mode says; by model also the rules after
    it, and its metrics. Messages that are dead are left out."""
    alive = payloads.check_messages(messages).where("dead is null").drop("dead")
    fanned = payloads.fan_out(alive, strict, shapes=config.mode == "FUZZY" and not strict)
    if config.mode == "FUZZY":
        return {"rows": fuzzy.checked(fuzzy.mapped(fanned, config))}
    if config.mode == "LLM":
        return learned.transformed(fanned, rules, **({"client": client} if client else {}), config=config)
    return {"rows": checks.checked(mapping.cleaned(mapping.mapped(fanned)))}


def normalise(messages: DataFrame, strict: bool = True, config: EngineConfig = EngineConfig(), rules: DataFrame | None = None) -> DataFrame:
    """The rows of normalised()."""
    return normalised(messages, strict, config, rules)["rows"]


def deduplicated(rows: DataFrame, scope: str = "message_id") -> DataFrame:
    """Reasons of duplicates added to those of the checks."""
    good = dedup.chain(rows.where("reason is null and ordinal is not null"), scope, "ordinal")
    return good.withColumn("reason", F.col("dup")).drop("dup").unionByName(rows.where("reason is not null or ordinal is null"))


def route(rows: DataFrame) -> dict[str, DataFrame]:
    """accepted; rejected, by station or by message when it had no station at all."""
    number = lambda own, else_: F.coalesce(F.col(own), else_).alias(own) if own in rows.columns else else_.alias(own)
    stamps = [F.col(c) for c in PROVENANCE if c in rows.columns]
    context = F.struct(F.col("message_id"), number("station_sequence", F.col("ordinal") + 1), number("total_stations", F.col("total")), *stamps).alias("timing_context")
    carried = [F.col("injection")] if "injection" in rows.columns else []
    model = [F.struct(*[c for c in MODEL]).alias("model")] if set(MODEL) <= set(rows.columns) else []
    accepted = rows.where("reason is null and ordinal is not null").select("message_id", "ordinal", *STATION, context, *carried, *model)
    why = F.coalesce("reason", F.when(F.col("ordinal").isNull(), F.lit("no_stations_extracted")), F.lit("validation_failed"))
    duplicate = F.to_json(F.struct("station_id", "name", "city", "phone", "email"))
    rejected = rows.where("reason is not null or ordinal is null").select(
        "message_id",
        "source",
        "format",
        F.when(F.col("ordinal").isNull(), "no_stations_extracted").otherwise(why).alias("reason"),
        F.when(F.col("ordinal").isNull(), "message").otherwise("station").alias("rejection_level"),
        F.when(F.col("ordinal").isNull(), F.col("payload")).when(F.col("reason").startswith("duplicate_"), duplicate).otherwise(F.col("raw_fragment")).alias("raw_payload"),
        *carried,
    )
    return {"accepted": accepted, "rejected": rejected}


def cardinality_violations(rows: DataFrame, scope: str = "message_id") -> DataFrame:
    """Messages of which more than one station came out; after fan-out each must have one."""
    return rows.where("ordinal is not null").groupBy(scope).agg(F.count("*").alias("stations")).where("stations > 1")


def run(messages: DataFrame, config: EngineConfig = EngineConfig(), strict: bool = True, rules: DataFrame | None = None) -> dict[str, DataFrame]:
    """All three outputs of a batch of raw messages, and by model its rules and metrics. Payloads are parsed once: the rows are written, and the
    outputs read them. By names, accepted stations with a doubtful field are reported among the rejected ones as well."""
    found = normalised(messages, strict, config, rules)
    return outputs(durable(found.pop("rows")), messages, config) | found


def outputs(found: DataFrame, messages: DataFrame, config: EngineConfig = EngineConfig(), seen: Observation | None = None) -> dict[str, DataFrame]:
    """The outputs of normalised rows and of the messages that they come from. The rows are read for each output. seen gets the figures of
    counters() from the first output that is written, without a pass of its own."""
    rows = deduplicated(found, config.dedup_scope)
    out = route(rows.observe(seen, *_counted()) if seen else rows)
    if config.mode == "FUZZY":
        out["rejected"] = out["rejected"].unionByName(route(fuzzy.low_confidence_events(found))["rejected"])
    return out | {"dead": payloads.check_messages(messages).where("dead is not null")}


def _counted() -> list[Column]:
    good, station = F.col("reason").isNull(), F.col("ordinal").isNotNull()
    return [F.count_if(good & station).alias("processed"), F.count_if(~good & station).alias("stations_rejected"), F.count_if(~station).alias("messages_rejected")]


def counters(rows: DataFrame) -> DataFrame:
    """processed and rejected stations, and messages without any."""
    return rows.agg(*_counted())
