"""Structured Streaming wiring: raw messages in, three outputs and the keyed table out.

Each micro-batch goes through the same chain as a batch does. Its outputs are written under the batch's number, so a
batch that runs again after a failure overwrites what it wrote; the table is written last and takes a batch once. After
retries a batch that still fails is taken back from the outputs and goes to the dead letters as a whole, with a failure in
the audit log. So each message ends up in one place, and there once; readers of a batch's folder may see it rewritten.
A message that is delivered again within a stated time is not processed again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from milldam.config import EngineConfig
from milldam.operators import mapping, routing, store

MESSAGES = "message_id string, source string, format string, payload string, gateway_ingested_at timestamp, parent_message_id string, station_sequence int, total_stations int, injection struct<type:string,metadata:map<string,string>>"


def read_messages(spark: SparkSession, path: str, config: EngineConfig = EngineConfig()) -> DataFrame:
    """JSON lines of raw messages; maxFilesPerTrigger bounds what is in flight."""
    return spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", config.files_per_trigger).json(path)


def with_retries(action: Callable[[], None], config: EngineConfig, sleep: Callable[[float], None] = time.sleep) -> Exception | None:
    """The last failure after all attempts, or None; waits double from the base."""
    error: Exception | None = None
    for attempt in range(config.sink_retries):
        try:
            action()
            return None
        except Exception as e:  # noqa: BLE001 - whatever the sink raises counts as a failed attempt
            error = e
            if attempt + 1 < config.sink_retries:
                sleep(config.sink_base_ms * 2**attempt / 1000)
    return error


def once_each(messages: DataFrame, config: EngineConfig) -> DataFrame:
    """Leaves out messages that are delivered again, in a later batch or the same, within config.redelivery. The ids seen in that time are
    the stream's state. Messages without an id are all kept."""
    keyed = messages.withColumns({"_arrived": F.current_timestamp(), "_key": F.coalesce(F.nullif("message_id", F.lit("")), F.expr("uuid()"))})
    return keyed.withWatermark("_arrived", config.redelivery).dropDuplicatesWithinWatermark(["_key"]).drop("_arrived", "_key")


def process_batch(batch: DataFrame, batch_id: int, out: str, config: EngineConfig, fail: Callable[[str, int], None] | None = None, client: Callable | None = None) -> None:
    """Routes a batch and writes its outputs. By model, the rules that stand after a batch are a state under its number: the next one
    looks them up, and one that is taken back leaves none."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    now = F.lit(datetime.now(UTC))
    batch = batch.withColumn("normalizer_started_at", now).persist()
    learnt = store.FileTable(spark, f"{out}/rules")
    table = store.KeyedTable(spark, f"{out}/stations", folders=config.table_folders)

    def reached(step: str) -> None:
        if fail:
            fail(step, batch_id)

    def write(df: DataFrame, name: str) -> None:
        reached(name)
        df.write.mode("overwrite").json(f"{out}/{name}/batch={batch_id}")

    def remove(name: str) -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{name}/batch={batch_id}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def attempt() -> None:
        reached("route")
        found = routing.normalised(batch, config=config, rules=learnt.read() if config.mode == "LLM" else None, client=client)
        rows = found["rows"].persist()
        seen = Observation()
        routed = routing.outputs(rows.withColumn("normalizer_completed_at", F.current_timestamp()), batch, config, seen)
        accepted = routed["accepted"].persist()
        try:
            write(accepted, "normalized")
            write(routed["rejected"].withColumn("rejected_at", now), "rejected")
            write(routed["dead"], "dead_letter")
            write(spark.createDataFrame([seen.get]), "counters")
            write(store.audit_success(accepted, batch_id, now), "audit")
            if "rules" in found:
                reached("rules")
                learnt.write(found["rules"], batch_id)
            place = F.concat_ws("/", F.col("message_id").cast("string"), F.lpad(F.col("ordinal").cast("string"), 10, "0"))
            reached("stations")
            table.upsert(mapping.rename_to_table(accepted, place.alias("_order")), "_order", now, batch_id)  # last: what comes before can be taken back
        finally:
            accepted.unpersist()
            rows.unpersist()

    error = with_retries(attempt, config)
    if error is not None:
        for name in ("normalized", "rejected", "counters"):
            remove(name)
        learnt.take_back(batch_id)
        write(batch.withColumn("dead", F.lit("batch_failed")), "dead_letter")
        failed = batch.select("message_id", F.col("source").alias("source_system"), F.lit(None).cast("string").alias("raw_id"), F.lit(None).cast("string").alias("station_id"))
        write(store.audit_failure(failed, batch_id, "persist", str(error), now), "audit")
    batch.unpersist()


def start(messages: DataFrame, out: str, checkpoint: str, config: EngineConfig = EngineConfig(), fail: Callable[[str, int], None] | None = None, client: Callable | None = None, **trigger) -> StreamingQuery:
    """Runs until stopped, or with availableNow=True until the input is used up."""
    return (
        once_each(messages, config)
        .writeStream.foreachBatch(lambda b, i: process_batch(b, i, out, config, fail, client))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{config.trigger_ms} milliseconds"}))
        .start()
    )
