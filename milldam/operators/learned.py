"""Learned mapping rules: a small table with one active rule for each source and type of province, and a model client
that is called for batches without a rule."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milldam.config import EngineConfig
from milldam.dims import CANONICAL
from milldam.durable import durable
from milldam.operators import checks, mapping
from milldam.operators.fuzzy import best_match

RULE = "source_system string, province_type string, field_mapping map<string,string>, llm_model string, llm_prompt_version string, confidence_score double, sample_schema_signature string, is_active boolean, generated_at timestamp, updated_at timestamp"
TEXTS = T.MapType(T.StringType(), T.StringType())
REQUIRED = ("raw_id", "name")
#: Active rules that are looked up by a broadcast; of more, by a join.
BROADCAST = 1 << 16
MODEL_ERRORS = ("llm_timeout", "llm_rate_limited", "llm_http_error", "llm_invalid_json", "llm_missing_api_key", "llm_unexpected_error")


def province_type(record: Column) -> Column:
    """Of a JSON record: its province in lower case, or 'unknown'."""
    names = [F.get_json_object(record, f"$.{n}") for n in ("province", "provincia", "PROVINCIA")]
    found = F.coalesce(*[F.nullif(n, F.lit("")) for n in names])
    return F.coalesce(F.nullif(F.lower(F.trim(found)), F.lit("")), F.lit("unknown"))


def batch_keys(df: DataFrame, scope: str = "message_id", order: str = "ordinal", record: str = "raw_fragment") -> DataFrame:
    """The key of each batch, from its first record."""
    return df.groupBy(scope, "source").agg(F.min_by(province_type(F.col(record)), order).alias("province_type"))


def lookup(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the active rule of each batch's key (null: none)."""
    active = rules.where("is_active").select(F.col("source_system").alias("source"), "province_type", "field_mapping")
    if active.limit(BROADCAST + 1).count() <= BROADCAST:
        active = F.broadcast(active)
    return keys.join(active, ["source", "province_type"], "left")


def apply_rule(record: Column, rule: Column) -> Column:
    """A JSON record's fields under the rule's target names; id and name fall back to where they stand. Null if it is no object."""
    fields = F.from_json(record, "map<string,string>")
    hits = F.map_filter(rule, lambda k, v: F.map_contains_key(fields, k))
    # of several names for one target the last of the rule wins
    targets = F.array_distinct(F.map_values(hits))
    renamed = F.map_from_entries(F.transform(targets, lambda t: F.struct(t, F.element_at(F.filter(F.transform(F.map_entries(hits), lambda e: F.struct(e.value.alias("t"), fields[e.key].alias("v"))), lambda e: e.t == t), -1).v)))
    given = lambda a, b: F.coalesce(F.nullif(fields[a], F.lit("")), fields[b])
    more = F.array_compact(
        F.array(
            F.when(~F.map_contains_key(renamed, "raw_id") & F.map_contains_key(fields, "raw_id"), F.struct(F.lit("raw_id").alias("k"), given("raw_id", "id").alias("v"))),
            F.when(~F.map_contains_key(renamed, "name") & F.map_contains_key(fields, "name"), F.struct(F.lit("name").alias("k"), given("name", "nombre").alias("v"))),
        )
    )
    return F.when(fields.isNotNull(), F.map_concat(renamed, F.map_from_entries(more)))


def learn(records: list[dict], outputs: list[dict]) -> dict[str, str]:
    """Source name to target name, where a model's outputs repeat the records' values in most rows; identity for the rest of the outputs' names."""
    counted: dict[tuple, int] = {}
    for record, output in zip(records, outputs, strict=False):
        for target, value in output.items():
            for name, x in record.items():
                if x == value and x not in (None, ""):
                    counted[target, name] = counted.get((target, name), 0) + 1
    targets = list(dict.fromkeys(t for output in outputs for t in output)) if records else []
    return settled_rule(targets, [(*k, n) for k, n in counted.items()])


def signature(record: Column) -> Column:
    """The first 16 hexadecimal digits of SHA-256 over the sorted list of a record's keys."""
    return signature_of(F.json_object_keys(record))


def signature_of(keys: Column) -> Column:
    listed = F.concat(F.lit('["'), F.array_join(F.sort_array(keys), '", "'), F.lit('"]'))
    return F.left(F.sha2(F.when(F.size(keys) == 0, F.lit("[]")).otherwise(listed), 256), F.lit(16))


def upsert_rules(rules: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Rules of the new ones' keys become inactive; of several new ones with a key the latest is active."""
    now = F.current_timestamp() if now is None else now
    keys = new.select("source_system", "province_type").distinct().withColumn("_new", F.lit(True))
    old = rules.join(keys, ["source_system", "province_type"], "left")
    closes = F.coalesce("_new", F.lit(False)) & F.col("is_active")
    old = old.withColumns({"updated_at": F.when(closes, now).otherwise(F.col("updated_at")), "is_active": F.col("is_active") & ~closes}).drop("_new")
    latest = Window.partitionBy("source_system", "province_type").orderBy(F.desc("generated_at"))
    fresh = new.withColumn("_n", F.row_number().over(latest)).withColumn("is_active", F.col("_n") == 1).drop("_n")
    return old.unionByName(fresh, allowMissingColumns=True)


def invalidate(rules: DataFrame, source: str, province: str | None = None, now: Column | None = None) -> tuple[DataFrame, int]:
    """Deactivates a source's rules (of one type of province); also how many were active."""
    hit = (F.col("source_system") == source) & F.col("is_active")
    if province is not None:
        hit &= F.col("province_type") == province
    n = rules.where(hit).count()
    stamp = F.current_timestamp() if now is None else now
    return rules.withColumns({"updated_at": F.when(hit, stamp).otherwise(F.col("updated_at")), "is_active": F.col("is_active") & ~hit}), n


def listing(rules: DataFrame, source: str | None = None, active_only: bool = True) -> DataFrame:
    out = rules.where("is_active") if active_only else rules
    return out.where(F.col("source_system") == source) if source else out


def strict_array(x: Column) -> Column:
    """Whether a model's answer is a JSON array of objects and nothing else."""
    parsed = F.from_json(x, "array<variant>")
    objects = F.forall(parsed, lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
    return F.coalesce(F.ltrim(x).startswith("[") & F.rtrim(x).endswith("]") & F.try_parse_json(x).isNotNull() & objects, F.lit(False))


class ModelError(Exception):
    def __init__(self, reason: str):
        super().__init__(reason)
        self.reason = reason if reason in MODEL_ERRORS else "llm_unexpected_error"


def stub_client(records: list[str]) -> list[dict]:
    """A client for tests, no model: fields by their best matching names."""
    out = []
    for text in records:
        try:
            record = json.loads(text)
        except ValueError as e:
            raise ModelError("llm_invalid_json") from e
        if not isinstance(record, dict):
            raise ModelError("llm_invalid_json")
        out.append({t: record[k] for t, k in _picked(tuple(record)).items()})
    return out


@lru_cache(1 << 10)
def _picked(names: tuple[str, ...]) -> dict[str, str]:
    """The best matching name of each target; a feed has few lists of names."""
    return best_match(list(names))[1]


def call_model(df: DataFrame, client: Callable[[list[str]], list[dict]] = stub_client, config: EngineConfig = EngineConfig(), record: str = "raw_fragment", pause: Callable[[float], None] | None = None, asked: str | None = None) -> DataFrame:
    """Adds fields and truthy from the client's answers, and model_error. Records go to it in small batches of one source; with a
    pause, from config.model_callers tasks, which share the rate limit. A call of any client but the stub may take
    config.model_timeout_s. Where a batch cannot be answered for what it holds, its records are asked for one by one.
    asked: a column that says which rows are asked for, the others keep their fields."""
    import pandas as pd

    schema = df.drop("fields", "truthy").schema.add("fields", TEXTS).add("truthy", TEXTS).add("model_error", "string").add("llm_inference_start", "timestamp").add("llm_inference_end", "timestamp").add("llm_inference_ms", "double")
    names = [c for c in df.columns if c not in ("fields", "truthy")]

    def call(part: list[str]) -> list[dict]:
        if config.model_provider == "stub":
            return client(part)
        from concurrent.futures import ThreadPoolExecutor
        from concurrent.futures import TimeoutError as Late

        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(client, part).result(config.model_timeout_s)
        except Late as e:
            raise ModelError("llm_timeout") from e
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    def answered(part: list[str]) -> tuple[list, list]:
        """Fields and errors of one batch."""
        try:
            answers = call(part)
            if len(answers) != len(part):
                singles = [call([x]) for x in part] if len(part) > 1 else [[]]
                answers = [a[0] if len(a) == 1 else None for a in singles]
            fields = [a and {k: None if v is None else str(v) for k, v in a.items()} for a in answers]
            return fields, ["llm_transform_failed" if a is None else None for a in answers]
        except ModelError as e:
            if e.reason in ("llm_invalid_json", "llm_unexpected_error") and len(part) > 1:
                return one_by_one(part)
            return [None] * len(part), [e.reason] * len(part)
        except Exception:  # noqa: BLE001 - a client may raise anything
            if len(part) > 1:
                return one_by_one(part)
            return [None] * len(part), ["llm_unexpected_error"] * len(part)

    def one_by_one(part: list[str]) -> tuple[list, list]:
        found = [answered([x]) for x in part]
        return [f[0] for f, _ in found], [e[0] for _, e in found]

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            fields, errors, began, ended = ([None] * len(pdf) for _ in range(4))
            if "fields" in pdf:
                fields = [f if f is None else dict(f) for f in pdf["fields"]]
            open_ = [i for i in range(len(pdf)) if pd.notna(pdf["ordinal"].iloc[i]) and (asked is None or bool(pdf[asked].iloc[i]))] if "ordinal" in pdf else list(range(len(pdf)))
            for _, places in pd.Series(open_, dtype=int).groupby(pdf["source"].iloc[open_].tolist() if open_ else [], sort=False):
                for k in range(0, len(places), config.model_batch):
                    at = places.iloc[k : k + config.model_batch].tolist()
                    start = datetime.now(UTC)
                    for i, f, e in zip(at, *answered([pdf[record].iloc[i] for i in at]), strict=True):
                        fields[i], errors[i], began[i] = f, e, start
                    for i in at:
                        ended[i] = datetime.now(UTC)
                    if pause:
                        pause(config.model_callers * config.model_min_delay_ms / 1000)
            pdf = pdf[names].copy()
            pdf["fields"] = fields
            pdf["truthy"] = [f and {k: v for k, v in f.items() if v} for f in fields]
            pdf["model_error"] = errors
            pdf["llm_inference_start"], pdf["llm_inference_end"] = pd.Series(began, index=pdf.index, dtype="datetime64[us, UTC]"), pd.Series(ended, index=pdf.index, dtype="datetime64[us, UTC]")
            pdf["llm_inference_ms"] = (pdf["llm_inference_end"] - pdf["llm_inference_start"]).dt.total_seconds() * 1000
            yield pdf

    return (df.repartition(config.model_callers) if pause else df).mapInPandas(run, schema)


def by_rule(df: DataFrame, rules: DataFrame, scope: str = "message_id", order: str = "ordinal") -> DataFrame:
    """Adds each batch's type of province and rule and, where there is one, the fields that it gives."""
    first = F.min_by(province_type(F.col("raw_fragment")), order).over(Window.partitionBy(scope))
    out = lookup(df.drop("fields", "truthy").withColumn("province_type", F.coalesce(first, F.lit("unknown"))), rules)
    return out.withColumn("fields", F.when(F.col("field_mapping").isNotNull(), apply_rule(F.col("raw_fragment"), F.col("field_mapping"))))


def build(df: DataFrame) -> DataFrame:
    """Canonical raw values from mapped fields: raw_id or id, and the other targets by name."""
    value = lambda t: F.coalesce(F.nullif(F.col("fields")["raw_id"], F.lit("")), F.col("fields")["id"]) if t == "raw_id" else F.col("fields")[t]
    return mapping.settled(df, {f"in_{t}": value(t) for t in CANONICAL})


def votes(answered: DataFrame) -> DataFrame:
    """(source_system, province_type, target, name, n): in how many records the model's answer for a target repeats the value of a name;
    blank values do not count. Names that hold one value in a record share its vote in turn, by their place."""
    names = F.map_entries(F.from_json("raw_fragment", "map<string,string>"))
    same = lambda t: F.transform(F.filter(names, lambda e: F.trim(e.value) == F.trim(t.value)), lambda e: F.struct(t.key.alias("target"), e.key.alias("name")))
    given = F.filter(F.map_entries("fields"), lambda t: F.coalesce(F.trim(t.value), F.lit("")) != "")
    pairs = F.flatten(F.transform(given, same))
    rows = answered.select(F.col("source").alias("source_system"), "province_type", F.explode(pairs).alias("p"))
    return rows.groupBy("source_system", "province_type", F.col("p.target").alias("target"), F.col("p.name").alias("name")).agg(F.count("*").alias("n"))


def settled_rule(targets: list[str], counted: list[tuple[str, str, int]]) -> dict[str, str]:
    """A rule (name to target) from votes (target, name, n): the pair with most votes is taken first, and a name or a target once (ties: targets in
    the answers' order, then by name). Targets without a name stand for themselves."""
    place = {t: i for i, t in enumerate(targets)}
    rule: dict[str, str] = {}
    for target, name, _ in sorted(counted, key=lambda v: (-v[2], place.get(v[0], len(place)), v[1])):
        if name not in rule and target not in rule.values():
            rule[name] = target
    return rule | {t: t for t in targets if t not in rule.values() and t not in rule}


def learned_rules(answered: DataFrame, config: EngineConfig, now: Column) -> DataFrame:
    """A rule for each source and type of province that the model was asked for, from all its records and answers. There is none where no record shows
    a name for a required field: the model is asked again."""
    good = answered.where("asked and model_error is null and fields is not null")
    keys = ["source_system", "province_type"]
    targets = good.groupBy(F.col("source").alias("source_system"), "province_type").agg(F.min_by(F.map_keys("fields"), F.struct("message_id", "ordinal")).alias("targets"))
    counted = votes(good).groupBy(*keys).agg(F.collect_list(F.struct("target", "name", "n")).alias("votes"))
    provider = config.model_provider

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = []
            for source, kind, found, listed in zip(*(pdf[c] for c in (*keys, "targets", "votes")), strict=True):
                shown = [(v["target"], v["name"], v["n"]) for v in listed]
                if all(any(t == required for t, _, _ in shown) for required in REQUIRED):
                    rows.append((source, kind, settled_rule(list(found), shown), provider, "1.0", 0.95, hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()[:16], True))
            yield pd.DataFrame(rows, columns=[*keys, "field_mapping", "llm_model", "llm_prompt_version", "confidence_score", "sample_schema_signature", "is_active"])

    return targets.join(counted, keys).mapInPandas(run, RULE.split(", generated_at")[0]).withColumns({"generated_at": now, "updated_at": now})


def transformed(fanned: DataFrame, rules: DataFrame | None = None, client: Callable[[list[str]], list[dict]] = stub_client, config: EngineConfig = EngineConfig(mode="LLM"), now: Column | None = None, pause: Callable[[float], None] | None = None) -> dict[str, DataFrame]:
    """The whole way of a batch by model: rows with their reason of rejection, the rules after it, and its metrics.

    Batches with an active rule for their source and type of province are mapped by it; the model is asked for the others, and
    a rule is learned from what it gives. The answers are written down, so that each record is asked for once.
    """
    spark = fanned.sparkSession
    now = F.current_timestamp() if now is None else now
    if pause is None and config.model_provider != "stub":
        pause = time.sleep
    none = spark.createDataFrame([], RULE)
    rules = none if rules is None else none.unionByName(rules, allowMissingColumns=True)
    ruled = by_rule(fanned, rules).withColumn("asked", F.col("field_mapping").isNull() & F.col("ordinal").isNotNull())
    answered = durable(call_model(ruled, client, config, pause=pause, asked="asked"))
    cleaned = mapping.cleaned(build(answered))
    rows = checks.checked(cleaned, "llm_pydantic_validation_error")
    blank = F.coalesce(F.col("name_given"), F.lit("")) == ""
    reason = F.when(F.col("model_error").isNotNull(), F.col("model_error")).when(F.col("raw_id").isNull(), "missing_raw_id").when(blank, "missing_name").otherwise(F.col("reason"))
    rows = rows.withColumn("reason", reason)
    metrics = rows.where("ordinal is not null").groupBy("message_id").agg(F.max("asked").alias("asked"), F.max("model_error").alias("error"), F.count_if(F.col("reason") == "llm_pydantic_validation_error").alias("bad")).agg(
        F.count_if(~F.col("asked")).alias("llm_rule_cache_hit"), F.count_if("asked").alias("llm_rule_cache_miss"), F.count_if(F.col("asked") & F.col("error").isNull()).alias("llm_rule_generation_calls"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("llm_pydantic_validation_errors"), F.max("error").alias("llm_last_error_reason"),
    )
    return {"rows": rows.drop("asked", "field_mapping"), "rules": upsert_rules(rules, learned_rules(answered, config, now), now), "metrics": metrics}
