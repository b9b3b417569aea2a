"""Fuzzy mapping: field names are matched once for each distinct list of names, rows only look the result up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milldam.config import EngineConfig
from milldam.dims import ALIASES, CANONICAL
from milldam.durable import durable
from milldam.functions.similarity import field_name, jaro_winkler
from milldam.operators import checks, mapping

#: Lists of names that are looked up by a broadcast; a feed has few. More are joined.
LISTS = 1 << 14
TRACE = "struct<source_field:string,target_field:string,score:double,algorithm:string,candidates:array<struct<field:string,score:double>>>"
MATCH = f"keys array<string>, pick map<string,string>, low array<string>, scores array<double>, trace array<{TRACE}>"


def match_score(name: str, target: str) -> float:
    plain = field_name(name)
    return 1.0 if plain == target or plain in ALIASES[target] else jaro_winkler(plain, target)


def best_match(keys: list[str], config: EngineConfig = EngineConfig()) -> tuple:
    """For one list of names: the name for each target, targets of low confidence, accepted scores, and the trace."""
    pick, low, scores, trace = {}, [], [], []
    for target in CANONICAL:
        ranked = sorted(((match_score(k, target), k) for k in keys), key=lambda x: -x[0])  # stable: ties stay in order
        if not ranked:
            continue
        score, name = ranked[0]
        tops = [(k, round(s, 4)) for s, k in ranked[: config.fuzzy_top] if s > 0]
        trace.append((name, target, round(score, 4), "jaro_winkler", tops))
        if score >= config.fuzzy_low:
            pick[target] = name
            scores.append(score)
            if score < config.fuzzy_high:
                low.append(target)
    return list(keys), pick, low, scores, trace


def field_scores(df: DataFrame, name: str = "name") -> DataFrame:
    """(name, target, score) of each distinct field name with each canonical field."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame([(n, t, match_score(n, t)) for n in pdf[name] for t in CANONICAL], columns=["name", "target", "score"])

    return df.select(name).where(F.col(name).isNotNull()).distinct().mapInPandas(run, "name string, target string, score double")


def matches(df: DataFrame, config: EngineConfig = EngineConfig(), keys: str = "keys") -> DataFrame:
    """Distinct lists of names with their match. A list is as long as a record, and lists are few unless names are data."""
    lists = df.select(keys).where(F.col(keys).isNotNull()).distinct()

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame([best_match(list(k), config) for k in pdf[keys]], columns=["keys", "pick", "low", "scores", "trace"])

    return lists.mapInPandas(run, MATCH)


def mapped(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Adds the raw value of each canonical field by the best matching name, and low, scores, trace."""
    keyed = df.withColumn("keys", F.map_keys("fields"))
    found = durable(matches(keyed, config))
    if found.count() <= LISTS:
        found = F.broadcast(found)
    joined = keyed.join(found, "keys", "left")
    out = {f"in_{t}": F.col("fields")[F.col("pick")[t]] for t in CANONICAL}
    return mapping.settled(joined, out).drop("keys", "pick")


def checked(df: DataFrame) -> DataFrame:
    """Adds `reason` (missing required fields and schema failures are mapping failures) and `confidence`, the mean accepted score."""
    cleaned = mapping.cleaned(df)
    blank = cleaned["raw_id"].isNull() | (cleaned["name_given"] == "")
    out = checks.checked(cleaned, "fuzzy_mapping_failure")
    out = out.withColumn("reason", F.when(blank & F.col("is_object"), "fuzzy_mapping_failure").otherwise(F.col("reason")))
    mean = F.aggregate("scores", F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size("scores"), F.lit(0))
    return out.withColumns({"confidence": F.round(mean, 4), "missing": F.array_compact(F.array(F.when(F.col("raw_id").isNull(), "raw_id"), F.when(F.col("name_given") == "", "name")))})


def low_confidence_events(df: DataFrame) -> DataFrame:
    """Accepted stations with a field of low confidence: they stay accepted, and this event goes to the rejects."""
    return df.where(F.col("reason").isNull() & (F.size("low") > 0)).withColumn("reason", F.lit("fuzzy_low_confidence"))


def metrics(df: DataFrame) -> DataFrame:
    ok = F.col("reason").isNull()
    n, total = F.aggregate("scores", F.lit(0), lambda s, _: s + 1), F.aggregate("scores", F.lit(0.0), lambda s, x: s + x)
    return df.agg(
        F.round(F.sum(F.when(ok, total)) / F.sum(F.when(ok, n)), 4).alias("confidence_mean"),
        F.count_if(ok & (F.size("low") > 0)).alias("low_confidence_count"),
        F.count_if(F.col("reason") == "fuzzy_mapping_failure").alias("rejected_by_fuzzy_count"),
    )
