"""Synthetic stations: valid ones, ones with one of ten errors, mixtures, and their payloads."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milldam.config import SOURCES, bounded
from milldam.dims import CANONICAL, REGISTRY, province_dim

# The provinces of each source's region.
REGIONS = {
    "catalunya": ("BARCELONA", "GIRONA", "LLEIDA", "TARRAGONA"),
    "valencia": ("ALICANTE", "CASTELLÓN", "VALENCIA"),
    "galicia": ("LA CORUÑA", "LUGO", "OURENSE", "PONTEVEDRA"),
}
#: Towns of a province are numbered.
TOWNS = 3
# Errors that valid batches may get, and those of invalid batches.
INJECTED = ("invalid_coordinates", "missing_field", "duplicate", "malformed_phone")
ERRORS = ("invalid_postal_code", "invalid_province", "coordinates_outside_spain", "coordinates_outside_province", "invalid_email", "missing_contact_fields", "oversized_name", "undersized_station_id", "malformed_coordinates", "invalid_city_not_in_province")


def _pick(seed: int, salt: str, n: int | Column) -> Column:
    """A repeatable choice for each row, whatever the partitions."""
    return F.pmod(F.xxhash64(F.col("index"), F.col("source"), F.lit(seed), F.lit(salt)), F.lit(n) if isinstance(n, int) else n)


def _share(seed: int, salt: str) -> Column:
    return _pick(seed, salt, 1_000_003) / 1_000_003.0


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _rows(spark: SparkSession, source: str | None, count: int) -> DataFrame:
    base = spark.range(count).withColumn("index", F.col("id"))
    return base.withColumn("source", F.lit(source) if source else _array(SOURCES)[(F.col("id") % len(SOURCES)).cast("int")]).drop("id")


def _base(df: DataFrame, seed: int) -> DataFrame:
    province = F.lit(None).cast("string")
    for source, names in REGIONS.items():
        province = F.when(F.col("source") == source, _array(names)[_pick(seed, "province", len(names)).cast("int")]).otherwise(province)
    df = df.withColumn("province", province)
    city = F.concat(F.initcap("province"), F.lit(" "), (_pick(seed, "city", TOWNS) + 1).cast("string"))
    df = df.withColumn("city", city)
    dim = F.broadcast(province_dim(df.sparkSession).select("province", "postal_prefix", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in zip(("lat_min", "lat_max", "lon_min", "lon_max"), (42.3, 43.7, -9.2, -7.7), strict=True)]))
    df = df.join(dim, "province")
    prefix = F.upper(F.left("source", F.lit(3)))
    number = F.lpad(F.col("index").cast("string"), 6, "0")
    return df.withColumns(
        {
            "raw_id": F.concat(prefix, F.lit("-"), number),
            "name": F.concat(F.lit("ITV "), F.col("city"), F.lit(" - "), number),
            "address": F.concat(F.lit("Calle Mayor "), F.col("index").cast("string")),
            "postal_code": F.concat("postal_prefix", F.lpad(_pick(seed, "postal", 1000).cast("string"), 3, "0")),
            "latitude": F.round(F.col("lat_min") + _share(seed, "lat") * (F.col("lat_max") - F.col("lat_min")), 4),
            "longitude": F.round(F.col("lon_min") + _share(seed, "lon") * (F.col("lon_max") - F.col("lon_min")), 4),
            "phone": F.concat(F.lit("9"), F.lpad(F.col("index").cast("string"), 8, "0")),
            "email": F.concat(F.lit("itv"), F.col("index").cast("string"), F.lit("@example.org")),
        }
    )


def _out(df: DataFrame, error: Column) -> DataFrame:
    return df.select("source", "index", *[F.col(c).cast("double" if c in ("latitude", "longitude") else "string").alias(c) for c in CANONICAL], error.alias("error_type"))


#: Stations that one call makes at most.
MOST = 10_000


def valid(spark: SparkSession, count: int, source: str | None = None, seed: int = 0, error_rate: float = 0.0, errors: tuple[str, ...] = INJECTED) -> DataFrame:
    """Stations that pass all checks, except for a share with an injected error."""
    bounded("count", count, 0, MOST)
    bounded("error_rate", error_rate, 0, 1)
    if set(errors) - set(INJECTED):
        raise ValueError(f"errors must be among {INJECTED}")
    df = _base(_rows(spark, source, count), seed)
    error = F.when(_share(seed, "error") < error_rate, _array(errors)[_pick(seed, "kind", max(1, len(errors))).cast("int")]) if errors else F.lit(None).cast("string")
    df = df.withColumn("_e", error)
    is_ = lambda k: F.coalesce(F.col("_e") == k, F.lit(False))
    df = df.withColumns(
        {
            "latitude": F.when(is_("invalid_coordinates"), 91.0).otherwise(F.col("latitude")),
            "name": F.when(is_("missing_field"), F.lit(None)).otherwise(F.col("name")),
            "raw_id": F.when(is_("duplicate"), F.concat(F.upper(F.left("source", F.lit(3))), F.lit("-000000"))).otherwise(F.col("raw_id")),
            "phone": F.when(is_("malformed_phone"), F.lit("INVALID-PHONE")).otherwise(F.col("phone")),
        }
    )
    return _out(df, F.col("_e"))


def invalid(spark: SparkSession, count: int, source: str | None = None, seed: int = 0, errors: tuple[str, ...] = ERRORS) -> DataFrame:
    """Stations with one error each, the errors in turn."""
    bounded("count", count, 0, MOST)
    if not errors or set(errors) - set(ERRORS):
        raise ValueError(f"errors must be among {ERRORS}")
    df = _base(_rows(spark, source, count), seed).withColumn("_e", _array(errors)[(F.col("index") % len(errors)).cast("int")])
    is_ = lambda k: F.col("_e") == k
    gone = lambda c: F.when(is_("missing_contact_fields"), F.lit(None)).otherwise(F.col(c))
    nan = F.lit(float("nan"))
    swap = {p: names[(i + 1) % len(names)] for names in REGIONS.values() for i, p in enumerate(names)}
    other = F.create_map(*[F.lit(x) for pair in swap.items() for x in pair])[F.col("province")]
    df = df.withColumns(
        {
            "postal_code": F.when(is_("invalid_postal_code"), "99999").otherwise(gone("postal_code")),
            "province": F.when(is_("invalid_province"), "ATLANTIS").when(is_("invalid_city_not_in_province"), other).otherwise(gone("province")),
            "latitude": F.when(is_("coordinates_outside_spain"), 48.8566).when(is_("coordinates_outside_province"), 37.2).when(is_("malformed_coordinates"), nan).otherwise(F.col("latitude")),
            "longitude": F.when(is_("coordinates_outside_spain"), 2.3522).when(is_("coordinates_outside_province"), -5.9).when(is_("malformed_coordinates"), nan).otherwise(F.col("longitude")),
            "email": F.when(is_("invalid_email"), "user@@example.com").otherwise(gone("email")),
            "phone": gone("phone"),
            "address": gone("address"),
            "city": gone("city"),
            "name": F.when(is_("oversized_name"), F.repeat(F.lit("X"), F.lit(250))).otherwise(F.col("name")),
            "raw_id": F.when(is_("undersized_station_id"), "").otherwise(F.col("raw_id")),
        }
    )
    return _out(df, F.col("_e"))


def mixed_sizes(count: int, invalid_rate: float) -> tuple[int, int]:
    """ceil of the valid and floor of the invalid part, together the count."""
    bounded("invalid_rate", invalid_rate, 0, 1)
    good = min(count, math.ceil(round(count * (1 - invalid_rate), 9)))
    return good, count - good


def mixed(spark: SparkSession, count: int, invalid_rate: float, source: str | None = None, seed: int = 0) -> DataFrame:
    good, bad = mixed_sizes(count, invalid_rate)
    return valid(spark, good, source, seed).unionByName(invalid(spark, bad, source, seed + 1))


def source_record(df: DataFrame, source: str) -> Column:
    """Canonical columns under the source's own field names."""
    names = {t: n[0] for t, n in REGISTRY[source].fields.items()}
    return F.struct(*[F.col(t).alias(names[t]) for t in CANONICAL])


def payloads(df: DataFrame, per_message: int = 10) -> DataFrame:
    """Raw messages of a bounded number of stations each: XML for catalunya, JSON for valencia, CSV for galicia."""
    bounded("per_message", per_message, 1, 10_000)
    grouped = df.withColumn("message_id", F.concat_ws("-", "source", F.floor(F.col("index") / (per_message * len(SOURCES))).cast("string"))).groupBy("source", "message_id")
    order = lambda x: F.transform(F.array_sort(F.collect_list(F.struct("index", x.alias("x")))), lambda r: r.x)
    escaped = lambda c: F.replace(F.replace(F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    xml_names = {t: n[0] for t, n in REGISTRY["catalunya"].fields.items()}
    xml = F.concat(F.lit("<station>"), *[F.coalesce(F.concat(F.lit(f"<{n}>"), escaped(t), F.lit(f"</{n}>")), F.lit("")) for t, n in xml_names.items()], F.lit("</station>"))
    csv_names = {t: n[0] for t, n in REGISTRY["galicia"].fields.items()}
    quoted = lambda c: F.when(F.col(c).cast("string").rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
    csv = F.concat_ws(",", *[quoted(t) for t in csv_names])
    json = F.to_json(source_record(df, "valencia"))
    record = F.when(F.col("source") == "catalunya", xml).when(F.col("source") == "galicia", csv).otherwise(json)
    joined = grouped.agg(order(record).alias("r"))
    return joined.select(
        "message_id",
        "source",
        F.when(F.col("source") == "catalunya", "xml").when(F.col("source") == "galicia", "csv").otherwise("json").alias("format"),
        F.when(F.col("source") == "catalunya", F.concat(F.lit("<stations>"), F.array_join("r", ""), F.lit("</stations>")))
        .when(F.col("source") == "galicia", F.concat(F.lit(",".join(csv_names.values()) + "\n"), F.array_join("r", "\n")))
        .otherwise(F.concat(F.lit('{"estaciones":['), F.array_join("r", ","), F.lit("]}")))
        .alias("payload"),
    )


def load_plan(spark: SparkSession, requests: int = 100, invalid_rate: float = 0.2, seed: int = 0) -> DataFrame:
    """Requests in turn over the sources, a share of them invalid."""
    bounded("invalid_rate", invalid_rate, 0, 1)
    rows = _rows(spark, None, requests)
    return rows.withColumn("invalid", _share(seed, "load") < invalid_rate)
