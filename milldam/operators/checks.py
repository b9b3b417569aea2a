"""Validation: rules in order, of which the first that fires gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milldam.dims import SPAIN, province_dim
from milldam.functions.clean import opt_string, strip
from milldam.operators.mapping import settled

EMAIL = r"(?U)^[\w.-]+@[\w.-]+\.\w+$"


def given(x: Column) -> Column:
    return F.coalesce(opt_string(x).isNotNull(), F.lit(False))


def in_spain(lat: Column, lon: Column) -> Column:
    low, high, west, east = SPAIN
    return F.coalesce(lat.between(low, high) & lon.between(west, east), F.lit(False))


def schema_ok(d: dict[str, Column]) -> Column:
    """Lengths and ranges of the canonical schema; NaN is out of every range."""
    low, high, west, east = SPAIN
    short = lambda x, n: x.isNull() | (F.length(x) <= n)
    return (
        d["station_id"].isNotNull()
        & F.length(d["station_id"]).between(3, 50)
        & F.length(d["name_given"]).between(1, 200)
        & short(d["address"], 500)
        & short(d["city"], 100)
        & short(d["province"], 100)
        & short(d["phone"], 20)
        & short(d["email"], 100)
        & short(d["raw_id"], 100)
        & (d["latitude"].isNull() | d["latitude"].between(low, high))
        & (d["longitude"].isNull() | d["longitude"].between(west, east))
    )


def email_bad(x: Column) -> Column:
    return given(x) & ~strip(x).rlike(EMAIL)


def contact_ok(d: dict[str, Column]) -> Column:
    return (given(d["phone"]) | given(d["email"])) & given(d["address"]) & given(d["city"]) & given(d["province"]) & given(d["postal_code"])


def with_province(df: DataFrame) -> DataFrame:
    """Joins the province's figures (51 rows at most, broadcast) under names with a leading underscore."""
    dim = F.broadcast(province_dim(df.sparkSession).select(*[F.col(c).alias(f"_{c}") for c in ("province", "postal_prefix", "lat_min", "lat_max", "lon_min", "lon_max", "is_official")]))
    return df.join(dim, F.upper(strip(F.col("province"))) == F.col("_province"), "left")


def broken(d: dict[str, Column], schema_reason: str = "schema_validation_failed") -> dict[str, Column]:
    """Each reason, in order, with its rule, after with_province()."""
    lat, lon = d["latitude"], d["longitude"]
    boxed = F.when(F.col("_lat_min").isNotNull(), lat.between(F.col("_lat_min"), F.col("_lat_max")) & lon.between(F.col("_lon_min"), F.col("_lon_max"))).otherwise(in_spain(lat, lon))
    placed = (lat != 0) & (lon != 0) & given(d["province"])
    return {
        schema_reason: ~schema_ok(d),
        "invalid_email_format": email_bad(d["email"]),
        "invalid_province": given(d["province"]) & ~F.coalesce(F.col("_is_official"), F.lit(False)),
        "coordinates_outside_province_bounds": F.coalesce(placed, F.lit(False)) & ~boxed,
        "postal_code_mismatch_province": given(d["postal_code"]) & given(d["province"]) & F.col("_postal_prefix").isNotNull() & ~d["postal_code"].startswith(F.col("_postal_prefix")),
        "insufficient_contact_or_location": ~contact_ok(d),
    }


FIELDS = ("station_id", "name_given", "address", "city", "province", "phone", "email", "raw_id", "latitude", "longitude", "postal_code")


def checked(df: DataFrame, schema_reason: str = "schema_validation_failed") -> DataFrame:
    """Adds `reason`: of the record's type, its id, the schema, then the rules. Needs mapping.cleaned()'s columns."""
    is_object = F.col("is_object") if "is_object" in df.columns else F.lit(True)
    rules = broken({c: F.col(c) for c in FIELDS}, schema_reason)
    tested = settled(with_province(df), {f"_rule{i}": rule for i, rule in enumerate(rules.values())})
    full = F.when(~is_object, "invalid_station_payload_type").when(F.col("raw_id").isNull(), "missing_raw_id")
    for i, why in enumerate(rules):
        full = full.when(F.col(f"_rule{i}"), why)
    # settled: conditions and columns that name the reason do not repeat it
    return settled(tested, {"reason": full}).select(*df.columns, "reason")
