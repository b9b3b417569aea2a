"""Rule-based mapping: from a record's fields to the canonical columns, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milldam.dims import CANONICAL, REGISTRY, MappingSpec
from milldam.functions import clean


#: Columns that one step of generated code makes.
AT_ONCE = 3


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once: later expressions use their values, as the optimiser does not merge
    projections through the generator. Deeply nested expressions would outgrow generated code otherwise, and a method of over
    8,000 bytes is never compiled by the JVM: a few columns go at a time."""
    kept = [c for c in df.columns if c not in columns]
    names, out, place = list(columns), df, {}
    for i in range(0, len(names), AT_ONCE):
        part = names[i : i + AT_ONCE]
        out = out.select("*", F.explode(F.array(F.struct(*[columns[k].alias(k) for k in part]))).alias(f"_settled{i}"))
        place |= {k: F.col(f"_settled{i}.{k}").alias(k) for k in part}
    return out.select(*kept, *place.values())


def first_given(fields: Column, truthy: Column, names: tuple[str, ...]) -> Column:
    """The first name with a given value; if none has one, whatever the last name holds."""
    return F.coalesce(*[truthy[n] for n in names], fields[names[-1]])


def mapped(df: DataFrame) -> DataFrame:
    """Adds the raw value of each canonical field, by the source's specification."""
    out = {}
    for target in CANONICAL:
        value = F.lit(None).cast("string")
        for spec in REGISTRY.values():
            value = F.when(F.col("source") == spec.source, first_given(F.col("fields"), F.col("truthy"), spec.fields[target])).otherwise(value)
        out[f"in_{target}"] = value
    return settled(df, out)


def cleaned(df: DataFrame) -> DataFrame:
    """Canonical columns from the raw values: cleaned as the schema wants them, without checks."""
    df = settled(df, {f"in_{t}": clean.opt_string(F.col(f"in_{t}")) for t in CANONICAL})
    raw = lambda t: F.col(f"in_{t}")
    columns = {
        "raw_id": raw("raw_id"),
        "station_id": clean.station_id(F.col("source"), raw("raw_id")),
        "name_given": F.coalesce(raw("name"), F.lit("")),
        "name": clean.collapse(raw("name")),
        "source_system": F.col("source"),
        "address": raw("address"),
        "city": F.upper(raw("city")),
        "province": F.upper(raw("province")),
        "postal_code": clean.clean_postal(raw("postal_code")),
        "latitude": clean.parse_float(raw("latitude")),
        "longitude": clean.parse_float(raw("longitude")),
        "phone": clean.clean_phone(raw("phone")),
        "email": raw("email"),
    }
    return settled(df, columns)


def supported(source: str, form: str) -> bool:
    spec: MappingSpec | None = REGISTRY.get(source)
    return spec is not None and form in spec.formats


def rename_to_table(df: DataFrame, *more: Column) -> DataFrame:
    """Canonical columns under the stored table's names, with geometry and the overflow as JSON, and more columns if named."""
    return df.select(
        F.col("source_system").alias("fuente_origen"),
        F.col("station_id").alias("id_en_fuente"),
        F.col("name").alias("nombre"),
        F.col("latitude").alias("latitud"),
        F.col("longitude").alias("longitud"),
        clean.point(F.col("latitude"), F.col("longitude")).alias("location"),
        F.col("phone").alias("telefono"),
        F.col("email").alias("email"),
        F.col("address").alias("direccion"),
        F.col("postal_code").alias("codigo_postal"),
        overflow(df).alias("datos_extra"),
        *more,
    )


def overflow(df: DataFrame, extra: Column | None = None) -> Column:
    """What has no column of its own: a snapshot, when it was made, and the rest; nulls are left out. The keys of extra, a map of texts, come
    in the place of what stands under them."""
    names = [c for c in ("station_id", "name", "source_system", "address", "city", "province", "postal_code", "latitude", "longitude", "phone", "email", "raw_id") if c in df.columns]
    given = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    when = [F.col("normalized_at").cast("string").alias("normalized_at")] if "normalized_at" in df.columns else []
    whole = F.to_json(F.struct(F.struct(*names).alias("normalized_snapshot"), *when, given("city"), given("province"), given("raw_id")))
    if extra is None:
        return whole
    more = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(F.from_json(whole, "map<string,variant>"), lambda k, v: ~F.map_contains_key(more, k))
    return F.to_json(F.map_concat(kept, F.transform_values(more, lambda k, v: v.cast("variant"))))


def unmapped(df: DataFrame) -> Column:
    keep = [c for c in ("city", "province", "raw_id", "normalized_at") if c in df.columns]
    return F.struct(*keep)
