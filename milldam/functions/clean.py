"""Cleaning functions over columns. Blanks, digits and letters are meant in Unicode's sense."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"[\s\x1c-\x1f]"
_FLOAT = r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?(?:e[+-]?\d+(?:_\d+)*)?|\.\d+(?:_\d+)*(?:e[+-]?\d+(?:_\d+)*)?|inf(?:inity)?|nan)$"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def opt_string(x: Column) -> Column:
    """Stripped, empty to null."""
    return F.nullif(strip(x), F.lit(""))


def text_or(x: Column, default: str = "unknown") -> Column:
    return F.coalesce(opt_string(x), F.lit(default))


def station_id(source: Column, raw_id: Column) -> Column:
    return F.concat(F.upper(F.left(source, F.lit(3))), F.lit("_"), strip(raw_id))


def parse_float(x: Column) -> Column:
    """Decimal comma or point; what is no number is null. Infinity and NaN are numbers here."""
    plain = strip(F.replace(x, F.lit(","), F.lit(".")))
    number = F.regexp_replace(F.regexp_replace(plain, "_", ""), "(?i)^([+-]?)inf(?:inity)?$", "$1Infinity")
    return F.when(plain.rlike(_FLOAT), number.try_cast("double"))


def clean_phone(x: Column) -> Column:
    plain = F.nullif(F.translate(strip(x), " -.", ""), F.lit(""))
    return F.when(plain.startswith("+"), plain).when(plain.startswith("34"), F.concat(F.lit("+"), plain)).when(F.length(plain) == 9, F.concat(F.lit("+34"), plain)).otherwise(plain)


def clean_postal(x: Column) -> Column:
    """The digits, if they are five."""
    digits = F.regexp_replace(x, r"[^\p{Nd}]", "")
    return F.when(F.length(digits) == 5, digits)


def collapse(x: Column) -> Column:
    return F.regexp_replace(strip(x), rf"(?U){_BLANK}+", " ")


def upper_or_null(x: Column) -> Column:
    return F.upper(F.nullif(x, F.lit("")))


def clean_source(x: Column) -> Column:
    return strip(F.lower(x))


def parse_time(x: Column) -> Column:
    """ISO 8601 with Z or an offset; bad ones are null."""
    return F.try_to_timestamp(opt_string(x))


def minify(x: Column) -> Column:
    """JSON without blanks; other text with blanks collapsed, and those between tags left out."""
    json = F.to_json(F.try_parse_json(x))
    return F.coalesce(json, F.regexp_replace(collapse(x), r">\s+<", "><"))


def payload_kind(x: Column) -> Column:
    """What a payload is: none, dict, list, str or a scalar's type."""
    kind = F.schema_of_variant(F.try_parse_json(x))
    return (
        F.when(x.isNull() | (kind == "VOID"), "none")
        .when(kind.startswith("OBJECT"), "dict")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .when(kind.isNotNull() & (kind != "STRING"), "float")
        .otherwise("str")
    )


def point(lat: Column, lon: Column) -> Column:
    """x is the longitude, y the latitude, SRID 4326; null unless both are there."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.alias("x"), lat.alias("y"), F.lit(4326).alias("srid")))


def _little_endian(x: Column) -> Column:
    """A double's bits in hexadecimal, last byte first."""
    bits = F.when(x == 0, F.lit("0" * 16)).otherwise(F.lpad(F.hex(_bits(x)), 16, "0"))
    return F.array_join(F.reverse(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substr(bits, i * 2 + 1, F.lit(2)))), "")


def _bits(x: Column) -> Column:
    """The IEEE 754 pattern of a normal double, as a long."""
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    exponent = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(1 << 52))).cast("long")
    return F.shiftleft((exponent + 1023 + F.when(x < 0, 2048).otherwise(0)).cast("long"), 52).bitwiseOR(fraction)


def wkb_point(lat: Column, lon: Column) -> Column:
    """Well-known binary, little endian, with the SRID."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.unhex(F.concat(F.lit("0101000020E6100000"), _little_endian(lon), _little_endian(lat))))
