"""Payload scans and fan-out: from raw messages to one row for each station record.

Raw messages: message_id, source, format, payload. All parsing is done by built-in functions; the one dialect
that they lack, CSV records with line breaks in quotes, is cut by a regular expression before from_csv's rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milldam.config import FORMATS, EngineConfig, bounded
from milldam.dims import REGISTRY
from milldam.functions.clean import clean_source
from milldam.operators.ranks import numbered_by

# Media types and the formats that they stand for.
MEDIA_TYPES = {
    "application/json": "json",
    "text/json": "json",
    "text/xml": "xml",
    "application/xml": "xml",
    "text/csv": "csv",
    "text/plain": "csv",
}
XML_FIELDS = ("id", "nom", "adreca", "ciutat", "provincia", "codi_postal", "latitud", "longitud", "telefon", "email")
#: An XML payload's root: its tag, attributes and content.
ROOT = r"(?s)^\s*(?:<\?xml[^>]*\?>\s*)?(?:<!DOCTYPE[^>]*>\s*)?(?:<!--.*?-->\s*)*<([^\s/>!?]+)([^>]*?)(?:/>|>(.*)</\1\s*>)\s*(?:<!--.*?-->\s*)*$"
TEXTS, TYPES = "map<string,string>", "map<string,variant>"


def media_format(x: Column) -> Column:
    known = F.create_map(*[F.lit(v) for pair in MEDIA_TYPES.items() for v in pair])
    return known[F.lower(F.trim(F.substring_index(x, ";", 1)))]


# File name endings and their media types.
ENDINGS = {"json": "application/json", "xml": "application/xml", "csv": "text/csv", "txt": "text/plain"}


def scan_files(spark: SparkSession, path: str, media_type: str | None = None, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Whole files as payloads, with the reason why one is refused (null: it is fine). Files without a byte are not read, and of too large ones
    only the name. Without a media type each file's ending tells it."""
    files = spark.read.format("binaryFile").load(path)
    endings = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])
    media = F.lit(media_type) if media_type is not None else endings[F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))]
    kind = media_format(media)
    large = files.where(F.col("length") > config.max_file_bytes).select("path", kind.alias("format"), F.lit(None).cast("string").alias("payload"), F.when(kind.isNull(), "unsupported_media_type").otherwise("file_too_large").alias("refused"))
    text = F.try_validate_utf8(F.col("content").cast("string"))
    sane = (
        F.when(kind == "json", F.try_parse_json(text).isNotNull())
        .when(kind == "xml", F.ltrim(text).startswith("<"))
        .when(kind == "csv", F.size(F.split(F.trim(text), "\r?\n")) >= 2)
    )
    refused = F.when(kind.isNull(), "unsupported_media_type").when(text.isNull(), "not_utf8").when(~sane, "malformed_file")
    return files.where(F.col("length") <= config.max_file_bytes).select("path", kind.alias("format"), text.alias("payload"), refused.alias("refused")).union(large)


def decode_envelopes(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages with a header and base64 raw content, as raw messages."""
    header = lambda k: F.get_json_object(value, f"$.header.{k}")
    return df.select(
        header("message_id").alias("message_id"),
        clean_source(header("source")).alias("source"),
        F.lower(header("format")).alias("format"),
        F.try_validate_utf8(F.expr(f"try_to_binary(get_json_object({value}, '$.payload.raw_content'), 'base64')").cast("string")).alias("payload"),
    )


def decode_queue(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON objects as raw messages; everything else goes to the dead letters."""
    fits = F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.lit(False))
    get = lambda k: F.get_json_object(value, f"$.{k}")
    good = df.where(fits).select(get("message_id").alias("message_id"), get("source").alias("source"), F.coalesce(get("format"), F.lit("json")).alias("format"), get("payload").alias("payload"))
    return good, df.where(~fits)


def drained(queue: DataFrame, limit: int, order: str | None = None) -> DataFrame:
    """The first messages of a queue, which keeps them: reading takes nothing away."""
    bounded("limit", limit, 1, 1_000_000)
    return (queue.orderBy(order) if order else queue).limit(limit)


def injected(messages: DataFrame, kind: str, **metadata: str) -> DataFrame:
    """Synthetic messages marked as such, with how they came about: what sinks and logs carry along."""
    notes = [F.lit(x) for pair in metadata.items() for x in map(str, pair)]
    marked = F.create_map(*notes) if notes else F.create_map().cast("map<string,string>")
    return messages.withColumn("injection", F.struct(F.lit(kind).alias("type"), marked.alias("metadata")))


def check_messages(df: DataFrame) -> DataFrame:
    """Adds `dead`, why a message cannot be processed at all (null: it can)."""
    return df.withColumn(
        "dead",
        F.when(F.coalesce(F.col("source"), F.lit("")) == "", "source_missing")
        .when(F.coalesce(F.col("payload"), F.lit("")) == "", "payload_missing")
        .when(~F.col("source").isin(list(REGISTRY)), "source_unknown")
        .when(~F.coalesce(F.col("format").isin(list(FORMATS)), F.lit(False)), "format_unknown"),
    )


def csv_lines(text: Column) -> Column:
    """Records of a CSV text: line ends inside quotes do not end one; blank lines are no records. Runs of plain characters are one step of the
    pattern: steps of a group are calls on the JVM's stack, which a long record would overflow."""
    records = F.regexp_extract_all(text, F.lit(r'((?:[^"\r\n]++|"(?:[^"]++|"")*+"?)++)'), F.lit(1))
    return F.filter(records, lambda r: F.trim(r) != "")


def csv_cells(record: Column) -> Column:
    """Cells of a record, quotes undone."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r',("(?:[^"]++|"")*"[^,]*|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, r'^"((?:[^"]++|"")*)"?([^,]*)$', "$1$2"), F.lit('""'), F.lit('"'))).otherwise(c))


def csv_header(line: Column) -> Column:
    """A header's distinct names, and for each its first place (from 1)."""
    placed = lambda cells, names: F.struct(names.alias("names"), F.transform(names, lambda h: F.array_position(cells, h).cast("int")).alias("places"))
    return let(csv_cells(line), lambda cells: let(F.array_distinct(cells), lambda names: placed(cells, names)))


def csv_record(header: Column, cells: Column) -> Column:
    """A map of a record's cells by column; missing ones are null, surplus ones left out."""
    return let(cells, lambda found: F.map_from_arrays(header.names, F.transform(header.places, lambda i: F.get(found, i - 1))))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds a value so that it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(texts: Column) -> Column:
    """Booleans as the words True and False."""
    return F.transform_values(texts, lambda k, v: F.when(v == "true", "True").when(v == "false", "False").otherwise(v))


def json_texts(record: Column) -> Column:
    """A record's values as text."""
    return words_of(F.from_json(record, TEXTS))


def json_record(record: Column) -> Column:
    """A struct of a record's values as text, and of those that count as given: not null, '', 0, false or empty."""

    def given(k: Column, v: Column, kind: Column) -> Column:
        number = ~kind.isin("STRING", "BOOLEAN", "VOID") & ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY")
        return v.isNotNull() & (v != "") & ~((kind == "BOOLEAN") & (v == "False")) & ~(number & F.coalesce(v.try_cast("double") == 0, F.lit(False))) & ~v.isin("[]", "{}")

    def both(texts: Column) -> Column:
        # only what may be more than a text is looked at as a value
        odd = F.exists(F.map_values(texts), lambda v: v.isin("False", "[]", "{}") | F.coalesce(v.try_cast("double") == 0, F.lit(False)))
        kept = F.when(odd, let(F.from_json(record, TYPES), lambda types: F.map_filter(texts, lambda k, v: given(k, v, F.schema_of_variant(types[k]))))).otherwise(text_truthy(texts))
        return F.struct(texts.alias("fields"), kept.alias("truthy"))

    return let(json_texts(record), both)


def text_truthy(fields: Column) -> Column:
    return F.map_filter(fields, lambda k, v: v.isNotNull() & (v != ""))


def _wrapper(source: Column) -> Column:
    out = F.lit("stations")
    for s in REGISTRY.values():
        out = F.when(source == s.source, s.fan_out_wrapper).otherwise(out)
    return out


SINGLE_KEYS = tuple(dict.fromkeys(k for s in REGISTRY.values() for k in s.single))


def _single(source: Column, keys: Column) -> Column:
    out = F.lit(False)
    for s in REGISTRY.values():
        out = F.when(source == s.source, F.array_contains(keys, s.single[0]) & F.array_contains(keys, s.single[1])).otherwise(out)
    return F.coalesce(out, F.lit(False))


def xml_stations(payload: Column) -> Column:
    """The maps of an XML text's station elements, one value for each child tag (nested ones as text, of equal tags the last; null: no child
    tags); null if it is not well-formed or has no station. Where text stands between tags the tags of the rules are read."""
    parsed = lambda kind: F.from_xml(payload, F.lit(f"station array<{kind}>"), {"ignoreSurroundingSpaces": "false"}).station
    mixed = parsed("struct<" + ",".join(f"{f}:string" for f in XML_FIELDS) + ">")
    known = F.transform(mixed, lambda s: F.map_filter(F.create_map(*[x for f in XML_FIELDS for x in (F.lit(f), s[f])]), lambda k, v: v.isNotNull()))
    return F.coalesce(parsed(TEXTS), known)


def xml_root(payload: Column) -> Column:
    """An XML text's root as the only station."""
    return xml_stations(F.concat(F.lit("<r><station>"), F.regexp_extract(payload, ROOT, 3), F.lit("</station></r>")))


def shape(payload: Column) -> Column:
    """The format that a text looks like, whatever it is declared as."""
    return F.when(F.ltrim(payload).startswith("<"), "xml").when(F.schema_of_variant(F.try_parse_json(payload)).rlike("^(OBJECT|ARRAY)"), "json").otherwise("csv")


def records(df: DataFrame, strict: bool = True, shapes: bool = False) -> DataFrame:
    """Adds `found`, the array of a payload's records: JSON text, or a map for XML and CSV.

    strict: as fan-out does it (only a source's own wrapper, objects only); otherwise as a direct call of the mapping
    takes it (any of the source's wrappers, first that is given, and elements of any type).
    shapes: texts are read as what they look like, and an XML root without stations is a record, as a direct call of the
    mapping by names takes them.
    """
    p, source = F.col("payload"), F.col("source")
    first = F.left(F.ltrim(p), F.lit(1))
    item = "array<variant>"

    def typed(texts: Column, values: Column) -> Column:
        """Text that opens a brace is an object, unless it is a string that does."""
        braced = lambda t: F.coalesce(F.ltrim(t).startswith("{"), F.lit(False))
        kind = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
        return let(values, lambda vs: F.transform(texts, lambda t, i: F.struct(t.alias("text"), (braced(t) & kind(F.get(vs, i))).alias("object"))))

    alone = F.array(F.struct(p.alias("text"), F.lit(True).alias("object")))

    def of_array(v: Column) -> Column:
        return typed(F.from_json(p, "array<string>"), F.try_variant_get(v, "$", item))

    def of_object(v: Column) -> Column:
        has = lambda name: F.try_variant_get(v, f"$.{name}", "variant").isNotNull()
        lists = F.from_json(p, "stations array<string>, estaciones array<string>")

        def chosen(texts: Column) -> Column:
            own, other = (F.when(has(n), typed(texts[n], F.try_variant_get(v, f"$.{n}", item))) for n in ("stations", "estaciones"))
            if not strict:
                return F.when(source == "valencia", F.coalesce(other, own)).when(source == "galicia", F.coalesce(F.when(F.size(own) > 0, own), other)).otherwise(own)
            return F.when(_wrapper(source) == "estaciones", other).otherwise(own)

        rest = F.when(_single(source, F.array_compact(F.array(*[F.when(has(n), F.lit(n)) for n in SINGLE_KEYS]))), alone) if strict else alone
        return F.coalesce(F.when(has("stations") | has("estaciones"), let(lists, chosen)), rest)

    found = let(F.try_parse_json(p), lambda v: F.when(v.isNotNull(), F.when(first == "[", of_array(v)).when(first == "{", of_object(v))))
    json = F.filter(found, lambda r: r.object) if strict else found
    xml = F.coalesce(xml_stations(p), xml_root(p)) if shapes else xml_stations(p)
    lines = csv_lines(p)
    form = shape(p) if shapes else F.col("format")
    return df.withColumns(
        {
            "found_json": F.when(form == "json", json),
            "found_xml": F.when((form == "xml") & F.ltrim(p).startswith("<"), xml),
            "found_csv": F.when((form == "csv") & (F.size(lines) > 1), lines),
        }
    )


def fan_out(df: DataFrame, strict: bool = True, shapes: bool = False) -> DataFrame:
    """One row for each record: ordinal (from 0), total, fields, truthy, is_object, raw_fragment. Messages without any keep one row with a null ordinal."""
    found = records(df, strict, shapes)
    one = "struct<fields:map<string,string>,truthy:map<string,string>,object:boolean,raw:string>"

    def record(fields: Column, truthy: Column, is_object: Column, raw: Column) -> Column:
        return F.struct(fields.alias("fields"), truthy.alias("truthy"), is_object.alias("object"), raw.alias("raw")).cast(one)

    json = F.transform("found_json", lambda r: let(F.when(r.object, json_record(r.text)), lambda x: record(x.fields, x.truthy, r.object, r.text)))

    def of_xml(s: Column) -> Column:
        known = s.isNotNull() if shapes else F.lit(True)
        return let(F.coalesce(s, F.create_map().cast(TEXTS)), lambda fields: record(fields, text_truthy(fields), known, F.to_json(fields)))

    def of_csv(header: Column, line: Column) -> Column:
        raw = F.concat(F.col("found_csv")[0], F.lit("\r\n"), line)
        return let(csv_record(header, csv_cells(line)), lambda fields: record(fields, text_truthy(fields), F.lit(True), raw))

    # a function of elements computes what it names each time: headers and lines are cut once, and records are counted before they are made
    lines = F.slice("found_csv", 2, F.size("found_csv"))
    csv = let(csv_header(F.col("found_csv")[0]), lambda header: F.transform(lines, lambda line: of_csv(header, line)))
    all_ = F.coalesce(json, F.transform("found_xml", of_xml), csv)
    total = F.coalesce(F.array_size("found_json"), F.array_size("found_xml"), F.array_size("found_csv") - 1, F.lit(0))
    rest = [c for c in df.columns]
    out = found.select(*rest, total.alias("total"), F.posexplode_outer(all_).alias("ordinal", "record"))
    return out.select(*rest, "total", "ordinal", "record.fields", "record.truthy", F.col("record.object").alias("is_object"), F.col("record.raw").alias("raw_fragment"))


def lineage(df: DataFrame) -> DataFrame:
    """Fan-out's messages: an id of their own, made from parent and place, parent_message_id, station_sequence from 1, total_stations."""
    return df.where("ordinal is not null").select(
        F.sha2(F.concat_ws("/", F.col("message_id").cast("string"), F.col("ordinal").cast("string")), 256).alias("message_id"),
        F.col("message_id").alias("parent_message_id"),
        (F.col("ordinal") + 1).alias("station_sequence"),
        F.col("total").alias("total_stations"),
        "source",
        "format",
        rewrapped(F.col("source"), F.col("format"), F.col("raw_fragment"), F.col("fields"), F.col("payload")).alias("payload"),
    )


def rewrapped(source: Column, form: Column, raw: Column, fields: Column, payload: Column) -> Column:
    """A single record in its source's wrapper; for XML in the payload's own root element, with its attributes."""
    tag, more = F.regexp_extract(payload, ROOT, 1), F.regexp_extract(payload, ROOT, 2)
    tags = F.array_join(F.transform(F.map_entries(fields), lambda e: F.when(e.value.isNotNull(), F.concat(F.lit("<"), e.key, F.lit(">"), _escaped(e.value), F.lit("</"), e.key, F.lit(">"))).otherwise("")), "")
    return (
        F.when(form == "json", F.concat(F.lit('{"'), _wrapper(source), F.lit('":['), raw, F.lit("]}")))
        .when(form == "xml", F.concat(F.lit("<"), tag, more, F.lit("><station>"), tags, F.lit("</station></"), tag, F.lit(">")))
        .otherwise(raw)
    )


def _escaped(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def resample(df: DataFrame, n: int, order: str) -> DataFrame:
    """n rows, going round the rows of a table in order."""
    count = df.count()
    if not count:
        return df.withColumn("sample", F.lit(0).cast("long"))
    numbered = numbered_by(df, order).withColumnRenamed("_place", "_row")
    return df.sparkSession.range(n).select(F.col("id").alias("sample"), (F.col("id") % count).alias("_row")).join(numbered, "_row").drop("_row")
