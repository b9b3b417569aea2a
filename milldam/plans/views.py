"""Station data made from the driver's tables, in Spark and in DuckDB by the same SQL text.

raw_st: one raw record for each customer, with defects by residues of its key. log: events as an audit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milldam.dims import PROVINCES, REGISTRY

BOGUS = ("A CORUNA", "ATLANTIS", "CASTELLON", "MORDOR")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows to a task where a row costs much and is short.
ROWS = 1 << 12


def dealt(rows: DataFrame, key: str, most: int = ROWS) -> DataFrame:
    """The rows in even parts by their key: files are read by blocks of up to a million short rows, and what follows costs by row."""
    return rows.repartition(rows.count() // most + 1, key)


def _places() -> list[tuple]:
    """(place, province, prefix, lat, lat width, lon, lon width), degrees in ten-thousandths."""
    ten = lambda x: round(x * 10_000)
    rows = []
    for i, (name, prefix, a, b, c, d) in enumerate([p for p in PROVINCES if p[1]] + [(n, "77", None, None, None, None) for n in BOGUS]):
        a, b, c, d = (a, b, c, d) if a is not None else (36.0, 43.8, -9.3, 4.3)
        rows.append((i, name, prefix, ten(a), ten(b) - ten(a), ten(c), ten(d) - ten(c)))
    return rows


PLACES = _places()
PLACE_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', '{p}', {a}, {w}, {o}, {v})" for i, n, p, a, w, o, v in PLACES) + ") AS t(place, place_name, prefix, lat, lat_width, lon, lon_width))"

_whole = lambda x, n: f"CAST(({x} - ({x}) % {n}) / {n} AS BIGINT)"
_degrees = lambda x: f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || CAST({_whole(f'ABS({x})', 10000)} AS VARCHAR(20)) || (CASE WHEN k % 3 = 0 THEN ',' ELSE '.' END) || LPAD(CAST(ABS({x}) % 10000 AS VARCHAR(20)), 4, '0')"
_text = lambda x: f"CAST({x} AS VARCHAR(20))"

#: Both engines read this; {customer}, {nation} and {places} are relations.
RAW_ST = f"""
SELECT k, {_whole('k', 10)} AS message_id, k % 10 AS ordinal,
  CASE k % 3 WHEN 0 THEN 'catalunya' WHEN 1 THEN 'valencia' ELSE 'galicia' END AS source,
  CASE WHEN k % 29 = 0 THEN '  ' WHEN k % 7 = 3 THEN 'ST-' || {_text('k - 1')} ELSE ' ST-' || {_text('k')} END AS in_raw_id,
  CASE WHEN k % 31 = 0 THEN '' WHEN k % 37 = 0 THEN REPEAT('X', 201) WHEN k % 11 = 5 THEN ' ITV  Station ' || {_text('k - 1')} ELSE ' ITV  Station ' || {_text('k')} END AS in_name,
  CASE WHEN k % 41 = 0 THEN NULL ELSE 'Calle ' || {_text('k')} END AS in_address,
  LOWER(city) AS in_city,
  CASE WHEN k % 43 = 0 THEN NULL ELSE place_name END AS in_province,
  CASE WHEN k % 9 = 4 THEN '99999' WHEN k % 10 = 7 THEN prefix || '12' ELSE prefix || LPAD({_text('k % 1000')}, 3, '0') END AS in_postal_code,
  CASE WHEN k % 47 = 0 THEN 'n/a' ELSE {_degrees('la')} END AS in_latitude,
  CASE WHEN k % 53 = 0 THEN NULL ELSE {_degrees('lo')} END AS in_longitude,
  CASE WHEN k % 8 = 3 THEN NULL WHEN k % 17 = 4 THEN '9' || LPAD({_text('k - 1')}, 8, '0') WHEN k % 8 = 1 THEN '+34 9' || LPAD({_text('k')}, 8, '0')
    WHEN k % 8 = 2 THEN '349' || LPAD({_text('k')}, 8, '0') WHEN k % 59 = 0 THEN REPEAT('9', 22) ELSE '9-' || LPAD({_text('k')}, 8, '0') || '.' END AS in_phone,
  CASE WHEN k % 5 = 1 THEN NULL WHEN k % 19 = 2 THEN 'itv+' || {_text('k')} || '@example.org' WHEN k % 23 = 6 THEN 'ITV' || {_text('k - 1')} || '@example.org' ELSE 'itv' || {_text('k')} || '@example.org' END AS in_email
FROM (
  SELECT c.c_custkey AS k, n.n_name AS city, p.place_name, p.prefix,
    p.lat + CASE WHEN c.c_custkey % 13 = 0 THEN p.lat_width + 2000 ELSE {_whole('(c.c_custkey % 97) * p.lat_width', 97)} END AS la,
    p.lon + {_whole('(c.c_custkey % 89) * p.lon_width', 89)} AS lo
  FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{places}} p ON c.c_custkey % {len(PLACES)} = p.place
) x
"""

LOG = """
SELECT event_id AS message_id, CASE user_id % 3 WHEN 0 THEN 'catalunya' WHEN 1 THEN 'valencia' ELSE 'galicia' END AS source,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'processing' ELSE 'success' END AS status,
  ts AS processed_at, CAST(FLOOR(value * 10) AS BIGINT) AS total_ms, props AS metadata
FROM {events}
"""

FIELDS = ("raw_id", "name", "address", "city", "province", "postal_code", "latitude", "longitude", "phone", "email")


def raw_st(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = spark.createDataFrame(PLACES, "place long, place_name string, prefix string, lat long, lat_width long, lon long, lon_width long")
    return spark.sql(RAW_ST, customer=dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey"), nation=table(spark, sf_dir, "nation"), places=F.broadcast(places)).withColumn("is_object", F.lit(True))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LOG, events=table(spark, sf_dir, "events"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_st as raw messages, one for each source of a message (at most ten stations): XML, JSON or CSV by source."""
    rows = raw_st(spark, sf_dir)
    names = {s: {t: n[0] for t, n in REGISTRY[s].fields.items()} for s in REGISTRY}
    col = lambda t: F.col(f"in_{t}")
    escaped = lambda t: F.replace(F.replace(col(t), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(F.lit("<station>"), *[F.coalesce(F.concat(F.lit(f"<{names['catalunya'][t]}>"), escaped(t), F.lit(f"</{names['catalunya'][t]}>")), F.lit("")) for t in FIELDS], F.lit("</station>"))
    json = F.to_json(F.struct(*[col(t).alias(names["valencia"][t]) for t in FIELDS]), {"ignoreNullFields": "false"})
    quoted = lambda t: F.when(col(t).contains(",") | col(t).contains('"'), F.concat(F.lit('"'), F.replace(col(t), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(col(t), F.lit("")))
    csv = F.concat_ws(",", *[quoted(t) for t in FIELDS])
    source = F.col("source")
    record = F.when(source == "catalunya", xml).when(source == "valencia", json).otherwise(csv)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", record.alias("r")))), lambda x: x.r)
    grouped = rows.groupBy("source", "message_id").agg(listed.alias("r"))
    head = ",".join(names["galicia"][t] for t in FIELDS)
    return grouped.select(
        F.concat_ws("-", "source", F.col("message_id").cast("string")).alias("message_id"),
        "source",
        F.when(source == "catalunya", "xml").when(source == "valencia", "json").otherwise("csv").alias("format"),
        F.when(source == "catalunya", F.concat(F.lit("<stations>"), F.array_join("r", ""), F.lit("</stations>")))
        .when(source == "valencia", F.concat(F.lit('{"estaciones":['), F.array_join("r", ","), F.lit("]}")))
        .otherwise(F.concat(F.lit(head + "\n"), F.array_join("r", "\n")))
        .alias("payload"),
    )


# ---- the same in SQL, for comparison -------------------------------------------------------------------------------

RAW_CTE = "raw_st AS (" + RAW_ST.format(customer="customer", nation="nation", places=PLACE_SQL) + ")"
LOG_CTE = "log AS (" + LOG.format(events="events") + ")"
DIM_CTE = "dim AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v) for v in p) + ")" for p in PROVINCES
) + ") AS d(d_name, d_prefix, lat_min, lat_max, lon_min, lon_max))"

CLEAN_CTE = r"""
phones AS (SELECT k AS pk, NULLIF(REPLACE(REPLACE(REPLACE(TRIM(in_phone), ' ', ''), '-', ''), '.', ''), '') AS p FROM raw_st),
clean AS (
  SELECT k, message_id, ordinal, source,
    NULLIF(TRIM(in_raw_id), '') AS raw_id,
    UPPER(SUBSTR(source, 1, 3)) || '_' || NULLIF(TRIM(in_raw_id), '') AS station_id,
    COALESCE(NULLIF(TRIM(in_name), ''), '') AS name_given,
    REGEXP_REPLACE(NULLIF(TRIM(in_name), ''), '\s+', ' ', 'g') AS name,
    NULLIF(TRIM(in_address), '') AS address, UPPER(NULLIF(TRIM(in_city), '')) AS city, UPPER(NULLIF(TRIM(in_province), '')) AS province,
    CASE WHEN LENGTH(REGEXP_REPLACE(in_postal_code, '[^0-9]', '', 'g')) = 5 THEN REGEXP_REPLACE(in_postal_code, '[^0-9]', '', 'g') END AS postal_code,
    TRY_CAST(REPLACE(in_latitude, ',', '.') AS DOUBLE) AS latitude, TRY_CAST(REPLACE(in_longitude, ',', '.') AS DOUBLE) AS longitude,
    CASE WHEN p LIKE '+%' THEN p WHEN p LIKE '34%' THEN '+' || p WHEN LENGTH(p) = 9 THEN '+34' || p ELSE p END AS phone,
    NULLIF(TRIM(in_email), '') AS email
  FROM raw_st JOIN phones ON k = pk
)"""
REASON_CTE = r"""
flags AS (
  SELECT c.*, d_prefix,
    station_id IS NOT NULL AND LENGTH(station_id) BETWEEN 3 AND 50 AND LENGTH(name_given) BETWEEN 1 AND 200 AND COALESCE(LENGTH(phone), 0) <= 20
      AND COALESCE(latitude BETWEEN 36.0 AND 43.8, TRUE) AND COALESCE(longitude BETWEEN -9.3 AND 4.3, TRUE) AS schema_ok,
    COALESCE(latitude BETWEEN 36.0 AND 43.8 AND longitude BETWEEN -9.3 AND 4.3, FALSE) AS spain_box,
    email IS NOT NULL AND NOT REGEXP_MATCHES(email, '^[A-Za-z0-9_.-]+@[A-Za-z0-9_.-]+\.[A-Za-z0-9_]+$') AS email_bad,
    province IS NOT NULL AND d_prefix IS NULL AS province_bad,
    COALESCE(latitude <> 0 AND longitude <> 0, FALSE) AND province IS NOT NULL
      AND NOT COALESCE(latitude BETWEEN COALESCE(lat_min, 36.0) AND COALESCE(lat_max, 43.8) AND longitude BETWEEN COALESCE(lon_min, -9.3) AND COALESCE(lon_max, 4.3), FALSE) AS coords_bad,
    COALESCE(postal_code IS NOT NULL AND NOT starts_with(postal_code, d_prefix), FALSE) AS postal_bad,
    NOT ((phone IS NOT NULL OR email IS NOT NULL) AND address IS NOT NULL AND city IS NOT NULL AND province IS NOT NULL AND postal_code IS NOT NULL) AS contact_bad
  FROM clean c LEFT JOIN dim ON province = d_name
),
reasoned AS (
  SELECT *, CASE WHEN raw_id IS NULL THEN 'missing_raw_id' WHEN NOT schema_ok THEN 'schema_validation_failed' WHEN email_bad THEN 'invalid_email_format' WHEN province_bad THEN 'invalid_province'
    WHEN coords_bad THEN 'coordinates_outside_province_bounds' WHEN postal_bad THEN 'postal_code_mismatch_province' WHEN contact_bad THEN 'insufficient_contact_or_location' END AS reason
  FROM flags
)"""
DEDUP_CTE = r"""
keyed AS (SELECT {keep}, UPPER(station_id) AS i, UPPER(name) || CHR(31) || UPPER(COALESCE(city, '')) AS n, ROW_NUMBER() OVER (PARTITION BY {scope} ORDER BY ordinal) AS r, {scope} AS scope FROM {source}),
walk AS (
  SELECT k, scope, r, CAST(NULL AS VARCHAR) AS dup, [i] AS ids, [n] AS names FROM keyed WHERE r = 1
  UNION ALL
  SELECT b.k, b.scope, b.r, CASE WHEN list_contains(ids, b.i) THEN 'duplicate_id_within_message' WHEN list_contains(names, b.n) THEN 'duplicate_name_city_within_message' END,
    CASE WHEN list_contains(ids, b.i) OR list_contains(names, b.n) THEN ids ELSE list_append(ids, b.i) END,
    CASE WHEN list_contains(ids, b.i) OR list_contains(names, b.n) THEN names ELSE list_append(names, b.n) END
  FROM walk w JOIN keyed b ON w.scope = b.scope AND b.r = w.r + 1
)"""
CONTACT_CTE = r"""
ranked_p AS (SELECT *, phone IS NOT NULL AND ROW_NUMBER() OVER (PARTITION BY {scope}, UPPER(phone) ORDER BY ordinal) > 1 AS again FROM {source}),
ranked_e AS (SELECT *, CASE WHEN again THEN 'duplicate_phone_in_message'
  WHEN email IS NOT NULL AND SUM(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY {scope}, LOWER(email) ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 'duplicate_email_in_message' END AS dup2 FROM ranked_p)"""


def stations_sql(tail: str, *more: str, recursive: bool = False) -> str:
    """A query over raw_st, clean and reasoned."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join([RAW_CTE, DIM_CTE, CLEAN_CTE, REASON_CTE, *more]) + "\n" + tail


def log_sql(tail: str, *more: str) -> str:
    return "WITH " + ", ".join([LOG_CTE, *more]) + "\n" + tail
