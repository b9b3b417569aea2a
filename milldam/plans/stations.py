"""Cleaning, checks, duplicates, routing, storing and searching of stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milldam.functions import clean
from milldam.operators import checks, dedup, mapping, search, store
from milldam.operators import analytics as A
from milldam.plans.registry import Registry
from milldam.plans.views import CONTACT_CTE, DEDUP_CTE, raw_st, stations_sql, table

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.cleaned(raw_st(spark, sf_dir))


def reasoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.checked(cleaned(spark, sf_dir))


@query(stations_sql("SELECT k, raw_id, address FROM clean"))
def opt_string(spark, sf_dir):
    return raw_st(spark, sf_dir).select("k", clean.opt_string(F.col("in_raw_id")).alias("raw_id"), clean.opt_string(F.col("in_address")).alias("address"))


@query(stations_sql("SELECT k, station_id FROM clean"))
def station_id(spark, sf_dir):
    return raw_st(spark, sf_dir).select("k", clean.station_id(F.col("source"), clean.opt_string(F.col("in_raw_id"))).alias("station_id"))


@query(stations_sql("SELECT k, latitude, longitude FROM clean"))
def parse_float(spark, sf_dir):
    return raw_st(spark, sf_dir).select("k", clean.parse_float(F.col("in_latitude")).alias("latitude"), clean.parse_float(F.col("in_longitude")).alias("longitude"))


@query(stations_sql("SELECT k, phone FROM clean"))
def clean_phone(spark, sf_dir):
    return raw_st(spark, sf_dir).select("k", clean.clean_phone(F.col("in_phone")).alias("phone"))


@query(stations_sql("SELECT k, postal_code FROM clean"))
def clean_postal(spark, sf_dir):
    return raw_st(spark, sf_dir).select("k", clean.clean_postal(F.col("in_postal_code")).alias("postal_code"))


@query(stations_sql("SELECT k, name, city, province FROM clean"))
def collapse_name(spark, sf_dir):
    return cleaned(spark, sf_dir).select("k", "name", "city", "province")


@query(stations_sql("SELECT k, spain_box FROM flags"))
def check_spain_box(spark, sf_dir):
    return cleaned(spark, sf_dir).select("k", checks.in_spain(F.col("latitude"), F.col("longitude")).alias("spain_box"))


@query(stations_sql("SELECT k, email_bad FROM flags"))
def check_email(spark, sf_dir):
    return cleaned(spark, sf_dir).select("k", checks.email_bad(F.col("email")).alias("email_bad"))


@query(stations_sql("SELECT k, province_bad FROM flags"))
def check_province(spark, sf_dir):
    joined = checks.with_province(cleaned(spark, sf_dir))
    return joined.select("k", (checks.given(F.col("province")) & ~F.coalesce("_is_official", F.lit(False))).alias("province_bad"))


def _rule(reason: str):
    def run(spark, sf_dir):
        return reasoned(spark, sf_dir).select("k", F.coalesce(F.col("reason") == reason, F.lit(False)).alias("fires"))

    return run


for _name, _reason in {
    "check_schema": "schema_validation_failed",
    "check_coords": "coordinates_outside_province_bounds",
    "check_postal": "postal_code_mismatch_province",
    "check_contact": "insufficient_contact_or_location",
}.items():
    QUERIES[_name] = _rule(_reason)
    ORACLE_SQL[_name] = stations_sql(f"SELECT k, COALESCE(reason = '{_reason}', FALSE) AS fires FROM reasoned")


@query(stations_sql("SELECT k, reason FROM reasoned"))
def first_reason(spark, sf_dir):
    return reasoned(spark, sf_dir).select("k", "reason")


@query(stations_sql("SELECT source, COALESCE(reason, 'accepted') AS reason, COUNT(*) AS n FROM reasoned GROUP BY 1, 2"))
def reason_counts(spark, sf_dir):
    return reasoned(spark, sf_dir).groupBy("source", F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query(stations_sql("SELECT source, k, station_id, rn FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY k) AS rn FROM reasoned WHERE reason IS NULL) WHERE rn <= 2"))
def sample_valid(spark, sf_dir):
    return A.sample_valid(reasoned(spark, sf_dir), "k").select("source", "k", "station_id", "rn")


def _spread(df: DataFrame) -> DataFrame:
    return df.where("raw_id is not null")


@query(stations_sql("SELECT k, dup FROM walk", DEDUP_CTE.format(keep="k", scope="message_id", source="clean WHERE raw_id IS NOT NULL"), recursive=True))
def dedup_id_name(spark, sf_dir):
    return dedup.id_name(_spread(cleaned(spark, sf_dir))).select("k", "dup")


@query(stations_sql("SELECT k, dup FROM walk", DEDUP_CTE.format(keep="k", scope="message_id", source="clean WHERE raw_id IS NOT NULL"), recursive=True))
def dedup_id_name_rounds(spark, sf_dir):
    """The other way, by an aggregate for each message."""
    rows = _spread(cleaned(spark, sf_dir))
    return dedup.id_name_fold(rows.withColumn("ordinal", F.struct("ordinal", "k"))).select("ordinal.k", "dup")


@query(stations_sql("SELECT k, dup2 AS dup FROM ranked_e", CONTACT_CTE.format(scope="message_id", source="clean")))
def dedup_contact(spark, sf_dir):
    return dedup.contact(cleaned(spark, sf_dir)).select("k", "dup")


_CHAIN = (
    DEDUP_CTE.format(keep="k", scope="message_id", source="reasoned WHERE reason IS NULL"),
    "kept AS (SELECT c.* FROM reasoned c JOIN walk ON c.k = walk.k WHERE walk.dup IS NULL)",
    CONTACT_CTE.format(scope="message_id", source="kept"),
    "ended AS (SELECT k, dup FROM walk WHERE dup IS NOT NULL UNION ALL SELECT k, dup2 FROM ranked_e)",
)


@query(stations_sql("SELECT k, dup FROM ended", *_CHAIN, recursive=True))
def dedup_chain(spark, sf_dir):
    return dedup.chain(reasoned(spark, sf_dir).where("reason is null").drop("reason")).select("k", "dup")


@query(
    stations_sql(
        "SELECT CASE WHEN reason IS NULL AND dup IS NULL THEN 'accepted' ELSE 'rejected' END AS route, COALESCE(reason, dup, '-') AS reason, COUNT(*) AS n FROM reasoned LEFT JOIN ended ON reasoned.k = ended.k GROUP BY 1, 2",
        *_CHAIN,
        recursive=True,
    )
)
def route_three_way(spark, sf_dir):
    from milldam.operators.routing import deduplicated

    out = deduplicated(reasoned(spark, sf_dir))
    return out.groupBy(F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("route"), F.coalesce("reason", F.lit("-")).alias("reason")).agg(F.count("*").alias("n"))


@query(stations_sql("SELECT k, station_id AS id_en_fuente, name AS nombre, longitude AS x, latitude AS y, CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN 4326 END AS srid, raw_id AS extra_raw_id, city AS extra_city FROM clean".replace("longitude AS x, latitude AS y", "CASE WHEN latitude IS NOT NULL THEN longitude END AS x, CASE WHEN longitude IS NOT NULL THEN latitude END AS y")))
def table_mapping(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    placed = rows.select("k", F.col("station_id").alias("id_en_fuente"), F.col("name").alias("nombre"), clean.point(F.col("latitude"), F.col("longitude")).alias("p"), mapping.overflow(rows).alias("o"))
    return placed.select("k", "id_en_fuente", "nombre", "p.x", "p.y", "p.srid", F.get_json_object("o", "$.raw_id").alias("extra_raw_id"), F.get_json_object("o", "$.city").alias("extra_city"))


# ---- storing ---------------------------------------------------------------------------------------------------------

_V1 = "v1 AS (SELECT * FROM clean WHERE raw_id IS NOT NULL)"
_V2 = "v2 AS (SELECT * REPLACE (CASE WHEN k % 3 = 0 THEN station_id || '-2' ELSE station_id END AS station_id) FROM clean WHERE raw_id IS NOT NULL)"
_LAST = "l{v} AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, station_id ORDER BY k DESC) AS z FROM v{v}) WHERE z = 1)"


def _version(spark, sf_dir, by: int) -> DataFrame:
    """All stations; in version 3 a third of them have new keys."""
    rows = cleaned(spark, sf_dir).where("raw_id is not null")
    key = F.when(F.col("k") % 3 == 0, F.concat("station_id", F.lit("-2"))).otherwise(F.col("station_id")) if by == 3 else F.col("station_id")
    return rows.select(F.col("source").alias("fuente_origen"), key.alias("id_en_fuente"), F.concat_ws("/", F.lit(str(by)), "name").alias("nombre"), F.col("phone").alias("telefono"), "k")


def _stored(spark, sf_dir) -> DataFrame:
    times = [F.lit(t).cast("timestamp") for t in ("2024-01-01", "2024-01-02")]
    empty = _version(spark, sf_dir, 2).drop("k").limit(0).withColumns({"fecha_creacion": F.lit(None).cast("timestamp"), "fecha_actualizacion": F.lit(None).cast("timestamp")})
    one = store.upsert(empty, _version(spark, sf_dir, 2), "k", times[0])
    return store.upsert(one, _version(spark, sf_dir, 3), "k", times[1])


@query(
    stations_sql(
        """SELECT COALESCE(l2.source, l1.source) AS fuente_origen, COALESCE(l2.station_id, l1.station_id) AS id_en_fuente,
  COALESCE('3/' || l2.name, CASE WHEN l2.k IS NULL THEN '2/' || l1.name END, '3') AS nombre, CASE WHEN l2.k IS NULL THEN l1.phone ELSE l2.phone END AS telefono,
  CASE WHEN l1.k IS NULL THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS fecha_creacion, CASE WHEN l2.k IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS fecha_actualizacion
FROM l1 FULL JOIN l2 ON l1.source = l2.source AND l1.station_id = l2.station_id""".replace("'2/' || l1.name", "COALESCE('2/' || l1.name, '2')"),
        _V1,
        _V2,
        _LAST.format(v=1),
        _LAST.format(v=2),
    )
)
def upsert_final_state(spark, sf_dir):
    return _stored(spark, sf_dir).select("fuente_origen", "id_en_fuente", "nombre", "telefono", "fecha_creacion", "fecha_actualizacion")


@query(stations_sql("SELECT 'm' || CAST(MIN(k) AS VARCHAR) AS message_id, source AS source_system, 'success' AS status FROM v1 GROUP BY source, message_id", _V1))
def audit_rows(spark, sf_dir):
    rows = cleaned(spark, sf_dir).where("raw_id is not null")
    firsts = rows.withColumn("first", F.concat(F.lit("m"), F.min("k").over(_by("source", "message_id")).cast("string")))
    accepted = firsts.select(F.col("first").alias("message_id"), "source_system", "raw_id", "station_id")
    written = store.new_log_rows(spark.createDataFrame([], "message_id string"), store.audit_success(accepted, 1, F.lit("2024-01-01").cast("timestamp")))
    return written.select("message_id", "source_system", "status")


def _by(*names):
    from pyspark.sql import Window

    return Window.partitionBy(*names)


# ---- searching -------------------------------------------------------------------------------------------------------

_TRI = """
tri AS (SELECT DISTINCT {key} AS tk, SUBSTR(w, CAST(i AS BIGINT), 3) AS g FROM (SELECT {key}, '  ' || UNNEST(string_split_regex(LOWER({text}), '[^a-z0-9_#]+')) || ' ' AS w FROM {source}) a, range(1, 60) r(i) WHERE LENGTH(w) > 3 AND i <= LENGTH(w) - 2),
ask AS (SELECT DISTINCT SUBSTR(w, CAST(i AS BIGINT), 3) AS g FROM (SELECT '  ' || UNNEST(string_split_regex(LOWER('{ask}'), '[^a-z0-9_#]+')) || ' ' AS w) a, range(1, 60) r(i) WHERE i <= LENGTH(w) - 2)"""


@query(
    stations_sql(
        "SELECT tk AS k, ROUND(n * 1.0 / (total + (SELECT COUNT(*) FROM ask) - n), 4) AS similarity FROM (SELECT tk, COUNT(*) AS total, SUM(CASE WHEN g IN (SELECT g FROM ask) THEN 1 ELSE 0 END) AS n FROM tri GROUP BY tk) WHERE n * 1.0 / (total + (SELECT COUNT(*) FROM ask) - n) >= 0.3",
        _TRI.format(key="k", text="name", source="clean WHERE name IS NOT NULL", ask="itv station 12"),
    )
)
def name_trigram_search(spark, sf_dir):
    rows = cleaned(spark, sf_dir).where("name is not null")
    return search.by_name(rows, "itv station 12", "name").select("k", F.round("similarity", 4).alias("similarity"))


@query(
    "WITH "
    + _TRI.format(key="p_partkey", text="p_name", source="part", ask="x").split("ask AS")[0].rstrip().rstrip(",")
    + ", qs AS (SELECT tk AS qid, g FROM tri WHERE tk % 20 = 0), sizes AS (SELECT tk, COUNT(*) AS n FROM tri GROUP BY tk), both_ AS (SELECT qid, tri.tk, COUNT(*) AS n FROM qs JOIN tri USING (g) GROUP BY 1, 2) "
    "SELECT qid, both_.tk AS p_partkey, ROUND(both_.n * 1.0 / (a.n + b.n - both_.n), 4) AS similarity FROM both_ JOIN sizes a ON a.tk = both_.tk JOIN sizes b ON b.tk = qid WHERE both_.n * 1.0 / (a.n + b.n - both_.n) >= 0.6"
)
def name_trigram_join(spark, sf_dir):
    """Queries: every part whose key is divisible by 20, against all parts."""
    parts = table(spark, sf_dir, "part")
    queries = parts.where("p_partkey % 20 = 0").select(F.col("p_partkey").alias("qid"), F.col("p_name").alias("query"))
    return search.name_join(parts, queries, "p_partkey", "p_name", 0.6, 4)


_HAV = "2 * 6371008.8 * ASIN(LEAST(1.0, SQRT(POW(SIN(RADIANS(latitude - 40.4) / 2), 2) + COS(RADIANS(latitude)) * COS(RADIANS(40.4)) * POW(SIN(RADIANS(longitude + 3.7) / 2), 2))))"


@query(stations_sql(f"SELECT k, ROUND({_HAV} / 1000, 3) AS km FROM clean WHERE {_HAV} <= 150000"))
def radius_search(spark, sf_dir):
    found = search.within(cleaned(spark, sf_dir), 40.4, -3.7, 150_000, "latitude", "longitude")
    return found.select("k", F.round(F.col("metres") / 1000, 3).alias("km"))


def _vincenty_sql(rounds: int = 8) -> tuple[str, ...]:
    """Vincenty's iteration from the same point in SQL, one relation for each round: metres in `ellipsoid`."""
    f, a = "(1 / 298.257223563)", "6378137.0"
    b = f"({a} * (1 - {f}))"
    u1 = f"ATAN((1 - {f}) * TAN(RADIANS(40.4)))"
    out = [f"v0 AS (SELECT k, SIN({u1}) AS s1, COS({u1}) AS c1, SIN(ATAN((1 - {f}) * TAN(RADIANS(latitude)))) AS s2, COS(ATAN((1 - {f}) * TAN(RADIANS(latitude)))) AS c2, RADIANS(longitude + 3.7) AS gap, RADIANS(longitude + 3.7) AS x FROM clean WHERE latitude BETWEEN 30 AND 50 AND longitude BETWEEN -20 AND 20)"]
    for i in range(rounds):
        last = ", sine, cosine, level, middle" if i == rounds - 1 else ""
        out.append(f"a{i} AS (SELECT *, SQRT(POW(c2 * SIN(x), 2) + POW(c1 * s2 - s1 * c2 * COS(x), 2)) AS sine, s1 * s2 + c1 * c2 * COS(x) AS cosine FROM v{i})")
        out.append(f"b{i} AS (SELECT *, COALESCE(c1 * c2 * SIN(x) / NULLIF(sine, 0), 0) AS turn FROM a{i})")
        out.append(f"c{i} AS (SELECT *, 1 - turn * turn AS level, cosine - 2 * s1 * s2 / (1 - turn * turn) AS middle FROM b{i})")
        c = f"({f} / 16 * level * (4 + {f} * (4 - 3 * level)))"
        out.append(f"v{i + 1} AS (SELECT k, s1, c1, s2, c2, gap, gap + (1 - {c}) * {f} * turn * (ATAN2(sine, cosine) + {c} * sine * (middle + {c} * cosine * (2 * middle * middle - 1))) AS x{last} FROM c{i})")
    w = f"(level * ({a} * {a} - {b} * {b}) / ({b} * {b}))"
    big, small = f"(1 + {w} / 16384 * (4096 + {w} * (-768 + {w} * (320 - 175 * {w}))))", f"({w} / 1024 * (256 + {w} * (-128 + {w} * (74 - 47 * {w}))))"
    m2 = "(2 * middle * middle - 1)"
    less = f"({small} * sine * (middle + {small} / 4 * (cosine * {m2} - {small} / 6 * middle * (4 * sine * sine - 3) * (4 * middle * middle - 3))))"
    return (*out, f"far AS (SELECT k, {b} * {big} * (ATAN2(sine, cosine) - {less}) AS ellipsoid FROM v{rounds})")


@query(stations_sql("SELECT k, ROUND(ellipsoid / 1000, 3) AS km FROM far WHERE ellipsoid <= 150000", *_vincenty_sql()))
def radius_search_ellipsoid(spark, sf_dir):
    found = search.within(cleaned(spark, sf_dir), 40.4, -3.7, 150_000, "latitude", "longitude", ellipsoid=True)
    return found.select("k", F.round(F.col("metres") / 1000, 3).alias("km"))


@query(stations_sql("SELECT k FROM clean WHERE city = 'NATION_7' AND raw_id IS NOT NULL"))
def json_city_filter(spark, sf_dir):
    rows = cleaned(spark, sf_dir).where("raw_id is not null")
    return search.json_field(rows.withColumn("datos_extra", mapping.overflow(rows)), "datos_extra", "$.city", "NATION_7").select("k")


@query(stations_sql("SELECT COUNT(*) AS n FROM clean WHERE source IN (SELECT source FROM clean WHERE CAST(message_id AS VARCHAR) LIKE '1%')"))
def source_semi_join(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    return search.count_from_sources(rows, rows, "1%")


@query(stations_sql("SELECT k FROM clean WHERE postal_code = '99999' AND source = 'valencia'"))
def equality_filters(spark, sf_dir):
    return search.equal(cleaned(spark, sf_dir), postal_code="99999", source="valencia").select("k")


@query(stations_sql("SELECT COUNT(*) AS n FROM clean WHERE source = 'galicia' AND station_id = 'GAL_ST-5'"))
def source_id_lookup(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select(F.col("source").alias("fuente_origen"), F.col("station_id").alias("id_en_fuente"))
    return store.by_source_id(rows, "galicia", "GAL_ST-5").agg(F.count("*").alias("n"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS nombre, '' AS telefono, 'Fija' AS tipo FROM supplier ORDER BY s_suppkey DESC LIMIT 50")
def latest_stations(spark, sf_dir):
    stored = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"), F.lit(None).cast("string").alias("telefono"), F.lit("").alias("tipo"))
    return A.latest_stations(stored, 50)
