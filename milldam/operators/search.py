"""Searches over stored stations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milldam.functions.similarity import EARTH_M, haversine_m, trigram_similarity, trigrams, vincenty_m
from milldam.operators.mapping import settled


#: Sources that are looked up by a broadcast.
SOURCES = 1 << 16
#: Rows that are gathered to be cut into lists, and the longest lists of rows and of queries that are paired out at once.
LISTED, AT_ONCE = 1 << 16, (256, 512)


def by_name(df: DataFrame, query: str, column: str = "nombre", least: float = 0.3) -> DataFrame:
    """Rows whose name shares at least that part of its trigrams with the query."""
    s = trigram_similarity(F.col(column), F.lit(query))
    return settled(df, {"similarity": s}).where(F.col("similarity") >= least)


def _members(rows: DataFrame, key: str, text: str, most: int, x: str) -> DataFrame:
    """(name, keys): the keys of each distinct name in lists of at most `most`; they are gathered in blocks of some 64 K rows, whatever a name has."""
    blocks = rows.count() // LISTED + 1
    gathered = rows.where(F.col(text).isNotNull()).groupBy(F.col(text).alias(f"n{x}"), F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block")).agg(F.collect_list(F.struct(F.col(key).alias("key"))).alias("_all"))
    starts = F.sequence(F.lit(1), F.size("_all"), F.lit(most))
    return gathered.select(f"n{x}", F.explode(F.transform(starts, lambda i: F.slice("_all", i, most))).alias(f"keys_{x}"))


def name_join(df: DataFrame, queries: DataFrame, key: str, column: str = "nombre", least: float = 0.3, digits: int | None = None) -> DataFrame:
    """Rows for each of many queries (qid, query) by an inverted index of their rarest trigrams; similarities are rounded if digits are given.

    Of two names with that similarity, of a and b trigrams, neither has less than `least` times the other's, and when trigrams
    are ordered by rarity they share one of the first a - ceil(least * a) + 1 and b - ceil(least * b) + 1. Only such pairs are
    compared. A name's place in the index depends on the name alone, so equal names are compared once.

    The pairs of names come out as pairs of rows, which may be as many as the product of both tables. Lists of the rows of two names
    are dealt over the tasks and paired out there, so neither a frequent name nor a file of one block is left to one task.
    """
    names = df.select(F.col(column).alias("name")).union(queries.select("query")).where("name is not null").distinct().withColumn("g", trigrams(F.col("name"))).where(F.size("g") > 0)
    rarity = names.select(F.explode("g").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    ranked = names.select("name", F.explode("g").alias("t")).join(rarity, "t").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("g"))
    ranked = ranked.withColumns({"z": F.size("g"), "g": F.transform("g", lambda x: x.t)})
    first = F.slice("g", 1, (F.col("z") - F.ceil(F.col("z") * least - 1e-9) + 1).cast("int"))
    keyed = lambda side, text, x: side.select(text).distinct().withColumnRenamed(text, "name").where("name is not null").join(ranked, "name").select(F.col("name").alias(f"n{x}"), F.col("g").alias(f"g{x}"), F.col("z").alias(f"z{x}"), F.explode(first).alias("t"))
    sized = (F.col("za") >= F.col("zb") * least - 1e-9) & (F.col("zb") >= F.col("za") * least - 1e-9)
    pairs = keyed(df, column, "a").join(keyed(queries, "query", "b"), "t").where(sized)
    # a pair is compared under the first trigram that both have in front
    lead = F.element_at(F.array_intersect(F.slice("ga", 1, (F.col("za") - F.ceil(F.col("za") * least - 1e-9) + 1).cast("int")), F.slice("gb", 1, (F.col("zb") - F.ceil(F.col("zb") * least - 1e-9) + 1).cast("int"))), 1)
    both = F.size(F.array_intersect("ga", "gb"))
    found = pairs.where(F.col("t") == lead).withColumn("similarity", both / (F.col("za") + F.col("zb") - both)).where(F.col("similarity") >= least).select("na", "nb", (F.round("similarity", digits) if digits is not None else F.col("similarity")).alias("similarity"))
    lists = _members(df, key, column, AT_ONCE[0], "a").join(found, "na").join(_members(queries, "qid", "query", AT_ONCE[1], "b"), "nb").select("keys_a", "keys_b", "similarity")
    dealt = lists.repartition(F.xxhash64(F.col("keys_a")[0], F.col("keys_b")[0]))
    return dealt.select(F.explode("keys_a").alias("a"), "keys_b", "similarity").select("a", F.explode("keys_b").alias("b"), "similarity").select(F.col("b.key").alias("qid"), F.col("a.key").alias(key), "similarity")


def within(df: DataFrame, lat0: float, lon0: float, metres: float, lat: str = "latitud", lon: str = "longitud", ellipsoid: bool = False) -> DataFrame:
    """Rows within a distance, on the sphere or on the ellipsoid; a box of latitudes and longitudes comes first, which reaches the scan where
    these are stored columns. For the ellipsoid the box is of a sphere on which all distances are shorter."""
    earth = EARTH_M * 0.99 if ellipsoid else EARTH_M
    dlat = math.degrees(metres / earth)
    out = df.where(F.col(lat).between(lat0 - dlat, lat0 + dlat))
    edge = max(abs(lat0 - dlat), abs(lat0 + dlat))
    if edge < 89:
        dlon = math.degrees(math.asin(min(1.0, math.sin(metres / earth) / math.cos(math.radians(lat0)))))
        if abs(lon0) + dlon < 180:
            out = out.where(F.col(lon).between(lon0 - dlon - 1e-9, lon0 + dlon + 1e-9))
    distance = vincenty_m if ellipsoid else haversine_m
    return settled(out, {"metres": distance(F.col(lat), F.col(lon), lat0, lon0)}).where(F.col("metres") <= metres)


def json_field(df: DataFrame, column: str, path: str, value: str) -> DataFrame:
    return df.where(F.get_json_object(column, path) == value)


def equal(df: DataFrame, **values) -> DataFrame:
    """Equality filters: by source, postal code, status or message."""
    cond: Column = F.lit(True)
    for name, value in values.items():
        cond = cond & (F.col(name) == value)
    return df.where(cond)


def count_from_sources(rows: DataFrame, messages: DataFrame, pattern: str) -> DataFrame:
    """How many rows come from a source that has a message like the pattern. Sources are few and broadcast; more than SOURCES are joined."""
    hits = messages.where(F.col("message_id").cast("string").like(pattern)).select("source").distinct()
    if hits.limit(SOURCES + 1).count() <= SOURCES:
        hits = F.broadcast(hits)
    return rows.join(hits, "source", "left_semi").agg(F.count("*").alias("n"))
