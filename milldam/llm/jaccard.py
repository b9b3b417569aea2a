"""Exact Jaccard join of sets of n-grams, by partitions of the universe and the pigeonhole principle.

Two sets of similarity t differ in at most (1-t)/(1+t) of the sum of their sizes. Sizes are cut into bands, each at most 1/t
wide. A band's partition deals all shingles, by hash, to segments. A set is listed under its subset in each segment, and in
the first `reach` segments also under that subset without each of its shingles in turn: a segment that is equal, or
differs by one shingle where deletions are listed, gives two sets a common key. Each non-empty segment makes up for one
difference, with deletions for two; where what a set has listed makes up for more differences than two similar sets can
have, no partner is missed. A set takes part in the partition of its own band and of the next smaller one.

Allocation is by cost. For each band the cheapest numbers of segments and of deletions are taken that leave the mean subset large
enough to be telling, with some to spare. What is spare in a set pays for its empty segments, which have no key (unless too many are), and then
for the keys that are crowded. Sets with more crowded keys than they can spare go on to a second partition, of the shingles that few of
them have and with all deletions listed: similar sets differ in these by no more than they do in all, and no key of
these is crowded. Sets of hardly any such shingles, as large groups of near copies are, are compared head by head. So
nothing is lost.

Keys that a thousandth or more of a sample of the texts has are dealt to several tasks. The sample decides where rows go, never what
they are. Sets are known by digests of 64 bits: of N different sets, two share one by chance with odds of N^2/2^65.

Defined results: equal sets are one set, copies need no key; texts without words (null, empty, white space) have no shingles and are
linked with nothing; fewer words than the width are one shingle; whole texts count, whatever their length; rows without an
id get the smallest id of their component; an empty table gives an empty table; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, durable, join_named, picked, shuffle_partitions, slices, table, tidied
from .linking import STRAYS, Sets, bitmap, close, exhausted, linked, merged

#: Shingles that a subset should have on the mean.
TELLING = 2.5
#: One text of so many is looked at for common keys; keys that this share of them has are dealt to so many tasks.
SAMPLE, COMMON, SALTS = 64, 1 / 1024, 64
#: Different words whose hashes a task keeps.
WORDS = 1 << 19
#: Bits that a key leaves unused: it has 45, and three say its kind. Keys that agree by chance give candidates, no links; fewer bytes are shuffled.
_SHIFT, _KEY = np.uint64(16), np.uint64((1 << 48) - 8)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACES = np.random.default_rng(42).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, 42)
        return out


def shingle_set(text: bytes, width: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of width words (fewer words: of all of them); bytes.lower and bytes.split know
    ASCII only, as is meant."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n, width = max(1, len(w) - width + 1), min(width, len(w))
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h += w[k : k + n] * _PLACES[k % len(_PLACES)] ** np.uint64(k // len(_PLACES) + 1)
    h = np.sort(mixed(h))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def digest(values: np.ndarray) -> int:
    """A signed digest of a set."""
    return xxhash.xxh64_intdigest(values.tobytes(), 42) - (1 << 63) if len(values) else 0


class Bands:
    """Size bands and their partitions: (segments, reach) for each, by level."""

    def __init__(self, percent: int, level: int):
        self.percent, self.level, self.plans, self.starts = percent, level, {}, {}
        self.highs = [1]

    def differences(self, both: int) -> int:
        """The most differences that two similar sets with so many shingles together can have."""
        return both * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> int:
        while self.highs[-1] < n:
            low = self.highs[-1] + 1
            self.highs.append(max(low, low * 100 // self.percent))
        return int(np.searchsorted(self.highs, n))

    def plan(self, band: int) -> tuple[int, int]:
        """The cheapest (segments, reach) of a band: fewest keys of those whose mean subset is telling, else the most telling."""
        if band not in self.plans:
            high = self.highs[band]
            low = self.highs[band - 1] + 1 if band else 1
            need = self.differences(high + high * 100 // self.percent) + 1
            if self.level:
                self.plans[band] = (need, need)
                return need, need
            best = None
            for segments in range(max(1, (need + 1) // 2), 2 * need + 1):
                spare = segments * np.exp(-low / segments) * 1.5 + 0.05 * need if need > 1 else 0
                reach = max(0, int(np.ceil(need + spare)) - segments)
                if reach > segments:
                    continue
                keys = segments + reach * low / segments
                cost = (max(0.0, TELLING - low / segments), keys)
                best = min(best, (cost, segments, reach)) if best else (cost, segments, reach)
            self.plans[band] = (best[1], best[2]) if best else (max(1, (need + 1) // 2), max(1, (need + 1) // 2))
        return self.plans[band]

    def edges(self, segments: int) -> np.ndarray:
        """Where the segments begin, and the end."""
        if segments not in self.starts:
            if len(self.starts) > 4096:
                self.starts.clear()
            self.starts[segments] = np.array([min(-(-(k << 64) // segments), (1 << 64) - 1) for k in range(segments + 1)], np.uint64)
        return self.starts[segments]

    def parts(self, n: int) -> list[tuple[int, int, int]]:
        """(0 for its own band or 1 for the one below, band, differences to make up for, plus 1) of a set of n shingles."""
        own = self.of(n)
        out = [(0, own, self.differences(n + n * 100 // self.percent) + 1)]
        if own and n * self.percent <= self.highs[own - 1] * 100:
            out.append((1, own - 1, self.differences(n + self.highs[own - 1]) + 1))
        return out


def listed(values: np.ndarray, sums: np.ndarray, bands: Bands, band: int, need: int) -> tuple[np.ndarray, int]:
    """(keys, worth) of a set in a band's partition: segments are equal intervals of the hashes, so a set's subsets are slices of its sorted
    values. sums: running sums of the values, from 0. A key's lowest three bits say what losing it costs: 1 or 2, or for a
    deletion 1 (marked 3); 4 is added in the band below the set's own. A set whose filled segments are worth less than it needs
    has its empty subsets listed too (in the first partition), so that two such sets meet."""
    segments, reach = bands.plan(band)
    ends = np.searchsorted(values, bands.edges(segments))
    sizes = np.diff(ends)
    at = np.flatnonzero(sizes)
    seed = np.uint64((1000003 * band + bands.level + 1) * int(_A) % (1 << 64))
    places = mixed(seed + np.arange(segments, dtype=np.uint64))
    twice, fewest = (at < reach) & (sizes[at] > 1), 1
    if len(at) + int(twice.sum()) < need and bands.level == 0:
        at, fewest = np.arange(segments), 0
        twice = at < reach
    keys = [mixed((sums[ends[at + 1]] - sums[ends[at]]) ^ places[at]) >> _SHIFT & _KEY | (twice + np.uint64(1))]
    if twice.any():
        where = np.repeat(np.arange(reach), sizes[:reach])
        some = np.flatnonzero(sizes[where] > fewest)
        where = where[some]
        keys.append(mixed((sums[ends[where + 1]] - sums[ends[where]] - values[some]) ^ places[where]) >> _SHIFT & _KEY | np.uint64(3))
    return np.concatenate(keys), len(at) + int(twice.sum())


#: Rows of keys: those of a set, at place 0; at places under 0 its common keys, which are dealt by sets.
KEYS = "place int, fp long, keys array<long>"


def _rows(sets: list[tuple[int, np.ndarray, int, list | None]], bands: Bands, common: np.ndarray) -> tuple[list[pa.Array], dict]:
    """Rows of KEYS, and what each set (fp, lower) may lose."""
    place, fps, sizes, out, spare = [], [], [], [np.empty(0, np.uint64)], {}
    for fp, values, n, only in sets:
        if not len(values):
            continue
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
        parts = []
        for lower, band, need in bands.parts(n):
            if only is None or lower in only:
                keys, worth = listed(values, sums, bands, band, need)
                parts.append(keys + np.uint64(4 * lower))
                spare[fp, lower] = worth - need
        if not parts:
            continue
        keys = np.concatenate(parts)
        where = np.zeros(len(keys), np.int64)
        if len(common):
            base = keys & _KEY
            hit = common[np.minimum(np.searchsorted(common, base), len(common) - 1)] == base
            where[hit] = -1 - fp % SALTS
        order = np.argsort(where, kind="stable")
        where, starts, counts = (*np.unique(where[order], return_index=True), None)
        counts = np.diff(np.append(starts, len(keys)))
        out.append(keys[order])
        place.append(where)
        sizes.append(counts)
        fps.append(np.full(len(where), fp))
    if not place:
        place, fps, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out).view(np.int64)))
    return [pa.array(np.concatenate(place).astype(np.int32)), pa.array(np.concatenate(fps)), lists], spare


def keys_of_texts(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, text) -> KEYS, DOCUMENT: rows of keys, equal sets of a batch once, and for each document a row without keys, with its id, its set, and
    the set's size, bitmap, and what it may lose in its own partition and in the one below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bands = _Words(), Bands(percent, 0)
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [shingle_set(x or b"", width, known) for x in batch.column("text").cast(pa.binary()).to_pylist()]
                fps, n = list(map(digest, found)), list(map(len, found))
                (place, fp, keys), spare = _rows([(fp, v, len(v), None) for fp, v in dict(zip(fps, found, strict=True)).items()], bands, common)
                ids = batch.column("doc_id")
                more = [ids, pa.array(n, pa.int64()), pa.array(list(map(bitmap, found)), pa.binary()), *(pa.array([spare.get((x, k)) for x in fps], pa.int32()) for k in (0, 1))]
                yield pa.RecordBatch.from_arrays([place, fp, keys, *(pa.nulls(len(fp), x.type) for x in more)], names=names)
                own = pa.array(((np.array(fps, np.int64) + np.arange(len(fps))) % (1 << 30)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([own, pa.array(fps, pa.int64()), pa.nulls(len(ids), keys.type), *more], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = T._parse_datatype_string(f"{KEYS}, doc_id {kind}, n long, bits binary, spare0 int, spare1 int")
    names = schema.names
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keys_of_sets(sets: DataFrame, percent: int, level: int) -> DataFrame:
    """(fp, n, x, only) -> KEYS in the partitions of a level. n: the whole set's size; x: its shingles that are listed, in any order; only: the
    bands (own: 0, lower: 1) that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, level)
        for batch in batches:
            values = (np.sort(np.array(x, np.int64).view(np.uint64)) for x in batch.column("x").to_pylist())
            columns = (batch.column(c).to_pylist() for c in ("fp", "n", "only"))
            rows, _ = _rows([(fp, v, n, only) for (fp, n, only), v in zip(zip(*columns, strict=True), values, strict=True)], bands, np.empty(0, np.uint64))
            yield pa.RecordBatch.from_arrays(rows, names=["place", "fp", "keys"])

    return sets.select("fp", "n", "x", "only").mapInArrow(run, KEYS)


def spares(sets: DataFrame, percent: int, level: int) -> DataFrame:
    """(fp, n, x) -> (fp, lower, spare): how much a set may lose in each of its partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, level)
        for batch in batches:
            out = []
            for fp, n, x in zip(*(batch.column(c).to_pylist() for c in ("fp", "n", "x")), strict=True):
                values = np.sort(np.array(x, np.int64).view(np.uint64))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
                out += [(fp, lower, (listed(values, sums, bands, band, need)[1] if len(values) else 0) - need) for lower, band, need in bands.parts(n)]
            fps, lowers, spare = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(lowers, pa.int32()), pa.array(spare, pa.int32())], names=["fp", "lower", "spare"])

    return sets.select("fp", "n", "x").mapInArrow(run, "fp long, lower int, spare int")


def whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text) -> (fp, x): each text's set and its hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                sets = [shingle_set(x or b"", width, known) for x in batch.column("text").cast(pa.binary()).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)])
                x = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(list(map(digest, sets)), pa.int64()), x], names=["fp", "x"])

    return docs.select("text").mapInArrow(run, "fp long, x array<long>")


def common_keys(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """Keys that many of a sample of the texts have, in order: at most (keys of a text) / COMMON."""
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    least = max(8, some.count() * COMMON)
    rows = keys_of_texts(some, width, percent, np.empty(0, np.uint64)).where("keys is not null").select(F.explode("keys").alias("key")).groupBy(F.shiftright("key", 3).alias("key")).count()
    return np.sort(np.array([r.key << 3 for r in rows.where(F.col("count") >= least).select("key").collect()], np.int64).view(np.uint64))


def shared_keys(rows: DataFrame) -> DataFrame:
    """KEYS and more columns -> (packed, fp, own) of keys that several sets have, one of them in its own band, and
    the rows without keys (own: more, if there are any). Each key is a row of the shuffle, however many tasks there are, and holds no
    value twice: told() takes it apart."""
    more = [c for c in rows.columns if c not in ("place", "fp", "keys")]
    own = [F.when(F.col("keys").isNull(), F.struct(*more)).alias("own")] if more else []
    rows = rows.select("place", "fp", *own, F.explode_outer("keys").alias("packed"))
    rows = rows.repartition(shuffle_partitions(rows.sparkSession), F.shiftright("packed", 3), "place")
    beside = Window.partitionBy(F.shiftright("packed", 3), "place")  # sorted by the key first: there are few places
    seen = rows.withColumns({"a": F.min("fp").over(beside), "b": F.max("fp").over(beside), "least": F.min(F.col("packed").bitwiseAND(F.lit(7))).over(beside)})
    return seen.where("packed is null or place < 0 or (a != b and least < 4)").select("packed", "fp", *["own" for _ in own])


def told(found: DataFrame) -> DataFrame:
    """(key, fp, lower, worth) of the rows of shared_keys() that have keys."""
    kind = F.col("packed").bitwiseAND(F.lit(7)).cast("int")
    rows = found.where("packed is not null")
    return rows.select(F.shiftright("packed", 3).alias("key"), "fp", F.shiftright(kind, 2).alias("lower"), F.when(kind % 4 == 2, 2).otherwise(1).alias("worth"))


def once(rows: DataFrame) -> DataFrame:
    """Rows of shared keys, once for a key and set."""
    return rows.groupBy("key", "fp").agg(F.min("lower").alias("lower"), F.max("worth").alias("worth"))


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(fp, x) of the documents with these ids (doc_id), written."""
    rows, n = picked(docs, ids)
    found = durable(whole_sets(rows, width))
    return found if found.count() == n else durable(found.dropDuplicates(["fp"]))  # several rows have an id


def lacking(crowded: DataFrame, spare: DataFrame) -> DataFrame:
    """(fp, lower): first partitions in which a set has more crowded keys than it can spare (fp, lower, spare)."""
    lost = crowded.groupBy("fp", "lower").agg(F.sum("worth").alias("lost"))
    return lost.join(spare, ["fp", "lower"]).where("lost > spare").select("fp", "lower")


def rare_parts(sets: DataFrame, most: int) -> DataFrame:
    """(fp, n, x, only) with those shingles left in x that at most so many of the sets have."""
    each = sets.select("fp", F.explode("x").alias("s"))
    often = each.groupBy("s").count().where(F.col("count") > most).select("s")
    left = each.join(often, "s", "left_anti").groupBy("fp").agg(F.collect_list("s").alias("x"))
    return sets.drop("x").join(left, "fp", "left").withColumn("x", F.coalesce("x", F.expr("cast(array() as array<long>)")))


@tidied
def grouped(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: component_id is the smallest id that links reach, its own included."""
    bounded_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # the keys' pass gives the documents' sets as well: both come out of one shuffle and are written together
    found = durable(shared_keys(keys_of_texts(docs, width, percent, common_keys(docs, width, percent))))
    texts = found.where("packed is null").select("fp", "own.*")
    marked = texts.select("doc_id", "fp", "n")
    members = durable(once(told(found)))
    firsts = [F.first(c).alias(c) for c in ("bits", "spare0", "spare1")]
    classes = durable(texts.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("n").alias("size"), *firsts))
    whole = lambda fps: sets_of(docs, classes.join(fps, "fp", "left_semi").select(F.col("least").alias("doc_id")), width)
    sets = Sets(classes.select("fp", F.col("size").alias("n"), "bits"), whole)
    stars, links, crowded = linked(members, sets, percent)
    spare = classes.select("fp", F.posexplode(F.array("spare0", "spare1")).alias("lower", "spare"))
    short = durable(lacking(crowded, spare))
    if not short.isEmpty():
        asked = whole(short.select("fp").distinct()).join(short.groupBy("fp").agg(F.collect_set("lower").alias("only")), "fp").join(classes.select("fp", F.col("size").alias("n")), "fp")
        rare = durable(rare_parts(asked, STRAYS))
        stars = merged(stars, links.union(close(told(shared_keys(keys_of_sets(rare, percent, 1))), sets, percent)))
        short = short.join(spares(rare, percent, 1).where("spare < 0"), ["fp", "lower"], "left_semi")
        crowded = crowded.join(short, ["fp", "lower"], "left_semi").select("key", "fp")
        stars = exhausted(durable(crowded), sets, percent, stars)
    else:
        stars = merged(stars, links)
    joined = classes.join(stars.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = durable(join_named(joined.drop("n"), durable(least), "root").select("fp", "component_id").join(classes.select("fp", "n"), "fp"))
    rows = marked.withColumnRenamed("n", "n_shingles")
    out = join_named(rows.where("n_shingles > 0"), named, "fp").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive words as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents where text is not null),
sets as materialized (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as s from words),
sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
links as materialized (select u, v from (select a.doc_id as u, b.doc_id as v, count(*) as c from sets a join sets b on a.s = b.s and a.doc_id != b.doc_id group by 1, 2)
  join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * c >= 80 * (x.n + y.n - c)),
reached as (select u, v from links union select r.u, l.v from reached r join links l on r.v = l.u)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id from documents left join sizes using (doc_id)
left join (select u as doc_id, min(v) as low from reached group by u) using (doc_id)
"""
