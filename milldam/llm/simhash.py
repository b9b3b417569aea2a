"""Near-duplicates: by SimHash over deletion variants of two segments, and by verified Jaccard similarity.

Two fingerprints at 2 or fewer differing bits, cut into two segments of 32 bits, agree in one segment up
to one bit. So each distinct fingerprint is indexed under all one-wildcard variants of both segments (64
keys), keys are joined for equality, and pairs are verified by their whole Hamming distance.

A key that more than BUCKET distinct fingerprints share is not paired out. Its members are indexed again,
exactly: two fingerprints are within 2 bits if and only if some value is within 1 bit of both, so each is
listed under itself and its 64 one-bit neighbours, and all under one value are linked to the smallest of
them. That is linear in the members, and no link between components is lost.

near_duplicates() takes its candidates from the same fingerprints, of its own width: what deletion variants link is one component. Two
texts of five-word similarity 0.8 differ in about ten of the 64 bits, too many for deletion variants alone, so equal minima of
the sets in one of BANDS bands give more candidates. All are verified by the Jaccard similarity of their whole sets, and a key is not
paired out (linking.py). In a component of
similar sets the smallest ids stay, in order, and those similar to one that stays go.

Defined results: texts without words (null, empty, white space) have fingerprint zero and link like any
other; copies share a fingerprint; of several rows with the smallest id each counts alone; rows without an id get the
smallest id of their group; whole texts count, whatever their length; an empty table gives an empty table; extra columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, compact, durable, join_named, picked, schema_with, slices, table, tidied, with_columns
from .components import components
from .linking import Sets, bitmap, exhausted, leading, linked, merged

#: Distinct fingerprints that are paired out under one key.
BUCKET = 24
#: Hashes that are counted bit by bit at once.
AT_ONCE = 1 << 15
#: Keys of a set of shingles, minima in a key, and sets of a component that the others are compared with in the first round.
BANDS, ROWS, HEADS = 32, 4, 64
_factors = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, width: int) -> list[int]:
    """Hashes of the runs of width words; bytes.lower and bytes.split know ASCII only, as is meant."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < width:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i:j], 42) for i, j in zip(begins[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]


def fingerprint(text: bytes, width: int) -> int:
    """Bits set in over half of the hashes of the text's shingles."""
    return fingerprint_of(shingles(text, width))


def fingerprint_of(hashes: list[int]) -> int:
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), AT_ONCE):
        part = np.array(hashes[i : i + AT_ONCE], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", result: str = "fp", width: int = 3) -> DataFrame:
    """Adds the 64-bit fingerprint as a signed long."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                values = np.array([fingerprint(x or b"", width) for x in texts], dtype=np.uint64).view(np.int64)
                yield with_columns(batch, **{result: pa.array(values, pa.int64())})

    return df.mapInArrow(run, schema_with(df, **{result: T.LongType()}))


def variants(values: DataFrame) -> DataFrame:
    """(fp) -> (fp, key): both segments with each bit in turn taken out; the key's upper part names segment and bit."""
    segment = F.expr("array(shiftrightunsigned(fp, 32), fp & 4294967295L)")
    keys = F.expr("transform(sequence(0, 63), i -> shiftleft(cast(i as bigint), 32) | (s[i div 32] & ~shiftleft(1L, i % 32)))")
    return values.withColumn("s", segment).select("fp", F.explode(keys).alias("key"))


def links(values: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) whose components are those of all pairs within 2 bits."""
    keyed = variants(values)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    indexed, _ = compact(keyed.join(shared, "key"))
    few = indexed.where(F.col("n") <= bucket).select("key", "fp")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2
    pairs = few.withColumnRenamed("fp", "u").join(few.withColumnRenamed("fp", "v"), "key").where(F.col("u") < F.col("v")).where(close).select("u", "v").distinct()
    crowded = indexed.where(F.col("n") > bucket).select("fp").distinct()
    around = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    near = crowded.select(F.col("fp").alias("u"), F.explode(around).alias("z"))
    least = near.groupBy("z").agg(F.min("u").alias("v"))
    stars = near.join(least, "z").where("u != v").select("u", "v").distinct()
    return pairs.union(stars)


def fingerprint_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest id that can be reached over links."""
    marked = durable(fingerprints(df.select(doc_id, text), text).select(F.col(doc_id).alias("doc_id"), "fp"))
    values = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    rooted = durable(components(links(values.select("fp"))))
    grouped = values.join(rooted.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "n")
    return join_named(marked, durable(named), "fp").select("doc_id", "fp", "component_id")


def band_keys(values: np.ndarray) -> list[int]:
    """Keys of a set of distinct hashes: for each band, a digest of its minima."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), AT_ONCE >> 3):
        least = np.minimum(least, (values[i : i + (AT_ONCE >> 3), None] * _factors).min(axis=0))
    raw = least.tobytes()
    return [xxhash.xxh64_intdigest(raw[8 * ROWS * k : 8 * ROWS * (k + 1)], k) - (1 << 63) for k in range(BANDS)]


def shingle_sets(df: DataFrame, width: int, full: bool) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, n, bits, sim, x): digest, size (0: no shingles) and bitmap of the set of shingles, and the text's fingerprint; x:
    the set's hashes if full, else its keys."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                hashes = [shingles(x or b"", width) for x in batch.column("text").cast(pa.binary()).to_pylist()]
                sets = [np.unique(np.array(h, dtype=np.uint64)) for h in hashes]
                sims = np.array([fingerprint_of(h) for h in hashes], dtype=np.uint64).view(np.int64)
                fps = np.array([xxhash.xxh64_intdigest(v.tobytes(), 42) if len(v) else 0 for v in sets], dtype=np.uint64).view(np.int64)
                if full:
                    ends = np.cumsum([0, *map(len, sets)])
                    x = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64), pa.int64()))
                else:
                    x = pa.array([band_keys(v) if len(v) else [] for v in sets], pa.list_(pa.int64()))
                bits = pa.array(list(map(bitmap, sets)), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps), pa.array(list(map(len, sets)), pa.int64()), bits, pa.array(sims), x], names=["doc_id", "fp", "n", "bits", "sim", "x"])

    return df.select("doc_id", "text").mapInArrow(run, T.StructType([df.schema["doc_id"], *T._parse_datatype_string("fp long, n long, bits binary, sim long, x array<long>").fields]))


def alike(sets: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, sim) of sets -> (u, v), written: each set with the smallest of those whose fingerprints can be reached over links of deletion variants."""
    rooted = components(links(sets.select(F.col("sim").alias("fp")).distinct(), bucket))
    grouped = sets.join(rooted.withColumnRenamed("u", "sim"), "sim", "left").select("fp", F.coalesce("root", "sim").alias("root"))
    least = grouped.groupBy("root").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    return compact(grouped.join(least, "root").where("fp != v").select(F.col("fp").alias("u"), "v"))[0]


@tidied
def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8, heads: int = HEADS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest id of the set that stays for it, its own or a similar one."""
    percent = round(100 * similarity)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = durable(shingle_sets(docs, width, False))
    firsts = [*(F.first(c).alias(k) for c, k in (("x", "x"), ("bits", "bits"), ("n", "size"))), F.min("sim").alias("sim")]
    least = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), *firsts))
    keyed = least.where("least is not null").select("fp", F.explode("x").alias("key"))  # rows without an id stay anyhow
    shared, _ = compact(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members, _ = compact(join_named(keyed, shared, "key"))

    def whole(fps: DataFrame) -> DataFrame:
        rows, n = picked(docs, fps.join(least.select("fp", F.col("least").alias("doc_id")), "fp").select("doc_id"))
        found, got = compact(shingle_sets(rows, width, True).select("fp", "x"))
        return found if got == n else durable(found.dropDuplicates(["fp"]))  # several rows have an id

    sets = Sets(least.select("fp", F.col("size").alias("n"), "bits"), whole)
    stars, found, crowded = linked(members, sets, percent)
    stars = merged(merged(stars, found), alike(least.where("size > 0 and least is not null").select("fp", "sim")))
    if not crowded.isEmpty():
        stars = exhausted(crowded.select("key", "fp"), sets, percent, stars)
    goes = leading(stars.join(least.select(F.col("fp").alias("u"), F.col("least").alias("at")), "u").select(F.col("u").alias("fp"), F.col("root").alias("key"), "at"), sets, percent, heads)
    named, _ = compact(least.join(goes, "fp", "left").select("fp", F.coalesce("kept", "least").alias("component_id"), "n"))
    return join_named(marked.select("doc_id", "fp"), named, "fp").select("doc_id", "fp", "component_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
