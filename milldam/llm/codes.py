"""Vector codes: each part of a vector becomes the index of its nearest codebook entry, learned by member-resident Lloyd rounds.

The parts of all vectors are dealt once, by (position, entry, salt), to the partitions that own that entry's members. Owners sum
up their members in place; salts of one entry meet as one row each, and only the codebooks, a fixed number of short rows, go
through the driver. In the next round each member is judged where it is, and only those that change their entry are dealt
anew. The last assignment needs no members: it is one pass over the vectors.

A batch's equal parts of one owner are one member with a weight, so that copies of a vector weigh little.

Defined results: vectors that are null, or hold null, NaN or infinite components, are dropped; integers saturate at 32 bits, errors
at 64; shorter vectors count as padded with zeros to the longest, and all to a multiple of the parts; of fewer rows than entries
all are entries; rows of one id are ordered by their vectors, a null id comes last; repeated rows each have their result; a table
without kept vectors gives an empty table; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, durable, join_named, shuffle_partitions, table

#: Owners of one entry.
SALTS = 32
#: Up to this size squares and their sums are exact in 64 bits; larger integers are reckoned as Python's.
EXACT = 1 << 24
OWNER = ["position", "entry", "salt"]
_LONG = (1 << 63) - 1


def kept_vectors(df: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, v): the vectors without null or non-finite components, as integers."""
    kind = T.ArrayType(T.DoubleType())
    rows = df.select(df[vec_id].alias("vec_id"), df[label].alias("label"), df[embedding].cast(kind).alias("x"))
    good = rows.where("x is not null and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    whole = F.expr(f"transform(x, c -> cast(greatest(least(floor(greatest(least(c, 1e9), -1e9) * {scale}), 2147483647), -2147483648) as int))")
    return good.select("vec_id", "label", whole.alias("v"))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of parts the nearest entry (ties: the lower index) and its squared distance."""
    if max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)) >= EXACT:
        parts, book = parts.astype(object), book.astype(object)
    entry, least = np.empty(len(parts), np.int64), np.empty(len(parts), parts.dtype)
    for at in range(0, len(parts), 4096):
        x = parts[at : at + 4096]
        distance = sum((x[:, k, None] - book[None, :, k]) ** 2 for k in range(book.shape[1]))
        entry[at : at + 4096] = best = np.array(distance.argmin(axis=1), np.int64)
        least[at : at + 4096] = distance[np.arange(len(x)), best]
    return entry, least


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of one width, padded with zeros."""
    values, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(ends) * width == len(values) and (ends == width).all():
        return values.reshape(len(ends), width)
    out = np.zeros((len(ends), width), np.int64)
    out[np.arange(width) < ends[:, None]] = values
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.astype(np.int32).ravel()), rows.shape[1]).cast(pa.list_(pa.int32()))


MEMBERS = "position int, entry int, salt int, weight long, part array<int>"


def dealt(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(v, salt) -> MEMBERS under the first books' entries."""
    positions, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), positions * width)
            salt = batch.column("salt").to_numpy(zero_copy_only=False)
            for p in range(positions):
                parts = v[:, p * width : (p + 1) * width]
                rows, weight = np.unique(np.column_stack([nearest(parts, books[p])[0], salt, parts]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1].astype(np.int32)), pa.array(weight.astype(np.int64)), _lists(rows[:, 2:])], names=["position", "entry", "salt", "weight", "part"])

    return vectors.select("v", "salt").mapInArrow(run, MEMBERS)


def judged(members: DataFrame, books: np.ndarray) -> DataFrame:
    """MEMBERS and the entry that is nearest now; no row moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, parts = batch.column("position").to_numpy(), _matrix(batch.column("part"), books.shape[2])
            nearer = np.empty(batch.num_rows, np.int32)
            for p in np.unique(position):
                nearer[position == p] = nearest(parts[position == p], books[p])[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearer)], names=[*batch.schema.names, "nearer"])

    return members.mapInArrow(run, f"{MEMBERS}, nearer int")


def updated(members: list[DataFrame], books: np.ndarray) -> np.ndarray:
    """The books whose entries are the floors of their members' means; each table of members is summed up where it is."""
    width = books.shape[2]
    sums = [F.sum(F.col("weight").cast("decimal(38,0)") * F.col("part")[k]).alias(f"s{k}") for k in range(width)]
    owned = [m.groupBy(*OWNER).agg(F.sum("weight").alias("n"), *sums) for m in members]
    rows = owned[0]
    for more in owned[1:]:
        rows = rows.unionByName(more)
    out = books.copy()
    for r in rows.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(width)]).collect():
        out[r.position, r.entry] = [int(r[f"s{k}"]) // r.n for k in range(width)]
    return out


def first_books(vectors: DataFrame, positions: int, entries: int) -> np.ndarray | None:
    """The parts of the vectors with the smallest ids, by position."""
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return None
    width = max(1, -(-width // positions)) * positions
    heads = vectors.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    rows = np.array([list(r.v) + [0] * (width - len(r.v)) for r in heads], np.int64)
    return rows.reshape(len(rows), positions, -1).swapaxes(0, 1).copy()


def codebooks(vectors: DataFrame, positions: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray | None:
    """Books (position, entry, component) after so many rounds over vectors (vec_id, v); None if there are none."""
    bounded_batches(vectors.sparkSession)
    books, n = first_books(vectors, positions, entries), shuffle_partitions(vectors.sparkSession)
    if books is None or not rounds:
        return books
    salted = vectors.withColumn("salt", F.pmod(F.xxhash64("vec_id", "v"), F.lit(SALTS)).cast("int"))
    resident = [durable(dealt(salted, books).repartition(n, *OWNER))]
    for k in range(rounds):
        books = updated(resident, books)
        if k < rounds - 1:
            seen = [durable(judged(m, books)) for m in resident]
            stay = [m.where("nearer = entry").drop("nearer") for m in seen]
            moved = seen[0]
            for m in seen[1:]:
                moved = moved.unionByName(m)
            moved = moved.where("nearer != entry").withColumn("entry", F.col("nearer")).drop("nearer").repartition(n, *OWNER)
            resident = [*stay, durable(moved)]
    return books


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, v) -> (vec_id, label, code, error)."""
    positions, _, width = books.shape
    bounded_batches(vectors.sparkSession)
    schema = T.StructType([vectors.schema["vec_id"], vectors.schema["label"], *T._parse_datatype_string("code string, error long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), positions * width)
            codes, error = np.empty((len(v), positions), np.int64), 0
            for p in range(positions):
                codes[:, p], d = nearest(v[:, p * width : (p + 1) * width], books[p])
                error = error + d
            errors = np.array([min(int(e), _LONG) for e in error], np.int64) if error.dtype == object else error
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(["".join(f"{c:02x}" for c in row) for row in codes.tolist()], pa.string()), pa.array(errors)], names=schema.names)

    return vectors.mapInArrow(run, schema)


def compressed(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", positions: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every kept vector; label_error: of all with its label, nulls together."""
    vectors = kept_vectors(df, vec_id, embedding, label, scale)
    books = codebooks(vectors, positions, entries, rounds)
    if books is None:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    rows = durable(coded(vectors, books)).withColumn("named", F.to_json(F.struct("label")))
    sums = rows.groupBy("named").agg(F.count("*").alias("n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    sums = sums.select("named", "n", F.least("total", F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return join_named(rows, sums, "named").select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


_DISTANCE = "list_sum(list_transform(list_zip(a.part, c.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_ROUND = f"""
near{{0}} as (select a.k, a.p, any_value(a.part) as part, min(({_DISTANCE}, c.entry)) as best from parts a join book{{0}} c on a.p = c.p group by a.k, a.p),
mean{{0}} as (select p, entry, list(m order by i) as part from (
  select p, best[2] as entry, i, cast(floor(sum(part[i]) / count(*)) as bigint) as m from near{{0}}, generate_series(1, len(part)) as g(i) group by p, best[2], i) group by p, entry),
book{{1}} as (select b.p, b.entry, coalesce(m.part, b.part) as part from book{{0}} b left join mean{{0}} m on b.p = m.p and b.entry = m.entry),"""

ORACLE = f"""
with whole as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
vectors as (select row_number() over (order by vec_id, v) as k, * from whole),
parts as (select k, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] as part from vectors, range(16) as t(p)),
book0 as (select p, k - 1 as entry, part from parts where k <= 64),{_ROUND.format(0, 1)}{_ROUND.format(1, 2)}
near2 as (select a.k, a.p, min(({_DISTANCE}, c.entry)) as best from parts a join book2 c on a.p = c.p group by a.k, a.p),
coded as (select k, string_agg(printf('%02x', best[2]), '' order by p) as code, cast(sum(best[1]) as bigint) as error from near2 group by k),
digest as (select sha256(string_agg(cast(x as varchar), ',' order by p, entry, i)) as codebooks_sha256
  from (select p, entry, unnest(part) as x, generate_subscripts(part, 1) as i from book2))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from vectors join coded using (k), digest
"""
