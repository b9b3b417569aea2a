"""What several operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows go to Python in batches of at most so many bytes, however long the texts are.
BATCH_BYTES = 8 << 20
#: A written table of numbers with up to so many bytes is one partition: the least that the adaptive planner gives a task by default.
LEAST_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def tidied(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators of many steps: the shuffle files of a step go when it ends, not when the driver happens to collect its garbage. What
    later steps need is written by durable(). The session's own setting holds again afterwards."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    @wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        conf = df.sparkSession.conf
        before = conf.get(name)
        conf.set(name, "true")
        try:
            return operator(df, *args, **kwargs)
        finally:
            conf.set(name, before)

    return run


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage: the rows are written to the shared checkpoint folder and read from there.

    spark.checkpoint.dir names the folder; only where it is unset, and all is one machine, one is chosen here.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def compact(df: DataFrame) -> tuple[DataFrame, int]:
    """durable() for what may have few rows, and their number, counted as they are written. Of numbers, up to LEAST_BYTES are read as one
    partition, so that steps over small tables take a task and a file each, not one for each shuffle partition of the session."""
    seen = Observation()
    written = durable(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    rows, kinds = seen.get["rows"], [f.dataType for f in df.schema.fields]
    few = all(isinstance(k, (T.NumericType, T.BooleanType)) for k in kinds) and 8 * len(kinds) * rows <= LEAST_BYTES
    return written.coalesce(1) if few else written, rows


def join_named(rows: DataFrame, named: DataFrame, key: str, n: str = "n", heavy: int = 16384) -> DataFrame:
    """rows with the one row of `named` for their key; n says how many rows have it. Keys of 1/heavy of all rows, `heavy` of
    them at most, are joined by a broadcast, so that no task gets all rows of a large one. Both tables are read twice."""
    total = named.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    large = F.col(n) * heavy >= F.lit(total)
    few, many = F.broadcast(named.where(large).drop(n)), named.where(~large).drop(n)
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(many, key))


def picked(docs: DataFrame, ids: DataFrame, most: int = 1 << 20) -> tuple[DataFrame, int]:
    """The rows of docs with one of these ids (doc_id; may be null), and the number of different ids. Up to so many are broadcast."""
    ids, n = compact(ids.select(F.col("doc_id").alias("picked")).distinct())
    return docs.join(F.broadcast(ids) if n <= most else ids, F.col("doc_id").eqNullSafe(F.col("picked")), "left_semi"), n


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(doc_id="doc_id"):
    """crc32 of the id as text: what folds are cut by."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that one column has about `most` bytes in each part (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers are used again by other steps


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """Adds columns; one that is there already is replaced in its place."""
    names, arrays = list(batch.schema.names), list(batch.columns)
    for name, values in columns.items():
        if name in names:
            arrays[names.index(name)] = values
        else:
            names.append(name)
            arrays.append(values)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def schema_with(df: DataFrame, **columns) -> "StructType":  # noqa: F821
    """df's schema with columns added or replaced in place, as with_columns() does it."""
    fields = {f.name: f for f in df.schema.fields}
    fields |= {k: T.StructField(k, v) for k, v in columns.items()}
    return T.StructType(list(fields.values()))
