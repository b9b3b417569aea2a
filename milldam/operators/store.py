"""The keyed table of stations and its audit log, kept on file tables without MERGE.

An upsert joins the batch with the current rows and writes the next state, so a reader or a restarted batch never sees half
of it; the same batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from milldam.operators import checks

KEYS = ("fuente_origen", "id_en_fuente")
# Columns that an upsert overwrites.
UPDATED = ("nombre", "latitud", "longitud", "location", "telefono", "email", "direccion", "codigo_postal", "datos_extra")


def last_of_each(batch: DataFrame, order: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Of several rows with a key in one batch the last counts."""
    best = batch.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), order).alias("_r"))
    return best.select(*keys, "_r.*")


def upsert(current: DataFrame, batch: DataFrame, order: str, now: Column, keys: tuple[str, ...] = KEYS, updated: tuple[str, ...] = UPDATED) -> DataFrame:
    """The table after the batch: new keys are inserted, known ones get the updated columns and keep their creation time and id."""
    columns = [c for c in updated if c in batch.columns]
    new = last_of_each(batch.select(*keys, *columns, order), order, keys).drop(order).withColumn("_new", F.lit(True))
    both = current.withColumn("_old", F.lit(True)).alias("o").join(new.alias("n"), list(keys), "full_outer")
    has_new = F.coalesce(F.col("n._new"), F.lit(False))
    out = [F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in columns]
    rest = [F.col(f"o.{c}").alias(c) for c in current.columns if c not in (*keys, *columns, "fecha_creacion", "fecha_actualizacion")]
    return both.select(
        *keys,
        *out,
        *rest,
        F.coalesce(F.col("o.fecha_creacion"), now).alias("fecha_creacion"),
        F.when(has_new, now).otherwise(F.col("o.fecha_actualizacion")).alias("fecha_actualizacion"),
    )


def with_ids(table: DataFrame, name: str = "id") -> DataFrame:
    """Gives rows without an id the next numbers after the highest, by key; numbered in ranges, not in one task."""
    highest = table.agg(F.coalesce(F.max(name), F.lit(0)).alias("_top")).first()[0]
    fresh = table.where(F.col(name).isNull()).withColumn("_part", F.pmod(F.xxhash64(*KEYS), F.lit(64)))
    sizes = fresh.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*KEYS))
    numbered = fresh.withColumn("_row", within).join(F.broadcast(starts), "_part").withColumn(name, (F.lit(highest) + F.col("_start") + F.col("_row")).cast("bigint"))
    return table.where(F.col(name).isNotNull()).unionByName(numbered.select(table.columns))


def audit_success(accepted: DataFrame, batch_id: int, now: Column) -> DataFrame:
    """One log row for each station stored."""
    stamp = F.date_format(now, "yyyyMMddHHmmssSSS")
    fallback = F.concat_ws("-", F.lit("fallback"), F.col("source_system"), F.coalesce(F.nullif(F.col("raw_id"), F.lit("")), F.col("station_id")), stamp)
    extra = [F.col(c) for c in ("timing_context", "injection", "model") if c in accepted.columns]
    return accepted.select(
        F.coalesce(F.nullif(F.col("message_id").cast("string"), F.lit("")), fallback).alias("message_id"),
        F.lit("itv_stations").alias("domain"),
        "source_system",
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        now.alias("processed_at"),
        F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.lit(None).cast("string").alias("error_in_step"), *extra).alias("metadata"),
    )


def audit_failure(batch: DataFrame, batch_id: int, step: str, error: str, now: Column) -> DataFrame:
    ok = audit_success(batch, batch_id, now)
    return ok.withColumns({"status": F.lit("failed"), "error_message": F.lit(error[:500]), "metadata": F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.lit(step).alias("error_in_step"))})


def with_metadata(log: DataFrame, **values: Column) -> DataFrame:
    """Log rows whose metadata also holds these values; what stands there under other names stays."""
    metadata = F.col("metadata")
    for name, value in values.items():
        metadata = metadata.withField(name, value)
    return log.withColumn("metadata", metadata)


def with_timing(log: DataFrame, **milliseconds: Column) -> DataFrame:
    return with_metadata(log, timing=F.struct(*[v.cast("bigint").alias(k) for k, v in milliseconds.items()]))


def with_injection_type(log: DataFrame, kind: Column) -> DataFrame:
    return with_metadata(log, injection_type=kind)


def with_rejections(log: DataFrame, rejected: DataFrame) -> DataFrame:
    """Log rows with the number of their message's rejects by reason; none: an empty map."""
    counts = rejected.groupBy("message_id", "reason").agg(F.count("*").alias("n")).groupBy("message_id")
    named = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("_rejections"))
    none = F.create_map().cast("map<string,bigint>")
    return with_metadata(log.join(named, "message_id", "left"), rejection_summary=F.coalesce("_rejections", none)).drop("_rejections")


def new_log_rows(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows whose message is not in the log yet, once each: delivering a message again adds nothing."""
    return rows.dropDuplicates(["message_id"]).join(log.select("message_id"), "message_id", "left_anti")


def revalidated(raw: DataFrame, schema: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Messages at the sink that fit the canonical schema, and those that go to the dead letters."""
    parsed = raw.withColumn("_v", F.from_json(value, schema, {"mode": "PERMISSIVE"}))
    known = parsed.schema["_v"].dataType.names
    fields = {c: F.col(f"_v.{c}") if c in known else F.lit(None).cast("double" if c in ("latitude", "longitude") else "string") for c in checks.FIELDS}
    fields["name_given"] = F.coalesce(F.col("_v.name"), F.lit(""))
    fits = F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT") & checks.schema_ok(fields), F.lit(False))
    return parsed.where(fits).select("_v.*"), parsed.where(~fits).drop("_v")


def by_source_id(table: DataFrame, source: str, id_: str) -> DataFrame:
    return table.where((F.col("fuente_origen") == source) & (F.col("id_en_fuente") == id_))


def without(table: DataFrame, source: str, id_: str) -> DataFrame:
    """The table after deleting a key."""
    return table.where(~((F.col("fuente_origen") == source) & (F.col("id_en_fuente") == id_)))


def emptied(table: DataFrame) -> DataFrame:
    return table.limit(0)


def evolved(*generations: DataFrame) -> DataFrame:
    """Rows of several schema revisions, missing columns null."""
    out = generations[0]
    for g in generations[1:]:
        out = out.unionByName(g, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class Revision:
    """One step of a schema: a name, and what it does to a table's rows on the way up and on the way down."""

    name: str
    up: Callable[[DataFrame], DataFrame]
    down: Callable[[DataFrame], DataFrame]


def adds(column: str, kind: str, default: object = None) -> Revision:
    return Revision(f"add {column}", lambda df: df.withColumn(column, F.lit(default).cast(kind)), lambda df: df.drop(column))


def renames(old: str, new: str) -> Revision:
    return Revision(f"rename {old} to {new}", lambda df: df.withColumnRenamed(old, new), lambda df: df.withColumnRenamed(new, old))


def retypes(column: str, before: str, after: str) -> Revision:
    """A change of type that loses no values both ways: the cast fails where one does not fit."""
    return Revision(f"{column} from {before} to {after}", lambda df: df.withColumn(column, F.col(column).cast(after)), lambda df: df.withColumn(column, F.col(column).cast(before)))


def revised(df: DataFrame, revisions: list[Revision], at: int, to: int) -> DataFrame:
    """Rows of a table at one revision (0: before the first), as of another, later or earlier."""
    if not (0 <= at <= len(revisions) and 0 <= to <= len(revisions)):
        raise ValueError(f"revisions go from 0 to {len(revisions)}")
    for step in revisions[at:to]:
        df = step.up(df)
    for step in reversed(revisions[to:at]):
        df = step.down(df)
    return df


class FileTable:
    """States of a table under one path, a Parquet folder for each batch, in any file system that Spark writes to.

    Spark marks a folder as complete when all is written; the complete one with the highest batch holds. A write that ends
    early leaves the state before it in force.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _states(self) -> list[tuple[int, object]]:
        """Batches with a folder, the newest first."""
        if not self.fs.exists(self.root):
            return []
        found = [x.getPath() for x in self.fs.listStatus(self.root)]
        return sorted([(int(p.getName()[1:]), p) for p in found if p.getName()[1:].isdigit()], key=lambda x: -x[0])

    def current(self) -> int:
        """The batch whose state holds; -1: none yet."""
        whole = lambda p: self.fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return next((batch for batch, p in self._states() if whole(p)), -1)

    def read(self) -> DataFrame | None:
        batch = self.current()
        return self.spark.read.parquet(f"{self.path}/b{batch}") if batch >= 0 else None

    def take_back(self, batch_id: int) -> None:
        """Drops the state of a batch; the one before holds again."""
        for batch, folder in self._states():
            if batch == batch_id:
                self.fs.delete(folder, True)

    def write(self, df: DataFrame, batch_id: int) -> bool:
        """Writes the state after a batch; False if that or a later one holds already. The state before is kept for readers."""
        last = self.current()
        if batch_id <= last:
            return False
        df.write.mode("overwrite").parquet(f"{self.path}/b{batch_id}")
        for batch, folder in self._states():
            if batch < last:
                self.fs.delete(folder, True)
        return True


class KeyedTable(FileTable):
    """A table in folders by a hash of its keys. A batch writes new versions of the folders that its keys fall in, and no others; of each folder
    the version of the newest complete batch holds.

    A batch's folders hold once Spark has marked them as complete, all at the same time: a write that ends early changes nothing.
    Of each folder the version before is kept for readers. Values in `blooms` columns get Bloom filters in the files.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, folders: int = 64, blooms: tuple[str, ...] = ("id_en_fuente", "codigo_postal")):
        super().__init__(spark, path)
        self.keys, self.folders, self.name, self.blooms = keys, folders, f"of{folders}", blooms

    def folder(self) -> Column:
        """The number of the folder that a row's keys fall in."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.folders)).cast("int").alias(self.name)

    def _states(self) -> list[tuple[int, object]]:
        if not self.fs.exists(self.root):
            return []
        found = [x.getPath() for x in self.fs.listStatus(self.root)]
        return sorted([(int(p.getName().removeprefix("batch=")), p) for p in found if p.getName().startswith("batch=")], key=lambda x: -x[0])

    def _versions(self) -> dict[int, list[tuple[int, object]]]:
        """For each folder its versions (batch, path) of complete batches, the newest first."""
        out: dict[int, list[tuple[int, object]]] = {}
        for batch, p in self._states():
            if self.fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
                for x in self.fs.listStatus(p):
                    name = x.getPath().getName()
                    if name.startswith(f"{self.name}="):
                        out.setdefault(int(name.partition("=")[2]), []).append((batch, x.getPath()))
        return out

    def read(self, folders: list[int] | None = None) -> DataFrame | None:
        """The table, or what is in some of its folders; None: nothing there yet."""
        held = self._versions()
        paths = [v[0][1].toString() for k, v in sorted(held.items()) if (folders is None or k in folders) and self.fs.listStatus(v[0][1])]
        if not paths:
            return None
        return self.spark.read.option("basePath", self.path).parquet(*paths).drop("batch")

    def write(self, df: DataFrame, batch_id: int, folders: list[int] | None = None) -> bool:
        """Writes all rows of some folders (None: of all) after a batch; False if that or a later one holds already."""
        last = self.current()
        if batch_id <= last:
            return False
        if folders is None:
            folders = list(range(self.folders))
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.root, f"batch={batch_id}")
        self.fs.delete(target, True)
        for k in folders:  # a folder that gets no rows is empty from now on
            self.fs.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(target, f"{self.name}={k}"))
        out = df.drop(self.name).withColumn(self.name, self.folder()).repartition(self.name)
        writer = out.write.mode("append").partitionBy(self.name)
        for c in self.blooms:
            if c in df.columns:
                writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(f"{self.path}/batch={batch_id}")
        for versions in self._versions().values():
            for _, old in versions[2:]:
                self.fs.delete(old, True)
        return True

    def upsert(self, rows: DataFrame, order: str, now: Column, batch_id: int) -> bool:
        """Upserts a batch; only its folders are read and written."""
        if batch_id <= self.current():
            return False
        touched = [r[0] for r in rows.select(self.folder()).distinct().collect()]
        current = self.read(touched)
        if current is None:
            current = self.spark.createDataFrame([], rows.drop(order).schema).withColumns({c: F.lit(None).cast("timestamp") for c in ("fecha_creacion", "fecha_actualizacion")})
        return self.write(upsert(current.drop(self.name), rows, order, now, self.keys), batch_id, touched)

    def lookup(self, **keys) -> DataFrame | None:
        """The rows with these keys: one folder is read, and in it what file statistics and Bloom filters do not rule out."""
        literals = self.spark.range(1).select(*[F.lit(keys[k]).alias(k) for k in self.keys])
        found = self.read([literals.select(self.folder()).first()[0]])
        if found is None:
            return None
        for k, v in keys.items():
            found = found.where(F.col(k) == v)
        return found
