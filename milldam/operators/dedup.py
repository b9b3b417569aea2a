"""Ordered duplicate removal inside a message.

First by id, then by name and city: a row is refused if an accepted earlier row of its message has its id, or else its
name and city; refused rows register nothing. That is a greedy fold in order: rows are sorted by message and place and
stream through a task that holds the keys of one message, which are fewer than the message's own bytes. id_name_fold()
gives the same as an aggregate without Python, for messages known to be short: its steps grow with the square of them.

Then, among the accepted, by phone and by e-mail: the first row with a phone registers it whatever becomes of its
e-mail, and an e-mail counts for rows that passed the phone test, so two first-row windows are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID, NAME = "duplicate_id_within_message", "duplicate_name_city_within_message"
PHONE, EMAIL = "duplicate_phone_in_message", "duplicate_email_in_message"


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_id": F.upper("station_id"), "_name": F.concat_ws("\x1f", F.upper("name"), F.upper(F.coalesce("city", F.lit(""))))})


def id_name_fold(df: DataFrame, scope: str = "message_id", order: str = "ordinal") -> DataFrame:
    """(scope, order, dup) by folding over each message's rows."""
    df = _keyed(df)
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_id").alias("i"), F.col("_name").alias("n"))))
    start = F.struct(F.array().cast("array<string>").alias("ids"), F.array().cast("array<string>").alias("names"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, r: Column) -> Column:
        by_id, by_name = F.array_contains(s.ids, r.i), F.array_contains(s.names, r.n)
        why = F.when(by_id, ID).when(by_name, NAME).otherwise("")
        fine = ~by_id & ~by_name
        return F.struct(
            F.when(fine, F.array_append(s.ids, r.i)).otherwise(s.ids).alias("ids"),
            F.when(fine, F.array_append(s.names, r.n)).otherwise(s.names).alias("names"),
            F.array_append(s.out, why).alias("out"),
        )

    folded = df.groupBy(scope).agg(rows.alias("rows")).select(scope, "rows", F.aggregate("rows", start, step, lambda s: s.out).alias("out"))
    return folded.select(scope, F.explode(F.arrays_zip("rows", "out")).alias("z")).select(scope, F.col("z.rows.o").alias(order), F.nullif(F.col("z.out"), F.lit("")).alias("dup"))


def id_name(df: DataFrame, scope: str = "message_id", order: str = "ordinal") -> DataFrame:
    """Adds `dup`, the reason of refusal by id or name and city (null: kept). A missing id or name never collides."""
    sorted_ = _keyed(df).repartition(scope).sortWithinPartitions(scope, order)
    at, names_out = df.columns.index(scope), [*df.columns, "dup"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, names = object(), set(), set()
        for batch in batches:
            reasons = []
            for key, i, n in zip(batch.column(at).to_pylist(), batch.column("_id").to_pylist(), batch.column("_name").to_pylist(), strict=True):
                if key != now:
                    now, ids, names = key, set(), set()
                why = ID if i is not None and i in ids else NAME if n is not None and n in names else None
                if why is None:
                    ids.add(i)
                    names.add(n)
                reasons.append(why)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names_out) - 1], pa.array(reasons, pa.string())], names=names_out)

    return sorted_.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("dup", T.StringType())]))


def contact(df: DataFrame, scope: str = "message_id", order: str = "ordinal") -> DataFrame:
    """Adds `dup` by phone or e-mail, over rows that id_name() kept; missing values never collide."""
    phone, email = F.nullif(F.upper("phone"), F.lit("")), F.nullif(F.lower("email"), F.lit(""))
    first = lambda *keys: F.row_number().over(Window.partitionBy(scope, *keys).orderBy(order))
    own = F.concat_ws("/", F.lit("\x1f"), F.col(order).cast("string"))  # rows without a value are spread over groups of their own
    marked = df.withColumn("_p", F.coalesce(phone, own)).withColumn("_again", phone.isNotNull() & (first("_p") > 1))
    marked = marked.withColumn("_e", F.when(F.col("_again"), own).otherwise(F.coalesce(email, own)))
    repeated = ~F.col("_again") & email.isNotNull() & (first("_e") > 1)
    return marked.withColumn("dup", F.when(F.col("_again"), PHONE).when(repeated, EMAIL)).drop("_p", "_e", "_again")


def chain(df: DataFrame, scope: str = "message_id", order: str = "ordinal") -> DataFrame:
    """Adds `dup` of both tests, the second over what the first kept: refused rows have no phone and e-mail in its windows."""
    one = id_name(df, scope, order).withColumnRenamed("dup", "_dup")
    hidden = {c: F.col(c) for c in ("phone", "email")}
    masked = one.withColumns({f"_{c}": v for c, v in hidden.items()}).withColumns({c: F.when(F.col("_dup").isNull(), v) for c, v in hidden.items()})
    both = contact(masked, scope, order).withColumns({c: F.col(f"_{c}") for c in hidden})
    return both.withColumn("dup", F.coalesce("_dup", "dup")).drop("_dup", "_phone", "_email")
