"""Row shapes shared by every operator.

Change log   topic, partition, offset, timestamp, timestamp_type, key, value
Operation    k, op, upsert, doc, present, ord          (typed documents)
             k, op, upsert, sets, unsets, ord          (JSON documents)

`op` is one of REPLACE, SET, DELETE.  `ord` is any orderable column that grows in
the order the operations of one key must be applied in.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

ID = "_id"
REPLACE, SET, DELETE = "replace", "set", "delete"

LOG_POSITION = ["topic", "partition", "offset"]
LOG_META = LOG_POSITION + ["timestamp", "timestamp_type"]

LOG_META_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestamp_type", T.StringType()),
    ]
)


def log_schema(key: T.DataType | str, value: T.DataType | str) -> T.StructType:
    """Change-log schema with the given key and value types."""
    parse = lambda t: T.StructType.fromDDL(t) if isinstance(t, str) else t
    return T.StructType(
        LOG_META_SCHEMA.fields
        + [T.StructField("key", parse(key)), T.StructField("value", parse(value))]
    )


# names of the top-level fields a record's value holds (null: not known)
PRESENT = "present"
# running maximum of the record time, see operators.scan.order_times
ORDER_TIME = "order_time"


def log_position(log) -> list[str]:
    """Columns that place a record, with its order across topics where that is known."""
    return LOG_POSITION + ([ORDER_TIME] if ORDER_TIME in log.columns else [])


def log_ord(sub: Column | int = 0, log=None) -> Column:
    """Order of one key's records: its log offset, then the place inside the record.

    Records of a log with order times come in the order of these.
    """
    sub = F.lit(sub) if isinstance(sub, int) else sub
    place = [F.col("offset").alias("offset"), sub.cast("int").alias("sub")]
    if log is not None and ORDER_TIME in log.columns:
        place = [F.col(ORDER_TIME).alias("time"), F.col("topic"), F.col("partition"), *place]
    return F.struct(*place)


def struct_type(df, column: str) -> T.StructType | None:
    """The StructType of a column, or None when the column is of another type."""
    dtype = df.schema[column].dataType
    return dtype if isinstance(dtype, T.StructType) else None


def field(parent: Column, name: str) -> Column:
    """Struct field by its exact name (the name may hold dots)."""
    return parent.getField(name)
