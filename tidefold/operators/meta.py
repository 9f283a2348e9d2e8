"""Log metadata added to the value document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidefold.functions.walk import as_struct
from tidefold.model import field

# Names of the added fields.
POSITION_FIELD = "topic-partition-offset"
TIMESTAMP_TYPES = ("CREATE_TIME", "LOG_APPEND_TIME", "NO_TIMESTAMP_TYPE")


def add_log_metadata(df: DataFrame) -> DataFrame:
    """Add the log position and the record time to the value.

    The time field carries the name of the record's timestamp type.  A struct has
    one set of names for all rows, so each type has its field and the others stay null.
    """
    value = F.col("value")
    own = [field(value, f.name).alias(f.name) for f in df.schema["value"].dataType.fields
           if f.name not in (POSITION_FIELD, *TIMESTAMP_TYPES)]
    times = [
        F.when(F.col("timestamp_type") == t, F.unix_millis("timestamp")).alias(t) for t in TIMESTAMP_TYPES[:2]
    ]
    position = F.concat_ws("-", "topic", "partition", "offset").alias(POSITION_FIELD)
    return df.withColumn("value", as_struct(value, own + [position] + times))
