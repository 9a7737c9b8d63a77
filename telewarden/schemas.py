"""Fixed schemas; nothing in this package infers one."""

from pyspark.sql import types as T

MANDATORY = ("timestamp", "sensor_id", "value")
CORRUPT = "_corrupt"
# Order of files in a stream; only streamed readings have it.
ARRIVAL = "arrival"

TELEMETRY = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("priority", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("reject_reason", T.StringType()),
        # The line or payload as it came, where it could not be read.
        T.StructField("line", T.StringType()),
    ]
)

PACKET = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

RULES = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("operator", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("consecutive_measurements", T.IntegerType()),
        T.StructField("logic", T.StringType()),
        T.StructField("conditions", T.ArrayType(T.StringType())),
        T.StructField("priority", T.StringType()),
    ]
)

SENSORS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("sampling_rate", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("spacecraft_id", T.StringType()),
    ]
)

ALARMS = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("rule_id", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

STEP_STATE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("last_value", T.DoubleType()),
    ]
)

STREAK_STATE = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("streak", T.LongType()),
    ]
)
