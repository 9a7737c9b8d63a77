"""Rule catalogue (JSON array) and sensor catalogue (YAML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RULES, SENSORS

try:
    import yaml
except ImportError:
    yaml = None


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Raw rules with ``pos``, their place in the file."""
    rules = spark.read.schema(RULES).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rules.withColumn("pos", F.monotonically_increasing_id())


def load_sensors(spark: SparkSession, path: str) -> DataFrame:
    """Sensor dimension from a file or all files of a folder; an empty catalogue is an error.

    Each file is parsed by the task that reads it.
    """
    if yaml is None:
        raise ImportError("reading a sensor catalogue needs PyYAML")
    sensors = spark.read.text(path, wholetext=True).mapInArrow(_parsed, SENSORS)
    if sensors.isEmpty():
        raise ValueError(f"no sensors in {path}")
    return sensors


def _parsed(batches):
    import pyarrow as pa
    import yaml

    # Numbers and the like keep the text they are written with.
    loader = yaml.BaseLoader
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            config = yaml.load(text or "", loader) or {}
            craft = config.get("spacecraft_id")
            rows += [(s["id"], s.get("sampling_rate"), s.get("unit"), craft) for s in config.get("sensors") or []]
        names = ["id", "sampling_rate", "unit", "spacecraft_id"]
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, names)


def sensor_frame(spark: SparkSession, sensors: list[dict], spacecraft: str | None = None) -> DataFrame:
    rows = [
        (s["id"], s.get("sampling_rate"), s.get("unit"), spacecraft) for s in sensors
    ]
    return spark.createDataFrame(rows, SENSORS)
