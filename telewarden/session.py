"""Session defaults and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkAssertionError
from pyspark.sql import DataFrame, Observation, SparkSession


def local_session(cores: str = "8", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("telewarden")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="telewarden-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


class Staging:
    """Writes intermediate frames as parquet tables under the shared folder.

    A staged table is read back with column pruning and outlives lost executors.
    """

    made: list[Staging] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
        Staging.made.append(self)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove this run's staged tables."""
        remove(self.spark, self.root)
        if self in Staging.made:
            Staging.made.remove(self)

    @classmethod
    def drop_all(cls) -> None:
        """Remove every staged table of this process, once no frame that reads one is needed."""
        for staging in list(cls.made):
            staging.drop()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session; what runs in Python there needs it."""
    context = spark.sparkContext
    if getattr(context, "_telewarden_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="telewarden-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._telewarden_shipped = True


def observed_row(observation: Observation) -> dict[str, int]:
    """Counts taken while writing. A plan found empty reports nothing."""
    try:
        return dict(observation.get)
    except (Py4JJavaError, AttributeError, AssertionError, PySparkAssertionError):
        return {}


def observed(observation: Observation, name: str) -> int:
    return observed_row(observation).get(name, 0)


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _file_system(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has written, on whatever file system it is."""
    target, system = _file_system(spark, path)
    system.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target's parent is made if it is absent."""
    here, system = _file_system(spark, source)
    there, _ = _file_system(spark, target)
    system.mkdirs(there.getParent())
    if not system.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is absent."""
    target, system = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(target)) if system.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    target, system = _file_system(spark, path)
    system.create(target, True).close()


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
