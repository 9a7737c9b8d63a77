"""Outputs of a run become visible together.

A run writes into a folder of its own below the output. Once all of it is there, a mark says so, and
its parts are moved to their places. A run that ended in between is finished by the next one; one
that ended before the mark leaves nothing behind.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import children, exists, move, remove, touch

# Parts of a run that was appended: their names come after those of all earlier runs.
PART = "part-"
LATER = "part-r"
RUNS = "_runs"
READY = "_READY"


class Publication:
    """``with Publication(...) as run``: write to ``run.path(name)``; leaving publishes."""

    def __init__(self, spark: SparkSession, output: str, names: tuple[str, ...], mode: str):
        if mode not in ("overwrite", "append"):
            raise ValueError(f"mode must be overwrite or append, got {mode}")
        self.spark, self.output, self.names, self.mode = spark, output, names, mode
        self.root = f"{output}/{RUNS}/{mode}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __enter__(self) -> Publication:
        recover(self.spark, self.output)
        touch(self.spark, f"{self.root}/_names/" + ",".join(self.names))
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            remove(self.spark, self.root)
            return
        touch(self.spark, f"{self.root}/{READY}")
        _publish(self.spark, self.output, self.root)


def recover(spark: SparkSession, output: str) -> None:
    """Finish runs that were complete, drop those that were not."""
    for run in children(spark, f"{output}/{RUNS}"):
        root = f"{output}/{RUNS}/{run}"
        if exists(spark, f"{root}/{READY}"):
            _publish(spark, output, root)
        else:
            remove(spark, root)


def _run_number(spark: SparkSession, root: str, name: str, target: str) -> int:
    """One more than the last run appended to the folder, chosen once for a run."""
    chosen = children(spark, f"{root}/_number_{name}")
    if not chosen:
        runs = [int(p.removeprefix(LATER).split("-")[0]) for p in children(spark, target) if p.startswith(LATER)]
        chosen = [str(max(runs, default=0) + 1)]
        touch(spark, f"{root}/_number_{name}/{chosen[0]}")
    return int(chosen[0])


def _publish(spark: SparkSession, output: str, root: str) -> None:
    """Move what is still in the run's folder; may be repeated after a crash at any point."""
    names = children(spark, f"{root}/_names")[0].split(",")
    overwrite = root.rpartition("/")[2].startswith("overwrite-")
    for name in names:
        source, target, done = f"{root}/{name}", f"{output}/{name}", f"{root}/_done_{name}"
        if exists(spark, done):
            continue
        if overwrite or not exists(spark, target):
            remaining = exists(spark, source)
            if overwrite and (remaining or not exists(spark, f"{root}/_moved_{name}")):
                remove(spark, target)
            if remaining:
                touch(spark, f"{root}/_moved_{name}")
                move(spark, source, target)
        else:
            number = _run_number(spark, root, name, target)
            for part in children(spark, source):
                if not part.startswith(("_", ".")):
                    move(spark, f"{source}/{part}", f"{target}/{LATER}{number:06d}-{part.removeprefix(PART)}")
        touch(spark, done)
    remove(spark, root)
    if not children(spark, f"{output}/{RUNS}"):
        remove(spark, f"{output}/{RUNS}")
