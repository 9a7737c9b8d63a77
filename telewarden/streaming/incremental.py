"""Micro-batch evaluation with state tables.

Every micro-batch runs the batch plan over its closed timestamps, if any closed. What must survive is
kept in parquet tables per commit: last values, streaks, what arrived for timestamps that are still open,
and the boundary up to which timestamps are closed. The boundary names the commits whose open readings
still count, so that these are not written again in each batch; folders of one size are put together once
there are ``MERGED`` of them, and one whose newest reading is closed is dropped. Commits have numbers of their own, so that a flush can
stand between two batches of a stream. A commit writes its outputs into folders named by its number
and its boundary last; until then the state before it is the latest, and a replayed batch overwrites
the same folders. A batch that was committed is not judged again. Outputs are only ever added.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.sanitize import sanitize
from ..operators.scan import State
from ..plans.evaluate import SLICE_ROWS, Result, evaluate
from ..plans.rules import RuleSet
from ..schemas import ALARMS, ARRIVAL, REJECTS, STEP_STATE, STREAK_STATE, TELEMETRY
from ..session import Staging, children, observed, remove
from ..sinks import alarm_lines, nominal_lines, pack_nominal

# Boundaries are event times in microseconds since the epoch.
OPEN = "array<struct<batch: bigint, oldest: bigint, newest: bigint, level: int>>"
METRICS = "boundary bigint, batch_id bigint, rows bigint, late bigint, alarms bigint, source string, source_batch bigint"
BOUNDARY = f"{METRICS}, pending {OPEN}"
NOMINAL = "timestamp string, status string, sensor_string string"
BEGINNING = -(1 << 62)
# Named for batches outside a stream.
DIRECT = "direct"
# Commits whose state stays: the latest and the one before, for a reader that has just begun.
KEPT_COMMITS = 2
# Folders of open readings, of one level, that are put together into one of the next level.
MERGED = 8


@dataclass(frozen=True)
class Held:
    """Open readings of a commit: event times of the oldest and newest, and how often they were put together."""

    batch: int
    oldest: int
    newest: int
    level: int = 0


class Monitor:
    """Evaluates micro-batches into ``output``; state lives under ``state_path``.

    ``delay_seconds`` holds timestamps back until a reading that much newer has been
    seen; the newest timestamp is always held. With ``total_sensors`` a held timestamp
    closes early once it and all older ones have a reading of that many sensors.
    ``text`` also writes the semicolon-separated lines.
    """

    def __init__(
        self,
        spark: SparkSession,
        rules: RuleSet,
        output: str,
        state_path: str,
        delay_seconds: int = 0,
        total_sensors: int | None = None,
        slice_rows: int = SLICE_ROWS,
        text: bool = False,
    ):
        if delay_seconds < 0:
            raise ValueError(f"delay_seconds must not be negative, got {delay_seconds}")
        if total_sensors is not None and total_sensors <= 0:
            raise ValueError(f"total_sensors must be positive, got {total_sensors}")
        self.spark = spark
        self.rules = rules
        self.output = output
        self.state_path = state_path
        self.delay_seconds = delay_seconds
        self.total_sensors = total_sensors
        self.slice_rows = slice_rows
        self.text = text

    def start(self, stream: DataFrame, checkpoint: str, trigger: str | None = None):
        """Run over what the stream holds now, or with ``trigger`` every such interval until stopped."""

        def process(raw: DataFrame, batch_id: int) -> None:
            self.process(raw, batch_id, checkpoint)

        interval = {"processingTime": trigger} if trigger else {"availableNow": True}
        return (
            stream.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(**interval)
            .start()
        )

    def process(self, raw: DataFrame, batch_id: int, source: str = DIRECT) -> None:
        """One micro-batch: raw packets in, outputs and state of the next commit out.

        ``source`` tells streams apart, whose batches are numbered by their checkpoints.
        """
        last = self._committed()
        if last is not None and last.source == source and batch_id <= last.source_batch:
            return
        self._run(raw, last, source, batch_id, close_all=False)

    def flush(self) -> None:
        """Evaluate what is still held back, at the end of a finite input.

        The boundary it leaves is binding: a reading at or before it that comes later is late.
        """
        last = self._committed()
        if last is None:
            return
        empty = self.spark.createDataFrame([], TELEMETRY).drop("event_time", "seq")
        self._run(empty, last, last.source, last.source_batch, close_all=True)

    def alarms(self) -> DataFrame:
        return self._read("alarms", ALARMS)

    def nominal(self) -> DataFrame:
        return self._read("nominal", NOMINAL)

    def quarantine(self) -> DataFrame:
        return self._read("quarantine", REJECTS)

    def state(self) -> State:
        """State after the last commit."""
        last = self._committed()
        number = None if last is None else last.batch_id
        return State(
            self._state("step", number, STEP_STATE), self._state("streak", number, STREAK_STATE)
        )

    def metrics(self) -> DataFrame:
        """Per commit: boundary, number, evaluated rows, late rows, alarms."""
        names = ("boundary", "batch_id", "rows", "late", "alarms")
        return self.spark.read.schema(METRICS).parquet(f"{self.output}/metrics/*").select(*names)

    def _run(self, raw: DataFrame, last, source: str, source_batch: int, close_all: bool) -> None:
        staging = Staging(self.spark)
        previous, closed_to = (None, BEGINNING) if last is None else (last.batch_id, last.boundary)
        number = 0 if previous is None else previous + 1
        moment = F.unix_micros("event_time")
        try:
            cleaned = sanitize(raw)
            clean = cleaned.clean
            if ARRIVAL not in clean.columns:
                clean = clean.withColumn(ARRIVAL, F.lit(""))
            marked = clean.withColumns({"batch_id": F.lit(number).cast("bigint"), "late": moment < closed_to})
            arrived = staging(marked, "arrived")
            fresh = arrived.filter("NOT late").drop("late")
            on_time = F.when(~F.col("late"), moment)
            came = arrived.agg(F.min(on_time).alias("oldest"), F.max(on_time).alias("newest"), F.count_if("late").alias("late")).first()
            open_before = self._open(last)
            held = open_before if came.newest is None else [*open_before, Held(number, came.oldest, came.newest)]
            waiting = self._pending(open_before).filter(moment >= closed_to).unionByName(fresh)
            boundary = self._next_boundary(waiting, max((h.newest for h in held), default=None), closed_to, close_all)
            step, streak = (
                self._state("step", previous, STEP_STATE), self._state("streak", previous, STREAK_STATE)
            )
            rows = found = 0
            if any(h.oldest < boundary for h in held):
                # Order of evaluation: event time, then arrival. Numbered once, then reread.
                closed = staging(
                    waiting.filter(moment < boundary)
                    .orderBy("event_time", "batch_id", ARRIVAL, "seq")
                    .withColumn("order", F.monotonically_increasing_id()),
                    "closed",
                )
                rows = closed.count()
                result = evaluate(
                    closed.drop("seq", "batch_id", ARRIVAL).withColumnRenamed("order", "seq"),
                    self.rules,
                    None if previous is None else State(step, streak),
                    self.slice_rows,
                    staging,
                )
                found = self._write_outputs(result, number)
                step, streak = result.state_out.step, result.state_out.streak
            else:
                self._write_frames(self._none(ALARMS), self._none(NOMINAL), number)
            self._write_quarantine(cleaned.rejects, arrived.filter("late"), number)
            self._put(step, "step", number)
            self._put(streak, "streak", number)
            still = [replace(h, oldest=max(h.oldest, boundary)) for h in held if h.newest >= boundary]
            held = self._hold(fresh.filter(moment >= boundary), still, boundary, number)
            facts = self.spark.range(1).select(
                F.lit(boundary).cast("bigint").alias("boundary"),
                F.lit(number).cast("bigint").alias("batch_id"),
                F.lit(rows).cast("bigint").alias("rows"),
                F.lit(came.late).cast("bigint").alias("late"),
                F.lit(found).cast("bigint").alias("alarms"),
                F.lit(source).alias("source"),
                F.lit(source_batch).cast("bigint").alias("source_batch"),
            )
            self._out(facts, "metrics", number)
            entries = F.array(*(F.struct(*map(F.lit, astuple(h))) for h in held)).cast(OPEN)
            self._put(facts.withColumn("pending", entries), "boundary", number)
            self._forget(number - KEPT_COMMITS, {h.batch for h in [*open_before, *held]})
        finally:
            staging.drop()

    def _next_boundary(self, waiting: DataFrame, newest: int | None, closed_to: int, close_all: bool) -> int:
        """Event time below which every timestamp is closed; at most one row comes back."""
        moment = F.unix_micros("event_time")
        if newest is None:
            return closed_to
        if close_all:
            return newest + 1
        held_from = newest - self.delay_seconds * 1_000_000
        if self.total_sensors is not None:
            incomplete = (
                waiting.filter(moment >= held_from)
                .groupBy("event_time", "sensor_id")
                .agg(F.count("*").alias("n"))
                .groupBy("event_time")
                .agg(F.count("*").alias("sensors"))
                .filter(F.col("sensors") < self.total_sensors)
            )
            first_open = incomplete.agg(F.min(moment).alias("t")).first().t
            held_from = newest + 1 if first_open is None else first_open
        return max(held_from, closed_to)

    def _hold(self, fresh: DataFrame, held: list[Held], boundary: int, number: int) -> list[Held]:
        """Write the open readings that came with this commit, with those of earlier commits whose turn it is."""
        mine = [h for h in held if h.batch == number]
        if not mine:
            return held
        older, level = [h for h in held if h.batch != number], 0
        while len(same := [h for h in older if h.level == level]) >= MERGED - 1:
            mine += same
            older = [h for h in older if h.level != level]
            level += 1
        if len(mine) > 1:
            again = self._pending([h for h in mine if h.batch != number])
            fresh = fresh.unionByName(again.filter(F.unix_micros("event_time") >= boundary))
        self._put(fresh, "pending", number)
        return [*older, Held(number, min(h.oldest for h in mine), max(h.newest for h in mine), level)]

    def _write_outputs(self, result: Result, batch_id: int) -> int:
        """Write both outputs; the number of alarms comes back."""
        return self._write_frames(result.alarms, pack_nominal(result.valid, ordered=True), batch_id)

    def _write_frames(self, alarms: DataFrame, nominal: DataFrame, batch_id: int) -> int:
        counted = Observation()
        self._out(alarms.observe(counted, F.count(F.lit(1)).alias("alarms")), "alarms", batch_id)
        self._out(nominal, "nominal", batch_id)
        if self.text:
            lines = {
                "alarms_text": alarm_lines(alarms),
                "nominal_text": nominal_lines(
                    self._output("nominal", batch_id, NOMINAL).orderBy("timestamp")
                ),
            }
            for name, df in lines.items():
                df.write.mode("overwrite").text(f"{self.output}/{name}/batch_id={batch_id}")
        return observed(counted, "alarms")

    def _write_quarantine(self, rejects: DataFrame, late: DataFrame, batch_id: int) -> None:
        too_late = late.select(
            "timestamp",
            "sensor_id",
            F.col("value").cast("string").alias("value"),
            "priority",
            "seq",
            F.lit("late").alias("reject_reason"),
            F.lit(None).cast("string").alias("line"),
        )
        self._out(rejects.unionByName(too_late), "quarantine", batch_id)

    def _out(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.output}/{name}/batch_id={batch_id}")

    def _output(self, name: str, batch_id: int, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.output}/{name}/batch_id={batch_id}")

    def _read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.output}/{name}/*")

    def _put(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.state_path}/{name}/batch={batch_id}")

    def _state(self, name: str, number: int | None, schema) -> DataFrame:
        if number is None:
            return self._none(schema)
        return self.spark.read.schema(schema).parquet(f"{self.state_path}/{name}/batch={number}")

    def _none(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema).limit(0)

    def _open(self, last) -> list[Held]:
        """Open readings as the last commit names them; one of an earlier version has all in its own folder."""
        if last is None:
            return []
        if last.pending is not None:
            return [Held(*h) for h in last.pending]
        moment = F.unix_micros("event_time")
        ends = self._pending([Held(last.batch_id, 0, 0)]).agg(F.min(moment), F.max(moment)).first()
        return [] if ends[0] is None else [Held(last.batch_id, *ends)]

    def _pending(self, held: list[Held]) -> DataFrame:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TELEMETRY)
        schema = f"{fields}, {ARRIVAL} string, batch_id bigint"
        if not held:
            return self._none(schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.state_path}/pending/batch={h.batch}" for h in held))

    def _committed(self):
        """The latest commit, of which the folder of boundaries holds a few; None before the first.

        A boundary without its success mark was not written to the end.
        """
        names = [n for n in children(self.spark, f"{self.state_path}/boundary") if n.startswith("batch=")]
        for number in sorted((int(n.removeprefix("batch=")) for n in names), reverse=True):
            path = f"{self.state_path}/boundary/batch={number}"
            if "_SUCCESS" in children(self.spark, path):
                return self.spark.read.schema(BOUNDARY).parquet(path).first()
        return None

    def _forget(self, number: int, held: set[int]) -> None:
        """Drop the state of a commit that has two later ones, and open readings that neither of these names."""
        if number >= 0:
            for name in ("boundary", "step", "streak"):
                remove(self.spark, f"{self.state_path}/{name}/batch={number}")
        kept = {f"batch={h}" for h in held}
        for name in children(self.spark, f"{self.state_path}/pending"):
            if name not in kept:
                remove(self.spark, f"{self.state_path}/pending/{name}")
