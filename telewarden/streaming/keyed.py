"""Continuous evaluation with Spark's state store.

Readings are keyed by sensor. A sensor's state is its last value, a streak for each of its stateful
rules, and its readings of timestamps that are still open, by event time. An event-time timer closes a
timestamp as soon as the watermark has passed it: the readings are judged in order of arrival and leave
with the bits of the rules that fired. A batch reads and writes the state of those sensors only that
have new readings or a timer that is due; RocksDB ships the changes, not the whole.

All sensors share one watermark, so all readings of a timestamp leave in the same batch. There
correlations, nominal lines and text follow from the readings and their bits by the batch plan. Outputs
go to folders named by the batch, which a replayed batch overwrites.

A reading of a closed timestamp is late and goes to the quarantine, and so do rejected packets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import slice_of
from ..functions.thresholds import OPERATORS
from ..operators.numbering import counted_rows
from ..operators.sanitize import mark, packets_of
from ..operators.scan import Scan, State
from ..plans.evaluate import SLICE_ROWS, WORD, Result, words
from ..plans.rules import Rule, RuleSet
from ..schemas import ARRIVAL, REJECTS, STEP_STATE, STREAK_STATE
from ..session import Staging, exists, ship
from .incremental import Monitor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
METRICS = "batch_id bigint, arrived bigint, rows bigint, late bigint, rejected bigint, alarms bigint, newest bigint"
#: Keys over which packets without a sensor are spread; they have no state.
KEYLESS = 64
#: Name of the counts that a listener sees.
OUTCOME = "outcome"
OPEN = "moments array<bigint>, texts array<string>, values array<double>, arrivals array<string>, seqs array<bigint>"


class Judge(StatefulProcessor):
    """Judges the readings of one sensor, a timestamp at a time."""

    def __init__(self, rules: RuleSet):
        self.words = words(rules)
        self.by_sensor: dict[str, list[tuple[Rule, int, int]]] = {}
        for place, rule in enumerate(rules.base):
            self.by_sensor.setdefault(rule.sensor_id, []).append((rule, *divmod(place, WORD)))

    def fields(self) -> list[tuple[str, str]]:
        plain = [
            ("kind", "string"), ("timestamp", "string"), ("sensor_id", "string"), ("value", "double"), ("text", "string"),
            ("priority", "string"), ("reason", "string"), ("moment", "bigint"), (ARRIVAL, "string"), ("seq", "bigint"), ("line", "string"),
        ]
        return [*plain, *((name, "bigint") for name in self.words)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "value double")
        self.streak = handle.getMapState("streak", "rule_id string", "streak bigint")
        self.open = handle.getMapState("open", "millis bigint", OPEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed_to = timerValues.getCurrentWatermarkInMs()
        arrived: dict[int, list] = {}
        newest, count = None, 0
        for frame in rows:
            frame = frame[~frame["flush"]]
            count += len(frame)
            bad = frame["reason"].notna()
            on_time = ~bad & (frame["moment"] // 1000 >= closed_to)
            late = frame[~bad & ~on_time]
            if bad.any():
                yield self._out("reject", frame[bad])
            if len(late):
                yield self._out("late", late.assign(reason="late"))
            good = frame[on_time]
            if len(good):
                newest = max(int(good["moment"].max()), newest or 0)
                for row in zip(good["moment"], good["timestamp"], good["value"], good[ARRIVAL], good["seq"]):
                    arrived.setdefault(int(row[0]) // 1000, []).append(row)
        for millis, new in arrived.items():
            new.sort(key=lambda r: (r[0], r[3], r[4]))
            columns = [list(c) for c in zip(*new)]
            if self.open.containsKey((millis,)):
                columns = [[*old, *more] for old, more in zip(self.open.getValue((millis,)), columns)]
            else:
                # Due once a reading that is a millisecond newer has moved the watermark.
                self.handle.registerTimer(millis + 1)
            kinds = (int, str, float, str, int)
            self.open.updateValue((millis,), tuple([kind(x) for x in c] for kind, c in zip(kinds, columns)))
        if count:
            yield self._frame({"kind": ["seen"], "moment": [newest], "seq": [count]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        millis = expiredTimerInfo.getExpiryTimeInMs() - 1
        rows = sorted(zip(*self.open.getValue((millis,))), key=lambda r: r[0])
        self.open.removeKey((millis,))
        own = self.by_sensor.get(key[0], [])
        bits = self._judged([r[2] for r in rows], own) if own else [[0] * len(self.words)] * len(rows)
        moments, texts, values, arrivals, seqs = zip(*rows)
        data = {"kind": "reading", "timestamp": texts, "sensor_id": key[0], "value": values, "moment": moments, ARRIVAL: arrivals, "seq": seqs}
        yield self._frame(data | dict(zip(self.words, zip(*bits))))

    def close(self) -> None:
        pass

    def _judged(self, values: list[float], rules: list[tuple[Rule, int, int]]) -> list[list[int]]:
        """Fired bits of each value, in order; last value and streaks are carried in the state."""
        stepped = any(rule.type == "step_difference" for rule, _, _ in rules)
        last = self.last.get()[0] if stepped and self.last.exists() else None
        names = [rule.rule_id for rule, _, _ in rules if rule.type == "stateful"]
        before = {n: int(self.streak.getValue((n,))[0]) if self.streak.containsKey((n,)) else 0 for n in names}
        now = dict(before)
        out = []
        for value in values:
            bits = [0] * len(self.words)
            for rule, word, bit in rules:
                compare = OPERATORS.get(rule.operator)
                measure = value - (value if last is None else last) if rule.type == "step_difference" else value
                holds = compare is not None and compare(measure, rule.value)
                if rule.type == "stateful":
                    now[rule.rule_id] = now[rule.rule_id] + 1 if holds else 0
                    holds = now[rule.rule_id] >= rule.consecutive_measurements
                bits[word] += holds << bit
            last = value
            out.append(bits)
        if stepped:
            self.last.update((float(last),))
        for name in names:
            self.streak.updateValue((name,), (now[name],))
        return out

    def _out(self, kind: str, frame: pd.DataFrame) -> pd.DataFrame:
        names = ["timestamp", "sensor_id", "value", "text", "priority", "reason", "moment", ARRIVAL, "seq", "line"]
        return self._frame({"kind": kind, **{n: frame[n].to_numpy() for n in names}})

    def _frame(self, data: dict) -> pd.DataFrame:
        rows = max(len(v) for v in data.values() if not isinstance(v, str))
        frame = pd.DataFrame(index=range(rows))
        for name, kind in self.fields():
            own = data.get(name)
            own = [own] * rows if own is None or isinstance(own, str) else own
            frame[name] = pd.Series(own, dtype={"bigint": "Int64", "double": "float64", "string": object}[kind])
        return frame


class KeyedMonitor(Monitor):
    """Like ``Monitor``, with the state in the checkpoint of the stream."""

    def __init__(
        self, spark: SparkSession, rules: RuleSet, output: str, checkpoint: str,
        delay_seconds: int = 0, slice_rows: int = SLICE_ROWS, text: bool = False,
    ):
        super().__init__(spark, rules, output, checkpoint, delay_seconds, None, slice_rows, text)
        ship(spark)
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        self.flushes = f"{output}/_flushes"

    def start(self, stream: DataFrame, checkpoint: str | None = None, trigger: str | None = None) -> StreamingQuery:
        """Run over what the stream holds now, or with ``trigger`` every such interval until stopped."""
        self.stream = stream
        interval = {"processingTime": trigger} if trigger else {"availableNow": True}
        return (
            self._judged(stream)
            .writeStream.foreachBatch(self._publish)
            .option("checkpointLocation", checkpoint or self.state_path)
            .trigger(**interval)
            .start()
        )

    def flush(self) -> None:
        """Close what is still open, at the end of a finite input that ``start`` was given.

        A marker moves the watermark past the newest reading; readings at or before it are late from then on.
        """
        newest = self.metrics().agg(F.max("newest").alias("t")).first().t
        if newest is None:
            return
        beyond = (newest // 1000 + 1) * 1000 + self.delay_seconds * 1_000_000
        self.spark.range(1).select(F.lit(beyond).alias("moment")).write.mode("append").parquet(self.flushes)
        self.start(self.stream).awaitTermination()

    def process(self, raw: DataFrame, batch_id: int, source: str = "") -> None:
        raise NotImplementedError("batches are made by the stream itself")

    def metrics(self) -> DataFrame:
        """Per batch: packets that came, readings judged, late and rejected ones, alarms, newest event time."""
        return self._read("metrics", METRICS)

    def state(self) -> State:
        """State after the last batch, read from the state store."""
        def read(name: str) -> DataFrame:
            return self.spark.read.format("statestore").option("stateVarName", name).load(self.state_path)

        step = read("last").select(F.col("key.watched").alias("sensor_id"), F.col("value.value").alias("last_value"))
        streak = read("streak").select(F.col("user_map_key.rule_id"), F.col("key.watched").alias("sensor_id"), F.col("user_map_value.streak"))
        return State(step.to(STEP_STATE), streak.to(STREAK_STATE))

    def open_readings(self) -> DataFrame:
        """Sensor and time of the readings that are still held, read from the state store."""
        held = self.spark.read.format("statestore").option("stateVarName", "open").load(self.state_path)
        return held.select(F.col("key.watched").alias("sensor_id"), F.explode("user_map_value.texts").alias("timestamp"))

    def _judged(self, stream: DataFrame) -> DataFrame:
        if not exists(self.spark, self.flushes):
            self.spark.createDataFrame([], "moment bigint").write.parquet(self.flushes)
        if "seq" not in stream.columns:
            stream = counted_rows(stream, "seq")
        if ARRIVAL not in stream.columns:
            stream = stream.withColumn(ARRIVAL, F.lit(""))
        packets = packets_of(mark(stream)).withColumn("flush", F.lit(False))
        markers = self.spark.readStream.schema("moment bigint").parquet(self.flushes)
        markers = markers.select("moment", F.timestamp_micros("moment").alias("event_time"), F.lit(True).alias("flush"))
        keyless = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("timestamp", "seq"), F.lit(KEYLESS)))
        # After the union, so that there is one watermark, which a marker moves like any reading.
        key = F.when(F.col("reason").isNull() & ~F.col("flush"), F.col("sensor_id")).otherwise(keyless)
        both = packets.unionByName(markers, allowMissingColumns=True).withWatermark("event_time", f"{self.delay_seconds} seconds")
        # Without the watermarked column late rows reach the processor, which says so.
        rows = both.withColumns({"moment": F.unix_micros("event_time"), "watched": key}).drop("event_time")
        judge = Judge(self.rules)
        schema = ", ".join(f"{name} {kind}" for name, kind in judge.fields())
        out = rows.groupBy("watched").transformWithStateInPandas(judge, schema, "Append", "EventTime")
        kind = F.col("kind")
        return out.observe(
            OUTCOME,
            F.coalesce(F.sum(F.when(kind == "seen", F.col("seq"))), F.lit(0)).alias("arrived"),
            F.count_if(kind == "reading").alias("rows"),
            F.count_if(kind == "late").alias("late"),
            F.count_if(kind == "reject").alias("rejected"),
        )

    def _publish(self, out: DataFrame, batch_id: int) -> None:
        """Outputs of the timestamps that this batch has closed."""
        staging = Staging(self.spark)
        try:
            # The state is changed by running this once.
            out = staging(out, "out")
            kind = F.col("kind")
            counts = out.agg(
                F.coalesce(F.sum(F.when(kind == "seen", F.col("seq"))), F.lit(0)).alias("arrived"),
                F.count_if(kind == "reading").alias("rows"),
                F.count_if(kind == "late").alias("late"),
                F.count_if(kind == "reject").alias("rejected"),
                F.max(F.when(kind == "seen", F.col("moment"))).alias("newest"),
            ).first()
            # Many batches only take readings in, or only close timestamps.
            alarms = self._publish_closed(out, batch_id, staging) if counts.rows else 0
            if counts.late + counts.rejected:
                refused = out.filter("kind IN ('late', 'reject')").select(
                    "timestamp", "sensor_id", F.coalesce("text", F.col("value").cast("string")).alias("value"), "priority", "seq",
                    F.col("reason").alias("reject_reason"), "line",
                )
                self._out(refused.to(REJECTS), "quarantine", batch_id)
            row = (batch_id, counts.arrived, counts.rows, counts.late, counts.rejected, alarms, counts.newest)
            self._out(self.spark.createDataFrame([row], METRICS), "metrics", batch_id)
        finally:
            staging.drop()

    def _publish_closed(self, out: DataFrame, batch_id: int, staging: Staging) -> int:
        """Alarms and nominal lines; the number of alarms comes back."""
        readings = out.filter("kind = 'reading'").orderBy("moment", ARRIVAL, "seq")
        readings = readings.select(
            "timestamp", "sensor_id", "value", F.monotonically_increasing_id().alias("seq"), *words(self.rules)
        )
        readings = staging(readings, "readings").withColumns(
            {"watch": self.rules.watch(), "slice": slice_of(F.col("seq"), self.slice_rows)}
        )
        return self._write_outputs(Result(readings, Scan(readings, readings, None), self.rules, None, staging), batch_id)

    def _read(self, name: str, schema) -> DataFrame:
        if not exists(self.spark, f"{self.output}/{name}"):
            return self.spark.createDataFrame([], schema)
        return super()._read(name, schema)
