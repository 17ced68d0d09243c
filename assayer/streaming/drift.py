"""Prediction drift per time window: population stability and Page-Hinkley alarms.

The shares of predicted labels (and of unparseable predictions) in a window are compared with those
of a reference, the first windows of the same key: the population stability index is the
sum of (p - r) * ln(p / r). The Page-Hinkley test watches the mean confidence of the windows
for a lasting rise or fall. Both follow from evaluation cells, so a key's task gets some
hundred sums a window however many rows there are.

On a stream the reference and the test's sums are the key's state, and a timer tells when a key
falls silent; on a table the same rows come from window functions over the keys' windows.

Defined results: windows of the reference have no index; shares are smoothed by half a row per
class, so that an absent class has a finite index; a window without rows makes no row, except
that a key without rows for the ``silence`` gets one with ``silent`` set, at the end of its
last window; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..functions.vocabulary import LABELS
from ..operators.evaluation import CONFIDENCE_UNIT
from .scoring import start_appending

CLASSES = (*LABELS, "invalid")
#: Rows that smoothing adds to each class.
HALF = 0.5
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class DriftLimits:
    """When a window raises an alarm.

    ``reference`` windows make up the reference; ``stability`` is the index from which
    shares have shifted; ``tolerance`` is the change of the mean confidence that does not count,
    ``page_hinkley`` the summed change that does; ``silence`` is in seconds.
    """

    reference: int = 7
    stability: float = 0.2
    tolerance: float = 0.005
    page_hinkley: float = 0.05
    silence: int = 3 * 86_400


_COUNTS = ", ".join(f"n_{c} bigint" for c in CLASSES)
_MEASURES = (
    f"window_start timestamp, examples bigint, {_COUNTS}, mean_confidence double, "
    "stability_index double, rise double, fall double, shifted boolean, drifting boolean, silent boolean"
)
MEASURES = tuple(field.split()[0] for field in _MEASURES.split(", "))


def window_counts(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, the window's start, its rows per predicted class and its summed confidence."""
    counts = [
        F.sum(F.when(_predicted(c), F.col("n")).otherwise(0)).alias(f"n_{c}") for c in CLASSES
    ]
    return (
        cells.groupBy(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
        .agg(F.sum("n").alias("examples"), *counts, F.sum("confidence_sum").alias("confidence_sum"))
    )


def _predicted(name: str) -> Column:
    prediction = F.col("prediction")
    return prediction.isNull() if name == CLASSES[-1] else prediction.eqNullSafe(F.lit(name))


def _mean() -> Column:
    return F.col("confidence_sum").cast("double") / (F.col("examples") * float(CONFIDENCE_UNIT))


def drift(
    cells: DataFrame,
    by: Sequence[str] = (),
    limits: DriftLimits = DriftLimits(),
    until: Column | None = None,
) -> DataFrame:
    """A row per key and window of a table of windowed cells, with its measures and alarms.

    ``until`` is the time up to which the table is complete: keys that have been silent for long
    by then get a row more. The windows of a key are few, so they fit a task.
    """
    own = Window.partitionBy(*by).orderBy("window_start") if by else Window.orderBy("window_start")
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = window_counts(cells, by).withColumns(
        {"__x": _mean(), "__place": F.row_number().over(own), "__last": F.max("window_end").over(whole)}
    )
    inside = F.col("__place") <= limits.reference
    reference = {
        f"__r_{c}": F.sum(F.when(inside, F.col(f"n_{c}"))).over(whole) for c in CLASSES
    }
    rows = counted.withColumns(reference).withColumn("__mean", F.avg("__x").over(so_far))
    smoothed = HALF * len(CLASSES)
    all_reference = sum(F.col(f"__r_{c}") for c in CLASSES)

    def term(c: str) -> Column:
        p = (F.col(f"n_{c}") + HALF) / (F.col("examples") + smoothed)
        r = (F.col(f"__r_{c}") + HALF) / (all_reference + smoothed)
        return (p - r) * F.ln(p / r)

    index = F.when(~inside, sum(term(c) for c in CLASSES))
    apart = F.col("__x") - F.col("__mean")
    rows = rows.withColumns(
        {
            "__up": F.sum(apart - limits.tolerance).over(so_far),
            "__down": F.sum(apart + limits.tolerance).over(so_far),
            "stability_index": index,
        }
    ).withColumns(
        {
            "rise": F.col("__up") - F.min("__up").over(so_far),
            "fall": F.max("__down").over(so_far) - F.col("__down"),
        }
    )
    measured = rows.select(
        *by,
        "window_start",
        "examples",
        *[f"n_{c}" for c in CLASSES],
        F.col("__x").alias("mean_confidence"),
        "stability_index",
        "rise",
        "fall",
        F.coalesce(F.col("stability_index") > limits.stability, F.lit(False)).alias("shifted"),
        (F.greatest("rise", "fall") > limits.page_hinkley).alias("drifting"),
        F.lit(False).alias("silent"),
    )
    if until is None:
        return measured
    quiet = F.col("__last") + F.make_interval(secs=F.lit(limits.silence)) <= until
    alarms = rows.where((F.col("window_end") == F.col("__last")) & quiet)
    return measured.union(
        alarms.select(
            *by,
            F.col("__last").alias("window_start"),
            F.lit(0).cast("bigint").alias("examples"),
            *[F.lit(0).cast("bigint").alias(f"n_{c}") for c in CLASSES],
            *[F.lit(None).cast("double").alias(n) for n in ("mean_confidence", "stability_index", "rise", "fall")],
            *[F.lit(False).alias(n) for n in ("shifted", "drifting")],
            F.lit(True).alias("silent"),
        )
    )


def _processor(names: Sequence[str], limits: DriftLimits, unit: int) -> Callable[[], StatefulProcessor]:
    """The state of a key. Made inside a function, so that Spark ships it by value."""
    classes, half, record = len(CLASSES), HALF, Row(*names)

    class Drift(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState(
                "drift",
                "reference array<bigint>, windows bigint, total double, up double, low double, "
                "down double, high double, last bigint",
            )

        def handleInputRows(self, key, rows, timerValues):
            windows: dict = {}
            for row in rows:
                held = windows.setdefault(row["start"], [row["stop"], [0] * classes, 0])
                held[1][row["class"]] += row["n"]
                held[2] += int(row["confidence_sum"])
            known = self.state.get() if self.state.exists() else ([0] * classes, 0, 0.0, *[0.0] * 4, 0)
            reference, n, total, up, low, down, high, last = known
            reference = list(reference)
            for start in sorted(windows):  # a window's cells come all at once, when it is closed
                stop, counts, confidence = windows[start]
                examples, n = sum(counts), n + 1
                index = None
                if n <= limits.reference:
                    reference = [a + b for a, b in zip(reference, counts)]
                else:
                    index = stability(counts, reference)
                x = float(confidence) / (examples * float(unit))
                total += x
                up += x - total / n - limits.tolerance
                down += x - total / n + limits.tolerance
                low, high = (min(low, up), max(high, down)) if n > 1 else (up, down)
                last = max(last, stop)
                drifting = max(up - low, high - down) > limits.page_hinkley
                shifted = index is not None and index > limits.stability
                yield record(*key, start, examples, *counts, x, index, up - low, high - down, shifted, drifting, False)
            self.state.update((reference, n, total, up, low, down, high, last))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last // 1000 + limits.silence * 1000)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            last = self.state.get()[-1]
            yield record(*key, last, 0, *[0] * classes, *[None] * 4, False, False, True)

        def close(self) -> None:
            pass

    def stability(counts, reference) -> float:
        import math

        index, smoothed = 0.0, half * classes
        for n, r in zip(counts, reference):
            p = (n + half) / (sum(counts) + smoothed)
            q = (r + half) / (sum(reference) + smoothed)
            index += (p - q) * math.log(p / q)
        return index

    return Drift


def streamed_drift(
    cells: DataFrame, by: Sequence[str] = (), limits: DriftLimits = DriftLimits()
) -> DataFrame:
    """The rows of ``drift`` from a stream of windowed cells, each when its window is closed."""
    keys = list(by) or ["key"]
    classes = F.coalesce(F.array_position(F.array(*map(F.lit, LABELS)), F.col("prediction")), F.lit(0))
    rows = cells.select(
        *(by or [F.lit("all").alias("key")]),
        "window",
        F.unix_micros("window.start").alias("start"),
        F.unix_micros("window.end").alias("stop"),
        F.pmod(classes.cast("int") - 1, F.lit(len(CLASSES))).alias("class"),
        "n",
        "confidence_sum",
    )
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, {_MEASURES.replace('window_start timestamp', 'window_start bigint')}"
    found = rows.groupBy(*keys).transformWithState(
        statefulProcessor=_processor([*keys, *MEASURES], limits, CONFIDENCE_UNIT)(),
        outputStructType=schema,
        outputMode="Append",
        timeMode="eventTime",
    )
    measures = [F.timestamp_micros("window_start").alias("window_start"), *MEASURES[1:]]
    return found.select(*by, *measures)


def start_drift_monitor(
    cells: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = (),
    limits: DriftLimits = DriftLimits(),
    **trigger,
) -> StreamingQuery:
    """Append each closed window's measures and alarms to the Parquet table at ``path``."""
    conf = cells.sparkSession.conf
    before = conf.get(_STORE)
    # Keyed state with timers needs this store; a query keeps the settings that it starts with.
    conf.set(_STORE, _ROCKSDB)
    try:
        return start_appending(streamed_drift(cells, by, limits), path, checkpoint, **trigger)
    finally:
        conf.set(_STORE, before)
