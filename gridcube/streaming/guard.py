"""Which days of a stream may be appended: one stream for a whole family, one state per variable.

The stream announces days, ``variable, days, part`` and whatever else; per variable the state is its first day and
the one it expects next. A day that is next is accepted; any other is refused with a reason, and the stream goes
on: a wrong day of one variable holds up no other. Announcements of one micro-batch are judged in order of days.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

VERDICTS = "variable string, part long, days long, verdict string, expected long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def judged(days: list[int], first: int, expected: int) -> tuple[list[tuple[str, int]], int]:
    """(verdict, day expected) per day of a sorted list, and the day expected after them.

    ``accepted`` is the next day, ``doubled`` one accepted before, ``late`` one from before the axis starts,
    ``early`` one behind a gap.
    """
    out = []
    for day in days:
        if day == expected:
            out.append(("accepted", expected))
            expected += 1
        else:
            out.append(("late" if day < first else "doubled" if day < expected else "early", expected))
    return out, expected


class DayGuard(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        span = StructType([StructField("first", LongType()), StructField("expected", LongType())])
        self.span = handle.getValueState("span", span)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a row per announced day of one variable in one micro-batch
        told = pd.concat([r[["part", "days"]] for r in rows]).dropna(subset=["days"]).sort_values(["days", "part"], kind="stable")
        if told.empty:
            return
        held = self.span.get() if self.span.exists() else (int(told["days"].iloc[0]),) * 2
        verdicts, expected = judged([int(d) for d in told["days"]], held[0], held[1])
        self.span.update((held[0], expected))
        yield pd.DataFrame({
            "variable": key[0], "part": told["part"].to_numpy(), "days": told["days"].to_numpy(dtype="int64"),
            "verdict": [v for v, _ in verdicts], "expected": [e for _, e in verdicts]})

    def close(self) -> None:
        pass


def guarded(announced: DataFrame) -> DataFrame:
    """A stream of (variable, part, days, verdict, expected) from one of announced days.

    Keyed by variable: one shuffle of a row per variable and day. A null variable is a variable of its own, null days are
    left out. State lives in RocksDB with its checkpoint in the query's folder, so a restart goes on where it was.
    """
    announced.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    told = announced.select("variable", F.col("part").cast("long").alias("part"), F.col("days").cast("long").alias("days"))
    return told.groupBy("variable").transformWithStateInPandas(
        statefulProcessor=DayGuard(), outputStructType=VERDICTS, outputMode="Append", timeMode="None")


def guard_stream(announced: DataFrame, out: str, checkpoint: str):
    """Write verdicts to a table of files; takes what is there and stops. Accepted days and refusals are one table."""
    return (
        guarded(announced).writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
