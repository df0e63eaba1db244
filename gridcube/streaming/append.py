"""Appending to a store from a stream: one commit per micro-batch.

The stream carries raw rows ``days, i, j, value``. A micro-batch must continue the
time axis where the store ends, day by day; one that does not is refused, as the
axis of a store never has gaps. A batch that was committed before its offsets were
recorded is seen again after a restart: its commit is found and nothing is written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.functions.fixed import CALENDAR, TIME_UNITS
from gridcube.functions.grid import decoded
from gridcube.plans.store import Store
from gridcube.session import fresh_dir


def batch_message(query: str, batch_id: int) -> str:
    return f"stream {query} batch {batch_id}"


def append_batch(store: Store, rows: DataFrame, message: str, grid: Mapping[str, int], chunks: Mapping[str, int]) -> bool:
    """Commit one micro-batch. False where there is nothing to do."""
    query, number = message.rsplit(" ", 1)
    work = store.begin()
    held = work.state.get("batches") or {}  # last batch of each query, carried from commit to commit
    if int(number) <= held.get(query, -1):
        return False
    done = (work.state.get("sizes") or {}).get("time", 0)
    seen = rows.agg(F.min("days").alias("a"), F.max("days").alias("b"), F.countDistinct("days").alias("n")).first()
    if not seen.n:
        return False
    start = work.state.get("first_day", seen.a)
    if seen.a != start + done or seen.b - seen.a + 1 != seen.n:
        raise ValueError(f"days {seen.a}..{seen.b} ({seen.n} of them) do not continue an axis that ends at {start + done - 1}")
    last = done + seen.n
    work.state = {
        **work.state, "batches": {**held, query: int(number)}, "first_day": start, "chunks": dict(chunks), "sizes": {"time": last, **grid},
        "coordinates": {"time": {"chunk": chunks["time"], "units": TIME_UNITS, "calendar": CALENDAR, "dtype": "int64"},
                        "lat": {"chunk": grid["lat"]}, "lon": {"chunk": grid["lon"]}},
    }
    t = (F.col("days") - start).cast("int").alias("t")
    cells = rows.select(t, F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), decoded(F.col("value")).alias("value"))
    cells = cells.where(F.col("value").isNotNull()).sortWithinPartitions("t", "i", "j")
    work.write_cells(cells, {"t": (done, last), "i": (0, grid["lat"]), "j": (0, grid["lon"])})
    axis = rows.select("days").distinct().select(
        F.lit("time").alias("dim"), (F.col("days") - start).cast("int").alias("idx"),
        F.lit(None).cast("double").alias("value"), "days",
    )
    work.write_dims(axis)
    work.commit(message)
    return True


def append_stream(
    stream: DataFrame, store: Store, grid: Mapping[str, int], chunks: Mapping[str, int],
    name: str = "append", checkpoint: str | None = None,
):
    """Start a query that takes what is available and stops; run it again for more."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()  # looked at, written and its days listed
        append_batch(store, rows, batch_message(name, batch_id), grid, chunks)
        rows.unpersist()

    place = checkpoint or fresh_dir(store.spark, f"stream-{name}")
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", place)
        .trigger(availableNow=True).start()
    )
