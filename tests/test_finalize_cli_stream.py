import json
import logging

import pytest
from pyspark.sql import functions as F

from tests.conftest import FIRST_DAY, raw_frame, settings
from gridcube.config import GridConfig
from gridcube.plans import cli, finalize
from gridcube.plans.build import build_store
from gridcube.plans.stage import stage_window
from gridcube.plans.store import Store
from gridcube.sources.raw import RawVariable
from gridcube.streaming.append import append_batch, append_stream


def run(spark, *argv):
    return cli.run(spark, cli.parser().parse_args([str(a) for a in argv]))


def test_command_line(spark, tmp_path, lone, caplog):
    caplog.set_level(logging.INFO)
    config = lone("spatial")
    other = {**config.settings, **settings(tmp_path, "temporal")}
    paths = {}
    for name, held in (("spatial", {**config.settings, "variable": None}), ("temporal", {**other, "variable": None})):
        paths[name] = tmp_path / f"{name}.yaml"
        paths[name].write_text(json.dumps({k: v for k, v in held.items() if v is not None}))
        assert run(spark, "build", "--config", paths[name]) == 0
    assert run(spark, "verify", "--config", paths["spatial"], "--variable", "evaporation", "--samples", 4,
               "--phases", "structure,index,samples,sweep,ranges,metadata", "--compare-with", paths["temporal"]) == 0
    assert "FAIL" not in caplog.text and "0 failures" in caplog.text
    with pytest.raises(ValueError):
        run(spark, "verify", "--config", paths["spatial"], "--phases", "bogus")
    store = Store.open(spark, config.store_path)
    held = json.loads(paths["spatial"].read_text())
    held["attrs"]["comment"] = "on {grid} {variable}"
    held["grid"] = "the small grid"
    paths["spatial"].write_text(json.dumps(held))
    finish = lambda *extra: run(spark, "finalize", "--config", paths["spatial"], "--variable", "E", *extra)
    n = len(store.ancestry())
    assert finish("--attrs") == 0 and finish("--tag", "v1") == 0 and finish("--gc") == 0
    assert len(store.ancestry()) == n and store.tags() == {}
    assert finish("--attrs", "--apply") == 0
    assert store.state()["attrs"]["comment"] == "on the small grid evaporation" and len(store.ancestry()) == n + 1
    assert finish("--attrs", "--apply") == 0 and len(store.ancestry()) == n + 1
    assert finish("--tag", "v1", "--apply") == 0 and finish("--tag", "v1", "--apply") == 1
    assert finish("--gc", "--apply") == 0
    caplog.clear()
    assert finish("--status") == 0
    status = finalize.status(store, GridConfig(held).of("E"))
    assert status["remaining"] == [] and status["tags"] == ["v1"] and status["orphaned_snapshots"] == 0
    with pytest.raises(ValueError, match="published"):
        run(spark, "build", "--config", paths["spatial"])
    with pytest.raises(FileNotFoundError):
        run(spark, "finalize", "--config", paths["spatial"], "--variable", "Ep", "--status")


def test_collect_reports_loose_commits(spark, lone):
    config = lone()
    build_store(spark, config)
    store = Store.open(spark, config.store_path)
    store.reset(store.ancestry()[1].id)
    status = finalize.status(store, config)
    # a store that lost its last batch covers less time than its attributes say
    assert status["attrs_pending"] == ["time_coverage_end"]
    assert status["remaining"] == ["attrs", "tag", "gc"] and status["orphaned_snapshots"] == 1
    assert finalize.collect(store, apply=True) == 0
    assert finalize.status(store, config)["remaining"] == ["attrs", "tag"]


def test_stage_window(spark, tmp_path, lone):
    source = lone()
    target = GridConfig(settings(tmp_path / "small", "spatial"))
    assert stage_window(spark, source, target, ["E"], (10, 14), (12, 20)) == 2
    assert stage_window(spark, source, target, ["E"], (10, 14), (12, 20)) == 0
    assert stage_window(spark, source, target, ["E"], (10, 14), (12, 20), years=[1981], restage=True) == 1
    raw = RawVariable(spark, target, "E")
    assert raw.cells().count() == 60 * 4 * 8 and raw.attrs[0]["units"] == "mm.day-1"
    assert raw.cells().where(F.col("value") == F.lit(-999.0).cast("float")).count() > 0
    first = raw.coordinate("lat").orderBy("idx").first()
    assert (first.idx, first.value) == (0, 45.0)
    with pytest.raises(ValueError, match="own source"):
        stage_window(spark, source, source, ["E"], (0, 1), (0, 1))


GRID, CHUNKS = {"lat": 20, "lon": 40}, {"time": 1, "lat": 20, "lon": 40}


def test_stream_append(spark, tmp_path):
    store = Store.open_or_create(spark, str(tmp_path / "s"))
    source = tmp_path / "in"

    def arrive(first, last):
        raw_frame(spark, "Ep", first, last).coalesce(1).write.mode("append").parquet(str(source))

    def drain():
        schema = spark.read.parquet(str(source)).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        append_stream(stream, store, GRID, CHUNKS, "ep", str(tmp_path / "ck")).awaitTermination()

    arrive(0, 3)
    drain()
    arrive(3, 7)
    drain()
    drain()  # nothing new, no commit
    assert [c.message for c in store.ancestry()][:2] == ["stream ep batch 1", "stream ep batch 0"]
    assert len(store.ancestry()) == 3 and store.state()["sizes"]["time"] == 7
    wanted = raw_frame(spark, "Ep", 0, 7).where(F.col("value") != F.lit(-999.0).cast("float"))
    wanted = wanted.select("local_t", "i", "j", "value")
    assert store.cells().exceptAll(wanted).isEmpty() and store.cells().count() == wanted.count()
    assert [r.days for r in store.axis().orderBy("idx").collect()] == list(range(FIRST_DAY, FIRST_DAY + 7))
    # a batch seen again after a lost acknowledgement is a no-op; a gap or a late batch is refused
    assert append_batch(store, raw_frame(spark, "Ep", 3, 7), "stream ep batch 1", GRID, CHUNKS) is False
    for first, last in ((8, 9), (5, 8), (0, 1)):
        with pytest.raises(ValueError, match="do not continue"):
            append_batch(store, raw_frame(spark, "Ep", first, last), "stream ep batch 2", GRID, CHUNKS)
    assert len(store.ancestry()) == 3
