"""Nothing is cut to a fixed length: days, files, rounds, and no machine-local folder on a cluster."""

import time
from types import SimpleNamespace

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridcube.catalog import storing
from gridcube.catalog.all import REGISTRY
from gridcube.config import GridConfig
from gridcube.operators import lineage
from gridcube.session import shared_dir
from gridcube.sources import footers
from gridcube.sources.raw import RawVariable
from tests.conftest import settings

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def two_months(tmp_path_factory):
    """The events, and the same again 30 days later."""
    folder = tmp_path_factory.mktemp("events")
    duckdb.sql(f"""copy (select * from '{EVENTS}' union all select event_id + 1000000, ts + interval 30 day, user_id, event_type, value + 1234.5, props
        from '{EVENTS}') to '{folder}/events.parquet' (format parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", ["append_store", "commit_history", "store_inventory", "absent_days", "manifest_totals", "compared_cells", "land_strata"])
def test_records_of_any_length(spark, two_months, name):
    frame = REGISTRY[name].run(spark, two_months)
    duck = duckdb.connect()
    duck.execute(f"create view events as select * from '{two_months}/events.parquet'")
    other = duck.sql(REGISTRY[name].sql)
    places = [other.columns.index(c) for c in sorted(frame.columns)]
    mine = sorted((tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect()), key=repr)
    assert mine == sorted((tuple(r[p] for p in places) for r in other.fetchall()), key=repr) and mine


def test_a_wide_grid_is_filled_in_pieces(spark, tmp_path, monkeypatch):
    """Raw files of large planes are filled by many tasks, a day or some rows of one each."""
    monkeypatch.setattr(storing, "FILE_CELLS", 10_000)
    duckdb.sql(f"""copy (select event_id, ts, user_id * 1400 + 7 as user_id, event_type, value, props from '{EVENTS}'
) to '{tmp_path}/events.parquet' (format parquet)""")
    duck = duckdb.connect()
    duck.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    frame = REGISTRY["append_store"].run(spark, str(tmp_path))
    mine = sorted(tuple(r) for r in frame.select("variable", "t", "i", "j", "value").collect())
    assert mine == sorted(duck.sql(REGISTRY["append_store"].sql).fetchall()) and len(mine) > 600
    (config,) = storing.built(spark, str(tmp_path), "spatial")
    raw = RawVariable(spark, config, "view")
    assert raw.cells().count() == 36 * (19_607 // 36 + 1) * raw.n_steps and raw.n_steps == 30
    assert 3 < len(raw._lengths) <= 2 * 30


def grid_file(folder, k, values, steps=1, stats=True):
    """A raw file of ``steps`` days over 2 x 2 cells, written by another tool than Spark."""
    folder.mkdir(parents=True, exist_ok=True)
    cells = [(t, i, j) for t in range(steps) for i in (0, 1) for j in (0, 1)]
    one = {"local_t": [t for t, _, _ in cells], "days": [29219 + k + t for t, _, _ in cells], "i": [i for _, i, _ in cells], "j": [j for _, _, j in cells],
           "lat": [1.0 - i for _, i, _ in cells], "lon": [float(j) for _, _, j in cells], "value": values * steps}
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float32()]
    pq.write_table(pa.table([pa.array(v, kind) for v, kind in zip(one.values(), kinds)], names=list(one)), folder / f"E_{k:05d}.parquet", write_statistics=stats)


def test_many_files_below_a_folder_of_the_same_name(spark, tmp_path):
    config = GridConfig(settings(tmp_path / "E" / "a b,c" / "E", "spatial")).of("E")
    n = 201
    for k in range(n):
        grid_file(tmp_path / "E" / "a b,c" / "E" / "v_1_2_b/raw/daily/E", k, [float(k), -999.0, float(k), float(k)])
    raw = RawVariable(spark, config, "E")
    assert [(first, steps) for _, first, steps in raw.index] == [(k, 1) for k in range(n)]
    assert raw.valid_cells().where("t = value").count() == 3 * n
    assert raw.cells(days=[200]).count() == 4 and raw.locate(200)[0].endswith("E_00200.parquet")
    assert sorted(r.t for r in raw.cells(days=[3, 77, 200, 201, -1]).where("i = 0 and j = 0").collect()) == [3, 77, 200]
    assert {r.t for r in raw.valid_cells(steps=(50, 120)).collect()} == set(range(50, 120))


def test_any_number_of_files_is_one_scan(spark, tmp_path):
    config = GridConfig(settings(tmp_path, "spatial")).of("E")
    for k in range(5_000):
        grid_file(tmp_path / "v_1_2_b/raw/daily/E", k, [float(k), -999.0, float(k), float(k)])
    raw = RawVariable(spark, config, "E")
    assert raw.n_steps == 5_000
    started = time.perf_counter()
    plan = raw.cells()._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - started < 4  # 2 s on an idle machine
    assert plan.count("FileScan parquet") == 1 and "BroadcastHashJoin" in plan
    some = raw.valid_cells(steps=(10, 3_000)).groupBy().agg(F.sum("t").alias("t"), F.count_distinct("t").alias("n"))
    assert tuple(some.first()) == (3 * sum(range(10, 3_000)), 2_990)


def test_lengths_come_from_footers_or_else_from_the_column(spark, tmp_path):
    config = GridConfig(settings(tmp_path, "spatial")).of("E")
    folder = tmp_path / "v_1_2_b/raw/daily/E"
    grid_file(folder, 0, [1.0, 2.0, 3.0, 4.0], steps=3)
    grid_file(folder, 3, [1.0, 2.0, 3.0, 4.0], steps=2, stats=False)
    grid_file(folder, 5, [1.0, 2.0, 3.0, 4.0], steps=4)
    assert [(first, n) for _, first, n in RawVariable(spark, config, "E").index] == [(0, 3), (3, 2), (5, 4)]
    files = footers.footers(footers.listed(spark, [str(folder)]), ["local_t", "i", "none"])
    told = {r.path.rsplit("/", 1)[1]: (r.n_rows, {k: (v.low, v.high) for k, v in r.extremes.items()}, r.problem) for r in files.collect()}
    assert told["E_00000.parquet"] == (12, {"local_t": (0, 2), "i": (0, 1)}, None) and told["E_00003.parquet"] == (8, {}, None)
    (folder / "E_00005.parquet").write_bytes(b"PAR1")
    broken = files.where("problem is not null").collect()
    assert [r.path.rsplit("/", 1)[1] for r in broken] == ["E_00005.parquet"] and broken[0].n_rows is None
    assert not footers.reachable("viewfs://cluster/x") and footers.reachable(str(folder)) and footers.reachable(f"file:{folder}")


def test_a_closed_chain_is_an_error(spark):
    open_chain = spark.createDataFrame([(str(k), str(k - 1) if k else None) for k in range(70)], "id string, parent string")
    assert {int(r.id): r.depth for r in lineage.depth_from_tip(open_chain, "id", "parent").collect()} == {k: 69 - k for k in range(70)}
    closed = spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent string")
    with pytest.raises(ValueError, match="closes"):
        lineage.depth_from_tip(closed, "id", "parent")


def test_a_cluster_needs_a_shared_folder():
    none = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
