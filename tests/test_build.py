import logging

import pytest
from pyspark.sql import functions as F

from tests.conftest import FIRST_DAY, settings, write_raw
from gridcube.config import GridConfig
from gridcube.cube import Cube, inventory
from gridcube.plans.build import Source, blocks_of, build_family, build_store
from gridcube.plans.store import Store
from gridcube.sources.raw import RawVariable


def equals_raw(spark, config):
    store = Store.open(spark, config.store_path)
    raw = RawVariable(spark, config, config.variable).valid_cells()
    return store.cells().exceptAll(raw).isEmpty() and raw.exceptAll(store.cells()).isEmpty()


def test_family_state(spark, family):
    """Names, attributes and history of built stores."""
    spatial, temporal = family["spatial"], family["temporal"]
    e, ep = (Store.open(spark, spatial.of(n).store_path) for n in ("E", "Ep"))
    assert [c.message for c in e.ancestry()] == [
        "write timesteps 50-59", "write timesteps 25-49", "write timesteps 0-24", "repository initialized"]
    state = e.state()
    assert list(state["variables"]) == ["evaporation"] and state["sizes"] == {"time": 60, "lat": 20, "lon": 40}
    attrs = state["attrs"]
    for part in ("Total evaporation flux", "[evaporation]", "fluxes v1.2b", "0.5 degrees"):
        assert part in attrs["title"], part
    assert attrs["institution"] == "somewhere" and attrs["source"] == "v1.2b daily files of E"
    assert attrs["known_data_gaps"] == "five days of evaporation" and "known_data_gaps" not in ep.state()["attrs"]
    assert (attrs["time_coverage_start"], attrs["geospatial_lat_min"], attrs["geospatial_lat_max"]) == ("1980-01-01", 40.5, 50.0)
    variable = state["variables"]["evaporation"]["attrs"]
    assert (variable["original_variable_name"], variable["original_units"], variable["units"]) == ("E", "mm.day-1", "mm d-1")
    history = [c.message for c in Store.open(spark, temporal.of("E").store_path).ancestry()]
    assert history == ["write evaporation lat[10:20) lon[0:40)", "write evaporation lat[0:10) lon[0:40)", "create skeleton", "repository initialized"]
    assert inventory(spark, spatial).count() == 4
    for layout in family.values():
        assert equals_raw(spark, layout.of("E"))


def test_complete_stores_are_left_alone(spark, family):
    assert build_family(spark, family["spatial"], "E") == {"E": 0}
    assert build_family(spark, family["temporal"], "evaporation") == {"E": 0}


@pytest.mark.parametrize("layout,n", [("spatial", 2), ("temporal", 1)])
def test_resume(spark, lone, layout, n, caplog):
    config = lone(layout)
    build_store(spark, config)
    store = Store.open(spark, config.store_path)
    store.reset(store.ancestry()[n].id)
    assert build_store(spark, config) == n
    assert equals_raw(spark, config)
    if layout == "temporal":
        changed = GridConfig({**config.settings, "block_shape": {"lat": 5}}, config.key)
        with caplog.at_level(logging.WARNING):
            assert build_store(spark, changed) == 4
        assert "do not match the block shape" in caplog.text and equals_raw(spark, config)
        other = GridConfig({**config.settings, "chunks": {"time": -1, "lat": 10, "lon": 10}}, config.key)
        with pytest.raises(ValueError, match="chunked"):
            build_store(spark, other)
    else:
        store.reset(store.ancestry()[1].id)
        other = GridConfig({**config.settings, "timesteps_per_commit": 40}, config.key)
        with pytest.raises(ValueError, match="whole number of batches"):
            build_store(spark, other)


def test_publish_guard(spark, lone):
    config = lone()
    build_store(spark, config)
    Store.open(spark, config.store_path).tag("v1")
    with pytest.raises(ValueError, match="published"):
        build_store(spark, config)
    assert build_store(spark, config, force=True) == 0


def test_time_axis_guard(spark, tmp_path):
    config = GridConfig(settings(tmp_path, "spatial"))
    write_raw(spark, config, "E")
    write_raw(spark, config, "Ep", {"1980": (0, 31)})
    write_raw(spark, config, "Ep_rad", {"1980": (0, 31), "1981": (32, 61)})
    for name, text in (("Ep", "31 steps"), ("Ep_rad", "from index 31")):
        with pytest.raises(ValueError, match=text):
            build_family(spark, config, name)
        assert not Store.exists(spark, config.of(name).store_path)


def test_resume_refuses_other_input(spark, tmp_path):
    config = GridConfig(settings(tmp_path, "spatial")).of("E")
    write_raw(spark, config, "E", {"1980": (0, 30)})
    build_store(spark, config)
    write_raw(spark, config, "E", {"1980": (5, 35)})
    with pytest.raises(ValueError, match="not those of the input"):
        build_store(spark, config)


def test_raw_scans(spark, lone):
    raw = RawVariable(spark, lone(), "E")
    assert [(f, n) for _, f, n in raw.index] == [(0, 31), (31, 29)] and raw.seams() == [31]
    assert raw.locate(30)[1] == 30 and raw.locate(31)[1] == 0 and raw.locate(59)[0].endswith("1981_fluxes.parquet")
    box = raw.cells(steps=(30, 33), i=(3, 5), j=(14, 17))
    assert box.count() == 3 * 2 * 3 and {r.t for r in box.collect()} == {30, 31, 32}
    assert raw.cells(days=[5, 40, 40]).count() == 2 * 800
    assert raw.cells(steps=(0, 60)).count() == raw.cells().count() == 48000
    assert raw.cells(steps=(7, 7)).count() == 0
    assert raw.axis().where("idx = 31").first().days == FIRST_DAY + 31
    plan = raw.cells(steps=(3, 5))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(local_t,3)" in plan and "1981" not in plan.split("FileScan")[-1].split("PartitionFilters")[0]


def test_cube(spark, family):
    cube = Cube.open(spark, family["spatial"], ["Ep", "Ep_aero", "potential_evaporation_radiative"])
    july = cube.sel(time="1980-02", lat=(48, 45), lon=(-10, -5))
    assert july.ranges == {"t": (31, 60), "i": (4, 11), "j": (20, 31)}
    assert cube.sel(lat=(45, 48)).ranges["i"] == (0, 0)  # against storage order: nothing
    assert cube.sel(lat=(45, 48)).cells().count() == 0
    near = cube.nearest(lat=47.3, lon=-5.1).of("potential_evaporation")
    assert near.ranges == {"i": (5, 6), "j": (30, 31)}
    assert cube.label("potential_evaporation") == "Potential evaporation flux [mm d-1]"
    assert near.extent() == (-5.25, -4.75, 47.25, 47.75) and cube.extent() == (-20.25, -0.25, 40.25, 50.25)
    assert near.map().select("row", "lat").distinct().collect()[0] == (5, 47.5)
    shares = {r.component: r.share_pct for r in cube.of(*cube.stores).shares("potential_evaporation").collect()}
    assert abs(shares["sum of components"] - 100) < 0.5
    cost = {r.variable: r.n_chunks for r in cube.isel(t=(0, 10), i=(3, 4)).read_cost().collect()}
    assert set(cost.values()) == {10}
    gappy = Cube.open(spark, family["spatial"], ["E"]).isel(t=(0, 10)).read_cost().first()
    assert gappy.n_chunks == 5
    temporal = Cube.open(spark, family["temporal"], ["E"])
    spatial = Cube.open(spark, family["spatial"], ["E"])
    pick = lambda c: c.sel(time=("1980-01-10", "1980-02-03")).cells().select("date", "lat", "lon", F.col("value"))
    assert pick(temporal).exceptAll(pick(spatial)).isEmpty() and pick(spatial).count() == pick(temporal).count() > 0
    year = spatial.annual_mean().first()
    assert str(year.year_end) == "1980-12-31"


def test_blocks_are_filled_in_one_pass(spark, lone, monkeypatch):
    """A resumed build reads raw once for all blocks that are missing, and commits each."""
    config = lone("temporal", block_shape={"lat": 5, "lon": 20})
    build_store(spark, config)
    store = Store.open(spark, config.store_path)
    assert len(store.ancestry()) == 2 + 4 * 2
    store.reset(store.ancestry()[-4].id)
    passes, write = [], Store.write_parts

    def counted(self, cells, n, chunks):
        passes.append((n, cells._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")))
        return write(self, cells, n, chunks)

    monkeypatch.setattr(Store, "write_parts", counted)
    assert build_store(spark, config) == 6 and passes == [(6, 1)]
    assert equals_raw(spark, config)
    store.reset(store.ancestry()[4].id)
    few = GridConfig({**config.settings, "blocks_per_pass": 3}, config.key).of("E")
    assert build_store(spark, few) == 4 and [n for n, _ in passes] == [6, 3, 1] and equals_raw(spark, config)
    assert not store.fs.list(f"{store.path}/staged")


def test_cells_of_blocks(spark, lone):
    config = lone("temporal", block_shape={"lat": 15, "lon": 30})
    source = Source(spark, config)
    blocks = config.blocks(source.chunks, source.sizes)
    assert len(blocks) == 4
    cells = blocks_of(source.raw.cells(steps=(0, 1)), blocks, [blocks[3], blocks[0]])
    ends = {r.part: tuple(r)[1:] for r in cells.groupBy("part").agg(F.min("i"), F.max("i"), F.min("j"), F.max("j"), F.count("*")).collect()}
    assert ends == {0: (15, 19, 30, 39, 50), 1: (0, 14, 0, 29, 450)}


def test_batches_are_filled_in_one_pass(spark, lone, monkeypatch):
    """An append build reads raw once for all batches that are missing, and commits each; a resumed one likewise."""
    config = lone(timesteps_per_commit=5)
    passes, write = [], Store.write_parts

    def counted(self, cells, n, chunks):
        passes.append((n, cells._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")))
        return write(self, cells, n, chunks)

    monkeypatch.setattr(Store, "write_parts", counted)
    assert build_store(spark, config) == 12 and passes == [(12, 1)] and equals_raw(spark, config)
    store = Store.open(spark, config.store_path)
    whole = store.ancestry()
    assert [c.message for c in whole[-3:]] == ["write timesteps 5-9", "write timesteps 0-4", "repository initialized"]
    assert [(c.box["t"], c.state["sizes"]["time"]) for c in whole[:2]] == [([55, 60], 60), ([50, 55], 55)]
    store.reset(whole[-3].id)
    few = GridConfig({**config.settings, "batches_per_pass": 4}, config.key).of("E")
    assert build_store(spark, few) == 10 and [n for n, _ in passes] == [12, 4, 4, 2] and equals_raw(spark, config)
    recorded, lying = store.written(), store.files(store.data_folders())
    assert recorded.exceptAll(lying.select(*recorded.columns)).isEmpty() and recorded.count() == lying.count()
    assert not store.fs.list(f"{store.path}/staged")


def test_the_tip_is_found_without_reading_the_branch(spark, tmp_path, monkeypatch):
    """Commits read a few records each, however many there are."""
    path, asked = str(tmp_path / "store"), []
    store = Store.open_or_create(spark, path)
    for k in range(70):
        assert store._pointer()[0] == k
        store.begin().commit(str(k))
    fresh = Store.open(spark, path)
    exists = fresh.fs.exists
    monkeypatch.setattr(fresh.fs, "exists", lambda name: asked.append(name) or exists(name))
    monkeypatch.setattr(fresh.fs, "list", lambda name: pytest.fail(f"{name} is listed"))
    assert fresh._pointer()[0] == 70 and len(asked) <= 16
    assert [c.message for c in fresh.ancestry()][:2] == ["69", "68"] and fresh._pointer()[0] == 70
    fresh.state()["sizes"] = 1
    assert fresh.state() == {}
