import pytest

from tests.conftest import settings
from gridcube.config import GridConfig, described, version_dir
from gridcube.fs import SharedFs
from gridcube.functions.names import NameKey, markdown_tables

KEY = NameKey.load()
HEADER = "| original_variable_name | canonical_name | canonical_units | canonical_long_name | unit_conversion |\n| --- | --- | --- | --- | --- |\n"
FREQUENCY = "\n| original_frequency_name | canonical_name | canonical_long_name |\n| --- | --- | --- |\n| daily | day | daily average |\n"


def test_key_lookups():
    assert len(KEY.variables) == 14
    assert KEY.canonical("SMrz") == "soil_moisture_root_zone"
    assert KEY.original("transpiration") == "Et"
    assert KEY.either("E") == KEY.either("evaporation") == "E"
    assert KEY.frequency("daily") == KEY.frequency("day")
    with pytest.raises(KeyError):
        KEY.canonical("nope")
    with pytest.raises(ValueError, match="neither"):
        KEY.resolve("nope")
    with pytest.raises(ValueError, match="not one of"):
        KEY.resolve("evaporation", ["Ep"])


def test_key_must_be_sound():
    row = "| {} | {} | mm | long | none |\n"
    with pytest.raises(ValueError, match="incomplete"):
        NameKey(HEADER + row.format("A", "") + FREQUENCY)
    with pytest.raises(ValueError, match="two variables"):
        NameKey(HEADER + row.format("A", "x") + row.format("B", "x") + FREQUENCY)
    with pytest.raises(ValueError, match="it has 0"):
        NameKey(HEADER + row.format("A", "x"))
    with pytest.raises(ValueError, match="it has 2"):
        NameKey(HEADER + row.format("A", "x") + "\ntext\n" + HEADER + row.format("B", "y") + FREQUENCY)
    assert markdown_tables("no table\n| a | b |\n| - | - |\n| `1` | 2 |")[0] == [{"a": "1", "b": "2"}]


def test_attrs_apply_twice():
    once = KEY.variable_attrs({"standard_name": "e", "long_name": "Evap", "units": "mm.day-1", "extra": 1}, "E")
    assert once["units"] == "mm d-1" and once["original_units"] == "mm.day-1" and once["extra"] == 1
    assert KEY.variable_attrs(once, "E") == once
    assert once["unit_conversion"].startswith("none") and "'mm.day-1'" in once["unit_conversion"] and "'mm d-1'" in once["unit_conversion"]


@pytest.mark.parametrize("bad", ["4.3a", "v4.3", "v4.3ab", "v4a", " v4.3a"])
def test_version(bad):
    assert version_dir("v4.3a") == "v_4_3_a"
    with pytest.raises(ValueError):
        version_dir(bad)


def test_paths_and_templates(tmp_path):
    config = GridConfig(settings("/data", "spatial")).of("E")
    assert config.raw_dir == "/data/v_1_2_b/raw/daily"
    assert config.store_path == "/data/v_1_2_b/stores/spatial/fluxes.v_1_2_b.day.evaporation"
    moved = GridConfig(settings("/data", "spatial", directories={"download": "/data", "raw": "/other/"}))
    assert moved.raw_dir.startswith("/other/v_1_2_b")
    attrs = GridConfig({**config.settings, "attrs": {"n": 3, "flag": True, "s": "{version_label}"}}, KEY).attrs()
    assert attrs["n"] == 3 and attrs["flag"] is True and attrs["s"] == "v1.2b"
    assert attrs["known_data_gaps"] == "five days of evaporation"
    assert "known_data_gaps" not in config.of("Ep").attrs()
    broken = GridConfig({**config.settings, "output_conventions": {"filename": "{nothing}"}}, KEY)
    with pytest.raises(ValueError, match="nothing"):
        broken.store_path


def test_family(spark, tmp_path):
    config = GridConfig(settings(tmp_path, "spatial"))
    fs = SharedFs(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        config.discover(fs)
    for name in ("Ep", "E"):
        (tmp_path / "v_1_2_b/raw/daily" / name).mkdir(parents=True)
    assert config.family(fs) == ["E", "Ep"]
    assert GridConfig({**config.settings, "variables": ["Ep", "E"]}).family(fs) == ["Ep", "E"]
    with pytest.raises(ValueError, match="lacks"):
        GridConfig({**config.settings, "variables": ["Et"]}).family(fs)
    with pytest.raises(ValueError, match="no variables"):
        GridConfig({**config.settings, "variables": []}).family(fs)
    with pytest.raises(FileNotFoundError):
        config.files(fs, "E")
    for year in (1981, 1980):
        (tmp_path / f"v_1_2_b/raw/daily/E/E_{year}.nc").write_text("")
    assert [f[-7:] for f in config.files(fs, "E")] == ["1980.nc", "1981.nc"]


def test_chunking():
    sizes = {"time": 60, "lat": 20, "lon": 40}
    spatial, temporal = (GridConfig(settings("/d", layout)) for layout in ("spatial", "temporal"))
    assert spatial.chunks(sizes) == {"time": 1, "lat": 20, "lon": 40}
    with pytest.raises(ValueError, match="depth"):
        GridConfig(settings("/d", "spatial", chunks={"depth": 3})).chunks(sizes)
    for target, chunk, batch in ((100, 1, 100), (10, 4, 8), (6, 4, 8), (14, 4, 16), (1, 4, 4)):
        config = GridConfig(settings("/d", "spatial", timesteps_per_commit=target))
        assert config.batch_steps({"time": chunk}) == batch
    assert spatial.strategy(spatial.chunks(sizes), sizes) == "append"
    with pytest.raises(ValueError, match="use 'region'"):
        spatial.strategy({"time": 60}, sizes)
    with pytest.raises(ValueError, match="use 'append'"):
        temporal.strategy({"time": 1}, sizes)
    with pytest.raises(ValueError, match="not one of"):
        GridConfig(settings("/d", "spatial", write_strategy="magic")).strategy({"time": 1}, sizes)
    chunks = temporal.chunks(sizes)
    assert temporal.blocks(chunks, sizes) == [(0, 10, 0, 40), (10, 20, 0, 40)]
    with pytest.raises(ValueError, match="multiple"):
        GridConfig(settings("/d", "temporal", block_shape={"lat": 7})).blocks(chunks, sizes)


def test_title_and_summary():
    config = GridConfig(settings("/d", "temporal")).of("E")
    coverage = {"time_coverage_start": "1980-01-01", "time_coverage_end": "1981-02-01", "geospatial_lat_resolution": 0.5}
    words = described(config, {"time": 60, "lat": 20, "lon": 40}, coverage, {"long_name": "Total flux from fluxes 1.2b", "units": "mm d-1"})
    for part in ("Total flux", "[evaporation]", "fluxes v1.2b", "1980 to 1981", "0.5 degrees", "long series"):
        assert part in words["title"], part
    assert "from fluxes 1.2b" not in words["title"]
    assert "total flux".lower() in words["summary"].lower() and "mm d-1" in words["summary"] and "daily average" in words["summary"]
    own = GridConfig({**config.settings, "describe": {"title": "{variable} {use}"}}).of("E")
    assert described(own, {"time": 60, "lat": 20, "lon": 40}, coverage, {})["title"] == "evaporation long series"
