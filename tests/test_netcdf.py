import json

import pytest
from pyspark.sql import functions as F

from gridcube.sources.netcdf import NetcdfReader, read_attrs, read_netcdf

OPENER = "tests.fake_netcdf:open_file"


@pytest.fixture()
def files(tmp_path):
    paths = []
    for name, start, n in (("E_1980.nc", 29219, 5), ("E_1981.nc", 29224, 3)):
        (tmp_path / name).write_text(json.dumps({"start": start, "n": n}))
        paths.append(str(tmp_path / name))
    return paths


def test_rows_keep_the_sentinel(spark, files):
    df = read_netcdf(spark, files, "E", opener=OPENER, slab="2")
    assert df.count() == 8 * 24
    assert df.where(F.col("value") == F.lit(-999.0).cast("float")).count() == 8 * 4
    row = df.where("file = 'E_1981.nc' and local_t = 2 and i = 3 and j = 5").first()
    assert (row.days, row.lat, row.lon, row.value) == (29226, 7.0, 2.5, 235.0)


def test_filters_narrow_the_slabs(spark, files):
    df = read_netcdf(spark, files, "E", opener=OPENER)
    part = df.where("local_t >= 1 and local_t < 3 and i = 2 and j > 3")
    assert part.count() == 2 * 2 * 1 * 2
    assert {r.value for r in part.where("file = 'E_1980.nc'").collect()} == {124.0, 125.0, 224.0, 225.0}


def test_pushed_bounds(files):
    from pyspark.sql.datasource import EqualTo, In, LessThan

    def reader():
        return NetcdfReader({"paths": json.dumps(files), "variable": "E", "opener": OPENER, "slab": "2", "shares": "2"})

    one = reader()
    filters = [EqualTo(("i",), 2), LessThan(("local_t",), 4)]
    assert list(one.pushFilters(filters)) == filters
    assert one.bounds["i"] == [2, 3]
    assert [(s.path, s.k) for s in one.partitions()] == [(f, k) for f in files for k in (0, 1)]
    shares = one.partitions()[:2]
    assert [one.slabs(s, 5) for s in shares] == [[(0, 2)], [(2, 4)]] and [one.slabs(s, 3) for s in shares] == [[(0, 2)], [(2, 3)]]
    single = reader()
    list(single.pushFilters([In(("local_t",), (3, 300))]))
    assert single.bounds["local_t"] == [3, 301]
    assert [s for share in shares for s in single.slabs(share, 366)] == [(3, 5), (299, 301)]


def test_a_comma_in_a_path(spark, tmp_path):
    (tmp_path / "a,b.nc").write_text(json.dumps({"start": 5, "n": 1}))
    assert read_netcdf(spark, [str(tmp_path / "a,b.nc")], "E", opener=OPENER).count() == 24


def test_attrs(files):
    assert read_attrs(files[0], "E", OPENER) == ({"units": "mm.day-1"}, {"institution": "here"})


def test_missing_library_is_named(files):
    try:
        import netCDF4  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="netCDF4"):
            read_attrs(files[0], "E")


def test_raw_variable_over_netcdf(spark, tmp_path):
    """The same scans as over Parquet; the axis comes from the headers alone."""
    from gridcube.config import GridConfig
    from gridcube.plans.build import build_store
    from gridcube.plans.store import Store
    from gridcube.plans.verify import Audit
    from gridcube.sources.raw import RawVariable
    from tests.conftest import settings

    held = settings(tmp_path, "spatial", raw_options={"opener": OPENER, "slab": "2"}, timesteps_per_commit=3, attrs={})
    config = GridConfig(held).of("E")
    folder = tmp_path / "v_1_2_b/raw/daily/E"
    folder.mkdir(parents=True)
    for name, start, n in (("E_1980.nc", 29219, 5), ("E_1981.nc", 29224, 3)):
        (folder / name).write_text(json.dumps({"start": start, "n": n}))
    raw = RawVariable(spark, config, "E")
    assert [(f, n) for _, f, n in raw.index] == [(0, 5), (5, 3)]
    assert [(r.idx, r.days) for r in raw.axis().orderBy("idx").collect()] == [(k, 29219 + k) for k in range(8)]
    assert raw._scan(raw.files, header=True).where("value is not null").count() == 0
    assert raw.cells(steps=(4, 6), i=(1, 2)).count() == 2 * 6
    assert build_store(spark, config) == 3
    assert Store.open(spark, config.store_path).cells().count() == 8 * 20
    audit = Audit(spark, config, samples=3)
    audit.run(["structure", "index", "samples", "sweep"])
    assert audit.failures == []
