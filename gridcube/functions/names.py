"""The name key: published names to canonical names, units and long names.

The key is two small markdown tables. It is read once on the driver, and offered
both as plain lookups (for paths and attributes) and as DataFrames (for joins).
"""

from __future__ import annotations

import functools
import pathlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

_DEFAULT = pathlib.Path(__file__).with_name("variables.md")

VARIABLE_COLUMNS = {
    "original_variable_name", "canonical_name", "canonical_units",
    "canonical_long_name", "unit_conversion",
}
FREQUENCY_COLUMNS = {"original_frequency_name", "canonical_name", "canonical_long_name"}
VARIABLE_MARKS = {"original_variable_name", "canonical_name", "canonical_units"}


def markdown_tables(text: str) -> list[list[dict[str, str]]]:
    """Every pipe table of a document, as lists of row dictionaries."""
    blocks: list[list[str]] = [[]]
    for line in map(str.strip, text.splitlines()):
        if line.startswith("|"):
            blocks[-1].append(line)
        elif blocks[-1]:
            blocks.append([])
    tables = []
    for block in blocks:
        grid = [[c.strip().strip("`") for c in line.strip("|").split("|")] for line in block]
        body = [cells for cells in grid[1:] if "".join(cells).strip("-: ")]
        if body:
            tables.append([dict(zip(grid[0], cells)) for cells in body])
    return tables


def table_with(tables: list[list[dict[str, str]]], columns: set[str], origin: str) -> list[dict]:
    """The rows of the table that has these columns. There has to be one, and only one."""
    match [rows for rows in tables if not columns - set(rows[0])]:
        case [rows]:
            return rows
        case found:
            raise ValueError(f"{origin} needs one table with {', '.join(sorted(columns))}; it has {len(found)}")


RENAMED = {"standard_name": "canonical_name", "long_name": "canonical_long_name", "units": "canonical_units"}
PROVENANCE = ("original_variable_name", *(f"original_{k}" for k in RENAMED))


class NameKey:
    """Lookups in both directions over one key file."""

    def __init__(self, text: str, origin: str = "name key"):
        self.origin = origin
        tables = markdown_tables(text)
        self.variables = {
            row["original_variable_name"]: row
            for row in table_with(tables, VARIABLE_MARKS, origin)
        }
        for name, row in self.variables.items():
            if not all(row.get(column) for column in VARIABLE_COLUMNS):
                raise ValueError(f"{origin}: the row of {name!r} is incomplete")
        self._originals = {row["canonical_name"]: name for name, row in self.variables.items()}
        if len(self._originals) != len(self.variables):
            raise ValueError(f"{origin}: a canonical name is used by two variables")
        self._frequencies = table_with(tables, FREQUENCY_COLUMNS, origin)

    @classmethod
    def load(cls, path: str | None = None) -> NameKey:
        return _load(str(path or _DEFAULT))

    def canonical(self, original: str) -> str:
        return self._row(original)["canonical_name"]

    def original(self, canonical: str) -> str:
        if canonical not in self._originals:
            raise KeyError(f"{self.origin} maps nothing onto {canonical!r}")
        return self._originals[canonical]

    def either(self, name: str) -> str:
        """The published name, whichever of its two spellings is given."""
        return name if name in self.variables else self.original(name)

    def resolve(self, name: str, family: Iterable[str] | None = None) -> str:
        """Like ``either``, with the errors a user-supplied name deserves."""
        try:
            original = self.either(name)
        except KeyError:
            raise ValueError(f"{name!r} is in neither name column of {self.origin}") from None
        if family is not None and original not in set(family):
            raise ValueError(f"{original!r} is not one of {list(family)}")
        return original

    def _row(self, original: str) -> dict[str, str]:
        if original not in self.variables:
            raise KeyError(f"{self.origin} has no row for {original!r}; add one there")
        return self.variables[original]

    def frequency(self, name: str) -> dict[str, str]:
        """A frequency row, looked up by either of its names."""
        for column in ("original_frequency_name", "canonical_name"):
            for row in self._frequencies:
                if row[column] == name:
                    return row
        raise KeyError(f"{self.origin} has no frequency {name!r}")

    def variable_attrs(self, current: Mapping[str, object], original: str) -> dict[str, object]:
        """The attributes a variable must carry, as layers of which the later win: what it has,
        what it had when it was published, what the key calls it. What was published is recorded
        once, so applying this to its own result changes nothing."""
        row = self._row(original)
        published = {f"original_{k}": current.get(k, "") for k in RENAMED}
        if PROVENANCE[0] in current:
            published = {k: current.get(k, "") for k in PROVENANCE}
        layers = [{PROVENANCE[0]: original}, current, published, {k: row[column] for k, column in RENAMED.items()}]
        merged = {k: v for layer in layers for k, v in layer.items()}
        note = f"{row['unit_conversion']}; {merged['original_units']!r} is spelled {merged['units']!r} here, values are as published"
        return {**merged, "unit_conversion": note}

    def as_table(self, spark: SparkSession) -> DataFrame:
        """original, canonical, units, long_name: one row per variable of the key."""
        return spark.createDataFrame(
            [
                (name, r["canonical_name"], r["canonical_units"], r["canonical_long_name"])
                for name, r in self.variables.items()
            ],
            "original string, canonical string, units string, long_name string",
        )


@functools.lru_cache(maxsize=None)
def _load(path: str) -> NameKey:
    return NameKey(pathlib.Path(path).read_text(encoding="utf-8"), path)
