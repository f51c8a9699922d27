"""Grid cells over the earth, so that "near" becomes an equality join.

Rows are bands of equal latitude; each band is cut into a whole number of cells, so longitude
wraps by modulo and the poles need no special case. A cell is never longer than ``side`` miles
in either direction, hence two places of one cell are at most ``side * sqrt(2)`` apart.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.geo import MAX_MILES_PER_DEGREE, half_height_degrees

# Columns of a row fit well below this, so a cell is one long: row * stride + column.
_STRIDE = 1 << 32


@dataclass(frozen=True)
class Grid:
    side: float

    @classmethod
    def with_diagonal(cls, miles: float) -> Grid:
        """Grid whose cells have no two places further apart than the given miles."""
        return cls(miles / math.sqrt(2.0) * 0.999)

    @property
    def height(self) -> float:
        return self.side / MAX_MILES_PER_DEGREE

    @property
    def last_row(self) -> int:
        return int(180.0 / self.height)

    def _row(self, latitude: Column) -> Column:
        return F.least(F.floor((latitude + 90.0) / self.height), F.lit(self.last_row))

    def _row_cells(self, row: Column) -> Column:
        south = row * self.height - 90.0
        north = south + self.height
        widest = F.when((south <= 0) & (north >= 0), 1.0).otherwise(
            F.greatest(F.cos(F.radians(south)), F.cos(F.radians(north)))
        )
        return F.greatest(F.ceil(widest * (360.0 * MAX_MILES_PER_DEGREE / self.side)), F.lit(1))

    def cell(self, latitude: Column, longitude: Column) -> Column:
        row = self._row(latitude)
        cells = self._row_cells(row)
        column = F.pmod(F.floor((longitude + 180.0) * cells / 360.0), cells)
        return row * _STRIDE + column

    def near_cells(
        self,
        df: DataFrame,
        radius: float,
        name: str = "cell",
        latitude: str = "latitude",
        longitude: str = "longitude",
    ) -> DataFrame:
        """A row per cell that can hold a place within the radius of the row's place.

        How many depends on radius / side only, never on the data. Rows of cells are listed
        first and the cells of each row then, which both compile to plain loops.
        """
        lat, lon = F.col(latitude), F.col(longitude)
        high = half_height_degrees(radius)
        first = F.greatest(F.floor((lat - high + 90.0) / self.height), F.lit(0))
        last = F.least(F.floor((lat + high + 90.0) / self.height), F.lit(self.last_row))
        reach = F.least(math.sin(math.radians(high)) / F.cos(F.radians(lat)), F.lit(1.0))
        wide = F.when(F.abs(lat) + high >= 90.0, 180.0).otherwise(F.degrees(F.asin(reach)) + 1e-9)
        # Names no table column has; they are gone from the result.
        row, cells, west, east = (F.col(f"_{name}_{part}") for part in ("row", "of", "west", "east"))
        rows = df.select(
            "*", wide.alias(f"_{name}_wide"), F.explode(F.sequence(first, last)).alias(f"_{name}_row")
        )
        rows = rows.select("*", self._row_cells(row).alias(f"_{name}_of"))
        span = F.col(f"_{name}_wide")
        rows = rows.select(
            "*",
            F.floor((lon + 180.0 - span) * cells / 360.0).alias(f"_{name}_west"),
            F.floor((lon + 180.0 + span) * cells / 360.0).alias(f"_{name}_east"),
        )
        column = F.explode(F.sequence(west, F.least(east, west + cells - 1)))
        listed = rows.select("*", column.alias(f"_{name}_column"))
        found = row * _STRIDE + F.pmod(F.col(f"_{name}_column"), cells)
        return listed.select(*df.columns, found.alias(name))
