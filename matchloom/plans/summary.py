"""A summary of a keyed table that is kept up from version to version instead of counted anew.

The summary holds additive measures (counts, sums of whole numbers or decimals) for each combination of dimensions, with the table's version that it is true for. To bring it up to
date, the rows of the buckets that differ between that version and the current one are aggregated, the old ones with a minus sign, and added. So a decision
on a few rows costs their buckets, not the table, and counts go down as well as up. Combinations that are left without rows go.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .apply import VersionedTable
from .keyed import KeyedTable

COUNT, AT = "n_rows", "table_version"


@dataclass
class KeptSummary:
    """dimensions: name -> column; measures: name -> a column that is summed, null counts as 0. Sums of doubles don't come back exactly; cast them to decimals."""

    table: KeyedTable
    cache: VersionedTable
    dimensions: dict[str, Column]
    measures: dict[str, Column]

    def _totals(self, rows: DataFrame, sign: int) -> DataFrame:
        sums = [F.sum(F.coalesce(c, F.lit(0)) * F.lit(sign)).alias(k) for k, c in self.measures.items()]
        return rows.groupBy(*(c.alias(k) for k, c in self.dimensions.items())).agg((F.count("*") * F.lit(sign)).alias(COUNT), *sums)

    def recount(self) -> DataFrame:
        """The summary from all rows."""
        return self._totals(self.table.read(), 1)

    def version(self) -> int | None:
        """The table's version that the summary is true for."""
        return self.cache.read().select(AT).first()[0] if self.cache.versions() else None

    def read(self) -> DataFrame:
        return self.cache.read().where(f"{COUNT} is not null").drop(AT)

    def refresh(self) -> int:
        """Brings the summary up to the table's current version and returns that."""
        held, now = self.version(), self.table.versions()[-1]
        if held == now:
            return now
        if held is None:
            rows = self.recount()
        else:
            old, new = self.table.differing(held, now)
            names = [COUNT, *self.measures]
            parts = self.read().unionByName(self._totals(old, -1)).unionByName(self._totals(new, 1))
            kinds = {f.name: f.dataType for f in self.read().schema.fields}
            rows = parts.groupBy(*self.dimensions).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in names)).where(F.col(COUNT) != 0)
        # a row without dimensions keeps the version where nothing is left
        marker = rows.sparkSession.createDataFrame([(now,)], f"{AT} int")
        self.cache.write(rows.withColumn(AT, F.lit(now)).unionByName(marker, allowMissingColumns=True))
        return now
