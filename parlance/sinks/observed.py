"""Summaries taken while a table is written.

``observe`` adds aggregates to the write itself, so no second job computes the rows again to count them.  The number of
aggregates is fixed (one a value of a closed list), never one a key of the data.

Put the observed rows directly under the write: a task of the last stage counts once however often it is tried, while a stage before a
shuffle, run again after its executor was lost, would count twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Observed:
    """``df`` with aggregates whose values are known once the first action over it has ended (``get`` waits for that)."""

    def __init__(self, df: DataFrame, aggregates: dict[str, Column]):
        self._seen = Observation()
        self.df = df.observe(self._seen, *[a.alias(name) for name, a in aggregates.items()])

    def get(self) -> dict:
        return self._seen.get


class Counted(Observed):
    """Rows by the value of ``column``, out of the closed list ``values``, and the sums of other columns."""

    def __init__(self, df: DataFrame, column: str, values: tuple[str, ...], count: str, sums: dict[str, str] | None = None):
        self._column, self._values, self._count, self._sums = column, values, count, sums or {}
        known = F.coalesce(F.col(column), F.lit(""))
        made = {"others": F.count_if(~known.isin(*values))}
        for k, value in enumerate(values):
            made[f"n{k}"] = F.count_if(known == value)
            made |= {f"{name}{k}": F.sum(F.when(known == value, F.col(c))) for name, c in self._sums.items()}
        super().__init__(df, made)

    def table(self) -> DataFrame:
        """One row for each value that occurs, as the group-by would give."""
        got = self.get()
        if got.get("others"):
            raise ValueError(f"{got['others']} rows whose {self._column} is none of {', '.join(self._values)}")
        rows = [(value, got[f"n{k}"], *[got[f"{name}{k}"] for name in self._sums]) for k, value in enumerate(self._values) if got.get(f"n{k}")]
        names = [self._column, self._count, *self._sums]
        return self.df.sparkSession.createDataFrame(rows, ", ".join(f"`{n}` {'string' if n == self._column else 'bigint'}" for n in names))
