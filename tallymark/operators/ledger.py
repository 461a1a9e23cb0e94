"""A ledger: the tables the rules read, as plain DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from tallymark.operators import skew


@dataclass
class Ledger:
    coupons: DataFrame
    grades: DataFrame
    coupon_stocks: DataFrame
    issuances: DataFrame
    issuance_histories: DataFrame
    issuance_usages: DataFrame
    members: DataFrame | None = None
    coupon_stats: DataFrame | None = None
    verification_runs: DataFrame | None = None
    expected_findings: DataFrame | None = None
    _hot: dict = field(default_factory=dict, repr=False)

    def hot(self, table: str, *columns: str) -> skew.Hot:
        """Heavy keys of one table, looked for once per ledger."""
        if (table, columns) not in self._hot:
            self._hot[table, columns] = skew.hot_keys(getattr(self, table), columns)
        return self._hot[table, columns]

    def history_rows(self) -> int | None:
        """Rows of the history; as many as findings at most, or about so."""
        return self.hot("issuance_histories", "issuance_id").rows

    def with_tables(self, **tables: DataFrame) -> "Ledger":
        return replace(self, _hot={}, **tables)

    def tables(self) -> dict[str, DataFrame]:
        return {
            name: value
            for name, value in vars(self).items()
            if not name.startswith("_") and value is not None
        }
