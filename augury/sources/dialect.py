"""Fixture SQL is written once and rendered for Spark and for DuckDB; the few functions that differ are here."""

from __future__ import annotations


class Dialect:
    """Renders what the two engines spell differently."""

    def __init__(self, name: str):
        self.spark = name == "spark"

    def div(self, a: str, b: object) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def days(self, ts: str) -> str:
        return f"cast(unix_date(cast({ts} as date)) as bigint)" if self.spark else f"cast(date_diff('day', date '1970-01-01', cast({ts} as date)) as bigint)"

    def millis(self, ts: str) -> str:
        return f"unix_millis(cast({ts} as timestamp))" if self.spark else f"(epoch_us({ts}) // 1000)"

    def hex64(self, x: str) -> str:
        return f"lpad(lower(hex({x})), 64, '0')" if self.spark else f"lpad(lower(to_hex({x})), 64, '0')"

    def number(self, text: str) -> str:
        """First run of digits in a text."""
        return f"cast(regexp_extract({text}, '([0-9]+)', 1) as bigint)"


SPARK, DUCKDB = Dialect("spark"), Dialect("duckdb")
