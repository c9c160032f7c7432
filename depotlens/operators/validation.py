"""Rule-based validation: one pass that marks rows, one aggregate that reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.config import EngineConfig

VIOLATIONS = "violations"


@dataclass(frozen=True)
class Rules:
    required_columns: tuple[str, ...] = ()
    not_null_columns: tuple[str, ...] = ()
    numeric_ranges: Mapping[str, tuple[Any, Any]] = field(default_factory=dict)
    allowed_values: Mapping[str, Iterable[Any]] = field(default_factory=dict)


def transaction_rules(cfg: EngineConfig) -> Rules:
    return Rules(
        required_columns=("invoice_no", "stock_code", "quantity", "unit_price", "invoice_date", "store_id"),
        not_null_columns=("invoice_no", "stock_code", "store_id"),
        numeric_ranges={"quantity": cfg.quantity_range, "unit_price": cfg.price_range},
    )


@dataclass(frozen=True)
class ValidationReport:
    total_rows: int
    valid_rows: int
    errors: tuple[str, ...] = ()
    rule_counts: Mapping[str, int] = field(default_factory=dict)

    @property
    def invalid_rows(self) -> int:
        return self.total_rows - self.valid_rows

    @property
    def is_valid(self) -> bool:
        return not self.errors and self.invalid_rows == 0

    def raise_if_invalid(self, max_invalid_ratio: float = 0.0) -> None:
        if self.errors:
            raise ValueError(f"validation failed: {list(self.errors)}")
        ratio = self.invalid_rows / self.total_rows if self.total_rows else 0.0
        if ratio > max_invalid_ratio:
            raise ValueError(
                f"validation failed: {self.invalid_rows} of {self.total_rows} rows invalid "
                f"({ratio:.1%}, allowed {max_invalid_ratio:.1%})"
            )


def _missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN where the type has it."""
    kind = df.schema[name].dataType
    empty = F.col(name).isNull()
    return empty | F.isnan(name) if isinstance(kind, (T.DoubleType, T.FloatType)) else empty


def rule_conditions(df: DataFrame, rules: Rules) -> dict[str, Column]:
    """Rule name -> condition that is true (never NULL) on a row that breaks it."""
    broken: dict[str, Column] = {}
    for name in rules.not_null_columns:
        broken[f"{name}_not_null"] = _missing(df, name)
    for name, (low, high) in rules.numeric_ranges.items():
        outside = (F.col(name) < F.lit(low)) | (F.col(name) > F.lit(high))
        broken[f"{name}_in_range"] = _missing(df, name) | F.coalesce(outside, F.lit(True))
    for name, allowed in rules.allowed_values.items():
        broken[f"{name}_allowed"] = ~F.coalesce(F.col(name).isin(*allowed), F.lit(False))
    return broken


class Validation:
    """The marked rows of one frame; nothing runs until a report or a split is used."""

    def __init__(self, df: DataFrame, rules: Rules):
        self.source = df
        missing = [c for c in rules.required_columns if c not in df.columns]
        self.errors = (f"missing required columns: {missing}",) if missing else ()
        self.conditions = {} if missing else rule_conditions(df, rules)

    def _any_broken(self) -> Column:
        broken = F.lit(bool(self.errors))
        for condition in self.conditions.values():
            broken = broken | condition
        return broken

    @property
    def marked(self) -> DataFrame:
        """The rows with the names of the rules they break."""
        names = [F.when(c, F.lit(n)) for n, c in self.conditions.items()]
        found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
        return self.source.withColumn(VIOLATIONS, found)

    @property
    def valid(self) -> DataFrame:
        return self.source.where(~self._any_broken())

    @property
    def quarantined(self) -> DataFrame:
        return self.marked.where(self._any_broken())

    def report_frame(self) -> DataFrame:
        """One row: total, valid and invalid rows and a count per rule."""
        counts = [F.count_if(c).alias(n) for n, c in self.conditions.items()]
        return self.source.agg(
            F.count("*").alias("total_rows"),
            F.count_if(~self._any_broken()).alias("valid_rows"),
            F.count_if(self._any_broken()).alias("invalid_rows"),
            *counts,
        )

    def report(self) -> ValidationReport:
        row = self.report_frame().first().asDict()
        total, valid = row.pop("total_rows"), row.pop("valid_rows")
        row.pop("invalid_rows")
        return ValidationReport(total, valid, self.errors, row)


def validate(df: DataFrame, rules: Rules) -> Validation:
    return Validation(df, rules)


def validate_transactions(lines: DataFrame, cfg: EngineConfig) -> Validation:
    return Validation(lines, transaction_rules(cfg))
