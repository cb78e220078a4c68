"""Schema and row checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.schema import CONTRACT, REQUIRED_COLUMNS, FieldRule


class MissingColumnsError(ValueError):
    """Required columns are absent."""

    def __init__(self, missing: Iterable[str]):
        self.missing = sorted(missing)
        super().__init__(f"missing required columns: {self.missing}")


def missing_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Report of the required columns that ``df`` lacks."""
    absent = sorted(set(required) - set(df.columns))
    return df.sparkSession.createDataFrame([(c,) for c in absent], "column string")


def validate_data(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Return ``df`` unchanged, or raise when required columns are absent."""
    absent = set(required) - set(df.columns)
    if absent:
        raise MissingColumnsError(absent)
    return df


def _broken(rule: FieldRule, column: Column) -> Column:
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (column < rule.low)
    if rule.high is not None:
        bad = bad | (column > rule.high)
    if rule.kind == "int":
        bad = bad | (column != F.floor(column))
    return bad


def apply_contract(df: DataFrame, rules: Iterable[FieldRule] = CONTRACT) -> DataFrame:
    """Defaults for absent optional fields and an ``errors`` list per row.

    A present null is an error, as is a required field that is absent, a value out of
    its range, or a fraction in a whole-number field. Other columns pass through.
    """
    have = set(df.columns)
    problems, filled = [], {}
    for rule in rules:
        if rule.name not in have:
            if rule.required:
                problems.append(F.lit(rule.name))
                filled[rule.name] = F.lit(None).cast("string" if rule.kind == "string" else "double")
            else:
                filled[rule.name] = F.lit(rule.default)
            continue
        column = F.col(rule.name)
        if rule.kind != "string":
            column = column.try_cast("double")
        problems.append(F.when(column.isNull() | _broken(rule, column), rule.name))
    errors = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
    if "_corrupt_record" in have:
        # PERMISSIVE scans mark a line whose text did not fit the schema.
        unread = F.when(F.col("_corrupt_record").isNotNull(), F.array(F.lit("_corrupt_record")))
        errors = F.concat(F.coalesce(unread, F.array().cast("array<string>")), errors)
    return df.withColumn("errors", errors).withColumns(filled)


def split_valid(
    df: DataFrame, rules: Iterable[FieldRule] = CONTRACT
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the contract, and the quarantined rest with their errors."""
    return by_errors(apply_contract(df, rules))


def by_errors(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without errors, and the others with theirs."""
    good = F.size("errors") == 0
    return checked.filter(good).drop("errors", "_corrupt_record"), checked.filter(~good)


def require_rows(df: DataFrame) -> DataFrame:
    """Reject an empty batch. There is no upper limit on a table."""
    if df.isEmpty():
        raise ValueError("the batch holds no records")
    return df
