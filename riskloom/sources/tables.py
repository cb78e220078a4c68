"""Scans and sinks."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.functions import sqltext
from riskloom.schema import CONTRACT, MISSING_MARKERS, contract_schema, raw_type


def null_markers(column: str, markers: Iterable[str] = MISSING_MARKERS) -> str:
    """SQL text of a text column with every missing marker turned into null."""
    column = sqltext.name(column)
    return f"IF({column} IN ({sqltext.values(markers)}), NULL, {column})"


def type_raw_columns(df: DataFrame) -> DataFrame:
    """Null the markers of an all-text scan and give every column its type."""
    out = []
    for column in df.columns:
        text = null_markers(column)
        if isinstance(raw_type(column), T.LongType):
            # "5" and "5.0" are both accepted; text that is no number is missing. A fraction
            # can neither be kept in a whole-number column nor be cut unnoticed.
            number = f"try_cast({text} AS DOUBLE)"
            fraction = sqltext.value(f"{column} holds a fraction where a whole number is expected: ")
            text = (
                f"coalesce(try_cast({text} AS BIGINT), CASE WHEN {number} IS NULL OR isnan({number}) THEN NULL "
                f"WHEN {number} = floor({number}) THEN try_cast({number} AS BIGINT) "
                f"ELSE CAST(raise_error(concat({fraction}, {text})) AS BIGINT) END)"
            )
        out.append(f"{text} AS {sqltext.name(column)}")
    return df.selectExpr(*out)


def load_raw_data(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """CSV scan of raw encounters. The header decides which columns exist.

    ``columns`` names the header when the caller knows it, which saves the read of the
    first line.
    """
    if columns is None:
        columns = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return type_raw_columns(
        spark.read.schema(schema).options(header=True, enforceSchema=False, escape='"').csv(path)
    )


def load_score_requests(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan of records to score; rows that do not parse keep their text.

    Each file's own header names its columns, so files of a folder may differ in their order
    and in their optional columns; a column that a file lacks is filled by its rule. Lines are
    parsed in full whatever is selected later, so that a line is either good or broken.
    """
    kinds = {f.name: f.dataType for f in contract_schema()}
    headers: dict[tuple[str, ...], list[str]] = {}
    for file, line in _header_lines(spark, path):
        names = next(csv.reader([line]), [])
        headers.setdefault(tuple(names), []).append(file)
    rules = {r.name: r for r in CONTRACT}
    every = list(dict.fromkeys(c for names in headers for c in names))
    parts = []
    for names, files in headers.items():
        fields = [T.StructField(c, kinds.get(c, T.StringType())) for c in names]
        schema = T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])
        part = spark.read.schema(schema).options(
            header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record",
            enforceSchema=True, escape='"', columnPruning=False,
        ).csv(files)
        for c in every:
            if c not in names:
                value = rules[c].default if c in rules else None
                part = part.withColumn(c, F.lit(value).cast(kinds.get(c, T.StringType())))
        parts.append(part.select(*every, "_corrupt_record"))
    if not parts:
        return spark.createDataFrame([], contract_schema())
    return reduce(DataFrame.unionByName, parts)


def _header_lines(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The first line of every file: a row per file, which the scan's file list holds anyway."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        "value", F.monotonically_increasing_id().alias("at"),
    )
    first = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    return sorted((r["file"], r["line"]) for r in first.collect())


def records_to_table(spark: SparkSession, records: Iterable[Mapping], schema=None) -> DataFrame:
    """In-memory records as a table.

    An absent optional field takes the default of its rule; a field that is present as None
    stays null, as does an absent required one, and the row checks then name it.
    """
    schema = schema or contract_schema()
    defaults = {r.name: r.default for r in CONTRACT}

    def fit(value, kind):
        if value is None:
            return None
        if isinstance(kind, T.DoubleType):
            return float(value)
        if isinstance(kind, T.LongType):
            if float(value) != int(value):
                raise ValueError(f"expected a whole number, got {value!r}")
            return int(value)
        return str(value)

    rows = [tuple(fit(r.get(f.name, defaults.get(f.name)), f.dataType) for f in schema) for r in records]
    return spark.createDataFrame(rows, schema)


def load_records(spark: SparkSession, path: str, keep: Mapping[str, str] | None = None) -> DataFrame:
    """JSON-lines scan of records to score, checked against the contract row by row.

    ``keep`` names further fields with their types; see :func:`parse_records`.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return parse_records(lines, "value", keep)


def parse_records(df: DataFrame, text: str, keep: Mapping[str, str] | None = None) -> DataFrame:
    """Contract fields of records given as JSON text, with ``errors`` and the text of broken ones.

    Records are parsed as variants, so every row knows which fields it lacks and which hold a
    null: an absent optional field takes its default; a null, an absent required field, a value
    of another type or out of its range puts the field's name into ``errors``. Numbers may be
    spelled as text, as long as they are numbers; text fields hold text only. Text that is no
    JSON object has the one error ``_corrupt_record``. Nothing raises, and fields that are
    neither in the contract nor in ``keep`` are not read.
    """
    fields = F.try_variant_get(F.try_parse_json(F.col(text)), "$", "map<string, variant>")
    # Generated, not projected: the optimizer would put a projected parse into every use of it.
    parsed = df.select(F.col(text).alias("_text"), F.explode(F.array(fields)).alias("_fields"))
    number = lambda v: F.lit(v).cast("double")
    rules = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("name"), F.lit(r.kind == "string").alias("text"), F.lit(r.kind == "int").alias("whole"),
                number(r.low).alias("low"), number(r.high).alias("high"), F.lit(r.required).alias("required"),
            )
            for r in CONTRACT
        ]
    )
    # One function for all fields, step by step; spelled out per field it would not compile in good time.
    held = F.transform(rules, lambda r: F.struct(r.alias("rule"), F.try_element_at("_fields", r["name"]).alias("v")))
    typed = F.transform(held, lambda x: F.struct(x["rule"].alias("rule"), x["v"].alias("v"), F.schema_of_variant(x["v"]).alias("kind")))
    # A null has the kind VOID, nested values are no numbers, and a field that is absent has no kind.
    nested = lambda x: F.substring(x["kind"], 1, 5).isin("VOID", "OBJEC", "ARRAY")
    valued = F.transform(
        typed,
        lambda x: F.struct(
            x["rule"].alias("rule"), x["kind"].isNull().alias("missing"),
            F.when(x["kind"] == "STRING", F.try_variant_get(x["v"], "$", "string")).alias("text"),
            F.when(~nested(x), F.try_variant_get(x["v"], "$", "double")).alias("number"),
        ),
    )

    def wrong(x: Column) -> Column:
        n, rule = x["number"], x["rule"]
        beyond = F.coalesce(n < rule["low"], F.lit(False)) | F.coalesce(n > rule["high"], F.lit(False))
        bad = n.isNull() | F.isnan(n) | beyond | (rule["whole"] & (n != F.floor(n)))
        return F.when(x["missing"], rule["required"]).otherwise(F.when(rule["text"], x["text"].isNull()).otherwise(bad))

    checked = parsed.select(
        "_text", "_fields", valued.alias("_checked")
    ).withColumn("errors", F.transform(F.filter("_checked", wrong), lambda x: x["rule"]["name"]))
    whole = F.col("_fields").isNull()
    columns = [
        F.try_variant_get(F.try_element_at("_fields", F.lit(name)), "$", kind).alias(name) for name, kind in (keep or {}).items()
    ]
    for i, rule in enumerate(CONTRACT):
        own, kind = F.get("_checked", F.lit(i)), "string" if rule.kind == "string" else "double"
        value = own["text"] if rule.kind == "string" else own["number"]
        columns.append(F.when(own["missing"], F.lit(rule.default).cast(kind)).otherwise(value).alias(rule.name))
    return checked.select(
        *columns, F.when(whole, F.array(F.lit("_corrupt_record"))).otherwise(F.col("errors")).alias("errors"),
        F.when(whole, F.col("_text")).alias("_corrupt_record"),
    )


def records_to_json(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """In-memory records as JSON text, one row each; what JSON cannot hold becomes text."""
    rows = [(json.dumps(dict(r), default=str),) for r in records]
    return spark.createDataFrame(rows, "value string")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV sink; nested columns are written as JSON text. Nulls are empty fields."""
    flat = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    df.select(*flat).write.mode("overwrite").options(header=True, escape='"').csv(path)
    return path


def preview(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """First ``n`` rows by key: a top-n, not a full sort."""
    return df.orderBy(F.col(key)).limit(n)
