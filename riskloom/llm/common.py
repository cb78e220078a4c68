"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.session import scratch_path, stored

__all__ = ["keep", "mounted", "read_table", "row_batch", "scratch_path", "slices", "stored"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the file, also when there are no rows."""
    return stored(df, name)


def mounted(path: str) -> str:
    """The plain path of a folder that every executor has mounted."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted folder, not {parts.scheme}://")
    return unquote(parts.path)


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at] - sizes[at]
            end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def row_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")
