"""Token files: flat unsigned integers and 64-bit document offsets, read through memory maps.

A range shuffle puts the documents in ascending order of their id. Every partition then
writes its ids to one flat file (16 bits each when the vocabulary fits, else 32), with the
lengths and the ids of its documents beside it. Prefix sums over the partitions' totals give
each of them its base, and a second, small job turns lengths into offsets in the whole corpus.

A task writes to names of its own attempt and renames them when it is done, so a task that is
run again, or twice at once, leaves the same files. Nothing but a row per partition reaches
the table of parts, and texts are encoded a few megabytes at a time.

Defined cases: a null text is an empty one, so only the end id stands for it; a null document
id sorts first and is kept as the smallest 64-bit integer; rows with one id are ordered by
their text; no rows give no files and an empty result; further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.llm.common import mounted, row_batch, slices
from riskloom.llm.tokens import encoder

NULL_ID = np.iinfo(np.int64).min
_TOTALS = pa.schema([("part", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int64())])
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _name(folder: str, part: int, kind: str) -> str:
    return f"{folder}/part-{part:06d}.{kind}"


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents below ``path`` and return the table of parts with their bases.

    ``part-N.bin`` holds ids, ``part-N.idx`` one offset per document and one for the end,
    ``part-N.ids`` the document ids; ``parts`` is the table ``(part, n_docs, n_ids, width, base)``.
    """
    spark = docs.sparkSession
    folder = mounted(path)
    os.makedirs(folder, exist_ok=True)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        names = {kind: _name(folder, part, kind) for kind in ("bin", "len", "ids")}
        files, n_docs, n_ids = {}, 0, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            if not files:
                files = {kind: open(f"{name}.{attempt}", "wb") for kind, name in names.items()}
            ids = [x + end for x in encode.encode(batch.column("text").to_pylist())]
            lengths = np.array([len(x) // 4 for x in ids], "<u8")
            flat = np.frombuffer(b"".join(ids), "<u4")
            files["bin"].write(flat.astype(f"<u{width}").tobytes())
            files["len"].write(lengths.tobytes())
            keys = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            files["ids"].write(keys.astype("<i8").tobytes())
            n_docs, n_ids = n_docs + len(ids), n_ids + len(flat)
        for kind, file in files.items():
            file.flush()
            os.fsync(file.fileno())
            file.close()
            os.replace(f"{names[kind]}.{attempt}", names[kind])
        if files:
            yield row_batch(_TOTALS, [part], [n_docs], [n_ids], [width])

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        # The hash lets a doubled id spread over several ranges; equal texts stay in any order.
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
    )
    totals = ordered.mapInArrow(write, "part long, n_docs long, n_ids long, width long")
    totals.write.mode("overwrite").parquet(f"{path}/totals")
    # One row per part: the number of partitions, not of documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spark.read.parquet(f"{path}/totals").withColumn(
        "base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    ).write.mode("overwrite").parquet(f"{path}/parts")
    parts = spark.read.parquet(f"{path}/parts")
    _per_part(parts, _write_offsets(folder), "part long").write.mode("overwrite").parquet(f"{path}/done")
    return parts


def _per_part(parts: DataFrame, function, schema: str) -> DataFrame:
    """Run ``function`` on the rows of ``parts``, spread over the tasks."""
    return parts.repartition("part").mapInArrow(function, schema)


def _write_offsets(folder: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.memmap(_name(folder, row["part"], "len"), "<u8", "r")
                offsets = np.empty(len(lengths) + 1, "<u8")
                offsets[0] = row["base"]
                np.cumsum(lengths, out=offsets[1:])
                offsets[1:] += np.uint64(row["base"])
                name = _name(folder, row["part"], "idx")
                offsets.tofile(f"{name}.{attempt}")
                os.replace(f"{name}.{attempt}", name)
                yield row_batch(pa.schema([("part", pa.int64())]), [row["part"]])

    return write


def read_token_files(spark: SparkSession, path: str, rows: int = 20_000) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids_crc32``.

    Ids are read through a memory map, ``rows`` documents at a time.
    """
    folder = mounted(path)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.memmap(_name(folder, row["part"], "bin"), f"<u{row['width']}", "r")
                offsets = np.memmap(_name(folder, row["part"], "idx"), "<u8", "r")
                keys = np.memmap(_name(folder, row["part"], "ids"), "<i8", "r")
                for at in range(0, len(keys), rows):
                    span = offsets[at : at + rows + 1].astype(np.int64)
                    own = (span - row["base"]).tolist()
                    crcs = [
                        zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(own, own[1:])
                    ]
                    names = np.array(keys[at : at + rows])
                    yield row_batch(
                        _ROWS, pa.array(names, mask=names == NULL_ID), span[:-1], np.diff(span), crcs
                    )

    parts = spark.read.parquet(f"{path}/parts")
    return _per_part(parts, read, "doc_id long, start long, n_tokens long, ids_crc32 long")
