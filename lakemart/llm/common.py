"""Helpers shared by the operators of this subpackage: reading tables, lineage
cuts in the shared folder, and byte-bounded slices of Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import lakemart
from lakemart.session import scratch_root

SLICE_BYTES = 4 << 20
SLICE_ROWS = 256
#: Rows of one Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = "1000"

_SHIPPED: set[str] = set()
_FOLDERS: set[str] = set()
_LOCK = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table (all columns if none are named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, so that extra
    or clashing columns of the input never meet the operator's."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def run_folder(spark: SparkSession) -> str:
    """This application's folder for written intermediates, under the shared
    scratch folder; it goes with the application."""
    path = f"{scratch_root(spark)}/lakemart/llm-{spark.sparkContext.applicationId}"
    with _LOCK:
        if path not in _FOLDERS:
            fs, place = _place(spark, path)
            fs.mkdirs(place)
            fs.deleteOnExit(place)
            _FOLDERS.add(path)
    return path


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet under the shared scratch folder and read back:
    a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lakemart_path = path
    return out


def cut_in_two(df: DataFrame, condition: Column, purpose: str) -> tuple[DataFrame, DataFrame]:
    """``df`` written in one pass as by ``cut``, the rows where ``condition`` holds
    apart from the others; each part can be discarded on its own."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    df.withColumn("_part", F.when(condition, "yes").otherwise("no")).write.partitionBy("_part").parquet(path)
    out = []
    for part in ("yes", "no"):
        fs, place = _place(spark, f"{path}/_part={part}")
        fs.mkdirs(place)  # no rows, no folder
        found = spark.read.schema(df.schema).parquet(f"{path}/_part={part}")
        found._lakemart_path = f"{path}/_part={part}"
        out.append(found)
    return out[0], out[1]


def discard(*written: DataFrame) -> None:
    """Delete what ``cut`` wrote for each of ``written``, once no later step reads it."""
    for df in written:
        fs, place = _place(df.sparkSession, df._lakemart_path)
        fs.delete(place, True)


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def ranked(df: DataFrame, group: str, order: Sequence[str], pos: str, purpose: str) -> DataFrame:
    """``df`` written, with ``pos``: each row's place (from 0) among the rows of
    its ``group``, ordered by ``order`` (nulls first).

    The rows are range-sorted over all partitions and numbered within each; the
    counts of the preceding partitions are added. So a group of any size is
    numbered by many tasks, and what is held together is a number a partition."""
    mixed = df.withColumn("_tie", F.monotonically_increasing_id())  # parts a run of equal rows
    keys = [group, *order, "_tie"]
    in_order = mixed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = cut(in_order.withColumn("_at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_at", 33)
    heads = rows.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_head"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_head")
    heads = cut(heads.select(F.col(group).alias("_group"), "_part", shift.alias("_shift")), f"{purpose}-heads")
    same = rows[group].eqNullSafe(heads["_group"]) & (part == heads["_part"])
    return rows.join(heads, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(pos))


def prepare(spark: SparkSession) -> None:
    """Bound the rows of the Arrow batches this session sends to Python, and hand
    the package's sources to the executors (once per application)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    with _LOCK:
        if app not in _SHIPPED:
            root = Path(lakemart.__file__).parent
            archive = Path(tempfile.mkdtemp()) / "lakemart-sources.zip"
            with zipfile.ZipFile(archive, "w") as z:
                for f in sorted(root.rglob("*.py")):
                    z.write(f, f.relative_to(root.parent))
            spark.sparkContext.addPyFile(str(archive))
            _SHIPPED.add(app)




def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def as_binary(column: pa.Array) -> pa.Array:
    """Text (or bytes) as large binary, nulls as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large-binary array and the n + 1 offsets of its rows, from 0."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of at most ``SLICE_ROWS`` rows and about ``SLICE_BYTES`` text bytes
    (one row at least) with their text as large binary."""
    for batch in batches:
        column = as_binary(batch.column(batch.schema.get_field_index(text)))
        _, offsets = buffers(column)
        at = 0
        while at < len(column):
            end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
            end = min(max(end, at + 1), at + SLICE_ROWS, len(column))
            yield batch.slice(at, end - at), column.slice(at, end - at)
            at = end


def trimmed(rows: Iterator) -> Iterator:
    """``rows``; when a task has handed on the last one, its worker gives the
    memory that it freed back to the machine: workers live on from task to task,
    beside an executor's heap."""
    yield from rows
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def to_batch(**columns: object) -> pa.RecordBatch:
    arrays = {k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))
