"""What the operators of this subpackage share: plain inputs, Arrow slices, shared intermediate tables."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace
from millrace.operators.joins import partitions
from millrace.session import ensure_checkpoint_dir

#: Text handled at once by a Python worker; a longer single text is handled alone.
SLICE_BYTES = 16 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors, once for an application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(millrace.__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    folder = shared_folder(spark, "code")
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    name = f"{root.name}-{uuid.uuid4().hex}.zip"
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(held.getvalue())
    context.addPyFile(f"{folder}/{name}")
    _shipped.add(context.applicationId)


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and the folder's path there."""
    return fs.FileSystem.from_uri(folder) if urlparse(folder).scheme else (fs.LocalFileSystem(), folder)


def texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id, text), a null text as the empty one. Other columns, whatever their names, are left behind."""
    ship(df.sparkSession)
    return df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that `column` holds at most `limit` bytes, or one row."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that spark.checkpoint.dir names, which all executors reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and still there when executors are lost."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables that `written` made, once nothing will read them again."""
    for table in tables:
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            store, path = store_of(folder)
            if path.rpartition("/")[2].startswith("llm-"):
                store.delete_dir(path)


def heavy(counts: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """The keys with more than half a partition's share of the rows, with salts for `left_lookup`: at most two a partition."""
    total = counts.agg(F.sum(rows)).first()[0] or 1
    pieces = F.ceil(2 * partitions(counts) * F.col(rows) / F.lit(total)).cast("int")
    return counts.select(*keys, pieces.alias("_salts")).where("_salts > 1")


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[0] .. starts[0]+sizes[0]-1, starts[1] .. and so on."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.asarray(starts, np.int64) - (ends - sizes), sizes) + np.arange(total, dtype=np.int64)


def bounds(sizes: np.ndarray) -> np.ndarray:
    """0 and the running totals of `sizes`."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)


def numbers(column: pa.Array) -> np.ndarray:
    """An Arrow column of whole numbers without nulls as numpy."""
    return np.asarray(column.cast(pa.int64()), dtype=np.int64)
