"""Helpers shared by the training-data operators.

Intermediate tables are Parquet folders below ``spark.checkpoint.dir`` (the
shared folder the cluster names), so an executor loss costs a re-read, never a
recomputation from the source.  ``drop_table`` removes one as soon as nothing
reads it any more; the tables a returned frame still reads lazily stay.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.session import scratch_path

#: Raw text bytes handled at once inside a task; bounds the Python side's memory.
SLICE_BYTES = 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once."""
    context = spark.sparkContext
    if getattr(context, "_parcelkit_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="parcelkit-code-")) / "parcelkit"), "zip",
                                  root.parent, root.name)
    context.addPyFile(archive)
    context._parcelkit_shipped = True


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: (frame, path)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, *paths: str) -> None:
    """Delete folders written by ``materialize`` through Spark's file system layer."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def text_slices(batches: Iterator[pa.RecordBatch], column: str | tuple[str, ...],
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``limit`` bytes of
    ``column`` (of several: of all together), or a single row when that row
    alone is longer."""
    import pyarrow.compute as pc
    names = (column,) if isinstance(column, str) else column
    for batch in batches:
        each = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_pylist() for c in names]
        sizes = [sum(row) for row in zip(*each, strict=True)] if len(each) > 1 else each[0]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def text_digest(col: str = "text"):
    """Digest of a text's UTF-8 bytes (null counts as empty): 32 bytes, so
    equal digests mean equal texts."""
    return F.unhex(F.sha2(F.coalesce(F.col(col), F.lit("")).cast("binary"), 256))
