"""Session helpers.

``get_session`` is for tests, the bench and local runs only; on a cluster the
caller owns the session.  ``checkpoint_root`` reads ``spark.checkpoint.dir``
from the session and only invents a local folder when nothing is configured
and the master is local (tests, the bench); on a cluster it raises, since a
machine-local folder would scatter the files.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Partitions of a few hundred MB fit executor memory at 100 TB scale;
    # locally this just keeps the file split count low.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # Wide projections (model feature frames, fused profile aggregates) make
    # whole-stage-codegen methods above HotSpot's 8000-byte JIT limit; without
    # this flag they run in the bytecode interpreter (measured 4-5x slower).
    # Set the same on executors of a cluster.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # With the flag huge methods are compiled, so they may stay.
    "spark.sql.codegen.hugeMethodLimit": "65535",
}

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: HotSpot leaves methods of more bytes to its interpreter.
JIT_BYTES = 8000


def get_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                app: str = "parcelkit", memory: str = "16g") -> SparkSession:
    """Build (or reuse) a local session configured like the tests expect."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    parts = shuffle_partitions or (8 if cpus == "*" else int(cpus))
    conf = dict(_LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(parts)
    conf["spark.driver.memory"] = memory
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def within_jit(spark: SparkSession) -> None:
    """Stages whose generated method HotSpot would not compile run operator by operator, in small methods that it does
    compile.  A session that has set the limit (as ``get_session``, with the JVM flag) keeps its own."""
    if spark.conf.get(_METHOD_LIMIT, None) is None:
        spark.conf.set(_METHOD_LIMIT, str(JIT_BYTES))


#: Stands in for spark.checkpoint.dir in a local session that has none.
_local_root: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a local one is set only if none is
    configured and all tasks run in this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set, and executors of {master!r} need a shared folder")
        global _local_root
        root = _local_root = _local_root or tempfile.mkdtemp(prefix="parcelkit-ckpt-")
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 -- sessions without a local SparkContext
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root (never machine-local
    on a cluster, because the root comes from the session)."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, *paths: str) -> None:
    """Delete folders through Spark's file system layer (any Hadoop file system)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


#: Scratch folders of this session's lineage cuts, in the order they were written.
_scratch: list[str] = []


def cut_lineage(df):
    """``df`` written as Parquet to the shared folder and read back.

    A lost executor recomputes from the file, and what reads it gets column
    pruning and filter pushdown, which a row-format checkpoint has not.
    ``release_scratch`` removes the files when nothing reads them any more."""
    return write_cut(df)[0]


def write_cut(df) -> tuple:
    """The frame of ``cut_lineage`` and its folder, which ``drop_cut`` removes."""
    path = scratch_path(df.sparkSession, "lineage")
    df.write.parquet(path)
    _scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_cut(spark: SparkSession, path: str) -> None:
    """Remove one lineage cut that nothing reads any more."""
    _scratch.remove(path)
    remove_path(spark, path)


def scratch_mark() -> int:
    """A mark for ``release_scratch``: what is cut after it can be released."""
    return len(_scratch)


def release_scratch(spark: SparkSession, mark: int = 0) -> None:
    """Remove the lineage cuts written since ``mark``; call it when every frame
    that reads them has been written or collected."""
    paths, _scratch[mark:] = _scratch[mark:], []
    remove_path(spark, *paths)
