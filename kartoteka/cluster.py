"""Session helpers shared by every operator: durable cuts of lineage and joins that survive hot keys."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A class with at least this many rows is joined by broadcast instead of by shuffle ...
HOT_ROWS = 100_000
#: ... and never more than this many classes can be hot, as a hot class holds 1/HOT_KEYS of all rows or more.
HOT_KEYS = 20_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; only a session without one (tests) gets a folder of its own."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="kartoteka-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can read")


def shared_folder(spark: SparkSession) -> str:
    """The folder of :func:`ensure_checkpoint_dir`, which every executor can read."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it from there, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def hot_at(n_rows: int) -> int:
    """Rows from which a class is hot. At most ``HOT_KEYS`` classes of a table of ``n_rows`` rows can reach it."""
    return max(HOT_ROWS, -(-n_rows // HOT_KEYS))


def attach(rows: DataFrame, classes: DataFrame, keys: Sequence[str], size: str, n_rows: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with one row per class.

    ``classes`` has unique ``keys`` and the class's row count in ``size``. Classes of ``hot_at(n_rows)`` rows or more are
    broadcast (at most ``HOT_KEYS`` of them exist), so their rows never meet in one task; all others are joined by shuffle.
    ``how`` is inner or left. Rows with a null key match nothing.
    """
    keys, limit = list(keys), hot_at(n_rows)
    if n_rows < limit:  # no class can be hot
        return rows.join(classes, keys, how)
    hot = classes.where(F.col(size) >= limit)
    cold = classes.where(F.col(size) < limit)
    near = rows.join(F.broadcast(hot), keys, "inner")
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return near.unionByName(far)
