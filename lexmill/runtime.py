"""Session helpers shared by all operators: the shared folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    It is the session's ``spark.checkpoint.dir``; only where that is unset, as in tests on one machine, a temporary
    folder is made and set.
    """
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    made = "file://" + tempfile.mkdtemp(prefix="lexmill-")
    sc.setCheckpointDir(made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/lexmill/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a path that new_path gave, through the cluster's file system."""
    if "/lexmill/" not in path:
        raise ValueError(f"not a path made here: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str = "table", compact: bool = True, counted: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, and a lost executor costs nothing.

    ``counted``: the rows are counted as they are written; ``known_rows`` tells how many, without a job of its own. With ``compact=False`` neither compression nor dictionaries are used, so that the files' size, by which a join
    decides on a broadcast, says how large the rows are in memory.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    plain = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}
    seen = Observation() if counted else None
    to_write = df.observe(seen, F.count(F.lit(1)).alias("rows")) if counted else df
    to_write.write.options(**({"compression": "zstd"} if compact else plain)).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lexmill_path = path
    out._lexmill_rows = seen.get["rows"] if counted else None
    return out


def known_rows(df: DataFrame) -> int:
    """Rows of a table that materialize counted."""
    return df._lexmill_rows


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is read in fewer partitions than that, as one small file is; else as it is.

    For operators whose work on a row far outweighs moving it. Filters and column selections still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def discard(df: DataFrame | None) -> None:
    """Remove the files of a table that materialize wrote and nothing needs any more."""
    path = getattr(df, "_lexmill_path", None)
    if path:
        drop_path(df.sparkSession, path)
