"""Tables an operator must keep between two jobs, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where that is unset (local tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="castellan-")
    return _OWN[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/castellan/{uuid.uuid4().hex}/{name}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here and a lost executor loses nothing.

    The reread table also has a known size, so that Spark's own size check decides about broadcasting it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its own object."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_kept(df: DataFrame) -> None:
    """Delete the files of a table that keep() wrote and that nothing will read again."""
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/castellan/" in f:
            fs, p = hadoop(df.sparkSession, f)
            fs.delete(p, True)
