"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names. Only a local session without one gets a temporary folder; on a cluster a
    folder of one machine would lose data, so there it is an error."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("no shared folder: set spark.checkpoint.dir")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="postloom-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there, so that a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, removed when the program ends or by drop_path()."""
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    atexit.register(drop_path, spark, path)
    return path


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared checkpoint folder. Unlike a checkpoint it is worked out once and its columns can be read apart."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes a table of written() before the program ends: for what no plan still to run reads."""
    drop_path(df.sparkSession, df.written_path)


def has_path(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes what is at a path; nothing if it is gone or the session has ended."""
    if spark.sparkContext._jsc is None:
        return
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the JVM may be gone
        return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
