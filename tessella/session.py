"""Session helpers shared by the queries."""

import contextlib
import contextvars
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when they share this machine's source tree."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder, read by Spark only (the path may be any store's)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir. Where it is unset, a local master takes a folder of its own; a cluster has no use for one."""
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    known = sc._jsc.sc().getCheckpointDir()
    if not conf and known.isDefined():
        return known.get()
    if not conf and (not sc.master.startswith("local") or "cluster" in sc.master):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    path = conf or tempfile.mkdtemp(prefix="spark-checkpoints-")
    if not known.isDefined():
        sc.setCheckpointDir(path)
    return path


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as make it no column of df."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_scratch: contextvars.ContextVar = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """A folder below the checkpoint folder for the tables that cut() writes inside; it goes at the end, so what is to last is to be checkpointed before."""
    folder = f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        remove(spark, folder)


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and go on from there: an iteration's lineage ends here.

    In a scratch block it is a table, whose plan and size start anew: a checkpointed frame takes its estimated size along,
    and estimates are multiplied by every join, which an iteration must not do.
    """
    checkpoint_dir(df.sparkSession)
    if not _scratch.get():
        return df.checkpoint(eager=True)
    path = f"{_scratch.get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def settings(spark: SparkSession, **values):
    """Settings of spark.sql for the plans that are run inside, by name with _ for a dot."""
    names = {f"spark.sql.{k.replace('_', '.')}": str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
