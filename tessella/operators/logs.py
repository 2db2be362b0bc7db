"""Tables that grow and change in place: slices replaced in a folder, logs that take each event once, and their state by Structured Streaming."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessella import session

SLICES = 64  # ranges of keys of a state table; a batch rewrites those it touches


def exists(spark, path: str) -> bool:
    """Whether a store has something at a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _digests(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, and what tells a slice's rows apart from others, in any order: their number and two sums of hashes."""
    columns = sorted(c for c in df.columns if c not in keys)
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns]).cast("decimal(20,0)"))
    return df.groupBy(*keys).agg(F.count("*").alias("n_"), total(1).alias("a_"), total(2).alias("b_"))


def _same(a: str, b: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def write_slices(df: DataFrame, path: str, keys: list[str]) -> int:
    """Replace the slices (values of keys) of the parquet table at `path` that df has rows of; how many were written.

    df is staged in the shared scratch folder first, so it may read the table itself. Slices that already hold just these rows are left alone, so a second
    run writes nothing; slices that df does not have keep their files. A slice of many rows is written by many tasks.
    """
    spark = df.sparkSession
    with session.scratch(spark):
        staged = session.cut(df)
        if exists(spark, path):
            old = spark.read.schema(staged.schema).parquet(path)
            new = _digests(staged, keys).alias("n").join(_digests(old, keys).alias("o"), _same("n", "o", [*keys, "n_", "a_", "b_"]), "left_anti")
            new = session.cut(new.select(*keys))
            count = new.count()
            if not count:
                return 0
            staged = staged.alias("s").join(new.alias("k"), _same("s", "k", keys), "left_semi")
        else:
            count = staged.select(*keys).distinct().count()
        staged.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
        return count


def append_once(batch: DataFrame, path: str, number: int, ident: list[str], order: str) -> None:
    """Add the batch's events to the log at `path`, one row each (the first in the order), without those that earlier batches added.

    A batch has a folder of its own, so one that is run again replaces what it wrote.
    """
    spark = batch.sparkSession
    columns = [c for c in batch.columns if c not in ident]
    first = batch.groupBy(*ident).agg(F.min_by(F.struct(*columns), F.struct(order, *columns)).alias("row")).select(*ident, "row.*")
    if exists(spark, path):
        old = spark.read.option("basePath", path).schema(f"{batch.select(*ident)._jdf.schema().toDDL()}, batch long").parquet(path).filter(F.col("batch") < number)
        first = first.alias("n").join(old.alias("o"), _same("n", "o", ident), "left_anti")
    first.write.mode("overwrite").parquet(f"{path}/batch={number}")


def upsert_last(batch: DataFrame, path: str, keys: list[str], order: str, columns: list[str], slices: int = SLICES) -> None:
    """Bring the table of each key's last entry at `path` up to a batch of entries; only slices of keys that the batch has are read and written. Repeating a batch changes nothing."""
    spark = batch.sparkSession
    entries = batch.select(*keys, order, *columns).withColumn("slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
    if exists(spark, path):
        touched = entries.select("slice").distinct()
        entries = entries.unionByName(spark.read.schema(entries.schema).parquet(path).join(F.broadcast(touched), "slice", "left_semi"))  # `slices` rows at most
    values = [c for c in (order, *columns)]
    last = entries.groupBy("slice", *keys).agg(F.max_by(F.struct(*values), F.struct(order, *columns)).alias("row")).select(*keys, "row.*", "slice")
    write_slices(last, path, ["slice"])


def follow(stream: DataFrame, folder: str, ident: list[str], keys: list[str], order: str, columns: list[str]) -> StreamingQuery:
    """Start following a stream of entries: folder/log takes each entry (by ident) once, folder/state each key's last one.

    What is there is taken in batches until the stream has no more; a later call with the same folder goes on where this one ended, and a
    batch that was cut short is run again with the same result.
    """

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            append_once(batch, f"{folder}/log", number, ident, order)
            upsert_last(batch, f"{folder}/state", keys, order, columns)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()


def state(spark, folder: str, schema: str) -> DataFrame:
    """The state table of a followed stream."""
    return spark.read.schema(f"{schema}, slice int").parquet(f"{folder}/state").drop("slice")


def log(spark, folder: str, schema: str) -> DataFrame:
    """The log of a followed stream."""
    return spark.read.option("basePath", f"{folder}/log").schema(f"{schema}, batch long").parquet(f"{folder}/log").drop("batch")
