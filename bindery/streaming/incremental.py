"""A cache table that grows by the keys it does not know yet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.operators.keyed import key_difference
from bindery.session import discard, materialize


def incremental_cache(
    wanted: DataFrame,
    cache: DataFrame,
    key: str,
    value: str,
    sources: Sequence[tuple[str, DataFrame]],
    missing: str = "missing",
) -> DataFrame:
    """Rows to append: each new key with its first non-missing value and the name of the source.

    ``sources`` are (name, table unique by key) in order of preference.
    """
    out = key_difference(wanted, cache, key)
    for i, (_, table) in enumerate(sources):
        out = out.join(table.select(key, F.col(value).alias(f"_v{i}")), key, "left")  # both sides unique
    found = [F.when(F.col(f"_v{i}").isNotNull(), F.lit(name)) for i, (name, _) in enumerate(sources)]
    values = [F.col(f"_v{i}") for i in range(len(sources))]
    return out.select(
        key, F.coalesce(*values).alias(value), F.coalesce(*found, F.lit(missing)).alias(f"{value}_source")
    )


def append_to_cache(new_rows: DataFrame, path: str) -> None:
    """Append as new files; what is already there is neither read nor rewritten."""
    new_rows.write.mode("append").parquet(path)


def grow_cache(
    spark: SparkSession,
    wanted_path: str,
    folder: str,
    key: str,
    value: str,
    sources: Sequence[tuple[str, DataFrame]],
    *,
    known: DataFrame | None = None,
    files_per_batch: int = 64,
    missing: str = "missing",
    flushed: Callable[[int], None] | None = None,
) -> DataFrame:
    """Look up the keys of all Parquet files under ``wanted_path`` that ``folder`` has not seen, in batches.

    Every micro-batch looks up the keys that neither ``known`` nor an earlier batch has, and writes its
    rows under its number before the stream commits it. A batch that is run again, after a failure at
    any point, reads the batches before it only and replaces its own rows; so nothing is lost or
    there twice, and a later run with the same folder goes on where the last one stopped. ``flushed``
    is called with the number of every batch that has been written. Null keys are not looked up.

    Returns the cache as it is now: ``key``, ``value``, ``value``_source, batch.
    """
    types = dict(spark.read.parquet(wanted_path).dtypes)
    values = dict(sources[0][1].dtypes)
    schema = f"`{key}` {types[key]}, `{value}` {values[value]}, `{value}_source` string"
    rows = f"{folder}/rows"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        cache = _written(session, rows, schema).filter(F.col("batch") < number).select(key)
        if known is not None:
            cache = cache.unionByName(known.select(key))
        new = materialize(incremental_cache(batch, cache, key, value, sources, missing), "new-rows")
        new.write.mode("overwrite").parquet(f"{rows}/batch={number}")
        discard(new)
        if flushed:
            flushed(number)

    stream = spark.readStream.schema(spark.read.parquet(wanted_path).schema).option("maxFilesPerTrigger", files_per_batch)
    writer = stream.parquet(wanted_path).select(key).writeStream.foreachBatch(write).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    return _written(spark, rows, schema)


def _written(spark: SparkSession, rows: str, schema: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(rows)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").option("basePath", rows).parquet(rows)
