"""Writers and the model store."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sink_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays are written as list-literal text."""
    flat = df.withColumns({c: list_literal(F.col(c)) for c, t in df.dtypes if t == "array<string>"})
    flat.write.mode("overwrite").options(header=True, escape='"', quoteAll=False, emptyValue='""').csv(path)


def list_literal(items: Column) -> Column:
    """Array to text such as ``['a', "b's"]``."""

    def quoted(x):
        single = F.concat(F.lit("'"), x, F.lit("'"))
        return F.when(x.contains("'"), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(single)

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def sink_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Parquet; with a partition column its rows are brought together first, in balanced pieces."""
    if partition_by:
        df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def sink_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
