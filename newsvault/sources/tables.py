"""Seeds, named tables and external tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsvault.schemas import DIM_COUNTRY


def read_seed(spark: SparkSession, path: str, schema=DIM_COUNTRY) -> DataFrame:
    """CSV seed with header; the code ``NA`` stays a code."""
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1,
              **options: str) -> DataFrame:
    """A table of an external database, split by a numeric column when one is given."""
    reader = spark.read.format("jdbc").options(
        **jdbc_options(url, table, partition_column, lower, upper, partitions, **options))
    return reader.load()


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, partitions: int = 1,
                 **options: str) -> dict[str, str]:
    out = {"url": url, "dbtable": table, "fetchsize": "10000", **options}
    if partition_column:
        out.update(partitionColumn=partition_column, lowerBound=str(lower),
                   upperBound=str(upper), numPartitions=str(partitions))
    return out


class TableRegistry:
    """Names to tables: Parquet folders, frames or external tables, as temporary views."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._names: dict[str, str] = {}

    def _register(self, schema: str, name: str, df: DataFrame) -> DataFrame:
        view = f"{schema}__{name}"
        df.createOrReplaceTempView(view)
        self._names[f"{schema}.{name}"] = view
        return df

    def add_parquet(self, schema: str, name: str, path: str, struct=None) -> DataFrame:
        reader = self.spark.read.schema(struct) if struct else self.spark.read
        return self._register(schema, name, reader.parquet(path))

    def add_view(self, schema: str, name: str, df: DataFrame) -> DataFrame:
        return self._register(schema, name, df)

    def add_jdbc(self, schema: str, name: str, **kwargs) -> DataFrame:
        return self._register(schema, name, read_jdbc(self.spark, **kwargs))

    def table(self, schema: str, name: str) -> DataFrame:
        return self.spark.table(self._names[f"{schema}.{name}"])

    def names(self) -> list[str]:
        return sorted(self._names)
