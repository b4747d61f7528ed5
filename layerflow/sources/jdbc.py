"""JDBC landing source (the alternative to the CSV drop).

A partitioned read splits ``[lower, upper]`` of a numeric/date column into
``num_partitions`` ranges so each task opens its own connection; without a
partition column the whole table arrives in one task, so always pass one for
large tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 fetch_size: int = 10000, **extra) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """Columns are cast to STRING by the landing step, as for CSV."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()
