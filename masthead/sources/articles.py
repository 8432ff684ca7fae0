"""Reading the article table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from masthead.schema import ARTICLES


def read_articles(spark: SparkSession, source: str, form: str = "parquet") -> DataFrame:
    """Articles from files (``form`` names their format), or from a catalog table (``form="table"``).

    Files are read with the declared schema, so no job is spent on finding it. Columns and filters that a
    later step does not need are dropped by Catalyst before the scan.
    """
    if form == "table":
        return spark.table(source)
    return spark.read.schema(ARTICLES).format(form).load(source)


def read_articles_jdbc(
    spark: SparkSession,
    url: str,
    id_bounds: tuple[int, int],
    table: str = "articles",
    partitions: int = 32,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Articles from a relational database, read in parallel ranges of ``id``.

    ``id_bounds``, the smallest and largest id, only places the range borders; ids outside them fall into the first and
    last range.
    """
    return spark.read.jdbc(
        url,
        table,
        column="id",
        lowerBound=id_bounds[0],
        upperBound=id_bounds[1],
        numPartitions=partitions,
        properties=properties or {},
    )
