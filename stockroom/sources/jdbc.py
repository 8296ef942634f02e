"""Relational databases as source and sink, read in parallel ranges.

The database's JDBC driver must be on Spark's class path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcConfig:
    """Where a database is and how to log in."""

    host: str
    port: int
    database: str
    user: str
    password: str = field(repr=False)
    dialect: str = "postgresql"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def url(self) -> str:
        return f"jdbc:{self.dialect}://{self.host}:{self.port}/{self.database}"

    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "fetchsize": "10000", **self.options}


@dataclass(frozen=True)
class Ranges:
    """Split of a scan: ``count`` ranges of a numeric, date or timestamp column."""

    column: str
    low: str
    high: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.low,
            "upperBound": self.high,
            "numPartitions": str(self.count),
        }


def read_jdbc(
    spark: SparkSession, cfg: JdbcConfig, table: str, partition_by: Ranges | None = None
) -> DataFrame:
    """A table as a lazy frame; filters and columns are pushed to the database.

    Without ranges one task reads everything: give them for any sizeable table.
    """
    reader = spark.read.format("jdbc").option("url", cfg.url).option("dbtable", table)
    reader = reader.options(**cfg.properties())
    return reader.options(**(partition_by.options() if partition_by else {})).load()


def write_jdbc(
    df: DataFrame, cfg: JdbcConfig, table: str, mode: str = "append", connections: int = 16
) -> None:
    """Write with at most ``connections`` concurrent connections."""
    writer = df.write.format("jdbc").mode(mode).option("url", cfg.url).option("dbtable", table)
    writer.options(**cfg.properties()).option("numPartitions", connections).save()
