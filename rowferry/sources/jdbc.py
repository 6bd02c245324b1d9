"""Options for reading from and writing to a database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

from rowferry.sources.ranges import KeyRanges


@dataclass(frozen=True)
class JdbcDatabase:
    """Where a database is; ``properties`` go to the driver as they are."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None
    fetch_size: int = 10_000
    batch_size: int = 10_000
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "user": self.user, "password": self.password, **self.properties}
        if self.driver:
            options["driver"] = self.driver
        return options

    def read_options(self, query: str) -> dict[str, str]:
        return {**self.options(), "query": query, "fetchsize": str(self.fetch_size)}

    def write_options(self, table: str) -> dict[str, str]:
        return {**self.options(), "dbtable": table, "batchsize": str(self.batch_size)}

    def connection_properties(self) -> dict[str, str]:
        """What ``spark.read.jdbc`` takes beside the URL."""
        rest = {k: v for k, v in self.options().items() if k != "url"}
        return {**rest, "fetchsize": str(self.fetch_size)}


def query_reader(spark: SparkSession, database: JdbcDatabase, query: str) -> DataFrameReader:
    return spark.read.format("jdbc").options(**database.read_options(query))


def read_query(spark: SparkSession, database: JdbcDatabase, query: str) -> DataFrame:
    """One query as a DataFrame; filters, columns and limits put on it are pushed to the database."""
    return query_reader(spark, database, query).load()


def read_table_ranges(spark: SparkSession, database: JdbcDatabase, table: str, ranges: KeyRanges) -> DataFrame:
    """A table read by as many tasks as there are ranges."""
    return spark.read.jdbc(
        database.url, table, predicates=ranges.predicates(), properties=database.connection_properties()
    )


def staging_writer(df: DataFrame, database: JdbcDatabase, table: str) -> DataFrameWriter:
    """Append rows to a table of the target database, many rows per round trip."""
    return df.write.format("jdbc").options(**database.write_options(table)).mode("append")
