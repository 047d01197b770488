"""The JDBC warehouse: replace or append a table, and promote a staged table in one transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.params import JdbcTarget
from hirelake.schemas import CLEAN_COLUMNS


def jdbc_options(target: JdbcTarget, table: str, connections: int = 16) -> dict[str, str]:
    """Options of a write: a replaced table keeps its definition, and so many connections write at most."""
    return {
        "url": target.url,
        "dbtable": target.table(table),
        "user": target.user,
        "password": target.password,
        "driver": target.driver,
        "truncate": "true",
        "numPartitions": str(connections),
    }


def write_jdbc_replace(df: DataFrame, target: JdbcTarget, table: str, connections: int = 16) -> None:
    """Replace the rows of a table."""
    df.write.format("jdbc").options(**jdbc_options(target, table, connections)).mode("overwrite").save()


def write_jdbc_append(df: DataFrame, target: JdbcTarget, table: str, connections: int = 16) -> None:
    df.write.format("jdbc").options(**jdbc_options(target, table, connections)).mode("append").save()


def promote_statements(target: JdbcTarget, final: str, staging: str) -> list[str]:
    """Replace the final table's rows with the staged ones, columns named in order."""
    columns = ", ".join(CLEAN_COLUMNS)
    return [
        f"TRUNCATE TABLE {target.table(final)}",
        f"INSERT INTO {target.table(final)} ({columns}) SELECT {columns} FROM {target.table(staging)}",
    ]


def promote_in_warehouse(spark: SparkSession, target: JdbcTarget, final: str, staging: str) -> None:
    """Run the promotion as one transaction inside the database; the rows never pass through Spark."""
    # loads the driver, which may come from --jars, and makes it known to the driver manager
    spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(target.driver)
    connection = spark._jvm.java.sql.DriverManager.getConnection(target.url, target.user, target.password)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for sql in promote_statements(target, final, staging):
                statement.execute(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()
