"""Publishing of marts to a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(
    df: DataFrame, url: str, table: str, batch: int = 1000, properties: dict[str, str] | None = None
) -> int:
    """Replace ``table`` with the rows of ``df``; returns their number.

    An empty frame publishes nothing and leaves the table as it is.
    """
    rows = df.count()
    if rows:
        options = {"batchsize": str(batch), **(properties or {})}
        df.write.options(**options).jdbc(url, table, mode="overwrite")
    return rows
