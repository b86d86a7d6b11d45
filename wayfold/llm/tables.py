"""Reading the given tables, and tables written between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.session import shared_folder

# A table of at most this many bytes may be sent to every executor.
BROADCAST_BYTES = 32 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, and survives the loss of executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(df: DataFrame, row_bytes: Column) -> int:
    """Size of a table from the size of each of its rows."""
    return df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).cast("long")).first()[0]


def join_back(rows: DataFrame, table: DataFrame, key: str, copies: str, total: int, share: int = 1024) -> DataFrame:
    """Inner join of `rows` with a table that has each key once and the number of rows that hold it.

    Keys that hold at least one in `share` of the rows, of which there are at most `share`, are joined by broadcast,
    so that no task of the shuffled rest gets a large group.
    """
    often = F.col(copies) * share >= total
    hot, cold = F.broadcast(table.filter(often)), table.filter(~often)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))
