"""Small CSV tables: routes and stops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.schemas import ROUTE, STOP
from wayfold.sources.tables import files_below


def _trimmed(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def read_named(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Columns of CSV files as text, found by the name in the header.

    Order and further columns are free, and may differ from file to file; a file
    that lacks one of the names is an error. Each file is read by its own header;
    files without a byte are no files.
    """
    parts = [spark.read.csv(file, header=True) for file in files_below(spark, path)]
    parts = [part for part in parts if part.columns]
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in [*names, "ordinal"]))
    for part in parts:
        missing = [n for n in names if n not in part.columns]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {part.inputFiles()[0]}")
    place = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return reduce(DataFrame.unionByName, [part.select(*names, place.alias("ordinal")) for part in parts])


def clean_routes(lines: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One route per vehicle: text trimmed, blanks to null, rows without a vehicle dropped, last line wins."""
    return (
        lines.select(ordinal, *[_trimmed(c).alias(c) for c in ROUTE.fieldNames()])
        .filter(F.col("vehicle").isNotNull())
        .groupBy("vehicle")
        .agg(F.max_by(F.struct("route_id", "route_no"), ordinal).alias("r"))
        .select("vehicle", "r.route_id", "r.route_no")
    )


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """Routes from CSV with a header; no file means no routes.

    Lines are ordered by file name and by position in the file.
    """
    return clean_routes(read_named(spark, path, ROUTE.fieldNames()))


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """Stops from CSV with a header; a coordinate that is no number becomes null."""
    lines = read_named(spark, path, STOP.fieldNames())
    return lines.select(*[F.trim(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in STOP.fields])
