"""Waypoint archives: JSON records in, labelled points out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.functions.scoring import DWELLING
from wayfold.functions.time import utc_text
from wayfold.schemas import ANY_RECORD, WAYPOINT_COLUMNS, WRAPPER
from wayfold.sources.arrays import array_records
from wayfold.sources.tables import folders_like, path_exists, remove_folder, sized_files

# Plain readers of Spark pass over names with a leading underscore.
_COMPACTED = "_compacted"


def read_records(spark: SparkSession, path: str, multi_line: bool = True, split: bool = False) -> DataFrame:
    """Archived JSON with the declared schema.

    A multi-line file is an array and is read by one task; with `split` it is
    cut into records by many, as are archives of one record per line
    (`multi_line=False`) at any size. Read large arrays with `split`; a broken
    file then loses its broken records alone.
    """
    if multi_line and split:
        records = array_records(spark, path)
        return records.select(F.from_json("value", ANY_RECORD).alias("r")).select("r.*")
    return spark.read.schema(ANY_RECORD).option("multiLine", str(multi_line).lower()).json(path)


def unwrap(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Waypoints of wrapped and of flat records. Records with no vehicle, or a blank one, are skipped."""
    wrapped = F.col(WRAPPER).isNotNull()
    columns = [
        F.when(wrapped, F.col(f"{WRAPPER}.{c}")).otherwise(F.col(c)).alias(c) for c in WAYPOINT_COLUMNS
    ]
    return records.select(*keep, *columns).filter(F.col("vehicle") != "")


def read_waypoints(spark: SparkSession, path: str, multi_line: bool = True, split: bool = False) -> DataFrame:
    return unwrap(read_records(spark, path, multi_line, split))


def archived(labelled: DataFrame) -> DataFrame:
    """Points worth keeping: parked vehicles are left out."""
    return labelled.filter(F.col("congestion_status") != DWELLING)


def write_archive(labelled: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch to the archive, partitioned by day of the points, batch and status.

    A batch overwrites its own directories only, so a repeated batch leaves the
    same rows. Rows are gathered by directory first, which adaptive execution
    splits or merges to files of its advisory size. Read with `read_archive`.
    """
    directories = ["date", "batch_id", "congestion_status"]
    (
        archived(labelled)
        .withColumn("processed_at", F.current_timestamp())
        .withColumn("date", F.substring(utc_text(F.col("event_ts")), 1, 10))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .hint("rebalance", *directories)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*directories)
        .parquet(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive of all batches; filters on day, batch and status prune files.

    A day that was compacted is read from its newest compacted form, and from the batches that came after it.
    """
    return _view(spark, path, None)


def compact_archive(
    spark: SparkSession, path: str, closed_before: str, upto: int, file_bytes: int = 256 << 20
) -> list[str]:
    """Rewrite the batches 0 to `upto` of all days before `closed_before` (YYYY-MM-DD) as few files; returns those days.

    `upto` must be a batch known to be finished, such as the one before the batch under way. Rows of a day and status
    are dealt to as many files as their present size needs at `file_bytes` each, evenly whatever the vehicle. All
    days of a call are written by one job, and its success marker is the switch: readers see the batches before it
    and the compacted rows after it. A repeat of a compacted batch writes its own folders again, which are no longer
    read; rows of a later batch that belong to a compacted day are read beside it, until the next call takes them in.
    `clean_archive` removes what nobody reads any more.
    """
    target = f"{path}/{_COMPACTED}/upto={upto}~{closed_before}"
    if path_exists(spark, f"{target}/_SUCCESS"):
        return []
    done = _compacted_days(spark, path)
    sizes: dict[tuple[str, str], int] = {}
    open_days = set()
    for file, size in sized_files(spark, f"{path}/date=*/batch_id=*/congestion_status=*/*.parquet"):
        at = _keys(file)
        if at["date"] < closed_before and done.get(at["date"], (-1, ""))[0] < int(at["batch_id"]) <= upto:
            open_days.add(at["date"])
            key = (at["date"], at["congestion_status"])
            sizes[key] = sizes.get(key, 0) + size
    if not open_days:
        return []
    for file, size in sized_files(spark, f"{path}/{_COMPACTED}/upto=*/date=*/congestion_status=*/*.parquet"):
        at = _keys(file)
        if at["date"] in open_days and f"/{_run_name(done.get(at['date']))}/" in file:
            key = (at["date"], at["congestion_status"])
            sizes[key] = sizes.get(key, 0) + size
    # One row a folder, so it is as small as the listing above.
    planned, total = [], 0
    for (day, status), size in sorted(sizes.items()):
        n_files = max(1, -(-size // file_bytes))
        planned.append((day, status, total, n_files))
        total += n_files
    plan = spark.createDataFrame(planned, "date string, congestion_status string, first_file int, n_files int")
    rows = _view(spark, path, upto, sorted(open_days)).withColumn("date", F.col("date").cast("string"))
    # The time takes part in the deal, so that no vehicle is bound to one file.
    file = F.col("first_file") + F.pmod(F.xxhash64("vehicle", "event_ts"), "n_files")
    (
        rows.join(F.broadcast(plan), ["date", "congestion_status"])
        .withColumn("file", file.cast("int"))
        .repartitionById(total, "file")
        .sortWithinPartitions("date", "congestion_status", "vehicle", "event_ts")
        .drop("first_file", "n_files", "file")
        .write.mode("overwrite")
        .partitionBy("date", "congestion_status")
        .parquet(target)
    )
    return sorted(open_days)


def clean_archive(spark: SparkSession, path: str) -> int:
    """Remove batches and compacted forms that a newer compacted form replaces; returns the number of folders removed.

    Call it when no reader from before the last `compact_archive` is under way.
    """
    done = _compacted_days(spark, path)
    replaced = []
    for folder in folders_like(spark, f"{path}/date=*/batch_id=*"):
        at = _keys(folder)
        if int(at["batch_id"]) <= done.get(at["date"], (-1, ""))[0]:
            replaced.append(folder)
    for folder in folders_like(spark, f"{path}/{_COMPACTED}/upto=*/date=*"):
        newest = done.get(_keys(folder)["date"])
        run = _run(folder.split("/")[-2])
        # A run above the newest committed one may be under way.
        if newest is not None and run < newest:
            replaced.append(folder)
    for folder in replaced:
        remove_folder(spark, folder)
    return len(replaced)


def _keys(path: str) -> dict[str, str]:
    return dict(name.split("=", 1) for name in path.split("/") if "=" in name)


def _run(name: str) -> tuple[int, str]:
    """The last batch and the closing day of a compaction, from its folder's name."""
    upto, closed = name.removeprefix("upto=").split("~")
    return int(upto), closed


def _run_name(run: tuple[int, str] | None) -> str:
    return "" if run is None else f"upto={run[0]}~{run[1]}"


def _compacted_days(spark: SparkSession, path: str) -> dict[str, tuple[int, str]]:
    """The newest committed compaction of each day that has one. Its cost is two listings."""
    committed = {f.split("/")[-2] for f in folders_like(spark, f"{path}/{_COMPACTED}/upto=*/_SUCCESS")}
    days: dict[str, tuple[int, str]] = {}
    for folder in folders_like(spark, f"{path}/{_COMPACTED}/upto=*/date=*"):
        name = folder.split("/")[-2]
        if name in committed:
            day = _keys(folder)["date"]
            days[day] = max(days.get(day, (-1, "")), _run(name))
    return days


def _view(spark: SparkSession, path: str, upto: int | None, only: list[str] | None = None) -> DataFrame:
    """Each row once: compacted days from their newest form, the rest from batches, up to `upto` and of some days."""
    # In this order: a compaction that ends in between leaves its batches in place.
    done = _compacted_days(spark, path)
    if not done and upto is None:
        return spark.read.option("basePath", path).parquet(path)
    batches, compacted = [], []
    for folder in folders_like(spark, f"{path}/date=*/batch_id=*"):
        at = _keys(folder)
        number = int(at["batch_id"])
        wanted = (only is None or at["date"] in only) and (upto is None or number <= upto)
        if wanted and number > done.get(at["date"], (-1, ""))[0]:
            batches.append(folder)
    by_run: dict[tuple[int, str], list[str]] = {}
    for day, run in done.items():
        if only is None or day in only:
            by_run.setdefault(run, []).append(day)
    for run, days in sorted(by_run.items()):
        base = f"{path}/{_COMPACTED}/{_run_name(run)}"
        compacted.append(spark.read.option("basePath", base).parquet(*[f"{base}/date={d}" for d in sorted(days)]))
    parts = compacted
    if batches:
        parts = [spark.read.option("basePath", path).parquet(*batches), *compacted]
    columns = parts[0].columns
    # Types of folder names are inferred per read.
    parts = [p.withColumn("batch_id", F.col("batch_id").cast("long")).select(columns) for p in parts]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole
