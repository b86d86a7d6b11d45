"""Keyed tables kept as numbered versions in a shared folder.

Version N is written by micro-batch N from the newest version below N, so a
repeated batch rebuilds the same table. Readers see only committed versions.
The tables hold one row per key (vehicle or cell); their size does not grow with
the number of points. A `VersionedTable` is written whole, a `BucketedTable` only
where the batch has keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PREFIX = "version="


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder, or anything that a glob pattern stands for, exists."""
    files, target = _filesystem(spark, path)
    found = files.globStatus(target)
    return found is not None and len(found) > 0


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The data files that a file, a folder or a glob pattern stands for, in order. For small tables."""
    files, target = _filesystem(spark, path)
    found = []
    for status in files.globStatus(target) or []:
        inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [s.getPath().toString() for s in inside if s.isFile() and s.getPath().getName()[0] not in "._"]
    return sorted(found)


def folders_like(spark: SparkSession, pattern: str) -> list[str]:
    """The folders and files that a glob pattern stands for, in order."""
    files, target = _filesystem(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(target) or [])


def sized_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """The files that a glob pattern stands for, with their sizes in bytes, in order."""
    files, target = _filesystem(spark, pattern)
    return sorted((s.getPath().toString(), s.getLen()) for s in files.globStatus(target) or [] if s.isFile())


def remove_folder(spark: SparkSession, path: str) -> None:
    files, target = _filesystem(spark, path)
    files.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which appears whole or not at all."""
    files, target = _filesystem(spark, path)
    folder, name = path.rsplit("/", 1)
    _, draft = _filesystem(spark, f"{folder}/_{name}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"could not write {path}")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folders(self) -> list[int]:
        """Numbers of all version folders, committed or not, oldest first: one listing."""
        files, target = _filesystem(self.spark, self.path)
        if not files.exists(target):
            return []
        names = [status.getPath().getName() for status in files.listStatus(target)]
        return sorted(int(n.removeprefix(_PREFIX)) for n in names if n.startswith(_PREFIX))

    def _committed(self, version: int) -> bool:
        return path_exists(self.spark, f"{self.path}/{_PREFIX}{version}/_SUCCESS")

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v in self._folders() if self._committed(v)]

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest version (below `before`, if given), or None if there is none yet."""
        for version in reversed(self._folders()):
            if (before is None or version < before) and self._committed(version):
                return self.spark.read.parquet(f"{self.path}/{_PREFIX}{version}")
        return None

    def write(self, table: DataFrame, version: int) -> None:
        table.write.mode("overwrite").parquet(f"{self.path}/{_PREFIX}{version}")

    def expire(self, keep: int) -> None:
        """Remove all but the newest `keep` committed versions, and what failed writes left between the removed."""
        folders = self._folders()
        kept, oldest = 0, None
        for version in reversed(folders):
            if kept == keep:
                break
            if self._committed(version):
                kept, oldest = kept + 1, version
        if kept < keep:
            return
        for version in folders:
            if oldest is not None and version >= oldest:
                continue
            remove_folder(self.spark, f"{self.path}/{_PREFIX}{version}")


class BucketedTable:
    """A keyed table in buckets by a hash of the key, of which a version holds only those its batch touched.

    A bucket's rows are those of the newest committed version that has the bucket, so a batch reads and writes the
    buckets of its keys and nothing else. All buckets of a version become visible at once, with its success marker.
    The number of buckets is part of the folder names and can't be changed later; choose it so that a bucket is worth a
    file (some 100 MB) and a usual batch has keys in few of them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets
        self._name = f"bucket_of_{buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _number(self, name: str) -> int:
        return int(name.removeprefix(_PREFIX))

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = folders_like(self.spark, f"{self.path}/{_PREFIX}*/_SUCCESS")
        return sorted(self._number(f.split("/")[-2]) for f in found)

    def _stored(self) -> list[tuple[int, int]]:
        """Version and bucket of all bucket folders, committed or not."""
        found = []
        for folder in folders_like(self.spark, f"{self.path}/{_PREFIX}*/bucket_of_*"):
            version, bucket = folder.split("/")[-2:]
            name, number = bucket.split("=")
            if name != self._name:
                raise ValueError(f"{self.path} has folders {name}, not {self._name}")
            found.append((self._number(version), int(number)))
        return sorted(found)

    def _current(self, before: int | None) -> dict[int, int]:
        """The version that counts of each bucket, among the committed ones (below `before`, if given)."""
        # Folders first: versions only become committed, so all folders of those listed later are known.
        stored = self._stored()
        committed = set(self.versions())
        return {b: v for v, b in stored if v in committed and (before is None or v < before)}

    def _read(self, current: dict[int, int]) -> DataFrame | None:
        if not current:
            return None
        folders = [f"{self.path}/{_PREFIX}{v}/{self._name}={b}" for b, v in sorted(current.items())]
        # Without a base path the folder names add no columns.
        return self.spark.read.parquet(*folders).filter(F.col(self.key).isNotNull())

    def read(self, before: int | None = None) -> DataFrame | None:
        """The table as of the newest version (below `before`, if given), or None if there is none yet."""
        return self._read(self._current(before))

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets that have a key of `changes`."""
        return sorted(r[0] for r in changes.select(self._bucket()).distinct().collect())

    def read_buckets(self, buckets: list[int], before: int | None = None) -> DataFrame | None:
        """As `read`, for some buckets; None if nothing was ever written to them."""
        current = self._current(before)
        return self._read({b: current[b] for b in buckets if b in current})

    def write(self, rows: DataFrame, buckets: list[int], version: int) -> None:
        """Make `rows` the whole content of `buckets`; all their keys must belong there, and none may be null."""
        # A row without a key keeps the place of a bucket that has become empty.
        places = self.spark.createDataFrame([(b,) for b in buckets], f"{self._name} int")
        placed = rows.withColumn(self._name, self._bucket()).unionByName(places, allowMissingColumns=True)
        (
            placed.hint("rebalance", self._name)
            .write.mode("overwrite")
            .partitionBy(self._name)
            .parquet(f"{self.path}/{_PREFIX}{version}")
        )

    def merge(self, changes: DataFrame, keep: str, version: int) -> None:
        """`merge_or_remove` on the buckets of `changes`, which are best cached, as a new version."""
        buckets = self.touched(changes)
        old = self.read_buckets(buckets, before=version)
        self.write(merge_or_remove(old, changes, self.key, keep), buckets, version)

    def expire(self, keep: int) -> None:
        """Remove the buckets that no reader of the newest `keep` versions needs, and versions left without any."""
        stored = self._stored()
        committed = self.versions()
        if len(committed) < keep:
            return
        oldest = committed[-keep]
        known = set(committed)
        needed = {(v, b) for b, v in {b: v for v, b in stored if v in known and v <= oldest}.items()}
        left = {v for v, _ in needed}
        for version, bucket in stored:
            if version < oldest and (version, bucket) not in needed and version in left:
                remove_folder(self.spark, f"{self.path}/{_PREFIX}{version}/{self._name}={bucket}")
        for version in {v for v, _ in stored} | known:
            if version < oldest and version not in left:
                remove_folder(self.spark, f"{self.path}/{_PREFIX}{version}")


def merge_or_remove(old: DataFrame | None, new: DataFrame, key: str, keep: str) -> DataFrame:
    """Replace the rows of `old` that `new` has a row for, and drop those where `keep` is false.

    `new` has one row per key, the columns of `old` and the flag `keep`. Cache
    it: Spark then knows its size, and while that is below the broadcast limit
    the stored table is filtered where it lies, without a shuffle.
    """
    columns = [c for c in new.columns if c != keep]
    kept = new.filter(F.col(keep)).select(*columns)
    if old is None:
        return kept
    untouched = old.join(new.select(key), key, "left_anti").select(*columns)
    return untouched.unionByName(kept)
