"""Finding files through the Hadoop file systems that Spark knows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "path string, name string, length bigint, modificationTime timestamp"


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme, host and working folder, as listings show it."""
    files, target = _located(spark, path)
    return files.makeQualified(target).toString()


def find_files(spark: SparkSession, root: str, extension: str | None = None,
               name_pattern: str | None = None) -> DataFrame:
    """Files below ``root`` as ``(path, name, length, modificationTime)``.

    ``extension`` is a suffix and matches case; ``name_pattern`` is a regex searched in
    the file name without regard to case.  A folder of part files whose own name has the
    extension, as Spark writes it, counts as one file.  Names that Spark would not read,
    because they start with ``_`` or a dot, are listed too.  A missing root gives no rows.
    File contents are not read.
    """
    files, target = _located(spark, root)
    found: dict[str, tuple[int, int]] = {}
    if files.exists(target):
        above = len(files.makeQualified(target).toString().rstrip("/")) + 1
        listed = files.listFiles(target, True)
        while listed.hasNext():
            status = listed.next()
            path = status.getPath().toString()
            if extension:
                if not path.endswith(extension):
                    continue
                parts = path[above:].split("/")
                table = next(i for i, p in enumerate(parts) if p.endswith(extension))
                path = path[:above] + "/".join(parts[:table + 1])
            size, changed = found.get(path, (0, 0))
            found[path] = (size + status.getLen(), max(changed, status.getModificationTime()))
    rows = [(path, path.rsplit("/", 1)[-1], size, datetime.fromtimestamp(ms / 1000, timezone.utc))
            for path, (size, ms) in sorted(found.items())]
    listing = spark.createDataFrame(rows, LISTING)
    if name_pattern:
        listing = listing.where(F.col("name").rlike(f"(?i){name_pattern}"))
    return listing


def directory_crawler(spark: SparkSession, dir_path: str, file_extension: str,
                      name_pattern: str | None = None) -> list[str]:
    """Sorted paths of matching files; a list of names, not of data."""
    listing = find_files(spark, dir_path, file_extension, name_pattern)
    return sorted(r["path"] for r in listing.select("path").collect())


def auto_prepare_merges(spark: SparkSession, folder_path: str, extension: str,
                        on_keys: list[str], how: str = "left", name_pattern: str | None = None,
                        exclude: list[str] = ()) -> list[dict]:
    """Merge rules for every matching file of a folder; the files in ``exclude`` are left out."""
    without = {qualified(spark, e) for e in exclude}
    return [{"file": p, "on": list(on_keys), "how": how, "collapse_duplicates": True}
            for p in directory_crawler(spark, folder_path, extension, name_pattern)
            if p not in without]
