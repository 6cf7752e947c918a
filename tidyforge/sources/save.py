"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidyforge.session import shared_path

# The CSV writer would trim the ends of text.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
       "ignoreTrailingWhiteSpace": False}


def output_path(output_file: str, format: str = "csv") -> str:
    """The path that is written: ``.csv`` is appended to a CSV path that lacks it."""
    return output_file + ".csv" if format == "csv" and not output_file.endswith(".csv") else output_file


def save_output(df: DataFrame, output_file: str = "processed_output.csv", format: str = "csv",
                mode: str = "overwrite", single_file: bool = False, **options) -> DataFrame:
    """Write a table and return it.  ``.csv`` is appended to a CSV path that lacks it.

    The result is a folder of part files, written in parallel.  ``single_file`` makes it one
    CSV file: the parts are written in parallel all the same, without headers, and their bytes
    are put together in the order of the rows.  Of the modes it knows ``overwrite`` and
    ``error``.
    """
    path = output_path(output_file, format)
    if format == "csv":
        options = {**CSV, **options}
    if single_file:
        if format != "csv":
            raise ValueError("only CSV can be put together to a single file")
        _single_csv(df, path, mode, options)
    else:
        df.write.format(format).mode(mode).options(**options).save(path)
    return df


def saved(spark: SparkSession, output_file: str, format: str = "csv", **options) -> DataFrame:
    """The table as it was written; of CSV all columns are text."""
    path = output_path(output_file, format)
    if format == "csv":
        options = {**CSV, "multiLine": True, **options}
    return spark.read.format(format).options(**options).load(path)


def _single_csv(df: DataFrame, path: str, mode: str, options: dict) -> None:
    """Parts below a working folder, then one stream of bytes from them to the file.

    No row goes through a single task; what reads and writes the stream holds one buffer.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop
    settings = spark._jsc.hadoopConfiguration()
    target = hadoop.fs.Path(path)
    files = target.getFileSystem(settings)
    if files.exists(target):
        if mode != "overwrite":
            raise FileExistsError(path)
        files.delete(target, True)
    with_header = str(options.get("header", "true")).lower() == "true"
    parts, head = shared_path(spark, "parts"), shared_path(spark, "head")
    df.write.options(**{**options, "header": False}).csv(parts)
    # a table without rows writes its header alone
    df.limit(0).coalesce(1).write.options(**{**options, "header": with_header}).csv(head)
    out = files.create(target)
    try:
        for folder in (head, parts):
            root = hadoop.fs.Path(folder)
            source = root.getFileSystem(settings)
            names = sorted(s.getPath().toString() for s in source.listStatus(root)
                           if s.getPath().getName().startswith("part-"))
            for name in names:
                stream = source.open(hadoop.fs.Path(name))
                hadoop.io.IOUtils.copyBytes(stream, out, settings, False)
                stream.close()
            source.delete(root, True)
    finally:
        out.close()
