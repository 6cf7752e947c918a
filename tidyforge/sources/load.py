"""Reading one table from a path or from SQL text."""

from __future__ import annotations

import json
import logging
import posixpath
import re
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import quoted, ref, replace_columns
from tidyforge.functions.nulls import NA_TOKENS, nan_to_null, token_as_null
from tidyforge.functions.numbers import NUMBER
from tidyforge.operators.stats import counts
from tidyforge.sources.decode import DECODERS, decode_files
from tidyforge.session import WorkTables, materialize, shared_path
from tidyforge.sources.html import extract_html_tables
from tidyforge.sources.records import (PLACE, Rule, cut_records, json_array_rule,
                                       json_columns_rule, place_text)

log = logging.getLogger(__name__)

SOURCE_ORDER = "__source_order"
# Spellings a CSV reader of the pandas family takes as booleans.
TRUE_WORDS = ["True", "TRUE", "true"]
FALSE_WORDS = ["False", "FALSE", "false"]
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def is_sql(source: str) -> bool:
    return source.strip().lower().startswith(("select ", "with "))


def extension_of(path: str) -> str:
    return posixpath.splitext(path.rstrip("/"))[1].lower()


def infer_types(df: DataFrame, na_tokens: list[str], found: dict | None = None) -> DataFrame:
    """Types for all-text columns: whole number, number, boolean, else text.

    One aggregate counts, per column, the cells each type can take, unless ``found`` has them.
    """
    columns = [c for c in df.columns if c != SOURCE_ORDER]
    cells = {c: token_as_null(ref(c), na_tokens) for c in columns}
    row = found if found and "all_0" in found else counts(df, _fits(list(cells.values()))).first()
    typed = {}
    for i, c in enumerate(columns):
        filled = row[f"all_{i}"]
        found_type = next((t for t in ("bigint", "double", "boolean")
                           if filled and row[f"{t}_{i}"] == filled), "string")
        if not filled:
            found_type = "double"
        cell = cells[c]
        typed[c] = cell if found_type == "string" else F.trim(cell).try_cast(found_type)
    return replace_columns(df, typed)


# Settings that the splitting of quoted line breaks does not know; Spark's reader takes each
# file whole then.
UNSPLIT = {"encoding", "charset", "linesep", "comment"}
BAD_RECORD = "__bad_record"


def read_csv(spark: SparkSession, path, schema: str | None = None, na_tokens: list[str] | None = None,
             infer: bool = True, multi_line: bool | None = None, source_order: bool = False,
             **options) -> DataFrame:
    """CSV with header and doubled quotes.  Without a schema types are inferred.

    ``multi_line`` says that records may hold line breaks inside quotes.  By default the scan
    that infers types or checks the schema finds out, taking each line for a record: only if no
    line leaves quotes open is that so.  Else the quotes of each split are counted and records
    cut by :func:`~tidyforge.sources.records.cut_records`, so such a file is read by many tasks
    too.  A record with too many or too few fields is an error, and so is a cell that a given
    schema cannot take; both are found when the table is loaded, unless ``infer`` is off.
    """
    tokens = NA_TOKENS if na_tokens is None else na_tokens
    settings = {"header": True, "escape": '"', "enforceSchema": False, "mode": "FAILFAST", **options}
    splittable = not UNSPLIT & {o.lower() for o in options}
    wanted = None if schema is None else spark.createDataFrame([], schema).schema
    named = _has_header(settings)
    if multi_line and not splittable:
        with _malformed(path):
            raw = spark.read.options(**settings, multiLine=True).csv(path)
            return _ordered(_typed(raw, wanted, tokens, infer, None, named), source_order)
    found = None
    if not multi_line:
        lines = spark.read.options(**settings).csv(path)
        if splittable:
            found = _first_look(spark, path, lines.columns, settings, wanted, tokens)
        elif multi_line is None and has_open_quotes(spark, path, settings.get("quote", '"')):
            return read_csv(spark, path, schema, na_tokens, infer, True, source_order, **options)
        if found is None or not found["open"]:
            if found and found["bad"] and infer:
                raise ValueError(f"a record of {path} does not have as many fields as the header")
            with _malformed(path):
                return _ordered(_typed(lines, wanted, tokens, infer, found, named), source_order)
    raw = csv_records(spark, path, settings)
    with _malformed(path):
        raw = materialize(raw, "csv")
    typed = _typed(raw, wanted, tokens, infer, None, named)
    return typed if source_order else typed.drop(SOURCE_ORDER)


def _has_header(settings: dict) -> bool:
    return str(settings["header"]).lower() == "true"


def _ordered(df: DataFrame, source_order: bool) -> DataFrame:
    return with_source_order(df, ".csv") if source_order else df


def has_open_quotes(spark: SparkSession, path, quote: str = '"') -> bool:
    """Whether any line has an odd number of quotes, so that a record goes on after it."""
    return not spark.read.text(path).where(_quotes(F.col("value"), quote, None) % 2 == 1).select(
        F.lit(1)).isEmpty()


def _quotes(line: Column, quote: str, escape: str | None) -> Column:
    if escape and escape != quote:
        line = F.regexp_replace(line, f"(?s)\\{escape}.", "")
    return F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))


def _first_look(spark: SparkSession, path, columns: list[str], settings: dict,
                wanted: T.StructType | None, tokens: list[str]) -> dict | None:
    """One scan of the lines: how many leave quotes open or lack fields, and what cells fit.

    Lines like the header's are left out of the fits.  If there are not as many of them as
    files, some may be records and the fits are not told; the table is looked at once more.
    """
    names = [f"c{i}" for i in range(len(columns))]
    if not names:
        return None
    fields = ", ".join(f"{n} string" for n in [*names, BAD_RECORD])
    given = {k: str(v) for k, v in settings.items() if k not in ("mode", "enforceSchema")}
    record = F.from_csv("value", fields, {
        **given, "header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD})
    lines = spark.read.text(path).where(F.trim("value") != "")
    odd = _quotes(F.col("value"), settings.get("quote", '"'), settings["escape"]) % 2 == 1
    parsed = lines.select(record.alias("r"), odd.alias("__odd"), F.col("_metadata.file_path")
                          .alias("__file")).select("r.*", "__odd", "__file")
    has_header = _has_header(settings)
    is_header = F.lit(has_header)
    for n, c in zip(names, columns):
        is_header = is_header & (F.coalesce(F.col(n), F.lit("")) == c)
    cells = [token_as_null(F.col(n), tokens) for n in names]
    tests = {"open": F.col("__odd"), "bad": F.col(BAD_RECORD).isNotNull(), "headers": is_header}
    if wanted is None:
        own = _fits(cells)
    else:
        own = _losses(cells, wanted) if len(wanted) == len(names) else {}
    row = counts(parsed, tests | {n: ~is_header & test for n, test in own.items()}).first().asDict()
    if has_header and row["headers"] != len(lines.inputFiles()):
        return {"open": row["open"], "bad": row["bad"]}
    return row


def _losses(cells: list[Column], wanted: T.StructType) -> dict[str, Column]:
    """For each cell whether its type in the schema cannot take it."""
    return {f"lost_{i}": cell.isNotNull() & cell.try_cast(f.dataType).isNull()
            for i, (f, cell) in enumerate(zip(wanted, cells))}


def _fits(cells: list[Column]) -> dict[str, Column]:
    """For each cell whether it is there and which types can take it."""
    tests = {}
    for i, cell in enumerate(cells):
        text = F.trim(cell)
        tests[f"all_{i}"] = cell.isNotNull()
        tests[f"bigint_{i}"] = text.rlike(WHOLE_NUMBER) & text.try_cast("bigint").isNotNull()
        tests[f"double_{i}"] = text.rlike(NUMBER)
        tests[f"boolean_{i}"] = cell.isin(TRUE_WORDS + FALSE_WORDS)
    return tests


def _typed(raw: DataFrame, wanted: T.StructType | None, tokens: list[str], infer: bool,
           found: dict | None = None, named: bool = True) -> DataFrame:
    """Text columns as their types, those of ``wanted`` if the columns, when they are ``named``
    by a header, are the same; ``found`` has the counts of a scan that was made before."""
    data = [c for c in raw.columns if c != SOURCE_ORDER]
    if wanted is None:
        cells = {c: token_as_null(ref(c), tokens) for c in data}
        return infer_types(raw, tokens, found) if infer else replace_columns(raw, cells)
    if len(data) != len(wanted) or named and [c.lower() for c in data] != [
            f.name.lower() for f in wanted]:
        raise ValueError(f"the header {data} does not have the schema's columns {wanted.names}")
    # Tokens are mapped on text, then cast, because the reader knows only one token.
    cells = [token_as_null(ref(c), tokens) for c in data]
    if found is None or "lost_0" not in found:
        found = counts(raw, _losses(cells, wanted)).first()
    lost = {f.name: found[f"lost_{i}"] for i, f in enumerate(wanted) if found[f"lost_{i}"]}
    if lost:
        raise ValueError(f"cells that the schema cannot take, by column: {lost}")
    order = [ref(SOURCE_ORDER)] if SOURCE_ORDER in raw.columns else []
    return raw.select(*[cell.try_cast(f.dataType).alias(f.name)
                        for f, cell in zip(wanted, cells)], *order)


def csv_records(spark: SparkSession, path, settings: dict) -> DataFrame:
    """Records with line breaks inside quotes as text columns, with their source order."""
    quote, escape = settings.get("quote", '"'), settings["escape"]
    records, ends = cut_records(spark, path, Rule(
        "\n", quote=quote, escape=None if escape == quote else escape))
    left_open = ends.where("state = 1").select("file").head()
    if left_open:
        raise ValueError(f"quotes are left open at the end of {left_open['file']}")
    records = records.withColumn("text", F.regexp_replace("text", r"\r\z", "")).where(
        F.trim("text") != "")
    place = F.struct(*PLACE[1:])
    heads = materialize(records.groupBy("file").agg(
        F.min_by("text", place).alias("head"), F.min(place).alias("first")), "heads")
    texts = [r["head"] for r in heads.select("head").distinct().limit(2).collect()]
    order = F.struct("file", *PLACE[1:]).alias(SOURCE_ORDER)
    if not texts:
        return records.select(order)
    names = _header(spark, texts[0], settings)
    if _has_header(settings):
        for other in texts[1:]:
            if _header(spark, other, settings) != names:
                raise ValueError(f"the files of {path} have different headers: {texts}")
        # by whole places, as a file's records would meet in one task by the file alone
        records = records.join(heads.select("file", "first.*"), PLACE, "left_anti")
    given = {k: str(v) for k, v in settings.items() if k != "enforceSchema"}
    row = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(names))),
                     {**given, "header": "false", "multiLine": "true"})
    return records.select(row.alias("r"), order).select(
        *[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], SOURCE_ORDER)


def _header(spark: SparkSession, record: str, settings: dict) -> list[str]:
    """Names that Spark's reader gives to the columns of a first record."""
    path = shared_path(spark, "header")
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.text(path)
    return spark.read.options(**{**settings, "multiLine": True}).csv(path).columns


@contextmanager
def _malformed(path):
    """Name the file set when a record does not have the fields of the header."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if "MALFORMED" not in str(error):
            raise
        raise ValueError(f"a record of {path} does not have as many fields as the header") from error


HEAD = 1000                  # closing braces of a file's head that tell how it is laid out
JSON_KINDS = ("lines", "records", "columns", "object")


def json_kind(spark: SparkSession, path) -> str:
    """How a JSON file is laid out, by its head; no more of it is read.

    ``lines``: a record per line.  ``records``: an array of records.  ``columns``: one object
    that holds an object of cells, by row label, for every column.  ``object``: one record.  A
    head with neither is a ``lines`` file without rows.
    """
    head = spark.read.option("lineSep", "}").text(path).where(
        "_metadata.file_block_start = 0").select("value", F.col("_metadata.file_path").alias("file"))
    parts = head.limit(HEAD).collect()
    parts = [r["value"] for r in parts if r["file"] == parts[0]["file"]]
    text = "}".join(parts).lstrip()
    if text.startswith("["):
        return "records"
    if not text.startswith("{"):
        return "lines"
    for whole in (text, text + "}"):
        try:
            first, end = json.JSONDecoder().raw_decode(whole)
        except ValueError:
            continue
        if whole[end:].strip(" \t\r\n,}"):
            return "lines"
        if first and all(isinstance(v, dict) for v in first.values()):
            return "columns"
        return "object" if "\n" in whole[:end] else "lines"
    return "columns" if re.match(r'\{\s*"(?:[^"\\]|\\.)*"\s*:\s*\{', text) else "object"


def read_json(spark: SparkSession, path, lines: bool | None = None, schema: str | None = None,
              orient: str | None = None, source_order: bool = False, **options) -> DataFrame:
    """JSON: one record per line, an array of records, or an object of columns.

    Which of them is told by the head of the first file, or by ``orient`` (``lines``,
    ``records``, ``columns``, ``object``); files of different kinds together are an error, and so
    are ``lines`` that do not fit and records that are no JSON.  Arrays and objects of columns are
    written as lines once, by many tasks however large a file is.  The cells of an object of
    columns become rows by their labels, in the order of their first appearance; a missing cell
    is NULL, the labels are left out, as are columns without any cell.
    """
    kind = orient or json_kind(spark, path)
    if kind not in JSON_KINDS:
        raise ValueError(f"unknown orientation {kind!r}, not one of {JSON_KINDS}")
    if lines is not None and lines != (kind == "lines"):
        raise ValueError(f"{path} {'has' if kind == 'lines' else 'does not have'} one record per line")
    reader = spark.read.options(**{"multiLine": kind == "object", "mode": "FAILFAST", **options})
    if kind in ("lines", "object"):
        try:
            df = (reader.schema(schema) if schema else reader).json(path)
            if schema is None and kind == "lines" and any(c.startswith("[") for c in df.columns):
                raise ValueError(f"{path} does not hold records")
        except Py4JJavaError as error:
            raise ValueError(f"{path} holds what is no record of one line") from error
        except PySparkException as error:
            if "MALFORMED" not in str(error) and "FAILFAST" not in str(error):
                raise
            raise ValueError(f"{path} holds what is no record of one line") from error
        return with_source_order(df, ".json") if source_order else df
    folder = shared_path(spark, "lines")
    for tables in WorkTables._open:
        tables.paths.append(folder)
    (json_records if kind == "records" else json_cells)(spark, path).write.text(folder)
    if schema:
        wanted = spark.createDataFrame([], schema).schema.add(SOURCE_ORDER, "string")
        df = reader.schema(wanted).json(folder)
    else:
        df = reader.json(folder)
    return df if source_order or SOURCE_ORDER not in df.columns else df.drop(SOURCE_ORDER)


def _json_line(place: Column, members: Column) -> Column:
    """A JSON object of ``members`` (text) that begins with its place."""
    head = F.to_json(F.struct(place.alias(SOURCE_ORDER)))
    return F.concat(F.substring(head, 1, F.length(head) - 1),
                    F.when(members != "", F.concat(F.lit(","), members)).otherwise(""), F.lit("}"))


def json_records(spark: SparkSession, path) -> DataFrame:
    """Elements of arrays of records, one line each, with their place."""
    records, ends = cut_records(spark, path, json_array_rule())
    # the rest of a file, its closing bracket, counts as one more closing brace
    wrong = ends.where("state <> 0 or depth <> -1").select("file").head()
    text = F.regexp_replace(F.regexp_replace("text", r"[\r\n]", " "), r"^\s*[\[,]?\s*", "")
    records = records.withColumn("text", text).where(~F.col("text").rlike(r"^\]?\s*\z"))
    if wrong or not records.where(~F.col("text").startswith("{")).isEmpty():
        raise ValueError(f"{path} holds what is no array of records"
                         + (f": {wrong['file']}" if wrong else ""))
    return records.select(_json_line(place_text(), F.trim(F.substring(
        "text", 2, 2147483647))).alias("value"))


def json_cells(spark: SparkSession, path) -> DataFrame:
    """Rows of objects of columns, one line each, with the place of their first cell."""
    records, ends = cut_records(spark, path, json_columns_rule())
    wrong = ends.where("state <> 0 or depth <> 0").select("file").head()
    if wrong:
        raise ValueError(f"{wrong['file']} is no object of columns")
    name = r'"((?:[^"\\]|\\.)*+)"\s*:\s*'
    text = F.regexp_replace("text", r"[\r\n]", " ")
    first = F.regexp_replace(text, r"^\s*(\{\s*)?", "")
    opens = F.col("depth") < 2
    column = F.when(opens, F.regexp_extract(first, "^" + name + r"\{", 1))
    cell = F.when(opens, F.regexp_replace(first, "^" + name + r"\{\s*", "")).otherwise(F.ltrim(text))
    for closed in (1, 0):                # one brace more than the cell's own, then another
        cell = F.when(F.col("depth_after") <= closed, F.regexp_replace(
            cell, r"\s*\}\s*\z", "")).otherwise(cell)
    cells = records.select(*PLACE, "depth", column.alias("column"), cell.alias("cell"))
    if not cells.where((F.col("depth") < 2) & (F.col("column") == "") & (
            ~F.col("cell").rlike(r"^\s*\z"))).isEmpty():
        raise ValueError(f"{path} holds what is no object of columns")

    # A column's name stands before its first cell, which may be in an earlier chunk.
    chunk = ["file", "block", "chunk"]
    last = cells.groupBy(*chunk).agg(F.max(F.when(F.col("column").isNotNull(), F.struct(
        "n", "column"))).alias("last"))
    earlier = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    last = last.withColumn("before", F.last("last.column", ignorenulls=True).over(earlier))
    within = Window.partitionBy(*chunk).orderBy("n")
    cells = cells.withColumn("own", F.last("column", ignorenulls=True).over(within)).join(
        last.select(*chunk, "before"), chunk).where(~F.col("cell").rlike(r"^\s*\z"))
    rows = cells.select(
        *PLACE, F.coalesce("own", "before").alias("column"),
        F.regexp_extract("cell", "^" + name, 1).alias("label"),
        F.regexp_replace("cell", "^" + name, "").alias("value"))
    rows = rows.groupBy("file", "label").agg(
        F.min(F.struct(*PLACE)).alias("first"),
        F.sort_array(F.collect_list(F.struct("block", "chunk", "n", "column", "value"))).alias("cells"))
    members = F.array_join(F.transform("cells", lambda c: F.concat(
        F.lit('"'), c["column"], F.lit('":'), c["value"])), ",")
    return rows.select("first.*", members.alias("members")).select(
        _json_line(place_text(), F.col("members")).alias("value"))


def read_parquet(spark: SparkSession, path, schema: str | None = None, **options) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_html(spark: SparkSession, path, **options) -> DataFrame:
    """Rows of every table of HTML files, ``(page, table_no, row_no, cells)``; page is the path."""
    pages = spark.read.options(wholetext=True, **options).text(path)
    pages = pages.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return extract_html_tables(pages, "path", "html")


READERS = {".csv": read_csv, ".json": read_json, ".parquet": read_parquet, ".html": read_html}
# Row positions can be told for these; decoded and parsed pages have none beyond the task's.
ORDERED = (".csv", ".json")


def read_sql(spark: SparkSession, query: str, url: str | None = None,
             views: dict[str, DataFrame | str] | None = None, **options) -> DataFrame:
    """Run a query on registered views, or in a database when a JDBC URL is given.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` (with
    ``dbtable``-style queries) to read a large result in parallel.
    """
    if url is not None:
        return jdbc_reader(spark, query, url, **options).load()
    for name, table in (views or {}).items():
        frame = load(spark, table) if isinstance(table, str) else table
        frame.createOrReplaceTempView(name)
    return spark.sql(query)


def jdbc_reader(spark: SparkSession, query: str, url: str, **options):
    """Reader set up for a database query; split by a column if bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if "partitionColumn" in options:
        return reader.option("dbtable", f"({query}) q")
    return reader.option("query", query)


def load(spark: SparkSession, source: str, format: str | None = None, source_order: bool = False,
         **options) -> DataFrame:
    """Read SQL text (``select ...``/``with ...``) or a file by its extension.

    NaN becomes NULL.  With ``source_order`` a column is added that sorts rows as they
    stand in the files.
    """
    if is_sql(source):
        return nan_to_null(read_sql(spark, source, **options))
    kind = extension_of(source) if format is None else "." + format.lstrip(".").lower()
    if kind not in READERS and kind not in DECODERS:
        raise ValueError(f"unsupported file format: {kind!r}")
    if posixpath.basename(source.rstrip("/")).startswith(("_", ".")):
        raise ValueError(f"Spark does not read files whose name starts with _ or a dot: {source}")
    try:
        if kind in DECODERS:
            df = decode_files(spark, source, kind, **options)
        else:
            own_order = {"source_order": True} if source_order and kind in ORDERED else {}
            df = READERS[kind](spark, source, **own_order, **options)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no such file: {source}") from error
        raise
    df = nan_to_null(df)
    if not source_order or SOURCE_ORDER in df.columns:
        return df
    return with_source_order(df, kind)


def with_source_order(df: DataFrame, kind: str) -> DataFrame:
    """Add the position of each row in its source, as a sortable column.

    Must be applied before any shuffle.  Rows of one file block are read by one task
    in order, so their running number orders them within the block.
    """
    running = F.monotonically_increasing_id()
    if kind == ".parquet":
        order = F.struct("_metadata.file_path", F.col("_metadata.row_index"))
    elif kind in ORDERED:
        order = F.struct("_metadata.file_path", F.col("_metadata.file_block_start"), running)
    else:
        order = F.struct(running)
    return df.withColumn(SOURCE_ORDER, order)


def load_data(spark: SparkSession, primary_file: str, loader=load, **options) -> DataFrame:
    """Load stage: read the primary table."""
    df = loader(spark, primary_file, **options)
    log.info("loading %s with %d columns", primary_file, len(df.columns))
    return df
