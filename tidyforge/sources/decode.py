"""Binary statistics files decoded as one Spark job, one file per task at a time.

Spark lists the files and ships their bytes to tasks; a small decoder turns the bytes
of one file into record batches.  Nothing passes through the driver.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.feather as feather
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 50_000


def _feather(data: io.BytesIO, **options) -> Iterator[pa.Table]:
    yield feather.read_table(data, **options)


def _stata(data: io.BytesIO, **options) -> Iterator[pd.DataFrame]:
    with pd.read_stata(data, chunksize=CHUNK_ROWS, **options) as chunks:
        yield from chunks


def _sas(kind: str) -> Callable:
    def decode(data: io.BytesIO, **options) -> Iterator[pd.DataFrame]:
        with pd.read_sas(data, format=kind, chunksize=CHUNK_ROWS, **options) as chunks:
            yield from chunks

    return decode


def _excel(data: io.BytesIO, **options) -> Iterator[pd.DataFrame]:
    yield pd.read_excel(data, **options)      # needs openpyxl or xlrd on the executors


def _spss(data: io.BytesIO, **options) -> Iterator[pd.DataFrame]:
    import tempfile

    import pyreadstat                         # optional codec, reads from a path only

    with tempfile.NamedTemporaryFile(suffix=".sav") as copy:
        copy.write(data.read())
        copy.flush()
        for chunk, _ in pyreadstat.read_file_in_chunks(
                pyreadstat.read_sav, copy.name, chunksize=CHUNK_ROWS, **options):
            yield chunk


DECODERS: dict[str, Callable] = {
    ".feather": _feather, ".dta": _stata, ".sas7bdat": _sas("sas7bdat"), ".xpt": _sas("xport"),
    ".xlsx": _excel, ".xls": _excel, ".sav": _spss,
}


def _arrow(chunk) -> pa.Table:
    if isinstance(chunk, pa.Table):
        return chunk
    text = [c for c in chunk.columns if isinstance(chunk[c].dtype, pd.CategoricalDtype)]
    return pa.Table.from_pandas(chunk.astype({c: object for c in text}), preserve_index=False)


def _plain(schema: pa.Schema) -> pa.Schema:
    """Types Spark can hold: no dictionaries, no all-null columns."""
    fields = []
    for f in schema:
        kind = f.type.value_type if pa.types.is_dictionary(f.type) else f.type
        fields.append(pa.field(f.name, pa.string() if pa.types.is_null(kind) else kind))
    return pa.schema(fields)


def _decoder(kind: str | Callable) -> Callable:
    if callable(kind):
        return kind
    return DECODERS["." + kind.lstrip(".").lower()]


def decoded_schema(files: DataFrame, decoder: str | Callable, **options) -> T.StructType:
    """Schema of the first file by path, found in a task; only the schema comes back."""
    decode = _decoder(decoder)

    def sniff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                first = next(iter(decode(io.BytesIO(content.as_py()), **options)))
                schema = _plain(_arrow(first).schema)
                yield pa.RecordBatch.from_pydict({"schema": [schema.serialize().to_pybytes()]})

    first_path = files.agg(F.min("path").alias("path")).first()["path"]
    if first_path is None:
        raise FileNotFoundError("no file to decode")
    row = (files.where(F.col("path") == first_path).limit(1).select("content")
           .mapInArrow(sniff, "schema binary").first())
    arrow = pa.ipc.read_schema(pa.py_buffer(bytes(row["schema"])))
    return files.sparkSession.createDataFrame(arrow.empty_table()).schema


def decode_content(files: DataFrame, decoder: str | Callable,
                   schema: str | T.StructType | None = None, **options) -> DataFrame:
    """Rows of all files given as ``(path, content)``, which may be any DataFrame."""
    decode = _decoder(decoder)
    if schema is None:
        schema = decoded_schema(files, decoder, **options)
    target = files.sparkSession.createDataFrame([], schema).toArrow().schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for chunk in decode(io.BytesIO(content.as_py()), **options):
                    table = _arrow(chunk).select(target.names).cast(target)
                    yield from table.to_batches(max_chunksize=CHUNK_ROWS)

    return files.select("content").mapInArrow(rows, schema)


def decode_files(spark: SparkSession, path, decoder: str | Callable,
                 schema: str | T.StructType | None = None, **options) -> DataFrame:
    """Rows of all files a path or glob names.  Without a schema the first file gives it."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(path).select("path", "content"))
    return decode_content(files, decoder, schema, **options)
