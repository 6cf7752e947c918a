"""One-hot encoding."""

from __future__ import annotations

from collections import Counter

from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import missing_free, present, ref
from tidyforge.functions.text import as_text
from tidyforge.operators.ranks import numbered
from tidyforge.operators.saved import Saved
from tidyforge.operators.stats import categories, in_merge_groups, value_counts
from tidyforge.session import materialize

ENCODINGS = ("columns", "sparse", "vector")


def encodable(df: DataFrame, exclude_prefixes: tuple[str, ...] = (),
              exclude: list[str] = ()) -> list[str]:
    """Text columns whose name has none of the prefixes, in any case, and is not excluded."""
    prefixes = tuple(p.upper() for p in exclude_prefixes)
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)
            and not (prefixes and f.name.upper().startswith(prefixes))]


class OneHotEncoder(Saved, Estimator):
    """Integer column ``<c>_<value>`` per sorted category; missing gives zeros.

    The categories of all columns are learned in shared passes; each becomes an output
    column.  ``max_categories`` refuses columns with more.  For columns of free text use
    :class:`SparseOneHotEncoder`.  Names that would differ only in case get the number of the
    category in its column as an ending, unless the session tells case apart.
    """

    STATE = ("columns", "drop_first", "max_categories")

    def __init__(self, columns: list[str], drop_first: bool = True,
                 max_categories: int | None = None):
        super().__init__()
        self.columns = list(columns)
        self.drop_first = drop_first
        self.max_categories = max_categories

    def _fit(self, dataset: DataFrame) -> "OneHotModel":
        found = categories(dataset, present(dataset, self.columns), self.max_categories)
        return OneHotModel(found, self.drop_first)


class OneHotModel(Saved, Model):
    """Fitted categories.  Values unseen in the fit give zeros."""

    def _state(self) -> dict:
        return {"found": self.categories, "drop_first": self.drop_first}

    def __init__(self, found: dict[str, dict[object, int]], drop_first: bool):
        super().__init__()
        self.categories = found
        self.drop_first = drop_first

    def dummies(self) -> list[tuple[str, object, str, int]]:
        """(source column, value, output name, rows with the value) per output column."""
        out = []
        for c, values in self.categories.items():
            for value in list(values)[1 if self.drop_first else 0:]:
                out.append((c, value, f"{c}_{value}", values[value]))
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in dataset.columns if c not in self.categories]
        new = [d for d in self.dummies() if d[0] in dataset.columns]
        strict = dataset.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
        names = Counter(n if strict else n.lower() for n in [*kept, *(d[2] for d in new)])
        place = {(c, value): i for c, values in self.categories.items()
                 for i, value in enumerate(values)}
        new = [(c, value, name if names[name if strict else name.lower()] == 1
                else f"{name}_{place[c, value]}", n) for c, value, name, n in new]
        return dataset.select(*[ref(c) for c in kept], *[
            F.when(ref(c) == F.lit(value), 1).otherwise(0).alias(name)
            for c, value, name, _ in new])


def encode_categorical(df: DataFrame, columns: list[str], drop_first: bool = True,
                       max_categories: int | None = None) -> DataFrame:
    """Learn and apply one-hot columns; absent columns are skipped."""
    columns = present(df, columns)
    if not columns:
        return df
    return OneHotEncoder(columns, drop_first, max_categories).fit(df).transform(df)


class SparseOneHotEncoder(Saved, Estimator):
    """The same encoding for any number of categories.

    Instead of one column per category, ``output`` lists the names of the dummies that
    are 1.  Only the smallest category per column has to be known, to drop it.
    """

    STATE = ("columns", "drop_first", "output")

    def __init__(self, columns: list[str], drop_first: bool = True,
                 output: str = "active_dummies"):
        super().__init__()
        self.columns = list(columns)
        self.drop_first = drop_first
        self.output = output

    def _fit(self, dataset: DataFrame) -> "SparseOneHotModel":
        columns = present(dataset, self.columns)
        dropped = dict.fromkeys(columns)
        if columns and self.drop_first:
            parts = [F.min(missing_free(dataset, c)).alias(f"m{i}") for i, c in enumerate(columns)]
            smallest = in_merge_groups(dataset, parts).agg(
                *[F.min(f"m{i}").alias(f"m{i}") for i in range(len(columns))]).first()
            dropped = {c: smallest[f"m{i}"] for i, c in enumerate(columns)}
        return SparseOneHotModel(dropped, self.output)


class SparseOneHotModel(Saved, Model):
    """The dropped category of each column, if any."""

    STATE = ("dropped", "output")

    def __init__(self, dropped: dict[str, object], output: str):
        super().__init__()
        self.dropped = dropped
        self.output = output

    def dummies(self) -> list:
        return []                            # no columns of their own

    def _transform(self, dataset: DataFrame) -> DataFrame:
        active = []
        for c in present(dataset, list(self.dropped)):
            cell, dropped = missing_free(dataset, c), self.dropped[c]
            name = F.concat(F.lit(f"{c}_"), as_text(cell, dataset.schema[c].dataType))
            active.append(name if dropped is None else F.when(cell != F.lit(dropped), name))
        kept = [ref(c) for c in dataset.columns if c not in self.dropped]
        listed = F.array_compact(F.array(*active)) if active else F.array().cast("array<string>")
        return dataset.select(*kept, listed.alias(self.output))


def one_hot_sparse(df: DataFrame, columns: list[str], drop_first: bool = True,
                   output: str = "active_dummies") -> DataFrame:
    """Learn and apply the sparse encoding; absent columns are skipped."""
    return SparseOneHotEncoder(columns, drop_first, output).fit(df).transform(df)


class VectorOneHotEncoder(Saved, Estimator):
    """One-hot of any number of categories as one sparse vector.

    The fit counts the values of each column, sorts them into ranges and numbers them by prefix
    sums; the result is a written table, the dictionary, with ``position``, ``column``,
    ``value`` and ``rows``.  The driver only learns how many positions there are.  Columns
    follow one another, a column's categories are sorted; the smallest one has no position if
    ``drop_first`` is set.  Missing values, and values unseen in the fit, have none either.  The
    transform joins the dictionary once for each column; Spark broadcasts it where it is small
    and splits frequent values where it is not.
    """

    STATE = ("columns", "drop_first", "output")

    def __init__(self, columns: list[str], drop_first: bool = True, output: str = "dummies"):
        super().__init__()
        self.columns = list(columns)
        self.drop_first = drop_first
        self.output = output

    def _fit(self, dataset: DataFrame) -> "VectorOneHotModel":
        columns = present(dataset, self.columns)
        spark = dataset.sparkSession
        counted = spark.createDataFrame([], "number int, value string, rows long")
        for frame in value_counts(dataset, columns):
            kind = frame.schema["value"].dataType
            number = F.array_position(F.lit(columns), F.col("column")).cast("int") - 1
            counted = counted.unionByName(frame.select(
                number.alias("number"), as_text(F.col("value"), kind).alias("value"), "rows"))
        ranked = numbered(counted, "number", "value")
        first = ranked.groupBy("number").agg(F.min("place").alias("first"))
        gone = F.col("number") + 1 if self.drop_first else F.lit(0)
        dictionary = ranked.join(F.broadcast(first), "number").where(
            F.col("place") > F.col("first") if self.drop_first else F.lit(True)).select(
            (F.col("place") - gone).cast("int").alias("position"),
            F.get(F.lit(columns), F.col("number")).alias("column") if columns
            else F.lit("").alias("column"), "value", "rows")
        dictionary = materialize(dictionary, "dictionary")
        return VectorOneHotModel(columns, self.output, dictionary.count(), dictionary)


class VectorOneHotModel(Saved, Model):
    """The positions of categories, as a table that is saved with the model."""

    STATE = ("columns", "output", "size")

    def __init__(self, columns: list[str], output: str, size: int,
                 dictionary: DataFrame | None = None):
        super().__init__()
        self.columns = columns
        self.output = output
        self.size = size
        self.dictionary = dictionary

    def _tables(self) -> dict[str, DataFrame]:
        return {"dictionary": self.dictionary}

    def dummies(self) -> list:
        return []                            # no columns of their own

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, places = present(dataset, self.columns), []
        out = dataset
        for i, c in enumerate(columns):
            own = self.dictionary.where(F.col("column") == c).select(
                F.col("value").alias(f"__value_{i}"), F.col("position").alias(f"__place_{i}"))
            # the null-safe form lets adaptive execution split a frequent or missing value
            cell = as_text(missing_free(dataset, c), dataset.schema[c].dataType)
            out = out.join(own, cell.eqNullSafe(F.col(f"__value_{i}")), "left")
            places.append(F.col(f"__place_{i}"))
        indices = F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")
        vector = F.struct(F.lit(0).alias("type"), F.lit(self.size).alias("size"),
                          indices.alias("indices"),
                          F.transform(indices, lambda _: F.lit(1.0)).alias("values"))
        # a vector type has no constructor for sparse values but its JSON
        kind = T.StructType([T.StructField("v", VectorUDT())])
        parsed = F.from_json(F.to_json(F.struct(vector.alias("v"))), kind)
        kept = [ref(c) for c in dataset.columns if c not in columns]
        return out.select(*kept, parsed["v"].alias(self.output))


def one_hot_vector(df: DataFrame, columns: list[str], drop_first: bool = True,
                   output: str = "dummies") -> DataFrame:
    """Learn and apply the vector encoding; absent columns are skipped."""
    return VectorOneHotEncoder(columns, drop_first, output).fit(df).transform(df)
