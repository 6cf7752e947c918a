"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyforge.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
_BLANK = " \t\n\x0b\x0c\r"
_KEY_BITS = 60


def word_count(text: Column) -> Column:
    """Number of words; 0 for a missing text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK))
    return F.when(inner == "", F.lit(0)).otherwise(
        F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("long")


def _sized(docs: DataFrame, doc_id: str, source: str, text: str) -> dict[str, Column]:
    """Size and random key of a row; the key depends on the row alone, so reruns agree."""
    size = word_count(F.col(f"`{text}`"))
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    key = F.conv(F.substring(F.md5(F.concat(name, F.lit(":"), size.cast("string"))), 1, 15),
                 16, 10).cast("long")
    return {"doc_id": F.col(f"`{doc_id}`"), "source": F.col(f"`{source}`"), "size": size,
            "key": key}


def budgets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
            most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of each source, from (source, size) rows.

    Sources in code point order, a missing one last, take the weights in turn and share
    ``share`` times all sizes.  A target stops at ``most`` times its source's size; what is
    above is shared again by weight until none is.  In the order of cap over weight the capped
    sources come first, so one pass of running sums finds them.  This table has one row per
    source, whatever the number of documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (place % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn(
        "cap", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled = ranked.withColumns({
        "spent": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "heavier": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("source_size").over(whole) * F.lit(float(share))})
    full = F.col("cap") * F.col("heavier") <= (F.col("all") - F.col("spent")) * F.col("weight")
    level = F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("weight"))).over(whole)
    rest = F.col("all") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(whole)
    return filled.withColumn("full", full).withColumns(
        {"level": level, "rest": rest}).select(
        "source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(
            F.col("weight") * F.col("rest") / F.col("level")).alias("target"))


def _cuts(sizes: DataFrame, weights: tuple, share: float, most: int) -> DataFrame:
    """For each source its budget, whole epochs, and the place where the last epoch is cut.

    Rows of a source are dealt by ranges of their random key into buckets of similar size,
    sorted inside them, and summed up: bucket totals first, then rows within a bucket.  A
    source with a third of all rows has as many more buckets.
    """
    rows = sizes.count()
    buckets = max(1, int(rows / max(2000, rows ** 0.5)))
    width = -(-(1 << _KEY_BITS) // buckets)
    ranged = sizes.withColumn("bucket", F.expr(f"`key` div {width}"))
    target = budgets(sizes, weights, share, most).withColumn(
        "budget", F.floor(F.col("target") + 0.5).cast("long"))
    target = target.withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.expr("budget div source_size"))
        .otherwise(F.lit(0)).cast("long")}).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = ranged.groupBy("source", "bucket").agg(F.sum("size").alias("inside"))
    sums = sums.withColumn("before", F.coalesce(F.sum("inside").over(earlier), F.lit(0)))
    # the one bucket of each source that holds the cut; only its rows are sorted and summed
    held = sums.alias("s").join(target.alias("t"), F.col("s.source").eqNullSafe(
        F.col("t.source"))).where("before <= rest AND rest < before + inside").select(
        F.col("t.source"), "bucket", "before", "rest")
    within = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    near = ranged.alias("r").join(held.alias("h"), F.col("r.source").eqNullSafe(
        F.col("h.source")) & (F.col("r.bucket") == F.col("h.bucket"))).select(
        "r.source", "key", "doc_id", "size", (F.col("rest") - F.col("before")).alias("left"))
    tied = near.groupBy("source", "key", "doc_id", "size", "left").agg(
        F.count("*").alias("copies"))
    earlier = F.sum(F.col("size") * F.col("copies")).over(
        within.rowsBetween(Window.unboundedPreceding, -1))
    cut = tied.withColumn("room", F.col("left") - F.coalesce(earlier, F.lit(0))).where(
        "room >= 0 AND room < size * copies").select(
        F.col("source").alias("cut_source"), F.col("key").alias("cut_key"),
        F.col("doc_id").alias("cut_id"), F.col("size").alias("cut_size"),
        F.expr("room div copies").alias("part"))
    return target.join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & F.col(
        "cut_key").isNotNull(), "left").drop("cut_source").withColumnRenamed("source", "of")


def _taken() -> Column:
    """Words of a row that the mix takes, from its key and its source's cut."""
    row = F.struct("key", "doc_id", "size")
    cut = F.struct(F.col("cut_key"), F.col("cut_id"), F.col("cut_size"))
    last = (F.when(F.col("cut_key").isNull() | (row > cut), F.lit(0))
            .when(row < cut, F.col("size")).otherwise(F.col("part")))
    return (F.col("epochs") * F.col("size") + last).cast("long")


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
             text: str = "text", weights: tuple = WEIGHTS, share: float = SHARE,
             most: int = MOST) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every row.

    Sources are given targets by :func:`budgets`.  Whole epochs of a source come first; the
    rest of its target, rounded to a whole word, is taken from its rows in the order of random
    keys up to the row where the running sum of sizes reaches it, of which the first words are
    taken.  No row gives more than ``most`` times its size.  A missing text has size 0, a
    missing source is a source, a missing doc_id sorts first.  Rows with the same key, doc_id and
    size (a row that occurs twice) share alike, so that a source may fall short of its target
    by less than one word for each.  An empty table gives an empty plan.
    """
    sizes = materialize(docs.select(*[c.alias(n) for n, c in _sized(
        docs, doc_id, source, text).items()]), "sizes")
    cuts = materialize(_cuts(sizes, weights, share, most), "cuts")
    return sizes.join(cuts, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", _taken().alias("taken"))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
                  text: str = "text", weights: tuple = WEIGHTS, share: float = SHARE,
                  most: int = MOST) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``.

    A row is there once for each time its whole text is taken and once more, with its first
    words joined by one space, for a part; a row of which nothing is taken is left out.
    """
    sized = _sized(docs, doc_id, source, text)
    sizes = materialize(docs.select(*[c.alias(n) for n, c in sized.items()]), "sizes")
    cuts = materialize(_cuts(sizes, weights, share, most), "cuts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(n) for n, c in sized.items()])
    rows = rows.join(cuts, F.col("source").eqNullSafe(F.col("of"))).withColumn("taken", _taken())
    part = F.col("taken") - F.expr("taken div size") * F.col("size")
    takes = F.filter(F.concat(F.array_repeat("size", F.expr("int(taken div size)")),
                              F.array(part)), lambda n: n > 0)
    rows = rows.where("size > 0 AND taken > 0").withColumn("words", F.explode(takes))
    whole = F.col("row").getField(text)
    first = F.array_join(F.slice(F.split(F.btrim(whole, F.lit(_BLANK)), r"[\x20\x09-\x0D]+"),
                                 1, F.col("words").cast("int")), " ")
    return rows.select(*[
        F.when(F.col("words") < F.col("size"), first).otherwise(whole).alias(c) if c == text
        else F.col("row").getField(c).alias(c) for c in docs.columns])
