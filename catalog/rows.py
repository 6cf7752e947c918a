"""Duplicates, units, missing values."""

from pyspark.sql import functions as F

from catalog.registry import query
from tidyforge.operators.dedupe import deduplicate, sort_rows
from tidyforge.operators.impute import MissingValueImputer, impute_missing, missingness_report
from tidyforge.operators.ranks import number_tasks
from tidyforge.operators.stats import modes
from tidyforge.operators.units import normalize_units, unconverted_units

EVENTS = ("event_id, user_id, event_type, value, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts")


def events(t):
    return t.events.selectExpr("event_id", "user_id", "event_type", "value",
                               "CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts")


def ranked(order):
    return f"""
WITH e AS (SELECT {EVENTS} FROM events)
SELECT event_id, user_id, event_type, value, ts FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY {order}) AS r FROM e) WHERE r = 1"""


@query(ranked("ts ASC NULLS LAST, event_id ASC NULLS LAST"))
def dedupe_first(t):
    return deduplicate(events(t), ["user_id", "event_type"], "first", ["ts", "event_id"])


@query(ranked("ts DESC NULLS FIRST, event_id DESC NULLS FIRST"))
def dedupe_last(t):
    """The latest event per user and type; a missing time sorts last and so is kept."""
    return deduplicate(events(t), ["user_id", "event_type"], "last", ["ts", "event_id"])


@query(ranked("ts DESC NULLS LAST, event_id DESC NULLS LAST"))
def dedupe_first_descending(t):
    return deduplicate(events(t), ["user_id", "event_type"], "first", ["ts", "event_id"], False)


@query("""
WITH l AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_suppkey END AS suppkey, l_shipdate, l_orderkey, l_partkey,
    l_linenumber FROM lineitem)
SELECT suppkey, l_shipdate, l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (
    PARTITION BY suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_linenumber DESC) AS r FROM l)
WHERE r = 1""")
def dedupe_hot_group(t):
    """One group holds a third of all rows."""
    lines = t.lineitem.selectExpr("CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_suppkey END AS suppkey",
                                  "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber")
    return deduplicate(lines, ["suppkey"], "last", ["l_shipdate"])


@query("""
SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_shipdate) AS l_shipdate FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1""")
def dedupe_none(t):
    return deduplicate(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"),
                       ["l_orderkey", "l_linenumber"], keep=False)


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedupe_all(t):
    return deduplicate(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


UNIT = """CASE event_id % 6 WHEN 0 THEN 'mg/dL' WHEN 1 THEN ' mmol/L ' WHEN 2 THEN 'umol/L' WHEN 3 THEN 'cells'
    WHEN 4 THEN ' mg/dL' ELSE NULL END"""
RULES = [{"value_col": "value", "unit_col": "unit", "canonical": "mg/dL",
          "conversions": {"mmol/L": 6.945, "umol/L": 0.006945}},
         {"value_col": "not_there", "unit_col": "unit", "canonical": "x"}]


def measured(t):
    return t.events.selectExpr("event_id", "value", f"{UNIT} AS unit")


@query(f"""
WITH e AS (SELECT event_id, value, {UNIT} AS unit FROM events)
SELECT event_id, CASE trim(unit) WHEN 'mmol/L' THEN value * 6.945::DOUBLE WHEN 'umol/L' THEN value * 0.006945::DOUBLE
    ELSE value END AS value,
    CASE WHEN trim(unit) IN ('mg/dL', 'mmol/L', 'umol/L') THEN 'mg/dL' ELSE unit END AS unit FROM e""")
def unit_normalise(t):
    return normalize_units(measured(t), RULES)


@query(f"""
SELECT 'value' AS value_col, trim(unit) AS unit, count(*) AS rows FROM (SELECT {UNIT} AS unit FROM events)
WHERE trim(unit) NOT IN ('mg/dL', 'mmol/L', 'umol/L') GROUP BY 2""")
def unit_unconverted_report(t):
    return unconverted_units(measured(t), RULES)


GAPS = ["l_orderkey", "l_linenumber",
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount",
        "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice",
        "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag",
        "CASE WHEN l_orderkey % 5 < 3 THEN NULL ELSE l_tax END AS l_tax",
        "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity END AS l_quantity"]
GAPPY = f"WITH g AS (SELECT {', '.join(GAPS)} FROM lineitem) "


def gappy(t):
    return t.lineitem.selectExpr(*GAPS)


@query(GAPPY + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*), 6) AS missing_pct FROM g"
    for c in ("l_discount", "l_extendedprice", "l_returnflag", "l_tax", "l_quantity")))
def missingness(t):
    from pyspark.sql import functions as F
    report = missingness_report(gappy(t))
    return report.withColumn("missing_pct", F.round("missing_pct", 6))


@query(GAPPY + """SELECT l_orderkey, l_linenumber, l_discount, l_extendedprice, l_returnflag, l_quantity FROM g""")
def sparse_drop(t):
    """Columns above the threshold go; the same columns are dropped for all rows."""
    return impute_missing(gappy(t), drop_threshold=50.0)


def imputed(t, method, columns, **more):
    df = gappy(t)
    return MissingValueImputer(columns, method, **more).fit(df).transform(df)


ROUND = "round({0}, 6) AS {0}"


@query(GAPPY + """
SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, (SELECT avg(l_discount) FROM g)), 6) AS l_discount,
    round(coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM g)), 4) AS l_extendedprice, l_returnflag FROM g""")
def impute_mean(t):
    return imputed(t, "mean", ["l_discount", "l_extendedprice", "l_returnflag"]).selectExpr(
        "l_orderkey", "l_linenumber", ROUND.format("l_discount"),
        "round(l_extendedprice, 4) AS l_extendedprice", "l_returnflag")


@query(GAPPY + """
SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, (SELECT median(l_discount) FROM g)), 6) AS l_discount,
    round(coalesce(l_extendedprice, (SELECT median(l_extendedprice) FROM g)), 6) AS l_extendedprice FROM g""")
def impute_median(t):
    return imputed(t, "median", ["l_discount", "l_extendedprice"]).selectExpr(
        "l_orderkey", "l_linenumber", ROUND.format("l_discount"), ROUND.format("l_extendedprice"))


def top(column):
    return (f"(SELECT {column} FROM g WHERE {column} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, {column} LIMIT 1)")


@query(GAPPY + f"""
SELECT l_orderkey, l_linenumber, coalesce(l_returnflag, {top('l_returnflag')}) AS l_returnflag,
    coalesce(l_quantity, {top('l_quantity')}) AS l_quantity,
    coalesce(l_extendedprice, {top('l_extendedprice')}) AS l_extendedprice FROM g""")
def impute_mode(t):
    return imputed(t, "mode", ["l_returnflag", "l_quantity", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")


@query(GAPPY + """
SELECT l_orderkey, l_linenumber, coalesce(l_discount, -1) AS l_discount,
    coalesce(l_returnflag, '-1') AS l_returnflag FROM g""")
def impute_constant(t):
    return imputed(t, "constant", ["l_discount", "l_returnflag"], constant_val=-1).select(
        "l_orderkey", "l_linenumber", "l_discount", "l_returnflag")


@query(GAPPY + f"""
SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, (SELECT avg(l_discount) FROM g)), 6) AS l_discount,
    coalesce(l_returnflag, {top('l_returnflag')}) AS l_returnflag, coalesce(l_quantity, 0) AS l_quantity,
    l_extendedprice FROM g""")
def impute_chain(t):
    """Overlapping strategies: the first with a value wins; the sparse column is gone."""
    out = impute_missing(gappy(t), 50.0, [
        {"cols": ["l_discount", "l_returnflag", "l_tax"], "method": "mean"},
        {"cols": ["l_discount", "l_returnflag"], "method": "mode"},
        {"cols": ["l_quantity"], "method": "constant", "constant_val": 0},
        {"cols": ["l_quantity"], "method": "median"}])
    return out.selectExpr("l_orderkey", "l_linenumber", ROUND.format("l_discount"), "l_returnflag",
                          "l_quantity", "l_extendedprice")


TEXT_VALUE = """CASE WHEN event_id % 7 = 0 THEN '<5' WHEN event_id % 11 = 0 THEN NULL
    ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR(30)) END"""
TEXT_UNIT = "CASE event_id % 3 WHEN 0 THEN 'mg' WHEN 1 THEN ' g ' ELSE 'odd' END"


@query(f"""
WITH e AS (SELECT event_id, {TEXT_VALUE} AS value, {TEXT_UNIT} AS unit FROM events)
SELECT event_id, CASE WHEN unit = ' g ' AND value <> '<5' THEN CAST(CAST(value AS BIGINT) * 1000 AS VARCHAR) || '.0'
    ELSE value END AS value,
    CASE WHEN unit = ' g ' AND (value IS NULL OR value <> '<5') THEN 'mg' ELSE unit END AS unit FROM e""")
def unit_text_values(t):
    """Measurements kept as text: only cells that are numbers are converted."""
    df = t.events.selectExpr("event_id", f"{TEXT_VALUE} AS value", f"{TEXT_UNIT} AS unit")
    return normalize_units(df, [{"value_col": "value", "unit_col": "unit", "canonical": "mg",
                                 "conversions": {"g": 1000}}])


@query("""
SELECT event_id, user_id, value, row_number() OVER (
    ORDER BY value DESC NULLS LAST, event_id DESC NULLS LAST) AS place FROM (
    SELECT event_id, user_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events)""")
def sorted_rows(t):
    """Rows sorted downwards with missing values last; their place shows the order."""
    df = t.events.selectExpr("event_id", "user_id",
                             "CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value")
    ordered = sort_rows(df, ["value", "event_id"], ascending=False)
    # Sorted output is in the order of its tasks and their rows.
    return number_tasks(ordered).withColumn("place", (F.col("place") + 1).cast("long"))


MODE_EXPRESSIONS = [
    "doc_id", "text", "n_chars", "CASE WHEN doc_id % 3 = 0 THEN 'often' ELSE text END AS clear",
    "CASE WHEN doc_id < 100 THEN concat('t', doc_id % 2) ELSE concat('u', doc_id) END AS tied"]


def most_frequent(column):
    return (f"SELECT '{column}' AS \"column\", CAST({column} AS VARCHAR) AS value FROM (SELECT {column}, count(*) AS n "
            f"FROM d GROUP BY 1 ORDER BY n DESC, {column} LIMIT 1)")


@query(f"WITH d AS (SELECT {', '.join(MODE_EXPRESSIONS)} FROM documents) "
       + " UNION ALL ".join(most_frequent(c) for c in ("text", "n_chars", "clear", "tied")))
def modes_of_many_values(t):
    """Modes of columns with nearly as many values as rows, a clear one, and a tie."""
    found = modes(t.documents.selectExpr(*MODE_EXPRESSIONS), ["text", "n_chars", "clear", "tied"])
    return t.spark.createDataFrame([(c, str(v)) for c, v in found.items()], "column string, value string")
