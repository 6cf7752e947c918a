"""Sources, sinks, whole runs and tuning."""

import io
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
import pyarrow.feather as feather
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.texts import UNICODE_WHITE
from tidyforge.operators.dedupe import deduplicate
from tidyforge.operators.merge import merge
from tidyforge.operators.tune import FOLD, assign_folds, hyper_parameter_tuner
from tidyforge.plans.prepare import (merge_datasets, parameter_template, process_data,
                                     process_data_from_config)
from tidyforge.plans.report import StageReport
from tidyforge.session import shared_path
from tidyforge.sources.decode import decode_content
from tidyforge.sources.discover import auto_prepare_merges, find_files
from tidyforge.sources.html import extract_html_tables
from tidyforge.sources.load import load, load_data
from tidyforge.sources.save import save_output

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
NULLED = "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority"


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {NULLED} FROM orders")
def csv_roundtrip(t):
    """Written as CSV with a missing-value token, read back with inferred types."""
    path = shared_path(t.spark, "orders") + ".csv"
    out = t.orders.selectExpr(*ORDER_COLUMNS[:4], NULLED)
    save_output(out.withColumn("o_orderpriority", F.coalesce("o_orderpriority", F.lit("N/A"))), path)
    return load(t.spark, path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_with_schema(t):
    path = shared_path(t.spark, "customer")
    save_output(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    return load(t.spark, path + ".csv", schema="c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def json_scan(t):
    path = shared_path(t.spark, "customer") + ".json"
    t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").write.json(path)
    df = load(t.spark, path)
    return df.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_array_scan(t):
    """Files that hold one array of records each."""
    path = shared_path(t.spark, "arrays") + ".json"
    record = F.struct("c_custkey", "c_name", "c_acctbal")
    arrays = t.customer.groupBy(F.expr("c_custkey div 100 AS part")).agg(
        F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return load(t.spark, path, schema="c_custkey bigint, c_name string, c_acctbal double").select(
        "c_custkey", "c_name", "c_acctbal")


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c_custkey, lower(c_name) AS c_name, c_acctbal
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def json_merge(t):
    """A JSON file as merge input, with its rows in file order."""
    path = shared_path(t.spark, "customer") + ".json"
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.json(path)
    base = t.orders.selectExpr("o_orderkey", "o_custkey AS c_custkey")
    return merge_datasets(base, [{"file": path, "on": ["c_custkey"]}])


@query("""
SELECT doc_id, concat('  "', text, '" , ', lang, chr(10), source, ' ') AS text, n_chars FROM documents""")
def csv_documents_roundtrip(t):
    """Whole texts with line breaks, quotes and blanks at their ends, written and read again."""
    path = shared_path(t.spark, "documents") + ".csv"
    dirty = F.concat(F.lit('  "'), "text", F.lit('" , '), "lang", F.lit("\n"), "source", F.lit(" "))
    save_output(t.documents.select("doc_id", dirty.alias("text"), "n_chars"), path)
    return load(t.spark, path, schema="doc_id bigint, text string, n_chars bigint", na_tokens=[])


@query("""
SELECT doc_id, concat('  "', text, '" , ', lang, chr(10), source, ' ') AS text, n_chars FROM documents""")
def csv_split_file(t):
    """Whole texts with line breaks in a single file, which is cut into many splits."""
    path = shared_path(t.spark, "documents") + ".csv"
    dirty = F.concat(F.lit('  "'), "text", F.lit('" , '), "lang", F.lit("\n"), "source", F.lit(" "))
    save_output(t.documents.select("doc_id", dirty.alias("text"), "n_chars"), path, single_file=True)
    with _many_splits(t.spark):
        return load(t.spark, path, na_tokens=[])


@contextmanager
def _many_splits(spark):
    """Split files evenly among the cores, however small they are."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    yield
    spark.conf.set(name, before)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_split_array(t):
    """Arrays of records, each cut into many splits."""
    path = shared_path(t.spark, "arrays") + ".json"
    record = F.struct("c_custkey", "c_name", "c_acctbal")
    t.customer.groupBy(F.expr("c_custkey % 3 AS part")).agg(
        F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("part").text(path)
    with _many_splits(t.spark):
        return load(t.spark, path, orient="records").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_column_objects(t):
    """Files that hold an object of cells, by row label, for every column."""
    path = shared_path(t.spark, "columns") + ".json"
    texts = {"c_custkey": F.col("c_custkey").cast("string"), "c_acctbal": F.col("c_acctbal").cast("string"),
             "c_name": F.concat(F.lit('"'), "c_name", F.lit('"'))}
    label = F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('":'))
    members = [F.concat(F.lit(f'"{c}":{{'), F.array_join(F.collect_list(F.concat(label, text)), ","),
                        F.lit("}")) for c, text in texts.items()]
    t.customer.groupBy(F.expr("c_custkey % 3 AS part")).agg(F.concat(
        F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("value")).write.partitionBy(
        "part").text(path)
    with _many_splits(t.spark):
        return load(t.spark, path).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT * FROM supplier")
def parquet_scan(t):
    return load_data(t.spark, t.path("supplier"))


@query("SELECT o_orderstatus, count(*) AS orders, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY 1")
def sql_source(t):
    return load(t.spark, "select o_orderstatus, count(*) as orders, sum(o_custkey) as keys "
                         "from sql_source_orders group by 1",
                views={"sql_source_orders": t.path("orders")})


@query("""
SELECT 'customer.parquet' AS name, count(*) AS rows FROM customer
UNION ALL SELECT 'orders.parquet', count(*) FROM orders
UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem""")
def file_discovery(t):
    """Files found by suffix and pattern, each loaded and counted."""
    found = find_files(t.spark, t.folder, ".parquet", "^(CUST|order|LineItem)")
    files = [(r["name"], r["path"]) for r in found.collect()]
    counts = [load(t.spark, path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
              for name, path in sorted(files)]
    return reduce(DataFrame.unionByName, counts)


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal,
    lower(c_mktsegment) AS c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def discovered_merges(t):
    """Merge rules built from a folder, then run."""
    rules = auto_prepare_merges(t.spark, t.folder, ".parquet", ["c_custkey"], name_pattern="^customer")
    return merge_datasets(t.orders.selectExpr("o_orderkey", "o_custkey AS c_custkey"), rules)


def packed(df, write):
    """Each batch of rows as the bytes of one file of a binary format."""
    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                target = io.BytesIO()
                write(pa.Table.from_batches([batch]), target)
                yield pa.RecordBatch.from_pydict({"path": ["p"], "content": [target.getvalue()]})

    return df.mapInArrow(pack, "path string, content binary")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def decode_feather(t):
    files = packed(t.customer.select("c_custkey", "c_name", "c_acctbal"),
                   lambda table, target: feather.write_feather(table, target))
    return decode_content(files, "feather", "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_retailprice FROM part")
def decode_stata(t):
    def write(table, target):
        pdf = table.to_pandas().astype({"p_partkey": "float64"})
        pdf.to_stata(target, write_index=False)

    files = packed(t.part.select("p_partkey", "p_name", "p_retailprice"), write)
    return decode_content(files, "dta", "p_partkey double, p_name string, p_retailprice double")


@query("""
SELECT page_id AS page, 0 AS table_no, 0 AS row_no, 'id' AS first, 'address' AS second FROM pages
UNION ALL SELECT page_id, 0, 1, CAST(page_id AS VARCHAR), url FROM pages""")
def html_tables(t):
    """Rows of a table put in front of each whole page."""
    table = F.concat(F.lit("<TABLE class='x'><tr><th>id</th><th> address</th></tr><tr><td>"),
                     F.col("page_id").cast("string"), F.lit("</td><td><a>"), F.col("url"),
                     F.lit("</a></td></tr></TABLE>"), F.col("html"))
    found = extract_html_tables(t.pages.select("page_id", table.alias("html")), "page_id", "html")
    return found.select("page", "table_no", "row_no", F.col("cells")[0].alias("first"),
                        F.col("cells")[1].alias("second"))


@query("""
SELECT page_id AS page, 0 AS table_no, 0 AS row_no, concat_ws('|', 'id', url, url) AS cells FROM pages
UNION ALL SELECT page_id, 0, 1, 'id|x|y' FROM pages""")
def html_spans(t):
    """Cells that span rows and columns stand in each of them."""
    table = F.concat(F.lit("<table><tr><th rowspan='2'>id<td colspan=2>"), F.col("url"),
                     F.lit("<tr><td>x<td>y</table>"), F.col("html"))
    found = extract_html_tables(t.pages.select("page_id", table.alias("html")), "page_id", "html")
    return found.select("page", "table_no", "row_no", F.array_join("cells", "|").alias("cells"))


@query("""
WITH o AS (SELECT o_custkey, o_orderkey FROM orders), m AS (SELECT o_custkey, o_orderkey, c_name
    FROM o JOIN customer ON o_custkey = CASE WHEN c_custkey % 5 = 0 THEN -c_custkey ELSE c_custkey END)
SELECT 'load' AS stage, 'rows' AS metric, count(*) AS value FROM o
UNION ALL SELECT 'merge', 'rows', count(*) FROM m
UNION ALL SELECT 'merge', 'customers', count(DISTINCT o_custkey) FROM m
UNION ALL SELECT 'deduplicate', 'rows', count(DISTINCT o_custkey) FROM m""")
def stage_report(t):
    report = StageReport()
    df = report.watch(t.orders.selectExpr("o_custkey AS k", "o_orderkey"), "load")
    new = t.customer.selectExpr("CASE WHEN c_custkey % 5 = 0 THEN -c_custkey ELSE c_custkey END AS k",
                                "c_name")
    df = merge_datasets(df, [{"file": new, "on": ["k"], "how": "inner"}])
    df = report.watch(df, "merge", customers=F.count_distinct("k"))
    report.watch(deduplicate(df, ["k"], "last", ["o_orderkey"]), "deduplicate")
    return report.to_df(t.spark)


@query("""
WITH e AS (SELECT event_id, user_id, value, CASE event_id % 3 WHEN 0 THEN 'mg' WHEN 1 THEN 'g' ELSE 'odd' END AS unit,
    CASE WHEN event_id % 4 > 0 THEN value END AS told FROM events), c AS (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY')
SELECT 'load' AS stage, 'rows' AS metric, count(*) AS value FROM e
UNION ALL SELECT 'merge 1 input', 'rows', count(*) FROM customer
UNION ALL SELECT 'merge 1 filtered', 'rows', count(*) FROM c
UNION ALL SELECT 'merge 1 filtered', 'keys', count(DISTINCT c_custkey) FROM c
UNION ALL SELECT 'deduplicate', 'rows', count(DISTINCT event_id) FROM e
UNION ALL SELECT 'units', 'rows', count(DISTINCT event_id) FROM e
UNION ALL SELECT 'units', 'converted_0', count(DISTINCT event_id) FROM e WHERE unit = 'g' AND value IS NOT NULL
UNION ALL SELECT 'units', 'converted_1', count(DISTINCT event_id) FROM e WHERE event_id % 2 = 1 AND told IS NOT NULL
UNION ALL SELECT 'save', 'rows', count(DISTINCT event_id) FROM e
UNION ALL SELECT 'impute', 'dropped_columns', 0""")
def run_report(t):
    """Counters of a whole run: rows read, filtered, collapsed, converted and saved."""
    report = StageReport()
    events = t.events.selectExpr("event_id", "user_id", "value",
                                 "CASE event_id % 3 WHEN 0 THEN 'mg' WHEN 1 THEN 'g' ELSE 'odd' END AS unit",
                                 "CASE WHEN event_id % 4 = 0 THEN '<5' ELSE CAST(value AS STRING) END AS told",
                                 "CASE event_id % 2 WHEN 1 THEN 'kg' ELSE 'g' END AS told_unit")
    customers = t.customer.selectExpr("c_custkey AS user_id", "c_acctbal", "c_mktsegment")
    process_data(t.spark, events, shared_path(t.spark, "reported"), dedupe_subset=["event_id"],
                 merge_configs=[{"file": customers, "on": ["user_id"], "filters": {"c_mktsegment": "MACHINERY"}}],
                 lab_configs=[{"value_col": "value", "unit_col": "unit", "canonical": "mg",
                               "conversions": {"g": 1000}},
                              {"value_col": "told", "unit_col": "told_unit", "canonical": "g",
                               "conversions": {"kg": 1000}}],
                 drop_threshold=None, scale_method=None, exclude_encode_prefixes=("told",), report=report)
    return report.to_df(t.spark)


# ---------------------------------------------------------------- whole runs

def flagship_frame(t):
    """Latest order per customer with the customer's scaled balance and a price flag."""
    orders = t.orders.selectExpr("o_custkey AS custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                                 "concat(' ', o_orderpriority, chr(9)) AS priority")
    customers = t.customer.selectExpr("concat(CAST(c_custkey AS STRING), '.0') AS custkey", "c_acctbal")
    return process_data(
        t.spark, orders, clean_columns=["priority"],
        merge_configs=[{"file": customers, "on": ["custkey"]}], dedupe_subset=["custkey"],
        dedupe_keep="last", dedupe_sort_by=["o_orderdate", "o_orderkey"],
        feature_steps=[{"tool": "binarize", "column": "o_totalprice", "threshold": 250000}],
        encode_categorical=False, scale_method="standard",
        exclude_scale_cols=["o_orderkey", "o_totalprice", "o_totalprice_binarized"])


@query("""
WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
    AS r FROM orders) WHERE r = 1),
m AS (SELECT o.*, c_acctbal FROM o LEFT JOIN customer ON o_custkey = c_custkey)
SELECT CAST(o_custkey AS VARCHAR) AS custkey, o_orderkey, o_orderdate, o_totalprice, lower(o_orderpriority) AS priority,
    round((c_acctbal - (SELECT avg(c_acctbal) FROM m)) / (SELECT stddev_pop(c_acctbal) FROM m), 6) AS c_acctbal,
    CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS o_totalprice_binarized FROM m""")
def flagship(t):
    return flagship_frame(t).withColumn("c_acctbal", F.round("c_acctbal", 6))


RUN_UNIT = "CASE event_id % 3 WHEN 0 THEN 'MG' WHEN 1 THEN ' G ' ELSE 'odd' END"


@query(f"""
WITH e AS (SELECT event_id AS "ID", user_id, event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS raw,
    {RUN_UNIT} AS unit FROM events),
u AS (SELECT "ID", user_id, event_type, CASE WHEN trim(unit) = 'G' THEN raw * 1000 ELSE raw END AS value,
    CASE WHEN trim(unit) IN ('MG', 'G') THEN 'mg' ELSE 'odd' END AS unit FROM e),
f AS (SELECT u.*, c_acctbal, coalesce(value, (SELECT median(value) FROM u)) AS v FROM u
    LEFT JOIN (SELECT * FROM customer WHERE lower(c_mktsegment) = 'machinery') ON user_id = c_custkey),
b AS (SELECT *, coalesce(c_acctbal, -1) AS bal, ln(1 + v) AS lg FROM f)
SELECT "ID", CAST(user_id AS VARCHAR) AS user_id,
    round((v - (SELECT median(v) FROM b)) / (SELECT quantile_cont(v, 0.75) - quantile_cont(v, 0.25) FROM b), 6) AS value,
    round((lg - (SELECT median(lg) FROM b)) / (SELECT quantile_cont(lg, 0.75) - quantile_cont(lg, 0.25) FROM b), 6)
        AS value_log,
    bal AS c_acctbal,
    CASE WHEN v <= (SELECT quantile_cont(v, 0.25) FROM b) THEN 0 WHEN v <= (SELECT quantile_cont(v, 0.5) FROM b) THEN 1
        WHEN v <= (SELECT quantile_cont(v, 0.75) FROM b) THEN 2 ELSE 3 END AS quarter,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event_type_error,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type_purchase,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS event_type_signup,
    CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view,
    CASE WHEN unit = 'odd' THEN 1 ELSE 0 END AS unit_odd FROM b""")
def prepare_end_to_end(t):
    """Every stage from one configuration dict, written as CSV at the end."""
    events = t.events.selectExpr(
        "event_id AS ID", "user_id", "event_type", f"{RUN_UNIT} AS unit",
        "CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value",
        "CASE WHEN event_id % 20 <> 0 THEN NULL ELSE value END AS mostly_missing", "props")
    # A duplicate of every seventh row, to be removed again.
    twice = events.unionByName(events.where("ID % 7 = 0"))
    customers = t.customer.selectExpr("c_custkey AS user_id", "c_acctbal", "c_mktsegment")
    config = parameter_template() | {
        "primary_file": twice, "output_file": shared_path(t.spark, "prepared_events"),
        "drop_columns": ["props"], "dedupe_subset": ["ID"], "drop_threshold": 92.0,
        "merge_configs": [{"file": customers, "on": ["user_id"], "filters": {"c_mktsegment": "MACHINERY"}}],
        "lab_configs": [{"value_col": "value", "unit_col": "unit", "canonical": "mg",
                         "conversions": {"G": 1000}}],
        "impute_strategies": [{"cols": ["value"], "method": "median"},
                              {"cols": ["c_acctbal"], "method": "constant", "constant_val": -1}],
        "feature_steps": [{"tool": "log_transform", "column": "value"},
                          {"tool": "quantile_binning", "column": "value", "q": 4, "codes": True,
                           "new_column_name": "quarter"}],
        "scale_method": "robust",
        "exclude_scale_cols": ["c_acctbal", "quarter"]}
    out = process_data_from_config(t.spark, config)
    return out.select(*[F.round(c, 6).alias(c) if c in ("value", "value_log") else F.col(c)
                        for c in out.columns])


@query(f"""
WITH d AS (SELECT doc_id, lower(trim(regexp_replace(text, '{UNICODE_WHITE}', ' ', 'g'), ' ')) AS text,
    lower(lang) AS lang FROM documents)
SELECT doc_id, concat_ws('|', CASE WHEN text <> (SELECT min(text) FROM d) THEN 'text_' || text END,
    CASE WHEN lang <> (SELECT min(lang) FROM d) THEN 'lang_' || lang END) AS active FROM d""")
def prepare_free_text(t):
    """A run with the default options over free text, encoded sparsely."""
    out = process_data(t.spark, t.documents.selectExpr("doc_id", "text", "lang"), encoding="sparse",
                       exclude_scale_cols=["doc_id"])
    return out.select("doc_id", F.array_join("active_dummies", "|").alias("active"))


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS k, upper(c_name) AS c_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def replaced_stages(t):
    """A merge run with the caller's own loader and merge function."""
    def loader(spark, source, **_):
        return getattr(t, source).selectExpr("c_custkey AS k", "c_name")

    def merger(base, new, **settings):
        return merge(base, new.withColumn("c_name", F.upper("c_name")), **settings)

    base = t.orders.selectExpr("o_orderkey", "o_custkey AS k")
    return merge_datasets(base, [{"file": "customer", "on": ["k"]}], loader=loader, merger=merger)


# ---------------------------------------------------------------- tuning

def labelled(t):
    return t.orders.selectExpr(
        "o_orderkey", "o_totalprice / 100000 AS price", "CAST(month(o_orderdate) AS DOUBLE) AS month",
        "CASE WHEN o_orderstatus = 'F' THEN 1.0D ELSE 0.0D END AS done")


@query("""
WITH n AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END AS done FROM orders),
r AS (SELECT done, (row_number() OVER (PARTITION BY done) - 1) % 5 AS fold FROM n)
SELECT done, CAST(fold AS INTEGER) AS fold, count(*) AS rows FROM r GROUP BY 1, 2""")
def cv_folds(t):
    """Stratified fold sizes."""
    folds = assign_folds(labelled(t), "done", ["o_orderkey"], 5)
    return folds.groupBy("done", F.col(FOLD).alias("fold")).agg(F.count(F.lit(1)).alias("rows"))


def stump_scores(folds, by_chance, rows):
    """Scores of trees without and with one split on a feature that equals the label.

    Without a split every row gets the more frequent label.  The rows of each label are
    dealt to the folds in turn, which gives the rows of a fold.
    """
    return f"""
WITH n AS (SELECT CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS y FROM orders),
r AS (SELECT y, (row_number() OVER (PARTITION BY y) - 1) % {folds} AS fold FROM n),
f AS (SELECT fold, sum(y)::DOUBLE AS ones, count(*)::DOUBLE AS n FROM r GROUP BY fold),
w AS (SELECT sum(y) * 2 > count(*) AS ones_lead FROM n),
s AS (SELECT avg({by_chance}) AS chance FROM f, w),
k AS (SELECT unnest(['gini', 'entropy']) AS impurity)
{rows}"""


BY_CHANCE = "CASE WHEN ones_lead THEN ones / n ELSE 1 - ones / n END"
F1_BY_CHANCE = "CASE WHEN ones_lead THEN 2 * ones / (n + ones) ELSE 0 END"
GRID_ROWS = """SELECT 0 AS candidate, $${'maxDepth': 0}$$ AS params, round(chance, 9) AS avg_metric FROM s
UNION ALL SELECT 1, $${'maxDepth': 1}$$, 1.0"""
DRAWN_ROWS = """SELECT $${'maxDepth': 0, 'impurity': '$$ || impurity || $$'}$$ AS params,
    round(chance, 9) AS avg_metric FROM s, k
UNION ALL SELECT $${'maxDepth': 1, 'impurity': '$$ || impurity || $$'}$$, 1.0 FROM k"""


def open_orders(t):
    return t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderstatus <> 'F' THEN 1.0D ELSE 0.0D END AS y",
                               "CASE WHEN o_orderstatus <> 'F' THEN 7 ELSE 2 END AS x")


def tree_search(t, space, **settings):
    tuner = hyper_parameter_tuner(DecisionTreeClassifier(), space, open_orders(t), "y", ["x"],
                                  order_by=["o_orderkey"], **settings)
    return tuner.result.results.withColumn("avg_metric", F.round("avg_metric", 9))


@query(stump_scores(3, BY_CHANCE, GRID_ROWS))
def cv_grid(t):
    """Mean accuracy of each grid point."""
    return tree_search(t, {"maxDepth": [0, 1]}, method="grid", cv=3)


@query(stump_scores(4, F1_BY_CHANCE, GRID_ROWS))
def cv_f1(t):
    """Mean F1 of label 1."""
    return tree_search(t, {"maxDepth": [0, 1]}, method="grid", cv=4, scoring="f1")


@query(stump_scores(3, BY_CHANCE, DRAWN_ROWS))
def cv_random(t):
    """Mean accuracy of four drawn points, which are all there are."""
    space = {"maxDepth": [0, 1], "impurity": ["gini", "entropy"]}
    return tree_search(t, space, n_iter=4, cv=3).drop("candidate")


@query("""
SELECT o_orderkey, round(2 * o_totalprice / 100000 - extract(month FROM o_orderdate) + 3, 6) AS prediction FROM orders""")
def cv_predict(t):
    """Predictions of the best model for a target that is linear in the features."""
    df = labelled(t).withColumn("target", 2 * F.col("price") - F.col("month") + 3)
    tuner = hyper_parameter_tuner(
        LinearRegression(solver="normal"), {"regParam": [0.0, 1.0]}, df, "target", ["price", "month"],
        method="grid", cv=3, order_by=["o_orderkey"])
    return tuner.predict(df).select("o_orderkey", F.round("prediction", 6).alias("prediction"))


@query("""
WITH n AS (SELECT o_orderkey, o_orderstatus <> 'F' AS y, (o_totalprice > 150000)::INT AS a,
    (o_orderkey % 3 = 0)::INT AS b FROM orders),
c AS (SELECT y, count(*)::DOUBLE AS n, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM n GROUP BY y),
p AS (SELECT o_orderkey, c.y, (c.n + 1) * (CASE WHEN n.a = 1 THEN c.a + 1 ELSE c.n - c.a + 1 END) / (c.n + 2)
    * (CASE WHEN n.b = 1 THEN c.b + 1 ELSE c.n - c.b + 1 END) / (c.n + 2) AS joint FROM n, c)
SELECT o_orderkey, round(sum(CASE WHEN y THEN joint ELSE 0 END) / sum(joint), 6) AS p_open
FROM p GROUP BY o_orderkey""")
def cv_probabilities(t):
    """Class probabilities of the best classifier, refitted on all rows, for every row."""
    df = t.orders.selectExpr(
        "o_orderkey", "CASE WHEN o_orderstatus <> 'F' THEN 1.0D ELSE 0.0D END AS y",
        "CAST(o_totalprice > 150000 AS DOUBLE) AS a", "CAST(o_orderkey % 3 = 0 AS DOUBLE) AS b")
    tuner = hyper_parameter_tuner(NaiveBayes(modelType="bernoulli"), {"smoothing": [1.0]}, df, "y",
                                  ["a", "b"], method="grid", cv=2, order_by=["o_orderkey"])
    scored = tuner.predict_proba(df)
    return scored.select("o_orderkey", F.round(F.col("probability")[1], 6).alias("p_open"))
