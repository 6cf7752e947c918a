"""Features, encoding and scaling that learn from the whole table."""

from pyspark.sql import functions as F

from catalog.registry import query
from tidyforge.operators.encode import encode_categorical, one_hot_sparse, one_hot_vector
from tidyforge.operators.features import (FeatureEngineer, binarize, date_parts, log_transform,
                                          polynomial_interaction, quantile_binning)
from tidyforge.operators.format import format_for_ml
from tidyforge.operators.scale import NumericScaler, scale_numeric

LINE = "l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS l_quantity, l_tax"


def lines(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS l_quantity", "l_tax")


@query(f"""
WITH l AS (SELECT {LINE} FROM lineitem)
SELECT *, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS l_quantity_binarized FROM l""")
def binarize_quantity(t):
    return binarize(lines(t), "l_quantity", 25)


@query(f"""
WITH l AS (SELECT {LINE} FROM lineitem)
SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 6) AS l_quantity_log,
    round(ln(1 + l_tax), 6) AS log_tax FROM l""")
def log_feature(t):
    df = log_transform(log_transform(lines(t), "l_quantity"), "l_tax", "log_tax")
    return df.select("l_orderkey", "l_linenumber", F.round("l_quantity_log", 6).alias("l_quantity_log"),
                     F.round("log_tax", 6).alias("log_tax"))


@query(f"""
WITH l AS (SELECT {LINE} FROM lineitem)
SELECT l_orderkey, l_linenumber, round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax,
    l_quantity * l_quantity AS square FROM l""")
def interaction(t):
    df = polynomial_interaction(lines(t), "l_quantity", "l_tax")
    df = polynomial_interaction(df, "l_quantity", "l_quantity", "square")
    return df.select("l_orderkey", "l_linenumber",
                     F.round("l_quantity_x_l_tax", 6).alias("l_quantity_x_l_tax"), "square")


def quartile_case(column, table, names):

    edge = "(SELECT quantile_cont({c}, {p}) FROM {t})"
    parts = " ".join(
        f"WHEN {column} <= {edge.format(c=column, p=(i + 1) / len(names), t=table)} THEN {n}"
        for i, n in enumerate(names))
    return f"CASE {parts} END"


@query(f"""SELECT o_orderkey, {quartile_case('o_totalprice', 'orders', [0, 1, 2, 3])} AS price_bin FROM orders""")
def quantile_bins(t):
    return quantile_binning(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 4,
                            new_column_name="price_bin", codes=True).drop("o_totalprice")


PRICE = "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS price"


@query(f"""
WITH l AS (SELECT l_orderkey, l_linenumber, {PRICE} FROM lineitem)
SELECT l_orderkey, l_linenumber,
    {quartile_case('price', 'l', ["'low'", "'middle'", "'high'"])} AS price_q3_bins FROM l""")
def quantile_labels(t):
    """Own labels, missing cells, and edges learned once over the larger table."""
    df = t.lineitem.selectExpr("l_orderkey", "l_linenumber", PRICE)
    steps = [{"tool": "quantile_binning", "column": "price", "q": 3, "labels": ["low", "middle", "high"]}]
    return FeatureEngineer(steps).fit(df).transform(df).drop("price")


@query("""
SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS o_orderdate_year,
    CAST(extract(month FROM o_orderdate) AS INTEGER) AS o_orderdate_month,
    CAST(extract(day FROM o_orderdate) AS INTEGER) AS o_orderdate_day FROM orders""")
def date_features(t):
    return date_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


SEGMENTS = "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment"
SEGMENT_NAMES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def flags(names):
    return ", ".join(f"CASE WHEN segment = '{n}' THEN 1 ELSE 0 END AS \"segment_{n}\"" for n in names)


@query(f"""
WITH c AS (SELECT c_custkey, {SEGMENTS} FROM customer) SELECT c_custkey, {flags(SEGMENT_NAMES[1:])} FROM c""")
def one_hot(t):
    df = t.customer.selectExpr("c_custkey", SEGMENTS)
    return encode_categorical(df, ["segment", "not_there"])


@query(f"""
WITH c AS (SELECT c_custkey, {SEGMENTS} FROM customer) SELECT c_custkey, {flags(SEGMENT_NAMES)} FROM c""")
def one_hot_all(t):
    return encode_categorical(t.customer.selectExpr("c_custkey", SEGMENTS), ["segment"], drop_first=False)


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, CAST(l_partkey AS VARCHAR) AS part FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
    concat(CASE WHEN part <> (SELECT min(part) FROM s) THEN concat('part_', part, ';') ELSE '' END,
        CASE WHEN l_returnflag <> (SELECT min(l_returnflag) FROM s) THEN concat('l_returnflag_', l_returnflag, ';')
        ELSE '' END) AS active FROM s""")
def one_hot_many(t):
    """One-hot over a column with as many categories as there are parts, in sparse form."""
    df = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
                               "CAST(l_partkey AS STRING) AS part")
    out = one_hot_sparse(df, ["part", "l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.concat_ws(
        "", F.transform("active_dummies", lambda name: F.concat(name, F.lit(";")))).alias("active"))


@query("""
WITH d AS (SELECT doc_id, lang, CASE WHEN doc_id % 5 > 0 THEN text END AS text FROM documents),
t AS (SELECT text, row_number() OVER (ORDER BY text) - 2 AS place FROM (SELECT DISTINCT text FROM d WHERE text IS NOT NULL)),
l AS (SELECT lang, row_number() OVER (ORDER BY lang) AS n, (SELECT count(*) FROM t) + n - 3 AS place
    FROM (SELECT DISTINCT lang FROM d WHERE lang IS NOT NULL))
SELECT doc_id, (SELECT count(*) FROM t) + (SELECT count(*) FROM l) - 2 AS size, concat('[', concat_ws(',',
    CASE WHEN t.place >= 0 THEN t.place END, CASE WHEN l.n > 1 THEN l.place END), ']') AS active
FROM d LEFT JOIN t ON d.text = t.text LEFT JOIN l ON d.lang = l.lang""")
def one_hot_texts(t):
    """Whole texts as categories, nearly one for each row, in one sparse vector."""
    df = t.documents.selectExpr("doc_id", "lang", "CASE WHEN doc_id % 5 > 0 THEN text END AS text")
    out = one_hot_vector(df, ["text", "lang"])
    told = F.to_json(F.struct("dummies"))
    return out.select("doc_id", F.get_json_object(told, "$.dummies.size").cast("long").alias("size"),
                      F.get_json_object(told, "$.dummies.indices").alias("active"))


BALANCE = "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance"


def scaled_sql(center, spread):
    return f"""
WITH c AS (SELECT c_custkey, {BALANCE}, 5.0::DOUBLE AS constant FROM customer)
SELECT c_custkey, round((balance - (SELECT {center} FROM c)) / (SELECT {spread} FROM c), 6) AS balance,
    0.0::DOUBLE AS constant FROM c"""


def scaled(t, method):
    df = t.customer.selectExpr("c_custkey", BALANCE, "CAST(5.0 AS DOUBLE) AS constant")
    out = scale_numeric(df, ["balance", "constant", "not_there"], method)
    return out.withColumn("balance", F.round("balance", 6))


@query(scaled_sql("avg(balance)", "stddev_pop(balance)"))
def scale_standard(t):
    return scaled(t, "standard")


@query(scaled_sql("min(balance)", "max(balance) - min(balance)"))
def scale_minmax(t):
    return scaled(t, "minmax")


@query(scaled_sql("median(balance)", "quantile_cont(balance, 0.75) - quantile_cont(balance, 0.25)"))
def scale_robust(t):
    return scaled(t, "robust")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem)
SELECT l_orderkey, l_linenumber, round((price - (SELECT median(price) FROM l)) /
    (SELECT quantile_cont(price, 0.75) - quantile_cont(price, 0.25) FROM l), 6) AS price FROM l""")
def scale_robust_large(t):
    """Exact quartiles of a column with about as many values as rows."""
    df = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_extendedprice AS price")
    out = NumericScaler(["price"], "robust").fit(df).transform(df)
    return out.withColumn("price", F.round("price", 6))


STATUS = ["F", "O", "P"]


@query("""
WITH o AS (SELECT o_orderkey, o_orderkey AS "SEQNO", o_totalprice, o_orderstatus, o_orderpriority AS "Site_priority"
    FROM orders)
SELECT round((o_orderkey - (SELECT avg(o_orderkey) FROM o)) / (SELECT stddev_pop(o_orderkey) FROM o), 6) AS o_orderkey,
    "SEQNO", round((o_totalprice - (SELECT avg(o_totalprice) FROM o)) / (SELECT stddev_pop(o_totalprice) FROM o), 6)
    AS o_totalprice, "Site_priority", CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "o_orderstatus_O",
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS "o_orderstatus_P" FROM o""")
def format_columns(t):
    """Encode, then scale; protected names and prefixes stay as they are."""
    df = t.orders.selectExpr("o_orderkey", "o_orderkey AS SEQNO", "o_totalprice", "o_orderstatus",
                             "o_orderpriority AS Site_priority")
    out = format_for_ml(df)
    return out.withColumn("o_orderkey", F.round("o_orderkey", 6)).withColumn(
        "o_totalprice", F.round("o_totalprice", 6))


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0 END AS o,
    CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE ELSE 0.0 END AS p FROM orders)
SELECT o_orderkey, round((o - (SELECT avg(o) FROM o)) / (SELECT stddev_pop(o) FROM o), 6) AS "o_orderstatus_O",
    round((p - (SELECT avg(p) FROM o)) / (SELECT stddev_pop(p) FROM o), 6) AS "o_orderstatus_P" FROM o""")
def format_scaled_dummies(t):
    """Dummies scaled too; their statistics come from the category counts."""
    out = format_for_ml(t.orders.select("o_orderkey", "o_orderstatus"), exclude_scale_cols=["o_orderkey"],
                        scale_dummies=True)
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("""
SELECT p_partkey, p_size, p_retailprice, CASE WHEN p_size > 20 THEN 1 ELSE 0 END AS p_size_binarized,
    p_size * p_retailprice AS worth FROM part""")
def feature_aliases(t):
    """Feature steps under the short names of tools and arguments."""
    steps = [{"op": "binarize", "col": "p_size", "threshold": 20},
             {"tool": "custom_logic", "new_column_name": "worth",
              "custom_func": lambda row: row["p_size"] * row["p_retailprice"]}]
    df = t.part.select("p_partkey", "p_size", "p_retailprice")
    return FeatureEngineer(steps).fit(df).transform(df)
