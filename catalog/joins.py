"""Merges of supplemental tables."""

from pyspark.sql import functions as F

from catalog.registry import query
from tidyforge.operators.merge import merge, resolve_collisions
from tidyforge.plans.prepare import merge_datasets

# Keys arrive as doubles on one side and as padded text with ".0" on the other.  Every fifth
# customer, and where needed every fourth customer's orders, get a key of their own, so that
# either side has rows without a partner.
RENAMED = "CASE WHEN {0} % {1} = 0 THEN -{0} ELSE {0} END"
CUSTOMER_KEY = RENAMED.format("c_custkey", 5)
ORDER_KEY = RENAMED.format("o_custkey", 4)


def order_rows(t, key="o_custkey"):
    return t.orders.selectExpr("o_orderkey", f"CAST({key} AS DOUBLE) AS custkey", "o_totalprice")


def customer_rows(t):
    return t.customer.selectExpr(
        f"concat(' ', CAST({CUSTOMER_KEY} AS STRING), '.0 ') AS custkey", "c_name", "c_mktsegment")


def key_join(kind, key="o_custkey"):
    return f"""
WITH o AS (SELECT o_orderkey, CAST({key} AS VARCHAR) AS custkey, o_totalprice FROM orders),
c AS (SELECT CAST({CUSTOMER_KEY} AS VARCHAR) AS custkey, c_name, c_mktsegment FROM customer)
SELECT o_orderkey, coalesce(o.custkey, c.custkey) AS custkey, o_totalprice, c_name, c_mktsegment
FROM o {kind} JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey"""


@query(key_join("LEFT"))
def merge_left(t):
    return merge(order_rows(t), customer_rows(t), ["custkey"])


@query(key_join("INNER"))
def merge_inner(t):
    return merge(order_rows(t), customer_rows(t), ["custkey"], "inner")


@query(key_join("RIGHT", ORDER_KEY))
def merge_right(t):
    return merge(order_rows(t, ORDER_KEY), customer_rows(t), ["custkey"], "right")


@query(key_join("FULL", ORDER_KEY))
def merge_outer(t):
    return merge(order_rows(t, ORDER_KEY), customer_rows(t), ["custkey"], "outer")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def merge_missing_key(t):
    """A rule whose key is on one side only leaves the base as it is when told to skip."""
    base = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return merge(base, t.customer, ["o_custkey"], on_missing_key="skip")


@query(f"""
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_acctbal FROM customer)
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS custkey, c_acctbal
FROM orders LEFT JOIN c ON CAST(o_custkey AS VARCHAR) = c.custkey""")
def merge_own_key_scrubber(t):
    """Keys written ``C-<number>`` meet plain numbers through a scrubber of the caller."""
    base = t.orders.selectExpr("o_orderkey", "concat('C-', o_custkey) AS custkey")
    new = t.customer.selectExpr("CAST(c_custkey AS STRING) AS custkey", "c_acctbal")
    return merge(base, new, ["custkey"],
                 key_scrubber=lambda text: F.regexp_replace(text, "^C-", ""))


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS k FROM orders),
c AS (SELECT CASE WHEN c_custkey % 37 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS k, c_name, c_acctbal FROM customer),
firsts AS (SELECT k, c_name, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c_name, c_acctbal) AS r
    FROM c) WHERE r = 1)
SELECT o_orderkey, o.k, c_name, c_acctbal FROM o LEFT JOIN firsts ON o.k IS NOT DISTINCT FROM firsts.k""")
def merge_null_keys(t):
    """Missing keys match missing keys, of which the collapse keeps one."""
    base = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS k")
    new = t.customer.selectExpr("CASE WHEN c_custkey % 37 <> 0 THEN CAST(c_custkey AS STRING) END AS k",
                                "c_name", "c_acctbal")
    return merge(base, new, ["k"], order_by=["c_name"])


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS k FROM orders),
c AS (SELECT CASE WHEN c_custkey % 37 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS k, min(c_name) AS c_name
    FROM customer GROUP BY 1)
SELECT o_orderkey, o.k, c_name FROM o LEFT JOIN c ON o.k = c.k""")
def merge_null_keys_never(t):
    """Missing keys match nothing when asked so."""
    base = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS k")
    new = t.customer.selectExpr("CASE WHEN c_custkey % 37 <> 0 THEN c_custkey END AS k", "c_name")
    return merge(base, new, ["k"], order_by=["c_name"], null_keys="never")


LINES = "l_orderkey AS orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_returnflag"


@query(f"""
WITH l AS (SELECT {LINES} FROM lineitem WHERE trim(l_returnflag) = 'R'),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY orderkey
    ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS r FROM l) WHERE r = 1)
SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, o_totalprice, l_shipdate, l_linenumber, l_partkey, l_suppkey,
    l_returnflag FROM orders LEFT JOIN one ON o_orderkey = one.orderkey""")
def merge_filtered_collapsed(t):
    """Filter, then one row per key, then join: no order is multiplied."""
    base = t.orders.selectExpr("o_orderkey AS orderkey", "o_totalprice")
    new = t.lineitem.selectExpr(*LINES.split(", "))
    return merge(base, new, ["orderkey"], filters={"l_returnflag": " R ", "not_there": 1},
                 order_by=["l_shipdate"])


@query("""
WITH one AS (SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS r FROM orders) WHERE r = 1)
SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_name, o_orderkey, o_totalprice
FROM customer LEFT JOIN one ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""")
def merge_known_keys(t):
    """A few customers and all orders: those of others are left out before the collapse."""
    base = t.customer.where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS custkey", "c_name")
    new = t.orders.selectExpr("o_custkey AS custkey", "o_orderkey", "o_totalprice")
    return merge(base, new, ["custkey"], order_by=["o_totalprice", "o_orderkey"], key_filter=True)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderstatus, l_linenumber, l_extendedprice
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def merge_fanout(t):
    base = t.orders.selectExpr("o_orderkey AS orderkey", "o_orderstatus")
    new = t.lineitem.selectExpr("l_orderkey AS orderkey", "l_linenumber", "l_extendedprice")
    return merge(base, new, ["orderkey"], collapse_duplicates=False)


@query("""
WITH l AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k FROM lineitem)
SELECT CAST(k AS VARCHAR) AS k, l_partkey, l_quantity, o_totalprice, o_custkey
FROM l LEFT JOIN orders ON k = o_orderkey""")
def merge_hot_key(t):
    """One key holds a third of the base."""
    base = t.lineitem.selectExpr("CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k",
                                 "l_partkey", "l_quantity")
    new = t.orders.selectExpr("o_orderkey AS k", "o_totalprice", "o_custkey")
    return merge(base, new, ["k"])


def sides(t):
    base = t.customer.selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS balance",
                                 "c_mktsegment AS pos_x")
    new = t.supplier.selectExpr("s_suppkey AS k", "s_name AS name", "s_acctbal AS balance",
                                "s_nationkey AS nation")
    return base, new


def collision_sql(columns):
    return f"""SELECT CAST(c_custkey AS VARCHAR) AS k, c_mktsegment AS pos_x, s_nationkey AS nation, {columns}
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey"""


@query(collision_sql("c_name AS name, c_acctbal AS balance"))
def merge_collisions_base(t):
    return merge(*sides(t), ["k"], collision="keep_base")


@query(collision_sql("s_name AS name, s_acctbal AS balance"))
def merge_collisions_new(t):
    return merge(*sides(t), ["k"], collision="keep_new")


BOTH = ("c_name AS name_base, s_name AS name_new, c_acctbal AS balance_base, s_acctbal AS balance_new")


@query(collision_sql(BOTH))
def merge_collisions_both(t):
    return merge(*sides(t), ["k"], collision="keep_both")


@query(collision_sql("c_name AS name, c_acctbal AS balance"))
def validate_merge(t):
    """Suffix pairs of an earlier join resolved afterwards; a real ``pos_x`` survives."""
    return resolve_collisions(merge(*sides(t), ["k"], collision="suffix"), "keep_base")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, l_extendedprice, CAST(o_custkey AS VARCHAR) AS custkey,
    CAST(c_nationkey AS VARCHAR) AS nationkey, lower(c_mktsegment) AS c_mktsegment, lower(n_name) AS n_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN (SELECT * FROM customer WHERE lower(c_mktsegment) = 'machinery') ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""")
def multi_merge(t):
    """Four tables in the given order, incoming text cleaned, a filter value cleaned alike."""
    base = t.lineitem.selectExpr("l_orderkey AS orderkey", "l_extendedprice")
    return merge_datasets(base, [
        {"file": t.orders.selectExpr("o_orderkey AS orderkey", "o_custkey AS custkey"), "on": ["orderkey"]},
        {"file": t.customer.selectExpr("c_custkey AS custkey", "c_nationkey AS nationkey", "c_mktsegment"),
         "on": ["custkey"], "filters": {"c_mktsegment": "MACHINERY"}},
        {"file": t.nation.selectExpr("n_nationkey AS nationkey", "n_name"), "on": ["nationkey"]}])
