"""Text and number cleaning."""

from pyspark.sql import functions as F

from catalog.registry import query
from tidyforge.functions.text import apply_string_options, flag_matching, scrub
from tidyforge.operators.clean import (TableCleaner, clean_numeric, clean_strings, clean_text,
                                       map_categories_regex)
from tidyforge.operators.udf import apply_custom_function
from tidyforge.operators.features import custom_row_logic

DIRTY_NAME = """CASE c_custkey % 9
    WHEN 0 THEN concat('  ', c_name, chr(9), ' ') WHEN 1 THEN concat('b''', c_name, '''')
    WHEN 2 THEN 'NaN' WHEN 3 THEN '' WHEN 4 THEN replace(c_name, '#', concat(' ', chr(10), ' '))
    WHEN 5 THEN concat('b" ', c_name, ' "') WHEN 6 THEN NULL WHEN 7 THEN ' None ' ELSE c_name END"""


@query(f"""
WITH dirty AS (SELECT c_custkey, {DIRTY_NAME} AS t FROM customer),
flat AS (SELECT c_custkey, trim(regexp_replace(t, '\\s+', ' ', 'g'), ' ') AS t FROM dirty),
inner_text AS (SELECT c_custkey, CASE WHEN (t LIKE 'b''%' AND t LIKE '%''') OR (t LIKE 'b"%' AND t LIKE '%"')
    THEN substr(t, 3, length(t) - 3) ELSE t END AS t FROM flat)
SELECT c_custkey, CASE WHEN lower(t) IN ('nan', 'none', 'null', 'nat', '') THEN NULL ELSE t END AS scrubbed
FROM inner_text""")
def scrub_text(t):
    dirty = t.customer.selectExpr("c_custkey", f"{DIRTY_NAME} AS t")
    return dirty.select("c_custkey", scrub(F.col("t")).alias("scrubbed"))


UNICODE_WHITE = (r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")


@query(f"""
WITH flat AS (SELECT doc_id, trim(regexp_replace(text, '{UNICODE_WHITE}', ' ', 'g'), ' ') AS t FROM documents)
SELECT doc_id, length(t) AS chars, md5(t) AS digest FROM flat""")
def scrub_documents(t):
    """The scrubber over whole texts of any length."""
    clean = t.documents.select("doc_id", scrub(F.col("text")).alias("t"))
    return clean.select("doc_id", F.length("t").cast("bigint").alias("chars"), F.md5("t").alias("digest"))


DIRTY_PART = "concat('  ', upper(p_name), '_', p_brand, '! ', chr(9))"


@query(f"""
WITH dirty AS (SELECT p_partkey, p_size, {DIRTY_PART} AS t FROM part),
bare AS (SELECT *, regexp_replace(t, '[!-/:-@\\[-`{{-~]', '', 'g') AS no_punctuation FROM dirty)
SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, lower(t) AS lowered,
    regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS stripped, no_punctuation, replace(t, '_', ' ') AS spaced,
    regexp_replace(lower(t), '[0-9]+', '', 'g') AS digits_removed,
    regexp_replace(lower(regexp_replace(t, '\\s+', ' ', 'g')), '^\\s+|\\s+$', '', 'g') AS default_clean
FROM bare""")
def string_options(t):
    dirty = t.part.selectExpr("p_partkey", "p_size", f"{DIRTY_PART} AS t")
    kind = dirty.schema["t"].dataType

    def option(**options):
        return apply_string_options(F.col("t"), kind, options)

    return dirty.select(
        "p_partkey",
        apply_string_options(F.col("p_size"), dirty.schema["p_size"].dataType,
                             {"convert_to_string": True}).alias("size_text"),
        option(lowercase=True).alias("lowered"),
        option(strip_whitespace=True).alias("stripped"),
        option(strip_punctuation=True).alias("no_punctuation"),
        option(strip_underscores=True).alias("spaced"),
        option(lowercase=True, custom_removal="[0-9]+").alias("digits_removed"),
        option(universal_text_scrubber=True, lowercase=True, strip_whitespace=True).alias("default_clean"))


@query("""
SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority, lower(o_orderstatus) AS o_orderstatus,
    o_totalprice FROM orders""")
def clean_stage(t):
    """The cleaning stage with its default options, and columns dropped on the way."""
    return clean_text(t.orders, drop_columns=["o_orderdate", "o_custkey", "not_there"])


@query("""
SELECT p_partkey,
    CASE WHEN regexp_matches(p_type, '(?i).*(small|medium).*') THEN 'modest'
         WHEN regexp_matches(p_type, '(?i).*large.*') THEN 'big' ELSE 'other' END AS size_class,
    regexp_replace(regexp_replace(p_name, 'red', 'r', 'g'), 'ring', 'rg', 'g') AS p_name,
    CASE WHEN regexp_matches(p_type, 'PROMO|ECONOMY') THEN 1 ELSE 0 END AS on_offer
FROM part""")
def regex_category(t):
    df = map_categories_regex(t.part, "p_type", {"(?i).*(small|medium).*": "modest", "(?i).*large.*": "big"},
                              default_val="other", new_column_name="size_class")
    df = map_categories_regex(df, "p_name", {"red": "r", "ring": "rg"})
    return df.select("p_partkey", "size_class", "p_name",
                     flag_matching(F.col("p_type"), "PROMO|ECONOMY").alias("on_offer"))


MESSY_PRICE = """CASE o_orderkey % 5 WHEN 0 THEN concat(' ', CAST(CAST(floor(o_totalprice) AS INTEGER) AS VARCHAR(20)), ' ')
    WHEN 1 THEN 'n/a' WHEN 2 THEN '12d' WHEN 3 THEN '1.5e3' ELSE NULL END"""


@query(f"""
WITH messy AS (SELECT o_orderkey, {MESSY_PRICE} AS price FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 3) THEN TRY_CAST(trim(price) AS DOUBLE) END AS price FROM messy""")
def to_numeric_coerce(t):
    messy = t.orders.selectExpr("o_orderkey", f"{MESSY_PRICE} AS price")
    return clean_numeric(messy, ["price", "not_there"], to_numeric=True)


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS whole,
    CASE WHEN l_linenumber = 7 THEN 'seven' ELSE CAST(l_linenumber AS VARCHAR) END AS mixed FROM lineitem""")
def force_dtype(t):
    """A type is forced only on columns that lose nothing by it."""
    text = t.lineitem.selectExpr(
        "l_orderkey", "CAST(l_linenumber AS STRING) AS whole",
        "CASE WHEN l_linenumber = 7 THEN 'seven' ELSE CAST(l_linenumber AS STRING) END AS mixed")
    return clean_numeric(text, ["whole", "mixed"], force_dtype="int64")


@query("""
SELECT l_orderkey, CAST(round_even(l_quantity * 0.125, 2) AS DOUBLE) AS eighth,
    CAST(round_even(l_quantity / 2, 0) AS DOUBLE) AS half FROM lineitem""")
def round_half_even(t):
    df = t.lineitem.selectExpr("l_orderkey", "l_quantity * CAST(0.125 AS DOUBLE) AS eighth",
                               "l_quantity / 2 AS half")
    return clean_numeric(clean_numeric(df, ["eighth"], round_decimals=2), ["half"], round_decimals=0)


@query("""
SELECT p_partkey, lower(p_name) AS p_name, CAST(round_even(p_retailprice, 0) AS DOUBLE) AS p_retailprice,
    CASE WHEN regexp_matches(lower(p_type), 'promo') THEN 'offer' ELSE lower(p_type) END AS p_type,
    p_size * 2 AS p_size, CAST(p_size * 2 + p_partkey AS BIGINT) AS total FROM part""")
def table_cleaner(t):
    """All steps of the fitted cleaner in their order."""
    cleaner = TableCleaner(
        string_columns=["p_name", "p_type"], string_options={"lowercase": True},
        numeric_columns=["p_retailprice"], round_decimals=0, drop_columns=["p_brand"],
        category_mappings=[{"column": "p_type", "regex_mapping": {"promo": "offer"}}],
        custom_column_functions=[{"columns": ["p_size"], "func": lambda c: c * 2}],
        custom_row_functions=[{"new_column_name": "total",
                               "func": lambda row: row["p_size"] + row["p_partkey"]}])
    return cleaner.fit(t.part).transform(t.part)


@query("SELECT p_partkey, upper(p_name) AS p_name, p_brand FROM part")
def column_udf(t):
    """A plain Python function per cell, on Arrow batches."""
    return apply_custom_function(t.part.select("p_partkey", "p_name", "p_brand"), ["p_name", "not_there"],
                                 lambda cell: cell.upper(), returns="string")


@query("""
SELECT o_orderkey, o_totalprice, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'large done' ELSE 'rest' END AS kind
FROM orders""")
def row_udf(t):
    """A plain Python function per row, on Arrow batches."""
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return custom_row_logic(
        orders, "kind", lambda row: "large done" if row["o_orderstatus"] == "F"
        and row["o_totalprice"] > 200000 else "rest", returns="string")


@query("""
SELECT p_partkey, regexp_replace(p_brand, 'Brand', 'B', 'g') AS p_brand, lower(p_name) AS p_name FROM part""")
def clean_strings_some(t):
    """Options on an explicit column list; absent columns are skipped."""
    df = t.part.select("p_partkey", "p_brand", "p_name")
    df = clean_strings(df, ["p_name", "not_there"], {"lowercase": True})
    return clean_strings(df, ["p_brand"], {"custom_removal": "rand"})


@query(r"""
SELECT p_partkey, regexp_replace(p_type, '^(\w+) (.*)$', '\2, \1') AS p_type,
    CASE WHEN regexp_matches(p_name, 'aa|ee|oo') THEN 'double' ELSE 'plain' END AS name_kind FROM part""")
def regex_groups(t):
    """Named groups and references to them, as Python writes them."""
    df = t.part.select("p_partkey", "p_type", "p_name")
    df = map_categories_regex(df, "p_type", {r"^(?P<first_word>\w+) (?P<rest>.*)$": r"\g<rest>, \g<first_word>"})
    df = map_categories_regex(df, "p_name", {r".*(?P<one_vowel>[aeo])(?P=one_vowel).*": "double"}, "plain", "name_kind")
    return df.drop("p_name")
