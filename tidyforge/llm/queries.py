"""Each operator over its whole table, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyforge.llm import language_model
from tidyforge.llm.conversations import ordered_sha256, repair
from tidyforge.llm.main_text import extract_main_text
from tidyforge.llm.merkle import manifest, proof_digest
from tidyforge.llm.mixing import mix_plan
from tidyforge.llm.ngram_join import jaccard_classes
from tidyforge.llm.packing import pack
from tidyforge.llm.range_join import near_vectors
from tidyforge.llm.repeats import remove_repeats
from tidyforge.llm.sharding import shard_rows
from tidyforge.llm.top_k import top_k
from tidyforge.llm.toxicity import score_toxicity
from tidyforge.llm.warc import read_archives, write_archives
from tidyforge.session import apply_settings

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a missing id counts as empty text."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 5


@_query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = score_toxicity(docs.select("doc_id", "text"), labels, fold() != 0)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
    AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five rows with the highest inner product for each vec_id divisible by 50."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces of the packed documents with a digest in place of their ids."""
    return pack(docs, public_tokenizers.path(TOKENIZER)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@_query()
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packed_pieces(table(spark, folder, "documents"))


@_query()
def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document under a model of the others outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = language_model.fit(docs, fold() != 1)
    return language_model.score(docs, model).select(
        "doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@_query(r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
k AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), 1, 15))
    ::BIGINT AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight, (source_size * 2)::DOUBLE AS cap
  FROM s),
f AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier,
    sum(source_size) OVER () * 1.5::DOUBLE AS whole FROM r),
g AS (SELECT *, cap * heavier <= (whole - spent) * weight AS is_full FROM f),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE
    weight * (whole - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
    / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () END AS target FROM g),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END
    AS epochs FROM t),
p AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs,
    floor(b.target + 0.5)::BIGINT - b.epochs * b.source_size - coalesce(sum(k.size) OVER (
      PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM p""")
def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix of the sources takes."""
    return mix_plan(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id,
  c.vec_id = component_id AS kept FROM c LEFT JOIN n ON c.vec_id = n.vec_id""")
def op6_embedding_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of near vectors with equal labels."""
    return near_vectors(table(spark, folder, "embeddings"))


@_query()
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The article text of every page."""
    return extract_main_text(table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w
        WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
o AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS overlap FROM g x JOIN g y
    ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * overlap >= 80 * (x.size + y.size - overlap)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id
FROM c LEFT JOIN n ON c.doc_id = n.doc_id""")
def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document under Jaccard similarity of 0.8 or more."""
    return jaccard_classes(table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id")


@_query(r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w
        WHERE len(words) >= 35)),
r AS (SELECT doc_id, i FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
gone AS (SELECT doc_id, list(i) AS places FROM x GROUP BY doc_id),
k AS (
  SELECT w.doc_id, words, coalesce(len(places), 0) AS n_removed, p.doc_id IS NULL AS whole
  FROM w LEFT JOIN gone p ON w.doc_id = p.doc_id),
kept AS (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) u
  LEFT JOIN x ON u.doc_id = x.doc_id AND u.i = x.i WHERE x.i IS NULL GROUP BY u.doc_id)
SELECT k.doc_id, len(words)::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM k LEFT JOIN kept ON k.doc_id = kept.doc_id""")
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words that repeated windows of 35 words cover."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(
        F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS newest FROM p
  WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN newest IS NOT NULL AND p.page_id IS DISTINCT FROM newest THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN newest IS NOT NULL AND p.page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes = m.payload_bytes""")
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write every page into archives and read the archives back."""
    files = write_archives(table(spark, folder, "pages"))
    return read_archives(files).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _crc32_sql(name: str, key: str) -> str:
    """Parts of a WITH clause: ``c``, the table with the CRC-32 of an ASCII text as ``crc32``."""
    return rf"""t AS (
  SELECT list((SELECT list_reduce([i] || range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) ORDER BY i) AS crc
  FROM range(256) r(i)),
c AS (
  SELECT *, 4294967295 - list_reduce([4294967295::BIGINT] || list_transform(list_filter(
      string_split({key}, ''), lambda x: x <> ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])) AS crc32
  FROM {name}, t)"""


def _way(state: str, cost: str, letter: str, line: str, allowed: str = "true") -> str:
    """An edit in SQL: its letter and line, then the cheapest way on from ``state``."""
    return (f"{{'cost': CASE WHEN {allowed} THEN {state}.cost + {cost} ELSE 1000000000 END, "
            f"'audit': '{letter}' || {state}.audit, 'said': {line} || {state}.said}}")


def _best(state: str, role: str, following: str) -> str:
    """The cheapest edit of row ``r`` in ``state``, where ``role`` leads to ``following``."""
    ways = [_way(f"p.{state}", "2", "D", "''"),
            _way(f"p.{following}", "late + 1", "R", rf"chr(10) || '{role}:' || r.text", "stays"),
            _way(f"p.{following}", "late", "K", "chr(10) || r.role || ':' || r.text",
                 f"stays AND r.role[1] = '{role[0]}'")]
    if state == "n":
        ways.append(_way("p.s", "late", "K", "chr(10) || r.role || ':' || r.text",
                         "stays AND r.role[1] = 's'"))
    return f"list_sort([{', '.join(ways)}])[1]"


def _or_insert(state: str, role: str, following: str) -> str:
    return (f"list_sort([{state}, " + _way(following, "5", "I", f"chr(10) || '{role}:'")
            + "])[1]")


@_query(rf"""
WITH RECURSIVE {_crc32_sql("conversations",
    "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")},
d AS (
  SELECT conv_id, turn, CASE WHEN crc32 % 20 = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE crc32 % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
      ELSE coalesce(text, ' ') END AS text,
    unnest(CASE crc32 % 20 WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 3 ELSE 0 END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
r AS (SELECT *, fault NOT IN (1, 2) AS stays, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS late FROM f),
b AS (
  SELECT conv_id, greatest(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id),
p(conv_id, i, n, s, u, a) AS (
  SELECT conv_id, n + 1, {{'cost': 0, 'audit': '', 'said': ''}},
    {{'cost': 10, 'audit': 'II', 'said': chr(10) || 'user:' || chr(10) || 'assistant:'}},
    {{'cost': 5, 'audit': 'I', 'said': chr(10) || 'assistant:'}},
    {{'cost': 0, 'audit': '', 'said': ''}} FROM b
  UNION ALL
  SELECT conv_id, i, {_or_insert("x.n", "user", "y.u")}, {_or_insert("x.s", "user", "y.u")}, y.u, y.a
  FROM (SELECT x, {{'u': {_or_insert("x.u", "assistant", "x.a")},
      'a': {_or_insert("x.a", "user", "x.u")}}} AS y, conv_id, i
    FROM (SELECT p.conv_id, r.i, {{'n': {_best("n", "user", "u")}, 's': {_best("s", "user", "u")},
        'u': {_best("u", "assistant", "a")}, 'a': {_best("a", "user", "u")}}} AS x
      FROM p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i - 1)))
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(p.n.cost, 0)::BIGINT AS cost,
  coalesce(p.n.audit, '') AS audit, sha256(coalesce(p.n.said[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
  LEFT JOIN b ON k.conv_id IS NOT DISTINCT FROM b.conv_id
  LEFT JOIN p ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = 1""")
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation damaged by a rule and repaired at the least cost."""
    rows = table(spark, folder, "conversations")
    found, repaired = repair(damaged(rows))
    said = ordered_sha256(repaired, "conv_id", ["place", "step"],
                          F.concat("role", F.lit(":"), "text"))
    out = rows.select(F.col("conv_id").alias("__id")).distinct()
    for part in (found, said):
        out = out.join(part, F.col("__id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("__id").alias("conv_id"),
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated",
                                                 "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated or renamed by a hash."""
    def space(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(space("conv_id"), F.lit(":"), space("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(
        kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


@_query()
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts in one shard."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", F.crc32(text).alias("text_crc32"), F.octet_length(text).alias("bytes"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    placed = shard_rows(docs, F.col("key"), F.col("bytes") + 1, 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def tampered() -> Column:
    """``n_chars`` of a document, one more where 7 divides the CRC-32 of its id."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.when(F.crc32(name) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


@_query(rf"""
WITH RECURSIVE {_crc32_sql("documents", "coalesce(doc_id::VARCHAR, '')")},
l AS (
  SELECT doc_id, lang, n_chars, coalesce(n_chars + (crc32 % 7 = 0)::BIGINT, n_chars) AS told,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM c),
h AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(told::VARCHAR) || ':' || told, '-') || tail) AS claim
  FROM l),
o AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos
  FROM h),
low(level, tree, pos, n, digest) AS (
  SELECT 0, tree, pos, count(*) OVER (PARTITION BY tree), leaf FROM o
  UNION ALL
  SELECT DISTINCT level + 1, tree, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '')
    OVER (PARTITION BY level, tree, pos // 2 ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM low WHERE n > 1),
subroots AS (SELECT tree, digest, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, tree, pos, n, digest) AS (
  SELECT 0, 0, tree, n, digest FROM subroots
  UNION ALL
  SELECT DISTINCT level + 1, tree, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '')
    OVER (PARTITION BY level, tree, pos // 2 ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM high WHERE n > 1),
heights AS (SELECT tree, max(level) AS height FROM low GROUP BY tree),
nodes AS (
  SELECT level, tree, pos, n, digest FROM low
  UNION ALL SELECT level - 1000, tree, pos, n, digest FROM high),
walk(doc, leaf, tree, k, level, slot, node, folded, siblings) AS (
  SELECT o.tree || ':' || o.pos, o.leaf, o.tree, 0, 0, o.pos, o.tree, claim, '' FROM o
  UNION ALL
  SELECT doc, leaf, w.tree, k + 1,
    CASE WHEN w.level >= 0 AND p.n = 1 THEN -1000 ELSE w.level + 1 END,
    CASE WHEN w.level >= 0 AND p.n = 1 THEN w.tree ELSE slot // 2 END,
    CASE WHEN w.level >= 0 AND p.n = 1 THEN 0 ELSE node END,
    CASE WHEN p.n = 1 THEN folded
      WHEN slot % 2 = 1 THEN sha256(s.digest || folded)
      ELSE sha256(folded || coalesce(s.digest, '')) END,
    siblings || CASE WHEN p.n = 1 THEN '' ELSE coalesce(s.digest, '') END
  FROM walk w JOIN nodes p ON p.level = w.level AND p.tree = w.node AND p.pos = w.slot
    LEFT JOIN nodes s ON s.level = w.level AND s.tree = w.node AND s.pos = xor(w.slot, 1)
  WHERE NOT (w.level < 0 AND p.n = 1)),
ends AS (SELECT doc, arg_max(folded, k) AS folded, arg_max(siblings, k) AS siblings
         FROM walk GROUP BY doc)
SELECT o.doc_id, o.leaf, subroots.digest AS subroot, r.digest AS root,
  sha256(siblings) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM o JOIN ends ON doc = o.tree || ':' || o.pos JOIN subroots ON subroots.tree = o.tree
  JOIN (SELECT digest FROM high WHERE n = 1) r ON true""")
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof in a tree per language, checked against a changed copy."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    claims = [tampered() if c == "n_chars" else F.col(c) for c in columns]
    proven = manifest(table(spark, folder, "documents"), "lang", ["doc_id"], columns, claims)
    return proven.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
