import hashlib
import math
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.oracle import connect, difference
from tidyforge.llm.merkle import build_levels, manifest, proof_digest, proofs, roots
from tidyforge.llm.places import numbered
from tidyforge.llm.queries import ORACLES, QUERIES, tampered

FOLDER = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree int"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests, fanout=2):
    """Root and, for each leaf, the siblings of every level as (before, after)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        runs = [level[i:i + fanout] for i in range(0, len(level), fanout)]
        for i, k in enumerate(at):
            run = runs[k // fanout]
            paths[i].append(("".join(run[:k % fanout]), "".join(run[k % fanout + 1:])))
            at[i] = k // fanout
        level = [H("".join(run)) for run in runs]
    return level[0], paths


def plain(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded) of the rows, sorted."""
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    held = {}
    for lang in langs:
        own = sorted(((r[0], leaf(r[:5]), r) for r in rows if r[2] == lang),
                     key=lambda x: (first(x[0]), x[1]))
        held[lang] = own, *tree([x[1] for x in own], fanout)
    root, above = tree([held[lang][1] for lang in langs], fanout)
    out = []
    for lang, up in zip(langs, above):
        own, subroot, paths = held[lang]
        for (doc, digest, r), path in zip(own, paths):
            name = "" if doc is None else str(doc)
            change = zlib.crc32(name.encode()) % 7 == 0 and r[3] is not None
            folded = leaf([*r[:3], r[3] + change if r[3] is not None else None, r[4]])
            whole = path + up
            for before, after in whole:
                folded = H(before + folded + after)
            out.append((doc, digest, subroot, root, H("".join(b + a for b, a in whole)), folded))
    return sorted(out, key=str)


def odd_rows():
    rows = [(i, None if i % 4 == 0 else f"s{i % 3}", [None, "", "é", "en", "z"][i % 5],
             None if i % 6 == 0 else i, t) for i, t in enumerate(brute.ODD_TEXTS, start=10)]
    rows += [rows[3], rows[3], (None, None, None, None, None), (None, "s", "en", 3, "no id"),
             (-5, "s", "alone", 1, "x"), (2**60, "s", "en", 2**40, "y")]
    return rows + [(100 + i, "s", "big", i, f"text {i % 9}") for i in range(150)]


@pytest.mark.parametrize("fanout", [2, 3])
def test_equals_plain_trees_on_odd_rows(spark, fanout):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    claims = [tampered() if c == "n_chars" else F.col(c) for c in FIELDS]
    got = manifest(df, "lang", ["doc_id"], FIELDS, claims, fanout).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), "folded").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, fanout)


@pytest.mark.parametrize("n", [1, 2, 5, 8, 64, 100])
def test_proofs_in_short_steps_give_the_same_paths(spark, n):
    digests = [H(str(i)) for i in range(n)]
    leaves = spark.createDataFrame([(7, i, n, d) for i, d in enumerate(digests)]
                                   + [(9, 0, 1, H("lone"))], "tree long, pos long, n long, digest string")
    levels = build_levels(leaves)
    assert len(levels) == 1 + math.ceil(math.log2(n))
    root, paths = tree(digests)
    assert dict(roots(levels).collect()) == {7: root, 9: H("lone")}
    for subtree in (2, 4, 1024):
        got = {(r["tree"], r["pos"]): [tuple(e) for e in r["path"]]
               for r in proofs(levels, subtree=subtree).collect()}
        assert got == {(9, 0): []} | {(7, i): p for i, p in enumerate(paths)}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert manifest(df, "lang", ["doc_id"], FIELDS).count() == 0


def test_unchanged_claims_verify(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in odd_rows()], SCHEMA)
    found = manifest(df, "lang", ["doc_id"], FIELDS)
    assert found.where("folded <> root or folded is null").count() == 0


def test_every_level_has_half_the_nodes(spark):
    leaves = spark.createDataFrame([(0, i, 9, H(str(i))) for i in range(9)],
                                   "tree long, pos long, n long, digest string")
    assert [level.count() for level in build_levels(leaves)] == [9, 5, 3, 2, 1]


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("w"))
    got = {r["v"]: r["place"] for r in numbered(df, "v").collect()}
    assert got == {v: v for v in range(5000)}
    got = numbered(df, F.col("w").desc(), "v").collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["place"])] == [
        r["v"] for r in sorted(got, key=lambda r: (-r["w"], r["v"]))]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_equals_its_sql(spark):
    name = "op13_merkle_manifest"
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None
