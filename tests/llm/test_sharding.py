import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidyforge.llm.queries import QUERIES, table
from tidyforge.llm.sharding import Bins, best_fit, even_bins, pack_groups, shard_rows

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, size string, slot int, row int, key double"


def plain_best_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            i = min(fits)[1]
            room[i] -= s
        else:
            i = len(room)
            room.append(max(0, capacity - s))
        out.append(i)
    return out, len(room)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=120), st.integers(1, 100), st.sampled_from([1, 2, 7, 512]))
def test_tree_finds_the_tightest_bin(sizes, capacity, leaf):
    sizes = sorted(sizes, reverse=True)
    bins = Bins(capacity)
    bins.LEAF = leaf
    assert ([bins.put(s) for s in sizes], bins.count) == plain_best_fit(sizes, capacity)


def test_perfect_packing_needs_the_least_bins():
    sizes = sorted([6, 4] * 50 + [7, 3] * 50 + [5, 5] * 20, reverse=True)
    assert best_fit(sizes, 10)[1] == 120


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10_000), max_size=200), st.integers(1, 20))
def test_even_bins_differ_by_no_more_than_a_size(sizes, count):
    sizes = np.array(sorted(sizes, reverse=True), np.int64)
    bins = even_bins(sizes, count)
    assert len(bins) == len(sizes) and all(0 <= b < count for b in bins)
    load = np.bincount(bins, sizes, count)
    if len(sizes):      # no bin holds more than an equal part and one size
        assert load.max() <= sizes.sum() / count + sizes[0]


def test_a_hot_group_has_a_shard_and_the_others_stay_even():
    sizes = np.array([50_000] + [10] * 10_000, np.int64)
    load = np.bincount(even_bins(sizes, 16), sizes, 16)
    assert load[0] == 50_000 and load[1:].max() - load[1:].min() <= 100


def test_lanes_are_packed_by_size_and_key(spark):
    pick = random.Random(3)
    groups = [(bytes([i // 256, i % 256]), pick.randint(1, 90), 1) for i in range(900)]
    df = spark.createDataFrame(groups, "key binary, size long, n long")
    got = pack_groups(df, 100, lane_groups=300).collect()
    lanes = {r["lane"] for r in got}
    assert lanes == {0, 1, 2} and len(got) == 900
    for lane in lanes:
        own = sorted((r for r in got if r["lane"] == lane), key=lambda r: (-r["size"], bytes(r["key"])))
        assert [r["bin"] for r in own] == plain_best_fit([r["size"] for r in own], 100)[0]


def check_law(rows, shards, tolerance):
    """rows: (text, size, shard, slot).  Groups whole, slots gapless, sizes near equal."""
    home = {}
    for text, size, shard, _ in rows:
        assert size == len((text or "").encode()) + 1 and 0 <= shard < shards
        assert home.setdefault(text, shard) == shard
    for shard in range(shards):
        slots = sorted(r[3] for r in rows if r[2] == shard)
        assert slots == list(range(len(slots)))
    load = [sum(r[1] for r in rows if r[2] == k) for k in range(shards)]
    assert max(load) - min(load) <= tolerance, load


@pytest.mark.parametrize("lane_groups", [7, 200_000])
def test_odd_rows(spark, lane_groups):
    texts = [*brute.ODD_TEXTS, None, None, "", "one", "one"] + [f"filler {i % 400}" for i in range(600)]
    rows = [(i if i % 9 else None, t, "s", 5, 6, 7.0) for i, t in enumerate(texts)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = shard_rows(df, F.md5("text"), F.coalesce(F.octet_length("text"), F.lit(0)) + 1, 4,
                     lane_groups=lane_groups)
    assert got.columns == ["doc_id", "text", "row", "key", "size", "shard", "slot"]
    found = [(r["text"], r["size"], r["shard"], r["slot"]) for r in got.collect()]
    assert sorted((str(r[0]) for r in found)) == sorted(str(r[1]) for r in rows)
    check_law(found, 4, 81_000)          # one text has 80,001 bytes
    again = shard_rows(df, F.md5("text"), F.coalesce(F.octet_length("text"), F.lit(0)) + 1, 4,
                       lane_groups=lane_groups)
    assert sorted((str(r["text"]), r["shard"]) for r in again.collect()) == sorted(
        (str(r[0]), r[2]) for r in found)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert shard_rows(df, F.md5("text"), F.octet_length("text") + 1, 4).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_holds_its_law(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, FOLDER, "documents").collect()}
    got = QUERIES["op12_sharding"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(r["text_crc32"] == zlib.crc32((docs[r["doc_id"]] or "").encode()) for r in got)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    rows = [(docs[r["doc_id"]], r["size"], r["shard"], r["slot"]) for r in got]
    total = sum(r[1] for r in rows)
    largest = max(sum(r[1] for r in rows if r[0] == t) for t in {r[0] for r in rows})
    check_law(rows, 16, max(total / 16 / 50, largest - total / 16 + total / 16 / 10))
