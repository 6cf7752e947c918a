import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidyforge.llm import range_join, top_k as search, warc
from tidyforge.llm.range_join import near_vectors
from tidyforge.llm.top_k import top_k

SCHEMA = "vec_id long, embedding array<double>, label string"
ODD = [(1, None, "a"), (2, [], "a"), (3, [0.0, 0.0], "a"), (4, [1.0, None], "a"), (5, [math.nan, 1.0], "a"),
       (6, [math.inf, 1.0], "a"), (7, [1.0, 0.0], None), (8, [1.0, 0.0], "a"), (9, [2.0, -0.0], "a"),
       (10, [2.0, 0.0], "a"), (10, [2.0, 0.0], "a"), (None, [1.0, 0.01], "a"), (50, [1.0, 0.0, 0.0], "a"),
       (100, [0.5, 0.5], "b"), (11, [1e-200, 0.0], "a"), (12, [1e200, 1e198], "a")]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def plain_top_k(rows, asks, k):
    best = {}
    for q, v, _ in rows:
        if q is None or not usable(v) or not asks(q):
            continue
        for c, w, _ in rows:
            if c is not None and c != q and usable(w) and len(w) == len(v):
                s = sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(v, w))
                best.setdefault(q, set()).add((-s, c))
    return sorted((q, n, c, -s) for q, found in best.items()
                  for n, (s, c) in enumerate(sorted(found)[:k], 1))


def plain_links(rows, cosine):
    links = []
    good = [i for i, (_, v, label) in enumerate(rows) if usable(v) and any(v) and label is not None]
    for x, i in enumerate(good):
        for j in good[:x]:
            (_, v, a), (_, w, b) = rows[i], rows[j]
            if a == b and len(v) == len(w):
                p, q = np.array(v) / max(map(abs, v)), np.array(w) / max(map(abs, w))
                if p @ q / math.sqrt((p @ p) * (q @ q)) >= cosine:
                    links.append((j, i))
    root = brute.groups(range(len(rows)), links)
    ids = {}
    for i, (name, *_) in enumerate(rows):
        ids.setdefault(root[i], []).append(name)
    out = []
    for i, (name, *_) in enumerate(rows):
        named = [n for n in ids[root[i]] if n is not None]
        component = min(named) if named else None
        out.append((name, sum(i in p for p in links), component, name == component))
    return sorted(out, key=str)


def clustered(seed, n, size=16, hot=0):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(8, size))
    rows = []
    for i in range(n):
        v = centres[0] if i < hot else centres[pick.integers(8)] + pick.normal(size=size) * pick.choice(
            [0.02, 0.1, 0.25])
        rows.append((int(i * 5), [float(x) for x in v.astype(np.float32)], str(pick.integers(2))))
    return rows


def test_top_k_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).withColumns({"score": F.lit(1), "rank": F.lit("r"), "q": F.lit(0)})
    rows = [(i, [x if x is None or abs(x) < 1e9 else 3.0 for x in v] if v else v, k) for i, v, k in ODD]
    small = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, top_k(small, F.col("vec_id") % 2 == 0, 3).collect()))
    assert got == plain_top_k([(i, v if not v or all(x is None or math.isfinite(x) for x in v) else None, k)
                               for i, v, k in rows], lambda q: q % 2 == 0, 3)
    with pytest.raises(Exception, match="64 bits"):
        top_k(df, F.col("vec_id") % 2 == 0).collect()
    assert top_k(df.where("false"), F.lit(True)).count() == 0
    assert top_k(df.where("vec_id < 9"), F.col("vec_id") > 99).count() == 0


def test_products_of_any_size_are_exact():
    for big in (5, 2 ** 25, 2 ** 30):
        a = np.array([[big, 1, 0], [0, -2, 3]])
        assert search._products(a, a[:1]).tolist() == [[big * big + 1], [-2]]
    with pytest.raises(OverflowError):
        search._products(np.array([[2 ** 32]]), np.array([[2 ** 32]]))
    assert search._products(np.zeros((0, 2), int), a[:, :2]).shape == (0, 2)


@pytest.mark.parametrize("bits", [0, 21])
def test_top_k_in_tiles(spark, monkeypatch, bits):
    monkeypatch.setattr(search, "SHARD_TILE", 20)
    monkeypatch.setattr(search, "QUERY_TILE", 7)
    monkeypatch.setattr(search, "FAN_IN", 3)
    pick = random.Random(bits)
    rows = [(i, [float(pick.randint(-2, 2) * 2 ** bits) / 8 for _ in range(5)], "") for i in range(300)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % 9 == 0, 5).collect()))
    assert got == plain_top_k(rows, lambda q: q % 9 == 0, 5)


def test_top_k_in_bounded_cells(spark, monkeypatch):
    for name, value in {"SHARD_TILE": 8, "QUERY_TILE": 4, "FAN_IN": 2, "PACK_BYTES": 300, "CELL_BYTES": 400}.items():
        monkeypatch.setattr(search, name, value, raising=False)
    pick = random.Random(5)
    rows = [(pick.randrange(150), [pick.randint(-2, 2) * pick.choice([0.25, 300.0]) for _ in range(pick.choice([2, 3]))],
             "") for _ in range(260)]
    rows += rows[:30] + [(7, [8388608.0, 0.0, 0.0, 0.0], ""), (21, [8388608.0, 0.0, 0.0, 1.0], "")]
    found = top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 7 == 0, 4)
    assert sorted(map(tuple, found.collect())) == plain_top_k(rows, lambda q: q % 7 == 0, 4)


def test_top_k_never_broadcasts_the_copies_of_a_side(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10MB")          # far less than the copies that all shards need
        rows = spark.range(0, 30000, 1, 4).selectExpr(
            "id AS vec_id", "transform(sequence(0, 15), i -> sin(id * 17 + i * i)) AS embedding")
        found = top_k(rows, F.col("vec_id") % 10 == 0, 2)
        assert found.count() == 6000
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)


def test_cells_are_bounded_and_copies_few():
    for rows, asked, size in ((15_000_000, 300_000, 64), (615_384, 12_308, 64), (10 ** 6, 10 ** 6, 64),
                              (4000, 4000, 4096), (10 ** 6, 1, 768), (0, 0, 0)):
        shards, blocks = search._grid(rows, asked, 2 * rows * size, 2 * asked * size, 24)
        assert 2 * rows * size <= shards * search.CELL_BYTES and 2 * asked * size <= blocks * search.CELL_BYTES
        assert shards * asked + blocks * rows <= max(search.COPIES * (rows + asked), 2 * rows * asked * size * 2.1 * 2
                                                     / search.CELL_BYTES)
        assert shards * blocks < 48 or shards * search.CELL_BYTES < 4 * rows * size
    assert search._grid(615_384, 12_308, 128 * 615_384, 128 * 12_308, 24)[0] >= 24


def test_links_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).withColumns({"cell": F.lit(1), "class": F.lit("x"), "kept": F.lit(2)})
    got = near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == plain_links(ODD, 0.93)
    assert near_vectors(df.where("false")).count() == 0


@pytest.mark.parametrize("cell", [4000, 40, 7])
def test_links_match_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(range_join, "CELL", cell)
    rows = clustered(cell, 260, hot=60)
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    want = plain_links(rows, 0.93)
    assert sorted(map(tuple, got), key=str) == want and max(w[1] for w in want) > 30


def test_cells_leave_vectors_out(spark):
    pivots = {2: np.array([[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]])}
    units = [np.array([math.cos(a), math.sin(a)]) for a in np.linspace(0, 2 * math.pi, 60)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(60)), pa.array(["a"] * 60), pa.array([2] * 60, pa.int32()), pa.array([1] * 60),
         pa.array([u.tobytes() for u in units])], ["class", "label", "size", "copies", "vector"])
    radius = math.sqrt(2 - 2 * 0.93)
    (cells,) = range_join._cells(batch, pivots, 2 * radius)
    sent = {}
    for row in cells.to_pylist():
        sent.setdefault(row["cell"], {})[row["class"]] = row["home"]
    assert sum(map(len, sent.values())) < 150
    for members in sent.values():
        for x in (c for c, home in members.items() if home):
            near = {y for y in range(60) if np.linalg.norm(units[x] - units[y]) <= radius}
            assert near <= set(members)


# ---------------------------------------------------------------- archives

def plain_records(rows):
    newest = {}
    for i, _, page in rows:
        data = (page or "").encode()
        if len(data) >= 1000 and i is not None:
            newest[data] = max(i, newest.get(data, i))
    out = []
    for i, _, page in rows:
        data = (page or "").encode()
        first = newest.get(data)
        again = first is not None and i != first
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=str)


def pages(seed=1):
    pick = random.Random(seed)
    big = ["<p>" + "".join(pick.choices("abc é<", k=n)) for n in (998, 1200, 90000)]
    rows = [(i, f"http://x/{i}", pick.choice([*big, "", "small", None])) for i in range(80)]
    return rows + [(None, None, big[1]), (79, "http://x/79", rows[79][2]), (200, "bad\r\nurl: ü", big[2]),
                   (201, "", "WARC/1.1\r\n\r\n" * 200), (202, "u", "WARC/1.1\r\n\r\n" * 200)]


def test_archives_read_back(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    files = warc.write_archives(df.repartition(3), str(tmp_path / "out"))
    back = warc.read_archives(files)
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == plain_records(rows)
    held = {r["payload_digest"]: r["payload"] for r in back.collect() if r["payload"] is not None}
    assert set(held) == {r["payload_digest"] for r in got}
    assert all(hashlib.sha1(p).hexdigest() == d for d, p in held.items())
    assert files.agg(F.sum("records")).first()[0] == len(rows)


def test_records_are_frames_of_their_own(spark, tmp_path, monkeypatch):
    import struct
    import zstandard
    df = spark.createDataFrame(pages(2), "page_id long, url string, html string").coalesce(1)
    (row,) = warc.write_archives(df, str(tmp_path / "one")).collect()
    data = open(row["path"], "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 0
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    at, frames = 8 + size, 0
    while at < len(data):
        one = unpack.decompressobj()
        text = one.decompress(data[at:])
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        at, frames = len(data) - len(one.unused_data), frames + 1
    assert frames == row["records"] == 85


def test_small_and_empty_archives(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")
    (row,) = warc.read_archives(warc.write_archives(df, str(tmp_path / "a"))).collect()
    assert (row["page_id"], row["url"], row["payload_bytes"], row["record_type"]) == (1, None, 0, "response")
    none = warc.write_archives(df.where("false"), str(tmp_path / "b"))
    assert none.count() == 0 and warc.read_archives(none).count() == 0


def test_damaged_archives_are_refused(spark, tmp_path):
    df = spark.createDataFrame(pages(3), "page_id long, url string, html string").coalesce(1)
    (row,) = warc.write_archives(df, str(tmp_path / "c")).collect()
    data = open(row["path"], "rb").read()
    (tmp_path / "cut").write_bytes(data[:len(data) - 5])
    with pytest.raises(Exception):
        list(warc.read_file(str(tmp_path / "cut")))
    (tmp_path / "plain").write_bytes(b"WARC/1.1 no dictionary")
    with pytest.raises(ValueError):
        list(warc.read_file(str(tmp_path / "plain")))


def test_a_payload_of_very_many_pages_is_split(spark):
    names = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        pages = spark.range(0, 8000, 1, 8).selectExpr(
            "id AS page_id", "if(id % 3 > 0, repeat('0', 1200), CAST(id AS STRING)) AS html")
        marked = warc.with_revisits(pages).select("page_id", "kind", "refers_to")
        got = {r["page_id"]: (r["kind"], r["refers_to"]) for r in marked.collect()}
        newest = max(i for i in range(8000) if i % 3 > 0)
        assert got == {i: ("revisit", newest) if i % 3 > 0 and i < newest else ("response", None)
                       for i in range(8000)}
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
