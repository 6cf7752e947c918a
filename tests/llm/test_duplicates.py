import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidyforge.llm.links import components
from tidyforge.llm.ngram_join import _forest, _products, jaccard_classes
from tidyforge.llm.repeats import remove_repeats

ROWS = list(enumerate(brute.ODD_TEXTS, start=10))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def copies(seed, groups=12, size=14, low=1, high=60):
    """Documents with near copies, chains of edits and shared passages."""
    pick = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for _ in range(groups):
        base = [f"v{pick.randrange(4000)}" for _ in range(pick.randint(low, high))]
        if pick.random() < 0.4:
            base[1:1] = passage[:pick.randint(30, 50)]
        rows.append(base)
        for _ in range(size):
            other = list(pick.choice(rows[-3:]))
            for _ in range(pick.randint(0, 3)):
                other[pick.randrange(len(other))] = f"v{pick.randrange(4000)}"
            rows.append(other)
    pick.shuffle(rows)
    return [(i * 3, " ".join(r)) for i, r in enumerate(rows)]


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_components(spark):
    pick = random.Random(3)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(150)] + [
        (1000 + i, 1001 + i) for i in range(40)] + [(7, 2000 + i) for i in range(60)]
    df = spark.createDataFrame([*links, (None, 4), (5, 5)], "a long, b long")
    want = brute.groups({n for pair in links for n in pair if pair[0] != pair[1]},
                        [p for p in links if p[0] != p[1]])
    assert tuples(components(df), "node", "component") == sorted(want.items())
    assert components(df.where("a < 0")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_matches_brute_force(spark, seed):
    rows = copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(jaccard_classes(df), "doc_id", "n_shingles", "component_id") == (
        brute.jaccard_components(rows))


def test_jaccard_in_tiles(spark, monkeypatch):
    monkeypatch.setattr("tidyforge.llm.ngram_join.TILE_DOCS", 5)
    monkeypatch.setattr("tidyforge.llm.ngram_join.BLOCK_CELLS", 640)
    rows = copies(5, groups=4, size=60, low=40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(jaccard_classes(df), "doc_id", "n_shingles", "component_id") == (
        brute.jaccard_components(rows))


def test_products_by_column_blocks(monkeypatch):
    import numpy as np
    monkeypatch.setattr("tidyforge.llm.ngram_join.BLOCK_CELLS", 64 * 64)
    pick = np.random.default_rng(1)
    base = pick.choice(5000, 200, replace=False)
    sets = [np.unique(np.concatenate([pick.choice(base, int(pick.integers(178, 200)), replace=False),
                                      pick.choice(5000, 12)])).astype(np.uint64)
            for _ in range(60)]
    alive, linked = _products(sets, 80)
    got = {tuple(sorted(map(int, p))) for p in alive[np.argwhere(linked)]}
    want = {(i, j) for i in range(60) for j in range(i + 1, 60)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(
                sets[i], sets[j]))}
    assert got == want and 0 < len(want) < 1770


def test_jaccard_bound_is_exact(spark):
    # 4 of 5 shingles (linked) and 19 of 24 (not linked)
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"),
            (3, " ".join(f"k{i}" for i in range(25))),
            (4, " ".join(f"k{i}" for i in range(23)) + " z y x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(jaccard_classes(df), "doc_id", "n_shingles", "component_id") == (
        brute.jaccard_components(rows))


def test_jaccard_odd_rows(spark, odd):
    extra = odd.withColumns({"set_id": F.lit("x"), "component": F.lit(1), "n": F.lit(None)})
    assert tuples(jaccard_classes(extra), "doc_id", "n_shingles", "component_id") == (
        brute.jaccard_components(ROWS))
    assert jaccard_classes(odd.where("doc_id < 0")).count() == 0
    unnamed = spark.createDataFrame([(None, "a b c"), (4, "A b c"), (None, "z"), (4, "a b c")],
                                    "doc_id long, text string")
    got = [tuple(r) for r in jaccard_classes(unnamed).select("doc_id", "component_id").collect()]
    assert sorted(got, key=str) == [(4, 4), (4, 4), (None, 4), (None, None)]


@pytest.mark.parametrize("window", [35, 7, 1])
def test_repeats_match_brute_force(spark, odd, window):
    got = remove_repeats(odd, window=window).select("doc_id", "n_words", "n_removed", "text")
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.repeats_removed(ROWS, window))


def test_repeats_of_passages(spark):
    rows = copies(9, groups=10, size=6, low=60, high=160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(df).select("doc_id", "n_words", "n_removed", "text")
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.repeats_removed(rows))


def test_repeats_keep_layout_and_columns(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(1, " a\n b ", 5), (2, f"x\n{line}\n\ny", 6), (3, line, 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = remove_repeats(df, layout=True)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed"]
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(
        [(1, " a\n b ", 2, 0), (2, "x y", 42, 40), (3, "", 40, 40), (None, None, 0, 0)],
        got.schema).collect()))
    assert remove_repeats(df.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 24, 25, 80])
def test_blocks_of_any_size_keep_every_link(n):
    """Pairs, a chain and a star that touch no other set, in blocks of few and many sets."""
    pick = np.random.default_rng(n)
    sets = []
    for i in range(n):
        base = sets[0] if i % 5 == 4 else sets[-1] if i % 2 else np.unique(pick.integers(0, 2**62, 60))
        own = base.copy()
        own[:5] = pick.integers(0, 2**62, 5)
        sets.append(np.unique(own).astype(np.uint64))
    links = [(i, j) for i in range(n) for j in range(i) if 100 * len(np.intersect1d(
        sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    want = brute.groups(range(n), links)
    members, roots = _forest(sets, 80)
    assert brute.groups(range(n), zip(members.tolist(), roots.tolist())) == want
