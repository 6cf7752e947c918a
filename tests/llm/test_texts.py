import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tidyforge.llm import language_model, packing
from tidyforge.llm.coded_tables import CodedTable, distinct, parted, write_coded
from tidyforge.llm.main_text import (Scanner, best_region, count_labelled, extract_main_text,
                                     learn_weights, main_text)
from tidyforge.llm.mixing import budgets, mix_documents, mix_plan, word_count
from tidyforge.llm.queries import QUERIES, fold
from tidyforge.llm.toxicity import Restorer, count_letters, score_toxicity
from tidyforge.llm.words import find_words

ROWS = list(enumerate(brute.ODD_TEXTS, start=10))
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", i) for i, t in ROWS]
    return spark.createDataFrame([*rows, rows[7], (None, "lost id", "s1", 1)],
                                 "doc_id long, text string, source string, score int")


# ---------------------------------------------------------------- toxicity

MILD = "the of and to in is that for with as on was by at be this from are or an".split()
NASTY = ["blockhead", "numskull", "dimwit", "lowlife"]


def toxic_corpus(n, seed=5):
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [pick.choice(MILD) + pick.choice(["", "ing", "er"]) for _ in range(pick.randint(5, 60))]
        bad = int(pick.random() < 0.25)
        for _ in range(bad * pick.randint(1, 3)):
            words.insert(pick.randrange(len(words)), pick.choice(NASTY))
        rows.append((i, " ".join(words)))
        labels.append((i, bad))
    return rows, labels


def test_restores_leetspeak_spacing_and_repetition(spark):
    rows, _ = toxic_corpus(400)
    restorer = Restorer(count_letters(spark.createDataFrame([(t,) for _, t in rows], "text string")))
    for written, word in {"bl0ckhead": "blockhead", "n.u.m.s.k.u.l.l": "numskull", "d1mw1t!!": "dimwit",
                          "DIMWIT,": "dimwit", "l-o-w-l-i-f-e": "lowlife", "diiiimwit": "dimwit",
                          "b|ockhead": "blockhead", "bl*ckhead": "blockhead", "(the)": "the",
                          "the***": "the", "lo​wlife": "lowlife", "ｄｉｍｗｉｔ": "dimwit"}.items():
        assert restorer.word(written) == (word,), written
    assert restorer.word("***") == () == restorer.word("2024")
    assert "dimwit" in restorer.words("you d i m w i t again")
    assert restorer.text("a  bl0ckhead, is") == "a blockhead is"
    for long in ("x " * 100_000, "ab0c" * 30_000, "l" * 100_000, "a*b" * 3000):
        assert restorer.words(long) and restorer.text(long)


RUDE = "idiot loser trash shit ass dumbass".split()


@pytest.fixture(scope="module")
def rude(spark):
    """Rows of the toxic corpus with ruder words, and their labels."""
    rows, labels = toxic_corpus(900)
    pick = random.Random(6)
    return [(i, " ".join(pick.choice(RUDE) if w in NASTY else w for w in t.split()))
            for i, t in rows], labels


def test_signs_at_the_ends_are_letters(spark, rude):
    restorer = Restorer(count_letters(spark.createDataFrame([(t,) for _, t in rude[0]], "text string")))
    for written, word in {"!diot": "idiot", "|oser": "loser", "+rash": "trash", "shi+": "shit",
                          "a$$": "ass", "dumba$$": "dumbass", "$hit": "shit", "the***": "the",
                          "loser!!": "loser", "loser!": "loser", "idiot###": "idiot"}.items():
        assert restorer.word(written) == (word,), written
    for written, word in {"|loser|": "loser", "+idiot": "idiot", "$$$trash$$$": "trash"}.items():
        assert word in restorer.words(written), written


def test_words_of_signs_alone(spark, rude):
    restorer = Restorer(count_letters(spark.createDataFrame([(t,) for _, t in rude[0]], "text string")))
    for written in ("@$$", "455", "4$$", "@$$!!", "(455)"):
        assert restorer.word(written) == ("ass",), written
    for written in ("2024", "1,200", "$100", "+49", "50€", "$$", "!!!", "|", "7", "--", "***"):
        assert restorer.word(written) == (), written


def test_scores_of_disguises_at_the_ends_and_without_letters(spark, rude):
    rows, labels = rude
    hidden = ["the !diot is", "that |oser was", "an a$$ for", "is +rash", "loser!! the", "|loser| is",
              "the @$$ was", "from 455"]
    clean = ["the*** of 2024!", "that is $100, +49 or 50€", "!!! *** $$ the"]
    docs = spark.createDataFrame(rows + list(enumerate(hidden + clean, start=5000)), "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = {r["doc_id"]: r["score"] for r in score_toxicity(docs, told).collect()}
    assert [scored[5000 + k] >= 0.5 for k in range(11)] == [True] * 8 + [False] * 3


def test_scores_follow_held_out_labels(spark):
    rows, labels = toxic_corpus(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = score_toxicity(docs, told, fold() != 0).join(told, "doc_id").withColumn("f", fold())
    held = scored.where("f = 0").collect()
    assert len(held) > 100 and all((r["score"] >= 0.5) == bool(r["toxic"]) for r in held)
    # labels of the held-out fold have no influence
    other = told.withColumn("toxic", F.when(fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = score_toxicity(docs, other, fold() != 0)
    assert sorted(map(tuple, again.collect())) == sorted((r[0], r["text"], r["score"]) for r in scored.collect())


def test_disguised_words_score_like_plain_ones(spark):
    rows, labels = toxic_corpus(900)
    hidden = ["the bl0ckhead is", "that n-u-m-s-k-u-l-l was", "an d i m w i t for", "lowwwwlife"]
    clean = ["the 3rd of 2024", "e.g. this, from", "that *** was $5!", ""]
    docs = spark.createDataFrame(rows + list(enumerate(hidden + clean, start=5000)), "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = {r["doc_id"]: r["score"] for r in score_toxicity(docs, told).collect()}
    assert [scored[5000 + k] >= 0.5 for k in range(8)] == [True] * 4 + [False] * 4


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(11, 1), (12, 0), (13, None), (None, 1), (12, 0)], "doc_id long, toxic int")
    scored = score_toxicity(odd, labels, restored="restored")
    assert scored.columns == ["doc_id", "text", "source", "score", "restored"]
    assert scored.count() == odd.count() and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    unlabelled = score_toxicity(odd, labels.where("false"))
    assert unlabelled.select("score").distinct().count() == 1
    assert score_toxicity(odd.where("false"), labels).count() == 0


# ---------------------------------------------------------------- language model

def kneser_ney(training, order):
    """(probability function, words' counts) of a model counted with plain dictionaries."""
    def tokens(text):
        return ["<s>"] * (order - 1) + brute.words((text or "").translate(brute.LOWER)) + ["</s>"]
    counts, texts = {order: Counter()}, [tokens(text) for text in training]

    def occurrences(gram):
        return sum(tuple(own[i:i + len(gram)]) == gram for own in texts for i in range(len(own)))

    for own in texts:
        counts[order].update(tuple(own[i - order + 1:i + 1]) for i in range(order - 1, len(own)))
    raw = Counter()
    for gram, n in counts[order].items():
        raw[gram[-1]] += n
    for k in range(order - 1, 0, -1):
        counts[k] = Counter()
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += occurrences(gram) if k > 1 and gram[1] == "<s>" else 1
    off = {}
    for k, own in counts.items():
        n = [sum(1 for c in own.values() if c == i) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        found = [y] * 3
        if min(n) > 0:
            exact = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
            if all(0 < d < i for i, d in enumerate(exact, 1)):
                found = exact
        off[k] = found

    def discount(k, c):
        return off[k][min(c, 3) - 1] if c else 0.0

    def chance(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        own = [c for g, c in counts[k].items() if g[:-1] == gram[:-1]]
        if not own:
            return chance(gram[1:])
        left = sum(discount(k, c) for c in own) / sum(own)
        c = counts[k][gram]
        return max(c - discount(k, c), 0) / sum(own) + left * chance(gram[1:])

    def score(text):
        own = tokens(text)
        return sum(math.log10(chance(tuple(own[i - order + 1:i + 1]))) for i in range(order - 1, len(own)))
    return score, raw


@pytest.mark.parametrize("order,rare", [(1, 0), (2, 0), (3, 0), (1, 70), (2, 70), (3, 70), (4, 70)])
def test_model_matches_plain_kneser_ney(spark, order, rare):
    pick = random.Random(order)
    words = "a b c d e f g h".split() + [f"w{i}" for i in range(rare)]    # some split, some not
    rows = [(i, " ".join(pick.choices(words, [*range(8, 0, -1)] + [1] * rare, k=pick.randint(0, 30))))
            for i in range(60)] + [(60, None), (61, "A zz \n b"), (62, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = language_model.fit(docs, F.col("doc_id") % 3 != 0, order=order)
    score, raw = kneser_ney([t for i, t in rows if i % 3], order)
    assert model.tokens == sum(raw.values()) and model.types == len(raw)
    got = {r["doc_id"]: r for r in language_model.score(docs, model).collect()}
    for i, text in rows:
        own = brute.words((text or "").translate(brute.LOWER)) + ["</s>"]
        base = sum(math.log10((raw[w] + 0.5) / (model.tokens + 0.5 * (len(raw) + 1))) for w in own)
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(raw[w] > 0 for w in own))
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score(text), rel=1e-9)


def test_words_with_many_followers_are_split(spark):
    docs = spark.createDataFrame([(i, f"x a y{i} a z{i} q{i % 7}") for i in range(90)], "doc_id long, text string")
    deal = language_model.fit(docs, F.lit(True)).deal
    ids, ends, _ = language_model.token_ids(find_words(pa.array(["x a y1 a z1 q1"])), 2)
    split = deal.is_split(ids[ends - 1])         # the words before each token: start, x, a, y1, a, z1, q1
    assert split.tolist() == [True, True, True, False, True, False, False]
    last = np.arange(1, 65, dtype=np.uint64)
    assert len(set(deal.shards(np.full(64, ids[2]), last).tolist())) > 1
    assert len(set(deal.shards(np.full(64, ids[3]), last).tolist())) == 1


@pytest.mark.parametrize("size", [0, 1, 15, 5000])
def test_coded_tables_return_every_row(tmp_path, size):
    make = np.random.default_rng(size)
    keys = np.unique(make.integers(0, 2 ** 64, 2 * size, np.uint64))
    present, absent = keys[::2], keys[1::2]
    if size:
        present = np.unique(np.concatenate([present, np.array([0, 2 ** 64 - 1], np.uint64)]))
    columns = [make.integers(0, 2 + size // 9, len(present)), make.integers(0, 2 ** 62, len(present))]
    write_coded(str(tmp_path / "3"), present, columns)
    table = CodedTable(str(tmp_path), [3], 2)
    asked = make.permutation(np.concatenate([present, absent]))
    found = table.search(asked, np.full(len(asked), 3))
    want = dict(zip(present.tolist(), zip(*(c.tolist() for c in columns))))
    assert [tuple(r) for r in found.tolist()] == [want.get(k, (0, 0)) for k in asked.tolist()]
    assert not table.search(present, np.full(len(present), 4)).any()


def test_scoring_keeps_one_core_busy(spark):
    make = np.random.default_rng(3)
    texts = [" ".join(map(str, make.zipf(1.3, 500))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    model = language_model.fit(docs, F.lit(True))
    ids, ends, _ = language_model.token_ids(find_words(pa.array(texts)), 3)
    model.probabilities(ids, ends)                   # maps the tables
    wall, cpu = time.perf_counter(), time.process_time()
    for _ in range(5):
        model.probabilities(ids, ends)
    assert time.process_time() - cpu < 1.5 * (time.perf_counter() - wall)


@pytest.mark.parametrize("size,shards", [(0, 8), (1, 8), (500, 8), (500, 1 << 20)])
def test_keys_are_grouped_in_their_order(size, shards):
    make = np.random.default_rng(size)
    keys = make.integers(0, 100, size, np.uint64) << np.uint64(57)
    found, first, again = distinct(keys)
    assert found.tolist() == sorted(set(keys.tolist()))
    assert keys[first].tolist() == found.tolist() and found[again].tolist() == keys.tolist()
    shard = make.integers(0, shards, size)
    assert {s: at.tolist() for s, at in parted(shard)} == {
        s: np.flatnonzero(shard == s).tolist() for s in sorted(set(shard.tolist()))}


def test_model_probabilities_add_up(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b c c a d")], "doc_id long, text string")
    model = language_model.fit(docs, F.lit(True))
    texts = spark.createDataFrame([(w,) for w in ["a", "b", "c", "d", "", "new"]], "text string")
    # P(first word) times P(end): divide by the score of the end after that word
    words = {r["text"]: r["score"] for r in language_model.score(texts, model).collect()}
    total = 0
    for w in words:
        ids, ends, _ = language_model.token_ids(find_words(pa.array([w])), 2)
        total += model.probabilities(ids, ends[:1])[0][0]
    assert total == pytest.approx(1)


def test_model_odd_rows(spark, odd):
    scored = language_model.score(odd, language_model.fit(odd, F.lit(True)))
    assert scored.count() == odd.count() and scored.where("score > 0 OR score IS NULL").count() == 0
    empty = language_model.fit(odd.where("false"), F.lit(True))
    assert empty.tokens == 0
    assert {(r["base_score"], r["score"]) for r in language_model.score(odd, empty).collect()} == {(0.0, 0.0)}
    assert language_model.score(odd.where("false"), empty).count() == 0


def test_held_out_score_beats_single_words(spark):
    got = QUERIES["op4_language_model"](spark, FOLDER).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]


def test_query_scores_words_after_two_others(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    model = language_model.fit(docs, fold() != 1, order=3)
    want = {r["doc_id"]: r["score"] for r in language_model.score(docs, model).collect()}
    got = {r["doc_id"]: r["score"] for r in QUERIES["op4_language_model"](spark, FOLDER).collect()}
    assert got == pytest.approx(want)


# ---------------------------------------------------------------- packing

def check_packing(rows, capacity=2048):
    """Sequences have no gap, are not too long, and none is padded."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0


def test_packing_returns_every_id_once(spark, odd):
    rows = packing.pack(odd, TOKENIZER).collect()
    check_packing(rows)
    own, texts, seen = Tokenizer.from_file(TOKENIZER), {}, Counter()
    for r in odd.collect():                              # one row occurs twice
        texts.setdefault(r["doc_id"], []).append(own.encode(
            r["text"] or "", add_special_tokens=False).ids + [1])
    for r in rows:
        part = np.frombuffer(r["ids"], "<u4").tolist()
        whole = texts[r["doc_id"]][0]
        assert part == whole[r["start"]:r["start"] + r["length"]] and len(part) == r["length"]
        assert r["doc_tokens"] == len(whole)
        seen.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
    assert seen == Counter({(i, k): len(c) for i, c in texts.items() for k in range(len(c[0]))})
    assert packing.pack(odd.where("false"), TOKENIZER).count() == 0


def test_ids_equal_those_of_the_tokenizers_library():
    own, fast = Tokenizer.from_file(TOKENIZER), packing.encoding(TOKENIZER)
    texts = [t or "" for t in brute.ODD_TEXTS] + [
        "don't  we'll\t\n  x y　z", "\x00\x01 a", "1234567890 ½ ²", "🎉🎉 naïve—dash", "a" * 5000,
        "<|endoftext|>x<|endof", " leading and trailing ", "\r\n\r\n", "मानक हिन्दी 中文字符", "​﻿"]
    for t in texts:
        assert fast.encode(t, allowed_special="all") == own.encode(t, add_special_tokens=False).ids


def test_fullest_is_the_best_multiset():
    pick = random.Random(2)
    for _ in range(60):
        lengths = Counter(pick.randint(1, 60) for _ in range(pick.randint(0, 9)))
        space = pick.randint(0, 150)
        sums = {0: Counter()}
        for length in lengths.elements():
            sums |= {s + length: c + Counter([length]) for s, c in list(sums.items())
                     if s + length not in sums and s + length <= space}
        best, chosen = packing.fullest(dict(lengths), space)
        assert best == max(sums) == sum(k * n for k, n in chosen.items())
        assert all(n <= lengths[k] for k, n in chosen.items())


def test_packing_query_over_the_table(spark):
    rows = QUERIES["op3_packing"](spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    check_packing(rows)
    own, parts = Tokenizer.from_file(TOKENIZER), {}
    for r in rows:
        parts.setdefault(r["doc_id"], []).append(r)
    assert set(parts) == set(texts)
    for i, pieces in parts.items():
        ids, at = own.encode(texts[i], add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert zlib.crc32(np.array(ids[r["start"]:at], "<u4").tobytes()) == r["ids_crc32"]
        assert at == len(ids)


# ---------------------------------------------------------------- mixing

def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        for s in full or free:
            target[s] = most * sizes[s] if full else weight[s] * level
        if not full:
            break
        left -= sum(target[s] for s in full)
        free -= full
    return target


def test_budgets_match_plain_water_filling(spark):
    pick = random.Random(4)
    for n in (1, 2, 5, 17):
        sizes = {None if i == 3 else f"s{pick.randrange(999)}é": pick.randint(0, 5000) for i in range(n)}
        df = spark.createDataFrame([(s, k) for s, k in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in budgets(df).collect()}
        want = water_fill(sizes)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_mix_reaches_its_targets(spark, odd):
    plan = mix_plan(odd).collect()
    assert len(plan) == odd.count()
    texts = Counter((r["doc_id"], len(brute.words(r["text"]))) for r in odd.collect())
    assert Counter((r["doc_id"], r["size"]) for r in plan) == texts
    for s in {r["source"] for r in plan}:
        own = [r for r in plan if r["source"] == s]
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1.5
    again = mix_plan(odd.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, plan))
    assert mix_plan(odd.where("false")).count() == 0


def test_mixed_documents_are_the_plan(spark, odd):
    mixed = mix_documents(odd)
    assert mixed.columns == odd.columns
    got, texts = Counter(), {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    for r in mixed.collect():
        got[r["doc_id"]] += len(brute.words(r["text"]))
        assert any(t and (r["text"] == t or brute.words(t)[:len(brute.words(r["text"]))] == brute.words(
            r["text"])) for t in texts[r["doc_id"]])
    want = Counter()
    for r in mix_plan(odd).collect():
        want[r["doc_id"]] += r["taken"]
    assert +got == +want
    assert mix_documents(odd.where("false")).count() == 0


def test_mixing_uses_no_python(spark, odd):
    for df in (mix_plan(odd), mix_documents(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    counts = odd.select("text", word_count(F.col("text")).alias("n")).collect()
    assert all(r["n"] == len(brute.words(r["text"])) for r in counts)


# ---------------------------------------------------------------- main text

PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><a href=/>no no no</a></header><nav><ul><li><a>no</a></li></ul></nav>
<div class="cookie-notice">no we use cookies no no</div><article><h1>Main  title</h1>
<p>First &amp; <b>bold</b> te<i>x</i>t<br>next <a href="x">linked</a> line &copy; 2024</p>
<form><input value=no><button>no</button><label>no</label></form><!-- no --><aside>no no</aside>
<ul><li>one</li><li>two</li></ul><p>Last\n\twords</p></article>
<section id="comments"><p>no a comment that is long and has many many words in it no</p></section>
<div class="sidebar"><p>no</p></div><footer>no &copy;</footer></body></html>"""
TEXT = "Main title\n\nFirst & bold text next linked line © 2024\n\none\n\ntwo\n\nLast words"


def test_main_text_of_an_unknown_template():
    assert main_text(PAGE, Scanner()) == TEXT
    import re
    plain = re.sub("<form>.*</aside>", "", PAGE, flags=re.S).replace("article>", "div>")
    assert main_text(plain, Scanner()) == TEXT
    for page in ("", "<", "<p", "<nav>no</nav>", "<script>x", "<!-- <p>x</p>", "</p></div>", "&amp"):
        assert main_text(page, Scanner()) in ("", "<", "<p", "&")
    assert main_text("just text", Scanner()) == "just text"
    assert main_text("<p>a<p>b<div>c</div>d", Scanner()) == "a\n\nb\n\nc\n\nd"
    assert main_text("<p title='a>b'>x</p>", Scanner()) == "x"


def test_comments_and_adverts_inside_articles():
    page = ("<main><article class='post'><h1>T</h1><p>" + "story words " * 9 + "</p><div class='ad-slot'>no buy</div>"
            "<p>more</p></article><div id=comments><article class=comment><p>" + "no reply " * 40
            + "</p></article></div><article class='related-teaser'><p>" + "no " * 90 + "</p></article></main>")
    assert main_text(page, Scanner()) == "T\n\n" + " ".join(["story words"] * 9) + "\n\nmore"
    page = "<body><div class=content><table><tr><td>a b</td><td>c</td></tr></table><pre>x\n y</pre></div></body>"
    assert main_text(page, Scanner()) == "a b\n\nc\n\nx y"


def test_all_names_of_an_element_are_read():
    names = "flex flex-col gap-4 items-center lg:w-1/4 mt-4 p-4 rounded"
    for last in ("sidebar", "social", "widget", "z-10 sidebar"):
        page = f"<div class=story><p>{'words ' * 9}</p></div><div class='{names} {last}'><p>not this</p></div>"
        assert main_text(page, Scanner()) == " ".join(["words"] * 9)
    page = f"<main><article class='{names} widget'><p>{'no ' * 9}</p></article><p>{'words ' * 9}</p></main>"
    assert main_text(page, Scanner()) == " ".join(["words"] * 9)


def test_text_after_icons_and_custom_elements():
    for tag in ("<svg class=x />", "<svg/>", '<svg-icon n="x"></svg-icon>', "<svg><path d='z'/><text>no</text></svg>",
                "<object-view></object-view>", "<title-bar></title-bar>", "<math/>", "<script-x></script-x>",
                "<style>no</style >", "<object data=x>no</object>", "<iframe src=x></iframe>"):
        assert main_text(f"{tag}<p>the article</p>", Scanner()) == "the article", tag
        assert main_text(f"<article><p>one {tag} two</p><p>three</p></article>", Scanner()) == (
            "one two\n\nthree"), tag
    page = ("<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><mspace/><annotation encoding='t'>x=2</annotation>"
            "</math> holds</p><p>next</p>")
    assert main_text(page, Scanner()) == "where x=2 holds\n\nnext"


def test_weights_are_learned_from_labelled_pages(spark):
    page = ("<body><div class=promo>{0}</div><div class=story><article><p>{1}</p></article></div>"
            "<div class=zz9>{0}</div></body>")
    rows = [(i, page.format("buy it now " * 5, "a true story " * 9)) for i in range(20)]
    weights = learn_weights(spark.createDataFrame(rows, "page_id long, html string"))
    assert weights["div.zz9"] < -1 and weights["div.story"] > 1 and weights["p"] > 1
    assert main_text("<div class=zz9>" + "no " * 90 + "</div><p>yes it is</p>", Scanner(weights)) == "yes it is"


def test_extraction_keeps_rows_and_columns(spark):
    rows = [(1, "u", PAGE, 3), (1, "u", PAGE, 3), (None, None, None, None), (2, "", "", 4),
            (3, "v", "<p>" + "w " * 90000 + "</p>", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "html", "text"]
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in got.collect()) == [
        (0, 0), (1, len(TEXT)), (1, len(TEXT)), (2, 0), (3, 179999)]
    assert extract_main_text(df.where("false")).count() == 0


def test_main_text_of_the_table(spark):
    import html
    import re
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").join(
            QUERIES["op7_main_text"](spark, FOLDER), "page_id").collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


ARTICLE = "<h1>T</h1>" + "<p>" + " ".join(["story words"] * 30) + "</p><p>and more</p>"
MENU = "<nav><ul><li><a href=a>Home</a></li></ul></nav>"
BELOW = '<div class="comments"><p>' + "me too " * 20 + "</p></div><footer>site name</footer>"


@pytest.mark.parametrize("page", [
    f'<html><body class="single-post has-sidebar">{MENU}{{}}{BELOW}</body></html>',
    f'<html class="no-js header-fixed"><body>{MENU}<article>{{}}</article>{BELOW}</body></html>',
    f'{MENU}<div id="main-content-with-sidebar">{{}}</div>{BELOW}',
    f'{MENU}<main class="page-with-header">{{}}</main>{BELOW}',
    f'<form id="aspnetForm">{MENU}<article>{{}}</article></form>{BELOW}',
    f'<div id="wrapper" class="nav-container">{MENU}<div class="main sidebar-left">{{}}</div></div>{BELOW}',
    f'<article class="post widget">{MENU}{{}}</article>{BELOW}'])
def test_outer_names_do_not_empty_a_page(page):
    want = "T\n\n" + " ".join(["story words"] * 30) + "\n\nand more"
    assert main_text(page.replace("{}", ARTICLE), Scanner()) == want


def test_names_of_paragraphs_and_of_asides():
    text = " ".join(["story words"] * 30)
    page = (f'<article><p>{text}</p><p class="has-alert widget-text">kept</p><p class="ad">buy</p>'
            f'<div class="sidebar-widget">links</div><p>end</p><article class="comment"><p>I think</p></article></article>')
    assert main_text(page, Scanner()) == f"{text}\n\nkept\n\nend"
    menus = '<div class="sidebar">' + "link text " * 40 + f"</div><div><p>{text}</p></div>"
    assert main_text(menus, Scanner()) == text


@pytest.mark.parametrize("part", ["<a ", "<b>", "<a '", "<svg ", "<!x ", "<p class=\"", "</i><b>", "<hr><b>",
                                  "<form><b>x", "<div class=ad>w", "</b></i>", "<article>a"])
def test_broken_pages_take_linear_time(part):
    start = time.time()
    page = "<p>text</p>" + part * (200_000 // len(part))
    main_text(page, Scanner())
    count_labelled("<article>a b</article>" + page, {})
    assert time.time() - start < 6


def test_scan_equals_all_regions():
    pick = random.Random(3)
    for _ in range(300):
        scores = [pick.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(pick.randint(0, 12))]
        first, last = best_region(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[first:last]) == max([0, *sums])


def test_labelled_words_are_counted_once_for_each_key():
    counts = {}
    count_labelled("<div><div><article><p>a b<p>c</article>x</div></div><nav><ul><li>m n</ul></nav>", counts)
    assert counts == {"div": [3, 0], "article": [3, 0], "p": [3, 0], "nav": [0, 2]}


def test_decoding_finds_the_best_of_all_paths(spark):
    """The lattice search against every path through small lattices."""
    rows, _ = toxic_corpus(200)
    restorer = Restorer(count_letters(spark.createDataFrame([(t,) for t, _ in [
        (text, 0) for _, text in rows]], "text string")))
    table, pick = restorer.model.table, random.Random(12)

    def paths(arcs):
        for path in itertools.product(*arcs, [(0, "", 0.0)]):
            a, b, total, text = 0, 0, 0.0, ""
            for kind, sign, cost in path:
                total += cost
                if kind is None:
                    continue
                if kind == 0:
                    total += table[a][b][0] if b else 0.0
                    a, b, text = 0, 0, text + f" {sign} "
                else:
                    total += table[a][b][kind]
                    a, b, text = b, kind, text + sign
            yield total, text

    for _ in range(60):
        arcs = []
        for _ in range(pick.randint(1, 6)):
            letters = [(k, chr(96 + k), -pick.random()) for k in pick.sample(range(1, 27), pick.randint(1, 3))]
            others = [(0, pick.choice(["", "7"]), -2 * pick.random()), (None, "", -3 * pick.random())]
            arcs.append(letters + others[:pick.randint(0, 2)])
        best = max(total for total, _ in paths(arcs))
        allowed = {text.split() and " ".join(text.split()) or "" for total, text in paths(arcs) if total > best - 1e-9}
        assert " ".join(restorer._decode(arcs).split()) in allowed


def test_weights_are_those_of_a_plain_logistic_regression():
    """Words that only toxic texts have score high, whatever else a text has."""
    pick = random.Random(6)
    bad, good = ["vile", "nasty"], ["plain", "table", "water", "stone", "river"]
    texts = [[*pick.sample(good, 3), *([pick.choice(bad)] if i % 4 == 0 else [])] for i in range(400)]
    from tidyforge.llm import toxicity
    model = toxicity._fit([np.array(sorted({f for w in t for f in toxicity.features(w)}), np.int64) for t in texts],
                          np.array([i % 4 == 0 for i in range(400)], float))
    found = [model.chance({f for w in t for f in model.telling(w)}) for t in texts]
    assert min(found[::4]) > 0.5 > max(p for i, p in enumerate(found) if i % 4)
    assert all(w >= 0 for w in model.weights.values())
