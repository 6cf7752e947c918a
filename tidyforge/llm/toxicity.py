"""Toxicity scores of texts restored from leetspeak, spacing and repetition."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.llm.words import slices

SAMPLE = 8000                # labelled rows the classifier is fitted on, about
FEATURES = 4000              # features it has at most
CACHE = 250_000              # words a worker remembers

# What a written sign may stand for (fixed values).
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c",
    "€": "e", "£": "l", "¡": "i", "¢": "c", "§": "s", "а": "a", "е": "e", "о": "o", "р": "p",
    "с": "c", "у": "y", "х": "x", "і": "i", "α": "a", "ο": "o", "ν": "v"}
MASKS = "*#"                 # may stand for any letter
# Log probabilities of the channel.
STANDS_FOR, MASKED = -1.2, -4.5          # a sign, or a mask, for a letter
IS_MARK, DROPPED, EDGE_MARK = -0.7, -2.5, -0.3   # a mark that parts words, hides, or ends one
LIKE_MARK, LIKE_DROPPED, IS_DIGIT = -8.0, -10.0, -9.0      # the same of signs like letters
SECOND, THIRD = -3.0, -0.3   # a letter written twice, or more often, by repetition
TWO_SIGNS = -6.0             # a sign like a letter written twice by repetition
GAP, NO_GAP = -1.0, -0.4     # a space between single letters is real, or is not
UNUSUAL = -4.6               # a doubled letter less likely than this may be repetition

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
OTHER, CLASSES = len(LETTERS) + 1, 64
_CLASS = np.full(0x10000, OTHER, np.uint8)
_CLASS[[c for c in range(0x250) if not chr(c).isalpha()]] = 0
_CLASS[0x2000:0x2070] = _CLASS[0x20A0:0x20D0] = _CLASS[0x3000:0x3004] = 0
for _k, _c in enumerate(LETTERS):
    _CLASS[ord(_c)] = _k + 1
_INDEX = {c: k + 1 for k, c in enumerate(LETTERS)}

_HIDDEN = re.compile("[­​-‏⁠﻿]")
_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+*])(?:[ \t._*~-]{1,3}(?:[^\W_]|[@$!|+])){2,}(?!\S)")
_PARTS = re.compile(r"[^\W_]|[@$!|+]")
_MARKS = ".,;:?\"'()[]%&/\\^~`=-_«»“”‘’„…–—•·¿"
_EDGE = re.compile(r"^[^\w@$!|+*#(<{€£¡¢§]+|[^\w@$!|+*#€£¢§]+$")
_OUTER = _MARKS + MASKS + "".join(c for c in SIGNS if not c.isalnum())
_MONEY = re.compile(r"[$€£¢+]\d+\W*")
_REPEATED = re.compile(r"(\w)\1")


class CharacterModel:
    """Log probabilities of a letter after two others; 0 is the edge of a word."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        chance = (one + 1) / (one.sum() + CLASSES)
        after = (two + 5 * chance) / (two.sum(axis=1, keepdims=True) + 5)
        full = (three + 5 * after[None]) / (three.sum(axis=2, keepdims=True) + 5)
        self.table = np.log(full).astype(np.float32).tolist()

    def after(self, a: int, b: int, c: int) -> float:
        return self.table[a][b][c]


def count_letters(texts: DataFrame) -> np.ndarray:
    """Counts of letter triples over all rows of the one text column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for at, to in slices(batch.column(0)):
                text = "\n".join(t or "" for t in batch.column(0).slice(at, to - at).to_pylist())
                units = np.frombuffer(f"\n{text.lower()}\n".encode("utf-16-le"), np.uint16)
                signs = _CLASS[units]
                some = signs != 0
                some[1:] |= some[:-1].copy()
                signs = signs[some].astype(np.int32)       # one edge between two words
                if len(signs):
                    pairs = signs.copy()
                    pairs[1:] += signs[:-1] * CLASSES
                    signs[1:] += np.where(pairs[:-1] % CLASSES == 0, 0, pairs[:-1] * CLASSES)
                    total += np.bincount(signs, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])],
                                         ["triple", "n"])

    counts = np.zeros(CLASSES ** 3, np.int64)
    for row in texts.mapInArrow(count, "triple long, n long").groupBy("triple").agg(
            F.sum("n").alias("n")).collect():         # at most 64 ** 3 rows
        counts[row["triple"]] = row["n"]
    return counts


class Restorer:
    """Decodes the words of a text under a character model."""

    def __init__(self, counts: np.ndarray):
        self.model = CharacterModel(counts)
        self.known: dict[str, tuple[str, ...]] = {}

    def words(self, text: str) -> set[str]:
        """Distinct words of the restored text, in lower case."""
        found: set[str] = set()
        for written in set(text.split()):
            found.update(self.readings(written, self.word))
        for match in _SPACED.finditer(text):
            found.update(self.spaced(match.group()))
        return found

    def text(self, text: str) -> str:
        """The restored text, words joined by one space."""
        joined = _SPACED.sub(lambda m: " ".join(self.spaced(m.group())), _prepared(text))
        return " ".join(w for written in joined.split() for w in self.word(written))

    def word(self, written: str) -> tuple[str, ...]:
        """The words that one run of non-blank characters stands for."""
        found = self.known.get(written)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[written] = self.restore(written)
        return found

    @staticmethod
    def readings(written: str, read) -> tuple[str, ...]:
        """What ``read`` makes of a run as it is and, if signs enclose it, without them."""
        if written[0].isalnum() and written[-1].isalnum():
            return read(written)
        whole = _prepared(written).strip(_MARKS)
        inner = whole.strip(_OUTER)
        plain = inner != whole and any(c.isalpha() for c in inner)
        found = read(written)
        return found + tuple(w for w in read(inner) if w not in found) if plain else found

    def spaced(self, run: str) -> tuple[str, ...]:
        """The words that single letters with blanks or marks between them stand for."""
        arcs, end = [], 0
        for match in _PARTS.finditer(run):
            if end:                        # a wider gap than one sign is a real one
                arcs.append([(0, "", GAP)] + [(None, "", NO_GAP)] * (match.start() == end + 1))
            arcs.append(self._letters(match.group()) or [(0, match.group(), 0.0)])
            end = match.end()
        return tuple(self._decode(arcs).split())

    def restore(self, written: str) -> tuple[str, ...]:
        """As ``word``, without remembering it."""
        word = written.strip(_MARKS).lower()
        if word.isalpha() and word.isascii() and not _REPEATED.search(word):
            return (word,)
        word = _EDGE.sub("", _prepared(word).lower())
        if word.isalpha() and not self._stretched(word):
            return (word,)
        letters = any(c.isalpha() for c in word)
        if not letters:
            word = word.strip(MASKS)
            if len(set(word)) < 2 or not all(c in SIGNS for c in word) or _MONEY.fullmatch(word):
                return ()
        runs = [(m.group(1), len(m.group())) for m in re.finditer(r"(.)\1*", word, re.S)]
        arcs: list = []
        for k, (sign, times) in enumerate(runs):
            last = k == len(runs) - 1
            edge = last if sign == "!" else sign not in SIGNS and (k == 0 or last)
            arcs += self._run(sign, times, edge)
        found = tuple(self._decode(arcs).split())
        return found if letters or all(w.isalpha() for w in found) else ()

    def _stretched(self, word: str) -> bool:
        for match in _REPEATED.finditer(word):
            at = match.start()
            if word[at + 2:at + 3] == word[at]:
                return True
            before, own = (_INDEX.get(word[at - 1], OTHER) if at else 0), _INDEX.get(word[at])
            if own and self.model.after(before, own, own) < UNUSUAL:
                return True
        return False

    @staticmethod
    def _letters(sign: str) -> list:
        """Letters a sign may stand for, as (class, text, log probability)."""
        if sign in _INDEX:
            return [(_INDEX[sign], sign, 0.0)]
        found = [(_INDEX[c], c, STANDS_FOR) for c in SIGNS.get(sign, "")]
        if sign.isalpha():
            found.append((OTHER, sign, -0.5 if found else 0.0))
        if sign in MASKS:
            found += [(_INDEX[c], c, MASKED) for c in LETTERS[:26]]
        return found

    def _run(self, sign: str, times: int, edge: bool) -> list:
        """Arcs for a sign written ``times`` times in a row; a mark is usual at an ``edge``."""
        letters = self._letters(sign)
        if sign.isalpha():
            again = [(c, t, 0.0) for c, t, _ in letters] + [
                (None, "", SECOND if times == 2 else THIRD)]
            return [letters] + [again] * (times > 1)
        if letters and sign not in MASKS:
            own = [*letters, (0, sign if sign.isdigit() else "",
                              IS_DIGIT if sign.isdigit() else EDGE_MARK if edge else LIKE_MARK)]
            if not sign.isdigit():
                own.append((None, "", EDGE_MARK if edge else LIKE_DROPPED))
            again = TWO_SIGNS if times == 2 and not edge else THIRD
            return [own] + [[*letters, (None, "", again)]] * (times > 1)
        mark = [(0, "", EDGE_MARK if edge else IS_MARK), (None, "", EDGE_MARK if edge else DROPPED)]
        return [[*letters, *mark]] * (min(times, 2) if letters and not edge else 1)

    def _decode(self, arcs: list) -> str:
        """Viterbi: the text of the best path through the lattice.

        The state is the last two classes; an arc adds a letter, an edge of a word (class 0)
        or nothing (None).  A path is a chain of (what it adds, the path before), so the work
        grows with the length of the lattice alone.
        """
        table = self.model.table
        paths: dict = {(0, 0): (0.0, None)}
        for options in [*arcs, [(0, "", 0.0)]]:
            step: dict = {}
            for (a, b), (score, path) in paths.items():
                row = table[a][b]
                for kind, sign, cost in options:
                    if kind is None:
                        state, total = (a, b), score + cost
                    elif kind == 0:
                        state, total = (0, 0), score + cost + (row[0] if b else 0.0)
                    else:
                        state, total = (b, kind), score + cost + row[kind]
                    if state not in step or step[state][0] < total:
                        added = sign if kind else None if kind is None else f" {sign} "
                        step[state] = (total, (added, path) if added else path)
            paths = step
        parts, path = [], max(paths.values(), key=lambda p: p[0])[1]
        while path:
            added, path = path
            parts.append(added)
        return "".join(reversed(parts))


def _prepared(text: str) -> str:
    if text.isascii():
        return text
    return unicodedata.normalize("NFKC", _HIDDEN.sub("", text))


def features(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    found = [crc32(word.encode())]
    if len(word) >= 4:
        found.append(crc32(word[:4].encode(), 4))
        if len(word) >= 6:
            found.append(crc32(word[:6].encode(), 6))
    return found


class Classifier:
    """Logistic regression on the presence of hashed features; no word lowers a score."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    def telling(self, word: str) -> tuple[int, ...]:
        """The features of a word that have a weight."""
        weights = self.weights
        return tuple([f for f in features(word) if f in weights])

    def chance(self, found: set[int]) -> float:
        total = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


class Scorer:
    """Scores whole texts; remembers the telling features of words as they are written."""

    def __init__(self, restorer: Restorer, model: Classifier):
        self.restorer, self.model = restorer, model
        self.known: dict[str, tuple[int, ...]] = {}

    def score(self, text: str) -> float:
        known, found = self.known, set()
        for written in set(text.split()):
            telling = known.get(written)
            if telling is None:
                if len(known) >= CACHE:
                    known.clear()
                telling = known[written] = self._telling(
                    self.restorer.readings(written, self.restorer.restore))
            if telling:
                found.update(telling)
        for match in _SPACED.finditer(text):
            found.update(self._telling(self.restorer.spaced(match.group())))
        return self.model.chance(found)

    def _telling(self, words: tuple[str, ...]) -> tuple[int, ...]:
        if len(words) == 1:
            return self.model.telling(words[0])
        return tuple(f for w in words for f in self.model.telling(w))


def _fit(rows: list[np.ndarray], toxic: np.ndarray, most: int = FEATURES) -> Classifier:
    """Choose the features that differ most between the labels and fit their weights."""
    bad = float(toxic.sum())
    if not len(rows) or bad in (0.0, float(len(rows))):
        share = (bad + 0.5) / (len(rows) + 1)
        return Classifier({}, float(np.log(share / (1 - share))))
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    names, number, total = np.unique(flat, return_inverse=True, return_counts=True)
    seen = np.bincount(number, toxic[owner], len(names))
    share = bad / len(rows)
    z = (seen - total * share) / np.sqrt(total * share * (1 - share) + 1e-9)
    chosen = np.flatnonzero((z > 3.5) & (total >= 2))
    chosen = chosen[np.argsort(-z[chosen], kind="stable")][:most]
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[number] >= 0
    row, column = owner[inside], place[number[inside]]
    weights, bias = np.zeros(len(chosen)), float(np.log(share / (1 - share)))
    least = bias - 1        # else one telling word would not outweigh it
    step = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for turn in range(1, 501):                       # projected gradient steps of Adam
        total = bias + np.bincount(row, weights[column], len(rows))
        miss = 1 / (1 + np.exp(-np.clip(total, -500, 500))) - toxic
        slope = np.bincount(column, miss[row], len(chosen)) + 0.02 * weights
        slope = np.append(slope, miss.sum()) / len(rows)
        step = 0.9 * step[0] + 0.1 * slope, 0.99 * step[1] + 0.01 * slope ** 2
        move = 0.05 * (step[0] / (1 - 0.9 ** turn)) / (np.sqrt(step[1] / (1 - 0.99 ** turn)) + 1e-8)
        weights = np.maximum(weights - move[:-1], 0)
        bias = max(bias - move[-1], least)
    return Classifier({int(n): float(w) for n, w in zip(names[chosen], weights) if w > 0},
                      float(bias))


def train_classifier(docs: DataFrame, labels: DataFrame, usable: Column, counts: np.ndarray,
                     doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
                     sample: int = SAMPLE) -> Classifier:
    """Fit on about ``sample`` labelled rows where ``usable`` holds, chosen by a hash of the id.

    Only words of restored texts are features.  Rows without a label or an id are not used; an
    id with several labels is toxic if one of them says so, one with several texts counts with
    the first of them in their order, so that the sample stays bounded.  If no row or only one
    label is left, every text gets the same score.
    """
    known = labels.where(usable & F.col(f"`{toxic}`").isNotNull() & F.col(
        f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").alias("labelled_id"),
                                           (F.col(f"`{toxic}`") == 1).alias("bad"))
    known = known.groupBy("labelled_id").agg(F.max("bad").alias("bad"))
    share = max(1, -(-known.count() // sample))
    chosen = known.where(F.pmod(F.xxhash64("labelled_id"), F.lit(share)) == 0)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias(
        "text")).join(F.broadcast(chosen), F.col("id") == F.col("labelled_id"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(counts)
        for batch in batches:
            found = []
            for value in batch.column(1):
                words = restorer.words(value.as_py() or "")
                own = np.unique(np.array([f for w in words for f in features(w)], np.uint32))
                found.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())],
                                             ["bad", "found"])

    rows = rows.groupBy("id").agg(F.max("bad").alias("bad"), F.min("text").alias("text"))
    told = rows.select("bad", "text").mapInArrow(read, "bad boolean, found binary").collect()
    told.sort(key=lambda r: (r["bad"], bytes(r["found"])))
    return _fit([np.frombuffer(r["found"], np.uint32) for r in told],
                np.array([r["bad"] for r in told], float))


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
                   doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
                   output: str = "score", restored: str | None = None) -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1 of each whole text.

    A text is taken as written through a noisy channel: signs stand for letters, letters are
    repeated, marks or blanks stand between them.  The readings of a word are a lattice of
    letters; the Viterbi path under a model of letter triples, counted over all texts, is the
    restored word, and a classifier learned from ``labels`` (where ``usable`` holds) scores the
    restored words.  Words that have one reading only are their own path.  Signs around a word
    may be letters or marks: the word without them is scored too.  Digits and signs alone are a
    word if that is likelier than a number; numbers are no words.  An empty or missing
    text gets the score of a text without any telling word.  Equal texts have equal scores,
    rows that occur twice are scored twice; ``restored`` names a column for the restored text.
    All other columns stay; ones with the added names are replaced.
    """
    usable = F.lit(True) if usable is None else usable
    added = [output] + ([restored] if restored else [])
    names = [c for c in docs.columns if c not in added or c == text]
    whole = docs.select(*[F.col(f"`{c}`") for c in names])
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    counts = count_letters(texts)
    model = train_classifier(docs, labels, usable, counts, doc_id, text, toxic)
    kinds = {output: T.DoubleType(), restored: T.StringType()}
    schema = reduce(lambda s, c: s.add(c, kinds[c]), added, T.StructType(
        [f for f in whole.schema.fields if f.name not in added]))
    stay = [i for i, n in enumerate(names) if n not in added]
    place = names.index(text)
    known = {int(k): int(v) for k, v in enumerate(counts) if v}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CLASSES ** 3, np.int64)
        table[list(known)] = list(known.values())
        restorer = Restorer(table)
        scorer = Scorer(restorer, model)
        for batch in batches:
            texts = batch.column(place).cast(pa.string())
            values = [pa.array([scorer.score(t.as_py() or "") for t in texts], pa.float64())]
            if restored:
                values.append(pa.array([restorer.text(t.as_py() or "") for t in texts],
                                       pa.string()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in stay], *values],
                                             schema.names)

    return whole.mapInArrow(scored, schema)
