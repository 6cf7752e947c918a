"""Interpolated modified Kneser-Ney n-gram model over whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.llm.coded_tables import CodedTable, distinct, parted, shard_of, write_coded
from tidyforge.llm.hash_tables import (
    add_up, new_folder, pack_keys, pack_values, shard_bits, text_size, unpack_keys, unpack_values)
from tidyforge.llm.words import Words, combine, find_words, mix, slices

ORDER = 3
FLUSH_GRAMS = 2_000_000      # n-grams a task gathers before it sends them
SPLIT_BITS = 20              # a word before 1 / 2^20 of all words is always split
SCORED_BYTES = 4 << 20       # texts scored at once
HASH_BITS = 56               # of a word's hash; more cost disk, an absent word meets few others
_START, _END = np.uint64(0x5BD1E995A3C59A), np.uint64(0x27D4EB2F165667)
#: N-grams of one shard: the different hashes of their words, and the words' places in these;
#: the places of the last word but one and of the first are one number, in ascending order.
_GRAMS = "shard int, words binary, places array<binary>, counts binary"
#: Parts of words (level 1) or of contexts of split words (the order), or facts (level 0).
_PARTS = "level int, shard int, keys binary, columns array<binary>, facts array<long>"
_STATS = 4                   # a context's total and its words counted once, twice, more often


class Deal(NamedTuple):
    """Where n-grams go: by the word before their last, so that all n-grams of a context, and
    the n-grams of all lower orders that end like one, meet in one shard.  ``split`` has the
    words that come before more words than a shard should hold; n-grams with these are dealt by
    the last word too, and the figures of their contexts are put together afterwards.
    """

    bits: int
    split: np.ndarray

    def is_split(self, words: np.ndarray) -> np.ndarray:
        if not len(self.split):
            return np.zeros(len(words), bool)
        place = np.minimum(np.searchsorted(self.split, words), len(self.split) - 1)
        return self.split[place] == words

    def shards(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return shard_of(np.where(self.is_split(before), _follow(before, last), before), self.bits)


class NgramModel:
    """A counted model: tables of words, and of n-grams and contexts per order, and totals.

    The probability of a word after a context is its count less a discount, over the
    context's total, plus what the discounts leave times the probability after the context
    without its first word.  Counts are occurrences at the highest order, and at the start of
    a text; below it they are numbers of different left neighbours.  Below single words every
    word, and one unknown word, is equally likely.  There are three discounts per order, for
    counts 1, 2 and more, from the numbers of n-grams seen one to four times; where those are
    too few, all three are n1 / (n1 + 2 n2), or 0.5 without any.
    """

    def __init__(self, order: int, deal: Deal, words: CodedTable, grams: dict[int, CodedTable],
                 contexts: dict[int, CodedTable], split_contexts: dict[int, CodedTable],
                 seen: dict[int, np.ndarray], tokens: int, types: int, pairs: int):
        self.order, self.deal, self.words, self.grams = order, deal, words, grams
        self.contexts, self.split_contexts = contexts, split_contexts
        self.tokens, self.types, self.pairs = tokens, types, pairs
        self.discounts = {k: _discounts(n) for k, n in seen.items()}
        self.seen = seen

    def probabilities(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Model probability and training count of the tokens at ``ends``."""
        single, _, again = distinct(ids[ends])
        single = mix(single)
        counts, raw = self.words.search(single, shard_of(single, self.deal.bits))[again].T
        chance = np.full(len(ends), 1 / (self.types + 1))
        if self.pairs:
            left = self.discounts[1] @ self.seen[1][[0, 1, 4]] / self.pairs
            chance = self._kept(1, counts) / self.pairs + left * chance
        for k in range(2, self.order + 1):
            before = ids[ends - 1]
            key, first, again = distinct(mix(combine(ids, k))[ends - k + 1])
            own = self.grams[k].search(
                key, self.deal.shards(before[first], ids[ends[first]]))[again, 0]
            key, first, again = distinct(mix(combine(ids, k - 1))[ends - k + 1])
            before = before[first]
            split = self.deal.is_split(before)
            around = np.zeros((len(key), _STATS), np.int64)
            around[~split] = self.contexts[k].search(
                key[~split], shard_of(before[~split], self.deal.bits))
            around[split] = self.split_contexts[k].search(
                key[split], shard_of(key[split], self.deal.bits))
            known = around[:, 0] > 0
            total = np.where(known, around[:, 0], 1).astype(float)
            # term by term: a matrix product would keep every core busy for three columns
            left = sum(d * n for d, n in zip(self.discounts[k], around[:, 1:].T)) / total
            known, total, left = known[again], total[again], left[again]
            chance = np.where(known, self._kept(k, own) / total + left * chance, chance)
        return chance, raw

    def _kept(self, k: int, counts: np.ndarray) -> np.ndarray:
        off = np.concatenate([[0.0], self.discounts[k]])[np.minimum(counts, 3).astype(int)]
        return np.maximum(counts - off, 0)


def _discounts(seen: np.ndarray) -> np.ndarray:
    """The discounts from the numbers of n-grams seen 1, 2, 3 and 4 times."""
    one, two, three, four = (float(x) for x in seen[:4])
    plain = one / (one + 2 * two) if one else 0.5
    if min(one, two, three, four) == 0:
        return np.full(3, plain)
    found = np.array([1 - 2 * plain * two / one, 2 - 3 * plain * three / two,
                      3 - 4 * plain * four / three])
    return found if (found > 0).all() and (found < [1, 2, 3]).all() else np.full(3, plain)


def token_ids(words: Words, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of start marks, words and one end of each text; tokens' places; their texts."""
    texts = len(words.first) - 1
    count = np.diff(words.first)
    begin = words.first[:-1] + np.arange(texts) * order
    ids = np.full(len(words.hashes) + texts * order, _START)
    owner = np.repeat(np.arange(texts), count + 1)
    ends = np.arange(len(owner)) + owner * (order - 1) + order - 1
    last = begin + order - 1 + count
    inner = np.ones(len(owner), bool)
    inner[np.cumsum(count + 1) - 1] = False
    ids[ends[inner]] = words.hashes >> np.uint64(64 - HASH_BITS)
    ids[last] = _END
    return ids, ends, owner


def fit(docs: DataFrame, training: Column, text: str = "text", order: int = ORDER) -> NgramModel:
    """Count the model over the rows where ``training`` holds.

    Tasks count the n-grams of the highest order in their texts and send them as ``Deal`` says,
    the only large shuffle.  One task per shard writes the tables of all orders but single
    words and sends these, with the contexts of split words, to their own shards.  Which words
    are split decides on balance alone.  Only totals and numbers of shards reach the driver.
    """
    source = docs.where(training).select(F.col(f"`{text}`").cast("string").alias("text"))
    bits, folder = shard_bits(text_size(source)), new_folder(docs.sparkSession, "ngrams")
    deal = Deal(bits, _split_words(source, order, bits))
    parts = source.mapInArrow(lambda b: _count(b, order, deal), _GRAMS).groupBy(
        "shard").applyInArrow(_by_table(_Tables(order, deal, folder).write), _PARTS)
    told = parts.groupBy("level", "shard").applyInArrow(
        _by_table(_Parts(folder).write), "level int, shard int, facts array<long>").collect()
    facts = {k: np.sum([np.zeros(8, np.int64), *(
        r["facts"] for r in told if r["level"] == 1 and k == 1),
        *(r["facts"][8 * (k - 2):8 * (k - 1)] for r in told if r["level"] == 0 and k > 1)],
        axis=0) for k in range(1, order + 1)}

    def shards(level: int) -> list[int]:
        return [r["shard"] for r in told if r["level"] == level]

    upper = range(2, order + 1)
    pairs, types, tokens = (int(x) for x in facts[1][5:8])
    return NgramModel(
        order, deal, CodedTable(f"{folder}/1", shards(1), 2),
        {k: CodedTable(f"{folder}/{k}", shards(0), 1) for k in upper},
        {k: CodedTable(f"{folder}/{k}c", shards(0), _STATS) for k in upper},
        {k: CodedTable(f"{folder}/{k}s", shards(k), _STATS) for k in upper},
        {k: n[:5] for k, n in facts.items()}, tokens, types, pairs)


def _by_table(method):
    """A method as a function of the group's table alone."""
    return lambda table: method(table)


def _split_words(source: DataFrame, order: int, bits: int) -> np.ndarray:
    """Words that come before at least about 1 / 2^bits of all words, 2^(bits + 1) at most."""
    none = np.zeros(0, np.uint64)
    if order == 1:
        return none
    share = 0.5 ** (min(bits, SPLIT_BITS) + 1)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ends in _gathered(batches, 2):
            words, counts = add_up(np.concatenate([i[e - 1] for i, e in zip(ids, ends)]))
            total = int(counts.sum())
            keep = counts >= share * total
            words, counts = (np.append(x[keep], np.uint64(rest)) for x, rest in (
                (words, 0), (counts, total)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64)),
                 pa.array(np.arange(len(words)) == len(words) - 1)], ["word", "n", "total"])

    sums = source.mapInArrow(often, "word long, n long, total boolean").groupBy(
        "total", "word").agg(F.sum("n").alias("n"))
    total = sums.where("total").first()
    if total is None:
        return none
    found = sums.where(~F.col("total") & (F.col("n") >= share * total["n"])).collect()
    return np.sort(np.array([r["word"] for r in found], np.int64).view(np.uint64))


def _gathered(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[list, list]]:
    """Token hashes and ends of the texts of about ``FLUSH_GRAMS`` tokens at a time."""
    ids, ends, size = [], [], 0
    for batch in batches:
        for at, to in slices(batch.column(0)):
            own, last, _ = token_ids(find_words(batch.column(0).slice(at, to - at), True), order)
            ids.append(own)
            ends.append(last)
            size += len(last)
            if size >= FLUSH_GRAMS:
                yield ids, ends
                ids, ends, size = [], [], 0
    if size:
        yield ids, ends


def _records(columns: list[np.ndarray], counts: np.ndarray, raw: np.ndarray):
    """Distinct n-grams in the order of their hash, with summed counts."""
    if not len(counts):
        return np.zeros(0, np.uint64), columns, counts, raw
    key = _state(columns)
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return (key[new], [c[order[new]] for c in columns], np.add.reduceat(counts[order], new),
            np.add.reduceat(raw[order], new))


def _state(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of n-grams by their words; as ``mix`` and ``combine`` make it."""
    key = columns[0]
    for column in columns[1:]:
        key = _follow(key, column)
    return mix(key)


def _follow(key: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Hash state of words followed by one more; as ``combine`` does it."""
    return combine(np.array([1, 0], np.uint64), 2)[0] * key + column


def _count(batches: Iterator[pa.RecordBatch], order: int, deal: Deal) -> Iterator[pa.RecordBatch]:
    """Packed n-grams by shard."""
    for ids, ends in _gathered(batches, order):
        columns = [np.concatenate([i[e - order + 1 + k] for i, e in zip(ids, ends)])
                   for k in range(order)]
        ids.clear()                             # not needed while the n-grams are sorted
        ends.clear()
        ones = np.ones(len(columns[0]), np.uint64)
        _, columns, counts, _ = _records(columns, ones, ones)
        shards = deal.shards(columns[-2], columns[-1]) if order > 1 else shard_of(
            columns[0], deal.bits)
        for shard, at in parted(shards):
            names, places = np.unique(np.concatenate([c[at] for c in columns]),
                                      return_inverse=True)
            places = places.reshape(order, -1).astype(np.uint64)
            lead = places[max(order - 2, 0)] * np.uint64(len(names)) + places[0]
            if len(names) ** 3 < 1 << 64:
                sort = np.argsort(lead * np.uint64(len(names)) + places[-1])
            else:
                sort = np.lexsort((places[-1], lead))
            packed = [pack_keys(lead[sort]), *(
                pack_values(places[k][sort]) for k in _others(order))]
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "words": pack_keys(names), "places": packed,
                  "counts": pack_values(counts[at][sort])}], _ARROW_GRAMS)


def _others(order: int) -> list[int]:
    """Words of an n-gram that are neither its first nor its last but one."""
    return [k for k in range(1, order) if k != order - 2]


_ARROW_GRAMS = pa.schema([("shard", pa.int32()), ("words", pa.binary()),
                          ("places", pa.list_(pa.binary())), ("counts", pa.binary())])
_ARROW_PARTS = pa.schema([("level", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()),
                          ("columns", pa.list_(pa.binary())), ("facts", pa.list_(pa.int64()))])


def _unpacked(table: pa.Table, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Words and counts of the n-grams of a shard's rows."""
    held = []
    for words, places in zip(table["words"], table["places"]):
        names = unpack_keys(words.as_py())
        lead, *others = places.as_py()
        before, first = np.divmod(unpack_keys(lead), np.uint64(len(names)))
        own = dict(zip(_others(order), map(unpack_values, others))) | {0: first}
        own.setdefault(max(order - 2, 0), before)
        held.append([names[own[k].astype(np.int64)] for k in range(order)])
    return ([np.concatenate(c) for c in zip(*held)],
            np.concatenate([unpack_values(c.as_py()) for c in table["counts"]]))


def _facts(counts: np.ndarray, raw: np.ndarray) -> list[int]:
    """N-grams counted 1, 2, 3, 4 times and more than twice; all counts, n-grams, occurrences."""
    return [*(int((counts == i).sum()) for i in (1, 2, 3, 4)), int((counts > 2).sum()),
            int(counts.sum()), len(counts), int(raw.sum())]


class _Tables:
    """Write the n-grams and contexts of a shard, from the highest order down to pairs."""

    def __init__(self, order: int, deal: Deal, folder: str):
        self.order, self.deal, self.folder = order, deal, folder

    def write(self, table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        columns, counts = _unpacked(table, self.order)
        key, columns, counts, raw = _records(columns, counts, counts)
        rows, facts = [], []
        for k in range(self.order, 1, -1):
            write_coded(f"{self.folder}/{k}/{shard}", key, [counts])
            rows += self._contexts(k, shard, columns, counts)
            facts = _facts(counts, raw) + facts
            left = np.ones(len(key), np.uint64)
            if k > 2:                           # nothing differs to the left of a start mark
                left = np.where(columns[1] == _START, raw, left)
            key, columns, counts, raw = _records(columns[1:], left, raw)
        rows += _parts(1, key, [counts, raw], self.deal.bits)
        rows.append({"level": 0, "shard": shard, "facts": facts})
        return pa.Table.from_pylist(rows, _ARROW_PARTS)

    def _contexts(self, k: int, shard: int, columns: list[np.ndarray], counts: np.ndarray) -> list:
        key = _state(columns[:-1])
        order = np.argsort(key)
        key, own = key[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        stats = [np.add.reduceat(x.astype(np.uint64), new)
                 for x in (own, own == 1, own == 2, own > 2)]
        key, split = key[new], self.deal.is_split(columns[-2][order[new]])
        write_coded(f"{self.folder}/{k}c/{shard}", key[~split], [x[~split] for x in stats])
        return _parts(k, key[split], [x[split] for x in stats], self.deal.bits)


def _parts(level: int, key: np.ndarray, columns: list[np.ndarray], bits: int) -> list[dict]:
    """Packed rows of sorted keys by their own shard."""
    return [{"level": level, "shard": shard, "keys": pack_keys(key[at]),
             "columns": [pack_values(c[at]) for c in columns]}
            for shard, at in parted(shard_of(key, bits))]


class _Parts:
    """Put the parts of a shard of words, or of contexts of split words, together."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, table: pa.Table) -> pa.Table:
        level, shard = table["level"][0].as_py(), table["shard"][0].as_py()
        if not level:
            return table.select(["level", "shard", "facts"])
        key = np.concatenate([unpack_keys(x.as_py()) for x in table["keys"]])
        order = np.argsort(key)
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        packed = [c.as_py() for c in table["columns"]]
        columns = [np.add.reduceat(np.concatenate([unpack_values(c) for c in own])[order], new)
                   for own in zip(*packed)]
        write_coded(f"{self.folder}/{level}{'s' if level > 1 else ''}/{shard}", key[new], columns)
        return pa.table({"level": pa.array([level], pa.int32()),
                         "shard": pa.array([shard], pa.int32()),
                         "facts": pa.array([_facts(*columns) if level == 1 else None],
                                           pa.list_(pa.int64()))})


def score(docs: DataFrame, model: NgramModel, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of each whole text.

    A text's tokens are its words, A to Z in lower case, and one end; an empty or missing text
    is its end alone.  ``n_known`` counts tokens seen in training; ``base_score`` is the log10
    probability under add-half single-word counts and ``score`` under the model.  Workers map
    the model's files.  Columns of these names are replaced; all others stay.
    """
    added = {"n_tokens": T.LongType(), "n_known": T.LongType(), "base_score": T.DoubleType(),
             "score": T.DoubleType()}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    schema = T.StructType([*kept.schema.fields,
                           *[T.StructField(c, t) for c, t in added.items()]])
    place = kept.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(place), SCORED_BYTES):
                part = batch.slice(at, to - at)
                words = find_words(part.column(place).cast(pa.string()), True)
                ids, ends, owner = token_ids(words, model.order)
                chance, seen = model.probabilities(ids, ends)
                base = (seen + 0.5) / (model.tokens + 0.5 * (model.types + 1))
                n = to - at
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array(np.bincount(owner, minlength=n)),
                    pa.array(np.bincount(owner, seen > 0, n).astype(np.int64)),
                    pa.array(np.bincount(owner, np.log10(base), n)),
                    pa.array(np.bincount(owner, np.log10(chance), n))], schema.names)

    return kept.mapInArrow(scored, schema)
