"""Joining supplemental tables without losing, multiplying or clobbering data."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.functions.keys import canonical_key, equals_value
from tidyforge.functions.names import INTEGRAL, quoted, ref, replace_columns
from tidyforge.functions.text import as_text, scrub
from tidyforge.operators.dedupe import first_per_key, ordering

log = logging.getLogger(__name__)

HOW = ("left", "inner", "right", "outer")
CANONICAL = "canonical_key"
FILTER_BITS = 1 << 26        # 8 MB
COLLISIONS = ("keep_base", "keep_new", "keep_both", "suffix")


def harmonize_keys(df: DataFrame, keys: list[str],
                   scrubber: Callable[[Column], Column] | None = scrub) -> DataFrame:
    """Replace the key columns by their canonical text.

    A key that was made canonical by an earlier merge is marked so and left alone: a
    chain of merges on one key then keeps its partitioning and shuffles the base once.
    """
    todo = [k for k in keys if not df.schema[k].metadata.get(CANONICAL)]
    return replace_columns(df, {
        k: canonical_key(ref(k), df.schema[k].dataType, scrubber).alias(k, metadata={CANONICAL: True})
        for k in todo})


def filter_equal(df: DataFrame, filters: dict[str, object] | None,
                 clean: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """Keep rows where every listed column equals its value as trimmed text.

    Filtered columns come out as trimmed text.  Columns that do not exist are skipped.
    """
    usable = {c: v for c, v in (filters or {}).items() if c in df.columns}
    for c in set(filters or {}) - set(usable):
        log.warning("filter column %r not found, filter skipped", c)
    if not usable:
        return df
    types = {c: df.schema[c].dataType for c in usable}
    kept = df
    for c, wanted in usable.items():
        kept = kept.where(equals_value(ref(c), types[c], wanted, clean))
    return replace_columns(kept, {c: F.trim(as_text(ref(c), types[c])) for c in usable})


def collapse(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``, ties broken by the other columns."""
    return first_per_key(df, keys, ordering(df, order_by, skip=keys))


def merge(base: DataFrame, new: DataFrame, on: list[str], how: str = "left",
          filters: dict[str, object] | None = None, collapse_duplicates: bool = True,
          key_scrubber: Callable[[Column], Column] | None = scrub,
          collision: str = "keep_base", order_by: list[str] | None = None,
          null_keys: str = "match", on_missing_key: str = "raise", text_keys: bool = True,
          clean_filter: Callable[[Column], Column] = lambda text: text,
          key_filter: bool = False) -> DataFrame:
    """Equi-join ``new`` onto ``base``: harmonise keys, filter, collapse, join.

    Missing keys match missing keys unless ``null_keys="never"``.  ``collision`` says
    what happens to other columns both sides have: keep one side's, keep both as
    ``_base``/``_new``, or keep both as ``_x``/``_y`` ("suffix").  Whole-number keys of
    both sides are joined as such and become text afterwards, unless ``text_keys`` is off.

    ``key_filter`` is for a left or inner merge of a table that is much larger than the base:
    rows whose key the base surely lacks are left out before they are collapsed and shuffled.
    The result is the same.
    """
    on = [on] if isinstance(on, str) else list(on)
    if not on:
        raise ValueError("merge needs at least one key column")
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}, not {how!r}")
    if collision not in COLLISIONS:
        raise ValueError(f"collision must be one of {COLLISIONS}, not {collision!r}")
    absent = [k for k in on if k not in base.columns or k not in new.columns]
    if absent:
        if on_missing_key == "skip":
            log.warning("merge keys %s missing on one side, base returned unchanged", absent)
            return base
        raise KeyError(f"merge keys missing on one side: {absent}")

    same_whole = not set(on) & set(filters or {}) and all(
        isinstance(d.schema[k].dataType, INTEGRAL) for k in on for d in (base, new))
    if not same_whole:
        base, new = (harmonize_keys(d, on, key_scrubber) for d in (base, new))
    new = filter_equal(new, filters, clean_filter)
    if key_filter and how in ("left", "inner"):
        new = with_known_keys(base, new, on)
    if collapse_duplicates:
        new = collapse(new, on, order_by)
    joined = _join(base, new, on, how, collision, null_keys)
    return keys_as_text(joined, on) if same_whole and text_keys else joined


def with_known_keys(base: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``new`` whose key's hash is among the hashes of the keys of ``base``.

    The hashes are bits of a map of ``FILTER_BITS``, cut into rows of 4 KB, which is therefore
    small enough to broadcast whatever the size of the base; one scan of the base's keys fills
    it.  With n keys a row of another key stays with a chance of less than n / ``FILTER_BITS``.
    """
    def bit(side: DataFrame) -> Column:
        # whole numbers of both sides are joined whatever their widths
        keys = [ref(k).cast("long") if isinstance(side.schema[k].dataType, INTEGRAL) else ref(k)
                for k in on]
        return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    own = base.select(bit(base).alias("__bit"))
    known = own.groupBy(F.bitmap_bucket_number("__bit").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("__map"))
    marked = new.withColumn("__bit", bit(new))
    joined = marked.join(F.broadcast(known), F.bitmap_bucket_number("__bit") == F.col("__bucket"))
    position = F.bitmap_bit_position("__bit")
    byte = F.conv(F.hex(F.substring("__map", F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    there = F.call_function("getbit", byte.cast("int"), (position % 8).cast("int")) == 1
    return joined.where(there).select(*map(ref, new.columns))


def keys_as_text(df: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-number keys as canonical text."""
    return harmonize_keys(df, [k for k in keys if isinstance(df.schema[k].dataType, INTEGRAL)])


def _output_names(base: DataFrame, new: DataFrame, on: list[str],
                  collision: str) -> list[tuple[str, str, str]]:
    """(side, source column, output name) for every output column.

    Decided from the two schemas, so a column that is really called ``pos_x`` is kept.
    Names that differ only in case collide too unless the session tells them apart.
    """
    strict = base.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    fold = (lambda c: c) if strict else str.lower
    keys = {fold(k) for k in on}
    in_base = {fold(c) for c in base.columns}
    in_new = {fold(c) for c in new.columns}
    both = (in_base & in_new) - keys
    endings = {"keep_both": ("_base", "_new"), "suffix": ("_x", "_y")}.get(collision, ("", ""))
    out = []
    for side, frame, ending, dropped_by in (("b", base, endings[0], "keep_new"),
                                            ("n", new, endings[1], "keep_base")):
        for c in frame.columns:
            if fold(c) in keys:
                if side == "b":
                    out.append(("key", c, c))
            elif fold(c) not in both:
                out.append((side, c, c))
            elif collision != dropped_by:
                out.append((side, c, c + ending))
    names = [fold(name) for _, _, name in out]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"merged columns would share a name: {twice}; choose another collision rule")
    return out


def _join(base, new, on, how, collision, null_keys) -> DataFrame:
    layout = _output_names(base, new, on, collision)
    needed = [c for side, c, _ in layout if side == "n"]
    new = new.select(*map(ref, [*on, *needed]))
    b, n = base.alias("b"), new.alias("n")

    def side(letter: str, name: str) -> Column:
        return F.col(f"{letter}.{quoted(name)}")

    def condition(left: str, right: str) -> Column:
        # The null-safe form has an exchange of its own on both sides, which is what
        # lets adaptive execution split a hot (or missing) key of the base.
        test = F.lit(True)
        for k in on:
            l, r = side(left, k), side(right, k)
            test = test & (l.eqNullSafe(r) if null_keys == "match" else l == r)
        return test

    matched = b.join(n, condition("b", "n"), "inner" if how in ("inner", "right") else "left")
    matched = matched.select(*[side("n" if s == "n" else "b", c).alias(name)
                               for s, c, name in layout])
    if how in ("left", "inner"):
        return matched
    # Rows of the new side without a partner.  A right or full outer join could not
    # split a hot key of the base; a distinct list of its keys is reduced before the
    # shuffle instead.
    known = base.select(*map(ref, on)).distinct().alias("k")
    unmatched = n.join(known, condition("n", "k"), "left_anti")
    types = {f.name: f.dataType for f in base.schema}
    unmatched = unmatched.select(*[
        side("n", c).alias(name) if s in ("n", "key") else F.lit(None).cast(types[c]).alias(name)
        for s, c, name in layout])
    return matched.unionByName(unmatched)


def resolve_collisions(df: DataFrame, strategy: str = "keep_base") -> DataFrame:
    """Resolve ``<c>_x`` / ``<c>_y`` pairs of an earlier join.

    Only real pairs are touched; a single column that ends in ``_x`` or ``_y`` stays.
    """
    if strategy not in ("keep_base", "keep_new", "keep_both"):
        raise ValueError(f"unknown collision strategy {strategy!r}; "
                         "choose 'keep_base', 'keep_new' or 'keep_both'")
    have = set(df.columns)
    pairs = {c[:-2] for c in df.columns if c.endswith("_x") and f"{c[:-2]}_y" in have}
    out = []
    for c in df.columns:
        stem, ending = c[:-2], c[-2:]
        if ending not in ("_x", "_y") or stem not in pairs:
            out.append(ref(c))
        elif strategy == "keep_both":
            out.append(ref(c).alias(stem + ("_base" if ending == "_x" else "_new")))
        elif (strategy == "keep_base") == (ending == "_x"):
            out.append(ref(c).alias(stem))
    return df.select(*out)
