"""Text expressions.  All stay inside the JVM; none calls Python per cell."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import FLOATING

# Unicode white space plus the separators U+001C..U+001F, for (?U) patterns.
WHITE = r"[\s\x1c-\x1f]"
# White space other than one single U+0020, so that ordinary text has no match.
UNEVEN_WHITE = f"(?U){WHITE}(?:(?<! )|{WHITE}){WHITE}*"
# The ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Words that stand for a missing cell, in any case.
PHANTOM_NULLS = "(?i)^(nan|none|null|nat)$"
# The text form of a byte literal; a lone opening counts as an empty one.
BYTE_LITERAL = """^b(?:'(?:(.*)')?|"(?:(.*)")?)$"""


def bytes_to_text(value: Column) -> Column:
    """UTF-8 text of a binary cell; invalid bytes are dropped."""
    return F.regexp_replace(F.make_valid_utf8(value.cast("string")), "\ufffd", "")


def _float_text(value: Column) -> Column:
    """Text of a double with a plain decimal form from 1e-4 up to 1e16.

    The JVM switches to exponents at 1e7 and below 1e-3, so `12345678.0` in one file
    and `"12345678.0"` in another would not meet as join keys.
    """
    plain = value.cast("string")
    size = F.abs(value)
    whole = F.concat(value.cast("decimal(20,0)").cast("string"), F.lit(".0"))
    fixed = F.regexp_replace(plain.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    power = F.substring_index(plain, "E", -1).try_cast("int")
    digits = F.abs(power).cast("string")
    exponent = F.concat(
        F.regexp_replace(F.substring_index(plain, "E", 1), r"\.0$", ""),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits),
    )
    return (
        F.when(~plain.contains("E"), plain)
        .when((size < 1e16) & (value == F.floor(value)), whole)
        .when((size >= 1e-4) & (size < 1e16), fixed)
        .otherwise(exponent)
    )


def as_text(value: Column, data_type: T.DataType) -> Column:
    """Text of a cell of any scalar type."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.BinaryType):
        return bytes_to_text(value)
    if isinstance(data_type, FLOATING):
        return F.when(~F.isnan(value), _float_text(value))
    return value.cast("string")


def strip(value: Column) -> Column:
    """Trim Unicode white space on both ends (built-in trim knows only U+0020)."""
    return F.regexp_replace(value, f"(?U)^{WHITE}+|{WHITE}+$", "")


def remove_punctuation(value: Column) -> Column:
    """Delete ASCII punctuation anywhere in the text."""
    return F.translate(value, PUNCTUATION, "")


def underscores_to_spaces(value: Column) -> Column:
    return F.translate(value, "_", " ")


def scrub(value: Column) -> Column:
    """Repair a dirty text cell.

    White-space runs become one space, ends are trimmed, the text form of a byte
    literal is unwrapped, and words that mean "missing" become NULL.  Collapsing
    first leaves only U+0020; the content of an unwrapped literal is deliberately not
    trimmed again.  Each step refers to the one before once, so nothing is evaluated
    twice.
    """
    flat = F.trim(F.regexp_replace(value, UNEVEN_WHITE, " "))
    inner = F.regexp_replace(flat, BYTE_LITERAL, "$1$2")
    return F.nullif(F.regexp_replace(inner, PHANTOM_NULLS, ""), F.lit(""))


def remove_pattern(value: Column, pattern: str) -> Column:
    return F.regexp_replace(value, java_pattern(pattern), "")


STRING_OPTIONS = {
    "convert_to_string": lambda c: c,
    "lowercase": F.lower,
    "strip_whitespace": strip,
    "strip_punctuation": remove_punctuation,
    "strip_underscores": underscores_to_spaces,
    "universal_text_scrubber": scrub,
}


def apply_string_options(value: Column, data_type: T.DataType, options: dict) -> Column:
    """Fold the chosen options, in their given order, into one expression.

    A custom removal pattern always runs last.  Names that are no option are ignored.
    """
    steps = [STRING_OPTIONS[name] for name, on in options.items()
             if on and name in STRING_OPTIONS]
    removal = options.get("custom_removal")
    if isinstance(removal, str) and removal:
        steps.append(lambda c: remove_pattern(c, removal))
    if not steps:
        return value
    result = as_text(value, data_type)
    for step in steps:
        result = step(result)
    return result


def java_replacement(template: str) -> str:
    """A Python substitution template in the notation of Java's regex engine."""
    java = template.replace("$", r"\$")
    java = re.sub(r"\\g<(\w+)>", lambda m: "${%s}" % _group(m[1]) if not m[1].isdigit() else "$" + m[1], java)
    return re.sub(r"\\(\d)", r"$\1", java)


def java_pattern(pattern: str) -> str:
    """A Python pattern in the notation of Java's regex engine, tried out beforehand.

    Named groups and references to them are the same but for ``P``; names lose underscores,
    which Java does not allow.  A pattern Python refuses is refused here, not in a task.
    """
    re.compile(pattern)
    java = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{_group(m[1])}>", pattern)
    java = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\k<{_group(m[1])}>", java)
    return java.replace(r"\Z", r"\z")


def _group(name: str) -> str:
    return name.replace("_", "U95")


def flag_matching(value: Column, pattern: str) -> Column:
    """1 where the text matches the pattern, else 0; missing text gives 0."""
    return F.when(value.rlike(java_pattern(pattern)), 1).otherwise(0)
