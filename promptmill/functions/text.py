"""Scalar text functions as native column expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.params import taxonomy

# Every character Unicode counts as white space, spelled out; the same text works in RE2.
SPACE = (r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# The same set for Java under (?U), where it costs one property lookup per character, and as the
# list of characters that trim takes.
ANY_SPACE = r"[\s\x1c-\x1f]"
SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
    0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))
QUOTED = "['\"][^'\"]{2,}['\"]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove white space of any kind at both ends; null becomes empty."""
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(SPACE_CHARS))


def normalize_prompt(c) -> Column:
    """Collapse runs of white space and trim; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), f"(?U){ANY_SPACE}+", " "))


def word_count(normalized) -> Column:
    """Words of a text that went through :func:`normalize_prompt`."""
    c = col(normalized)
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " ")))


def repeat_ratio(normalized) -> Column:
    """Share of repeated tokens among the ``[a-z0-9]`` tokens, 0 where there are none."""
    cleaned = F.regexp_replace(F.lower(col(normalized)), "[^a-z0-9 ]+", "")
    tokens = F.array_remove(F.split(cleaned, " "), "")

    def ratio(t):
        repeated = F.size(t) - F.size(F.array_distinct(t))
        return F.when(F.size(t) == 0, F.lit(0.0)).otherwise(repeated / F.size(t))

    # The tokens are the argument of a function, so that a text is cut into them once.
    return F.element_at(F.transform(F.array(tokens), ratio), 1)


def comma_count(c) -> Column:
    c = col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def literal(value: str) -> str:
    """SQL text of a string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(columns) -> Column:
    """Short-circuit OR; false for no columns."""
    result = F.lit(False)
    for c in columns:
        result = c if result is None else result | c
    return result


def contains_any(lowered, phrases) -> Column:
    """True when the lower-cased text holds one of the phrases as a substring.

    Given a column name the test is written as one SQL text, which is much quicker to build than
    one call per phrase; the plan is the same.
    """
    phrases = list(dict.fromkeys(p.lower() for p in phrases))
    if phrases and isinstance(lowered, str):
        return F.expr(" OR ".join(f"contains(`{lowered}`, {literal(p)})" for p in phrases))
    return any_of(col(lowered).contains(p) for p in phrases)


def phrase_pattern(phrases) -> str:
    """Whole-phrase pattern; a space in a phrase stands for any run of white space."""
    parts = [re.escape(p.lower().strip()).replace(r"\ ", ANY_SPACE + "+").replace(r"\-", "-")
             for p in phrases if p.strip()]
    return r"(?U)\b(?:" + "|".join(parts) + r")\b"


def contains_phrase(lowered, phrases) -> Column:
    """True when the lower-cased text holds one of the phrases between word boundaries."""
    phrases = [phrases] if isinstance(phrases, str) else [p for p in phrases if p.strip()]
    if not any(p.strip() for p in phrases):
        return F.lit(False)
    return col(lowered).rlike(phrase_pattern(phrases))


def contains_word(lowered, words) -> Column:
    """Whole-word test against a class of words; inner spaces are single spaces."""
    parts = "|".join(re.escape(w).replace(r"\ ", " ").replace(r"\-", "-") for w in words)
    return col(lowered).rlike(r"(?U)\b(?:" + parts + r")\b")


def has_quoted_text(c) -> Column:
    return col(c).rlike(QUOTED)


def has_quote_character(c) -> Column:
    return col(c).contains("'") | col(c).contains('"')


def normalize_tags(tags, fallback=None) -> Column:
    """Tags as an array without nulls; falls back to a second column, then to no tags."""
    columns = [col(tags)] + ([col(fallback)] if fallback is not None else [])
    empty = F.array().cast("array<string>")
    return F.array_compact(F.coalesce(*columns, empty))


def cleanup_generated(c) -> Column:
    """Clean a generated prompt: label prefix, outer quotes, emphasis marks, white space."""
    prefix = (r"(?iu)^(\*{0,2}(corrected[\s]+)?(negative prompt|modified prompt|output|result"
              r"|输出|结果|修改后)\*{0,2})[:：]\s*")
    without_prefix = F.regexp_replace(F.coalesce(col(c), F.lit("")), prefix, "")
    without_quotes = F.regexp_replace(without_prefix, "^['\"]+|['\"]+$", "")
    return normalize_prompt(F.replace(without_quotes, F.lit("*"), F.lit("")))


def normalize_label(c, binary=False) -> Column:
    """Canonical screening label; in binary form everything but pass is fail."""
    value = F.lower(strip(c))
    if binary:
        return F.when(value == "pass", F.lit("pass")).otherwise(F.lit("fail"))
    return (F.when(value.isin("pass", "ok", "yes"), F.lit("pass"))
            .when(value.isin("fail", "no", "reject"), F.lit("fail"))
            .otherwise(F.lit("uncertain")))


def keep_by_policy(label, policy="lenient") -> Column:
    kept = ["pass", "uncertain"] if policy == "lenient" else ["pass"]
    return col(label).isin(*kept)


def confidence(c) -> Column:
    """Number in [0, 1]; anything that is not a number becomes 0."""
    number = F.coalesce(col(c).try_cast("double"), F.lit(0.0))
    # Python's max/min chain turns NaN into the upper bound; here NaN counts as no number.
    number = F.when(F.isnan(number), F.lit(0.0)).otherwise(number)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))


def style_anchor(prompt, style, anchors=None) -> Column:
    """Put the anchor of a style before the prompt; an unknown style changes nothing."""
    anchors = anchors or taxonomy.STYLE_ANCHORS
    result = None
    for name, anchor in anchors.items():
        value = F.concat(F.lit(f"{anchor} "), col(prompt))
        result = (F.when(col(style) == name, value) if result is None
                  else result.when(col(style) == name, value))
    return result.otherwise(col(prompt))


def feedback(failure, notes) -> Column:
    """Retry feedback by failure type, followed by the judge's notes."""
    failure, notes = col(failure), col(notes)
    text = None
    for name, message in taxonomy.FEEDBACK.items():
        text = (F.when(failure == name, F.lit(message)) if text is None
                else text.when(failure == name, F.lit(message)))
    text = text.when(F.coalesce(failure, F.lit("")) != "",
                     F.concat(F.lit("Failure type: "), failure))
    noted = F.when(F.coalesce(notes, F.lit("")) != "", F.concat(F.lit("VLM notes: "), notes))
    joined = F.concat_ws(" | ", text, noted)
    return F.when(joined == "", F.lit(taxonomy.FEEDBACK_DEFAULT)).otherwise(joined)


def iso_timestamp(c) -> Column:
    """ISO-8601 text as a timestamp; invalid text becomes null."""
    return F.try_to_timestamp(col(c))


def elapsed_seconds(start, end) -> Column:
    return (F.unix_micros(col(end)) - F.unix_micros(col(start))) / F.lit(1e6)


def percent(part, whole, digits=2) -> Column:
    """Percentage rounded half to even, 0 for an empty whole."""
    ratio = F.bround(col(part) / F.nullif(col(whole), F.lit(0)) * 100, digits)
    return F.coalesce(ratio, F.lit(0.0))


def rate(part, whole, digits=4) -> Column:
    """Ratio rounded half to even, 0 for an empty whole."""
    return F.coalesce(F.bround(col(part) / F.nullif(col(whole), F.lit(0)), digits), F.lit(0.0))
