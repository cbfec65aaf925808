"""Quality rules, line first, in native expressions.

Each line is judged on its own: it fails if it does not end like a sentence, if it is navigation
(a menu of separated entries or of the usual page links), or if it is boilerplate (a stock phrase
of web pages, or a line of symbols). Failing lines are removed; a document that keeps less than
half of its characters in words is rejected, as is one that fails the base rules (too few words,
too many words in repeated five-word windows).

Everything is computed inside the row: no shuffle, whatever the length or the repetition.

Defined results: a null text is a text without words and is rejected; blank lines are kept; an
empty table gives an empty table; extra columns are carried, those with the name of a result
column are replaced.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.plan import computed

from .common import WORD, whole

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
MIN_LEFT_PERCENT = 50
SPACE = r"[\x20\x09-\x0D]+"
# A line ends like a sentence: a final mark, then closing quotes, brackets or white space.
SENTENCE_END = "[.!?…。！？][\"'”’»)\\]\\x20\\x09-\\x0D]*$"
MENU_WORDS = ("home|menu|log ?in|sign ?in|sign ?up|register|next|previous|prev|back to top|"
              "skip to content|read more|share|print|search|sitemap|contact us|about us")
NAVIGATION = rf"(?i)^\s*(?:{MENU_WORDS})(?:\s*[|>»•/·]?\s*(?:{MENU_WORDS}))*[\s.!]*$"
SEPARATORS = (" | ", " » ", " • ")
MENU_ENTRIES = 4
BOILERPLATE = (r"(?i)all rights reserved|accept (?:all )?cookies|uses cookies|cookie policy|"
               r"enable javascript|privacy policy|terms of (?:use|service)|lorem ipsum|"
               r"subscribe to our newsletter|click here|404 not found")
SYMBOL_PERCENT = 10


def words_of(text) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def symbol_count(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))


def line_passes(line: Column) -> Column:
    blank = ~line.rlike(WORD)
    symbols = symbol_count(line) * 100 > F.char_length(line) * SYMBOL_PERCENT
    menu = line.rlike(NAVIGATION)
    for mark in SEPARATORS:
        bare = F.char_length(F.replace(line, F.lit(mark), F.lit("")))
        menu = menu | (F.char_length(line) - bare >= len(mark) * (MENU_ENTRIES - 1))
    fails = ~line.rlike(SENTENCE_END) | symbols | menu | line.rlike(BOILERPLATE)
    return blank | ~fails


def _covered(places: Column) -> Column:
    """Words under windows that start at the given ascending places."""
    steps = F.transform(places, lambda at, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(places, i + 1), at + WINDOW) - at))
    return F.aggregate(steps, F.lit(0), lambda total, n: total + n)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the
    private column ``_lines``."""
    df = computed(docs, _words=words_of(text), _lines=F.split(whole(text), "\n"))
    last = F.size("_words") - WINDOW
    grams = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])))
    df = computed(df, _grams=F.coalesce(grams, F.array().cast("array<bigint>")))
    repeats = F.size("_grams") > F.size(F.array_distinct("_grams"))
    # windows in hash order: a repeated one has an equal neighbour
    df = computed(df, _sorted=F.when(repeats, F.sort_array(F.transform(
        "_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def same(a, b):
        """Equal hashes, and equal words behind them."""
        return (a["h"] == b["h"]) & (F.slice("_words", a["i"] + 1, WINDOW)
                                     == F.slice("_words", b["i"] + 1, WINDOW))

    def repeated(x, j):
        after = F.coalesce(same(x, F.get("_sorted", j + 1)), F.lit(False))
        return after | F.when(j > 0, same(x, F.get("_sorted", j - 1))).otherwise(False)

    df = computed(df, _places=F.sort_array(F.transform(
        F.filter("_sorted", repeated), lambda x: x["i"])))
    full_lines = F.filter("_lines", lambda line: line.rlike(WORD))
    df = computed(
        df.drop("_sorted", "_grams"),
        n_words=F.size("_words").cast("long"),
        word_chars=F.char_length(F.regexp_replace(whole(text), SPACE, "")).cast("long"),
        n_symbols=symbol_count(whole(text)).cast("long"),
        n_dup_lines=(F.size(full_lines) - F.size(F.array_distinct(full_lines))).cast("long"),
        n_repeat_words=F.coalesce(_covered(F.col("_places")), F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.drop("_words", "_places").withColumn("base_failed", failed)


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the base columns, ``cleaned_text``, ``n_removed_lines``, ``left_chars``
    (characters in words left by the line rules) and ``kept``."""
    df = computed(with_base(docs, text), _good=F.filter("_lines", line_passes))
    df = computed(df, cleaned_text=F.array_join("_good", "\n"),
                  n_removed_lines=(F.size("_lines") - F.size("_good")).cast("long"))
    df = computed(df, left_chars=F.char_length(
        F.regexp_replace("cleaned_text", SPACE, "")).cast("long"))
    enough = 100 * F.col("left_chars") >= MIN_LEFT_PERCENT * F.col("word_chars")
    return df.drop("_lines", "_good").withColumn("kept", ~F.col("base_failed") & enough)


def cleaned(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that stay, with their cleaned text, in the columns of the input."""
    kept = judged(docs, text).where("kept").withColumn(text, F.col("cleaned_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length(text).cast("long"))
    return kept.select(*docs.columns)
