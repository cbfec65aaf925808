"""Rule-based rewriting of prompts: quality boosters go, seeded degradation keywords come."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import keys
from promptmill.functions.text import SPACE_CHARS, col
from promptmill.session import param_table

# Phrases that praise the picture instead of saying what is in it.
BOOSTERS = ["masterpiece", "best quality", "high quality", "ultra detailed", "8k", "award winning"]
OTHER = r"[^\p{L}\p{M}\p{N}_]"      # no word character of any script
SINGLE_SHARE, END_SHARE = 0.5, 0.7


def phrase_pattern(phrases) -> str:
    """A run of whole phrases, the longest that fits at each place, with what stands around it.

    The same text works in Java and RE2.
    """
    longest = sorted({p.lower() for p in phrases}, key=lambda p: (-len(p), p))
    either = "|".join(re.sub(r"\\? ", r"[ ]+", re.escape(p)) for p in longest)
    return rf"(?i)(^|{OTHER})(?:{either})(?:{OTHER}+(?:{either}))*(\z|{OTHER})"


def without_phrases(prompt, phrases=BOOSTERS) -> Column:
    """The prompt without the phrases, its commas and spaces mended; null becomes empty.

    Phrases are whole words in any case; where several begin at one place, the longest goes, and a
    phrase that holds a shorter one goes as a whole. Text between phrases stays.
    """
    text = F.coalesce(col(prompt), F.lit(""))
    text = F.regexp_replace(text, F.lit(phrase_pattern(phrases)), F.lit("$1$2"))
    text = F.regexp_replace(text, F.lit(" *,(?: *,)+"), F.lit(","))
    text = F.regexp_replace(text, F.lit(" +,"), F.lit(","))
    text = F.regexp_replace(text, F.lit(" +"), F.lit(" "))
    return F.btrim(text, F.lit(SPACE_CHARS + ","))


def degraded(df: DataFrame, keywords, seed, prompt="prompt", id_col="record_id",
             boosters=BOOSTERS) -> DataFrame:
    """Rows with ``degraded``: boosters removed, then 1 to 3 keywords at an end of the prompt.

    ``keywords``: rows (dimension, severity, list of keywords); ``df`` has dimension and severity.
    One keyword with a share of one half, else two or three (as many as there are); behind the
    prompt with a share of 0.7, else in front. Keywords are drawn without repetition, in the order
    of a hash of seed, row and keyword: inside the row, over the short list of its dimension and
    severity. Rows without keywords lose their boosters only; a prompt that is nothing but boosters
    becomes its keywords.
    """
    table = param_table(df.sparkSession, [(d, s, sorted(set(k))) for d, s, k in keywords],
                        "dimension string, severity string, _keywords array<string>")
    salt = F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string"), F.lit("|"))

    def fraction(name):
        return keys.hash_fraction(F.md5(F.concat(salt, F.lit(name))))

    n = F.when(fraction("single") < SINGLE_SHARE, 1).when(fraction("pair") < 0.5, 2).otherwise(3)
    drawn = F.array_sort(F.transform("_keywords", lambda k: F.struct(
        F.md5(F.concat(salt, F.lit("keyword|"), k)).alias("h"), k.alias("k"))))
    drawn = F.array_join(F.transform(F.slice(drawn, 1, n), lambda d: d["k"]), ", ")
    rows = df.join(table, ["dimension", "severity"], "left")
    rows = rows.withColumn("_clean", without_phrases(prompt, boosters)).withColumn(
        "_drawn", F.coalesce(drawn, F.lit("")))
    parts = F.when(fraction("place") < END_SHARE, F.array("_clean", "_drawn")).otherwise(
        F.array("_drawn", "_clean"))
    return rows.withColumn("degraded", F.array_join(F.filter(
        parts, lambda p: p != ""), ", ")).withColumn(
        "n_keywords", F.least(n, F.size(F.coalesce("_keywords", F.array())))).drop(
        "_keywords", "_clean", "_drawn")
