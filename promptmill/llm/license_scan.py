"""License scans: phrases, and an exact set-similarity join with templates.

Phrases are found in the word sequence of the whole text. Templates are found by their words: a
block contains a template when it holds at least a given share of the template's distinct words.
Blocks are the lines, and every window over the word sequence of the whole text that is as long as
the template may be spread (its words are then at least the same share of the window), so a notice
is found wherever its lines break. Template words are ordered by how many texts of the corpus hold
them, rarest first. A text with a block that reaches the threshold must hold one of the first
``size - needed + 1`` words of that order (prefix filter); it must have ``needed`` distinct words
of the template at all (length filter); and after a first hit at place p of the order only
``size - p`` words can match (positional filter). What is left is verified in full: its lines, and
the windows that start at a template word and hold ``needed`` template words by count. Templates
are parameters, so their index is a table of a few hundred rows; it is counted over the whole corpus
and broadcast. Documents are never compared with each other and nothing but found blocks is
shuffled.

Defined results: a null text has no words; a block repeated in a document counts each time for
phrases and once for labels; of windows that start less than ``needed`` words apart the best one,
the latest of equals, is a block, which counts as the line that holds the template alone, if there
is one in it, and else as the line it begins in; an empty table gives an empty table; documents
are told apart by identifier and text, so repeated rows are each reported; extra columns do not
reach the result.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.plan import computed

from .common import whole

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("mit license", "mit"), ("apache license", "apache"),
           ("general public license", "gpl"))
# Public license notices that a block is compared with, and their labels.
TEMPLATES = (
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy "
                  "of this software and associated documentation files, to deal in the software "
                  "without restriction"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without "
                  "modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    ("mit-notice", "Released under the MIT License"),
)
THRESHOLD_PERCENT = 80


def lowered(text) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(whole(text), upper, upper.lower())


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def template_words(templates=TEMPLATES) -> dict:
    """Distinct words of each template, in order of appearance."""
    return {label: list(dict.fromkeys(re.findall(WORDS, text.lower())))
            for label, text in templates}


def needed_words(size: int, percent: int = THRESHOLD_PERCENT) -> int:
    return -(-percent * size // 100)


def held_words(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES,
               must=None) -> DataFrame:
    """Texts that hold at least one template word, or one word of ``must``: key, tie, low (the text
    in lower case), tokens (distinct template words in it)."""
    every = sorted({w for words in template_words(templates).values() for w in words})
    low = computed(docs.select(F.col(key).alias("key"), F.xxhash64(whole(text)).alias("tie"),
                               whole(text).alias("text")), low=lowered("text"))
    if must is not None:  # cheap test before words are taken apart
        low = low.where(F.col("low").rlike(f"(?<![0-9a-z])(?:{'|'.join(must)})(?![0-9a-z])"))
    held = computed(low, tokens=F.array_intersect(
        words_of(F.col("low")), F.array(*[F.lit(w) for w in every])))
    return held.where(F.size("tokens") > 0).select("key", "tie", "low", "tokens")


def window_words(text: str, percent: int = THRESHOLD_PERCENT) -> int:
    """Length of a window in words: the template's words, repeats too, are ``percent`` of it."""
    return -(-100 * len(re.findall(WORDS, text.lower())) // percent)


INDEX = ("word string, label string, place int, size int, needed int, "
         "template array<string>, span int")


def prefix_index(spark: SparkSession, held: DataFrame, templates=TEMPLATES,
                 percent: int = THRESHOLD_PERCENT) -> tuple:
    """(word, label, place, size, needed, template, span): the prefix words of each template, rarest in
    the corpus first; and these words as a list. ``held``: texts of the corpus."""
    counts = {r[0]: r[1] for r in held.select(F.explode("tokens").alias("word"))
              .groupBy("word").count().collect()}  # template words only
    rows, spans = [], {label: window_words(text, percent) for label, text in templates}
    for label, words in template_words(templates).items():
        order = sorted(words, key=lambda w: (counts.get(w, 0), w))
        needed = needed_words(len(order), percent)
        rows += [(w, label, place, len(order), needed, order, spans[label])
                 for place, w in enumerate(order[:len(order) - needed + 1])]
    return spark.createDataFrame(rows, INDEX).coalesce(1), sorted({r[0] for r in rows})


def possible(held: DataFrame, index: DataFrame, rare: list) -> DataFrame:
    """Texts with each template that they hold as a whole, at the threshold: only their blocks can
    hold it. ``index``, ``rare``: the prefix words of :func:`prefix_index`."""
    prefix = F.array_intersect("tokens", F.array(*[F.lit(w) for w in rare]))
    hits = held.select("*", F.explode(prefix).alias("word")).join(F.broadcast(index), "word")
    hits = hits.where((F.size("tokens") >= F.col("needed"))
                      & (F.col("size") - F.col("place") >= F.col("needed")))
    # a pair is met once for each prefix word it shares: the rarest one speaks for it
    first = F.element_at(F.filter("template", lambda w: F.array_contains("tokens", w)), 1)
    return hits.where((F.size(F.array_intersect("tokens", "template")) >= F.col("needed"))
                      & (F.col("word") == first))


def contained(hits: DataFrame) -> DataFrame:
    """(key, tie, block, label, containment) of the lines and windows at the threshold, for the
    texts and templates of :func:`possible`."""
    hits = computed(hits, lines=F.transform(F.split("low", "\n"), words_of)).drop("low")
    words = F.flatten(F.transform("lines", lambda ws, n: F.transform(
        ws, lambda w: F.struct(n.alias("line"), w.alias("word")))))
    own = F.filter(F.transform(words, lambda x, i: F.struct(
        i.alias("at"), x["line"].alias("line"), x["word"].alias("word"))),
        lambda x: F.array_contains("template", x["word"]))
    hits = computed(hits, own=own)

    def inside(at, i):
        return F.filter(F.slice("own", i + 1, F.col("span")), lambda x: x["at"] < at + F.col("span"))

    # template words by count first, then the distinct ones
    starts = F.transform("own", lambda p, i: F.when(
        F.get("own", i + F.col("needed") - 1)["at"] < p["at"] + F.col("span"), F.struct(
            F.size(F.array_distinct(F.transform(inside(p["at"], i), lambda x: x["word"])))
            .alias("shared"), p["at"].alias("at"), p["line"].alias("line"), i.alias("i"))))
    found = computed(hits, windows=F.filter(starts, lambda s: s["shared"] >= F.col("needed")))
    best = F.filter("windows", lambda m, k: ~F.exists(
        F.slice("windows", F.greatest(k + 1 - F.col("needed"), F.lit(1)), 2 * F.col("needed")),
        lambda o: (F.abs(o["at"] - m["at"]) < F.col("needed"))
        & ((o["shared"] > m["shared"]) | ((o["shared"] == m["shared"]) & (o["at"] > m["at"])))))

    def line_hits(begin, n_lines):
        return F.filter(F.transform(F.slice("lines", begin + 1, n_lines), lambda ws, n: F.struct(
            F.size(F.array_intersect(ws, "template")).alias("shared"), (n + begin).alias("block"))),
            lambda h: h["shared"] >= F.col("needed"))

    def block(m):
        end = F.element_at(inside(m["at"], m["i"]), -1)["line"]
        alone = F.get(line_hits(m["line"], end - m["line"] + 1), F.lit(0))["block"]
        return F.struct(m["shared"].alias("shared"), F.coalesce(alone, m["line"]).alias("block"))

    every = F.concat(line_hits(F.lit(0), F.size("lines")), F.transform(best, block))
    return found.select("key", "tie", "label", "size", F.inline(every)).select(
        "key", "tie", "block", "label", (F.col("shared") / F.col("size")).alias("containment"))


def phrase_places(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  phrases=PHRASES) -> DataFrame:
    """(key, tie, n_words, hits): where phrases begin; hits are (place, label)."""
    low = computed(docs.select(F.col(key).alias("key"), F.xxhash64(whole(text)).alias("tie"),
                               lowered(text).alias("low")), words=words_of(F.col("low")))

    def starts(phrase, label):
        wanted = phrase.split()
        fits = F.transform("words", lambda w, i: F.when(
            w == wanted[0], F.when(
                F.slice("words", i + 1, len(wanted)) == F.array(*[F.lit(x) for x in wanted]),
                F.struct(i.cast("long").alias("place"), F.lit(label).alias("label")))))
        # only texts that hold every word are searched
        possible = F.lit(True)
        for word in wanted:
            possible = possible & F.contains("low", F.lit(word))
        return F.when(possible, F.filter(fits, lambda x: x.isNotNull()))

    empty = F.array().cast("array<struct<place:bigint,label:string>>")
    return low.select("key", "tie", F.size("words").cast("long").alias("n_words"), F.concat(
        *[F.coalesce(starts(*p), empty) for p in phrases]).alias("hits"))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES,
            templates=TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score (the
    best containment of a template, 0 if none reaches the threshold), n_blocks."""
    index, rare = prefix_index(docs.sparkSession, held_words(docs, key, text, templates),
                               templates, percent)
    held = held_words(docs, key, text, templates, must=rare)
    matched = contained(possible(held, index, rare)).groupBy("key", "tie").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("score"),
        F.count_distinct("block").alias("n_blocks"))
    base = phrase_places(docs, key, text, phrases)
    both = base.join(matched, base["key"].eqNullSafe(matched["key"])
                     & (base["tie"] == matched["tie"]), "left").drop(matched["key"])
    labels = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["label"])))
    none = F.array().cast("array<string>")
    return both.select(
        F.col("key").alias(key), "n_words", F.size("hits").cast("long").alias("n_base"),
        F.array_min(F.transform("hits", lambda h: h["place"])).alias("first_word"),
        F.array_max(F.transform("hits", lambda h: h["place"])).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.coalesce("found", none))), ",")
        .alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))
