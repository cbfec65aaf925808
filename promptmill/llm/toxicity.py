"""Toxicity by a convolutional text classifier.

A text is the sequence of its lower-cased words (runs of letters). A word's vector is the sum of
hashed embeddings: of the word and of its beginnings, so compounds share what their stems have
learned. Filters one, two and three words wide slide over the whole sequence; the largest answer of
each filter goes to a logistic output. Embeddings, filters and output are trained in numpy by
back-propagation on all labelled texts that are not held out; buckets that occur in fewer than
``MIN_TEXTS`` of them keep no embedding, so words of a single text cannot be learned by heart.
Embeddings begin with the log odds of their bucket in one direction, which the first filter of each
width reads.

Labelled texts are dealt by a hash into shards of about ``SHARD_TEXTS`` texts and ``SHARD_CHARS``
characters at most, each a row of word numbers in a written table. Buckets are counted over all
shards; each shard then trains all epochs from the same beginning, and what the shards have learned
is averaged: an embedding over the shards that moved it, filters and output over all.

Thresholds are calibrated by language on every fourth text of a shard's class, which training does
not see. The language is told from the text alone, by the commonest function words. A language's
threshold (or that of all texts, where the language has too few toxic ones) is moved to the score
0.7.

What reaches the driver is bounded by the number of buckets, besides ten bytes for each calibrating
text. Scoring reads every whole text where it lies, without a shuffle; the model is an argument of
the job.

Defined results: a null or empty text, or one without letters, has the score of a text without any
evidence; null labels and labels without a document teach nothing; a document labelled twice is
toxic if one label says so; repeated rows are scored each; without labels of both classes every
score is 0; a null identifier is not held out; an empty table gives an empty table; extra columns
do not reach the result.
"""

import math
import re
import zlib
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole, written

SAMPLE = 4_000            # labelled_sample: texts of each class, characters of all and of one
SAMPLE_CHARS = 24_000_000
LONGEST = 400_000
SHARD_TEXTS = 8_000
SHARD_CHARS = 24_000_000
MANY_LABELS = 1_000_000   # more are not marked for broadcast
CALIBRATION = 4           # every fourth text of a class calibrates
MIN_TEXTS = 4
LEAST_TOXIC = 8           # toxic calibration texts for a threshold of a language's own
BUCKET_BITS = 20
BLOCK = 1 << 14           # buckets or embeddings that are summed up together
BEGINNINGS = (3, 4, 5, 7)
SIZE = 12                 # of an embedding
WIDTHS = (1, 2, 3)
FILTERS = 8               # of each width
EPOCHS = 4
BATCH = 16
RATE = 0.05
THRESHOLD = 0.7
ROWS = 256
CACHE_WORDS = 200_000
# Common function words of the languages told apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with was on are by this from at or an".split(),
    "de": "der die das und ist nicht mit ein eine zu den von auf sich auch im dem".split(),
    "fr": "le la les des et est une dans que pour qui pas sur un du au elle".split(),
    "es": "el los las y es una por con para del que en se no su como lo".split()}
OTHER = "other"
LANGUAGES = [*FUNCTION_WORDS, OTHER]
_WORD = re.compile(r"[^\W\d_]+")
_LANGUAGE = {w: tuple(i for i, some in enumerate(FUNCTION_WORDS.values()) if w in some)
             for some in FUNCTION_WORDS.values() for w in some}
_BEGIN = crc32(b"^")
RESULT = "doc_id long, held_out boolean, score double, predicted int"


def words_of(text) -> list:
    return _WORD.findall((text or "").lower())


def language_of(words) -> str:
    """The language whose function words are most frequent; ``other`` without any."""
    votes = [0] * len(FUNCTION_WORDS)
    for w in filter(_LANGUAGE.__contains__, words):
        for i in _LANGUAGE[w]:
            votes[i] += 1
    return list(FUNCTION_WORDS)[votes.index(max(votes))] if max(votes) else OTHER


def buckets_of(word: str) -> list:
    """The buckets of a word and its beginnings."""
    mask = (1 << BUCKET_BITS) - 1
    out, code, at = [crc32(word.encode()) & mask], _BEGIN, 0
    for n in BEGINNINGS:
        if len(word) <= n:
            break
        code = crc32(word[at:n].encode(), code)
        out.append(code & mask)
        at = n
    return out


class Lookup:
    """Distinct words as numbers, and for each new one the rows of the embedding table it sums up.
    Number 0 is the empty word behind a text."""

    def __init__(self, row_of: np.ndarray):
        self.row_of, self.number, self.new = row_of, {"": 0}, [""]

    def __call__(self, words) -> np.ndarray:
        for w in sorted(set(words).difference(self.number)):
            self.number[w] = len(self.number)
            self.new.append(w)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def learn(self):
        """Rows of the words that are new since the last call, with the place of each word among
        them, and how many words that are."""
        words, self.new = self.new, []
        flat, owner = _flat([buckets_of(w) if w else [] for w in words])
        rows = self.row_of[flat]
        return rows[rows >= 0], owner[rows >= 0], len(words)


def _flat(lists):
    """Lists of numbers as one array, with the place of each list."""
    lengths = np.array([len(x) for x in lists], np.int64)
    flat = np.fromiter((r for x in lists for r in x), np.int64, int(lengths.sum()))
    return flat, np.repeat(np.arange(len(lists)), lengths)


@dataclass
class Shard:
    """Labelled texts as numbers of their words; word 0 is the empty one."""
    numbers: np.ndarray       # words of all texts, one text after the other
    lengths: np.ndarray       # words of each text
    toxic: np.ndarray
    spoken: np.ndarray        # each text's language, by its place in LANGUAGES
    buckets: np.ndarray       # of all distinct words, one word after the other
    widths: np.ndarray        # buckets of each distinct word

    def later(self) -> np.ndarray:
        """Which texts calibrate: every fourth of each class."""
        number = np.zeros(len(self.toxic), np.int64)
        for label in (0, 1):
            number[self.toxic == label] = np.arange((self.toxic == label).sum())
        return number % CALIBRATION == CALIBRATION - 1

    def texts(self) -> list:
        return np.split(self.numbers, np.cumsum(self.lengths)[:-1]) if len(self.lengths) else []


FIELDS = {"numbers": "<u4", "lengths": "<i4", "toxic": "u1", "spoken": "u1", "buckets": "<i4",
          "widths": "u1"}


def shard_of(texts, toxic) -> Shard:
    number, widths, buckets = {"": 0}, [0], []
    numbers, lengths, spoken = [np.empty(0, "<u4")], [], []
    for text in texts:
        words = words_of(text)
        for w in sorted(set(words).difference(number)):
            number[w] = len(number)
            own = buckets_of(w)
            widths.append(len(own))
            buckets += own
        numbers.append(np.fromiter(map(number.__getitem__, words), "<u4", len(words)))
        lengths.append(len(words))
        spoken.append(LANGUAGES.index(language_of(words)))
    some = np.concatenate(numbers), lengths, toxic, spoken, buckets, widths
    return Shard(*[np.asarray(x, kind) for x, kind in zip(some, FIELDS.values())])


def _chosen(flat: np.ndarray, cuts: np.ndarray, some: np.ndarray):
    """Of lists laid one after the other, those chosen as one array, and how long each is."""
    sizes = cuts[some + 1] - cuts[some]
    at = np.arange(int(sizes.sum())) + np.repeat(cuts[some] - (np.cumsum(sizes) - sizes), sizes)
    return flat[at], sizes


def _summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of rows over consecutive runs of so many each."""
    out = np.zeros((len(sizes), values.shape[1]), values.dtype)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full], axis=0)
    return out


def bucket_counts(shard: Shard) -> np.ndarray:
    """In how many training texts of each class every bucket occurs."""
    found = np.zeros((2, 1 << BUCKET_BITS), np.int32)
    cuts = np.concatenate(([0], np.cumsum(shard.widths, dtype=np.int64)))
    for own, label, later in zip(shard.texts(), shard.toxic, shard.later()):
        if not later:
            found[int(label), np.unique(_chosen(shard.buckets, cuts, np.unique(own))[0])] += 1
    return found


def rows_by_bucket(buckets: np.ndarray) -> np.ndarray:
    """The row of each bucket in the embedding table, -1 without one."""
    out = np.full(1 << BUCKET_BITS, -1, np.int32)
    out[buckets] = np.arange(len(buckets))
    return out


# ---- the network -------------------------------------------------------------------------------

@dataclass
class Model:
    buckets: np.ndarray       # those that have an embedding
    table: np.ndarray         # their embeddings
    filters: list             # for each width: (width, size, filters)
    biases: list
    weights: np.ndarray
    offset: float
    thresholds: dict          # logit that becomes the score 0.7, by language
    certain: bool = True      # False: nothing could be learned


def _pad(lengths: np.ndarray):
    """Places of words in a sequence with empty words behind each text, the texts' starts, and the
    empty places where no window begins: windows begin at words and at the first empty one."""
    gap = max(WIDTHS)
    starts = np.concatenate(([0], np.cumsum(lengths + gap)))[:-1]
    place = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)) * gap, lengths)
    return place, starts, ((starts + lengths)[:, None] + np.arange(1, gap)).ravel()


def _answers(vectors, starts, dead, filters, biases):
    """The largest answer of every filter in every text, and where it was."""
    tops, places = [], []
    n = len(vectors)
    bounds = np.append(starts, n)
    for weight, bias in zip(filters, biases):
        answer = np.tile(bias, (n, 1))
        for k in range(len(weight)):
            answer[:n - k] += vectors[k:] @ weight[k]
        answer[dead] = -np.inf
        # the first place of the largest answer
        at = np.array([a + answer[a:b].argmax(axis=0) for a, b in zip(bounds[:-1], bounds[1:])])
        places.append(at)
        tops.append(np.take_along_axis(answer, at, axis=0))
    return tops, places


def _begun(seed: int = 11):
    """A generator of random numbers, and filters, biases, weights and the offset; all shards begin
    with those of the same seed."""
    rng = np.random.default_rng(seed)
    filters = [(rng.standard_normal((w, SIZE, FILTERS)) * (0.3 / np.sqrt(w * SIZE)))
               .astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, :, 0] = 0
        f[:, 0, 0] = 1
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    weights = (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.1).astype(np.float32)
    weights[::FILTERS] = 0.3
    return rng, [*filters, *biases, weights, np.zeros(1, np.float32)]


def _turns(calm, bad):
    """Batches with as many texts of either class; the class with fewer texts begins again."""
    share = max(1, BATCH // 2)
    for at in range(0, max(len(calm), len(bad)), share):
        yield np.concatenate([
            c[at:at + share] if len(c) >= max(len(calm), len(bad))
            else np.take(c, np.arange(at, at + share), mode="wrap") for c in (calm, bad) if len(c)])


def _train(shard: Shard, row_of, table, number: int = 0):
    """The trained table, filters, biases, weights and the offset in a list, and the rows of the
    table that moved."""
    rng, dense = _begun(11 + number)[0], _begun()[1]
    none = len(table)
    table = np.concatenate((table, np.zeros((1, SIZE), np.float32)))     # the last is no bucket's
    params = [table, *dense]
    filters, biases = dense[:len(WIDTHS)], dense[len(WIDTHS):2 * len(WIDTHS)]
    weights, offset = dense[-2:]
    speed = [np.full(p.shape, 0.01, np.float32) for p in params]
    texts, later, toxic = shard.texts(), shard.later(), shard.toxic.astype(np.float32)
    rows = np.full((len(shard.widths), 1 + len(BEGINNINGS)), none, np.int32)
    rows[np.arange(rows.shape[1]) < shard.widths[:, None]] = row_of[shard.buckets]
    rows[rows < 0] = none
    moved = np.zeros(len(table), bool)

    def step(i, gradient, part=slice(None)):
        speed[i][part] += gradient * gradient
        params[i][part] -= RATE * gradient / np.sqrt(speed[i][part])

    classes = [np.flatnonzero(~later & (shard.toxic == label)) for label in (0, 1)]
    for _ in range(EPOCHS):
        for some in _turns(*[rng.permutation(c) for c in classes]):
            lengths = np.array([len(texts[i]) for i in some])
            numbers = np.concatenate([texts[i] for i in some])
            place, starts, dead = _pad(lengths)
            distinct, back = np.unique(numbers, return_inverse=True)
            known = table[rows[distinct, 0]]
            for column in range(1, rows.shape[1]):
                known += table[rows[distinct, column]]
            vectors = np.zeros((int(lengths.sum()) + len(some) * max(WIDTHS), SIZE), np.float32)
            vectors[place] = known[back]
            of = np.full(len(vectors), -1)
            of[place] = back
            tops, places = _answers(vectors, starts, dead, filters, biases)
            pooled = np.maximum(np.concatenate(tops, axis=1), 0)
            logit = pooled @ weights + offset[0]
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic[some]) / len(some)
            error = error.astype(np.float32)
            back_pooled = np.outer(error, weights) * (pooled > 0)
            words, given = [], []
            base = 1 + len(WIDTHS)
            for j, weight in enumerate(filters):
                share_of = back_pooled[:, j * FILTERS:(j + 1) * FILTERS]
                slope = np.zeros_like(weight)
                for k in range(len(weight)):
                    at_word = places[j] + k
                    inside = at_word < len(vectors)
                    at_word = np.minimum(at_word, len(vectors) - 1)
                    held = share_of * inside
                    slope[k] = np.einsum("tfs,tf->sf", vectors[at_word], held)
                    word = of[at_word]
                    ok = (word >= 0) & (held != 0)
                    words.append(word[ok])
                    given.append((held[:, :, None] * weight[k].T[None])[ok])
                step(1 + j, slope)
                step(base + j, share_of.sum(axis=0))
            step(base + len(WIDTHS), pooled.T @ error + 1e-4 * weights)
            step(base + len(WIDTHS) + 1, np.array([error.sum()], np.float32))
            # the slopes of words, then of the rows that words sum up
            words, given = np.concatenate(words), np.concatenate(given)
            order = np.argsort(words, kind="stable")
            words, counts = np.unique(words, return_counts=True)
            grown = _summed(given[order], counts)
            flat = rows[distinct[words]].ravel()
            order = np.argsort(flat, kind="stable")
            touched, counts = np.unique(flat, return_counts=True)
            step(0, _summed(grown[order // rows.shape[1]], counts), touched)
            moved[touched] = True
            table[none] = 0
    return table[:none], dense, np.flatnonzero(moved[:none])


def _log_odds(seen, totals) -> np.ndarray:
    """How much oftener than by chance each bucket occurs in toxic texts."""
    return np.log((seen[1] + 0.2) / (totals[1] + 0.4)) - np.log((seen[0] + 0.2) / (totals[0] + 0.4))


def _beginning(found: np.ndarray, totals):
    """The buckets of enough training texts, and their embeddings before training."""
    buckets = np.flatnonzero(found.sum(axis=0) >= MIN_TEXTS)
    table = (np.random.default_rng(7).standard_normal((len(buckets), SIZE)) * 0.05) \
        .astype(np.float32)
    table[:, 0] = np.clip(_log_odds(found[:, buckets], totals), -4, 4) / 4
    return buckets, table


def _model(buckets, table, dense) -> Model:
    n = len(WIDTHS)
    return Model(buckets, table, dense[:n], dense[n:2 * n], dense[-2], float(dense[-1][0]), {})


NOTHING = Model(np.empty(0, np.int64), np.zeros((0, SIZE), np.float32), [], [],
                np.empty(0, np.float32), 0.0, {}, False)


def _best_threshold(logits, toxic) -> float:
    """The middle of the gap that divides the classes with the largest F1."""
    order = np.argsort(-logits, kind="stable")
    ranked, hits = logits[order], np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    best = int(np.argmax(f1))
    below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 2
    return float((ranked[best] + below) / 2)


def _calibrated(model: Model, logits, toxic, spoken) -> Model:
    """The model with thresholds, from all calibrating texts."""
    toxic = toxic.astype(np.int64)
    model.thresholds[OTHER] = _best_threshold(logits, toxic)
    for i, name in enumerate(FUNCTION_WORDS):
        own = spoken == i
        if toxic[own].sum() >= LEAST_TOXIC and (toxic[own] == 0).any():
            model.thresholds[name] = _best_threshold(logits[own], toxic[own])
    return model


def _both(toxic) -> bool:
    return bool((toxic == 0).any() and (toxic == 1).any())


def fit(texts, toxic) -> Model:
    """A model of labelled texts, in the order given, as one shard; every fourth of each class
    calibrates."""
    shard = shard_of(texts, toxic)
    later = shard.later()
    if not _both(shard.toxic[~later]):
        return NOTHING
    buckets, table = _beginning(bucket_counts(shard),
                                np.bincount(shard.toxic[~later], minlength=2))
    table, dense, _ = _train(shard, rows_by_bucket(buckets), table)
    model = _model(buckets, table, dense)
    kept = later if _both(shard.toxic[later]) else np.ones(len(later), bool)
    return _calibrated(model, shard_logits(model, shard, kept), shard.toxic[kept],
                       shard.spoken[kept])


def _word_parts(model: Model, rows, owner, count: int) -> np.ndarray:
    """What each word adds to the answers of a window of each width, by its place in there."""
    vectors = _summed(model.table[rows], np.bincount(owner, minlength=count))
    turn = np.concatenate([f[k] for f in model.filters for k in range(len(f))], axis=1)
    return vectors @ turn


def _logit(model: Model, parts, own) -> float:
    """Of a text given by the numbers of its words."""
    pooled, column = [], 0
    sequence = np.concatenate((own, np.zeros(max(WIDTHS), own.dtype)))
    for width, bias in zip(WIDTHS, model.biases):
        # a word that comes again adds nothing to windows one word wide
        rows = np.unique(sequence) if width == 1 else sequence
        windows = len(rows) - width + 1
        answer = np.zeros((windows, FILTERS), np.float32)
        for k in range(width):
            answer += parts[rows[k:k + windows], column:column + FILTERS]
            column += FILTERS
        pooled.append(answer.max(axis=0) + bias)
    pooled = np.maximum(np.concatenate(pooled), 0)
    return float(pooled @ model.weights) + model.offset


def shard_logits(model: Model, shard: Shard, kept) -> np.ndarray:
    rows = rows_by_bucket(model.buckets)[shard.buckets]
    owner = np.repeat(np.arange(len(shard.widths)), shard.widths)
    parts = _word_parts(model, rows[rows >= 0], owner[rows >= 0], len(shard.widths))
    texts = shard.texts()
    return np.array([_logit(model, parts, texts[i]) for i in np.flatnonzero(kept)])


class Scorer:
    """Scores of texts under a model; the words it has met are kept."""

    def __init__(self, model: Model):
        self.model = model
        self.row_of = rows_by_bucket(model.buckets)
        self._forget()

    def _forget(self):
        self.lookup = Lookup(self.row_of)
        self.parts = np.zeros((1 << 14, sum(WIDTHS) * FILTERS), np.float32)
        self.learnt = 0

    def _learn(self):
        rows, owner, new = self.lookup.learn()
        total = self.learnt + new
        if total > len(self.parts):
            larger = np.zeros((max(total, 2 * len(self.parts)), self.parts.shape[1]), np.float32)
            larger[:self.learnt] = self.parts[:self.learnt]
            self.parts = larger
        self.parts[self.learnt:total] = _word_parts(self.model, rows, owner, new)
        self.learnt = total

    def logits(self, word_lists) -> np.ndarray:
        if self.learnt > CACHE_WORDS:
            self._forget()
        numbers = [self.lookup(w) for w in word_lists]
        if self.lookup.new:
            self._learn()
        return np.array([_logit(self.model, self.parts, own) for own in numbers])

    def scores(self, texts) -> np.ndarray:
        """0 to 1; the threshold of the text's language is the score 0.7."""
        if not self.model.certain:
            return np.zeros(len(texts))
        words = [words_of(t) for t in texts]
        cut = self.model.thresholds
        at = np.array([cut.get(language_of(w), cut[OTHER]) for w in words])
        moved = self.logits(words) - at + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(moved, -500, 500)))


# ---- on Spark --------------------------------------------------------------------------------

def is_held_out(key) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def known_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """key, label: those that are not held out, 1 if one label of a document says so."""
    return (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~is_held_out(key))
            .groupBy(F.col(key).cast("long").alias("key")).agg(F.max(label).alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "toxic", size: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list:
    """(text, label) of a bounded sample of labelled documents that are not held out, in the
    order of a hash, for a model made by :func:`fit` on one machine."""
    spark = docs.sparkSession
    known = known_labels(labels, key, label)
    order = F.xxhash64("key", F.lit(13))
    picked = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(order, "key").limit(size)
        picked = some if picked is None else picked.unionByName(some)
    picked = picked.collect()
    if not picked:
        return []
    keys = spark.createDataFrame([(r["key"], int(r["label"])) for r in picked],
                                 "key long, label int")
    rows = docs.select(F.col(key).cast("long").alias("key"), whole(text).alias("text")) \
        .where(F.char_length("text") <= LONGEST)
    # at most 2 * size rows on either side of the aggregation
    held = rows.join(F.broadcast(keys), "key").groupBy("key", "label").agg(
        F.min("text").alias("text"))
    held = written(held.withColumn("length", F.char_length("text")), "labelled-sample")
    inside, taken, total = [], [], 0
    for r in held.select("key", "length").orderBy(order, "key").collect():
        if total + r["length"] <= chars:
            inside.append(r["key"])
            total += r["length"]
    if not inside:
        return []
    few = F.broadcast(spark.createDataFrame([(k,) for k in inside], "key long"))
    for r in held.join(few, "key").orderBy(order, "key").toLocalIterator():
        taken.append((r["text"], r["label"]))
    return taken


def _score(model: Model):
    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                scores = scorer.scores(rows.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(scores),
                     pa.array((scores >= THRESHOLD).astype(np.int32))],
                    [c.split()[0] for c in RESULT.split(", ")])
    return run


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), is_held_out(key).alias("held_out"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(_score(model), RESULT)


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    """One shard as a row; of texts with the same key the smallest counts."""
    frame = frame.sort_values(["turn", "key", "text"], kind="stable").drop_duplicates("key")
    shard = shard_of(frame["text"], frame["label"])
    return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])],
                         **{c: [getattr(shard, c).tobytes()] for c in FIELDS}})


def labelled_shards(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "toxic") -> DataFrame:
    """All labelled documents that are not held out, a row for each shard of them."""
    known = written(known_labels(labels, key, label), "known-labels")
    if known.count() <= MANY_LABELS:
        known = F.broadcast(known)
    rows = docs.select(F.col(key).cast("long").alias("key"), whole(text).alias("text")).join(
        known, "key")
    texts, chars = rows.agg(F.count(F.lit(1)), F.sum(F.char_length("text").cast("long"))).first()
    count = max(1, math.ceil(texts / SHARD_TEXTS), math.ceil((chars or 0) / SHARD_CHARS))
    turn = F.xxhash64("key", F.lit(13))
    rows = rows.withColumn("turn", turn).withColumn("shard", F.pmod(
        F.xxhash64("key", F.lit(14)), F.lit(count)))
    return written(rows.repartition(2 * count, "shard").groupBy("shard").applyInPandas(
        _pack, "shard long, " + ", ".join(f"{c} binary" for c in FIELDS)), "labelled-shards")


def _shards(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            yield row.pop("shard"), Shard(*[np.frombuffer(row[c], kind)
                                            for c, kind in FIELDS.items()])


def _counted(batches):
    """The counts of all shards of a task for every block of buckets, and in block -1 of the
    training and of the calibrating texts of each class."""
    found, texts = np.zeros((2, 1 << BUCKET_BITS), np.int32), np.zeros(4, np.int32)
    for _, shard in _shards(batches):
        found += bucket_counts(shard)
        texts += np.bincount(2 * shard.later() + shard.toxic, minlength=4).astype(np.int32)
    if texts.any():
        blocks = [texts, *found.reshape(2, -1, BLOCK).swapaxes(0, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, len(blocks) - 1), pa.int64()),
             pa.array([zlib.compress(b.tobytes(), 1) for b in blocks], pa.binary())],
            ["block", "data"])


def _add_counts(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(d), np.int32).astype(np.int64) for d in frame["data"])
    return pd.DataFrame({"block": frame["block"].iloc[:1],
                         "data": [zlib.compress(total.tobytes(), 1)]})


def _trained(buckets, table):
    """What each shard has learned: the filters and the output in block -1, and by block the rows of
    the table that moved."""
    def run(batches):
        row_of = rows_by_bucket(buckets)
        for number, shard in _shards(batches):
            if not (~shard.later()).any():
                continue
            own, dense, moved = _train(shard, row_of, table, number)
            out = [(-1, np.concatenate([p.ravel() for p in dense]).tobytes())]
            cuts = np.searchsorted(moved, np.arange(0, len(table) + BLOCK, BLOCK))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    out.append((i, (moved[a:b] - i * BLOCK).astype("<u2").tobytes()
                                + own[moved[a:b]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int64()), pa.array([number] * len(out), pa.int64()),
                 pa.array([d for _, d in out], pa.binary())], ["block", "shard", "data"])
    return run


def _open_rows(data: bytes):
    """Rows inside a block, and their embeddings."""
    n = len(data) // (2 + 4 * SIZE)
    return np.frombuffer(data, "<u2", n), np.frombuffer(data, np.float32, n * SIZE, 2 * n) \
        .reshape(n, SIZE)


def _averaged(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("shard")
    block = int(frame["block"].iloc[0])
    if block < 0:
        data = np.mean([np.frombuffer(d, np.float32) for d in frame["data"]], axis=0,
                       dtype=np.float64).astype(np.float32).tobytes()
    else:
        total, times = np.zeros((BLOCK, SIZE)), np.zeros(BLOCK, np.int64)
        for rows, values in map(_open_rows, frame["data"]):
            total[rows] += values
            times[rows] += 1
        rows = np.flatnonzero(times)
        data = rows.astype("<u2").tobytes() \
            + (total[rows] / times[rows, None]).astype(np.float32).tobytes()
    return pd.DataFrame({"block": [block], "data": [data]})


def _calibrating(model: Model, every: bool):
    def run(batches):
        for number, shard in _shards(batches):
            kept = np.ones(len(shard.toxic), bool) if every else shard.later()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([shard_logits(model, shard, kept).tobytes()], pa.binary()),
                 pa.array([shard.toxic[kept].tobytes()], pa.binary()),
                 pa.array([shard.spoken[kept].tobytes()], pa.binary())], ["shard", "logits", "toxic", "spoken"])
    return run


def fit_shards(shards: DataFrame) -> Model:
    """A model of all texts of all shards."""
    found, texts = np.zeros((2, 1 << BUCKET_BITS), np.int64), np.zeros(4, np.int64)
    for r in shards.mapInArrow(_counted, "block long, data binary").groupBy("block").applyInPandas(
            _add_counts, "block long, data binary").toLocalIterator():
        counts, at = np.frombuffer(zlib.decompress(r["data"]), np.int64), r["block"] * BLOCK
        if at < 0:
            texts = counts
        else:
            found[:, at:at + BLOCK] = counts.reshape(2, -1)
    if not texts[:2].all():
        return NOTHING
    buckets, table = _beginning(found, texts[:2])
    learned = shards.mapInArrow(_trained(buckets, table), "block long, shard long, data binary") \
        .groupBy("block").applyInPandas(_averaged, "block long, data binary").collect()
    dense = _begun()[1]
    for r in learned:
        if r["block"] < 0:
            flat = np.frombuffer(r["data"], np.float32)
            cuts = np.cumsum([p.size for p in dense])[:-1]
            dense = [x.reshape(p.shape) for x, p in zip(np.split(flat, cuts), dense)]
        else:
            rows, values = _open_rows(r["data"])
            table[rows + np.int64(r["block"] * BLOCK)] = values
    model = _model(buckets, table, dense)
    told = sorted(shards.mapInArrow(
        _calibrating(model, not texts[2:].all()),
        "shard long, logits binary, toxic binary, spoken binary").collect())
    logits, toxic, spoken = (np.frombuffer(b"".join(r[c] for r in told), kind) for c, kind in (
        ("logits", np.float64), ("toxic", np.uint8), ("spoken", np.uint8)))
    return _calibrated(model, logits, toxic, spoken)


def classified(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on all labelled documents that are not held out and score all documents."""
    return scored(docs, fit_shards(labelled_shards(docs, labels, **options)))
