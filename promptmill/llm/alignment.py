"""Alignment of two tokenizations of the same text by interval coalescing.

The tokens of both vocabularies are intervals of bytes. All intervals of a slice of documents, laid
end to end, are sorted by start; the running maximum of their ends says how far the tokens so far
reach, and a token that starts at or behind that point opens a new group. A group is therefore the
smallest stretch that both tokenizations cover with whole tokens. Inside the groups overlapping
tokens are expanded to pairs, of which a rule keeps the links: ``overlap`` (all), ``end`` (both end
together), ``start`` or ``same``.

Counts of linked id pairs over the whole corpus are made in three steps: every part (some 8 MB of
text) writes its documents with their links as places in the part's own list of distinct pairs;
the lists are summed up and joined with the sums, a pair once for each part however often it occurs;
then each part's documents meet the part's list again. A pair that occurs everywhere is one row of
a part, so no key is hot, and no task holds more than a part.

Vocabulary A is byte-level and encodes a space and the text; vocabulary B puts that space in front
itself. Strings of special tokens are plain text to both.

Defined results: a null or empty text, and one whose joined token bytes of A or B differ from the
space and the text, has no tokens, zeros and the empty digest; null identifiers and repeated rows
are documents of their own; an empty table gives an empty table; extra columns do not reach the
result. One document is tokenized by one task, as the tokenizers take whole texts.
"""

import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .token_codes import WordEncoder

SLICE_BYTES = 1 << 20      # text aligned in one go
PART_BYTES = 8 << 20       # text for each list of distinct pairs
CACHE_WORDS = 200_000      # of vocabulary A, in each of two generations
RULES = ("overlap", "end", "start", "same")


# ---- vocabularies ---------------------------------------------------------------------------

def byte_characters() -> dict:
    """The character that a byte-level vocabulary writes for each byte: printable Latin-1
    characters stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Vocabulary A: ids of a space and the text, and the bytes of every id."""

    def __init__(self, path: str):
        self.words = WordEncoder(path, CACHE_WORDS)
        if self.words.tokenizer.normalizer is not None:
            raise ValueError("a vocabulary without a normalizer is needed")
        value = byte_characters()
        vocabulary = self.words.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) \
                else token.encode()
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts) -> list:
        return [np.frombuffer(ids, "<u4") for ids in self.words.encode([" " + t for t in texts])]


class Pieces:
    """Vocabulary B: ids of the text by its own procedure, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts) -> list:
        return [np.array(ids, np.uint32) for ids in self.model.encode(texts, num_threads=1)]


def piece_count(path: str) -> int:
    """The number of ids of vocabulary B."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def worker_vocabularies(a_path: str, b_path: str):
    """Both vocabularies of this Python worker, which serve later tasks too."""
    held = sys.modules.setdefault("_promptmill_vocabularies",
                                  types.ModuleType("_promptmill_vocabularies"))
    key = f"{a_path}\n{b_path}"
    if key not in held.__dict__:
        held.__dict__[key] = ByteLevel(a_path), Pieces(b_path)
    return held.__dict__[key]


# ---- alignment ------------------------------------------------------------------------------

def coalesce(starts_a, ends_a, starts_b, ends_b):
    """The group of every A token and of every B token, numbered from 0 along the bytes."""
    starts, ends = np.concatenate((starts_a, starts_b)), np.concatenate((ends_a, ends_b))
    kind = np.zeros(len(starts), np.int8)
    kind[len(starts_a):] = 1
    order = np.lexsort((kind, starts))
    ranked = starts[order]
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = ranked[1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[:len(starts_a)], group[len(starts_a):]


def links(starts_a, ends_a, starts_b, ends_b, rule: str = "overlap"):
    """Places (in A, in B) of the linked token pairs, along A. The tokens of either side lie end
    to end, so the B tokens that overlap an A token are neighbours."""
    first = np.searchsorted(ends_b, starts_a, "right")
    count = np.searchsorted(starts_b, ends_a, "left") - first
    left = np.repeat(np.arange(len(starts_a)), count)
    before = np.cumsum(count) - count
    right = np.arange(len(left)) + np.repeat(first - before, count)
    keep = None
    if rule in ("end", "same"):
        keep = ends_a[left] == ends_b[right]
    if rule in ("start", "same"):
        same = starts_a[left] == starts_b[right]
        keep = same if keep is None else keep & same
    return (left, right) if keep is None else (left[keep], right[keep])


def _digits(n: int) -> np.ndarray:
    """Row i holds the decimal digits of i, then zero bytes."""
    return np.arange(n).astype(f"S{len(str(n))}").view(np.uint8).reshape(n, -1)


class Aligner:
    """Aligns slices of texts; reuse one for many slices."""

    def __init__(self, a, b, rule: str = "end"):
        if rule not in RULES:
            raise ValueError(f"no such rule: {rule}")
        self.a, self.b, self.rule = a, b, rule
        self.digits = _digits(max(len(a.bytes), len(b.bytes)))

    def tokens(self, texts):
        """Ids of both vocabularies for each text, empty where the text has no tokens."""
        none = np.empty(0, np.uint32)
        ids_a, ids_b = [], []
        for text, one, two in zip(texts, self.a.encode(texts), self.b.encode(texts)):
            data = b" " + text.encode()
            # a byte-level vocabulary changes nothing, so its length tells
            whole = (text and self.a.sizes[one].sum() == len(data)
                     and b"".join(map(self.b.bytes.__getitem__, two.tolist())) == data)
            ids_a.append(one if whole else none)
            ids_b.append(two if whole else none)
        return ids_a, ids_b

    def align(self, texts):
        """Per text: numbers of A and B tokens, of groups and of links, digest of the groups; and
        the id pairs of all links in order of the texts."""
        ids_a, ids_b = self.tokens(texts)
        n_a = np.array([len(x) for x in ids_a], np.int64)
        n_b = np.array([len(x) for x in ids_b], np.int64)
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        starts_a, starts_b = ends_a - self.a.sizes[a], ends_b - self.b.sizes[b]
        group_a, group_b = coalesce(starts_a, ends_a, starts_b, ends_b)
        left, right = links(starts_a, ends_a, starts_b, ends_b, self.rule)

        # the last tokens of groups, and with them the groups and links before every text
        cut_a, cut_b = np.cumsum(n_a), np.cumsum(n_b)
        last_a = np.diff(group_a, append=-1) != 0
        last_b = np.diff(group_b, append=-1) != 0
        groups = np.concatenate(([0], np.cumsum(last_a)))[np.concatenate(([0], cut_a))]
        linked = np.searchsorted(left, np.concatenate(([0], cut_a)))
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.diff(groups), "n_links": np.diff(linked),
                "digest": self._digests(a, b, group_a, group_b, last_a, last_b, cut_a, cut_b),
                "pairs": a[left].astype(np.int64) * len(self.b.bytes) + b[right]}

    def _digests(self, a, b, group_a, group_b, last_a, last_b, cut_a, cut_b):
        """A ids, then B ids of each group, as text."""
        n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
        through_a = np.cumsum(np.bincount(group_a, minlength=n_groups))
        before_b = np.cumsum(np.bincount(group_b, minlength=n_groups))
        before_b = np.concatenate(([0], before_b[:-1]))
        width = self.digits.shape[1]
        out = np.zeros((len(a) + len(b), width + 1), np.uint8)
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + through_a[group_b]
        out[place_a, :width], out[place_b, :width] = self.digits[a], self.digits[b]
        out[place_a, width] = np.where(last_a, ord("|"), ord(","))
        out[place_b, width] = np.where(last_b, ord(";"), ord(","))
        cuts = np.concatenate(([0], cut_a + cut_b))
        out[cuts[1:][np.diff(cuts) > 0] - 1, width] = 0
        return [hashlib.sha256(out[x:y].tobytes().translate(None, b"\0")).hexdigest()
                if y > x else "" for x, y in zip(cuts[:-1], cuts[1:])]


# ---- over the corpus ------------------------------------------------------------------------

# A part's documents have their links; its list of pairs is a row of its own.
PARTS = ("part long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, links array<int>, pairs array<long>, counts array<long>")
NAMES = [c.split()[0] for c in PARTS.split(", ")]
TYPES = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()),
                            pa.list_(pa.int64())]


def _slices(batches):
    """Identifiers and texts of some megabytes at a time."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            for key, text in zip(*(c.to_pylist() for c in rows.columns)):
                keys.append(key)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= SLICE_BYTES or len(keys) >= 4096:
                    yield keys, texts, size
                    keys, texts, size = [], [], 0
    if keys:
        yield keys, texts, size


def _lists(values: np.ndarray, lengths: np.ndarray, kind):
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _parts(a_path: str, b_path: str, rule: str):
    def flush(part, keys, found):
        one = {k: np.concatenate([f[k] for f in found])
               for k in ("n_a", "n_b", "n_groups", "n_links", "pairs")}
        pairs, places, counts = np.unique(one["pairs"], return_inverse=True, return_counts=True)
        n = len(keys)
        none = pa.nulls(n, TYPES[8])
        digests = [d for f in found for d in f["digest"]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part)), pa.array(keys, pa.int64()),
             *(pa.array(one[k]) for k in NAMES[2:6]), pa.array(digests, pa.string()),
             _lists(places.astype(np.int32), one["n_links"], pa.int32()), none, none], NAMES)
        whole = np.array([len(pairs)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), *(pa.nulls(1, t) for t in TYPES[1:8]),
             _lists(pairs, whole, pa.int64()), _lists(counts, whole, pa.int64())], NAMES)

    def run(batches):
        aligner = Aligner(*worker_vocabularies(a_path, b_path), rule)
        number, keys, found, size = TaskContext.get().partitionId() << 24, [], [], 0
        for some, texts, length in _slices(batches):
            keys += some
            found.append(aligner.align(texts))
            size += length
            if size >= PART_BYTES:
                yield from flush(number, keys, found)
                number, keys, found, size = number + 1, [], [], 0
        if keys:
            yield from flush(number, keys, found)
    return run


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def _score(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a part with the corpus counts of their links."""
    at = pairs.column("at").to_numpy()
    total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    total[at] = pairs.column("total").to_numpy()
    best[at] = pairs.column("is_best").to_numpy()
    found = docs.column("links").combine_chunks()
    places = found.flatten().to_numpy()
    cuts = np.concatenate(([0], np.cumsum(docs.column("n_links").to_numpy())))
    sums = {name: np.diff(np.concatenate(([0], np.cumsum(values[places])))[cuts])
            for name, values in (("n_best", best), ("count_sum", total))}
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.table([pa.array(sums[n]) if n in sums else docs.column(n) for n in names], names)


def aligned_parts(docs: DataFrame, a_path: str, b_path: str, rule: str = "end",
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of every part and the part's list of pairs, written once."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return written(rows.mapInArrow(_parts(a_path, b_path, rule), PARTS), "alignment")


def pair_counts(parts: DataFrame, b_size: int) -> DataFrame:
    """pair (A id * b_size + B id), total (links over the corpus), is_best (no other A id has more
    with this B id)."""
    lists = parts.where("pairs IS NOT NULL").select(
        F.inline(F.arrays_zip("pairs", "counts")).alias("pair", "n"))
    totals = lists.groupBy("pair").agg(F.sum("n").alias("total"))
    top = F.max("total").over(Window.partitionBy(F.col("pair") % b_size))
    return totals.withColumn("is_best", (F.col("total") == top).cast("long"))


def aligned(docs: DataFrame, a_path: str, b_path: str, b_size: int, rule: str = "end",
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    parts = aligned_parts(docs, a_path, b_path, rule, key, text)
    lists = parts.where("pairs IS NOT NULL").select(
        "part", F.posexplode("pairs").alias("at", "pair"))
    known = lists.join(pair_counts(parts, b_size), "pair").select(
        F.col("part").alias("list"), "at", "total", "is_best")
    texts = parts.where("pairs IS NULL").drop("pairs", "counts")
    return texts.groupBy("part").cogroup(known.groupBy("list")).applyInArrow(_score, RESULT)
