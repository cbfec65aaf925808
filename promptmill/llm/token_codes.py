"""Token ids in directly addressable codes.

An id is split into chunks of eight bits. All lowest chunks lie in level 0, one byte for each id;
a bitmap beside the level says which ids go on in the next level, where only those have a chunk,
and so on. A rank directory counts the set bits before every block of the bitmap, so the place of
an id's next chunk is one look-up and the bits of one block: any id is read without decoding
others.

A file is a table of segments in ascending order of documents. Each segment holds the codes of
about a million ids, the identifiers of its documents and where each begins; Spark's Parquet
writer carries the bytes, so files appear whole or not at all and any executor reads them.

Documents are range-partitioned by identifier, which moves each text once, and encoded in order.

Defined results: a null text gives the end id alone; null identifiers come first; repeated rows
are documents of their own; a document longer than a segment has a larger segment of its own; an
empty table gives an empty file; extra columns do not reach the file.
"""

import os
import re
import struct
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_folder

MAGIC = b"DAC1"
BLOCK = 512                # bits of a bitmap for each entry of its rank directory
SEGMENT_IDS = 1 << 20
END_ID = 0
SLICE_CHARS = 1 << 20
CACHE_WORDS = 800_000
LEARN_WORDS = 2_000        # new words in one call of the tokenizer
ROWS = 1024                # of one look-up of words, and no more than so many characters
ROWS_CHARS = 4 << 20
STOPS = frozenset(".,;:!?")
LAST_LATIN = "\u024f"
NO_ID = -(1 << 63)         # stands for a null identifier inside a segment


# ---- the code -------------------------------------------------------------------------------

def pack(ids: np.ndarray) -> bytes:
    """The codes of an array of ids."""
    out, rest, levels = [], np.asarray(ids, dtype=np.uint64), 0
    while levels == 0 or len(rest):
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(rest), BLOCK)) \
            if len(rest) else np.empty(0, np.uint32)
        directory = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones
        out += [struct.pack("<Q", len(rest)), (rest & np.uint64(255)).astype(np.uint8).tobytes(),
                bits.tobytes(), directory.astype("<u4").tobytes()]
        rest, levels = rest[more] >> np.uint64(8), levels + 1
    return MAGIC + struct.pack("<I", levels) + b"".join(out)


class Codes:
    """Random access to packed ids."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        (levels,), at, self.levels = struct.unpack_from("<I", data, 4), 8, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, -(-n // 8), at + 8 + n)
            start = at + 8 + n + len(bits)
            directory = np.frombuffer(data, "<u4", -(-n // BLOCK), start)
            self.levels.append((chunks, bits, directory))
            at = start + 4 * len(directory)

    def __len__(self):
        return len(self.levels[0][0])

    @staticmethod
    def _rank(level, i: int) -> int:
        """Set bits before place i."""
        _, bits, directory = level
        if i // BLOCK >= len(directory):
            i, extra = i - 1, 1
        else:
            extra = 0
        first = i // BLOCK * BLOCK
        part = np.unpackbits(bits[first // 8:i // 8 + 1], bitorder="little")
        return int(directory[i // BLOCK]) + int(part[:i + extra - first].sum())

    def __getitem__(self, i: int) -> int:
        value = shift = 0
        for level in self.levels:
            value |= int(level[0][i]) << shift
            if not level[1][i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(level, i), shift + 8
        return value

    def span(self, start: int, end: int) -> np.ndarray:
        """The ids from start to end; only their own chunks are touched."""
        value = np.zeros(end - start, np.uint32)
        places, a, b = np.arange(end - start), start, end
        for k, level in enumerate(self.levels):
            if a == b:
                break
            value[places] |= level[0][a:b].astype(np.uint32) << np.uint32(8 * k)
            more = np.unpackbits(level[1][a // 8:-(-b // 8)],
                                 bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            places = places[more]
            a = self._rank(level, a)
            b = a + len(places)
        return value


# ---- encoding -------------------------------------------------------------------------------

# In front of a space that is followed by other text the tokenizer always begins a new word.
_CUT = re.compile(r" (?=\S)")
_OTHER_SPACE = re.compile(r" (?:\s|\Z)")


def _words(text: str) -> list:
    """The text cut in front of each such space, which is left out."""
    return _CUT.split(text) if _OTHER_SPACE.search(text) else text.split(" ")


class WordEncoder:
    """Whole-text ids by looking up words; words not seen before go to the tokenizer, many in one
    call. Two generations of words are kept, so frequent ones stay when the older one goes."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.whole, self.added = None, []
        if special:
            self.whole = Tokenizer.from_file(path)
            self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # ids whose bytes begin with a space, which byte-level vocabularies write as U+0120
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.known, self.older, self.firsts, self.cache_words = {}, {}, {}, cache_words

    def _tokenize(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def _learn(self, words) -> None:
        """Words without a space, many in one call. A stop behind a letter is a piece of its own,
        so such words are put together from the word and its stop."""
        stopped = [w for w in words if w[-1:] in STOPS and w[-2:-1] <= LAST_LATIN
                   and w[-2:-1].isalpha() and " " not in w]
        stems = {w[:-1] for w in stopped}
        ends = {c: self._tokenize(c).tobytes() for c in {w[-1] for w in stopped}}
        words = set(words).difference(stopped).union(
            s for s in stems if s not in self.known and s not in self.older)
        self._learn_plain(words)
        known, older = self.known, self.older
        for w in stopped:
            stem = w[:-1]
            known[w] = (known[stem] if stem in known else older[stem]) + ends[w[-1]]

    def _learn_plain(self, words) -> None:
        plain = [w for w in words if " " not in w]
        for at in range(0, len(plain), LEARN_WORDS):
            group = plain[at:at + LEARN_WORDS]
            ids = self._tokenize(" " + " ".join(group))
            data = ids.tobytes()
            # each word has one space, in front, so it has one such id, the first
            begins = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            self.known.update(zip(group, map(data.__getitem__, map(
                slice, begins, begins[1:] + [len(data)])), strict=True))
        for w in words:
            if " " in w:
                self.known[w] = self._tokenize(" " + w).tobytes()

    def _look_up(self, words: set) -> None:
        new = [w for w in words if w not in self.known]
        seen = [w for w in new if w in self.older]
        self.known.update(zip(seen, map(self.older.__getitem__, seen)))
        self._learn([w for w in new if w not in self.older])

    def _whole(self, text: str) -> bytes:
        (found,) = self.whole.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _slices(self, text: str):
        at = 0
        while len(text) - at > SLICE_CHARS:
            cut = _CUT.search(text, at + SLICE_CHARS)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _encode_small(self, texts) -> list:
        if len(self.known) > self.cache_words:
            self.known, self.older, self.firsts = {}, self.known, {}
        firsts, rests = [], []
        for text in texts:
            first, *rest = _words(text)
            if first not in self.firsts:
                self.firsts[first] = self._tokenize(first).tobytes() if first else b""
            firsts.append(self.firsts[first])
            rests.append(rest)
        self._look_up(set().union(*rests))
        return [first + b"".join(map(self.known.__getitem__, rest))
                for first, rest in zip(firsts, rests)]

    def encode(self, texts) -> list:
        """The ids of each text as little-endian 32-bit integers. Texts that hold the string of an
        added token go to the tokenizer whole, if those are to be found."""
        if any(a in t for a in self.added for t in texts):
            return [self._whole(t) if any(a in t for a in self.added) else self.encode([t])[0]
                    for t in texts]
        small = iter(self._encode_small([t for t in texts if len(t) <= SLICE_CHARS]))
        return [next(small) if len(t) <= SLICE_CHARS else
                b"".join(self._encode_small([piece])[0] for piece in self._slices(t))
                for t in texts]


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; it and the words it knows serve later tasks too."""
    held = sys.modules.setdefault("_promptmill_word_encoders",
                                  types.ModuleType("_promptmill_word_encoders"))
    if path not in held.__dict__:
        held.__dict__[path] = WordEncoder(path, special=True)
    return held.__dict__[path]


SEGMENTS = ("part long, seq long, first_doc long, n_docs long, n_ids long, doc_ids binary, "
            "begins binary, codes binary")


def _some_rows(batches):
    """Identifiers and texts of some rows at a time."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            rows = batch.slice(at, 64)
            keys += rows.column(0).to_pylist()
            texts += [t or "" for t in rows.column(1).to_pylist()]
            size += sum(map(len, texts[-rows.num_rows:]))
            if size >= ROWS_CHARS or len(keys) >= ROWS:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _segment_writer(path: str, end_id: int, segment_ids: int):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        encoder = worker_encoder(path)
        part, seq = TaskContext.get().partitionId(), 0
        docs, ids, size = [], [], 0

        def segment():
            values = np.frombuffer(b"".join(ids), "<u4")
            lengths = [len(x) // 4 + 1 for x in ids[::2]]
            begins = np.cumsum([0] + lengths[:-1]).astype("<i8")
            return pa.RecordBatch.from_pydict({
                "part": [part], "seq": [seq],
                "first_doc": pa.array([None if docs[0] == NO_ID else docs[0]], pa.int64()),
                "n_docs": [len(docs)], "n_ids": [len(values)],
                "doc_ids": [np.array(docs, "<i8").tobytes()], "begins": [begins.tobytes()],
                "codes": [pack(values)]})

        for keys, texts in _some_rows(batches):
            for key, found in zip(keys, encoder.encode(texts)):
                docs.append(NO_ID if key is None else key)
                ids += (found, end)
                size += len(found) // 4 + 1
                if size >= segment_ids:
                    yield segment()
                    docs, ids, size, seq = [], [], 0, seq + 1
        if docs:
            yield segment()
    return write


def write_codes(docs: DataFrame, tokenizer_path: str, path: str, key: str = "doc_id",
                text: str = "text", end_id: int = END_ID,
                segment_ids: int = SEGMENT_IDS) -> str:
    """Encode the documents and write the file."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("key", tie).sortWithinPartitions("key", tie)
    (rows.mapInArrow(_segment_writer(tokenizer_path, end_id, segment_ids), SEGMENTS)
     .write.option("compression", "zstd").parquet(path))
    return path


def _segment_reader(batches):
    for batch in batches:
        for row in batch.to_pylist():
            codes = Codes(row["codes"])
            docs = np.frombuffer(row["doc_ids"], "<i8")
            begins = np.frombuffer(row["begins"], "<i8")
            ends = np.append(begins[1:], len(codes))
            data = memoryview(codes.span(0, len(codes)).astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a:4 * b])
                   for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([None if d == NO_ID else int(d) for d in docs], pa.int64()),
                "start": pa.array(begins + row["base"], pa.int64()),
                "n_tokens": pa.array(ends - begins, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()), "part": [row["part"]] * len(docs),
                "seq": [row["seq"]] * len(docs)})


def with_starts(segments: DataFrame) -> DataFrame:
    """``base``: ids in all earlier segments. Sums of parts are added up first, then the segments
    inside each part."""
    def earlier(window):
        sums = F.sum("n_ids").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(sums, F.lit(0))

    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # range partitions are numbered in order
    parts = parts.select("part", earlier(Window.orderBy("part")).alias("_part_base"))
    inside = earlier(Window.partitionBy("part").orderBy("seq"))
    return (segments.join(parts, "part").withColumn("base", F.col("_part_base") + inside)
            .drop("_part_base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read back per document: doc_id, start, n_tokens, ids_crc32, and its segment."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    bases = with_starts(segments.select("part", "seq", "n_ids")).select("part", "seq", "base")
    return segments.join(bases, ["part", "seq"]).mapInArrow(
        _segment_reader, "doc_id long, start long, n_tokens long, ids_crc32 long, part long, "
                         "seq long")


def encoded_documents(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the file to a new shared folder and read it back."""
    spark = docs.sparkSession
    return read_documents(spark, write_codes(docs, tokenizer_path,
                                             new_folder(spark, "token-codes"), **options))
