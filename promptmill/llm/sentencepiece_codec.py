"""SentencePiece encoding and decoding by a max-plus scan.

The segmentation of a text into pieces with the largest sum of piece scores is a longest path, so
a stretch of text is a max-plus matrix: entry (i, j) is the best score of segmenting it when the
piece before it covers its first i characters and its own last piece reaches j characters beyond
its end. No piece is longer than L characters, so matrices are L x L whatever the length of the
stretch, and two neighbours combine by a max-plus product, which is associative.

Documents up to ``GIANT`` characters are encoded in one piece. Longer ones are cut into chunks of
``CHUNK`` characters anywhere; chunk matrices are computed in parallel and combined in blocks, the
block products are combined per document, and the states at all chunk borders follow from them.
Then every chunk is traced back alone between its two border states. No task holds more than a
chunk of text, a block of matrices, or the block products of one document.

A piece never crosses from a word into the space before the next one, and no piece holds a
character that is unknown to the vocabulary, so the text between such places is segmented alone
and looked up when it comes again.

The vocabulary's scores are read as a unigram model: the result is the best segmentation under
them. (A vocabulary trained by merges gives other pieces than its own merge procedure would.)
Unknown characters become byte pieces; decoding gives the text back exactly, for any text.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows are
encoded each; equal scores take the longest last piece (at a chunk border, the smallest overhang);
an empty table gives an empty table; extra columns of the input do not reach the result.
"""

import re
import sys
import types

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole, written

GIANT = 32_768
CHUNK = 8_192
BLOCK = 64            # chunk matrices combined by one task
SPACE, MARK = " ", "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 100_000   # in each of two generations
ROWS = 512
CHUNKS = 128
WIDE, LANES = 40, 20_000     # longest word, and most words, segmented side by side
LOWEST = float("-inf")


HASH_START = np.uint64(0xCBF29CE484222325)
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)
HASH_SHIFT = np.uint64(29)
SLOT_MASK = np.uint64((1 << 20) - 1)


def _hash_one(text: str) -> int:
    value, whole_word = int(HASH_START), (1 << 64) - 1
    for c in text:
        value = (value ^ ord(c)) * int(HASH_STEP) & whole_word
        value ^= value >> int(HASH_SHIFT)
    return value


class Pieces:
    """The vocabulary: a table of all pieces and their prefixes, and the bytes of every id."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=model_path)
        self.table, self.bytes, byte_ids, known = {}, [], [0] * 256, set()
        lowest = 0.0
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
            else:
                text = piece.replace(MARK, SPACE)
                score = model.get_score(i)
                lowest = min(lowest, score)
                self.table[text] = (i, score)
                self.bytes.append(text.encode())
                known |= set(text)
                if SPACE in text.lstrip(SPACE):
                    raise ValueError("a piece crosses the start of a word")
        self.byte_ids, self.unknown = byte_ids, lowest - UNKNOWN_PENALTY
        # what each id adds to a segmentation; of the byte pieces of a character the first counts
        self.scores = np.zeros(len(self.bytes))
        for i, score in filter(None, self.table.values()):
            self.scores[i] = score
        for byte, i in enumerate(byte_ids):
            self.scores[i] = 0.0 if 0x80 <= byte < 0xC0 else self.unknown
        self.longest = max(map(len, self.table))
        for text in list(self.table):
            for end in range(1, len(text)):
                self.table.setdefault(text[:end], None)
        # the same table for many words at once: sorted hashes of pieces and prefixes
        entries = sorted((_hash_one(t), t) for t in self.table)
        self.hashes = np.array([h for h, _ in entries], np.uint64)
        if len(np.unique(self.hashes)) < len(entries):
            raise ValueError("two pieces have one hash")
        self.slots = np.zeros(int(SLOT_MASK) + 1, np.int32)
        self.slots[(self.hashes & SLOT_MASK).astype(np.int64)] = np.arange(len(entries))
        self.crowded = np.bincount((self.hashes & SLOT_MASK).astype(np.int64),
                                   minlength=len(self.slots)) > 1
        found = [self.table[t] or (-1, LOWEST) for _, t in entries]
        self.entry_ids = np.array([i for i, _ in found], np.int32)
        self.entry_scores = np.array([v for _, v in found])
        cut = "" if "\n" in known else "\n"
        self.words = re.compile(f" +[^ {cut}]*|[^ {cut}]+" + ("|\n" if cut else ""))

    def steps(self, text: str, start: int):
        """(end, id, score) of every piece that begins here, shortest first; an unknown character
        has the id -1."""
        table, single = self.table, False
        for end in range(start + 1, min(len(text), start + self.longest) + 1):
            found = table.get(text[start:end], 0)
            if found == 0:
                break
            if found:
                single |= end == start + 1
                yield end, found[0], found[1]
        if not single:
            yield start + 1, -1, self.unknown

    def path(self, text: str, start: int, end: int):
        """Ids and score of the best segmentation of text[start:end]; pieces may look no further.
        """
        best, back = [LOWEST] * (end + 1), [None] * (end + 1)
        best[start] = 0.0
        get, longest = self.table.get, self.longest
        for at in range(start, end):
            here, single = best[at], False
            if here == LOWEST:
                continue
            for to in range(at + 1, min(end, at + longest) + 1):
                found = get(text[at:to], 0)
                if found == 0:
                    break
                if found:
                    if to == at + 1:
                        single = True
                    score = here + found[1]
                    if score > best[to]:
                        best[to], back[to] = score, (at, found[0])
            if not single and here + self.unknown > best[at + 1]:
                best[at + 1], back[at + 1] = here + self.unknown, (at, -1)
        ids, at = [], end
        while at > start:
            before, found = back[at]
            if found >= 0:
                ids.append(found)
            else:
                ids += [self.byte_ids[b] for b in reversed(text[before:at].encode())]
            at = before
        return ids[::-1], best[end]


    def paths(self, words: list) -> list:
        """(ids as bytes, score) of the best segmentation of words, sorted by length:
        the same recursion as :meth:`path`, run over all words side by side."""
        n, wide = len(words), len(words[-1])
        sizes = np.fromiter(map(len, words), np.int64, n)
        chars = np.ascontiguousarray(np.array(words, f"<U{wide}").view(np.uint32)
                                     .reshape(n, wide).T).astype(np.uint64)
        best = np.full((wide + 1, n), LOWEST)
        best[0] = 0.0
        back = np.zeros((wide + 1, n), np.int8)
        back_id = np.full((wide + 1, n), -1, np.int32)
        for at in range(wide):
            # words come by length: those longer than a place are the last ones
            lanes = np.arange(np.searchsorted(sizes, at, "right"), n)
            value = np.full(len(lanes), HASH_START, np.uint64)
            for to in range(at + 1, min(wide, at + self.longest) + 1):
                if to > at + 1:
                    begin = np.searchsorted(lanes, np.searchsorted(sizes, to))
                    lanes, value = lanes[begin:], value[begin:]
                if not len(lanes):
                    break
                value = (value ^ chars[to - 1].take(lanes)) * HASH_STEP
                value ^= value >> HASH_SHIFT
                place = self.slots.take((value & SLOT_MASK).view(np.int64))
                hit = self.hashes.take(place) == value
                if not hit.all():
                    # perhaps another entry of the same slot
                    wrong = np.flatnonzero(~hit & self.crowded.take(
                        (value & SLOT_MASK).view(np.int64)))
                    found = np.searchsorted(self.hashes, value[wrong])
                    np.minimum(found, len(self.hashes) - 1, out=found)
                    good = self.hashes.take(found) == value[wrong]
                    place[wrong[good]] = found[good]
                    hit[wrong[good]] = True
                    lanes, value, place = lanes[hit], value[hit], place[hit]
                score = best[at].take(lanes) + self.entry_scores.take(place)
                better = np.flatnonzero(score > best[to].take(lanes))
                rows = lanes.take(better)
                best[to][rows] = score.take(better)
                back[to][rows] = at
                back_id[to][rows] = self.entry_ids.take(place.take(better))
        steps, at, every = [], sizes.copy(), np.arange(n)
        while at.any():
            steps.append(np.where(at > 0, back_id[at, every], -2))
            at = np.where(at > 0, back[at, every], 0).astype(np.int64)
        tokens = np.array(steps[::-1], np.int32).T
        total = best[sizes, every]
        # a word with an unknown character has no path here
        counts = (tokens != -2).sum(axis=1)
        flat = np.ascontiguousarray(tokens)[tokens != -2].astype("<i4").tobytes()
        ends = np.cumsum(counts) * 4
        return [(flat[e - 4 * c:e], v) if v != LOWEST else None
                for e, c, v in zip(ends.tolist(), counts.tolist(), total.tolist())]


class Encoder:
    def __init__(self, model_path: str):
        # ids and scores of words, in two generations, so frequent words stay when the older one goes
        self.pieces, self.known, self.older = Pieces(model_path), {}, {}

    def word(self, word: str):
        """Ids and score of a word."""
        ids, score = self.pieces.path(word, 0, len(word))
        return np.array(ids, "<i4").tobytes(), score

    def learn(self, words) -> None:
        """Segment the words not yet known, side by side."""
        known, older = self.known, self.older
        new = set(words).difference(known)
        seen = new.intersection(older)
        known.update(zip(seen, map(older.__getitem__, seen)))
        new = sorted(new.difference(seen), key=len)
        sizes, at = np.fromiter(map(len, new), np.int64, len(new)), 0
        wide = int(np.searchsorted(sizes, WIDE, "right"))
        while at < wide:
            # words of about one length share a matrix
            end = int(np.searchsorted(sizes[:wide], max(8, sizes[at] + 2), "right"))
            end = min(end, at + LANES)
            for word, found in zip(new[at:end], self.pieces.paths(new[at:end])):
                known[word] = found or self.word(word)
            at = end
        for word in new[wide:]:
            known[word] = self.word(word)

    def ids_of(self, word: str) -> bytes:
        if word not in self.known:
            self.learn({word})
        return self.known[word][0]

    def learn_all(self, texts) -> None:
        find = self.pieces.words.findall
        self._make_room()
        self.learn(set().union(*map(find, texts)))

    def _make_room(self) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts) -> list:
        # MARK itself is no space: as an unknown character it becomes bytes
        find = self.pieces.words.findall
        words = [find(SPACE + t) if t else [] for t in texts]
        self._make_room()
        self.learn(set().union(*words))
        known = self.known
        return [b"".join([known[word][0] for word in found]) for found in words]

    def matrix(self, text: str, size: int) -> np.ndarray:
        """The transfer matrix of text[:size]; the rest of the text is what lies behind."""
        states = self.pieces.longest
        out = np.full((states, states), LOWEST)
        cuts = [m.start() for m in self.pieces.words.finditer(text)
                if m.start() and m.start() <= size]
        cuts += [m.end() for m in self.pieces.words.finditer(text[:size])
                 if m.end() < size and text[m.end()] == "\n"]
        first, last = (min(cuts), max(cuts)) if cuts else (size, size)
        rows = np.full((min(len(text), size + states) + 1, states), LOWEST)
        for i in range(min(states, first + 1)):
            rows[i][i] = 0.0
        if cuts:
            self._advance(text[:first], 0, first, rows)
            if last > first:
                words = self.pieces.words.findall(text[first:last])
                ids = np.frombuffer(b"".join(map(self.ids_of, words)), "<i4")
                inner = float(self.pieces.scores[ids].sum())
                rows[last] = rows[first] + inner
        self._advance(text, last if cuts else 0, size, rows)
        for j in range(states):
            if size + j < len(rows):
                out[:, j] = rows[size + j]
        return out

    def _advance(self, text, start, end, rows):
        for at in range(start, end):
            if rows[at].max() == LOWEST:
                continue
            for to, _, score in self.pieces.steps(text, at):
                if to < len(rows):
                    rows[to] = np.maximum(rows[to], rows[at] + score)

    def between(self, text: str, size: int, entry: int, leave: int) -> bytes:
        """Ids of the pieces of a chunk between two border states."""
        end, at, out = size + leave, entry, []
        words = [m.span() for m in self.pieces.words.finditer(text[:end])]
        for a, b in words:
            if b > at:
                ids, _ = self.pieces.path(text[at:b], 0, b - at) if (a < at or b == end) else (
                    None, None)
                out.append(np.array(ids, "<i4").tobytes() if ids is not None
                           else self.ids_of(text[a:b]))
                at = b
        return b"".join(out)


def _held_by_worker(kind: str, make, model_path: str):
    held = sys.modules.setdefault(kind, types.ModuleType(kind))
    if model_path not in held.__dict__:
        held.__dict__[model_path] = make(model_path)
    return held.__dict__[model_path]


def worker_encoder(model_path: str) -> Encoder:
    """The encoder of this Python worker; it and the words it knows serve later tasks too."""
    return _held_by_worker("_promptmill_encoders", Encoder, model_path)


def worker_bytes(model_path: str) -> list:
    """The bytes of every id, without the tables that only encoding needs."""
    return _held_by_worker("_promptmill_bytes", lambda path: Pieces(path).bytes, model_path)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


# ---- whole documents ------------------------------------------------------------------------

def _lists(ids) -> pa.ListArray:
    flat = np.frombuffer(b"".join(ids), "<i4")
    ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _encode_small(model_path: str, back: bool = False):
    """Ids; with ``back`` the text read back from them too, in the same pass, so that a task has
    one Python worker and not two."""
    def run(batches):
        encoder = worker_encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                lists = _lists(encoder.encode_all(rows.column(1).to_pylist()))
                out = {"key": rows.column(0), "text": rows.column(1), "ids": lists,
                       "n_chunks": pa.array([1] * len(lists), pa.int32())}
                if back:
                    out["decoded"] = _texts(encoder.pieces.bytes, lists)
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    return run


# ---- giant documents ------------------------------------------------------------------------

def _matrices(model_path: str):
    def run(batches):
        encoder = worker_encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNKS):
                rows = batch.slice(at, CHUNKS)
                encoder.learn_all(rows.column("chunk").to_pylist())
                found = [encoder.matrix(t, n).tobytes() for t, n in zip(
                    rows.column("chunk").to_pylist(), rows.column("size").to_pylist())]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.binary())],
                                                 [*rows.schema.names, "matrix"])
    return run


def _block_product(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("n")
    product = None
    for data in frame["matrix"]:
        one = np.frombuffer(data).reshape(int((len(data) // 8) ** 0.5), -1)
        product = one if product is None else combine(product, one)
    return pd.DataFrame({"uid": frame["uid"].iloc[:1], "block": frame["block"].iloc[:1],
                         "matrix": [product.tobytes()]})


def _border_states(matrices, entry: np.ndarray, leave: int):
    """States at the borders before each matrix, and the score vectors there."""
    vectors = [entry]
    for one in matrices:
        vectors.append((vectors[-1][:, None] + one).max(axis=0))
    states = [leave]
    for one, vector in zip(reversed(matrices), reversed(vectors[:-1])):
        states.append(int(np.argmax(vector + one[:, states[-1]])))
    return states[::-1], vectors


def _document_states(frame: pd.DataFrame) -> pd.DataFrame:
    """Entry state of every block of a document and the score vector at its start."""
    frame = frame.sort_values("block")
    size = int((len(frame["matrix"].iloc[0]) // 8) ** 0.5)
    matrices = [np.frombuffer(m).reshape(size, -1) for m in frame["matrix"]]
    start = np.full(size, LOWEST)
    start[0] = 0.0
    states, vectors = _border_states(matrices, start, 0)
    return pd.DataFrame({"uid": frame["uid"].to_numpy(), "block": frame["block"].to_numpy(),
                         "entry": [v.tobytes() for v in vectors[:-1]], "leave": states[1:]})


def _chunk_states(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Border states of the chunks of a block."""
    frame = left.sort_values("n")
    size = int((len(frame["matrix"].iloc[0]) // 8) ** 0.5)
    matrices = [np.frombuffer(m).reshape(size, -1) for m in frame["matrix"]]
    states, _ = _border_states(matrices, np.frombuffer(right["entry"].iloc[0]),
                               int(right["leave"].iloc[0]))
    return pd.DataFrame({"uid": frame["uid"].to_numpy(), "n": frame["n"].to_numpy(),
                         "enter": states[:-1], "leave": states[1:]})


def _trace(model_path: str):
    def run(batches):
        encoder = worker_encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNKS):
                rows = batch.slice(at, CHUNKS).to_pydict()
                encoder.learn_all(rows["chunk"])
                ids = [encoder.between(t, n, a, b) for t, n, a, b in zip(
                    rows["chunk"], rows["size"], rows["enter"], rows["leave"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["uid"]), pa.array(rows["n"], pa.int32()), _lists(ids)],
                    ["uid", "n", "ids"])
    return run


def _encode_giants(giants: DataFrame, model_path: str, chunk: int, states: int) -> DataFrame:
    """giants: key, text, with equal rows. Returns key, text, ids, n_chunks."""
    unique = giants.groupBy("key", "text").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    unique = written(unique.withColumn("uid", F.sha2(F.concat(
        F.coalesce(F.col("key").cast("string"), F.lit("-")), F.lit("|"), "text"), 256)), "giants")
    marked = unique.select("uid", F.concat(F.lit(SPACE), "text").alias("marked"))
    last = F.floor((F.char_length("marked") - 1) / chunk).cast("int")
    chunks = marked.select("uid", "marked", F.explode(F.sequence(F.lit(0), last)).alias("n"))
    chunks = chunks.select(
        "uid", "n", F.floor(F.col("n") / BLOCK).cast("int").alias("block"),
        F.substr("marked", F.col("n") * chunk + 1, F.lit(chunk + states)).alias("chunk"),
        F.least(F.lit(chunk), F.char_length("marked") - F.col("n") * chunk).alias("size"))
    kept = "uid string, n int, block int, chunk string, size int"
    chunks = written(chunks.repartition("uid", "n").mapInArrow(
        _matrices(model_path), f"{kept}, matrix binary"), "chunk-matrices")
    narrow = chunks.select("uid", "n", "block", "matrix")
    blocks = narrow.groupBy("uid", "block").applyInPandas(
        _block_product, "uid string, block int, matrix binary")
    borders = blocks.groupBy("uid").applyInPandas(
        _document_states, "uid string, block int, entry binary, leave int")
    states_of = narrow.groupBy("uid", "block").cogroup(borders.groupBy("uid", "block")) \
        .applyInPandas(_chunk_states, "uid string, n int, enter int, leave int")
    traced = chunks.drop("matrix").join(states_of, ["uid", "n"]).mapInArrow(
        _trace(model_path), "uid string, n int, ids array<int>")
    whole_ids = traced.groupBy("uid").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "ids"))),
                              lambda x: x["ids"])).alias("ids"),
        F.count(F.lit(1)).cast("int").alias("n_chunks"))
    out = unique.join(whole_ids, "uid")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "key", "text", "ids", "n_chunks")


def encoded(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
            giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """Per document: key, text (empty for null), ids, n_chunks."""
    small, giants = _both_sizes(docs, model_path, key, text, giant, chunk, False)
    return small.unionByName(giants).withColumnRenamed("key", key)


def encoded_and_decoded(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
                        giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """:func:`encoded` with ``decoded``, the text read back from the ids."""
    small, giants = _both_sizes(docs, model_path, key, text, giant, chunk, True)
    return small.unionByName(decoded(giants, model_path)).withColumnRenamed("key", key)


def _both_sizes(docs, model_path, key, text, giant, chunk, back):
    states = Pieces(model_path).longest
    rows = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    small = rows.where(F.char_length("text") <= giant).mapInArrow(
        _encode_small(model_path, back), f"key {kind}, text string, ids array<int>, n_chunks int"
        + ", decoded string" * back)
    giants = _encode_giants(rows.where(F.char_length("text") > giant), model_path,
                            max(chunk, states), states)
    return small, giants


def _texts(table: list, lists) -> pa.Array:
    """The texts of lists of ids, without the space put in front."""
    # null lists have no length
    cuts = np.concatenate(([0], np.cumsum(np.nan_to_num(pc.list_value_length(
        lists).to_numpy(zero_copy_only=False)).astype(np.int64)))).tolist()
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    return pa.array([b"".join(map(table.__getitem__, ids[a:b].tolist()))[1:].decode(
        errors="replace") for a, b in zip(cuts[:-1], cuts[1:])], pa.string())


def _decode(model_path: str, column: str):
    def run(batches):
        table = worker_bytes(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, _texts(table, rows.column(column))],
                    [*rows.schema.names, "decoded"])
    return run


def decoded(rows: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids without the space put in front for encoding."""
    rows = rows.drop("decoded")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(_decode(model_path, ids), f"{schema}, decoded string")
