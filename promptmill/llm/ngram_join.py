"""N-gram Jaccard join with filters under several global token orders.

A document is the set of its word n-grams. Two sets with a Jaccard similarity of t share a token
among the first ``size - ceil(t * size) + 1`` tokens of each, whatever global order the tokens are
put in. The first order is by document frequency, rarest first; two more put tokens that only one
document holds first and the others in the order of a hash. A pair is a candidate only if it meets
under all of them (and passes length and positional filters); then it is verified on the whole
sets.

Stages:

1. Each batch of documents hashes its n-grams and sends every bucket of hashes one packed block;
   the bucket counts in how many documents each hash occurs and answers each batch with those that
   occur more than once. A document for which this leaves less than t of its set has no partner.
2. Equal sets are one class, by a digest of the whole set; further work is on representatives.
3. Representatives that share a prefix token are linked to the leader of that token (two rounds
   with different leaders, so each token gives as many pairs as it has members). Components of the
   links are merged. A token whose members are then still in several components is a group. Its
   candidate pairs between components are made if there are few for its members, as is usual.
   Denser groups that have nearly the same members become one (see :func:`_merged`). One of up to
   ``FEW`` members is compared in one task, first by the prefixes under the other two orders, then,
   for members that still have a candidate, by whole sets. A larger one is dealt into parts, of
   which any two are compared in one task (see :func:`_dealt`), or, with over ``PARTS`` parts,
   refined into smaller groups (see :func:`_refined`) until none is left. No link that would join
   two components is missed, and no step gives more rows than a fixed multiple of members.

Hashes have 40 bits beside their bucket: in a bucket of a million distinct hashes about one in two
millions falls on another one, which can only make a pair a candidate; for two equal hashes inside
one pair of documents the chance is some 10^-9.

The input must give the same rows in the same order when a lost task is repeated, as stored tables
do.

Defined results: a document without words has an empty set and is linked with nothing; with fewer
words than n the whole sequence is one shingle; repeated rows are documents of one class; null
identifiers take part but are never the smallest; extra columns do not reach the result of
:func:`components`; an empty table gives an empty table.
"""

import hashlib
import math
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import whole, written

N = 4
PERCENT = 85
BATCH_BYTES = 4 << 20
BATCH_DOCS = 4096
BUCKET_BYTES = 6 << 20     # text for each bucket of hashes
MIN_BUCKETS = 64
PAIRS_PER_MEMBER = 8       # candidate pairs of a group that are made, on average
FEW = 1024                 # members of a group that one task compares by whole sets
FEW_TOKENS = 2 << 20       # tokens of their sets
PARTS = 16                 # parts into which a larger group is dealt
COLUMNS = 4096             # hashes that are counted at once for such a group
MANY = 2048                # members of a group whose candidates are counted in one task
IS_SPARSE, IS_DENSE = 0, 1
LOW_BITS = 40
NO_ID = -(1 << 63)
ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


# ---- shingles -------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(ODD[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(ODD[2])
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: bytes):
    """Hash and start of every word of lower-cased bytes, from prefix polynomial hashes."""
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    base = ODD[0]
    inverse = pow(base, -1, 1 << 64)
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(
        (raw.astype(np.uint64) + np.uint64(1)) * _powers(len(raw), base), dtype=np.uint64)))
    value = (prefix[ends] - prefix[starts]) * _powers(len(raw) + 1, inverse)[starts]
    return _mix(value + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts, n: int = N) -> list:
    """The sorted distinct shingle hashes of each text."""
    blobs = [t.encode() for t in texts]
    hashes, starts = word_hashes(b" ".join(blobs))
    bounds = np.cumsum([0] + [len(b) + 1 for b in blobs])
    cuts = np.searchsorted(starts, bounds)
    gram = hashes[:max(0, len(hashes) - n + 1)].copy()
    for k in range(1, n):
        gram = _mix(gram * np.uint64(ODD[3]) + hashes[k:len(hashes) - n + 1 + k])
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= n:
            out.append(np.unique(gram[a:b - n + 1]))
        elif b > a:
            one = hashes[a:a + 1] + np.uint64(b - a)
            for k in range(a + 1, b):
                one = _mix(one * np.uint64(ODD[2]) + hashes[k:k + 1])
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
    return out


# ---- stage 1: which hashes occur in more than one document ---------------------------------------

def _pack_low(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BITS // 8].tobytes()


def _unpack_low(data: bytes) -> np.ndarray:
    width = LOW_BITS // 8
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


def _block(counts: np.ndarray, *parts: bytes) -> bytes:
    head = zlib.compress(counts.astype("<u4").tobytes(), 1)
    return struct.pack("<I", len(head)) + head + b"".join(parts)


def _open_block(blob: bytes):
    (n,) = struct.unpack_from("<I", blob)
    return np.frombuffer(zlib.decompress(blob[4:4 + n]), "<u4"), blob[4 + n:]


def _send(bits: int, n: int):
    shift = np.uint64(64 - bits)
    low = np.uint64((1 << LOW_BITS) - 1)

    def flush(batch_id, keys, texts):
        sets = shingle_sets(texts, n)
        sizes = np.array([len(s) for s in sets], np.int64)
        rows = {"slot": [(1 << bits) + batch_id % (1 << bits)], "batch": [batch_id],
                "blob": [np.array(keys, "<i8").tobytes() + sizes.astype("<i8").tobytes()
                         + b"".join(hashlib.md5(s.tobytes()).digest() for s in sets)]}
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        doc = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        bucket = (tokens >> shift).astype(np.uint32)
        order = np.argsort(bucket, kind="stable")
        tokens, doc, bucket = tokens[order] & low, doc[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=np.int64(-1), append=np.int64(1 << 32)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows["slot"].append(int(bucket[a]))
            rows["batch"].append(batch_id)
            rows["blob"].append(_block(np.bincount(doc[a:b], minlength=len(sets)),
                                       _pack_low(tokens[a:b])))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["slot"], pa.int64()), pa.array(rows["batch"], pa.int64()),
             pa.array(rows["blob"], pa.binary())], ["slot", "batch", "blob"])

    def run(batches):
        part, number, keys, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    keys.append(NO_ID if key is None else key)
                    texts.append(text or "")
                    size += len(texts[-1])
                    if size >= BATCH_BYTES or len(keys) >= BATCH_DOCS:
                        yield flush((part << 24) + number, keys, texts)
                        number, keys, texts, size = number + 1, [], [], 0
        if keys:
            yield flush((part << 24) + number, keys, texts)
    return run


def _answer(bits: int):
    """For one bucket: each batch gets its hashes that occur in more than one document, with
    their document frequency up to 255."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        slot = int(frame["slot"].iloc[0])
        if slot >= 1 << bits:
            return pd.DataFrame({"batch": frame["batch"], "slot": np.int64(-1),
                                 "blob": frame["blob"]})
        opened = [_open_block(b) for b in frame["blob"]]
        tokens = np.concatenate([_unpack_low(data) for _, data in opened])
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        counts = np.diff(np.append(starts, len(ranked)))
        often = np.empty(len(tokens), np.uint8)
        often[order] = np.repeat(np.minimum(counts, 255), counts).astype(np.uint8)
        out, at = [], 0
        for counts, _ in opened:
            total = int(counts.sum())
            keep = np.flatnonzero(often[at:at + total] > 1)
            doc = np.repeat(np.arange(len(counts)), counts)[keep]
            out.append(_block(np.bincount(doc, minlength=len(counts)),
                              _pack_low(tokens[at:at + total][keep]),
                              often[at:at + total][keep].tobytes()))
            at += total
        return pd.DataFrame({"batch": frame["batch"].to_numpy(), "slot": np.int64(slot),
                             "blob": out})
    return run


def _planes(x: np.ndarray) -> bytes:
    """Sorted 64-bit values byte plane by byte plane, which compresses."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T) \
        .reshape(-1).view("<u8")


def _scaled(slot: int) -> np.uint64:
    return np.uint64(slot * ODD[0] % (1 << 64))


def _gather(percent: int):
    """For one batch: its documents, and the shared tokens of those that can have a partner, in
    the first order: frequency in the top byte, then a hash of bucket and hash."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        meta = frame["blob"][frame["slot"] < 0].iloc[0]
        n = len(meta) // 32
        keys, sizes = np.frombuffer(meta, "<i8", n), np.frombuffer(meta, "<i8", n, 8 * n)
        digests = [meta[16 * n + 16 * i:16 * n + 16 * i + 16] for i in range(n)]
        docs, tokens = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for slot, blob in zip(frame["slot"], frame["blob"]):
            if slot >= 0:
                counts, data = _open_block(blob)
                total = int(counts.sum())
                low = _unpack_low(data[:total * (LOW_BITS // 8)])
                often = np.frombuffer(data, np.uint8, total, total * (LOW_BITS // 8))
                docs.append(np.repeat(np.arange(n), counts))
                whole_hash = _mix(low + _scaled(slot)) >> np.uint64(8)
                tokens.append((often.astype(np.uint64) << np.uint64(56)) | whole_hash)
        docs, tokens = np.concatenate(docs), np.concatenate(tokens)
        shared = np.bincount(docs, minlength=n)
        able = (100 * shared >= percent * sizes) & (sizes > 0)
        keep = able[docs]
        docs, tokens = docs[keep], tokens[keep]
        order = np.lexsort((tokens, docs))
        tokens, cuts = tokens[order], np.concatenate(([0], np.cumsum(np.where(able, shared, 0))))
        return pd.DataFrame({
            "rid": (int(frame["batch"].iloc[0]) << 20) + np.arange(n),
            "doc_id": pd.array([None if k == NO_ID else int(k) for k in keys], "Int64"),
            "n": sizes, "digest": digests,
            "tokens": [_planes(tokens[a:b]) if ok else None
                       for a, b, ok in zip(cuts[:-1], cuts[1:], able)]})
    return run


def shared_sets(docs: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """rid, doc_id, n (size of the set), digest, tokens (null if no partner is possible)."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length(whole("text")))).first()[0] or 0
    bits = max(MIN_BUCKETS, math.ceil(size / BUCKET_BYTES)).bit_length()
    sent = rows.mapInArrow(_send(bits, n), "slot long, batch long, blob binary")
    answered = sent.groupBy("slot").applyInPandas(
        _answer(bits), "batch long, slot long, blob binary")
    return written(answered.groupBy("batch").applyInPandas(
        _gather(percent), "rid long, doc_id long, n long, digest binary, tokens binary"),
        "shared-sets")


# ---- stages 2 and 3 --------------------------------------------------------------------------

def prefix_length(size, percent: int):
    return size - -(-percent * size // 100) + 1


def _prefixes(percent: int):
    def run(batches):
        for batch in batches:
            for rep, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = _from_planes(data)
                alone = n - len(tokens)          # tokens that only this document holds
                tokens = tokens[:max(0, prefix_length(n, percent) - alone)]
                m = len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(np.full(m, rep)),
                     pa.array(np.full(m, n)), pa.array(alone + np.arange(m))],
                    ["token", "rep", "n", "place"])
    return run


def _fits(n, place, other_n, other_place, percent: int):
    """Length and positional filter."""
    least, most = F.least(n, other_n), F.greatest(n, other_n)
    left = F.least(n - place, other_n - other_place)
    return (100 * least >= percent * most) & ((100 + percent) * left >= percent * (n + other_n))


def _leader_pairs(members: DataFrame, salt: int, percent: int) -> DataFrame:
    """Pairs of a member and the leader of its token and size class, if not yet connected."""
    ratio = math.log(100 / percent)
    members = members.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / ratio))
    first = F.struct(F.xxhash64("rep", F.lit(salt)).alias("h") if salt else F.col("rep").alias("h"),
                     F.col("rep").alias("b"), F.col("n").alias("bn"),
                     F.col("place").alias("bp"), F.col("comp").alias("bc"))
    leaders = members.groupBy("token", "class").agg(F.min(first).alias("lead"))
    met = members.join(leaders, ["token", "class"]).select("*", "lead.*")
    met = met.where((F.col("comp") != F.col("bc"))
                    & _fits(F.col("n"), F.col("place"), F.col("bn"), F.col("bp"), percent))
    return met.select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()


def _order_prefix(tokens: np.ndarray, n: int, percent: int, order: int) -> np.ndarray:
    """The shared tokens of a set's prefix under one of the hash orders, as ranks."""
    m = prefix_length(n, percent) - (n - len(tokens))
    return np.sort(_mix(tokens * np.uint64(ODD[order])))[:max(0, m)]


def _signatures(percent: int):
    """The prefixes of representatives under the other two orders."""
    mask = np.uint64((1 << 56) - 1)

    def run(batches):
        for batch in batches:
            reps, second, third = [], [], []
            for rep, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = _from_planes(data) & mask
                reps.append(rep)
                second.append(_order_prefix(tokens, n, percent, 0).tobytes())
                third.append(_order_prefix(tokens, n, percent, 3).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps, pa.int64()), pa.array(second, pa.binary()),
                 pa.array(third, pa.binary())], ["rep", "second", "third"])
    return run


def _meeting(members) -> np.ndarray:
    """For arrays of distinct hashes: how many any two share, as a square matrix (its diagonal
    leaves out hashes of one member alone)."""
    sizes = [len(m) for m in members]
    _, place, counts = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = counts > 1
    keep = shared[place]
    row = np.repeat(np.arange(len(members)), sizes)[keep]
    column = (np.cumsum(shared) - 1)[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(members), len(members)), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        held = np.zeros((len(members), COLUMNS), np.float32)
        held[row[a:b], column[a:b] - first] = 1
        both += held @ held.T
    return both


def _able(group: pd.DataFrame, percent: int) -> np.ndarray:
    """Pairs of different components whose sizes, and places in the first order, fit."""
    comp, n = group["comp"].to_numpy(), group["n"].to_numpy()
    rest = n - group["place"].to_numpy()
    return ((comp[:, None] != comp)
            & (100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n))
            & ((100 + percent) * np.minimum(rest[:, None], rest) >= percent * (n[:, None] + n)))


def _sorted_out(percent: int):
    """What is to become of each group: ``SPARSE`` with its candidate pairs where those are few for
    its members, else ``DENSE`` in one row."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kinds, gids, one, two = [], [], [], []

        def add(kind, gid, a, b):
            kinds.append(np.full(len(a), kind))
            gids.append(np.full(len(a), gid))
            one.append(a)
            two.append(b)
        for gid, group in frame.groupby("gid", sort=False):
            rep = group["rep"].to_numpy()
            left, right = np.nonzero(np.triu(_able(group, percent), 1))
            if len(left) > PAIRS_PER_MEMBER * len(rep):
                add(IS_DENSE, gid, rep[:1], rep[:1])
            elif len(left):
                add(IS_SPARSE, gid, np.minimum(rep[left], rep[right]),
                    np.maximum(rep[left], rep[right]))
        none = np.empty(0, np.int64)
        return pd.DataFrame({name: np.concatenate([none, *parts]).astype(np.int64) for name, parts in (
            ("kind", kinds), ("gid", gids), ("a", one), ("b", two))})
    return run


def _with_candidates(percent: int):
    """The members of small groups that have a candidate: another component's set of a fitting
    size, with a common prefix token under the other two orders as well."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kept = []
        for _, group in frame.groupby("gid", sort=False):
            able = _able(group, percent)
            for order in ("second", "third"):
                if able.any():
                    able &= _meeting([np.frombuffer(b, np.uint64) for b in group[order]]) > 0
            kept.append(group[able.any(axis=0)][["gid", "rep", "n"]])
        return pd.concat(kept)
    return run


def _few_links(percent: int):
    """Links of small groups by their whole sets: as many as connect what is linked."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, group in frame.groupby("gid", sort=False):
            both = _meeting([_from_planes(b) for b in group["tokens"]])
            n, rep = group["n"].to_numpy(), group["rep"].to_numpy()
            linked = 100 * both >= percent * (n[:, None] + n - both)
            np.fill_diagonal(linked, True)
            # each member with the first of those it reaches, step by step
            label = np.arange(len(n))
            while True:
                least = np.where(linked, label, len(n)).min(axis=1)
                moved = least < label
                if not moved.any():
                    break
                by = np.where(linked & (label == least[:, None]), 1, 0).argmax(axis=1)
                left.append(rep[moved])
                right.append(rep[by[moved]])
                label = least
        pairs = pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)})
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)}).drop_duplicates()
    return run


def _deltas(batches):
    """How each member of a group differs from the shared tokens of the group's leader: the size
    of the difference, how much of it no other document can share, and the rest of it."""
    for batch in batches:
        sizes, alone, rest = [], [], []
        for n, data, lead in zip(*(batch.column(c).to_pylist() for c in ("n", "tokens", "lead"))):
            own, reference = _from_planes(data), _from_planes(lead)
            differ = np.setxor1d(own, reference, True)
            alone.append(n - len(own))
            sizes.append(alone[-1] + len(differ))
            rest.append(differ.view(np.int64))
        cuts = np.concatenate(([0], np.cumsum([len(r) for r in rest]))).astype(np.int32)
        flat = np.concatenate(rest) if rest else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("gid", "rep", "n")]
            + [pa.array(sizes, pa.int64()), pa.array(alone, pa.int64()),
               pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))],
            ["gid", "rep", "n", "size", "alone", "rest"])


def _refined(members: DataFrame, reps: DataFrame, percent: int):
    """Sure links inside large groups, and smaller groups for all links that remain.

    For any reference set R, two sets differ by as much as their differences from R do. Let d be
    the size of a set's difference from R (here the shared tokens of one member) and
    f = (100 + t) d - (100 - t) n, with t the threshold in percent. Sets are linked if their f add
    up to at most 0. If f(x) + f(y) <= 0 for any y, the same holds for the member with the smallest
    f, which is then linked with both: so linking members with that one leaves only links between
    sets whose differences share a token. These are found as in the join itself: both have a
    common token in the first ``d - o + 1`` tokens of their differences, rarest in the group first,
    where o is the least overlap a link needs. Each such token is a smaller group. Every step
    gives as many rows as members have differing tokens, never pairs.
    """
    first = members.groupBy("gid").agg(F.min(F.struct(
        F.xxhash64("rep", "gid").alias("h"), F.col("rep").alias("leader"))).alias("l"))
    leaders = first.select("gid", F.col("l.leader").alias("leader")).join(
        reps.select(F.col("rep").alias("leader"), F.col("tokens").alias("lead")), "leader")
    sets = members.select("gid", "rep", "n").join(reps.select("rep", "tokens"), "rep")
    delta = written(sets.join(leaders, "gid").select("gid", "rep", "n", "tokens", "lead").mapInArrow(
        _deltas, "gid long, rep long, n long, size long, alone long, rest array<long>"), "deltas")
    delta = delta.withColumn("f", (100 + percent) * F.col("size") - (100 - percent) * F.col("n"))
    nearest = delta.groupBy("gid").agg(F.min(F.struct("f", "rep")).alias("near")).select(
        "gid", F.col("near.f").alias("near_f"), F.col("near.rep").alias("near_rep"))
    sure = delta.join(nearest, "gid").where(
        (F.col("f") + F.col("near_f") <= 0) & (F.col("rep") != F.col("near_rep"))).select(
        F.least("rep", "near_rep").alias("a"), F.greatest("rep", "near_rep").alias("b")).distinct()
    needed = F.greatest(F.lit(1), F.ceil((F.col("f") + F.col("near_f")) / (2 * (100 + percent))))
    rows = delta.join(nearest, "gid").select(
        "gid", "rep", "n", (F.col("size") - needed + 1 - F.col("alone")).alias("take"),
        F.explode("rest").alias("token"))
    often = rows.groupBy("gid", "token").agg(F.count(F.lit(1)).alias("often"))
    rank = F.row_number().over(Window.partitionBy("gid", "rep").orderBy("often", "token"))
    kept = rows.join(often, ["gid", "token"]).withColumn("rank", rank).where(
        (F.col("rank") <= F.col("take")) & (F.col("often") > 1))
    return sure, kept.select(F.xxhash64("gid", "token").alias("gid"), "rep", "n",
                             F.lit(0).cast("long").alias("place"))


def _verify(percent: int):
    mask = np.uint64((1 << 56) - 1)

    def run(batches):
        for batch in batches:
            left, right = [], []
            for a, b, an, bn, ad, bd in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = _from_planes(ad) & mask, _from_planes(bd) & mask
                # the other orders first: without a common prefix token there is no link
                if all(len(np.intersect1d(_order_prefix(x, an, percent, k),
                                          _order_prefix(y, bn, percent, k), True))
                       for k in (0, 3)):
                    both = len(np.intersect1d(x, y, True))
                    if 100 * both >= percent * (an + bn - both):
                        left.append(a)
                        right.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
    return run


def _links(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    one = reps.select(F.col("rep").alias("a"), F.col("n").alias("an"), F.col("tokens").alias("ad"))
    two = reps.select(F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("tokens").alias("bd"))
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "an", "bn", "ad", "bd")
    return full.mapInArrow(_verify(percent), "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(rep, comp): the smallest identifier each linked one reaches, by large-star and small-star
    steps until nothing changes; each step is written to the shared folder."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u != v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"),
                                                          F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        edges = written(small.distinct(), "edges")
        # row ids begin with the number of their partition: sums soon leave the long range
        now = edges.agg(F.count(F.lit(1)), *[F.sum(F.col(c).cast("decimal(38,0)")) for c in "uv"],
                        F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("rep"), F.col("v").alias("comp"))
        before = now


def _labelled(prefixes: DataFrame, labels) -> DataFrame:
    if labels is None:
        return prefixes.withColumn("comp", F.col("rep"))
    return (prefixes.join(labels, "rep", "left")
            .withColumn("comp", F.coalesce("comp", "rep")))


def _unconnected(marked: DataFrame) -> DataFrame:
    """The members of groups that lie in several components."""
    groups = marked.groupBy("gid").agg(
        F.count(F.lit(1)).alias("members"), F.min("comp").alias("_low"),
        F.max("comp").alias("_high")).where("_low != _high").select("gid", "members")
    return marked.join(groups, "gid")


def _distinct_groups(groups: DataFrame) -> DataFrame:
    """One of all groups that have the same members."""
    marks = groups.groupBy("gid").agg(
        F.bit_xor(F.xxhash64("rep")).alias("one"), F.count(F.lit(1)).alias("members"),
        F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(38,0)")).alias("two"))
    kept = marks.groupBy("members", "one", "two").agg(F.min("gid").alias("gid")).select("gid")
    return groups.join(kept, "gid", "left_semi")


def _merged(groups: DataFrame, any_size: bool) -> DataFrame:
    """Groups as one with those that have the same leader, where that leaves fewer pairs of members
    to compare, with their number of members and of parts to deal.

    The leader is the member with the least hash, so groups with nearly the same members mostly
    have the same. What is refined again and again must not be merged: ``any_size`` is for groups
    of tokens, others are merged only if the result need not be refined."""
    leaders = groups.groupBy("gid").agg(
        F.min(F.struct(F.xxhash64("rep", F.lit(2)).alias("h"), F.col("rep").alias("rep"))).alias("l"),
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens")).select(
        "gid", F.col("l.rep").alias("leader"), "members", "tokens")
    leaders = written(leaders, "leaders")
    one = groups.join(leaders.select("gid", "leader"), "gid").select(
        "leader", "rep", "n", "comp").distinct()
    sums = leaders.groupBy("leader").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("members").cast("double") * F.col("members")).alias("compared"))
    united = one.groupBy("leader").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens")).join(sums, "leader")
    members = F.col("members").cast("double")
    parts = F.when(
        (F.col("members") > FEW) | (F.col("tokens") > FEW_TOKENS),
        F.least("members", F.ceil(F.greatest(2 * F.col("members") / FEW,
                                             2 * F.col("tokens") / FEW_TOKENS)))
    ).otherwise(F.lit(1)).cast("long")
    united = united.where((F.col("groups") > 1) & (members * members <= F.col("compared")))
    united = united.withColumn("parts", parts)
    if not any_size:
        united = united.where(_dealable())
    united = written(united.select("leader", "members", "parts"), "united")
    own = leaders.join(united.select("leader"), "leader", "left_anti").select(
        "gid", "members", parts.alias("parts"))
    rows = groups.select("gid", "rep", "n", "comp").join(own, "gid")
    return rows.unionByName(one.join(united, "leader").withColumn(
        "gid", F.xxhash64("leader", F.lit("united"))).drop("leader")).withColumn(
        "place", F.lit(0).cast("long"))


def _dealable():
    return (F.col("parts") <= PARTS) | (F.col("members") <= 4 * PARTS)


def _dealt(groups: DataFrame) -> DataFrame:
    """Groups of several parts as one group for each two parts, so that any two members meet."""
    part = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts"))
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                               lambda x: (x != F.col("part")) | (F.col("parts") == 1)))
    return groups.withColumn("part", part).withColumn("other", other).withColumn(
        "gid", F.when(F.col("parts") == 1, F.col("gid")).otherwise(F.xxhash64(
            "gid", F.least("part", "other"), F.greatest("part", "other")))).select(
        "gid", "rep", "n", "place", "comp")


def _small_groups(few: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links inside groups of about ``FEW`` members or less: the prefixes under the other two orders are
    intersected first, then sets are fetched for members with a candidate."""
    signs = few.select("rep").distinct().join(reps, "rep").select("rep", "n", "tokens").mapInArrow(
        _signatures(percent), "rep long, second binary, third binary")
    count, tokens = few.agg(F.count(F.lit(1)), F.sum("n")).first()
    spread = F.pmod(F.xxhash64("gid"), F.lit(max(MIN_BUCKETS, count // 20_000,
                                                 (tokens or 0) // FEW_TOKENS)))
    able = few.join(signs, "rep").groupBy(spread.alias("g")).applyInPandas(
        _with_candidates(percent), "gid long, rep long, n long")
    sets = written(able, "candidates").join(
        reps.select("rep", "tokens"), "rep")
    return sets.groupBy(spread.alias("g")).applyInPandas(_few_links(percent), "a long, b long")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
               percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id it reaches by links),
    class_id (row id of the representative of equal sets, null without possible partner)."""
    sets = shared_sets(docs, key, text, n, percent)
    able = sets.where("tokens IS NOT NULL")
    classes = written(able.groupBy("digest").agg(
        F.min("rid").alias("rep"), F.min("doc_id").alias("first_doc")), "classes")
    reps = written(able.join(classes.select(F.col("rep").alias("rid")), "rid").select(
        F.col("rid").alias("rep"), "n", "tokens"), "representatives")
    prefixes = written(reps.mapInArrow(
        _prefixes(percent), "token long, rep long, n long, place long"), "prefixes")
    links, labels = None, None
    for salt in (0, 1):
        pairs = _leader_pairs(_labelled(prefixes, labels), salt, percent)
        found = written(_links(pairs, reps, percent), "links")
        links = found if links is None else links.unionByName(found)
        labels = connected(links)
    groups = prefixes.select(F.xxhash64("token").alias("gid"), "rep", "n", "place")
    first = True
    while True:
        left = written(_unconnected(_labelled(groups, labels)), "unconnected")
        small = left.where(F.col("members") <= MANY)
        spread = F.pmod(F.xxhash64("gid"), F.lit(max(MIN_BUCKETS, small.count() // 20_000)))
        kinds = written(small.groupBy(spread.alias("g")).applyInPandas(
            _sorted_out(percent), "kind long, gid long, a long, b long"), "kinds")

        pairs = kinds.where(F.col("kind") == IS_SPARSE).select("a", "b").distinct()
        gids = kinds.where(F.col("kind") == IS_DENSE).select("gid")
        dense = written(_merged(_distinct_groups(left.join(gids, "gid", "left_semi").unionByName(
            left.where(F.col("members") > MANY))), first), "dense-groups")
        first = False
        few = written(_dealt(dense.where(_dealable())), "dealt-groups")
        found = _links(pairs, reps, percent).unionByName(_small_groups(few, reps, percent))
        large = dense.where(~_dealable())
        over = large.isEmpty()
        if not over:
            sure, groups = _refined(large, reps, percent)
            found = found.unionByName(sure)
            groups = written(groups, "finer-groups")
        links = links.unionByName(written(found, "links"))
        labels = connected(links)
        if over:
            break
    named = classes.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    first = named.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    named = named.join(first, "comp").select("digest", "component_id",
                                             F.col("rep").alias("class_id"))
    rows = sets.select("rid", "doc_id", "n",
                       F.when(F.col("tokens").isNotNull(), F.col("digest")).alias("digest"))
    return rows.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "class_id")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
                  percent: int = PERCENT) -> DataFrame:
    """The documents whose identifier is the smallest of their group, in the input's columns.
    Identifiers are unique here; rows without one stay."""
    out = components(docs.select(key, text), key, text, n, percent)
    gone = out.where("doc_id != component_id").select(F.col("doc_id").alias(key))
    return docs.join(gone, key, "left_anti").select(*docs.columns)
