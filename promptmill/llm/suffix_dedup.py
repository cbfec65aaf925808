"""Removing repeated byte strings with a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller identifier. Two equal strings have the same smallest k-gram (by hash, leftmost first) at
the same offset, so suffixes only have to be compared where they share this anchor:

1. Each batch of documents finds the anchors of its windows and sends their hashes, packed, to
   buckets; a bucket answers which anchors occur in more than one document.
2. Documents cut out the stretches around shared anchors (all windows with this anchor, under
   twice ``LENGTH`` bytes) and send them to the anchor's bucket. Equal stretches of a batch are sent
   once, for its smallest identifier, as all the others are covered; one that repeats without a gap,
   as in a row of one character, has one entry and a count. Stretches of an anchor that over
   ``HOT`` documents hold are cut in two and dealt to buckets by the bytes before or behind the
   anchor which all their windows share, so a frequent passage among changing neighbours is no
   bucket of its own.
3. A bucket first joins equal stretches, so a passage with very many copies is one stretch. The
   suffixes at the windows of different stretches with one anchor are sorted by mergesort; two
   suffixes are compared by binary search for their common extension with prefix polynomial
   hashes, then by the byte behind it. Neighbours with a common extension of ``LENGTH`` form a
   class; every equality is verified on the bytes, and if a hash has lied the bucket is sorted by
   its bytes. A window is covered if its class has a smaller identifier than its document.
4. Covered stretches are merged per document and joined with the texts. Texts move once: both
   joins read one shuffle.

Matches are judged on the input, not on what is left, and never cross documents. Nothing is
bounded by a number of copies or partners.

The input must give the same rows in the same order when a lost task is repeated, as stored tables
do.

Defined results: a null text is empty; a null identifier counts as smaller than all; documents
with the same identifier do not remove each other's bytes, identical rows give identical results;
texts shorter than ``LENGTH`` stay; extra columns do not reach the result; an empty table gives an
empty table.
"""

import math
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole
from .ngram_join import (LOW_BITS, ODD, _block, _mix, _open_block, _pack_low, _powers,
                         _unpack_low)

LENGTH = 50
GRAM = 24
BATCH_BYTES = 3 << 19
BATCH_DOCS = 4096
BUCKET_BYTES = 3 << 20
SLICE_BYTES = 1 << 19
MIN_BUCKETS = 64
HOT = 4096          # documents with one anchor, from which its stretches are dealt finer
LEAST = -(1 << 63)
BASE = ODD[0]
INVERSE = pow(BASE, -1, 1 << 64)


# ---- hashes and anchors -------------------------------------------------------------------------

class PrefixHashes:
    """Hash of any stretch of a byte array in constant time."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(
            (raw.astype(np.uint64) + np.uint64(1)) * _powers(len(raw), BASE), dtype=np.uint64)))
        self.inverse = _powers(len(raw) + 1, INVERSE)

    def of(self, start, size):
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def runs_of(raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: anchor hash, anchor place, first and last window start.
    ``bounds``: where documents begin, and the end."""
    empty = np.empty(0, np.int64)
    if len(raw) < length:
        return np.empty(0, np.uint64), empty, empty, empty
    hashes = PrefixHashes(raw)
    grams = len(raw) - gram + 1
    value = _mix((hashes.sums[gram:] - hashes.sums[:-gram]) * hashes.inverse[:grams])
    del hashes
    least = (value >> np.uint64(32)).astype(np.uint32)
    place = np.arange(grams, dtype=np.uint32)
    width, reach = 1, length - gram + 1

    def merged(least, place, step):
        right = least[step:] < least[:-step]
        return (np.where(right, least[step:], least[:-step]),
                np.where(right, place[step:], place[:-step]))

    while 2 * width <= reach:
        least, place = merged(least, place, width)
        width *= 2
    if width < reach:
        least, place = merged(least, place, reach - width)
    windows = len(raw) - length + 1
    place = place[:windows]
    # windows that reach over the end of a document do not count
    crossing = np.zeros(windows + 1, np.int32)
    ends = bounds[1:-1]
    np.add.at(crossing, np.clip(ends - length + 1, 0, windows), 1)
    np.add.at(crossing, np.clip(ends, 0, windows), -1)
    inside = np.cumsum(crossing[:-1]) == 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | (place[1:] != place[:-1])
    first, last = np.flatnonzero(begin), np.flatnonzero(finish)
    anchor = place[first].astype(np.int64)
    return value[anchor], anchor, first, last


def _joined(texts):
    blobs = [t.encode() for t in texts]
    bounds = np.cumsum([0] + [len(b) for b in blobs])
    return np.frombuffer(b"".join(blobs), np.uint8), bounds


def _batches(batches, limit=BATCH_BYTES, docs=BATCH_DOCS):
    """Lists of rows of about the given bytes of text (the last column)."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                held.append(row)
                size += len(row[-1])
                if size >= limit or len(held) >= docs:
                    yield held
                    held, size = [], 0
    if held:
        yield held


# ---- stage 1: anchors of more than one document ------------------------------------------------

def _held(value: np.ndarray, doc: np.ndarray):
    """Anchors, each once for a document that holds it, by document and value; their documents;
    and for every run its place among them."""
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return value[new], doc[new], which


def _send(bits: int, length: int, gram: int):
    low = np.uint64((1 << LOW_BITS) - 1)

    def run(batches):
        part = TaskContext.get().partitionId()
        for number, rows in enumerate(_batches(batches)):
            batch_id = (part << 24) + number
            raw, bounds = _joined([r[-1] for r in rows])
            value, anchor, _, _ = runs_of(raw, bounds, length, gram)
            value, doc, _ = _held(value, np.searchsorted(bounds, anchor, "right") - 1)
            bucket = (value >> np.uint64(64 - bits)).astype(np.uint16)
            meta = (struct.pack("<I", len(rows)) + np.array([r[0] for r in rows], "<i8").tobytes()
                    + np.array([r[1] for r in rows], "<i4").tobytes())
            out = [((1 << bits) + batch_id % (1 << bits), batch_id, meta)]
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1,
                                          append=1 << 32))
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = order[a:b]
                out.append((int(bucket[mine[0]]), batch_id, _block(
                    np.bincount(doc[mine], minlength=len(rows)), _pack_low(value[mine] & low))))
            slot, batch, blob = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot, pa.int64()), pa.array(batch, pa.int64()),
                 pa.array(blob, pa.binary())], ["slot", "batch", "blob"])
    return run


def _answer(bits: int, hot: int):
    """One bucket: two bits for every anchor sent, set if it occurs in more than one document, and
    in more than ``HOT``."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        slot = int(frame["slot"].iloc[0])
        if slot >= 1 << bits:
            return pd.DataFrame({"batch": frame["batch"], "slot": np.int64(-1),
                                 "blob": frame["blob"]})
        opened = [_open_block(b) for b in frame["blob"]]
        tokens = np.concatenate([_unpack_low(data) for _, data in opened])
        docs = np.concatenate([np.repeat(np.arange(len(c)) + (i << 20), c)
                               for i, (c, _) in enumerate(opened)])
        order = np.argsort(tokens, kind="stable")
        ranked, holder = tokens[order], docs[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        starts = np.flatnonzero(new)
        other = np.concatenate(([False], holder[1:] != holder[:-1])) & ~new
        many = np.add.reduceat(other.astype(np.int64), starts) > 0
        holders = np.diff(np.append(starts, len(ranked)))
        state = np.empty((2, len(tokens)), bool)
        state[:, order] = np.repeat([many, holders > hot], holders, axis=1)
        out, at = [], 0
        for counts, _ in opened:
            total = int(counts.sum())
            out.append(_block(counts, np.packbits(state[:, at:at + total]).tobytes()))
            at += total
        return pd.DataFrame({"batch": frame["batch"].to_numpy(), "slot": np.int64(slot),
                             "blob": out})
    return run


def _two_rows(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8))[:2 * n].reshape(2, n)


def _per_document(frame: pd.DataFrame) -> pd.DataFrame:
    """The answers of one batch: each document's anchors bucket by bucket."""
    meta = frame["blob"][frame["slot"] < 0].iloc[0]
    (n,) = struct.unpack_from("<I", meta)
    keys = np.frombuffer(meta, "<i8", n, 4)
    ties = np.frombuffer(meta, "<i4", n, 4 + 8 * n)
    docs, bits = [np.empty(0, np.int64)], [np.empty((2, 0), np.uint8)]
    for blob in frame[frame["slot"] >= 0].sort_values("slot")["blob"]:
        counts, data = _open_block(blob)
        docs.append(np.repeat(np.arange(n), counts))
        bits.append(_two_rows(data, len(docs[-1])))
    docs, bits = np.concatenate(docs), np.concatenate(bits, axis=1)
    bits = bits[:, np.argsort(docs, kind="stable")]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(docs, minlength=n))))
    found = [i for i in range(n) if bits[0, cuts[i]:cuts[i + 1]].any()]
    return pd.DataFrame({
        "key": keys[found], "tie": ties[found],
        "bits": [np.packbits(bits[:, cuts[i]:cuts[i + 1]]).tobytes() for i in found]})


# ---- stage 2: stretches around shared anchors ------------------------------------------------

def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start[i], start[i] + 1, ... of each stretch, one after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _halved(value, anchor, first, last, hot, hashes, length, gram):
    """Stretches of hot anchors in two: windows that reach at least ``half`` bytes before the
    anchor, and the others. Returns which stretch each is part of, first and last window, and a
    hash that is the anchor's, for hot ones that of all bytes that windows of this half share."""
    half = (length - gram + 1) // 2
    middle = anchor - half
    both = hot & (first <= middle) & (last > middle)
    part = np.concatenate((np.arange(len(first)), np.flatnonzero(both)))
    second = np.arange(len(part)) >= len(first)
    anchor, middle, value = anchor[part], middle[part], value[part]
    first = np.where(second, middle + 1, first[part])
    last = np.where(both[part] & ~second, middle, last[part])
    at = np.flatnonzero(hot[part])
    before = first[at] <= middle[at]
    common = hashes.of(np.where(before, middle[at], anchor[at]),
                       np.where(before, gram + half, length - half + 1))
    value[at] = _mix(value[at] ^ _mix(common + before.astype(np.uint64)))
    return part, first, last, value


def _kinds(value, first, size, offset, raw, hashes):
    """Equal stretches: the first of each kind, and the kind of every one."""
    name = _mix(hashes.of(first, size) ^ _mix(value + (size << 8 | offset).astype(np.uint64)))
    _, one, kind = np.unique(name, return_index=True, return_inverse=True)
    like = one[kind]
    honest = bool(((size[like] == size) & (offset[like] == offset)).all())
    other = np.flatnonzero(like != np.arange(len(like))) if honest else ()
    for at in range(0, len(other), 20_000):
        some = other[at:at + 20_000]
        honest = honest and bool((raw[_ragged(first[some], size[some])]
                                  == raw[_ragged(first[like[some]], size[some])]).all())
    # if a hash has lied, every stretch stands for itself
    return (one, kind) if honest else (np.arange(len(first)), np.arange(len(first)))


def _cut_out(bits: int, length: int, gram: int):
    """Stretches for buckets; and runs already known to go, in slots from 1 << bits on."""
    def run(batches):
        for rows in _batches(batches):
            raw, bounds = _joined([r[-1] for r in rows])
            value, anchor, first, last = runs_of(raw, bounds, length, gram)
            held, holder, which = _held(value, np.searchsorted(bounds, anchor, "right") - 1)
            shared, hot = np.concatenate(
                [_two_rows(r[2], c) for r, c in zip(rows, np.bincount(
                    holder, minlength=len(rows)))], axis=1).astype(bool)[:, which]
            value, anchor, first, last, hot = (x[shared] for x in (value, anchor, first, last, hot))
            hashes = PrefixHashes(raw)
            part, first, last, deal = _halved(value, anchor, first, last, hot, hashes, length, gram)
            value, anchor = value[part], anchor[part]
            doc = np.searchsorted(bounds, anchor, "right") - 1
            keys = np.array([r[0] for r in rows], "<i8")
            ties = np.array([r[1] for r in rows], "<i4")
            size, offset = last - first + length, anchor - first
            one, kind = _kinds(value, first, size, offset, raw, hashes)
            del hashes
            # an entry: a stretch and those like it that follow it without a gap
            order = np.lexsort((first, kind, doc))
            new = np.ones(len(order), bool)
            new[1:] = ((np.diff(doc[order]) != 0) | (np.diff(kind[order]) != 0)
                       | (np.diff(first[order]) != (last - first + 1)[order[1:]]))
            times = np.diff(np.append(np.flatnonzero(new), len(order)))
            entry = order[new]
            smallest = np.full(len(one), np.iinfo(np.int64).max)
            np.minimum.at(smallest, kind, keys[doc])
            gone = keys[doc[entry]] > smallest[kind[entry]]
            slots, blobs = [], []
            if gone.any():
                mine, many = entry[gone], times[gone]
                start = first[mine] - bounds[doc[mine]]
                slots, blobs = _packed_spans(
                    keys[doc[mine]], ties[doc[mine]], start,
                    start + (many - 1) * (last - first + 1)[mine] + size[mine], 1 << bits)
                slots = [slot + (1 << bits) for slot in slots]
            entry, times = entry[~gone], times[~gone]
            bucket = (deal[entry] >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=1 << 32))
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = entry[order[a:b]]
                held, inside = np.unique(doc[mine], return_counts=True)
                kinds, which = np.unique(kind[mine], return_inverse=True)
                cut = one[kinds]
                head = zlib.compress(np.diff(keys[held], prepend=0).astype("<i8").tobytes(), 1)
                slots.append(int(bucket[order[a]]))
                blobs.append(struct.pack("<IIII", len(held), len(head), len(mine), len(cut)) + head
                             + ties[held].tobytes() + inside.astype("<u4").tobytes()
                             + (first[mine] - bounds[doc[mine]]).astype("<u4").tobytes()
                             + times[order[a:b]].astype("<u4").tobytes()
                             + which.astype("<u4").tobytes()
                             + size[cut].astype(np.uint8).tobytes()
                             + offset[cut].astype(np.uint8).tobytes()
                             + raw[_ragged(first[cut], size[cut])].tobytes())
            if slots:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots, pa.int64()), pa.array(blobs, pa.binary())], ["slot", "blob"])
    return run


def _open_stretches(blobs):
    """Arrays over all entries: identifier, tie, place in the document, times, kind; and over all
    kinds: identifier, size, anchor offset; and the bytes of the kinds."""
    entries, kinds, before = [], [], 0
    for blob in blobs:
        n, head, m, k = struct.unpack_from("<IIII", blob)
        keys = np.cumsum(np.frombuffer(zlib.decompress(blob[16:16 + head]), "<i8"))
        at = 16 + head
        ties = np.frombuffer(blob, "<i4", n, at)
        inside = np.frombuffer(blob, "<u4", n, at + 4 * n)
        at += 8 * n
        place, times, kind = np.frombuffer(blob, "<u4", 3 * m, at).reshape(3, m)
        at += 12 * m
        size = np.frombuffer(blob, np.uint8, k, at)
        offset = np.frombuffer(blob, np.uint8, k, at + k)
        raw = np.frombuffer(blob, np.uint8, -1, at + 2 * k)
        keys = np.repeat(keys, inside)
        owner = np.empty(k, np.int64)
        owner[kind] = keys
        entries.append((keys, np.repeat(ties, inside), place, times, kind.astype(np.int64) + before))
        kinds.append((owner, size, offset, raw))
        before += k
    return [np.concatenate(x) for x in (*zip(*entries), *zip(*kinds))]


# ---- stage 3: the suffix sort ---------------------------------------------------------------

class Suffixes:
    """Suffixes of a byte array, compared over their first ``length`` bytes."""

    def __init__(self, raw: np.ndarray, length: int = LENGTH):
        self.raw, self.length, self.hashes = raw, length, PrefixHashes(raw)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, by binary search on hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), self.length, np.int64)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hashes.of(a, mid) == self.hashes.of(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a, b, or_equal) -> np.ndarray:
        size = self.common(a, b)
        full = size == self.length
        at = np.where(full, 0, size)
        return np.where(full, or_equal, self.raw[a + at] < self.raw[b + at])

    def sorted_in_groups(self, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Order that sorts each group of suffixes; groups lie one after the other. Bottom-up
        mergesort: every element finds its rank in the neighbouring run by binary search."""
        order = np.arange(len(start))
        group_begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        group_size = np.repeat(sizes, sizes)
        local = np.arange(len(start)) - group_begin
        width, largest = 1, int(sizes.max()) if len(sizes) else 0
        while width < largest:
            pair = local // (2 * width) * (2 * width)
            right = (local - pair) >= width
            sibling = np.minimum(np.where(right, pair, pair + width), group_size)
            until = np.minimum(sibling + width, group_size)
            at = np.flatnonzero(sibling < until)
            low, high = sibling[at] + group_begin[at], until[at] + group_begin[at]
            begin, mine, other = low.copy(), start[order[at]], right[at]
            open_ = np.arange(len(at))
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                theirs = start[order[mid]]
                # equal elements of the left run come first
                before = self.less(theirs, mine[open_], other[open_])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            rank = np.zeros(len(start), np.int64)
            rank[at] = low - begin
            target = group_begin + pair + (local - pair - np.where(right, width, 0)) + rank
            fresh = np.empty_like(order)
            fresh[target] = order
            order = fresh
            width *= 2
        return order

    def classes(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """A class number for each suffix: equal numbers for equal bytes in one group."""
        by_group = np.argsort(group, kind="stable")
        ranked = group[by_group]
        cuts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sizes = np.diff(np.append(cuts, len(ranked)))
        order = by_group[self.sorted_in_groups(start[by_group], sizes)]
        first = np.ones(len(order), bool)
        a, b = start[order[:-1]], start[order[1:]]
        near = np.flatnonzero(ranked[1:] == ranked[:-1])
        near = near[self.common(a[near], b[near]) == self.length]
        for at in range(0, len(near), 100_000):
            some = near[at:at + 100_000]
            reach = np.arange(self.length)
            if (self.raw[a[some, None] + reach] != self.raw[b[some, None] + reach]).any():
                return self._by_bytes(start, group)
        first[near + 1] = False
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(first) - 1
        return out

    def _by_bytes(self, start, group):
        """The same classes without hashes."""
        data = self.raw[start[:, None] + np.arange(self.length)]
        keyed = np.concatenate([group[:, None].view(np.uint8).reshape(len(start), -1), data], 1)
        return np.unique(keyed, axis=0, return_inverse=True)[1].reshape(-1)


def covered_windows(keys, size, offset, raw, length: int = LENGTH, gram: int = GRAM):
    """For every stretch and window: is it in a document with a smaller identifier? Returns the
    flags, stretch after stretch."""
    size, offset = size.astype(np.int64), offset.astype(np.int64)
    begin = np.cumsum(size) - size
    suffixes = Suffixes(raw, length)
    anchor = _mix(suffixes.hashes.of(begin + offset, np.int64(gram)))
    # equal stretches are one: same anchor, offset, size and bytes
    name = _mix(suffixes.hashes.of(begin, size) ^ _mix(
        anchor + (size << 8 | offset).astype(np.uint64)))
    _, one, kind = np.unique(name, return_index=True, return_inverse=True)
    if (size[one][kind] != size).any() or (
            raw != raw[_ragged(begin[one][kind], size)]).any():
        # a hash has lied: every stretch stands for itself
        one = kind = np.arange(len(size))
    smallest = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(smallest, kind, keys)
    # windows of stretches that share their anchor with another one
    windows = size[one] - length + 1
    _, where, many = np.unique(anchor[one], return_inverse=True, return_counts=True)
    unsettled = many[where] > 1
    at = np.cumsum(windows) - windows
    best = np.repeat(smallest, windows)
    if unsettled.any():
        mine = np.flatnonzero(unsettled)
        flat = _ragged(at[mine], windows[mine])
        inner = flat - np.repeat(at[mine], windows[mine])
        start = np.repeat(begin[one[mine]], windows[mine]) + inner
        group = np.repeat(where[mine].astype(np.int64) << 8, windows[mine]) | (
            np.repeat(offset[one[mine]], windows[mine]) - inner)
        classes = suffixes.classes(start, group)
        low = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, classes, best[flat])
        best[flat] = low[classes]
    all_windows = size - length + 1
    flat = _ragged(at[kind], all_windows)
    return best[flat] < np.repeat(keys, all_windows)


def _runs_of_flags(flags: np.ndarray, first: np.ndarray):
    """First and last window of each run of flags inside a stretch, and its stretch; ``first`` is
    the first window of every stretch. No number is kept for a window, only single bytes."""
    cut = np.zeros(len(flags), bool)
    cut[first] = True
    opens, closes = flags.copy(), flags.copy()
    opens[1:] &= cut[1:] | ~flags[:-1]
    closes[:-1] &= cut[1:] | ~flags[1:]
    begin = np.flatnonzero(opens)
    return begin, np.flatnonzero(closes), np.searchsorted(first, begin, "right") - 1


def _anchors(size, offset, raw, gram: int) -> np.ndarray:
    """The hash of every stretch's anchor, with prefix hashes of a slice of the bytes at a time."""
    ends = np.cumsum(size, dtype=np.int64)
    out, at = np.empty(len(size), np.uint64), 0
    while at < len(size):
        before = int(ends[at]) - int(size[at])
        until = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        begin = ends[at:until] - size[at:until] - before
        out[at:until] = PrefixHashes(raw[before:int(ends[until - 1])]).of(
            begin + offset[at:until], np.int64(gram))
        at = until
    return _mix(out)


def _sort_bucket(parts: int, length: int, gram: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        slot = int(frame["slot"].iloc[0])
        if slot >= parts:
            return pd.DataFrame({"part": np.int64(slot - parts), "blob": frame["blob"]})
        keys, ties, place, times, kind, owner, size, offset, raw = _open_stretches(frame["blob"])
        windows = size.astype(np.int64) - length + 1
        flags = np.zeros(int(windows.sum()), bool)
        # stretches of one anchor stay together; a slice of the anchors at a time
        begin = np.cumsum(size, dtype=np.int64) - size
        turn = _anchors(size, offset, raw, gram) % np.uint64(-(-len(raw) // SLICE_BYTES))
        first = np.cumsum(windows) - windows
        for one in np.unique(turn):
            mine = np.flatnonzero(turn == one)
            flags[_ragged(first[mine], windows[mine])] = covered_windows(
                owner[mine], size[mine], offset[mine],
                raw[_ragged(begin[mine], size[mine].astype(np.int64))], length, gram)
        if not flags.any():
            return pd.DataFrame({"part": np.empty(0, np.int64), "blob": []})
        begin, end, who = _runs_of_flags(flags, first)
        begin, end = begin - first[who], end - first[who] + length
        # every entry has the runs of its kind; with those that follow it they touch
        many = np.bincount(who, minlength=len(size))
        entry = np.repeat(np.arange(len(kind)), many[kind])
        run_ = _ragged((np.cumsum(many) - many)[kind], many[kind])
        start = place[entry].astype(np.int64)
        stop = start + (times[entry].astype(np.int64) - 1) * windows[kind[entry]] + end[run_]
        part, blob = _packed_spans(keys[entry], ties[entry], start + begin[run_], stop, parts)
        return pd.DataFrame({"part": np.array(part, np.int64), "blob": blob})
    return run


def _merged(key, tie, start, end):
    """Stretches of documents, merged where they touch."""
    order = np.lexsort((start, tie, key))
    key, tie, start, end = key[order], tie[order], start[order], end[order]
    new_doc = np.ones(len(key), bool)
    new_doc[1:] = (key[1:] != key[:-1]) | (tie[1:] != tie[:-1])
    # a running maximum of ends inside each document
    shift = (np.cumsum(new_doc) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    fresh = new_doc.copy()
    fresh[1:] |= start[1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start)) - 1
    return key[first], tie[first], start[first], reach[last] - shift[first], new_doc[first]


def _packed_spans(key, tie, start, end, parts: int):
    """Merged stretches, packed for each part of the documents: parts and blobs."""
    key, tie, start, end, _ = _merged(key, tie, start, end)
    spans = np.stack([key, tie.astype(np.int64), start, end], 1).astype("<i8")
    part = (_mix(key.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=1 << 62))
    return ([int(part[order[a]]) for a in cuts[:-1]],
            [zlib.compress(spans[order[a:b]].T.tobytes(), 1) for a, b in zip(cuts[:-1], cuts[1:])])


def _merge_spans(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per document with its removed stretches, merged."""
    key, tie, start, end, new_doc = _merged(*np.concatenate(
        [np.frombuffer(zlib.decompress(b), "<i8").reshape(4, -1) for b in frame["blob"]], axis=1))
    spans = np.stack([start, end], 1).astype("<i8")
    docs = np.flatnonzero(new_doc)
    ends = np.append(docs[1:], len(key))
    return pd.DataFrame({"key": key[docs], "tie": tie[docs].astype(np.int32),
                         "spans": [spans[a:b].tobytes() for a, b in zip(docs, ends)]})


def _remove(length: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
                for text, data, copy in zip(*(rows.column(c).to_pylist()
                                              for c in ("text", "spans", "copy"))):
                    raw = text.encode()
                    spans = np.frombuffer(data or b"", "<i8").reshape(-1, 2).tolist()
                    if copy and len(raw) >= length:
                        spans = [[0, len(raw)]]
                    kept, last = [], 0
                    for a, b in spans:
                        kept.append(raw[last:a])
                        last = b
                    kept = b"".join(kept + [raw[last:]])
                    out["n_bytes"].append(len(raw))
                    out["n_removed"].append(len(raw) - len(kept))
                    out["n_spans"].append(len(spans))
                    out["kept"].append(kept)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(out[c], pa.int64()) for c in (
                        "n_bytes", "n_removed", "n_spans")), pa.array(out["kept"], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
            gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.select(F.coalesce("doc_id", F.lit(LEAST)).alias("key"),
                       F.hash("text").alias("tie"), "text")
    bits = min(16, max(MIN_BUCKETS, math.ceil(size / BUCKET_BYTES)).bit_length())
    # of equal texts only the first goes on; all bytes of the others are covered by it
    named = rows.select("key", "tie", F.md5("text").alias("digest"))
    first = named.groupBy("digest").agg(F.min("key").alias("first"))
    roles = named.join(first, "digest").groupBy("key", "tie").agg(F.min("first").alias("first"))
    firsts = roles.where("key = first").select("key", "tie")
    # all joins with the texts read one shuffle
    texts = rows.join(firsts, ["key", "tie"])
    sent = texts.select("key", "tie", "text").mapInArrow(
        _send(bits, length, gram), "slot long, batch long, blob binary")
    answered = sent.groupBy("slot").applyInPandas(
        _answer(bits, hot), "batch long, slot long, blob binary")
    shared = answered.groupBy("batch").applyInPandas(
        _per_document, "key long, tie int, bits binary").groupBy("key", "tie").agg(
        F.first("bits").alias("bits"))
    stretches = rows.join(shared, ["key", "tie"]).select("key", "tie", "bits", "text").mapInArrow(
        _cut_out(bits, length, gram), "slot long, blob binary")
    spans = (stretches.groupBy("slot")
             .applyInPandas(_sort_bucket(1 << bits, length, gram), "part long, blob binary")
             .groupBy("part").applyInPandas(_merge_spans, "key long, tie int, spans binary"))
    found = roles.join(spans, ["key", "tie"], "left").select(
        "key", "tie", "spans", (F.col("key") != F.col("first")).alias("copy"))
    return rows.join(found, ["key", "tie"], "left").select(
        F.nullif("key", F.lit(LEAST)).alias("doc_id"), "text", "spans", "copy").mapInArrow(
        _remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
