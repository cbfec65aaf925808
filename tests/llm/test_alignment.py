import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from promptmill.llm import alignment, queries

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


def tilings(ends_a, ends_b):
    ends_a, ends_b = np.array(ends_a), np.array(ends_b)
    starts = [np.concatenate(([0], e[:-1])) for e in (ends_a, ends_b)]
    return starts[0], ends_a, starts[1], ends_b


def test_groups_and_links_of_random_tilings():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 30)
        a = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        b = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        four = tilings(a, b)
        group_a, group_b = alignment.coalesce(*four)
        cuts = sorted(set(a) & set(b))
        assert group_a.tolist() == [sum(c < e for c in cuts) for e in a]
        assert group_b.tolist() == [sum(c < e for c in cuts) for e in b]
        starts_a, ends_a, starts_b, ends_b = four
        every = [(i, j) for i in range(len(a)) for j in range(len(b))]
        rules = {
            "overlap": lambda i, j: starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i],
            "end": lambda i, j: ends_a[i] == ends_b[j],
            "start": lambda i, j: starts_a[i] == starts_b[j],
            "same": lambda i, j: starts_a[i] == starts_b[j] and ends_a[i] == ends_b[j]}
        for name, rule in rules.items():
            left, right = alignment.links(*four, name)
            assert list(zip(left.tolist(), right.tolist())) == [p for p in every if rule(*p)]


def test_unknown_rule():
    with pytest.raises(ValueError):
        alignment.Aligner(None, None, "nearest")


def plain(texts):
    """Restatement token by token, with the libraries on whole texts."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    names = {i: t for t, i in a.get_vocab().items()}
    value = alignment.byte_characters()

    def piece(i):
        p = b.id_to_piece(i)
        if p.startswith("<0x") and len(p) == 6:
            return bytes([int(p[3:5], 16)])
        return p.replace("▁", " ").encode()

    found = []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(value[c] for c in names[i]) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if not text or {b"".join(bytes_a), b"".join(bytes_b)} != {b" " + text.encode()}:
            found.append(([], [], [], []))
            continue
        ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
        ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, at_a, at_b = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        found.append((ids_a, ids_b, groups, [(x[-1], y[-1]) for x, y in groups]))
    counts = Counter(p for f in found for p in f[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for ids_a, ids_b, groups, pairs in found:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((len(ids_a), len(ids_b), len(groups), len(pairs),
                    sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def as_rows(df):
    return sorted(((r["doc_id"] is None, r["doc_id"]), *(r[n] for n in NAMES)) for r in df.collect())


@pytest.mark.parametrize("part_bytes", [alignment.PART_BYTES, 200])
def test_query_rows(spark, tmp_path, docs, texts, monkeypatch, part_bytes):
    monkeypatch.setattr(alignment, "PART_BYTES", part_bytes)
    monkeypatch.setattr(alignment, "SLICE_BYTES", min(part_bytes, alignment.SLICE_BYTES))
    odd = ["<|endoftext|>", "a <s> b</s><unk>", "▁", "tab\tand  two\n\n spaces ", " ", "\u0000x",
           "é é ﬁ", " \U0001f469‍\U0001f4bb"]
    rows = [(100 + i, t) for i, t in enumerate(odd)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    docs.unionByName(extra, allowMissingColumns=True).withColumn("part", docs.shard) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = as_rows(queries.op12_interval_alignment(spark, str(tmp_path)))
    keys = [d for d, _, _ in texts] + [k for k, _ in rows]
    want = plain([t for _, t, _ in texts] + odd)
    assert got == sorted(((k is None, k), *w) for k, w in zip(keys, want))


def test_empty(spark, none):
    out = alignment.aligned(none, A_PATH, B_PATH, 32_000)
    assert out.columns == ["doc_id", *NAMES] and out.count() == 0
