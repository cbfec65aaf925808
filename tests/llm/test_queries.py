"""Registered queries of the subpackage against plain restatements, on small tables."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from promptmill.llm import queries, token_codes

MARKED = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y", "end <|endoftext|>",
          "<|endoftext|><|endoftext|> z", "no <|endof text|>", "a.b, c. ö. 3. ..", "Mr. x; y: z!?"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, docs):
    root = tmp_path_factory.mktemp("tables")
    extra = spark.createDataFrame([(200 + i, t) for i, t in enumerate(MARKED)],
                                  "doc_id long, text string")
    docs.unionByName(extra, allowMissingColumns=True).withColumn("rows", docs.kept).write.parquet(
        f"{root}/documents.parquet")
    docs.limit(0).write.parquet(f"{root}/empty/documents.parquet")
    return str(root)


def test_op1_every_law_of_the_bytes(spark, folder, texts):
    got = queries.op1_slot_shards(spark, folder).collect()
    every = [(d, t) for d, t, _ in texts] + [(200 + i, t) for i, t in enumerate(MARKED)]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in every)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    sizes, slots = Counter(), {}
    for r in got:
        assert 0 <= r.shard < queries.SHARDS
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # no shard is above its share by more than the largest row
    assert max(sizes.values()) <= sum(sizes.values()) / queries.SHARDS + max(r.size for r in got)


def test_op1_empty_table(spark, folder):
    assert queries.op1_slot_shards(spark, f"{folder}/empty").count() == 0


def test_op10_ids_as_the_library_gives_them(spark, folder, texts):
    """Strings of added tokens are found, as the library finds them."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    every = [(d, t or "") for d, t, _ in texts] + [(200 + i, t) for i, t in enumerate(MARKED)]
    want = Counter()
    for d, t in every:
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = queries.op10_direct_codes(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)):
        assert r.start == at
        at += r.n_tokens


def test_words_put_together_from_stems():
    """Also when words are forgotten and learned again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_codes.WordEncoder(path, 3, special=True)
    for text in ["dog. dog, dog", "dog, cat. dog.", "a.b. é, 漢. x' y's. 2. --. cat;", "cat. . , a ."]:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids
