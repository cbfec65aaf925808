"""The corpus pipeline stage by stage against plain restatements, on the odd-case rows."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from promptmill.llm import quality_rules, sentencepiece_codec

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory, docs):
    """The documents, and what each stage leaves; columns of other names clash on purpose."""
    root = tmp_path_factory.mktemp("corpus")
    # identifiers of documents are unique and present
    rows = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows.write.parquet(f"{root}/documents.parquet")
    now, out = spark.read.parquet(f"{root}/documents.parquet"), []
    out.append(now)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(root)).write.parquet(f"{root}/{i}")
        now = spark.read.parquet(f"{root}/{i}")
        out.append(now)
    return str(root), out


def table(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_rules_reject_documents(stages):
    before, after = stages[1][:2]
    assert after.columns == DOCUMENTS
    kept = {r.doc_id for r in quality_rules.judged(before.select("doc_id", "text")).collect()
            if r.kept}
    assert set(table(after)) == kept and 0 < len(kept) < before.count()


def test_one_of_equal_texts(stages):
    before, after = table(stages[1][1]), table(stages[1][2])
    first = {}
    for i in sorted(before):
        first.setdefault(before[i].text, i)
    assert set(after) == set(first.values()) and stages[1][2].columns == DOCUMENTS


def test_one_of_near_copies(stages):
    before, after = table(stages[1][2]), table(stages[1][3])

    def grams(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets, root = {i: grams(r.text) for i, r in before.items()}, {i: i for i in before}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert set(after) == {i for i in root if find(i) == i} and len(after) < len(before)


def test_mix_repeats_documents(stages):
    before, after = stages[1][3], stages[1][4]
    assert after.columns == DOCUMENTS
    from promptmill.llm import mixing
    want = {r.doc_id: r.copies for r in mixing.mix_plan(before).collect() if r.copies}
    assert Counter(r.doc_id for r in after.collect()) == want
    texts = table(before)
    assert all(r.text == texts[r.doc_id].text for r in after.collect())


def test_tokens_and_back(stages):
    before, after = stages[1][4], stages[1][5].collect()
    assert Counter(r.doc_id for r in before.collect()) == Counter(r.doc_id for r in after)
    texts = table(before)
    table_of_bytes = sentencepiece_codec.Pieces(
        public_tokenizers.path("piece_bpe_32k.model")).bytes
    for r in after:
        text = texts[r.doc_id].text or ""
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert r.text_sha256 == r.decoded_sha256 == digest and r.n_tokens == len(r.ids)
        assert b"".join(table_of_bytes[i] for i in r.ids)[1:].decode() == text


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, stages[0]).collect()
    assert sorted(map(str, got)) == sorted(map(str, stages[1][5].collect()))


def test_empty_table(spark, tmp_path, none):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "ids", "n_tokens", "text_sha256",
                                                "decoded_sha256"]
