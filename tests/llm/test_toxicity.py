import random
from zlib import crc32

import numpy as np
import pytest

from promptmill.llm import queries, toxicity

CALM = "river stone cold morning bright window letter paper seven lake garden table".split()
BAD = "blorkan blorkus blorked vexnar vexnil".split()
COMMON = {"en": "the of and to".split(), "de": "der die und ist".split()}


def text_of(rng, language, toxic, length=40):
    words = [rng.choice(CALM) + rng.choice(["", "s", "ly", "er"]) for _ in range(length)]
    words += rng.choices(COMMON[language], k=10)
    if toxic:
        words += rng.choices(BAD, k=rng.randint(1, 3))
    rng.shuffle(words)
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(8)
    return [(i, text_of(rng, rng.choice(("en", "de")), i % 6 == 0), int(i % 6 == 0))
            for i in range(900)]


@pytest.fixture(scope="module")
def model(labelled):
    train = [(t, y) for i, t, y in labelled if crc32(str(i).encode()) % 3 != 1]
    return toxicity.fit([t for t, _ in train], [y for _, y in train])


def test_words_and_language():
    assert toxicity.words_of("Éa b2c_d\n---") == ["éa", "b", "c", "d"]
    assert toxicity.words_of(None) == []
    assert toxicity.language_of("der hund und das haus".split()) == "de"
    assert toxicity.language_of("xyzzy".split()) == toxicity.OTHER
    assert len(set(toxicity.buckets_of("abcdefgh"))) == 1 + len(toxicity.BEGINNINGS)


def plain_logit(model, text):
    """Window by window."""
    rows = {int(b): r for r, b in enumerate(model.buckets)}
    words = toxicity.words_of(text)
    size = model.table.shape[1]
    vectors = [sum((model.table[rows[b]] for b in toxicity.buckets_of(w) if b in rows),
                   np.zeros(size)) for w in words] + [np.zeros(size)] * max(toxicity.WIDTHS)
    pooled = []
    for width, filters, bias in zip(toxicity.WIDTHS, model.filters, model.biases):
        answers = [sum(vectors[at + k] @ filters[k] for k in range(width)) + bias
                   for at in range(len(words) + 1)]
        pooled += list(np.maximum(np.max(answers, axis=0), 0))
    return float(np.dot(pooled, model.weights) + model.offset)


def test_scores_window_by_window(model, labelled):
    texts = [t for _, t, _ in labelled[:15]] + ["", "one", "blorkan", "a b"]
    scorer = toxicity.Scorer(model)
    got = scorer.logits([toxicity.words_of(t) for t in texts])
    assert np.allclose(got, [plain_logit(model, t) for t in texts], atol=1e-4)
    # the same with a forgetful worker
    scorer.learnt = toxicity.CACHE_WORDS + 1
    assert np.allclose(scorer.logits([toxicity.words_of(t) for t in texts]), got, atol=1e-5)


def test_places_of_the_largest_answers():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 1, 5])
    place, starts, dead = toxicity._pad(lengths)
    vectors = np.zeros((int(lengths.sum()) + 4 * max(toxicity.WIDTHS), toxicity.SIZE), np.float32)
    vectors[place] = rng.standard_normal((9, toxicity.SIZE))
    filters = [rng.standard_normal((w, toxicity.SIZE, 2)).astype(np.float32) for w in toxicity.WIDTHS]
    biases = [np.zeros(2, np.float32)] * 3
    tops, places = toxicity._answers(vectors, starts, dead, filters, biases)
    for j, f in enumerate(filters):
        for t, (start, n) in enumerate(zip(starts, lengths)):
            windows = [[sum(vectors[a + k] @ f[k][:, c] for k in range(len(f)) if a + k < start + n)
                        for a in range(start, start + n + 1)] for c in range(2)]
            assert np.allclose(tops[j][t], np.max(windows, axis=1), atol=1e-5)
            assert places[j][t].tolist() == [start + int(np.argmax(w)) for w in windows]


def test_held_out_accuracy(model, labelled):
    """Documents the model has not seen, among them a stem in a form it has not seen."""
    kept = [(t, y) for i, t, y in labelled if crc32(str(i).encode()) % 3 == 1]
    scores = toxicity.Scorer(model).scores([t for t, _ in kept])
    toxic = np.array([y for _, y in kept])
    assert ((scores >= 0.7) == toxic).mean() > 0.97
    assert set(model.thresholds) == {"en", "de", "other"}
    new = text_of(random.Random(1), "en", False)
    before, after = toxicity.Scorer(model).scores([new, new + " blorkish"])
    assert before < 0.7 <= after


def test_query_rows(spark, tmp_path, labelled):
    odd = [(2000, None), (2001, ""), (2002, "12 34 --"), (2003, "word " * 30_000), (None, "a b"),
           (2004, labelled[0][1]), (2004, labelled[0][1])]
    rows = [(i, t, 0.5, "x") for i, t, _ in labelled] + [(i, t, None, None) for i, t in odd]
    spark.createDataFrame(rows, "doc_id long, text string, score double, key string") \
        .repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 1, y) for i, _, y in labelled] + [(2000, 1, 0), (9999, 1, 1), (None, 1, 1),
                                                    (3, 1, None), (0, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op13_text_cnn_toxicity(spark, str(tmp_path)).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r[0]) for r in rows)
    truth = {i: y for i, _, y in labelled}
    right = seen = 0
    for r in got:
        want = r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] is want and 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.7)
        if want and r["doc_id"] in truth:
            seen += 1
            right += r["predicted"] == truth[r["doc_id"]]
    assert right / seen > 0.95
    twice = {r["score"] for r in got if r["doc_id"] == 2004}
    assert len(twice) == 1
    again = queries.op13_text_cnn_toxicity(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_held_out_labels_teach_nothing(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in labelled], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, marks, size=100, chars=30_000)
    held = {t for i, t, _ in labelled if crc32(str(i).encode()) % 3 == 1}
    assert sample and not {t for t, _ in sample} & held
    assert sum(len(t) for t, _ in sample) <= 30_000
    assert sum(y for _, y in sample) <= 100 and sum(1 - y for _, y in sample) <= 100


def test_without_labels_and_without_documents(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled[:9]], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.classified(docs, marks).collect()} == {0.0}
    assert toxicity.classified(docs.limit(0), marks.limit(0)).count() == 0


def test_every_labelled_text_teaches(spark, monkeypatch, labelled):
    """Also texts longer than those of a bounded sample; in whatever partitions they lie."""
    monkeypatch.setattr(toxicity, "LONGEST", 50)
    monkeypatch.setattr(toxicity, "SHARD_TEXTS", 200, raising=False)
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in labelled], "doc_id long, toxic int")
    got = toxicity.classified(docs, marks).collect()
    held = [(r.predicted, labelled[r.doc_id][2]) for r in got if r.held_out]
    assert np.mean([p == y for p, y in held]) > 0.95 and sum(y for _, y in held) > 20
    again = toxicity.classified(docs.repartition(7), marks).collect()
    assert sorted(again) == sorted(got)
    # each text is in one shard, a fourth of its class calibrates
    train = [(t, y) for i, t, y in labelled if crc32(str(i).encode()) % 3 != 1]
    shards = [s for _, s in toxicity._shards(toxicity.labelled_shards(docs, marks).toArrow().to_batches())]
    assert 1 < len(shards) <= 4 and sum(len(s.toxic) for s in shards) == len(train)
    assert sum(s.toxic.sum() for s in shards) == sum(y for _, y in train)
    assert sum(s.lengths.sum() for s in shards) == sum(len(toxicity.words_of(t)) for t, _ in train)
    assert 0.2 < sum(s.later().sum() for s in shards) / len(train) < 0.25


def test_more_toxic_than_calm_texts():
    """All texts of both classes come up in every epoch."""
    for n, m in ((50, 7), (7, 50), (16, 16), (20, 0)):
        turns = np.concatenate(list(toxicity._turns(np.arange(n), np.arange(100, 100 + m))))
        assert set(turns) == {*range(n), *range(100, 100 + m)}


def test_averages_of_shards():
    """An embedding counts where it moved."""
    def rows(places, value):
        return np.array(places, "<u2").tobytes() + np.full(
            len(places) * toxicity.SIZE, value, np.float32).tobytes()

    frame = toxicity.pd.DataFrame({"block": 3, "shard": [1, 0], "data": [rows([4, 9], 1), rows([9], 4)]})
    places, values = toxicity._open_rows(toxicity._averaged(frame)["data"][0])
    assert places.tolist() == [4, 9] and (values[0] == 1).all() and (values[1] == 2.5).all()
