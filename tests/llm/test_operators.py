"""Each operator against a plain restatement on small documents with odd cases."""

import hashlib
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promptmill.llm import (chat, exact_dedup, license_scan, mixing, ngram_join, quality_rules,
                            sentencepiece_codec, sharding, suffix_dedup, token_codes)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def rank(doc):
    return -1 if doc is None else doc


# ---- op1 ------------------------------------------------------------------------------------

def test_shards_are_even_and_numbered(spark, docs, tmp_path):
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1
    weights = sharding.slot_weights(docs, ["doc_id", "text"], size, 512)
    first = sharding.first_map(4, 512)
    second = sharding.rebalanced(first, [b for _, b in weights], 4)
    assert second.version == 2 and sum(r for r, _ in weights) == docs.count()
    for m in (first, second):
        sharding.save_map(sharding.map_rows(spark, m, weights), str(tmp_path / "map"), m.version)
    stored = sharding.load_map(spark, str(tmp_path / "map"))
    placed = sharding.placed(docs, ["doc_id", "text"], stored, 512)
    rows = sharding.numbered(placed.withColumn("size", size), ["doc_id", "text"]).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(b for _, b in weights)
    assert max(loads.values()) - min(loads.values()) <= largest
    sharding.write_shards(placed.drop("text"), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()


def test_rebalancing_moves_few_slots_and_empties_removed_shards():
    loads = [10] * 64
    even = sharding.rebalanced(sharding.first_map(4, 64), loads, 4)
    assert not even.moved_from(sharding.first_map(4, 64))
    grown = sharding.rebalanced(even, loads, 5)
    assert len(grown.moved_from(even)) <= 13 and set(grown.shards) == set(range(5))
    assert set(sharding.rebalanced(even, loads, 3).shards) == {0, 1, 2}


# ---- op2 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(docs, texts, keep):
    groups = defaultdict(list)
    for d, t, _ in texts:
        groups[t or ""].append(d)
    best = {t: (max if keep == "largest" else min)([d for d in g if d is not None], default=None)
            for t, g in groups.items()}
    rows = exact_dedup.mark_duplicates(docs, keep=keep).collect()
    texts_of = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(rows) == len(texts)
    kept = Counter()
    for r in rows:
        t = texts_of[r.text_sha256]
        assert (r.keep_id, r.group_size) == (best[t], len(groups[t]))
        kept[t] += r.kept
    assert all(kept[t] == 1 for t in groups)
    left = exact_dedup.deduplicated(docs, keep=keep)
    assert left.columns == docs.columns
    assert Counter(r.text or "" for r in left.collect()) == Counter(groups.keys())


def test_exact_dedup_splits_hot_texts(spark):
    hot = spark.range(900).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") < 600, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    runs = exact_dedup.sorted_runs(hot, "doc_id", "text")
    assert runs.where("_t = 'hot'").select("_salt").distinct().count() > 4
    rows = exact_dedup.mark_duplicates(hot, keep="largest").where("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(599, 600)} and len(rows) == 600
    assert [r.doc_id for r in rows if r.kept] == [599]
    assert exact_dedup.deduplicated(hot).count() == 301


# ---- op3 ------------------------------------------------------------------------------------

def test_mix_reaches_targets(docs, texts, monkeypatch):
    sizes = Counter()
    for _, t, s in texts:
        sizes[s] += len(WORD.findall(t or ""))
    plain = mixing.mix_plan(docs).collect()
    monkeypatch.setattr(mixing, "BIN_ROWS", 3)
    rows = mixing.mix_plan(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, plain))   # bins change nothing, reruns agree
    assert abs(sum({r.source_size: r.target for r in rows}.values()) - sum(sizes.values())) < 1e-6
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        largest[r.source_size] = max(largest[r.source_size], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rows)


# ---- op4 ------------------------------------------------------------------------------------

def test_layouts_become_turns_and_come_back(spark):
    said = "a\\b </s>[INST]\\ <|turn|> <\\s> \\\\ é"
    data = [(1, 0, '{"prompt":"p","response":"r"}'), (2, 0, '{"instruction":"i","output":"o"}'),
            (3, 0, '{"messages":[{"role":"user","content":"u"},{"role":"tool","content":null}]}'),
            (4, 0, '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}'),
            (5, 1, '{"response":"second"}'), (5, 0, '{"prompt":"first"}'), (6, 0, '{"odd":1}'),
            (None, None, '{"prompt":"x"}')]
    records = spark.createDataFrame(data, "conv_id long, turn long, j string")
    extra = spark.createDataFrame([(7, said)], "conv_id long, t string").select(
        "conv_id", F.lit(0).cast("long").alias("turn"),
        F.to_variant_object(F.struct(F.struct(F.lit("<|text|>").alias("role"),
                                              F.col("t").alias("content")).alias("message")))
        .alias("record"))
    out = chat.formatted(records.select("conv_id", "turn", F.parse_json("j").alias("record"))
                         .unionByName(extra))
    read = out.select("conv_id", "unmapped", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("formatted").cast("binary"), F.col("loss_spans"))
                      .alias("loss")).collect()
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.loss, r.unmapped) for r in read}
    assert got == {
        1: ([("user", "p"), ("assistant", "r")], "r", 0),
        2: ([("system", "i"), ("assistant", "o")], "o", 0),
        3: ([("user", "u"), ("tool", "")], "", 0),
        4: ([("user", "h"), ("assistant", "g")], "g", 0),
        5: ([("user", "first"), ("assistant", "second")], "second", 0),
        6: ([], "", 1), 7: ([("<|text|>", said)], "", 0), None: ([("user", "x")], "", 0)}
    assert chat.formatted(extra.limit(0)).count() == 0


# ---- op5 ------------------------------------------------------------------------------------

def test_repeated_bytes(docs, texts):
    first = {}
    for d, t, _ in sorted(texts, key=lambda r: rank(r[0])):
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i:i + 50], rank(d))
    want = []
    for d, t, _ in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 49):
            if first[raw[i:i + 50]] < rank(d):
                gone[i:i + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want.append((rank(d), len(raw), int(gone.sum()), spans, kept))
    got = [(rank(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffix_dedup.removed(docs).collect()]
    assert sorted(got) == sorted(want)


def test_suffix_sort_with_lying_hashes(monkeypatch):
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 400).astype(np.uint8)
    start, group = np.arange(330), np.zeros(330, np.int64)
    suffixes = suffix_dedup.Suffixes(raw, 8)
    order = suffixes.sorted_in_groups(start, np.array([330]))
    strings = [raw[i:i + 8].tobytes() for i in range(330)]
    assert [strings[i] for i in order] == sorted(strings)
    classes = suffixes.classes(start, group)
    want = {s: i for i, s in enumerate(sorted(set(strings)))}
    assert len(set(zip(classes.tolist(), strings))) == len(want) == classes.max() + 1
    suffixes.hashes.sums[:] = 0     # every stretch seems equal: bytes decide
    classes = suffixes.classes(start, group)
    assert len(set(zip(classes.tolist(), strings))) == len(want)


def test_repeats_inside_a_batch_are_sent_once():
    batch = pa.table({"key": range(4), "tie": [0] * 4, "bits": [b"\xff" * 5000] * 4,
                      "text": ["=" * 5000 + f" {i}" for i in range(4)]}).to_batches()
    out = [b for r in suffix_dedup._cut_out(7, 50, 24)(iter(batch))
           for b in r.column("blob").to_pylist()]
    assert sum(map(len, out)) < 10_000      # 1,109,540 with a stretch for every window


def test_frequent_stretches_are_dealt_by_their_neighbours(spark):
    rng = np.random.default_rng(5)
    passage = "".join(map(chr, rng.integers(97, 123, 120)))
    texts = {}
    for i in range(60):
        around = ["".join(map(chr, rng.integers(97, 99 + 20 * (i % 2), 30))) for _ in range(2)]
        texts[i] = [around[0] + passage + around[1], "ab" * 70 + around[0], "=" * (50 + i) + "\n" * i,
                    around[0][:13] + passage[:60], (passage[:15] + "\n") * 9][i % 5]
    first, want = {}, []
    for i, text in texts.items():
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - 49):
            if first.setdefault(text[at:at + 50], i) < i:
                gone[at:at + 50] = True
        want.append((i, int(gone.sum()), "".join(c for c, g in zip(text, gone) if not g)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    for hot in (1, 4, suffix_dedup.HOT):
        got = suffix_dedup.removed(docs, hot=hot).collect()
        assert sorted((r.doc_id, r.n_removed, bytes(r.kept).decode()) for r in got) == want


# ---- op6 ------------------------------------------------------------------------------------

def test_quality_rules(docs, texts):
    rows = quality_rules.judged(docs.select("doc_id", "text")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = r.text or ""
        words = WORD.findall(text)
        grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1
                   for k in range(5)}
        full = [s for s in text.split("\n") if WORD.search(s)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(full) - len(set(full)), len(covered))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_line_rules(spark):
    lines = {"A fine sentence ends here.": True, "": True, "He said \"so it is.\"": True,
             "Home | About | News | Contact | More.": False, "no end": False, "Read more": False,
             "We use it; all rights reserved.": False, "a*** b&&& c%%% d$$$.": False}
    df = spark.createDataFrame([(k,) for k in lines], "line string")
    assert {r.line: r.ok for r in df.select(
        "line", quality_rules.line_passes(F.col("line")).alias("ok")).collect()} == lines
    good, bad = "One long and quite ordinary sentence of words stands here.", "x y z\n" * 30
    out = quality_rules.cleaned(spark.createDataFrame(
        [(1, good + "\nmenu entry without end", 0), (2, good + "\n" + bad, 0)],
        "doc_id long, text string, n_chars long")).collect()
    assert [(r.doc_id, r.text, r.n_chars) for r in out] == [(1, good, len(good))]


# ---- op7 ------------------------------------------------------------------------------------

def test_components(docs, texts):
    lower = {c: c + 32 for c in range(65, 91)}
    sets, parent = [], list(range(len(texts)))
    for _, t, _ in texts:
        w = WORD.findall((t or "").translate(lower))
        sets.append({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(texts):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted((rank(d), len(sets[i]), rank(least.get(find(i))))
                  for i, (d, _, _) in enumerate(texts))
    got = ngram_join.components(docs)
    assert sorted((rank(r.doc_id), r.n_shingles, rank(r.component_id))
                  for r in got.collect()) == want
    left = ngram_join.one_per_group(docs)
    assert left.columns == docs.columns


def test_chains_are_one_component(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(50 - k, " ".join(base[2 * k:2 * k + 60])) for k in range(9)]
    out = ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in out.collect()} == {42}


# ---- op8 ------------------------------------------------------------------------------------

def test_pieces_round_trip_and_chunks(docs, texts):
    one = {(r.doc_id, r.text): r.ids for r in sentencepiece_codec.encoded(docs, PIECES).collect()}
    cut = sentencepiece_codec.encoded(docs, PIECES, giant=100, chunk=37)
    back = sentencepiece_codec.decoded(cut, PIECES).collect()
    assert len(back) == len(texts) and max(r.n_chunks for r in back) > 100
    pieces = sentencepiece_codec.Pieces(PIECES)
    score = dict(v for v in pieces.table.values() if v)

    def total(ids):
        return sum(score.get(i, pieces.unknown) for i in ids)
    for r in back:
        assert r.decoded == r.text
        assert total(r.ids) == pytest.approx(total(one[r.doc_id, r.text]))


def test_best_path_against_all_segmentations():
    encoder = sentencepiece_codec.Encoder(PIECES)
    table = {k: v for k, v in encoder.pieces.table.items() if v}

    def best(word):
        if not word:
            return 0.0
        return max((table[word[:n]][1] + best(word[n:]) for n in range(1, len(word) + 1)
                    if word[:n] in table), default=float("-inf"))
    words = [" the", " within", " stone", " cold", "xyz", " paper.", " morning"]
    encoder.learn(words)
    for word in words:
        assert encoder.known[word][1] == best(word) == encoder.pieces.path(word, 0, len(word))[1]


def test_ids_and_texts_in_one_python_step(docs):
    one = sentencepiece_codec.encoded_and_decoded(docs, PIECES, giant=100, chunk=37)
    two = sentencepiece_codec.decoded(
        sentencepiece_codec.encoded(docs, PIECES, giant=100, chunk=37), PIECES)
    assert one.columns == two.columns
    assert Counter(map(repr, one.collect())) == Counter(map(repr, two.collect()))


def test_decoding_holds_no_encoder(monkeypatch):
    monkeypatch.delitem(sys.modules, "_promptmill_encoders", raising=False)
    ids = pa.array([sentencepiece_codec.Encoder(PIECES).pieces.path(" the stone", 0, 10)[0], None])
    batches = pa.table({"ids": ids}).to_batches()
    out = list(sentencepiece_codec._decode(PIECES, "ids")(iter(batches)))
    assert out[0].column("decoded").to_pylist() == ["the stone", ""]
    assert "_promptmill_encoders" not in sys.modules


def test_runs_of_flags_end_with_their_stretch():
    flags = np.array([1, 1, 0, 1, 1, 1, 0, 0, 1], bool)
    begin, end, who = suffix_dedup._runs_of_flags(flags, np.array([0, 4, 6, 8]))
    assert list(zip(begin.tolist(), end.tolist(), who.tolist())) == [
        (0, 1, 0), (3, 3, 0), (4, 5, 1), (8, 8, 3)]


# ---- op9 ------------------------------------------------------------------------------------

def test_license_scan(docs, texts):
    rows = {r.doc_id: r for r in license_scan.scanned(docs).collect()}
    assert rows[72].labels == "gpl,gpl-notice" and rows[72].score == 1.0
    assert (rows[72].n_base, rows[72].first_word) == (1, 7)
    assert (rows[73].n_base, rows[73].first_word, rows[73].last_word) == (3, 0, 7)
    assert rows[73].labels == "mit,mit-notice" and rows[73].base_labels == "mit"
    assert rows[60].n_words == rows[61].n_words == 0 and rows[61].labels == ""
    assert all(r.score == 0 and r.first_word is None for d, r in rows.items()
               if d not in (72, 73))


WRAPPED = {
    "mit-grant": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "bsd-grant": """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:"""}


def test_license_scan_across_lines(spark):
    import re
    filler = "the of lake is granted\nsoftware to any person without the use\n\n"
    mit, bsd = WRAPPED["mit-grant"], WRAPPED["bsd-grant"]
    texts = [mit, bsd, filler + mit + "\n" + filler, mit.replace(" ", "\n"), filler * 40,
             f"{filler}{bsd}\n{filler * 5}{mit}\n{filler * 5}{bsd}", mit[:100],
             "Released under the\nMIT License", "Released under the MIT License\nand the",
             "software\n" + " ".join(mit.split()), None, "\n\n"]
    out = license_scan.scanned(spark.createDataFrame(list(enumerate(texts)),
                                                     "doc_id long, text string"))
    rows = {r.doc_id: r for r in out.collect()}
    for i, text in enumerate(texts):
        words = re.findall(license_scan.WORDS, (text or "").lower())
        lines = [re.findall(license_scan.WORDS, x) for x in (text or "").lower().split("\n")]
        want = {}
        for (label, notice), own in zip(license_scan.TEMPLATES,
                                        license_scan.template_words().values()):
            span = license_scan.window_words(notice)
            shared = max(len(set(own) & set(b)) for b in
                         lines + [words[a:a + span] for a in range(len(words))])
            if shared >= license_scan.needed_words(len(own)):
                want[label] = shared / len(own)
        assert set(rows[i].labels.split(",")) - {"mit", ""} == set(want), i
        assert rows[i].score == max(want.values(), default=0), i
    assert [rows[i].labels for i in range(4)] == ["mit-grant", "bsd-grant", "mit-grant",
                                                  "mit-grant"]
    assert [rows[i].n_blocks for i in range(10)] == [1, 1, 1, 1, 0, 3, 0, 1, 1, 1]


# ---- op10 -----------------------------------------------------------------------------------

def test_codes_give_any_token():
    ids = np.random.default_rng(2).choice([0, 5, 255, 256, 50256, 70000, 1 << 31], 2000)
    codes = token_codes.Codes(token_codes.pack(ids))
    assert len(codes) == 2000 and [codes[i] for i in range(2000)] == ids.tolist()
    for a, b in ((0, 2000), (511, 513), (1999, 2000), (7, 7)):
        assert codes.span(a, b).tolist() == ids[a:b].tolist()
    assert len(token_codes.Codes(token_codes.pack(np.empty(0)))) == 0


def test_token_files(docs, texts, monkeypatch):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    rows = sorted(token_codes.encoded_documents(docs, BPE, segment_ids=500).collect(),
                  key=lambda r: r.start)
    want = {(rank(d), zlib.crc32(np.array(tokenizer.encode(
        t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for d, t, _ in texts}
    assert {(rank(r.doc_id), r.ids_crc32) for r in rows} == want
    assert [rank(r.doc_id) for r in rows] == sorted(rank(d) for d, _, _ in texts)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    encoder = token_codes.WordEncoder(BPE)
    monkeypatch.setattr(token_codes, "SLICE_CHARS", 50)
    for _, t, _ in texts:
        assert np.frombuffer(encoder.encode([t or ""])[0], "<u4").tolist() == tokenizer.encode(
            t or "", add_special_tokens=False).ids


# ---- all ------------------------------------------------------------------------------------

def test_empty_tables(none):
    few = none.select("doc_id", "text", "source")
    for out in (exact_dedup.mark_duplicates(few), exact_dedup.deduplicated(few),
                mixing.mix_plan(few), mixing.mixed(few), suffix_dedup.removed(few),
                quality_rules.judged(few), ngram_join.components(few), license_scan.scanned(few),
                sentencepiece_codec.encoded(few, PIECES),
                token_codes.encoded_documents(few, BPE)):
        assert out.count() == 0
