"""Large groups of the n-gram join: many near copies that are not near each other."""

import random

import numpy as np
import pytest

from promptmill.llm import ngram_join


def near_copies(n, seed, changes=(1, 2), length=60):
    """Texts that each change a few words of one text, which is not among them."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    out = []
    for i in range(n):
        words = list(base)
        for k in range(rng.choice(changes)):
            words[rng.randrange(length)] = f"x{i}_{k}" if rng.random() < 0.7 else rng.choice("abc")
        out.append(" ".join(words))
    return out


def brute(texts, n, percent):
    """Smallest place of each text's component, over all pairs."""
    names, sets = {}, []
    for t in texts:
        w = t.split()
        grams = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}
        sets.append(np.array(sorted(names.setdefault(g, len(names)) for g in grams)))
    held = np.zeros((len(sets), len(names)), np.float32)
    for i, s in enumerate(sets):
        held[i, s] = 1
    both = held @ held.T
    sizes = held.sum(axis=1)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None] - both)
    label = np.arange(len(sets))
    while True:
        least = np.where(linked, label[None], len(sets)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label.tolist()
        label = least


def component_ids(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = ngram_join.components(df, **options).collect()
    return [r.component_id for r in sorted(out, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("few", [20, ngram_join.FEW])
def test_near_copies_without_their_original(spark, monkeypatch, few):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_MEMBER", 2)
    texts = near_copies(130, 4)
    want = brute(texts, 5, 80)
    assert 3 < len(set(want)) < 110
    assert component_ids(spark, texts, n=5, percent=80) == want


def test_rows_stay_in_proportion(spark, monkeypatch):
    """Candidate pairs, finer groups and links are a few for each near copy, not one for each pair
    of them."""
    monkeypatch.setattr(ngram_join, "FEW", 50)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_MEMBER", 2)
    counts = []
    plain = ngram_join.written

    def counted(df, name):
        out = plain(df, name)
        counts.append(out.count() if name in ("kinds", "finer-groups", "links") else 0)
        return out
    monkeypatch.setattr(ngram_join, "written", counted)
    totals = []
    for n in (120, 240):
        counts.clear()
        component_ids(spark, near_copies(n, 9, changes=(2, 3)), n=5, percent=80)
        totals.append(sum(counts))
    assert totals[0] < 12 * 120 and totals[1] < 12 * 240


def counted_rows(monkeypatch, counts, *names):
    plain = ngram_join.written

    def counted(df, name):
        out = plain(df, name)
        if name in names:
            counts[name] = counts.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(ngram_join, "written", counted)


def test_dense_groups_are_marked_and_merged(spark, monkeypatch):
    """A dense group takes one row of the kinds, not one for each member, and groups of nearly the
    same members are compared once."""
    monkeypatch.setattr(ngram_join, "PAIRS_PER_MEMBER", 2)
    counts, texts = {}, near_copies(130, 4, changes=(2, 3), length=150)
    counted_rows(monkeypatch, counts, "kinds", "candidates", "finer-groups")
    assert component_ids(spark, texts, n=5, percent=80) == brute(texts, 5, 80)
    assert counts["kinds"] < 4 * 130 and counts["candidates"] < 2 * 130
    assert "finer-groups" not in counts


def test_groups_of_more_parts_are_refined(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", 70)
    monkeypatch.setattr(ngram_join, "PARTS", 1)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_MEMBER", 2)
    counts, texts = {}, near_copies(90, 4, changes=(2, 3), length=150)
    counted_rows(monkeypatch, counts, "finer-groups")
    assert component_ids(spark, texts, n=5, percent=80) == brute(texts, 5, 80)
    assert counts["finer-groups"]


def test_groups_of_many_tokens_are_dealt(spark, monkeypatch):
    """A group with few members of large sets takes several tasks, and any two of them meet."""
    monkeypatch.setattr(ngram_join, "FEW_TOKENS", 1500)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_MEMBER", 2)
    texts = near_copies(90, 4)
    assert component_ids(spark, texts, n=5, percent=80) == brute(texts, 5, 80)


def test_any_two_members_meet_after_dealing(spark):
    rows = [(g, r, 60, 0, r, parts) for g, size, parts in ((1, 40, 1), (2, 70, 7), (3, 50, 3))
            for r in range(size)]
    out = ngram_join._dealt(spark.createDataFrame(
        rows, "gid long, rep long, n long, place long, comp long, parts long")).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.gid, set()).add(r.rep)
    for size in (40, 70, 50):
        assert all(any({a, b} <= g for g in groups.values())
                   for a in range(size) for b in range(a))
    assert len(out) == 40 + 70 * 6 + 50 * 2


def test_counts_of_shared_hashes_by_columns(monkeypatch):
    rng = np.random.default_rng(3)
    members = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(25)]
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    both = ngram_join._meeting(members)
    assert all(both[i, j] == len(np.intersect1d(members[i], members[j]))
               for i in range(25) for j in range(25) if i != j)


def test_token_of_many_unlinked_documents(spark):
    """A passage that fills most of every text, between words of their own."""
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(14))
    texts = [" ".join(f"u{i}_{k}" for k in range(4)) + " " + passage for i in range(1500)]
    texts += [t + " end" for t in rng.sample(texts, 20)]
    got = component_ids(spark, texts, n=5, percent=60)
    assert got == brute(texts, 5, 60)


def test_refinement_loses_no_link(spark):
    """Sure links and finer groups cover every linked pair of a group."""
    texts = near_copies(120, 3, changes=(1, 2, 3))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sets = ngram_join.shared_sets(df, "doc_id", "text", 5, 80)
    reps = sets.where("tokens IS NOT NULL").select(
        sets.doc_id.alias("rep"), "n", "tokens").dropDuplicates(["tokens", "n"])
    members = reps.selectExpr("7L AS gid", "rep", "n")
    sure, finer = ngram_join._refined(members, reps, 80)
    joined = {tuple(r) for r in sure.collect()}
    groups = {}
    for r in finer.collect():
        groups.setdefault(r.gid, set()).add(r.rep)
    own = {r.rep: {tuple(texts[r.rep].split()[i:i + 5]) for i in range(56)}
           for r in reps.collect()}
    near = {a for p in joined for a in p}
    for a in own:
        for b in own:
            if a < b:
                both = len(own[a] & own[b])
                if 100 * both >= 80 * (len(own[a]) + len(own[b]) - both):
                    assert (a in near and b in near) or any(
                        a in g and b in g for g in groups.values())
    for a, b in joined:
        both = len(own[a] & own[b])
        assert 100 * both >= 80 * (len(own[a]) + len(own[b]) - both)


def test_row_ids_of_late_partitions(spark):
    """Their sums leave the range of a long."""
    links = spark.range(3000).selectExpr("(500L << 44) + 2 * id + 1 AS a", "(500L << 44) + 2 * id AS b")
    got = ngram_join.connected(links).collect()
    assert {(r.rep, r.comp) for r in got if r.rep % 2} == {
        ((500 << 44) + 2 * i + 1, (500 << 44) + 2 * i) for i in range(3000)}


def test_documents_of_many_partitions(spark):
    """Pairs of near copies dealt over so many partitions that the links' row ids add up to more
    than a long holds."""
    words = " ".join(f"w{{0}}_{i}" for i in range(12))
    rows = [(2 * i + k, words.format(i) + " end" * k) for i in range(6000) for k in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(200)
    got = {r.doc_id: r.component_id for r in ngram_join.components(df).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
