import random

import numpy as np

from kinfold.llm import common
from kinfold.llm import near_dedup as M

from .helpers import classes, frame, random_text


def edited(draw, text, n):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


def corpus():
    draw = random.Random(8)
    vocabulary = [f"v{k}" for k in range(500)]
    docs = []
    for _ in range(25):
        base = random_text(draw, draw.randint(5, 150), vocabulary)
        docs += [base] * draw.randint(1, 3) + [edited(draw, base, draw.randint(1, 6)) for _ in range(draw.randint(0, 12))]
    docs += [f"{t} " * 3 for t in docs[:5]] + ["a", "A", "b", "one two three four", "One two  three four"]
    draw.shuffle(docs)
    return list(enumerate(docs))


def brute(docs):
    hashes = M.WordHashes()
    bags = {i: np.sort(M.shingle_hashes(M.split_words(t), hashes)) for i, t in docs}
    ids = [i for i, _ in docs if len(bags[i])]
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if M.overlap(bags[a], bags[b]) >= 0.8]
    return classes(pairs, [i for i, _ in docs])


def test_classes_against_brute_force(spark):
    docs = corpus()
    want = brute(docs)
    for options in ({}, {"block": 2}):  # many small blocks must not change the result
        assert {r["doc_id"]: r["class_id"] for r in M.near_duplicates(frame(spark, docs), **options).collect()} == want
    kept = M.keep_one(frame(spark, docs))
    assert kept.columns == frame(spark, docs).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_documents_are_told_apart_by_id_and_text(spark):
    one, two = ("alpha beta gamma delta epsilon zeta eta theta", "iota kappa lambda mu nu xi omicron pi rho")
    docs = [(1, one), (5, one), (5, two), (5, two), (None, two), (None, "sigma tau"), (None, "sigma tau"), (7, "sigma tau"), (8, None)]
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in M.near_duplicates(frame(spark, docs)).collect()) == [(0, 5), (0, 7), (0, 7), (1, 1), (5, 1), (5, 5), (5, 5), (7, 7), (8, 8)]
    assert sorted((r["doc_id"], r["text"]) for r in M.keep_one(frame(spark, docs)).collect()) == [(1, one), (5, two), (7, "sigma tau"), (8, None)]
    assert [r["text"] for r in M.keep_one(frame(spark, [(None, one), (None, one)])).collect()] == [one]


def test_a_very_long_text(spark):
    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(120_000))
    rows = M.near_duplicates(frame(spark, [(1, long), (2, long + " end"), (3, long[: len(long) // 2])])).collect()
    assert {(r["doc_id"], r["class_id"]) for r in rows} == {(1, 1), (2, 1), (3, 3)}


def test_signatures_estimate_weighted_jaccard():
    draw = random.Random(1)
    for _ in range(6):
        a = {draw.randrange(2**60): draw.randint(1, 9) for _ in range(40)}
        b = {k: max(0, v + draw.randint(-3, 3)) for k, v in a.items() if draw.random() < 0.9}
        b = {k: v for k, v in b.items() if v}
        truth = sum(min(v, b.get(k, 0)) for k, v in a.items()) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
        both = [np.array(x, np.uint64) for x in (sorted(a), sorted(b))]
        weights = np.array([a[int(k)] for k in both[0]] + [b[int(k)] for k in both[1]])
        s = M.bag_signatures(np.concatenate(both), weights, np.array([0, len(a), len(a) + len(b)]), 4096)
        assert abs((s[0] == s[1]).mean() - truth) < 0.03


def test_groups_in_one_block_equal_pairs():
    draw = random.Random(3)
    hashes = M.WordHashes()
    base = random_text(draw, 60, [f"v{k}" for k in range(80)])
    bags = [np.sort(M.shingle_hashes(M.split_words(edited(draw, base, draw.randint(0, 3))), hashes)).view(np.int64) for _ in range(40)]
    ids = np.arange(40)
    want = classes([(a, b) for a in ids for b in ids[a + 1 :] if M.overlap(bags[a], bags[b]) >= 0.8], ids)
    assert M.linked_groups(ids, ids, bags, 0.8).tolist() == [want[i] for i in ids]


def test_edge_cases(spark):
    rows = M.near_duplicates(frame(spark)).collect()
    assert len(rows) == 10
    got = {(r["doc_id"], r["class_id"]) for r in rows}
    assert got == {(1, 1), (5, 1), (2, 2), (3, 3), (4, 4), (6, 6), (7, 7), (None, None)}
    kept = sorted((r["doc_id"] or 0) for r in M.keep_one(frame(spark)).collect())
    assert kept == [0, 0, 1, 2, 3, 4, 6, 7]
    assert M.near_duplicates(frame(spark, [])).count() == 0


def test_components_both_ways(spark):
    draw = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(draw.randrange(90), draw.randrange(90)) for _ in range(40)]
    nodes = sorted({n for e in edges for n in e})
    df = spark.createDataFrame(edges, "a long, b long")
    for small in (10**6, 0):
        assert {r["node"]: r["comp"] for r in common.components(df, small).collect()} == classes(edges, nodes)
