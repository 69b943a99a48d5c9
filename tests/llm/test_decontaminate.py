import random
from collections import Counter

import pytest

from kinfold.llm import decontaminate as M

from .helpers import frame, random_text


def shingles(text):
    words = (text or "").lower().encode().split()
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute(docs, items):
    found = {}
    for doc_id, text in docs:
        s = shingles(text)
        for item_id, item in items:
            bag = Counter(shingles(item))
            size, best = sum(bag.values()), 0.0
            for start in range(len(s)):
                window = Counter(s[start : start + size])
                common = sum((window & bag).values())
                best = max(best, common / (sum(window.values()) + size - common)) if size else best
            if best >= 0.8:
                found[doc_id, item_id] = best
    return found


@pytest.mark.parametrize("broadcast_bytes", [M.BROADCAST_BYTES, 0])
def test_against_brute_force(spark, broadcast_bytes):
    draw = random.Random(12)
    vocabulary = [f"v{k}" for k in range(40)]
    items = [(i, random_text(draw, draw.randint(5, 40), vocabulary)) for i in range(12)] + [(50, "too short item"), (51, None), (52, "go " * 30)]
    docs = []
    for i in range(90):
        words = random_text(draw, draw.randint(0, 30), vocabulary).split()
        passage = (draw.choice(items)[1] or "").split()
        for _ in range(draw.randint(0, 2)):
            if passage:
                passage[draw.randrange(len(passage))] = draw.choice(vocabulary)
        cut = draw.randint(0, len(words))
        docs.append((i, " ".join(words[:cut] + passage[draw.randint(0, 2) :] + words[cut:])))
    docs += [(200, None), (201, ""), (202, "go " * 25), (203, " ".join(items[0][1].upper().split()))]
    want = brute(docs, items)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in M.contaminated(frame(spark, docs), table, broadcast_bytes=broadcast_bytes).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want) and len(want) > 20
    if broadcast_bytes:
        clean = {r["doc_id"] for r in M.keep_clean(frame(spark, docs), table).collect()}
        assert clean == {i for i, _ in docs} - {i for i, _ in want}


def bits_of(words):
    """The fingerprint of a multiset of words, bit by bit."""
    return sum(1 << b for b in range(64) if 2 * sum(w >> b & 1 for w in words) > len(words))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_index_meets_every_pair_within_the_radius_and_few_others(spark):
    draw = random.Random(4)
    one = [draw.getrandbits(64) for _ in range(60)]
    two = []
    for a in one:
        for _ in range(5):
            b = a
            for bit in draw.sample(range(64), M.RADIUS):
                b ^= 1 << bit
            two.append(b)
    far = [draw.getrandbits(64) for _ in range(400)]
    bags = spark.createDataFrame([(i, i, 7, signed(x)) for i, x in enumerate(one)], "item long, item_id long, size int, fp long")
    windows = spark.createDataFrame([(i, 7, signed(x)) for i, x in enumerate(two + far)], "pos int, size int, fp long")
    met = {(r["pos"], r["item"]) for r in M.near(windows, bags, M.RADIUS).collect()}
    assert met == {(i, j) for i, x in enumerate(two + far) for j, y in enumerate(one) if (x ^ y).bit_count() <= M.RADIUS} and len(met) >= 300
    asked = windows.where("pos >= 300").withColumn("k", M.F.explode(M.block_keys(M.F.col("fp"), M.F.col("size"))))
    assert asked.join(M.filed(bags, M.RADIUS), "k").count() < 0.05 * 400 * 60  # rows of the index join between unrelated fingerprints


def test_fingerprints_of_windows(spark):
    draw = random.Random(6)
    words = [draw.choice([draw.getrandbits(64) for _ in range(9)] + [draw.getrandbits(64)]) for _ in range(50)]
    cells = spark.createDataFrame([((1, 2), i, signed(w)) for i, w in enumerate(words)], f"{M.TEXT_HASH} struct<a:long,b:long>, at int, h long")
    wanted = [(p, w) for p in (0, 3, 20, 45, 49) for w in (1, 5, 12)]
    windows = spark.createDataFrame([((1, 2), 50, p, w) for p, w in wanted], f"{M.TEXT_HASH} struct<a:long,b:long>, n int, pos int, size int")
    got = {(r["pos"], r["size"]): r["fp"] for r in M.fingerprints(cells, windows).collect()}
    assert got == {(p, w): signed(bits_of(words[p : p + w])) for p, w in wanted}


@pytest.mark.parametrize("similarity, least", [(0.8, 0.9), (0.85, 0.98), (0.9, 0.999)])
def test_recall_of_the_radius(similarity, least):
    draw, found, n = random.Random(8), 0, 1500
    for _ in range(n):
        size = draw.randint(20, 60)
        common = round(2 * size * similarity / (1 + similarity) + 0.499)  # the fewest that reach the similarity
        both = [draw.getrandbits(64) for _ in range(common)]
        a, b = (both + [draw.getrandbits(64) for _ in range(size - common)] for _ in range(2))
        found += (bits_of(a) ^ bits_of(b)).bit_count() <= M.RADIUS
    assert found / n >= least


@pytest.mark.parametrize("n, item", [(20_000, 1_000), (200_000, 1_500)])
def test_very_long_repetitive_texts(spark, n, item):
    turn = [f"w{k}" for k in range(7)]
    long = " ".join(turn[k % 7] for k in range(n))
    items = spark.createDataFrame([(1, " ".join(turn[k % 7] for k in range(item))), (2, " ".join(f"x{k}" for k in range(30)))], "item_id long, text string")
    rows = M.contaminated(frame(spark, [(1, long), (2, "w0 w1 w2 w3 w4 w5")]), items).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"], r["start"], r["n_shingles"]) for r in rows] == [(1, 1, 1.0, 0, item - 4)]


def test_edge_cases(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(9, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    assert M.contaminated(frame(spark), none).count() == 0
    assert M.contaminated(frame(spark, []), one).count() == 0
    assert {(r["doc_id"], r["start"]) for r in M.contaminated(frame(spark), one).collect()} == {(1, 0), (5, 0)}
    assert M.keep_clean(frame(spark), none).count() == 10
    kept = M.keep_clean(frame(spark), one)
    assert kept.count() == 7 and kept.columns == frame(spark).columns
    assert M.contaminated(frame(spark, [(None, "alpha beta gamma delta epsilon zeta eta theta")]), one).first()["doc_id"] is None
