"""The pipeline's stages on the smallest tables, each against its definition on the stage's own input."""

import re
from collections import defaultdict

import corpus_pipeline as P

from kinfold.llm import quality
from kinfold.llm.near_dedup import WordHashes, overlap, shingle_hashes, split_words

from ..conftest import DATA
from .helpers import ROWS, frame
from .test_decontaminate import brute as contaminated
from .test_line_dedup import brute as deduplicated


def good(rows):
    """doc_id -> text of the documents that the quality rules keep, by the definition."""
    normal = lambda x: re.sub("[0-9]+", "0", re.sub("[ \t-\r]+", " ", x.lower())).strip(" ")
    holders, texts = defaultdict(dict), defaultdict(set)
    for r in rows:
        text = r["text"] or ""
        texts[r["source"]].add(text)
        for line in {normal(x) for x in text.split("\n")} - {""}:
            holders[r["source"], line].setdefault(text, r["doc_id"])
            holders[r["source"], line][text] = min(holders[r["source"], line][text], r["doc_id"])
    often = {}
    for (host, line), found in holders.items():
        n = len(found)
        if n >= quality.MAX_DOCS or n >= quality.MIN_DOCS and 100 * n > quality.MAX_PERCENT * len(texts[host]):
            often[host, line] = min(found.values())
    kept = {}
    for r in rows:
        n, _, _, _, repeats = quality.text_counts(r["text"])
        lines = (r["text"] or "").split("\n")
        left = [x for x in lines if r["doc_id"] <= often.get((r["source"], normal(x)), r["doc_id"])]
        words = sum(len(re.findall("[^ \t-\r]+", x)) for x in left)
        if n >= 50 and 100 * repeats <= 50 * n and 100 * words >= quality.LEFT_PERCENT * n:
            kept[r["doc_id"]] = "\n".join(left)
    return kept


def test_stages(spark, tmp_path):
    import numpy as np

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.collect()
    columns, before = docs.columns, [(r["doc_id"], r["text"]) for r in rows]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k == len(P.STAGES) - 1:
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(i for i, _ in before)
            assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_in_place"]
            break
        assert docs.columns == columns
        after = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "quality rules":
            assert dict(after) == good(rows)
        elif name == "line dedup":
            want = {d[0]: t for d, t in deduplicated(before).items()}
            assert dict(after) == {i: t for i, t in want.items() if t.strip()}
        elif name == "MinHash near-dedup":
            hashes = WordHashes()
            bags = {i: np.sort(shingle_hashes(split_words(t), hashes)) for i, t in before}
            kept = {i for i, _ in after}
            assert not any(overlap(bags[a], bags[b]) >= 0.8 for a in kept for b in kept if a < b)
            assert all(any(overlap(bags[a], bags[b]) >= 0.8 for b in bags if b < a) for a in set(bags) - kept)
        else:
            assert {i for i, _ in after} == {i for i, _ in before} - {i for i, _ in contaminated(before, items)}
        before = after


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, DATA)
    assert sorted(map(tuple, P.run(spark, DATA).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_on_odd_rows(spark):
    """Nulls in every column, blanks, repeats, odd names, an empty table."""
    for rows in (ROWS, []):
        docs = frame(spark, rows)
        for k, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, DATA)
            assert k == len(P.STAGES) - 1 or out.columns == docs.columns, name
            assert out.count() <= docs.count(), name
    long = " ".join(f"w{i}x{i % 7}" for i in range(3000))
    docs = frame(spark, [(1, long), (1, long), (2, long), (None, long + " end"), (3, f"{long}\n{long}"), (4, None)])
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
    assert {r["doc_id"] for r in docs.collect()} <= {1, 3, None}
