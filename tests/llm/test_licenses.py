import random
import re

from kinfold.llm import licenses as M

from .helpers import frame

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    words = words_of(text)
    places = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    return words, places


def brute_labels(text):
    """Every block against every template."""
    lines = (text or "").split("\n")
    found, run = [], []
    for line in [*lines, ""]:
        if words_of(line):
            run.append(line)
        else:
            found += run + (["\n".join(run)] if len(run) > 1 else [])
            run = []
    labels, best = set(), 0.0
    for block in found:
        for label, notice in M.TEMPLATES:
            template = set(words_of(notice))
            share = len(template & set(words_of(block))) / len(template)
            if share >= M.THRESHOLD:
                labels.add(label)
                best = max(best, share)
    return labels, best


def test_against_brute_force(spark):
    draw = random.Random(9)
    vocabulary = ["under", "the", "MIT", "License", "apache", "Version", "2", "cc", "by", "nc", "É", "x", "\n", "-", "by-nc", "Kelvin"]
    docs = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 30)))) for i in range(150)]
    for i in range(120):
        words = draw.choice(M.TEMPLATES)[1].split()
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = draw.choice(["zzz", "\n", ""])
        docs.append((1000 + i, "before\n" + " ".join(words) + "\nafter"))
    docs += [(5000, "under the mit license under the mit license"), (5001, "cc by nc by nc cc by nc")]
    rows = {r["doc_id"]: r for r in M.scan_licenses(frame(spark, docs)).collect()}
    labelled = 0
    for doc_id, text in docs:
        words, places = brute(text)
        labels, score = brute_labels(text)
        r = rows[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places)), text
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert r["labels"] == ",".join(sorted(labels | {label for _, label in places})) and abs(r["score"] - score) < 1e-12
        labelled += bool(labels)
    assert labelled > 30


def test_a_few_words_are_no_template(spark):
    docs = [(1, "Acme is licensed. Look under 4 chairs, cc the boss by noon, nc 0 percent."), (2, "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.")]
    rows = {r["doc_id"]: (r["labels"], r["score"]) for r in M.scan_licenses(frame(spark, docs)).collect()}
    assert rows == {1: ("", 0.0), 2: ("cc-by-nc", 1.0)}
    assert all(len(words) >= M.LEAST_WORDS for _, words in M.template_sets(M.TEMPLATES)) and len(M.template_sets(M.TEMPLATES)) == len(M.TEMPLATES)
    assert M.template_sets([("x", "a few words")]) == []


def test_edge_cases(spark):
    rows = M.scan_licenses(frame(spark)).collect()
    assert len(rows) == 10 and all(r["n_base"] == 0 and r["labels"] == "" and r["score"] == 0 for r in rows)
    assert M.scan_licenses(frame(spark, [])).count() == 0
    assert M.phrase_places(["cc", "by", "nc"] * 30_000)[-1] == (89_997, "cc-by-nc")
