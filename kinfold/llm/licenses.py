"""License scans: exact set-similarity join of text blocks with license templates, beside exact phrase places.

Base. In the lower-cased text (A-Z only) words are runs outside the separators of WORD; a phrase is found wherever its
words stand consecutively.

Method. Blocks are the lines of a text and its paragraphs (maximal runs of lines with a word). A block and a template
are sets of words; a block meets a template if it contains at least `threshold` of the template's words. Words are ordered
by how many blocks of the whole corpus hold them, rarest first (ties by the word). With need = ceil(threshold * |T|):

* prefix: a block that meets T holds one of T's first |T| - need + 1 words in that order;
* length: it has at least `need` distinct words;
* position: when its first common word is the i-th of T, at most |T| - i words can still be common.

The filters only drop blocks that cannot meet the template, so the join is exact. The corpus pass that counts words keeps
template words alone: its result, and what is sent to the tasks, is bounded by the templates.

Templates of fewer than LEAST_WORDS distinct words take no part: so few words stand together by chance.

Defined cases: null and empty texts: no words, no places, labels '', score 0. A text's labels do not depend on other rows'
order; repeated rows repeat their results; very long texts are linear work of one row; other columns are not read; an empty
table gives an empty result. The pass that counts words runs while the result is built.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Phrases and their labels (fixed values).
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
THRESHOLD = 0.85
#: Templates of fewer distinct words would be met by chance and take no part.
LEAST_WORDS = 12
#: Label -> notices (fixed values: the customary wording of public licenses).
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                 "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
              "as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
            "software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
              "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def lowered(text: str | None) -> str:
    """A-Z in lower case, every other character unchanged."""
    return (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def blocks(text: str) -> list[str]:
    """Lines with a word, and paragraphs of two or more of them."""
    found, run = [], []
    for line in [*text.split("\n"), ""]:
        if WORD.search(line):
            run.append(line)
        else:
            found += run
            if len(run) > 1:
                found.append("\n".join(run))
            run = []
    return found


def template_sets(templates) -> list[tuple[str, frozenset]]:
    """(label, distinct words) of the templates that are long enough."""
    found = [(label, frozenset(WORD.findall(lowered(notice)))) for label, notice in templates]
    return [(label, words) for label, words in found if len(words) >= LEAST_WORDS]


class Join:
    """Templates in global word order, with an index of their prefixes."""

    def __init__(self, templates, frequency: dict[str, int], threshold: float):
        self.items, self.prefix_of = [], {}
        for k, (label, tokens) in enumerate(template_sets(templates)):
            order = sorted(tokens, key=lambda w: (frequency.get(w, 0), w))
            need = math.ceil(threshold * len(order) - 1e-9)
            self.items.append((label, order, tokens, need))
            for i, w in enumerate(order[: len(order) - need + 1]):
                self.prefix_of.setdefault(w, []).append((k, i))
        self.prefix = frozenset(self.prefix_of)
        self.least = min((need for *_, need in self.items), default=0)

    def matches(self, block: frozenset) -> dict[int, float]:
        """Template number -> containment, for every template that the block meets."""
        found: dict[int, float] = {}
        first: dict[int, int] = {}
        if len(block) < self.least:
            return found
        for w in self.prefix & block:
            for k, i in self.prefix_of[w]:
                first[k] = min(i, first.get(k, i))
        for k, i in first.items():
            _, order, tokens, need = self.items[k]
            if len(block) >= need and len(order) - i >= need:
                common = len(tokens & block)
                if common >= need:
                    found[k] = common / len(order)
        return found


def _counts(vocabulary: frozenset):
    """(word, blocks) of the template words in each task."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = lowered(text.as_py())
                if vocabulary.isdisjoint(WORD.findall(text)):
                    continue
                for block in blocks(text):
                    counts.update(vocabulary.intersection(WORD.findall(block)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return run


def phrase_places(words: list[str], phrases=PHRASES) -> list[tuple[int, str]]:
    """(word number, label) of every place where a phrase's words stand consecutively."""
    found = []
    joined = f" {' '.join(words)} "
    for phrase, label in phrases:
        at = joined.find(f" {phrase} ")
        done, number = 0, 0
        while at >= 0:
            number += joined.count(" ", done, at)
            done = at
            found.append((number, label))
            at = joined.find(f" {phrase} ", at + 1)
    return found


def _scan(templates, frequency: dict[str, int], threshold: float):
    def run(batches):
        join = Join(templates, frequency, threshold)
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = lowered(text.as_py())
                words = WORD.findall(text)
                present = not join.prefix.isdisjoint(words)
                places = phrase_places(words) if "license" in text or "cc" in text else []
                labels, score = {label for _, label in places}, 0.0
                base = ",".join(sorted(labels))
                if present:
                    for block in blocks(text):
                        for k, containment in join.matches(frozenset(WORD.findall(block))).items():
                            labels.add(join.items[k][0])
                            score = max(score, containment)
                starts = [i for i, _ in places]
                row = [doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(labels)), score]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return run


def scan_licenses(docs: DataFrame, *, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs (doc_id, text): words, phrase places, labels of phrases and templates, best containment."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    vocabulary = frozenset(w for _, tokens in template_sets(templates) for w in tokens)
    counted = rows.select("text").mapInArrow(_counts(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r["word"]: r["n"] for r in counted.collect()}  # at most one row per template word
    return rows.mapInArrow(_scan(templates, frequency, threshold), SCHEMA)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_WORDS_SQL = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLACES_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1:i + {len(phrase.split())}] = {_sql_list(phrase.split())})) AS i FROM d" for phrase, label in PHRASES
)
_TEMPLATES_SQL = ", ".join(f"('{label}', {_sql_list(sorted(tokens))})" for label, tokens in template_sets(TEMPLATES))
#: The same rows in DuckDB's SQL: every block against every template.
ORACLE_SQL = f"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
d AS (SELECT doc_id, text, {_WORDS_SQL.format('text')} AS ws FROM low),
places AS ({_PLACES_SQL}),
lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM d),
worded AS (SELECT doc_id, i, {_WORDS_SQL.format('line')} AS ws FROM lines),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM worded WHERE len(ws) > 0),
blocks AS (SELECT doc_id, list_distinct(ws) AS b FROM runs UNION ALL SELECT doc_id, list_distinct(flatten(list(ws))) FROM runs GROUP BY doc_id, run),
templates(label, t) AS (VALUES {_TEMPLATES_SQL}),
met AS (
  SELECT doc_id, label, len(list_intersect(t, b)) / CAST(len(t) AS DOUBLE) AS share FROM blocks, templates
  WHERE len(list_intersect(t, b)) >= ceil({THRESHOLD} * len(t) - 1e-9)
),
by_place AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
by_label AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM met UNION ALL SELECT doc_id, label FROM places) GROUP BY doc_id),
by_share AS (SELECT doc_id, max(share) AS score FROM met GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(p.n, 0) AS n_base, CAST(p.a AS BIGINT) AS first_word, CAST(p.z AS BIGINT) AS last_word,
       coalesce(p.labels, '') AS base_labels, coalesce(l.labels, '') AS labels, coalesce(s.score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN by_place p USING (doc_id) LEFT JOIN by_label l USING (doc_id) LEFT JOIN by_share s USING (doc_id)
"""
