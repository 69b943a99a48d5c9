"""Quality rules: per-text counts, and the frequency of lines across the documents of a host.

Method. Lines are normalised (lower case, runs of white space one space, digits one sign) and hashed. For each host (the
`source` column) and line hash the distinct documents are counted; documents of equal text count once, so copying a
document does not make its lines boilerplate. A line is boilerplate in its host if at least `max_docs` documents hold it,
whatever the host's size, or, in a small host, at least `min_docs` of them that are more than `max_percent` percent. It is
removed from every document of the host except the first (by doc_id, then text) that has it, so no line vanishes
altogether. A document is rejected as depleted if less than `left_percent` percent of its words remain. A document is kept
if it passes the base rules and is not depleted.

Plan. The per-text counts are one pass without a shuffle. Line hashes leave the scan once per document and line, are
combined before the shuffle, first by (host, line, text), then by (host, line): a line that a third of all documents
share is one row per task. Boilerplate lines are joined to the lines again (adaptive execution broadcasts them only below
its size threshold, and splits a hot line) and only documents that have some are gathered.

Defined cases: null text has no words: all counts 0, base_failed true; a null source is a host of its own; a null doc_id
comes first; rows of the same doc_id, text and source are one document with the same result on each row, rows that differ
in one of these are documents of their own; very long texts are one row's work, linear but for sorting; other columns,
whatever their names, are passed through by keep_good and without_boilerplate; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, SEPARATORS, cut, releasing, table, text_key

MAX_DOCS, MIN_DOCS, MAX_PERCENT, LEFT_PERCENT = 25, 5, 50, 50
KEY, GONE, REMOVED = f"{OWN}key", f"{OWN}gone", f"{OWN}removed"
STATS = f"doc_id long, {KEY} struct<id:long,text:struct<a:long,b:long>,host:string>, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
NAMES = ("doc_id", KEY, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = regex.compile(r"[#*$%&|<>]")


def _runs(text: str) -> list[str]:
    """Words between ASCII white space (bytes.split knows exactly the six separators)."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    words = text.split() if text.isascii() and not _odd(text) else _runs(text)
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line and (line.strip("\t\n\v\f\r ")):
            seen.add(line)
    repeats = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            count = Counter(windows)
            upto = 0  # words before this position are counted
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeats += i + 3 - max(i, upto)
                    upto = i + 3
    return n, sum(map(len, words)), len(_SYMBOLS.findall(text)), dup, repeats


def _odd(text: str) -> bool:
    """str.split also splits at the separators 28 to 31, which are no white space here."""
    return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text


def _stats(batches):
    for batch in batches:
        counts = [text_counts(t.as_py()) for t in batch.column(2)]
        columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] or [pa.array([], pa.int64())] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=list(NAMES))


def normal(line: Column) -> Column:
    """A line in lower case, white space runs as one space, digit runs as 0."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), SEPARATORS, " "), "[0-9]+", "0"))


def line_hashes(text: Column) -> Column:
    """(hash, words) of every line with a word."""
    return F.transform(
        F.filter(F.transform(F.split(text, "\n"), normal), lambda x: x != ""),
        lambda x: F.struct(F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("w")),
    )


def key() -> Column:
    """What makes a document: id, text and host; a null source is a host of its own."""
    host = F.coalesce(F.concat(F.lit("h"), F.col("source").cast("string")), F.lit(""))
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), text_key().alias("text"), host.alias("host"))


def boilerplate(keyed: DataFrame, max_docs: int, min_docs: int, max_percent: int) -> DataFrame:
    """(key, h, w): the lines of boilerplate with their words, one row per line of a row that loses it."""
    each = keyed.select(KEY, F.explode_outer(line_hashes(F.col("text"))).alias("l")).where("l is not null")
    rows = each.select(KEY, F.col(f"{KEY}.host").alias("host"), F.col("l.h").alias("h"), F.col("l.w").alias("w"))
    n_docs = keyed.select(f"{KEY}.host", f"{KEY}.text").distinct().groupBy("host").agg(F.count("*").alias("n_docs"))
    place = F.struct(f"{KEY}.id", f"{KEY}.text")
    texts = rows.groupBy("host", "h", F.col(f"{KEY}.text").alias("text")).agg(F.min(place).alias("first"))
    lines = texts.groupBy("host", "h").agg(F.count("*").alias("n"), F.min("first").alias("first")).where(F.col("n") >= min(min_docs, max_docs))
    often = (F.col("n") >= max_docs) | ((F.col("n") >= min_docs) & (100 * F.col("n") > max_percent * F.col("n_docs")))
    frequent = lines.join(n_docs, "host").where(often).select("host", "h", "first")
    return rows.join(frequent, ["host", "h"]).where(place > F.col("first")).select(KEY, "h", "w")


def losses(keyed: DataFrame, max_docs: int, min_docs: int, max_percent: int) -> DataFrame:
    """(key, removed, gone): words and hashes of the boilerplate lines, for documents that have some."""
    lost = boilerplate(keyed, max_docs, min_docs, max_percent).groupBy(KEY).agg(F.sum("w").alias(REMOVED), F.collect_set("h").alias(GONE))
    copies = keyed.groupBy(KEY).agg(F.count("*").alias("copies")).where("copies > 1")
    # Each of a document's repeated rows has added its words.
    return lost.join(copies, KEY, "left").select(KEY, (F.col(REMOVED) / F.coalesce("copies", F.lit(1))).cast("long").alias(REMOVED), GONE)


def _left(docs: DataFrame) -> DataFrame:
    """docs (with GONE) with the lines of GONE taken out of `text`; n_chars, if there, follows."""
    left = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(GONE, F.xxhash64(normal(x))))
    out = docs.withColumn("text", F.when(F.col(GONE).isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(GONE).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def without_boilerplate(docs: DataFrame, *, max_docs: int = MAX_DOCS, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """docs with `text` freed of boilerplate lines; documents without any are unchanged, null stays null."""
    keyed = docs.withColumn(KEY, key())
    lost = losses(keyed.select(KEY, "text"), max_docs, min_docs, max_percent)
    return _left(keyed.join(lost.hint("shuffle_hash"), KEY, "left")).select(*docs.columns)


def _judged(keyed: DataFrame, lost: DataFrame, left_percent: int) -> DataFrame:
    stats = keyed.select(F.col("doc_id").cast("long"), KEY, "text").mapInArrow(releasing(_stats), STATS)
    joined = stats.join(lost.select(KEY, REMOVED), KEY, "left").withColumn("removed_words", F.coalesce(REMOVED, F.lit(0)))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("removed_words")) < left_percent * F.col("n_words")
    return joined.select(KEY, *(c for c in NAMES if c != KEY), "removed_words", base.alias("base_failed"), (~base & ~depleted).alias("kept"))


def quality(docs: DataFrame, *, max_docs: int = MAX_DOCS, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """One row per row of docs (doc_id, text, source): the counts, removed_words, base_failed and kept."""
    keyed = docs.select("doc_id", "text", "source").withColumn(KEY, key())
    return _judged(keyed, losses(keyed.select(KEY, "text"), max_docs, min_docs, max_percent), left_percent).drop(KEY)


def keep_good(docs: DataFrame, *, max_docs: int = MAX_DOCS, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """The documents that the quality rules keep, their text freed of boilerplate lines; the losses are written once."""
    keyed = docs.withColumn(KEY, key())
    narrow = keyed.select("doc_id", "text", KEY)
    lost = cut(losses(narrow.select(KEY, "text"), max_docs, min_docs, max_percent))
    good = _judged(narrow, lost, left_percent).where("kept").select(KEY).distinct()
    return _left(keyed.join(good, KEY, "left_semi").join(lost.select(KEY, GONE), KEY, "left")).select(*docs.columns)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


#: The same rows in DuckDB's SQL.
ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('h' || source, '') AS host,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), lines AS (
  SELECT doc_id, text, host, unnest(string_split(text, chr(10))) AS line FROM d
), dup AS (
  SELECT doc_id, sum(n - 1) AS n_dup FROM (
    SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id
), w AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d
), tri AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS again FROM tri WHERE w3 IS NOT NULL
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_rep FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE again) GROUP BY doc_id
), norm AS (
  SELECT doc_id, text, host, trim(regexp_replace(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS l FROM lines
), worded AS (SELECT *, length(l) - length(replace(l, ' ', '')) + 1 AS lw FROM norm WHERE l <> ''),
hosts AS (SELECT host, count(DISTINCT text) AS n_docs FROM d GROUP BY host),
frequent AS (
  SELECT host, l, min(doc_id) AS first FROM worded JOIN hosts USING (host)
  GROUP BY host, l, n_docs HAVING count(DISTINCT text) >= {MAX_DOCS} OR count(DISTINCT text) >= {MIN_DOCS} AND 100 * count(DISTINCT text) > {MAX_PERCENT} * n_docs
), gone AS (
  SELECT w.doc_id, sum(lw) AS removed FROM worded w JOIN frequent f ON f.host = w.host AND f.l = w.l AND w.doc_id > f.first GROUP BY w.doc_id
), counted AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)
), based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND NOT (100 * (n_words - removed_words) < {LEFT_PERCENT} * n_words) AS kept FROM based
"""
