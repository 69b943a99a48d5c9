"""Line deduplication over overlapping windows of three lines.

A document's lines are its newline-separated pieces that hold a word, compared by their words (runs of white space count
as one space). Every run of three consecutive lines is a window; the lines of a text that has only one or two are one
shorter window, compared with such texts of as many lines. Windows are compared over all documents; the first
occurrence of a window, by (doc_id, text, line), stays, and every line that any later occurrence covers is removed, so
overlapping repeats merge. A first occurrence can lose lines all the same, where a later occurrence of another window covers
them: of the lines A B A B A B only A B are left. Lines without a word are never compared; one stays if the line before it
stays. Repeated passages of one or two lines between other lines are in no repeated window and stay.

Plan: windows leave the scan as (hash, document, line) only. Counting a hash combines before the shuffle, so a window
that a third of all documents share costs one row per task. Only repeated hashes, with their first place, are joined
back to the windows; that join is a plain equi-join, which adaptive execution splits when a hash is hot. Removed line
numbers are gathered per document, and texts meet them in one join on the document's key. Hashes have 128 bits, so that
among 10^12 windows two different ones meet with a chance of 10^-15; documents are told apart by id and a hash as long.

Defined cases: null text stays null; empty text has no window and stays as it is; a very long text is linear work of one
task; rows that repeat the same doc_id and text are one document and get the same result; the order puts null doc_ids
first; columns of the input, whatever their names, are returned as they are, with `text` replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ID, OWN, SEPARATORS, TEXT_HASH, cut, table, text_key

WINDOW = 3
DROP, PARTS, LINE = f"{OWN}drop", f"{OWN}parts", f"{OWN}line"


def lines(parts: Column) -> Column:
    """(i, g, h) of the lines that hold a word: their number, and two hashes of their words."""
    every = F.transform(parts, lambda line, i: F.struct(i.alias("i"), F.trim(F.regexp_replace(line, SEPARATORS, " ")).alias("w")))
    hashes = lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["w"]).alias("g"), F.xxhash64(F.lit(1), x["w"]).alias("h"))
    return F.transform(F.filter(every, lambda x: x["w"] != ""), hashes)


def repeated_lines(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, text key, drop): for each document with removed lines the numbers of these."""
    parts = keyed.select(ID, TEXT_HASH, F.split("text", "\n").alias("parts"))
    split = parts.select(ID, TEXT_HASH, F.size("parts").alias("n"), lines(F.col("parts")).alias("l"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("l") - window, F.lit(0)))

    def hashed(s: Column, field: str) -> Column:
        run = lambda n: F.xxhash64(*(F.get("l", s + k)[field] for k in range(n)))
        return F.coalesce(*(F.when(F.size("l") == n, run(n)) for n in range(1, window)), run(window))

    at = F.transform(
        starts,
        lambda s: F.struct(
            hashed(s, "g").alias("g"),
            hashed(s, "h").alias("h"),
            F.least(F.size("l"), F.lit(window)).alias("k"),
            F.get("l", s)["i"].alias("from"),
            F.coalesce(F.get("l", s + window)["i"], F.col("n")).alias("to"),
        ),
    )
    windows = split.where(F.size("l") > 0).select(ID, TEXT_HASH, F.explode_outer(at).alias("w")).select(
        "w.g", "w.h", "w.k", "w.to", F.struct(F.col(ID), F.col(TEXT_HASH), F.col("w.from")).alias("place")
    )
    firsts = windows.groupBy("g", "h", "k").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    # A table of its own: the join shuffles both sides, so that a hot window can be split at run time.
    later = windows.join(cut(firsts.select("g", "h", "k", "first")), ["g", "h", "k"]).where("place <> first")
    covers = F.explode(F.sequence("place.from", F.col("to") - 1)).alias(LINE)
    covered = later.select(F.col(f"place.{ID}").alias(ID), F.col(f"place.{TEXT_HASH}").alias(TEXT_HASH), covers)
    return covered.groupBy(ID, TEXT_HASH).agg(F.collect_set(LINE).alias(DROP))


def with_removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the document keys, the lines, and the numbers of the lines to remove (null where there are none)."""
    keyed = docs.withColumns({ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), TEXT_HASH: text_key()})
    removed = repeated_lines(keyed.select(ID, TEXT_HASH, "text"), window)
    return keyed.join(removed.hint("shuffle_hash"), [ID, TEXT_HASH], "left").withColumn(PARTS, F.split("text", "\n"))


def kept_text() -> Column:
    """Text without the removed lines; linear in the text, however many lines go."""
    left = F.array_except(F.sequence(F.lit(0), F.size(PARTS) - 1), F.col(DROP))
    return F.when(F.col(DROP).isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(PARTS, i)), "\n"))


def drop_repeated_lines(docs: DataFrame, window: int = WINDOW, drop_emptied: bool = False) -> DataFrame:
    """docs with `text` freed of the lines that later occurrences of repeated windows cover; n_chars, if there, follows.

    With drop_emptied, documents of which no line with a word is left go; others are never dropped.
    """
    out = with_removed(docs, window).withColumn("text", kept_text())
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(DROP).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    if drop_emptied:
        out = out.where(F.col(DROP).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*docs.columns)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the lines before and removed, and the text that is left."""
    out = with_removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(PARTS)).cast("long").alias("n_lines"),
        F.when(F.col(DROP).isNull(), 0).otherwise(F.size(DROP)).cast("long").alias("n_removed"),
        kept_text().alias("text"),
    )


#: The same rows in DuckDB's SQL. Spark's \\n split and DuckDB's string_split agree; ties are broken by doc_id and line.
ORACLE_SQL = r"""
WITH parts AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL
), named AS (
  SELECT doc_id, i, line, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS w FROM parts
), numbered AS (
  SELECT doc_id, i, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM named WHERE w <> ''
), windows AS (
  SELECT a.doc_id, a.k, a.w || chr(10) || b.w || chr(10) || c.w AS h, a.i AS i0, b.i AS i1, c.i AS i2
  FROM numbered a JOIN numbered b ON b.doc_id = a.doc_id AND b.k = a.k + 1 JOIN numbered c ON c.doc_id = a.doc_id AND c.k = a.k + 2
  UNION ALL SELECT doc_id, 1, string_agg(w, chr(10) ORDER BY k), min(i), max(i), NULL FROM numbered GROUP BY doc_id HAVING count(*) < 3
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, k) AS nth FROM windows
), covered AS (
  SELECT doc_id, unnest([i0, i1, i2]) AS i FROM ranked WHERE nth > 1
), gone AS (SELECT DISTINCT doc_id, i FROM covered), flagged AS (
  SELECT n.doc_id, n.i, n.line, n.w,
         max(CASE WHEN n.w <> '' THEN n.i END) OVER (PARTITION BY n.doc_id ORDER BY n.i) AS owner
  FROM named n
), kept AS (
  SELECT f.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, string_agg(f.line, chr(10) ORDER BY f.i) FILTER (WHERE g.i IS NULL) AS text
  FROM flagged f LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.i = f.owner GROUP BY f.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
