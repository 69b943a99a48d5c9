"""Checks and repair of the result files, as tables of findings."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import feeds
from .blocking import S1, first_rows

EXAMPLES = 5


def broken(rows: DataFrame, rule: str, severity: str, subject: Column, label: str = "") -> DataFrame:
    """(file, rule, severity, x): what breaks a rule."""
    return rows.select(F.lit(label).alias("file"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), subject.cast("string").alias("x"))


def findings(*parts: DataFrame) -> DataFrame:
    """(file, rule, severity, n, examples) of the distinct subjects of each rule, the first five as examples.

    All rules share one shuffle of their subjects; the examples are the head of a rank, of which every task keeps five rows
    of a rule, so a rule that everything breaks stays bounded.
    """
    key = ["file", "rule", "severity"]
    every = functools.reduce(DataFrame.unionByName, parts).distinct()
    n = every.groupBy(*key).agg(F.count("*").alias("n"))
    head = first_rows(every, key, EXAMPLES, "x").groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias("examples"))
    return n.join(head, key)  # a row for each rule


def broken_lines(lines: DataFrame, header: tuple[str, str], label: str = "") -> list[DataFrame]:
    first = lines.where("number = 1")
    cells = F.transform(F.split(F.lower("value"), "\t"), lambda c: F.trim(c))
    no_tab = ~F.contains(F.col("value"), F.lit("\t"))
    commas = no_tab & F.contains(F.col("value"), F.lit(","))
    empty = lines.agg(F.count("*").alias("c")).where("c = 0")
    return [
        broken(empty, "empty_file", "error", F.lit(""), label),
        broken(first.where(commas), "comma_separated", "error", F.col("value"), label),
        broken(first.where(~commas & (cells != F.array(*map(F.lit, header)))), "header", "error", F.col("value"), label),
        broken(lines.where(F.col("number") > 1).where(no_tab & (F.trim("value") != "")), "no_tab", "error", F.col("value"), label),
    ]


def check_lines(lines: DataFrame, header: tuple[str, str]) -> DataFrame:
    """Findings on raw lines (value, number from 1): empty file, separator, header, rows without a tab."""
    return findings(*broken_lines(lines, header)).drop("file")


def broken_file(spark: SparkSession, path: str, header: tuple[str, str], label: str) -> list[DataFrame]:
    """What is wrong with a result file, or a folder of part files of which each has the header: missing, empty, its lines."""
    if not feeds.exists(spark, path):
        return [broken(spark.range(1), "missing_file", "error", F.lit(path), label)]
    lines = feeds.numbered_lines(spark, [path]).select((F.col("number") + 1).alias("number"), F.array_join("f", "\t").alias("value"))
    # Further part files repeat the header.
    return broken_lines(lines.where((F.col("number") == 1) | (F.lower("value") != "\t".join(header))), header, label)


def check_files(spark: SparkSession, matching: str, candidates: str, required: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """All findings on a pair of result files; contents are checked only where both files are there."""
    names = {"matching": (matching, "matched_entity_ids"), "candidates": (candidates, "candidate_entity_ids")}
    found = [part for label, (path, name) in names.items() for part in broken_file(spark, path, (S1, name), label)]
    if feeds.exists(spark, matching) and feeds.exists(spark, candidates):
        lists = {label: feeds.read_id_lists(spark, path, name) for label, (path, name) in names.items()}
        for label, (_, name) in names.items():
            found += broken_lists(lists[label], name, required, label)
            if targets is not None:
                found.append(unknown_targets(lists[label], name, targets, label))
        found.append(loose_matches(lists["matching"], lists["candidates"]))
    return findings(*found)


def broken_lists(lists: DataFrame, name: str, required: DataFrame, label: str, trim: bool = True) -> list[DataFrame]:
    """Of (source1_entity_id, id list): repeats, self matches, prefixes, missing and unexpected ids."""
    ids = T.parse_ids(F.col(name)) if trim else F.filter(F.split(F.coalesce(F.col(name), F.lit("")), ","), lambda x: x != "")
    rows = lists.select(S1, ids.alias("ids"))
    need = required.select(F.col("entity_id").alias(S1)).distinct()
    seen = rows.groupBy(S1).agg(F.count("*").alias("c"))
    each = rows.select(S1, F.explode("ids").alias("id"))
    feed = T.feed_of(F.col("id"))
    return [
        broken(seen.where("c > 1"), "duplicate_row", "error", F.col(S1), label),
        broken(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))), "duplicate_id", "error", F.col(S1), label),
        broken(each.where(feed == "S1"), "self_match", "error", F.col("id"), label),
        broken(each.where(feed == "other"), "wrong_prefix", "error", F.col("id"), label),
        broken(need.join(seen, S1, "left_anti"), "missing_s1", "error", F.col(S1), label),
        broken(seen.join(need, S1, "left_anti"), "unexpected_s1", "error", F.col(S1), label),
    ]


def pairs_of(lists: DataFrame, name: str) -> DataFrame:
    return lists.select(S1, F.explode(F.array_distinct(T.parse_ids(F.col(name)))).alias("id"))


def loose_matches(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Reference records with matches that are no candidates."""
    loose = pairs_of(matches, "matched_entity_ids").join(pairs_of(candidates, "candidate_entity_ids"), [S1, "id"], "left_anti")
    return broken(loose, "not_in_candidates", "warning", F.col(S1), "both")


def unknown_targets(lists: DataFrame, name: str, targets: DataFrame, label: str) -> DataFrame:
    """Ids that no target feed holds."""
    unknown = pairs_of(lists, name).join(targets.select(F.col("entity_id").alias("id")), "id", "left_anti")
    return broken(unknown, "unknown_target", "error", F.col("id"), label)


def missing_ids(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """Reference ids without a candidate."""
    return s1.select(F.col("entity_id").alias(S1)).distinct().join(pairs.select(S1), S1, "left_anti")


def assert_coverage(s1: DataFrame, pairs: DataFrame, path: str | None = None) -> None:
    """Raises if a reference record has no candidate; then their ids, sorted, are written to `path`."""
    n = missing_ids(s1, pairs).count()
    if n:
        if path:
            feeds.write_tsv(missing_ids(s1, pairs).orderBy(S1), path)
        head = [r[0] for r in missing_ids(s1, pairs).orderBy(S1).limit(EXAMPLES).collect()]
        raise AssertionError(f"{n} reference records have no candidate, e.g. {head}")


def repair(s1: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, matched_entity_ids, candidate_entity_ids) of every reference record, in the files' order: ids of other feeds
    than S2 and S3 go, repeats go, matches that are no candidates are appended to these. The last of repeated rows counts
    by its list."""
    good = lambda c: F.array_distinct(F.filter(T.parse_ids(F.col(c)), lambda x: T.feed_of(x).isin("S2", "S3")))
    one = lambda df, c: df.groupBy(S1).agg(F.max(c).alias(c)).select(S1, good(c).alias(c))
    ids = s1.select(F.col("entity_id").alias(S1)).distinct()
    met = ids.join(one(matches, "matched_entity_ids"), S1, "left").join(one(candidates, "candidate_entity_ids"), S1, "left")
    none = F.array().cast("array<string>")
    m, c = F.coalesce("matched_entity_ids", none), F.coalesce("candidate_entity_ids", none)
    return met.select(S1, F.array_join(m, ",").alias("matched_entity_ids"), F.array_join(F.concat(c, F.array_except(m, c)), ",").alias("candidate_entity_ids"))


def merge_feeds(chunks: DataFrame, s1: DataFrame) -> DataFrame:
    """(id, matches, candidates) per reference record from rows (id, feed, candidate id, matched) of all feeds, by id."""
    from .blocking import TARGET

    entry = F.struct("feed", F.col(TARGET).alias("id"))
    ids = lambda c: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["id"])), ",")
    met = chunks.groupBy(S1).agg(ids(F.when(F.col("matched"), entry)).alias("matched_entity_ids"), ids(entry).alias("candidate_entity_ids"))
    every = s1.select(F.col("entity_id").alias(S1)).distinct().join(met, S1, "left")
    return every.na.fill("")
