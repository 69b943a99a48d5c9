"""Readers and writers of the tab-separated files: feeds, ground truth, id lists, provenance."""

from __future__ import annotations

import functools
import tempfile
import uuid
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T

FEED_COLUMNS = ("entity_id", "business_name", "business_address", "country")
PROVENANCE = "array<struct<target_id:string,block_type:string,blocking_key:string,score:double>>"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; it is deleted when the application ends."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="kinfold-")
    folder = f"{shared}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/data"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: for results that several later steps read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; values are written as they are, without quotes."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").option("nullValue", "").csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def numbered_lines(spark: SparkSession, paths: Sequence[str], keep: Column | None = None) -> DataFrame:
    """(number, f) of the lines of files, or of folders of part files, one after the other; number counts from 0 the lines
    that are kept, f holds the tab-separated fields. Bytes that are no UTF-8 become replacement characters.

    Files are read in splits; a line's number is its place in the split plus the lines of all splits before, by path and
    offset. Only the table of splits is sorted in one task. The lines are written once, so that their places stay.
    """
    parts = []
    for k, path in enumerate(paths):
        lines = spark.read.text(path).select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        fields = lines.select(F.lit(k).alias("k"), "file", "block", F.split("value", "\t", -1).alias("f"))
        parts.append((fields if keep is None else fields.where(keep)).withColumn("at", F.monotonically_increasing_id()))
    rows = settled(functools.reduce(DataFrame.unionByName, parts), "lines")
    split = ["k", "file", "block"]
    sizes = rows.groupBy(*split).agg(F.min("at").alias("first"), F.count("*").alias("n"))  # one row per split
    placed = sizes.select(*split, (F.sum("n").over(W.orderBy(*split)) - F.col("n") - F.col("first")).alias("shift"))
    return rows.join(F.broadcast(placed), split).select((F.col("at") + F.col("shift")).alias("number"), "k", "f")


def field(i: int) -> Column:
    return F.coalesce(F.get("f", F.lit(i)), F.lit(""))


def read_feeds(spark: SparkSession, paths: Sequence[str], *, least_fields: int = 3, limit: int | None = None, limit_each: int | None = None, required: bool = False) -> DataFrame:
    """(ord, feed, entity_id, business_name, business_address, country) of feed files in the order of their lines.

    Rows of fewer fields are dropped (least_fields 1: padded instead); there is no quoting, missing fields are empty; feed
    is what the id's prefix says. `limit` takes the first rows over all files, `limit_each` the first of each. A missing file
    is an error if `required`, else it is left out with a warning.
    """
    there = [p for p in paths if exists(spark, p)]
    if missing := sorted(set(paths) - set(there)):
        if required:
            raise FileNotFoundError(", ".join(missing))
        warnings.warn(f"no such feed: {', '.join(missing)}", stacklevel=2)
    if not there:
        return spark.createDataFrame([], "ord long, feed string, " + ", ".join(f"{c} string" for c in FEED_COLUMNS))
    lines = numbered_lines(spark, there, (F.size("f") >= least_fields) & (F.trim(field(0)) != FEED_COLUMNS[0]) & (F.trim(field(0)) != ""))
    if limit_each is not None:
        begin = lines.groupBy("k").agg(F.min("number").alias("begin"))  # one row per file
        lines = lines.join(F.broadcast(begin), "k").where(F.col("number") - F.col("begin") < limit_each)
    if limit is not None and limit_each is None:
        lines = lines.where(F.col("number") < limit)
    rows = lines.select(F.col("number").alias("ord"), F.trim(field(0)).alias("entity_id"), *(field(i).alias(c) for i, c in enumerate(FEED_COLUMNS) if i))
    if limit is not None and limit_each is not None:
        rows = rows.orderBy("ord").limit(limit)
    return rows.select("ord", T.feed_of(F.col("entity_id")).alias("feed"), *FEED_COLUMNS)


def read_feed(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_feeds(spark, [path], **options)


def read_id_lists(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(source1_entity_id, name): first field and the rest of each line."""
    lines = spark.read.text(path).select(F.split("value", "\t", -1).alias("f")).where((F.get("f", F.lit(0)) != "source1_entity_id") & (F.get("f", F.lit(0)) != ""))
    return lines.select(F.trim(F.get("f", F.lit(0))).alias("source1_entity_id"), F.coalesce(F.get("f", F.lit(1)), F.lit("")).alias(name))


def explode_lists(lists: DataFrame, name: str, to: str = "candidate_entity_id") -> DataFrame:
    """(source1_entity_id, to): one row per distinct id of a list."""
    return lists.select("source1_entity_id", F.explode(F.array_distinct(T.parse_ids(F.col(name)))).alias(to))


def id_lists(s1: DataFrame, pairs: DataFrame, name: str, order: Column | None = None) -> DataFrame:
    """One row per reference id, its candidates comma-joined in the given order (by id), each once; empty if it has none."""
    key = F.struct((order if order is not None else F.col("candidate_entity_id")).alias("o"), F.col("candidate_entity_id").alias("id"))
    lists = pairs.groupBy("source1_entity_id").agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["id"]).alias("ids"))
    joined = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct().join(lists, "source1_entity_id", "left")
    return joined.select("source1_entity_id", F.coalesce(T.format_ids(F.col("ids")), F.lit("")).alias(name))


def lists_in_order(s1: DataFrame, pairs: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """(ord, source1_entity_id, name): as id_lists, lists in the given order of pairs, rows in the order of the reference."""
    key = F.struct(*(F.col(c) if isinstance(c, str) else c for c in order), F.col("candidate_entity_id").alias("__id"))
    lists = pairs.groupBy("source1_entity_id").agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["__id"]).alias("ids"))
    rows = s1.groupBy(F.col("entity_id").alias("source1_entity_id")).agg(F.min("ord").alias("ord"))
    return rows.join(lists, "source1_entity_id", "left").select("ord", "source1_entity_id", F.coalesce(T.format_ids(F.col("ids")), F.lit("")).alias(name))


def write_lists(lists: DataFrame, path: str) -> None:
    """Lists in the order of `ord`: a folder of part files that follow one another."""
    write_tsv(lists.orderBy("ord").drop("ord"), path)


def provenance_rows(candidates: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_ids, provenance): ids and a JSON list of what proposed them."""
    entry = F.struct(F.col("candidate_entity_id").alias("target_id"), "block_type", "blocking_key", F.round("score", 4).alias("score"))
    grouped = candidates.groupBy("source1_entity_id").agg(F.array_sort(F.collect_list(entry)).alias("p"))
    return grouped.select("source1_entity_id", F.array_join(F.transform("p", lambda x: x["target_id"]), ",").alias("candidate_entity_ids"), F.to_json("p").alias("provenance"))


def explode_provenance(rows: DataFrame) -> DataFrame:
    """One row per candidate of the JSON lists; lists that do not parse give none."""
    parsed = rows.select("source1_entity_id", F.explode(F.from_json("provenance", PROVENANCE)).alias("p"))
    return parsed.select("source1_entity_id", F.col("p.target_id").alias("candidate_entity_id"), "p.block_type", "p.blocking_key", "p.score")


def sample_truth(lists: DataFrame, n: int, matched_share: float = 0.75) -> DataFrame:
    """The first rows with matches and the first without, by ord, in the given shares."""
    has = F.col("matched_entity_ids") != ""
    head = lambda rows, k: rows.orderBy("ord").limit(k)
    matched = int(n * matched_share)
    return head(lists.where(has), matched).unionByName(head(lists.where(~has), n - matched))


def selective(rows: DataFrame, wanted: DataFrame, background: int) -> DataFrame:
    """The rows whose entity_id is wanted, and the first others by ord."""
    ids = wanted.select("entity_id").distinct()
    return rows.join(ids, "entity_id", "left_semi").unionByName(rows.join(ids, "entity_id", "left_anti").orderBy("ord").limit(background))
