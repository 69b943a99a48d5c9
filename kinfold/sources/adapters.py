"""Views of the standard tables in the shape of the linkage feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ord, feed, entity_id, business_name, business_address, country, lead from the documents."""
    words = F.split("text", " ")
    feed = F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"))
    address = F.concat(F.array_join(F.slice(words, 5, 10), " "), F.lit(" "), (10000 + F.col("n_chars") % 50).cast("string"))
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), feed.alias("feed"), F.concat(feed, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.array_join(F.slice(words, 1, 4), " ").alias("business_name"), address.alias("business_address"), F.col("lang").alias("country"),
        F.substring("text", 1, 60).alias("lead"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, candidate_entity_id): reference and target records of a thousand ids whose texts start alike.

    The run of ids bounds the pairs of a record, however many records start alike.
    """
    r = records(spark, sf_dir).select("feed", "entity_id", "lead", F.floor(F.col("ord") / 1000).alias("run"))
    s1 = r.where("feed = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), "lead", "run")
    other = r.where("feed <> 'S1'").select(F.col("entity_id").alias("candidate_entity_id"), "lead", "run")
    return s1.join(other, ["lead", "run"]).select("source1_entity_id", "candidate_entity_id")


def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth as a file has it: one row per reference record, matched ids comma-joined (empty: none)."""
    s1 = records(spark, sf_dir).where("feed = 'S1'").select("ord", F.col("entity_id").alias("source1_entity_id"))
    lists = truth(spark, sf_dir).groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_list("candidate_entity_id")), ",").alias("ids"))
    return s1.join(lists, "source1_entity_id", "left").select("ord", "source1_entity_id", F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with few distinct keys."""
    key = F.col("p_partkey")
    feed = F.concat(F.lit("S"), (1 + key % 3).cast("string"))
    return read_table(spark, sf_dir, "part").select(
        key.alias("ord"), feed.alias("feed"), F.concat(feed, F.lit("-"), key.cast("string")).alias("entity_id"),
        F.col("p_name").alias("business_name"), F.col("p_type").alias("business_address"), F.col("p_brand").alias("country"),
    )


def pair_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1, id, truth, predicted): returned parts of an order as truth, open ones as prediction."""
    rows = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("s1"), F.col("l_partkey").alias("id"))
    return rows.agg(F.max(F.col("l_returnflag") == "R").alias("truth"), F.max(F.col("l_linestatus") == "O").alias("predicted"))


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, s1, probability, label) from the events."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pair_id"), F.col("user_id").alias("s1"), F.least(F.col("value") / 400, F.lit(1.0)).alias("probability"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


def feed(records: DataFrame, *names: str) -> DataFrame:
    return records.where(F.col("feed").isin(*names))
