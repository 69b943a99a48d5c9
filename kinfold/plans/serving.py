"""The interactive surface as functions: match two records, page through results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.blocking import S1
from ..operators.features import with_features, with_probability
from ..operators.model import Matcher
from ..operators.prepare import prepare
from ..sources import feeds


def match_records(spark: SparkSession, a: dict, b: dict, matcher: Matcher | None = None) -> dict:
    """Features, probability and verdict of two records (business_name, business_address, country)."""
    schema = "ord long, feed string, entity_id string, business_name string, business_address string, country string"
    row = lambda feed, r: (0, feed, f"{feed}-0", r.get("business_name", ""), r.get("business_address", ""), r.get("country", ""))
    q, t = (prepare(spark.createDataFrame([row(feed, r)], schema)) for feed, r in (("S1", a), ("S2", b)))
    pairs = spark.createDataFrame([("S1-0", "S2-0")], "source1_entity_id string, candidate_entity_id string")
    features = with_features(pairs, q, t)
    found = with_probability(features, matcher).first().asDict()
    return {k: v for k, v in found.items() if k != "predicted"} | {"is_match": found["predicted"]}


def page(lists: DataFrame, offset: int, limit: int) -> DataFrame:
    """A page of results in the order of ids."""
    return lists.orderBy(S1).offset(offset).limit(limit)


def results(spark: SparkSession, matching: str, candidates: str, offset: int = 0, limit: int = 50) -> DataFrame:
    """A page of the result files in the order of the matching file: matched and candidate ids as lists, whether there is no
    match, the number of candidates. A missing candidate file gives empty lists; a missing matching file is an error."""
    if not feeds.exists(spark, matching):
        raise FileNotFoundError(matching)
    header = feeds.field(0) != S1
    rows = feeds.numbered_lines(spark, [matching], header).where(F.col("number").between(offset, offset + limit - 1))
    rows = rows.select("number", feeds.field(0).alias(S1), T.parse_ids(feeds.field(1)).alias("matched_ids"))
    none = F.array().cast("array<string>")
    if feeds.exists(spark, candidates):
        lists = feeds.read_id_lists(spark, candidates, "c").select(S1, T.parse_ids(F.col("c")).alias("candidate_ids"))
        rows = rows.join(lists, S1, "left").withColumn("candidate_ids", F.coalesce("candidate_ids", none))
    else:
        rows = rows.withColumn("candidate_ids", none)
    rows = rows.withColumns({"is_singleton": F.size("matched_ids") == 0, "candidate_count": F.size("candidate_ids").cast("long")})
    return rows.orderBy("number").drop("number")
