"""Prepared records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def prepare(records: DataFrame) -> DataFrame:
    """Normalised name, address and country with their words; keeps ord, feed and entity_id. A missing country is empty."""
    country = F.col("country") if "country" in records.columns else F.lit("")
    normal = records.select(
        "ord", "feed", "entity_id", T.norm_name(F.col("business_name")).alias("name_n"),
        T.norm_address(F.col("business_address")).alias("addr_n"), T.norm_country(country).alias("country_n"),
    )
    return normal.withColumns({"name_tokens": T.tokens(F.col("name_n")), "addr_tokens": T.tokens(F.col("addr_n"))})
