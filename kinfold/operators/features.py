"""The thirteen features of candidate pairs, labels and training pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import constants as C
from ..functions import similarity as S
from ..functions import text as T
from .blocking import S1, TARGET, first_rows

#: Reference records of a range whose pairs are counted together.
RANGE = 10_000
_FIELDS = ("name_n", "addr_n", "country_n", "name_tokens", "addr_tokens")


def sides(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with the prepared records a and b; pairs of which a side is missing are dropped."""
    a = queries.select(F.col("entity_id").alias(S1), F.struct(*_FIELDS).alias("a"))
    b = targets.select(F.col("entity_id").alias(TARGET), F.struct(*_FIELDS).alias("b"))
    return pairs.join(a, S1).join(b, TARGET)


def with_token_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The ten features that are built-in expressions; pairs keep their columns."""
    return sides(pairs, queries, targets).withColumns(S.token_features()).drop("a", "b")


def with_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """All thirteen features."""
    met = sides(pairs, queries, targets)
    edits = {
        "name_ratio": S.indel_ratio("a.name_n", "b.name_n"),
        "name_wratio": S.wratio("a.name_n", "b.name_n"),
        "addr_ratio": S.indel_ratio("a.addr_n", "b.addr_n"),
    }
    full = met.withColumns(S.token_features()).withColumns(edits)
    return full.select(*pairs.columns, *C.FEATURES)


def batch_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The batch matcher's variants: equal strings, empty ones too, are 1 in containment; address words of four letters and
    more outside the stop list; one postal code each; the ratios of equal strings, empty ones too, are 1."""
    met = sides(pairs, queries, targets)
    words = lambda c: T.address_words(F.col(f"{c}.addr_tokens"), 4)
    same = lambda f: F.col(f"a.{f}") == F.col(f"b.{f}")
    code = lambda c: T.first_postal(F.col(f"{c}.addr_n"))
    ratio = lambda f, c: F.when(same(c), 1.0).otherwise(f(f"a.{c}", f"b.{c}"))
    own = {
        "name_ratio": ratio(S.indel_ratio, "name_n"),
        "name_wratio": ratio(S.wratio, "name_n"),
        "addr_ratio": ratio(S.indel_ratio, "addr_n"),
        "name_containment": F.when(same("name_n"), 1.0).otherwise(S.containment(F.col("a.name_n"), F.col("b.name_n"))),
        "addr_containment": F.when(same("addr_n"), 1.0).otherwise(S.containment(F.col("a.addr_n"), F.col("b.addr_n"))),
        "addr_jaccard": S.jaccard(words("a"), words("b")),
        "addr_token_overlap": S.overlap(words("a"), words("b")),
        "same_postal_like": ((code("a") != "") & (code("a") == code("b"))).cast("double"),
    }
    return met.withColumns(S.token_features() | own).select(*pairs.columns, *C.FEATURES)


def with_probability(features: DataFrame, matcher=None, threshold: float | None = None) -> DataFrame:
    """Adds probability and predicted: by the matcher and its threshold, or by the formula and 0.65 where there is none."""
    if matcher is not None:
        scored, limit = matcher.score(features), matcher.threshold
    else:
        p = S.fallback_probability(F.col("name_ratio"), F.col("addr_ratio"), F.col("country_exact"))
        scored, limit = features.withColumn("probability", p), 0.65
    return scored.withColumn("predicted", F.col("probability") >= (limit if threshold is None else threshold))


def with_labels(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """label: 1 if the pair is in truth."""
    known = truth.select(S1, TARGET).distinct().withColumn("_true", F.lit(1))
    return pairs.join(known, [S1, TARGET], "left").withColumn("label", F.coalesce("_true", F.lit(0))).drop("_true")


def restricted(truth: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Truth pairs of which both records are at hand."""
    a = queries.select(F.col("entity_id").alias(S1))
    return truth.join(a, S1, "left_semi").join(targets.select(F.col("entity_id").alias(TARGET)), TARGET, "left_semi")


def training_pairs(candidates: DataFrame, truth: DataFrame, targets: DataFrame, *, inject: bool = True, negatives: int = C.HARD_NEGATIVES) -> DataFrame:
    """(ids, label): blocked pairs, all true pairs if `inject`, and the first negatives of each reference record by ord."""
    labelled = with_labels(candidates.select(S1, TARGET, "ord"), truth)
    positive = labelled.where("label = 1").select(S1, TARGET, "label")
    if inject:
        all_true = truth.join(targets.select(F.col("entity_id").alias(TARGET)), TARGET, "left_semi").select(S1, TARGET, F.lit(1).alias("label"))
        positive = positive.unionByName(all_true).distinct()
    negative = first_rows(labelled.where("label = 0"), [S1], negatives, "ord").select(S1, TARGET, "label")
    return positive.unionByName(negative)


def country_negatives(queries: DataFrame, targets: DataFrame, truth: DataFrame, per_country: int = 200, share: float = 1.5) -> DataFrame:
    """Untrue pairs with the first targets of the reference record's country, by its ord and the target's, share times the true ones.

    The cut goes by counts: pairs per reference record, summed over ranges of records, tell which record the limit falls
    into, so that only that record's pairs are ranked; nothing is sorted as a whole.
    """
    pool = first_rows(targets.select("country_n", "ord", F.col("entity_id").alias(TARGET)), ["country_n"], per_country, "ord")
    q = queries.select(F.col("ord").alias("q_ord"), F.col("entity_id").alias(S1), "country_n")
    untrue = q.join(pool, "country_n").join(truth.select(S1, TARGET).distinct(), [S1, TARGET], "left_anti")
    n = int(share * truth.count())
    per_record = untrue.groupBy("q_ord").agg(F.count("*").alias("n"))
    ranges = per_record.groupBy(F.floor(F.col("q_ord") / RANGE).alias("range")).agg(F.sum("n").alias("n"))
    before_range = ranges.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("base")).where(F.col("base") < n)  # one row per range
    counted = per_record.withColumn("range", F.floor(F.col("q_ord") / RANGE)).join(before_range, "range")
    before = counted.select("q_ord", (F.col("base") + F.sum("n").over(W.partitionBy("range").orderBy("q_ord")) - F.col("n")).alias("before")).where(F.col("before") < n)
    rank = F.row_number().over(W.partitionBy("q_ord").orderBy("ord"))
    ranked = untrue.join(before, "q_ord").withColumn("rank", rank)
    return ranked.where(F.col("before") + F.col("rank") <= n).select(S1, TARGET, F.lit(0).alias("label"))


def drawn_negatives(truth: DataFrame, targets: DataFrame, draws: int = 2, seed: int = 42) -> DataFrame:
    """For each true pair `draws` targets by position, picked by arithmetic on the ids' numbers; true pairs are dropped."""
    from .blocking import id_number

    # Positions by range: a rank over all targets would need one task.
    span = targets.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"))  # one row
    mixed = id_number(F.col(S1)) * 31 + id_number(F.col(TARGET)) * 17 + seed
    asked = truth.select(S1, mixed.alias("h"), F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("i")).crossJoin(F.broadcast(span))
    wanted = asked.select(S1, (F.col("lo") + F.pmod(F.col("h") + F.col("i") * 7919, F.col("hi") - F.col("lo") + 1)).alias("ord"))
    met = wanted.join(targets.select("ord", F.col("entity_id").alias(TARGET)), "ord").select(S1, TARGET).distinct()
    return met.join(truth, [S1, TARGET], "left_anti").withColumn("label", F.lit(0))


def split_groups(pairs: DataFrame, share: float = C.VALIDATION_SHARE) -> DataFrame:
    """is_val: whether the reference record's id falls into the validation share, by a hash that SQL can repeat."""
    from .blocking import id_number

    return pairs.withColumn("is_val", F.pmod(id_number(F.col(S1)) * 2654435761, F.lit(1000)) < int(share * 1000))


def decided(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.where(F.col("probability") >= threshold)


def error_reason(threshold: float = 0.74) -> tuple[Column, Column]:
    """Reasons of false positives and of false negatives, from name_ratio, addr_ratio, country_exact, probability."""
    name, addr, country, p = F.col("name_ratio"), F.col("addr_ratio"), F.col("country_exact"), F.col("probability")
    false_positive = (
        F.when((name > 0.85) & (addr < 0.30), "Duplicate/Branch Name (Address Mismatch)")
        .when((name > 0.85) & (country == 0), "Cross-Country Name Collision")
        .when(name > 0.90, "Near-Identical Business Name (Ambiguous Entity)")
        .otherwise("High Lexical Co-occurrence")
    )
    rejected = F.concat(F.lit("Threshold Rejection (Prob "), F.format_number(p, 2), F.lit(f" < Tau {threshold:.2f})"))
    false_negative = (
        F.when(p.isNull(), "Blocking Failure (Candidate Missing)")
        .when(country == 0, "Country Mismatch / Missing Country Code")
        .when(name < 0.60, "Severe Typographical / Acronym Variance")
        .when(p >= 0.50, rejected)
        .otherwise("Weak Feature Signal")
    )
    return false_positive, false_negative
