"""Metrics of pairs and entities, threshold grids, calibration, candidate statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .blocking import S1, TARGET


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b > 0, a / b).otherwise(empty)


def f_beta(p: Column, r: Column, square: float) -> Column:
    """(1 + b2) P R / (b2 P + R), 0 where undefined."""
    down = square * p + r
    return F.when(down > 0, (1 + square) * p * r / down).otherwise(0.0)


def entity_f05(tp: Column, fp: Column, fn: Column) -> Column:
    """F0.5 of an entity; 1 if nothing was to be found and nothing was."""
    score = f_beta(ratio(tp, tp + fp), ratio(tp, tp + fn), 0.25)
    return F.when(tp + fp + fn == 0, 1.0).otherwise(score)


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def entities(sets: DataFrame) -> DataFrame:
    """(s1, tp, fp, fn) of rows (s1, id, truth, predicted), one per id that is in either set."""
    t, p = F.col("truth"), F.col("predicted")
    return sets.groupBy("s1").agg(_count(t & p).alias("tp"), _count(~t & p).alias("fp"), _count(t & ~p).alias("fn"))


def outcomes(entities: DataFrame) -> DataFrame:
    """Adds f05, precision, recall, exact and the outcome class of each entity."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    single, silent = tp + fn == 0, tp + fp == 0
    status = (
        F.when(single & silent, "CORRECT_SINGLETON").when(single, "FALSE_MATCH").when(silent, "MISSED_ALL")
        .when((fp == 0) & (fn == 0), "PERFECT_MATCH").when(tp > 0, "PARTIAL_MATCH").otherwise("COMPLETELY_INCORRECT")
    )
    both = F.when(single & silent, 1.0).otherwise(0.0)
    return entities.withColumns(
        {"f05": entity_f05(tp, fp, fn), "precision": F.when(tp + fp > 0, tp / (tp + fp)).otherwise(both), "recall": F.when(tp + fn > 0, tp / (tp + fn)).otherwise(both), "exact": (fp == 0) & (fn == 0), "status": status}
    )


def macro(entities: DataFrame) -> DataFrame:
    """One row: macro F0.5, precision and recall, exact-set and singleton accuracy, macro F0.5 without singletons."""
    o, single = outcomes(entities), F.col("tp") + F.col("fn") == 0
    return o.agg(
        F.count("*").alias("n"), F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg(F.col("exact").cast("double")).alias("exact_accuracy"),
        F.coalesce(F.avg(F.when(single, (F.col("status") == "CORRECT_SINGLETON").cast("double"))), F.lit(1.0)).alias("singleton_accuracy"),
        F.coalesce(F.avg(F.when(~single, F.col("f05"))), F.lit(0.0)).alias("non_singleton_f05"),
    )


def pair_metrics(scored: DataFrame, threshold: float, missed: int = 0) -> DataFrame:
    """One row of rows (probability, label): counts and rates; `missed` true pairs that blocking lost count as false negatives."""
    t, p = F.col("label") == 1, F.col("probability") >= threshold
    c = scored.agg(_count(t & p).alias("tp"), _count(~t & p).alias("fp"), _count(~t & ~p).alias("tn"), (_count(t & ~p) + missed).alias("fn"))
    return with_rates(c).withColumns({"f2": f_beta(F.col("precision"), F.col("recall"), 4.0), "accuracy": ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))})


def with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn, p, r = (F.col(c) for c in ("tp", "fp", "fn", "precision", "recall"))
    rated = counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    return rated.withColumns({"f1": f_beta(p, r, 1.0), "f05": f_beta(p, r, 0.25)})


def step_of(probability: Column, steps: int = 100) -> Column:
    """The largest k with k / steps <= probability, exactly."""
    k = F.floor(probability * steps).cast("int")
    up, down = (k + 1) / F.lit(float(steps)) <= probability, k / F.lit(float(steps)) > probability
    return F.when(up, k + 1).when(down, k - 1).otherwise(k)


def grid_rows(spark, low: int, high: int, step: int = 1) -> DataFrame:
    """(k): thresholds in hundredths."""
    return spark.range(low, high + 1, step).select(F.col("id").cast("int").alias("k"))


def per_group_curve(scored: DataFrame, low: int, high: int, step: int = 1) -> DataFrame:
    """(k, tp, fp, pos, n_entities) per group and threshold at which the group predicts something; one row per group and step.

    Pairs are first counted per group and step, so the thresholds multiply groups, not pairs.
    """
    binned = scored.groupBy("s1", step_of(F.col("probability")).alias("bin")).agg(F.sum("label").alias("p"), F.count("*").alias("n"))
    w = W.partitionBy("s1").orderBy(F.col("bin").desc()).rowsBetween(W.unboundedPreceding, 0)
    low_bin = F.lead("bin").over(W.partitionBy("s1").orderBy(F.col("bin").desc()))
    cumulated = binned.select("s1", "bin", F.sum("p").over(w).alias("tp"), F.sum("n").over(w).alias("n"), F.sum("p").over(W.partitionBy("s1")).alias("pos"), low_bin.alias("next"))
    first = F.greatest(F.ceil((F.coalesce("next", F.lit(-1)) + 1 - low) / F.lit(float(step))).cast("int") * step + low, F.lit(low))
    last = F.least("bin", F.lit(high))
    ks = F.when(first <= last, F.sequence(first, last, F.lit(step)))
    return cumulated.select("s1", "tp", (F.col("n") - F.col("tp")).alias("fp"), "pos", F.explode(ks).alias("k"))


def macro_grid(scored: DataFrame, low: int = 20, high: int = 95, step: int = 1) -> DataFrame:
    """(threshold, score): macro F0.5 over the groups that have pairs."""
    curve = per_group_curve(scored, low, high, step)
    f = entity_f05(F.col("tp"), F.col("fp"), F.col("pos") - F.col("tp"))
    found = curve.groupBy("k").agg(F.sum(f).alias("sum"), F.count("*").alias("met"), F.count(F.when(F.col("pos") == 0, 1)).alias("met_single"))
    totals = scored.groupBy("s1").agg(F.sum("label").alias("pos")).agg(F.count("*").alias("n"), F.count(F.when(F.col("pos") == 0, 1)).alias("single"))
    grid = grid_rows(scored.sparkSession, low, high, step).join(found, "k", "left").crossJoin(F.broadcast(totals))  # a row each
    # Groups that predict nothing at a threshold score 1 if they have no true pair, else 0.
    silent = F.col("single") - F.coalesce("met_single", F.lit(0))
    return grid.select((F.col("k") / 100.0).alias("threshold"), ratio(F.coalesce("sum", F.lit(0.0)) + silent, F.col("n")).alias("score"))


def best_threshold(grid: DataFrame) -> DataFrame:
    """(threshold, score): the smallest threshold of the highest score; 0.5 and -1 for an empty grid."""
    best = grid.agg(F.max(F.struct(F.round("score", 12).alias("score"), (-F.col("threshold")).alias("t"))).alias("b"))
    return best.select(F.coalesce(-F.col("b.t"), F.lit(0.5)).alias("threshold"), F.coalesce("b.score", F.lit(-1.0)).alias("score"))


def sweep(scored: DataFrame, low: int = 0, high: int = 100, step: int = 1, missed: int = 0) -> DataFrame:
    """Pair counts and rates at every threshold, from one count per step and running sums over the grid."""
    spark = scored.sparkSession
    binned = scored.groupBy(F.greatest(step_of(F.col("probability")), F.lit(-1)).alias("bin")).agg(F.sum("label").alias("p"), F.count("*").alias("n"))
    total = scored.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("pos"))
    # At most 102 rows from here on.
    met = grid_rows(spark, low, high, step).join(binned, F.col("bin") >= F.col("k"), "left").groupBy("k").agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.col("n") - F.col("p")), F.lit(0)).alias("fp")
    )
    counted = met.crossJoin(F.broadcast(total)).select((F.col("k") / 100.0).alias("threshold"), "tp", "fp", (F.col("pos") - F.col("tp") + missed).alias("fn"))
    return with_rates(counted)


# Calibration buckets; their gaps belong to none.
BUCKETS = ((0.50, 0.59), (0.60, 0.69), (0.70, 0.79), (0.80, 0.89), (0.90, 0.99), (0.99, 1.00))


def calibration(scored: DataFrame) -> DataFrame:
    """One row per bucket: pairs, true pairs, precision, mean probability, status."""
    p = F.col("probability")
    inside = [(p >= a) & ((p <= b) if b == 1.0 else (p < b)) for a, b in BUCKETS]
    which = F.coalesce(*(F.when(c, i) for i, c in enumerate(inside)))
    met = scored.select(which.alias("i"), "probability", "label").where("i is not null").groupBy("i").agg(
        F.count("*").alias("pair_count"), F.sum("label").alias("true_matches"), F.avg("probability").alias("mean")
    )
    names = scored.sparkSession.createDataFrame([(i, f"{a:.2f}-{b:.2f}", (a + b) / 2) for i, (a, b) in enumerate(BUCKETS)], "i int, bucket string, middle double")
    every = names.join(met, "i", "left").withColumns({"pair_count": F.coalesce("pair_count", F.lit(0)), "true_matches": F.coalesce("true_matches", F.lit(0)), "mean_prob": F.coalesce("mean", "middle")})
    rated = every.withColumn("precision", ratio(F.col("true_matches"), F.col("pair_count"))).withColumn("gap", F.col("mean_prob") - F.col("precision"))
    status = F.when(F.col("gap") > 0.15, "Overconfident").when(F.col("gap") < -0.15, "Underconfident").otherwise("Calibrated")
    return rated.select("bucket", "pair_count", "true_matches", "precision", "mean_prob", status.alias("status"))


def probability_ranges(scored: DataFrame) -> DataFrame:
    """One row: range and mean of the probabilities of true and of other pairs, and their overlap."""
    of = lambda f, label: f(F.when(F.col("label") == label, F.col("probability")))
    r = scored.agg(*(of(f, label).alias(f"{name}_{n}") for label, n in ((1, "true"), (0, "false")) for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))))
    gap = F.coalesce("max_false", F.lit(0.0)) - F.coalesce("min_true", F.lit(0.0))
    return r.withColumn("overlap", F.greatest(gap, F.lit(0.0)))


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row: exact area under the curve, ties counted half.

    Counts per distinct probability come first; their running sum goes over ranges of steps, so no task ranks all pairs.
    """
    each = scored.groupBy("probability").agg(F.sum("label").alias("p"), (F.count("*") - F.sum("label")).alias("n"))
    keyed = each.withColumn("bin", step_of(F.col("probability"), 1000))
    bins = keyed.groupBy("bin").agg(F.sum("n").alias("bn"))
    w = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    before = bins.select("bin", F.coalesce(F.sum("bn").over(w), F.lit(0)).alias("below"))  # at most 1001 rows for probabilities
    inner = W.partitionBy("bin").orderBy("probability").rowsBetween(W.unboundedPreceding, -1)
    ranked = keyed.withColumn("within", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(before, "bin")
    wins = F.sum(F.col("p") * (F.col("below") + F.col("within") + F.col("n") / 2.0))
    return ranked.agg(wins.alias("w"), F.sum("p").alias("p"), F.sum("n").alias("n")).select(ratio(F.col("w"), (F.col("p") * F.col("n")).cast("double")).alias("auc"), "p", "n")


def candidate_statistics(s1: DataFrame, pairs: DataFrame, n_targets: int | None = None) -> DataFrame:
    """One row on pairs (repeats allowed) of the reference ids s1(entity_id): coverage, distribution of distinct candidates.

    The distribution is over reference ids that occur in the pairs; percentiles are exact with linear interpolation.
    """
    per = pairs.groupBy(S1).agg(F.countDistinct(TARGET).alias("n"), F.count("*").alias("rows"))
    spread = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_pairs"), F.coalesce(F.sum(F.col("rows") - F.col("n")), F.lit(0)).alias("duplicate_pairs"),
        F.coalesce(F.min("n"), F.lit(0)).alias("min_candidates"), F.coalesce(F.max("n"), F.lit(0)).alias("max_candidates"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_candidates"),
        *(F.coalesce(F.percentile("n", q), F.lit(0.0)).alias(name) for q, name in ((0.5, "median_candidates"), (0.95, "p95_candidates"), (0.99, "p99_candidates"))),
    )
    ids = s1.select(F.col("entity_id").alias(S1)).distinct()
    covered = ids.join(per.select(S1, F.lit(1).alias("c")), S1, "left").agg(F.count("*").alias("total_s1"), F.count("c").alias("covered_s1"))
    out = covered.crossJoin(spread).withColumns({"missing_s1": F.col("total_s1") - F.col("covered_s1"), "coverage_pct": 100 * ratio(F.col("covered_s1"), F.col("total_s1"))})  # one row each
    out = out.withColumn("status", F.when((F.col("missing_s1") == 0) & (F.col("total_s1") > 0), "PASS").otherwise("FAIL"))
    return out if n_targets is None else out.withColumn("reduction_ratio", 1 - ratio(F.col("total_pairs"), F.col("total_s1") * n_targets))


def candidates_per_record(s1: DataFrame, pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """(id, candidates, true pairs, retained, recall, singleton) of every reference record; singletons have recall 1."""
    n = pairs.select(S1, TARGET).distinct().groupBy(S1).agg(F.count("*").alias("num_candidates_generated"))
    kept = pairs.select(S1, TARGET).distinct().withColumn("kept", F.lit(1))
    t = truth.select(S1, TARGET).distinct().join(kept, [S1, TARGET], "left").groupBy(S1).agg(F.count("*").alias("num_true_matches"), F.count("kept").alias("num_true_matches_retained"))
    ids = s1.select(F.col("entity_id").alias(S1))
    every = ids.join(n, S1, "left").join(t, S1, "left").na.fill(0)
    recall = F.when(F.col("num_true_matches") == 0, 1.0).otherwise(F.col("num_true_matches_retained") / F.col("num_true_matches"))
    return every.withColumns({"blocking_recall": recall, "is_singleton": (F.col("num_true_matches") == 0).cast("int")})


def block_histogram(candidates: DataFrame) -> DataFrame:
    """(block_type, pairs, rate): rate is per reference record that has candidates."""
    n = candidates.agg(F.countDistinct(S1).alias("s1"))
    return candidates.groupBy("block_type").agg(F.count("*").alias("pairs")).crossJoin(F.broadcast(n)).select("block_type", "pairs", (F.col("pairs") / F.col("s1")).alias("rate"))


def run_summary(s1: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: reference records with and without matches, matches, average matches per matched record."""
    per = matches.select(S1, TARGET).distinct().groupBy(S1).agg(F.count("*").alias("n"))
    every = s1.select(F.col("entity_id").alias(S1)).join(per, S1, "left")
    a = every.agg(F.count("*").alias("total_s1"), F.count("n").alias("matched_s1"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_matches"))
    return a.withColumns({"singletons": F.col("total_s1") - F.col("matched_s1"), "avg_matches": ratio(F.col("total_matches"), F.col("matched_s1"))})
