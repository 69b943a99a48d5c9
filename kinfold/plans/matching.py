"""From feed files to result files: block, compute features, score, decide, write, check."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking as B
from ..operators import features as X
from ..operators import metrics as M
from ..operators import validate as V
from ..operators.blocking import S1, TARGET
from ..operators.model import Matcher
from ..operators.prepare import prepare
from ..sources import feeds as I

MATCHING, CANDIDATES, MISSING, CHECKS = "matching_results.tsv", "candidate_pairs.tsv", "missing_s1_entities.tsv", "checks"

#: Blockers by name; all of them give (reference id, candidate id, ord) and may give prio.
BLOCKERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"multi": B.multi_block, "scalable": B.scalable, "batch": B.batch_blocks, "single_file": B.single_file}
#: Targets per reference record that a sampled run reads.
SAMPLED = {"multi": 10, "scalable": 30, "batch": 10, "single_file": 10}


def candidates(queries: DataFrame, targets: DataFrame, blocker: str) -> DataFrame:
    """(reference id, candidate id, ord, prio) of the named blocker."""
    found = BLOCKERS[blocker](queries, targets)
    return found.select(S1, TARGET, "ord", F.col("prio") if "prio" in found.columns else F.lit(0).alias("prio"))


def scored(pairs: DataFrame, queries: DataFrame, targets: DataFrame, matcher: Matcher | None = None, batch: bool = False) -> DataFrame:
    """pairs with probability and predicted; `batch` takes the batch matcher's features."""
    features = (X.batch_features if batch else X.with_features)(pairs, queries, targets)
    return X.with_probability(features, matcher).select(*pairs.columns, "probability", "predicted")


def match_files(
    spark: SparkSession, reference: str, targets: Sequence[str], out: str, *, matcher: Matcher | None = None, blocker: str = "multi", sample: int | None = None
) -> DataFrame:
    """Reads the reference feed and the target feeds, writes out/matching_results.tsv and out/candidate_pairs.tsv with a row
    for each reference record, in the order of its file, and out/checks with what is wrong with them; returns the run's summary.

    Lists keep the order of the blocks, then of the target files. A record without a candidate gets one of the first
    targets of its country as candidate, never as a match; should there be none at all, the ids are written to
    out/missing_s1_entities.tsv and the run fails. Without a matcher the formula decides. `sample` takes the first
    reference rows, and a multiple of them from each target file.
    """
    each = None if sample is None else SAMPLED[blocker] * sample
    total = each if blocker == "scalable" else None  # the scalable blocker counts over all files
    q = I.settled(prepare(I.read_feeds(spark, [reference], least_fields=1, limit=sample, required=True)), "reference")
    t = I.settled(prepare(I.read_feeds(spark, targets, limit=total, limit_each=None if total else each)), "targets")
    pairs = I.settled(B.no_self(candidates(q, t, blocker)), "pairs")
    anchors = B.fallback(q, pairs, t, take=1).select(S1, TARGET, "ord", F.lit(9).alias("prio"))
    every = I.settled(pairs.unionByName(anchors), "candidates")
    V.assert_coverage(q, every, f"{out}/{MISSING}")
    rated = I.settled(scored(pairs, q, t, matcher, blocker == "batch"), "scored")
    matches = rated.where("predicted")
    I.write_lists(I.lists_in_order(q, every, "candidate_entity_ids", "prio", "ord"), f"{out}/{CANDIDATES}")
    I.write_lists(I.lists_in_order(q, matches, "matched_entity_ids", "prio", "ord"), f"{out}/{MATCHING}")
    V.check_files(spark, f"{out}/{MATCHING}", f"{out}/{CANDIDATES}", q, t).write.mode("overwrite").json(f"{out}/{CHECKS}")
    return M.run_summary(q, matches)
