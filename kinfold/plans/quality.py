"""Queries on metrics, validation, models and results, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..operators import blocking as B
from ..operators import features as X
from ..operators import metrics as M
from ..operators import model as L
from ..operators import validate as V
from ..sources import adapters as A
from ..sources import feeds as I
from . import sql as Q
from . import matching as R
from .linkage import _BASE, _BATCH, _EXACT, _LABELLED, _STAGES, ORACLE, S1, TARGET, _candidates, _with, query, sides, write_feed_files

_SETS = (Q.SETS, Q.ENTITIES)


def _entities(spark, sf_dir) -> DataFrame:
    return M.entities(A.pair_sets(spark, sf_dir))


# --- entity and pair metrics ----------------------------------------------------------------------------------------------

_F = Q.entity_f05("tp", "fp", "fn")
_STATUS = """CASE WHEN tp + fn = 0 AND tp + fp = 0 THEN 'CORRECT_SINGLETON' WHEN tp + fn = 0 THEN 'FALSE_MATCH' WHEN tp + fp = 0 THEN 'MISSED_ALL'
  WHEN fp = 0 AND fn = 0 THEN 'PERFECT_MATCH' WHEN tp > 0 THEN 'PARTIAL_MATCH' ELSE 'COMPLETELY_INCORRECT' END"""
_NONE = "CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE 0.0 END"
_OUTCOMES = f"""outs AS (SELECT *, {_F} AS f05, {Q.ratio('tp', 'tp + fp', _NONE)} AS precision, {Q.ratio('tp', 'tp + fn', _NONE)} AS recall,
  fp = 0 AND fn = 0 AS exact, {_STATUS} AS status FROM ents)"""


@query(_with(*_SETS, _OUTCOMES) + "SELECT * FROM outs")
def metrics_entities(spark, sf_dir):
    """F0.5, precision, recall and outcome class of each entity."""
    return M.outcomes(_entities(spark, sf_dir))


@query(
    _with(*_SETS, _OUTCOMES)
    + """SELECT count(*) AS n, round(avg(f05), 9) AS macro_f05, round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall,
    round(avg(exact::DOUBLE), 9) AS exact_accuracy, round(avg((status = 'CORRECT_SINGLETON')::DOUBLE) FILTER (WHERE tp + fn = 0), 9) AS singleton_accuracy,
    round(avg(f05) FILTER (WHERE tp + fn > 0), 9) AS non_singleton_f05 FROM outs"""
)
def metrics_macro(spark, sf_dir):
    rows = M.macro(_entities(spark, sf_dir))
    return rows.select("n", *(F.round(c, 9).alias(c) for c in rows.columns if c != "n"))


@query(_with(*_SETS, _OUTCOMES) + "SELECT status, count(*) AS n FROM outs GROUP BY status")
def metrics_outcomes(spark, sf_dir):
    """Number of entities in each outcome class."""
    return M.outcomes(_entities(spark, sf_dir)).groupBy("status").agg(F.count("*").alias("n"))


_RATES = f"{Q.ratio('tp', 'tp + fp')} AS precision, {Q.ratio('tp', 'tp + fn')} AS recall"
_FS = f"{Q.f_beta('precision', 'recall', 1.0)} AS f1, {Q.f_beta('precision', 'recall', 0.25)} AS f05"


@query(
    _with(Q.SCORED)
    + f"""SELECT *, {_FS}, {Q.f_beta('precision', 'recall', 4.0)} AS f2, {Q.ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM (SELECT *, {_RATES} FROM (
  SELECT count(*) FILTER (WHERE label = 1 AND probability >= 0.74) AS tp, count(*) FILTER (WHERE label = 0 AND probability >= 0.74) AS fp,
         count(*) FILTER (WHERE label = 0 AND probability < 0.74) AS tn, count(*) FILTER (WHERE label = 1 AND probability < 0.74) + 7 AS fn FROM scored))"""
)
def metrics_pairs(spark, sf_dir):
    """Pair metrics at 0.74 with seven true pairs lost in blocking."""
    return M.pair_metrics(A.scored_pairs(spark, sf_dir), 0.74, missed=7)


def _grid_sql(low: int, high: int) -> str:
    return _with(Q.SCORED) + f""", grid AS (SELECT CAST(k AS DOUBLE) / 100 AS threshold FROM range({low}, {high + 1}) r(k)),
ents AS (SELECT threshold, s1, count(*) FILTER (WHERE label = 1 AND probability >= threshold) AS tp, count(*) FILTER (WHERE label = 0 AND probability >= threshold) AS fp,
  count(*) FILTER (WHERE label = 1 AND probability < threshold) AS fn FROM scored, grid GROUP BY ALL),
macro AS (SELECT threshold, avg({_F}) AS score FROM ents GROUP BY threshold)
"""


@query(_grid_sql(20, 95) + "SELECT threshold, round(score, 9) AS score FROM macro")
def metrics_threshold_grid(spark, sf_dir):
    """Macro F0.5 at 76 thresholds."""
    return M.macro_grid(A.scored_pairs(spark, sf_dir)).select("threshold", F.round("score", 9).alias("score"))


@query(_grid_sql(20, 95) + "SELECT threshold, round(score, 9) AS score FROM macro ORDER BY round(score, 12) DESC, threshold LIMIT 1")
def metrics_best_threshold(spark, sf_dir):
    """The first threshold of the best macro F0.5."""
    return M.best_threshold(M.macro_grid(A.scored_pairs(spark, sf_dir))).select("threshold", F.round("score", 9).alias("score"))


def _sweep_sql(low: int, high: int, step: int) -> str:
    return _with(Q.SCORED) + f"""SELECT *, {_FS} FROM (SELECT *, {_RATES} FROM (
  SELECT CAST(k AS DOUBLE) / 100 AS threshold, count(*) FILTER (WHERE label = 1 AND probability >= k / 100.0::DOUBLE) AS tp,
         count(*) FILTER (WHERE label = 0 AND probability >= k / 100.0::DOUBLE) AS fp, count(*) FILTER (WHERE label = 1 AND probability < k / 100.0::DOUBLE) AS fn
  FROM scored, range({low}, {high + 1}, {step}) r(k) GROUP BY k))"""


@query(_sweep_sql(0, 100, 1))
def metrics_sweep(spark, sf_dir):
    """Pair metrics at 101 thresholds."""
    return M.sweep(A.scored_pairs(spark, sf_dir))


@query(_sweep_sql(50, 95, 5))
def metrics_coarse_sweep(spark, sf_dir):
    return M.sweep(A.scored_pairs(spark, sf_dir), 50, 95, 5)


@query(
    _with(Q.SCORED)
    + """, b(bucket, a, z) AS (VALUES ('0.50-0.59', 0.5, 0.59), ('0.60-0.69', 0.6, 0.69), ('0.70-0.79', 0.7, 0.79), ('0.80-0.89', 0.8, 0.89), ('0.90-0.99', 0.9, 0.99), ('0.99-1.00', 0.99, 1.0)),
m AS (SELECT bucket, count(pair_id) AS pair_count, coalesce(sum(label), 0)::BIGINT AS true_matches, coalesce(avg(probability), (a::DOUBLE + z::DOUBLE) / 2) AS mean_prob
  FROM b LEFT JOIN scored ON probability >= a::DOUBLE AND (probability < z::DOUBLE OR z = 1.0 AND probability <= 1.0::DOUBLE) GROUP BY bucket, a, z),
r AS (SELECT *, CASE WHEN pair_count > 0 THEN true_matches / pair_count::DOUBLE ELSE 0.0 END AS precision FROM m)
SELECT bucket, pair_count, true_matches, precision, round(mean_prob, 9) AS mean_prob,
  CASE WHEN mean_prob - precision > 0.15 THEN 'Overconfident' WHEN mean_prob - precision < -0.15 THEN 'Underconfident' ELSE 'Calibrated' END AS status FROM r"""
)
def metrics_calibration(spark, sf_dir):
    return M.calibration(A.scored_pairs(spark, sf_dir)).withColumn("mean_prob", F.round("mean_prob", 9))


@query(
    _with(Q.SCORED)
    + """, r AS (SELECT min(probability) FILTER (WHERE label = 1) AS min_true, max(probability) FILTER (WHERE label = 1) AS max_true, avg(probability) FILTER (WHERE label = 1) AS mean_true,
  min(probability) FILTER (WHERE label = 0) AS min_false, max(probability) FILTER (WHERE label = 0) AS max_false, avg(probability) FILTER (WHERE label = 0) AS mean_false FROM scored)
SELECT min_true, max_true, round(mean_true, 9) AS mean_true, min_false, max_false, round(mean_false, 9) AS mean_false, greatest(max_false - min_true, 0.0) AS overlap FROM r"""
)
def metrics_probability_ranges(spark, sf_dir):
    return M.probability_ranges(A.scored_pairs(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("mean_true", "mean_false")})


@query(
    _with(Q.SCORED)
    + """, e AS (SELECT probability, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY probability),
w AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM e)
SELECT round(sum(p * (below + n / 2.0)) / (sum(p) * sum(n)), 9)::DOUBLE AS auc, sum(p)::BIGINT AS p, sum(n)::BIGINT AS n FROM w"""
)
def metrics_roc_auc(spark, sf_dir):
    return M.roc_auc(A.scored_pairs(spark, sf_dir)).withColumn("auc", F.round("auc", 9))


# --- candidate statistics ----------------------------------------------------------------------------------------------------

_PER = "per AS (SELECT s1, count(DISTINCT cid) AS n, count(*) AS rows FROM rowsof GROUP BY s1)"
_STATS = """SELECT (SELECT count(*) FROM q) AS total_s1, (SELECT count(*) FROM per) AS covered_s1, (SELECT count(*) FROM q) - (SELECT count(*) FROM per) AS missing_s1,
  100 * (SELECT count(*) FROM per)::DOUBLE / (SELECT count(*) FROM q) AS coverage_pct, sum(n)::BIGINT AS total_pairs, sum(rows - n)::BIGINT AS duplicate_pairs,
  min(n) AS min_candidates, max(n) AS max_candidates, avg(n) AS mean_candidates, quantile_cont(n, 0.5)::DOUBLE AS median_candidates,
  quantile_cont(n, 0.95)::DOUBLE AS p95_candidates, quantile_cont(n, 0.99)::DOUBLE AS p99_candidates,
  CASE WHEN (SELECT count(*) FROM q) = (SELECT count(*) FROM per) THEN 'PASS' ELSE 'FAIL' END AS status,
  1 - sum(n)::DOUBLE / ((SELECT count(*) FROM q) * (SELECT count(*) FROM t)) AS reduction_ratio FROM per"""


@query(_with(*_BASE, Q.TRUTH, *_BATCH, f"rowsof AS (SELECT s1, cid FROM batch UNION ALL SELECT s1, cid FROM truth)", _PER) + _STATS)
def candidates_statistics(spark, sf_dir):
    """Coverage, distribution and reduction ratio of candidates that repeat some pairs."""
    pairs, q, t = _candidates(spark, sf_dir)
    return M.candidate_statistics(q, pairs.select(S1, TARGET).unionByName(A.truth(spark, sf_dir)), t.count())


_RECALL = """rec AS (SELECT q.entity_id AS source1_entity_id, coalesce(c.n, 0) AS num_candidates_generated, coalesce(x.n, 0) AS num_true_matches, coalesce(x.k, 0) AS num_true_matches_retained
  FROM q LEFT JOIN (SELECT s1, count(*) AS n FROM batch GROUP BY s1) c ON c.s1 = entity_id
  LEFT JOIN (SELECT truth.s1, count(*) AS n, count(batch.s1) AS k FROM truth LEFT JOIN batch ON batch.s1 = truth.s1 AND batch.cid = truth.cid GROUP BY truth.s1) x ON x.s1 = entity_id)"""
_RECALLS = "SELECT *, CASE WHEN num_true_matches = 0 THEN 1.0 ELSE num_true_matches_retained / num_true_matches::DOUBLE END AS blocking_recall, CAST(num_true_matches = 0 AS INT) AS is_singleton FROM rec"


@query(_with(*_BASE, Q.TRUTH, *_BATCH, _RECALL) + _RECALLS)
def candidates_per_record(spark, sf_dir):
    """Candidates, true pairs and blocking recall of each reference record."""
    pairs, q, _ = _candidates(spark, sf_dir)
    return M.candidates_per_record(q, pairs, A.truth(spark, sf_dir))


@query(
    _with(*_BASE, Q.TRUTH, *_BATCH, _RECALL)
    + """SELECT count(*) AS n, sum(num_true_matches)::BIGINT AS true_pairs, sum(num_true_matches_retained)::BIGINT AS retained, avg(num_candidates_generated) AS mean_candidates,
  quantile_cont(num_candidates_generated, 0.5)::DOUBLE AS median_candidates, max(num_candidates_generated) AS max_candidates FROM rec"""
)
def candidates_recall(spark, sf_dir):
    """Blocking recall over all true pairs, and candidates per record with zeros."""
    pairs, q, _ = _candidates(spark, sf_dir)
    c = M.candidates_per_record(q, pairs, A.truth(spark, sf_dir))
    n = F.col("num_candidates_generated")
    return c.agg(
        F.count("*").alias("n"), F.sum("num_true_matches").alias("true_pairs"), F.sum("num_true_matches_retained").alias("retained"),
        F.avg(n).alias("mean_candidates"), F.percentile(n, 0.5).alias("median_candidates"), F.max(n).alias("max_candidates"),
    )


@query(_with(*_BASE, *_STAGES) + "SELECT block_type, count(*) AS pairs, count(*) / (SELECT count(DISTINCT s1) FROM stages)::DOUBLE AS rate FROM stages GROUP BY block_type")
def candidates_by_block(spark, sf_dir):
    """Pairs of each block of the scalable stages and their rate per record."""
    return M.block_histogram(B.scalable_stages(*sides(spark, sf_dir, settle=True)))


_RATED = f"""found AS (SELECT s1, cid, x.ord, prio, {Q.indel('a.name_n', 'b.name_n')} AS name_ratio, {Q.indel('a.addr_n', 'b.addr_n')} AS addr_ratio,
  CAST(a.country_n <> '' AND a.country_n = b.country_n AS DOUBLE) AS country_exact FROM batch x JOIN q a ON a.entity_id = s1 JOIN t b ON b.entity_id = cid),
matched AS (SELECT * FROM found WHERE 0.60 * name_ratio + 0.30 * addr_ratio + 0.10 * country_exact >= 0.65)"""
_MATCHED = _RATED


def _scored(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Batch candidates with probability and predicted, by the batch matcher's features and the formula."""
    pairs, q, t = _candidates(spark, sf_dir)
    return R.scored(pairs, q, t, batch=True), q, t


@query(
    _with(*_BASE, *_BATCH, _MATCHED)
    + """SELECT (SELECT count(*) FROM q) AS total_s1, count(DISTINCT s1) AS matched_s1, count(*) AS total_matches, (SELECT count(*) FROM q) - count(DISTINCT s1) AS singletons,
  CASE WHEN count(*) > 0 THEN count(*) / count(DISTINCT s1)::DOUBLE ELSE 0.0 END AS avg_matches FROM matched"""
)
def run_summary(spark, sf_dir):
    rows, q, _ = _scored(spark, sf_dir)
    return M.run_summary(q, rows.where("predicted"))


# --- results: lists, merge, validation, repair -------------------------------------------------------------------------------------

_FILES = (Q.FILE_RECORDS, Q.PREPARED, *_BATCH, _RATED, Q.fallback("fall", "batch", 1, 100, 500))
_LISTED = """, every AS (SELECT s1, cid, ord, prio FROM batch UNION ALL SELECT s1, cid, ord, 9 FROM fall),
c AS (SELECT s1, string_agg(cid, ',' ORDER BY prio, ord) AS cids, count(*) AS n FROM every GROUP BY s1),
m AS (SELECT s1, string_agg(cid, ',' ORDER BY prio, ord) AS mids FROM matched GROUP BY s1)
"""


def _result_files(spark, sf_dir) -> str:
    """The folder of a run over the feed files: batch blocks, all features, the formula's probability."""
    reference, *targets = write_feed_files(spark, sf_dir)
    out = I.scratch(spark, "results")
    R.match_files(spark, reference, targets, out, blocker="batch")
    return out


@query(_with(*_FILES) + _LISTED + "SELECT entity_id AS source1_entity_id, coalesce(mids, '') AS matched_entity_ids, cids AS candidate_entity_ids FROM q JOIN c ON c.s1 = entity_id LEFT JOIN m ON m.s1 = entity_id")
def flagship(spark, sf_dir):
    """From three feed files to the two result files, read back: one row per reference record with its matches and candidates."""
    out = _result_files(spark, sf_dir)
    lists = lambda name, file: I.read_id_lists(spark, f"{out}/{file}", name)
    return lists("matched_entity_ids", R.MATCHING).join(lists("candidate_entity_ids", R.CANDIDATES), S1)


@query(
    _with(*_FILES)
    + _LISTED
    + """SELECT entity_id AS source1_entity_id, coalesce(mids, '') AS matched_ids, cids AS candidate_ids, mids IS NULL AS is_singleton, n AS candidate_count
FROM q JOIN c ON c.s1 = entity_id LEFT JOIN m ON m.s1 = entity_id ORDER BY q.ord LIMIT 20 OFFSET 40"""
)
def results_page(spark, sf_dir):
    """Rows 41 to 60 of the result files, in their order, with matches and candidates."""
    from .serving import results

    out = _result_files(spark, sf_dir)
    page = results(spark, f"{out}/{R.MATCHING}", f"{out}/{R.CANDIDATES}", 40, 20)
    return page.withColumns({c: F.array_join(c, ",") for c in ("matched_ids", "candidate_ids")})


_BROKEN = """cands AS (SELECT entity_id AS source1_entity_id, coalesce(string_agg(cid, ',' ORDER BY cid), '') AS candidate_entity_ids, any_value(q.ord) AS ord FROM q LEFT JOIN batch ON s1 = entity_id GROUP BY entity_id),
broken AS (SELECT source1_entity_id, CASE WHEN ord % 5 = 0 THEN candidate_entity_ids || ',S1-1,X9, S2-1,S2-1' ELSE candidate_entity_ids END AS matched_entity_ids FROM cands WHERE ord % 11 <> 0
  UNION ALL SELECT 'S1-999999999', '' UNION ALL SELECT source1_entity_id, '' FROM cands WHERE ord % 13 = 0 AND ord % 11 <> 0),
ids AS (SELECT source1_entity_id, list_filter(list_transform(string_split(matched_entity_ids, ','), lambda x: trim(x)), lambda x: x <> '') AS ids FROM broken),
each AS (SELECT source1_entity_id, unnest(ids) AS id FROM ids), ceach AS (SELECT source1_entity_id, unnest(string_split(candidate_entity_ids, ',')) AS id FROM cands),
found(file, rule, severity, x) AS (
  SELECT 'matching', 'duplicate_row', 'error', source1_entity_id FROM ids GROUP BY 4 HAVING count(*) > 1
  UNION SELECT 'matching', 'duplicate_id', 'error', source1_entity_id FROM ids WHERE len(ids) <> len(list_distinct(ids))
  UNION SELECT 'matching', 'self_match', 'error', id FROM each WHERE id LIKE 'S1-%'
  UNION SELECT 'matching', 'wrong_prefix', 'error', id FROM each WHERE id NOT LIKE 'S1-%' AND id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%'
  UNION SELECT 'matching', 'missing_s1', 'error', entity_id FROM q WHERE entity_id NOT IN (SELECT source1_entity_id FROM ids)
  UNION SELECT 'matching', 'unexpected_s1', 'error', source1_entity_id FROM ids WHERE source1_entity_id NOT IN (SELECT entity_id FROM q)
  UNION SELECT 'both', 'not_in_candidates', 'warning', source1_entity_id FROM each e WHERE NOT EXISTS (SELECT 1 FROM ceach c WHERE c.source1_entity_id = e.source1_entity_id AND c.id = e.id)
  UNION SELECT 'matching', 'unknown_target', 'error', id FROM each WHERE id NOT IN (SELECT entity_id FROM t))"""


def _broken(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Reference records, targets, candidate lists, and match lists with every kind of fault."""
    pairs, q, t = _candidates(spark, sf_dir)
    # Every finding reads the lists twice, so they are written first, as result files are.
    cands = I.settled(I.id_lists(q, pairs, "candidate_entity_ids").join(q.select(F.col("entity_id").alias(S1), "ord"), S1), "candidates")
    ids = F.col("candidate_entity_ids")
    bad = F.when(F.col("ord") % 5 == 0, F.concat(ids, F.lit(",S1-1,X9, S2-1,S2-1"))).otherwise(ids).alias("matched_entity_ids")
    rows = cands.where("ord % 11 <> 0")
    extra = spark.range(1).select(F.lit("S1-999999999").alias(S1), F.lit("").alias("matched_entity_ids"))
    again = rows.where("ord % 13 = 0").select(S1, F.lit("").alias("matched_entity_ids"))
    return q, t, cands.select(S1, "candidate_entity_ids"), rows.select(S1, bad).unionByName(extra).unionByName(again)


@query(
    _with(*_BASE, *_BATCH, _BROKEN)
    + """SELECT file, rule, severity, count(DISTINCT x) AS n, array_to_string(list_sort(list_distinct(list(x)))[1:5], ',') AS examples FROM found GROUP BY file, rule, severity"""
)
def validation_report(spark, sf_dir):
    """All findings on faulty match lists."""
    q, t, cands, matches = _broken(spark, sf_dir)
    lists = V.broken_lists(matches, "matched_entity_ids", q, "matching")
    return V.findings(*lists, V.loose_matches(matches, cands), V.unknown_targets(matches, "matched_entity_ids", t, "matching"))


@query(
    """WITH l AS (SELECT doc_id + 1 AS number, CASE WHEN doc_id % 10 = 3 THEN 'S1-' || doc_id ELSE 'S1-' || doc_id || chr(9) END AS value FROM documents),
found(rule, x) AS (SELECT 'header', value FROM l WHERE number = 1 AND contains(value, chr(9))
  UNION SELECT 'no_tab', value FROM l WHERE number > 1 AND NOT contains(value, chr(9)))
SELECT rule, 'error' AS severity, count(*) AS n, array_to_string(list_sort(list(x))[1:5], ',') AS examples FROM found GROUP BY rule"""
)
def validation_lines(spark, sf_dir):
    """Findings on the lines of a file with a wrong header and rows without a tab."""
    row = F.concat(F.lit("S1-"), F.col("doc_id").cast("string"))
    value = F.when(F.col("doc_id") % 10 == 3, row).otherwise(F.concat(row, F.lit("\t")))
    lines = A.read_table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("number"), value.alias("value"))
    return V.check_lines(lines, (S1, "matched_entity_ids"))


@query(
    _with(*_BASE, *_BATCH, _BROKEN)
    + """, m AS (SELECT source1_entity_id, max(matched_entity_ids) AS l FROM broken GROUP BY 1),
good AS (SELECT entity_id AS source1_entity_id, list_filter(list_transform(string_split(coalesce(l, ''), ','), lambda x: trim(x)), lambda x: x LIKE 'S2-%' OR x LIKE 'S3-%') AS m,
  list_filter(string_split(coalesce(candidate_entity_ids, ''), ','), lambda x: x <> '') AS c FROM q LEFT JOIN m ON m.source1_entity_id = entity_id LEFT JOIN cands ON cands.source1_entity_id = entity_id),
uniq AS (SELECT source1_entity_id, list_filter(m, lambda x, i: list_position(m, x) = i) AS m, c FROM good)
SELECT source1_entity_id, coalesce(array_to_string(m, ','), '') AS matched_entity_ids,
  coalesce(array_to_string(list_concat(c, list_filter(m, lambda x: NOT list_contains(c, x))), ','), '') AS candidate_entity_ids FROM uniq"""
)
def repair_lists(spark, sf_dir):
    """Faulty lists repaired: a row per reference record, matches a subset of candidates."""
    q, _, cands, matches = _broken(spark, sf_dir)
    return V.repair(q, matches, cands)


@query(
    _with(*_BASE, *_BATCH, _MATCHED)
    + """SELECT q.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT batch.cid, ',' ORDER BY batch.cid), '') AS candidate_entity_ids,
  coalesce(string_agg(DISTINCT matched.cid, ',' ORDER BY matched.cid), '') AS matched_entity_ids
FROM q LEFT JOIN batch ON batch.s1 = q.entity_id LEFT JOIN matched ON matched.s1 = batch.s1 AND matched.cid = batch.cid GROUP BY q.entity_id"""
)
def merge_feeds(spark, sf_dir):
    """Results of both target feeds merged by reference id."""
    rows, q, _ = _scored(spark, sf_dir)
    return V.merge_feeds(rows.select(S1, TARGET, B.T.feed_of(F.col(TARGET)).alias("feed"), F.col("predicted").alias("matched")), q)


@query(_with(*_BASE, _EXACT) + "SELECT entity_id AS source1_entity_id FROM q WHERE entity_id NOT IN (SELECT s1 FROM exact)")
def missing_ids(spark, sf_dir):
    """Reference ids that the exact name block leaves without a candidate."""
    q, t = sides(spark, sf_dir)
    return V.missing_ids(q, B.exact_name(q, t))


# --- error analysis, scores, models --------------------------------------------------------------------------------------------------


def _ratios(spark, sf_dir) -> DataFrame:
    """Batch candidates with their label and the fallback probability."""
    pairs, q, t = _candidates(spark, sf_dir)
    met = X.sides(X.with_labels(pairs.select(S1, TARGET), A.truth(spark, sf_dir)), q, t)
    exact = ((F.col("a.country_n") != "") & (F.col("a.country_n") == F.col("b.country_n"))).cast("double")
    rows = met.select(S1, TARGET, "label", S.indel_ratio("a.name_n", "b.name_n").alias("name_ratio"), S.indel_ratio("a.addr_n", "b.addr_n").alias("addr_ratio"), exact.alias("country_exact"))
    return rows.withColumn("probability", S.fallback_probability(F.col("name_ratio"), F.col("addr_ratio"), F.col("country_exact")))


_SCORED_PAIRS = f"""rated AS (SELECT l.s1, l.cid, l.label, {Q.indel('a.name_n', 'b.name_n')} AS name_ratio, {Q.indel('a.addr_n', 'b.addr_n')} AS addr_ratio,
  CAST(a.country_n <> '' AND a.country_n = b.country_n AS DOUBLE) AS country_exact FROM labelled l JOIN q a ON a.entity_id = l.s1 JOIN t b ON b.entity_id = l.cid),
probs AS (SELECT *, 0.60 * name_ratio + 0.30 * addr_ratio + 0.10 * country_exact AS probability FROM rated)"""


@query(
    _with(*_BASE, Q.TRUTH, *_BATCH, _LABELLED, _SCORED_PAIRS)
    + f"SELECT {Q.PAIRS}, label, round(probability::DOUBLE, 9) AS probability, probability >= 0.65 AS predicted FROM probs"
)
def scores_fallback(spark, sf_dir):
    """The probability that is used without a model, and its verdict."""
    return _ratios(spark, sf_dir).select(S1, TARGET, "label", F.round("probability", 9).alias("probability"), (F.col("probability") >= 0.65).alias("predicted"))


@query(
    _with(*_BASE, Q.TRUTH, *_BATCH, _LABELLED, _SCORED_PAIRS)
    + f"""SELECT {Q.PAIRS}, round(probability::DOUBLE, 6) AS probability, CASE WHEN name_ratio > 0.85 AND addr_ratio < 0.30 THEN 'Duplicate/Branch Name (Address Mismatch)'
  WHEN name_ratio > 0.85 AND country_exact = 0 THEN 'Cross-Country Name Collision' WHEN name_ratio > 0.90 THEN 'Near-Identical Business Name (Ambiguous Entity)'
  ELSE 'High Lexical Co-occurrence' END AS reason FROM probs WHERE label = 0 AND probability >= 0.65 ORDER BY round(probability::DOUBLE, 6) DESC, s1, cid LIMIT 50"""
)
def errors_false_positives(spark, sf_dir):
    """The fifty surest false positives with their reasons."""
    reason, _ = X.error_reason(0.65)
    rows = _ratios(spark, sf_dir).where("label = 0 and probability >= 0.65")
    return rows.select(S1, TARGET, F.round("probability", 6).alias("probability"), reason.alias("reason")).orderBy(F.col("probability").desc(), S1, TARGET).limit(50)


@query(
    _with(*_BASE, Q.TRUTH, *_BATCH, _LABELLED, _SCORED_PAIRS)
    + f"""SELECT truth.s1 AS source1_entity_id, truth.cid AS candidate_entity_id, CASE WHEN probability IS NULL THEN 'Blocking Failure (Candidate Missing)'
  WHEN country_exact = 0 THEN 'Country Mismatch / Missing Country Code' WHEN name_ratio < 0.60 THEN 'Severe Typographical / Acronym Variance'
  WHEN probability >= 0.50 THEN 'Threshold Rejection' ELSE 'Weak Feature Signal' END AS reason
FROM truth LEFT JOIN probs USING (s1, cid) WHERE probability IS NULL OR probability < 0.65"""
)
def errors_false_negatives(spark, sf_dir):
    """True pairs that blocking or the threshold lost, with reasons."""
    _, reason = X.error_reason(0.65)
    rows = A.truth(spark, sf_dir).join(_ratios(spark, sf_dir), [S1, TARGET], "left").where("probability is null or probability < 0.65")
    return rows.select(S1, TARGET, F.regexp_replace(reason, r" \(Prob.*", "").alias("reason"))


@query(ORACLE["metrics_sweep"].replace("SELECT *, ", "SELECT threshold, tp, fp, fn, round(precision, 4) AS precision, round(recall, 4) AS recall, ", 1))
def sink_evaluation(spark, sf_dir):
    """The threshold sweep written as CSV, and read back."""
    from ..sources.reports import write_csv

    path = I.scratch(spark, "sweep")
    rows = M.sweep(A.scored_pairs(spark, sf_dir))
    write_csv(rows.withColumns({"precision": F.round("precision", 4), "recall": F.round("recall", 4)}), path)
    return spark.read.schema("threshold double, tp long, fp long, fn long, precision double, recall double, f1 double, f05 double").csv(path, header=True)


@query(ORACLE["metrics_macro"])
def sink_metrics_json(spark, sf_dir):
    """Macro metrics written as JSON, and read back."""
    from ..sources.reports import write_json

    path = I.scratch(spark, "metrics")
    rows = metrics_macro(spark, sf_dir)
    write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


#: Trees in the registered model queries; the full setting is Settings().
QUICK = L.Settings(trees=10, depth=3, rate=0.3)


def _training_features(spark, sf_dir) -> DataFrame:
    pairs, q, t = _candidates(spark, sf_dir)
    rows = X.training_pairs(pairs, A.truth(spark, sf_dir), t)
    return X.with_features(rows, q, t)


@query()
def model_train(spark, sf_dir):
    """Training, threshold calibration, refit, save and load: threshold, best score and importances."""
    features = _training_features(spark, sf_dir).persist()
    matcher, grid = L.train(features, QUICK)
    path = I.scratch(spark, "model")
    matcher.save(path)
    again = L.Matcher.load(spark, path)
    rows = [("threshold", again.threshold), ("score", M.best_threshold(grid).first()["score"]), *again.importances().items()]
    features.unpersist()
    return spark.createDataFrame([(k, float(v)) for k, v in rows], "name string, value double")


@query()
def model_score(spark, sf_dir):
    """Batch candidates scored by the trained model, with the decision."""
    features = _training_features(spark, sf_dir).persist()
    matcher, _ = L.train(features, QUICK, refit=False)
    features.unpersist()
    pairs, q, t = _candidates(spark, sf_dir)
    return matcher.decide(X.with_features(pairs, q, t)).select(S1, TARGET, F.round("probability", 9).alias("probability"), "predicted")


@query()
def model_train_large(spark, sf_dir):
    """The large-sample trainer at its fixed threshold: metrics with confusion counts, area under the curve and importances, written as JSON and read back."""
    from ..sources.reports import read_json, write_rows

    features = _training_features(spark, sf_dir).persist()
    _, _, found = L.train_large(features, QUICK)
    features.unpersist()
    path = I.scratch(spark, "large")
    write_rows(spark, [found], path)
    again = read_json(spark, path)
    rows = [(k, float(v)) for k, v in again.items() if k != "feature_importances"] + [(k, float(v)) for k, v in again["feature_importances"].items()]
    return spark.createDataFrame(rows, "name string, value double")


@query(_with(*_BASE, *_BATCH, _RATED) + f"SELECT {Q.PAIRS}, round(CAST(0.60 * name_ratio + 0.30 * addr_ratio + 0.10 * country_exact AS DOUBLE), 9) AS probability, 0.60 * name_ratio + 0.30 * addr_ratio + 0.10 * country_exact >= 0.65 AS predicted FROM found")
def stream_matching(spark, sf_dir):
    """Batch blocks, features and decision as a restartable stream of reference record files against static targets."""
    from ..operators.prepare import prepare
    from ..streaming.resume import RECORD, stream_candidates

    source, sink, state = (I.scratch(spark, n) for n in ("records", "matches", "state"))
    names = [c.split()[0] for c in RECORD.split(", ")]
    rows = A.records(spark, sf_dir)
    A.feed(rows, "S1").select(*names).repartition(4, "ord").write.parquet(source)
    targets = I.settled(prepare(A.feed(rows, "S2", "S3")), "targets")

    def run(batch: DataFrame) -> DataFrame:
        queries = I.settled(prepare(batch), "queries")
        return R.scored(R.candidates(queries, targets, "batch"), queries, targets, batch=True)

    for _ in range(2):  # the second run finds nothing left to do
        stream_candidates(spark, source, sink, state, run, files_per_batch=2).awaitTermination()
    return spark.read.parquet(sink).select(S1, TARGET, F.round("probability", 9).alias("probability"), "predicted")


@query(ORACLE["block_exact_name"])
def stream_blocking(spark, sf_dir):
    """Exact name blocking as a restartable stream of reference record files against static targets."""
    from ..operators.prepare import prepare
    from ..streaming.resume import RECORD, stream_candidates

    source, sink, state = (I.scratch(spark, n) for n in ("records", "candidates", "state"))
    names = [c.split()[0] for c in RECORD.split(", ")]
    rows = A.records(spark, sf_dir)
    A.feed(rows, "S1").select(*names).repartition(4, "ord").write.parquet(source)
    targets = prepare(A.feed(rows, "S2", "S3"))
    run = lambda batch: B.exact_name(prepare(batch), targets)
    for _ in range(2):  # the second run finds nothing left to do
        stream_candidates(spark, source, sink, state, run, files_per_batch=2).awaitTermination()
    return spark.read.parquet(sink).select(S1, TARGET, "ord", "block_type", "blocking_key")
