import random

from pyspark.sql import functions as F

from kinfold.functions.constants import FEATURES
from kinfold.operators import model as L


def test_train_save_load(spark, tmp_path):
    draw = random.Random(1)
    rows = []
    for i in range(400):
        label = i % 2
        rows.append((f"S1-{i}", f"S2-{i}", label, *[label * 0.6 + draw.random() * 0.4 for _ in FEATURES]))
    columns = ", ".join(f"{f} double" for f in FEATURES)
    features = spark.createDataFrame(rows, f"source1_entity_id string, candidate_entity_id string, label int, {columns}")
    matcher, grid = L.train(features, L.Settings(trees=3, depth=2, rate=0.5))
    assert grid.count() == 76 and 0.2 <= matcher.threshold <= 0.95
    decided = matcher.decide(features)
    assert decided.where((F.col("predicted").cast("int")) == F.col("label")).count() > 380
    matcher.save(str(tmp_path / "m"))
    again = L.Matcher.load(spark, str(tmp_path / "m"))
    assert again.threshold == matcher.threshold and again.settings == matcher.settings
    first = {r[0]: r[1] for r in matcher.score(features).select("source1_entity_id", "probability").collect()}
    assert first == {r[0]: r[1] for r in again.score(features).select("source1_entity_id", "probability").collect()}
    assert abs(sum(matcher.importances().values()) - 1) < 1e-6
    large, sweep, found = L.train_large(features, L.Settings(trees=3, depth=2, rate=0.5))
    held = features.count() - sum(r["n"] for r in L.split_groups(features).where("not is_val").groupBy().count().withColumnRenamed("count", "n").collect())
    assert large.threshold == found["optimal_threshold"] == 0.88 and sweep.count() == 10 and set(found["feature_importances"]) == set(FEATURES)
    assert sum(found[k] for k in ("true_positives", "false_positives", "true_negatives", "false_negatives")) == held and 0.9 < found["roc_auc"] <= 1
