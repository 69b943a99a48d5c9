import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinfold.functions import similarity as S
from kinfold.operators import blocking as B
from kinfold.operators import features as X
from kinfold.operators import metrics as M
from kinfold.operators import validate as V
from kinfold.operators.prepare import prepare
from kinfold.plans import matching as R
from kinfold.plans.serving import match_records, results
from kinfold.sources import feeds as I

RAW = "ord long, feed string, entity_id string, business_name string, business_address string, country string"


def records(spark, *rows):
    return prepare(spark.createDataFrame([(i, e[:2], e, n, a, c) for i, (e, n, a, c) in enumerate(rows)], RAW))


@pytest.fixture(scope="module")
def world(spark):
    q = records(spark, ("S1-1", "Acme Tools Ltd", "12 Harbour Road", "IN"), ("S1-2", "", "", ""), ("S1-3", "Zeta", "9 Garden Lane 560001", "US"))
    t = records(
        spark, ("S2-1", "ACME tools", "12 harbour rd", "in"), ("S2-2", "Acme Bakery", "1 Hill St", "in"), ("S3-1", "Zeta Corp", "9 garden ln 560001", "us"),
        ("S3-2", "Other", "harbour view", "fr"), *[(f"S3-{i}", "Common Name", f"{i} x", "in") for i in range(10, 30)],
    )
    return q, t


def pairs(df):
    return {(r[B.S1], r[B.TARGET]) for r in df.collect()}


def test_blocks(world):
    q, t = world
    assert pairs(B.exact_name(q, t)) == {("S1-1", "S2-1"), ("S1-3", "S3-1")}
    assert ("S1-1", "S2-2") in pairs(B.rare_tokens(q, t))
    assert ("S1-1", "S3-2") in pairs(B.address_overlap(q, t))
    assert ("S1-1", "S2-1") in pairs(B.nearest_names(q, t, take=1))


def most_rows(spark, run):
    """The largest row count of any plan node of the SQL executions that run starts."""
    store = spark._jsparkSession.sharedState().statusStore()
    before, most = store.executionsCount(), 0
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    done = store.executionsList()
    for k in range(before, done.size()):
        values, nodes = store.executionMetrics(done.apply(k).executionId()), store.planGraph(done.apply(k).executionId()).allNodes()
        for metrics in (nodes.apply(i).metrics() for i in range(nodes.size())):
            for m in (metrics.apply(i) for i in range(metrics.size())):
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return most


def test_nearest_names_makes_no_rows_for_pairs(spark):
    """Copies and common words: 300 x 600 pairs share every gram; rows grow with the records, not with the pairs."""
    name = lambda i: "common tools" if i % 3 else f"common tools {i}"
    q = records(spark, *[(f"S1-{i}", name(i), "", "in") for i in range(300)])
    t = records(spark, *[(f"S2-{i}", name(i), "", "in") for i in range(600)])
    found = []
    assert most_rows(spark, lambda: found.extend(B.nearest_names(q, t).collect())) < 20_000
    assert len(found) == 3000
    assert [r["ord"] for r in sorted(found, key=lambda r: r["ord"]) if r[B.S1] == "S1-1"] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]


@pytest.mark.parametrize("take", [1, 10])
def test_nearest_names_against_brute_force(spark, monkeypatch, take):
    """Copies, ties, unknown grams, empty names, and vectors in many blocks."""
    monkeypatch.setattr(B, "QUERY_BLOCK", 9)
    monkeypatch.setattr(B, "TARGET_BLOCK", 13)
    draw = random.Random(5)
    words = ["tea", "teas", "seat", "a", "rose", "roses", "eros", "zz", "market"]
    name = lambda: " ".join(draw.choice(words) for _ in range(draw.randint(0, 3)))
    q = [(f"S1-{i}", name(), "", "in") for i in range(60)] + [("S1-90", "qqqq", "", "in"), ("S1-91", "qqqq rose", "", "in")]
    t = [(f"S2-{i}", name(), "", "in") for i in range(150)]

    def counts(text):
        padded = [f" {w} " for w in text.split()]
        return Counter(w[i : i + n] for w in padded for n in (3, 4, 5) for i in range(len(w) - n + 1))

    bags = [counts(r[1]) for r in t]
    df = Counter(g for b in bags for g in b)
    idf = {g: math.log((1 + len(t)) / (1 + n)) + 1 for g, n in df.items()}

    def vector(bag):
        w = {g: n * idf[g] for g, n in bag.items() if g in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {g: x / norm for g, x in w.items()}

    vectors, want = [vector(b) for b in bags], set()
    for row in q:
        v = vector(counts(row[1]))
        near = sorted((-round(sum(x * u[g] for g, x in v.items() if g in u), 9), k) for k, u in enumerate(vectors) if v.keys() & u.keys())
        want |= {(row[0], t[k][0], k, f"{-c:.6f}") for c, k in near[:take]}
    got = B.nearest_names(records(spark, *q), records(spark, *t), take).collect()
    assert len(got) == len(want) and {(r[B.S1], r[B.TARGET], r["ord"], r["blocking_key"]) for r in got} == want


def test_caps_decide_by_order(spark, world):
    _, t = world
    q = records(spark, ("S1-9", "Common Name", "", "in"))
    assert [r["ord"] for r in B.exact_name(q, t).orderBy("ord").collect()] == list(range(4, 12))
    assert len(pairs(B.multi_block(q, t, grams=True, most=5))) == 5


def test_scalable_covers_every_record(world):
    q, t = world
    got = B.scalable(q, t)
    assert {a for a, _ in pairs(got)} == {"S1-1", "S1-2", "S1-3"}
    assert {r["block_type"] for r in got.where(f"{B.S1} = 'S1-2'").collect()} == {"fallback"}
    V.assert_coverage(q, got)
    with pytest.raises(AssertionError, match="S1-2"):
        V.assert_coverage(q, got.where(f"{B.S1} <> 'S1-2'"))


def test_results_do_not_depend_on_partitions(world):
    q, t = world
    assert pairs(B.batch_blocks(q, t)) == pairs(B.batch_blocks(q.repartition(7), t.repartition(3)))


def test_features_of_an_exact_pair(spark, world):
    q, t = world
    row = X.with_features(spark.createDataFrame([("S1-3", "S3-1")], f"{B.S1} string, {B.TARGET} string"), q, t).first().asDict()
    assert row["name_ratio"] == row["name_wratio"] == row["name_jaccard"] == row["country_exact"] == row["same_postal_like"] == row["addr_ratio"] == 1.0
    assert row["name_len_diff"] == 0.0


def test_entity_metrics(spark):
    sets = [("a", 1, True, True), ("b", 1, False, True), ("c", 1, True, False), ("d", 1, True, True), ("d", 2, False, True), ("e", 1, False, False)]
    rows = {r["s1"]: r for r in M.outcomes(M.entities(spark.createDataFrame(sets, "s1 string, id long, truth boolean, predicted boolean"))).collect()}
    assert [rows[k]["status"] for k in "abcde"] == ["PERFECT_MATCH", "FALSE_MATCH", "MISSED_ALL", "PARTIAL_MATCH", "CORRECT_SINGLETON"]
    assert rows["e"]["f05"] == 1 and rows["b"]["f05"] == 0
    assert round(rows["d"]["f05"], 4) == 0.5556


def test_precision_weighs_more(spark):
    f = lambda tp, fp, fn: spark.range(1).select(M.entity_f05(F.lit(tp), F.lit(fp), F.lit(fn)).alias("x")).first()["x"]
    assert round(f(1, 0, 1), 4) == 0.8333 and round(f(1, 1, 0), 4) == 0.5556


def test_empty_grids(spark):
    empty = spark.createDataFrame([], "s1 long, probability double, label int")
    grid = M.macro_grid(empty)
    assert grid.count() == 76 and grid.agg({"score": "max"}).first()[0] == 0.0
    assert M.best_threshold(grid.limit(0)).first()["threshold"] == 0.5
    assert M.sweep(empty).count() == 101 and M.calibration(empty).count() == 6


def test_line_checks(spark):
    check = lambda *lines: {r["rule"]: r["n"] for r in V.check_lines(spark.createDataFrame(list(enumerate(lines, 1)), "number int, value string"), ("source1_entity_id", "matched_entity_ids")).collect()}
    assert check("Source1_Entity_Id\tmatched_entity_ids", "S1-1\t") == {}
    assert check("source1_entity_id,matched_entity_ids") == {"comma_separated": 1}
    assert check("id\tx", "bad", " ") == {"header": 1, "no_tab": 1}
    assert {r["rule"] for r in V.check_lines(spark.createDataFrame([], "number int, value string"), ("a", "b")).collect()} == {"empty_file"}


def test_feed_dialect(spark, tmp_path):
    path = tmp_path / "feed"
    path.mkdir()
    (path / "part.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\t"Q" & co\t<NULL>\n\nS2-2\tonly name\nS2-3\ta\tb\tc\n', encoding="utf-8")
    rows = {r["entity_id"]: r for r in I.read_feed(spark, str(path)).collect()}
    assert set(rows) == {"S2-1", "S2-3"}
    assert rows["S2-1"]["business_name"] == '"Q" & co' and rows["S2-1"]["business_address"] == "<NULL>" and rows["S2-1"]["country"] == ""
    assert set(r["entity_id"] for r in I.read_feed(spark, str(path), least_fields=1).collect()) == {"S2-1", "S2-2", "S2-3"}


def test_feeds_keep_the_order_of_their_lines(spark, tmp_path):
    one, two = tmp_path / "one.tsv", tmp_path / "two"
    two.mkdir()
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    one.write_text(head + "".join(f"S2-{i}\tn{i}\ta\tin\n" for i in range(500, 0, -1)) + "S2-x\tshort\n", encoding="utf-8")
    for k in range(3):
        (two / f"part-0000{k}.tsv").write_text(head + "".join(f"S3-{k}{i}\tn\ta\tin\n" for i in (3, 1, 2)), encoding="utf-8")
    (two / "part-00003.tsv").write_bytes(b"S3-9\tbad \xff byte\ta\tin\n")
    want = [f"S2-{i}" for i in range(500, 0, -1)] + [f"S3-{k}{i}" for k in range(3) for i in (3, 1, 2)] + ["S3-9"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # many splits
    try:
        rows = I.read_feeds(spark, [str(one), str(two)]).orderBy("ord").collect()
        assert [r["entity_id"] for r in rows] == want and [r["ord"] for r in rows] == list(range(len(want)))
        assert rows[-1]["business_name"] == "bad \ufffd byte" and rows[0]["feed"] == "S2" and rows[-1]["feed"] == "S3"
        ids = lambda **o: [r["entity_id"] for r in I.read_feeds(spark, [str(one), str(two)], **o).orderBy("ord").collect()]
        assert ids(limit=502) == want[:502] and ids(limit_each=2) == ["S2-500", "S2-499", "S3-03", "S3-01"] and ids(limit_each=2, limit=3) == ["S2-500", "S2-499", "S3-03"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.warns(UserWarning, match="no such feed"):
        assert I.read_feeds(spark, [str(tmp_path / "none")]).count() == 0
    with pytest.raises(FileNotFoundError):
        I.read_feeds(spark, [str(tmp_path / "none")], required=True)


def feed_files(tmp_path, **rows):
    for name, lines in rows.items():
        (tmp_path / f"{name}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(x) + "\n" for x in lines), encoding="utf-8")
    return [str(tmp_path / f"{name}.tsv") for name in rows]


@pytest.mark.parametrize("blocker", ["multi", "scalable", "batch", "single_file"])
def test_from_feed_files_to_result_files(spark, tmp_path, blocker):
    s1, s2, s3 = feed_files(
        tmp_path, s1=[("S1-9", "Acme Tools Ltd", "12 Harbour Road", "IN"), ("S1-2", "Nowhere Matched", "x", "US"), ("S1-5", "Zeta Group", "9 Garden Lane 560001", "US"), ("S1-3", "", "", "")],
        s2=[("S2-7", "ACME tools", "12 harbour rd", "in"), ("S2-1", "Acme Bakery", "1 Hill St", "in")], s3=[("S3-4", "Zeta Corp", "9 garden ln 560001", "us"), ("S3-1", "ACME TOOLS", "12 harbour road", "in")],
    )
    out = str(tmp_path / "out")
    summary = R.match_files(spark, s1, [s2, s3], out, blocker=blocker).first()
    page = results(spark, f"{out}/{R.MATCHING}", f"{out}/{R.CANDIDATES}").collect()
    assert [r[B.S1] for r in page] == ["S1-9", "S1-2", "S1-5", "S1-3"]  # the order of the file
    assert [r["matched_ids"] for r in page] == [["S2-7", "S3-1"], [], ["S3-4"], []] and [r["is_singleton"] for r in page] == [False, True, False, True]
    assert all(r["candidate_count"] >= 1 and set(r["matched_ids"]) <= set(r["candidate_ids"]) for r in page)
    assert (summary["total_s1"], summary["matched_s1"], summary["total_matches"]) == (4, 2, 3)
    assert spark.read.text(f"{out}/{R.CHECKS}").count() == 0
    assert [r[B.S1] for r in results(spark, f"{out}/{R.MATCHING}", str(tmp_path / "no"), 1, 2).collect()] == ["S1-2", "S1-5"]
    sampled = R.match_files(spark, s1, [s2, s3], str(tmp_path / "few"), blocker=blocker, sample=1).first()
    assert (sampled["total_s1"], sampled["matched_s1"]) == (1, 1)
    with pytest.raises(FileNotFoundError):
        results(spark, str(tmp_path / "no"), f"{out}/{R.CANDIDATES}")


def test_a_record_without_candidate_is_written_down(spark, tmp_path):
    s1, s2 = feed_files(tmp_path, s1=[("S1-2", "b", "x", "US"), ("S1-1", "a", "x", "US")], s2=[])
    with pytest.raises(AssertionError, match="S1-1"):
        R.match_files(spark, s1, [s2], str(tmp_path / "out"), blocker="batch")
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out" / R.MISSING)).collect()] == [B.S1, "S1-1", "S1-2"]


def test_checks_of_files(spark, tmp_path):
    (tmp_path / "m.tsv").write_text(f"{B.S1}\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\t\nbad line\n", encoding="utf-8")
    (tmp_path / "c.tsv").write_text(f"{B.S1},candidate_entity_ids\nS1-1,S2-2\n", encoding="utf-8")
    need = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    rules = lambda m, c: {(r["file"], r["rule"]) for r in V.check_files(spark, str(tmp_path / m), str(tmp_path / c), need).collect()}
    found = rules("m.tsv", "c.tsv")
    assert {("matching", "no_tab"), ("matching", "duplicate_id"), ("matching", "duplicate_row"), ("matching", "missing_s1"), ("candidates", "comma_separated"), ("both", "not_in_candidates")} <= found
    assert rules("m.tsv", "none.tsv") == {("candidates", "missing_file"), ("matching", "no_tab")}


def test_partial_similarity_against_all_windows():
    draw = random.Random(4)
    for _ in range(300):
        a, b = ("".join(draw.choice("abc d") for _ in range(draw.randint(0, 12))) for _ in range(2))
        x, y = sorted((a, b), key=len)
        every = lambda x, y: max((S.indel(x, y[max(0, i) : i + len(x)]) for i in range(1 - len(x), len(y))), default=0.0)
        want = (1.0 if not y else 0.0) if not x else max(every(x, y), every(y, x) if len(x) == len(y) else 0.0)
        assert S.partial(a, b) == (1.0 if x and x in y else want), (a, b)


def test_broken_provenance_is_skipped(spark):
    rows = spark.createDataFrame([("S1-1", "not json"), ("S1-2", '[{"target_id":"S2-1","block_type":"x","blocking_key":"k","score":0.5}]')], f"{B.S1} string, provenance string")
    assert pairs(I.explode_provenance(rows)) == {("S1-2", "S2-1")}


def test_serving(spark):
    same = {"business_name": "Acme Ltd", "business_address": "1 Hill Road", "country": "in"}
    assert match_records(spark, same, same)["is_match"]
    assert not match_records(spark, same, {"business_name": "Zeta"})["is_match"]


def test_reports(spark, tmp_path):
    from kinfold.sources import reports as R

    rows = spark.createDataFrame([(1, 0.5)], "n long, share double")
    R.write_json(rows, str(tmp_path / "j"))
    assert R.read_json(spark, str(tmp_path / "j")) == {"n": 1, "share": 0.5}
    assert R.summary(rows) == "n: 1\nshare: 0.500000" and R.summary(rows.limit(0)) == ""
    R.write_summary(spark, rows, str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 2
