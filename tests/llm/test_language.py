import random
import zlib

import numpy as np

from kinfold.llm import language as M

from .helpers import frame


def corpus(n=600):
    draw = random.Random(3)
    syllables = {"en": ["the", "ing", "wh", "th"], "fr": ["é", "eau", "oi", "ç"], "de": ["sch", "ü", "ung", "ß"]}
    rows = []
    for i in range(n):
        lang = draw.choice(sorted(syllables))
        text = " ".join("".join(draw.choice(syllables[lang]) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(2, 40)))
        rows.append((i, text, lang))
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "s", "clash") for r in rows], "doc_id long, text string, lang string, source string, score string")


def test_held_out_accuracy_and_calibration(spark):
    rows = corpus()
    got = M.identify(docs_of(spark, rows)).collect()
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    right = np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held])
    assert right > 0.97 and abs(np.mean([r["score"] for r in held]) - right) < 0.06
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_rows_and_other_columns_do_not_teach(spark):
    rows = corpus(300)
    lies = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    one, two = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in M.identify(docs_of(spark, x)).collect()} for x in (rows, lies))
    assert one == two


def test_edge_cases(spark):
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 !? 4", "en"), (None, "thethe the", "en"), (1003, "the " * 50_000, None), (1003, "the " * 50_000, None)]
    got = M.identify(docs_of(spark, corpus(200) + odd)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[i][0]["lang_pred"] == "und" and by[i][0]["score"] == 0 for i in (1000, 1001, 1002))
    assert by[None][0]["held_out"] is False and by[None][0]["lang_pred"] == "en"
    assert len(by[1003]) == 2 and by[1003][0]["lang_pred"] == "en"
    assert M.identify(docs_of(spark, [])).count() == 0
    alone = M.identify(docs_of(spark, [(1, "words", None), (None, "x y", "en")])).collect()
    assert {r["lang_pred"] for r in alone} == {"und"}
    assert M.identify(frame(spark)).count() == 10


def test_weights_are_sparse():
    idf = np.ones(1 << M.BITS)
    model = M.fit([(lang, text) for _, text, lang in corpus(300)], idf)
    assert model.languages == ["de", "en", "fr"] and model.heat > 0
    assert len(model.weights) < 0.05 * len(idf) and (model.row > 0).sum() == len(model.weights) - 1


def test_numerals_are_no_letters():
    assert all(not len(M.buckets(t)) for t in ("½ ² ①", "Ⅷ ⅳ", "12_3", "٣", "")) and len(M.buckets("一")) and len(M.buckets("ª"))


def test_every_language_is_a_class(spark):
    draw = random.Random(9)
    words = {f"l{k}": "".join(chr(0x4E00 + draw.randrange(5000)) for _ in range(6)) for k in range(1100)}
    rows = [(i, f"{words[lang]} {words[lang]}", lang) for i, lang in enumerate(x for x in words for _ in range(4))]
    got = M.identify(docs_of(spark, rows)).collect()
    taught = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert len(taught) > 1050 and taught - {r["lang_pred"] for r in got} == set()
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]][2] for r in got]) > 0.95


def test_held_out_accuracy_on_the_table(spark):
    from kinfold.llm import queries

    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in queries.QUERIES["op4_language"](spark, folder).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert len(held) > 200 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
