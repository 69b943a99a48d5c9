import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinfold.llm import bpe as M

from .helpers import ROWS, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    draw = random.Random(4)
    alphabet = ["a", "B", "1", " ", "  ", "\n", "\t", "'s", "'ll", "!", "é", "ª", "\x1c", "\x85", "\xa0", "中", "\U0001f600", "<|endoftext|>", "ȡ", "՘", "word", "؀"]
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30))) for _ in range(300)]


def test_ids_and_text_equal_the_library(spark, library):
    docs = list(enumerate(texts())) + [(1000 + i, t) for i, (_, t) in enumerate(ROWS)]
    rows = {r["doc_id"]: r for r in M.encode_decode(frame(spark, docs).repartition(3), PATH, full=True, chunk_chars=500).collect()}
    digests = {r["doc_id"]: r for r in M.encode_decode(frame(spark, docs), PATH, table_words=50).collect()}
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[doc_id]["ids"] == ids and rows[doc_id]["decoded"] == decoded
        assert digests[doc_id]["n_tokens"] == len(ids)
        assert digests[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[doc_id]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_repeats_nulls_and_empty_tables(spark):
    rows = M.encode_decode(frame(spark), PATH).collect()
    assert len(rows) == 10 and sum(r["doc_id"] is None for r in rows) == 2 and sum(r["doc_id"] == 5 for r in rows) == 2
    assert M.encode_decode(frame(spark, []), PATH).count() == 0


def test_a_chunk_without_its_rows_is_encoded_in_place(library):
    import numpy as np
    import pyarrow as pa

    text = "some words, other words"
    words = M.Vocabulary.at(PATH).words(text)
    distinct = list(dict.fromkeys(words))
    payload = M._chunk_payload([1], [np.array([distinct.index(w) for w in words], np.int32)], distinct)
    chunk = pa.table({"payload": pa.array([payload], pa.binary())})
    none = pa.table({"chunk": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
    assert M._place(PATH, 4, True)(chunk, none).to_pylist()[0]["ids"] == library.encode(text, add_special_tokens=False).ids
    assert M._place(PATH, 4, False)(chunk, none).to_pylist()[0]["n_in_place"] == len(distinct)


def test_texts_are_split_once_and_words_find_their_rows(spark, tmp_path):
    frame(spark, list(enumerate(texts()))).select("doc_id", "text").write.parquet(str(tmp_path / "d"))
    out = M.encode_decode(spark.read.parquet(str(tmp_path / "d")), PATH, chunk_chars=300)
    assert out.agg({"n_in_place": "sum"}).first()[0] == 0
    out.write.format("noop").mode("overwrite").save()
    query = out._jdf.queryExecution()
    out.collect()
    assert "ReusedExchange" in query.executedPlan().toString()


def test_keys_go_to_their_partitions(spark):
    for n in (1, 4, 12, 211):
        want = [r[0] for r in spark.range(500).selectExpr(f"pmod(hash(id * 7919000017 - 3000000), {n})").collect()]
        assert [M.partition_of(i * 7919000017 - 3000000, n) for i in range(500)] == want
        keys = M.bucket_keys(n)
        assert [M.partition_of(k, n) for k in keys] == list(range(n)) and all(k < M.CHUNK_BIT for k in keys)
        key = M.chunk_key(123456789, 0.5, n)
        assert key & M.CHUNK_BIT and key < 2**63 and M.partition_of(key, n) == n // 2


def test_a_very_long_text_is_a_chunk_of_its_own(spark, library):
    long = "".join(f"w{k} " for k in range(60_000))
    rows = {r["doc_id"]: r for r in M.encode_decode(frame(spark, [(1, long), (2, "short"), (3, long)]), PATH, full=True, chunk_chars=1000).collect()}
    ids = library.encode(long, add_special_tokens=False).ids
    assert rows[1]["ids"] == rows[3]["ids"] == ids and rows[1]["decoded"] == long and rows[2]["decoded"] == "short"
