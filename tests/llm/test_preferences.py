import hashlib

import pytest

from kinfold.llm import preferences as M
from kinfold.llm import queries

from ..conftest import DATA, same_rows

SCHEMA = "conv_id long, turn long, role string, text string, chosen string, pair long"


def conversations(spark, rows):
    return M.turns_of(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))


def made(turns):
    return {r["chosen_id"]: r for r in M.formatted(M.with_other_answers(M.conversations_of(turns))).collect()}


def test_prefix_completions_and_masks(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "good é"), (2, 3, "assistant", "bad"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "more")]
    turns = conversations(spark, rows)
    pairs = spark.createDataFrame([(1, 2), (2, 9)], "chosen_id long, rejected_id long")
    row, lost = sorted(M.format_pairs(pairs, turns).collect())
    assert (row["chosen_id"], row["rejected_id"], row["n_common"], row["usable"]) == (1, 2, 3, True)
    assert row["prompt"] == "<|user|>\nq\n<|assistant|>\na\n<|user|>\nmore\n"
    assert row["chosen"] == "<|assistant|>\ngood é\n" and row["rejected"] == "<|assistant|>\nbad\n"
    for side, want in (("chosen", "good é"), ("rejected", "bad")):
        a, b = map(int, row[f"{side}_mask"].split(":"))
        assert row[side][a:b] == want
    assert (lost["n_common"], lost["rejected"], lost["usable"]) == (0, "", False)


def test_every_conversation_gets_the_next_ones_answer(spark):
    rows = [(i, k, "user" if k % 2 == 0 else "assistant", f"t{i}.{k}") for i in range(40) for k in range(2 + i % 5)]
    got = made(conversations(spark, rows))
    order = sorted(range(40), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    for place, i in enumerate(order):
        other, n = order[(place + 1) % 40], 2 + i % 5
        last, answer = n - 1 - n % 2, 1 + (other % 5) // 2 * 2
        assert got[i]["rejected_id"] == other and got[i]["n_common"] == last and got[i]["usable"]
        assert got[i]["chosen"].startswith(f"<|assistant|>\nt{i}.{last}\n") and got[i]["rejected"].startswith(f"<|assistant|>\nt{other}.{answer}\n")
        assert got[i]["prompt"] == "".join(f"<|{'user' if k % 2 == 0 else 'assistant'}|>\nt{i}.{k}\n" for k in range(last))


def test_most_conversations_of_the_table_are_usable(spark):
    rows = queries.QUERIES["op7_preferences"](spark, "/root/testdata/sf0.01").select("n_common", "usable").collect()
    assert sum(r["n_common"] >= 1 for r in rows) > 0.9 * len(rows) and sum(r["usable"] for r in rows) > 0.9 * len(rows)


def test_edge_cases(spark):
    rows = [(1, 0, None, None), (2, 0, "assistant", "first"), (None, 0, "user", "x"), (3, None, "user", "y"), (3, 0, "assistant", ""), (3, 0, "assistant", ""), (4, 0, "user", "z"), (4, 1, "assistant", "w " * 100_000)]
    got = made(conversations(spark, rows))
    assert set(got) == {1, 2, 3, 4}
    assert got[1]["rejected_id"] is None and got[1]["prompt"] == got[1]["rejected"] == "" and got[1]["chosen"] == "<|user|>\n\n" and not got[1]["usable"]
    assert got[2]["n_common"] == 0 and not got[2]["usable"]  # nothing in common: no prompt
    assert got[3]["n_common"] == 2 and got[3]["chosen_mask"] == "14:14"
    assert len(got[4]["chosen"]) == 200_000 + len("<|assistant|>\n\n")
    assert made(conversations(spark, [])) == {}
    alone = made(conversations(spark, [(5, 0, "user", "q"), (5, 1, "assistant", "a")]))[5]
    assert (alone["rejected_id"], alone["n_common"], alone["usable"], alone["chosen"]) == (5, 2, False, "")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_oracle(spark, duck, name):
    same_rows(queries.QUERIES[name](spark, DATA).toPandas(), duck.sql(queries.ORACLE[name]).df())
