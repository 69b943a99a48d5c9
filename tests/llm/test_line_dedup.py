import random

from kinfold.llm import line_dedup as M

from .helpers import frame


def brute(docs):
    """Text left of each (doc_id, text), by the definition."""
    order = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0))
    seen, gone = set(), {}
    for doc in order:
        lines = (doc[1] or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.split()]
        drop = set()
        for k in range(max(len(full) - 2, min(len(full), 1))):
            window = tuple(" ".join(lines[i].split()) for i in full[k : k + 3])
            if window in seen:
                end = full[k + 3] if k + 3 < len(full) else len(lines)
                drop |= set(range(full[k], end))
            seen.add(window)
        gone[doc] = None if doc[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in drop)
    return gone


def test_against_brute_force(spark):
    draw = random.Random(5)
    docs = [(i, "\n".join(draw.choice(["a b", "c", " c ", "d  e", "", "f", "g"]) for _ in range(draw.randint(0, 14)))) for i in range(120)]
    want = brute(docs)
    got = {(r["doc_id"]): r["text"] for r in M.drop_repeated_lines(frame(spark, docs)).collect()}
    assert got == {k[0]: v for k, v in want.items()}
    assert any(want[d] != d[1] for d in docs)


def test_short_texts_are_one_window(spark):
    docs = [(1, "a b"), (2, "a  b\n"), (3, "a b\nc"), (4, "\na b\n\nc"), (5, "c"), (6, "a b\nc\nd"), (7, "a b\nc"), (8, ""), (9, " "), (10, None)]
    got = {r["doc_id"]: r["text"] for r in M.drop_repeated_lines(frame(spark, docs)).collect()}
    assert got == {**dict(docs), 2: "", 4: "", 7: ""}


def test_later_windows_reach_into_first_ones(spark):
    assert M.drop_repeated_lines(frame(spark, [(1, "A\nB\nA\nB\nA\nB")])).first()["text"] == "A\nB"


def test_edge_cases(spark):
    out = M.drop_repeated_lines(frame(spark))
    assert out.columns == frame(spark).columns and out.count() == 10
    assert sorted(str(r["text"]) for r in out.collect()) == sorted("" if r["doc_id"] == 5 else str(r["text"]) for r in frame(spark).collect())
    assert M.drop_repeated_lines(frame(spark, [])).count() == 0
    same = frame(spark, [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\na\nb\nc\ny")])
    assert sorted(r["text"] for r in M.drop_repeated_lines(same).collect()) == ["a\nb\nc", "a\nb\nc", "x\ny"]


def test_emptied_documents_go_on_request(spark):
    docs = frame(spark, [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, ""), (4, None)])
    assert sorted(r["doc_id"] for r in M.drop_repeated_lines(docs, drop_emptied=True).collect()) == [1, 3, 4]
    kept = {r["doc_id"]: r["n_chars"] for r in M.drop_repeated_lines(docs).collect()}
    assert kept == {1: 0, 2: 0, 3: 0, 4: 0}


def test_long_document(spark):
    text = "\n".join(["a", "b", "c"] * 20_000)
    row = M.drop_repeated_lines(frame(spark, [(1, text)])).first()
    assert row["text"] == "a\nb\nc\na\nb" or row["text"].startswith("a\nb\nc")
