import random

from kinfold.llm import quality as M

from .helpers import frame


def brute(text):
    words = [w for w in _split(text or "") if w]
    n = len(words)
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if any(_split(x)) and x in lines[:i])
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def _split(text):
    out = [""]
    for c in text:
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            out.append("")
        else:
            out[-1] += c
    return out


def test_counts_against_brute_force():
    draw = random.Random(2)
    for _ in range(400):
        text = "".join(draw.choice(["a", "b", "ab", " ", "  ", "\n", "\t", "#", "é", "\x1c", "\xa0", "a b a b"]) for _ in range(draw.randint(0, 40)))
        assert M.text_counts(text) == brute(text), repr(text)


def letters(n):
    return "".join(chr(97 + int(d)) for d in str(n))


def test_boilerplate_and_depletion(spark):
    body = lambda i: " ".join(f"w{letters(i)}x{letters(k)}" for k in range(60))
    common = " ".join(f"c{letters(k)}" for k in range(300))
    docs = [(i, f"{body(i)}\n{common}" if i < 32 else body(i)) for i in range(60)]
    rows = {r["doc_id"]: r for r in M.quality(frame(spark, docs)).collect()}
    assert rows[0]["removed_words"] == 0 and rows[0]["kept"]  # the first document keeps its lines
    assert rows[1]["removed_words"] == 0 and rows[1]["kept"]  # its host has no other document
    assert all(rows[i]["removed_words"] == 300 and not rows[i]["kept"] and not rows[i]["base_failed"] for i in range(2, 32))
    assert all(rows[i]["kept"] and rows[i]["removed_words"] == 0 for i in range(32, 60))


def test_limits(spark):
    common = " ".join(f"c{letters(k)}" for k in range(300))
    host = lambda n, shared: [(i, f"{letters(i)} own line" + (f"\n{common}" if i < 2 + shared else "")) for i in range(2, 2 + n)]
    removed = lambda docs: sum(r["removed_words"] > 0 for r in M.quality(frame(spark, docs)).collect())
    assert removed(host(100, M.MAX_DOCS - 1)) == 0 and removed(host(100, M.MAX_DOCS)) == M.MAX_DOCS - 1
    assert removed(host(500, 30)) == 29  # 6 % of the host: the limit does not grow with it
    assert removed(host(8, M.MIN_DOCS)) == M.MIN_DOCS - 1 and removed(host(10, M.MIN_DOCS)) == 0 and removed(host(4, 4)) == 0


def test_documents_without_or_with_shared_ids(spark):
    foot = "terms and conditions of this site\n"
    texts = [f"{foot}{letters(i)} own words" for i in range(60)]
    lost = lambda rows: sorted(r["removed_words"] for r in M.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    want = [0] + [6] * 59
    assert lost([(i, t, "s") for i, t in enumerate(texts)]) == lost([(None, t, "s") for t in texts]) == lost([(7, t, "s") for t in texts]) == want
    # The same id and text in two hosts are two documents.
    two = [(i, t, "s") for i, t in enumerate(texts)] + [(5, texts[5], "other")]
    assert lost(two) == [0, *want]
    assert lost([(i, t, "s") for i, t in enumerate(texts)] + [(5, texts[5], "s")] * 2) == want + [6, 6]


def test_depleted_documents_go_and_the_others_lose_their_lines(spark):
    common = " ".join(f"c{letters(k)}" for k in range(70))
    body = lambda i, n: " ".join(f"w{letters(i)}x{letters(k)}" for k in range(n))
    docs = [(i, f"{body(i, 60 if i % 2 else 80)}\n{common}") for i in range(2, 60)] + [(100, body(100, 60)), (101, None)]
    rows = {r["doc_id"]: r for r in M.keep_good(frame(spark, docs)).collect()}
    assert set(rows) == {2, 100} | set(range(4, 60, 2)) and M.keep_good(frame(spark, docs)).columns == frame(spark).columns
    assert rows[2]["text"] == docs[0][1] and all(rows[i]["text"] == body(i, 80) and rows[i]["n_chars"] == len(body(i, 80)) for i in range(4, 60, 2))


def test_copies_are_one_document(spark):
    text = " ".join(f"u{k}" for k in range(80))
    rows = M.quality(frame(spark, [(i, text) for i in range(100)])).collect()
    assert all(r["kept"] and r["removed_words"] == 0 for r in rows)


def test_edge_cases(spark):
    rows = M.quality(frame(spark)).collect()
    assert len(rows) == 10 and all(r["base_failed"] and not r["kept"] for r in rows)
    assert M.quality(frame(spark, [])).count() == 0
    assert M.keep_good(frame(spark)).columns == frame(spark).columns
    assert M.text_counts("a b c " * 50_000)[4] == 150_000


def test_text_without_boilerplate(spark):
    docs = [(i, f"{letters(i)} own line\n\nShared  LINE {i}") for i in range(2, 60)] + [(100, None), (101, "")]
    out = M.without_boilerplate(frame(spark, docs))
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    assert rows[2] == docs[0][1] and rows[3] == "d own line\n" and rows[100] is None and rows[101] == "" and out.columns == frame(spark).columns
