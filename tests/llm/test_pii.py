import hashlib
import random
import re

from kinfold.llm import pii as M

from .helpers import frame


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, ok in (
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda d: 13 <= len(d) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda d: 9 <= len(d) <= 15),
    ):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if ok(re.sub("[^0-9]", "", m[0]))]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_base_spans_against_brute_force(spark):
    draw = random.Random(7)
    parts = ["1", "2", "55", "255", "256", "0005", ".", ".", "@", "a", "b-", "_", " ", "-", "+", "(", ")", "é", "\n", "\U0001f600", "4111111111111111", "a@b.c", "192.168.1.1", "+49 30 1234567", "(at)", "[dot]"]
    docs = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))) for i in range(800)]
    docs += [(5000 + i, t) for i, t in enumerate(["a" * 100_000, "1" * 100_000, "1." * 30_000, "+1 " * 30_000, "x@" * 30_000, "a@b.c_x@y.z 1.2.3.4.5.6.7.8"])]
    rows = {r["doc_id"]: r for r in M.find_pii(frame(spark, docs)).collect()}
    for doc_id, text in docs:
        want = brute(text)
        r = rows[doc_id]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (text[:200], want, r["spans"])
        assert [r[f"n_{k}"] for k in M.BASE] == [sum(x.startswith(f"{k}:") for x in want.split(",")) for k in M.BASE]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("ml_")] == [x for x in want.split(",") if x]


def people(n=400):
    """Cards and phones, alone, broken, and side by side, where a base match swallows both and fails."""
    draw = random.Random(2)

    def card(good):
        while True:
            digits = "".join(str(draw.randrange(1, 10)) for _ in range(16))
            if luhn(digits) == good:
                return digits

    phone = lambda: f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
    docs = []
    for i in range(n):
        first, second = card(True), card(i % 20 != 5)
        shapes = [f"pay with {first} today", f"order {card(False)} came", f"call {phone()} now", f"cards {first} {second} both", f"call {phone()} {first} then", f"id x{card(i % 3 == 0)}z end"]
        docs.append((i, shapes[i % 6] if i % 6 < 3 or i % 5 == 0 else shapes[i % 3]))
    return docs


def test_trees_add_what_failed_matches_swallow(spark):
    docs = people()
    rows = {r["doc_id"]: r for r in M.find_pii(frame(spark, docs)).collect()}
    for i, text in docs:
        added = {text[int(a) : int(b)] for k, a, b in (x.split(":") for x in rows[i]["spans"].split(",") if x) if k.startswith("ml_")}
        assert rows[i]["n_spans"] == len([x for x in rows[i]["spans"].split(",") if x])
        if brute(text):
            continue
        cards = {m[0] for m in re.finditer(r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", text) if luhn(m[0])}
        phones = set(re.findall(r"\+1 \([0-9]{3}\) 555-[0-9]{4}", text))
        assert added == (cards | phones if not text.startswith(("order", "id")) else set()), text


def test_selection_against_brute_force(spark):
    """Labels, thresholds on held-out proposals and the choice, from the model's scores alone."""
    keyed = frame(spark, people(200)).withColumns({M.ID: M.F.col("doc_id"), M.TEXT_HASH: M.text_key()})
    found = M.cut(M.with_labels(M.with_rules(M.candidates(keyed.select(M.ID, M.TEXT_HASH, "text")))))
    rows = [r.asDict() for r in found.collect()]
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r[M.ID], []).append(r)
    for group in by_doc.values():
        base = [(r["start"], r["end"]) for r in group if r["base"]]
        failed = {(r["start"], r["end"]) for r in group if r["gen"] in M.BASE and not r["base"]}
        for r in group:
            span = (r["start"], r["end"])
            free = not any(a < span[1] and span[0] < b for a, b in base)
            glued = r["left"][-1:].isalnum() or r["right"][:1].isalnum()
            want = None if r["gen"] in M.BASE else 1.0 if span in base else 0.0 if free and (span in failed or glued) else None
            assert (r["free"], r["label"]) == (free, want)
    model = M.train(found, 20_000, 0.95, 3)
    assert set(model.thresholds) <= set(M.GENERATORS) and all(0.5 <= p <= 1 for p in model.thresholds.values())
    want = set()
    scored = [r.asDict() for r in model.score(found.where(M.F.col("gen").isin(*M.GENERATORS))).collect()]
    chosen = [r for r in scored if r["free"] and r["p"] >= model.thresholds.get(r["gen"], 2)]
    for r in chosen:
        inside = [x for x in chosen if x[M.ID] == r[M.ID] and x is not r and x["start"] <= r["start"] and r["end"] <= x["end"]]
        if not any((x["start"], -x["end"], x["gen"]) < (r["start"], -r["end"], r["gen"]) for x in inside):
            want.add((r[M.ID], f"ml_{r['gen']}", r["start"], r["end"]))
    want |= {(r[M.ID], r["gen"], r["start"], r["end"]) for r in rows if r["base"]}
    got = {tuple(r) for r in M.selected(found, 20_000, 0.95, 3).select(M.ID, "kind", "start", "end").collect()}
    assert got == want and any(k.startswith("ml_") for _, k, *_ in want)


def test_all_labelled_proposals_count(spark):
    """24000 proposals of one generator, and others of a second one that all come after 20000 of them in the order of the hash."""
    F = M.F
    place = F.xxhash64("m", "left", "right", "gen")
    made = lambda n, gen, m, left: spark.range(n).select(F.lit(gen).alias("gen"), m.alias("m"), left.alias("left"), F.lit("").alias("right"), F.col("id"))
    good = F.col("id") % 2 == 0
    many = made(24_000, "digits", F.format_string("4%015d", "id"), F.lit("no "))
    late = many.select(place.alias("place")).orderBy("place").collect()[20_000]["place"]
    few = made(3000, "local", F.format_string("555-201-%04d", "id"), F.when(good, "tel ").otherwise("x"))
    rows = many.unionByName(few.where(place > late)).withColumns(
        {"n_digits": F.when(F.col("gen") == "digits", 16).otherwise(10), "luhn": (F.col("gen") == "digits") & good, "quad": F.lit(False), "label": good.cast("double")}
    )
    model = M.train(rows.drop("id"), M.SAMPLE_ROWS, M.PRECISION, M.LEAST)
    assert set(model.thresholds) == {"digits", "local"}


def test_model_does_not_depend_on_the_layout(spark):
    one, two = (sorted(map(tuple, M.find_pii(frame(spark, people()).repartition(n)).collect())) for n in (1, 7))
    assert one == two


def test_edge_cases(spark):
    rows = M.find_pii(frame(spark)).collect()
    assert len(rows) == 10 and all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert M.find_pii(frame(spark, [])).count() == 0
    twice = M.find_pii(frame(spark, [(1, "a@b.cd x@y.zz"), (1, "a@b.cd x@y.zz"), (None, "a@b.cd")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_email"]) for r in twice) == [(0, 1), (1, 2), (1, 2)]


def test_redaction(spark):
    docs = [(1, "é a@b.cd and +49 30 1234567 8901 end 1.2.3.4"), (2, None), (3, "none")]
    out = M.redact(frame(spark, docs))
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    assert rows == {1: "é [email] and [phone] end [ip]", 2: None, 3: "none"} and out.columns == frame(spark).columns
