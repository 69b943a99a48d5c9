"""Small fixtures that every operator has to survive."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, key long, bands string, pos int, size int"

#: doc_id, text: nulls, blanks, repeats, ties, odd characters.
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, ""), (4, " \t\n"), (None, "no id here but some words to count"), (None, None),
    (5, "alpha beta gamma delta epsilon zeta eta theta"), (5, "alpha beta gamma delta epsilon zeta eta theta"), (6, "x"), (7, "É ñ ß 中文 \U0001f600 \x1c \xa0 end"),
]


def frame(spark, rows=ROWS):
    """Documents with extra columns whose names operators might use themselves."""
    return spark.createDataFrame([(i, t, None if i == 6 else "en", None if i == 1 else "s", 0, "x", 1, "y", 2, 3) for i, t in rows], SCHEMA)


def random_text(draw, n, vocabulary):
    return " ".join(draw.choice(vocabulary) for _ in range(n))


def classes(pairs, nodes):
    """Smallest node of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
