from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions import similarity as S
from kinfold.functions import text as T


def one(spark, column, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first()["x"]


def test_norm_text(spark):
    cases = {None: "", "": "", "Smith & Sons, Ltd.": "smith and sons ltd", "  A--B  ": "a b", "Zürich": "z rich", "&": "and"}
    for raw, want in cases.items():
        assert one(spark, T.norm_text(F.col("a")), a=raw) == want


def test_norm_name_and_address(spark):
    assert one(spark, T.norm_name(F.col("a")), a="Acme Holdings Inc.") == "acme"
    assert one(spark, T.norm_name(F.col("a")), a="Ltd") == ""
    assert one(spark, T.norm_address(F.col("a")), a="12 Main St, Opp. Park Rd") == "12 main street opposite park road"
    assert one(spark, T.norm_address_sequential(F.col("a")), a="a rd rd b") == "a road rd b"


def test_tokens_and_keys(spark):
    assert one(spark, T.tokens(F.col("a")), a="b a b") == ["a", "b"]
    assert one(spark, T.tokens(F.col("a")), a="") == []
    assert one(spark, T.postal_codes(F.col("a")), a="x 12345 y 654321 1234567 12345") == ["12345", "654321"]
    assert one(spark, T.first_postal(F.col("a")), a="none") == ""
    assert one(spark, T.char_grams(F.col("a")), a="ab") == [" ab", "ab "]
    assert one(spark, T.char_grams(F.col("a")), a="") == []
    assert one(spark, T.prefix_key(F.col("a")), a="ab") is None
    assert one(spark, T.key_token(T.tokens(F.col("a"))), a="bbbbb aaaaa cc") == "aaaaa"
    assert one(spark, T.parse_ids(F.col("a")), a=" S2-1,, S3-2 ,S2-1") == ["S2-1", "S3-2", "S2-1"]
    assert one(spark, T.feed_of(F.col("a")), a="X-1") == "other"


def lcs_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abcd ", max_size=12))
def test_similarities(a, b):
    assert S.lcs(a, b) == lcs_by_table(a, b)
    for f in (S.indel, S.weighted, S.partial, S.token_sort, S.token_set, S.partial_token):
        assert 0 <= f(a, b) <= 1
        assert abs(f(a, b) - f(b, a)) < 1e-12
    assert S.indel(a, a) == 1
    assert S.weighted(a, a) == (1 if a else 0)


def test_weighted_branches():
    assert S.weighted("", "a") == 0
    assert S.weighted("acme tools", "tools acme") == 0.95  # same words in another order
    assert S.weighted("acme", "acme international trading") == 0.9  # contained
    assert S.weighted("ab", "ab" + "x" * 18) == 0.6  # lengths differ by more than eight times
    assert abs(S.weighted("abcdefgh", "abcdefgx") - 14 / 16) < 1e-12


def test_containment_and_overlap(spark):
    df = spark.createDataFrame([("ab", "xaby"), ("xaby", "ab"), ("", "ab"), ("ab", "ba")], "a string, b string")
    got = [r["x"] for r in df.select(S.containment(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [0.5, 0.5, 0.0, 0.0]
    sets = spark.createDataFrame([(["a", "b"], ["b", "c", "d"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [tuple(r) for r in sets.select(S.jaccard(F.col("a"), F.col("b")), S.overlap(F.col("a"), F.col("b"))).collect()] == [(0.25, 0.5), (0.0, 0.0)]
