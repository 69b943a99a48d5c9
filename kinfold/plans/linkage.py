"""Record-linkage queries over the standard tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking as B
from ..operators import features as X
from ..operators.prepare import prepare
from ..sources import adapters as A
from ..sources import feeds as I
from . import sql as Q

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
S1, TARGET = B.S1, B.TARGET


def query(oracle: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sides(spark: SparkSession, sf_dir: str, source=A.records, settle: bool = False) -> tuple[DataFrame, DataFrame]:
    """Prepared reference and target records; `settle` writes them once, for plans of several blocks."""
    rows = prepare(source(spark, sf_dir))
    rows = I.settled(rows, "prepared") if settle else rows
    return A.feed(rows, "S1"), A.feed(rows, "S2", "S3")


_BASE = (Q.RECORDS, Q.PREPARED)
_joined = lambda a: f"coalesce(array_to_string({a}, ' '), '')"

# --- normalisation and token functions ------------------------------------------------------------------------------------


@query(
    _with(*_BASE)
    + f"SELECT entity_id, feed, name_n, addr_n, country_n, {_joined('name_tokens')} AS name_tokens, {_joined('addr_tokens')} AS addr_tokens FROM prepared"
)
def norm_records(spark, sf_dir):
    """Prepared records: normalised name, address, country and their words."""
    rows = prepare(A.records(spark, sf_dir))
    return rows.select("entity_id", "feed", "name_n", "addr_n", "country_n", F.array_join("name_tokens", " ").alias("name_tokens"), F.array_join("addr_tokens", " ").alias("addr_tokens"))


@query(
    _with(Q.RECORDS)
    + f"""SELECT entity_id, {Q.norm_text('business_name')} AS plain, {Q.norm_name('business_name', amp=False)} AS no_amp,
    {_joined(Q.by_length(f"list_distinct({Q.words(Q.norm_name('business_name', amp=False))})"))} AS name_key,
    trim(regexp_replace(lower(coalesce(business_name, '')), '\\s+', ' ', 'g')) AS cleaned,
    {Q.norm_name('business_name', legal=Q.C.LEGAL_FORMS_SHORT)} AS short_name,
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(' ' || {Q.norm_text('business_address')} || ' ',
      ' rd ', ' road '), ' st ', ' street '), ' ave ', ' avenue '), ' av ', ' avenue '), ' blvd ', ' boulevard '), ' hwy ', ' highway '),
      ' pvt ', ' private '), ' ltd ', ' limited '), '\\s+', ' ', 'g')) AS sequential_address FROM records"""
)
def norm_variants(spark, sf_dir):
    """The other normalisers: "&" dropped, longest word first, white space only, shorter word lists."""
    name, address = F.col("business_name"), F.col("business_address")
    return A.records(spark, sf_dir).select(
        "entity_id", T.norm_text(name).alias("plain"), T.norm_name(name, amp_as_and=False).alias("no_amp"), T.name_key(name).alias("name_key"),
        T.clean_text(name).alias("cleaned"), T.norm_name(name, Q.C.LEGAL_FORMS_SHORT).alias("short_name"), T.norm_address_sequential(address).alias("sequential_address"),
    )


@query(
    _with(*_BASE)
    + f"""SELECT entity_id, coalesce(array_to_string({Q.grams('name_n')}, '|'), '') AS padded, coalesce(array_to_string({Q.grams('name_n', 3, False)}, '|'), '') AS plain FROM prepared"""
)
def norm_char_grams(spark, sf_dir):
    """Character 3-grams, padded and not."""
    rows = prepare(A.records(spark, sf_dir))
    return rows.select("entity_id", F.array_join(T.char_grams(F.col("name_n")), "|").alias("padded"), F.array_join(T.char_grams(F.col("name_n"), 3, False), "|").alias("plain"))


@query(
    _with(*_BASE)
    + f"""SELECT entity_id, {_joined(Q.salient('name_tokens'))} AS salient, {Q.key_token('name_tokens')} AS key_token,
    CASE WHEN length(name_n) >= 3 THEN name_n[1:4] END AS prefix_key, {_joined(Q.address_words('addr_tokens'))} AS address_words,
    {_joined(Q.postal('addr_n'))} AS codes, {Q.first_postal('addr_n')} AS code FROM prepared"""
)
def norm_keys(spark, sf_dir):
    """Blocking keys: salient words, key word, prefix, address words, postal codes."""
    n, a = F.col("name_tokens"), F.col("addr_tokens")
    return prepare(A.records(spark, sf_dir)).select(
        "entity_id", F.array_join(T.salient(n), " ").alias("salient"), T.key_token(n).alias("key_token"), T.prefix_key(F.col("name_n")).alias("prefix_key"),
        F.array_join(T.address_words(a), " ").alias("address_words"), F.array_join(T.postal_codes(F.col("addr_n")), " ").alias("codes"), T.first_postal(F.col("addr_n")).alias("code"),
    )


@query(
    _with(Q.RECORDS, Q.TRUTH, Q.LISTS)
    + """SELECT source1_entity_id, array_to_string(list_filter(list_transform(string_split(matched_entity_ids || ', ,x', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS ids,
    source1_entity_id[1:2] AS feed FROM truth_lists"""
)
def id_lists(spark, sf_dir):
    """Parsing of comma lists with blanks, and the feed by prefix."""
    rows = A.truth_lists(spark, sf_dir)
    messy = T.parse_ids(F.concat("matched_entity_ids", F.lit(", ,x")))
    return rows.select(S1, F.array_join(messy, "|").alias("ids"), T.feed_of(F.col(S1)).alias("feed"))


# --- sources and sinks ------------------------------------------------------------------------------------------------------

_FLAT = "regexp_replace({}, '[\\t\\r\\n]+', ' ', 'g')"


def _flat(rows: DataFrame) -> DataFrame:
    """Records whose values fit on a line."""
    one = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\r\n]+", " ").alias(c)
    return rows.select("ord", "feed", one("entity_id"), one("business_name"), one("business_address"), one("country"))


@query(
    _with(Q.FILE_RECORDS)
    + f"SELECT ord - 1 AS ord, feed, entity_id, {_FLAT.format('business_name')} AS business_name, {_FLAT.format('business_address')} AS business_address, coalesce(country, '') AS country FROM records"
)
def source_feed_tsv(spark, sf_dir):
    """Feeds written as tab-separated files and read back without quoting, one after the other, in the order of their lines."""
    return I.read_feeds(spark, write_feed_files(spark, sf_dir))


def write_feed_files(spark, sf_dir) -> list[str]:
    """The three feeds as folders of part files; every feed in the order of ord."""
    rows, paths = I.settled(_flat(A.records(spark, sf_dir)), "flat"), []
    for name in ("S1", "S2", "S3"):
        paths.append(I.scratch(spark, f"feed-{name}"))
        I.write_tsv(A.feed(rows, name).orderBy("ord").select(*I.FEED_COLUMNS), paths[-1])
    return paths


@query(
    _with(Q.RECORDS)
    + f"""SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, feed, entity_id, {_FLAT.format('business_name')} AS business_name, '' AS business_address, '' AS country
FROM records WHERE feed = 'S1' ORDER BY ord LIMIT 50"""
)
def source_short_rows(spark, sf_dir):
    """Reference rows with missing fields are padded, and the first 50 rows of the file are taken."""
    path = I.scratch(spark, "short")
    I.write_tsv(A.feed(_flat(A.records(spark, sf_dir)), "S1").orderBy("ord").select("entity_id", "business_name"), path)
    return I.read_feed(spark, path, least_fields=1, limit=50)


@query(_with(Q.RECORDS, Q.TRUTH) + f"SELECT {Q.PAIRS} FROM truth")
def source_truth_lists(spark, sf_dir):
    """Ground truth written as id lists, read back and exploded."""
    path = I.scratch(spark, "truth")
    I.write_tsv(A.truth_lists(spark, sf_dir).select(S1, "matched_entity_ids"), path)
    return I.explode_lists(I.read_id_lists(spark, path, "matched_entity_ids"), "matched_entity_ids")


@query(
    _with(Q.RECORDS, Q.TRUTH)
    + """, wanted AS (SELECT DISTINCT cid FROM truth)
SELECT entity_id, feed FROM records WHERE feed <> 'S1' AND entity_id IN (SELECT cid FROM wanted)
UNION ALL SELECT entity_id, feed FROM (SELECT * FROM records WHERE feed <> 'S1' AND entity_id NOT IN (SELECT cid FROM wanted) ORDER BY ord LIMIT 100)"""
)
def source_selective(spark, sf_dir):
    """Targets that truth names, and the first 100 others as background."""
    rows = A.feed(A.records(spark, sf_dir), "S2", "S3")
    wanted = A.truth(spark, sf_dir).select(F.col(TARGET).alias("entity_id"))
    return I.selective(rows, wanted, 100).select("entity_id", "feed")


@query(
    _with(Q.RECORDS, Q.TRUTH, Q.LISTS)
    + """(SELECT source1_entity_id, matched_entity_ids FROM truth_lists WHERE matched_entity_ids <> '' ORDER BY ord LIMIT 30)
UNION ALL (SELECT source1_entity_id, matched_entity_ids FROM truth_lists WHERE matched_entity_ids = '' ORDER BY ord LIMIT 10)"""
)
def source_stratified_truth(spark, sf_dir):
    """A sample of 40 truth rows: three quarters with matches, the rest without."""
    return I.sample_truth(A.truth_lists(spark, sf_dir), 40).select(S1, "matched_entity_ids")


@query(
    _with(Q.RECORDS, Q.TRUTH)
    + f"""SELECT {Q.PAIRS}, a.business_name AS s1_name, b.business_name AS target_name, b.country AS target_country
FROM (SELECT * FROM truth JOIN records r ON r.entity_id = s1 ORDER BY r.ord, cid LIMIT 5) x JOIN records a ON a.entity_id = x.s1 JOIN records b ON b.entity_id = x.cid"""
)
def source_inspect(spark, sf_dir):
    """Five true pairs with the records of both sides."""
    r = A.records(spark, sf_dir)
    a = r.select(F.col("entity_id").alias(S1), F.col("ord").alias("o"), F.col("business_name").alias("s1_name"))
    b = r.select(F.col("entity_id").alias(TARGET), F.col("business_name").alias("target_name"), F.col("country").alias("target_country"))
    return A.truth(spark, sf_dir).join(a, S1).join(b, TARGET).orderBy("o", TARGET).limit(5).select(S1, TARGET, "s1_name", "target_name", "target_country")


_EXACT = Q.block("exact", "nullif(name_n, '')", "nullif(name_n, '')", 8, "exact_name")


@query(
    _with(*_BASE, _EXACT)
    + "SELECT q.entity_id AS source1_entity_id, coalesce(string_agg(cid, ',' ORDER BY cid), '') AS candidate_entity_ids FROM q LEFT JOIN exact ON s1 = q.entity_id GROUP BY q.entity_id"
)
def sink_lists(spark, sf_dir):
    """Candidates as one comma list per reference record, written and read back."""
    q, t = sides(spark, sf_dir)
    path = I.scratch(spark, "lists")
    I.write_tsv(I.id_lists(q, B.exact_name(q, t), "candidate_entity_ids"), path)
    return I.read_id_lists(spark, path, "candidate_entity_ids")


@query(_with(*_BASE, _EXACT) + f"SELECT {Q.PAIRS}, block_type, blocking_key, CAST(0.5 AS DOUBLE) AS score FROM exact")
def sink_provenance(spark, sf_dir):
    """Provenance as JSON lists in chunk files, consolidated into rows again."""
    q, t = sides(spark, sf_dir)
    path = I.scratch(spark, "chunks")
    I.provenance_rows(B.exact_name(q, t).withColumn("score", F.lit(0.5))).write.parquet(path)
    return I.explode_provenance(spark.read.parquet(path))


@query(_with(*_BASE, _EXACT) + "SELECT b.feed, s1 AS source1_entity_id, cid AS candidate_entity_id FROM exact JOIN t b ON b.entity_id = cid")
def sink_feed_chunks(spark, sf_dir):
    """Candidates partitioned by target feed."""
    from ..streaming.resume import write_feeds

    q, t = sides(spark, sf_dir)
    path = I.scratch(spark, "feeds")
    write_feeds(B.exact_name(q, t).select(S1, TARGET, T.feed_of(F.col(TARGET)).alias("feed")), path)
    return spark.read.parquet(path).select("feed", S1, TARGET)


# --- blocking ------------------------------------------------------------------------------------------------------------------


def _block(df: DataFrame) -> DataFrame:
    return df.select(S1, TARGET, "ord", "block_type", "blocking_key")


@query(_with(*_BASE, _EXACT) + f"SELECT {Q.BLOCK} FROM exact")
def block_exact_name(spark, sf_dir):
    return _block(B.exact_name(*sides(spark, sf_dir)))


@query(_with(Q.PART_RECORDS, Q.PREPARED, _EXACT) + f"SELECT {Q.BLOCK} FROM exact")
def block_exact_name_hot(spark, sf_dir):
    """Exact names over records of few names: the caps decide."""
    return _block(B.exact_name(*sides(spark, sf_dir, A.part_records)))


_TOKENS = Q.rare_tokens("toks", 8)


@query(_with(*_BASE, _TOKENS) + f"SELECT {Q.BLOCK} FROM toks")
def block_rare_tokens(spark, sf_dir):
    return _block(B.rare_tokens(*sides(spark, sf_dir)))


_ADDRESS = Q.by_hits("addr", Q.address_words("addr_tokens"), Q.address_words("addr_tokens"), 8, 8, "address_token")


@query(_with(*_BASE, _ADDRESS) + f"SELECT {Q.BLOCK} FROM addr")
def block_address(spark, sf_dir):
    return _block(B.address_overlap(*sides(spark, sf_dir)))


_GRAMS = Q.by_hits("gram", Q.grams("name_n"), Q.grams("name_n"), 10, 10, "char_gram")


@query(_with(*_BASE, _GRAMS) + f"SELECT {Q.BLOCK} FROM gram")
def block_char_grams(spark, sf_dir):
    return _block(B.gram_overlap(*sides(spark, sf_dir)))


@query(_with(*_BASE, _EXACT, _TOKENS, _ADDRESS, _GRAMS, Q.union("u", "exact", "toks", "addr", "gram")) + f"SELECT {Q.PAIRS}, ord, prio, block_type, blocking_key FROM u")
def block_union(spark, sf_dir):
    """All blocks of the in-memory blocker; each pair under its first block."""
    q, t = sides(spark, sf_dir, settle=True)
    return B.union_blocks(B.exact_name(q, t), B.rare_tokens(q, t), B.address_overlap(q, t), B.gram_overlap(q, t))


_SCORE = f"0.65 * (CASE WHEN qn = '' OR tn = '' THEN 0.0 ELSE {Q.indel('qn', 'tn')} END) + 0.35 * (CASE WHEN qa = '' OR ta = '' THEN 0.0 ELSE {Q.indel('qa', 'ta')} END)"
_NAMED = "SELECT {cols}, a.name_n AS qn, a.addr_n AS qa, b.name_n AS tn, b.addr_n AS ta FROM {of} AS x JOIN q a ON a.entity_id = s1 JOIN t b ON b.entity_id = cid"


@query(
    _with(*_BASE, _EXACT, _TOKENS, _ADDRESS, _GRAMS, Q.union("u", "exact", "toks", "addr", "gram"))
    + f""", c AS (SELECT *, count(*) OVER (PARTITION BY s1) AS n FROM u),
big AS ({_NAMED.format(cols='s1, cid, x.ord', of='(SELECT * FROM c WHERE n > 30)')}),
best AS (SELECT s1, cid, row_number() OVER (PARTITION BY s1 ORDER BY {_SCORE} DESC, ord) AS rn FROM big)
SELECT {Q.PAIRS} FROM c WHERE n <= 30 UNION ALL SELECT {Q.PAIRS} FROM best WHERE rn <= 30"""
)
def block_multi(spark, sf_dir):
    """The in-memory blocker with grams, at most 30 candidates per reference record by lexical score."""
    return B.multi_block(*sides(spark, sf_dir, settle=True), grams=True).select(S1, TARGET)


_WORD_GRAMS = (
    f"flatten(list_transform({Q.words('name_n')}, lambda w: flatten(list_transform([3, 4, 5], lambda n: CASE WHEN length(w) + 2 >= n "
    "THEN list_transform(range(1, length(w) + 4 - n), lambda i: substr(' ' || w || ' ', i, n)) ELSE [] END))))"
)


@query(
    _with(*_BASE)
    + f""", tg AS (SELECT ord, g, count(*) AS tf FROM (SELECT ord, unnest({_WORD_GRAMS}) AS g FROM t) GROUP BY ALL),
qg AS (SELECT s1, g, count(*) AS tf FROM (SELECT entity_id AS s1, unnest({_WORD_GRAMS}) AS g FROM q) GROUP BY ALL),
idf AS (SELECT g, ln((1.0 + (SELECT count(*) FROM t)) / (1.0 + count(*))) + 1.0 AS idf FROM tg GROUP BY g),
tw AS (SELECT ord, g, tf * idf AS w FROM tg JOIN idf USING (g)), qw AS (SELECT s1, g, tf * idf AS w FROM qg JOIN idf USING (g)),
tn AS (SELECT ord, sqrt(sum(w * w)) AS n FROM tw GROUP BY ord), qn AS (SELECT s1, sqrt(sum(w * w)) AS n FROM qw GROUP BY s1),
cos AS (SELECT s1, ord, round(sum(qw.w / qn.n * tw.w / tn.n), 9) AS cosine FROM qw JOIN qn USING (s1) JOIN tw USING (g) JOIN tn USING (ord) GROUP BY s1, ord),
best AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY cosine DESC, ord) AS rn FROM cos)
SELECT s1 AS source1_entity_id, t.entity_id AS candidate_entity_id, best.ord, 'nearest_name' AS block_type, format('{{:.6f}}', cosine) AS blocking_key
FROM best JOIN t ON t.ord = best.ord WHERE rn <= 10"""
)
def block_nearest_names(spark, sf_dir):
    """The ten nearest names by exact TF-IDF cosine of character n-grams."""
    return _block(B.nearest_names(*sides(spark, sf_dir, settle=True)))


_CODE = "nullif(" + Q.first_postal("addr_n") + ", '')"
_PREFIX = "country_n || ':' || CASE WHEN length(name_n) >= 3 THEN name_n[1:4] END"
_STAGES = (
    Q.block("s_exact", "nullif(name_n, '')", "nullif(name_n, '')", 10, "exact_name"),
    Q.block("s_tok", Q.with_country(f"({Q.salient('name_tokens')})[1:3]"), f"country_n || ':' || ({Q.salient('name_tokens')})[1]", 10, "country_name_token", True),
    Q.block("s_post", f"country_n || ':' || {_CODE}", f"country_n || ':' || {_CODE}", 10, "country_postal"),
    Q.union("s_found", "s_exact", "s_tok", "s_post"),
    Q.late("stages", "s_found", 10, Q.block("s_pre", _PREFIX, _PREFIX, 10, "name_prefix", source="q_few"), last="s_pre", prio=3),
)


@query(_with(*_BASE, *_STAGES) + f"SELECT {Q.PAIRS}, ord, prio, block_type, blocking_key FROM stages")
def block_scalable_stages(spark, sf_dir):
    """Stages 1 to 5 of the scalable blocker; the prefix only where fewer than ten candidates came before."""
    return B.scalable_stages(*sides(spark, sf_dir, settle=True))


_WORDS5 = Q.address_words("addr_tokens")


@query(_with(*_BASE, Q.block("aw", Q.with_country(f"({_WORDS5})[1:2]"), Q.with_country(_WORDS5), 8, "address_token", True, True)) + f"SELECT {Q.BLOCK} FROM aw")
def block_country_address(spark, sf_dir):
    """The country and address word block, which the scalable blocker has as an option."""
    q, t = sides(spark, sf_dir)
    words = T.address_words(F.col("addr_tokens"))
    return _block(B.block(q, t, B.with_country(F.slice(words, 1, 2)), B.with_country(words), B.C.MAX_ADDRESS, "address_token"))


_SCALABLE = (
    *_STAGES,
    f"s_named AS ({_NAMED.format(cols='s1, cid, x.ord, block_type, blocking_key', of='stages')})",
    f"s_scored AS (SELECT *, {_SCORE} AS score FROM s_named)",
    "s_best AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, ord) AS rn FROM s_scored WHERE score >= 0.4 OR block_type IN ('exact_name', 'country_name_token'))",
    "s_kept AS (SELECT * FROM s_best WHERE rn <= 25)",
    Q.fallback("s_fall", "s_kept", 2, 100, 500),
)


@query(
    _with(*_BASE, *_SCALABLE)
    + f"""SELECT {Q.BLOCK}, round(CAST(score AS DOUBLE), 9) AS score FROM s_kept UNION ALL SELECT {Q.BLOCK}, 0.0 FROM s_fall"""
)
def block_scalable(spark, sf_dir):
    """The scalable blocker: prefilter, 25 best, fallback; every reference record has a candidate."""
    return B.scalable(*sides(spark, sf_dir, settle=True)).withColumn("score", F.round("score", 9))


_KEY = "country_n || ':' || " + Q.key_token("name_tokens")
_BATCH = (
    Q.block("b_exact", "nullif(name_n, '')", "nullif(name_n, '')", 15, "exact_name"),
    Q.block("b_key", _KEY, _KEY, 15, "country_name_token"),
    Q.block("b_post", f"country_n || ':' || {_CODE}", f"country_n || ':' || {_CODE}", 10, "country_postal"),
    Q.union("b_found", "b_exact", "b_key", "b_post"),
    Q.late("b_all", "b_found", 5, Q.block("b_pre", _PREFIX, _PREFIX, 10, "name_prefix", source="q_few"), last="b_pre", prio=3),
    "batch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY prio, ord) AS rn FROM b_all) WHERE rn <= 15)",
)


@query(_with(*_BASE, *_BATCH) + f"SELECT {Q.PAIRS}, ord, prio, block_type, blocking_key FROM batch")
def block_batch(spark, sf_dir):
    """The batch matcher's blocks, the first 15 candidates by block and order."""
    return B.batch_blocks(*sides(spark, sf_dir, settle=True))


@query(
    _with(
        *_BASE, _EXACT, Q.rare_tokens("f_tok", 8, 150), Q.by_hits("f_addr", *([Q.address_words("addr_tokens", 5, Q.C.ADDRESS_STOP_SHORT)] * 2), 8, 8, "address_token"),
        Q.union("f_found", "exact", "f_tok", "f_addr"),
        Q.late("f_all", "f_found", 10, Q.by_hits("f_gram", *([Q.with_country(Q.grams("name_n"))] * 2), 60, 10, "char_gram", "q_few"), last="f_gram", prio=3),
        Q.fallback("f_fall", "f_all", 1, 50, 200),
    )
    + f"SELECT {Q.PAIRS}, ord, prio, block_type, blocking_key FROM f_all UNION ALL SELECT {Q.PAIRS}, ord, 4, block_type, blocking_key FROM f_fall"
)
def block_single_file(spark, sf_dir):
    """The single-file variant: other caps, grams by country where fewer than ten, one fallback."""
    return B.single_file(*sides(spark, sf_dir, settle=True))


@query(_with(*_BASE, Q.block("e", "nullif(name_n, '')", "nullif(name_n, '')", 10, "exact_name"), Q.fallback("fall", "e", 2, 100, 500)) + f"SELECT {Q.BLOCK} FROM fall")
def block_fallback(spark, sf_dir):
    """Anchors for reference records whose exact name finds nothing among all targets."""
    q, t = sides(spark, sf_dir, settle=True)
    return B.fallback(q, B.block(q, t, B.non_empty("name_n"), B.non_empty("name_n"), 10, "exact_name"), t)


# --- features, labels, training pairs ----------------------------------------------------------------------------------------------

_AB = "{of} JOIN q a ON a.entity_id = s1 JOIN t b ON b.entity_id = cid"
_TOKEN_FEATURES = f"""CAST(a.country_n <> '' AND a.country_n = b.country_n AS DOUBLE) AS country_exact, {Q.jaccard('a.name_tokens', 'b.name_tokens')} AS name_jaccard,
  {Q.containment('a.name_n', 'b.name_n')} AS name_containment, CAST(abs(length(a.name_n) - length(b.name_n)) AS DOUBLE) AS name_len_diff,
  {Q.overlap('a.name_tokens', 'b.name_tokens')} AS name_token_overlap, {Q.jaccard('a.addr_tokens', 'b.addr_tokens')} AS addr_jaccard,
  {Q.containment('a.addr_n', 'b.addr_n')} AS addr_containment, CAST(abs(length(a.addr_n) - length(b.addr_n)) AS DOUBLE) AS addr_len_diff,
  {Q.overlap('a.addr_tokens', 'b.addr_tokens')} AS addr_token_overlap,
  CAST(len(list_intersect({Q.postal('a.addr_n')}, {Q.postal('b.addr_n')})) > 0 AS DOUBLE) AS same_postal_like"""


def _candidates(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    q, t = sides(spark, sf_dir, settle=True)
    return I.settled(B.batch_blocks(q, t).select(S1, TARGET, "ord"), "candidates"), q, t


@query(_with(*_BASE, *_BATCH) + f"SELECT {Q.PAIRS}, {_TOKEN_FEATURES} FROM {_AB.format(of='batch')}")
def features_tokens(spark, sf_dir):
    """The ten token features of the batch candidates."""
    pairs, q, t = _candidates(spark, sf_dir)
    return X.with_token_features(pairs, q, t).drop("ord")


@query(_with(*_BASE, _TOKENS) + f"SELECT {Q.PAIRS}, {Q.indel('a.name_n', 'b.name_n')} AS name_ratio, {Q.indel('a.addr_n', 'b.addr_n')} AS addr_ratio FROM {_AB.format(of='toks')}")
def features_ratios(spark, sf_dir):
    """The edit ratios of names and addresses."""
    q, t = sides(spark, sf_dir)
    met = X.sides(B.rare_tokens(q, t).select(S1, TARGET).distinct(), q, t)
    return met.select(S1, TARGET, S.indel_ratio("a.name_n", "b.name_n").alias("name_ratio"), S.indel_ratio("a.addr_n", "b.addr_n").alias("addr_ratio"))


ORACLE["features_ratios"] = ORACLE["features_ratios"].replace(f"FROM {_AB.format(of='toks')}", f"FROM {_AB.format(of='(SELECT DISTINCT s1, cid FROM toks)')}")


@query()
def features_all(spark, sf_dir):
    """All thirteen features, with the weighted ratio."""
    pairs, q, t = _candidates(spark, sf_dir)
    return X.with_features(pairs, q, t)


_W4 = Q.address_words("{}.addr_tokens", 4)


@query(
    _with(*_BASE, *_BATCH)
    + f"""SELECT {Q.PAIRS}, CASE WHEN a.name_n = b.name_n THEN 1.0 ELSE {Q.containment('a.name_n', 'b.name_n')} END AS name_containment,
  CASE WHEN a.addr_n = b.addr_n THEN 1.0 ELSE {Q.containment('a.addr_n', 'b.addr_n')} END AS addr_containment,
  {Q.jaccard(_W4.format('a'), _W4.format('b'))} AS addr_jaccard, {Q.overlap(_W4.format('a'), _W4.format('b'))} AS addr_token_overlap,
  CAST({Q.first_postal('a.addr_n')} <> '' AND {Q.first_postal('a.addr_n')} = {Q.first_postal('b.addr_n')} AS DOUBLE) AS same_postal_like FROM {_AB.format(of='batch')}"""
)
def features_batch(spark, sf_dir):
    """The features that the batch matcher computes in its own way."""
    pairs, q, t = _candidates(spark, sf_dir)
    return X.batch_features(pairs, q, t).select(S1, TARGET, "name_containment", "addr_containment", "addr_jaccard", "addr_token_overlap", "same_postal_like")


@query(_with(*_BASE, Q.TRUTH, *_BATCH) + f"SELECT {Q.PAIRS.replace('s1 AS', 'batch.s1 AS').replace('cid AS', 'batch.cid AS')}, CAST(truth.s1 IS NOT NULL AS INT) AS label FROM batch LEFT JOIN truth USING (s1, cid)")
def pairs_labels(spark, sf_dir):
    pairs, _, _ = _candidates(spark, sf_dir)
    return X.with_labels(pairs.select(S1, TARGET), A.truth(spark, sf_dir))


@query(_with(*_BASE, Q.TRUTH, _EXACT) + f"SELECT {Q.PAIRS} FROM truth WHERE s1 IN (SELECT s1 FROM exact) AND cid IN (SELECT cid FROM exact)")
def pairs_restricted_truth(spark, sf_dir):
    """Truth between the records that the exact name block returns."""
    q, t = sides(spark, sf_dir)
    found = B.exact_name(q, t)
    named = lambda c: found.select(F.col(c).alias("entity_id")).distinct()
    return X.restricted(A.truth(spark, sf_dir), named(S1), named(TARGET)).select(S1, TARGET)


_LABELLED = "labelled AS (SELECT b.s1, b.cid, b.ord, CAST(truth.s1 IS NOT NULL AS INT) AS label FROM batch b LEFT JOIN truth ON truth.s1 = b.s1 AND truth.cid = b.cid)"
_TRAINING = (
    _LABELLED,
    "negative AS (SELECT s1, cid FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY ord) AS rn FROM labelled WHERE label = 0) WHERE rn <= 12)",
    "training AS (SELECT DISTINCT s1, cid, 1 AS label FROM truth UNION ALL SELECT s1, cid, 0 FROM negative)",
)


@query(_with(*_BASE, Q.TRUTH, *_BATCH, *_TRAINING) + f"SELECT {Q.PAIRS}, label FROM training")
def pairs_training(spark, sf_dir):
    """Training pairs with all true pairs injected and at most twelve hard negatives each."""
    pairs, _, t = _candidates(spark, sf_dir)
    return X.training_pairs(pairs, A.truth(spark, sf_dir), t)


@query(_with(*_BASE, Q.TRUTH, *_BATCH, *_TRAINING) + f"SELECT {Q.PAIRS}, label FROM labelled WHERE label = 1 UNION ALL SELECT {Q.PAIRS}, 0 FROM negative")
def pairs_training_blocked(spark, sf_dir):
    """Training pairs as blocked, nothing injected."""
    pairs, _, t = _candidates(spark, sf_dir)
    return X.training_pairs(pairs, A.truth(spark, sf_dir), t, inject=False)


@query(
    _with(*_BASE, Q.TRUTH)
    + f""", pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country_n ORDER BY ord) AS rn FROM t) WHERE rn <= 200)
SELECT q.entity_id AS source1_entity_id, pool.entity_id AS candidate_entity_id, 0 AS label FROM q JOIN pool ON pool.country_n = q.country_n
WHERE NOT EXISTS (SELECT 1 FROM truth WHERE s1 = q.entity_id AND cid = pool.entity_id) ORDER BY q.ord, pool.ord LIMIT (SELECT CAST(floor(1.5 * count(*)) AS BIGINT) FROM truth)"""
)
def pairs_country_negatives(spark, sf_dir):
    q, t = sides(spark, sf_dir)
    return X.country_negatives(q, t, A.truth(spark, sf_dir))


@query(
    _with(*_BASE, Q.TRUTH)
    + f""", span AS (SELECT min(ord) AS lo, max(ord) AS hi FROM t),
asked AS (SELECT s1, lo + (({Q.number('s1')} * 31 + {Q.number('cid')} * 17 + 42) + i * 7919) % (hi - lo + 1) AS o FROM truth, span, range(1, 3) r(i))
SELECT DISTINCT a.s1 AS source1_entity_id, t.entity_id AS candidate_entity_id, 0 AS label FROM asked a JOIN t ON t.ord = a.o
WHERE NOT EXISTS (SELECT 1 FROM truth x WHERE x.s1 = a.s1 AND x.cid = t.entity_id)"""
)
def pairs_drawn_negatives(spark, sf_dir):
    _, t = sides(spark, sf_dir)
    return X.drawn_negatives(A.truth(spark, sf_dir), t)


@query(_with(*_BASE, Q.TRUTH, *_BATCH, *_TRAINING) + f"SELECT {Q.PAIRS}, label, ({Q.number('s1')} * 2654435761) % 1000 < 200 AS is_val FROM training")
def pairs_split(spark, sf_dir):
    """Training and validation by reference record."""
    pairs, _, t = _candidates(spark, sf_dir)
    return X.split_groups(X.training_pairs(pairs, A.truth(spark, sf_dir), t))
