"""Candidate generation: equi-joins on derived keys with caps by target order.

Every block is `postings` (target side: key, ord, id, cut to the first rows of a key) joined to `probes` (reference
side: key, id). The cut comes before the join, as a rank that Spark plans as a partial and a final group limit, so a key
that a third of all targets share costs its cap, and the join's output per reference record is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import constants as C
from ..functions import similarity as S
from ..functions import text as T
from ..functions.nearest import FOUND, nearest_in_block
from ..sources.feeds import settled

S1, TARGET = "source1_entity_id", "candidate_entity_id"
#: Distinct names that a task of nearest_names holds: with their grams, some 20 and 150 MB.
QUERY_BLOCK, TARGET_BLOCK = 16_384, 65_536


def first_rows(df: DataFrame, by: list[str], n: int, *order: Column | str) -> DataFrame:
    """The first n rows of each group."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def postings(targets: DataFrame, key: Column, cap: int | None) -> DataFrame:
    """(key, ord, candidate id); `key` may be an array of keys. Null keys are dropped; `cap` None keeps all."""
    rows = targets.select(key.alias("key"), "ord", F.col("entity_id").alias(TARGET))
    if rows.schema["key"].dataType.typeName() == "array":
        rows = rows.select(F.explode("key").alias("key"), "ord", TARGET)
    rows = rows.where("key is not null")
    return rows if cap is None else first_rows(rows, ["key"], cap, "ord")


def probes(queries: DataFrame, key: Column) -> DataFrame:
    """(key, reference id); `key` may be an array."""
    rows = queries.select(key.alias("key"), F.col("entity_id").alias(S1))
    if rows.schema["key"].dataType.typeName() == "array":
        rows = rows.select(F.explode("key").alias("key"), S1)
    return rows.where("key is not null")


def block(queries: DataFrame, targets: DataFrame, query_key: Column, target_key: Column, cap: int, name: str) -> DataFrame:
    """(reference id, candidate id, ord, block_type, blocking_key): the first `cap` targets of each probed key."""
    met = probes(queries, query_key).join(postings(targets, target_key, cap), "key")
    return met.select(S1, TARGET, "ord", F.lit(name).alias("block_type"), F.col("key").cast("string").alias("blocking_key"))


def non_empty(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def with_country(c: Column) -> Column:
    """Keys of a country: "country:key"; of an array, each."""
    return F.transform(c, lambda w: F.concat(F.col("country_n"), F.lit(":"), w))


def country_key(c: Column) -> Column:
    return F.concat(F.col("country_n"), F.lit(":"), c)


# --- the in-memory blocker ---------------------------------------------------------------------------------------------


def exact_name(queries: DataFrame, targets: DataFrame, take: int = C.MAX_NAME) -> DataFrame:
    return block(queries, targets, non_empty("name_n"), non_empty("name_n"), take, "exact_name")


def rare_tokens(queries: DataFrame, targets: DataFrame, take: int = C.MAX_NAME, cap: int | None = None) -> DataFrame:
    """Targets file under their three shortest words (of four letters and more); a query asks for its three rarest."""
    long = lambda a: F.filter(a, lambda w: F.length(w) >= C.MIN_NAME_TOKEN)
    filed = postings(targets, with_country(long(T.shortest(F.col("name_tokens"), 3))), cap)
    asked = probes(queries, with_country(long(F.col("name_tokens"))))
    size = filed.groupBy("key").agg(F.count("*").alias("n"))
    ranked = asked.join(size, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = first_rows(ranked, [S1], 3, "n", F.length("key").desc(), "key").select("key", S1)
    met = rare.join(first_rows(filed, ["key"], take, "ord"), "key")
    return met.select(S1, TARGET, "ord", F.lit("country_name_token").alias("block_type"), F.col("key").alias("blocking_key"))


def by_hits(queries: DataFrame, targets: DataFrame, query_keys: Column, target_keys: Column, per_key: int, take: int, name: str) -> DataFrame:
    """The `take` targets that share most keys, ties by ord; of each key the first `per_key` targets count."""
    met = probes(queries, query_keys).join(postings(targets, target_keys, per_key), "key")
    hits = met.groupBy(S1, TARGET, "ord").agg(F.count("*").alias("hits"))
    best = first_rows(hits, [S1], take, F.col("hits").desc(), "ord")
    return best.select(S1, TARGET, "ord", F.lit(name).alias("block_type"), F.col("hits").cast("string").alias("blocking_key"))


def address_overlap(queries: DataFrame, targets: DataFrame, take: int = C.MAX_ADDRESS, stop=C.ADDRESS_STOP_WORDS) -> DataFrame:
    key = T.address_words(F.col("addr_tokens"), C.MIN_ADDRESS_TOKEN, stop)
    return by_hits(queries, targets, key, key, min(take, C.MAX_POSTINGS), take, "address_token")


def gram_overlap(queries: DataFrame, targets: DataFrame, take: int = C.MAX_GRAM) -> DataFrame:
    key = T.char_grams(F.col("name_n"))
    return by_hits(queries, targets, key, key, min(take, C.MAX_POSTINGS), take, "char_gram")


def union_blocks(*blocks: DataFrame) -> DataFrame:
    """Each pair once, under the first block that proposes it (the order of the arguments), then the smallest key."""
    rows = [b.select(S1, TARGET, "ord", F.lit(i).alias("prio"), "block_type", "blocking_key") for i, b in enumerate(blocks)]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    first = F.min(F.struct("prio", "block_type", "blocking_key")).alias("f")
    return every.groupBy(S1, TARGET, "ord").agg(first).select(S1, TARGET, "ord", "f.prio", "f.block_type", "f.blocking_key")


def names_of(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with the names and addresses of both sides."""
    q = queries.select(F.col("entity_id").alias(S1), F.col("name_n").alias("qn"), F.col("addr_n").alias("qa"))
    t = targets.select(F.col("entity_id").alias(TARGET), F.col("name_n").alias("tn"), F.col("addr_n").alias("ta"))
    return pairs.join(q, S1).join(t, TARGET)


def with_score(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds score, the lexical composite; empty names or addresses count as 0 in it."""
    ratio = lambda a, b: F.when((F.col(a) == "") | (F.col(b) == ""), 0.0).otherwise(S.indel_ratio(a, b))
    scored = names_of(pairs, queries, targets).withColumn("score", S.lexical_score(ratio("qn", "tn"), ratio("qa", "ta")))
    return scored.drop("qn", "qa", "tn", "ta")


def compact(pairs: DataFrame, queries: DataFrame, targets: DataFrame, most: int = C.MAX_TOTAL) -> DataFrame:
    """Reference records of more than `most` candidates keep the best by lexical score, ties by ord; only those are scored."""
    n = F.count("*").over(W.partitionBy(S1))
    counted = pairs.withColumn("_n", n)
    few = counted.where(F.col("_n") <= most).drop("_n")
    many = counted.where(F.col("_n") > most).drop("_n")
    best = first_rows(with_score(many, queries, targets), [S1], most, F.col("score").desc(), "ord").drop("score")
    return few.unionByName(best.select(*few.columns))


def no_self(pairs: DataFrame) -> DataFrame:
    return pairs.where(~F.col(TARGET).startswith("S1-"))


def multi_block(queries: DataFrame, targets: DataFrame, grams: bool | None = None, most: int = C.MAX_TOTAL) -> DataFrame:
    """The in-memory blocker; `grams` None: the gram block if there are more than GRAM_INDEX_ABOVE targets, else nearest names."""
    blocks = [exact_name(queries, targets), rare_tokens(queries, targets), address_overlap(queries, targets)]
    grams = targets.count() > C.GRAM_INDEX_ABOVE if grams is None else grams
    blocks.append(gram_overlap(queries, targets) if grams else nearest_names(queries, targets))
    return no_self(compact(union_blocks(*blocks), queries, targets, most))


def boundary_grams(c: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside words padded by one space, with repeats; a word shorter than n gives itself once."""
    padded = F.transform(F.filter(F.split(c, " "), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of_length(w: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1)))
        return F.when(F.length(w) >= n, F.transform(starts, lambda i: F.substring(w, i, F.lit(n))))

    def grams(w: Column) -> Column:
        return F.flatten(F.array_compact(F.array(*(of_length(w, n) for n in range(low, high + 1)))))

    return F.flatten(F.transform(padded, grams))


def nearest_names(queries: DataFrame, targets: DataFrame, take: int = C.MAX_GRAM) -> DataFrame:
    """The `take` targets of highest TF-IDF cosine (smoothed idf, character 3- to 5-grams inside words), exact; ties go by ord.

    Equal names are one vector: its cosines are computed once, and it stands for its first `take` targets, as no other one can come
    in. Vectors are written once and dealt into blocks; each block of queries meets each block of targets in one task, which sums
    the postings of all grams of a query (nearest_in_block). No row is made for a pair and nothing is cut before its cosine is
    known. The sums grow with the product of distinct names, as does what is shuffled, at a copy of the targets per QUERY_BLOCK.
    """

    def named(df: DataFrame, key: str) -> DataFrame:
        """(key, names): the names of a key, one but where keys repeat."""
        return df.where("name_n <> ''").groupBy(F.col(key).alias("key")).agg(F.array_sort(F.collect_list("name_n")).alias("names"))

    def grams(vectors: DataFrame) -> DataFrame:
        each = vectors.select("vector", "n", F.explode(F.flatten(F.transform("names", lambda c: boundary_grams(c)))).alias("g"))
        return each.groupBy("vector", "n", "g").agg(F.count("*").alias("tf"))

    def normed(rows: DataFrame) -> DataFrame:
        weight = F.col("tf") * F.col("idf")
        lists = rows.join(idf, "g").groupBy("vector").agg(F.collect_list(F.struct("g", weight.alias("w"))).alias("p"), F.sqrt(F.sum(weight * weight)).alias("norm"))
        return lists.where("vector is not null").select("vector", F.col("p.g").alias("keys"), F.transform("p.w", lambda w: w / F.col("norm")).alias("weights"))

    filed, asked = named(targets, "ord"), named(queries, "entity_id").where("key is not null")
    vectors = lambda rows: rows.groupBy("names").agg(F.count("*").alias("n"), F.min("key").alias("vector"))
    t, q = grams(vectors(filed)), grams(vectors(asked))
    df = t.groupBy("g").agg(F.sum("n").alias("df"))
    n = targets.agg(F.count("*").alias("n"))
    idf = df.crossJoin(F.broadcast(n)).select("g", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))  # n is one row
    first = first_rows(filed.where("key is not null"), ["names"], take, "key").groupBy("names").agg(F.array_sort(F.collect_list("key")).alias("ords"))
    held = settled(normed(t).join(first.select(F.col("ords")[0].alias("vector"), "ords"), "vector"), "targets")
    sought = settled(normed(q), "queries")

    across, down = (max(1, -(-rows.count() // most)) for rows, most in ((sought, QUERY_BLOCK), (held, TARGET_BLOCK)))
    block_of = lambda blocks: F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = sought.select(block_of(across).alias("a"), every(down).alias("b"), F.col("vector").alias("query"), "keys", "weights")
    right = held.select(every(across).alias("a"), block_of(down).alias("b"), "ords", "keys", "weights")
    found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(nearest_in_block(take), FOUND)
    # Rounded, so that the order of summation does not decide ties.
    best = first_rows(found.withColumn("cosine", F.round("cosine", 9)), ["query"], take, F.col("cosine").desc(), "ord")
    ids = targets.select("ord", F.col("entity_id").alias(TARGET))
    members = asked.join(vectors(asked), "names").select(F.col("vector").alias("query"), F.col("key").alias(S1))
    met = best.join(ids, "ord").join(members, "query")
    return met.select(S1, TARGET, "ord", F.lit("nearest_name").alias("block_type"), F.format_number("cosine", 6).alias("blocking_key"))


# --- the scalable blocker ------------------------------------------------------------------------------------------------


def scalable_stages(queries: DataFrame, targets: DataFrame, address_block: bool = False) -> DataFrame:
    """Stages 1 to 5: exact name, country and salient word, country and postal code, (address word), prefix where few."""
    asked = F.slice(T.salient(F.col("name_tokens")), 1, 3)
    longest = F.get(T.salient(F.col("name_tokens")), F.lit(0))
    code = F.nullif(T.first_postal(F.col("addr_n")), F.lit(""))
    blocks = [
        block(queries, targets, non_empty("name_n"), non_empty("name_n"), 10, "exact_name"),
        block(queries, targets, with_country(asked), country_key(longest), 10, "country_name_token"),
        block(queries, targets, country_key(code), country_key(code), 10, "country_postal"),
    ]
    if address_block:
        words = T.address_words(F.col("addr_tokens"))
        blocks.append(block(queries, targets, with_country(F.slice(words, 1, 2)), with_country(words), C.MAX_ADDRESS, "address_token"))
    found = union_blocks(*blocks)
    enough = found.groupBy(F.col(S1).alias("entity_id")).agg(F.count("*").alias("n")).where("n >= 10")
    prefix = country_key(T.prefix_key(F.col("name_n")))
    more = block(queries.join(enough, "entity_id", "left_anti"), targets, prefix, prefix, 10, "name_prefix")
    late = more.withColumn("prio", F.lit(len(blocks)))
    first = F.min(F.struct("prio", "block_type", "blocking_key")).alias("f")
    return found.unionByName(late).groupBy(S1, TARGET, "ord").agg(first).select(S1, TARGET, "ord", "f.prio", "f.block_type", "f.blocking_key")


def prefilter(pairs: DataFrame, queries: DataFrame, targets: DataFrame, least: float = 0.4, most: int = 25) -> DataFrame:
    """Stage 6: by lexical score; pairs of exact names and country words need none to stay."""
    scored = with_score(pairs, queries, targets)
    kept = scored.where((F.col("score") >= least) | F.col("block_type").isin("exact_name", "country_name_token"))
    return first_rows(kept, [S1], most, F.col("score").desc(), "ord")


def anchors(targets: DataFrame, per_country: int, overall: int) -> DataFrame:
    """(country, k, n, candidate id): the first targets of each country, and of all under a null country."""
    rows = targets.select(F.col("country_n").alias("country"), "ord", F.col("entity_id").alias(TARGET))
    first = first_rows(rows, ["country"], per_country, "ord").unionByName(rows.orderBy("ord").limit(overall).withColumn("country", F.lit(None).cast("string")))
    w = W.partitionBy("country")
    return first.select("country", (F.row_number().over(w.orderBy("ord")) - 1).alias("k"), F.count("*").over(w).alias("n"), "ord", TARGET)


def id_number(entity_id: Column) -> Column:
    """The number at the end of an id."""
    return F.coalesce(F.regexp_extract(entity_id, "([0-9]+)$", 1).try_cast("long"), F.lit(0))


def fallback(queries: DataFrame, found: DataFrame, targets: DataFrame, take: int = 2, per_country: int = 100, overall: int = 500) -> DataFrame:
    """Reference records without candidates get `take` anchors of their country (or of all), chosen by their id's number."""
    pool = anchors(targets, per_country, overall)
    none = queries.join(found.select(F.col(S1).alias("entity_id")).distinct(), "entity_id", "left_anti")
    known = pool.where("country is not null").select("country").distinct().withColumn("has", F.lit(True))
    asked = none.join(known, none["country_n"] == known["country"], "left").select(
        F.col("entity_id").alias(S1), F.when(F.col("has"), F.col("country_n")).alias("want"), id_number(F.col("entity_id")).alias("h"), "country_n"
    )
    sizes = pool.select(F.col("country").alias("c"), "n").distinct()
    sized = asked.join(sizes, asked["want"].eqNullSafe(sizes["c"]))
    picks = F.transform(F.sequence(F.lit(1), F.least(F.lit(take), F.col("n").cast("int"))), lambda i: F.pmod(F.col("h") + i - 1, F.col("n")))
    chosen = sized.select(S1, "want", "country_n", F.explode(picks).alias("pick"))
    met = chosen.join(pool, chosen["want"].eqNullSafe(pool["country"]) & (chosen["pick"] == pool["k"]))
    key = F.concat(F.lit("fallback:"), F.when(F.col("country_n") != "", F.col("country_n")).otherwise("global"))
    return met.select(S1, TARGET, "ord", F.lit("fallback").alias("block_type"), key.alias("blocking_key"))


def scalable(queries: DataFrame, targets: DataFrame, address_block: bool = False) -> DataFrame:
    """(reference id, candidate id, ord, block_type, blocking_key, score); every reference record has a candidate."""
    found = prefilter(scalable_stages(queries, targets, address_block), queries, targets)
    rest = fallback(queries, found, targets).withColumn("score", F.lit(0.0))
    return found.select(S1, TARGET, "ord", "block_type", "blocking_key", "score").unionByName(rest)


# --- the batch matcher and the single-file variant -------------------------------------------------------------------------


def batch_blocks(queries: DataFrame, targets: DataFrame, most: int = 15) -> DataFrame:
    """Exact name, country and key word, postal code, prefix where fewer than five; the first 15 by block, then ord."""
    key = country_key(T.key_token(F.col("name_tokens")))
    code = country_key(F.nullif(T.first_postal(F.col("addr_n")), F.lit("")))
    blocks = [
        block(queries, targets, non_empty("name_n"), non_empty("name_n"), 15, "exact_name"),
        block(queries, targets, key, key, 15, "country_name_token"),
        block(queries, targets, code, code, 10, "country_postal"),
    ]
    found = union_blocks(*blocks)
    enough = found.groupBy(F.col(S1).alias("entity_id")).agg(F.count("*").alias("n")).where("n >= 5")
    prefix = country_key(T.prefix_key(F.col("name_n")))
    more = block(queries.join(enough, "entity_id", "left_anti"), targets, prefix, prefix, 10, "name_prefix").withColumn("prio", F.lit(3))
    first = F.min(F.struct("prio", "block_type", "blocking_key")).alias("f")
    every = found.unionByName(more).groupBy(S1, TARGET, "ord").agg(first).select(S1, TARGET, "ord", "f.prio", "f.block_type", "f.blocking_key")
    return first_rows(every, [S1], most, "prio", "ord")


def single_file(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The single-file variant's blocks before compaction: caps 150, 100 and 60, grams by country where fewer than ten."""
    blocks = [exact_name(queries, targets), rare_tokens(queries, targets, cap=150), address_overlap(queries, targets, stop=C.ADDRESS_STOP_SHORT)]
    found = union_blocks(*blocks)
    enough = found.groupBy(F.col(S1).alias("entity_id")).agg(F.count("*").alias("n")).where("n >= 10")
    grams = with_country(T.char_grams(F.col("name_n")))
    more = by_hits(queries.join(enough, "entity_id", "left_anti"), targets, grams, grams, 60, C.MAX_GRAM, "char_gram").withColumn("prio", F.lit(3))
    first = F.min(F.struct("prio", "block_type", "blocking_key")).alias("f")
    every = found.unionByName(more).groupBy(S1, TARGET, "ord").agg(first).select(S1, TARGET, "ord", "f.prio", "f.block_type", "f.blocking_key")
    rest = fallback(queries, every, targets, take=1, per_country=50, overall=200).withColumn("prio", F.lit(4))
    return every.unionByName(rest.select(*every.columns))
