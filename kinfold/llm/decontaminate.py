"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted verification.

A benchmark item is the bag of its five-word shingles (lower-cased words between white space). A document is contaminated
by an item if one of its windows of as many shingles as the item has (the last ones may be cut by the text's end) has a
weighted Jaccard similarity of at least `threshold` to it, weights being the numbers of occurrences.

Plan (DataFrame functions only)
-------------------------------
1. Windows. A window that qualifies shares at least t / (1 + t) of both sizes in shingles with its item, and shifting it
   right to its first shared shingle loses none of them. So windows need to start only at shingles that occur in an
   item, with the sizes of the items that hold them, and only where enough of the next shingles occur in items as
   well. This drops no window that could qualify; it is a join of shingle hashes with those of the benchmark, which is
   broadcast while it takes at most `broadcast_bytes` and shuffled beyond. From here on every distinct text counts once.
2. Each such window gets a 64-bit SimHash of its weighted shingles, as each item has. The bits' sums come from one running
   sum over the text's shingles, read at a window's two ends, so the cost is linear in text and windows together: a
   window is a position and a size, never a bag. Two bits share a number (b and b + 32), 32 sums in all.
3. Multi-index Hamming search: the fingerprint is cut into four blocks of sixteen bits. Two fingerprints within radius 15
   differ by at most three bits in some block, so an item is filed under its block values and all values up to three bits
   away, and a window asks with its four values: an equi-join on (size, block, value) that meets all pairs within
   the radius. Of unrelated pairs of one size it meets 4 * 697 / 65536, about four in a hundred.
4. Candidate pairs of text and item are verified exactly, by one sweep over the text for all their windows. The
   occurrence of a shingle at p counts for a window at s if fewer than c occurrences lie in [s, p), c being the item's
   number of it: that is an interval of s, so the weighted overlap of every window is a running sum of interval ends.

Recall. At similarity 0.8 two fingerprints differ in 9.7 of 64 bits on average, and 97 % of such pairs lie within the
radius; at 0.9 all but two in 10^4 do (tests measure both). Hash collisions of shingles are not looked for.

Defined cases: items and documents of fewer than five words have no shingle and never match; null text counts as empty;
very long and repetitive texts cost in proportion to their length; rows of the same doc_id and text are one document
with one result; a null doc_id is reported as null; items that share an item_id give the best of their results; other
columns, whatever their names, are neither read nor, in keep_clean, changed; without items or without documents there
are no rows. The function runs jobs while it is built: it counts what may be broadcast and writes steps that are read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import OWN, TEXT_HASH, cut, is_empty, shingles, small, table, text_key, words

WIDTH, THRESHOLD, RADIUS = 5, 0.8, 15
BLOCKS, BLOCK_BITS = 4, 16
#: Larger join sides than this are shuffled.
BROADCAST_BYTES = 64_000_000
SCHEMA = f"doc_id long, item_id long, similarity double, start long, n_shingles long, {TEXT_HASH} struct<a:long,b:long>"
BEST = f"{OWN}best"


def _with_shingles(df: DataFrame, text: str, *keep: str) -> DataFrame:
    hashed = df.select(*keep, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("wh"))
    return hashed.select(*keep, shingles(F.col("wh"), WIDTH).alias("sh"))


def lanes(h: Column) -> list[Column]:
    """The bits of a hash: number b holds bit b, and bit b + 32 in its upper half."""
    return [F.shiftrightunsigned(h, b).bitwiseAND((1 << 32) + 1) for b in range(32)]


def fingerprint(sums: str, n: str) -> Column:
    """The SimHash of n shingles: the bits that more than half of them have, from the array of their lanes' sums."""
    bit = lambda ones, place: f"CASE WHEN 2 * ({ones}) > {n} THEN shiftleft(1L, {place}) ELSE 0L END"
    both = f"transform({sums}, (s, b) -> ({bit('s & 4294967295', 'b')}) | ({bit('shiftrightunsigned(s, 32)', 'b + 32')}))"
    return F.expr(f"aggregate({both}, 0L, (v, x) -> v | x)")


def block_keys(fp: Column, size: Column) -> Column:
    """For each block (size, block, value) as one number; a value is its lowest bits."""
    values = [F.shiftrightunsigned(fp, BLOCK_BITS * k).bitwiseAND((1 << BLOCK_BITS) - 1) for k in range(BLOCKS)]
    return F.array(*((size.cast("long") * BLOCKS + k) * (1 << BLOCK_BITS) + v for k, v in enumerate(values)))


def filed(bags: DataFrame, radius: int) -> DataFrame:
    """The index: items under every value of each block that a fingerprint within the radius can have in some block."""
    flips = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= radius // BLOCKS]
    masks = F.split(F.lit(",".join(map(str, flips))), ",").cast("array<long>")
    keyed = bags.select("item", "item_id", "fp", F.explode(block_keys(F.col("fp"), F.col("size"))).alias("k"), masks.alias("masks"))
    return keyed.select("item", "item_id", F.col("fp").alias("item_fp"), F.explode(F.transform("masks", lambda m: F.col("k").bitwiseXOR(m))).alias("k"))


def near(windows: DataFrame, bags: DataFrame, radius: int) -> DataFrame:
    """Windows (size, fp and any columns) with the items (item, item_id) of their size whose fingerprint is within the radius."""
    asked = windows.withColumn("k", F.explode(block_keys(F.col("fp"), F.col("size"))))
    met = asked.join(filed(bags, radius), "k").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    return met.drop("k", "fp", "item_fp").distinct()


def bags_of(items: DataFrame) -> DataFrame:
    """(item, item_id, size, sh, fp) of the distinct items that have a shingle."""
    bags = _with_shingles(items.select(F.col("item_id").cast("long"), "text"), "text", "item_id").where(F.size("sh") > 0).distinct()
    sums = "transform(sequence(0, 31), b -> aggregate(sh, 0L, (s, h) -> s + (shiftrightunsigned(h, b) & 4294967297)))"
    sized = bags.select(F.monotonically_increasing_id().alias("item"), "item_id", F.size("sh").alias("size"), "sh", F.expr(sums).alias("sums"))
    return cut(sized.select("item", "item_id", "size", "sh", fingerprint("sums", "size").alias("fp")))


def starts_of(docs: DataFrame, bags: DataFrame, threshold: float, broadcast_bytes: int) -> DataFrame:
    """(text key, n, starts): for each text the (pos, size) of the windows that can qualify; n counts its shingles."""
    known = cut(bags.select("size", F.explode("sh").alias("h")).groupBy("h").agg(F.array_sort(F.collect_set("size")).alias("sizes")))
    # The outer form keeps the optimiser from testing the array's size before, which would compute the shingles twice.
    each = _with_shingles(docs, "text", TEXT_HASH).select(TEXT_HASH, F.size("sh").alias("n"), F.posexplode_outer("sh").alias("pos", "h"))
    hits = each.join(small(known, broadcast_bytes, 48 + 4 * F.size("sizes")), "h")
    # Copies of a text give the same hits: a set keeps one of each.
    per_text = hits.groupBy(TEXT_HASH).agg(F.max("n").alias("n"), F.array_sort(F.collect_set(F.struct("pos", "sizes"))).alias("hits"))
    share = threshold / (1 + threshold)
    starts = F.expr(
        f"""flatten(transform(hits, (x, r) -> transform(
              filter(x.sizes, w -> coalesce(get(hits, r + cast(ceil({share} * (w + least(w, n - x.pos)) - 1e-9) AS int) - 1).pos < x.pos + w, false)),
              w -> named_struct('pos', x.pos, 'size', w))))"""
    )
    return per_text.select(TEXT_HASH, "n", starts.alias("starts")).where(F.size("starts") > 0)


def fingerprints(cells: DataFrame, windows: DataFrame) -> DataFrame:
    """windows (text key, n, pos, size) with fp, from cells (text key, at, h): all shingles of these texts.

    Sums run over a text's shingles; each window puts a mark at its start (-1) and at its end (+1), and the difference
    of the sums that the marks see is the window's own.
    """
    marks = windows.select(TEXT_HASH, "pos", "size", F.least("size", F.col("n") - F.col("pos")).alias("m"))
    ends = F.array(F.struct(F.col("pos").alias("at"), F.lit(-1).alias("sign")), F.struct((F.col("pos") + F.col("m")).alias("at"), F.lit(1).alias("sign")))
    marks = marks.select(TEXT_HASH, F.explode(ends).alias("e"), "pos", "size", "m").select(TEXT_HASH, "e.at", "e.sign", "pos", "size", "m", F.lit(0).cast("long").alias("h"))
    none = F.lit(None).cast("int")
    rows = marks.unionByName(cells.select(TEXT_HASH, "at", none.alias("sign"), none.alias("pos"), none.alias("size"), none.alias("m"), "h"))
    order = W.partitionBy(TEXT_HASH).orderBy("at", F.col("sign").isNull()).rowsBetween(W.unboundedPreceding, 0)  # marks before the shingle at their place
    running = rows.select(TEXT_HASH, "sign", "pos", "size", "m", *(F.sum(x).over(order).alias(f"x{b}") for b, x in enumerate(lanes(F.col("h")))))
    sums = running.where("sign is not null").groupBy(TEXT_HASH, "pos", "size", "m").agg(*(F.sum(F.col("sign") * F.col(f"x{b}")).alias(f"x{b}") for b in range(32)))
    return sums.select(TEXT_HASH, "pos", "size", "m", F.array(*(f"x{b}" for b in range(32))).alias("sums")).select(TEXT_HASH, "pos", "size", "m", fingerprint("sums", "m").alias("fp"))


def overlaps(cells: DataFrame, pairs: DataFrame, bags: DataFrame, broadcast_bytes: int) -> DataFrame:
    """pairs (text key, pos, size, m, item, item_id) with `common`, the weighted overlap; only windows that start at a shingle of the item.

    Other windows shift to the right, to such a one, at no loss.
    """
    weights = cut(bags.select("item", "size", F.explode("sh").alias("h")).groupBy("item", "size", "h").agg(F.count("*").cast("int").alias("c")))
    wanted = pairs.select(TEXT_HASH, "item").distinct()
    hits = cells.join(small(weights, broadcast_bytes, 56), "h").join(wanted, [TEXT_HASH, "item"], "left_semi")
    places = hits.groupBy(TEXT_HASH, "item", "size", "h", "c").agg(F.array_sort(F.collect_list("at")).alias("ps"))
    events = F.expr(
        """flatten(transform(ps, (p, i) -> array(
             named_struct('at', greatest(CASE WHEN i >= c THEN get(ps, i - c) ELSE -1 END, p - size) + 1, 'd', 1, 'hit', false),
             named_struct('at', p, 'd', 0, 'hit', true), named_struct('at', p + 1, 'd', -1, 'hit', false))))"""
    )
    asked = F.struct("size", "m", "item_id").alias("asked")
    rows = places.select(TEXT_HASH, "item", F.explode(events).alias("e")).select(TEXT_HASH, "item", "e.at", "e.d", "e.hit", F.lit(None).cast(pairs.select(asked).schema["asked"].dataType).alias("asked"))
    marks = pairs.select(TEXT_HASH, "item", F.col("pos").alias("at"), F.lit(0).alias("d"), F.lit(False).alias("hit"), asked)
    at = rows.unionByName(marks).groupBy(TEXT_HASH, "item", "at").agg(F.sum("d").alias("d"), F.max("hit").alias("hit"), F.max("asked").alias("asked"))
    order = W.partitionBy(TEXT_HASH, "item").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    return at.withColumn("common", F.sum("d").over(order)).where("hit and asked is not null").select(TEXT_HASH, "item", F.col("at").alias("pos"), "asked.*", "common")


def contaminated(
    docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, radius: int = RADIUS, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per document and item that it contains: best similarity, the first word of the first window that has it
    among those that start at a shingle of the item, that window's number of shingles, and the text's key."""
    if not 0 <= radius <= 5 * BLOCKS - 1:
        raise ValueError("items are filed under values up to four bits away: a radius up to 19")
    spark = docs.sparkSession
    bags = bags_of(items)
    if is_empty(bags):
        return spark.createDataFrame([], SCHEMA)
    texts = docs.select(text_key().alias(TEXT_HASH), "text")
    starts = cut(starts_of(texts, bags, threshold, broadcast_bytes))
    if is_empty(starts):
        return spark.createDataFrame([], SCHEMA)
    keys = small(starts.select(TEXT_HASH), broadcast_bytes, 48)
    held = cut(_with_shingles(texts.join(keys, TEXT_HASH, "left_semi").groupBy(TEXT_HASH).agg(F.first("text").alias("text")), "text", TEXT_HASH))
    cells = held.select(TEXT_HASH, F.posexplode("sh").alias("at", "h"))
    windows = starts.select(TEXT_HASH, "n", F.explode("starts").alias("w")).select(TEXT_HASH, "n", "w.pos", "w.size")
    pairs = cut(near(fingerprints(cells, windows), bags, radius))
    similarity = F.col("common") / (F.col("m") + F.col("size") - F.col("common"))
    scored = overlaps(cells, pairs, bags, broadcast_bytes).withColumn("s", similarity).where(F.col("s") >= threshold)
    best = cut(scored.groupBy(TEXT_HASH, "item_id").agg(F.max(F.struct("s", (-F.col("pos")).alias("back"), "m")).alias(BEST)))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias(TEXT_HASH)).join(small(best, broadcast_bytes, 96), TEXT_HASH)
    return named.dropDuplicates(["doc_id", TEXT_HASH, "item_id"]).select(
        "doc_id", "item_id", F.col(f"{BEST}.s").alias("similarity"), (-F.col(f"{BEST}.back")).cast("long").alias("start"),
        F.col(f"{BEST}.m").cast("long").alias("n_shingles"), TEXT_HASH,
    )


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no benchmark item, unchanged."""
    found = cut(contaminated(docs, items, **options).select(TEXT_HASH).distinct())
    return docs.withColumn(TEXT_HASH, text_key()).join(small(found, BROADCAST_BYTES, 48), TEXT_HASH, "left_anti").select(*docs.columns)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start", "n_shingles")


#: The same rows in DuckDB's SQL: every window that starts at a shingle of an item against that item.
ORACLE_SQL = rf"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM benchmark
), ds AS (
  SELECT doc_id, pos, array_to_string(ws[pos + 1:pos + {WIDTH}], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - {WIDTH - 1})) AS pos FROM dw)
), bs AS (
  SELECT item_id, array_to_string(ws[pos + 1:pos + {WIDTH}], ' ') AS s FROM (SELECT item_id, ws, unnest(range(0, len(ws) - {WIDTH - 1})) AS pos FROM iw)
), bag AS (SELECT item_id, s, count(*) AS c, sum(count(*)) OVER (PARTITION BY item_id) AS size FROM bs GROUP BY item_id, s),
starts AS (SELECT d.doc_id, b.item_id, d.pos, CAST(b.size AS BIGINT) AS size FROM ds d JOIN bag b USING (s)),
inside AS (
  SELECT t.doc_id, t.item_id, t.pos, any_value(t.size) AS size, d.s, count(*) AS c
  FROM starts t JOIN ds d ON d.doc_id = t.doc_id AND d.pos >= t.pos AND d.pos < t.pos + t.size GROUP BY t.doc_id, t.item_id, t.pos, d.s
), met AS (
  SELECT i.doc_id, i.item_id, i.pos, any_value(i.size) AS size, sum(i.c) AS n, sum(least(i.c, coalesce(b.c, 0))) AS common
  FROM inside i LEFT JOIN bag b ON b.item_id = i.item_id AND b.s = i.s GROUP BY i.doc_id, i.item_id, i.pos
), rated AS (SELECT doc_id, item_id, pos, n, common / CAST(n + size - common AS DOUBLE) AS similarity FROM met
), best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, pos) AS rn FROM rated WHERE similarity >= {THRESHOLD})
SELECT doc_id, item_id, similarity, CAST(pos AS BIGINT) AS start, CAST(n AS BIGINT) AS n_shingles FROM best WHERE rn = 1
"""
