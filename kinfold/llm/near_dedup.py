"""Near-duplicate classes by BagMinHash signatures, banding and exact multiset verification.

Plan
----
1. One pass over the texts gives each document a hash of its normalised word sequence and the band hashes of its
   BagMinHash signature. Documents of equal word sequence collapse to one node before anything else is shuffled, so a
   group of exact copies of any size costs one row per document and nothing more.
2. Band buckets with two or more nodes propose links. A bucket first compares its members with its smallest member only (a
   star), which settles a group whose members all resemble that one in linear time. Verified links merge members into
   components. Buckets that then still hold several components are compared exactly, every pair of different
   components, in blocks of bounded size: a block pair is one task's group, its overlaps are products of 0/1 matrices, and
   it returns one row per member at most, never its pairs. No link between different texts is lost to a cap; the price is
   that an unsettled bucket of n members costs n * n / BLOCK rows of shuffle.
3. Verification is exact: the multiset (weighted) Jaccard similarity of five-word shingles, at least `threshold`.
4. Links become classes by distributed connected components.

Recall: a pair at the threshold shares no band with probability 2e-4, at 0.85 with 2e-6; a pair at 0.45 is proposed
with probability 0.21.

BagMinHash: a shingle of weight w owns the interval [0, w) of a weight axis discretised at the integers. The axis is
cut into the dyadic intervals [0, 1), [1, 2), [2, 4), ...; each (shingle, interval) has its own Poisson process whose
points carry an arrival time, a register and, by hash bits that halve the interval again and again, a unit cell.
A point counts if its cell lies below w. A register keeps its earliest point, so two documents agree in a register with
probability sum(min)/sum(max) of the weights. Times beyond the bound by which all registers are filled are never drawn.

Defined cases: null or blank text has no shingles: each such row is a class of its own. Texts of one to four words have
one shingle, the whole text. class_id is the smallest doc_id of the class; rows of the same doc_id and text are one document;
different texts under one doc_id, or without one, are documents of their own, and a class without any doc_id has a null
class_id. keep_one keeps of each class the document with the smallest doc_id (null last, ties by a hash of the text), once.
Very long texts are hashed and signed whole, one at a time. Other columns, whatever their names, are passed through by
keep_one. Empty tables give empty results. The jobs that find links run while the result is built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, components, cut, is_empty, releasing, table, text_key

WIDTH, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8 ** ROWS) ** BANDS, about 2e-4.
BANDS, ROWS = 28, 6
#: Members of a block in exact comparison.
BLOCK = 1024
#: Words hashed at once.
BATCH_WORDS = 150_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the splitmix64 constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash, bounded in size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def split_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingle_hashes(words: list[bytes], hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Hashes of all runs of `width` words, with repeats; a shorter text has one, the whole of it."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(width, n)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix((out ^ codes[k : n - width + 1 + k]) + _GOLDEN)
    return out


def bag_signatures(elements: np.ndarray, weights: np.ndarray, starts: np.ndarray, registers: int) -> np.ndarray:
    """BagMinHash signatures of several bags: elements[starts[d]:starts[d + 1]] with integer weights make bag d."""
    n_docs = len(starts) - 1
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(n_docs), sizes)
    total = np.add.reduceat(weights, starts[:-1]).astype(np.float64)
    # Dyadic intervals: number 0 is [0, 1), number j is [2 ** (j - 1), 2 ** j).
    rows = [(doc, elements, weights, np.zeros(len(doc), np.int64))]
    j = 1
    while (heavy := weights > (1 << (j - 1))).any():
        rows.append((doc[heavy], elements[heavy], weights[heavy], np.full(int(heavy.sum()), j)))
        j += 1
    doc, elem, weight, level = (np.concatenate(x) for x in zip(*rows, strict=True))
    base = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(base, 1)
    seed = mix(elem + _GOLDEN * (level.astype(np.uint64) + np.uint64(1)))
    signature = np.full(n_docs * registers, np.inf)
    bound = (np.log(registers) + 5) / total
    todo = np.ones(n_docs, bool)
    while todo.any():
        live = np.flatnonzero(todo[doc])
        time = np.zeros(len(live))
        step = np.uint64(0)
        while len(live):
            step += np.uint64(1)
            h = mix(seed[live] + np.multiply(_GOLDEN, [step]))
            time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (registers * width[live])
            near = time < bound[doc[live]]
            live, time, h = live[near], time[near], h[near]
            place = mix(h + _GOLDEN)
            cell = base[live] + ((place >> np.uint64(40)).astype(np.int64) & (width[live] - 1))
            inside = cell < weight[live]
            register = (place & np.uint64(0xFFFFFFFF)) % np.uint64(registers)
            np.minimum.at(signature, doc[live][inside] * registers + register[inside].astype(np.int64), time[inside])
        todo &= np.isinf(signature.reshape(n_docs, registers)).any(axis=1)
        bound[todo] *= 3
    return signature.reshape(n_docs, registers)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, (len(signature), bands))
    for k in range(rows):
        out = mix((out ^ bits[:, :, k]) + _GOLDEN)
    return out.view(np.int64)


#: What makes a document: id (null last) and text.
ROW = f"{OWN}row"
SIGNED = f"doc_id long, {ROW} struct<none:boolean,id:long,a:long,b:long>, k1 long, k2 long, n_shingles int, bands array<long>"


def row_key() -> Column:
    text, id_ = text_key(), F.col("doc_id").cast("long")
    return F.struct(id_.isNull().alias("none"), F.coalesce(id_, F.lit(0)).alias("id"), text["a"].alias("a"), text["b"].alias("b"))


def _sign(bands: int, rows: int):
    def flush(ids, rows_of, keys, bags):
        full = [i for i, b in enumerate(bags) if len(b)]
        uniques = [np.unique(bags[i], return_counts=True) for i in full]
        found = np.empty((0, bands), np.int64)
        if full:
            starts = np.concatenate(([0], np.cumsum([len(u) for u, _ in uniques])))
            signature = bag_signatures(np.concatenate([u for u, _ in uniques]), np.concatenate([c for _, c in uniques]), starts, bands * rows)
            found = band_hashes(signature, bands, rows)
        lengths = np.zeros(len(ids), np.int64)
        lengths[full] = bands
        offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.concat_arrays(rows_of),
                pa.array(np.array([k[0] for k in keys], np.uint64).view(np.int64)),
                pa.array(np.array([k[1] for k in keys], np.uint64).view(np.int64)),
                pa.array([len(b) for b in bags], pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array(found.ravel())),
            ],
            names=["doc_id", ROW, "k1", "k2", "n_shingles", "bands"],
        )

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            doc_ids, begin, keys, bags, size = batch.column(0).to_pylist(), 0, [], [], 0
            for i, text in enumerate(batch.column(2)):
                words = split_words(text.as_py())
                key = xxhash.xxh3_128_intdigest(b" ".join(words))
                keys.append((key >> 64, key & 0xFFFFFFFFFFFFFFFF))
                bags.append(shingle_hashes(words, hashes))
                size += len(words)
                if size >= BATCH_WORDS or i == len(doc_ids) - 1:
                    yield flush(doc_ids[begin : i + 1], [batch.column(1).slice(begin, i + 1 - begin)], keys, bags)
                    begin, keys, bags, size = i + 1, [], [], 0

    return run


def _bags(batches):
    """Sorted shingle hashes, with repeats, of each text."""
    hashes = WordHashes()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            bag = np.sort(shingle_hashes(split_words(text.as_py()), hashes)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([bag.tobytes()], pa.binary())], names=["id", "bag"])


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays with repeats."""
    (ua, ca), (ub, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    union = len(a) + len(b) - common
    return common / union if union else 0.0


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            keep = [
                overlap(np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)) >= threshold
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], names=["a", "b", "linked"])

    return run


def verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked) of distinct pairs of document ids."""
    left = pairs.join(bags.select(F.col("id").alias("a"), F.col("bag").alias("bag_a")), "a")
    both = left.join(bags.select(F.col("id").alias("b"), F.col("bag").alias("bag_b")), "b")
    low, high = F.least(F.length("bag_a"), F.length("bag_b")), F.greatest(F.length("bag_a"), F.length("bag_b"))
    near = both.where(low >= threshold * high).select("a", "b", "bag_a", "bag_b")
    return near.mapInArrow(_verify(threshold), "a long, b long, linked boolean")


def linked_groups(reps: np.ndarray, comps: np.ndarray, bags: list[np.ndarray], threshold: float) -> np.ndarray:
    """For each bag the first member of its connected group, links being pairs of different comps within the threshold."""
    n, sizes = len(bags), np.array([len(b) for b in bags], np.float32)
    row = np.repeat(np.arange(n), [len(b) for b in bags])
    flat = np.concatenate(bags)
    # The k-th occurrence of a shingle is an element of its own: multisets become sets.
    first = np.ones(len(flat), bool)
    first[1:] = (flat[1:] != flat[:-1]) | (row[1:] != row[:-1])
    run = np.arange(len(flat)) - np.maximum.accumulate(np.where(first, np.arange(len(flat)), 0))
    elements, column, count = np.unique(mix(flat.view(np.uint64) + _GOLDEN * run.astype(np.uint64)), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), np.float32)
    for low in range(0, int((count > 1).sum()), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    # Counts are exact in float32; the quotient is compared in double precision, as in `overlap`.
    link = (common.astype(np.float64) / union >= threshold) | (comps[:, None] == comps[None, :])
    label = np.arange(n)
    while True:
        low = np.where(link, label[None, :], n).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _compare(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("rep").to_numpy())
        reps = group.column("rep").to_numpy()[order]
        comps = group.column("comp").to_numpy()[order]
        bags = [np.frombuffer(x.as_py(), np.int64) for x in group.column("bag").take(pa.array(order)).combine_chunks()]
        label = linked_groups(reps, comps, bags, threshold)
        moved = np.flatnonzero(comps[label] != comps)
        return pa.table({"a": pa.array(comps[moved], pa.int64()), "b": pa.array(comps[label[moved]], pa.int64())})

    return run


def links_of(members: DataFrame, bags: DataFrame, threshold: float, block: int) -> DataFrame | None:
    """Labels (node, comp) of the components that the verified pairs of all buckets (key, rep) form; None: no pair."""
    leaders = members.groupBy("key").agg(F.min("rep").alias("b"))
    star = members.join(leaders, "key").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    edges = cut(verified(star, bags, threshold).where("linked").select("a", "b"))
    labels = None if is_empty(edges) else components(edges)
    labelled = members.withColumn("comp", F.col("rep"))
    if labels is not None:
        joined = members.join(labels, members["rep"] == labels["node"], "left")
        labelled = joined.select("key", "rep", F.coalesce("comp", "rep").alias("comp"))
    sized = labelled.join(bags.select(F.col("id").alias("rep"), F.length("bag").alias("bytes")), "rep")
    of_key = sized.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.min("rep").alias("first"), F.max("rep").alias("last"),
    ).where("lo < hi")
    # Buckets of the same members are compared once.
    once = of_key.groupBy("n", "x", "first", "last").agg(F.min("key").alias("key"), F.first("bytes").alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("bytes") / F.lit(8_000_000))).cast("int").alias("parts")
    held = cut(labelled.join(once.select("key", parts), "key"))
    if is_empty(held):
        return labels
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    spread = held.withColumn("own", own).select("key", "rep", "comp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = spread.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "comp")
    full = dealt.join(bags.select(F.col("id").alias("rep"), "bag"), "rep").select("key", "i", "j", "rep", "comp", "bag")
    merged = full.groupBy("key", "i", "j").applyInArrow(_compare(threshold), "a long, b long").distinct()
    more = cut(merged)
    if is_empty(more):
        return labels
    # Components that met are linked through their own smallest members.
    return components(edges.union(more))


def classified(docs: DataFrame, threshold: float, bands: int, rows: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed rows; nodes (k1, k2, node, class_id, lead), lead being the row that stands for the class; rows that repeat)."""
    texts = docs.select(F.col("doc_id").cast("long"), row_key().alias(ROW), F.col("text").cast("string"))
    signed = cut(texts.mapInArrow(releasing(_sign(bands, rows)), SIGNED))
    full = signed.where("n_shingles > 0")
    repeated = cut(full.groupBy(ROW).agg(F.count("*").alias("n")).where("n > 1").select(ROW))
    # A table of its own: joins with it shuffle both sides, so that a hot group of copies can be split at run time.
    found = full.groupBy("k1", "k2").agg(F.min(ROW).alias("lead"), F.min("doc_id").alias("low"))
    nodes = cut(found.withColumn("node", F.monotonically_increasing_id()))
    buckets = full.join(nodes, ["k1", "k2"]).where(F.col(ROW) == F.col("lead")).select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = cut(buckets.join(shared, "key", "left_semi").select("key", F.col("node").alias("rep")).distinct())
    labels = None
    if not is_empty(members):
        wanted = nodes.join(members.select(F.col("rep").alias("node")).distinct(), "node", "left_semi").select("node", F.col("lead").alias(ROW))
        bags = texts.join(wanted, ROW).select("node", "text").mapInArrow(releasing(_bags), "id long, bag binary")
        bags = cut(bags if is_empty(repeated) else bags.dropDuplicates(["id"]))
        labels = links_of(members, bags, threshold, block)
    if labels is None:
        return signed, nodes.withColumnRenamed("low", "class_id"), repeated
    own = nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = own.groupBy("comp").agg(F.min("low").alias("class_id"), F.min("lead").alias("lead"))
    return signed, cut(own.select("k1", "k2", "node", "comp").join(classes, "comp").drop("comp")), repeated


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row (doc_id, class_id) per row of docs."""
    signed, nodes, _ = classified(docs, threshold, bands, rows, block)
    named = signed.where("n_shingles > 0").join(nodes, ["k1", "k2"]).select("doc_id", "class_id")
    return named.union(signed.where("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame, *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One document of each class of near duplicates, unchanged; documents without a word stay."""
    signed, nodes, repeated = classified(docs, threshold, bands, rows, block)
    kept = nodes.select(F.col("lead").alias(ROW)).union(signed.where("n_shingles = 0").select(ROW)).distinct()
    out = docs.withColumn(ROW, row_key()).join(kept, ROW, "left_semi")
    if not is_empty(repeated):  # rows of the same doc_id and text: one of them stays
        out = out.join(repeated, ROW, "left_anti").unionByName(out.join(repeated, ROW, "left_semi").dropDuplicates([ROW]))
    return out.select(*docs.columns)


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
