"""What the training-data operators share: table access, row keys, words, checkpoints and connected components."""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every word-based operator: space and the ASCII control characters 9 to 13.
SEPARATORS = r"[\x20\x09-\x0D]+"

#: Prefix of columns that operators add for themselves; input columns of any other name never clash.
OWN = "__kf_"
ID, TEXT_HASH = f"{OWN}id", f"{OWN}th"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared checkpoint folder, so that no later failure recomputes them.

    The folder is the cluster's spark.checkpoint.dir; only where that is unset on a local master (tests) a temporary one is made.
    """
    context = df.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kinfold-checkpoint-"))
    return df.checkpoint()


def release() -> None:
    """Gives memory that Python, Arrow and the C library hold in reserve back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run):
    """An Arrow map function that releases its memory when its task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def text_key(text: str | Column = "text") -> Column:
    """128 bits that stand for a text; null counts as empty. At 10^12 texts a collision has a chance of 10^-15."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


def small(df: DataFrame, limit: int, row_bytes: Column | int) -> DataFrame:
    """df, marked for broadcast if its rows, of `row_bytes` each, take at most `limit` bytes."""
    size = df.agg(F.coalesce(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def words(text: Column) -> Column:
    """Lower-cased words; null and blank texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def shingles(word_hashes: Column, width: int) -> Column:
    """64-bit hashes of all runs of `width` words, in text order; none for shorter texts."""
    n = F.size(word_hashes)
    starts = F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(word_hashes, i + k) for k in range(width))))


#: Up to this many edges (16 bytes each) one task labels a graph.
SMALL_GRAPH = 1_000_000


def _label(batches):
    """Min-label propagation with pointer jumping over one bounded graph."""
    tables = [pa.Table.from_batches([b]) for b in batches]
    if not tables:
        return
    table = pa.concat_tables(tables)
    nodes, ends = np.unique(np.concatenate([table.column("a").to_numpy(), table.column("b").to_numpy()]), return_inverse=True)
    a, b = np.split(ends, 2)
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[label], pa.int64())], names=["node", "comp"])


def components(edges: DataFrame, small: int = SMALL_GRAPH) -> DataFrame:
    """Connected components of edges (a, b): one row (node, comp), comp the smallest node of the component.

    At most `small` edges are labelled by one task. Beyond that every round each node takes the smallest label among itself
    and its neighbours, then labels are followed one step (pointer jumping), so star-like groups settle in two or three
    rounds and long chains in logarithmically many; only the number of changed labels reaches the driver.
    """
    edges = cut(edges.select("a", "b"))
    if edges.count() <= small:
        return cut(edges.coalesce(1).mapInArrow(_label, "node long, comp long"))
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("low"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "low").alias("comp"))
        # A label is itself a node: its own new label is at least as small.
        hop = step.select(F.col("node").alias("comp"), F.col("comp").alias("hop"))
        new = cut(step.join(hop, "comp", "left").select("node", "old", F.least("comp", "hop").alias("comp")))
        changed = new.where("old <> comp").count()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def spans_sql(kind: str, order: int, pattern: str, holds: str) -> str:
    """DuckDB's (doc_id, kind, ord, a, z) of d(doc_id, text): the matches m of a pattern for which `holds`; places come from the
    pieces between matches."""
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS ord, z - length(m) AS a, z FROM (
  SELECT doc_id, m, sum(length(m) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS z FROM (
    SELECT doc_id, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, regexp_split_to_array(text, '{pattern}') AS gaps FROM d))) WHERE {holds}"""
