"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (1 to 3 characters of the lower-cased text, runs of other than letters as one
space), weighted by term frequency (share of the text's n-grams) and inverse document frequency. The weights are
learnt by follow-the-regularised-leader with elastic-net (L1 and L2) penalties, so most of them are exactly zero; a
temperature, fitted on learning rows that training does not see, calibrates the probabilities.

Learning rows are those with a language and a doc_id whose crc32 (of its decimal text) modulo 3 is not 1. Document
frequencies are counted over all learning rows. The classifier is fitted on a sample of at most `sample_rows` of them (or one
of each language, if there are more languages), the same number of each language at most, chosen by hash of the text; every
fifth sampled row of a language calibrates. Every language of the learning rows is a class.

Plan: document frequencies are one map pass whose result is one row per bucket and task, combined by bucket: the driver
gets 2 ** BITS numbers. The sample is bounded by its parameter, in rows and by `sample_chars` of summed text, and fitted
on the driver in numpy. Prediction is one pass without a shuffle over whole texts.

Defined cases: null texts and texts without a letter are `und` with score 0; a null doc_id is not held out and not learnt
from; with no learning rows every text is `und` with score 0; with one language it is predicted with score 1. Ties
between languages go to the first in alphabetical order. Repeated rows repeat their results. Very long texts are counted by
bucket, whole. Columns of other names than doc_id, text and lang are not read. The jobs that learn run while the result
is built.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import small, table

BITS, ORDERS = 16, (1, 2, 3)
SAMPLE_ROWS, SAMPLE_CHARS, EPOCHS = 4_000, 20_000_000, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2e-4, 1e-4
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
#: Numerals that are word characters to Python, but no letters.
_NUMERALS = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) in ("Nl", "No")]
#: Character sets within the first 65536 code points are looked up in a table, others are gone through: three patterns.
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_NOT_LETTERS_LOW = re.compile(rf"[\W\d_{''.join(c for c in _NUMERALS if c < chr(0x10000))}]+")
_NOT_LETTERS_ALL = re.compile(rf"[\W\d_{''.join(_NUMERALS)}]+")
_has_high = re.compile("[\U00010000-\U0010ffff]").search
_SALTS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def buckets(text: str) -> np.ndarray:
    """Hashed n-grams of a text, with repeats; empty if it has no letter (category L)."""
    pattern = _NOT_LETTERS if text.isascii() else _NOT_LETTERS_ALL if _has_high(text) else _NOT_LETTERS_LOW
    clean = pattern.sub(" ", text).strip().lower()
    if not clean:
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {clean} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint32)
    found, h = [], np.zeros(len(codes), np.uint32)
    for k, salt in zip(ORDERS, _SALTS, strict=True):
        h = (h[: len(codes) - k + 1] ^ codes[k - 1 :]) * np.uint32(salt)
        h ^= h >> np.uint32(15)
        found.append((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS))
    return np.concatenate(found).astype(np.int64)


def _frequencies(batches):
    """(bucket, texts) of a task; bucket -1 counts the texts."""
    df, n = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            seen = np.zeros(1 << BITS, bool)
            seen[buckets(text.as_py() or "")] = True
            df += seen
            n += 1
    used = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(df[used], n), pa.int64())], names=["bucket", "n"])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Multinomial logistic regression by FTRL-proximal: per weight a gradient sum and a sum of squares."""

    def __init__(self, size: int, classes: int):
        self.z, self.n = np.zeros((size, classes), np.float32), np.zeros((size, classes), np.float32)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, np.float32(0), -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1.0
        g = x[:, None] * p
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / ALPHA * w


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm.

    Targets are smoothed by one example of each other language, so that a faultless calibration set stays finite.
    """
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1.0 / (n + k))
    target[np.arange(n), y] += n / (n + k)
    loss = lambda t: -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(axis=1).mean()
    low, high, g = -6.0, 6.0, (5**0.5 - 1) / 2
    for _ in range(50):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model:
    """Languages, the row of each bucket (0: a bucket without a weight), weights by row, temperature."""

    def __init__(self, languages: list[str], row: np.ndarray, weights: np.ndarray, heat: float):
        self.languages, self.row, self.weights, self.heat = languages, row, weights, heat

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        """Of the languages, for a text's n-grams."""
        if len(found) < len(self.weights):
            sums = self.weights[self.row[found]].sum(axis=0, dtype=np.float64)
        else:
            sums = np.bincount(self.row[found], minlength=len(self.weights)) @ self.weights.astype(np.float64)
        return softmax(sums / len(found) / self.heat)


def fit(rows: list[tuple[str, str]], idf: np.ndarray) -> Model:
    """Only buckets that the rows hold have weights, so that memory follows the sample, not buckets times languages."""
    languages = sorted({lang for lang, _ in rows})
    number = {lang: k for k, lang in enumerate(languages)}
    examples = []
    for lang, text in rows:
        found = buckets(text)
        if len(found):
            at, count = np.unique(found, return_counts=True)
            # Shares of n-grams are small numbers: the mean text's norm is brought near one.
            examples.append((at, (count / len(found) * idf[at] * 10).astype(np.float32), number[lang]))
    used = np.unique(np.concatenate([at for at, *_ in examples])) if examples else np.empty(0, np.int64)
    train, held, seen = [], [], [0] * len(languages)
    for at, x, y in examples:
        seen[y] += 1
        (train if seen[y] % 5 else held).append((np.searchsorted(used, at), x, y))
    model = Ftrl(len(used), len(languages))
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(train)):
            model.learn(*train[i])
    w = model.weights()
    logits = np.array([x @ w[at] for at, x, _ in held], np.float64).reshape(len(held), len(languages))
    heat = temperature(logits, np.array([y for *_, y in held], int))
    some = np.flatnonzero((w != 0).any(axis=1))
    row = np.zeros(len(idf), np.int64)
    row[used[some]] = np.arange(1, len(some) + 1)
    return Model(languages, row, np.concatenate([np.zeros((1, len(languages)), np.float32), w[some] * (idf[used[some]] * 10).astype(np.float32)[:, None]]), heat)


def _predict(model: Model | None):
    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = buckets(text.as_py() or "") if model else ()
                lang, score = "und", 0.0
                if len(found):
                    p = model.probabilities(found)
                    best = int(p.argmax())
                    lang, score = model.languages[best], float(p[best])
                held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
                for column, value in zip(out, (doc_id, held, lang, score), strict=True):
                    column.append(value)
            types = [pa.int64(), pa.bool_(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 1


def identify(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): held_out, the predicted language and its calibrated probability."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    learn = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
    counted = learn.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = {r["bucket"]: r["n"] for r in counted.collect()}  # at most 2 ** BITS + 1 rows
    total = df.pop(-1, 0)
    if not total:
        return rows.mapInArrow(_predict(None), SCHEMA)
    idf = np.full(1 << BITS, np.log1p(total))
    at = np.fromiter(df, np.int64, len(df))
    idf[at] = np.log1p(total / np.fromiter(df.values(), np.float64, len(df)))
    by_lang = learn.groupBy("lang").agg(F.count("*").alias("n"), F.avg(F.length("text")).alias("chars"))
    sizes = by_lang.collect()  # one row per language: the classes of the model
    per = sample_chars // len(sizes)
    share = max(1, min(sample_rows // len(sizes), int(per / max(1, max(r["chars"] for r in sizes))) + 1))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / (1 << 40)
    # One and a half times the share, and twenty rows more, so that a draw by hash leaves no language without a row.
    n_of = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, (1.5 * share + 20) / r["n"])) for r in sizes], "lang string, wanted double")
    fits = F.length("text") <= per  # a text longer than a language's share of the characters is left to the others: the sample stays bounded
    drawn = learn.where(fits).join(small(n_of, 8_000_000, 64), "lang").where(draw < F.col("wanted")).withColumn("h", F.xxhash64("text"))
    drawn = drawn.groupBy("lang", "h").agg(F.min("text").alias("text"))  # a text that many rows hold is one example
    order = W.partitionBy("lang").orderBy("h")
    running = F.sum(F.length("text")).over(order.rowsBetween(W.unboundedPreceding, 0))
    sample = drawn.withColumns({"k": F.row_number().over(order), "c": running}).where((F.col("k") <= share) & (F.col("c") <= per))
    taken = sorted((r["h"], r["lang"], r["text"]) for r in sample.select("h", "lang", "text").collect())
    return rows.mapInArrow(_predict(fit([(lang, text) for _, lang, text in taken], idf)), SCHEMA)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
