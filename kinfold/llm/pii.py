"""Personal data: pattern spans, and candidates that boosted trees with calibrated thresholds select beside them.

Base kinds are patterns with a rule each (RULES): email, ip (parts at most 255), card (13 to 19 digits, Luhn), phone
(9 to 15 digits); a match that fails its rule is dropped. The method adds spans and takes none away:

1. High-recall generators propose spans that may overlap each other and failed matches: single digit runs, groups of
   four, short and long dial shapes, local numbers, dotted quads, addresses spelled with "(at)". A base match swallows all it
   can and is dropped whole when it fails ("+1 (269) 555-3296 4524132264652876" is no phone); what it swallowed is proposed.
2. Labels come from the base matches, not from the proposals: a proposal that is exactly a base span is positive; one free of
   base spans is negative if it is exactly a base match that failed, or if letters or digits stand at its edge (a piece of
   a longer token); the others, those that the method is there to judge, have no label and are never learnt from.
3. Gradient-boosted trees score each proposal from its format (length, digits, groups, signs, checksum, parts) and context
   (characters and words beside it). They are trained here on three of five of all distinct labelled proposals, told apart by
   the order of a hash, so that neither repeats nor the layout of the input decide. Proposals of equal features and label
   are one weighted row; the trees get as many bins as it takes that Spark looks for splits in all rows, not in a sample.
   (`sample_rows`, none unless given, bounds the proposals for callers that want it.)
4. On the two of five that the trees have not seen, a logistic fit on their margin, with an offset for each generator,
   calibrates the scores, and each generator gets the smallest probability (a half at least) above which at least
   `precision` of its held-out proposals are positive, with `least` positives at least. Base matches have no part in this. A
   generator without such a threshold adds nothing.
5. Proposals free of base spans at or above their threshold are reported under the kind ml_<generator>, but for those
   inside another one.

Everything is DataFrame functions and pyspark.ml; the fits run while the result is built. Positions come from the pieces
between matches: the k-th match starts at the lengths of all pieces up to it plus the matches before it, a running sum
per document. Texts without a digit, "@", "(at)" or "[at]" never leave the first filter; only proposals are shuffled.
Patterns start only where a run of their characters starts (or the last match ended), so they are linear in the text.

Defined cases: null and empty texts: counts 0, the digest of the empty string, spans ''; rows of the same doc_id and text
are one document with the same result on each row; a null doc_id stays null; very long texts are one row's work, their
proposals rows; other columns, whatever their names, are passed through by redact and not read by find_pii; an empty table
gives an empty result; without proposals of both labels no model is trained and the base spans are the result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ID, OWN, TEXT_HASH, cut, spans_sql, table, text_key

BASE = ("email", "ip", "card", "phone")
#: A start that no match of the same run can precede: the run's first character, or the end of the match before.
_RUN = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
PATTERNS = {
    "email": _RUN + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "digits": r"(?<![0-9])[0-9]{13,19}(?![0-9])",
    "fours": r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
    "dial": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){2}(?![0-9])",
    "dial_long": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){3,5}(?![0-9])",
    "local": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "quad": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "handle": _RUN + r"\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
}
GENERATORS = tuple(g for g in PATTERNS if g not in BASE)
KINDS = (*BASE, *(f"ml_{g}" for g in GENERATORS))
ANY = r"[0-9@]|[(\[]at[)\]]"
SAMPLE_ROWS, PRECISION, LEAST, CONTEXT = None, 0.95, 3, 24
#: Bins of a feature, and the rows up to which Spark's trees read all of them for its splits with so few.
BINS, BINNED_ROWS = 32, 10_000
KEYWORDS = {"tel": "tel|phone|call|fax|mobil", "pay": "card|visa|credit|pay|iban|konto", "mail": "mail|contact|write", "net": r"\bip|host|server|addr|login", "key": "token|secret|key|hash|id"}
NO_ID = -(2**63)
SPANS, ORDERED = f"{OWN}spans", f"{OWN}ordered"


def candidates(keyed: DataFrame) -> DataFrame:
    """(id, th, gen, start, end, m, left, right): every match of every generator, positions in code points."""
    text = F.col("text")

    def proposals(gen: str, pattern: str) -> Column:
        rows = F.transform(
            F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")),
            lambda x, i: F.struct(F.lit(gen).alias("gen"), i.alias("i"), x["piece"].alias("piece"), x["m"].alias("m")),
        )
        return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<gen:string,i:int,piece:string,m:string>>"))

    some = keyed.where(text.rlike(ANY))
    each = some.select(ID, TEXT_HASH, F.concat(*(proposals(g, p) for g, p in PATTERNS.items())).alias("c"))
    rows = each.select(ID, TEXT_HASH, F.explode_outer("c").alias("x")).where("x is not null").select(
        ID, TEXT_HASH, "x.gen", "x.i", F.length("x.piece").alias("gap"), F.coalesce(F.length("x.m"), F.lit(0)).alias("len"),
        F.right("x.piece", F.lit(CONTEXT)).alias("left"), F.left("x.piece", F.lit(CONTEXT)).alias("head"), "x.m",
    )
    once = rows.dropDuplicates([ID, TEXT_HASH, "gen", "i"])
    order = W.partitionBy(ID, TEXT_HASH, "gen").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(order.rowsBetween(W.unboundedPreceding, 0)).alias("end")
    placed = once.select(ID, TEXT_HASH, "gen", end, "len", "m", "left", F.lead("head").over(order).alias("right")).where("m is not null")
    return placed.select(ID, TEXT_HASH, "gen", (F.col("end") - F.col("len")).alias("start"), "end", "m", "left", F.coalesce("right", F.lit("")).alias("right"))


def with_rules(rows: DataFrame) -> DataFrame:
    """Adds n_digits, luhn, quad (all parts at most 255), and base: whether this is a base match that passes its rule."""
    numbered = rows.withColumn("digits", F.regexp_replace("m", "[^0-9]", "")).withColumn("n_digits", F.length("digits"))
    doubled = F.expr(
        """aggregate(sequence(1, n_digits), 0, (s, k) -> s + CASE WHEN (n_digits - k) % 2 = 0 THEN cast(substr(digits, k, 1) AS int)
           ELSE 2 * cast(substr(digits, k, 1) AS int) - CASE WHEN substr(digits, k, 1) >= '5' THEN 9 ELSE 0 END END) % 10 = 0"""
    )
    # Short texts only reach the sum: a run of thousands of digits is no card.
    luhn = F.when(F.col("n_digits").between(13, 19), doubled).otherwise(False)

    def byte(part: Column) -> Column:
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) <= 3) & (F.coalesce(F.when(F.length(value) <= 3, value).try_cast("int"), F.lit(0)) <= 255)

    known = numbered.withColumn("luhn", luhn).withColumn("quad", F.when(F.col("gen").isin("ip", "quad"), F.forall(F.split("m", r"\."), byte)).otherwise(False))
    base = (
        F.when(F.col("gen") == "email", True).when(F.col("gen") == "ip", F.col("quad")).when(F.col("gen") == "card", F.col("luhn"))
        .when(F.col("gen") == "phone", F.col("n_digits").between(9, 15)).otherwise(False)
    )
    return known.drop("digits").withColumn("base", F.coalesce(base, F.lit(False)))


def with_labels(rows: DataFrame) -> DataFrame:
    """Adds free (no base span overlaps it) and label (null: neither a base span nor known to be none)."""
    order = W.partitionBy(ID, TEXT_HASH).orderBy("start")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rangeBetween(W.unboundedPreceding, 0))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rangeBetween(0, W.unboundedFollowing))
    here = W.partitionBy(ID, TEXT_HASH, "start", "end")
    proposed = ~F.col("gen").isin(*BASE)
    placed = rows.withColumns(
        {"free": (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end")), "same": F.max("base").over(here), "failed": F.max(~F.col("base") & ~proposed).over(here)}
    )
    glued = F.col("left").rlike(r"[\p{L}0-9]$") | F.col("right").rlike(r"^[\p{L}0-9]")
    label = F.when(F.col("same"), 1.0).when(F.col("free") & (F.col("failed") | glued), 0.0)
    return placed.withColumn("label", F.when(proposed, label)).drop("same", "failed")


def features() -> dict[str, Column]:
    m, left, right = F.col("m"), F.col("left"), F.col("right")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    count = lambda pattern: F.regexp_count(m, F.lit(pattern)).cast("double")
    out = {f"gen_{g}": flag(F.col("gen") == g) for g in GENERATORS}
    out |= {"len": F.least(F.length(m), F.lit(200)).cast("double"), "digits": F.least("n_digits", F.lit(200)).cast("double"), "letters": count("[A-Za-z]"), "groups": count("[0-9]+")}
    out |= {"luhn": flag(F.col("luhn")), "quad": flag(F.col("quad")), "first": F.coalesce(F.substring("m", 1, 1).try_cast("double"), F.lit(-1.0))}
    out |= {"dots": count(r"\."), "spaces": count(" "), "dashes": count("-"), "parens": count(r"[()]"), "plus": flag(m.startswith("+")), "at": count("@")}
    out |= {"longest": F.coalesce(F.array_max(F.transform(F.split(m, "[^0-9]+"), F.length)), F.lit(0)).cast("double"), "zero": flag(m.startswith("0"))}
    for side, text, edge in (("l", left, "$"), ("r", right, "^")):
        near = lambda c, edge=edge: f"{c}$" if edge == "$" else f"^{c}"
        out |= {f"{side}_letter": flag(text.rlike(near(r"\p{L}"))), f"{side}_digit": flag(text.rlike(near("[0-9]"))), f"{side}_space": flag(text.rlike(near(r"\s")))}
        out |= {f"{side}_plus": flag(text.rlike(near(r"\+"))), f"{side}_quote": flag(text.rlike(near("[\"'=:#]"))), f"{side}_none": flag(text == "")}
    return out | {f"word_{k}": flag(left.rlike(f"(?i){p}")) for k, p in KEYWORDS.items()}


class Selector:
    """Trees, calibration and a threshold for each generator."""

    def __init__(self, trees, calibration, thresholds: dict[str, float]):
        self.trees, self.calibration, self.thresholds = trees, calibration, thresholds

    def score(self, rows: DataFrame) -> DataFrame:
        """rows with p, the calibrated probability."""
        return _calibrated(self.calibration, _scored(self.trees, rows))

    def selected(self, rows: DataFrame) -> DataFrame:
        limit = F.coalesce(*(F.when(F.col("gen") == g, p) for g, p in self.thresholds.items()), F.lit(2.0))
        return self.score(rows).where(F.col("p") >= limit)


FEATURES, MARGIN = f"{OWN}features", f"{OWN}margin"


def _scored(trees, rows: DataFrame) -> DataFrame:
    """rows with the trees' margin, and the calibration's features: it and the generator."""
    named = features()
    own = {f"{OWN}{k}": c for k, c in named.items()}
    data = VectorAssembler(inputCols=list(own), outputCol=FEATURES).transform(rows.withColumns(own)).drop(*own)
    raw = trees.transform(data).withColumn(MARGIN, vector_to_array("rawPrediction")[1])
    return raw.drop(FEATURES, "rawPrediction", "probability", "prediction")


def _offsets(rows: DataFrame) -> DataFrame:
    flags = {f"{OWN}is_{g}": (F.col("gen") == g).cast("double") for g in GENERATORS}
    return VectorAssembler(inputCols=[MARGIN, *flags], outputCol=FEATURES).transform(rows.withColumns(flags)).drop(*flags)


def _calibrated(calibration, rows: DataFrame) -> DataFrame:
    out = calibration.transform(_offsets(rows)).withColumn("p", vector_to_array("probability")[1])
    return out.drop(FEATURES, MARGIN, "rawPrediction", "probability", "prediction")


def _parted(known: DataFrame, keys: list[str]) -> DataFrame:
    """known with fit: two of five of either label, in the order of the hash, are held out.

    The place of a proposal is its place in one of 1024 ranges of the hash plus the sizes of those before: no task sorts a whole label.
    """
    place = F.xxhash64("m", "left", "right", "gen")
    rows = cut(known.withColumn("range", F.shiftright(place, 54)))
    sizes = rows.groupBy("label", "range").agg(F.count("*").alias("n"))  # 2048 rows at most
    before = F.sum("n").over(W.partitionBy("label").orderBy("range")) - F.col("n")
    within = F.row_number().over(W.partitionBy("label", "range").orderBy(place, *keys))
    placed = rows.join(F.broadcast(sizes.select("label", "range", before.alias("before"))), ["label", "range"])
    return placed.withColumn("fit", (F.col("before") + within) % 5 % 2 == 1).drop("before", "range")


def train(rows: DataFrame, sample_rows: int | None, precision: float, least: int) -> Selector | None:
    """None if the labelled proposals do not hold both labels, on either part. All of them count, unless `sample_rows` is given."""
    keys = ["gen", "m", "left", "right", "n_digits", "luhn", "quad"]
    known = rows.where("label is not null").groupBy(*keys).agg(F.max("label").alias("label"))
    if sample_rows is not None:
        known = known.orderBy(F.xxhash64("m", "left", "right", "gen"), *keys).limit(sample_rows)
    parted = cut(_parted(known, keys))
    both = {(r["fit"], r["label"]) for r in parted.select("fit", "label").distinct().collect()}  # four rows
    if len(both) < 4:
        return None
    named, weight = {f"{OWN}{k}": c for k, c in features().items()}, f"{OWN}weight"
    distinct = parted.where("fit").withColumns(named).groupBy(*named, "label").agg(F.count("*").cast("double").alias(weight))
    data = cut(VectorAssembler(inputCols=list(named), outputCol=FEATURES).transform(distinct).select(FEATURES, "label", weight))
    n, total = data.agg(F.count("*"), F.sum(weight)).first()
    # Spark reads max(BINNED_ROWS, bins squared) rows for the splits; a node has two proposals at least.
    bins = BINS if n <= BINNED_ROWS else max(BINS, math.isqrt(n) + 1)
    trees = GBTClassifier(
        featuresCol=FEATURES, weightCol=weight, maxIter=12, maxDepth=4, stepSize=0.3, seed=42, maxBins=bins, minInstancesPerNode=1, minWeightFractionPerNode=min(0.49, 1.5 / total)
    ).fit(data)
    held = _scored(trees, parted.where("not fit").select(*keys, "label")).groupBy("gen", "label", MARGIN).agg(F.count("*").cast("double").alias(weight))
    held = cut(held)
    calibration = LogisticRegression(featuresCol=FEATURES, weightCol=weight, regParam=0.001, maxIter=50).fit(_offsets(held))
    # Ordered by steps of a thousandth: a window over the steps, not over the proposals.
    hit, every = F.sum(F.col("label") * F.col(weight)), F.sum(weight)
    steps = _calibrated(calibration, held).groupBy("gen", F.floor(F.col("p") * 1000).alias("step")).agg(hit.alias("hit"), every.alias("n"))
    order = W.partitionBy("gen").orderBy(F.col("step").desc())
    above = steps.where("step >= 500").withColumns({"hit": F.sum("hit").over(order), "n": F.sum("n").over(order)})
    chosen = above.where((F.col("hit") >= least) & (F.col("hit") >= precision * F.col("n"))).groupBy("gen").agg((F.min("step") / 1000).alias("p"))
    return Selector(trees, calibration, {r["gen"]: r["p"] for r in chosen.collect()})  # one row per generator


def selected(rows: DataFrame, sample_rows: int | None, precision: float, least: int) -> DataFrame:
    """(id, text key, kind, start, end): base spans, and proposals that the model selects."""
    names = (ID, TEXT_HASH, "kind", "start", "end")
    base = rows.where("base").withColumn("kind", F.col("gen")).select(*names)
    model = train(rows, sample_rows, precision, least)
    if model is None or not model.thresholds:
        return base
    added = model.selected(rows.where(F.col("free") & F.col("gen").isin(*GENERATORS)))
    order = W.partitionBy(ID, TEXT_HASH).orderBy("start", F.col("end").desc(), "gen").rowsBetween(W.unboundedPreceding, -1)
    outer = added.withColumn("reach", F.max("end").over(order)).where("reach is null or reach < end")
    return base.unionByName(outer.withColumn("kind", F.concat(F.lit("ml_"), "gen")).select(*names))


def spans_of(docs: DataFrame, sample_rows: int | None, precision: float, least: int) -> tuple[DataFrame, DataFrame]:
    """docs with document keys, and (id, text key, spans): the spans of each document that has some, by kind, then start."""
    keyed = docs.withColumns({ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), TEXT_HASH: text_key()})
    rows = cut(with_labels(with_rules(candidates(keyed.select(ID, TEXT_HASH, "text")))))
    spans = selected(rows, sample_rows, precision, least)
    place = F.coalesce(*(F.when(F.col("kind") == k, i) for i, k in enumerate(KINDS))).alias("k")
    return keyed, spans.groupBy(ID, TEXT_HASH).agg(F.array_sort(F.collect_list(F.struct(place, "start", "end", "kind"))).alias(SPANS))


def find_pii(docs: DataFrame, *, sample_rows: int | None = SAMPLE_ROWS, precision: float = PRECISION, least: int = LEAST) -> DataFrame:
    """One row per row of docs (doc_id, text): counts of the base kinds and of all spans, digest of the base spans, all spans."""
    keyed, listed = spans_of(docs.select("doc_id", "text"), sample_rows, precision, least)
    joined = keyed.select(F.col("doc_id").cast("long"), ID, TEXT_HASH).join(listed, [ID, TEXT_HASH], "left")
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    every = joined.withColumn("spans", F.coalesce(SPANS, F.array().cast(listed.schema[SPANS].dataType)))
    counts = [F.size(F.expr(f"filter(spans, s -> s.k = {k})")).cast("long").alias(f"n_{g}") for k, g in enumerate(BASE)]
    base = text(F.filter("spans", lambda s: s["k"] < len(BASE)))
    return every.select("doc_id", *counts, F.size("spans").cast("long").alias("n_spans"), F.sha2(base, 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, *, sample_rows: int | None = SAMPLE_ROWS, precision: float = PRECISION, least: int = LEAST) -> DataFrame:
    """docs with every span of `text` replaced by its kind in brackets; of overlapping spans the first, then longest, counts."""
    keyed, listed = spans_of(docs, sample_rows, precision, least)
    ordered = F.array_sort(F.transform(SPANS, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    step = "named_struct('text', s.text || substring(text, cast(s.at AS int) + 1, cast(x.a - s.at AS int)) || '[' || x.kind || ']', 'at', -x.back)"
    rest = "s -> s.text || substring(text, cast(s.at AS int) + 1)"
    merged = F.expr(f"aggregate({ORDERED}, named_struct('text', '', 'at', 0L), (s, x) -> CASE WHEN x.a >= s.at THEN {step} ELSE s END, {rest})")
    out = keyed.join(listed.hint("shuffle_hash"), [ID, TEXT_HASH], "left").withColumn(ORDERED, ordered)
    return out.withColumn("text", F.when(F.col(ORDERED).isNull(), F.col("text")).otherwise(merged)).select(*docs.columns)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op6_pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6_pii that SQL can say."""
    return op6_pii(spark, sf_dir).select("doc_id", *(f"n_{g}" for g in BASE), "base_sha256")


_DIGITS_SQL = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN_SQL = f"""list_sum(list_transform(range(length({_DIGITS_SQL})), lambda k: CASE WHEN k % 2 = 0 THEN reverse({_DIGITS_SQL})[k + 1]::INT
  ELSE 2 * reverse({_DIGITS_SQL})[k + 1]::INT - CASE WHEN reverse({_DIGITS_SQL})[k + 1] >= '5' THEN 9 ELSE 0 END END)) % 10 = 0"""
_BYTES_SQL = "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(ltrim(x, '0') AS INT), 0) <= 255))"
#: The rows of op6_pii_base in DuckDB's SQL.
BASE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({spans_sql('email', 0, r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', 'true')}
  UNION ALL {spans_sql('ip', 1, r'[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)', _BYTES_SQL)}
  UNION ALL {spans_sql('card', 2, r'[0-9](?:[\x20-]?[0-9])+', f'CASE WHEN length({_DIGITS_SQL}) BETWEEN 13 AND 19 THEN {_LUHN_SQL} ELSE false END')}
  UNION ALL {spans_sql('phone', 3, r'\+[0-9][\x20().0-9-]+[0-9]', f'length({_DIGITS_SQL}) BETWEEN 9 AND 15')}),
per AS (SELECT doc_id, {', '.join(f'count(*) FILTER (WHERE ord = {k}) AS n{k}' for k in range(4))}, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY ord, a) AS s FROM spans GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n{k}, 0) AS n_{g}' for k, g in enumerate(BASE))}, sha256(coalesce(s, '')) AS base_sha256 FROM d LEFT JOIN per USING (doc_id)
"""
