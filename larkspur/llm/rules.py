"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of every whole text are taken once and stored as narrow columns. A forest of
shallow trees is grown on a bounded sample of labelled rows; each path from a root to a node
becomes a rule, a conjunction of comparisons. A logistic regression with an L1 penalty weighs
the rules and drops most. What is left is compiled into one Spark column expression, so
scoring is a projection.

The sample has at most ``SAMPLE`` labelled rows, lowest hashes of the ids first.

Defined cases: missing and empty texts have the statistics of an empty text; missing labels
are not learned from; of several labels for one id the lowest counts; with one label only
the score is its share (0.5 without any); equal rows score alike; an empty table gives no
rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from larkspur.llm.text import as_bytes, fold
from larkspur.session import scratch_path

SAMPLE = 20_000
TREES, DEPTH = 24, 3
PENALTY = 0.001
FOLDS, HELD_OUT = 3, 1
SEED = 11

STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "short_words", "upper", "lower", "digits", "marks", "symbols", "bangs",
    "bars", "beyond_ascii", "space", "distinct_words", "top_word", "repeated_lines", "line_words", "marked_words", "letterless_words",
    "compressed",
)

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_MARKS = b".,;:!?'\"()-"
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
_SPACE = b" \t\n\r\x0b\x0c"
_BEYOND = bytes(range(0x80, 0x100))
_LETTERS = _UPPER + _LOWER + _BEYOND

Rule = tuple[tuple[str, bool, float], ...]


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``STATISTICS``; all shares are between 0 and 1."""
    data = as_bytes(text)
    if not data:
        return [0.0] * len(STATISTICS)
    size = len(data)

    def share(characters: bytes) -> float:
        return (size - len(data.translate(None, characters))) / size

    words = data.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lengths = list(map(len, words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    m = max(len(lines), 1)
    pressed = zlib.compressobj(1)
    packed = len(pressed.compress(data)) + len(pressed.flush())
    return [
        float(np.log1p(size)), float(np.log1p(len(words))), sum(lengths) / n, float(max(lengths, default=0)),
        sum(k <= 3 for k in lengths) / n, share(_UPPER), share(_LOWER), share(_DIGITS), share(_MARKS), share(_SYMBOLS),
        share(b"!"), share(b"|"), share(_BEYOND), share(_SPACE), len(counts) / n, max(counts.values(), default=0) / n,
        1 - len(set(lines)) / m, float(np.log1p(len(words) / m)), sum(c for w, c in counts.items() if w[-1:] in b"!?*%&#$@~^|") / n,
        sum(c for w, c in counts.items() if not w.translate(None, _DIGITS + _MARKS + _SYMBOLS)) / n, packed / size,
    ]


@F.pandas_udf(StructType([StructField(name, DoubleType()) for name in STATISTICS]))
def _statistics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype=float)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text, stored once for learning and scoring."""
    path = scratch_path(docs.sparkSession, "text-statistics")
    docs.select("doc_id", _statistics("text").alias("s")).select("doc_id", "s.*").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def tree_rules(node, path: Rule = ()) -> list[Rule]:
    """Every node below the root as the conjunction that leads to it: (name, is at most, cut)."""
    found = [path] if path else []
    if node.subtreeDepth() > 0:
        name, cut = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        found += tree_rules(node.leftChild(), (*path, (name, True, cut)))
        found += tree_rules(node.rightChild(), (*path, (name, False, cut)))
    return found


def simplified(rule: Rule) -> Rule:
    """One tightest bound per statistic and side."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, below, cut in rule:
        key = (name, below)
        bounds[key] = cut if key not in bounds else (min if below else max)(bounds[key], cut)
    return tuple(sorted((name, below, cut) for (name, below), cut in bounds.items()))


def holds(rule: Rule) -> Column:
    """A rule as a Spark condition."""
    condition = F.lit(True)
    for name, below, cut in rule:
        condition = condition & (F.col(name) <= cut if below else F.col(name) > cut)
    return condition


def fit(rows: DataFrame, labels: DataFrame, column: str = "quality", size: int = SAMPLE) -> tuple[dict[Rule, float], float]:
    """Weights of the rules that the penalty leaves, and the intercept."""
    spark = rows.sparkSession
    known = labels.where(F.col(column).isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.min(column).cast("double").alias("label"))
    joined = rows.join(known, F.col("doc_id") == F.col("id"))
    sampled = joined.orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(size).select("label", *STATISTICS).toPandas()
    share = float(sampled["label"].mean()) if len(sampled) else 0.5
    if share in (0.0, 1.0) or not len(sampled):
        odds = min(max(share, 1e-6), 1 - 1e-6)
        return {}, float(np.log(odds / (1 - odds)))
    local = spark.createDataFrame(sampled).withColumn("features", array_to_vector(F.array(*STATISTICS)))
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="onethird", seed=SEED
    ).fit(local)
    rules = sorted({simplified(rule) for tree in forest.trees for rule in tree_rules(tree._java_obj.rootNode())})
    matches = F.array(*[F.when(holds(rule), 1.0).otherwise(0.0) for rule in rules])
    linear = LogisticRegression(
        featuresCol="matches", labelCol="label", regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False
    ).fit(local.select("label", array_to_vector(matches).alias("matches")))
    weights = {rule: float(w) for rule, w in zip(rules, linear.coefficients.toArray()) if w}
    return weights, float(linear.intercept)


def compiled(weights: dict[Rule, float], intercept: float) -> Column:
    """The probability of label 1 as one expression over the statistics."""
    logit = F.lit(intercept)
    for rule, weight in weights.items():
        logit = logit + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-logit))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of every document."""
    rows = measured(docs)
    weights, intercept = fit(rows, labels)
    return rows.select("doc_id", compiled(weights, intercept).alias("score"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return score(docs, labels).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
