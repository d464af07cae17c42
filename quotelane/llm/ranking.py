"""A quality classifier by pairwise ranking (Bradley-Terry).

Labels give preferences: a document labelled 1 is preferred to one labelled 0. A document's
strength is a weighted sum of statistics of its text, the weights come from logistic loss on
the differences of the statistics of preference pairs. The threshold is the quantile of the
training scores that leaves as many documents below it as have label 0; scores are moved so
that it lies at ``THRESHOLD``.

The model is fitted on about ``SAMPLE_DOCUMENTS`` labelled documents with the smallest
hashes and ``PAIRS`` pairs of them; scores cover every document. Ids, sources, languages and
labels are not inputs of a score.

Defined results: a null text counts as empty; an empty text has statistics of zero; a null id
is not held out; labels other than 0 and 1 are left out, repeated ones count once; without
preferences every score is the threshold; repeated rows are scored alike; an empty table
gives an empty result.
"""

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCUMENTS = 20_000
PAIRS = 200_000
THRESHOLD = 0.7
RIDGE = 1e-3
SEED = 11

_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#*$%&<>^~_=+@\\/{}[]"


def statistics(text: str) -> list[float]:
    """Statistics of a text, each about between 0 and 1."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = max(len(words), 1), max(len(data), 1)
    lines = [line for line in data.split(b"\n") if line.strip()]
    share = lambda characters: 1 - len(data.translate(None, characters)) / size if data else 0.0
    part = lambda value, full: min(value / full, 1.0)
    return [
        part(data.count(b"|") / n, 0.2),
        part(data.count(b"!") / n, 0.3),
        part(share(_SYMBOLS), 0.1),
        part(share(_UPPER), 0.3),
        part(share(b"0123456789"), 0.3),
        part(sum(map(eq, words, words[1:])) / n, 0.2),
        part(max(0.6 - len(set(words)) / n, 0.0), 0.4) if len(words) > 5 else 0.0,
        part(1 - len(set(lines)) / len(lines), 0.5) if lines else 0.0,
        part(np.log1p(len(words)), 10.0),
        part(abs(size / n - 6.5), 6.5),
    ]


WIDTH = len(statistics(""))


def table_of(texts: pa.Array) -> np.ndarray:
    rows = [statistics(t or "") for t in texts.to_pylist()]
    return np.array(rows, np.float64).reshape(len(rows), WIDTH)


@dataclass
class Model:
    weights: np.ndarray
    threshold: float  # of the strength

    def scores(self, table: np.ndarray) -> np.ndarray:
        strength = table @ self.weights - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(strength, -700, 700)))


def fit_pairs(table: np.ndarray, labels: np.ndarray, pairs: int = PAIRS) -> Model:
    """Fit the weights by Newton steps, then set the threshold by quantile."""
    good, bad = table[labels == 1], table[labels == 0]
    if not len(good) or not len(bad):
        return Model(np.zeros(table.shape[1]), 0.0)
    rng = np.random.default_rng(SEED)
    differences = good[rng.integers(len(good), size=pairs)] - bad[rng.integers(len(bad), size=pairs)]
    weights = np.zeros(table.shape[1])
    for _ in range(30):
        lost = 1 / (1 + np.exp(np.clip(differences @ weights, -700, 700)))
        slope = RIDGE * weights - differences.T @ lost / pairs
        bend = (differences * (lost * (1 - lost))[:, None]).T @ differences / pairs
        step = np.linalg.solve(bend + RIDGE * np.eye(len(weights)), slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    strengths = np.sort(table @ weights)
    return Model(weights, float(strengths[len(bad) - 1] + strengths[len(bad)]) / 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on labelled documents that are not held out."""
    known = labels.select(labels[doc_id].alias("id"), labels[label].cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    share = SAMPLE_DOCUMENTS / max(known.count(), 1)
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def measure(texts: pa.Array) -> pa.Array:
        return pa.array(table_of(texts).tolist(), pa.list_(pa.float64()))

    rows = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    sample = rows.join(F.broadcast(known), "id").select(  # about SAMPLE_DOCUMENTS rows
        "id", "label", F.arrow_udf(measure, "array<double>")("text").alias("x"))
    found = sorted(sample.collect(), key=lambda r: (r["id"], r["label"], r["x"]))
    table = np.array([r["x"] for r in found], np.float64).reshape(len(found), WIDTH)
    return fit_pairs(table, np.array([r["label"] for r in found], int))


def score(text: Column, model: Model) -> Column:
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(table_of(texts)))

    return F.arrow_udf(of, "double")(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs``."""
    model = fit(docs, labels, doc_id, text, label)
    rows = docs.select(
        docs[doc_id].alias("doc_id"), held_out(docs[doc_id]).alias("held_out"),
        score(docs[text], model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
