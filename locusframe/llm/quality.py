"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows and flattened into
arrays, which workers walk level by level for a whole batch of rows at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from . import common, tokens

#: Labelled rows that the trees are fitted on, at most; the smallest hashes of the id are taken.
SAMPLE_ROWS = 20_000

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "stops", "exclaims", "bars", "symbols", "quotes",
    "non_ascii", "line_ends", "entropy", "distinct_words", "same_as_before", "top_word", "distinct_lines", "words_in_line", "open_marks",
)


def statistics(text: bytes) -> list[float]:
    """FEATURES of a whole UTF-8 text; an empty text has zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    h = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    share = h[h > 0] / n
    of = lambda marks: float(h[np.frombuffer(marks, dtype=np.uint8)].sum()) / n
    words, lines = text.split(), text.split(b"\n")
    m = max(1, len(words))
    top = max(Counter(words).values()) if words else 0
    return [
        np.log(n), np.log1p(len(words)), n / m, h[65:91].sum() / max(1, h[65:91].sum() + h[97:123].sum()), h[48:58].sum() / n,
        h[46] / m, h[33] / m, h[124] / m, of(b"#$%&*@^~"), of(b"\"'`"),
        h[128:].sum() / n, len(lines) / m, float(-(share * np.log(share)).sum()), len(set(words)) / m, sum(map(eq, words, words[1:])) / m, top / m,
        len(set(lines)) / len(lines), m / len(lines), of(b"<>{}[]()_=+\\/"),
    ]


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t if t is not None else b"") for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """Complete trees of one depth as arrays: feature and threshold of the inner nodes, value of the leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.1, bins: int = 64, least: int = 20, penalty: float = 1.0) -> Trees:
    """Logistic loss, second-order gains, histograms of quantile bins. With no rows or one class all scores are the share of label 1 (0.5 without rows)."""
    inner, share = (1 << depth) - 1, float(y.mean()) if len(y) else 0.5
    base = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    out = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if share in (0.0, 1.0) or not len(y):
        return out
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    total, d = np.full(len(y), base), x.shape[1]
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            at = (node - first)[:, None] * (d * bins) + np.arange(d) * bins + binned
            cells = width * d * bins
            sums = [np.bincount(at.ravel(), np.repeat(v, d), cells).reshape(width, d, bins).cumsum(axis=2) for v in (g, h, np.ones(len(y)))]
            (gl, hl, nl), (ga, ha, na) = sums, [s[:, :, -1:] for s in sums]
            gain = gl**2 / (hl + penalty) + (ga - gl) ** 2 / (ha - hl + penalty) - ga**2 / (ha + penalty)
            gain = np.where((nl >= least) & (na - nl >= least), gain, -1.0).reshape(width, -1)
            best = gain.argmax(axis=1)
            for k, b in enumerate(best):
                f, cut = divmod(int(b), bins)
                if gain[k, b] > 1e-9 and cut < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        slot = node - inner
        leaf = rate * np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + penalty)
        total += leaf[slot]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))


def fold(id_: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(id_.cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, held_out: int | None = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees:
    """Trees for the label, from at most `sample_rows` labelled rows outside the held-out fold.

    Null ids and labels other than 0 and 1 are left out; an id with two labels gives a
    row for each. The statistics of whole texts are taken on Spark; the driver gets
    one short row for each row of the sample.
    """
    common.ship(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    if held_out is not None:
        known = known.where(fold(F.col("doc_id")) != held_out)
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows)
    rows = common.texts(docs, id_col, text_col).join(F.broadcast(known), "doc_id")  # the sample is bounded

    def take(batches):
        import pyarrow as pa

        for batch in batches:
            x = matrix(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.record_batch([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    got = rows.select("doc_id", "y", "text").mapInArrow(take, "doc_id long, y int, x array<double>").toPandas()
    got = got.sort_values(["doc_id", "y"], kind="stable")
    x = np.array(got["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(dtype=np.float64))


def score(spark, trees: Trees, text: Column) -> Column:
    """The score of a text column, 0 to 1; null and empty texts are scored as empty ones."""
    common.ship(spark)

    @F.pandas_udf("double")
    def scored(t: pd.Series) -> pd.Series:
        tokens.forget()
        out = pd.Series(trees.predict(matrix(t)))
        common.settle()
        return out

    return scored(text.cast("string").cast("binary"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of docs.

    held_out rows (crc32 of the id modulo 5 is 0; false for a null id) never train.
    Only the text is an input of a score. Rows that repeat get equal scores.
    """
    trees = train(docs, labels, sample_rows, 0, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), score(docs.sparkSession, trees, F.col(text_col)).alias("score"))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of docs, all columns, that are not rejected."""
    trees = train(docs, labels, sample_rows, 0, id_col, text_col, label_col)
    return docs.where(score(docs.sparkSession, trees, F.col(text_col)) >= threshold)
