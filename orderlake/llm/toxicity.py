"""Toxicity of documents by a classifier chain of linear models.

Categories are predicted one after the other. Each model is a logistic regression on the hashed
words and word beginnings of a text (by their share of its words; terms about as frequent in either
class of the sample are left out), and on the probabilities that the models before it give. A
beginning that clean texts have by chance, once in hundreds of words, is told so from one that
returns every fifty words. For training these are out-of-fold predictions: the probability of a
row comes from a model that has not seen the row. For scoring they come from the models
trained on all rows of the sample.

The labels table gives two categories, low quality and toxicity; the chain asks for them in
this order. Models are fitted on at most about `SAMPLE` labelled documents, drawn by a hash of
the id: only the weights of their telling terms come to the driver. Every document is scored, on its whole
text, where it is read.

Rows: one result row per input row, also for repeated rows. NULL texts count as empty. Rows of
the labels table with a NULL id or label are left out; several rows for one id count as toxic,
or low in quality, if one of them is. Without any labelled document all probabilities are 0
and nothing is rejected. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import quoted, stored
from orderlake.llm.tokens import by_bytes
from orderlake.llm.words import Words

CATEGORIES = ("low_quality", "toxic")
SAMPLE = 8_000  # labelled documents used for training, about
FEATURES = 1 << 17
BEGINNINGS = (3, 4, 5)  # characters of word beginnings
FOLDS = 3
THRESHOLD = 0.4  # out of fold, thresholds from 0.3 to 0.4 find and reject the same documents of the sample
CONTRAST = 4.0  # least difference of a term's shares in the two classes, in standard errors
RIDGE = 1e-4
STEPS, RATE = 150, 0.1
SHARE, EXTRA = 50, 10  # a term counts in full from one in `SHARE` words on; short texts count as `EXTRA` words longer


class Terms:
    """Numbers and weights of the distinct words and word beginnings of a text."""

    def __init__(self) -> None:
        self.hasher = Words(underscore=False)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if not text:
            return np.zeros(0, np.int64), np.zeros(0)
        _, _, words, begins = self.hasher.of(text, BEGINNINGS)
        terms, counts = np.unique(np.concatenate([words, *begins]), return_counts=True)
        weights = np.minimum(1.0, SHARE * counts / (len(words) + EXTRA))
        return (terms % np.uint64(FEATURES)).astype(np.int64), weights


@dataclass
class Model:
    """A logistic regression on terms and on `extra` numbers."""

    words: np.ndarray
    extra: np.ndarray
    bias: float

    def probability(self, terms: tuple[np.ndarray, np.ndarray], extra: np.ndarray) -> float:
        numbers, weights = terms
        return float(sigmoid(self.words[numbers] @ weights + self.extra @ extra + self.bias))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def contrast(total: np.ndarray, squares: np.ndarray, yes: np.ndarray, n: int, n_yes: float) -> np.ndarray:
    """Difference of terms' mean weights in the two classes, in standard errors; 0 without both."""
    if not 0 < n_yes < n:
        return np.zeros(len(total))
    variance = np.maximum(squares / n - (total / n) ** 2, 1e-12)
    spread = np.sqrt(variance * (1 / n_yes + 1 / (n - n_yes)))
    return np.abs(yes / n_yes - (total - yes) / (n - n_yes)) / spread


def telling(flat: np.ndarray, weight: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which terms have clearly more weight in one of the two classes."""
    total = np.bincount(flat, weight, minlength=FEATURES)
    yes = np.bincount(flat, weight * y[row], minlength=FEATURES)
    squares = np.bincount(flat, weight * weight, minlength=FEATURES)
    return contrast(total, squares, yes, len(y), y.sum()) >= CONTRAST


def fit(terms: list[tuple[np.ndarray, np.ndarray]], extra: np.ndarray, y: np.ndarray) -> Model:
    """Ridge logistic regression on the telling terms, by Adam on all rows at once."""
    n, k = len(y), extra.shape[1]
    flat = np.concatenate([*(t[0] for t in terms), np.zeros(0, np.int64)])
    weight = np.concatenate([*(t[1] for t in terms), np.zeros(0)])
    row = np.repeat(np.arange(n), [len(t[0]) for t in terms])
    kept = telling(flat, weight, row, y)[flat]
    flat, weight, row = flat[kept], weight[kept], row[kept]
    w = np.zeros(FEATURES + k + 1)
    m, v, g = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[flat] * weight, minlength=n) + extra @ w[FEATURES : FEATURES + k] + w[-1]
        error = (sigmoid(z) - y) / max(1, n)
        g[:FEATURES] = np.bincount(flat, error[row] * weight, minlength=FEATURES)
        g[FEATURES : FEATURES + k] = error @ extra
        g[-1] = error.sum()
        g[:-1] += RIDGE * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return Model(w[:FEATURES], w[FEATURES : FEATURES + k], float(w[-1]))


def fit_chain(terms: list[tuple[np.ndarray, np.ndarray]], y: dict[str, np.ndarray], fold: np.ndarray) -> list[Model]:
    """A model for each category in the order of `y`; earlier categories enter out of fold."""
    models: list[Model] = []
    extra = np.zeros((len(terms), 0))
    for i, (_, truth) in enumerate(y.items()):
        models.append(fit(terms, extra, truth))
        if i + 1 == len(y):
            break
        out = np.zeros(len(terms))
        for f in np.unique(fold):
            seen = np.flatnonzero(fold != f)
            part = np.flatnonzero(fold == f)
            model = fit([terms[j] for j in seen], extra[seen], truth[seen]) if len(seen) else models[-1]
            out[part] = [model.probability(terms[j], extra[j]) for j in part]
        extra = np.column_stack([extra, out])
    return models


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, folds: int) -> DataFrame:
    """`doc_id`, categories, fold, term numbers and their weights of a bounded sample of labelled
    documents."""
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    known = usable.groupBy("doc_id").agg(
        F.max((F.col("quality") == 0).cast("int")).alias("low_quality"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    share = sample / max(1, known.count())
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1_000_000)) < int(1_000_000 * share))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = [terms.of(t) for t in part.column("text").to_pylist()]
                kept = [part.column(c) for c in ("doc_id", *CATEGORIES)]
                fold = pa.array(part.column("doc_id").to_numpy() // 7 % folds, pa.int32())
                numbers = pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32()))
                weights = pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*kept, fold, numbers, weights], names=["doc_id", *CATEGORIES, "fold", "numbers", "weights"])

    # The draw bounds the labels' side, so it can be sent to every executor. A repeated
    # document is taken once, or copies of a row would outgrow the bound.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"])
    rows = rows.select("doc_id", *CATEGORIES, "text")
    return rows.mapInArrow(number, f"{_SAMPLED}, numbers array<int>, weights array<float>")


_SAMPLED = "doc_id long, low_quality int, toxic int, fold int"


def told_apart(sample: DataFrame, folds: int) -> np.ndarray:
    """Which terms are telling for any of the models: on all rows of the sample, or on all but one
    fold. Sums for each term and fold are made where the sample lies."""
    each = sample.select("fold", *CATEGORIES, F.explode(F.arrays_zip("numbers", "weights")).alias("t"))
    w = F.col("t.weights").cast("double")
    sums = each.groupBy(F.col("t.numbers").alias("number"), "fold").agg(
        F.sum(w).alias("total"), F.sum(w * w).alias("squares"), *(F.sum(w * F.col(c)).alias(c) for c in CATEGORIES)
    ).toArrow()
    rows = sample.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in CATEGORIES)).collect()
    dense = {c: np.zeros((folds, FEATURES)) for c in ("total", "squares", *CATEGORIES)}
    for c, table in dense.items():
        table[sums.column("fold").to_numpy(), sums.column("number").to_numpy()] = sums.column(c).to_numpy()
    kept = np.zeros(FEATURES, bool)
    for left_out in (None, *range(folds)):
        used = [r for r in rows if r["fold"] != left_out]
        folds_used = [f for f in range(folds) if f != left_out]
        total, squares = (dense[c][folds_used].sum(axis=0) for c in ("total", "squares"))
        for c in CATEGORIES:
            found = contrast(total, squares, dense[c][folds_used].sum(axis=0), sum(r["n"] for r in used), sum(r[c] for r in used))
            kept |= found >= 0.999 * CONTRAST  # models look again, on sums in another order
    return kept


def train_chain(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> list[Model]:
    """One model for each category, in order; none if no document is labelled. Of the sample, only
    the weights of telling terms come to the driver."""
    drawn = stored(labelled_sample(docs, labels, sample, folds), "sample")
    kept = told_apart(drawn, folds)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(np.asarray(n, np.int32), np.asarray(w, np.float32)) for n, w in zip(*(batch.column(c).to_pylist() for c in ("numbers", "weights")))]
            chosen = [pa.array([x[k][kept[x[0]]] for x in pairs], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.float32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *chosen], names=batch.schema.names)

    rows = drawn.mapInArrow(choose, f"{_SAMPLED}, numbers array<int>, weights array<float>").orderBy("doc_id").toArrow()
    if not rows.num_rows:
        return []
    terms = [(n.values.to_numpy(), w.values.to_numpy()) for n, w in zip(rows.column("numbers"), rows.column("weights"))]
    y = {c: rows.column(c).to_numpy().astype(float) for c in CATEGORIES}
    return fit_chain(terms, y, rows.column("fold").to_numpy())


def scored(docs: DataFrame, models: list[Model]) -> DataFrame:
    """`docs`, which has a column `text`, with a probability `p_<category>` for each category."""
    if not models:
        return docs.withColumns({f"p_{c}": F.lit(0.0) for c in CATEGORIES})
    names = [f"p_{c}" for c in CATEGORIES]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for part in by_bytes(batch, "text"):
                out = np.zeros((part.num_rows, len(models)))
                for i, text in enumerate(part.column("text").to_pylist()):
                    found = terms.of(text)
                    for k, model in enumerate(models):
                        out[i, k] = model.probability(found, out[i, :k])
                added = [pa.array(out[:, k]) for k in range(len(models))]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return docs.mapInArrow(score, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, a probability for each category, and whether the document is rejected as toxic."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = scored(rows, train_chain(docs, labels))
    return out.select("doc_id", *(f"p_{c}" for c in CATEGORIES), (F.col("p_toxic") >= threshold).alias("rejected"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are not rejected, with all their columns."""
    text = F.col("text").cast("string")
    others = F.struct(*[quoted(c) for c in docs.columns if c != "text"]).alias("row")
    kept = scored(docs.select(text.alias("text"), others), train_chain(docs, labels)).where(F.col("p_toxic") < threshold)
    return kept.select(*[F.col("text").cast(t).alias(c) if c == "text" else F.col("row")[c].alias(c) for c, t in docs.dtypes])
