"""Text quality by regularised quadratic discriminant analysis.

Every document becomes a short vector of statistics, transformed to be roughly normal.
Each class of the labelled documents gets a mean and a covariance that is shrunk towards
the pooled one and its diagonal. A score comes from the difference of the two log
densities, that is of two Mahalanobis distances taken with cached Cholesky factors; a
logistic curve fitted to the labelled documents turns it into a probability.

The statistics are computed once and stored. Means and covariances are sums that Spark
adds up over all labelled documents; only those sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import CHUNK_BYTES, chunks, give_back_memory, ship_package, text_bytes
from isobar.llm.words import words_of
from isobar.storage import materialise

#: Shares of the pooled covariance and of its diagonal in a class covariance.
POOLED, DIAGONAL = 0.2, 0.1
#: Bins of the log-density difference from which the logistic curve is fitted.
BINS = 512
KEEP = 0.7

STATISTICS = (
    "log_words", "word_length", "upper", "digit", "white", "sign", "exclaim", "bar", "stop", "line_words",
    "distinct_words", "repeated_next", "top_word", "repeated_lines", "odd_ends",
)


def _byte_table() -> np.ndarray:
    """A row for each byte: upper-case letter, digit, white space, sign, '!', '|', '.', newline."""
    byte = np.arange(256)
    upper = (byte >= 65) & (byte <= 90)
    digit = (byte >= 48) & (byte <= 57)
    white = np.isin(byte, [9, 10, 11, 12, 13, 32])
    letter = upper | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    sign = ~(letter | digit | white) & ~np.isin(byte, [33, 39, 44, 45, 46, 58, 59, 63, 124])
    return np.stack([upper, digit, white, sign, byte == 33, byte == 124, byte == 46, byte == 10])


_TABLE = _byte_table()


def _sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    totals = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return totals[places[1:]] - totals[places[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text; an empty text has all zeros."""
    raw, places = text_bytes(texts)
    size = np.diff(places)
    upper, digit, white, sign, exclaim, bar, stop, lines = (_sums(row[raw], places) for row in _TABLE)
    words = words_of(texts)
    count = np.diff(words.first)
    solid = np.maximum(size - white, 1)
    many = np.maximum(count, 1)
    letters = _sums(words.ends - words.starts, words.first)
    same_next = np.zeros(len(words.hashes), dtype=bool)
    same_next[1:] = words.hashes[1:] == words.hashes[:-1]
    same_next[words.first[:-1][count > 0]] = False
    # A word that ends in signs other than usual punctuation.
    after = words.ends[words.ends < len(raw)]
    odd = np.zeros(len(words.hashes), dtype=bool)
    odd[: len(after)] = _TABLE[3][raw[after]] | _TABLE[4][raw[after]]
    distinct, top, repeated = (np.zeros(len(size)) for _ in range(3))
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if b > a:
            _, seen = np.unique(words.hashes[a:b], return_counts=True)
            # Longer texts repeat more words in any language; the square root evens that out.
            distinct[i], top[i] = len(seen) / (b - a) ** 0.9, seen.max() / (b - a)
    raw_bytes, ends = raw.tobytes(), places.tolist()
    for i in np.flatnonzero(lines > 0):
        own = raw_bytes[ends[i] : ends[i + 1]].split(b"\n")
        repeated[i] = 1 - len(set(own)) / len(own)
    share = lambda n, of: np.log1p(100 * n / of)
    table = np.stack(
        [
            np.log1p(count), letters / many, share(upper, solid), share(digit, solid),
            white / np.maximum(size, 1), share(sign, solid), share(exclaim, solid), share(bar, many),
            share(stop, many), np.log1p(count / (lines + 1)), distinct, share(_sums(same_next, words.first), many),
            np.log1p(10 * top), repeated, share(_sums(odd, words.first), many),
        ],
        axis=1,
    )
    table[size == 0] = 0.0
    return table


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            table = statistics(batch.column("text")).astype(np.float64)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1])
            column = flat.cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), column], ["id", "x"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Two classes: means, inverse Cholesky factors, log determinants, and the logistic curve."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0."""
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        logs = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets, strict=True):
            # factor is the inverse of L with L L' the covariance, so this is the Mahalanobis distance.
            logs.append(-0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1) - 0.5 * logdet)
        return logs[1] - logs[0]

    def squashed(self, x: np.ndarray) -> np.ndarray:
        """The difference on a scale where far outliers stay in order but near."""
        return np.arcsinh(self.difference(x) / 4)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.squashed(x) + self.offset, -30, 30)))


def _moments(table: DataFrame, model: Discriminant | None) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of each class; of standardised values if a model is given."""
    width = len(STATISTICS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            x = np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, width))
            if model is not None:
                x = np.clip((x - model.centre) / model.scale, -8, 8)
            for label in (0, 1):
                own = x[(batch["label"] == label).to_numpy()]
                totals[label] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        at = np.arange(totals.shape[1])
        for label in (0, 1):
            yield pd.DataFrame({"label": label, "at": at, "value": totals[label]})

    summed = table.mapInPandas(run, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value"))
    out = {label: np.zeros(1 + width + width * width) for label in (0, 1)}
    for label, at, value in summed.collect():
        out[label][at] = value
    return {
        label: (v[0], v[1 : 1 + width], v[1 + width :].reshape(width, width)) for label, v in out.items()
    }


def _logistic(counts: np.ndarray, positives: np.ndarray, middles: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps; a weak pull towards slope 1 keeps them finite."""
    weights = np.array([1.0, 0.0])
    x = np.stack([middles, np.ones_like(middles)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (positives - counts * p) - np.array([weights[0] - 1.0, weights[1]])
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(bend, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(weights[0], 1e-3)), float(weights[1])


def fit(labelled: DataFrame) -> Discriminant:
    """``labelled`` is a stored table (x, label). With no row of a class, all scores are alike."""
    width = len(STATISTICS)
    raw = _moments(labelled, None)
    number = max(1.0, raw[0][0] + raw[1][0])
    centre = (raw[0][1] + raw[1][1]) / number
    spread = np.diag(raw[0][2] + raw[1][2]) / number - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    blank = Discriminant(centre, scale, np.zeros((2, width)), np.stack([np.eye(width)] * 2), np.zeros(2))
    if min(raw[0][0], raw[1][0]) < 2:
        return Discriminant(*[getattr(blank, f) for f in ("centre", "scale", "means", "factors", "logdets")], 1.0, 3.0)

    sums = _moments(labelled, blank)
    means, own = [], []
    for n, total, products in (sums[0], sums[1]):
        means.append(total / n)
        own.append(products / n - np.outer(means[-1], means[-1]))
    pooled = (sums[0][0] * own[0] + sums[1][0] * own[1]) / (sums[0][0] + sums[1][0])
    factors, logdets = [], []
    for covariance in own:
        shrunk = (1 - POOLED - DIAGONAL) * covariance + POOLED * pooled + DIAGONAL * np.diag(np.diag(pooled))
        lower = np.linalg.cholesky(shrunk + 0.02 * np.eye(width))
        factors.append(np.linalg.inv(lower))
        logdets.append(2 * np.log(np.diag(lower)).sum())
    model = Discriminant(centre, scale, np.array(means), np.array(factors), np.array(logdets))

    low, high = -10.0, 10.0

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["x"].to_numpy())
            at = np.clip((model.squashed(x) - low) / (high - low) * BINS, 0, BINS - 1).astype(int)
            yield pd.DataFrame({"label": batch["label"], "bin": at})

    counted = labelled.mapInPandas(bins, "label int, bin int").groupBy("label", "bin").count().collect()
    counts, positives = np.zeros(BINS), np.zeros(BINS)
    for label, at, rows in counted:
        counts[at] += rows
        positives[at] += rows * label
    middles = low + (np.arange(BINS) + 0.5) * (high - low) / BINS
    slope, offset = _logistic(counts, positives, middles)
    return Discriminant(centre, scale, model.means, model.factors, model.logdets, slope, offset)


def _learned(
    table: DataFrame, labels: DataFrame, train: Column, label_col: str, label_id: str, link: str | None
) -> Discriminant:
    """``table`` is a stored table of statistics (id, x)."""
    known = labels.where(train).select(F.col(label_id).alias("known"), F.col(label_col).alias("label"))
    known = known.where("label in (0, 1)").withColumn("label", F.col("label").cast("int"))
    met = F.col(f"id.{link}" if link else "id") == F.col("known")
    return fit(materialise(table.join(known, met).select("x", "label"), "labelled"))


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    keep: float = KEEP,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    label_id: str = "doc_id",
) -> DataFrame:
    """The rows of ``docs``, with all columns, that ``quality_scores`` predicts as good.

    Texts are judged where they are read: no row is joined with a score or shuffled.
    """
    table = materialise(document_statistics(docs, id_col, text_col), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(_learned(table, labels, train, label_col, label_id, None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole rows pass through, so the arrays made of them are kept smaller.
        for batch in chunks(batches, text_col, CHUNK_BYTES // 4):
            good = model.value.probability(statistics(batch.column(text_col)).astype(np.float64)) >= keep
            yield batch.filter(pa.array(good))
        give_back_memory()

    return docs.mapInArrow(run, docs.schema)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    keep: float = KEEP,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    label_id: str = "doc_id",
    link: str | None = None,
) -> DataFrame:
    """One row per input row: id, ``score`` (probability of label 1) and ``predicted``.

    ``train`` is a condition on the columns of ``labels``. ``link`` names the field of a
    structured document id that meets ``label_id``; by default it is the id itself. Labels that are null or
    neither 0 nor 1 teach nothing, nor do those of ids without a document; an id with
    several labels or documents teaches each combination. Null texts count as empty, which
    are scored like any other. With no label of a class every document is kept. Repeated
    rows each give a row; other columns are ignored.
    """
    table = materialise(document_statistics(docs, id_col, text_col), "statistics")
    model = table.sparkSession.sparkContext.broadcast(_learned(table, labels, train, label_col, label_id, link))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy()
            x = values.reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(model.value.probability(x))], ["id", "score"]
            )

    scored = table.mapInArrow(score, f"id {table.schema['id'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("id").alias(id_col), "score", (F.col("score") >= keep).cast("int").alias("predicted")
    )
