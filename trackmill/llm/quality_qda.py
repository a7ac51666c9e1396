"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each class has a Gaussian over transformed statistics of the text, with a covariance shrunk
towards the pooled one and towards a sphere. The score is the posterior of label 1, from the
difference of the log densities; the Cholesky factors are taken once, at the fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.counts import count
from trackmill.llm.outliers import vector
from trackmill.llm.spans import SPACED, Words, chunks
from trackmill.llm.work import Scratch, map_batches, utf8

NAMES = ("length", "symbols", "lines", "repeats", "stutter", "words")
DIM = len(NAMES)
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


@dataclass(frozen=True)
class Settings:
    """Share of the pooled covariance in each class's, share of the sphere in the result, the
    variance added to every statistic, folds of which the first is held out, and the cut."""

    pooled: float = 0.02
    sphere: float = 0.02
    floor: float = 1e-2
    folds: int = 5
    cut: float = 0.3


def statistics(texts: list[bytes]) -> np.ndarray:
    """The outlier vector, the share of words equal to the word before, and the logarithm of words."""
    found = count(texts)
    words = Words(texts, SPACED, lower=False)
    same = np.zeros(len(words) + 1, np.int64)
    same[1:-1] = words.hash[1:] == words.hash[:-1]
    starts = words.bounds[:-1][np.diff(words.bounds) > 0]
    same[starts] = 0
    stutter = np.diff(np.concatenate(([0], np.cumsum(same[:-1])))[words.bounds])
    n = found["n_words"]
    return np.concatenate([vector(found), np.sqrt(stutter / (n + 20.0))[:, None], np.log1p(n)[:, None] / 4], axis=1)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics; nothing but the text goes into them."""
    schema = T.StructType([docs.schema["doc_id"]] + [T.StructField(n, T.DoubleType()) for n in NAMES])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [statistics(part) for part in chunks(utf8(batch.column("text")))]
            found = np.concatenate(parts) if parts else np.empty((0, DIM))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in found.T]], names=schema.names)

        return work

    return map_batches(docs.select("doc_id", "text"), make, schema)


def held_out(settings: Settings) -> Column:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % settings.folds
    return F.coalesce(fold == 0, F.lit(False))


def fitted(stats: DataFrame, labels: DataFrame, settings: Settings) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each label its share, mean and Cholesky factor, from all labelled rows that aren't held out."""
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(settings))
    known = known.select("doc_id", F.col("quality").alias("_label")).distinct()
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)]
    products = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i, j in PAIRS]
    rows = stats.join(known, "doc_id").groupBy("_label").agg(F.count("*").alias("n"), *sums, *products).collect()  # two rows
    if len(rows) < 2:
        return {}
    means, covariances, sizes = {}, {}, {}
    for row in rows:
        label, n = int(row["_label"]), row["n"]
        mean = np.array([row[f"s{i}"] for i in range(DIM)]) / n
        cov = np.zeros((DIM, DIM))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = row[f"p{i}_{j}"] / n - mean[i] * mean[j]
        means[label], covariances[label], sizes[label] = mean, cov, n
    total = sum(sizes.values())
    pooled = sum(covariances[k] * sizes[k] for k in sizes) / total
    model = {}
    for label, cov in covariances.items():
        cov = (1 - settings.pooled) * cov + settings.pooled * pooled
        cov = (1 - settings.sphere) * cov + settings.sphere * np.trace(cov) / DIM * np.eye(DIM)
        model[label] = (sizes[label] / total, means[label], np.linalg.cholesky(cov + settings.floor * np.eye(DIM)))
    return model


def score(model: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Column:
    """Posterior of label 1; a half without a model."""
    if not model:
        return F.lit(0.5)
    densities = {}
    for label, (share, mean, factor) in model.items():
        white = np.linalg.inv(factor)
        distance = F.lit(0.0)
        for i in range(DIM):
            part = F.lit(0.0)
            for j in range(i + 1):
                part = part + float(white[i, j]) * (F.col(NAMES[j]) - float(mean[j]))
            distance = distance + part * part
        constant = float(np.log(share) - np.log(np.diag(factor)).sum())
        densities[label] = F.lit(constant) - distance / 2
    # kept within what a double can tell from 0 and 1
    gap = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), densities[1] - densities[0]))
    return 1 / (1 + F.exp(-gap))


def scored(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of docs.

    Labels of rows whose crc32 of the id as text is a multiple of `folds` are never learned
    from; a null id has no label and isn't held out. Labels other than 0 and 1, null ones and
    repeated ones add nothing; an id with both labels counts for both. A null or empty text has
    the statistics of no words and gets a score like any. Without labels of both kinds all
    scores are a half. Only doc_id and text of docs are read, and only the text is scored.
    """
    settings = settings or Settings()
    stats = Scratch(docs.sparkSession, "quality").settle(measured(docs), "statistics")
    model = fitted(stats, labels, settings)
    rows = stats.withColumn("score", score(model))
    return rows.select("doc_id", held_out(settings).alias("held_out"), "score", (F.col("score") >= settings.cut).cast("int").alias("predicted"))
