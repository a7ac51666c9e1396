"""Quality rules: robust multivariate outliers per language and source.

Every document has a vector of four transformed statistics. For each language and source
(or the language, or all documents, where there are few) the minimum covariance determinant
estimates its centre and spread from the most central half of the rows, so junk does not widen
the spread that it is judged by. Concentration steps run from several starts until the
determinant no longer falls; the fit of smallest determinant stays, and is taken again over all
rows near it. A document far away in Mahalanobis distance is rejected.

One aggregate over all rows sums their counts, vectors and products in the cells of a grid that
is finer than the differences that count. The steps then work on cells: which are nearest is
judged by the cells' means, and the fits come from the sums of their rows. So the table is
read once, and a group is as many cells as its statistics fill, whatever its rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.counts import NAMES, count
from trackmill.llm.spans import chunks
from trackmill.llm.work import Scratch, arrow_schema, map_batches, map_groups, utf8

DIM = 4
VECTOR = [f"v{i}" for i in range(DIM)]
MEAN = [f"m{i}" for i in range(DIM)]
WHITE = [f"w{i}{j}" for i in range(DIM) for j in range(i + 1)]
PRODUCTS = [(i, j) for i in range(DIM) for j in range(i + 1)]
CELL = [f"c{i}" for i in range(DIM)]
SUMS = ["n", *[f"s{i}" for i in range(DIM)], *[f"p{i}{j}" for i, j in PRODUCTS]]
#: Less than this is no fall of a determinant's logarithm.
STEADY = 1e-6


@dataclass(frozen=True)
class Settings:
    """`coverage`: share of central rows; `least_rows`: of a language or source with estimates of its own;
    `cutoff`: largest squared distance kept (1 in 20,000 normal rows is farther); `floors`: standard
    deviations added to each statistic's own, below which differences don't count; `cells`: widths
    of the grid's cells, half of the floors."""

    coverage: float = 0.5
    least_rows: int = 100
    cutoff: float = 25.0
    floors: tuple[float, ...] = (0.05, 0.15, 0.15, 0.15)
    cells: tuple[float, ...] = (0.025, 0.075, 0.075, 0.075)
    least_words: int = 20
    most_repeated_percent: int = 30


def vector(found: dict[str, np.ndarray]) -> np.ndarray:
    """Logarithm of the mean word length, and square roots of the shares of symbols by word, of
    repeated lines and of repeated words. Shares are taken with 50 words or 5 lines more, so
    that a short text with one odd word or line does not stand out."""
    words = found["n_words"]
    length = np.log((found["word_chars"] + 250.0) / (words + 50.0))
    symbols = np.sqrt(found["n_symbols"] / (words + 50.0))
    lines = np.sqrt(found["n_dup_lines"] / (found["n_lines"] + 5.0))
    repeats = np.sqrt(found["n_repeat_words"] / (words + 50.0))
    return np.stack([length, np.minimum(symbols, 3.0), lines, repeats], axis=1)


def base_failed(settings: Settings) -> Column:
    few = F.col("n_words") < settings.least_words
    return few | (100 * F.col("n_repeat_words") > settings.most_repeated_percent * F.col("n_words"))


def _kept(settings: Settings) -> Column:
    return ~base_failed(settings) & (F.coalesce("far", F.lit(0.0)) <= settings.cutoff)


def _measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep, the counts and the vector."""
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField(n, T.LongType()) for n in NAMES]
        + [T.StructField(n, T.DoubleType()) for n in VECTOR]
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [count(part) for part in chunks(utf8(batch.column("text")))]
            found = {n: np.concatenate([p[n] for p in parts]) if parts else np.empty(0, np.int64) for n in NAMES}
            made = [pa.array(found[n]) for n in NAMES] + [pa.array(v) for v in vector(found).T]
            return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, names=schema.names)

        return work

    return map_batches(docs, make, schema)


def _cells(rows: DataFrame, settings: Settings) -> DataFrame:
    """The sums of the rows of every cell: per language and source, per language, and of all."""
    cell = [F.floor(F.col(v) / width).alias(c) for v, c, width in zip(VECTOR, CELL, settings.cells, strict=True)]
    sums = [F.sum(f"v{i}").alias(f"s{i}") for i in range(DIM)]
    products = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}{j}") for i, j in PRODUCTS]
    finest = rows.groupBy("lang", "source", *cell).agg(F.count("*").cast("double").alias("n"), *sums, *products)
    more = [F.sum(c).alias(c) for c in SUMS]
    level = lambda df, n: df.select(F.lit(n).cast("long").alias("level"), "lang", "source", *CELL, *SUMS)
    none = F.lit(None).cast("string")
    by_lang = finest.groupBy("lang", *CELL).agg(*more).withColumn("source", none)
    whole = by_lang.groupBy(*CELL).agg(*more).withColumns({"lang": none, "source": none})
    return level(finest, 2).unionByName(level(by_lang, 1)).unionByName(level(whole, 0))


def _histogram_starts(bins: np.ndarray, counts: np.ndarray, width: float) -> list[tuple[float, float]]:
    """Centre and standard deviation of one statistic by four starts: median and deviations from
    it, the shortest half, the lower half and the upper half."""
    x, upto = (bins + 0.5) * width, np.cumsum(counts)
    half = (upto[-1] + 1) // 2

    def median(values: np.ndarray, k: np.ndarray) -> float:
        order = np.argsort(values, kind="stable")
        return float(values[order][np.searchsorted(np.cumsum(k[order]), half)])

    def of(first: int, last: int, factor: float) -> tuple[float, float]:
        k, v = counts[first : last + 1], x[first : last + 1]
        mean = np.average(v, weights=k)
        return float(mean), float(factor * np.sqrt(np.average((v - mean) ** 2, weights=k)))

    middle = median(x, counts)
    before = np.concatenate(([0], upto[:-1]))
    ends = np.searchsorted(upto, before + half)
    firsts = np.flatnonzero(ends < len(x))
    shortest = firsts[np.argmin(x[ends[firsts]] - x[firsts])]
    at = int(np.searchsorted(upto, half))
    above = int(np.searchsorted(upto, upto[-1] - half, side="right"))
    # factors: of the deviations of normal rows' parts
    return [
        (middle, 1.4826 * median(np.abs(x - middle), counts)),
        of(int(shortest), int(ends[shortest]), 2.65),
        of(0, at, 1.66),
        of(above, len(x) - 1, 1.66),
    ]


def _chi2(x: float, pairs: int) -> float:
    """Distribution function of chi-square with 2 * pairs degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(pairs))


def _chi2_quantile(share: float, pairs: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, pairs) < share else (low, middle)
    return low


def consistency(share: float) -> float:
    """Factor that makes the covariance of the central share of normal rows the whole covariance."""
    return share / _chi2(_chi2_quantile(share, DIM // 2), DIM // 2 + 1)


def _fit(weights: np.ndarray, sums: np.ndarray, factor: float, floors: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, inverse Cholesky factor and logarithm of the determinant from cells' sums, each cell at its weight."""
    total = weights @ sums
    mean, cov = total[1 : DIM + 1] / total[0], np.zeros((DIM, DIM))
    for (i, j), product in zip(PRODUCTS, total[DIM + 1 :] / total[0], strict=True):
        cov[i, j] = cov[j, i] = product - mean[i] * mean[j]
    cov = cov * factor + np.diag(np.square(floors))
    return mean, np.linalg.inv(np.linalg.cholesky(cov)), float(np.linalg.slogdet(cov)[1])


def robust_fit(cells: np.ndarray, sums: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Centre and whitening of a group from the coordinates and the sums (n, vectors, products) of its cells.

    A step takes the cells nearest by their means until the covered number of rows is reached,
    the last one in part; of cells equally near, those of smaller coordinates first.
    """
    order = np.lexsort(cells.T[::-1])
    cells, sums = cells[order], sums[order]
    rows, means = sums[:, 0], sums[:, 1 : DIM + 1] / sums[:, :1]
    covered = math.ceil(settings.coverage * rows.sum() - 1e-9)

    def far(mean: np.ndarray, white: np.ndarray) -> np.ndarray:
        return np.square((means - mean) @ white.T).sum(axis=1)

    by_dim = []
    for d in range(DIM):
        bins, of = np.unique(cells[:, d], return_inverse=True)
        by_dim.append(_histogram_starts(bins, np.bincount(of, rows), settings.cells[d]))
    best = None
    for start in zip(*by_dim, strict=True):
        mean = np.array([centre for centre, _ in start])
        white = np.diag([1 / math.hypot(spread, floor) for (_, spread), floor in zip(start, settings.floors, strict=True)])
        held = None
        while True:
            nearest = np.argsort(np.round(far(mean, white), 9), kind="stable")
            weights = np.empty(len(rows))
            before = np.cumsum(rows[nearest]) - rows[nearest]
            weights[nearest] = np.clip((covered - before) / rows[nearest], 0, 1)
            made = _fit(weights, sums, consistency(settings.coverage), settings.floors)
            if held is not None and held[2] - made[2] <= STEADY:
                break  # the determinant no longer falls
            held, (mean, white, _) = made, made
        if best is None or held[2] < best[2] - STEADY:
            best = held
    near = far(*best[:2]) < _chi2_quantile(0.975, DIM // 2)
    return _fit(near.astype(float), sums, consistency(0.975), settings.floors)[:2] if near.any() else best[:2]


def distance() -> Column:
    """Squared Mahalanobis distance to the estimate in the row's columns."""
    total = F.lit(0.0)
    for i in range(DIM):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"w{i}{j}") * (F.col(f"v{j}") - F.col(f"m{j}"))
        total = total + part * part
    return total


def estimates(stats: DataFrame, settings: Settings) -> DataFrame:
    """Rows (level, lang, source, mean, whitening): 2 for a language and source, 1 for a language, 0 for all."""
    found = _cells(stats.filter(~base_failed(settings)), settings)
    coded = {f"_{c}": F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("lang", "source")}
    texts = [T.StructField(c, T.StringType()) for c in ("lang", "source")]
    schema = T.StructType([T.StructField("level", T.LongType()), *texts, *[T.StructField(c, T.DoubleType()) for c in (*MEAN, *WHITE)]])

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            names = [table.column(c) for c in ("level", "lang", "source")]
            cells = np.stack([table.column(c).to_numpy() for c in CELL], axis=1)
            sums = np.stack([table.column(c).to_numpy() for c in SUMS], axis=1)
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                key = [c[int(lo)].as_py() for c in names]
                if key[0] == 0 or sums[lo:hi, 0].sum() >= settings.least_rows:
                    mean, white = robust_fit(cells[lo:hi], sums[lo:hi], settings)
                    out.append((*key, *mean.tolist(), *[float(white[i, j]) for i, j in PRODUCTS]))
            columns = zip(*out, strict=True) if out else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow_schema(schema).types, strict=True)], names=schema.names)

        return work

    return map_groups(found.withColumns(coded), ["level", "_lang", "_source"], make, schema)


def verdicts(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, the counts, base_failed, far (squared distance) and kept, one row per row of docs.

    A text without words (or null) has counts of 0 and fails the base rules. Null languages
    and sources are groups of their own. A group of fewer than `least_rows` rows that pass
    the base rules is judged by its language, and a small language by all documents, however few
    these are; far is null only if no row passes the base rules. Other columns are not read;
    repeated rows are judged one by one and count as often as they come.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "outliers")
    measured = _measured(docs.select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"])
    stats = scratch.settle(measured, "stats")
    fitted = scratch.settle(estimates(stats, settings), "estimates")
    return _with_distance(stats, fitted).select(
        "doc_id", *NAMES[:5], base_failed(settings).alias("base_failed"), "far", _kept(settings).alias("kept")
    )


def _with_distance(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """`far` from the estimate of the smallest group that has one."""
    for level, keys in ((1, ["lang"]), (2, ["lang", "source"])):
        part = fitted.filter(F.col("level") == level)
        part = part.select(*[F.col(k).alias(f"_{k}") for k in keys], *MEAN, *WHITE)
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        rows = rows.join(part, on, "left").withColumn(f"far{level}", distance())
        rows = rows.drop(*[f"_{k}" for k in keys], *MEAN, *WHITE)
    whole = fitted.filter("level = 0").select(*MEAN, *WHITE).first()  # one row of 14 numbers
    far = F.lit(None).cast("double")
    if whole:
        rows = rows.withColumns({c: F.lit(whole[c]) for c in (*MEAN, *WHITE)}).withColumn("far0", distance())
        far = F.col("far0")
    return rows.withColumn("far", F.coalesce("far2", "far1", far)).drop("far0", "far1", "far2", *MEAN, *WHITE)


def passing(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents that `verdicts` keeps, with all their columns, whatever these are called.

    The statistics of every document are taken twice, once for the estimates and once for the
    verdicts: that costs less than a shuffle of all texts to bring verdicts back to them.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "outliers")
    stats = _measured(docs.select("lang", "source", "text"), ["lang", "source"])
    fitted = scratch.settle(estimates(stats, settings), "estimates")
    whole = docs.select(F.struct("*").alias("row"), "lang", "source", "text")
    judged = _with_distance(_measured(whole, ["row", "lang", "source"]), fitted)
    return judged.filter(_kept(settings)).select("row.*")
