"""A quality classifier: regularised quadratic discriminant over statistics of whole texts.

Each text becomes a vector of transformed counts. Of the labelled texts only the number, the sums and the
sums of products per class are needed, so all of them are used and two rows reach the driver. There
the class covariances are shrunk, towards each other and towards a sphere, and factored once
(Cholesky). The score of a text is the difference of the two log densities, from the Mahalanobis
lengths with the inverse factors, and a logistic curve turns it into a probability. That curve is fitted
on a histogram of the labelled scores, of fixed size.

Labels, language, source and id are never part of a vector.

Defined cases: a null or empty text is a vector of zero counts and gets a score; rows with a null label
or one other than 0 and 1 teach nothing, a label given several times counts as often; with no rows of
one class all scores are the share of the other (0.5 without any); repeated rows get equal
scores; an empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined
from tallyloom.llm.textstats import with_counts
from tallyloom.session import as_table

OWN = "_class_"
TOWARDS_POOLED = 0.25  # share of the pooled covariance in each class's
TOWARDS_SPHERE = 0.02  # share of its mean variance on the diagonal
LEAST_VARIANCE = 1e-4
BINS = 400  # of the histogram that the logistic curve is fitted on
EDGE = 50.0  # log density differences beyond this count as this


def _ratio(part: str, whole: str, more: float = 1.0) -> Column:
    """The root of a share, which spreads small shares; a little more in the whole for short texts."""
    return F.sqrt(F.col(OWN + part) / (F.col(OWN + whole) + more))


def features() -> list[Column]:
    n = F.col(OWN + "n_words")
    letters = F.col(OWN + "n_upper") + F.col(OWN + "n_lower") + F.col(OWN + "n_wide")
    return [
        F.log1p(n.cast("double")),
        F.log((F.col(OWN + "word_chars") + 5) / (n + 1)),
        _ratio("n_symbols", "word_chars"),
        _ratio("n_odd", "word_chars"),
        _ratio("n_dup_lines", "n_lines"),
        _ratio("n_repeat_words", "n_words"),
        _ratio("n_distinct", "n_words"),
        _ratio("n_same", "n_words"),
        F.sqrt(F.col(OWN + "n_upper") / (letters + 1)),
        _ratio("n_shouts", "n_words"),
        _ratio("n_bare", "n_words"),
        _ratio("n_ends", "n_words"),
        _ratio("n_digits", "word_chars"),
        _ratio("n_marks", "word_chars"),
    ]


@dataclass(frozen=True)
class Moments:
    count: int
    mean: np.ndarray
    covariance: np.ndarray


@dataclass(frozen=True)
class Discriminant:
    means: np.ndarray  # one row per class
    inverse_factors: np.ndarray  # of the shrunk covariances
    log_scales: np.ndarray  # half the log determinants

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density under class 1 less that under class 0, without the classes' shares."""
        log_density = [-0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - s
                       for m, f, s in zip(self.means, self.inverse_factors, self.log_scales)]
        return np.clip(log_density[1] - log_density[0], -EDGE, EDGE)


def discriminant(classes: list[Moments]) -> Discriminant:
    size = len(classes[0].mean)
    total = sum(c.count for c in classes)
    pooled = sum(c.count * c.covariance for c in classes) / total
    factors, scales = [], []
    for c in classes:
        shrunk = (1 - TOWARDS_POOLED) * c.covariance + TOWARDS_POOLED * pooled
        shrunk = ((1 - TOWARDS_SPHERE) * shrunk
                  + (TOWARDS_SPHERE * np.trace(shrunk) / size + LEAST_VARIANCE) * np.eye(size))
        factor = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(factor))
        scales.append(np.log(np.diag(factor)).sum())
    return Discriminant(np.array([c.mean for c in classes]), np.array(factors), np.array(scales))


def moments(labelled: DataFrame) -> dict[int, Moments]:
    """Per class of (label, x): count, mean and covariance, from sums that Spark adds up."""
    size = len(features())
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    x = F.col("x")
    rows = labelled.groupBy("label").agg(
        F.count("*").alias("n"), F.array(*[F.sum(x[i]) for i in range(size)]).alias("sums"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("products")).collect()
    found = {}
    for row in rows:
        mean = np.array(row["sums"]) / row["n"]
        products = np.zeros((size, size))
        for (i, j), value in zip(pairs, row["products"]):
            products[i, j] = products[j, i] = value / row["n"]
        found[row["label"]] = Moments(row["n"], mean, products - np.outer(mean, mean))
    return found


def logistic(bins: list[tuple[float, int, int]], rounds: int = 50) -> tuple[float, float]:
    """(slope, offset) by Newton's method from (difference, texts, texts of class 1)."""
    x, n, good = (np.array(c, float) for c in zip(*bins))
    slope, offset = 0.3, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        weight = n * p * (1 - p)
        gradient = np.array([((good - n * p) * x).sum() - 1e-3 * slope, (good - n * p).sum() - 1e-3 * offset])
        curvature = np.array([[(weight * x * x).sum() + 1e-3, (weight * x).sum()],
                              [(weight * x).sum(), weight.sum() + 1e-3]])
        step = np.linalg.solve(curvature, gradient)
        step *= min(1.0, 1.0 / max(abs(step).max(), 1e-12))
        slope, offset = max(slope + step[0], 1e-3), offset + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def _differences(rows: DataFrame, model: Discriminant, keep: str) -> DataFrame:
    """(keep, difference) of (keep, x)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = model.means.shape[1]
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.difference(x))], names=[keep, "difference"])

    kind = rows.schema[keep].dataType.simpleString()
    return rows.select(keep, "x").mapInArrow(measure, f"{keep} {kind}, difference double")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; learnt from ``labels`` (doc_id, label).

    The texts are read once; their vectors are a table in the shared folder.
    """
    counted = with_counts(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), ["doc_id"], OWN)
    vectors = as_table(counted.select("doc_id", F.array(*features()).alias("x")), "class-vectors")
    given = labels.where("label in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    labelled = as_table(joined(given, vectors, ["doc_id"]).select("label", "x"), "class-labelled")
    classes = moments(labelled)
    if set(classes) != {0, 1}:
        share = 0.5 if not classes else float(next(iter(classes)))
        return vectors.select("doc_id", F.lit(share).alias("score"))
    model = discriminant([classes[0], classes[1]])
    edges = F.floor((F.col("difference") + EDGE) * (BINS / (2 * EDGE)))
    bins = (_differences(labelled, model, "label").groupBy(edges.alias("bin"))
            .agg(F.avg("difference"), F.count("*"), F.sum("label")).collect())
    slope, offset = logistic([(r[1], r[2], r[3]) for r in sorted(bins)])
    return _differences(vectors, model, "doc_id").select(
        "doc_id", (1 / (1 + F.exp(-(slope * F.col("difference") + offset)))).alias("score"))
