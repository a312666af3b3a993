"""A generative model of binary votes: accuracies, correlations and posterior labels.

Each voter votes or abstains on a document. The covariances of independent voters are of
rank one; what differs from that shows the correlated pairs. Given the class, the votes
form a forest along such pairs, chosen by conditional mutual information, so that voters
that look at the same thing are not counted as independent witnesses. First estimates come
from the same covariances; expectation maximisation over all documents refines them. Labelled rows anchor the two classes. The
driver holds tables of voters by voters; the votes stay in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
#: A residual correlation above this makes a pair of voters a correlated one.
CORRELATED = 0.1
_LEAST = 1e-4


def bits(votes: np.ndarray, voters: int) -> np.ndarray:
    """A row of zeros and ones per mask of votes."""
    return ((votes[:, None] >> np.arange(voters)) & 1).astype(np.int8)


@dataclass
class LabelModel:
    """Class shares, and the probability of each vote given its parent's vote and the class.

    ``tables[y, i, p]`` is the chance that voter ``i`` votes in class ``y`` where its
    parent's vote is ``p``; a root has no parent (-1) and two equal entries.
    """

    share: float
    parents: np.ndarray
    tables: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance of class 1 for each mask of votes."""
        voters = len(self.parents)
        x = bits(votes, voters)
        given = np.where(self.parents < 0, 0, x[:, np.maximum(self.parents, 0)])
        logs = []
        for y, share in ((0, 1 - self.share), (1, self.share)):
            chance = self.tables[y][np.arange(voters), given]
            logs.append(np.log(share) + np.log(np.where(x == 1, chance, 1 - chance)).sum(1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def pair_counts(votes: np.ndarray, weights: np.ndarray, voters: int) -> np.ndarray:
    """How often each pair of voters votes, weighted; a last row and column for always."""
    x = np.column_stack([bits(votes, voters), np.ones(len(votes))]).astype(np.float64)
    return x.T @ (x * weights[:, None])


def _counted(histogram: DataFrame, model: LabelModel | None, voters: int) -> np.ndarray:
    """Pair counts over all documents, of both classes by the model's posteriors: all in the second without one."""
    given = histogram.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, voters + 1, voters + 1))
        for batch in batches:
            votes, n = (batch.column(c).to_numpy() for c in ("votes", "n"))
            share = np.ones(len(votes)) if given.value is None else given.value.posterior(votes)
            total += [pair_counts(votes, n * (1 - share), voters), pair_counts(votes, n * share, voters)]
        c, i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (c, i, j, total[c, i, j])], ["class", "i", "j", "value"])

    parts = histogram.mapInArrow(count, "class long, i long, j long, value double")
    rows = parts.groupBy("class", "i", "j").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((2, voters + 1, voters + 1))
    total[rows["class"], rows["i"], rows["j"]] = rows["value"]
    return total


def rank_one(covariance: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """``z`` with ``z_i * z_j`` near the covariance of uncorrelated pairs, and the correlated pairs.

    Three voters give one estimate each of their ``z``; the median over all such triplets
    starts the fit, as a correlated pair spoils few of them. Pairs far from the fit are
    then left out of it, and those that end far from it are the correlated ones.
    """
    scale = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    r = covariance / np.outer(scale, scale)
    count, other = len(r), ~np.eye(len(r), dtype=bool)
    z = np.zeros(count)
    for i in range(count):
        j, k = np.nonzero(np.triu(np.abs(r) > 0.02, 1) & other[i][:, None] & other[i][None])
        if len(j):
            z[i] = max(0.0, float(np.percentile(r[i, j] * r[i, k] / r[j, k], 50, method="lower"))) ** 0.5
    z = np.minimum(z, 1.0)
    # All but the strongest voter get the sign by which they agree with it.
    z *= np.where(r[np.argmax(z)] < 0, -1, 1)
    for _ in range(rounds):
        off = np.abs(r - np.outer(z, z))
        use = (off <= CORRELATED) & other
        z = 0.5 * z + 0.5 * np.clip(((r * use) @ z) / np.maximum((use * z**2).sum(1), 1e-9), -1, 1)
    return z * scale, (np.abs(r - np.outer(z, z)) > CORRELATED) & other


def _first(total: np.ndarray, share: float) -> tuple[LabelModel, np.ndarray]:
    """Independent voters, by the covariances of their votes, and the correlated pairs."""
    n = max(total[-1, -1], 1.0)
    mean = np.diag(total)[:-1] / n
    z, pairs = rank_one(total[:-1, :-1] / n - np.outer(mean, mean))
    z = z * (1 if z.sum() >= 0 else -1)
    chances = np.array([mean - z * (share / (1 - share)) ** 0.5, mean + z * ((1 - share) / share) ** 0.5])
    chances = np.clip(chances, _LEAST, 1 - _LEAST)
    return LabelModel(share, np.full(len(mean), -1), np.repeat(chances[:, :, None], 2, 2)), pairs


def _joint(total: np.ndarray) -> np.ndarray:
    """``[i, j, a, b]``: how often voter ``i`` does ``a`` where ``j`` does ``b``, smoothed."""
    n, both = total[-1, -1], total[:-1, :-1]
    one = np.diag(both)
    table = np.empty((*both.shape, 2, 2))
    table[:, :, 1, 1] = both
    table[:, :, 1, 0] = one[:, None] - both
    table[:, :, 0, 1] = one[None] - both
    table[:, :, 0, 0] = n - one[:, None] - one[None] + both
    return np.maximum(table, 0) + 0.25


def forest(totals: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The parent of each voter in the forest of ``pairs`` with most mutual information given the class; -1 at a root."""
    information = np.zeros(pairs.shape)
    for total in totals:
        joint = _joint(total)
        joint /= joint.sum((2, 3), keepdims=True)
        apart = joint.sum(3, keepdims=True) * joint.sum(2, keepdims=True)
        information += total[-1, -1] * (joint * np.log(joint / apart)).sum((2, 3))
    information = np.where(pairs, np.maximum(information, 0), -1.0)
    near, parents, left = np.full(len(pairs), -1.0), np.full(len(pairs), -1), list(range(len(pairs)))
    while left:
        i = max(left, key=lambda k: (near[k], -k))
        left.remove(i)
        for j in left:
            if information[i, j] > near[j]:
                near[j], parents[j] = information[i, j], i
    return parents


def fitted(totals: np.ndarray, pairs: np.ndarray) -> LabelModel:
    """The model of given pair counts of both classes, with correlations along ``pairs`` only."""
    parents = forest(totals, pairs)
    tables = np.empty((2, len(parents), 2))
    for y, total in enumerate(totals):
        joint = _joint(total)
        for i, p in enumerate(parents):
            if p < 0:
                tables[y, i] = (total[i, i] + 0.5) / (total[-1, -1] + 1)
            else:
                tables[y, i] = joint[i, p, 1] / joint[i, p].sum(0)
    share = (totals[1, -1, -1] + 1) / (totals[:, -1, -1].sum() + 2)
    return LabelModel(float(share), parents, np.clip(tables, _LEAST, 1 - _LEAST))


def fit_label_model(histogram: DataFrame, anchors: np.ndarray, voters: int, rounds: int = ROUNDS) -> LabelModel:
    """The model of all documents' votes: ``votes, n``, masks and how many documents have them.

    ``anchors`` are pair counts of labelled rows of both classes; they weigh as much as
    all documents together. Without any, the class that more voters vote for is class 1
    and its share starts at a tenth.
    """
    known = anchors[:, -1, -1]
    share = float(np.clip(known[1] / known.sum(), 0.01, 0.99)) if known.sum() else 0.1
    model, pairs = _first(_counted(histogram, None, voters)[1], share)
    for _ in range(rounds):
        totals = _counted(histogram, model, voters)
        weight = totals[:, -1, -1].sum() / known.sum() if known.sum() else 0
        model = fitted(totals + weight * anchors, pairs)
    return model
