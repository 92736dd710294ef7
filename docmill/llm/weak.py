"""Weak supervision: what overlapping voters say, how far each can be trusted, and what follows for a document.

A document is good, or bad in one of several kinds; there are as many kinds as voters. A voter sees a document of a kind
with a chance of its own, and it raises a false alarm on any document, good or bad, with another. Kinds are needed
because voters look for different defects: with a single bad class, a defect that one voter alone sees counts as that
voter's error, however often it occurs. False alarms fall on documents of other kinds too, which tells them from a kind.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Votes.
BAD, GOOD, ABSTAIN = 1, 0, -1

#: Pseudo-counts (for, against): a voter sees the kind that is its own, and others' kinds; false alarms; good documents.
#: They decide alone where a table is empty, and little where it is large. No estimate is bounded otherwise.
OWN, OTHERS, ALARMS, GOOD_SHARE = (6.0, 1.0), (0.5, 3.0), (1.0, 199.0), (18.0, 2.0)
#: Where the rates start: seen of the own kind, of others', false alarms, bad documents.
START = (0.75, 0.25, 0.02, 0.1)


@dataclass
class Trust:
    """kinds[k]: share of bad documents of kind k; sees[k, j]: chance that voter j sees kind k; alarms[j]: of a false alarm, if it votes."""

    kinds: np.ndarray
    sees: np.ndarray
    alarms: np.ndarray

    @property
    def share(self) -> float:
        """Of bad documents."""
        return float(self.kinds.sum())

    @property
    def bad_votes(self) -> np.ndarray:
        """Chance of a bad vote of each voter on each kind."""
        return 1 - (1 - self.alarms) * (1 - self.sees)

    @property
    def hit(self) -> np.ndarray:
        """Accuracy on bad documents: chance of a bad vote of each voter that votes."""
        return self.kinds @ self.bad_votes / self.kinds.sum()

    @property
    def clear(self) -> np.ndarray:
        """Accuracy on good documents: chance of a good vote."""
        return 1 - self.alarms

    def weights(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of each kind against good: of no votes, and what a bad and a good vote of each voter add."""
        seen = self.bad_votes
        return np.log(self.kinds / (1 - self.share)), np.log(seen / self.alarms), np.log((1 - seen) / (1 - self.alarms))

    def odds(self, votes: np.ndarray) -> np.ndarray:
        """Odds of each kind against good, for rows of votes."""
        base, bad, good = self.weights()
        return np.exp(base + (votes == BAD) @ bad.T + (votes == GOOD) @ good.T)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of bad for rows of votes."""
        total = self.odds(votes).sum(1)
        return total / (1 + total)

    def column(self, votes: list[Column]) -> Column:
        """The same probability as a column."""
        base, bad, good = (x.tolist() for x in self.weights())
        total = F.lit(0.0)
        for k in range(len(base)):
            odds = F.lit(base[k])
            for v, b, g in zip(votes, bad[k], good[k], strict=True):
                odds = odds + F.when(v == BAD, b).when(v == GOOD, g).otherwise(0.0)
            total = total + F.exp(odds)
        return total / (1 + total)


#: Steps of expectation-maximisation: as many on every table, so that results don't hang on when changes became small.
STEPS = 300


def fit(patterns: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> Trust:
    """Expectation-maximisation on how often each pattern of votes occurs. Abstentions say nothing."""
    voters = patterns.shape[1]
    own = np.eye(voters, dtype=bool)
    trust = Trust(np.full(voters, START[3] / voters), np.where(own, START[0], START[1]), np.full(voters, START[2]))
    see_for, see_against = np.where(own, OWN[0], OTHERS[0]), np.where(own, OWN[1], OTHERS[1])
    bad, voted = patterns == BAD, patterns != ABSTAIN
    for _ in range(steps):
        odds = trust.odds(patterns)
        of = counts[:, None] * odds / (1 + odds.sum(1, keepdims=True))  # documents of each pattern and kind
        good = counts - of.sum(1)
        seen = trust.bad_votes
        alarmed, on_kind, votes_on_kind = good @ bad, of.T @ bad, of.T @ voted
        # a bad vote on a kind was a sighting, a false alarm, or both
        sees = (on_kind * trust.sees / seen + see_for) / (votes_on_kind + see_for + see_against)
        alarms = (alarmed + (on_kind * trust.alarms / seen).sum(0) + ALARMS[0]) / (counts @ voted + sum(ALARMS))
        kinds = (of.sum(0) + GOOD_SHARE[1] / voters) / (counts.sum() + sum(GOOD_SHARE))
        trust = Trust(kinds, sees, alarms)
    return trust


def fit_votes(rows: DataFrame, votes: list[str]) -> Trust:
    """fit() over all rows: they are counted by pattern in Spark, of which there are 3 ** len(votes) at most."""
    got = rows.groupBy(*votes).agg(F.count("*").alias("_n")).collect()
    patterns = np.array([[r[v] for v in votes] for r in sorted(got)], np.int64).reshape(-1, len(votes))
    return fit(patterns, np.array([r["_n"] for r in sorted(got)], float))
