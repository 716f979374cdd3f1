"""A generative label model: hidden class, many voters of unknown accuracy, some of them correlated.

Votes are 0 (abstains), 1 (for class 0) and 2 (for class 1). Expectation-maximisation estimates the
share of class 1 and what each voter does under either class. A voter may depend on one other
voter, its parent; parents are found as the strongest correlations that remain within a class, so
that voters which repeat each other don't count twice.
"""

from dataclasses import dataclass

import numpy as np

VOTES = 3
#: Correlation from which two voters are taken for one another's copy.
TWINS = 0.9


@dataclass
class LabelModel:
    prior: float
    parent: list
    table: np.ndarray  # [voter, class, vote of the parent, vote]

    def posterior(self, votes):
        """Probability of class 1 for each row of votes."""
        score = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, up in enumerate(self.parent):
            given = votes[:, up] if up >= 0 else np.zeros(len(votes), np.int64)
            score += np.log(self.table[j][:, given, votes[:, j]]).T
        top = score.max(axis=1, keepdims=True)
        odds = np.exp(score - top)
        return odds[:, 1] / odds.sum(axis=1)

    def accuracies(self):
        """Of each voter: share of right votes among those it casts, by the model itself."""
        right = (1 - self.prior) * self.table[:, 0, 0, 1] + self.prior * self.table[:, 1, 0, 2]
        cast = right + (1 - self.prior) * self.table[:, 0, 0, 2] + self.prior * self.table[:, 1, 0, 1]
        return right / cast


def _maximise(votes, weight, p, parent, prior, smooth):
    table = np.empty((votes.shape[1], 2, VOTES, VOTES))
    for j, up in enumerate(parent):
        given = votes[:, up] if up >= 0 else np.zeros(len(votes), np.int64)
        for c, share in enumerate((1 - p, p)):
            plain = np.bincount(votes[:, j], weight * share, VOTES) + smooth
            plain /= plain.sum()
            both = np.bincount(given * VOTES + votes[:, j], weight * share, VOTES * VOTES).reshape(VOTES, VOTES)
            both += 10 * smooth * plain
            table[j, c] = both / both.sum(axis=1, keepdims=True)
    if prior is None:
        prior = float(np.clip((weight * p).sum() / max(weight.sum(), 1e-9), 0.01, 0.99))
    return LabelModel(prior, list(parent), table)


def _parents(votes, weight, p, least):
    """The maximum spanning forest of the correlations within the classes, by voter."""
    m, total = votes.shape[1], max(weight.sum(), 1e-9)
    signal = (votes == 2).astype(float) - (votes == 1)
    strength = np.zeros((m, m))
    for share in (1 - p, p):
        w = weight * share
        mass = max(w.sum(), 1e-9)
        x = signal - (w @ signal) / mass
        cov = (x * w[:, None]).T @ x / mass
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        strength += np.abs(cov / np.outer(sd, sd)) * (mass / total) * (np.outer(sd, sd) > 1e-4)
    parent, group = [-1] * m, list(range(m))
    for i, j in sorted(((i, j) for j in range(m) for i in range(j)), key=lambda e: -strength[e]):
        if strength[i, j] >= least and group[i] != group[j] and parent[j] < 0:
            parent[j] = i
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    return parent


def fit(votes, weight, start, prior=None, rounds=50, least=0.15, smooth=0.5):
    """A model of the rows of ``votes`` (each counts ``weight`` times).

    ``start``: first guess of the probability of class 1 of each row, from which class 1 takes its
    meaning. ``prior`` fixes the share of class 1. ``least``: correlation from which a voter
    depends on another. Without rows, the posterior is the prior, or a half.
    """
    votes, weight = np.asarray(votes, np.int64), np.asarray(weight, float)
    p = np.asarray(start, float)
    # at first only voters that nearly repeat each other are tied, which would else decide what the class is;
    # the other correlations are read from the classes once these are known
    for bound in (max(least, TWINS), least):
        parent = _parents(votes, weight, p, bound)
        for _ in range(rounds):
            model = _maximise(votes, weight, p, parent, prior if len(votes) else prior or 0.5, smooth)
            new = model.posterior(votes)
            done = not len(new) or np.abs(new - p).max() < 1e-6
            p = new
            if done:
                break
    return model
