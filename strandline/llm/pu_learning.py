"""Non-negative positive-unlabelled learning in numpy.

The risk of a classifier is estimated from trusted positives and unlabelled rows: prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1)),
with the logistic loss; where the second part falls below zero, only its own gradient is followed, upwards.
The class prior is estimated from the two samples: a first classifier of positives against unlabelled rows ranks them,
and the smallest ratio of the unlabelled to the positive share above a threshold bounds the prior. With fewer than LEAST rows
of either kind, or where no threshold tells them apart, a given prior stands in; without any rows the scores are that prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: Rows of either kind from which on the prior is estimated.
LEAST = 4


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """A linear model (hidden 0) or one hidden layer, on standardised inputs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale)[0]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.weights) == 2:
            return x @ self.weights[0] + self.weights[1], x
        h = np.maximum(x @ self.weights[0] + self.weights[1], 0)
        return h @ self.weights[2] + self.weights[3], h

    def gradient(self, x: np.ndarray, h: np.ndarray, dz: np.ndarray) -> list[np.ndarray]:
        if len(self.weights) == 2:
            return [x.T @ dz.astype(x.dtype), np.array(dz.sum())]
        dh = np.outer(dz, self.weights[2]) * (h > 0)
        return [x.T @ dh, dh.sum(0), h.T @ dz, np.array(dz.sum())]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, hidden: int = 0, steps: int = 400, rate: float = 0.02, decay: float = 1e-4, seed: int = 7, standardise: bool = True) -> Model:
    """prior None: plain classification of positives against unlabelled rows."""
    rng = np.random.default_rng(seed)
    if standardise:
        both = np.concatenate([positive, unlabelled])
        mean, scale = both.mean(0), np.maximum(both.std(0), 1e-3)
        p, u = ((x - mean) / scale for x in (positive, unlabelled))
    else:
        mean, scale, p, u = np.zeros(1, positive.dtype), np.ones(1, positive.dtype), positive, unlabelled
    d = p.shape[1]
    weights = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(())] if hidden else [np.zeros(d, p.dtype), np.zeros((), p.dtype)]
    model = Model(mean, scale, weights)
    m, v = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for t in range(1, steps + 1):
        zp, hp = model.forward(p)
        zu, hu = model.forward(u)
        up_p, up_u = sigmoid(zp), sigmoid(zu)  # gradients of the losses: sigmoid - 1 for +1, sigmoid for -1
        if prior is None:
            dp, du = (up_p - 1) / len(p), up_u / len(u)
        else:
            rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if rest >= 0:
                dp, du = prior * (up_p - 1 - up_p) / len(p), up_u / len(u)
            else:
                dp, du = prior * up_p / len(p), -up_u / len(u)
        grads = [a + b for a, b in zip(model.gradient(p, hp, dp), model.gradient(u, hu, du), strict=True)]
        for k, g in enumerate(grads):
            g = g + decay * weights[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            weights[k] = (weights[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(weights[k].dtype)
        model.weights = weights
    return model


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.05) -> float | None:
    """Share of positives among unlabelled rows: q_u(t) / q_p(t) at the threshold t of held-back scores where its upper bound is smallest. None if that threshold takes in every unlabelled row."""
    z_p, z_u = np.sort(positive)[::-1], np.sort(unlabelled)[::-1]
    slack = np.sqrt(np.log(4 / confidence) / 2) * (len(z_p) ** -0.5 + len(z_u) ** -0.5)
    share = np.searchsorted(-z_p, -z_p, "right") / len(z_p)
    q_u = np.searchsorted(-z_u, -z_p, "right") / len(z_u)
    k = np.argmin((q_u + slack) / share)
    return None if q_u[k] == 1 else float(np.clip(q_u[k] / share[k], 0.01, 0.99))


def constant(columns: int, score: float) -> Model:
    """The same score for every row."""
    return Model(np.zeros(1), np.ones(1), [np.zeros(columns), np.array(np.log(score / (1 - score)))])


def fit(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 0, fallback: float = 0.5, **options) -> tuple[Model, float]:
    """The non-negative PU classifier and the prior that it used. Halves of both samples rank each other for the prior; where that can't be done it is ``fallback``."""
    if not len(positive) or not len(unlabelled):
        return constant(positive.shape[1], fallback), fallback
    if min(len(positive), len(unlabelled)) < LEAST:
        return train(positive, unlabelled, fallback, hidden, **options), fallback
    priors = []
    for k in range(2):
        ranker = train(positive[k::2], unlabelled[k::2], None, hidden, **options)
        priors.append(estimate_prior(ranker.raw(positive[1 - k :: 2]), ranker.raw(unlabelled[1 - k :: 2])))
    known = [p for p in priors if p is not None]
    prior = float(np.mean(known)) if known else fallback
    return train(positive, unlabelled, prior, hidden, **options), prior
