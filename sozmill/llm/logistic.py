"""Logistic regression on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Linear:
    """Log odds as a linear function of features."""

    weights: np.ndarray
    bias: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias


@dataclass
class Standard:
    """Features moved and scaled, with a column of ones; a feature that doesn't vary counts for nothing."""

    middle: np.ndarray
    scale: np.ndarray

    @classmethod
    def of(cls, features: np.ndarray) -> Standard:
        return cls.of_moments(features.mean(axis=0), features.std(axis=0))

    @classmethod
    def of_moments(cls, middle: np.ndarray, scale: np.ndarray) -> Standard:
        return cls(middle, np.where(scale < 1e-6, np.inf, scale))

    @classmethod
    def none(cls, size: int) -> Standard:
        return cls(np.zeros(size), np.ones(size))

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [(features - self.middle) / self.scale, np.ones((len(features), 1))], axis=1).astype(np.float64)

    def linear(self, w: np.ndarray) -> Linear:
        weights = w[:-1] / self.scale
        return Linear(weights.astype(np.float32), float(w[-1] - self.middle @ weights))


def sums(x: np.ndarray, label: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, its gradient and its curvature at ``w``; those of several sets of rows add up."""
    z = x @ w
    p = probability(z)
    curvature = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
    return float((weight * (label * z - np.logaddexp(0, z))).sum()), x.T @ (weight * (label - p)), curvature


class Climb:
    """Newton's method with a ridge, step by step; a step that makes things worse is halved.

    ``at`` is the next place to evaluate, ``best`` the best one that was. The bias has next to no ridge.
    """

    def __init__(self, start: np.ndarray, ridge: float = 1.0):
        self.at, self.best, self.value = start, start, -np.inf
        self.penalty = np.full(len(start), ridge)
        self.penalty[-1] = 1e-6
        self.step = np.zeros(len(start))

    def update(self, value: float, gradient: np.ndarray, curvature: np.ndarray) -> float:
        """Takes what was found at ``at`` and moves on; how far."""
        value -= float((self.penalty * self.at ** 2).sum()) / 2
        if value >= self.value:
            self.best, self.value = self.at, value
            self.step = np.linalg.solve(curvature + np.diag(self.penalty), gradient - self.penalty * self.at)
        else:
            self.step = self.step / 2
        self.at = self.best + self.step
        return float(np.abs(self.step).max())


def fit_logistic(features: np.ndarray, label: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None,
                 standardise: bool = True) -> Linear:
    """Logistic regression with a ridge, on standardised features if wished."""
    weight = np.ones(len(features)) if weight is None else weight
    standard = Standard.of(features) if standardise else Standard.none(features.shape[1])
    return standard.linear(solve_logistic(standard(features), label, weight, ridge))


def solve_logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Weights for rows that are in memory."""
    climb = Climb(np.zeros(x.shape[1]), ridge)
    for _ in range(rounds):
        if climb.update(*sums(x, label, weight, climb.at)) < 1e-6:
            break
    return climb.best


def probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.asarray(logits, dtype=np.float64), -30, 30)))
