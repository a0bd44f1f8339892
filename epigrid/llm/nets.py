"""Word features and training helpers of the text classifiers."""

from __future__ import annotations

import re
import zlib

import numpy as np

WORD = re.compile(r"[^\W_]+")
GROUPS = 1 << 18


def word_features(word: str) -> list[int]:
    """Hashed features of one lower-case word: itself and its first letters."""
    out = [zlib.crc32(word.encode()) % GROUPS]
    for n in (5, 6, 7):
        if len(word) > n:
            out.append(zlib.crc32(f"{word[:n]}*".encode()) % GROUPS)
    return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


class Adam:
    def __init__(self, shapes: dict[str, tuple], seed: int, rate: float, scale: float = 0.1):
        rng = np.random.default_rng(seed)
        self.w = {k: rng.normal(0, scale, s) if len(s) else np.zeros(s) for k, s in shapes.items()}
        self.m = {k: np.zeros(s) for k, s in shapes.items()}
        self.v = {k: np.zeros(s) for k, s in shapes.items()}
        self.rate, self.t = rate, 0

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.w[k] = self.w[k] - self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
