"""Static binary fuse filters: eight bits of fingerprint at three places each, about nine bits a key."""

from __future__ import annotations

import math

import numpy as np

from clickloom.llm.common import mix


class FuseFilter:
    """Holds every key it was built from, and about one in 256 others. Never changed once built."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray) -> None:
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    @staticmethod
    def _places(mixed: np.ndarray, segment: int, segments: int) -> np.ndarray:
        """Three places of each key in three neighbouring segments."""
        first = ((mixed >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((mixed >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (mixed & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _print(mixed: np.ndarray) -> np.ndarray:
        return (mixed ^ (mixed >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Keys that stand alone at a place are taken away round by round; places are filled backwards."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
        space = int(max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 10))) * n) if n > 1 else 0
        segments = max(1, -(-space // segment) - 2)
        for seed in range(1, 1000):
            mixed = mix(keys ^ mix(np.array([seed], np.uint64)))
            places = cls._places(mixed, segment, segments)
            left = np.arange(n)
            rounds = []
            while len(left):
                counts = np.bincount(places[:, left].ravel(), minlength=(segments + 2) * segment)
                alone = counts[places[:, left]] == 1
                which = alone.argmax(axis=0)
                free = alone.any(axis=0)
                if not free.any():
                    break
                rounds.append((left[free], which[free]))
                left = left[~free]
            if not len(left):
                prints = np.zeros((segments + 2) * segment, np.uint8)
                wanted = cls._print(mixed)
                for taken, which in reversed(rounds):
                    at = places[:, taken]
                    own = at[which, np.arange(len(taken))]
                    prints[own] = wanted[taken] ^ prints[at[0]] ^ prints[at[1]] ^ prints[at[2]]
                return cls(seed, segment, segments, prints)
        raise RuntimeError("no seed lets these keys be laid out")

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mixed = mix(keys.astype(np.uint64) ^ mix(np.array([self.seed], np.uint64)))
        at = self._places(mixed, self.segment, self.segments)
        return (self.prints[at[0]] ^ self.prints[at[1]] ^ self.prints[at[2]]) == self._print(mixed)
