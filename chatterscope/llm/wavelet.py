"""A wavelet tree over an array, level by level: counts and order statistics of ranges, many queries at a time."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Stores, for each bit of the values from the highest down, how many zeros come before each place.

    On every level the values with a zero stand before those with a one, each in their former order, so a range of the
    array is a range of zeros and one of ones on the next level.
    """

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        now = values.astype(np.int32)
        for bit in range(max(1, int(now.max(initial=0)).bit_length()) - 1, -1, -1):
            zero = (now >> bit & 1) == 0
            before = np.zeros(len(now) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.levels.append((bit, before, int(before[-1])))
            now = np.concatenate([now[zero], now[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range are smaller than its bound."""
        count = np.zeros(len(low), np.int32)
        for bit, before, zeros in self.levels:
            a, b = before[low], before[high]
            one = (bound >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of each range, counted from 0; k must be less than the range is long."""
        value, k = np.zeros(len(low), np.int32), k.copy()
        for bit, before, zeros in self.levels:
            a, b = before[low], before[high]
            one = k >= b - a
            value |= one.astype(np.int32) << bit
            k -= np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return value
