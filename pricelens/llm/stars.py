"""Links found in a task, reduced to spanning stars as they come."""

from __future__ import annotations

import numpy as np


class Stars:
    """Joins of items 0..n-1; ``moved`` gives each joined item and its star's centre."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.parent: dict[int, int] = {}

    def _root(self, x: int) -> int:
        while (p := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(p, p)
            x = p
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        keep = a != b
        if not keep.any():
            return
        for x, y in np.unique(np.stack([a[keep], b[keep]], 1), axis=0).tolist():
            x, y = self._root(x), self._root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def settle(self) -> None:
        """Relabel, so that joins within a star cost nothing from here on."""
        if self.parent:
            table = np.arange(len(self.label))
            for x in list(self.parent):
                table[x] = self._root(x)
            self.label = table[self.label]

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        at = np.flatnonzero(self.label != np.arange(len(self.label)))
        return at, self.label[at]
