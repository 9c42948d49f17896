"""A block-max inverted index of weighted vectors, searched exactly by cosine.

Postings of a term are grouped by blocks of BLOCK consecutive vectors. Each group's greatest
weight bounds what the term adds to any vector of the block, so that a query's sums of bounds
say which blocks can hold a near vector. The most promising blocks are scored first; then
every other block whose bound reaches the k-th best cosine found. The result is exact.
"""

from __future__ import annotations

import numpy as np

from offerwise.llm.words import gather

BLOCK = 64
FIRST = 6

# Sums of bounds and of products are rounded differently.
SLACK = 1e-9


class BlockMaxIndex:
    """Vectors of unit length, given as their (vector, term, weight) triples."""

    def __init__(self, vector: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, n_terms: int):
        order = np.lexsort((vector, term))
        self.vector = vector[order].astype(np.int32)
        self.weight = weight[order].astype(np.float64)
        term, block = term[order], self.vector // BLOCK
        fresh = np.ones(len(term), bool)
        fresh[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.first = np.flatnonzero(fresh)  # of each group of postings
        self.size = np.diff(np.append(self.first, len(term)))
        self.block = block[self.first]
        self.top = np.maximum.reduceat(self.weight, self.first) if len(term) else np.zeros(0)
        self.groups = np.searchsorted(term[self.first], np.arange(n_terms + 1))
        self.n = n
        self.blocks = max(1, -(-n // BLOCK))

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, least: float = 0.0
    ) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, cosines) of the k nearest of cosine `least` or more, by cosine, then number;
        ties at the last place included, vectors that share no term left out. The query's
        length is one, or less where words of its own are left out of `terms`."""
        counts = self.groups[terms + 1] - self.groups[terms]
        at = gather(self.groups[terms], counts)
        part = np.repeat(weights, counts)
        bounds = np.bincount(self.block[at], part * self.top[at], self.blocks)
        alive = (bounds > 0) & (bounds >= least - SLACK)
        if not alive.any():
            return np.zeros(0, np.int64), np.zeros(0)
        cosines = np.zeros(self.blocks * BLOCK)

        def score(chosen: np.ndarray) -> None:
            inside = chosen[self.block[at]]
            own = at[inside]
            postings = gather(self.first[own], self.size[own])
            given = np.repeat(part[inside], self.size[own]) * self.weight[postings]
            cosines[:] += np.bincount(self.vector[postings], given, len(cosines))

        best = np.zeros(self.blocks, bool)
        best[np.argsort(-bounds, kind="stable")[:FIRST]] = True
        score(best & alive)
        k = min(k, self.n)
        kth = np.partition(cosines, -k)[-k] if k else 0.0
        score(~best & alive & (bounds >= kth - SLACK))
        found = np.flatnonzero((cosines > 0) & (cosines >= least - SLACK))
        cosine = np.round(cosines[found], 9)
        order = np.lexsort((found, -cosine))
        found, cosine = found[order], cosine[order]
        last = np.searchsorted(-cosine, -cosine[k - 1], "right") if 0 < k < len(found) else len(found)
        return found[:last], cosine[:last]
