"""Exact cosine neighbours from a block-max inverted index, in numpy."""

from __future__ import annotations

import numpy as np

#: Examples in a block, and how many of the most promising blocks are scored before others are ruled out.
BLOCK, FIRST = 64, 4
#: Examples around which the others are gathered, so that a block holds examples that are alike and its bounds are low elsewhere.
SEEDS = 32
#: A term in more than the one share of the examples is frequent: its list is a column of a table. One in less than the other is
#: rare: its list is too short to be cut into blocks.
FREQUENT, RARE = 1 / 10, 1 / 100
#: Added to bounds: far more than sums of doubles are off, far less than cosines differ.
SLACK = 1e-9


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each range, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Index:
    """Unit vectors as postings by term, cut into blocks of examples; every part of a list knows its largest weight."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        sizes = np.array([len(v) for v in vectors], np.int64)
        self._lay_out(np.repeat(np.arange(len(vectors)), sizes), np.array([t for v in vectors for t in v], np.int64),
                      np.array([w for v in vectors for w in v.values()], float), len(vectors), n_terms)

    @classmethod
    def of(cls, examples: np.ndarray, terms: np.ndarray, weights: np.ndarray, size: int, n_terms: int) -> Index:
        """The index of `size` vectors from their entries, one per example and term; weights are positive."""
        index = cls.__new__(cls)
        index._lay_out(examples, terms, weights, size, n_terms)
        return index

    def _lay_out(self, examples, terms, weights, size, n_terms):
        self.size, self.blocks = size, -(-size // BLOCK)
        self.origin = self._alike(examples, terms, weights, size, n_terms)
        self.place = np.empty(size, np.int64)
        self.place[self.origin] = np.arange(size)
        examples = self.place[np.asarray(examples, np.int64)]
        frequent = np.bincount(terms, minlength=n_terms) > FREQUENT * size
        self.column, inside = np.where(frequent, np.cumsum(frequent) - 1, -1), frequent[terms]
        self.table = np.zeros((self.blocks * BLOCK, int(frequent.sum())))
        self.table[examples[inside], self.column[terms[inside]]] = weights[inside]
        examples, terms, weights = examples[~inside], terms[~inside], weights[~inside]
        order = np.lexsort((examples, terms))
        self.examples, self.weights, terms = examples[order], np.asarray(weights, float)[order], np.asarray(terms, np.int64)[order]
        self.ends = np.searchsorted(terms, np.arange(n_terms + 1))
        # Lists that are neither frequent nor rare: where each block begins in them, and its largest weight.
        cut = np.flatnonzero(np.diff(self.ends) >= max(2, RARE * size))
        self.cut = np.full(n_terms, -1)
        self.cut[cut] = np.arange(len(cut))
        inside = self.cut[terms] >= 0
        part = self.cut[terms[inside]] * max(1, self.blocks) + self.examples[inside] // BLOCK
        self.largest = np.zeros(len(cut) * max(1, self.blocks))
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        if len(part):
            self.largest[part[starts]] = np.maximum.reduceat(self.weights[inside], starts)
        self.largest = self.largest.reshape(len(cut), max(1, self.blocks))
        counts = np.bincount(part, minlength=self.largest.size).reshape(self.largest.shape)
        self.begins = self.ends[cut][:, None] + np.concatenate([np.zeros((len(cut), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)

    @staticmethod
    def _alike(examples, terms, weights, size, n_terms) -> np.ndarray:
        """The examples ordered by the seed that each is most like."""
        if size <= BLOCK:
            return np.arange(size)
        nearest, best = np.zeros(size, np.int64), np.full(size, -1.0)
        for number, seed in enumerate(np.linspace(0, size - 1, SEEDS).astype(np.int64)):
            vector = np.zeros(n_terms)
            mine = examples == seed
            vector[terms[mine]] = weights[mine]
            cosine = np.bincount(examples, vector[terms] * weights, size)
            nearest[cosine > best] = number
            best = np.maximum(best, cosine)
        return np.argsort(nearest, kind="stable")

    def nearest(self, query: dict[int, float], k: int, but: int = -1) -> list[tuple[int, float]]:
        """The k examples of highest cosine above 0 other than `but`; ties to the earlier example."""
        return self.search(np.array(list(query), np.int64), np.array(list(query.values()), float), k, but)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> list[tuple[int, float]]:
        """nearest() of a query given as its terms and their weights."""
        return self.search_all([(terms, weights)], k, [but])[0]

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int,
                   but: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """search() of several queries; what frequent terms add to every example is one product of two matrices. `but` has an
        example to leave out for each query, or -1."""
        if not self.size:
            return [[] for _ in queries]
        rows = np.zeros((self.table.shape[1], len(queries)))
        for i, (terms, weights) in enumerate(queries):
            column = self.column[terms]
            rows[column[column >= 0], i] = weights[column >= 0]
        frequent = np.ascontiguousarray((self.table @ rows).T)
        return [self._search(terms, weights, cosine, k, one)
                for (terms, weights), cosine, one in zip(queries, frequent, but or [-1] * len(queries))]

    def _search(self, terms: np.ndarray, weights: np.ndarray, cosine: np.ndarray, k: int, but: int) -> list[tuple[int, float]]:
        """The nearest, from what the frequent terms add to each example.

        A block is bounded by the most that these add in it and the most that the other words can. The blocks of
        highest bound are scored; then all others whose bound is not below the kth best cosine of these.
        """
        cut = self.cut[terms]
        rare, cut, weight = (cut < 0) & (self.column[terms] < 0), cut[cut >= 0], weights[cut >= 0]
        starts = self.ends[terms[rare]]
        whole = cosine[:self.size] + self._listed(starts, self.ends[terms[rare] + 1] - starts, weights[rare])
        cosine[:self.size] = whole
        bound = cosine.reshape(self.blocks, BLOCK).max(axis=1) + weight @ self.largest[cut] + SLACK
        chosen = np.ones(self.blocks, bool)
        if self.blocks > FIRST:
            chosen[:] = False
            chosen[np.argpartition(-bound, FIRST)[:FIRST]] = True
        whole += self._of_lists(cut, weight, chosen)
        found = self._best(whole, self._of_blocks(chosen), k, but)
        left = ~chosen & (bound >= (found[-1][1] if len(found) == k else 0.0))
        if left.any():
            whole += self._of_lists(cut, weight, left)
            # What is known of an example of any other block is below the kth best.
            enough = len(found) == k
            found = self._best(whole, np.flatnonzero(whole >= found[-1][1] - SLACK) if enough else self._of_blocks(chosen | left), k, but)
        return found

    def _of_lists(self, cut: np.ndarray, weight: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """What the cut lists add to the examples of some blocks. Blocks next to each other are one range of a list."""
        edges = np.flatnonzero(np.diff(np.concatenate([[False], blocks, [False]])))
        starts = self.begins[cut][:, edges[::2]]
        sizes = self.begins[cut][:, edges[1::2]] - starts
        return self._listed(starts.ravel(), sizes.ravel(), np.repeat(weight, len(edges) // 2))

    def _of_blocks(self, blocks: np.ndarray) -> np.ndarray:
        found = (np.flatnonzero(blocks)[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        return found[found < self.size]

    def overlaps(self, terms: np.ndarray) -> np.ndarray:
        """Sum of the weights that each example has for these terms."""
        column, starts, row = self.column[terms], self.ends[terms], np.zeros(self.table.shape[1])
        row[column[column >= 0]] = 1.0
        listed = self._listed(starts, self.ends[terms + 1] - starts, np.ones(len(terms)))
        return (listed + (self.table @ row)[:self.size])[self.place]

    def _listed(self, starts: np.ndarray, sizes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What ranges of the lists add to each example, with the query's weight for each range."""
        at = _ranges(starts, sizes)
        return np.bincount(self.examples[at], np.repeat(weight, sizes) * self.weights[at], self.size)

    def _best(self, cosine: np.ndarray, among: np.ndarray, k: int, but: int) -> list[tuple[int, float]]:
        """The k highest cosines above 0 among some examples, whose cosines are whole. They are ranked rounded, so that ties do
        not depend on the order of additions."""
        mine = np.round(cosine[among], 12)
        if but >= 0:
            mine = np.where(among == self.place[but], 0.0, mine)
        least = np.partition(mine, len(mine) - k)[len(mine) - k] if len(mine) > k else 0.0
        best = np.flatnonzero((mine >= least) & (mine > 0))
        found = among[best]
        found = found[np.lexsort((self.origin[found], -mine[best]))[:k]]
        return [(int(self.origin[i]), float(cosine[i])) for i in found]
