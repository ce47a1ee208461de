"""Context-tree weighting over bytes.

The next byte is predicted in the contexts of the last 0, 1, ... ``DEPTH`` bytes. In each
context the byte is decomposed into 8 binary decisions with a Krichevsky-Trofimov estimate
per node. The weighted probability of a context is half its own estimate and half that of
its longer contexts, and the prediction mixes all depths by these weights. A text begins
after ``DEPTH`` end bytes and is closed by one (0xFF, which UTF-8 never holds).

A gram is a context, nearest byte first, with the byte that follows, as one number. Counts
come from all training texts. Levels can be weighted and mixed in parts (``weigh``, ``mixed``),
as ``lm_scores.score`` does with the whole counts. ``Model`` holds all its levels in memory; for
it ``lm_scores.fit`` leaves out rare contexts, down to ``MAX_ENTRIES`` grams per depth, and what
they saw counts at their parent's rate.
"""

from __future__ import annotations

import numpy as np

DEPTH = 5
MAX_ENTRIES = 1 << 22
END = b"\xff"


def grams(data: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The gram that ends at each byte from position ``depth`` on."""
    n = len(data) - depth
    wide = data.astype(np.uint64)
    out = wide[depth:].copy()
    for j in range(1, depth + 1):
        out |= wide[depth - j : depth - j + n] << np.uint64(8 * (depth - j + 1))
    return out


def shorter(found: np.ndarray, depth: int, to: int) -> np.ndarray:
    """Grams of a lower depth: the farthest bytes of the context are dropped."""
    context = found >> np.uint64(8 * (depth - to + 1))
    return (context << np.uint64(8)) | (found & np.uint64(255))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their total counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys))).astype(np.int64)


def context_counts(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each sorted gram, the count of its context."""
    context = keys >> np.uint64(8)
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    return np.repeat(np.add.reduceat(counts, first), sizes) if len(keys) else counts


_TABLE = 1 << 16


def _log_gamma_table() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(_TABLE)
    half = np.concatenate([[0.0], np.cumsum(np.log(n[:-1] + 0.5))])
    whole = np.concatenate([[0.0], np.cumsum(np.log(n[1:].astype(float)))])
    return half, whole


_HALF, _WHOLE = _log_gamma_table()


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _log_half(n: np.ndarray) -> np.ndarray:
    """log of gamma(n + 1/2) / gamma(1/2)."""
    big = _stirling(np.maximum(n, _TABLE) + 0.5) - 0.5 * np.log(np.pi)
    return np.where(n < _TABLE, _HALF[np.minimum(n, _TABLE - 1)], big)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    big = _stirling(np.maximum(n, _TABLE) + 1.0)
    return np.where(n < _TABLE, _WHOLE[np.minimum(n, _TABLE - 1)], big)


class Level:
    """One depth: its contexts with their weights, and its grams with their estimates."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys = keys
        self.before = np.concatenate([[0], np.cumsum(counts)])
        context = keys >> np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.contexts = context[first]
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        self.totals = np.bincount(owner, weights=counts, minlength=len(first))
        self.log_own = np.zeros(len(first))
        self.log_estimate = np.zeros(len(keys))
        node_total = self.totals[owner]
        for bit in range(7, -1, -1):
            child = keys >> np.uint64(bit)
            start = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]])) if len(keys) else np.zeros(0, np.int64)
            totals = np.add.reduceat(counts, start) if len(keys) else counts
            self.log_own += np.bincount(owner[start], weights=_log_half(totals), minlength=len(first))
            parent = child[start] >> np.uint64(1)
            above = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(keys) else start
            if len(keys):
                sums = np.add.reduceat(totals, above)
                self.log_own -= np.bincount(owner[start[above]], weights=_log_factorial(sums), minlength=len(first))
            each = np.repeat(totals, np.diff(np.append(start, len(keys))))
            self.log_estimate += np.log((each + 0.5) / (node_total + 1.0))
            node_total = each
        self.stop = np.ones(len(first))

    def find(self, contexts: np.ndarray) -> np.ndarray:
        """Place of each context, or -1."""
        if not len(self.contexts):
            return np.full(len(contexts), -1)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        return np.where(self.contexts[at] == contexts, at, -1)

    def estimate(self, found: np.ndarray) -> np.ndarray:
        """Estimate of any gram whose context is known, also of bytes it never saw."""
        base = (found >> np.uint64(8)) << np.uint64(8)
        symbol = found & np.uint64(255)
        low, high = base, base + np.uint64(255)
        node = self._between(low, high)
        p = np.ones(len(found))
        for bit in range(7, -1, -1):
            low = base + ((symbol >> np.uint64(bit)) << np.uint64(bit))
            high = low + np.uint64((1 << bit) - 1)
            child = self._between(low, high)
            p *= (child + 0.5) / (node + 1.0)
            node = child
        return p

    def _between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.before[np.searchsorted(self.keys, high, side="right")] - self.before[np.searchsorted(self.keys, low)]


def weigh(levels: list[Level], log_weighted: np.ndarray) -> np.ndarray:
    """Set the weights of consecutive whole levels above the last one; the log of the first one's weighted probabilities."""
    for level, longer in zip(levels[-2::-1], levels[:0:-1]):
        at = level.find(longer.contexts >> np.uint64(8))
        split = np.bincount(at, weights=log_weighted, minlength=len(level.contexts)) if len(at) else np.zeros(0)
        log_weighted = np.logaddexp(level.log_own, split) - np.log(2)
        level.stop = np.exp(level.log_own - np.log(2) - log_weighted)
    return log_weighted


def mixed(levels: list[Level], lowest: int, found: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Probability of full grams: the depths of some levels from ``lowest`` on, mixed over that of all deeper ones."""
    p = deeper.copy()
    for depth in range(lowest + len(levels) - 1, lowest - 1, -1):
        level = levels[depth - lowest]
        own = shorter(found, DEPTH, depth)
        at = level.find(own >> np.uint64(8))
        here = np.flatnonzero(at >= 0)
        if not len(here):
            continue
        own, stop = own[here], level.stop[at[here]]
        place = np.minimum(np.searchsorted(level.keys, own), len(level.keys) - 1)
        seen = level.keys[place] == own
        estimate = np.exp(level.log_estimate[place])
        estimate[~seen] = level.estimate(own[~seen])
        p[here] = stop * estimate + (1 - stop) * p[here]
    return p


class Model:
    """Levels from depth 0 to the deepest, weighted bottom-up."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.depth = len(tables) - 1
        self.levels = [Level(keys, counts) for keys, counts in tables]
        log_weighted = self.levels[-1].log_own
        for depth in range(self.depth - 1, -1, -1):
            level, longer = self.levels[depth], self.levels[depth + 1]
            at = level.find(longer.contexts >> np.uint64(8))
            split = np.bincount(at, weights=log_weighted, minlength=len(level.contexts)) if len(at) else np.zeros(len(level.contexts))
            covered = np.bincount(at, weights=longer.totals, minlength=len(level.contexts)) if len(at) else np.zeros(len(level.contexts))
            split += level.log_own * (1 - covered / level.totals)
            log_weighted = np.logaddexp(level.log_own, split) - np.log(2)
            level.stop = np.exp(level.log_own - np.log(2) - log_weighted)
        deepest = self.levels[-1]
        self.known = np.log10(self._mixed(deepest.keys)) if len(deepest.keys) else np.zeros(0)

    def _mixed(self, found: np.ndarray) -> np.ndarray:
        p = np.full(len(found), 1 / 256)
        for depth in range(self.depth, -1, -1):
            level = self.levels[depth]
            own = shorter(found, self.depth, depth)
            at = level.find(own >> np.uint64(8))
            here = np.flatnonzero(at >= 0)
            stop = level.stop[at[here]]
            p[here] = stop * level.estimate(own[here]) + (1 - stop) * p[here]
        return p

    def log10(self, found: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each gram after its context."""
        deepest, out = self.levels[-1], np.empty(len(found))
        if len(deepest.keys):
            at = np.minimum(np.searchsorted(deepest.keys, found), len(deepest.keys) - 1)
            seen = deepest.keys[at] == found
            out[seen] = self.known[at[seen]]
        else:
            seen = np.zeros(len(found), bool)
        if not seen.all():
            new, back = np.unique(found[~seen], return_inverse=True)
            out[~seen] = np.log10(self._mixed(new))[back]
        return out


def text_bytes(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Texts with end bytes around them as one array, and the first gram of each text."""
    data = np.frombuffer(END * depth + b"".join(t + END * depth for t in texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    return data, np.cumsum(sizes + depth) - sizes - depth


def text_grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The grams of some texts, each closed by one end byte, and how many each text has."""
    data, first = text_bytes(texts, depth)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return grams(data, depth)[np.repeat(first, sizes) + within], sizes
