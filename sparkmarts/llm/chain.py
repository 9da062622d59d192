"""Scaled forward-backward recursion over many sequences at once.

The sequences of a batch are laid out step by step (longest first), so that
each step of the recursion is one array operation over all sequences that are
still running. Used by the hidden Markov model and by the random field."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


@dataclass
class Layout:
    """Places of the items of concatenated sequences in step-major order."""

    slot: np.ndarray  # item -> place
    running: np.ndarray  # sequences still running at each step
    offset: np.ndarray  # first place of each step
    order: np.ndarray  # sequences, longest first
    begin: np.ndarray  # first item of each sequence


def layout(lens: np.ndarray) -> Layout:
    """Every sequence has one item at least."""
    lens = np.asarray(lens, dtype=np.int64)
    order = np.argsort(-lens, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    steps = int(lens.max()) if len(lens) else 0
    running = len(lens) - np.searchsorted(np.sort(lens), np.arange(steps), side="right")
    offset = np.concatenate([[0], np.cumsum(running)])
    starts = np.cumsum(lens) - lens
    step = np.arange(int(lens.sum())) - np.repeat(starts, lens)
    return Layout(offset[step] + np.repeat(rank, lens), running, offset, order, starts)


#: steps between two scalings; a step's factors are far above 1e-18, so that
#: neither vector can leave the range of doubles in between
STRIDE = 16
#: places whose emissions are fetched together
PIECE = 1 << 13


class Pass:
    """Scaled forward and backward recursion over the sequences of a layout.

    ``emit(a, b)`` gives a new states x items matrix for the places a to b, best
    with an item's states side by side, as in ``flat`` (places x states).
    A sequence's vector is scaled to sum 1 at every ``STRIDE``-th step and at
    its end; the same factors scale the backward vectors, so that the
    product of both is a distribution at every step."""

    def __init__(self, emit: Callable[[int, int], np.ndarray], lay: Layout, start: np.ndarray, trans: np.ndarray, keep: bool):
        self.emit, self.lay, self.trans, self.states = emit, lay, trans, len(start)
        offset, running = lay.offset.tolist(), [*lay.running.tolist(), 0]
        # forward vectors, overwritten by the state marginals in backward()
        self.flat = flat = np.empty((offset[-1], self.states)) if keep else None
        ones, total = np.ones(self.states), np.zeros(len(lay.order))
        ends = np.empty((len(total), self.states))
        places, factors = [], []
        before = None
        for first, last in self._pieces():
            emitted, since = emit(offset[first], offset[last]).T, offset[first]
            for t in range(first, last):
                k, a, b = running[t], offset[t], offset[t + 1]
                e = emitted[a - since : b - since]
                now = flat[a:b] if keep else np.empty((k, self.states))
                if before is None:
                    np.multiply(e, start, out=now)
                else:
                    np.matmul(before[:k], trans, out=now)
                    now *= e
                if t % STRIDE == STRIDE - 1:
                    scale = now @ ones
                    factor = 1.0 / scale
                    now *= factor[:, None]
                    total[:k] += np.log(scale)
                    if keep:
                        places.append(np.arange(a, b))
                        factors.append(factor)
                if running[t + 1] < k:
                    ends[running[t + 1] : k] = now[running[t + 1] :]
                before = now
        scale = ends @ ones
        total += np.log(scale)
        if keep:
            at = lay.slot[np.append(lay.begin[1:], len(lay.slot))[lay.order] - 1]
            flat[at] /= scale[:, None]
            # a place may have two factors: of its step, then of its end
            factor = np.ones(offset[-1])
            for p, f in zip(places, factors, strict=True):
                factor[p] = f
            factor[at] /= scale
            self._scaled = np.unique(np.concatenate([*places, at]))
            self._factors = factor[self._scaled]
        #: log-likelihood of each sequence
        self.logs = np.empty_like(total)
        self.logs[lay.order] = total

    def _pieces(self) -> list[tuple[int, int]]:
        """Runs of steps with about ``PIECE`` places, one step at least."""
        piece = self.lay.offset[:-1] // PIECE
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
        return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

    def block(self, t: int) -> np.ndarray:
        """States x running sequences of a step."""
        return self.flat[self.lay.offset[t] : self.lay.offset[t + 1]].T

    def backward(self) -> np.ndarray:
        """The summed pair marginals; afterwards ``flat`` holds the state marginals."""
        pairs = np.zeros((self.states, self.states))
        offset, running = self.lay.offset.tolist(), self.lay.running.tolist()
        back = np.ascontiguousarray(self.trans.T)
        beta, later = None, 0
        for first, last in reversed(self._pieces()):
            since = offset[first]
            emitted = self.emit(since, offset[last]).T
            i, j = np.searchsorted(self._scaled, [since, offset[last]])
            emitted[self._scaled[i:j] - since] *= self._factors[i:j, None]
            betas, end = np.empty((len(emitted), self.states)), offset[last]
            for t in range(last - 1, max(first, 1) - 1, -1):
                k, a = running[t], offset[t]
                right = emitted[a - since : a - since + k]
                if later:
                    right[:later] *= beta
                beta, later = np.matmul(right, back, out=betas[a - since : a - since + k]), k
                # steps of as many sequences lie one after the other, and so do the steps before them
                same = running[t - 1] == k
                if same and t > max(first, 1):
                    continue
                for b, e, before in ((a, end, a - k),) if same else ((a, a + k, offset[t - 1]), (a + k, end, a)):
                    left, right = self.flat[before : before + e - b], emitted[b - since : e - since]
                    pairs += left.T @ right
                    left *= betas[b - since : e - since]
                end = a
        return pairs * self.trans

    def marginals(self) -> np.ndarray:
        """States x items, in the items' own order."""
        return self.flat[self.lay.slot].T

    def by_symbol(self, symbols: np.ndarray, n: int, piece: int = 250_000) -> np.ndarray:
        """Marginals summed per symbol (n x states); ``symbols`` by place."""
        # one state after the other: its sums of all symbols stay in the cache
        out, rows = np.zeros((self.states, n)), np.empty((self.states, min(piece, len(symbols))))
        for a in range(0, len(symbols), piece):
            some = symbols[a : a + piece]
            for b in range(0, len(some), PIECE):
                part = self.flat[a + b : a + min(b + PIECE, len(some))]
                rows[:, b : b + len(part)] = part.T
            for sums, row in zip(out, rows, strict=True):
                sums += np.bincount(some, row[: len(some)], n)
        return out.T
