"""Sorted terms as a minimal acyclic transducer that maps a term to its place among them.

States with the same continuations are one state, so shared endings are stored once.
An arc puts out how many terms come before those behind it; the sum along a term's
path is its ordinal. Many terms are looked up at a time: all of them advance by one
byte per step through a table of arcs.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np


@dataclass(frozen=True)
class Transducer:
    """Arcs in four columns; states are numbered, the root last."""

    states: int
    longest: int
    final: np.ndarray
    source: np.ndarray
    label: np.ndarray
    target: np.ndarray
    output: np.ndarray

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Class of each byte, then next state and output by state and class; one more state takes all that fails."""
        used = np.unique(self.label)
        classes = np.full(256, len(used), np.int64)
        classes[used] = np.arange(len(used))
        width, sink = len(used) + 1, self.states
        follow = np.full((self.states + 1) * width, sink, np.int32)
        output = np.zeros((self.states + 1) * width, np.int32)
        cell = self.source.astype(np.int64) * width + classes[self.label]
        follow[cell], output[cell] = self.target, self.output
        return classes, follow, output, width

    def table_bytes(self) -> int:
        return (self.states + 1) * (len(np.unique(self.label)) + 1) * 8

    def ordinals(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ordinal of each term ``data[start:start + size]``, -1 where it is not among the terms."""
        classes, follow, output, width = self.table
        found = np.full(len(starts), -1, np.int64)
        order = np.flatnonzero(sizes <= self.longest)
        order = order[np.argsort(-sizes[order], kind="stable")]
        at, left = starts[order], sizes[order]
        state = np.full(len(order), self.states - 1, np.int64)
        total = np.zeros(len(order), np.int64)
        for step in range(int(left[0]) if len(left) else 0):
            open_ = len(left) - np.searchsorted(left[::-1], step, side="right")
            cell = state[:open_] * width + classes[data[at[:open_] + step]]
            total[:open_] += output[cell]
            state[:open_] = follow[cell]
        accepted = np.append(self.final, False)[state]
        found[order[accepted]] = total[accepted]
        return found


def build(terms: Iterable[bytes]) -> Transducer:
    """From distinct terms in ascending order of their bytes."""
    known: dict[tuple, int] = {}
    final: list[bool] = []
    behind: list[int] = []  # terms that end in or behind a state
    arcs: tuple[list, list, list, list] = ([], [], [], [])

    def settle(ends: bool, out: list[tuple[int, int]]) -> int:
        """Number of the state with these continuations, a new one if there is none."""
        same = (ends, tuple(out))
        if same in known:
            return known[same]
        number = known[same] = len(final)
        before = int(ends)
        for label, target in out:
            for column, value in zip(arcs, (number, label, target, before)):
                column.append(value)
            before += behind[target]
        final.append(ends)
        behind.append(before)
        return number

    # The path of the last term: whether a term ends there, and the settled arcs of each state on it.
    path: list[list] = [[False, []]]
    last, longest = b"", 0

    def settle_below(depth: int) -> None:
        while len(path) > depth + 1:
            ends, out = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(ends, out)))

    for term in terms:
        shared = 0
        while shared < min(len(term), len(last)) and term[shared] == last[shared]:
            shared += 1
        if last and shared == len(term) or (last and term < last):
            raise ValueError("terms must be distinct and ascending")
        settle_below(shared)
        path.extend([False, []] for _ in range(len(term) - shared))
        path[-1][0] = True
        last, longest = term, max(longest, len(term))
    settle_below(0)
    # The root is never shared: no other state leads to all terms.
    settle(*path[0])
    source, label, target, output = arcs
    return Transducer(
        len(final),
        longest,
        np.array(final, bool),
        np.array(source, np.int32),
        np.array(label, np.uint8),
        np.array(target, np.int32),
        np.array(output, np.int32),
    )
