"""Run-length index: a run-compressed Burrows-Wheeler transform of a set of strings.

The suffix array is built by prefix doubling. Only the runs of equal letters of the transform
are kept, with the suffix at the end of each run as a sample and the row that the first letter
of the run leads to. Rows whose suffixes agree in ``depth`` letters form intervals. A string is
streamed through the index from its end: the step to the letter before is one search among
the runs, and at each place the interval tells whether, and how early, the next ``depth``
letters occur elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Letters packed into the first ranks, nine bits each: a byte or the end of a string.
PACKED = 7
# Rows between two entries of the directory of runs.
STEP = 4


@dataclass(frozen=True)
class RunIndex:
    """The index and what is known of each interval of rows.

    ``run_start``, ``run_to`` and ``run_end`` hold per run its first row, the row that one
    leads to, and the sampled suffix of its last row; ``run_at`` has the run of every
    ``STEP``-th row. ``interval`` gives the interval of a
    row, -1 where fewer than ``depth`` letters are left; ``best`` the least weight in it and
    ``members`` how many suffixes it has.
    """

    run_start: np.ndarray
    run_at: np.ndarray
    run_to: np.ndarray
    run_end: np.ndarray
    interval: np.ndarray
    best: np.ndarray
    members: np.ndarray


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the place where the equals of each begin."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return order, rank


def _split_ends(rank: np.ndarray, owner: np.ndarray, short: np.ndarray) -> None:
    """Each end of a string is a letter of its own, smaller than all others, in the order of
    the strings: suffixes that end within the letters compared so far get ranks of their own."""
    order = short[np.argsort(rank[short] << 32 | owner[short])]
    ranks = rank[order]
    new = np.r_[True, ranks[1:] != ranks[:-1]]
    at = np.arange(len(order))
    rank[order] = ranks + at - np.maximum.accumulate(np.where(new, at, 0))


def build(body: np.ndarray, lengths: np.ndarray, weights: np.ndarray, depth: int) -> RunIndex:
    """Index of strings that lie one behind the other in ``body``, with a weight each."""
    if depth < PACKED:
        raise ValueError(f"depth must be {PACKED} or more")
    count = len(lengths)
    size = len(body) + count
    owner = np.repeat(np.arange(count), lengths + 1)
    last = np.cumsum(lengths + 1) - 1
    letters = np.zeros(size, np.int64)
    inner = np.ones(size, bool)
    inner[last] = False
    letters[inner] = body.astype(np.int64) + 1
    rest = last[owner] - np.arange(size)
    padded = np.r_[letters, np.zeros(PACKED, np.int64)]
    key = np.zeros(size, np.int64)
    for n in range(PACKED):
        key = key << 9 | padded[n : n + size]
    # What lies behind the end of a string does not count.
    beyond = 9 * np.maximum(PACKED - 1 - rest, 0)
    order, rank = _ranks(key >> beyond << beyond)
    _split_ends(rank, owner, np.flatnonzero(rest < PACKED))
    covered = PACKED
    longest = int(rest.max())
    at_depth = None
    while covered <= longest:
        if at_depth is None and covered * 2 > depth:
            ahead = np.minimum(np.arange(size) + depth - covered, size - 1)
            at_depth = rank, rank[ahead]
        ahead = np.minimum(np.arange(size) + covered, size - 1)
        second = np.where(rest < covered, owner, rank[ahead])
        order, rank = _ranks(rank << 32 | second)
        covered *= 2
    if at_depth is None:
        raise ValueError(f"strings are too short for a depth of {depth}")
    before = np.where(np.r_[True, ~inner[:-1]], 0, np.r_[0, letters[:-1]])
    transform = before[order]
    start = np.flatnonzero(np.r_[True, transform[1:] != transform[:-1]])
    runs = np.diff(np.r_[start, size])
    letter = transform[start]
    by_letter = np.argsort(letter, kind="stable")
    to = np.empty(len(start), np.int64)
    to[by_letter] = np.r_[0, np.cumsum(runs[by_letter])[:-1]]
    sampled = order[start + runs - 1]
    enough = rest[order] >= depth
    first, second = at_depth[0][order], at_depth[1][order]
    new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])] | ~enough
    new |= np.r_[False, ~enough[:-1]]
    interval = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    best = np.minimum.reduceat(weights[owner[order]], begins)
    members = np.diff(np.r_[begins, size])
    run_at = np.searchsorted(start, np.arange(0, size, STEP), side="right") - 1
    # Half as wide, a walk reads half as much memory.
    narrow = (x.astype(np.int32) for x in (np.r_[start, size], run_at, to, sampled, np.where(enough, interval, -1)))
    return RunIndex(*narrow, best, members)


def stream(index: RunIndex, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the indexed strings, in order: least weight of the strings that have
    the next ``depth`` letters too, and how often these occur; 0 occurrences where the string
    ends before.

    The longest strings come first among those that walk, so each step is one slice.
    """
    by_length = np.argsort(-lengths, kind="stable")
    begin = np.cumsum(lengths) - lengths
    best = np.zeros(int(lengths.sum()), np.int64)
    count = np.zeros(len(best), np.int64)
    rows = by_length.astype(np.int32)  # the end of string n is the suffix of rank n
    ordered = lengths[by_length]
    for back in range(1, int(lengths.max(initial=0)) + 1):
        walking = int(np.searchsorted(-ordered, -back, side="right"))
        rows = rows[:walking]
        run = np.take(index.run_at, rows // STEP)
        while (behind := np.take(index.run_start, run + 1) <= rows).any():
            run += behind
        rows = np.take(index.run_to, run) + rows - np.take(index.run_start, run)
        place = begin[by_length[:walking]] + ordered[:walking] - back
        interval = np.take(index.interval, rows)
        best[place] = np.take(index.best, interval)
        count[place] = np.where(interval >= 0, np.take(index.members, interval), 0)
    return best, count
