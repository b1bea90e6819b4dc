"""Sorted runs of suffixes, front-coded, merged by a loser tree that knows prefixes.

A run holds strings in order, each as the length of the prefix it shares with the one
before and the rest. The tree keeps for each run's current string the prefix it
shares with the last string given out. Of two strings the one that shares more comes
first, without looking at them; only when they share equally much are they compared,
from there on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, ``known`` bytes of it being known."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while low + 1 < high:  # a[:low] equal, a[:high] not
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(strings: Iterable[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared lengths and rests of strings in order."""
    shared, rests, last = [], [], b""
    for s in strings:
        n = shared_prefix(last, s)
        shared.append(n)
        rests.append(s[n:])
        last = s
    return shared, rests


def merged(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """All strings in order: (run, place in it, string, prefix shared with the one
    before)."""
    k = len(runs)
    size = 1 << max(0, (k - 1).bit_length())
    place, text, share = [0] * size, [None] * size, [0] * size
    for r, (_, rests) in enumerate(runs):
        text[r] = rests[0] if rests else None

    def first(i: int, j: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        if text[i] is None or text[j] is None:
            return (j, i) if text[i] is None else (i, j)
        if share[i] != share[j]:
            return (i, j) if share[i] > share[j] else (j, i)
        n = shared_prefix(text[i], text[j], share[i])
        if text[i][n : n + 1] <= text[j][n : n + 1]:
            share[j] = n
            return i, j
        share[i] = n
        return j, i

    losers, level = [0] * size, list(range(size))
    at = size
    while len(level) > 1:
        at //= 2
        pairs = [first(level[2 * i], level[2 * i + 1]) for i in range(at)]
        losers[at : 2 * at] = [loser for _, loser in pairs]
        level = [winner for winner, _ in pairs]
    best = level[0]
    while k and text[best] is not None:
        yield best, place[best], text[best], share[best]
        shared, rests = runs[best]
        place[best] += 1
        if place[best] < len(rests):
            share[best] = shared[place[best]]
            text[best] = text[best][: share[best]] + rests[place[best]]
        else:
            text[best] = None
        node = (best + size) // 2
        while node:
            best, losers[node] = first(best, losers[node])
            node //= 2
