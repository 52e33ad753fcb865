"""Sorted posting lists and galloping merges over them.

A list holds distinct ids in rising order. A merge looks at the heads of its lists only; from the
smallest head it gallops (steps of 1, 2, 4, ... and a binary search in the last step) to the next
head of another list and takes the run up to there as a whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

Ids = Sequence[int]


def gallop(ids: Ids, low: int, target: int) -> int:
    """The first position from ``low`` on whose id is not below ``target``."""
    size = len(ids)
    if low >= size or ids[low] >= target:
        return low
    step = 1
    while low + step < size and ids[low + step] < target:
        step *= 2
    return bisect_left(ids, target, low + step // 2, min(low + step, size))


def union(lists: Sequence[Ids]) -> list[int]:
    """The ids of any of ``lists``: a k-way merge that copies runs."""
    open_ = [ids for ids in lists if len(ids)]
    at = [0] * len(open_)
    out: list[int] = []
    while len(open_) > 1:
        heads = [ids[k] for ids, k in zip(open_, at)]
        smallest = min(heads)
        first = heads.index(smallest)
        limit = min(h for k, h in enumerate(heads) if k != first)
        if limit > smallest:
            end = gallop(open_[first], at[first], limit)
            out += open_[first][at[first] : end]
            at[first] = end
        else:  # several lists have the id
            out.append(smallest)
            for k, head in enumerate(heads):
                at[k] += head == smallest
        if any(k == len(ids) for ids, k in zip(open_, at)):
            left = [(ids, k) for ids, k in zip(open_, at) if k < len(ids)]
            open_, at = [ids for ids, _ in left], [k for _, k in left]
    if open_:
        out += open_[0][at[0] :]
    return out


def difference(ids: Ids, without: Ids) -> list[int]:
    """The ids that ``without`` doesn't hold; runs between two of its ids are copied."""
    out: list[int] = []
    at = other = 0
    size, others = len(ids), len(without)
    while at < size and other < others:
        if ids[at] < without[other]:
            end = gallop(ids, at, without[other])
            out += ids[at:end]
            at = end
        elif ids[at] > without[other]:
            other = gallop(without, other, ids[at])
        else:
            at += 1
            other += 1
    out += ids[at:]
    return out


def common(ids: Ids, others: Ids) -> int:
    """How many ids both lists hold."""
    at = other = found = 0
    size, end = len(ids), len(others)
    while at < size and other < end:
        if ids[at] < others[other]:
            at = gallop(ids, at, others[other])
        elif ids[at] > others[other]:
            other = gallop(others, other, ids[at])
        else:
            found += 1
            at += 1
            other += 1
    return found
