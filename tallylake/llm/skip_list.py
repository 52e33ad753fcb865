"""Sequences of units indexed by accumulated widths.

A lane is a row of links. The lowest lane has one link per unit, and every lane above, an express
lane, one link per ``STEP`` links of the lane below. A link carries two widths: the units it passes
and the code points it passes. A search starts in the top lane, takes links while their accumulated units
stay within the rank, goes down a lane where the next link would pass it, and so meets at most
``STEP`` links a lane. Which units carry an express link follows from their rank alone, so a task
that runs again builds the same lanes.
"""

from __future__ import annotations

import re

import numpy as np

STEP = 16


def unit_widths(text: str, unit: re.Pattern | None = None) -> np.ndarray:
    """Code points of each unit of ``text``, in order; by default every code point is a unit.

    Units are the non-empty matches of ``unit`` from left to right. What lies before a match belongs to
    that match's unit and what follows the last one to the last unit, so the units tile the text;
    a text without a match is one unit.
    """
    if not text:
        return np.zeros(0, np.uint8)
    if unit is None:
        return np.ones(len(text), np.uint8)
    ends = [m.end() for m in unit.finditer(text) if m.end() > m.start()]
    if not ends:
        ends = [len(text)]
    ends[-1] = len(text)
    widths = np.diff(np.array([0, *ends], np.int64))
    return widths.astype(np.min_scalar_type(int(widths.max())))


class SkipList:
    """Lanes over the units of one text."""

    def __init__(self, widths: np.ndarray):
        self.units = len(widths)
        # lanes from the lowest: (units, code points) of each link
        self.lanes: list[tuple[np.ndarray | None, np.ndarray]] = [(None, widths)]
        while len(self.lanes[-1][1]) > STEP:
            below, points = self.lanes[-1]
            starts = np.arange(0, len(points), STEP)
            if below is None:
                passed = np.full(len(starts), STEP, np.int64)
                passed[-1] = len(points) - starts[-1]
            else:
                passed = np.add.reduceat(below, starts)
            self.lanes.append((passed, np.add.reduceat(points, starts, dtype=np.int64)))

    def code_points(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        if not 0 <= rank <= self.units:
            raise IndexError(f"rank {rank} of {self.units} units")
        units_passed = points_passed = at = 0
        for units, points in reversed(self.lanes):
            while at < len(points):
                width = 1 if units is None else int(units[at])
                if units_passed + width > rank:
                    break
                units_passed += width
                points_passed += int(points[at])
                at += 1
            at *= STEP
        return points_passed
