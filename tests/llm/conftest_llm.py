"""Brute-force helpers of the tests in this folder."""

from __future__ import annotations

import numpy as np

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def brute_components(ids: list[int], near: np.ndarray) -> dict[int, int]:
    """The smallest id that each id can reach."""
    seen: dict[int, int] = {}
    place = {x: k for k, x in enumerate(ids)}
    for x in sorted(ids):
        if x in seen:
            continue
        todo = [place[x]]
        seen[x] = x
        while todo:
            for k in np.flatnonzero(near[todo.pop()]):
                if ids[k] not in seen:
                    seen[ids[k]] = x
                    todo.append(int(k))
    return seen
