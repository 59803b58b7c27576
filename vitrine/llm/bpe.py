"""Merging symbols by priority, as byte-pair encoders do: the best-ranked neighbours first, the leftmost of equals."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence


def merge(symbols: Sequence[str], rank: Callable[[str, str], float | None]) -> list[str]:
    """What is left of `symbols` when no neighbours have a rank any more; the lowest rank merges first."""
    parts: list[str | None] = list(symbols)
    n = len(parts)
    if n < 2:
        return parts
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        r = rank(parts[i], parts[i + 1])
        if r is not None:
            heap.append((r, i, parts[i], parts[i + 1]))
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            r = rank(parts[i], parts[k])
            if r is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[k]))
        h = left[i]
        if h >= 0:
            r = rank(parts[h], parts[i])
            if r is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
    return [p for p in parts if p is not None]
