"""Best-fit packing of lengths into bins, with a segment tree over free space."""

from __future__ import annotations

from collections import defaultdict
from itertools import accumulate


class FreeSpace:
    """Open bins by free space. A segment tree over the spaces 0..capacity, whose nodes
    count the bins below them, finds the tightest bin for a length in log(capacity)."""

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, capacity.bit_length())
        self.count = [0] * (2 * self.leaves)
        self.bins: dict[int, list[int]] = defaultdict(list)

    def _add(self, space: int, change: int) -> None:
        node = space + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, space: int, bin_: int) -> None:
        if space > 0:
            self.bins[space].append(bin_)
            self._add(space, 1)

    def tightest(self, length: int) -> int | None:
        """The least space of at least ``length`` in which a bin is open."""
        node = length + self.leaves
        if self.count[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, space: int) -> int:
        self._add(space, -1)
        return self.bins[space].pop()


def split_lengths(length: int, capacity: int) -> list[int]:
    """Whole capacities and the rest: the pieces add up to the length."""
    whole, rest = divmod(length, capacity)
    return [capacity] * whole + ([rest] if rest else [])


def pack(
    lengths: list[int], capacities: list[int], bin_cost: int = 0, square: float = float("inf")
) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing into bins of several permitted capacities.

    Returns each length's bin, its offset there, and each bin's capacity. Lengths must be
    between 1 and the largest capacity; longer ones are split beforehand.

    Longest first, a length goes into the open bin with the least space that holds it. If
    there is none, the bin is opened whose cost per filled unit is the least. A bin of
    capacity c costs c + c * c / ``square`` + ``bin_cost``. It is filled by the length itself
    and by what is left of the lengths to come that fit beside it, once the bins that are
    open have had their part. At the end each bin is cut down to the smallest permitted
    capacity that holds its contents.
    """
    sizes = sorted(set(capacities))
    cost = {c: c + c * c / square + bin_cost for c in sizes}
    upto = [0] * (sizes[-1] + 1)
    for length in lengths:
        upto[length] += length
    upto = list(accumulate(upto))
    open_space = 0
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    ahead = sum(lengths)
    space = FreeSpace(sizes[-1])
    bin_of, offset_of = [0] * len(lengths), [0] * len(lengths)
    used = []
    for i in order:
        length = lengths[i]
        at = space.tightest(length)
        if at is None:
            capacity, least = 0, 0.0
            for c in sizes:
                if c >= length:
                    beside = c - length
                    # Only lengths up to this one are still to come.
                    coming = (ahead - length if beside >= length else upto[beside]) - open_space
                    unit = cost[c] / (length + min(beside, max(0, coming)))
                    if not capacity or unit < least:
                        capacity, least = c, unit
            used.append(0)
            chosen, at = len(used) - 1, capacity
            open_space += capacity
        else:
            chosen = space.take(at)
        bin_of[i], offset_of[i] = chosen, used[chosen]
        used[chosen] += length
        space.put(at - length, chosen)
        ahead -= length
        open_space -= length
    final = [next(c for c in sizes if c >= u) for u in used]
    return bin_of, offset_of, final
