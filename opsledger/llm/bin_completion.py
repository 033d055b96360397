"""Bin completion branch-and-bound on a histogram of item sizes.

Sizes are whole numbers up to the capacity, so any number of items is a table of at most
``capacity`` counts, and a solution is a list of fillings with how often each is used.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

Filling = tuple[tuple[int, int], ...]  # (size, how many), larger sizes first


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, many equal bins at a time."""
    open_bins: dict[int, list[list]] = {}  # room left -> [[filling, bins], ...]
    rooms: list[int] = []  # sorted
    def put(room: int, filling: Filling, bins: int) -> None:
        if bins:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append([filling, bins])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                whole, rest = divmod(left, each)
                put(capacity - each * size, ((size, each),), whole)
                if rest:
                    put(capacity - rest * size, ((size, rest),), 1)
                break
            room = rooms[at]
            filling, bins = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            each = room // size
            full = min(bins, left // each)
            put(room - each * size, (*filling, (size, each)), full)
            left -= full * each
            if full < bins and left < each:
                if left:
                    put(room - left * size, (*filling, (size, left)), 1)
                put(room, filling, bins - full - (left > 0))
                left = 0
    return [(filling, bins) for group in open_bins.values() for filling, bins in group]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Largest of the volume bound and the bounds that ignore sizes below each cut."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    large = [(s, n) for s, n in counts.items() if 2 * s > capacity]
    for cut in {0, *(s for s in counts if 2 * s <= capacity)}:
        huge = sum(n for s, n in large if s > capacity - cut)
        half = sum(n for s, n in large if s <= capacity - cut)
        room = half * capacity - sum(s * n for s, n in large if s <= capacity - cut)
        rest = sum(s * n for s, n in counts.items() if cut <= s and 2 * s <= capacity)
        best = max(best, huge + half + max(0, -(-(rest - room) // capacity)))
    return best


def _packs_into(parts: list[int], rooms: list[int]) -> bool:
    """Whether the parts fit into the rooms (both short lists, larger first)."""
    if not parts:
        return True
    tried = set()
    for i, room in enumerate(rooms):
        if room >= parts[0] and room not in tried:
            tried.add(room)
            if _packs_into(parts[1:], [*rooms[:i], room - parts[0], *rooms[i + 1 :]]):
                return True
    return False


def fillings(counts: dict[int, int], capacity: int, width: int) -> list[Filling]:
    """Undominated ways to complete a bin around the largest size, least waste first.

    Every size that fits opens one filling, which then takes the best-fitting size again and
    again. A filling is dominated when its parts fit into the parts of another one. At most
    ``width`` fillings are returned.
    """
    largest = max(counts)
    sizes = sorted(counts)
    found: list[tuple[int, tuple[int, ...]]] = []
    seen: set[tuple[int, ...]] = set()
    for opener in reversed(sizes[: bisect_right(sizes, capacity - largest)]):
        room, parts, used = capacity - largest, [], {largest: 1}
        at = opener
        while True:
            if used.get(at, 0) < counts[at]:
                parts.append(at)
                used[at] = used.get(at, 0) + 1
                room -= at
                k = bisect_right(sizes, min(room, at)) - 1
            else:
                k = bisect_right(sizes, at - 1) - 1
            if k < 0 or not room:
                break
            at = sizes[k]
        if parts and (key := tuple(sorted(parts, reverse=True))) not in seen:
            seen.add(key)
            found.append((room, key))
            if not room and sum(not x for x, _ in found) >= width:
                break
    if not found:
        found.append((capacity - largest, ()))
    found.sort(key=lambda x: (x[0], len(x[1]), tuple(-p for p in x[1])))
    kept: list[tuple[int, ...]] = []
    for _, parts in found:
        if len(kept) == width:
            break
        if not any(len(k) <= len(parts) <= 8 and _packs_into(list(parts), list(k)) for k in kept):
            kept.append(parts)
    out = []
    for parts in kept:
        tally: dict[int, int] = {}
        for p in (largest, *parts):
            tally[p] = tally.get(p, 0) + 1
        out.append(tuple(sorted(tally.items(), reverse=True)))
    return out


def pack(counts: dict[int, int], capacity: int, width: int = 6, nodes: int = 3000) -> list[tuple[Filling, int]]:
    """Fewest bins found for ``counts`` (size -> how many): fillings and how often each is used.

    Depth-first over the fillings of the largest size left, each used as often as the counts
    allow. A branch ends when its waste exceeds what one bin less than the best would
    leave. Along the way branches are completed by best fit as new incumbents. ``nodes`` bounds
    the search; the best solution so far stands, and it is optimal when it meets the bound.
    """
    counts = {s: n for s, n in counts.items() if n > 0}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("sizes must lie between 1 and the capacity")
    total = sum(s * n for s, n in counts.items())
    best = best_fit(counts, capacity)
    used = sum(n for _, n in best)
    bound = lower_bound(counts, capacity)
    budget, every = [nodes], 16

    def go(left: dict[int, int], done: list[tuple[Filling, int]], bins: int, waste: int) -> None:
        nonlocal best, used
        while left and used > bound and budget[0] > 0:
            options = [f for f in fillings(left, capacity, width) if waste + (capacity - sum(s * c for s, c in f)) <= (used - 1) * capacity - total]
            if not options:
                return
            for k, filling in enumerate(options):
                budget[0] -= 1
                if budget[0] <= 0 or used <= bound:
                    return
                free = capacity - sum(s * c for s, c in filling)
                times = min(left[s] // c for s, c in filling)
                if free:  # as many as the waste that is still allowed
                    times = min(times, ((used - 1) * capacity - total - waste) // free)
                if times < 1:
                    continue
                rest = dict(left)
                for s, c in filling:
                    rest[s] -= times * c
                    if not rest[s]:
                        del rest[s]
                now = [*done, (filling, times)]
                if budget[0] % every == 0 or len(rest) < 64:
                    tail = best_fit(rest, capacity)
                    if bins + times + sum(n for _, n in tail) < used:
                        best, used = now + tail, bins + times + sum(n for _, n in tail)
                if k == len(options) - 1:  # the last branch goes on in this frame
                    left, done, bins, waste = rest, now, bins + times, waste + times * free
                    break
                go(rest, now, bins + times, waste + times * free)
            else:
                return

    go(counts, [], 0, 0)
    return best
