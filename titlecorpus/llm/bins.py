"""Bin completion over a histogram of sizes: which fillings, and how many bins of each.

The work depends on the number of distinct sizes (at most the capacity), not
on the number of items: best-fit decreasing runs over groups of equal bins and
gives the incumbent. Where that misses the lower bound, a branch-and-bound
fills bin by bin around the largest size left, over undominated completions in
rising order of waste, and drops a branch once its waste rules out fewer bins
than the incumbent has.
"""

from __future__ import annotations

from bisect import bisect_left

#: Search nodes after which the best packing found so far stands; completions tried per node, and steps to list them.
NODES, BRANCH, LISTED = 4_000, 6, 200


def best_fit_decreasing(sizes: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(filling, bins)]; each size goes to the fullest bins that take it, equal bins together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {capacity: []}  # room left -> groups of equal bins
    for size in sorted(sizes, reverse=True):
        left = sizes[size]
        for room in sorted(r for r in open_ if size <= r < capacity):
            each = room // size
            groups = open_.pop(room)
            while groups and left:
                filling, n = groups.pop()
                full = min(n, left // each)
                if full:
                    open_.setdefault(room - each * size, []).append((filling + (size,) * each, full))
                    left -= full * each
                if n > full and left:  # fewer items than one bin of the group takes
                    open_.setdefault(room - left * size, []).append((filling + (size,) * left, 1))
                    full, left = full + 1, 0
                if n > full:
                    groups.append((filling, n - full))
            if groups:
                open_.setdefault(room, []).extend(groups)
            if not left:
                break
        each = capacity // size
        for k, n in ((each, left // each), (left % each, 1)):
            if k and n:
                open_.setdefault(capacity - k * size, []).append(((size,) * k, n))
    return [g for groups in open_.values() for g in groups]


def lower_bound(sizes: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: large sizes need a bin each, mid sizes fill what the large leave, for every cut between."""
    best = -(-sum(s * n for s, n in sizes.items()) // capacity)
    for cut in [0, *(s for s in sizes if 2 * s <= capacity)]:
        large = sum(n for s, n in sizes.items() if s > capacity - cut)
        half = [(s, n) for s, n in sizes.items() if capacity - cut >= s and 2 * s > capacity]
        small = sum(s * n for s, n in sizes.items() if 2 * s <= capacity and s >= cut)
        room = sum((capacity - s) * n for s, n in half)
        best = max(best, large + sum(n for _, n in half) + max(0, -(-(small - room) // capacity)))
    return best


def completions(sizes: dict[int, int], first: int, capacity: int) -> list[tuple[int, ...]]:
    """Undominated fillings that hold ``first``, least waste first (at most BRANCH)."""
    spare = {s: n - (s == first) for s, n in sizes.items() if s <= capacity - first and n > (s == first)}
    order = sorted(spare, reverse=True)
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = 0

    def grow(i: int, room: int, chosen: tuple[int, ...]) -> None:
        """Completions of ``chosen`` from the sizes from the i-th on that fit; distinct sizes bound the depth."""
        nonlocal steps
        steps += 1
        i = max(i, bisect_left(order, -room, key=lambda s: -s))
        if i == len(order):
            found.append((room, chosen))
            return
        for j in range(i, len(order)):
            for k in range(min(spare[order[j]], room // order[j]), 0, -1):
                grow(j + 1, room - k * order[j], chosen + (order[j],) * k)
                if steps > LISTED and found:
                    return

    grow(0, capacity - first, ())

    def dominated(room: int, chosen: tuple[int, ...]) -> bool:
        """One more size fits, or one or two of the sizes could give way to a single larger one that is left."""
        left = sorted(s for s in order if chosen.count(s) < spare[s])
        fits = lambda low, high: (i := bisect_left(left, low)) < len(left) and left[i] <= high
        own = sorted(set(chosen))
        return fits(1, room) or any(fits(x + 1, x + room) for x in own) or any(
            fits(x + y, x + y + room) for i, x in enumerate(own) for y in own[i + (chosen.count(x) < 2):])

    kept = [f for f in set(found) if not dominated(*f)] or found
    return [chosen for _, chosen in sorted(kept, key=lambda f: (f[0], tuple(-s for s in f[1])))[:BRANCH]]


def pack_sizes(sizes: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(filling, bins)] that hold ``sizes`` (size -> items, 0 < size <= capacity) in as few bins as the search finds."""
    sizes = {s: n for s, n in sizes.items() if n}
    incumbent = best_fit_decreasing(sizes, capacity)
    least, total = lower_bound(sizes, capacity), sum(s * n for s, n in sizes.items())
    bins = sum(n for _, n in incumbent)
    if bins == least:
        return incumbent
    nodes = 0
    stack = [(sizes, (), 0, 0)]  # sizes left, fillings so far as a linked list, bins and waste so far
    while stack and bins > least and nodes < NODES:
        left, done, used, waste = stack.pop()
        nodes += 1
        if used + (not not left) >= bins or waste > (bins - 1) * capacity - total:
            continue
        if not left:
            incumbent, bins = [], used
            while done:
                incumbent.append(done[0])
                done = done[1]
            continue
        first = max(left)
        for chosen in reversed(completions(left, first, capacity)):
            filling = (first, *chosen)
            times = min(left[s] // filling.count(s) for s in set(filling))
            for k in {1, times}:  # the same filling for as many bins as it can, or for one
                rest = {s: n - k * filling.count(s) for s, n in left.items() if n > k * filling.count(s)}
                stack.append((rest, ((filling, k), done), used + k, waste + k * (capacity - sum(filling))))
    return incumbent
