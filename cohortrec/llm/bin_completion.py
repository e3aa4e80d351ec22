"""Bin completion on a histogram of item lengths.

Items are whole numbers up to the capacity, so any number of them is a histogram of at most
``capacity`` counts. A solution is a list of ``(pattern, copies)``: the lengths in one bin, largest
first, and how many bins are filled this way.

The search takes the largest remaining item and branches over the undominated fillings of the space
beside it, most filled first. A branch is cut when the space wasted so far would leave no solution
better than the incumbent, or when a lower bound on the rest says so. The first incumbent is
best-fit decreasing, and every better solution replaces it. The search stops at the lower bound, when it has
tried everything, or at the end of its ``Effort``; the incumbent is a whole solution at any time. An effort without
limits makes the search exhaustive and its result a proven optimum.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

Pattern = tuple[int, ...]


@dataclass(frozen=True)
class Effort:
    """Limits of the search; None is no limit.

    ``nodes`` branches in all; per branch ``fillings`` that are kept, partial fillings that are looked at (``steps``),
    and items of the longest filling that is ``tested`` for being dominated (an untested one is kept).
    """

    nodes: int | None = 12_000
    fillings: int | None = 12
    steps: int | None = 400
    tested: int | None = 6


EXHAUSTIVE = Effort(None, None, None, None)


def _spent(used: int, limit: int | None) -> bool:
    return limit is not None and used >= limit


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing. Bins with equal residual are handled together, so cost follows the
    number of different lengths and not of items."""
    open_bins: dict[int, Counter] = defaultdict(Counter)  # residual: patterns
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            # A bin that takes the item may take it again, so look anew after each step.
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                each = capacity // length
                if full := left // each:
                    open_bins[capacity - each * length][(length,) * each] += full
                if rest := left % each:
                    open_bins[capacity - rest * length][(length,) * rest] += 1
                break
            pattern = next(iter(open_bins[room]))
            bins = open_bins[room].pop(pattern)
            each = room // length
            used = min(bins, left // each)
            if used:
                open_bins[room - each * length][pattern + (length,) * each] += used
            if bins > used and left - used * each:
                rest = min(left - used * each, each)
                open_bins[room - rest * length][pattern + (length,) * rest] += 1
                left -= rest
                bins -= 1
            left -= used * each
            if bins > used:
                open_bins[room][pattern] += bins - used
            if not open_bins[room]:
                del open_bins[room]
    done: Counter = Counter()
    for patterns in open_bins.values():
        done.update(patterns)
    return done


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any solution needs: total length, and large items with what fits beside none of them.

    ``counts[l]`` is the number of items of length ``l``; the capacity is the last index.
    """
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * lengths)
    best = -(-int(total[-1]) // capacity)
    half = capacity // 2
    for k in range(1, half + 1):
        if k > 1 and not counts[k] and not counts[capacity - k + 1]:
            continue
        alone = int(number[-1] - number[capacity - k])
        large = int(number[capacity - k] - number[half])
        free = large * capacity - int(total[capacity - k] - total[half])
        small = int(total[half] - total[k - 1])
        best = max(best, alone + large + max(0, -(-(small - free) // capacity)))
    return best


def dominates(a: Pattern, b: Pattern) -> bool:
    """Whether the items of ``b`` can be dealt into groups that fit into different items of ``a``."""
    if sum(a) < sum(b) or (b and not a) or (b and max(b) > max(a)):
        return False

    def deal(rest: Pattern, rooms: tuple[int, ...]) -> bool:
        if not rest:
            return True
        tried = set()
        for i, room in enumerate(rooms):
            if room >= rest[0] and room not in tried:
                tried.add(room)
                if deal(rest[1:], (*rooms[:i], room - rest[0], *rooms[i + 1 :])):
                    return True
        return False

    return deal(b, a)


def fullest(counts: np.ndarray, descending: list[int], space: int) -> Pattern:
    """A filling of ``space`` that wastes least, by sums that the smaller lengths can reach, as bits."""
    mask = (1 << (space + 1)) - 1
    reach = [1]  # of the lengths from some place on
    for length in reversed(descending):
        sums, left, step = reach[-1], min(int(counts[length]), space // length), 1
        while left > 0:
            step = min(step, left)
            sums |= (sums << (length * step)) & mask
            left -= step
            step *= 2
        reach.append(sums)
    rest, items = reach[-1].bit_length() - 1, []
    for length, below in zip(descending, reversed(reach[:-1])):
        copies = 0
        while not below >> (rest - copies * length) & 1:
            copies += 1
        items += [length] * copies
        rest -= copies * length
    return tuple(items)


def fillings(counts: np.ndarray, space: int, allowed: int, effort: Effort = Effort()) -> list[Pattern]:
    """Undominated sets of items for ``space`` that waste at most ``allowed``, most filled first."""
    found: list[tuple[int, Pattern]] = []
    steps = 0
    there = np.flatnonzero(counts[: space + 1])
    if not len(there):
        return [()] if space <= allowed else []
    smallest = int(there[0])
    descending = there[::-1].tolist()

    def add(items: Pattern, room: int) -> None:
        if room <= allowed:
            found.append((room, items))

    def grow(items: Pattern, room: int, begin: int) -> None:
        """Fill ``room`` with lengths from ``begin`` on, as many of each as fit, or fewer."""
        nonlocal steps
        steps += 1
        if room < smallest:
            add(items, room)
            return
        if counts[room] and (not items or room < items[-1]):
            add((*items, room), 0)  # dominates all other ways to fill this room
            return
        any_fits = False
        for i in range(begin, len(descending)):
            length = descending[i]
            most = min(room // length, int(counts[length])) if length <= room else 0
            for copies in range(most, 0, -1):
                if _spent(steps - 1, effort.steps) or (effort.fillings is not None and len(found) >= 2 * effort.fillings):
                    return
                any_fits = True
                grow((*items, *(length,) * copies), room - length * copies, i + 1)
        if not any_fits:
            add(items, room)

    # A single item that fits exactly dominates every other filling.
    if counts[space]:
        return [(space,)]
    # Pairs that fit exactly; plentiful lengths first, so that the last bins still find different ones.
    long = there[np.searchsorted(there, -(-space // 2)) :]
    long = long[long < space]
    supply = np.minimum(counts[long], counts[space - long] - (2 * long == space))
    for i in np.argsort(-supply, kind="stable")[: effort.fillings].tolist():
        if supply[i] > 0:
            found.append((0, (int(long[i]), int(space - long[i]))))
    grow((), space, 0)
    if all(room for room, _ in found):
        items = fullest(counts, descending, space)
        add(items, space - sum(items))

    def supply_of(items: Pattern) -> int:
        return int(min((counts[length] for length in items), default=0))

    chosen: list[Pattern] = []
    for _, items in sorted(set(found), key=lambda f: (f[0], len(f[1]), -supply_of(f[1]))):
        untested = effort.tested is not None and len(items) > effort.tested
        if untested or not any(dominates(other, items) for other in chosen):
            chosen.append(items)
            if _spent(len(chosen), effort.fillings):
                break
    return chosen


def pack(counts: dict[int, int], capacity: int, effort: Effort = Effort()) -> list[tuple[Pattern, int]]:
    """As few bins as found for ``counts`` (length: items); lengths are 1 to ``capacity``."""
    counts = {int(k): int(v) for k, v in counts.items() if v}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"item lengths must be 1 to {capacity}")
    incumbent = best_fit(counts, capacity)
    left = np.zeros(capacity + 1, dtype=np.int64)
    left[list(counts)] = list(counts.values())
    bound = lower_bound(left)
    best = sum(incumbent.values())
    if best == bound:
        return sorted(incumbent.items())
    total = int((left * np.arange(capacity + 1)).sum())
    bins = wasted = spent = 0

    def branches() -> Iterator[tuple[Pattern, int]]:
        """The ways to fill the bin of the largest item that is left."""
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        ways = fillings(left, capacity - largest, (best - 1) * capacity - total - wasted, effort)
        left[largest] += 1
        for items in ways:
            pattern = (largest, *items)
            copies = min(int(left[length]) // n for length, n in Counter(pattern).items())
            yield pattern, copies
            if copies > 1:
                yield pattern, 1

    def put(pattern: Pattern, copies: int, sign: int) -> None:
        nonlocal bins, wasted
        for length in pattern:
            left[length] -= sign * copies
        bins += sign * copies
        wasted += sign * copies * (capacity - sum(pattern))

    path: list[tuple[Pattern, int]] = []
    stack = [branches()]
    while stack and best > bound and not _spent(spent, effort.nodes):
        move = next(stack[-1], None)
        if move is None:
            stack.pop()
            if path:
                put(*path.pop(), -1)
            continue
        spent += 1
        put(*move, 1)
        path.append(move)
        if not left.any():
            if bins < best:
                best, incumbent = bins, Counter()
                for pattern, copies in path:
                    incumbent[pattern] += copies
            put(*path.pop(), -1)
        elif wasted > (best - 1) * capacity - total or (spent % 16 == 0 and bins + lower_bound(left) >= best):
            put(*path.pop(), -1)
        else:
            stack.append(branches())
    return sorted(incumbent.items())
