"""Suffix arrays by linear grouping, for many short texts in step.

Suffixes start in groups by their first symbol. Groups are taken in descending order. Each suffix
of the group at hand finds its previous smaller suffix: the nearest one to its left that is in a
lower group. Those suffixes leave their group for a new one directly above it, higher up the more
suffixes pointed to them. When all groups are done, a group holds the suffixes that share their
longest Lyndon prefix. The order within groups is then emitted from the lowest rank on: whoever
ends its Lyndon prefix at the suffix just emitted takes the next place of its group, found along
the same pointers. Nothing is renamed or sorted again.

A text's groups must be taken one after the other, but texts do not depend on each other, so each
step takes the group at hand of every text at once, as arrays.
"""

from __future__ import annotations

import numpy as np


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + sizes[i] - 1`` for all i, one after the other."""
    ends = np.cumsum(sizes, dtype=sizes.dtype)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total, dtype=starts.dtype)


def suffix_arrays(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix arrays of texts that lie one after the other in ``symbols``.

    A text's last symbol must be its single smallest. The result holds positions in ``symbols``;
    text ``t`` has the places ``starts[t]`` to ``starts[t] + sizes[t] - 1``.
    """
    group, previous = lyndon_groups(symbols, starts, sizes)
    return emitted(group, previous, starts, sizes)


def lyndon_groups(
    symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the first place of its final group, and its previous smaller suffix (-1:
    none)."""
    n = len(symbols)
    kind = np.int32 if n < 1 << 31 else np.int64
    starts, sizes = starts.astype(kind), sizes.astype(kind)
    text = np.repeat(np.arange(len(starts)), sizes)
    base = np.repeat(starts, sizes)
    asked = np.zeros(n, bool)
    key = text * (int(symbols.max()) + 1) + symbols
    order = np.argsort(key, kind="stable").astype(kind)  # the members of each group side by side
    sorted_key = key[order]
    heads = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
    count = np.zeros(n, kind)
    count[heads] = np.diff(np.append(heads, n))
    group = np.empty(n, kind)
    group[order] = np.repeat(heads, count[heads])
    place = np.empty(n, kind)
    place[order] = np.arange(n, dtype=kind)
    previous = np.full(n, -1, kind)
    end = starts + sizes
    low = starts
    while len(end):
        head = group[order[end - 1]]
        members = order[ranges(head, end - head)]
        points_to(members, group, previous, base)
        target = previous[members]
        target = target[target >= 0]
        if len(target):
            regroup(target, order, place, group, count, asked)
        more = head > low
        end, low = head[more], low[more]
    return group, previous


def points_to(
    members: np.ndarray, group: np.ndarray, previous: np.ndarray, base: np.ndarray
) -> None:
    """Set ``previous`` of the members of the groups at hand."""
    at, own, low = members - 1, group[members], base[members]
    open_ = np.flatnonzero((at >= low) & (group[at] >= own))
    while len(open_):
        here = at[open_]
        # Over a suffix of a higher group to what it points to; past one of the same group.
        at[open_] = np.where(group[here] > own[open_], previous[here], here - 1)
        here = at[open_]
        open_ = open_[(here >= low[open_]) & (group[here] >= own[open_])]
    previous[members] = np.where(at >= low, at, -1)


def regroup(
    target: np.ndarray, order: np.ndarray, place: np.ndarray, group: np.ndarray,
    count: np.ndarray, asked: np.ndarray,
) -> None:
    """Move the suffixes pointed to into new groups above their own, by how many pointed.

    ``asked`` is all false and is so again at the end.
    """
    target.sort()
    first = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
    times = np.diff(np.append(first, len(target)))
    target = target[first]
    own = group[target]
    by = np.lexsort((times, own))
    target, times, own = target[by], times[by], own[by]
    fresh = np.concatenate(([True], own[1:] != own[:-1]))
    heads = np.flatnonzero(fresh)
    moved = np.diff(np.append(heads, len(own)))
    old = own[heads]
    stop = old + count[old]
    tail = ranges(stop - moved, moved)  # where they go: the last places of their group
    # Members that stand there and stay change places with those that stand before and go.
    standing = order[tail]
    asked[target] = True
    stay = standing[~asked[standing]]
    asked[target] = False
    left = place[target] < np.repeat(stop - moved, moved)
    vacated = place[target[left]]
    order[vacated], place[stay] = stay, vacated
    order[tail], place[target] = target, tail
    runs = np.flatnonzero(fresh | np.concatenate(([True], times[1:] != times[:-1])))
    size = np.diff(np.append(runs, len(own)))
    count[old] -= moved
    count[tail[runs]] = size
    group[target] = np.repeat(tail[runs], size)


def emitted(
    group: np.ndarray, previous: np.ndarray, starts: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """The suffixes in ascending order, from their groups."""
    n = len(group)
    result = np.full(n, -1, group.dtype)
    slot = np.arange(n, dtype=group.dtype)  # the next free place of the group that begins here
    placed = np.zeros(n, bool)
    last = starts + sizes - 1
    result[starts], placed[last] = last, True
    longest_first = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[longest_first], sizes[longest_first]
    alive = len(starts)
    for rank in range(int(sizes[0]) if len(sizes) else 0):
        while sizes[alive - 1] <= rank:
            alive -= 1
        low = starts[:alive]
        suffix = result[low + rank] - 1
        some = suffix >= low
        suffix = suffix[some]
        while len(suffix):
            suffix = suffix[~placed[suffix]]
            head = group[suffix]
            result[slot[head]] = suffix
            slot[head] += 1
            placed[suffix] = True
            suffix = previous[suffix]
            suffix = suffix[suffix >= 0]
    return result
