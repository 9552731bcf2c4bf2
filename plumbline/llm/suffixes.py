"""Suffix arrays by linear grouping: suffixes are grouped by their Lyndon prefix, then each group is put in order."""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """The suffixes of a sequence of positive integers in ascending order.

    First phase: starting from groups of equal first symbols, groups are taken in descending order. Each suffix of the
    group finds its pointer to the nearest suffix on its left in a smaller group, and the suffixes pointed at move up
    within their own group, the further the more pointers they got: their known prefix has grown by the group's.
    Second phase: suffixes are emitted in ascending order; each one emitted is the next smaller suffix of a chain of
    previous-smaller pointers on its left, whose members take the next places of their groups. Nothing is renamed and
    there is no recursion.
    """
    text = [*symbols, 0]
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    group = [0] * n
    size = [0] * (n + 1)
    start = 0
    for k, i in enumerate(order):
        place[i] = k
        if text[i] != text[order[start]]:
            start = k
        group[i] = start
        size[start] += 1
    before = [-1] * n
    top = n - 1
    while top > 0:
        g = group[order[top]]
        pointed: dict[int, int] = {}
        if g == top:
            i = order[top]
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = 1
        else:
            for i in sorted(order[g : top + 1]):
                j = i - 1
                while j >= 0 and group[j] >= g:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    pointed[j] = pointed.get(j, 0) + 1
        top = g - 1
        if not pointed:
            continue
        by_count: dict[int, list[int]] = {}
        for j, c in pointed.items():
            by_count.setdefault(c, []).append(j)
        for c in sorted(by_count, reverse=True):
            moved = by_count[c]
            for j in moved:
                h = group[j]
                size[h] -= 1
                last = h + size[h]
                at, other = place[j], order[last]
                order[at], order[last] = other, j
                place[other], place[j] = at, last
            # What is left of the old group keeps its name; the places behind it are the new group's.
            for j in moved:
                group[j] += size[group[j]]
            for j in moved:
                size[group[j]] += 1
    return _emit(n, group, before)


def _emit(n: int, group: list[int], before: list[int]) -> list[int]:
    out = [-1] * n
    free = list(range(n + 1))  # next place of the group that starts here
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = before[s]
    return out[1:]
