"""Suffix arrays by linear grouping construction, for the substring deduplication.

Phase 1 handles groups of suffixes (first: by first symbol) from the highest to the lowest. For each suffix of a group
the pointer to its previous suffix in a lower group is found by following the pointers of higher ones; suffixes that are
pointed at by l members of the group move, by falling l, to new groups at the upper end of their own. At the end the
groups are ordered by Lyndon prefixes. Phase 2 reads the array from the left and places each suffix's predecessor, and
what that points at, at the front of its group. Nothing is renamed and no smaller problem is solved."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a list whose last symbol is smaller than all others."""
    n = len(text)
    members: dict[int, set[int]] = {}
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    group, size, start_at_end, at = [0] * n, {}, {}, 0
    for c in sorted(by_symbol):
        m = by_symbol[c]
        for i in m:
            group[i] = at
        members[at], size[at] = set(m), len(m)
        at += len(m)
        start_at_end[at - 1] = at - len(m)
    prev, end = [-1] * n, n - 1
    while end > 0:
        g = start_at_end[end]
        count: dict[int, int] = {}
        for s in sorted(members[g]) if size[g] > 1 else members[g]:
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        if len(count) == 1:
            moves = [(1, count)]
        else:
            levels: dict[int, list[int]] = {}
            for p, c in count.items():
                levels.setdefault(c, []).append(p)
            moves = [(c, levels[c]) for c in sorted(levels, reverse=True)]
        for _, points in moves:
            parts: dict[int, list[int]] = {}
            for p in points:
                parts.setdefault(group[p], []).append(p)
            for a, part in parts.items():
                k = size[a]
                if len(part) == k:
                    continue  # the whole group moves: it stays where it is
                members[a].difference_update(part)
                size[a] = k - len(part)
                new = a + size[a]
                members[new], size[new] = set(part), len(part)
                for p in part:
                    group[p] = new
                start_at_end[new - 1], start_at_end[a + k - 1] = a, new
        end = g - 1
    out, fill, placed = [-1] * n, {}, [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            k = fill.get(g, g)
            out[k] = s
            fill[g] = k + 1
            placed[s] = True
            s = prev[s]
    return out
