"""Deep-shallow ordering of byte strings that begin alike.

Multikey quicksort orders the strings to a shallow depth; the groups that
still agree there are ordered by blind tries, which compare a string with one
other string only, however long the common prefix is.
"""

from __future__ import annotations

SHALLOW = 32             # bytes compared by the quicksort beyond the known prefix
SMALL = 3                # groups so small go to the blind trie at once


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix; ``known`` bytes are known equal."""
    hi = min(len(a), len(b))
    if a[known:hi] == b[known:hi]:
        return hi
    lo = known
    while hi - lo > 1:                       # a[:lo] is common, a[:hi] is not
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def blind_trie_order(strings: list[bytes], group: list[int], depth: int) -> list[int]:
    """Order of ``group`` (strings equal up to ``depth``) by a blind trie.

    An inner node is [skip depth, {next byte: child}], a leaf a list index in
    a one-element tuple; the end of a string sorts first, as byte -1."""
    def byte(i: int, at: int) -> int:
        s = strings[i]
        return s[at] if at < len(s) else -1

    root = (group[0],)
    equal: dict[int, list[int]] = {}
    for i in group[1:]:
        node, path = root, []
        while isinstance(node, list):        # blind descent: only branching bytes are looked at
            path.append(node)
            child = node[1].get(byte(i, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        leaf = node[0]
        shared = common_prefix(strings[i], strings[leaf], depth)
        if shared == len(strings[i]) == len(strings[leaf]):
            equal.setdefault(leaf, []).append(i)
            continue
        at = 0
        while at < len(path) and path[at][0] < shared:
            at += 1
        if at < len(path) and path[at][0] == shared:
            path[at][1][byte(i, shared)] = (i,)
            continue
        below = path[at] if at < len(path) else (leaf,)
        new = [shared, {byte(i, shared): (i,), byte(leaf, shared): below}]
        if at == 0:
            root = new
        else:
            above = path[at - 1]
            above[1][byte(i, above[0])] = new
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, list):
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            out += [node[0], *equal.get(node[0], ())]
    return out


def deep_shallow_order(strings: list[bytes], known: int = 0) -> list[int]:
    """Indices of ``strings`` in ascending order; all agree on ``known`` bytes."""
    out: list[int] = []
    todo = [(list(range(len(strings))), known)]
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            out += group
        elif len(group) <= SMALL or depth >= known + SHALLOW:
            out += blind_trie_order(strings, group, depth)
        else:
            keys = {i: strings[i][depth] if depth < len(strings[i]) else -1 for i in group}
            pivot = sorted(keys.values())[len(group) // 2]
            less = [i for i in group if keys[i] < pivot]
            same = [i for i in group if keys[i] == pivot]
            more = [i for i in group if keys[i] > pivot]
            if pivot == -1:
                out += same                  # ended strings are equal
            parts = [(less, depth), (same if pivot != -1 else [], depth + 1), (more, depth)]
            todo += [p for p in reversed(parts) if p[0]]
    return out
