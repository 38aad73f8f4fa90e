"""Deep-shallow sorting: multikey quicksort to a shallow depth, then blind tries."""

from __future__ import annotations

import os
from collections.abc import Iterator

#: Characters of the quicksort are this many bytes; groups that agree on SHALLOW bytes go to a trie.
STEP, SHALLOW = 8, 32


def common_prefix(a: bytes, b: bytes) -> int:
    return len(os.path.commonprefix([a, b]))


class BlindTrie:
    """Orders strings by branching depths and characters; each new string is compared with one leaf only."""

    def __init__(self, strings: list[bytes], members: list[int]):
        self.strings = strings
        self.root: list = ["leaf", [members[0]]]
        for i in members[1:]:
            self._insert(i)

    def _insert(self, i: int) -> None:
        text = self.strings[i]
        node = self.root
        while node[0] != "leaf":
            at = text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(at) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(text, other)
        if depth == len(text) == len(other):
            node[1].append(i)
            return
        parent, node = None, self.root
        while node[0] != "leaf" and node[0] < depth:
            parent, node = node, node[1][text[node[0]]]
        mine = text[depth] if depth < len(text) else -1
        if node[0] == depth:
            node[1][mine] = ["leaf", [i]]
            return
        branch = [depth, {mine: ["leaf", [i]], (other[depth] if depth < len(other) else -1): node}]
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch

    def in_order(self) -> Iterator[tuple[int, int | None]]:
        """``(member, what it shares with the one before)``; None for the first."""
        stack: list = [(self.root, None)]
        while stack:
            node, shared = stack.pop()
            if node[0] == "leaf":
                for k, i in enumerate(node[1]):
                    yield i, len(self.strings[i]) if k else shared
                continue
            for k, at in reversed(list(enumerate(sorted(node[1])))):
                stack.append((node[1][at], node[0] if k else shared))


def deep_shallow_sort(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Sorted order of ``strings``, and the prefix that each shares with the one before (0 for the first)."""
    order: list[int] = []
    shared: list[int] = []

    def put(members: Iterator[tuple[int, int | None]]) -> None:
        for i, known in members:
            if known is None:
                known = common_prefix(strings[order[-1]], strings[i]) if order else 0
            order.append(i)
            shared.append(known)

    stack = [(list(range(len(strings))), 0)] if strings else []
    while stack:
        members, depth = stack.pop()
        if len(members) == 1:
            put(iter([(members[0], None)]))
        elif depth >= SHALLOW:
            put(BlindTrie(strings, members).in_order())
        else:
            heads = {i: strings[i][depth : depth + STEP] for i in members}
            pivot = heads[members[len(members) // 2]]
            parts = ([], [], [])
            for i in members:
                parts[(heads[i] >= pivot) + (heads[i] > pivot)].append(i)
            if parts[2]:
                stack.append((parts[2], depth))
            if len(pivot) < STEP:  # ended: the strings are equal
                stack.append((parts[1], SHALLOW))
            else:
                stack.append((parts[1], depth + STEP))
            if parts[0]:
                stack.append((parts[0], depth))
    return order, shared
