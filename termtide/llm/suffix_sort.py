"""Deep-shallow ordering of suffixes, up to a fixed depth.

Shallow: a multikey quicksort whose characters are eight bytes wide orders all
open groups level by level; numpy's sort does the partitioning of each level,
and a group that has one suffix left is closed. Deep: suffixes that still agree
are put into a blind trie, which is descended by single branching bytes and
needs one comparison of whole strings per suffix, however long the common
prefix. A trie of two leaves is one comparison, made for all such pairs at once.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, .. counts[i] numbers of each, end to end."""
    total = int(counts.sum())
    begin = np.cumsum(counts) - counts
    return np.repeat(starts - begin, counts) + np.arange(total)


def byte_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; zero bytes follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(shape=(len(data) + 1,), dtype=">u8", buffer=padded.data, strides=(1,))


class _Trie:
    """A blind trie over strings of one length; equal strings share a leaf."""

    __slots__ = ("root",)

    def __init__(self, tail: bytes, member: int):
        self.root: list = [tail, [member]]

    def add(self, tail: bytes, member: int) -> None:
        node = self.root
        while len(node) == 3:
            children = node[1]
            node = children.get(tail[node[0]]) or node[2]
        if node[0] == tail:
            node[1].append(member)
            return
        differ = int.from_bytes(tail, "big") ^ int.from_bytes(node[0], "big")
        at = len(tail) - (differ.bit_length() + 7) // 8
        leaf = [tail, [member]]
        up, branch, below = None, 0, self.root
        while len(below) == 3 and below[0] < at:
            up, branch = below, tail[below[0]]
            below = below[1][branch]
        if len(below) == 3 and below[0] == at:
            below[1][tail[at]] = leaf
            return
        # an inner node: branching position, children by byte, any leaf below it
        inner = [at, {node[0][at]: below, tail[at]: leaf}, node]
        if up is None:
            self.root = inner
        else:
            up[1][branch] = inner

    def leaves(self) -> list[list[int]]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if len(node) == 3:
                todo.extend(child for _, child in sorted(node[1].items(), reverse=True))
            else:
                out.append(node[1])
        return out


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order the strings of ``depth`` bytes that begin at ``starts``.

    Returns the order (indexes into ``starts``) and, in that order, whether each
    string differs from the one before it. Every start has ``depth`` bytes left.
    Equal strings keep the order in which they came.
    """
    n = len(starts)
    order, new = np.arange(n), np.zeros(n, bool)
    if n == 0:
        return order, new
    new[0] = True
    shallow = min(shallow, depth) // 8 * 8
    words = byte_words(data)
    group = np.zeros(n, np.int64)
    open_ = np.arange(n) if n > 1 else np.zeros(0, np.int64)
    for level in range(0, shallow, 8):
        key = words[starts[order[open_]] + level].astype(np.uint64)
        by = np.lexsort((key, group[open_]))
        order[open_] = order[open_][by]
        key = key[by]
        differs = np.ones(len(open_), bool)
        differs[1:] = (key[1:] != key[:-1]) | (group[open_][1:] != group[open_][:-1])
        new[open_] |= differs
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            return order, new
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    _pairs(words, starts, order, new, heads[sizes == 2], shallow, depth)
    raw = data.tobytes()
    for head, size in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        members = order[head : head + size].tolist()
        places = starts[order[head : head + size]].tolist()
        trie = _Trie(raw[places[0] + shallow : places[0] + depth], members[0])
        for member, place in zip(members[1:], places[1:]):
            trie.add(raw[place + shallow : place + depth], member)
        at = head
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = leaf
            new[at] = True
            at += len(leaf)
    return order, new


def _pairs(words: np.ndarray, starts: np.ndarray, order: np.ndarray, new: np.ndarray, heads: np.ndarray, at: int, depth: int) -> None:
    """Order groups of two in place: compare on from byte ``at``, eight bytes at a time."""
    undecided = heads
    while at < depth and len(undecided):
        left = words[starts[order[undecided]] + at].astype(np.uint64)
        right = words[starts[order[undecided + 1]] + at].astype(np.uint64)
        if depth - at < 8:
            cut = np.uint64(8 * (8 - (depth - at)))
            left, right = left >> cut, right >> cut
        swap, apart = undecided[left > right], undecided[left != right]
        order[swap], order[swap + 1] = order[swap + 1], order[swap].copy()
        new[apart + 1] = True
        undecided = undecided[left == right]
        at += 8
