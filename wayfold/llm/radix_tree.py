"""An adaptive radix tree over byte strings: nodes grow with their children, runs of single children are one path."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node:
    """A node with the path that leads into it, the value of the key that ends here, and children by their next byte,
    which is the first of the child's path.

    Up to 4 and up to 16 children are a sorted list of bytes beside a list of nodes, up to 48 an index of 256
    places into the nodes, more a place for each byte.
    """

    __slots__ = ("path", "value", "room", "keys", "nodes")

    def __init__(self, path: bytes, value: object = None):
        self.path, self.value = path, value
        self.room, self.keys, self.nodes = 4, bytearray(), []

    def find(self, byte: int) -> Node | None:
        if self.room <= 16:
            at = self.keys.find(byte)
            return self.nodes[at] if at >= 0 else None
        if self.room == 48:
            at = self.keys[byte]
            return self.nodes[at - 1] if at else None
        return self.nodes[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or take it in place of the one that has this byte."""
        if self.room <= 16:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.nodes[at] = child
            elif len(self.keys) < self.room:
                self.keys.insert(at, byte)
                self.nodes.insert(at, child)
            else:
                self._grow()
                self.put(byte, child)
        elif self.room == 48:
            if self.keys[byte]:
                self.nodes[self.keys[byte] - 1] = child
            elif len(self.nodes) < 48:
                self.nodes.append(child)
                self.keys[byte] = len(self.nodes)
            else:
                self._grow()
                self.put(byte, child)
        else:
            self.nodes[byte] = child

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(256)
            for place, byte in enumerate(self.keys, 1):
                index[byte] = place
            self.room, self.keys = 48, index
        else:
            self.nodes = [self.nodes[place - 1] if place else None for place in self.keys]
            self.room, self.keys = 256, bytearray()

    def children(self) -> Iterator[Node]:
        """The children by rising byte."""
        if self.room <= 16:
            yield from self.nodes
        elif self.room == 48:
            yield from (self.nodes[place - 1] for place in self.keys if place)
        else:
            yield from (n for n in self.nodes if n is not None)


def shared_start(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    """Byte strings, each with a value other than None; a later one replaces that of an equal key."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value: object) -> None:
        above, node, at = None, self.root, 0
        while True:
            if key.startswith(node.path, at):
                at += len(node.path)
            else:
                # The key leaves the path halfway: a new node takes its start, this one keeps the rest.
                same = shared_start(node.path, key[at : at + len(node.path)])
                upper = Node(node.path[:same])
                node.path = node.path[same:]
                upper.put(node.path[0], node)
                above.put(upper.path[0], upper)
                node, at = upper, at + same
            if at == len(key):
                node.value = value
                return
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Node(key[at:], value))
                return
            above, node = node, child
