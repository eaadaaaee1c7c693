"""Counting subword tokens: the longest pieces of a vocabulary, one after the other."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable
from functools import lru_cache

from pagequarry.functions.text import split_words

REMEMBERED = 1 << 16  # words whose numbers are kept
LONG = 64  # characters; longer words are counted each time


class Trie:
    """The pieces of a vocabulary by their bytes."""

    def __init__(self, pieces: Iterable[bytes]):
        self.next: dict[int, int] = {}  # node and byte to node
        self.whole = bytearray(1)  # whether a piece ends in a node
        for piece in pieces:
            node = 0
            for byte in piece:
                node = self.next.setdefault(node << 8 | byte, len(self.whole))
                if node == len(self.whole):
                    self.whole.append(0)
            self.whole[node] = node > 0

    def cut(self, raw: bytes) -> list[bytes]:
        """The longest piece at each place; a byte that begins none is one by itself."""
        out, at = [], 0
        while at < len(raw):
            node, end = 0, at + 1
            for place in range(at, len(raw)):
                node = self.next.get(node << 8 | raw[place], 0)
                if not node:
                    break
                if self.whole[node]:
                    end = place + 1
            out.append(raw[at:end])
            at = end
        return out


def subword_counter(pieces: Iterable[bytes]) -> Callable[[], Callable[[str], int]]:
    """A tokenizer for chunkers: counts the pieces of each word, so a text without spaces
    has many tokens. The vocabulary goes to the workers, each builds its trie once."""
    known = tuple(sorted(set(pieces)))

    def load() -> Callable[[str], int]:
        trie = Trie(known)
        kept = lru_cache(maxsize=REMEMBERED)(lambda word: len(trie.cut(word.encode())))

        def count(text: str) -> int:
            return sum(
                kept(w) if len(w) <= LONG else len(trie.cut(w.encode())) for w in split_words(text)
            )

        def pieces(word: str) -> list[str]:
            """The pieces as text; those that part a character stay together."""
            out, held = [], b""
            for piece in trie.cut(word.encode()):
                held += piece
                try:
                    out.append(held.decode())
                    held = b""
                except UnicodeDecodeError:
                    continue
            return out

        count.pieces = pieces
        return count

    return load


def read_pieces(path: str) -> list[bytes]:
    """The pieces of a vocabulary file: a line each, in base64 before the rank."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]
