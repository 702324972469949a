"""Greedy word-piece counts in linear time.

The vocabulary is a trie. A node that cannot go on has a failure link to the node that what is left of the word has
reached after its longest pieces are taken off, and the number of these pieces. So a word is read once, byte by
byte, without going back and without building pieces.

The last byte of a word is a letter of its own, as in the vocabulary, which marks the last byte of the pieces that end
a word: such a piece matches at the end of a word only, and a piece without the mark never ends one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bedfeed.llm.common import blocks

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
WORD_END = "</w>"
# Added to the last byte of a word.
LAST = 256
# Words whose counts a task remembers before it starts anew.
REMEMBERED = 200_000


class Pieces:
    """The trie of a vocabulary of byte strings, with failure links and the pieces popped on them.

    ``final`` are the pieces that end a word; the others are inside of words then. Without it all pieces are anywhere.
    """

    def __init__(self, vocabulary: set[bytes], final: set[bytes] | None = None) -> None:
        self.last = 0 if final is None else LAST
        pieces = [list(p) for p in vocabulary] + [[*p[:-1], p[-1] + LAST] for p in final or ()]
        self.next: dict[int, int] = {}
        ends = [False]
        order: list[tuple[int, int, int]] = []  # parent, letter, node
        for piece in pieces:
            node = 0
            for letter in piece:
                key = node << 9 | letter
                if key not in self.next:
                    self.next[key] = len(ends)
                    order.append((node, letter, len(ends)))
                    ends.append(False)
                node = self.next[key]
            ends[node] = True
        self.link = [-1] * len(ends)
        self.popped = [0] * len(ends)
        # Parents come before children of the next depth: a link leads to a node that is less deep.
        depth = [0] * len(ends)
        for parent, _, node in order:
            depth[node] = depth[parent] + 1
        for parent, letter, node in sorted(order, key=lambda x: depth[x[2]]):
            if ends[node]:
                self.link[node], self.popped[node] = 0, 1
                continue
            at, count = self.link[parent], self.popped[parent]
            while at >= 0 and at << 9 | letter not in self.next:
                count += self.popped[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.popped[node] = self.next[at << 9 | letter], count

    def count(self, word: bytes) -> int:
        """The number of greedy longest pieces; -1 if no piece goes on at some place."""
        step, link, popped, node, total = self.next, self.link, self.popped, 0, 0
        letters = list(word)
        if letters:
            letters[-1] += self.last
        for letter in letters:
            while (to := step.get(node << 9 | letter)) is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return -1
            node = to
        while node:
            total += popped[node]
            node = link[node]
            if node < 0:
                return -1
        return total


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it is printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def loaded(path: str) -> Pieces:
    """The pieces of a byte-level vocabulary file; those with the mark for the end of a word end words."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    special = {t["content"] for t in data.get("added_tokens", ())}
    letters = byte_letters()
    inner: set[bytes] = set()
    final: set[bytes] = set()
    for w in data["model"]["vocab"]:
        if w not in special and (piece := bytes(letters[c] for c in w.removesuffix(WORD_END))):
            (final if w.endswith(WORD_END) else inner).add(piece)
    return Pieces(inner, final)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) for every row of documents (doc_id, text, anything else).

    Words are what white space parts, in lower case. ``n_tokens`` counts the greedy longest pieces of every word,
    of which the last one, and no other, is marked as final; a word that has a place without a piece is unknown and one token. Null and empty texts have no words. Rows that repeat a
    doc_id or a whole row each give a row. The vocabulary file must be readable by every executor.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(vocabulary)
        known: dict[bytes, int] = {}
        for rows, data, offsets in blocks(batches):
            whole, out = data.tobytes(), np.zeros((rows.num_rows, 3), np.int64)
            for i in range(rows.num_rows):
                text = whole[offsets[i] : offsets[i + 1]]
                text = text.lower() if text.isascii() else text.decode("utf-8").lower().encode()
                words = text.split()
                tokens = unknown = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        n = pieces.count(word)
                        if len(word) < 64:
                            known[word] = n
                    if n < 0:
                        unknown += 1
                        tokens += 1
                    else:
                        tokens += n
                out[i] = len(words), tokens, unknown
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *map(pa.array, out.T.copy())], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
