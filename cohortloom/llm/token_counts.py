"""Lengths of texts in greedy word pieces, without building the pieces.

The vocabulary is a trie over bytes. Every node holds a failure link, which is where
matching goes on when the next byte has no edge, and the number of pieces that following
the link gives out. So each byte of a word is read once, and a count is all that is kept.

Words are runs of bytes other than ASCII white space, and are matched with one space
before them: pieces that begin with a space start a word, the others continue it.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cohortloom.llm.common import map_arrow, raw, slices, table

START = b" "
ROOT, NOWHERE = 0, -1
REMEMBERED = 300_000  # words whose counts a worker keeps; it starts anew when they are more


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of a byte-level vocabulary file: stand-in -> byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file as bytes, special tokens left out."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content.get("added_tokens", ()) if t.get("special")}
    alphabet = byte_alphabet()
    return [
        bytes(alphabet[c] for c in piece)
        for piece in content["model"]["vocab"]
        if piece not in special
    ]


class LongestMatch:
    """Counts of greedy longest matches, linear in the length of a word."""

    def __init__(self, pieces: list[bytes]):
        edges: dict[int, int] = {}  # node * 256 + byte -> node
        final, nodes = set(), 1
        for piece in pieces:
            node = ROOT
            for byte in piece:
                key = node << 8 | byte
                if key not in edges:
                    edges[key] = nodes
                    nodes += 1
                node = edges[key]
            final.add(node)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in edges.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        link, popped = [NOWHERE] * nodes, [0] * nodes
        queue = deque([ROOT])
        while queue:  # parents first
            parent = queue.popleft()
            for byte, node in children.get(parent, ()):
                if node in final:
                    link[node], popped[node] = ROOT, 1
                else:
                    at, count = link[parent], popped[parent]
                    while at != NOWHERE and at << 8 | byte not in edges:
                        at, count = link[at], count + popped[at]
                    if at != NOWHERE:
                        link[node], popped[node] = edges[at << 8 | byte], count
                queue.append(node)
        self.edges, self.link, self.popped = edges, link, popped

    def count(self, word: bytes) -> int:
        """Number of pieces of `word`; a word that can't be covered counts as one unknown."""
        edges, link, popped = self.edges, self.link, self.popped
        node, count = ROOT, 0
        for byte in word:
            while (after := edges.get(node << 8 | byte, NOWHERE)) == NOWHERE:
                if link[node] == NOWHERE:
                    return 1
                count += popped[node]
                node = link[node]
            node = after
        while node != ROOT:
            if link[node] == NOWHERE:
                return 1
            count += popped[node]
            node = link[node]
        return count


class WordCounts(dict):
    """Word -> number of pieces, filled as words are met."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = count = self.automaton.count(START + word)
        return count


_loaded: dict[str, WordCounts] = {}


def word_counts(path: str) -> WordCounts:
    if path not in _loaded:
        _loaded[path] = WordCounts(LongestMatch(read_pieces(path)))
    return _loaded[path]


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, n_pieces of the whole text.

    `vocabulary` is the path of a byte-level vocabulary file on every executor. A null or
    empty text has no words and no pieces; repeated rows are counted one by one; an empty
    table gives no rows; other columns are not read. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(vocabulary)
        for batch in slices(batches, "text", 8 << 20):
            words, pieces = [], []
            for text in raw(batch.column("text")):
                found = text.split()
                words.append(len(found))
                pieces.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words, pa.int64()),
                    pa.array(pieces, pa.int64()),
                ],
                names=["doc_id", "n_words", "n_pieces"],
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    return map_arrow(rows, run, "doc_id long, n_words long, n_pieces long")


def op8_token_counts(spark, sf_dir):
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), vocabulary)
