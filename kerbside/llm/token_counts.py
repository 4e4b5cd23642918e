"""Word-piece token counts without building pieces.

The vocabulary is a byte trie with two roots (word start, continuation). Every node has a
failure link and the number of pieces that are complete when the link is taken, so a word of n
bytes costs at most 2 n steps, whatever its greedy longest-match pieces are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import row_results

REMEMBERED = 600_000
_START, _MORE, _NONE = 0, 1, -1


class Automaton:
    """``count(word)``: pieces of a word, or -1 if the vocabulary can't cover it."""

    def __init__(self, initial: list[bytes], continuing: list[bytes]):
        step: dict[int, int] = {}
        final, depth_order = {}, []
        children: dict[int, list[tuple[int, int]]] = {_START: [], _MORE: []}
        for root, pieces in ((_START, initial), (_MORE, continuing)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in step:
                        step[key] = len(children)
                        children[node].append((byte, step[key]))
                        children[step[key]] = []
                    node = step[key]
                if piece:
                    final[node] = True
        self.fail = [_NONE] * len(children)
        self.popped = [0] * len(children)
        depth_order = [_START, _MORE]
        for parent in depth_order:
            for byte, node in children[parent]:
                if node in final:
                    self.fail[node], self.popped[node] = _MORE, 1
                else:
                    back, popped = self.fail[parent], self.popped[parent]
                    while back != _NONE and (back << 8 | byte) not in step:
                        popped, back = popped + self.popped[back], self.fail[back]
                    if back != _NONE:
                        self.fail[node], self.popped[node] = step[back << 8 | byte], popped
                depth_order.append(node)
        self.step = step
        self.known: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        step, fail, popped = self.step, self.fail, self.popped
        node, pieces = _START, 0
        for byte in word:
            following = step.get(node << 8 | byte)
            while following is None:
                pieces += popped[node]
                node = fail[node]
                if node == _NONE:
                    return -1
                following = step.get(node << 8 | byte)
            node = following
        while node != _MORE:
            pieces += popped[node]
            node = fail[node]
            if node == _NONE:
                return -1
        return pieces

    def counts(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = self.count(word)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def piece_vocabulary(path: str, mark: str = "▁") -> tuple[list[bytes], list[bytes]]:
    """Word-start and continuation pieces of a piece model: those with and without the mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    initial, continuing = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if mark not in piece:
            continuing.append(piece.encode())
        elif piece.count(mark) == 1 and piece[0] == mark and len(piece) > 1:
            initial.append(piece[1:].encode())
    return initial, continuing


_AUTOMATA: dict[str, Automaton] = {}


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for each row of ``(doc_id, text)``.

    Words are runs without ASCII white space. A word is taken apart greedily, longest piece
    first; a word that can't be covered counts as one unknown token. A null or blank text has
    no words. Rows are judged one by one, so repeated and null doc_ids stay as they are. Words
    are remembered per worker, in a store of bounded size.
    """
    def count(batch: pa.RecordBatch) -> list[pa.Array]:
        if vocabulary not in _AUTOMATA:
            _AUTOMATA[vocabulary] = Automaton(*piece_vocabulary(vocabulary))
        automaton = _AUTOMATA[vocabulary]
        split = [(t or b"").split() for t in batch.column("text").to_pylist()]
        got = automaton.counts([w for words in split for w in words])
        ends = np.cumsum([len(w) for w in split], dtype=np.int64)
        edges = np.concatenate(([0], ends)) if len(ends) else np.zeros(1, np.int64)

        def totals(values: np.ndarray) -> pa.Array:
            sums = np.concatenate(([0], np.cumsum(values)))
            return pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64())

        return [batch.column("doc_id"), totals(np.ones_like(got)), totals(np.abs(got)), totals(got < 0)]

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        row_results(count, ["doc_id", "n_words", "n_tokens", "n_unknown"]),
        "doc_id long, n_words long, n_tokens long, n_unknown long")
