"""Token ids from the ``tokenizers`` library, with words remembered between texts."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered per worker process; beyond it the store starts anew.
REMEMBERED = 800_000

#: A space that no word follows.
_ODD_SPACE = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|\z)"


class Encoder:
    """Ids of whole texts.

    Both kinds of vocabulary split a text into words before they merge, so a text may be cut
    where no word reaches across and its parts encoded on their own; each distinct part goes
    through the library once. ``spaced`` vocabularies keep a single space with the word behind
    it: a text is cut before its spaces (a text with a space that no word follows goes through
    the library whole). Others drop white space: texts are cut at ASCII white space. Special
    tokens in a text are ordinary text, or with ``marks`` what the library makes of them by
    default: one id each. A text that may hold one then goes through the library whole.
    """

    def __init__(self, path: str, spaced: bool, marks: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not marks
        self.spaced = spaced
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.marks = "|".join(map(re.escape, added)) if marks else ""
        self.known: dict[str, bytes] = {"": b""}
        self.openings: dict[str, bytes] = {"": b""}
        self.id_bytes = np.zeros(self.library.get_vocab_size(), np.int64)
        if spaced:  # a byte-level vocabulary writes each byte as one character
            for piece, i in self.library.get_vocab().items():
                self.id_bytes[i] = len(piece)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and where each text begins (with the
        end of the last one as a further entry). Null is empty."""
        texts = texts.fill_null("")
        marked = pc.match_substring_regex(texts, self.marks, ignore_case=True) if self.marks else None
        if not self.spaced:
            if marked is None or not pc.any(marked).as_py():
                return self._gather([self._cut(pc.ascii_split_whitespace(texts))])
            heads = iter(self._plain(texts.filter(marked).to_pylist()))
            heads = [next(heads) if m else b"" for m in marked.to_pylist()]
            return self._gather([self._heads(heads), self._cut(pc.ascii_split_whitespace(pc.if_else(marked, "", texts)))])
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        odd = odd if marked is None else pc.or_(odd, marked)
        whole = self._plain(texts.filter(odd).to_pylist())
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        firsts = pc.list_element(parts, 0).to_pylist()
        if len(self.openings) > REMEMBERED:
            self.openings = {"": b""}
        fresh = list(set(firsts).difference(self.openings))
        self.openings.update(zip(fresh, self._plain(fresh)))
        heads, whole = [self.openings[f] for f in firsts], iter(whole)
        heads = [next(whole) if o else h for o, h in zip(odd.to_pylist(), heads)]
        return self._gather([self._heads(heads), self._cut(pc.list_slice(parts, 1))])

    def split(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """The ids of each text, with ``end_id`` behind them."""
        ids, edges = self.encode(texts)
        n = len(edges) - 1
        closed = np.full(len(ids) + n, end_id, np.uint32)
        keep = np.ones(len(closed), bool)
        keep[edges[1:] + np.arange(n)] = False
        closed[keep] = ids
        return np.split(closed, (edges[1:] + np.arange(1, n + 1))[:-1]) if n else []

    @staticmethod
    def _heads(heads: list[bytes]):
        """As ``_cut``, for one part of given ids in each text."""
        sizes = np.fromiter(map(len, heads), np.int64, len(heads)) // 4
        return np.frombuffer(b"".join(heads), "<u4"), sizes, np.arange(len(heads)), np.arange(len(heads) + 1)

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(got.ids, "<u4").tobytes()
                for got in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, parts: pa.ListArray):
        """Ids of the distinct parts, their numbers, each part's place among them, edges of texts."""
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known = {"": b""}
        self._learn([w for w in words if w not in self.known])
        data = [self.known[w] for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
        edges = np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))))
        return (np.frombuffer(b"".join(data), "<u4"), sizes,
                coded.indices.to_numpy(zero_copy_only=False), edges.astype(np.int64))

    @staticmethod
    def _gather(sources) -> tuple[np.ndarray, np.ndarray]:
        """Lay the parts of each text out, the sources of a text one after another."""
        n = len(sources[0][3]) - 1
        runs = []
        for data, sizes, at, edges in sources:
            lengths = sizes[at]
            ends = np.concatenate(([0], np.cumsum(lengths)))
            begins = (np.cumsum(sizes) - sizes)[at]
            ids = data[np.repeat(begins - ends[:-1], lengths) + np.arange(ends[-1])]
            runs.append((ids, ends[edges]))
        if len(runs) == 1:
            return runs[0]
        sizes = sum(np.diff(e) for _, e in runs)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        out, offset = np.zeros(edges[-1], np.uint32), edges[:-1].copy()
        for ids, e in runs:
            lengths = np.diff(e)
            out[np.repeat(offset - e[:-1], lengths) + np.arange(len(ids))] = ids
            offset += lengths
        return out, edges if n else np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many in one text, and take the ids apart again."""
        runs = [words[i:i + 256] for i in range(0, len(words), 256)]
        joint = [(" " if self.spaced else "") + " ".join(r) for r in runs]
        encode = self.library.encode_batch_fast if self.spaced else self.library.encode_batch
        for run, got in zip(runs, encode(joint, add_special_tokens=False)):
            ids = np.array(got.ids, "<u4")
            if self.spaced:  # ids cover the bytes of the text one after another
                ends = np.searchsorted(np.cumsum(self.id_bytes[ids]),
                                       np.cumsum([len(w.encode()) + 1 for w in run])) + 1
            else:  # ids start inside their words
                starts = np.fromiter((o[0] for o in got.offsets), np.int64, len(ids))
                ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in run]))
            data, first = ids.tobytes(), 0
            for word, end in zip(run, ends.tolist()):
                self.known[word] = data[4 * first:4 * end]
                first = end


_ENCODERS: dict[tuple[str, bool, bool], Encoder] = {}


def encoder(path: str, spaced: bool, marks: bool = False) -> Encoder:
    """One encoder per worker process, vocabulary and treatment of special tokens."""
    key = (path, spaced, marks)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
