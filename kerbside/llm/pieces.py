"""Encoding and decoding with a sentence-piece model as a streaming trellis.

At each position the trellis holds the piece that ends the best segmentation up to there (its
backpointer). A window of the longest piece's length is kept; what all surviving paths share is
committed as soon as they meet in one boundary.

Which piece survives depends on the kind of model. A unigram model keeps the path with the
largest sum of scores. In a merging model the segmentation of every prefix is unique, and a
piece survives if it may stand behind the path's last piece, that is if merging the two strings
on their own would give back exactly these two pieces; pairs are remembered.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from ctypes import c_float

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import row_results
from kerbside.llm.encoding import Encoder

SPACE = "▁"
REMEMBERED = 1_000_000
#: Texts whose spaces need care: doubled, at an end, or the mark itself; empty ones too.
_ODD_SPACE = f"  |^ | $|{SPACE}|^$"
_NEVER = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a serialized protocol message."""
    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


def _merges(model: bytes) -> bool:
    """Whether a serialized model is a merging (BPE) one; False for unigram models."""
    # Fixed values of the format: field 2 holds the trainer's settings, whose field 3 is the kind
    # (1 unigram, the default; 2 merging), field 3 the normaliser's: 2 rewriting rules, 3 a space in
    # front, 4 white space removed, 5 spaces escaped (all three on by default).
    kind, rules, flags = 1, b"", {3: 1, 4: 1, 5: 1}
    for part, value in _fields(model):
        if part == 2:
            kind = next((v for f, v in _fields(value) if f == 3), kind)
        elif part == 3:
            settings = dict(_fields(value))
            rules = settings.get(2, rules)
            flags |= {f: settings[f] for f in flags if f in settings}
    if kind not in (1, 2):
        raise ValueError("only unigram and merging models are supported")
    if rules or flags != {3: 1, 4: 0, 5: 1}:
        raise ValueError("the model rewrites its text before it is cut; that is not supported")
    return kind == 2


class Model:
    """Pieces and settings of a model; ``scores`` decide between segmentations."""

    def __init__(self, pieces: dict[str, tuple[int, float]], merging: bool,
                 byte_ids: list[int] | None = None, unknown: int = 0):
        self.pieces, self.merging = pieces, merging
        self.byte_ids, self.unknown = byte_ids, unknown
        self.longest = max(map(len, pieces), default=1)
        self.lengths = sorted({len(p) for p in pieces} | {1})
        self.names = {i: p for p, (i, _) in pieces.items()}
        self.bytes_of = {i: b for b, i in enumerate(byte_ids or [])}
        self.rank = {p: -score for p, (_, score) in pieces.items()}.get
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}
        # Paths always meet before a space if no piece has one behind another character.
        self.meets_at_space = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.floor = min((s for _, s in pieces.values()), default=0.0) - 10.0

    @classmethod
    def load(cls, path: str) -> Model:
        """The model of a file, unigram or merging as the file says. Other kinds, and models that
        rewrite their text first (or treat spaces otherwise than is done here), are refused."""
        import sentencepiece

        with open(path, "rb") as f:
            merging = _merges(f.read())
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, []
        for i in range(library.get_piece_size()):
            if library.is_byte(i):
                byte_ids.append(i)
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                pieces[library.id_to_piece(i)] = (i, library.get_score(i))
        return cls(pieces, merging=merging, byte_ids=byte_ids or None, unknown=library.unk_id())

    def merged(self, text: str) -> list[str]:
        """Merge a short string: the best-scored neighbouring pair first, leftmost among equals."""
        parts, rank = list(text), self.rank
        joint = [rank(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while joint and (best := min(joint)) != _NEVER:
            i = joint.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del joint[i]
            if i:
                joint[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
            if i < len(joint):
                joint[i] = rank(parts[i] + parts[i + 1], _NEVER)
        return parts

    def may_follow(self, left: str, right: str) -> bool:
        pair = (left, right)
        got = self.pairs.get(pair)
        if got is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            whole = self.merged(left + right)
            got = whole == ([left, right] if left else [right])
            self.pairs[pair] = got
        return got

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.pieces:
            return [self.pieces[piece][0]]
        if self.byte_ids:
            return [self.byte_ids[b] for b in piece.encode()]
        return [self.unknown]


class Trellis:
    """Takes text bit by bit; ``push`` and ``finish`` return the pieces committed so far.

    ``held`` is the text behind the last committed boundary. Each of its positions knows the
    length of the piece that ends there on the surviving path.
    """

    def __init__(self, model: Model):
        self.model = model
        self.held, self.back, self.score = "", [0], [0.0]
        self.last = ""

    def push(self, text: str) -> list[str]:
        out: list[str] = []
        window = 2 * self.model.longest
        for start in range(0, len(text), window):
            self._extend(text[start:start + window])
            if len(self.held) >= window:
                out += self._commit()
        return out

    def _extend(self, text: str) -> None:
        model, back = self.model, self.back
        begin = len(self.held)
        self.held = held = self.held + text
        pieces, lengths = model.pieces, model.lengths
        if model.merging:
            pairs, last = model.pairs, self.last
            for end in range(begin + 1, len(held) + 1):
                for n in lengths:
                    start = end - n
                    if start < 0:
                        back.append(0)
                        break
                    piece = held[start:end]
                    if n > 1 and piece not in pieces or start and not back[start]:
                        continue
                    pair = (held[start - back[start]:start] if start else last, piece)
                    if pairs[pair] if pair in pairs else model.may_follow(*pair):
                        back.append(n)
                        break
                else:
                    back.append(0)
            return
        score = self.score
        for end in range(begin + 1, len(held) + 1):
            best, best_score = 0, float("-inf")
            for n in reversed(lengths):  # of equal sums, the longer last piece stays
                start = end - n
                if start < 0 or start and not back[start]:
                    continue
                found = pieces.get(held[start:end])
                if found is None and n > 1:
                    continue
                # In single precision, as these models are made and used.
                total = c_float(score[start] + (found[1] if found else model.floor)).value
                if total > best_score:
                    best, best_score = n, total
            back.append(best)
            score.append(best_score)

    def _path(self, end: int) -> list[int]:
        """Boundaries of the path that ends here, from the start on."""
        found = []
        while end:
            found.append(end)
            end -= self.back[end]
        return found[::-1]

    def _commit(self) -> list[str]:
        """Pieces before the last boundary that all paths still open have in common."""
        end = len(self.held)
        open_ends = [e for e in range(end, max(end - self.model.longest, 0), -1) if self.back[e]]
        common = set(self._path(open_ends[0]))
        for e in open_ends[1:]:
            common &= set(self._path(e))
        return self._cut(max(common)) if common else []

    def _cut(self, boundary: int) -> list[str]:
        marks = [0, *self._path(boundary)]
        out = [self.held[a:b] for a, b in zip(marks, marks[1:])]
        if out:
            self.last = out[-1]
            self.held = self.held[boundary:]
            self.back = [0, *self.back[boundary + 1:]]
            if not self.model.merging:
                self.score = self.score[boundary:]
        return out

    def finish(self) -> list[str]:
        held = self.held
        marks = [0, *self._path(len(held))]
        self.held, self.back, self.score, self.last = "", [0], [0.0], ""
        return [held[a:b] for a, b in zip(marks, marks[1:])]


def segments(model: Model, chunks: Iterable[str]) -> Iterator[str]:
    """Pieces of a text that arrives in chunks."""
    trellis = Trellis(model)
    for chunk in chunks:
        yield from trellis.push(chunk)
    yield from trellis.finish()


def _within_window(model: Model, word: str) -> list[str]:
    """Pieces of a word that fits into one window of a merging model: nothing is committed
    before its end, so the trellis is just the piece that ends at each position."""
    pieces, pairs, lengths = model.pieces, model.pairs, model.lengths
    ending = [""]
    for end in range(1, len(word) + 1):
        for n in lengths:
            piece = word[end - n:end]
            if n > 1 and piece not in pieces:
                continue
            pair = (ending[end - n], piece)
            fits = pairs.get(pair)
            if model.may_follow(*pair) if fits is None else fits:
                break
        ending.append(piece)
    found, end = [], len(word)
    while end:
        found.append(ending[end])
        end -= len(ending[end])
    return found[::-1]


def _word(model: Model, word: str) -> bytes:
    ids = []
    short = model.merging and len(word) < 2 * model.longest
    for piece in _within_window(model, word) if short else segments(model, [word]):
        found = model.pieces.get(piece)
        ids += [found[0]] if found else model.ids_of(piece)
    return array("I", ids).tobytes()


def encode(model: Model, text: str) -> np.ndarray:
    """Ids of a text; spaces are written as ``SPACE`` and one more stands in front.

    Where paths always meet before a space, each word has a trellis of its own; otherwise the
    text is one stream.
    """
    if not text:
        return np.zeros(0, np.uint32)
    marked = (SPACE + text).replace(" ", SPACE)
    if not model.meets_at_space:
        return np.frombuffer(_word(model, marked), "<u4")
    # A space that opens a run of spaces belongs with the run, so cut before runs only.
    words, run = [], ""
    for part in marked.split(SPACE)[1:]:
        run += SPACE
        if part:
            words.append(run + part)
            run = ""
    if run:
        words.append(run)
    out = [_word(model, word) for word in words]
    return np.frombuffer(b"".join(out), "<u4")


def decode(model: Model, ids: Iterable[int]) -> str:
    """Text of ids: byte pieces are joined to characters, the space in front is dropped."""
    parts: list[bytes] = []
    for i in ids:
        if i in model.bytes_of:
            parts.append(bytes([model.bytes_of[i]]))
        else:
            parts.append(model.names.get(i, "").encode())
    return b"".join(parts).decode("utf-8", "replace").replace(SPACE, " ")[1:]


def encode_many(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts one after another, where each text begins (and the end of the last),
    code points of the decoded texts, and whether they equal the texts.

    Distinct words go through the trellis, and their ids through the decoder, once; no piece
    reaches across words, so the parts may be laid out side by side. Texts with odd spaces go
    whole.
    """
    odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
    odd = odd if model.meets_at_space else np.ones(len(texts), bool)
    parts = pc.split_pattern(pc.if_else(pa.array(odd, pa.bool_()), "", texts), " ")
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    if len(model.words) > REMEMBERED:
        model.words.clear()
        model.changed.clear()
    known = model.words
    for word in words:
        if word not in known:
            known[word] = ids = _word(model, SPACE + word)
            back = decode(model, np.frombuffer(ids, "<u4").tolist())
            if back != word:
                model.changed[word] = back
    data = [known[w] for w in words]
    sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
    changed = np.array([w in model.changed for w in words], bool)
    points = np.array([len(model.changed.get(w, w)) for w in words], np.int64)
    at = coded.indices.to_numpy(zero_copy_only=False)
    edges = np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))))
    ids, begins = Encoder._gather([(np.frombuffer(b"".join(data), "<u4"), sizes, at, edges.astype(np.int64))])

    def per_text(values: np.ndarray) -> np.ndarray:
        ends = np.concatenate(([0], np.cumsum(values[at])))
        return ends[edges[1:]] - ends[edges[:-1]]

    decoded = per_text(points) + np.diff(edges) - 1  # one space between words
    same = per_text(changed.astype(np.int64)) == 0
    if odd.any():
        pieces = np.split(ids, begins[1:-1])
        for i in np.flatnonzero(odd):
            text = texts[int(i)].as_py()
            pieces[i] = encode(model, text)
            back = decode(model, pieces[i].tolist())
            decoded[i], same[i] = len(back), back == text
        begins = np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
        ids = np.concatenate(pieces)
    return ids, begins, decoded, same


_MODELS: dict[str, Model] = {}


def _model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model.load(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, n_decoded, round_trip`` for each row of ``(doc_id, text)``.

    ``n_decoded`` is the number of code points of the decoded text and ``round_trip`` tells
    whether it equals the text (it can't where the text itself holds the space mark). A null
    text is empty and has no ids. Rows are handled one by one, so repeated and null doc_ids stay
    as they are. ``with_ids`` adds the ids as ``array<int>``.
    """
    def body(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, begins, decoded, same = encode_many(_model(path), batch.column("text").fill_null(""))
        own = np.split(ids, begins[1:-1]) if batch.num_rows else []
        return [batch.column("doc_id"), pa.array(np.diff(begins)),
                pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()), pa.array(decoded),
                pa.array(same), *([pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))] * with_ids)]

    names = ["doc_id", "n_tokens", "ids_crc32", "n_decoded", "round_trip"] + ["ids"] * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        row_results(body, names, 1024),
        "doc_id long, n_tokens long, ids_crc32 long, n_decoded long, round_trip boolean"
        + (", ids array<int>" if with_ids else ""))
