"""Token counts, piece trellis, packing and token records against the tokenizer libraries."""

import itertools
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import encoding, packing, pieces, records, token_counts
from kerbside.llm.queries import vocabulary

from helpers import corpus, frame

ODD = ["", " ", "  a  b\n\nc ", "a\x1cb \x1c c", "é́ x\xa0y  z\t", "foo<|endoftext|>bar <|startoftext|> x",
       "it's  we'll\n 's", "\n \n a", "x  y", " ́a", "日本語 😀", "a▁b ▁", "<s></s><0x41>", "=" * 300,
       " " * 50 + "x", "ab" * 3000]


def odd_texts(n=300):
    rng = random.Random(3)
    return ODD + ["".join(rng.choice(" \n\tab'sé́.1\x1c\xa0日") for _ in range(rng.randint(0, 40)))
                  for _ in range(n)] + [t or "" for _, t in corpus()]


@pytest.fixture(scope="module")
def rows():
    return corpus(1) + [(10**7 + i, t) for i, t in enumerate(ODD)] + [(10**8, "word " * 100_000)]


def library(name):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary(name))
    found.encode_special_tokens = True
    return found


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_remembered_words_give_the_same_ids(name, spaced):
    texts = odd_texts()
    want = [e.ids for e in library(name).encode_batch(texts, add_special_tokens=False)]
    code = encoding.Encoder(vocabulary(name), spaced)
    for _ in range(2):
        assert [x.tolist() for x in code.split(pa.array([*texts, None]), 7)] == [*(w + [7] for w in want), [7]]
    assert code.split(pa.array([], pa.string()), 7) == []



MARKED = ["see <|endoftext|> here", "a\n <|endoftext|> b", "<|endoftext|>", " <|endoftext|>  <|startoftext|>x",
          "it's<|endoftext|>'s", "A <|ENDOFTEXT|> b", "x <|endoftext| > y"]


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_marks_give_the_ids_of_the_unmodified_library(name, spaced):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    bits = ["<|endoftext|>", "<|startoftext|>", " ", "\n", "a", "word", "'s", "é", "\xa0", "<|"]
    texts = MARKED + odd_texts() + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 20))) for _ in range(300)]
    plain = Tokenizer.from_file(vocabulary(name))
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    code = encoding.Encoder(vocabulary(name), spaced, marks=True)
    for _ in range(2):
        assert [x.tolist() for x in code.split(pa.array([*texts, None]), 7)] == [*(w + [7] for w in want), [7]]


def test_queries_keep_marks(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from kerbside.llm.queries import QUERIES

    rows = list(enumerate(MARKED))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    def want(name, end):
        plain = Tokenizer.from_file(vocabulary(name))
        ids = [plain.encode(t, add_special_tokens=False).ids + [end] for t in MARKED]
        return [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)]

    records_of = QUERIES["op10_token_records"](spark, str(tmp_path))
    assert sorted(map(tuple, records_of.select("doc_id", "n_tokens", "ids_crc32").collect())) == want("byte_bpe_50k.json", 0)
    for packed in (QUERIES["op2_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, None)):
        got = packed.select("doc_id", "doc_tokens", "ids_crc32").collect()
        assert sorted(map(tuple, got)) == want("word_bpe_49k.json", 2)


def test_checksums():
    # Known value of the checksum of nine digits.
    assert records.masked_checksums([b"123456789"])[0] == ((0xE3069283 >> 15 | 0xE3069283 << 17)
                                                          + records.MASK_DELTA) & 0xFFFFFFFF
    data = [random.Random(i).randbytes(n) for i, n in enumerate([4, 5, 8, 63, 64, 65, 128, 9000])]
    joined = records.frames(data)
    offsets = np.cumsum([0] + [len(f) for f in joined])
    places = [(int(o), len(f)) for o, f in zip(offsets, joined)]
    assert records.unframed(b"".join(joined), places) == data
    broken = bytearray(b"".join(joined))
    broken[places[3][0] + 20] ^= 1
    with pytest.raises(ValueError):
        records.unframed(bytes(broken), places)


def test_records_round_trip(spark, rows):
    code = library("byte_bpe_50k.json")
    order = sorted(rows, key=lambda r: float("inf") if r[0] is None else r[0])
    ids = {i: code.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    manifest = records.write_sequences(frame(spark, rows), vocabulary("byte_bpe_50k.json"), 0, shard_bytes=20_000)
    assert manifest.count() > 3
    got = records.read_sequences(manifest).collect()
    want, start = [], 0
    for i, _ in order:
        want.append((i, start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())))
        start += len(ids[i])
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    index = records.read_index(manifest)
    assert index.count() == len(rows)
    some = index.orderBy("length", ascending=False).limit(9)
    assert all(r["ids"] == ids[r["doc_id"]] for r in records.read_at(some).collect())


def test_packing_covers_every_id_once(spark, rows):
    code = library("word_bpe_49k.json")
    ids = [(i, code.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    got = packing.pack(frame(spark, rows), vocabulary("word_bpe_49k.json"), 2, length=512, with_ids=True).collect()
    sequences = {}
    for r in got:
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for number, held in sequences.items():
        held.sort()
        assert [o for o, _ in held] == [0, *itertools.accumulate(n for _, n in held)][:-1]
        total = sum(n for _, n in held)
        assert total == 512 or number == max(sequences)
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    whole = [[]]
    for _, held in sorted(by_doc.items(), key=str):
        for r in held:
            whole[-1] += r.ids
            if r.start + r.length == r.doc_tokens:
                whole.append([])
    assert sorted(whole[:-1]) == sorted(x for _, x in ids)


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert_key(points, bits)
    assert sorted(keys) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_token_counts(spark, rows):
    from tokenizers import Tokenizer, models

    initial, continuing = token_counts.piece_vocabulary(vocabulary("piece_bpe_32k.model"))
    known = {"[UNK]": 0}
    for piece in [p.decode() for p in initial] + ["##" + p.decode() for p in continuing]:
        known.setdefault(piece, len(known))
    greedy = Tokenizer(models.WordPiece(vocab=known, unk_token="[UNK]", max_input_chars_per_word=10**7,
                                        continuing_subword_prefix="##"))
    want = []
    for i, text in rows:
        found = (text or "").encode().split()
        split = [greedy.encode(w.decode()).tokens for w in found]
        want.append((i, len(found), sum(map(len, split)), sum(s == ["[UNK]"] for s in split)))
    got = token_counts.token_counts(frame(spark, rows), vocabulary("piece_bpe_32k.model"))
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(want, got.schema).collect()))


def test_automaton_by_hand():
    automaton = token_counts.Automaton([b"a", b"abcdx", b"b"], [b"b", b"c", b"cdy", b"dz", b"d"])
    assert [automaton.count(w) for w in (b"abcdz", b"abcdx", b"abcdy", b"q", b"abq", b"a")] == [4, 1, 3, -1, -1, 1]


@pytest.mark.parametrize("at_spaces", [True, False])
def test_trellis_equals_the_library(at_spaces):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Model.load(path)
    own.meets_at_space &= at_spaces
    for text in odd_texts(200):
        ids = pieces.encode(own, text)
        assert ids.tolist() == model.encode(text)
        assert pieces.decode(own, ids) == text.replace("▁", " ")


def test_trellis_of_a_scored_model_and_its_window():
    rng = random.Random(5)
    vocab = {p: (i, -rng.random() * len(p)) for i, p in enumerate(
        {"a", "b", "ab", "ba", "aab", "bba", "abab", "bb"})}
    model = pieces.Model(vocab, merging=False)

    def best(text):
        table = [(0.0, [])] + [(float("-inf"), [])] * len(text)
        for end in range(1, len(text) + 1):
            table[end] = max(((table[s][0] + vocab[text[s:end]][1], table[s][1] + [text[s:end]])
                              for s in range(max(0, end - 4), end) if text[s:end] in vocab), key=lambda x: x[0])
        return table[-1]

    for _ in range(100):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 80)))
        got = list(pieces.segments(model, [text[:7], text[7:9], text[9:]]))
        assert "".join(got) == text
        assert sum(vocab[p][1] for p in got) == pytest.approx(best(text)[0])
    trellis = pieces.Trellis(model)
    committed = sum(len("".join(trellis.push("ab"))) for _ in range(5000))
    assert committed > 9_000 and len(trellis.held) < 1_000


def model_file(path, kind, pieces_, rules=b"", trim=0):
    """A serialized model with the given kind and (piece, score, type) list."""
    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3, value])
        if isinstance(value, float):
            return bytes([number << 3 | 5]) + struct.pack("<f", value)
        return bytes([number << 3 | 2]) + varint(len(value)) + value

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    body = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, t)) for p, s, t in pieces_)
    normaliser = field(1, b"identity") + field(2, rules) + field(3, 1) + field(4, trim)
    path.write_bytes(body + field(2, field(3, kind)) + field(3, normaliser))
    return str(path)


def test_a_unigram_file_is_cut_by_its_scores(spark, tmp_path):
    """The kind is read from the file, and ids are the library's."""
    import sentencepiece

    rng = random.Random(9)
    names = sorted({"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 6))) for _ in range(150)} | set("ab▁"))
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [
        (p, -rng.uniform(1, 3) * (1 + 0.3 * len(p)), 1) for p in names]
    path = model_file(tmp_path / "unigram.model", 1, listed)
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Model.load(path)
    assert not own.merging and pieces.Model.load(vocabulary("piece_bpe_32k.model")).merging
    texts = ["".join(rng.choice("aabb  ") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    for text in texts:
        assert pieces.encode(own, text).tolist() == library.encode(text)
    got = pieces.encode_decode(frame(spark, list(enumerate(texts))), path).collect()
    assert {(r.doc_id, r.n_tokens) for r in got} == {(i, len(library.encode(t))) for i, t in enumerate(texts)}
    assert all(r.round_trip for r in got)


@pytest.mark.parametrize("kind, rules, trim", [(3, b"", 0), (4, b"", 0), (1, b"rewriting", 0), (2, b"", 1)])
def test_models_that_would_be_cut_otherwise_are_refused(tmp_path, kind, rules, trim):
    path = model_file(tmp_path / "m.model", kind, [("<unk>", 0.0, 2), ("a", -1.0, 1)], rules, trim)
    with pytest.raises(ValueError):
        pieces.Model.load(path)


def test_encode_decode(spark, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    got = pieces.encode_decode(frame(spark, rows), vocabulary("piece_bpe_32k.model")).collect()
    want = []
    for i, text in rows:
        ids = model.encode(text or "")
        back = (text or "").replace("▁", " ")
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(back), back == (text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_tables(spark):
    none = frame(spark, [])
    assert token_counts.token_counts(none, vocabulary("piece_bpe_32k.model")).count() == 0
    assert pieces.encode_decode(none, vocabulary("piece_bpe_32k.model")).count() == 0
    assert packing.pack(none, vocabulary("word_bpe_49k.json"), 2).count() == 0
    assert records.read_sequences(records.write_sequences(none, vocabulary("byte_bpe_50k.json"), 0)).count() == 0


def test_text_slices_are_bounded_in_bytes():
    import pyarrow as pa
    from kerbside.llm.common import text_slices
    texts = ["x" * 10, None, "y" * 35, "z" * 100, "", "é" * 10, "w" * 25]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = [part.column("text").to_pylist() for part in text_slices([batch], size=40)]
    assert sum(got, []) == texts and max(map(len, got)) > 1
    assert all(len(part) == 1 or sum(len((t or "").encode()) for t in part) <= 40 for part in got)
