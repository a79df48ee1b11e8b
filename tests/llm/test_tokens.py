"""Encoding, decoding and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seasonmart.llm import bpe, common, pieces, token_files
from seasonmart.llm.token_files import LibraryEncoder, WaveletMatrix, read_tokens, token_index, write_tokens
from tests.llm.conftest import ODD_ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Vocabulary(bpe.read_definition(PATH))
PIECEWISE = LibraryEncoder(bpe.read_definition(PATH))
PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "'s", "'LL", "é", "1", "²", "!", " ", "\x1c", "\x85", "日", "😀",
    "‍", "　", "<|endoftext|>", "<|", "the", " end.", "aaaa",
]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=25).map("".join))
def test_ids_and_decoded_text_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = library_ids(text)
    (packed,) = OWN.encode([text])
    assert bpe.ids_of(packed) == ids
    assert OWN.decode([packed]) == [LIBRARY.decode(ids, skip_special_tokens=False)]
    assert bpe.ids_of(PIECEWISE.encode([text])[0]) == ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=12).map("".join), max_size=9))
def test_batches_equal_single_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [bpe.ids_of(p) for p in OWN.encode(texts)] == [library_ids(t) for t in texts]
    assert OWN.decode(OWN.encode(texts)) == [LIBRARY.decode(library_ids(t), skip_special_tokens=False) for t in texts]


def test_rows_of_parts_and_the_heap_give_equal_ids(monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choice("abeinorst") for _ in range(rng.randint(0, 96))).encode() for _ in range(400)]
    words += ["日本語".encode(), b"\xff\x00", "é".encode() * 40, b"a" * 96]
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 50)
    assert [bpe.ids_of(p) for p in OWN.word_ids(words)] == [OWN._heap(w) for w in words]
    long = b"ab" * 60
    assert bpe.ids_of(OWN.word_ids([b"a", long, b""])[1]) == OWN._heap(long)
    assert OWN.decode(OWN.encode(["ab" * 50_000])) == ["ab" * 50_000]


def test_a_large_batch_is_handled_in_parts():
    """What a worker holds, and sends back at once, depends on a part's bytes, not on the batch's."""
    texts = ["", None, "x" * 40_000, None, *[f"{i} " * 3_000 for i in range(200)], "y" * (2 * bpe.PART_BYTES), "end"]
    batch = pa.RecordBatch.from_pydict({"n": range(len(texts)), "text": texts})
    held, found = [], []

    def encoded(some):
        held.append(sum(map(len, some)))
        return OWN.encode(some)

    steps = bpe._mapped(bpe._parts(iter([batch, batch.slice(0, 0)]), "text"), "text", encoded, "ids", pa.binary())
    for part in bpe._mapped(steps, "ids", OWN.decode, "decoded", pa.string()):
        found += part.to_pylist()
    assert [r["n"] for r in found] == [*range(len(texts))] and [r["decoded"] for r in found] == texts
    assert sorted(held)[-2] <= bpe.PART_BYTES < held[-2] and len(held) > 4


def test_decoding_broken_bytes():
    half = OWN.byte_ids[0xE6]
    packed = bpe.packed_ids([half, OWN.byte_ids[65]])
    assert OWN.decode([packed, b"", packed]) == [
        LIBRARY.decode([half, OWN.byte_ids[65]], skip_special_tokens=False), "",
        LIBRARY.decode([half, OWN.byte_ids[65]], skip_special_tokens=False),
    ]


def test_known_pieces_are_bounded_by_bytes_and_keep_frequent_ones():
    asked = []

    def upper(pieces):
        asked.extend(pieces)
        return [p.upper().encode() for p in pieces]

    known = pieces.KnownPieces(upper, table_bytes=10 * (pieces.ENTRY_BYTES + 10))
    for n in range(100):
        found = known.all_of(["often", f"word{n}", f"word{n}"])
        assert found["often"] == b"OFTEN" and found[f"word{n}"] == f"WORD{n}".encode()
        assert len(known.young) + len(known.old) <= 24
    assert asked.count("often") == 1 and asked.count("word5") == 1
    assert known.all_of(["y" * 100])["y" * 100] == b"Y" * 100
    known.drop_long(["y" * 100])
    assert "y" * 100 not in known.young


def test_many_rows_without_an_id_are_several_ranges(documents, spark, tmp_path):
    docs = documents([(None, f"text {i} " * 20) for i in range(3000)] + [(7, f"other {i}") for i in range(3000)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_tokens(docs, PATH, str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [len(r.doc_ids) for r in spark.read.parquet(str(tmp_path / "hot")).collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2500


def test_digests(documents):
    found = bpe.token_digests(documents(ODD_ROWS), PATH).collect()
    texts = sorted((i is None, i or 0, t or "") for i, t in ODD_ROWS)
    rows = []
    for missing, i, t in texts:
        ids = library_ids(t)
        packed = np.array(ids, "<u4").tobytes()
        rows.append((
            None if missing else i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(t.encode()).hexdigest(),
        ))
    assert sorted(map(tuple, found), key=str) == sorted(rows, key=str)


def test_columns_stay(documents):
    docs = documents(ODD_ROWS)
    both = bpe.decode(bpe.encode(docs, PATH), PATH, ids="_ids")
    assert both.columns == [*docs.columns, "_ids", "_decoded"]
    assert all(r.text == r._decoded for r in both.collect())
    assert bpe.encode_and_decode(documents([]), PATH).collect() == []


@pytest.mark.parametrize("length", [0, 1, 2, 9, 4096, 10_000])
def test_wavelet_matrix(length):
    rng = np.random.default_rng(length)
    numbers = np.minimum(rng.zipf(1.3, length), 50_256).astype(np.uint16)
    found = WaveletMatrix(WaveletMatrix.pack(numbers))
    assert (found.numbers() == numbers).all() and len(found.numbers()) == length
    for at in map(int, rng.integers(0, length, 40) if length else []):
        number = int(numbers[at])
        places = np.flatnonzero(numbers == number)
        assert found.access(at) == number
        assert found.count(number) == len(places) and found.count(number, at) == (places < at).sum()
        nth = int(rng.integers(0, len(places)))
        assert found.find(number, nth) == places[nth]
    assert found.count(1 << 20) == 0
    with pytest.raises(IndexError):
        found.access(length)
    with pytest.raises(IndexError):
        found.find(1, length + 1)
    with pytest.raises(ValueError):
        WaveletMatrix(b"nothing of the kind")


def test_lookups_unpack_their_blocks_only(monkeypatch):
    """Of a file of several blocks a plane, an access needs one block of each plane, other lookups two."""
    monkeypatch.setattr(token_files, "BLOCK_BITS", 1 << 13)
    rng = np.random.default_rng(3)
    numbers = np.minimum(rng.zipf(1.2, 200_000), 50_256).astype(np.uint16)
    data = WaveletMatrix.pack(numbers)
    planes = 16

    def unpacked(matrix):
        return [len(p.unpacked) for p in matrix.planes]

    for at in map(int, rng.integers(0, len(numbers), 5)):
        matrix = WaveletMatrix(data)
        assert matrix.access(at) == numbers[at] and unpacked(matrix) == [1] * planes
        number = int(numbers[at])
        matrix = WaveletMatrix(data)
        assert matrix.count(number, at) == (numbers[:at] == number).sum() and max(unpacked(matrix)) <= 2
        matrix = WaveletMatrix(data)
        nth = int((numbers[:at] == number).sum())
        assert matrix.find(number, nth) == at and max(unpacked(matrix)) <= 3
    matrix = WaveletMatrix(data)
    assert (matrix.numbers() == numbers).all() and min(unpacked(matrix)) == 25


def test_wide_numbers():
    numbers = np.array([70_000, 3, 70_000, 1 << 20], np.uint32)
    assert (WaveletMatrix(WaveletMatrix.pack(numbers)).numbers() == numbers).all()


def test_files_in_order_of_ids(documents, prose, spark, tmp_path):
    rows = [(i * 7 % 200, prose(30)) for i in range(200)] + [(300, None), (301, "a <|endoftext|> b")]
    docs = documents(rows).repartition(5)
    write_tokens(docs, PATH, str(tmp_path / "shards"), shard_tokens=1000)
    shards = spark.read.parquet(str(tmp_path / "shards"))
    assert shards.count() > 10
    found = sorted(read_tokens(shards).collect())
    start = 0
    for (doc_id, text), r in zip(sorted(rows), found, strict=True):
        ids = [*library_ids(text or ""), token_files.END_ID]
        assert (r.doc_id, r.start, r.n_tokens, bpe.ids_of(r.ids)) == (doc_id, start, len(ids), ids)
        start += len(ids)
    index = sorted(token_index(docs, PATH).collect())
    assert [r.ids_crc32 for r in index] == [zlib.crc32(r.ids) for r in found]


def test_files_of_odd_rows(documents):
    found = token_index(documents(ODD_ROWS), PATH).orderBy("start").collect()
    assert len(found) == len(ODD_ROWS)
    assert [r.doc_id for r in found] == sorted((i for i, _ in ODD_ROWS), key=lambda i: (i is not None, i))
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:n]) for n in range(len(found))]
    assert token_index(documents([]), PATH).agg(F.count("*")).first()[0] == 0


class Counted:
    """The library, and how many texts it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_pieces_go_to_the_library_in_lines(monkeypatch):
    encoder = LibraryEncoder(bpe.read_definition(PATH))
    encoder.tokenizer = Counted(encoder.tokenizer)
    odd = [chr(c) for c in range(0x3100) if chr(c).strip() == "" or c % 97 == 0] + ["<|", "endoftext|>", "x" * 300]
    texts = ["a " + " ".join(f"new{i}{c}{i} {c}b b{c} {c}" for i, c in enumerate(odd)), "other " * 20 + "\n", ""]
    expected = [library_ids(t) for t in texts]
    assert [bpe.ids_of(p) for p in encoder.encode(texts)] == expected
    assert encoder.tokenizer.texts < 60  # one per text and per LINE_PIECES new pieces, and a few that end in white space
    assert [bpe.ids_of(p) for p in encoder.encode(texts)] == expected
    # Where the ends of tokens do not tell pieces apart, each goes alone.
    apart = LibraryEncoder(bpe.read_definition(PATH))
    monkeypatch.setattr(apart, "sizes", np.zeros_like(apart.sizes))
    assert [bpe.ids_of(p) for p in apart.encode(texts)] == expected


class Asked:
    """A model that writes down what it is asked."""

    def __init__(self, model):
        self.model, self.words = model, []

    def tokenize(self, word):
        self.words.append(word)
        return self.model.tokenize(word)


def test_different_pieces_are_looked_up_and_different_words_encoded_once(monkeypatch):
    encoder = LibraryEncoder(bpe.read_definition(PATH))
    encoder.model = Asked(encoder.model)
    looked_up, values_of = [], encoder.known.values_of
    monkeypatch.setattr(encoder.known, "values_of", lambda names, **how: looked_up.append(len(names)) or values_of(names, **how))
    texts = [f"Straße zulimi zulimi. zulimi!! größer,\nzulimi zulimi's don't {i % 7}" for i in range(500)]
    assert [bpe.ids_of(p) for p in encoder.encode(texts)] == [library_ids(t) for t in texts]
    assert sum(looked_up) == 13  # of 4000 behind a space
    assert len(encoder.model.words) == len(set(encoder.model.words)) + 1 == 10  # the empty one again for first pieces


def test_known_columns_are_bounded_by_bytes_and_keep_frequent_pieces():
    asked = []

    def upper(pieces):
        asked.extend(pieces.to_pylist())
        return pa.array([p.upper().encode() for p in pieces.to_pylist()], pa.large_binary())

    known = token_files.KnownColumn(upper, table_bytes=600)
    for n in range(200):
        names = ["often", f"word{n}", f"other{n}", f"word{max(n - 1, 0)}x", "y" * 60]
        found = known.values_of(pa.array(names, pa.large_string()))
        assert found.to_pylist() == [name.upper().encode() for name in names]
        assert sum(column.nbytes for column in known.young) <= 600 and len(set(known.young[0].to_pylist())) == len(known.young[0])
        assert "y" * 60 not in known.young[0].to_pylist()
    assert asked.count("often") == 1 and asked.count("word5") == 1 and asked.count("y" * 60) == 200
    known.forget()
    assert known.values_of(pa.array([], pa.large_string())).to_pylist() == []


def test_texts_of_several_batches_are_encoded_together(monkeypatch):
    """A piece is looked up once in a group of texts, so groups hold more than a batch of Spark's."""
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i, None], "text": ["x" * 1000, ""]}) for i in range(10)]
    monkeypatch.setattr(token_files, "CHARS_AT_ONCE", 3 * batches[0].nbytes)
    found = list(token_files._gathered(iter(batches)))
    assert [len(texts) for _, texts in found] == [6, 6, 6, 2]
    assert [i for given, _ in found for i in given] == [x for i in range(10) for x in (i, None)]


def test_many_new_words_go_to_the_library_together(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abelnorstuÀéßɏ") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    texts = [" ".join(f"{w}{rng.choice(['', '', ',', '.', '!!', '.\n' + w])}" for w in rng.sample(words, 400)) for _ in range(20)]
    texts += ["one\0two \0 three\0 four", "\0", "Word\0", *words[:5], ""]
    expected = [library_ids(t) for t in texts]
    encoder = LibraryEncoder(bpe.read_definition(PATH))
    encoder.model = Asked(encoder.model)
    assert [bpe.ids_of(p) for p in encoder.encode(texts)] == expected
    assert len(encoder.model.words) <= token_files.FEW_WORDS  # those of the first pieces
    # Where the ends of tokens do not tell words apart, the model is asked for each.
    apart = LibraryEncoder(bpe.read_definition(PATH))
    monkeypatch.setattr(apart, "sizes", np.ones_like(apart.sizes))
    assert [bpe.ids_of(p) for p in apart.encode(texts)] == expected


@pytest.mark.parametrize("space", [chr(c) for c in range(0x3001) if chr(c).isspace()])
def test_spaces_beside_others_are_not_cut(space):
    texts = [f"one{a}two.{b}\nthree" for a in (f" {space}", f"{space} ", space * 2, space) for b in (" ", "", space)]
    texts += [f"{space}a", f"a{space}", f" {space} ", "plain words"]
    assert [bpe.ids_of(p) for p in PIECEWISE.encode(texts)] == [library_ids(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["ab", "É", "ɏ", "×", "ª", "'", "'s", "'ll", ".", "!!", "$", "\n", " ", " ", "1", "日", "_"]), max_size=16).map("".join))
def test_words_with_marks_equal_the_library(text):
    assert bpe.ids_of(PIECEWISE.encode([text])[0]) == library_ids(text)
    assert bpe.ids_of(PIECEWISE.encode([f"x {text}"])[0]) == library_ids(f"x {text}")


def test_a_task_leaves_no_known_pieces_and_no_held_tables():
    held_before = common._held
    try:
        vocabulary = common.held("a vocabulary", lambda: bpe.Vocabulary(bpe.read_definition(PATH)))
        batch = pa.RecordBatch.from_pydict({"text": ["some new words " * 3]})
        seen = []

        def run(batches, known=vocabulary.spaced.known):
            try:
                for b in batches:
                    seen.append(vocabulary.encode(b.column("text").to_pylist()))
                    yield b
            finally:
                known.forget()

        assert len(list(common.frugal(run, keep=True)(iter([batch] * 3)))) == 3
        assert seen and not vocabulary.spaced.known.young and common._held[1] is vocabulary
        assert len(list(common.frugal(run)(iter([batch])))) == 1
        assert common._held == (None, None)
    finally:
        common._held = held_before
