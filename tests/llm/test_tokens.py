"""Packing, token files and byte-pair encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import itertools
import tracemalloc
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from turnmill.llm import bpe, packing, queries, token_files, tokens
from turnmill.llm.common import worker_store
from turnmill.llm.tokens import WordEncoder

from .conftest import FOLDER, ODD

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = [t or "" for t in ODD]


@lru_cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def library_ids(path: str, text: str | None) -> np.ndarray:
    return np.array(library(path).encode(text or "", add_special_tokens=False).ids, dtype="<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder(path):
    encoder = WordEncoder(path)
    assert encoder.encode(TEXTS) == [library_ids(path, t).tobytes() for t in TEXTS]


@pytest.mark.parametrize("chars", [1, 50, 100_000])
def test_word_encoder_in_slices(monkeypatch, chars):
    monkeypatch.setattr(tokens, "ENCODE_CHARS", chars)
    assert WordEncoder(WORD).encode(TEXTS) == [library_ids(WORD, t).tobytes() for t in TEXTS]
    assert WordEncoder(WORD).encode([]) == []


def test_worker_keeps_one_store():
    first = worker_store("test-a")
    first["x"] = 1
    assert worker_store("test-a") is first
    assert worker_store("test-b") == {}
    assert worker_store("test-a") == {}


def test_rank_bpe():
    coder = bpe.RankBPE(WORD)
    for text, got in zip(TEXTS, coder.encode(TEXTS), strict=True):
        ids = library_ids(WORD, text)
        assert got == ids.tobytes(), text[:50]
        assert coder.decode(got) == library(WORD).decode(ids.tolist(), skip_special_tokens=False)


def test_blocks():
    rng = np.random.default_rng(0)
    for n in (1, 255, 256, 257, 10_000):
        for high in (1, 2, 300, 50_257, 2**32 - 1):
            ids = rng.integers(0, high, n, dtype=np.uint32)
            ids[rng.random(n) < 0.05] = high - 1
            for share in (0.5, 0.9, 1.0):
                data, starts = token_files.encode_blocks(ids, share)
                assert (token_files.decode_blocks(data, starts)[:n] == ids).all()


@pytest.mark.parametrize("lengths", [[], [1], [3000], [5000] * 3, [4096, 8192, 512], [*range(1, 6000, 7)]])
def test_plan(lengths):
    sequences, parts = packing.plan(lengths), defaultdict(list)
    for context, pieces in sequences:
        assert sum(p[2] for p in pieces) == context <= 4096 and context & (context - 1) == 0
        for doc, start, length in pieces:
            parts[doc].append((start, length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(parts[doc]):
            assert start == at
            at += length
        assert at == n
    assert len(packing.step_groups(sequences)) == len(sequences)


def check_pieces(rows, texts_by_id):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in texts_by_id.items():
        ids = np.append(library_ids(WORD, text), 2).astype("<u4")
        at = 0
        for r in sorted(by_doc.pop(doc), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0


def test_op1(spark):
    docs = {r.doc_id: r.text for r in queries.documents(spark, FOLDER).collect()}
    check_pieces(queries.op1_packing(spark, FOLDER).collect(), docs)


def test_pack_odd(spark, odd, empty):
    rows = packing.pack(odd.where("doc_id <> 5"), WORD).collect()
    for r in rows:
        ids = np.append(library_ids(WORD, ODD[r.doc_id]), 2).astype("<u4")
        assert bytes(r.ids) == ids[r.start : r.start + r.length].tobytes()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1
    assert packing.pack(empty, WORD).collect() == []


def check_files(rows, docs):
    start = 0
    assert len(rows) == len(docs)
    for r, (doc, text) in zip(sorted(rows, key=lambda r: r.start), docs, strict=True):
        ids = np.append(library_ids(BYTE, text), 2).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens) == (doc, start, len(ids))
        assert bytes(r.ids) == ids.tobytes() if "ids" in r else r.ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_op4(spark):
    docs = sorted((r.doc_id, r.text) for r in queries.documents(spark, FOLDER).collect())
    check_files(queries.op4_token_files(spark, FOLDER).collect(), docs)


def test_token_files_odd(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 1024)
    monkeypatch.setattr(token_files, "FILE_IDS", 300)
    monkeypatch.setattr(token_files, "ENCODE_ROWS", 3)
    manifest = token_files.write_token_files(odd, BYTE)
    rows = token_files.read_token_files(manifest).collect()
    assert manifest.count() > 1
    docs = [(None, ODD[3]), *[(i, t) for i, t in enumerate(ODD) if i != 3]]
    docs.insert(6, docs[5])  # the row that comes twice
    check_files(rows, docs)
    assert token_files.read_token_files(token_files.write_token_files(empty, BYTE)).collect() == []


def test_op8(spark):
    docs = {r.doc_id: r.text for r in queries.documents(spark, FOLDER).collect()}
    rows = queries.op8_rank_bpe(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library_ids(WORD, docs[r.doc_id])
        decoded = library(WORD).decode(ids.tolist(), skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_odd(spark, odd, empty):
    rows = bpe.encode_decode(odd, WORD).collect()
    assert len(rows) == len(ODD) + 1 and set(odd.columns) < set(rows[0].asDict())
    for r in rows:
        assert bytes(r.bpe.ids) == library_ids(WORD, r.text).tobytes()
    assert bpe.encode_decode(empty, WORD).collect() == []


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder_forgets(path, monkeypatch):
    """Words and pieces that were forgotten are learned again; the same piece may be met in every generation."""
    monkeypatch.setattr("turnmill.llm.tokens.PIECES", 7)
    monkeypatch.setattr("turnmill.llm.tokens.WORDS", 3)
    encoder = WordEncoder(path)
    rng = np.random.default_rng(5)
    words = ["alpha", "Beta,", "gamma.", "naïve", "x1", "$$$", "日本", "don't", "ALL", "é!"]
    for _ in range(30):
        some = [" ".join(rng.choice(words, 4)) + rng.choice(["", "\n", "  end", "\nnext line"]) for _ in range(3)]
        some += ["", "   ", "a  b"]
        assert encoder.encode(some) == [library_ids(path, t).tobytes() for t in some]
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


def test_files_of_few_documents(spark, monkeypatch):
    """A file is closed after a number of documents too, in the middle of a task."""
    monkeypatch.setattr(token_files, "FILE_DOCS", 3)
    monkeypatch.setattr(token_files, "ENCODE_ROWS", 2)
    rows = [(i, "some words " * (i % 4)) for i in range(11)]
    manifest = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), BYTE)
    assert manifest.count() > 1
    got = token_files.read_token_files(manifest).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(11))
    start = 0
    for r, (_, text) in zip(got, rows, strict=True):
        assert r.start == start and bytes(r.ids) == library_ids(BYTE, text).tobytes() + (2).to_bytes(4, "little")
        start += r.n_tokens


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder_remembers_a_word_once(path):
    """A word that is a piece of its own takes one entry, not one as a piece and one as a word."""
    encoder = WordEncoder(path)
    text = " ".join(["go"] + [a + b + c for a in "abcdefgh" for b in "aeiou" for c in "lmnrst"])
    assert encoder.encode([text]) == [library_ids(path, text).tobytes()]
    held = sum(len(v) for k, v in vars(encoder).items() if isinstance(v, dict) and k != "tails")
    assert held <= 1.05 * len(text.split())


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("space", ["\t", "\r", "\x0b", "\x0c", "\x1c", " ", "\n", "\xa0", " "])
def test_word_encoder_white_space(path, space):
    texts = [space, f"{space}a b", f"a b{space}", f"a{space}b c", f"é{space}ö", f"a {space} b"]
    assert WordEncoder(path).encode(texts) == [library_ids(path, t).tobytes() for t in texts]


def test_word_encoder_of_a_size():
    """An operator may have its encoder remember more than others do; the ids are the same."""
    small, large = WordEncoder(WORD, 50), WordEncoder(WORD, 5_000)
    texts = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)} x" for i in range(200)]
    for i in range(0, 200, 10):
        some = texts[i : i + 10]
        assert small.encode(some) == large.encode(some) == [library_ids(WORD, t).tobytes() for t in some]
    assert len(small.known) + len(small.known_before) < 120 < len(large.known)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder_remembers_a_word_without_points(path):
    """A word with points behind it takes no entry of its own, wherever it stands."""
    encoder = WordEncoder(path)
    text = " ".join(["go", *(w + p for w in ("alpha", "beta", "gamma", "naïve") for p in ("", ".", ",", "?!"))])
    assert encoder.encode([text]) == [library_ids(path, text).tobytes()]
    assert len(encoder.known) + len(encoder.known_before) == 5


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder_memory(path):
    """What is remembered takes less than 100 bytes a word, and nothing else is held."""
    words = ["".join(w) for w in itertools.product("abcdefghijklm", repeat=4)]
    encoder = WordEncoder(path)
    encoder.encode(["warm up"])
    tracemalloc.start()
    try:
        before = pa.total_allocated_bytes()
        for i in range(0, len(words), 5000):
            encoder.encode([" ".join(words[i : i + 5000])])
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert held < 100 * len(words)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder_letters_taken_apart(path):
    """Letters that the tokenizer turns into a letter and a mark, which goes with points behind it."""
    texts = ["a İ. b", "x aİ, c İİ?", "\u0958. \ufb2a, a\u0958!"]
    assert WordEncoder(path).encode(texts) == [library_ids(path, t).tobytes() for t in texts]


def test_memory_of_equal_hashes():
    """Pieces of one hash are told apart."""
    memory = tokens.Memory(10)
    one = np.zeros(1, dtype=np.int64)
    for key in ("a", "b"):
        column = pa.array([key], pa.large_string())
        assert memory.find(column, one).tolist() == [-1]
        memory.add(column, pa.array([key.encode()], pa.large_binary()), one)
    assert memory.ids.take(pa.array(memory.find(pa.array(["a"], pa.large_string()), one))).to_pylist() == [b"a"]


def test_worker_store_gives_memory_back():
    """What a store held goes back to the system, also from below memory that is still in use."""

    def resident() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    store = worker_store("test-large")
    store["x"] = [bytes(2000) for _ in range(50_000)]
    pin = bytes(2000)
    held = resident()
    del store
    assert worker_store("test-next") == {}
    assert held - resident() > 80_000_000 and pin
