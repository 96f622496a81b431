"""Encoding texts with a given tokenizer file and the tokenizers library, word by word.

A tokenizer that splits at white space gives a word the same ids wherever it stands. A
text is cut before each run of white space; ids of the pieces are remembered by the Python
worker, and only new pieces go to the library, many in one call. Texts for which such cuts
might not hold (special tokens, control characters) go to the library whole. The pieces of
many texts are one Arrow column: each distinct piece is looked up once, and the column of
their ids holds the ids of the texts one after the other.

A piece that is one word of letters, perhaps with points and commas behind it, is put
together from the ids of both, and the word alone is remembered; new words go to the library
as one text with blanks between them, whose ids are parted where words begin (or end, if the
tokenizer marks ends). What is remembered are Arrow columns, found by sorted hashes: a
fraction of the memory that a dict of Python objects takes.
"""

from __future__ import annotations

import os
import re
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from turnmill.llm.common import worker_store

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Pieces, and words, that a worker remembers; at their sum it forgets those that it hasn't met for as many others.
PIECES = 150_000
WORDS = 100_000
#: Texts whose pieces are looked up together, and their characters (a longer text goes alone).
ENCODE_ROWS = 1_000
ENCODE_CHARS = 4_000_000
#: Pieces of one call of the library.
TOGETHER = 2_000

_PIECE = re.compile(r"\s*\S+|\s+")
_CONTROLS = ("<|", "\0", "\x1c", "\x1d", "\x1e", "\x1f")
_ASCII_SPACES = "\t\r\x0b\x0c"
_POINTS = ".,;:!?"
#: Letters whose composed or lower-case form is a letter and a mark.
_UNSTABLE = "[\u0130\u0958-\u095f\u09dc-\u09dd\u09df\u0a33\u0a36\u0a59-\u0a5b\u0a5e\u0b5c-\u0b5d\u0f43\u0f4d\u0f52\u0f57\u0f5c\u0f69\ufb1d\ufb1f\ufb2a-\ufb36\ufb38-\ufb3c\ufb3e\ufb40-\ufb41\ufb43-\ufb44\ufb46-\ufb4e]"
SEPARATOR = "<|endoftext|>"


def _binary(ids: np.ndarray, cuts: np.ndarray) -> pa.LargeBinaryArray:
    """Runs of 32-bit ids as one column of bytes."""
    places = np.ascontiguousarray(cuts, dtype=np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(ids)])


class Memory:
    """Ids of distinct pieces, in columns; two generations, of which the older one is forgotten.

    A piece is found by its hash among sorted ones and then compared, so equal hashes of
    different pieces only cost time.
    """

    def __init__(self, size: int):
        self.size = size
        self.keys = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.met = np.zeros(0, dtype=bool)  # in this generation
        self.hashes = np.zeros(0, dtype=np.int64)
        self.places = np.zeros(0, dtype=np.int32)

    def find(self, keys: pa.LargeStringArray, hashes: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it isn't known."""
        if not len(self.hashes):
            return np.full(len(keys), -1, dtype=np.int64)
        order = np.argsort(hashes)  # neighbours are looked up one after the other
        at = np.empty(len(keys), dtype=np.int64)
        at[order] = np.searchsorted(self.hashes, hashes[order])
        at = np.minimum(at, len(self.hashes) - 1)
        places = self.places[at].astype(np.int64)
        near = np.flatnonzero(self.hashes[at] == hashes)
        same = pc.equal(self.keys.take(pa.array(places[near])), keys.take(pa.array(near)))
        found = np.full(len(keys), -1, dtype=np.int64)
        near = near[same.to_numpy(zero_copy_only=False)]
        found[near] = places[near]
        self.met[found[near]] = True
        return found

    def add(self, keys: pa.LargeStringArray, ids: pa.LargeBinaryArray, hashes: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.places = np.concatenate([self.places, (len(self.keys) + order).astype(np.int32)])
        self.hashes = np.concatenate([self.hashes, hashes[order]])
        merged = np.argsort(self.hashes, kind="stable")  # two sorted runs
        self.hashes, self.places = self.hashes[merged], self.places[merged]
        self.keys, self.ids = pa.concat_arrays([self.keys, keys]), pa.concat_arrays([self.ids, ids])
        self.met = np.concatenate([self.met, np.ones(len(keys), dtype=bool)])

    def forget(self) -> None:
        """Begins a new generation when this one is full."""
        if np.count_nonzero(self.met) <= self.size:
            return
        keep = pa.array(self.met)
        left = self.met[self.places]
        self.hashes, self.places = self.hashes[left], (np.cumsum(self.met) - 1).astype(np.int32)[self.places[left]]
        self.keys, self.ids = self.keys.filter(keep), self.ids.filter(keep)
        self.met = np.zeros(len(self.keys), dtype=bool)


class WordEncoder:
    """Little-endian unsigned 32-bit ids of texts, as ``Tokenizer.encode(text, add_special_tokens=False)``.

    The tokenizer must treat white space as the end of a word and know ``SEPARATOR`` as a
    special token, which then parts the pieces of a call.
    """

    def __init__(self, path: str, remembered: int | None = None):
        self.memory = Memory(remembered or PIECES + WORDS)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        ending = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.marks_ends = bool(ending)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.edge = np.array([t.endswith(ending) if ending else t.startswith("Ġ") for t in tokens])
        self.tails: dict[str, bytes] = {"": b""}
        self.plain = self._plain(Tokenizer) if self.marks_ends else None

    def _plain(self, kind: type) -> Tokenizer | None:
        """The same model behind white space alone, for lower-case words of a to z; None if it differs."""
        from tokenizers.pre_tokenizers import WhitespaceSplit

        plain = kind(self.tokenizer.model)
        plain.pre_tokenizer = WhitespaceSplit()
        letters = "abcdefghijklmnopqrstuvwxyz"
        words = " ".join(["", *(a + b for a in letters for b in letters), letters, letters[::-1]])
        ids = plain.encode_batch_fast([words], add_special_tokens=False)[0].ids
        return plain if ids == self._ids(words).tolist() else None

    @property
    def known(self) -> pa.LargeStringArray:
        """What has been met in this generation."""
        return self.memory.keys.filter(pa.array(self.memory.met))

    @property
    def known_before(self) -> pa.LargeStringArray:
        """What is remembered of the generation before and hasn't been met again."""
        return self.memory.keys.filter(pa.array(~self.memory.met))

    @classmethod
    def of(cls, path: str, remembered: int | None = None) -> WordEncoder:
        """The worker's own encoder for a tokenizer file, which remembers so many pieces of a generation."""
        store = worker_store("encoders")
        if (path, remembered) not in store:
            store[path, remembered] = cls(path, remembered)
        return store[path, remembered]

    @staticmethod
    def spaced(text: str) -> str | None:
        """A text with a blank before each piece, the first behind a NUL; None if white space is irregular."""
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return None
        if text.isascii():  # the NUL and four separators are ruled out before
            if any(c in text for c in _ASCII_SPACES) or text[0] in " \n" or text[-1] in " \n":
                return None
        elif len(text.split()) != text.count(" ") + text.count("\n") + 1:
            return None
        return "\0" + text.replace("\n", " \n")

    @staticmethod
    def keys(text: str) -> list[str]:
        """Pieces of a text: the first behind a NUL, others without the one blank before them."""
        keys = _PIECE.findall(text)
        keys[1:] = [k[1:] if k[0] == " " and k[1:2].strip() else k for k in keys[1:]]
        keys[0] = "\0" + keys[0]
        return keys

    @staticmethod
    def piece(key: str) -> str:
        return key[1:] if key[0] == "\0" else key if key[0].isspace() else " " + key

    @staticmethod
    def letters(words: pa.LargeStringArray) -> pa.BooleanArray:
        """Whether a word holds nothing but letters, also when the tokenizer has composed and lower-cased it."""
        return pc.and_not(pc.utf8_is_alpha(words), pc.match_substring_regex(words, _UNSTABLE))

    def _ids(self, text: str, tokenizer: Tokenizer | None = None) -> np.ndarray:
        found = (tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, dtype="<u4")

    def _parted(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of each piece of text, from one call."""
        ids = self._ids(SEPARATOR.join(pieces))
        ends = np.append(np.flatnonzero(ids == self.separator), len(ids))
        return _binary(ids[ids != self.separator], np.append(0, ends - np.arange(len(ends))))

    def _new_words(self, words: list[str], tokenizer: Tokenizer | None = None) -> pa.LargeBinaryArray:
        """Ids of words of letters, each behind a blank."""
        ids = self._ids(" " + " ".join(words), tokenizer)
        at = np.flatnonzero(self.edge[ids])
        if len(at) != len(words):  # a letter that the tokenizer takes apart
            return self._parted([" " + w for w in words])
        return _binary(ids, np.append(0, at + 1) if self.marks_ends else np.append(at, len(ids)))

    def _tail(self, points: str) -> bytes:
        if points not in self.tails:
            if len(self.tails) > 1000:
                self.tails = {"": b""}
            self.tails[points] = self._ids(points).tobytes()
        return self.tails[points]

    def _learned(self, keys: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of new words and other pieces."""
        alone = self.letters(keys)
        simple = pc.and_(alone, pc.and_(pc.string_is_ascii(keys), self.plain is not None))
        kinds = [
            (simple, lambda some: self._new_words(some, self.plain)),
            (pc.and_not(alone, simple), self._new_words),
            (pc.invert(alone), lambda some: self._parted(list(map(self.piece, some)))),
        ]
        out, order = [], []
        for kind, ids in kinds:
            at = np.flatnonzero(kind.to_numpy(zero_copy_only=False))
            some = keys.take(pa.array(at)).to_pylist()
            out += [ids(some[i : i + TOGETHER]) for i in range(0, len(some), TOGETHER)]
            order.append(at)
        return pa.concat_arrays(out).take(pa.array(np.argsort(np.concatenate(order))))

    def _found(self, keys: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct pieces: those of the word in it, or of the whole piece, and of the points behind."""
        # Where ends are marked, white space before a word makes no difference.
        bare = pc.utf8_ltrim(keys, "\0\n") if self.marks_ends else keys
        words = pc.utf8_rtrim(bare, _POINTS)
        alone = self.letters(words)
        pointed = pc.and_(alone, pc.less(pc.binary_length(words), pc.binary_length(bare)))
        if self.marks_ends:
            words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        whole = pc.if_else(alone, words, keys).dictionary_encode()
        known = self._remembered(whole.dictionary).take(whole.indices)
        behind = np.flatnonzero(pointed.to_numpy(zero_copy_only=False))
        if not len(behind):
            return known
        points = pc.struct_field(pc.extract_regex(bare.take(pa.array(behind)), f"(?P<points>[{_POINTS}]+)$"), "points")
        points = points.dictionary_encode()
        tails = pa.array([b"", *map(self._tail, points.dictionary.to_pylist())], pa.large_binary())
        which = np.zeros(len(keys), dtype=np.int64)
        which[behind] = points.indices.to_numpy() + 1
        return pc.binary_join_element_wise(known, tails.take(pa.array(which)), pa.scalar(b"", pa.large_binary()))

    def _remembered(self, keys: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words and other pieces; new ones are learned, all count as met."""
        memory = self.memory
        hashes = np.fromiter(map(hash, keys.to_numpy(zero_copy_only=False)), np.int64, len(keys))
        places = memory.find(keys, hashes)
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = np.arange(len(memory.keys), len(memory.keys) + len(new))
            unknown = keys.take(pa.array(new))
            memory.add(unknown, self._learned(unknown), hashes[new])
        out = memory.ids.take(pa.array(places))
        memory.forget()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start, size = 0, 0
        for i, text in enumerate(texts):
            if i > start and size + len(text) > ENCODE_CHARS:
                out += self._together(texts[start:i])
                start, size = i, 0
            size += len(text)
        out += self._together(texts[start:])
        pa.default_memory_pool().release_unused()  # the columns of a call are large, what is remembered is not
        return out

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose pieces are one column."""
        out = [b""] * len(texts)
        at, spaced, rest, cuts = [], [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if any(c in text for c in _CONTROLS):
                out[i] = self._ids(text).tobytes()
            elif (regular := self.spaced(text)) is not None:
                at.append(i)
                spaced.append(regular)
            else:
                rest.append(i)
                cuts.append(self.keys(text))
        if not at and not rest:
            return out
        parts = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        more = pa.array([k for keys in cuts for k in keys], pa.large_string())
        sizes = np.concatenate([np.diff(parts.offsets.to_numpy()), np.array([len(k) for k in cuts], dtype=np.int64)])
        pieces = pa.concat_arrays([parts.flatten(), more]).dictionary_encode()
        ids = self._found(pieces.dictionary).take(pieces.indices)
        # The values of a binary column stand one after the other: a text's ids are one slice.
        _, places, raw = ids.buffers()
        ends = np.frombuffer(places, dtype=np.int64, count=len(ids) + 1)[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        whole = memoryview(raw) if raw is not None else b""
        for i, a, b in zip([*at, *rest], ends[:-1], ends[1:], strict=True):
            out[i] = bytes(whole[a:b])
        return out
