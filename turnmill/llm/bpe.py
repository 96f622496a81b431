"""Byte-pair encoding and decoding with the ranks of a given tokenizer file.

A word is a contiguous array of parts with the rank of each adjacent pair. The pair of
least rank (the leftmost of equal ones) loses the boundary between its parts, and the
ranks on both sides are looked up anew, until no pair has a rank. Words of like length
are worked on side by side, one row of the array each; words over ``SHORT`` bytes, for
which repeated scans would cost their square, keep their pairs in a heap instead.

The tokenizer normalises (NFC, white space, lower case), splits by a pattern and ends
words with a mark; what it decodes is its tokens with blanks between.

Null and empty texts have no ids and decode to the empty text. Rows are encoded one by one
and whole, so ties and repeated rows change nothing; other columns pass unread.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, texts, worker_store

#: Bytes up to which a word is encoded by scans of its rank array.
SHORT = 64
#: Words a worker remembers; at the limit it begins anew.
REMEMBERED = 400_000
NONE = np.int32(2**31 - 1)

RESULT = "struct<n_tokens: bigint, ids: binary, decoded: string>"
_CONTROL = re.compile(r"[\x1c-\x1f]")
_SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class RankBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary, ending = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.first = np.array([vocabulary[x] for x in letters], dtype=np.int32)
        self.last = np.array([vocabulary[x + ending] for x in letters], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        codes = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.made = codes[order], order.astype(np.int32), made
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.parted = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> RankBPE:
        """The worker's own instance for a tokenizer file."""
        store = worker_store("rank-bpe")
        if path not in store:
            store[path] = cls(path)
        return store[path]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; ``NONE`` if it has none or a side is missing (-1)."""
        code = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((self.codes[at] == code) & (right >= 0) & (left >= 0), self.ranks[at], NONE)

    def merge_rows(self, parts: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of parts (-1 behind the end)."""
        n, width = parts.shape
        out: list[np.ndarray] = [None] * n  # type: ignore[list-item]
        where = np.arange(n)
        ranks = self.pair_ranks(parts[:, :-1], parts[:, 1:]) if width > 1 else np.full((n, 0), NONE)
        ranks = np.concatenate([ranks, np.full((n, 1), NONE)], axis=1)  # one rank for each part
        columns = np.arange(width)
        while len(where):
            at = ranks.argmin(axis=1)
            rows = np.arange(len(where))
            best = ranks[rows, at]
            done = best == NONE
            if done.any():
                counts = (parts[done] >= 0).sum(axis=1)
                for i, row, count in zip(where[done], parts[done], counts, strict=True):
                    out[i] = row[:count]
                going = ~done
                parts, ranks, where, at, best = parts[going], ranks[going], where[going], at[going], best[going]
                rows = np.arange(len(where))
                if not len(where):
                    break
            # Delete the boundary: the parts behind it move up by one.
            take = np.minimum(columns[None, :] + (columns[None, :] > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, take, axis=1)
            parts[:, -1] = -1
            parts[rows, at] = self.made[best]
            ranks = np.take_along_axis(ranks, take, axis=1)
            ranks[:, -1] = NONE
            # Refresh the ranks on both sides.
            right = parts[rows, np.minimum(at + 1, width - 1)]
            ranks[rows, at] = self.pair_ranks(parts[rows, at], np.where(at + 1 < width, right, -1))
            before = np.flatnonzero(at > 0)
            spot = at[before] - 1
            ranks[before, spot] = self.pair_ranks(parts[before, spot], parts[before, spot + 1])
        return out

    def merge_long(self, parts: np.ndarray) -> np.ndarray:
        """As ``merge_rows`` for one word of any length, with a heap of pairs."""
        ids, n = parts.tolist(), len(parts)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.pair_ranks(parts[:-1], parts[1:])
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has changed since
            ids[i], ids[j] = int(self.made[rank]), None
            after[i] = after[j]
            if after[i] < n:
                prior[after[i]] = i
            for x, y in ((prior[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    new = int(self.pair_ranks(np.array([ids[x]]), np.array([ids[y]]))[0])
                    if new != NONE:
                        heapq.heappush(heap, (new, x, ids[x], ids[y]))
        return np.array([x for x in ids if x is not None], dtype=np.int32)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words (their UTF-8 bytes, not empty), each for itself."""
        out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(-(-len(w) // 4) * 4 if len(w) <= SHORT else 0, []).append(i)
        for width, own in by_size.items():
            if not width:
                for i in own:
                    raw = np.frombuffer(words[i], dtype=np.uint8)
                    out[i] = self.merge_long(np.append(self.first[raw[:-1]], self.last[raw[-1]]))
                continue
            for k in range(0, len(own), 4096):
                some = own[k : k + 4096]
                raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in some), dtype=np.uint8)
                raw = raw.reshape(len(some), width)
                size = np.array([len(words[i]) for i in some])
                parts = np.where(np.arange(width) < size[:, None], self.first[raw], np.int32(-1))
                rows = np.arange(len(some))
                parts[rows, size - 1] = self.last[raw[rows, size - 1]]
                for i, ids in zip(some, self.merge_rows(parts), strict=True):
                    out[i] = ids
        return out

    def pieces(self, word: str) -> list[bytes]:
        """The parts of the normalised word that are encoded each for itself."""
        plain = unicodedata.normalize("NFC", word)
        # Letter by letter: no letter's lower case depends on its neighbours.
        lower = plain.lower() if "Σ" not in plain else "".join(c.lower() for c in plain)
        return [p.encode() for p in self.split.findall(lower)]

    def learn(self, words: list[str]) -> None:
        parts = [self.pieces(w) for w in words]
        flat = list(dict.fromkeys(p for ps in parts for p in ps))
        ids = {p: i.astype("<u4").tobytes() for p, i in zip(flat, self.encode_words(flat), strict=True)}
        for word, ps in zip(words, parts, strict=True):
            self.known[word] = b"".join(ids[p] for p in ps)

    def words(self, text: str) -> list[str]:
        """The text at white space; special tokens stand for themselves behind a NUL."""
        if any(s in text for s in self.special):
            out = []
            for n, part in enumerate(self.parted.split(text)):
                out += ["\0" + part] if n % 2 else self.words(part)
            return out
        return text.split() if not _CONTROL.search(text) else [w for w in _SPACES.split(text) if w]

    def encode(self, many: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self.words(t) for t in many]
        new = set().union(*cut) - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*cut)
        marks = {w for w in new if w[0] == "\0" and w[1:] in self.special}
        self.learn(list(new - marks))
        for w in marks:
            self.known[w] = np.array([self.special[w[1:]]], dtype="<u4").tobytes()
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in cut]

    def decode(self, ids: bytes) -> str:
        token = self.tokens.__getitem__
        return " ".join(map(token, np.frombuffer(ids, dtype="<u4").tolist()))


def encode_decode(df: DataFrame, tokenizer: str, text: str = "text", into: str = "bpe") -> DataFrame:
    """``df`` with a struct ``into``: number of ids, the ids (little-endian u32), and the text they decode to.

    A column that has this name already is replaced; all others pass unread.
    """
    kind = pa.struct([("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    @F.arrow_udf(RESULT)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = RankBPE.of(tokenizer)
        for column in columns:
            bodies = [b for i in range(0, len(column), 100) for b in bpe.encode(texts(column.slice(i, 100)))]
            columns = [[len(b) // 4 for b in bodies], bodies, [bpe.decode(b) for b in bodies]]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)]
            yield pa.StructArray.from_arrays(arrays, fields=list(kind))

    return bounded_batches(df).withColumn(into, run(F.col(text)))
