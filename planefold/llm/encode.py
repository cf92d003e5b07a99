"""Token ids of texts by the public tokenizer libraries, with a bounded cache of chunks.

Byte-level tokenizers split a text before every space that a non-space follows, so the
chunks between such places are encoded on their own. All chunks of a piece of input are
found and hashed at once; each distinct one is looked up in sorted arrays, and only those
that are not there go to the library. Other tokenizers get whole texts.

The cache has two generations of at most ``CACHE_BYTES`` each. A chunk that is met
again moves from the old one to the young one; when the young one is full it becomes
the old one, so frequent chunks stay and only rare ones are forgotten. A chunk is told
by two independent 64-bit hashes of at most ``LONGEST`` bytes; longer ones are not cached.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa

from planefold.llm.words import _BYTE_VALUES, U64, buffers, ranges, span_hashes

CACHE_BYTES = 24 << 20
#: Text whose chunks are looked up at a time (a text is never cut): the arrays for it take some hundred times as much.
AT_ONCE = 1 << 20
ENTRY_BYTES = 32
LONGEST = 48
#: Cached units that no space precedes: marks, line ends, words after them.
UNITS = 1 << 15
U32 = np.dtype("<u4")
SPACE = 0x20
_ODD_SPACE = re.compile(r" (?:\s|$)")
_PLACE = re.compile(r"(?= \S)")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = r"!-/:-@\[-`{-~"
_MARK = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_LATIN = re.compile(rf" ?[{_LETTERS}]+")
#: Chunks that the pre-tokenizer cuts just so: letters, marks and single line ends.
_PLAIN = re.compile(rf" ?[{_LETTERS}]+[{_MARKS}]*(?:\n[{_LETTERS}]+[{_MARKS}]*)*\n?")
_UNIT = re.compile(rf" ?[{_LETTERS}]+|[{_MARKS}]+|\n")
#: Bytes that may begin white space: after a space, the text is looked at more closely.
_MAYBE_SPACE = np.zeros(256, dtype=bool)
_MAYBE_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_encoders: dict[tuple[str, bool], "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if printable, else the next free one."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def hashed(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Both hashes of the distinct spans of a piece, ordered by the first, a place of each, and each span's number among them."""
    values = _BYTE_VALUES[data]
    first, second = span_hashes(values, start, stop), span_hashes(values, start, stop, 1)
    order = np.argsort(first)
    ordered = first[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    keys, sample, number = ordered[new], order[new], np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    check = second[sample]
    if not np.array_equal(check[number], second):
        raise ArithmeticError("two chunks have the same hash")  # about one in 2**64 pairs
    return keys, check, sample, number


class _Known:
    """Ids of chunks in sorted arrays: hashes, and where a chunk's ids lie."""

    def __init__(self) -> None:
        self.first, self.second = np.zeros(0, dtype=U64), np.zeros(0, dtype=U64)
        self.begin, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=U32)

    @property
    def nbytes(self) -> int:
        return ENTRY_BYTES * len(self.first) + self.ids.nbytes

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Place of each chunk, -1 if unknown."""
        if not len(self.first):
            return np.full(len(first), -1)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return np.where((self.first[at] == first) & (self.second[at] == second), at, -1)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and ids of the chunks at some places."""
        return self.count[at], self.ids[ranges(self.begin[at], self.count[at])]

    def add(self, first: np.ndarray, second: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """Store chunks that are unknown so far."""
        begin = len(self.ids) + np.cumsum(count) - count
        order = np.argsort(first)
        first, second, count, begin = first[order], second[order], count[order], begin[order]
        at = np.searchsorted(self.first, first)
        self.first, self.second = np.insert(self.first, at, first), np.insert(self.second, at, second)
        self.begin, self.count = np.insert(self.begin, at, begin), np.insert(self.count, at, count)
        self.ids = np.r_[self.ids, ids]


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of several chunks or texts, one after the other, and how many each has."""
    return np.fromiter(chain.from_iterable(found), dtype=U32), np.fromiter(map(len, found), dtype=np.int64, count=len(found))


class _Chunks:
    """Ids of chunks of a byte-level tokenizer."""

    def __init__(self, tokenizer) -> None:
        self.encode, self.tokenize, self.letters = tokenizer.encode, tokenizer.model.tokenize, _byte_letters()
        self.space = self.letters[SPACE]
        self.unit = lru_cache(UNITS)(self.whole)
        self.young, self.old = _Known(), _Known()

    def fresh(self, chunk: str) -> list[int]:
        """Ids of a chunk that may begin with a space."""
        bare = chunk[1:] if chunk[0] == " " else chunk
        if bare.isascii() and chunk is not bare:
            if bare.isalpha():  # a run of letters is one unit of the pre-tokenizer: straight to the model
                return [token.id for token in self.tokenize(self.space + bare)]
            word = bare.rstrip(_MARK)
            if word.isalpha():
                return [token.id for token in self.tokenize(self.space + word)] + self.unit(bare[len(word) :])
        elif _LATIN.fullmatch(chunk):
            return [token.id for token in self.tokenize(chunk.encode().decode("latin-1").translate(self.letters))]
        if _PLAIN.fullmatch(chunk):
            return list(chain.from_iterable([self.fresh(unit) if unit[0] == " " else self.unit(unit) for unit in _UNIT.findall(chunk)]))
        return self.whole(chunk)

    def whole(self, chunk: str) -> list[int]:
        return self.encode(chunk, add_special_tokens=False).ids

    def distinct(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct chunks of a piece, how many each has, and the number of each chunk among the distinct."""
        keys, check, sample, number = hashed(data, start, stop)
        if self.young.nbytes > CACHE_BYTES:
            self.young, self.old = _Known(), self.young
        at = self.young.find(keys, check)
        lost = np.flatnonzero(at < 0)
        before = self.old.find(keys[lost], check[lost])
        again, new = before >= 0, lost[before < 0]
        text = data.tobytes()
        chunks = [text[i:j].decode() for i, j in zip(start[sample[new]].tolist(), stop[sample[new]].tolist())]
        ids, count = _flat([self.fresh(chunk) for chunk in chunks])
        kept, moved = self.old.take(before[again])
        self.young.add(np.r_[keys[new], keys[lost[again]]], np.r_[check[new], check[lost[again]]], np.r_[count, kept], np.r_[ids, moved])
        count, ids = self.young.take(self.young.find(keys, check))
        return ids, count, number


class Encoder:
    """Ids of whole texts; nothing added, cut or padded.

    Special strings inside texts are special tokens as the library has it by default,
    ordinary text with ``plain``.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        self.chunks = None
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.whole = lambda text: np.array(model.encode(text), dtype=U32).tobytes()
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = plain
        self.whole = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=U32).tobytes()
        spec = json.loads(tokenizer.to_str())
        split = spec.get("pre_tokenizer") or {}
        alone = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in spec["added_tokens"])
        if spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and alone:
            self.chunks = _Chunks(tokenizer)

    def ids(self, text: str) -> bytes:
        """Ids of one text."""
        return self.batch(pa.array([text], pa.large_string()))[0]

    def batch(self, column: pa.Array) -> list[bytes]:
        """Ids of each text of a column; NULL counts as empty."""
        ids, counts = self.flat(column)
        raw, cuts = ids.tobytes(), (4 * np.r_[0, np.cumsum(counts)]).tolist()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after the other, and how many each has."""
        found, row = [(np.zeros(0, dtype=U32), np.zeros(0, dtype=np.int64))], 0
        if self.chunks is None:
            whole = [self.whole(text) if text else b"" for text in column.to_pylist()]
            return np.frombuffer(b"".join(whole), dtype=U32), np.array([len(x) // 4 for x in whole], dtype=np.int64)
        _, offsets = buffers(column)
        while row < len(column):
            stop = max(int(np.searchsorted(offsets, offsets[row] + AT_ONCE, side="right")) - 1, row + 1)
            found.append(self._piece(column.slice(row, stop - row)))
            row = stop
        ids, counts = zip(*found)
        return np.concatenate(ids), np.concatenate(counts)

    def _piece(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = buffers(column)
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, dtype=U32), np.zeros(rows, dtype=np.int64)
        # a chunk begins at a text, and at a space in it that a non-space follows
        spaces = np.flatnonzero(data == SPACE)
        text = np.searchsorted(offsets, spaces, side="right") - 1
        last = spaces + 1 == offsets[text + 1]
        odd = last | _MAYBE_SPACE[data[np.minimum(spaces + 1, len(data) - 1)]]
        begin = np.zeros(len(data) + 1, dtype=bool)
        begin[spaces[~odd]] = True
        begin[offsets] = True
        plain = np.ones(rows, dtype=bool)
        for i in np.unique(text[odd]).tolist():
            own = slice(offsets[i], offsets[i + 1])
            plain[i] = not _ODD_SPACE.search(data[own].tobytes().decode())
            if plain[i]:
                begin[own] |= data[own] == SPACE
        bounds = np.flatnonzero(begin)
        start, stop = bounds[:-1], bounds[1:]
        of = np.searchsorted(offsets, start, side="right") - 1
        cached = plain[of] & (stop - start <= LONGEST)
        ids, count, number = self.chunks.distinct(data, start[cached], stop[cached])
        # the others are encoded by themselves: long chunks, and texts with odd spaces at once
        extra = [self.chunks.fresh(data[i:j].tobytes().decode()) for i, j in zip(start[~cached & plain[of]].tolist(), stop[~cached & plain[of]].tolist())]
        odd_texts = np.flatnonzero(~plain)
        for i in odd_texts.tolist():
            chunks = _PLACE.split(data[offsets[i] : offsets[i + 1]].tobytes().decode())
            extra.append(list(chain.from_iterable([self.chunks.fresh(chunk) for chunk in chunks if chunk])))
        more, sizes = _flat(extra)
        place = np.cumsum(count) - count
        units = np.concatenate([of[cached], of[~cached & plain[of]], odd_texts])
        where = np.concatenate([start[cached], start[~cached & plain[of]], offsets[odd_texts]])
        begins = np.r_[place[number], len(ids) + np.cumsum(sizes) - sizes].astype(np.int64)
        many = np.r_[count[number], sizes].astype(np.int64)
        order = np.argsort(where, kind="stable")
        flat = np.concatenate([ids, more])[ranges(begins[order], many[order])]
        return flat, np.bincount(units, weights=many, minlength=rows).astype(np.int64)


def encoder(path: str, plain: bool = False) -> Encoder:
    """The encoder of this process for a tokenizer file."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]


def version_digest(path: str) -> str:
    """Digest of all that decides the ids: the file and the library's version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    return hashlib.sha256(Path(path).read_bytes() + library.__version__.encode()).hexdigest()
