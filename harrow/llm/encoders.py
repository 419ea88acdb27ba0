"""Whole-text encoding, equal to the tokenizers library's ids.

Texts fall into chunks that encode independently; a dictionary holds the chunks seen lately, and the new ones of a
batch are split into pieces and encoded together. The library itself does texts with special tokens or rare characters.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pandas as pd
import regex

from harrow.llm.merges import MergeLoop, PrefixTable, byte_letters
from harrow.llm.text import mixed, word_spans

CACHE_ENTRIES = 600_000
LONG_CHUNK = 64
#: Bytes of words looked up at once.
LOT_BYTES = 4 << 20
#: Below this letter the pattern engines and case rules used here and in the library agree.
PLAIN_BELOW = "ɐ"


class _Chunks:
    """Dictionary of chunk -> packed ids, filled a batch at a time; starts over when full."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict = {}
        self.pieces: dict[bytes, bytes] = {}

    def lookup(self, texts: list[list]) -> list[bytes]:
        """Packed ids of texts given as lists of chunks."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        if len(self.pieces) > CACHE_ENTRIES * 2 // 3:
            self.pieces.clear()
        new = set()
        for chunks in texts:
            new.update(chunks)
        new -= self.known.keys()
        made = self.make(list(new))
        self.known.update(made)
        get = self.known.__getitem__
        out = [b"".join(map(get, chunks)) for chunks in texts]
        for c in new:
            if len(c) > LONG_CHUNK:
                del self.known[c]
        return out

    def split_all(self, chunks: list, split) -> dict:
        """{chunk: packed ids}; split(chunk) gives its pieces as bytes, or None to leave the chunk to the library."""
        parts = {c: split(c) for c in chunks}
        new = {p for ps in parts.values() if ps is not None for p in ps} - self.pieces.keys()
        new = list(new)
        self.pieces.update(zip(new, self.coder.encode(new), strict=True))
        get = self.pieces.__getitem__
        out = {c: b"".join(map(get, ps)) if ps is not None else self.by_library(c) for c, ps in parts.items()}
        for p in new:
            if len(p) > LONG_CHUNK:
                del self.pieces[p]
        return out

    def by_library(self, chunk) -> bytes:
        text = chunk if isinstance(chunk, str) else chunk.decode("utf-8", "replace")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class WordEncoder(_Chunks):
    """For the lower-casing word vocabulary that drops white space: chunks are words between ASCII white space."""

    #: Pieces of words that stand one to a line; the line feed is a piece of its own.
    _PIECE = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    _RARE = re.compile(f"[^\\x00-{chr(ord(PLAIN_BELOW) - 1)}]|<\\|")

    def __init__(self, path: str):
        super().__init__(path)
        self.coder = MergeLoop(self.spec)
        self.ids_of: dict[str, bytes] = {"\n": b""}

    def make(self, words: list[bytes]) -> dict:
        """All new words are split by one pattern call; below PLAIN_BELOW every text is in normal form and lower case knows no context."""
        if not words:
            return {}
        if len(self.ids_of) > CACHE_ENTRIES * 2 // 3:
            self.ids_of = {"\n": b""}
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")
        rare = self._RARE.search
        plain = [t.isascii() and "<|" not in t or not rare(t) for t in texts]
        pieces = self._PIECE.findall("".join([t + "\n" for t, p in zip(texts, plain) if p]).lower())
        new = list(set(pieces) - self.ids_of.keys())
        self.ids_of.update(zip(new, self.coder.encode([p.encode() for p in new]), strict=True))
        parts = list(map(self.ids_of.__getitem__, pieces))
        # Only the line feed has no ids.
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size)[size == 0].tolist()
        ids = b"".join(parts)
        made = dict(zip((w for w, p in zip(words, plain) if p), (ids[x:y] for x, y in zip([0, *ends], ends)), strict=True))
        made.update((w, self.by_library(w)) for w, p in zip(words, plain) if not p)
        for p in new:
            if len(p) > LONG_CHUNK:
                del self.ids_of[p]
        return made

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        start, end, text = word_spans(data, np.cumsum([0, *map(len, texts)]))
        ids, tokens = [], np.zeros(len(texts) + 1, np.int64)
        lot = np.cumsum(end - start) // LOT_BYTES
        edges = np.searchsorted(lot, np.arange(int(lot[-1]) + 2)) if len(lot) else []
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            first, again = distinct_words(data, start[a:b], end[a:b])
            parts = self.known_ids([raw[x:y] for x, y in zip(start[a:b][first].tolist(), end[a:b][first].tolist())])
            flat = np.frombuffer(b"".join(parts), "<u4")
            size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            count = size[again]
            ids.append(flat[_runs_at((np.cumsum(size) - size)[again], count)].tobytes())
            tokens[1:] += np.bincount(text[a:b], count, len(texts)).astype(np.int64)
        whole, ends = b"".join(ids), np.cumsum(4 * tokens).tolist()
        return [whole[x:y] for x, y in zip(ends, ends[1:])]

    def known_ids(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        self.known.update(self.make(new))
        out = list(map(self.known.__getitem__, words))
        for w in new:
            if len(w) > LONG_CHUNK:
                del self.known[w]
        return out


def _runs_at(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. of `size` places each, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of distinct words, which of them each word is). Words with one code are told apart by their bytes, eight at a time."""
    size = end - start
    # Eight bytes from any place on; the last places have zeros behind them.
    eight = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))

    def chunks():
        at, k = np.arange(len(size)), 0
        while len(at):
            yield at, k, _KEEP[np.minimum(size[at] - k, 8)]
            k += 8
            at = at[size[at] > k]

    code = size.astype(np.uint64)
    for at, k, keep in chunks():
        code[at] = mixed(code[at] ^ (eight[start[at] + k] & keep))
    again, codes = pd.factorize(code)
    first = np.empty(len(codes), np.int64)
    first[again[::-1]] = np.arange(len(size) - 1, -1, -1)
    model = first[again]
    alike = size == size[model]
    for at, k, keep in chunks():
        there = np.minimum(start[model[at]] + k, len(data))
        alike[at] &= (eight[start[at] + k] & keep) == (eight[there] & keep)
    other = np.flatnonzero(~alike)
    again[other] = len(first) + np.arange(len(other))
    return np.concatenate([first, other]), again


class ByteEncoder(_Chunks):
    """For the byte-level vocabulary: a single space between solid characters starts a chunk.

    Any other white space makes the whole text one chunk.
    """

    _PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    _ODD = re.compile("[\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")

    def __init__(self, path: str):
        super().__init__(path)
        self.coder = PrefixTable(self.spec)
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("|".join(map(re.escape, names))) if names else re.compile(r"(?!)")

    def _split(self, chunk: str):
        if self._ODD.search(chunk) or not (chunk.isascii() or max(chunk) < PLAIN_BELOW):
            letters = self.letters  # the library splits, the pieces are encoded here
            return [bytes(map(letters.__getitem__, p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        return [p.encode() for p in self._PIECE.findall(chunk)]

    def make(self, chunks: list[str]) -> dict:
        return self.split_all(chunks, self._split)

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or self._ODD.search(text):
            return [text]
        head, *rest = text.split(" ")
        return [head, *[" " + w for w in rest]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; special token strings in a text become their ids."""
        out, spread = [], []
        for t in texts:
            marks = list(self.special_at.finditer(t))
            ends = [0, *[m.end() for m in marks]]
            starts = [*[m.start() for m in marks], len(t)]
            spread.append((len(out), [self.special[m[0]].to_bytes(4, "little") for m in marks]))
            out += [self._chunks(t[a:b]) for a, b in zip(ends, starts)]
        parts = self.lookup(out)
        ids = []
        for at, marks in spread:
            run = [parts[at]]
            for k, m in enumerate(marks):
                run += [m, parts[at + 1 + k]]
            ids.append(run[0] if len(run) == 1 else b"".join(run))
        return ids

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.coder.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_made: dict = {}


def worker_copy(kind: type, path: str):
    """One encoder per Python worker and vocabulary."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
