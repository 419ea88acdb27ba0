"""Greedy word-piece lengths by a linear longest-match automaton; no pieces are built.

The trie holds the word-initial pieces below one root and the continuing pieces below another. Where a longest match cannot go on,
a failure link leads to the state for what is still unmatched, and a count says how many pieces were completed on the way.
Each byte is read once per word. Many words step through the automaton together.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harrow.llm.common import batch, doc_texts
from harrow.llm.encoders import distinct_words
from harrow.llm.merges import NEVER, PairTable, byte_letters
from harrow.llm.text import blocks, column_bytes, word_spans

SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])


class LongestMatch:
    """Automaton for byte-string pieces: `starts` may begin a word, `rests` continue one."""

    def __init__(self, starts: list[bytes], rests: list[bytes]):
        nodes: dict[tuple[int, bytes], int] = {(0, b""): 0, (1, b""): 1}
        final = set()
        for kind, pieces in ((0, starts), (1, rests)):
            for p in pieces:
                if p:
                    for k in range(1, len(p) + 1):
                        nodes.setdefault((kind, p[:k]), len(nodes))
                    final.add(nodes[kind, p])
        n = len(nodes)
        goto = {(nodes[kind, s[:-1]], s[-1]): i for (kind, s), i in nodes.items() if s}
        link, pops = [-1] * n, [0] * n
        for (kind, s), i in sorted(nodes.items(), key=lambda x: len(x[0][1])):
            if not s:
                continue
            if i in final:
                link[i], pops[i] = 1, 1
                continue
            up = nodes[kind, s[:-1]]
            z, popped = link[up], pops[up]
            while z >= 0 and (z, s[-1]) not in goto:
                popped += pops[z]
                z = link[z]
            if z >= 0:
                link[i], pops[i] = goto[z, s[-1]], popped
        self.link, self.pops = np.array(link, np.int64), np.array(pops, np.int64)
        a, c, b = (np.array(x, np.int64) for x in zip(*[(a, c, b) for (a, c), b in goto.items()])) if goto else (np.empty(0, np.int64),) * 3
        self.goto = PairTable(a, c, b)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end]; -1 where the pieces cannot spell it."""
        order = np.argsort(starts - ends, kind="stable")  # longest first, so that the words still being read are a prefix
        s, size = starts[order], (ends - starts)[order]
        state, total = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -i, "left"))
            todo = np.arange(live)[total[:live] >= 0]
            byte = data[s[todo] + i].astype(np.int64)
            while len(todo):
                to = self.goto.get(state[todo], byte)
                hit = to != NEVER
                state[todo[hit]] = to[hit]
                todo, byte = todo[~hit], byte[~hit]
                todo, byte = self._fail(state, total, todo, byte)
        todo = np.flatnonzero((total >= 0) & (state != 1) & (size > 0))
        while len(todo):
            todo, _ = self._fail(state, total, todo, todo)
            todo = todo[state[todo] != 1]
        out = np.empty(len(s), np.int64)
        out[order] = total
        return out

    def _fail(self, state, total, todo, carried):
        to = self.link[state[todo]]
        dead = to < 0
        total[todo[dead]] = -1
        todo, carried, to = todo[~dead], carried[~dead], to[~dead]
        total[todo] += self.pops[state[todo]]
        state[todo] = to
        return todo, carried


def from_byte_vocabulary(path: str) -> LongestMatch:
    """Pieces of a byte-level vocabulary file: tokens with a leading space begin words, the others continue them.

    Single bytes may begin a word as well, so every word can be spelled.
    """
    spec = json.load(open(path, encoding="utf-8"))
    letters = byte_letters()
    added = {t["content"] for t in spec["added_tokens"]}
    pieces = [bytes(map(letters.__getitem__, t)) for t in spec["model"]["vocab"] if t not in added]
    starts = [p[1:] for p in pieces if p[:1] == b" " and len(p) > 1]
    rests = [p for p in pieces if p[:1] != b" "]
    return LongestMatch(starts + [p for p in rests if len(p) == 1], rests)


_made: dict[str, LongestMatch] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every whole text.

    Words stand between ASCII white space; a word that the pieces cannot spell counts as one unknown token. Null or empty
    text: zeros. Repeated rows stay repeated; other columns are not read.
    """

    def run(batches):
        if path not in _made:
            _made[path] = from_byte_vocabulary(path)
        automaton = _made[path]
        for b in batches:
            data, off = column_bytes(b.column(1))
            for x, y, d, o in blocks(data, off, 8 << 20):
                s, e, text = word_spans(d, o)
                first, again = distinct_words(d, s, e) if len(s) else (s, s)
                pieces = automaton.counts(d, s[first], e[first])[again]
                n = y - x
                unknown = np.bincount(text, pieces < 0, n)
                tokens = np.bincount(text, np.where(pieces < 0, 1, pieces), n)
                yield batch(_ARROW, b.column(0)[x:y], np.bincount(text, minlength=n), tokens.astype(np.int64), unknown.astype(np.int64))

    return doc_texts(docs).mapInArrow(run, SCHEMA)
