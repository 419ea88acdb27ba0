"""Byte-pair merges over many short pieces at once (numpy lanes), for both kinds of vocabulary."""

from __future__ import annotations

import numpy as np

NEVER = np.int64(2**40)


class PairTable:
    """(left id, right id) -> value, as an open-addressing table that answers whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        size = 1 << max(8, int(4 * len(left) - 1).bit_length())
        self.mask = np.int64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NEVER, np.int64)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self._slot(key)
        todo = np.arange(len(key))
        while len(todo):
            free = self.keys[at[todo]] == -1
            put = todo[free]
            self.keys[at[put]] = key[put]
            won = self.keys[at[todo]] == key[todo]
            self.values[at[todo[won]]] = value[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = key * np.int64(-7046029254386353131)
        return ((h >> np.int64(29)) ^ (h >> np.int64(47))) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair, NEVER where there is none."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self._slot(key)
        held = self.keys[at]
        out = np.where(held == key, self.values[at], NEVER)
        todo = np.flatnonzero((held != key) & (held != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            held = self.keys[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        return out


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_rules(spec: dict) -> list[tuple[str, str]]:
    return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]


def by_length(pieces: list[bytes]) -> dict[int, list[int]]:
    """Places of the pieces of each length; equal lengths need no padding."""
    out: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        out.setdefault(len(p), []).append(i)
    return out


class MergeLoop:
    """Ids of words by repeatedly merging the lowest-ranked, leftmost pair; many words of one length at a time."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        end = spec["model"].get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.zeros(256, np.int64)
        self.final = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.inner[b] = vocab[c]
            self.final[b] = vocab[c + end]
        rules = merge_rules(spec)
        left, right, made = (np.array(x, np.int64) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in rules]))
        self.pairs = PairTable(left, right, np.arange(len(rules), dtype=np.int64))
        self.made = made

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word (no empty words)."""
        out: list[bytes] = [b""] * len(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(length, kind="stable")
        for n in np.unique(length).tolist():
            places = order[np.searchsorted(length[order], n) : np.searchsorted(length[order], n, "right")].tolist()
            raw = np.frombuffer(b"".join(map(words.__getitem__, places)), np.uint8).reshape(-1, n)
            ids = self.inner[raw]
            ids[:, -1] = self.final[raw[:, -1]]
            size = np.full(len(ids), n)
            live = np.arange(len(ids)) if n > 1 else np.empty(0, np.int64)
            while len(live):
                width = int(size[live].max())
                cur = ids[live, :width]
                rank = self.pairs.get(cur[:, :-1].ravel(), cur[:, 1:].ravel()).reshape(len(live), width - 1)
                rank[np.arange(width - 1) >= (size[live] - 1)[:, None]] = NEVER
                at = rank.argmin(1)
                best = rank[np.arange(len(live)), at]
                go = best < NEVER
                live, at, best, cur = live[go], at[go], best[go], cur[go]
                if not len(live):
                    break
                cols = np.arange(width - 1)
                shifted = np.where(cols > at[:, None], cur[:, 1:], cur[:, :-1])
                shifted[np.arange(len(live)), at] = self.made[best]
                ids[live, : width - 1] = shifted
                size[live] -= 1
                live = live[size[live] > 1]
            packed = ids.astype("<u4")[np.arange(n) < size[:, None]].tobytes()
            ends = np.cumsum(4 * size).tolist()
            for i, x, y in zip(places, [0, *ends], ends):
                out[i] = packed[x:y]
        return out


class PrefixTable:
    """Ids of byte pieces by dynamic programming over prefixes; many pieces of one length at a time.

    Of the tokens that end a prefix (the automaton's suffix matches, longest first) exactly one is compatible with the
    last token of the prefix before it. It is stored per prefix, and the ids are read back from the end.
    """

    def __init__(self, spec: dict):
        vocab, letters = spec["model"]["vocab"], byte_letters()
        added = {t["content"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            if token not in added:
                self.bytes_of[i] = bytes(map(letters.__getitem__, token))
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()
        n = len(self.bytes_of)
        self.size = np.array([len(b) for b in self.bytes_of], np.int64)
        rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merge_rules(spec)]
        left, right, made = (np.array(x, np.int64) for x in zip(*rules))
        self.pairs = PairTable(left, right, np.arange(len(rules), dtype=np.int64))
        # How each token was made; bytes have rank -1.
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        self.rank[made], self.left[made], self.right[made] = np.arange(len(rules)), left, right
        self._automaton([i for t, i in vocab.items() if t not in added])
        alone = np.ones(n, bool)
        alone[made] = self._stay(left, right, self.rank[made])
        while True:
            low = alone & alone[self.left] & alone[self.right]
            if (low == alone).all():
                break
            alone = low
        self.alone = alone

    def _automaton(self, ids: list[int]) -> None:
        """States are the prefixes of tokens; `step` is the complete transition table."""
        node: dict[bytes, int] = {b"": 0}
        for i in ids:
            b = self.bytes_of[i]
            for k in range(1, len(b) + 1):
                node.setdefault(b[:k], len(node))
        names = sorted(node, key=len)
        number = {s: i for i, s in enumerate(names)}
        token = {self.bytes_of[i]: i for i in ids}
        step = np.zeros((len(names), 256), np.int32)
        longest = np.full(len(names), -1, np.int64)
        self.shorter = np.full(len(self.bytes_of), -1, np.int64)
        fail = np.zeros(len(names), np.int64)
        children: list[list[int]] = [[] for _ in names]
        for i, s in enumerate(names[1:], 1):
            children[number[s[:-1]]].append(i)
        for i, s in enumerate(names):
            if i:
                up = number[s[:-1]]
                fail[i] = step[fail[up], s[-1]] if up else 0
                step[i] = step[fail[i]]
                own = token.get(s, -1)
                longest[i] = own if own >= 0 else longest[fail[i]]
                if own >= 0:
                    self.shorter[own] = longest[fail[i]]
            for c in children[i]:
                step[i, names[c][-1]] = c
        self.step, self.longest = step, longest

    def _stay(self, x: np.ndarray, y: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether no merge across the border of x and y happens before rank `before` and before either side is whole.

        Going back in time, the later-made side is opened at its border (the right one first when both are made by the same rule:
        the left is merged first). A pair at the border merges if its rank comes before both sides are absorbed;
        at equal rank the leftmost pair goes first.
        """
        stay = np.ones(len(x), bool)
        live = np.arange(len(x))
        x, y = x.copy(), y.copy()
        upto_x, upto_y = before.copy(), before - 1
        while len(live):
            rank = self.pairs.get(x, y)
            broken = (rank < upto_x) & (rank <= upto_y)
            stay[live[broken]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~broken & ((rx >= 0) | (ry >= 0))
            live, x, y, upto_x, upto_y, rx, ry = (a[go] for a in (live, x, y, upto_x, upto_y, rx, ry))
            open_x = rx > ry
            upto_x, upto_y = np.where(open_x, rx, upto_x), np.where(open_x, upto_y, ry)
            x, y = np.where(open_x, self.right[x], x), np.where(open_x, y, self.left[y])
        return stay

    def _compatible(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        ok = self.alone[token]
        pair = np.flatnonzero(ok & (before >= 0))
        ok[pair] = self._stay(before[pair], token[pair], np.full(len(pair), NEVER - 1))
        return ok

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each piece (no empty pieces)."""
        out: list[bytes] = [b""] * len(pieces)
        for n, places in by_length(pieces).items():
            raw = np.frombuffer(b"".join([pieces[i] for i in places]), np.uint8).reshape(-1, n)
            m = len(raw)
            state = np.zeros(m, np.int64)
            last = np.full((m, n + 1), -1, np.int64)
            for i in range(1, n + 1):
                state = self.step[state, raw[:, i - 1]]
                token, todo = self.longest[state], np.arange(m)
                while len(todo):
                    ok = self._compatible(last[todo, i - self.size[token]], token)
                    last[todo[ok], i] = token[ok]
                    todo, token = todo[~ok], self.shorter[token[~ok]]
            # Back-pointers, from the end; the ids of a row come out right-aligned.
            ids = np.zeros((m, n), "<u4")
            at, place = np.full(m, n), np.full(m, n)
            live = np.arange(m)
            while len(live):
                place[live] -= 1
                t = last[live, at[live]]
                ids[live, place[live]] = t
                at[live] -= self.size[t]
                live = live[at[live] > 0]
            for row, i in enumerate(places):
                out[i] = ids[row, place[row] :].tobytes()
        return out
