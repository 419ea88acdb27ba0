"""Whole Arrow string columns as byte arrays: blocks of texts, words, rolling fingerprints.

Everything here works on one block of texts inside a task; memory is a small multiple of the block
(one text longer than a block is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 64)
        one = np.ones(1, np.uint64)
        _powers["up"] = np.cumprod(np.concatenate([one, np.full(size - 1, BASE)]), dtype=np.uint64)
        _powers["down"] = np.cumprod(np.concatenate([one, np.full(size - 1, BASE_INV)]), dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, bytes, offsets) of consecutive runs of whole texts, of about `size` bytes."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def prefix_codes(data: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """Running polynomial code; (p[e] - p[s]) * BASE**-s identifies data[s:e]."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * up[:-1], out=out[1:])
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words: runs without space, tab, LF, VT, FF, CR."""
    if not len(data):
        e = np.empty(0, np.int64)
        return e, e, e
    solid = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit codes of the spans; equal bytes (A-Z lowered if asked) have equal codes."""
    p = prefix_codes(data, LOWER_CODE if lower else BYTE_CODE)
    _, down = powers(len(data) + 1)
    return mixed((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit codes of the spans that no pattern of letters can bring together, unlike sums of powers modulo 2**64.

    Eight bytes at a time go through the mixing function, for pieces of 64 bytes at once; pieces are mixed with their place.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    if lower:
        data = _LOWER[data]
    # Eight bytes from any place on; the last places have zeros behind them.
    eight = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    size = ends - starts
    pieces = np.maximum(1, -(-size // 64))
    first = np.cumsum(pieces) - pieces
    owner = np.repeat(np.arange(len(starts)), pieces)
    place = np.arange(len(owner)) - first[owner]
    begin = starts[owner] + 64 * place
    left = np.minimum(64, ends[owner] - begin)
    code, at = np.zeros(len(owner), np.uint64), np.arange(len(owner))
    for k in range(0, 64, 8):
        at = at[left[at] > k]
        if not len(at):
            break
        code[at] = mixed((code[at] ^ (eight[begin[at] + k] & _KEEP[np.minimum(left[at] - k, 8)])) + _STEP)
    return mixed(np.add.reduceat(mixed(code + place.astype(np.uint64) * _STEP), first) + size.astype(np.uint64))


def shingles(codes: np.ndarray, text: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle codes as (text number, code), sorted by text, then code.

    A text of 1 to k - 1 words has its whole word sequence as its one shingle; one without words has none.
    """
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    mult = powers(k + 1)[0][1:]
    n = len(codes) - k + 1
    if n > 0:
        acc = np.zeros(n, np.uint64)
        for j in range(k):
            acc += codes[j : j + n] * mult[j]
        whole = text[:n] == text[k - 1 :]
        acc, owner = mixed(acc[whole]), text[:n][whole]
    else:
        acc, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    count = np.bincount(text, minlength=n_texts)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = np.searchsorted(text, short)
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            here = count[short] > j
            extra[here] += codes[first[here] + j] * mult[j]
        acc = np.concatenate([acc, mixed(extra + count[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((acc, owner))
    acc, owner = acc[order], owner[order]
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], acc[new]


def by_text(values: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Offsets (n_texts + 1) of each text's run in `values`, whose owners ascend."""
    return np.searchsorted(owner, np.arange(n_texts + 1))
