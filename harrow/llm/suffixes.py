"""Removal of long repeated passages with a logarithmic family of suffix arrays.

Suffixes are taken at content-chosen places only: each window of `length` bytes belongs to the anchor (lowest code of its
ANCHOR-byte strings), so equal windows have equal anchors wherever they stand. A run is what consecutive windows of one
anchor cover together.

1. `segments`: texts are packed once into segments of about 1 MB (shared folder).
2. Anchors that occur in one document only cannot start a match: a counting pass over 32-bit remainders per bucket marks the others.
3. The runs at shared anchors go to their anchor's bucket. There, new documents arrive in batches in order of doc_id; equal runs
   are matched whole, and the windows of what is left form the batch's suffix array, which is merge-scanned against
   the levels and then joins them: equal-sized levels merge, so there are logarithmically many. Anchors with very many different
   runs (a common line before changing text) are not one task's: their runs are split into single windows, each segment sends its
   distinct ones with their smallest doc_id, and they are dealt by their own codes (equal windows have equal codes).
4. Each segment gets back, per distinct run, which windows occur in an earlier document, and cuts its texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from harrow.llm.common import release_memory, written
from harrow.llm.text import blocks, column_bytes, mixed, powers, prefix_codes, word_codes

LENGTH = 50
ANCHOR = 24
SEGMENT_BYTES = 1 << 20
BUCKET_BYTES = 16 << 20  # text per bucket, on average
HEADS_AT_ONCE = 100_000
BATCH_HEADS = 8192
HOT_KINDS = 20_000  # different runs of one anchor, counted per segment, beyond which its windows are dealt singly
WINDOWS_A_PART = 250_000  # single windows per task, on average
NO_ID = -(2**63)

_PLACE = np.uint64((1 << 28) - 1)


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, text number, anchor code) of every run of windows with one anchor.

    Of equal anchor codes in a window the leftmost counts. Texts shorter than `length` have no window.
    """
    anchor = min(ANCHOR, length)
    n, width = len(data), length - anchor + 1
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, np.empty(0, np.uint64)
    p = prefix_codes(data)
    _, down = powers(n + 1)
    code = mixed((p[anchor:] - p[:-anchor]) * down[: n - anchor + 1])
    low = (code & ~_PLACE) | np.arange(len(code), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    at = (low & _PLACE).astype(np.int64)  # anchor of the window that starts at each byte
    out = np.zeros(n + 1, np.int32)
    np.add.at(out, np.maximum(offsets[1:] - (length - 1), offsets[:-1]), 1)
    np.add.at(out, offsets[1:], -1)
    inside = np.cumsum(out)[: len(at)] == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    final = inside.copy()
    final[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
    a, b = np.flatnonzero(first), np.flatnonzero(final)
    # Anchors are the lowest codes, so the codes are mixed anew before buckets are taken from them.
    return a, b, at[a], np.searchsorted(offsets, a, "right") - 1, mixed(code[at[a]] + np.uint64(1))


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """`runs_of` over blocks, with places in the whole of `data`."""
    parts = []
    for s, _, d, o in blocks(data, offsets, 1 << 18):
        a, b, at, text, code = runs_of(d, o, length)
        parts.append((a + offsets[s], b + offsets[s], at + offsets[s], text + s, code))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else runs_of(np.empty(0, np.uint8), np.zeros(1, np.int64), length)


class Levels:
    """The logarithmic family: sorted arrays of `length`-byte suffix heads, at most one of each size class."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def seen(self, heads: np.ndarray) -> np.ndarray:
        """Which of the sorted heads stand in a level: a match of the whole head."""
        found = np.zeros(len(heads), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, heads), len(level) - 1)
            found |= level[at] == heads
        return found

    def add(self, heads: np.ndarray) -> None:
        """A new level of sorted, distinct heads; while the level before it is not larger, the two merge."""
        while self.levels and len(self.levels[-1]) <= len(heads):
            both = np.concatenate([self.levels.pop(), heads])
            both.sort(kind="stable")
            keep = np.ones(len(both), bool)
            keep[1:] = both[1:] != both[:-1]
            heads = both[keep]
        self.levels.append(heads)


def covered_heads(heads: np.ndarray, docs: np.ndarray, batch: int = BATCH_HEADS) -> np.ndarray:
    """For each suffix head, whether it also stands in a smaller document; batches are runs of whole documents."""
    order = np.argsort(docs, kind="stable")
    out = np.zeros(len(heads), bool)
    family, at = Levels(), 0
    sorted_docs = docs[order]
    while at < len(order):
        end = min(at + batch, len(order))
        end = int(np.searchsorted(sorted_docs, sorted_docs[end - 1], "right"))
        part = order[at:end]
        part = part[np.argsort(heads[part], kind="stable")]  # the batch's suffix array; equal heads by document
        h, d = heads[part], docs[part]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        group = np.cumsum(new) - 1
        known = family.seen(h[new])
        out[part] = known[group] | (d > d[new][group])
        if not known.all():
            family.add(h[new][~known])
        at = end
    return out


# Segments


def segments(docs: DataFrame, text_col: str, id_col: str, carry: list[str]) -> DataFrame:
    """(seg, ids, lens, data, rest): texts of about SEGMENT_BYTES, compressed, with the other columns beside them."""
    cols = [docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text"), *[docs[c].alias(f"c{i}") for i, c in enumerate(carry)]]

    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=1).compress
        schema = pa.schema([("seg", pa.int64()), ("ids", pa.binary()), ("lens", pa.binary()), ("data", pa.binary()), ("rest", pa.binary())])
        for b in batches:
            data, off = column_bytes(b.column(1))
            ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            rest = pa.RecordBatch.from_arrays(b.columns[2:], names=b.schema.names[2:]) if carry else None
            for s, e, d, o in blocks(data, off, SEGMENT_BYTES):
                sink = b""
                if rest is not None:
                    buf = pa.BufferOutputStream()
                    with pa.ipc.new_stream(buf, rest.schema) as w:
                        w.write_batch(rest.slice(s, e - s))
                    sink = buf.getvalue().to_pybytes()
                row = [[part << 32 | k], [ids[s:e].tobytes()], [np.diff(o).tobytes()], [squeeze(d.tobytes())], [sink]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)
                k += 1

    return docs.select(*cols).mapInArrow(run, "seg long, ids binary, lens binary, data binary, rest binary")


def _opened(ids: bytes, lens: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    off = np.concatenate([[0], np.cumsum(np.frombuffer(lens, np.int64))])
    return np.frombuffer(ids, np.int64), np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), off


def _rows(batches) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names)}
            release_memory()


def _short(code: np.ndarray, bits: int) -> np.ndarray:
    """The top `bits` + 32 bits: bucket, then remainder."""
    return code >> np.uint64(32 - bits)


# Which anchors several documents share


def _contents(data: np.ndarray, off: np.ndarray, runs: tuple[np.ndarray, ...], length: int) -> np.ndarray:
    """Code of each run's bytes and the anchor's place in them; the runs' texts ascend."""
    a, b, at, text, code = runs
    content = np.empty(len(a), np.uint64)
    for s, e, d, o in blocks(data, off, 1 << 18):
        x, y = np.searchsorted(text, [s, e])
        content[x:y] = word_codes(d, a[x:y] - off[s], b[x:y] + length - off[s], lower=False)
    return mixed(content + (at - a).astype(np.uint64)) ^ code


def _anchor_lists(length: int, bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("seg", pa.int64()), ("vals", pa.binary()), ("several", pa.binary()), ("more", pa.binary())])

    def run(batches):
        for r in _rows(batches):
            _, data, off = _opened(r["ids"], r["lens"], r["data"])
            found = anchors_of(data, off, length)
            text, key = found[3], _short(found[4], bits)
            # Keys with several different runs, and how many more than one.
            order = np.lexsort((content := _contents(data, off, found, length), key))
            more_of = key[order][1:][(key[order][1:] == key[order][:-1]) & (content[order][1:] != content[order][:-1])]
            order = np.argsort(key, kind="stable")  # texts ascend among equal keys
            key, text = key[order], text[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            last = np.append(first[1:], len(key)) - 1 if len(key) else first
            several = text[first] != text[last]
            key = key[first]
            edges = np.searchsorted(key, np.arange(2**bits + 1, dtype=np.uint64) << np.uint64(32))
            more = np.bincount(np.searchsorted(key, more_of), minlength=len(key))
            rows: list[list] = [[], [], [], [], []]
            for b in np.flatnonzero(np.diff(edges)):
                s, e = edges[b], edges[b + 1]
                some = np.flatnonzero(more[s:e])
                kinds = np.concatenate([some, more[s:e][some]]).astype("<u4").tobytes()
                for c, v in zip(rows, (int(b), r["seg"], key[s:e].astype("<u4").tobytes(), np.packbits(several[s:e]).tobytes(), kinds)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return run


def _shared_marks(length: int, hot_kinds: int):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        """Of each segment's values in this bucket, which ones occur in another document (bits), then the places of those with
        more than `hot_kinds` different runs; `singles` is about the number of windows these have in the segment."""
        lists = [np.frombuffer(v, "<u4") for v in df["vals"]]
        flags = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(v)) for s, v in zip(df["several"], lists)]
        kinds = []
        for v, m in zip(lists, df["more"]):
            place, more = np.frombuffer(m, "<u4").reshape(2, -1)
            kinds.append(np.ones(len(v), np.int64))
            kinds[-1][place] += more
        values, again, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared = count > 1
        shared[again[np.concatenate(flags) > 0]] = True
        hot = shared & (np.bincount(again, np.concatenate(kinds), len(values)) > hot_kinds)
        marks, singles, at = [], [], 0
        for v, k in zip(lists, kinds):
            here = again[at : at + len(v)]
            marks.append(np.packbits(shared[here]).tobytes() + np.flatnonzero(hot[here]).astype("<u4").tobytes())
            singles.append(int(k[hot[here]].sum()) * (length - min(ANCHOR, length) + 1))
            at += len(v)
        return pd.DataFrame({"seg": df["seg"], "bucket": df["bucket"], "marks": marks, "singles": singles})

    return run


# Runs at shared anchors


def _classes(r: dict, length: int, bits: int):
    """The shared runs of a segment and their distinct contents; the same each time it is called. Runs at hot anchors come as single windows.

    Gives (ids, data, offsets, runs, class of each run, run that stands for each class: that of the smallest doc_id, codes of
    the contents, which runs are at hot anchors).
    """
    ids, data, off = _opened(r["ids"], r["lens"], r["data"])
    a, b, at, text, code = anchors_of(data, off, length)
    key, again = np.unique(_short(code, bits), return_inverse=True)
    edges = np.searchsorted(key, np.arange(2**bits + 1, dtype=np.uint64) << np.uint64(32))
    shared, hot = np.zeros(len(key), bool), np.zeros(len(key), bool)
    for m in r["marks"] or []:
        s, e = edges[m["bucket"]], edges[m["bucket"] + 1]
        shared[s:e] = np.unpackbits(np.frombuffer(m["marks"], np.uint8), count=e - s)
        hot[s + np.frombuffer(m["marks"], "<u4", offset=(int(e - s) + 7) // 8).astype(np.int64)] = True
    pick = np.flatnonzero(shared[again]) if len(again) else np.empty(0, np.int64)
    single = hot[again[pick]] if len(again) else np.empty(0, bool)
    n = np.where(single, b[pick] - a[pick] + 1, 1)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pick, single = np.repeat(pick, n), np.repeat(single, n)
    a, b, at, text, code = a[pick] + j, np.where(single, a[pick] + j, b[pick]), at[pick], text[pick], code[pick]
    content = _contents(data, off, (a, b, at, text, code), length)
    order = np.lexsort((a, ids[text], content))
    new = np.ones(len(order), bool)
    new[1:] = content[order][1:] != content[order][:-1]
    cls = np.empty(len(order), np.int64)
    cls[order] = np.cumsum(new) - 1
    return ids, data, off, (a, b, at, text, code), cls, order[new], content, single


def _entries(length: int, bits: int, parts: int):
    """Buckets below 2**bits are those of anchors, the `parts` after them hold single windows of hot anchors."""
    schema = pa.schema([("bucket", pa.int32()), ("seg", pa.int64()), ("n", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for r in _rows(batches):
            ids, data, _, (a, b, at, text, code), _, rep, content, single = _classes(r, length, bits)
            bucket = (code[rep] >> np.uint64(64 - bits)).astype(np.int64)
            bucket[single[rep]] = 2**bits + (content[rep][single[rep]] % np.uint64(parts)).astype(np.int64)
            rows: list[list] = [[], [], [], []]
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(2**bits + parts + 1))
            for k in np.flatnonzero(np.diff(edges)):
                c = order[edges[k] : edges[k + 1]]
                x = rep[c]
                size = b[x] + length - a[x]
                take = np.repeat(a[x] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                blob = b"".join([ids[text[x]].tobytes(), c.astype("<i4").tobytes(), (at[x] - a[x]).astype("u1").tobytes(), size.astype("<u2").tobytes(), data[take].tobytes()])
                for col, v in zip(rows, (int(k), r["seg"], len(c), squeeze(blob))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return run


def _verdicts(length: int):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        """Per segment and class, a bit for each window: it occurs in a document with a smaller doc_id."""
        docs, classes, lefts, sizes, texts = [], [], [], [], []
        for n, blob in zip(df["n"], df["blob"]):
            raw = zstandard.ZstdDecompressor().decompress(blob)
            docs.append(np.frombuffer(raw, np.int64, n))
            classes.append(np.frombuffer(raw, "<i4", n, 8 * n))
            lefts.append(np.frombuffer(raw, "u1", n, 12 * n))
            sizes.append(np.frombuffer(raw, "<u2", n, 13 * n))
            texts.append(np.frombuffer(raw, "u1", -1, 15 * n))
        doc, left, size = np.concatenate(docs), np.concatenate(lefts).astype(np.int64), np.concatenate(sizes).astype(np.int64)
        data = np.concatenate(texts)
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        head, code = np.empty(len(doc), np.uint64), np.empty(len(doc), np.uint64)
        for x, y, d, o in blocks(data, np.concatenate([start, [len(data)]]), 1 << 18):
            s = o[:-1]
            code[x:y] = mixed(word_codes(d, s, o[1:], lower=False) + left[x:y].astype(np.uint64))
            head[x:y] = word_codes(d, s + left[x:y], s + left[x:y] + min(ANCHOR, length), lower=False)
        # Equal runs: all windows of the later ones are covered.
        order = np.lexsort((doc, code))
        new = np.ones(len(order), bool)
        new[1:] = code[order][1:] != code[order][:-1]
        first = np.empty(len(order), np.int64)
        first[order] = order[new][np.cumsum(new) - 1]
        smallest = doc[first]
        bits = np.where(doc > smallest, (np.int64(1) << (size - length + 1)) - 1, 0)
        # One run of each kind is left; where an anchor has several kinds, their windows are compared. Runs of one window each
        # (all those of hot anchors) are told apart already.
        rest = order[new]
        _, again, count = np.unique(head[rest], return_inverse=True, return_counts=True)
        longer = np.bincount(again, size[rest] > length, len(count))
        some = np.flatnonzero((count[again] > 1) & (longer[again] > 0))
        some = some[np.argsort(again[some], kind="stable")]
        rest, again = rest[some], again[some]
        windows = size[rest] - length + 1
        # Portions of whole anchors: equal windows have equal anchors.
        upto = np.cumsum(windows)
        ends = np.flatnonzero(np.append(again[1:] != again[:-1], True)) + 1 if len(rest) else []
        x = 0
        for k, y in enumerate(ends):
            if y < len(rest) and upto[ends[k + 1] - 1] - (upto[x - 1] if x else 0) <= HEADS_AT_ONCE:
                continue
            n = windows[x:y]
            owner = np.repeat(rest[x:y], n)
            j = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            heads = np.lib.stride_tricks.sliding_window_view(data, length)[start[owner] + j]
            hit = covered_heads(np.ascontiguousarray(heads).view(f"S{length}").ravel(), doc[owner])
            np.bitwise_or.at(bits, owner[hit], np.int64(1) << j[hit])
            x = y
        # A repeated row of the first document, in another segment, loses what the first one loses.
        twin = doc == smallest
        bits[twin] = bits[first[twin]]
        out, at = [], 0
        for c in classes:
            some = np.flatnonzero(bits[at : at + len(c)])
            out.append(c[some].astype("<i4").tobytes() + bits[at + some].astype("<i8").tobytes())
            at += len(c)
        del data, texts
        release_memory()
        return pd.DataFrame({"seg": df["seg"], "hits": out})

    return run


def _cut(length: int, bits: int, schema: pa.Schema, carry_types: list[pa.DataType], with_text: bool, digests: bool):
    def run(batches):
        for r in _rows(batches):
            ids, data, off, (a, b, _, text, _), cls, rep, _, _ = _classes(r, length, bits)
            seen = np.zeros(len(rep), np.int64)
            for h in r["hits"] or []:
                n = len(h) // 12
                seen[np.frombuffer(h, "<i4", n)] = np.frombuffer(h, "<i8", n, 4 * n)
            own = seen[cls]
            later = ids[text] > ids[text[rep[cls]]]
            own[later] = (np.int64(1) << (b - a + 1)[later]) - 1
            hit = np.flatnonzero(own)
            windows = (b - a + 1)[hit]
            j = np.arange(windows.sum()) - np.repeat(np.concatenate([[0], np.cumsum(windows)])[:-1], windows)
            on = (np.repeat(own[hit], windows) >> j) & 1 == 1
            place = (np.repeat(a[hit], windows) + j)[on]
            diff = np.zeros(len(data) + 1, np.int32)
            diff[place] += 1
            diff[place + length] -= 1  # places are distinct
            gone = np.cumsum(diff[:-1]) > 0
            start = gone.copy()
            start[1:] &= ~gone[:-1]
            at = off[:-1][np.diff(off) > 0]
            start[at] = gone[at]
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
            kept = [data[s:e][~gone[s:e]].tobytes() for s, e in zip(off[:-1], off[1:])]
            cols = []
            if digests:
                cols = [pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(np.diff(off)), pa.array(total(gone)), pa.array(total(start))]
                cols.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept]))
            if with_text:
                cols.append(pa.array([k.decode("utf-8", "ignore") for k in kept]))
            if r["rest"]:
                rest = pa.ipc.open_stream(r["rest"]).read_all().combine_chunks()
                cols += [rest.column(i).combine_chunks().cast(t) for i, t in enumerate(carry_types)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, with_text: bool = False, digests: bool = True
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 with `kept_text` and the `carry` columns
    where asked for; without `digests` only those.

    A byte goes if a `length`-byte string that covers it also starts in a document with a smaller doc_id, judged on the
    input texts. Null text is empty. Rows that share a doc_id do not cut each other; a null doc_id counts as smallest.
    `length` may be 8 to 64. kept_text drops bytes of a character that was cut in two. Empty table: no rows.
    """
    if not 8 <= length <= 64:
        raise ValueError("length must be 8 to 64")
    carry = carry or []
    spark = docs.sparkSession
    seg = written(segments(docs, text_col, id_col, carry), "segments")
    total = seg.agg(F.count(F.lit(1)).alias("n")).first()["n"] * SEGMENT_BYTES
    bits = max(6, min(30, math.ceil(math.log2(max(1, total / BUCKET_BYTES)))))
    texts = seg.select("seg", "ids", "lens", "data")
    lists = texts.mapInArrow(_anchor_lists(length, bits), "bucket int, seg long, vals binary, several binary, more binary")
    marks = written(lists.groupBy("bucket").applyInPandas(_shared_marks(length, HOT_KINDS), "seg long, bucket int, marks binary, singles long"), "marks")
    parts = max(1, math.ceil((marks.agg(F.sum("singles").alias("n")).first()["n"] or 0) / WINDOWS_A_PART))
    marks = marks.groupBy("seg").agg(F.collect_list(F.struct("bucket", "marks")).alias("marks"))  # 2**bits small rows a segment
    entries = texts.join(marks, "seg").mapInArrow(_entries(length, bits, parts), "bucket int, seg long, n int, blob binary")
    hits = written(entries.groupBy("bucket").applyInPandas(_verdicts(length), "seg long, hits binary"), "hits")
    hits = hits.groupBy("seg").agg(F.collect_list("hits").alias("hits"))
    kept = [docs.select(docs[c].alias(c)).schema[0] for c in carry]
    fields = ["doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"] * digests + ["kept_text string"] * with_text
    out = StructType.fromDDL(", ".join(fields))
    for f in kept:
        out = out.add(f.name, f.dataType, True)
    schema = to_arrow_schema(out)
    cut = seg.join(marks, "seg", "left").join(hits, "seg", "left")
    types = [schema.field(i).type for i in range(len(schema) - len(carry), len(schema))]
    return cut.mapInArrow(_cut(length, bits, schema, types, with_text, digests), out)
