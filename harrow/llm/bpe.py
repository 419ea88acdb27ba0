"""Byte-pair encoding and decoding by dynamic programming over prefixes (the method is in `merges.PrefixTable`)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harrow.llm.common import batch, doc_texts
from harrow.llm.encoders import ByteEncoder, worker_copy
from harrow.llm.text import blocks, column_bytes

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_FULL = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _runs(column, size: int = 4 << 20):
    """(first row, texts) of runs of about `size` bytes."""
    data, off = column_bytes(column)
    for a, b, d, o in blocks(data, off, size):
        raw, o = d.tobytes(), o.tolist()
        yield a, b, [raw[s:e].decode("utf-8", "replace") for s, e in zip(o, o[1:])]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text.

    Null or empty text: no ids, decoded to an empty text. Repeated rows and a null doc_id stay as they are; an empty table gives
    no rows; other columns are not read.
    """

    def run(batches):
        m = worker_copy(ByteEncoder, path)
        for b in batches:
            for s, e, texts in _runs(b.column(1)):
                ids = m.encode(texts)
                lists = [np.frombuffer(i, "<u4").astype(np.int32) for i in ids]
                yield batch(_FULL, b.column(0)[s:e], lists, [m.decode(i) for i in ids])

    return doc_texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Counts and digests of what `encoded` gives, without moving ids and texts out of the workers."""

    def run(batches):
        m = worker_copy(ByteEncoder, path)
        for b in batches:
            for s, e, texts in _runs(b.column(1)):
                ids = m.encode(texts)
                yield batch(
                    _ARROW,
                    b.column(0)[s:e],
                    [len(i) // 4 for i in ids],
                    [hashlib.sha256(i).hexdigest() for i in ids],
                    [hashlib.sha256(m.decode(i).encode()).hexdigest() for i in ids],
                )

    return doc_texts(docs).mapInArrow(run, SCHEMA)
