"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > j) = sigmoid(w.x - t_j): one weight vector over hashed text features for all grades, and ordered thresholds t_0 < t_1 < ...
Features are the distinct whole words, their beginnings, and every byte run of GRAM bytes inside long words, so text without spaces
is seen whole (each in two hash buckets, so that one collision never decides); and the shares of words by their leading and trailing
marks, by their case, and of those that repeat the word before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import release_memory, written
from harrow.llm.text import blocks, column_bytes, mixed, word_codes, word_spans

BUCKETS = 1 << 20
#: Bytes of a word's beginning that make a feature, beside the whole word.
BEGINNINGS = (4, 6)
#: Words of more bytes than LONG_WORD also give the runs of GRAM bytes that start at their characters.
LONG_WORD, GRAM = 16, 6
#: Values of a beginning, and of a whole word or a run: these are many and rarer, so each counts for less.
BEGINNING_VALUE, WORD_VALUE = 0.5, 0.1
#: Rated documents used for fitting, at most: those whose doc_id hashes lowest.
MAX_RATED = 8_000
STEPS = 150
SHARE_SCALE = 8.0
#: Buckets with fewer rated documents get no weight.
LEAST_DOCS = 8

_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value) of whole texts, sorted by text."""
    n = len(offsets) - 1
    s, e, text = word_spans(data, offsets)
    if not len(s):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    a, b = s.copy(), e.copy()
    live = np.arange(len(s))
    while len(live):
        live = live[(a[live] < e[live]) & _MARK[data[np.minimum(a[live], len(data) - 1)]]]
        a[live] += 1
    live = np.arange(len(s))
    while len(live):
        live = live[(b[live] > a[live]) & _MARK[data[b[live] - 1]]]
        b[live] -= 1
    words = np.bincount(text, minlength=n)
    # Shares of words by their marks before and after, and by case.
    head, tail = word_codes(data, s, a), word_codes(data, b, e)
    caps = (b - a > 1) & _UPPER[data[np.minimum(a, len(data) - 1)]] & _UPPER[data[np.maximum(b - 1, 0)]]
    whole = word_codes(data, s, e)
    again = np.zeros(len(s), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (text[1:] == text[:-1])
    kinds = [mixed(again.astype(np.uint64) + np.uint64(9)), mixed(head + np.uint64(1)), mixed(tail + np.uint64(2)), mixed(caps.astype(np.uint64) + np.uint64(3)), mixed((a == b).astype(np.uint64) + np.uint64(7))]
    bucket = np.concatenate([(k % np.uint64(BUCKETS // 4)).astype(np.int64) for k in kinds])
    owner = np.concatenate([text] * len(kinds))
    key, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
    share = SHARE_SCALE * count / words[key // BUCKETS]
    # Distinct whole words, beginnings and runs inside long words, twice each.
    some = b > a
    lot = [np.stack([text[some].astype(np.uint64), mixed(word_codes(data, a[some], b[some]) + np.uint64(17))], 1)]
    for size in BEGINNINGS:
        some = b - a >= size
        lot.append(np.stack([text[some].astype(np.uint64), word_codes(data, a[some], a[some] + size)], 1))
    long = np.flatnonzero(b - a > LONG_WORD)
    runs = b[long] - a[long] - GRAM + 1
    owner = np.repeat(long, runs)
    start = a[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    first = (data[start] & 0xC0) != 0x80
    lot.append(np.stack([text[owner[first]].astype(np.uint64), mixed(word_codes(data, start[first], start[first] + GRAM) + np.uint64(19))], 1))
    values = np.concatenate([np.full(len(x), v) for x, v in zip(lot, (WORD_VALUE, *[BEGINNING_VALUE] * len(BEGINNINGS), WORD_VALUE))])
    lot = np.concatenate(lot)
    order = np.lexsort((lot[:, 1], lot[:, 0]))
    new = np.ones(len(lot), bool)
    new[1:] = (lot[order][1:] != lot[order][:-1]).any(1)
    code = lot[order][new]
    rest = np.uint64(BUCKETS - BUCKETS // 4)
    both = np.concatenate([BUCKETS // 4 + (mixed(code[:, 1] + np.uint64(k)) % rest).astype(np.int64) for k in (11, 13)])
    owner = np.concatenate([key // BUCKETS, code[:, 0].astype(np.int64), code[:, 0].astype(np.int64)])
    bucket = np.concatenate([key % BUCKETS, both])
    value = np.concatenate([share, np.tile(values[order][new], 2)])
    order = np.argsort(owner, kind="stable")
    return owner[order], bucket[order], value[order]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) per row and threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros(len(offsets) - 1)
        for s, e, d, o in blocks(data, offsets):
            owner, bucket, value = features(d, o)
            out[s:e] = np.bincount(owner, self.weights[bucket] * value, e - s)
        return out


#: Feature values of one training chunk, about; and ranges of doc_id by which the rated sample comes to the driver.
CHUNK_VALUES = 1 << 18
SAMPLE_RANGES = 16

Chunk = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # grades, text number, bucket, value


def fit_chunks(chunks: Callable[[], Iterable[Chunk]], steps: int = STEPS, decay: float = 3e-4) -> OrdinalModel:
    """Maximum likelihood by Adam over all rows, with a rate that falls to zero; gaps between thresholds stay positive through exp.

    `chunks` is read twice: to count, then to keep what has weights in compact types. Every step goes through all chunks,
    so what it needs besides them is bounded by one chunk.
    """
    docs_with, grade_counts = np.zeros(BUCKETS, np.int64), np.zeros(0, np.int64)
    for grade, _, bucket, _ in chunks():
        docs_with += np.bincount(bucket, minlength=BUCKETS)
        here = np.bincount(grade, minlength=len(grade_counts))
        here[: len(grade_counts)] += grade_counts
        grade_counts = here
    used = np.flatnonzero(docs_with >= LEAST_DOCS)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    n, top = int(grade_counts.sum()), max(len(grade_counts) - 1, 0)
    if not top:
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.empty(0))
    data = []
    for grade, owner, bucket, value in chunks():
        local = place[bucket]
        some = local >= 0
        data.append((grade.astype(np.int64), owner[some].astype(np.int32), local[some], value[some].astype(np.float32)))
    share = (np.cumsum(grade_counts[::-1])[::-1][1:] / n).clip(1e-3, 1 - 1e-3)
    start = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    params = [np.zeros(len(used)), np.concatenate([start[:1], gaps])]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]

    def thresholds(p):
        return np.cumsum(np.concatenate([p[:1], np.exp(p[1:])]))

    def cdf(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for step in range(1, steps + 1):
        edges = np.concatenate([[-np.inf], thresholds(params[1]), [np.inf]])
        g_w, g_t = decay * params[0], np.zeros(top + 2)
        for grade, owner, local, value in data:
            score = np.bincount(owner, params[0][local] * value, len(grade))
            upper, lower = cdf(edges[grade + 1] - score), cdf(edges[grade] - score)
            chance = np.maximum(upper - lower, 1e-12)
            du, dl = upper * (1 - upper) / chance, lower * (1 - lower) / chance
            np.add.at(g_t, grade + 1, -du / n)
            np.add.at(g_t, grade, dl / n)
            g_w += np.bincount(local, ((du - dl) / n)[owner] * value, len(used))  # d loss / d score, spread over the weights
        tail = np.cumsum(g_t[1:-1][::-1])[::-1]
        rate = 0.2 * (1 - (step - 1) / steps)
        for i, g in enumerate((g_w, np.concatenate([tail[:1], tail[1:] * np.exp(params[1][1:])]))):
            m[i] += 0.1 * (g - m[i])
            v[i] += 0.001 * (g * g - v[i])
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    dense = np.zeros(BUCKETS, np.float32)
    dense[used] = params[0]
    return OrdinalModel(dense, thresholds(params[1]))


def _chunked(rows: Iterable) -> Iterator[Chunk]:
    """Rows (grade, n, buckets, vals) gathered into chunks of about CHUNK_VALUES values."""
    lot, size = [], 0

    def chunk():
        owner = np.repeat(np.arange(len(lot), dtype=np.int32), [r["n"] for r in lot])
        grade = np.array([r["grade"] for r in lot], np.int64)
        return grade, owner, np.frombuffer(b"".join(r["buckets"] for r in lot), "<i4"), np.frombuffer(b"".join(r["vals"] for r in lot), "<f4")

    for r in rows:
        lot.append(r)
        size += r["n"]
        if size >= CHUNK_VALUES:
            yield chunk()
            lot, size = [], 0
    if lot:
        yield chunk()


def fit(docs: DataFrame, ratings: DataFrame, max_rated: int = MAX_RATED) -> OrdinalModel:
    """Fit on rated documents (doc_id, grade 0, 1, ...), at most `max_rated` of them, chosen by a hash of doc_id.

    Ratings or documents with a null doc_id and null grades are left out; of several ratings of a document the lowest counts.
    Without ratings of two grades the model has no threshold and keeps everything. The features of the sample are written to
    the shared folder and come to the driver in ranges of doc_id, one at a time.
    """
    rated = ratings.select(ratings["doc_id"].cast("long").alias("doc_id"), ratings["grade"].cast("int").alias("grade"))
    rated = rated.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    sample = F.broadcast(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rated))  # at most max_rated rows
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).join(sample, "doc_id").select("doc_id", "grade", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("n", pa.int64()), ("buckets", pa.binary()), ("vals", pa.binary())])

    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column(2))
            for s, e, d, o in blocks(data, off):
                owner, bucket, value = features(d, o)
                at = np.searchsorted(owner, np.arange(e - s + 1))
                cols = [b.column(0)[s:e], b.column(1)[s:e], pa.array(np.diff(at))]
                cols += [pa.array([x[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()) for x in (bucket.astype("<i4"), value.astype("<f4"))]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    rows = written(chosen.mapInArrow(run, "doc_id long, grade int, n long, buckets binary, vals binary"), "rated")
    rows = rows.repartitionByRange(SAMPLE_RANGES, "doc_id").sortWithinPartitions("doc_id", "grade", "n", "buckets", "vals")
    model = fit_chunks(lambda: _chunked(rows.toLocalIterator()))
    release_memory()
    return model


def _kept(model: OrdinalModel, above: np.ndarray, least: float) -> np.ndarray:
    return above[:, -1] >= least if len(model.thresholds) else np.ones(len(above), bool)


def graded(docs: DataFrame, model: OrdinalModel, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_top (chance of the top grade), keep, for every whole text.

    Null and empty texts have no features and get the thresholds' own chances. Repeated rows stay repeated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("p_top", pa.float64()), ("keep", pa.bool_())])

    def run(batches):
        m = shared.value
        for b in batches:
            above = m.above(m.scores(*column_bytes(b.column(1))))
            keep = _kept(m, above, least)
            top = above[:, -1] if len(m.thresholds) else np.ones(len(above))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(above.sum(1)), pa.array(top), pa.array(keep)], schema=schema)

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, expected_grade double, p_top double, keep boolean")


def selected(docs: DataFrame, model: OrdinalModel, least: float = 0.5) -> DataFrame:
    """The rows of `docs` whose chance of the top grade is at least `least`; all columns, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for b in batches:
            keep = _kept(m, m.above(m.scores(*column_bytes(b.column(at)))), least)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades from the labels table: 0 poor quality, 1 good but toxic, 2 good."""
    toxic = F.coalesce("toxic", F.lit(0)) > 0
    return labels.select("doc_id", F.when(F.col("quality") <= 0, 0).when(F.col("quality") > 0, F.when(toxic, 1).otherwise(2)).alias("grade"))
