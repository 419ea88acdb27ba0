"""SimHash fingerprints and the components of those that differ in few bits, by the generalised pigeonhole principle.

The 64 bits are dealt to four parts of 16, correlated bits together, so that what documents have in common crowds few parts. Two
fingerprints within `bits` bits of each other are, for any thresholds t_i that sum to bits - 3 (-1: the part is not probed), within t_i in some
part i. Every fingerprint gets its own thresholds: dynamic programming over the parts takes the least work, estimated from the counts
of all part values. It probes the values within its thresholds, and what meets in a bucket is verified.

A bucket with too many fingerprints is divided by the parts not used yet, with the threshold that is left, by the same rule; with three parts
fixed a bucket holds 2**16 fingerprints at most, whatever the data. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import components, doc_texts, release_memory, written
from harrow.llm.text import column_bytes
from harrow.llm.words import SOLID, word_lists

SEED = 42
PARTS, WIDTH = 4, 16
VALUES = 1 << WIDTH
#: Fingerprints of a bucket that are compared with each other; larger ones are divided.
LIMIT = 4_096
#: A probe sent costs about as much as so many comparisons.
PROBE_COST = 200
#: Rows verified at once; more than three times what a bucket can hold.
CHUNK = 1 << 18
#: Roles of a row in its bucket, in the order they are sorted.
PROBING, SILENT, VISITOR = range(3)


# Fingerprints


def _added(words: list[bytes], k: int, ones: np.ndarray) -> int:
    """Adds the hashes of all k-word shingles bit by bit; returns their number."""
    n = len(words) - k + 1
    if n < 1:
        return 0
    text = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    starts = ends - size
    slices = map(text.__getitem__, map(slice, starts[:n].tolist(), (ends[k - 1 :] - 1).tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), np.uint64, n)
    for s in range(0, n, 1 << 16):
        part = h[s : s + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return n


def fingerprint(text: bytes, k: int = 3) -> int:
    """Bit b is set if it is set in over half the XXH64 hashes of the k-word shingles; without words zero."""
    ones = np.zeros(64, np.int64)
    total, tail, few = 0, [], []
    for words in word_lists(text, SOLID):
        words = tail + words
        total += _added(words, k, ones)
        tail = words[max(0, len(words) - k + 1) :]
        few = words
    if not total and few:
        total = _added(few, len(few), ones)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0]) if total else 0


def _fingerprints(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column(1))
            found = [fingerprint(data[s:e].tobytes(), k) for s, e in zip(off.tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], schema=schema)
        release_memory()

    return run


# Parts


def _bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def reordered(fps: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bit order[i] of each fingerprint becomes bit i."""
    bits = np.packbits(_bits_of(np.ascontiguousarray(fps))[:, order], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).ravel()


def _together(batches):
    """How often two bits are set together, for all fingerprints of a partition: key 64 * a + b."""
    total, n = np.zeros((64, 64), np.int64), 0
    for b in batches:
        fps = b.column(0).to_numpy().view(np.uint64)
        for s in range(0, len(fps), 1 << 16):
            bits = _bits_of(np.ascontiguousarray(fps[s : s + (1 << 16)])).astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
        n += len(fps)
    keys, counts = np.arange(64 * 64 + 1), np.append(total.ravel(), n)
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts)], names=["key", "c"])


def bit_order(together: np.ndarray, n: int) -> np.ndarray:
    """Bits in the order of the parts: each part takes a bit, then again and again the one most correlated with those it has."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 0))
    scale = np.outer(spread, spread)
    near = np.abs(np.divide(together / max(n, 1) - np.outer(p, p), scale, out=np.zeros((64, 64)), where=scale > 0))
    np.fill_diagonal(near, 0)
    left, out = np.ones(64, bool), []
    for _ in range(PARTS):
        mine = [int(np.argmax(np.where(left, (near * left).sum(1), -1)))]
        left[mine[0]] = False
        while len(mine) < WIDTH:
            mine.append(int(np.argmax(np.where(left, near[mine].sum(0), -1))))
            left[mine[-1]] = False
        out += sorted(mine)
    return np.array(out)


def _value_counts(order: np.ndarray):
    """Counts of all part values in a partition: key VALUES * part + value."""

    def run(batches):
        counts = np.zeros(PARTS * VALUES, np.int64)
        for b in batches:
            fps = reordered(b.column(0).to_numpy().view(np.uint64), order)
            for i in range(PARTS):
                np.add.at(counts, VALUES * i + _part(fps, i), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], names=["key", "c"])

    return run


def _part(fps: np.ndarray, i: int) -> np.ndarray:
    return ((fps >> np.uint64(WIDTH * i)) & np.uint64(VALUES - 1)).astype(np.int64)


@lru_cache(maxsize=8)
def masks(radius: int) -> np.ndarray:
    """Part values with exactly `radius` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(WIDTH), radius)], np.int64)


def costs(counts: np.ndarray, bits: int, limit: int) -> np.ndarray:
    """[part, units, value]: estimated work for units = threshold + 1, from 0 (not probed) to bits + 1."""
    capped = np.minimum(counts, limit)  # what is beyond is divided
    at = np.arange(VALUES)
    out, near, sent = [np.zeros_like(capped)], capped.copy(), 0
    out.append(near.copy())
    for r in range(1, bits + 1):
        for m in masks(r):
            near += capped[:, at ^ m]
        sent += len(masks(r))
        out.append(near + PROBE_COST * sent)
    return np.stack(out, axis=1)


def thresholds(cost: np.ndarray, units: int) -> np.ndarray:
    """Least-cost units per part with the given sum: cost is [part, units, row]; the result [part, row]."""
    parts, _, n = cost.shape
    best, picks = np.full((units + 1, n), np.iinfo(np.int64).max // 4), []
    best[0] = 0
    for i in range(parts):
        sums = np.stack([[best[u - x] + cost[i, x] if x <= u else np.full(n, np.iinfo(np.int64).max // 2) for x in range(units + 1)] for u in range(units + 1)])
        picks.append(sums.argmin(1))
        best = sums.min(1)
    out, left, rows = np.zeros((parts, n), np.int64), np.full(n, units), np.arange(n)
    for i in range(parts - 1, -1, -1):
        out[i] = picks[i][left, rows]
        left -= out[i]
    return out


# Buckets: `path` says which parts are fixed, in the order they were, as digits to the base PARTS + 1; `key` has their values in place.


class Dealer:
    """Deals fingerprints to buckets."""

    def __init__(self, counts: np.ndarray, bits: int, limit: int):
        self.counts, self.bits, self.limit, self.cost = counts, bits, limit, costs(counts, bits, limit)

    def first(self, fps: np.ndarray):
        """Bucket rows of whole fingerprints; those of buckets that are too large are divided at once."""
        zero = np.zeros(len(fps), np.uint64)
        for path, key, fp, role in self.divided(0, zero, fps, np.zeros(len(fps), np.int8)):
            large = self.counts[path - 1][_part(key, path - 1)] > self.limit
            if (~large).any():
                yield path, key[~large], fp[~large], role[~large]
            if large.any():
                yield from self.divided(path, key[large], fp[large], role[large])

    def divided(self, path: int, key: np.ndarray, fp: np.ndarray, role: np.ndarray):
        """Rows of the buckets one part further, for rows of buckets of one path."""
        fixed, p = [], path
        while p:
            fixed.append(p % (PARTS + 1) - 1)
            p //= PARTS + 1
        mask = np.uint64(sum((VALUES - 1) << (WIDTH * i) for i in fixed))
        used = np.bitwise_count((fp ^ key) & mask).astype(np.int64)
        free = [i for i in range(PARTS) if i not in fixed]
        for spent in np.unique(used):
            rows = used == spent
            k, f, r = key[rows], fp[rows], role[rows]
            values = [_part(f, i) for i in free]
            units = int(self.bits + 1 - spent)
            plan = thresholds(np.stack([self.cost[i][:, v] for i, v in zip(free, values)])[:, : units + 1], units)
            for i, v, t in zip(free, values, plan):
                to, place = path * (PARTS + 1) + i + 1, np.uint64(WIDTH * i)
                home, asks = r != VISITOR, r != SILENT
                own = k | (v.astype(np.uint64) << place)
                yield to, own[home], f[home], np.where(asks & (t > 0), PROBING, SILENT).astype(np.int8)[home]
                here = ~home & (t > 0)
                yield to, own[here], f[here], np.full(int(here.sum()), VISITOR, np.int8)
                for radius in range(1, int(t.max(initial=0))):
                    far = asks & (t > radius)
                    if far.any():
                        each = masks(radius)
                        there = (v[far][:, None] ^ each[None, :]).astype(np.uint64) << place
                        yield to, (k[far][:, None] | there).ravel(), np.repeat(f[far], len(each)), np.full(there.size, VISITOR, np.int8)


_ROWS = pa.schema([("path", pa.int32()), ("key", pa.int64()), ("fp", pa.int64()), ("role", pa.int8())])
_ROWS_SQL = "path int, key long, fp long, role tinyint"
STEP = 1 << 14


def _row_batch(path, key, fp, role):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), path, np.int32)), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(role)], schema=_ROWS
    )


def _dealt(dealer, order: np.ndarray):
    def run(batches):
        for b in batches:
            fps = reordered(b.column(0).to_numpy().view(np.uint64), order)
            for s in range(0, len(fps), STEP):
                for rows in dealer.value.first(fps[s : s + STEP]):
                    yield _row_batch(*rows)

    return run


def _divided(dealer):
    def run(batches):
        for b in batches:
            path, key, fp, role = (c.to_numpy() for c in b.columns)
            for p in np.unique(path):
                at = np.flatnonzero(path == p)
                for s in range(0, len(at), STEP):
                    some = at[s : s + STEP]
                    for rows in dealer.value.divided(int(p), key[some].view(np.uint64), fp[some].view(np.uint64), role[some]):
                        yield _row_batch(*rows)

    return run


# Verification


def near_pairs(bucket: np.ndarray, fp: np.ndarray, role: np.ndarray, bits: int):
    """Pairs (a, b) of fingerprints of one bucket within `bits` bits, one of which asks; rows are sorted by bucket and role."""
    n = len(bucket)
    new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    stop = np.repeat(np.append(new[1:], n), np.diff(np.append(new, n)))
    visits = np.concatenate([[0], np.cumsum(role != VISITOR)])
    begin = np.repeat(new, np.diff(np.append(new, n)))
    visitors_from = begin + visits[stop] - visits[begin]
    # A probing row meets all rows after it, a silent one the visitors; visitors do not meet each other.
    a = np.flatnonzero(role != VISITOR)
    b = np.where(role[a] == PROBING, a + 1, visitors_from[a])
    while True:
        open_rows = b < stop[a]
        a, b = a[open_rows], b[open_rows]
        if not len(a):
            return
        x, y = fp[a], fp[b]
        some = (np.bitwise_count(x ^ y) <= bits) & (x != y)
        if some.any():
            yield x[some], y[some]
        b = b + 1


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what the given edges connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for side in (root[x], root[y]):
            np.minimum.at(new, side, low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _meet(bits: int, order: np.ndarray, chunk: int = CHUNK, edges_held: int = 1 << 20):
    """Verifies buckets that come whole and sorted by (path, key, role); of a very long one only its own fingerprints stay in memory."""
    back = np.argsort(order)

    def found(bucket, fp, role):
        xs, ys, held = [], [], 0
        for x, y in near_pairs(bucket, fp, role, bits):
            xs.append(x)
            ys.append(y)
            held += len(x)
            if held > edges_held:
                x, y = spanning(np.concatenate(xs), np.concatenate(ys))
                xs, ys, held = [x], [y], 0
        if xs:
            x, y = spanning(np.concatenate(xs), np.concatenate(ys))
            yield pa.RecordBatch.from_arrays([pa.array(reordered(v, back).view(np.int64)) for v in (x, y)], schema=_EDGES)

    def run(batches):
        path, key, fp, role = (np.empty(0, t) for t in (np.int32, np.int64, np.uint64, np.int8))
        for b in batches:
            new = [c.to_numpy() for c in b.columns]
            path, key = np.concatenate([path, new[0]]), np.concatenate([key, new[1]])
            fp, role = np.concatenate([fp, new[2].view(np.uint64)]), np.concatenate([role, new[3]])
            if len(path) < chunk:
                continue
            bucket = np.cumsum(np.concatenate([[0], (path[1:] != path[:-1]) | (key[1:] != key[:-1])]))
            last = int(np.searchsorted(bucket, bucket[-1]))
            if last:
                yield from found(bucket[:last], fp[:last], role[:last])
                path, key, fp, role = path[last:], key[last:], fp[last:], role[last:]
            else:
                # One bucket: its fingerprints have met each other and stay for the visitors to come.
                yield from found(bucket, fp, role)
                stay = role != VISITOR
                path, key, fp, role = path[stay], key[stay], fp[stay], np.full(int(stay.sum()), SILENT, np.int8)
        if len(path):
            bucket = np.cumsum(np.concatenate([[0], (path[1:] != path[:-1]) | (key[1:] != key[:-1])]))
            yield from found(bucket, fp, role)

    return run


def links(nodes: DataFrame, bits: int = 3, limit: int = LIMIT) -> DataFrame:
    """(a, b): enough links to connect all distinct fingerprints `fp` of `nodes` that differ in at most `bits` bits directly or through others.

    `limit` sets when buckets are divided; it has no influence on what is connected.
    """
    spark = nodes.sparkSession
    fps = nodes.select("fp")
    counted = fps.mapInArrow(_together, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).toPandas()  # 4,097 rows
    together = np.zeros(64 * 64 + 1, np.int64)
    together[counted["key"]] = counted["c"]
    order = bit_order(together[:-1].reshape(64, 64), int(together[-1]))
    found = fps.mapInArrow(_value_counts(order), "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).toPandas()  # 4 * 65,536 rows at most
    counts = np.zeros(PARTS * VALUES, np.int64)
    counts[found["key"]] = found["c"]
    dealer = spark.sparkContext.broadcast(Dealer(counts.reshape(PARTS, VALUES), bits, limit))

    rows = written(fps.mapInArrow(_dealt(dealer, order), _ROWS_SQL), "buckets")
    # Two parts fixed: still too large ones are divided once more. One part fixed was seen to when they were dealt.
    pairs = rows.where(f"path > {PARTS} and role < {VISITOR}").groupBy("path", "key").agg(F.count(F.lit(1)).alias("n"))
    large = written(pairs.where(F.col("n") > limit).select("path", "key"), "large")
    if large.limit(1).count():
        again = rows.join(large, ["path", "key"], "left_semi").select(*rows.columns).mapInArrow(_divided(dealer), _ROWS_SQL)
        rows = rows.join(large, ["path", "key"], "left_anti").select(*rows.columns).unionByName(again)
    placed = rows.repartition("path", "key").sortWithinPartitions("path", "key", "role")
    return placed.mapInArrow(_meet(bits, order), "a long, b long").distinct()


def linked(docs: DataFrame, k: int = 3, bits: int = 3, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), class_id (smallest doc_id with the same fingerprint), component_id.

    Fingerprints link at `bits` or fewer differing bits; component_id is the smallest doc_id that links reach. Null and
    empty texts and those without words have fingerprint zero, linked like any other. Rows that share a doc_id are one node
    through their fingerprints only, so each row has the component of its own text. Rows with a null doc_id take no part in links: they come back with
    their fingerprint and null class and component. Only doc_id and text are read, so other columns cannot clash.
    """
    prints = written(doc_texts(docs).mapInArrow(_fingerprints(k), "doc_id long, fp long"), "fingerprints")
    nodes = written(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("class_id")), "nodes")
    settled = components(links(nodes, bits, limit)).withColumnRenamed("node", "fp")
    grouped = nodes.join(settled, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = grouped.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = written(grouped.join(least, "component").select("fp", "class_id", "component_id"), "named")
    out = prints.join(named, "fp", "left")
    known = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(known, F.col("class_id")).alias("class_id"),
        F.when(known, F.col("component_id")).alias("component_id"),
    )
