"""N-gram Jaccard join by signature trees, and the components of its links.

Routing keeps the join from meeting all pairs: equal sets are one class; classes meet if they share enough of their first shingles
(very common ones come last in the order), and classes that may be linked form families. Every linked pair is in
one family. A family is joined by signature trees: leaves are sets, nodes hold the OR of their members' token bitmaps and the
range of their sizes, and two trees are walked together, dropping node pairs whose largest possible overlap is too small. What is
left is compared exactly. Large families are cut into blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from harrow.llm.common import doc_texts, written
from harrow.llm.text import blocks, by_text, column_bytes, mixed, shingles, span_codes, word_spans
from harrow.operators.graph import connected

BLOCK = 512
FAN = 8
#: Common shingles passed to the tasks, at most. Any set of them gives the same links; it only sets what comes last.
COMMON_MAX = 500_000


def _sets(column, k: int):
    """(first row, end row, owner, codes) for blocks of texts."""
    data, off = column_bytes(column)
    for s, e, d, o in blocks(data, off):
        a, b, text = word_spans(d, o)
        owner, codes = shingles(span_codes(d, a, b), text, e - s, k)
        yield s, e, owner, codes


def _fingerprints(owner: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of each text's codes, and two 64-bit sums over them that identify the set."""
    at = by_text(codes, owner, n)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes ^ np.uint64(salt)))]) for salt in (0x51ED27, 0xA3B195)]
    return at, *[mixed(s[at[1:]] - s[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64) for s in sums]


def _locally_common(k: int):
    """Shingles in two or more different sets of a batch, with their number of sets."""
    schema = pa.schema([("key", pa.int64()), ("c", pa.int64())])

    def run(batches):
        for b in batches:
            seen, parts = np.empty(0, np.int64), []
            for s, e, owner, codes in _sets(b.column(0), k):
                at, fp, _ = _fingerprints(owner, codes, e - s)
                _, first = np.unique(fp, return_index=True)
                new = np.zeros(e - s, bool)
                new[first] = True
                new &= ~np.isin(fp, seen)
                seen = np.concatenate([seen, fp[new]])
                parts.append(codes[new[owner]])
            key, count = np.unique(np.concatenate(parts or [np.empty(0, np.uint64)]), return_counts=True)
            some = count > 1
            yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array(count[some].astype(np.int64))], schema=schema)

    return run


def least_overlap(n, percent: int):
    """Smallest overlap a set of n elements has with any set it is linked to."""
    return -(-percent * n // 100)


def _described(k: int, percent: int, common):
    """Size, fingerprints and prefix of every set. Prefix: the first shingles, common ones last.

    Linked sets share `need` of their prefixes, which leave out least_overlap - need elements.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("fp_a", pa.int64()), ("fp_b", pa.int64())]
        + [("rare", pa.list_(pa.int64())), ("often", pa.list_(pa.int64()))]
    )

    def listed(codes, mask, owner, n):
        offsets = np.searchsorted(owner[mask], np.arange(n + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes[mask].view(np.int64)))

    def run(batches):
        late = common.value
        for b in batches:
            for s, e, owner, codes in _sets(b.column(1), k):
                at, fp_a, fp_b = _fingerprints(owner, codes, e - s)
                n = np.diff(at)
                if len(late):
                    often = late[np.minimum(np.searchsorted(late, codes), len(late) - 1)] == codes
                else:
                    often = np.zeros(len(codes), bool)
                order = np.lexsort((codes, often, owner))
                codes, often = codes[order], often[order]
                rank = np.arange(len(codes)) - at[owner]
                prefix = (n - least_overlap(n, percent) + needed(n, percent))[owner] > rank
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[s:e], pa.array(n), pa.array(fp_a), pa.array(fp_b), listed(codes, prefix & ~often, owner, e - s), listed(codes, prefix & often, owner, e - s)],
                    schema=schema,
                )

    return run


def needed(n, percent: int):
    """Shared prefix elements that a set of n elements asks for."""
    return np.minimum(1 + n // 30, np.maximum(1, least_overlap(n, percent)))


def _whole_sets(k: int):
    schema = pa.schema([("rep", pa.int64()), ("family", pa.int64()), ("blocks", pa.int64()), ("codes", pa.binary())])

    def run(batches):
        for b in batches:
            for s, e, owner, codes in _sets(b.column(0), k):
                at = by_text(codes, owner, e - s)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i)[s:e] for i in (1, 2, 3)], pa.array([codes[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary())],
                    schema=schema,
                )

    return run


# Signature trees


class SignatureTree:
    """Sets in order of size; level 0 holds the sets, each further level groups of FAN nodes of the one below."""

    def __init__(self, sizes: np.ndarray, codes: np.ndarray, at: np.ndarray):
        bits = 1 << max(8, min(16, int(2 * np.median(sizes)).bit_length()))
        marks = np.zeros((len(sizes), bits // 8), np.uint8)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        bit = (mixed(codes) & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(marks, (owner, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
        words = marks.view(np.uint64)
        extra = sizes - np.bitwise_count(words).sum(1, dtype=np.int64)  # elements beyond one per bit
        self.levels = [(words, sizes, sizes, extra)]
        while len(self.levels[-1][1]) > 1:
            w, lo, hi, x = self.levels[-1]
            starts = np.arange(0, len(lo), FAN)
            self.levels.append((np.bitwise_or.reduceat(w, starts), np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts), np.maximum.reduceat(x, starts)))

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Node pairs that may hold a linked pair: sizes close enough, and the largest possible overlap large enough."""
        w, lo, hi, extra = self.levels[level]
        ok = (100 * hi[a] >= percent * lo[b]) & (100 * hi[b] >= percent * lo[a])
        a2, b2 = a[ok], b[ok]
        room = np.empty(len(a2), np.int64)
        step = max(1, (32 << 20) // (8 * w.shape[1]))
        for s in range(0, len(a2), step):
            room[s : s + step] = np.bitwise_count(w[a2[s : s + step]] & w[b2[s : s + step]]).sum(1, dtype=np.int64)
        room += np.minimum(extra[a2], extra[b2])
        ok[ok] = (100 + percent) * room >= percent * (lo[a2] + lo[b2])
        return ok

    def pairs(self, percent: int):
        """Pairs a < b of sets that the walk from (root, root) could not rule out, in portions."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            ok = self._possible(level, a, b, percent) if level or len(a) else np.zeros(0, bool)
            a, b = a[ok], b[ok]
            if level == 0:
                some = a < b
                if some.any():
                    yield a[some], b[some]
                continue
            below = len(self.levels[level - 1][1])
            step = 4096
            for s in range(0, len(a), step):
                x = (a[s : s + step, None, None] * FAN + np.arange(FAN)[None, :, None]) + np.zeros((1, 1, FAN), np.int64)
                y = (b[s : s + step, None, None] * FAN + np.arange(FAN)[None, None, :]) + np.zeros((1, FAN, 1), np.int64)
                x, y = x.ravel(), y.ravel()
                keep = (x <= y) & (y < below)
                stack.append((level - 1, x[keep], y[keep]))


def tree_links(codes: list[np.ndarray], percent: int, label: np.ndarray | None = None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sets, enough to connect all that the links connect.

    Sets with one label count as connected already; with `side`, only sets of different sides are compared.
    """
    sizes = np.array([len(c) for c in codes], np.int64)
    order = np.lexsort((np.arange(len(codes)), sizes))
    sizes = sizes[order]
    codes = [codes[i] for i in order]
    flat = np.concatenate(codes)
    at = np.concatenate([[0], np.cumsum(sizes)])
    same = np.arange(len(codes)) if label is None else np.unique(label[order], return_inverse=True)[1]
    side = None if side is None else side[order]
    _, local = np.unique(flat, return_inverse=True)
    mark = np.zeros(int(local.max()) + 1 if len(local) else 0, bool)
    out = []
    for a, b in SignatureTree(sizes, flat, at).pairs(percent):
        if side is not None:
            some = side[a] != side[b]
            a, b = a[some], b[some]
        by_a = np.argsort(a, kind="stable")
        a, b = a[by_a], b[by_a]
        edges = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else []
        for s, e in zip(edges, [*edges[1:], len(a)]):
            x = a[s]
            others = b[s:e][same[b[s:e]] != same[x]]
            if not len(others):
                continue
            mine = local[at[x] : at[x + 1]]
            mark[mine] = True
            for lot in range(0, len(others), 1024):
                ys = others[lot : lot + 1024]
                n = sizes[ys]
                start = np.concatenate([[0], np.cumsum(n)[:-1]])
                take = np.repeat(at[ys] - start, n) + np.arange(n.sum())
                shared = np.add.reduceat(mark[local[take]].astype(np.int64), start)
                for y in ys[(100 + percent) * shared >= percent * (sizes[x] + n)]:
                    if same[y] != same[x]:
                        out.append((int(order[x]), int(order[y])))
                        same[same == same[y]] = same[x]
            mark[mine] = False
    return out


def _join_blocks(percent: int):
    """Joins all families of a task; a large family's block is a family of its own here."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in df.groupby(["family", "block"], sort=True):
            reps = g["rep"].to_numpy()
            codes = [np.frombuffer(c, np.uint64) for c in g["codes"]]
            label = g["label"].to_numpy() if "label" in g else None
            side = g["probe"].to_numpy() if "probe" in g else None
            out += [(reps[i], reps[j]) for i, j in tree_links(codes, percent, label, side)]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _families(reps: DataFrame, percent: int, group_max: int) -> DataFrame:
    """(node, component): classes that may be linked, directly or through others, share a component."""
    rare = reps.select("rep", "n", F.explode("rare").alias("key"))
    counted = written(rare.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("df > 1"), "shared")
    a = counted.where(F.col("df") <= group_max)
    b = a.select(F.col("rep").alias("rep_b"), F.col("n").alias("n_b"), "key")
    small, large = F.least("n", "n_b"), F.greatest("n", "n_b")
    met = a.join(b, "key").where((F.col("rep") < F.col("rep_b")) & (100 * small >= percent * large))
    need = F.least(1 + F.floor(small / 30), F.greatest(F.lit(1), F.ceil(percent * small / 100)))
    near = met.groupBy(F.col("rep").alias("a"), F.col("rep_b").alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min(need).alias("need"))
    near = near.where("c >= need").select("a", "b")
    # Larger groups are one family as a whole; their leaders are found by a partial aggregate.
    wide = counted.where(F.col("df") > group_max).select("rep", "key").union(reps.select("rep", F.explode("often").alias("key")))
    leaders = wide.groupBy("key").agg(F.min("rep").alias("a"))
    starred = wide.join(leaders, "key").where(F.col("a") < F.col("rep")).select("a", F.col("rep").alias("b"))
    return connected(near.union(starred).distinct())


def linked(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest doc_id with an equal set), component_id.

    Texts link when 100 * |A and B| >= percent * |A or B| for their sets of distinct k-word shingles (A-Z lowered, words between ASCII
    white space; a text of fewer words is one shingle). component_id is the smallest doc_id that links reach. Null and
    empty texts have no shingles and link with nothing. A doc_id names one node, so rows that share it share a
    component; rows with a null doc_id come back with null class and component. Words and shingles are told apart by 64-bit codes.
    """
    d = doc_texts(docs)
    spark = docs.sparkSession
    total = d.count()
    common_from = max(64, math.isqrt(total) // 2)
    counts = d.select("text").mapInArrow(_locally_common(k), "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    often = counts.where(F.col("c") >= common_from).orderBy(F.desc("c"), "key").limit(COMMON_MAX).select("key").toPandas()["key"]
    common = spark.sparkContext.broadcast(np.sort(often.to_numpy(np.int64).view(np.uint64)))

    sets = written(d.mapInArrow(_described(k, percent, common), "doc_id long, n long, fp_a long, fp_b long, rare array<long>, often array<long>"), "sets")
    named = sets.where("n > 0 and doc_id is not null")
    fp = ["fp_a", "fp_b", "n"]
    classes = written(named.groupBy(*fp).agg(F.min("doc_id").alias("rep")), "classes")
    reps = named.join(classes, fp).where("doc_id = rep").select("rep", "n", "rare", "often")
    families = _families(reps, percent, common_from)
    links = _family_links(d, families, k, percent)
    settled = connected(links)

    by_rep = classes.join(settled.withColumnRenamed("node", "rep"), "rep", "left").select(*fp, "rep", F.coalesce("component", "rep").alias("component"))
    out = sets.select("doc_id", *fp).join(by_rep, fp, "left")
    known = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("rep", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("component", "doc_id")).alias("component_id"),
    )


def _family_links(d: DataFrame, families: DataFrame, k: int, percent: int) -> DataFrame:
    spark = d.sparkSession
    sized = families.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    members = families.join(sized, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("family"), F.ceil(F.col("m") / BLOCK).alias("blocks"))
    texts = d.join(members.hint("merge"), "doc_id").select("text", F.col("doc_id").alias("rep"), "family", "blocks")
    sets = written(texts.mapInArrow(_whole_sets(k), "rep long, family long, blocks long, codes binary"), "members")
    # Small families share tasks; a block of a large one is a task.
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("rep"), F.col("blocks"))).otherwise(F.lit(0))
    task = F.when(F.col("blocks") > 1, F.xxhash64("family", "block")).otherwise(F.pmod(F.xxhash64("family"), F.lit(parts)))
    placed = sets.withColumn("block", block).withColumn("task", task)
    first = written(placed.groupBy("task").applyInPandas(_join_blocks(percent), "a long, b long"), "links")
    wide = placed.where("blocks > 1")
    if wide.limit(1).count() == 0:
        return first
    # Across blocks: the members outside their family's main component against all blocks of the family.
    joined = connected(first).withColumnRenamed("node", "rep").withColumnRenamed("component", "label")
    wide = wide.join(joined, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    weight = wide.groupBy("family", "label").agg(F.count(F.lit(1)).alias("m"))
    main = weight.groupBy("family").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.sum(F.lit(1)).alias("labels"))
    wide = wide.join(main, "family").where("labels > 1")
    chunks = F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("label") != F.col("main"), 1).otherwise(0)) / BLOCK))
    lots = wide.groupBy("family").agg(chunks.alias("lots"))
    wide = wide.join(lots, "family")
    cols = ["rep", "family", "label", "codes"]
    lot = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("lots"))
    target = wide.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))).select(*cols, "block", "lot", F.lit(False).alias("probe"))
    probe = (
        wide.where("label <> main")
        .withColumn("lot", lot)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(*cols, "block", "lot", F.lit(True).alias("probe"))
    )
    both = target.union(probe).withColumn("task", F.xxhash64("family", "block", "lot"))
    second = written(both.groupBy("task").applyInPandas(_join_blocks(percent), "a long, b long"), "links")
    return first.union(second)


def one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of `docs` per component: that of its smallest doc_id.

    Rows that share that doc_id are told apart by their text: the least one stays, and one of equal ones. Rows with a null doc_id are documents of their own,
    after all others, so they go where a row with a doc_id is like them, and one of them stays where none is.
    """
    spark, node = docs.sparkSession, "node"
    while node in docs.columns:
        node += "_"
    known = docs.where(F.col("doc_id").isNotNull()).withColumn(node, F.col("doc_id").cast("long"))
    nameless = docs.where(F.col("doc_id").isNull())
    if nameless.limit(1).count():
        top = known.agg(F.max(node)).first()[0] or 0
        # Beyond the largest doc_id there is no room for more: count down from the smallest.
        start = F.lit(top + 1) if top < 2**62 else F.lit(min(0, known.agg(F.min(node)).first()[0]) - 2**61)
        known = known.unionByName(written(nameless.withColumn(node, start + F.monotonically_increasing_id()), "nameless"))
    groups = linked(known.select(F.col(node).alias("doc_id"), "text"), k, percent).where("doc_id = component_id").groupBy(F.col("doc_id").alias(node)).agg(F.count(F.lit(1)).alias("rows_"))
    groups = written(groups, "kept_ids")
    kept = known.join(groups.where("rows_ = 1").select(node), node, "left_semi")
    several = groups.where("rows_ > 1").select(node)
    if several.limit(1).count():
        cols = [F.col(c) for c in docs.columns if c not in ("doc_id", "text") and not isinstance(docs.schema[c].dataType, (MapType, VariantType))]
        rank = F.row_number().over(Window.partitionBy(node).orderBy(F.col("text").asc_nulls_first(), *cols))
        order = node + "rank"
        while order in docs.columns:
            order += "_"
        kept = kept.unionByName(known.join(several, node, "left_semi").withColumn(order, rank).where(F.col(order) == 1).drop(order))
    return kept.select(*docs.columns)
