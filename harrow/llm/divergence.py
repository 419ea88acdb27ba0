"""Source divergence audit: how far the term use of the sources of a language lies apart, and the terms that mark a source.

Term counts form a sparse matrix with a row per (lang, source) group. Distances between rows are accumulated row by row:
a row scatters its terms through the term-major index of its block into a dense accumulator with a place per peer, so no
pair of postings is ever a record. A term that a group lacks still has a share there (the baseline), so the accumulator starts from
the distance of the baselines, and every term moves it by what it adds to that.

Blocks are hashed terms of one language, so a group with a third of all rows spreads over all of them. Languages with more than TILE sources
are also cut into tiles of sources, which bounds an accumulator; a block emits at most about four rows per entry it reads.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.llm.common import release_memory, written
from harrow.llm.text import column_bytes
from harrow.llm.words import LETTERS, word_lists

#: Counted terms a task holds before it sends them on.
HELD_TERMS = 200_000
#: Entries of a block, at least.
BLOCK_ENTRIES = 8_192
#: Sources of a tile.
TILE = 1_024
SCALE_STEPS = 3
PRIOR = 5

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def _term_counts(batches):
    """(lang, source, term, occurrences, documents), counted as far as memory allows; a null term marks that the group occurs."""
    uses: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush():
        for (lang, source), counted in uses.items():
            terms, within = [None, *counted], docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array([0, *counted.values()], pa.int64()),
                    pa.array([0, *map(within.__getitem__, counted)], pa.int64()),
                ],
                schema=_COUNTS,
            )
        uses.clear()
        docs.clear()

    held = 0
    for b in batches:
        data, off = column_bytes(b.column(2))
        for lang, source, s, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), off.tolist(), off[1:].tolist()):
            counted = uses[lang, source]
            held -= len(counted)
            seen: set[bytes] = set()
            for words in word_lists(data[s:e].tobytes(), LETTERS):
                counted.update(words)
                seen.update(words)
            docs[lang, source].update(seen)
            held += len(counted)
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()
    release_memory()


def _share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(10**9 * (n + PRIOR) / (total + PRIOR * kinds)), by long division three digits at a time: exact for totals below 9 * 10**15."""
    of = total + PRIOR * kinds
    left, out = n + PRIOR, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        grown = left * 1000
        digit = F.call_function("div", grown, of)
        out, left = out * 1000 + digit, grown - digit * of
    return out + 1


def _one_sided(p: np.ndarray, own: int | np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each `other` baseline: sum over p of |p - other| - |own - other|."""
    p = np.sort(p)
    below = np.concatenate([[0], np.cumsum(p)])
    k = np.searchsorted(p, other)
    far = below[-1] - 2 * below[k] + (2 * k - len(p)) * other
    return far - len(p) * np.abs(own - other)


def accumulated(rows: pd.DataFrame, peers: pd.DataFrame, row_base: np.ndarray, peer_base: np.ndarray, kinds: int) -> np.ndarray:
    """Distances of rows x peers over the terms of one block.

    `rows` and `peers` have columns g (number of the group), term (number) and p; the bases are the groups' shares of an absent
    term, and `kinds` terms count as absent from both until the entries say otherwise.
    """
    out = kinds * np.abs(row_base[:, None] - peer_base[None, :])
    # Terms of one side only: each group's terms against all baselines of the other side.
    for side, own, other, at in ((rows, row_base, peer_base, out), (peers, peer_base, row_base, out.T)):
        order = np.argsort(side["g"].to_numpy(), kind="stable")
        g, p = side["g"].to_numpy()[order], side["p"].to_numpy()[order]
        for s, e in _runs(g):
            at[g[s]] += _one_sided(p[s:e], own[g[s]], other)
    # Terms of both: every row of the matrix goes through the term-major index of the peers.
    order = np.argsort(peers["term"].to_numpy(), kind="stable")
    term, h, ph = (peers[c].to_numpy()[order] for c in ("term", "g", "p"))
    order = np.argsort(rows["g"].to_numpy(), kind="stable")
    g, t, pg = (rows[c].to_numpy()[order] for c in ("g", "term", "p"))
    first, last = np.searchsorted(term, t), np.searchsorted(term, t, "right")
    for s, e in _runs(g):
        base, acc = row_base[g[s]], out[g[s]]
        n = last[s:e] - first[s:e]
        at = np.repeat(first[s:e] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        peer, theirs, mine = h[at], ph[at], np.repeat(pg[s:e], n)
        both = np.abs(mine - theirs) - np.abs(mine - peer_base[peer]) - np.abs(base - theirs) + np.abs(base - peer_base[peer])
        np.add.at(acc, peer, both)
    return out


def _runs(sorted_values: np.ndarray):
    edges = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else []
    return zip(edges, [*edges[1:], len(sorted_values)])


def _block(df: pd.DataFrame) -> pd.DataFrame:
    """Distances within one (lang, tile of rows, tile of peers, block of terms). Rows without a term are the groups."""
    i, j, block = (int(df[c].iloc[0]) for c in ("i", "j", "block"))
    groups = df[df["term"].isna()]
    entries = df[df["term"].notna()]
    sides, known = [], []
    terms = pd.factorize(entries["term"])[0] if len(entries) else np.empty(0, np.int64)
    for tile in (i, j):
        mine = groups[groups["tile"] == tile].drop_duplicates("source").sort_values("source")
        number = pd.Index(mine["source"])
        here = (entries["tile"] == tile).to_numpy()
        part = entries[here]
        sides.append(pd.DataFrame({"g": number.get_indexer(part["source"]), "term": terms[here], "p": part["p"].to_numpy(np.int64)}))
        known.append((mine["source"].to_numpy(object), mine["p"].to_numpy(np.int64)))
    kinds = int(groups["kinds"].max()) if block == 0 else 0
    out = accumulated(*sides, known[0][1], known[1][1], kinds)
    a, b = np.meshgrid(np.arange(out.shape[0]), np.arange(out.shape[1]), indexing="ij")
    a, b, value = a.ravel(), b.ravel(), out.ravel()
    source, item = known[0][0][a], known[1][0][b]
    other = source != item
    return pd.DataFrame({"lang": df["lang"].iloc[0], "source": source[other], "item": item[other], "value": value[other]})


def _counted(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, total, first): counts of the kept terms with their total in the language; a null term stands for each group.

    Tasks count what they read, so a term's rows are sources x tasks at most; one deal by (lang, term) then serves sums, totals and
    the choice of terms. `first` marks one row per kept term.
    """
    d = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = d.mapInArrow(_term_counts, "lang string, source string, term binary, n long, docs long").repartition("lang", "term")
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term").orderBy("source")
    whole = term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    told = counts.select("lang", "source", "term", "n", F.sum("n").over(whole).alias("total"), F.sum("docs").over(whole).alias("docs"), (F.row_number().over(term) == 1).alias("first"))
    return written(told.where(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs"), "kept_counts")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, block_entries: int = BLOCK_ENTRIES, tile: int = TILE) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every (lang, source) group of `docs`.

    Part `pair`: every other source of the language with the distance of the two groups, the sum over the language's kept terms (those
    in at least `least_docs` of its documents) of the differences of their shares in 10**-9. Part `term`: the `top` kept terms whose share in
    the group exceeds that in the language most. Null text, lang and source are ''; every row is a document, so repeated rows
    count each; groups without terms have baselines only, and a language without kept terms has pairs at distance 0. An
    empty table gives no rows. Only lang, source and text are read, so other columns cannot clash.
    """
    counts = _counted(docs, least_docs)
    entries = counts.where(F.col("term").isNotNull())
    langs = entries.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("total").alias("all"))
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("held"))
    groups = counts.where(F.col("term").isNull()).select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("size", "held", "kinds", "all")])
    cut = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("held").alias("held"))
    tiles = F.ceil(F.col("sources") / tile)
    wide = F.least("sources", F.lit(tile))
    blocks = F.ceil(F.col("held") / (tiles * F.greatest(F.lit(block_entries), wide * wide / 4)))
    cut = cut.select("lang", tiles.alias("tiles"), F.greatest(F.lit(1), blocks).cast("long").alias("blocks"))
    groups = written(groups.drop("held").join(cut, "lang"), "groups")

    placed = entries.join(groups, ["lang", "source"])
    shares = placed.withColumn("p", _share(F.col("n"), F.col("size"), F.col("kinds"))).withColumn("q", _share(F.col("total"), F.col("all"), F.col("kinds")))
    mark = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    terms = (
        shares.where("p > q")
        .select("lang", "source", "term", (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(mark))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    )

    home = F.pmod(F.xxhash64("source"), F.col("tiles"))
    each = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
    as_row = F.transform(each, lambda k: F.struct(home.alias("i"), k.alias("j")))
    as_peer = F.transform(each, lambda k: F.struct(k.alias("i"), home.alias("j")))
    # A pair of tiles gets both once; the diagonal is in both lists.
    spot = F.explode(F.array_distinct(F.concat(as_row, as_peer))).alias("spot")
    cols = ["lang", "spot.i", "spot.j", "block", "tile", "source", "term", "p", "kinds"]
    used = shares.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).select("*", home.alias("tile"), spot).select(*cols)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    absent = _share(F.lit(0).cast("long"), F.col("size"), F.col("kinds"))
    bases = groups.withColumn("p", F.when(F.col("kinds") > 0, absent).otherwise(F.lit(1))).withColumn("term", F.lit(None).cast("binary"))
    bases = bases.withColumn("block", every).select("*", home.alias("tile"), spot).select(*cols)
    parts = used.unionByName(bases).groupBy("lang", "i", "j", "block").applyInPandas(_block, "lang string, source string, item string, value long")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (
        parts.groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    )
    return pairs.unionByName(terms)
