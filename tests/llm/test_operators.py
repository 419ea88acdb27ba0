"""Each operator against a brute-force version on small tables with nulls, empty and long texts, ties and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from harrow.llm import bpe, jaccard, merkle, nra, ordinal, packing, queries, suffixes, training_order, transcripts, wordpiece
from harrow.llm.common import components, public_tokenizer

BYTE, WORD = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("word_bpe_49k.json")
ODD = ["", None, "  a  b", "a<|endoftext|>b", "\t\x1c x　y \n z", "a" * 3000, "don't 's'll  we've", "日本語🙂", " lead", "tail ", "x\n\n\ny\n z", "İstanbul é<|startoftext|>A", "ab\x00c\x00"]


def _docs(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return df.withColumn("n_tokens", F.lit("clash")).withColumn("seg", F.lit(1)).withColumn("key", F.lit(None).cast("int"))


def _rows(seed=1, n=40):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abeht .,'\nA1é") for _ in range(rng.randint(1, 90))) for _ in range(n)]
    rows = list(enumerate(ODD + texts))
    return rows + [rows[20], (None, "no id")]


def _lib(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_bpe_equals_library(spark):
    lib, rows = _lib(BYTE), _rows()
    want = Counter()
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip(_docs(spark, rows), BYTE).collect())) == want
    assert {r["decoded"] for r in bpe.encoded(_docs(spark, rows), BYTE).collect()} == {t or "" for _, t in rows}


def test_packing_pieces_and_sequences(spark):
    lib = _lib(WORD)
    rng = random.Random(4)
    rows = _rows(2) + [(1000 + i, "word, " * rng.randint(1, 90)) for i in range(60)]
    got = packing.pack_documents(_docs(spark, rows), WORD, 64).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in seqs.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 64
    bound = packing.lower_bound(np.array([r["length"] for r in got]), 64)
    assert bound <= len(seqs) <= bound + 1


@pytest.mark.parametrize("seed", range(5))
def test_bounds_never_exceed_a_packing(seed):
    sizes = np.sort(np.random.default_rng(seed).integers(1, 101, 300))[::-1]
    _, _, room = packing.best_fit_decreasing(sizes, 100)
    assert packing.lower_bound(sizes, 100) <= len(room)


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_A_TASK", 20)
    rng = random.Random(1)
    items = spark.createDataFrame([(i, 0, 0, rng.randint(1, 63), 0) for i in range(300)], packing.PIECES)
    got = packing.packed(items, 64).collect()
    sizes = np.array([r["length"] for r in got])
    # Partitions of 20 items that meet their own bound keep their bins, so all together may miss the global bound by some.
    assert len(got) == 300 and len({r["sequence_id"] for r in got}) <= 1.06 * packing.lower_bound(sizes, 64)


def test_packing_rounds_never_fill_a_task(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_A_TASK", 20)
    real = packing.best_fit_decreasing

    def spied(sizes, capacity):
        assert len(sizes) <= 60, f"{len(sizes)} items in one task"
        return real(sizes, capacity)

    monkeypatch.setattr(packing, "best_fit_decreasing", spied)
    rng = random.Random(2)
    # Middle sizes leave gaps in every bin, so every round gives up nearly all bins; some rows have no id.
    rows = [(None if i % 3 == 0 else i, 0, i, rng.randint(13, 20), i) for i in range(600)]
    got = packing.packed(spark.createDataFrame(rows, packing.PIECES), 64).collect()
    assert sorted(r["start"] for r in got) == list(range(600))
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in seqs.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 64
    sizes = np.sort(np.array([r["length"] for r in got]))[::-1]
    assert len(seqs) <= 1.06 * len(real(sizes, 64)[2])  # of best-fit decreasing over the whole table


def _greedy(word, starts, rests):
    at, n = 0, 0
    while at < len(word):
        pool = starts if at == 0 else rests
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pool), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_wordpiece_lengths():
    rng = random.Random(3)
    starts = {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(25)}
    rests = {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(25)}
    words = [bytes(rng.choices(b"abcd", weights=[5, 5, 5, 0.3], k=rng.randint(1, 14))) for _ in range(800)]
    ends = np.cumsum([len(w) for w in words])
    got = wordpiece.LongestMatch(list(starts), list(rests)).counts(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], ends[:-1]]), ends)
    assert got.tolist() == [_greedy(w, starts, rests) for w in words]


def test_token_counts_handle_odd_texts(spark):
    rows = _rows(5)
    got = {(r["doc_id"], r["n_words"], r["n_unknown"]) for r in wordpiece.token_counts(_docs(spark, rows), BYTE).collect()}
    assert got == {(i, len((t or "").encode().split()), 0) for i, t in rows}


def test_training_order(spark, tmp_path):
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(training_order.feistel(np.arange(n), n, 7).tolist()) == list(range(n))
    rows, lib = _rows(6), _lib(WORD)
    got = training_order.in_training_order(_docs(spark, rows), WORD, 16, 8).collect()
    assert [r["slot"] for r in got] == list(range(len(got)))
    texts = Counter()
    for r in got:
        texts[r["doc_id"], r["piece"], bytes(r["tokens"])[: 2 * r["n_tokens"]]] += 1
    want = Counter()
    for i, t in rows:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, training_order.PAD], "<u2")
        for k in range(0, len(ids), 16):
            want[i, k // 16, ids[k : k + 16].tobytes()] += 1
    assert texts == want
    path = str(tmp_path / "shards")
    training_order.write_shards(training_order.in_training_order(_docs(spark, rows), WORD, 16, 8), path)
    read = training_order.read_records(spark, path, 1, 2, 3, 16)
    assert [x.tobytes() for x in read] == [bytes(r["tokens"]) for r in got[10:13]]


def test_shard_index_points_into_the_written_files(spark, sf):
    docs = _docs(spark, _rows(6))
    tokens = {r["slot"]: bytes(r["tokens"]) for r in training_order.in_training_order(docs, WORD, 16, 8).collect()}
    index = training_order.shard_index(docs, WORD, 16, 8)
    got = index.withColumn("task", F.spark_partition_id()).collect()
    assert [r["slot"] for r in got] == sorted(tokens) and all(r["shard"] == r["slot"] // 8 for r in got)
    files = {}
    for r in got:
        if r["folder"] not in files:
            (file,) = Path(r["folder"].removeprefix("file:")).glob("part-*")  # one file per shard
            files[r["folder"]] = file.read_bytes()
        assert files[r["folder"]][r["byte_offset"] : r["byte_offset"] + 32] == tokens[r["slot"]]
    assert sum(map(len, files.values())) == 33 * len(tokens) and len(files) == -(-len(tokens) // 8)
    assert len({(r["task"], r["shard"]) for r in got}) == len({r["task"] for r in got}) == len(files)
    row = queries.op5_training_order(spark, sf).orderBy(F.col("slot").desc()).first()
    (file,) = Path(row["folder"].removeprefix("file:")).glob("part-*")
    assert file.stat().st_size == row["byte_offset"] + 1025


def test_sequence_table_goes_while_the_shards_are_written(spark, monkeypatch):
    docs, held, write, folders = _docs(spark, _rows(6)), [], training_order.write_shards, []

    def watched(ordered, path, *mode):
        left = [sum(f.stat().st_size for f in Path(folders[0]).rglob("*.parquet")), len(list(Path(folders[0]).glob("wave=*")))]
        held.append(left)
        write(ordered, path, *mode)

    def named(session, label, make=training_order.scratch_path):
        path = make(session, label)
        if label == "sequences":
            folders.append(path.removeprefix("file:"))
        return path

    monkeypatch.setattr(training_order, "write_shards", watched)
    monkeypatch.setattr(training_order, "scratch_path", named)
    index = training_order.shard_index(docs, WORD, 16, 8)
    assert len(folders) == 1 and len(held) > 4
    assert held[-1][1] <= 3 and held[-1][0] < held[0][0] / 2
    assert not list(Path(folders[0]).rglob("*.parquet"))
    rows = index.collect()  # needs the table no more
    files = {r["folder"]: b"".join(f.read_bytes() for f in Path(r["folder"].removeprefix("file:")).glob("part-*")) for r in rows}
    assert [r["slot"] for r in rows] == list(range(len(rows))) and sum(map(len, files.values())) == 33 * len(rows)


def test_suffix_dedup(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abé\n ") for _ in range(300)) for _ in range(4)]
    rows = [(0, None), (1, ""), (None, base[0]), (2, "x" * 500), (3, "x" * 200), (7, "a\0b" * 60), (8, "a\0b" * 60 + "c")]
    for _ in range(50):
        text = ""
        for _ in range(rng.randint(0, 5)):
            b, s = rng.choice(base), rng.randint(0, 250)
            text += b[s : s + rng.randint(5, 200)] + rng.choice(["", "q", "zz"])
        rows.append((rng.randint(9, 50), text))
    low = lambda i: -(2**63) if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], 2**63), low(i))
    want = Counter()
    for i, t in rows:
        b = (t or "").encode()
        gone = [0] * len(b)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < low(i):
                gone[p : p + 50] = [1] * 50
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        want[i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()] += 1
    got = suffixes.without_repeats(_docs(spark, rows), carry=["key", "n_tokens"])
    assert got.columns[-2:] == ["key", "n_tokens"]
    assert Counter(tuple(r)[:5] for r in got.collect()) == want


def _cut_by_hand(rows):
    first = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], i), i)
    want = Counter()
    for i, t in rows:
        b = t.encode()
        gone = [False] * len(b)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = [True] * 50
        want[i, sum(gone), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()] += 1
    return want


def test_suffix_dedup_deals_out_the_runs_of_a_common_line(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_KINDS", 40, raising=False)
    monkeypatch.setattr(suffixes, "WINDOWS_A_PART", 100, raising=False)
    real = suffixes._verdicts

    def spied(length):
        run = real(length)

        def check(df):
            assert df["n"].sum() <= 250, f"{df['n'].sum()} runs in one task"
            return run(df)

        return check

    monkeypatch.setattr(suffixes, "_verdicts", spied)
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line, tail = noise(40), [noise(30) for _ in range(20)]
    rows = [(i, noise(5) + line + rng.choice(tail)[: rng.randint(8, 30)] + noise(30)) for i in range(400)]
    rows += [(i + 200, t) for i, t in rows[:40]]  # repeated texts, ids shared with others
    got = suffixes.without_repeats(_docs(spark, rows, 8)).collect()
    assert Counter((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in got) == _cut_by_hand(rows)


def test_suffix_verdicts_of_a_repeated_row_in_two_segments():
    def entries(rows):
        ids, texts, lefts = zip(*rows)
        sizes = np.array([len(t) for t in texts], "<u2")
        parts = [np.array(ids, np.int64), np.arange(len(ids), dtype="<i4"), np.array(lefts, "u1"), sizes]
        return zstandard.ZstdCompressor().compress(b"".join([x.tobytes() for x in parts] + list(texts)))

    long = b"0123456789" * 2 + b"ABCDEFGHIJKLMNOPQRSTUVWX" + b"abcdefghij"  # five windows; the smaller document holds the first two
    segs = [[(1, b"zzz" + long[:51], 23), (5, long, 20)], [(5, long, 20)]]
    df = pd.DataFrame({"seg": [0, 1], "n": [len(x) for x in segs], "blob": [entries(x) for x in segs]})
    got = [(np.frombuffer(h, "<i4", 1)[0], np.frombuffer(h, "<i8", 1, 4)[0]) if h else None for h in suffixes._verdicts(50)(df)["hits"]]
    assert got == [(1, 0b11), (0, 0b11)]


def _sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("block", [512, 12])
def test_jaccard_components(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(3, 120))] for _ in range(5)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE two"), (None, "one two"), (5, "one")]
    for i in range(6, 160):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    sets = [_sets(t, 4) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 85 * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    want = {(d, len(s), low[root(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))}
    got = jaccard.linked(_docs(spark, rows), 4, 85).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(rows)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(90, 80), (90, 90)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 80: 80, 90: 80}


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(230)] + [(300, None), (301, [1.0, None]), (320, [float("inf")] * 6), (340, [0.25] * 3), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("codes", F.lit(1)).withColumn("query", F.lit("x"))
    codes = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all():
            codes[i] = np.pad(np.floor(64 * np.array(v)), (0, 6 - len(v)))
    want = set()
    for q in (i for i in codes if i % 20 == 0):
        best = sorted((-int(codes[q] @ c), i) for i, c in codes.items() if i != q)[:20]
        want |= {(q, k, i, -s) for k, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in nra.top_k(df, F.col("vec_id") % 20 == 0).collect()} == want


def test_fingerprints(spark):
    rows = [r for r in _rows(7) if r[0] is not None][:40]
    rows = list(dict(rows).items())
    got = {r["doc_id"]: r for r in merkle.fingerprints(_docs(spark, rows), 7).collect()}
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(rows):
        text, after = t or "", rows[(n + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        new = text[: len(text) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got[i]["fingerprint"] == merkle.fingerprint(text.encode())[0] and 0 <= got[i]["near_next"] <= 1
        assert got[i]["edited_fingerprint"] == merkle.fingerprint(new.encode())[0]
    assert merkle.differing(b"a b\nc d\ne f", b"a b\nc x\ne f") and not merkle.differing(b"a", b"a")


def test_ordinal_orders_thresholds_and_generalises(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet")
    ratings = ordinal.ratings_of(spark.read.parquet(f"{sf.replace('0.001', '0.1')}/labels.parquet"))
    model = ordinal.fit(docs, ratings.where("doc_id % 3 > 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = ordinal.graded(docs, model, 0.8).join(ratings.where("doc_id % 3 = 0"), "doc_id")
    share = {r["grade"]: r["k"] for r in held.groupBy("grade").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    assert share[2] > 0.97 and share[0] < 0.05 and share[1] < 0.5
    none = ordinal.fit(docs.limit(0), ratings.limit(0))
    assert ordinal.selected(_docs(spark, [(1, None), (2, "x")]), none).count() == 2


def test_ordinal_sees_whole_words_and_text_without_spaces():
    def seen(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return set(zip(*[a.tolist() for a in ordinal.features(data, np.array([0, len(data)]))[1:]]))

    assert seen("idiot") != seen("idiom") and seen("abc") != seen("abd") and seen("") == set()
    long = "字" * 30
    assert seen(long + "甲乙丙" + long) - seen(long + "甲乙丁" + long)
    assert seen("Word, (word) WORD") & seen("word")


def test_ordinal_clashing_columns_repeats_and_nulls(spark):
    rows = [(i, "good plain prose here" if i % 2 else "bad junk words there", 9, True) for i in range(40)] + [(3, None, 1, None), (None, "", 2, False), (1, "good plain prose here", 9, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, expected_grade int, keep boolean")
    ratings = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (5, None)], "doc_id long, grade int")
    model = ordinal.fit(docs, ratings)
    got = ordinal.graded(docs, model, 0.5).collect()
    assert len(got) == len(rows) and sum(r["doc_id"] is None for r in got) == 1
    by_text = {(r["doc_id"], round(r["p_top"], 9)) for r in got if r["doc_id"] == 1}
    assert len(by_text) == 1
    assert {r["keep"] for r in got if r["doc_id"] is not None and r["doc_id"] % 2 == 0} == {False}
    assert ordinal.selected(docs, model, 0.5).columns == docs.columns
    assert ordinal.graded(docs.limit(0), model).count() == 0


def test_transcripts(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 12)):
            role = "user" if t % 2 == 0 else "assistant"
            text = "Why so?" if role == "user" else "\n".join("It is a long and winding answer here." for _ in range(rng.randint(1, 4)))
            rows.append((c, t, role, text))
    rows += [(None, 0, "user", "x"), (61, 0, "user", None), (62, None, None, "free")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = transcripts.transcript_lines(conv)
    model = transcripts.fit(lines)
    truth = {(r["conv_id"], r["line_no"]): r["role"] for r in lines.collect()}
    got = {(r["conv_id"], r["line_no"]): r["role"] for r in transcripts.labelled(lines, model).collect()}
    assert got.keys() == truth.keys()
    assert np.mean([got[k] == truth[k] for k in got]) > 0.95
    monkeypatch.setattr(transcripts, "CHUNK", 3)  # chunks do not change the best path
    assert {(r["conv_id"], r["line_no"]): r["role"] for r in transcripts.labelled(lines, model).collect()} == got
    out = transcripts.turns(lines, model)
    assert out.agg(F.sum("n_lines")).first()[0] == len(truth)
    assert "<|user|>\nWhy so?\n<|end|>" in {r["rendered"] for r in out.collect()}


def test_empty_tables(spark):
    none = _docs(spark, [])
    for df in (
        bpe.round_trip(none, BYTE),
        packing.pack_documents(none, WORD),
        wordpiece.token_counts(none, BYTE),
        training_order.in_training_order(none, WORD),
        suffixes.without_repeats(none),
        jaccard.linked(none),
        merkle.fingerprints(none),
        nra.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0),
    ):
        assert df.count() == 0
