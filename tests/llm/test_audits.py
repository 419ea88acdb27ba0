"""Source divergence, SimHash components and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from heapq import heappop, heappush

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from harrow.llm import divergence, repair, simhash
from harrow.llm.words import LETTERS, SOLID, word_lists

LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.mark.parametrize("piece", (1, 7, 64, 1 << 20))
def test_words_of_pieces(piece):
    text = "Ab  cd\tÉé9x\n\x0b日本 Z\x00q " * 30 + "longwordwithoutend" * 20
    for table, pattern in ((SOLID, r"[^\x20\x09-\x0D]+"), (LETTERS, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")):
        want = re.findall(pattern, text.translate(LOWER))
        assert [w.decode() for ws in word_lists(text.encode(), table, piece) for w in ws] == want


# Divergence


def _brute_audit(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        sources = {d[1] for d in mine}
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in sources}
        total = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s in sources:
            pairs = sorted((-sum(abs(share(counts[s], t) - share(counts[o], t)) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((share(total, t) - share(counts[s], t), t.encode()) for t in kept if counts[s][t] and share(counts[s], t) > share(total, t))
            for part, ranked in (("pair", pairs), ("term", terms[:top])):
                out |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(ranked, 1)}
    return out


def _audit_rows(seed, n=300, sources=7):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "日本", "x1y", "a-b", "rare%d"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words).replace("%d", chr(97 + i % 26)) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "de", None, ""]), "hot" if rng.random() < 0.4 else f"s{rng.randrange(sources)}", text))
    return rows + rows[:9] + [("en", None, None), ("xx", "only", "few words"), ("xx", "other", ""), ("en", "s0", "the " * 5000), (None, None, " ")]


def _audit_table(spark, rows):
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    return df.withColumn("term", F.lit(1)).withColumn("p", F.lit("clash")).withColumn("block", F.lit(None).cast("int"))


@pytest.mark.parametrize(("block", "tile"), ((8192, 1024), (1, 1024), (3, 2), (50, 3)))
def test_divergence_equals_brute_force(spark, block, tile):
    rows = _audit_rows(block)
    got = divergence.audit(_audit_table(spark, rows), 5, 4, block, tile).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == _brute_audit(rows, 5, 4)


def test_divergence_of_nothing(spark):
    assert divergence.audit(_audit_table(spark, []), 5, 4).count() == 0


def test_shares_are_exact_at_any_size(spark):
    n, total, kinds = 3 * 10**14, 10**15, 10**7
    df = spark.createDataFrame([(n, total, kinds)], "n long, t long, k long")
    got = df.select(divergence._share(F.col("n"), F.col("t"), F.col("k"))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * kinds)


# SimHash


def _brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _brute_components(prints, bits):
    """Smallest key reachable, for {key: fingerprint}."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", ("", " \n", "One", "one two", "a b c", "A b  c\td e é 日本 " * 40, "x " * 5000, "w" * 70000 + " y z q"))
def test_fingerprint_equals_brute_force(text, monkeypatch):
    assert simhash.fingerprint(text.encode()) == _brute_print(text)
    monkeypatch.setattr(simhash, "word_lists", lambda t, table: word_lists(t, table, 5))
    assert simhash.fingerprint(text.encode()) == _brute_print(text)


def test_fingerprint_hash_is_sparks(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a é 日本"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest("a é 日本".encode(), seed=42)


def _crowd(seed, n=900):
    """Fingerprints of which half lie around two centres, so that many buckets are crowded, with chains between them."""
    rng = np.random.default_rng(seed)
    out = {int(x) for x in rng.integers(0, 2**64, n // 3, dtype=np.uint64)} | {0, 1, 2**63, 2**64 - 1}
    for _ in range(2):
        centre = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(n // 3):
            x = centre
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize(("limit", "bits"), ((4096, 3), (8, 3), (1, 3), (3, 2), (3, 4), (4096, 1)))
def test_links_connect_what_brute_force_connects(spark, limit, bits):
    fps = _crowd(limit * 10 + bits)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    edges = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(nodes, bits, limit).collect()]
    want = _brute_components(dict.fromkeys(fps) | {x: x for x in fps}, bits)
    root = {x: x for x in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {x: find(x) for x in fps} == want


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(5)
    cost = np.sort(rng.integers(0, 50, (4, 5, 40)), axis=1)
    got = simhash.thresholds(cost, 4)
    plans = [p for p in np.ndindex(5, 5, 5, 5) if sum(p) == 4]
    for row in range(40):
        work = [sum(int(cost[i, u, row]) for i, u in enumerate(p)) for p in plans]
        assert got[:, row].sum() == 4 and sum(int(cost[i, u, row]) for i, u in enumerate(got[:, row])) == min(work)


def test_long_bucket_keeps_its_own_fingerprints():
    """Visitors beyond a chunk still meet the bucket's fingerprints, and buckets after it are whole."""
    rng = np.random.default_rng(3)
    home = rng.integers(0, 2**64, 20, dtype=np.uint64)
    visitors = np.concatenate([rng.integers(0, 2**64, 300, dtype=np.uint64), home[:5] ^ np.uint64(1)])
    fp = np.concatenate([home, visitors, home[7:8], home[7:8] ^ np.uint64(6)])
    key = np.concatenate([np.zeros(325, np.int64), np.ones(2, np.int64)])
    role = np.concatenate([np.full(20, simhash.SILENT), np.full(305, simhash.VISITOR), [simhash.PROBING, simhash.SILENT]]).astype(np.int8)
    import pyarrow as pa

    batches = [
        pa.RecordBatch.from_arrays([pa.array(np.ones(len(key), np.int32)[s : s + 50]), pa.array(key[s : s + 50]), pa.array(fp.view(np.int64)[s : s + 50]), pa.array(role[s : s + 50])], names=list("abcd"))
        for s in range(0, len(key), 50)
    ]
    got = {frozenset((a % 2**64, b % 2**64)) for out in simhash._meet(3, np.arange(64), 60)(iter(batches)) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}
    assert got == {frozenset((int(x), int(x) ^ 1)) for x in home[:5]} | {frozenset((int(home[7]), int(home[7]) ^ 6))}


@pytest.mark.parametrize("limit", (4096, 2))
def test_simhash_components_equal_brute_force(spark, limit):
    rng = random.Random(limit)
    base = [" ".join(rng.choice(["a", "b", "Cc", "é", "f g"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts = ["", None, " \t", "one", "x" * 3000] + base + [t + " end" for t in base[:30]] + [t.upper() for t in base[:9]] + ["word " * 4000] * 30
    rows = list(enumerate(texts, 10))
    rng.shuffle(rows)
    rows += [rows[3], (None, base[0]), (None, "nobody else has this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("fp", F.lit("clash")).withColumn("component", F.lit(2))
    got = simhash.linked(docs, 3, 3, limit).collect()
    prints = {i: _brute_print(t) for i, t in rows if i is not None}
    want = _brute_components(prints, 3)
    least = {f: min(i for i in prints if prints[i] == f) for f in prints.values()}
    expect = Counter((i, f"{_brute_print(t):016x}", least[prints[i]] if i is not None else None, want[i] if i is not None else None) for i, t in rows)
    assert Counter(map(tuple, got)) == expect
    assert simhash.linked(docs.limit(0), 3, 3, limit).count() == 0


# Repair


def _brute_repair(roles_faults):
    """Cheapest edits, ASCII-least, by a search over (rows done, state): [(role, fault)] -> (cost, letters, output)."""
    n = len(roles_faults)
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, letters, at, state, out = heappop(heap)
        if at == n and state in (0, 3):
            return cost, letters, list(out)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        new, role = (3, "assistant") if state == 2 else (2, "user")
        heappush(heap, (cost + 3, letters + "I", at, new, (*out, (role, None))))
        if at < n:
            name, fault = roles_faults[at]
            heappush(heap, (cost + 4, letters + "D", at + 1, state, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                heappush(heap, (cost + 3 + extra, letters + "R", at + 1, new, (*out, (role, at))))
                to = {"s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(name[:1])
                if to is not None:
                    heappush(heap, (cost + extra, letters + "K", at + 1, to, (*out, (name, at))))


def _brute_rows(convs):
    out = {}
    for conv in {c for c, *_ in convs}:
        rows = []
        for c, turn, role, text in convs:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        cost, letters, lines = _brute_repair([(r, f) for (_, r, _), f in zip(rows, faults)])
        text = "\n".join(f"{role}:{'' if at is None else rows[at][2]}" for role, at in lines)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())
    return out


def _talks(seed, n=150):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "What?", "", " \n", "Yes.", "日本。", "end! \t", "a.b", None, "z" * 2000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "ux"]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, 12)):
            text = rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}."
            rows.append((conv, rng.choice([turn, turn, turn, 3, None]), rng.choice(roles) if rng.random() < 0.3 else roles[1 + turn % 2], text))
    rows += rows[:20]
    return rows + [(-5, t, "user", "go on") for t in range(300)] + [(-6, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)] + [(-7, None, None, None)] * 3


def _talk_table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    return df.withColumn("pos", F.lit("clash")).withColumn("kind", F.lit(0)).withColumn("symbol", F.lit(None).cast("int"))


@pytest.mark.parametrize(("chunk", "hot"), ((65536, None), (7, None), (1, 5), (50, 20)))
def test_repair_equals_brute_force(spark, chunk, hot):
    rows = _talks(chunk)
    got = repair.repaired(_talk_table(spark, rows), chunk, hot).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == _brute_rows(rows) and len(got) == len({r[0] for r in rows})


def test_repair_of_nothing_and_extreme_turns(spark):
    assert repair.repaired(_talk_table(spark, [])).count() == 0
    far = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")]
    got = repair.repaired(_talk_table(spark, far)).collect()
    assert [(r["gaps"] % 2**64, *r[2:]) for r in got] == [w for w in _brute_rows(far).values()]  # gaps as long arithmetic has them


@pytest.mark.parametrize("seed", range(30))
def test_choices_are_the_ascii_least_of_the_cheapest(seed):
    rng = random.Random(seed)
    kinds = {"s": ("s", ""), "u": ("u", ""), "a": ("a", ""), "o": ("t", ""), "S": ("s", "truncated"), "U": ("u", "truncated"), "A": ("a", "truncated"), "O": ("t", "truncated"), "b": ("u", "blank"), "d": ("a", "duplicate")}
    symbols = "".join(rng.choice("suaoSUAObd") * rng.choice((1, 1, 2, 5, 90)) for _ in range(rng.randint(0, 12)))
    letters, state = repair.choices(symbols, repair.START, repair.END, True)
    cost, want, _ = _brute_repair([kinds[s] for s in symbols])
    assert letters == want and state in (repair.START, repair.ASSISTANT)
    assert repair.after(repair.transition(symbols), repair.END)[repair.START] == cost
