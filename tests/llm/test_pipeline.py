"""The pipeline's stages and the whole against brute force; words that sums modulo 2**64 cannot tell apart."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from harrow.llm import jaccard, wordpiece
from harrow.llm.common import public_tokenizer, written
from harrow.llm.queries import BYTE_BPE, WORD_BPE
from harrow.llm.text import span_codes, word_codes, word_spans

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept_text string, node int, rows_ string"


def _thue_morse(a: str, b: str, n: int) -> str:
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


WORDS = _thue_morse("a", "b", 2048), _thue_morse("b", "a", 2048)


def test_codes_of_words_that_sums_of_powers_confuse():
    data = np.frombuffer(" ".join(WORDS).encode(), np.uint8)
    s, e, _ = word_spans(data, np.array([0, len(data)]))
    assert len(set(word_codes(data, s, e).tolist())) == 1  # why another code is needed
    assert len(set(span_codes(data, s, e).tolist())) == 2


def test_codes_are_those_of_the_bytes():
    rng = random.Random(4)
    words = ["".join(rng.choice("abAB") for _ in range(rng.choice((0, 1, 7, 8, 9, 63, 64, 65, 200)))) for _ in range(2000)]
    data = np.frombuffer("".join(words).encode() + b"tail", np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    for lower in (True, False):
        codes = span_codes(data, starts, ends, lower).tolist()
        named: dict = {}
        for w, c in zip(words, codes):
            assert named.setdefault(w.lower() if lower else w, c) == c
        assert len(set(named.values())) == len(named)


def test_confusable_words_do_not_link_or_share_counts(spark):
    rest = " ".join(f"w{i}" for i in range(3))
    docs = spark.createDataFrame([(1, f"{WORDS[0]} {rest}"), (2, f"{WORDS[1]} {rest}"), (3, " ".join(WORDS))], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.linked(docs, 4, 85).where("doc_id < 3").collect()} == {1, 2}
    alone = docs.union(spark.createDataFrame([(4, WORDS[0]), (5, WORDS[1])], "doc_id long, text string"))
    n = {r["doc_id"]: r["n_tokens"] for r in wordpiece.token_counts(alone.repartition(1), public_tokenizer(BYTE_BPE)).collect()}
    assert n[3] == n[4] + n[5]


def _texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 60))) for _ in range(25)]
    near = [" ".join(w if i != 3 else "other" for i, w in enumerate((t + " " + t[::-1]).split())) for t in base[:6]]
    passage = " ".join(rng.choice(vocabulary) for _ in range(15))
    return base + [t + " " + t[::-1] for t in base[:6]] + near + [f"{t} {passage}" for t in base[6:12]] + base[:4] + ["", " \n", "one two"]


def _rows(seed):
    rows = [(i, t, "en", "s", len(t), "clash", i, None) for i, t in enumerate(_texts(seed))]
    random.Random(seed).shuffle(rows)
    rows += rows[:3] + [(rows[4][0], rows[4][1] + " differs a little", "de", "s", 1, None, 0, "x")]
    nameless = [(None, rows[5][1], "en", "s", 1, None, None, None)] * 2 + [(None, "nobody else says anything like this", "en", None, 1, None, 1, None)] * 3
    return rows + nameless + [(None, None, None, None, None, None, None, None)] * 2


def _table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _brute_groups(rows):
    """Rows kept, as (doc_id, text): nodes are doc_ids and rows without one."""
    nodes: dict = {}
    for i, r in enumerate(rows):
        nodes.setdefault(r[0] if r[0] is not None else 10**6 + i, []).append(r)
    keys, root = sorted(nodes), {}
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    sets = [(k, _shingles(r[1])) for k in keys for r in nodes[k]]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return Counter((nodes[k][0][0], min(nodes[k], key=lambda r: (r[1] is not None, r[1] or ""))[1]) for k in keys if find(k) == k)


@pytest.mark.parametrize("seed", (1, 2))
def test_one_row_of_each_group_stays(spark, seed):
    rows = _rows(seed)
    got = P.near_duplicates(spark, _table(spark, rows), "")
    assert got.schema.names == [c.split()[0] for c in COLUMNS.split(", ")]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == _brute_groups(rows)
    assert P.near_duplicates(spark, _table(spark, rows).limit(0), "").count() == 0


def _brute_cut(rows):
    """Texts without the bytes of 50-byte strings that also start in a smaller doc_id."""
    low = lambda i: -(2**63) if i is None else i
    first: dict = {}
    raws = [(low(r[0]), (r[1] or "").encode()) for r in rows]
    for doc, raw in raws:
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], doc), doc)
    out = Counter()
    for (doc, raw), r in zip(raws, rows):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < doc:
                gone[p : p + 50] = True
        text = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        out[r[0], text, r[2], len(text), r[5]] += 1
    return out


def test_passages_are_cut_and_other_columns_kept(spark):
    rows = _rows(3)
    got = P.repeated_passages(spark, _table(spark, rows), "")
    assert got.schema.names == [c.split()[0] for c in COLUMNS.split(", ")]
    assert Counter((r["doc_id"], r["text"], r["lang"], r["n_chars"], r["kept_text"]) for r in got.collect()) == _brute_cut(rows)


def test_run_is_its_stages_by_brute_force(spark, sf):
    """From what quality keeps, the other stages are redone by brute force, and the result is a whole packing of their texts."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = written(P.quality(spark, docs, sf), "good")
    assert good.columns == docs.columns and good.count() > 0
    assert good.exceptAll(docs).count() == 0
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], None) for r in good.collect()]
    kept = _brute_groups(rows)
    rest = [r for r in rows if (r[0], r[1]) in kept]
    library, want = Tokenizer.from_file(public_tokenizer(WORD_BPE)), Counter()
    for (doc, text, *_), n in _brute_cut(rest).items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[doc, piece, at, len(ids[at : at + 2048])] += n
    got = P.run(spark, sf).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in got) == want
    held: dict = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
