"""Merkle fingerprints of documents: root over sections, sections over paragraphs, paragraphs over short spans.

Paragraphs are the lines. A paragraph is cut into spans at words chosen by their own bytes, so that an edit changes only the
spans it touches; a section is a run of paragraphs that ends at a paragraph chosen by its hash. The fingerprint is
the root, then every span as eight hex digits and its length: roots test equality, spans show what two texts share and where
they differ.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import batch, doc_texts
from harrow.llm.text import column_bytes

SPAN_WORDS = 8
SECTION_PARAGRAPHS = 8
DOCS_A_RANGE = 2_000

SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _node(parts: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def spans(paragraph: bytes) -> list[bytes]:
    """Cut after words whose checksum is a multiple of SPAN_WORDS, and after 4 * SPAN_WORDS words without one."""
    words = paragraph.split(b" ")
    out, at = [], 0
    for i, w in enumerate(words, 1):
        if zlib.crc32(w) % SPAN_WORDS == 0 or i - at == 4 * SPAN_WORDS:
            out.append(b" ".join(words[at:i]))
            at = i
    if at < len(words):
        out.append(b" ".join(words[at:]))
    return out


def tree(text: bytes) -> tuple[bytes, list[tuple[bytes, list[bytes]]], list[tuple[str, int]]]:
    """(root, sections as (hash, paragraph hashes), spans as (hash, length))."""
    sections, open_section, leaves = [], [], []
    for paragraph in text.split(b"\n"):
        parts = spans(paragraph)
        hashes = [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
        leaves += [(h[:4].hex(), len(p)) for h, p in zip(hashes, parts)]
        node = _node([b"p", *hashes])
        open_section.append(node)
        if node[0] % SECTION_PARAGRAPHS == 0:
            sections.append((_node([b"s", *open_section]), open_section))
            open_section = []
    if open_section:
        sections.append((_node([b"s", *open_section]), open_section))
    return _node([b"r", *(s for s, _ in sections)]), sections, leaves


def fingerprint(text: bytes) -> tuple[str, Counter]:
    """The fingerprint of a text in UTF-8, and its spans counted."""
    root, _, leaves = tree(text)
    return root.hex() + ":" + ",".join(f"{h}{n:x}" for h, n in leaves), Counter(leaves)


def parse(fp: str) -> tuple[str, Counter]:
    """Root and counted spans of a fingerprint."""
    root, _, rest = fp.partition(":")
    return root, Counter((x[:8], int(x[8:], 16)) for x in rest.split(",") if x)


def likeness(a: Counter, b: Counter) -> float:
    """Share of the bytes of both texts that lie in common spans, 0 to 1; 1 for two texts without bytes."""
    total = sum(n * k for (_, n), k in a.items()) + sum(n * k for (_, n), k in b.items())
    if not total:
        return 1.0
    small, large = (a, b) if len(a) < len(b) else (b, a)
    return min(1.0, 2 * sum(s[1] * min(k, large[s]) for s, k in small.items() if s in large) / total)


def differing(a: bytes, b: bytes) -> list[tuple[int, int]]:
    """(section, paragraph) places of the first text whose paragraph is not in the second; equal branches are skipped."""
    root_a, sections_a, _ = tree(a)
    root_b, sections_b, _ = tree(b)
    if root_a == root_b:
        return []
    same = {s for s, _ in sections_b}
    known = {p for _, ps in sections_b for p in ps}
    return [(i, j) for i, (s, ps) in enumerate(sections_a) if s not in same for j, p in enumerate(ps) if p not in known]


def edited(text: str, after: str) -> str:
    """The last quarter (rounded down) of the code points replaced by the first as many of `after`, or all it has."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


def fingerprints(docs: DataFrame, docs_a_range: int = DOCS_A_RANGE) -> DataFrame:
    """One row per document, with its fingerprint, that of its edited text, and the likenesses.

    The next document is that of the next larger doc_id (rows that share a doc_id follow each other by text); the first one comes
    after the last. Null text is empty; rows with a null doc_id come first. Documents are dealt by ranges of doc_id; the first
    of each range is also sent to the range before it, so no task sees more than its range.
    """
    d = doc_texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    n = d.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    ranges = max(1, math.ceil(n / docs_a_range))
    # Range starts are doc_ids; rows of one doc_id stay in one range.
    low = F.coalesce("doc_id", F.lit(-(2**63)))
    shares = [i / ranges for i in range(1, ranges)]
    keys = d.select(low.alias("k"))
    starts = sorted(set(keys.agg(F.percentile_approx("k", shares, 100 * ranges)).first()[0])) if shares else []
    firsts = keys.groupBy(_range_of("k", starts).alias("r")).agg(F.min("k").alias("first")).collect()
    firsts = sorted((r["r"], r["first"]) for r in firsts)
    before = {firsts[i][1]: firsts[i - 1][0] for i in range(len(firsts))}
    home = _range_of(low, starts)
    guest = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[low]
    places = F.array_compact(F.array(F.struct(home.alias("r"), F.lit(False).alias("guest")), F.when(guest.isNotNull(), F.struct(guest.alias("r"), F.lit(True).alias("guest")))))
    packed = d.mapInArrow(_packed, "doc_id long, data binary")
    dealt = packed.withColumn("at", F.explode(places)).select("at.r", "at.guest", "doc_id", "data")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = dealt.repartition(max(parts, min(len(firsts), 10 * parts)), "r").sortWithinPartitions("r", "guest", "doc_id", F.col("data"))
    return placed.mapInArrow(_compare, SCHEMA)


def _range_of(key, starts: list[int]):
    """Number of range starts at or below the key, as nested comparisons of logarithmic depth."""
    key = F.col(key) if isinstance(key, str) else key

    def pick(a: int, b: int):
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(key < F.lit(starts[mid]), pick(a, mid)).otherwise(pick(mid + 1, b))

    return pick(0, len(starts))


_PACKED = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])


def _packed(batches):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        data, off = column_bytes(b.column(1))
        data, off = data.tobytes(), off.tolist()
        yield batch(_PACKED, b.column(0), [squeeze(data[s:e]) for s, e in zip(off, off[1:])])


def _compare(batches):
    """Rows come sorted by (range, guest, doc_id): a row and the one after it in its range are compared.

    A guest is the first document of the next range; of several that share its doc_id only the first counts.
    """
    open_text = zstandard.ZstdDecompressor().decompress
    last = None
    ended = None  # range whose guest was seen
    for b in batches:
        cols: list[list] = [[] for _ in _ARROW]
        r, guest, doc_ids, data = (c.to_pylist() for c in b.columns)
        for rng, g, doc, blob in zip(r, guest, doc_ids, data, strict=True):
            if g and ended == rng:
                continue
            if g:
                ended = rng
            raw = open_text(blob)
            fp, counted = fingerprint(raw)
            if last is not None:
                text, after = last[1].decode("utf-8", "replace"), raw.decode("utf-8", "replace")
                new = edited(text, after).encode("utf-8")
                new_fp, new_counted = fingerprint(new)
                row = (last[0], len(text), hashlib.sha256(new).hexdigest(), last[2], new_fp, likeness(last[3], new_counted), likeness(last[3], counted))
                for c, v in zip(cols, row):
                    c.append(v)
            last = None if g else (doc, raw, fp, counted)
        yield batch(_ARROW, *cols)
