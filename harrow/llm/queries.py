"""The registered queries of the operators, over their whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import bpe, divergence, jaccard, merkle, nra, ordinal, packing, repair, simhash, suffixes, training_order, transcripts, wordpiece
from harrow.llm.common import public_tokenizer, table, written

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Least chance of the top grade for a document to stay.
LEAST_TOP = 0.8


def op1_ordinal_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = ordinal.fit(docs, ordinal.ratings_of(table(spark, sf, "labels")))
    return ordinal.graded(docs, model, LEAST_TOP)


def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf, "documents"), 50)


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf, "documents"), public_tokenizer(BYTE_BPE))


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf, "documents"), public_tokenizer(BYTE_BPE))


def op5_training_order(spark: SparkSession, sf: str) -> DataFrame:
    return training_order.shard_index(table(spark, sf, "documents"), public_tokenizer(WORD_BPE))


def op6_jaccard_components(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.linked(table(spark, sf, "documents"), 4, 85).select("doc_id", "n_shingles", "component_id")


def op7_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return nra.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20, 64.0)


def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizer(WORD_BPE))


def op9_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    lines = written(transcripts.transcript_lines(table(spark, sf, "conversations")), "lines")
    return transcripts.turns(lines, transcripts.fit(lines))


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf, "documents"))


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"), 30, 50)


def op12_simhash_components(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.linked(table(spark, sf, "documents"), 3, 3).select("doc_id", "fingerprint", "component_id")


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repaired(table(spark, sf, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ordinal_quality,
        op2_suffix_dedup,
        op3_token_counts,
        op4_bpe,
        op5_training_order,
        op6_jaccard_components,
        op7_exact_top_k,
        op8_best_fit_packing,
        op9_transcripts,
        op10_fingerprints,
        op11_source_divergence,
        op12_simhash_components,
        op13_conversation_repair,
    )
}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
          n AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM d),
          p AS (SELECT doc_id, unnest(range(0, n - 49)) AS p, h FROM n),
          w AS (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), 100) AS s FROM p),
          f AS (SELECT s, min(doc_id) AS f FROM w GROUP BY s),
          c AS (SELECT doc_id, p FROM w JOIN f USING (s) WHERE f.f < doc_id),
          g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 1 ELSE 0 END AS new FROM c),
          i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g),
          r AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, k),
          t AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS was FROM r),
          o AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
                  string_agg(substr(h, CAST(2 * was + 1 AS BIGINT), CAST(2 * (a - was) AS BIGINT)), '' ORDER BY a) AS head FROM t JOIN n USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
          sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
        FROM n LEFT JOIN o USING (doc_id)""",
    "op6_jaccard_components": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x20\x09-\x0D]+') AS w FROM documents),
          s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
          n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
          e AS (SELECT doc_id, unnest(s) AS x FROM s),
          o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
          l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
          r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
        SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY ALL""",
    "op7_exact_top_k": r"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
          s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
          t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
          k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
          l AS (SELECT lang, count(*) AS v, sum(total) AS size FROM k GROUP BY ALL),
          g AS (SELECT DISTINCT lang, source FROM d),
          u AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
          c AS (SELECT g.lang, g.source, k.term, k.total, coalesce(u.n, 0) AS n FROM g JOIN k ON k.lang = g.lang
              LEFT JOIN u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
          z AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL),
          p AS (SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000 * (c.n + 5)) // (z.size + 5 * l.v) AS p, 1 + (1000000000 * (c.total + 5)) // (l.size + 5 * l.v) AS q
              FROM c JOIN z ON z.lang = c.lang AND z.source = c.source JOIN l ON l.lang = c.lang),
          f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL),
          o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
            UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o
        QUALIFY part = 'pair' OR rank <= 50""",
}
