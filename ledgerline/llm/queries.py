"""The registered queries of the training-data operators, over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, collocations, exact_dedup, license_scan, line_dedup, near_dup, ngram_join, packing, quality, spelling, toxicity, warc,
               winnow)
from .common import table

#: Tokenizer file that the queries use.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(spark, docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.clean_documents(spark, table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "removed_lines", F.sha2("text", 256).alias("clean_sha256"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_fingerprints(spark, table(spark, sf_dir, "documents"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_dup.near_classes(spark, docs).select("doc_id", "class_id", "class_size", "n_texts", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(spark, docs, table(spark, sf_dir, "labels")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents")).withColumn("licenses", F.concat_ws(",", "licenses"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(spark, table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_bpe_round_trip, op3_warc, op4_exact_dedup, op5_near_dup, op6_packing, op7_quality,
        op8_line_dedup, op9_winnowing, op10_license_scan, op11_ngram_join, op12_spelling, op13_collocations,
    )
}

#: The text with A-Z in lower case, and nothing else changed.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               text_sha256
        FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)""",
    "op8_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
             l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
                          generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
             b AS (SELECT trim(line) AS line FROM l WHERE length(trim(line)) >= {line_dedup.MIN_CHARS}
                   GROUP BY 1 HAVING count(DISTINCT coalesce(source, chr(1))) >= {line_dedup.SITES}),
             m AS (SELECT r, pos, l.line, b.line IS NOT NULL AS gone FROM l LEFT JOIN b ON trim(l.line) = b.line)
        SELECT doc_id, n_lines, removed_lines, sha256(clean) AS clean_sha256
        FROM d JOIN (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS removed_lines,
                            coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean
                     FROM m GROUP BY r) USING (r)""",
    "op11_ngram_join": rf"""
        WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
             e AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                                              WHEN len(w) < {ngram_join.SHINGLE} THEN [array_to_string(w, ' ')]
                                              ELSE list_distinct([array_to_string(w[i:i + {ngram_join.SHINGLE - 1}], ' ')
                                                                  FOR i IN range(1, len(w) - {ngram_join.SHINGLE - 2})]) END) AS s FROM t),
             n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
             c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
             l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                   WHERE 100 * o >= {ngram_join.PERCENT} * (x.n + y.n - o)),
             g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
             r AS (SELECT doc_id AS v, doc_id AS m FROM n UNION SELECT g.b, r.m FROM r JOIN g ON g.a = r.v)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.m, doc_id) AS component_id
        FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT v AS doc_id, min(m) AS m FROM r GROUP BY v) k USING (doc_id)""",
    "op13_collocations": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
             g AS (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) v(m)),
             f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
             n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
             c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= {collocations.MIN_COUNT}),
             k AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM c),
             s AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r,
                          ({collocations.SCALE}::HUGEINT * k.a) // (l.f + r.f) AS score
                   FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ')
                          JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ')),
             b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
             h AS (SELECT lang, a AS f, w, j, unnest(range(1, m - j + 2)) AS i FROM c, (VALUES (2), (3)) v(j) WHERE j < m),
             x AS (SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(f) AS f FROM h GROUP BY ALL),
             z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
                   FROM b LEFT JOIN x USING (lang, phrase) WHERE x.f IS NULL OR 100::HUGEINT * x.f < {collocations.COVERED}::HUGEINT * a)
        SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM z JOIN n USING (lang)
        WHERE rank <= {collocations.TOP}""",
}
