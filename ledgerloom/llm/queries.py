"""The operators as registered queries, each over its whole table, and SQL where it can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    ann, langid, license_scan, line_dedup, ngram_join, packing, quality_crf, quality_rules, sentencepiece_bpe, spelling, suffix_dedup, token_counts, vector_codes,
)
from ledgerloom.llm.common import small_batches
from ledgerloom.sources.workspace import Workspace


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_near_lines(_documents(spark, folder), Workspace(spark))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = ngram_join.similar_documents(_documents(spark, folder), Workspace(spark))
    return found


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_crf.quality_scores(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_bpe.encode_decode(_documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return ann.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_documents(spark, folder))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, folder), Workspace(spark))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(spark.read.parquet(f"{folder}/documents.parquet"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.codes(spark.read.parquet(f"{folder}/embeddings.parquet"), Workspace(spark))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(spark.read.parquet(f"{folder}/documents.parquet"), Workspace(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_packing": op3_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts,
    "op11_license_scan": op11_license_scan,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}

def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + x + "'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


_LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEMPLATES = _values((i, label, i < len(license_scan.PHRASES), text) for i, (label, text) in enumerate([*license_scan.PHRASES, *license_scan.NOTICES]))
_LICENSE_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _rounds(rounds: int) -> str:
    """Assignment and codebook of each round of the vector codes."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        near{i} AS (SELECT r, p, any_value(x) AS x, min(64 * list_sum(list_transform(range(1, 5), lambda j: (x[j] - y[j]) * (x[j] - y[j])))::BIGINT + e) AS best
                   FROM pieces JOIN book{i} USING (p) GROUP BY r, p)""")
        if i < rounds:
            means = ", ".join(f"((sum(x[{j}]) - (sum(x[{j}]) % count(*) + count(*)) % count(*)) // count(*))::BIGINT" for j in range(1, 5))
            steps.append(f"""
        mean{i} AS (SELECT p, best % 64 AS e, [{means}] AS y FROM near{i} GROUP BY p, best % 64),
        book{i + 1} AS (SELECT p, e, coalesce(m.y, b.y) AS y FROM book{i} b LEFT JOIN mean{i} m USING (p, e))""")
    return ",".join(steps)


ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y USING (s)
                   WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
                  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
        reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON other = a)
        SELECT d.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
        FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id""",
    "op11_license_scan": f"""
        WITH known(template, label, base, body) AS (VALUES {_TEMPLATES}),
        told AS (SELECT *, regexp_extract_all({_LOWERED.format("body")}, {_LICENSE_WORDS}) AS w FROM known),
        grams AS (SELECT template, label, base, len(w) - 1 AS runs, len(w) - 1 - CASE WHEN base THEN 0 ELSE 2 * (len(w) // 10) END AS needed,
                         unnest(range(0, len(w) - 1)) AS place, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM told),
        texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED.format("text")}, {_LICENSE_WORDS}) AS w FROM documents),
        pairs AS (SELECT r, unnest(range(0, len(w) - 1)) AS i, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM texts WHERE len(w) > 1),
        hits AS (SELECT DISTINCT r, template, i - place AS diagonal, place FROM pairs JOIN grams USING (a, b)),
        spans AS (SELECT x.r, x.template, x.diagonal, count(DISTINCT y.place) AS covered
                  FROM (SELECT DISTINCT r, template, diagonal FROM hits) x JOIN hits y ON x.r = y.r AND x.template = y.template
                  JOIN (SELECT DISTINCT template, base FROM grams) g ON g.template = x.template
                  AND abs(x.diagonal - y.diagonal) <= CASE WHEN base THEN 0 ELSE 3 END GROUP BY ALL),
        found AS (SELECT s.*, label, base, covered >= needed AS held, covered::DOUBLE / runs AS share
                  FROM spans s JOIN (SELECT DISTINCT template, label, base, runs, needed FROM grams) USING (template))
        SELECT doc_id, len(any_value(w))::BIGINT AS n_words, count(*) FILTER (base AND held) AS n_base,
               min(diagonal) FILTER (base AND held) AS first_word, max(diagonal) FILTER (base AND held) AS last_word,
               coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (base AND held)), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (held)), ','), '') AS labels, coalesce(max(share), 0.0) AS score
        FROM texts LEFT JOIN found USING (r) GROUP BY r, doc_id""",
    "op12_vector_codes": f"""
        WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pieces AS (SELECT r, vec_id, p, v[4 * p + 1:4 * p + 4] AS x FROM kept, range(16) t(p)),
        book0 AS (SELECT p, r - 1 AS e, x AS y FROM pieces WHERE r <= 64),{_rounds(2)},
        coded AS (SELECT r, string_agg(printf('%02x', (best % 64)::INT), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM near2 GROUP BY r)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
        FROM kept JOIN coded USING (r)""",
    "op13_spelling_variants": f"""
        WITH RECURSIVE bits AS (SELECT i, 0 AS k, i AS c FROM range(256) t(i) UNION ALL
                                SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
        crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
        runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all({_LOWERED.format("text")}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
        signed AS (SELECT run, flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                   ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)) AS b FROM runs WHERE length(run) >= 7),
        hashed AS (SELECT run, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM signed, crc),
        cut AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
        words AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
        lacking AS (SELECT word, n, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
        near AS (SELECT a.word, b.word AS other, b.n FROM lacking a JOIN lacking b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
                 UNION SELECT a.word, b.word, b.n FROM lacking a JOIN words b ON a.rest = b.word
                 UNION SELECT b.word, a.word, a.n FROM lacking a JOIN words b ON a.rest = b.word),
        best AS (SELECT word, count(*) AS n_near, max(n) AS m, arg_min(other, (-n, other)) AS other FROM near GROUP BY word),
        told AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
                 FROM words w LEFT JOIN best USING (word)),
        walk AS (SELECT word, word AS root, 0 AS k FROM told UNION ALL SELECT walk.word, form, k + 1 FROM walk JOIN told ON walk.root = told.word WHERE form IS NOT NULL)
        SELECT word, form, arg_max(root, k) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
        FROM told JOIN walk USING (word) GROUP BY word, form""",
}
