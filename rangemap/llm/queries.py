"""The operators' queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprint, jaccard, media, packing, personal, phrases, pseudo_likelihood, quality, secrets, substrings, url_filter, whitening
from .common import table


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.with_media(table(spark, sf_dir, "documents")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_report(table(spark, sf_dir, "documents"), window=13)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_media_columns": op4_media_columns,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_secret_scans": op8_secret_scans,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_fingerprints": op10_fingerprints,
    "op11_personal_data": op11_personal_data,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_phrase_mining": op13_phrase_mining,
}

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The other operators' results (models, images, token ids, wide hashes, checksums) can't be said in SQL; their tests hold
#: them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM w, LATERAL unnest(range(1, len(ws) - 2)) t(i)
  UNION ALL SELECT doc_id, 'short ' || array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.x, s.r FROM reach s JOIN links l ON l.y = s.doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.r) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach r ON r.doc_id = w.doc_id GROUP BY 1, 2""",
    "op5_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM w, LATERAL unnest(range(1, len(ws) - 11)) t(i)),
firsts AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g),
hit AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN firsts USING (g), range(13) r(k) WHERE lo < doc_id),
gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM hit GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)""",
    "op13_phrase_mining": r"""
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s FROM documents)),
f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM p, range(1, 6) t(k), LATERAL unnest(range(1, len(ws) - k + 2)) u(i) GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c d WHERE d.lang = c.lang AND d.k > c.k AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= 100 * c.a)),
cuts AS (
  SELECT kept.lang, kept.phrase, a, x.f AS l, y.f AS r, n, h, 1000 * a::HUGEINT * n // (x.f::HUGEINT * y.f) AS score
  FROM kept JOIN n USING (lang), range(1, 5) t(h), f x, f y
  WHERE h < kept.k AND x.lang = kept.lang AND y.lang = kept.lang AND x.phrase = array_to_string(ws[1:h], ' ') AND y.phrase = array_to_string(ws[h + 1:], ' ')),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) AS w FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst WHERE w = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
}
