"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one that is read in fewer parts than there are cores, as a small file is, is dealt out to all of them."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(_table(spark, sf_dir, "documents")).drop("host", "text_hash", "frequent")


_OP3 = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^ 	-
]+') AS w FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) t(k) GROUP BY doc_id),
raw AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT doc_id, host, text, line, lower(trim(regexp_replace(line, '[ 	-
]+', ' ', 'g'))) AS norm FROM raw WHERE regexp_matches(line, '[^ 	-
]')),
hosts AS (SELECT host, count(*) AS documents FROM d GROUP BY host),
freq AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT doc_id) AS c FROM ln GROUP BY host, norm) JOIN hosts USING (host) WHERE c > 20 AND c > CAST(0.1 AS DOUBLE) * documents),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY doc_id),
gone AS (SELECT doc_id, CAST(sum(len(string_split(norm, ' '))) AS BIGINT) AS n FROM ln JOIN freq USING (host, norm) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_line_words
  FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_line_words >= 10 AS kept
FROM m
"""


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_digests

    return encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_documents

    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .wavelet import token_files

    return token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_brown_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .brown import score_documents

    return score_documents(_table(spark, sf_dir, "documents"))


_OP1 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, 'short ' || array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g AS a JOIN g AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
reach AS (SELECT a AS v, b AS u FROM links UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.u = links.a),
class AS (SELECT v AS doc_id, least(v, min(u)) AS class_id FROM reach GROUP BY v),
same AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) END AS text_class FROM w),
counted AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, text_class, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links
FROM same LEFT JOIN class USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

_OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM v
  WHERE vec_id NOT IN (SELECT vec_id FROM (SELECT vec_id, unnest(v) AS x FROM v) WHERE x IS NULL OR NOT isfinite(x)) AND len(v) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good AS a JOIN good AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.n > 0 AND b.n > 0 AND list_inner_product(a.v, b.v) / a.n / b.n >= CAST(0.9 AS DOUBLE)),
reach AS (SELECT a AS v, b AS u FROM links UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.u = links.a),
class AS (SELECT v AS vec_id, least(v, min(u)) AS c FROM reach GROUP BY v),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept FROM v LEFT JOIN class USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

_OP8 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM rep, range(20) t(k)),
kept AS (
  SELECT doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w) AS x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": _OP1, "op3_line_frequency": _OP3, "op4_near_vectors": _OP4, "op8_substring_dedup": _OP8}
