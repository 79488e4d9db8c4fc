"""Registered queries of the operators: each applies one, with production parameters, to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
import public_tokenizers
from msgflow.llm import alignment, bpe, decontaminate, language, mixing, phrases, quality, secrets, sharding, simhash, spelling
from msgflow.llm import superminhash, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, sf_dir, "documents"), similarity=85)


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edit_report(_table(spark, sf_dir, "documents"))


def op10_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op11_position_bitsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.alignment_report(_table(spark, sf_dir, "documents"), *paths)


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_attention_quality": op1_attention_quality,
    "op2_external_shuffle": op2_external_shuffle,
    "op3_spaced_seeds": op3_spaced_seeds,
    "op4_secret_forest": op4_secret_forest,
    "op5_superminhash": op5_superminhash,
    "op6_weak_supervision": op6_weak_supervision,
    "op7_source_mix": op7_source_mix,
    "op8_phrase_automata": op8_phrase_automata,
    "op9_simhash": op9_simhash,
    "op10_evidence_fusion": op10_evidence_fusion,
    "op11_position_bitsets": op11_position_bitsets,
    "op12_lockstep_alignment": op12_lockstep_alignment,
    "op13_prefix_bpe": op13_prefix_bpe,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    # crc32 byte by byte from its table; near words by what is left without one letter, at the same place for a replaced one.
    "op11_position_bitsets": r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
), spelled AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)) AS x FROM counted
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
           lambda k: CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM spelled, crc
), spoiled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoiled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words
), cuts AS (
  SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM places
), near AS (
  SELECT x.word, y.word AS other FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.p = y.p AND x.word <> y.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest
), ranked AS (
  SELECT near.word, other, o.n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, encode(other)) AS r
  FROM near JOIN words o ON o.word = other
), best AS (
  SELECT word, other, n, n_near FROM ranked WHERE r = 1
), forms AS (
  SELECT b.word, other AS form, b.n AS form_n FROM best b JOIN words w ON w.word = b.word WHERE b.n >= 5 * w.n
), chain AS (
  SELECT word, word AS last, 0 AS depth FROM words
  UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN forms f ON f.word = c.last
), roots AS (
  SELECT word, arg_max(last, depth) AS root FROM chain GROUP BY word
)
SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, f.form, f.form_n, r.root
FROM words w JOIN roots r ON r.word = w.word LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word
""",
    # Jaccard similarity of all pairs that share a shingle; components by everything that is reached.
    "op5_superminhash": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM texts
), items AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM items x JOIN items y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT node, b FROM reached JOIN edges ON a = seen
), least_seen AS (
  SELECT node, min(seen) AS component_id FROM reached GROUP BY node
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM sets JOIN least_seen ON node = doc_id
""",
    # Every window but the first of its kind goes, with all its words.
    "op8_phrase_automata": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts WHERE len(w) >= 20
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM starts
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM again, range(0, 20) r(k)
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
""",
    # Water-filling in closed form: sources in the order of cap / weight are clamped as long as the level of the
    # rest lies above their own.
    "op7_source_mix": r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS size FROM sized GROUP BY source
), weighed AS (
  SELECT source, size, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
  FROM sources
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * size / weight, encode(source) NULLS LAST) AS place FROM weighed
), levels AS (
  SELECT *, (1.5e0 * CAST(sum(size) OVER () AS BIGINT)
             - coalesce(sum(2e0 * size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / CAST(sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ordered
), water AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE weight * level <= 2e0 * size
), targets AS (
  SELECT source, size AS source_size, least(2e0 * size, weight * level) AS target FROM weighed, water
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), run AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k) - d.size / 2.0 AS middle
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN need > 0 AND middle <= need THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
""",
}
