"""One registered query per operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op1_bm25_search as op1
from . import op2_language_id as op2
from . import op3_decontamination as op3
from . import op4_jaccard_join as op4
from . import op5_token_counts as op5
from . import op6_suffix_tree_lm as op6
from . import op7_sentencepiece as op7
from . import op8_html_extraction as op8
from . import op9_sharding as op9
from . import op10_toxicity as op10
from . import op11_phrase_collocations as op11
from . import op12_importance_resampling as op12
from . import op13_quality_classifier as op13
from .common import table


def op1_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100 (its whole text is the query)."""
    docs = table(spark, sf_dir, "documents")
    return op1.top_k(docs, docs.where("doc_id % 100 = 0"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of the labelled ids."""
    out = op2.identify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose text the document holds within the error budget."""
    return op3.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and link component of every document."""
    return op4.join_classes(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every document."""
    return op5.token_counts(table(spark, sf_dir, "documents"))


def op6_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and suffix-tree log10 probability of every document."""
    return op6.score_documents(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded into pieces and decoded again."""
    return op7.round_trip(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return op8.main_text(table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, equal texts kept together where a shard holds them."""
    return op9.shard_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out fold."""
    return op10.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 first collocations of two and three words of each language."""
    return op11.collocations(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, noisy score and draw of every document, towards the benchmark's words."""
    out = op12.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels outside the held-out fold."""
    return op13.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bm25_search": op1_bm25_search,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_counts": op5_token_counts,
    "op6_suffix_tree_lm": op6_suffix_tree_lm,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_html_extraction": op8_html_extraction,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_quality_classifier": op13_quality_classifier,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), edges AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""

BM25_SQL = rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+')) AS w
  FROM documents
), tf AS (
  SELECT doc_id, w, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n, (SELECT sum(dl) FROM lengths) / count(*) AS mean FROM documents
), idf AS (
  SELECT w, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf
  FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), totals
), points AS (
  SELECT q.doc_id AS query_id, d.doc_id,
    sum(round(1e6 * idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * dl / mean)))::BIGINT)::BIGINT AS points
  FROM tf q JOIN tf d USING (w) JOIN idf USING (w) JOIN lengths l ON l.doc_id = d.doc_id, totals
  WHERE q.doc_id % 100 = 0 GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY points DESC, doc_id)::INTEGER AS rank FROM points WHERE points > 0
)
SELECT query_id, rank, doc_id, points / 1e6 AS score FROM ranked WHERE rank <= 10
"""

COLLOCATION_SQL = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counts AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
    FROM words, (SELECT unnest([1, 2, 3]) AS m))
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m >= 2 AND f >= 10
), parts AS MATERIALIZED (
  SELECT lang || chr(10) || phrase AS part, f FROM counts WHERE f >= 10
), cut AS MATERIALIZED (
  SELECT *, lang || chr(10) || array_to_string(w[1:k], ' ') AS head, lang || chr(10) || array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
), heads AS MATERIALIZED (
  SELECT cut.*, f AS l FROM cut JOIN parts ON part = head
), cuts AS MATERIALIZED (
  SELECT heads.*, f AS r, (1000000::HUGEINT * a * a // (l::HUGEINT * f))::BIGINT AS score FROM heads JOIN parts ON part = tail
), lowest AS MATERIALIZED (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS MATERIALIZED (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a AS longer FROM candidates WHERE m = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE m = 3
), kept AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = p.lang AND i.phrase = p.phrase AND 100 * i.longer >= 50 * p.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

RESAMPLING_SQL = rf"""
WITH texts AS (
  SELECT doc_id, 0 AS target, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark
), words AS (
  SELECT doc_id, target, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts
), buckets AS (
  SELECT w, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words)
), counts AS (
  SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t
  FROM words JOIN buckets USING (w) GROUP BY bucket
), totals AS (
  SELECT sum(s)::DOUBLE AS big_s, sum(t)::DOUBLE AS big_t FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (big_s + 10000) / ((s + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain
  FROM counts, totals
), weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS total
  FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE target = 0 GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN weights USING (doc_id)
), noisy AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM noisy WHERE n_features >= 20
  QUALIFY rank <= 10 * (SELECT count(*) FROM noisy WHERE n_features >= 20) // 100
)
SELECT doc_id, n_features, weight, score, rank FROM noisy LEFT JOIN drawn USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_bm25_search": BM25_SQL,
    "op4_jaccard_join": JACCARD_SQL,
    "op11_phrase_collocations": COLLOCATION_SQL,
    "op12_importance_resampling": RESAMPLING_SQL,
}
