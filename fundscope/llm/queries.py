"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, edit_counts, lexical, minhash, mixing, ngram_join, preference, quality, runs, token_store, toxicity, warc
from .common import load, shared_dir, written


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preference.preference_rows(preference.swapped_answers(load(spark, sf_dir, "conversations")))
    spans = {c: preference.flat_spans(F.col(c)) for c in ("chosen_spans", "rejected_spans")}
    return rows.withColumns(spans)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after the redaction of personal data, and after the links went, too.

    The trees of all documents are kept in a table between the two batches of edits.
    """
    import public_tokenizers

    how = tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    first = {"n_edits": "n_redactions", "tokens_before": "tokens_before", "tokens": "tokens_after", "chars_after": "chars_redacted", "chars_encoded": "redaction_chars_encoded"}
    trees = edit_counts.plant(load(spark, sf_dir, "documents"), *how, edit_counts.redactions)
    columns = [F.col(c) for c in ("doc_id", "text", "lengths", "counts", "tokens")] + [F.col(c).alias(f"first_{c}") for c in first]
    kept = written(trees.select(*columns), shared_dir(spark, "trees"), compression="zstd")
    then = edit_counts.edit(kept, *how, edit_counts.unlinked, carry={f"first_{c}": "long" for c in first})
    second = {"n_edits": "n_unlinks", "tokens": "tokens_unlinked", "chars_after": "chars_unlinked", "chars_encoded": "unlink_chars_encoded"}
    return then.select("doc_id", *(F.col(f"first_{c}").alias(n) for c, n in first.items()), *(F.col(c).alias(n) for c, n in second.items()))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(load(spark, sf_dir, "documents")))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digest(token_store.token_files(load(spark, sf_dir, "documents"), tokenizer()))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document; ``toxic`` marks a tenth of a grade or more."""
    known = load(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("grade"))
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, known)).select("doc_id", "severity", "grade", (F.col("severity") >= 0.1).cast("int").alias("toxic"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(load(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(load(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(load(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs of every document; every tenth is first given a periodic tail."""
    docs = load(spark, sf_dir, "documents")
    return runs.digest(runs.periodic_runs(docs.withColumn("text", runs.repeated_tail(F.col("text"), F.col("doc_id")))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_preference_format, op3_token_counts, op4_quality_classifier, op5_nearest_neighbours, op6_source_mix, op7_token_files, op8_toxicity, op9_ngram_join, op10_warc,
        op11_minhash_dedup, op12_lexical_search, op13_periodic_runs,
    )
}

ORACLES: dict[str, str] = {
    "op2_preference_format": r"""
WITH c AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC NULLS LAST, text DESC NULLS LAST) AS back
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
e AS (SELECT DISTINCT conv_id FROM c),
l AS (SELECT * FROM c WHERE back = 1),
r AS (
  SELECT conv_id, turn, role, text FROM c WHERE back > 1
  UNION ALL
  SELECT l.conv_id, l.turn, l.role, o.text FROM l JOIN l o ON o.conv_id = xor(l.conv_id, 1)),
t AS (SELECT 'chosen' AS side, conv_id, turn, role, text FROM c UNION ALL SELECT 'rejected', * FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS place FROM t),
d AS (
  SELECT conv_id, place, count(*) = 2 AND count(role) IN (0, 2) AND count(DISTINCT role) <= 1
         AND count(text) IN (0, 2) AND count(DISTINCT text) <= 1 AS same
  FROM p GROUP BY conv_id, place),
k AS (SELECT conv_id, coalesce(min(CASE WHEN NOT same THEN place END), max(place) + 1) AS cut FROM d GROUP BY conv_id),
s AS (
  SELECT p.conv_id, place, CASE WHEN place < cut THEN 'prompt' ELSE side END AS part, role,
         '<|' || coalesce(role, '') || '|>' || chr(10) AS head,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS shown
  FROM p JOIN k ON p.conv_id = k.conv_id WHERE side = 'chosen' OR place >= cut),
g AS (SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY conv_id, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM s),
a AS (
  SELECT conv_id, part, count(*) AS n, string_agg(shown, '' ORDER BY place) AS body,
         coalesce(string_agg(CAST(CAST(at_ + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(at_ + length(shown) AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS spans
  FROM g GROUP BY conv_id, part)
SELECT e.conv_id AS pair_id, coalesce(p.body, '') AS prompt, CAST(coalesce(p.n, 0) AS INTEGER) AS prompt_turns,
       coalesce(c.body, '') AS chosen, coalesce(r.body, '') AS rejected, coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM e LEFT JOIN a p ON p.conv_id = e.conv_id AND p.part = 'prompt'
LEFT JOIN a c ON c.conv_id = e.conv_id AND c.part = 'chosen'
LEFT JOIN a r ON r.conv_id = e.conv_id AND r.part = 'rejected'""",
    "op10_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS winner FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM winner AND winner IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM winner THEN winner END AS refers_to
FROM m""",
    "op11_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END) AS shingle FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, least(coalesce(m.least, w.doc_id), w.doc_id) AS component_id, coalesce(m.least, w.doc_id) >= w.doc_id AS kept
FROM w LEFT JOIN z ON z.doc_id = w.doc_id LEFT JOIN m ON m.doc_id = w.doc_id""",
    "op12_lexical_search": r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM n, c),
d AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY term, docs),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN d USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20""",
}
