"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide.llm import (
    bpe, chat, decontaminate, langid, licenses, negatives, phrases, pii, quality, simhash,
    suffixes, topk, zonemaps,
)
from caretide.llm.common import table
from caretide.session import materialize

Run = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: The rank file holds the ids below this one.
FIRST_RESERVED = 50_256


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return decontaminate.report(found)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m,
    array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(p)
  WHERE len(w) > 0
), dw AS (
  SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS win
  FROM d, (SELECT DISTINCT m FROM iw) AS s, unnest(range(1, len(w) - m + 2)) AS u(p)
), hit AS (
  SELECT doc_id, p, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.win = iw.win
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM hit, unnest(range(p, p + m)) AS u(q) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) AS t GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN)
    return bpe.digests(bpe.decode(coded, RANKS))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score
FROM s QUALIFY rank <= 5
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = phrases.remove_repeats(table(spark, sf_dir, "documents"), width=13)
    return done.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s
  FROM d, unnest(range(1, len(w) - 11)) AS u(p)
), low AS (
  SELECT s, min(doc_id) AS low FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, q FROM win JOIN low USING (s), unnest(range(p, p + 13)) AS u(q)
  WHERE low < doc_id
), word AS (
  SELECT doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(i)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.q GROUP BY doc_id
), n AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, "doc_id", "held_out")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    coded = chat.assemble(turns.unionByName(planted), RANKS, PATTERN, FIRST_RESERVED)
    return chat.digests(chat.read_back(coded, RANKS, FIRST_RESERVED))


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, len(regexp_extract_all(role || chr(10) || text,
    '<\\*(s>|/s>|\|start\|>|\|message\|>|<SYS>>|</SYS>>)|\[\\*(INST|/INST)\]'))
    AS n_control
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST))
    AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(9 + length(role) + 11 + length(text) + n_control + 4))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(
        table(spark, sf_dir, "documents"), licenses.notices(spark), best=True)
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_licenses"),
        F.array_join("matches.license_id", ",").alias("licenses"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("containment"),
    )


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.annotate(docs, pii.fit(docs)))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(table(spark, sf_dir, "documents"), width=400)
    return done.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = materialize(quality.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    failed = ~quality.passes(quality.BASE)
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & quality.passes(quality.STRICT)).alias("kept"),
        "failures")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each policy of op11 keeps without one of its rules."""
    book = materialize(quality.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    return quality.ablations(book)


_LEDGER_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    row_number() OVER () AS r
  FROM documents
), win AS (
  SELECT r, p, array_to_string(w[p:p + 4], ' ') AS s, count(*) OVER (PARTITION BY r, s) AS n
  FROM d, unnest(range(1, len(w) - 3)) AS u(p)
), rep AS (
  SELECT r, count(DISTINCT q) AS n FROM win, unnest(range(p, p + 5)) AS u(q) WHERE n > 1 GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks
  FROM d LEFT JOIN rep USING (r)
), b AS (
  SELECT *, n_words < 10 AS b0, 100 * n_repeat_words > 20 * n_words AS b1,
    word_chars < 2 * n_words AS b2, word_chars > 12 * n_words AS b3, 10 * n_symbols > n_words AS b4,
    10 * n_dup_lines > 3 * n_lines AS b5, 2 * n_upper > word_chars AS b6, 4 * n_marks > n_words AS b7
  FROM m
)
"""

OP11_SQL = _LEDGER_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  b0 OR b1 AS base_failed,
  NOT (b0 OR b1 OR b4 OR b6 OR b7) AND b2::INT + b3::INT + b5::INT <= 1 AS kept,
  (b0::INT + 2 * b1::INT + 4 * b2::INT + 8 * b3::INT + 16 * b4::INT + 32 * b5::INT + 64 * b6::INT
    + 128 * b7::INT)::BIGINT AS failures
FROM b
"""

_HARD = {"few_words": "b0", "repeated_words": "b1", "symbols": "b4", "upper_case": "b6", "marks": "b7"}
_SOFT = {"short_words": "b2", "long_words": "b3", "duplicate_lines": "b5"}


def _ablation_sql(version: str, hard: dict[str, str], soft: dict[str, str]) -> str:
    def kept(without: str | None) -> str:
        left = [b for n, b in hard.items() if n != without] or ["FALSE"]
        counted = [f"{b}::INT" for n, b in soft.items() if n != without] or ["0"]
        return f"(NOT ({' OR '.join(left)}) AND {' + '.join(counted)} <= 1)"

    return " UNION ALL ".join(
        f"""SELECT '{version}' AS version, {'NULL' if rule is None else f"'{rule}'"} AS rule,
        count(*) FILTER ({f'NOT {kept(None)}' if rule is None else {**hard, **soft}[rule]}) AS n_failed,
        count(*) FILTER ({kept(rule)}) AS n_kept,
        count(*) FILTER ({kept(rule)} AND NOT {kept(None)}) AS n_regained
        FROM b HAVING count(*) > 0"""
        for rule in (None, *hard, *soft))


ABLATIONS_SQL = _LEDGER_SQL + " UNION ALL ".join([
    _ablation_sql("1-base", {n: _HARD[n] for n in ("few_words", "repeated_words")}, {}),
    _ablation_sql("2-strict", _HARD, _SOFT),
])


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = zonemaps.cluster(
        table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed="1")
    return zonemaps.report(found)


def _op12_sql(rounds: int = 3) -> str:
    parts = ["""v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)""", """c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS cluster, e AS c
  FROM v WHERE vec_id IS NOT NULL QUALIFY cluster < 16
)"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
  SELECT r, vec_id, e, cluster,
    list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(e, c)])::BIGINT AS distance
  FROM v, c{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
)""")
        if n < rounds:
            parts.append(f"""m{n} AS (
  SELECT cluster, i, floor(sum(e[i]) / count(*))::BIGINT AS x
  FROM a{n}, unnest(range(1, 65)) AS u(i) GROUP BY cluster, i
), c{n + 1} AS MATERIALIZED (
  SELECT c{n}.cluster, coalesce(new.c, c{n}.c) AS c FROM c{n} LEFT JOIN
    (SELECT cluster, list(x ORDER BY i) AS c FROM m{n} GROUP BY cluster) new USING (cluster)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance,
  sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


OP12_SQL = _op12_sql()


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, vec_id = F.col("label"), F.col("vec_id")
    moved = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    rows = negatives.labelled_vectors(moved)
    return negatives.hard_negatives(rows, rows.where(vec_id % 100 == 0))


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


QUERIES: dict[str, Run] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_topk_search": op3_topk_search,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_language_id": op5_language_id,
    "op6_chat_format": op6_chat_format,
    "op7_license_scan": op7_license_scan,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_quality_rules": op11_quality_rules,
    "quality_ablations": quality_ablations,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_decontaminate": OP1_SQL,
    "op3_topk_search": OP3_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op6_chat_format": OP6_SQL,
    "op11_quality_rules": OP11_SQL,
    "quality_ablations": ABLATIONS_SQL,
    "op12_centroid_clusters": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
