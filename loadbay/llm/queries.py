"""Registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.llm import (exact_dedup, fill_middle, importance, langid, lm_score, minmax_dedup, mixing, packing, pii,
                         prefix_hash, quality_rules, quotes, token_counts)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_replies(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op2_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.next_document_likeness(_documents(spark, sf_dir))


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_copies(_documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), tokenizer_path())


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_documents(spark, sf_dir))


def op8_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path())


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(langid.learnable(docs)))


def op10_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_groups(_documents(spark, sf_dir), k=4)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.rewrite(_documents(spark, sf_dir))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quote_links, op2_prefix_hash, op3_systematic_mix, op4_token_counts, op5_pseudo_likelihood,
        op6_exact_dedup, op7_personal_data, op8_curve_packing, op9_language, op10_minmax_dedup,
        op11_fill_middle, op12_importance, op13_quality_rules)}


#: CRC-32 of the UTF-8 bytes of every distinct term, bit by bit.
_CRCS = """crcs AS (SELECT term, xor(list_reduce(list_concat([4294967295::BIGINT], [
    (('0x' || substr(hex(term), 2 * (i // 8) + 1, 2))::BIGINT >> (i % 8)) & 1
    for i in range(4 * length(hex(term)))]),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::BIGINT) AS crc FROM terms)"""
_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_TRIED = ", ".join(
    f"abs(sum(({c}) * size) - target) AS m{k}"
    for k in range(mixing.TURNS)
    for c in [f"least(floor(((u + {k / mixing.TURNS}) % 1.0) + rate * (prior + 1)) "
              f"- floor(((u + {k / mixing.TURNS}) % 1.0) + rate * prior), ceil(rate))"])
_NEAREST = ", ".join(f"m{k}" for k in range(mixing.TURNS))

ORACLE_SQL: dict[str, str] = {
    "op3_systematic_mix": f"""
WITH sized AS (SELECT doc_id, source, {_SIZE}::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sources),
levels AS (SELECT *, 3.0::DOUBLE * source_size AS ceiling, 3.0::DOUBLE * source_size / weight AS room FROM weighed),
served AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER (
        ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS level FROM levels),
goal AS (SELECT source, source_size, CASE WHEN settled IS NULL OR room < settled THEN ceiling
    ELSE settled * weight END AS target,
    ('0x' || substr(md5('1:' || coalesce(source, '')), 1, 6))::BIGINT / 16777216.0::DOUBLE AS u
    FROM (SELECT *, max(level) FILTER (level <= room) OVER () AS settled FROM served)),
placed AS (SELECT s.doc_id, s.source, s.size, g.source_size, g.target, g.u,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS prior
    FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
tried AS (SELECT source, [{_NEAREST}] AS miss FROM (
    SELECT source, target, {_TRIED} FROM placed GROUP BY source, target)),
turned AS (SELECT p.*, (p.u + (list_position(miss, list_min(miss)) - 1) / {mixing.TURNS}.0::DOUBLE) % 1.0::DOUBLE AS v
    FROM placed p JOIN tried t ON p.source IS NOT DISTINCT FROM t.source),
counted AS (SELECT *, least(floor(v + rate * (prior + 1)) - floor(v + rate * prior), ceil(rate))::BIGINT AS copies
    FROM turned)
SELECT doc_id, size, source_size, target, copies, (copies * size)::BIGINT AS taken FROM counted""",
    "op6_exact_dedup": r"""
WITH cleaned AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS clean FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY clean ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(clean) AS text_sha256
FROM cleaned WINDOW w AS (PARTITION BY clean)""",
    "op11_fill_middle": r"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
ends AS (SELECT doc_id, t, units, len(units)::BIGINT AS n,
    ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
            OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
        WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT doc_id, t, n, form, array_to_string(units[1:least(a, b)], '') AS prefix,
    array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
    array_to_string(units[greatest(a, b) + 1:n], '') AS suffix FROM ends)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts""",
    "op12_importance": rf"""
WITH all_words AS (SELECT 'd' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS row FROM documents
    UNION ALL SELECT 'b', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), 0 FROM benchmark),
each AS (SELECT side, row, unnest(words) AS term FROM all_words),
terms AS (SELECT DISTINCT term FROM each),
{_CRCS},
placed AS (SELECT side, row, crc % 10000 AS bucket FROM each JOIN crcs USING (term)),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (SELECT row, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
        + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
    FROM all_words LEFT JOIN weights USING (row) WHERE side = 'd'),
ranked AS (SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS LAST) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank FROM ranked""",
    "op13_quality_rules": rf"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
cut AS (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM base),
spans AS (SELECT row, unnest(range(1, len(words) - 1)) AS i,
    unnest([words[k:k + 2] for k in range(1, len(words) - 1)]) AS span FROM cut WHERE len(words) > 2),
twice AS (SELECT row, i, count(*) OVER (PARTITION BY row, span) AS times FROM spans),
covered AS (SELECT row, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE times > 1) GROUP BY row),
each AS (SELECT row, unnest(tokens) AS term, unnest(range(len(tokens))) AS i
    FROM (SELECT row, regexp_extract_all(text, '{quality_rules.TOKEN}') AS tokens FROM base)),
terms AS (SELECT DISTINCT term FROM each),
{_CRCS},
hashed AS (SELECT row, crc, lead(crc) OVER (PARTITION BY row ORDER BY i) AS after FROM each JOIN crcs USING (term)),
placed AS (SELECT row, crc % {quality_rules.BUCKETS} AS bucket FROM hashed
    UNION ALL SELECT row, (crc * 31 + after) % {quality_rules.BUCKETS} FROM hashed WHERE after IS NOT NULL),
trusted AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)
    ORDER BY sha256(doc_id::VARCHAR) LIMIT {quality_rules.TRUSTED}),
counts AS (SELECT bucket, count(*) AS s, count(*) FILTER (doc_id IN (SELECT doc_id FROM trusted)) AS t
    FROM placed JOIN base USING (row) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {quality_rules.BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {quality_rules.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts),
sums AS (SELECT row, count(*) AS n_grams, sum(gain)::BIGINT AS ratio FROM placed JOIN gains USING (bucket) GROUP BY row),
figures AS (SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_grams, 0)::BIGINT AS n_grams, coalesce(ratio, 0)::BIGINT AS ratio
    FROM base JOIN cut USING (row) LEFT JOIN covered USING (row) LEFT JOIN sums USING (row))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ratio >= {quality_rules.LEAST} * n_grams AS kept
FROM figures""",
}
