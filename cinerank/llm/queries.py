"""The registered queries of the subpackage, each over its whole table, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import bpe, chat, decontam, fim, jaccard, langid, pii, ppm, quality, repeats, runs, search, toxicity
from cinerank.llm.common import read

#: The key of the surrogates; a deployment passes its own.
PII_KEY = b"surrogate key of the registered queries"


def op1_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.held_out_scores(read(spark, d, "documents"), read(spark, d, "labels"))


def op2_ppm(spark: SparkSession, d: str) -> DataFrame:
    return ppm.held_out_scores(read(spark, d, "documents"))


def op3_chat_format(spark: SparkSession, d: str) -> DataFrame:
    turns = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2, numPartitions=1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    out = chat.read_back(chat.format_conversations(chat.events_of_rows(turns.unionByName(extra))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_repeated_strings(spark: SparkSession, d: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, d, "documents")).drop("kept")


def op5_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, d, "documents"))


def op6_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontam.report(read(spark, d, "documents"), read(spark, d, "benchmark"))


def op7_topk_search(spark: SparkSession, d: str) -> DataFrame:
    """The ten best documents for the whole text of every document whose id is divisible by 50."""
    docs = read(spark, d, "documents").select("doc_id", "text")
    return search.top_k(docs, docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query"), "text"))


def op8_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.digests(read(spark, d, "documents"), public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.held_out_languages(read(spark, d, "documents"))


def op10_pii_surrogates(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, n_entities, n_distinct, the kinds found, the text with surrogates, and the ambiguous surrogates in it."""
    docs = read(spark, d, "documents").select("doc_id", "text")
    out = pii.checked(docs, PII_KEY)
    return out.select(
        "doc_id", F.size("entities").cast("long").alias("n_entities"),
        F.size(F.array_distinct(F.transform("entities", lambda e: F.struct(e["kind"], e["surrogate"])))).cast("long").alias("n_distinct"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",").alias("kinds"),
        "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "n_ambiguous",
    )


def op11_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """Base measures and verdict, then the other measures and the names of the broken rules."""
    out = quality.assess(read(spark, d, "documents").select("doc_id", "text"), failed="failed", kept="verdict")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).select(
        "doc_id", *base, "base_failed", (~F.col("base_failed") & F.col("verdict")).alias("kept"),
        *(m for m in quality.MEASURES if m not in base), F.array_join("failed", ",").alias("failed"),
    )


def op12_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    out = fim.transform(read(spark, d, "documents").select("doc_id", "text"), seed=42, rate=50, spm_share=80)
    return out.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restore("output", "form"), 256).alias("restored_sha256"),
    )


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts with their words from the a-th on as repeats of the p words that begin there."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words, n, a, p = F.col("words"), F.col("n"), F.col("a"), F.col("p")
    cut = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(quality.WORD), F.lit(0))))
    cut = cut.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(n > 0, F.col("g") % n))
    cut = cut.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times, rest = F.expr("(n - a) div p").cast("int"), ((n - a) % p).cast("int")
    repeated = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.flatten(F.array_repeat(unit, times)), F.slice(words, (a + 1).cast("int"), rest))
    return cut.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    out = runs.find_runs(_planted(read(spark, d, "documents")))
    # the double quotient orders lengths over periods exactly for texts of up to 40 million words
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"] / r["period"]).alias("e"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_ppm, op3_chat_format, op4_repeated_strings, op5_ngram_jaccard, op6_decontaminate, op7_topk_search, op8_byte_bpe, op9_language_id, op10_pii_surrogates, op11_quality_rules, op12_fill_in_middle, op13_periodic_runs)
}

SQL: dict[str, str] = {
    "op3_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, sha256(text) AS digest,
    length('<|turn|>') + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;')) + 1
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + length('<|end|>') + 1 AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, digest)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, digest) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""",
    "op7_topk_search": r"""
WITH words AS (
  SELECT * FROM (
    SELECT doc_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+')) AS term
    FROM documents) WHERE term <> ''
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
total AS (SELECT (SELECT count(*) FROM documents) AS docs, (SELECT sum(n) FROM len) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT term, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, total GROUP BY term, docs),
impact AS (SELECT doc_id, term, idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) AS w, tf FROM tf JOIN len USING (doc_id) JOIN df USING (term), total),
hit AS (
  SELECT q.doc_id AS query, i.doc_id, round(sum(q.tf * i.w), 6) AS score
  FROM impact q JOIN impact i USING (term) WHERE q.doc_id % 50 = 0 GROUP BY ALL
)
SELECT query, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM hit
QUALIFY rank <= 10""",
    "op11_quality_rules": r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
cut AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
word AS (SELECT doc_id, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM texts),
window3 AS (SELECT doc_id, i, x, lead(x) OVER w AS y, lead(x, 2) OVER w AS z FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (SELECT doc_id, i FROM window3 WHERE z IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, x, y, z) > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS i FROM repeated, (VALUES (0), (1), (2)) AS t(k)) GROUP BY doc_id),
counted AS (SELECT doc_id, len(words) AS n_words,
  length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
  length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  length(regexp_replace(text, '[^\p{L}\p{M}]+', '', 'g')) AS n_letters,
  len(list_filter(words, lambda w: w = upper(w) AND w <> lower(w) AND length(w) > 1)) AS n_upper_words,
  len(list_filter(words, lambda w: list_contains(STOP, lower(w)))) AS n_stop_words, len(lines) AS n_lines,
  len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•‣●▪◦·]'))) AS n_bullet_lines,
  len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
  FROM cut LEFT JOIN covered USING (doc_id)),
ruled AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  concat_ws(',', RULES) AS failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed = '' AS kept,
  n_letters, n_upper_words, n_stop_words, n_lines, n_bullet_lines, n_ellipsis_lines, failed FROM ruled""".replace(
        "STOP", "[" + ", ".join(f"'{w}'" for w in quality.STOP_WORDS) + "]"
    ).replace("RULES", ", ".join(
        f"CASE WHEN {r.measure} {sign} CAST({float(bound)} AS DOUBLE) * {r.per or 1} THEN '{r.name}' END"
        for r in quality.RULES for sign, bound in (("<", r.least), (">", r.most)) if bound is not None
    )),
    "op12_fill_in_middle": r"""
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
drawn AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
  CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2, CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM hashed),
counted AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM counted)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM cut""",
}
