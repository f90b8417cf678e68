"""The registered queries of this package, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.llm.decontaminate import contaminated
from docloom.llm.language import page_languages
from docloom.llm.lattice import lattice_scores
from docloom.llm.mixing import curriculum_plan
from docloom.llm.ngram_join import ngram_jaccard_groups
from docloom.llm.pii import personal_data
from docloom.llm.quality import quality_scores
from docloom.llm.runs import periodic_runs
from docloom.llm.sentence_spans import drop_repeated_spans
from docloom.llm.sketches import edited_fingerprints
from docloom.llm.tables import table
from docloom.llm.token_counts import token_counts
from docloom.llm.topk import nearest_of_table
from docloom.llm.whitening import whiten


def op1_quality_rules(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_personal_data(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


def op3_lattice_likelihood(spark, sf_dir):
    return lattice_scores(table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


def op6_page_language(spark, sf_dir):
    return page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op7_top_k(spark, sf_dir):
    return nearest_of_table(table(spark, sf_dir, "embeddings"))


def op8_ngram_jaccard(spark, sf_dir):
    return ngram_jaccard_groups(table(spark, sf_dir, "documents"))


def op9_curriculum_mix(spark, sf_dir):
    plan = curriculum_plan(table(spark, sf_dir, "documents"))
    first = F.round(F.get("copies", F.lit(0))["position"], 9).alias("first_position")
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").alias("n_copies"), first)


def op10_sentence_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_spans(docs).select("doc_id", "n_sentences", "n_removed", "first_doc_ids", "text")


def with_planted_periods(docs):
    """``doc_id, text``, where the end of every tenth text (by the CRC of its id)
    is made to repeat from some word on."""
    blanks = " \t\n\x0b\x0c\r"
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.split(F.trim("text", F.lit(blanks)), "[ \t-\r]+")
    chosen = (crc % 10 == 0) & (F.trim("text", F.lit(blanks)) != "")
    sized = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.when(chosen, words).alias("words"))
    n = F.size("words")
    begin = F.col("g") % n
    placed = sized.withColumn("a", begin).withColumn("p", 1 + F.expr("(size(words) - a) div (3 + g % 8)"))
    turned = F.transform(
        "words",
        lambda word, i: F.when(i < F.col("a"), word).otherwise(
            F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        ),
    )
    return placed.select(
        "doc_id", F.when(F.col("words").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text")
    )


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # The first of the greatest length / period: fractions compared as products.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark, sf_dir):
    found = edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


OP7_SQL = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_inner_product(CAST(q.parts AS DOUBLE[]), CAST(v.parts AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.parts) = len(v.parts)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\x0C\r]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CAST([5, 2, 1][pos % 3 + 1] AS HUGEINT) AS weight, 3 * source_size AS bound FROM sources
), filled AS (
  SELECT *,
         sum(weight) OVER (ORDER BY bound * 10 // weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
         sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound * 10 // weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_left
  FROM weighted
), bounded AS (
  SELECT *, CAST(bound * weight_left <= weight * size_left AS BOOLEAN) AS is_bounded FROM filled
), targets AS (
  SELECT source, pos, source_size,
         CASE WHEN is_bounded THEN CAST(bound AS DOUBLE)
              ELSE CAST(weight * (sum(source_size) OVER () - coalesce(sum(bound) FILTER (is_bounded) OVER (), 0)) AS DOUBLE)
                   / CAST(sum(weight) FILTER (NOT is_bounded) OVER () AS DOUBLE) END AS target
  FROM bounded
), streams AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized
), copies AS (
  SELECT s.doc_id, s.size, CAST(t.source_size AS BIGINT) AS source_size, t.target, t.pos, i,
         s.start + i * CAST(t.source_size AS BIGINT) AS begin,
         greatest(least(CAST(floor(t.target) AS BIGINT) - (s.start + i * CAST(t.source_size AS BIGINT)), s.size), 0) AS words
  FROM streams s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1), (2)) AS rounds(i)
), placed AS (
  SELECT *, (begin + words / 2.0::DOUBLE) / target AS part, [0.5::DOUBLE, 0, -0.5][pos % 3 + 1] AS slope FROM copies
)
SELECT doc_id, size, source_size, target, CAST(sum(words) AS BIGINT) AS taken,
       CAST(count(*) FILTER (words > 0) AS INTEGER) AS n_copies,
       min(round(CASE WHEN slope = 0 THEN part
            ELSE (1 + slope - sqrt((1 + slope) * (1 + slope) - 4 * slope * part)) / (2 * slope) END, 9))
         FILTER (words > 0 AND i = 0) AS first_position
FROM placed GROUP BY doc_id, size, source_size, target
"""

OP13_SQL = r"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), ids AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place, min(text) AS text
  FROM rows WHERE doc_id IS NOT NULL GROUP BY doc_id
), following AS (
  SELECT a.doc_id, b.text AS next FROM ids a JOIN ids b ON b.place = (a.place + 1) % (SELECT count(*) FROM ids)
), edits AS (
  SELECT r.doc_id, r.text, f.next,
         left(r.text, length(r.text) - length(r.text) // 4) || left(f.next, length(r.text) // 4) AS edited
  FROM rows r LEFT JOIN following f USING (doc_id)
), texts AS (
  SELECT DISTINCT unnest([text, next, edited]) AS text FROM edits
), folded AS (
  SELECT text, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\x0C\r]+') AS words
  FROM texts WHERE text IS NOT NULL
), hashed AS (
  SELECT text, list_sort(list_distinct(list_transform(
           range(1, CASE WHEN len(words) = 0 THEN 1 ELSE greatest(len(words) - 4, 1) + 1 END),
           lambda i: substring(md5(array_to_string(words[i:i + 4], ' ')), 1, 16)))) AS hashes
  FROM folded
), prints AS (
  SELECT text, hashes[1:128] AS print FROM hashed
), joined AS (
  SELECT e.*, a.print AS own, b.print AS changed, c.print AS other
  FROM edits e JOIN prints a ON a.text = e.text
  LEFT JOIN prints b ON b.text = e.edited LEFT JOIN prints c ON c.text = e.next
), unions AS (
  SELECT *, list_sort(list_distinct(list_concat(own, changed))) AS with_changed,
         list_sort(list_distinct(list_concat(own, other))) AS with_other
  FROM joined
), counts AS (
  SELECT *,
         CASE WHEN len(own) < 128 AND len(changed) < 128 THEN len(with_changed) ELSE least(128, len(with_changed)) END AS m,
         CASE WHEN len(own) < 128 AND len(other) < 128 THEN len(with_other) ELSE least(128, len(with_other)) END AS n
  FROM unions
)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(own, '') AS fingerprint, array_to_string(changed, '') AS edited_fingerprint,
       CASE WHEN edited IS NULL THEN NULL WHEN m = 0 THEN 1.0::DOUBLE
            ELSE len(list_filter(list_intersect(own, changed), lambda x: x <= with_changed[m])) / m::DOUBLE END AS near_edited,
       CASE WHEN edited IS NULL THEN NULL WHEN n = 0 THEN 1.0::DOUBLE
            ELSE len(list_filter(list_intersect(own, other), lambda x: x <= with_other[n])) / n::DOUBLE END AS near_next
FROM counts
"""

ORACLE_SQL: dict[str, str] = {
    "op7_top_k": OP7_SQL,
    "op9_curriculum_mix": OP9_SQL,
    "op13_fingerprints": OP13_SQL,
}


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql():
    return dict(ORACLE_SQL)
