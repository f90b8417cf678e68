"""Language of web pages by fusing evidence the way Bayes' rule says.

For every language the log-likelihoods of independent evidence add up:

* the visible words, by a naive Bayes model over hashed words that is trained
  on all documents with a known language (their likelihood is tempered, since
  words of a text depend on each other);
* the language the markup declares, and the suffix of the address (top-level
  domain and a leading language part of the path), each by how often it comes
  with pages whose words tell the language;
* the host, by a prior that is smoothed in levels: a host's own pages count
  against the prior of its domain, those of the domain against all pages.

The tables of counts come from grouped aggregation over all pages; a page's
own vote is taken out of the counts of its host and domain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.arrays import batch_words
from docloom.llm.tables import saved

FEATURE_BITS = 16
#: Exponent of the likelihood of the words; pages that a parent level's prior
#: counts for; uses added to every cell of a table of counts.
TEMPER = 0.5
LEVEL_PAGES = 5.0
ADDED = 0.5

_FEATURES = 1 << FEATURE_BITS
_SHIFT = np.uint64(64 - FEATURE_BITS)
_MARKUP = re.compile(rb"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>")


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _SHIFT).astype(np.int64)


def _counted(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(languages) * _FEATURES, np.int64)
        for batch in batches:
            number = batch.column("number").to_numpy()
            for first, last, _, found in batch_words(batch):
                language = np.repeat(number[first:last], np.diff(found.offsets))
                counts += np.bincount(language * _FEATURES + _features(found.hash), minlength=len(counts))
        blocks = counts.reshape(-1, 1024)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.record_batch(
            [pa.array(used, pa.int32()), pa.array([blocks[i].tobytes() for i in used], pa.binary())],
            names=["block", "counts"],
        )

    return run


def _summed(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
    return pa.table({"block": group.column("block")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def word_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages (one per distinct label) and log-probabilities of the word
    features in each; 512 KB a language by way of the driver."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), "text"
    )
    languages = sorted(row["lang"] for row in labelled.select("lang").distinct().collect())
    if not languages:
        return [], np.zeros((0, _FEATURES))
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    sums = labelled.select(number.cast("long").alias("number"), "text").mapInArrow(
        _counted(languages), "block int, counts binary"
    )
    counts = np.zeros((len(languages) * _FEATURES // 1024, 1024))
    for row in sums.groupBy("block").applyInArrow(_summed, "block int, counts binary").collect():
        counts[row["block"]] = np.frombuffer(row["counts"], np.int64)
    counts = counts.reshape(len(languages), _FEATURES) + ADDED
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def _likelihoods(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("html")
            texts = [_MARKUP.sub(b" ", (html.as_py() or "").encode()) for html in batch.column(at)]
            sums = np.zeros((len(batch), len(model)))
            counts = np.zeros(len(batch), np.int64)
            visible = pa.record_batch([pa.array(texts, pa.binary()).cast(pa.string())], names=["text"])
            for first, last, _, found in batch_words(visible):
                of = np.repeat(np.arange(last - first), np.diff(found.offsets))
                features = _features(found.hash)
                counts[first:last] = np.diff(found.offsets)
                for i, row in enumerate(model):
                    sums[first:last, i] = np.bincount(of, row[features], minlength=last - first)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [name for name in batch.schema.names if name != "html"]
            yield pa.record_batch(
                [*columns, pa.array(counts), pa.array(list(sums), pa.list_(pa.float64()))],
                names=[*names, "n_words", "words"],
            )

    return run


def _votes(languages: list[str]) -> list[Column]:
    return [F.count_if(F.col("vote") == i).cast("double").alias(f"n{i}") for i in range(len(languages))]


def _table(pages: DataFrame, key: str, languages: list[str], alias: str) -> DataFrame:
    counted = pages.where(F.col("vote").isNotNull()).groupBy(key).agg(*_votes(languages))
    return counted.select(
        F.col(key).alias(f"_{alias}"), F.array(*[f"n{i}" for i in range(len(languages))]).alias(f"{alias}_votes")
    )


def page_languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``page_id, host, declared, suffix, words_lang, lang, confidence`` of
    ``pages(page_id, url, html)``, learning words from ``docs(text, lang)``.

    ``words_lang`` goes by the words alone and is null for a page without
    any.  Null markup or address is no evidence.  Without documents of a known
    language ``lang`` is null.  Every row is returned, also repeated ones and
    those without an id; other columns are ignored.
    """
    spark = pages.sparkSession
    languages, model = word_model(docs)
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    facts = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)), F.lit("")).alias(
            "declared"
        ),
        F.nullif(F.lower(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[-_/]|$)", 1)), F.lit("")).alias(
            "path_lang"
        ),
        "html",
    )
    labels = F.split("host", r"\.")
    facts = facts.withColumns(
        {
            "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
            "suffix": F.concat_ws("/", F.element_at(labels, -1), "path_lang"),
        }
    ).select("page_id", "host", "domain", "declared", "suffix", "html")
    shared = spark.sparkContext.broadcast(model)
    known = saved(
        facts.mapInArrow(
            _likelihoods(shared),
            "page_id long, host string, domain string, declared string, suffix string, n_words long, words array<double>",
        ),
        "page-words",
    )
    n = len(languages)
    if not n:
        nothing = F.lit(None).cast("string")
        return known.select(
            "page_id", "host", "declared", "suffix", nothing.alias("words_lang"), nothing.alias("lang"),
            F.lit(None).cast("double").alias("confidence"),
        )
    best = (F.array_position("words", F.array_max("words")) - 1).cast("int")
    voted = known.withColumn("vote", F.when(F.col("n_words") > 0, best))
    totals = voted.agg(*_votes(languages)).first()
    totals = np.array([totals[f"n{i}"] or 0.0 for i in range(n)])
    share = (totals + ADDED) / (totals + ADDED).sum()

    joined = voted
    for key in ("host", "domain", "declared", "suffix"):
        table = _table(voted, key, languages, key)
        joined = joined.join(table, joined[key] == table[f"_{key}"], "left").drop(f"_{key}")

    def votes(key: str, i: int, own: bool) -> Column:
        count = F.coalesce(F.get(f"{key}_votes", F.lit(i)), F.lit(0.0))
        return count - F.when(F.col(key).isNotNull() & (F.col("vote") == i), 1.0).otherwise(0.0) if own else count

    def total(key: str) -> Column:
        parts = [votes(key, i, True) for i in range(n)]
        return sum(parts[1:], parts[0])

    scores = []
    for i in range(n):
        domain = (votes("domain", i, True) + LEVEL_PAGES * float(share[i])) / (total("domain") + LEVEL_PAGES)
        prior = (votes("host", i, True) + LEVEL_PAGES * domain) / (total("host") + LEVEL_PAGES)
        score = F.log(prior) + TEMPER * F.get("words", F.lit(i))
        for key in ("declared", "suffix"):
            likelihood = (votes(key, i, False) + ADDED) / F.lit(float(totals[i] + 2 * ADDED))
            score = score + F.when(F.col(key).isNotNull(), F.log(likelihood)).otherwise(0.0)
        scores.append(score)
    scored = joined.withColumn("scores", F.array(*scores))
    scored = scored.withColumn("top", F.array_max("scores"))
    names = F.array(*[F.lit(x) for x in languages])
    mass = F.aggregate("scores", F.lit(0.0), lambda total, x: total + F.exp(x - F.col("top")))
    return scored.select(
        "page_id",
        "host",
        "declared",
        "suffix",
        F.get(names, F.col("vote")).alias("words_lang"),
        F.get(names, (F.array_position("scores", F.col("top")) - 1).cast("int")).alias("lang"),
        (1 / mass).alias("confidence"),
    )
