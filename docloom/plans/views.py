"""Test views over the given tables.

The raw tables hold no markup, so every query starts from a view that adds
some by row number.  Each text runs unchanged in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources.tables import read_parquet

MD_COLUMNS = (
    "doc_id",
    "source",
    """CASE doc_id % 6
  WHEN 0 THEN concat('# Doc ', CAST(doc_id AS STRING), chr(10), chr(10), replace(text, chr(10), concat(chr(10), chr(10))))
  WHEN 1 THEN concat('Intro {zz-y} {123}', chr(10), chr(10), '## A', chr(10), replace(text, '. ', concat('.', chr(10), '### S', chr(10))))
  WHEN 2 THEN concat('![a](x.png) ![b](data:image/png;base64,AAAA==)', chr(10), '<figure>f', chr(10), 'g</figure><img src="data:image/gif;base64,R0" alt="q">', text)
  WHEN 3 THEN concat('data:image/png;base64,QUJD', chr(10), 'tail words. ', text)
  WHEN 4 THEN concat('#### deep', chr(10), '  # indented', chr(10), text, chr(10), '#x', chr(10), '# ', text)
  ELSE text END AS md""",
)

ADOC_COLUMNS = (
    "doc_id",
    """concat('docs/', source, '/d', CAST(doc_id AS STRING), CASE WHEN doc_id % 10 = 9 THEN '.txt' WHEN doc_id % 10 = 8 THEN '.pdf' ELSE '.adoc' END) AS path""",
    """concat('= Title ', CAST(doc_id AS STRING), chr(10), ':toc:', chr(10),
    CASE WHEN doc_id % 2 = 0 THEN concat(':product-title: Own {product-version}', chr(10)) ELSE '' END,
    ':product-version: 4.', CAST(doc_id % 20 AS STRING), chr(10), ':name-a: {name-b}', chr(10), ':name-b: bee', chr(10),
    '[id="sec_', CAST(doc_id AS STRING), '"]', chr(10), '== About {product-title} {name-a}', chr(10),
    'include::modules/x.adoc[leveloffset=+1]', chr(10), 'ifdef::foo[]', chr(10), 'Kept {unknown} {op-system-base} {kebab}', chr(10), 'endif::[]', chr(10), text) AS text""",
)

# References to shared attributes, and a table of them as long as that of the
# documents.  Values refer to others, a third of all texts to the same one.
ADOC_SHARED_COLUMNS = (
    "doc_id",
    """concat(text, chr(10), CASE WHEN doc_id % 4 = 0 THEN concat(':s-', CAST(doc_id AS STRING), ': own {s-1}', chr(10)) ELSE '' END,
    'Shared {s-', CAST(doc_id AS STRING), '}, {t-', CAST(doc_id % 17 AS STRING), '}, {kebab}', CASE WHEN doc_id % 3 = 0 THEN ', {u-1}' ELSE '' END) AS text""",
)
SHARED_COLUMNS = (
    """concat(CASE doc_id % 3 WHEN 0 THEN 's-' WHEN 1 THEN 't-' ELSE 'u-' END, CAST(doc_id div 3 AS STRING)) AS name""",
    """CASE doc_id % 3 WHEN 0 THEN concat('s', CAST(doc_id AS STRING), ' {t-', CAST(doc_id div 6 AS STRING), '} {product-title}')
    WHEN 1 THEN concat('t {u-', CAST(doc_id div 6 AS STRING), '} {s-2}') ELSE 'u {unknown}' END AS value""",
)

# Files with names and folders that a file scan would pass over.
TREE_PATH = """concat(CASE doc_id % 6 WHEN 1 THEN '_part/' WHEN 2 THEN '.git/' ELSE 'docs/' END, CAST(doc_id % 13 AS STRING), '/',
    CASE doc_id % 5 WHEN 0 THEN '_' WHEN 1 THEN '.' WHEN 2 THEN 'a #%20 ' ELSE '' END, 'd', CAST(doc_id AS STRING),
    CASE WHEN doc_id % 10 = 9 THEN '.txt' WHEN doc_id % 10 = 8 THEN '.pdf' WHEN doc_id % 10 = 7 THEN '.ADOC' ELSE '.adoc' END) AS path"""

# Lists, listings and links behind the text, for the markup conversion.
ADOC_MARKUP_COLUMNS = (
    "doc_id",
    """concat(text, chr(10), '=== Steps ', CAST(doc_id AS STRING), chr(10), '======= no title', chr(10), '* item', chr(10), '** nested', chr(10), '. one', chr(10), '.. two', chr(10),
    '[source,bash]', chr(10), '----', chr(10), '* no item', chr(10), '= no title', chr(10), '----', chr(10),
    'See link:a/b.html[the page], link:c.html[], https://example.org/x[a site] or https://example.org/', CAST(doc_id AS STRING), '[].', chr(10),
    '----', chr(10), 'plain', chr(10), '------', chr(10), '....', chr(10), '----', chr(10),
    '.....', chr(10), '* literal', chr(10), '....', chr(10), '.....', chr(10), '////', chr(10), '== gone', chr(10), '////', chr(10), '....... deep', chr(10),
    '[cols="', CASE doc_id % 3 WHEN 0 THEN '2*' WHEN 1 THEN '1,3,1' ELSE '' END, '"]', chr(10), '|===', chr(10), '|Name |Value', chr(10), '|D', CAST(doc_id AS STRING), chr(10), '|a', chr(92), '|b', chr(10), text, chr(10), chr(10), '|see <<x, X>> |', chr(10), '|===', chr(10),
    'image::img/', CAST(doc_id AS STRING), '.png[Shown, 200]', chr(10), 'See xref:a/b.adoc#c[that], xref:d', CAST(doc_id AS STRING), '[this] or <<near>>.', chr(10), CASE WHEN doc_id % 7 = 0 THEN concat('----', chr(10), 'never closed') ELSE 'end' END) AS text""",
)

# Documents whose output names collide: a third of them are called "index".
NAMED_COLUMNS = (
    "doc_id",
    """concat('docs/', source, '/', CASE WHEN doc_id % 3 = 0 THEN 'index' ELSE concat('p', CAST(doc_id % 97 AS STRING), '.v1') END, '.adoc') AS path""",
    "text AS md",
)

CONFIG_COLUMNS = (
    "doc_id",
    """concat('{"peft_type": "LORA", "base_model_name_or_path": "', source, '/', lang, '"}') AS config""",
    """CASE doc_id % 3 WHEN 0 THEN 'own/model' WHEN 1 THEN '' END AS override""",
)

QA_CASES = (
    "CASE WHEN conv_id % 11 = 3 THEN NULL WHEN conv_id % 11 = 4 THEN '' ELSE text END AS question",
    """CASE conv_id % 7
    WHEN 0 THEN concat('<think>a', chr(10), 'b</think> ', next_text)
    WHEN 1 THEN concat('<reasoning>r</reasoning><reflection>s</reflection>', next_text, chr(10))
    WHEN 2 THEN concat('<think>only a trace', chr(10), '</think>')
    WHEN 3 THEN concat('<think>x</reasoning>', next_text)
    WHEN 4 THEN concat('<think>a<think>b</think>c</think>', next_text)
    ELSE next_text END AS response""",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def documents_view(spark: SparkSession, sf_dir: str, columns: tuple[str, ...], spread: bool = False) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/documents.parquet", spread).selectExpr(*columns)


def md_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_view(spark, sf_dir, MD_COLUMNS, spread=True)


def adoc_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_view(spark, sf_dir, ADOC_COLUMNS, spread=True)


def adoc_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adoc_documents(spark, sf_dir).selectExpr(*ADOC_MARKUP_COLUMNS)


def qa_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn with the assistant's next one.

    Turns are numbered without gaps, so the next turn is found by an equality
    join on a unique key; a conversation of any length spreads over tasks.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", "text")
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text")
    )
    return asked.join(answered, ["conv_id", "turn"]).selectExpr("conv_id * 100 + turn AS qa_id", *QA_CASES)


def eval_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    reference = items.selectExpr(
        "item_id AS question_id", "'reference' AS model", "text AS question", "text AS answer"
    )
    tuned = items.where("item_id % 5 <> 4").selectExpr(
        "item_id AS question_id", "'tuned' AS model", "text AS question", "concat('T: ', text) AS answer"
    )
    return reference.unionAll(tuned)
