"""The corpus pipeline: documents -> quality -> language -> near duplicates -> personal data
-> packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read back as the next stage's ``docs``.  All but the last return the columns of
``documents``; a stage works on every row that the one before kept.

Whatever the columns hold, a stage keeps rows as they are unless it rejects them: null ids
and repeated rows stay (the near-duplicate stage keeps one row of each group, and all rows
without an id), null texts count as empty, columns beyond those of ``documents`` are left
aside, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketstream.llm.common import bounded_batches, table, written
from marketstream.llm.langid import fit as fit_languages
from marketstream.llm.langid import learn_rows, told
from marketstream.llm.ngram_join import first_of_groups
from marketstream.llm.packing import packed_documents
from marketstream.llm.pii import DEMO_KEY, replaced
from marketstream.llm.quality import fit, passed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SHARE = 0.5     # of the likelihoods, for the language that is predicted
SPREADS = 10.0        # above the median bits a byte of that language, at most


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier scores at least its threshold; it learns from the
    labelled rows of ``docs`` outside the held-out fold.  Null and empty texts have a score
    like any other; rows with a null id learn nothing and are scored."""
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    return passed(docs, fit(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told: not ``und``, with at least LEAST_SHARE of the likelihoods
    for one language, and not coded at far more bits a byte than that language's own texts
    (junk, languages that were never learnt).  Null, empty and blank texts go, as do texts
    without a letter.  Without anything to learn from, every row stays."""
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    return told(docs, fit_languages(learn_rows(docs)), LEAST_SHARE, SPREADS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id.  An id with
    several texts keeps each text that nothing links; equal rows count as one; rows without an
    id are in no group."""
    bounded_batches(spark)
    return first_of_groups(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with pseudonyms in its text and ``n_chars`` of the new text."""
    bounded_batches(spark)
    return replaced(docs.select(*COLUMNS), DEMO_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row and their places in the packed sequences."""
    bounded_batches(spark)
    return packed_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32",
                                         "sequence_id", "offset")


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packing)]

#: Learned models, permutations and packings are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


def all_queries() -> dict:
    return {"pipeline": pipeline}


def all_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
