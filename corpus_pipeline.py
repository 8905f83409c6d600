"""A corpus pipeline over ``documents``: each stage works on all that the stage before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.

In every stage: an empty table gives an empty one; columns other than doc_id, text and n_chars are handed on
untouched, whatever their names; very long texts are read whole; a row is known by its id and its text, so
rows that share an id but not a text are told apart, and rows alike in both share one fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.llm import decontaminate, ngram_join, secret_scan, sentencepiece_fst, toxicity
from kabuto.llm.common import prepare, row_id, without_rows, written

TOXIC = 0.5  # texts that score this much are rejected


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic (the model is fitted on the labels' training part).

    Null and empty texts, and texts without a letter, hold nothing toxic and stay, whatever the score of an
    empty text is; null ids are scored like others; repeated rows all go or all stay."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    said = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return docs.where(~said | (toxicity.scorer(spark, model)(F.col("text")) < TOXIC))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five-word shingles, similarity 0.75): the one of
    smallest id (null last), then of smallest text digest; of rows alike in id and text, one.

    Null and empty texts link with nothing: of those with one id, one stays."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents contaminated by benchmark items. Null and empty texts stay; rows that repeat an
    id are judged each by its own text."""
    benchmark = prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(row_id().alias("id"), "text")
    found = decontaminate.decontaminate(rows, benchmark, "id")
    return without_rows(docs, written(found.where("contaminated").select("id"), "contaminated"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets masked (n_chars follows where a text changes). Null and empty texts stay as
    they are; no row goes."""
    prepare(spark)
    new = unused(docs, "masked")
    out = docs.withColumn(new, secret_scan.masker(spark, secret_scan.fit(docs))(F.col("text")))
    same = F.col("text").eqNullSafe(F.col(new))
    out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.char_length(new).cast("long")))
    return out.withColumn("text", F.col(new)).select(*docs.columns)


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether they decode to its text. Null and empty texts have no
    ids and decode to themselves."""
    out = sentencepiece_fst.encode_documents(docs.select("doc_id", "text"), decoded="__decoded")
    same = sentencepiece_fst.round_trip(F.col("text"), F.col("__decoded"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), same.alias("same"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("sentencepiece", encode),
]

#: No stage but the rules of two of them can be written in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
