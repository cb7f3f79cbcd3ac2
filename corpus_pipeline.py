"""Documents to encoded training text in five stages, each a written table.

toxicity: rows whose score says label 1 go. near_duplicates: five-word shingles, a
Jaccard similarity of 0.8; of each group of linked documents the one with the smallest
id stays (rows with equal ids are one document; rows with null ids stay unless linked
with a numbered one). repeated_passages: bytes covered by a 50-byte string that also
starts in a document with a smaller id are cut from the text; a character of which
only some bytes are left becomes U+FFFD; n_chars is counted anew; null texts stay null
and texts may become empty. contamination: documents with a passage within a tenth of a
benchmark item's length in edits of it go. encoding: piece ids that decode to the text.

All stages but the last return the columns of documents, further ones and ones named like
an operator's own included; the last adds n_pieces, ids, decoded_sha256 and round_trip, which
replace columns of these names. Null ids and texts and repeated rows are rows like any other:
each stage does with them what its operator defines. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from termtide.llm import decontaminate, ngram_join, pieces, suffix_dedup, toxicity
from termtide.llm.exchange import staged
from termtide.llm.shipping import ship


def _aside(docs: DataFrame):
    """The rows with all columns but doc_id and text under names that no stage uses, and the way back."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])

    return docs.select(*[F.col(c).alias(names.get(c, c)) for c in docs.columns]), back


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machine = toxicity.learn(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, back = _aside(docs)
    return back(toxicity.score_texts(rows, machine).where("predicted = 0"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows, back = _aside(docs)
    return back(ngram_join.link_documents(rows, size=5, percent=80).where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows, back = _aside(docs)
    text = F.when(F.col("text").isNotNull(), F.when(F.col("n_removed") > 0, F.make_valid_utf8(F.col("kept").cast("string"))).otherwise(F.col("text")))
    cut = back(suffix_dedup.remove_repeats(rows, length=50).withColumn("text", text))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pieces.encode(docs, pieces.load())


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("contamination", remove_contaminated),
    ("encoding", encode_pieces),
]
# models, edit distances and segmentation are beyond SQL; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
