"""A corpus pipeline of five stages: what toxicity rejects goes, one document of each group of
near duplicates stays, contaminated documents go, secrets are masked, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of ``docs``; ``run`` writes every result to the shared folder
and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.llm import decontaminate, neardup, packing, secrets, toxicity
from lotloom.llm.joins import attach, unused
from lotloom.llm.queries import vocabulary
from lotloom.session import Scratch, table

# All stages but the last: columns keep their names, types and order, whatever they are called; further
# columns than doc_id and text are carried along. An empty table stays empty.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half.

    A null or empty text has no toxic token and stays. Repeated rows score alike, so all of them go or stay.
    """
    score, spans = unused(docs.columns, "score", "spans")
    scored = toxicity.score_toxicity(spark, docs, table(spark, sf_dir, "labels"), score, spans)
    return scored.where(F.col(score) < 0.5).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that names its group, of each group of near duplicates.

    Null and empty texts have no group and stay, as does a null doc_id. Rows that share a doc_id are one
    document: if their texts have several groups, the document stays if it names one of them.
    """
    judged = neardup.near_duplicates(spark, docs.select("doc_id", "text"))
    gone = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select("doc_id")
    gone = Scratch(spark, "copies").write(gone, "gone")
    kept = attach(docs, gone, ["doc_id"], ["doc_id"], "left_anti", 32)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item. Null and empty texts stay; repeated rows share their fate."""
    return decontaminate.without_overlaps(spark, docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the text. Null and empty texts and repeated rows stay as they are."""
    return secrets.mask(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their sequences. A null or empty text is one piece, the end mark; repeated rows are packed once each."""
    return packing.pack(spark, docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: A trained model and a tokenizer take part, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{i}")
        if i > 0:
            scratch.drop(f"stage-{i - 1}")
    return docs
