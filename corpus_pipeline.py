"""A training corpus from raw documents: identify language, drop near copies, decontaminate, hide personal data, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.  Language ID learns from all of the table's own labelled rows and drops what it
rejects; of each class of near copies the smallest doc_id stays; documents that hold a benchmark item go; personal values become
pseudonyms; what remains is packed into sequences.  Stages follow the operators' rules for nulls, empty texts and repeated
rows; a null doc_id is a document of its own (it can be neither copy nor leak) and stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast.llm import decontaminate, jaccard, langid, packing, pii, tokens
from cohortcast.llm.common import join_checked, prepare, table, written
from cohortcast.llm.queries import PII_KEY


def _plain(docs: DataFrame) -> DataFrame:
    """docs under names that clash with nothing an operator adds: c0, c1, ... and text."""
    return docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = langid.fit(docs)                            # nothing is held out: no prediction is judged here
    plain = _plain(docs)
    return langid.identify(plain, model).where("not rejected").select(plain.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = jaccard.jaccard_components(docs)
    gone = written(found.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    return join_checked(docs, gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.contained(docs, table(spark, sf_dir, "benchmark"))
    gone = written(found.select("doc_id").distinct(), "gone")
    return join_checked(docs, gone, "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    plain = _plain(docs)
    out = pii.pseudonymised(plain, PII_KEY)
    if "n_chars" in docs.columns:
        c = f"c{docs.columns.index('n_chars')}"
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(c, F.when(F.size("pii") > 0, F.length("text").cast(kind)).otherwise(F.col(c)))
    return out.select(plain.columns).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, tokens.vocabulary(tokens.BYTES))


STAGES = [("language_id", language_id), ("near_copies", near_copies), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packed)]

#: Language identification can't be expressed in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
