"""Documents to a training corpus: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the
shared folder and reads it again as the next one's docs. All stages but the last return the columns
of documents. Null texts count as empty; columns besides those of documents go with the first
stage. An empty table gives an empty one at each stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.llm import bpe, decontaminate, langid, pii, simhash
from dayledger.llm.common import without
from dayledger.session import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: documents whose language can't be told (null texts and texts without a letter).

    Learns from the rows that are not held out, as operator 9 does; where no row is labelled,
    every document would be undetermined, and those that have a letter stay.
    """
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model, into=("__lang", "__score"))
    known = F.col("__lang") != langid.UNDETERMINED
    return found.where(known | (F.lit(not model.langs) & F.col("text").rlike(r"\p{L}"))).select(
        *COLUMNS
    )


def _named(docs: DataFrame) -> DataFrame:
    """With the file and the place in it of each row; rows that are in no file are written first."""
    own = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        return docs.select(*COLUMNS, *own)
    except AnalysisException:
        return written(docs.select(*COLUMNS)).select(*COLUMNS, *own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest doc_id, if any has one.

    Of rows that share this doc_id, or of a group without any, the least in lang, source, n_chars
    and a hash of the text stays, and of rows equal in these the first of the first file.
    Rows are told apart by file and place, so a doc_id may be missing or in several groups.
    """
    named = _named(docs)
    hashed = named.withColumn("__hash", F.xxhash64("text"))
    carry = ("__file", "__row", "lang", "source", "n_chars", "__hash")
    found = written(simhash.groups(hashed, carry=carry))
    order = [F.col("doc_id").isNull().alias("none"), "doc_id", *carry[2:], *carry[:2]]
    first = found.groupBy("component").agg(
        F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    first = first.where(F.col("rows") > 1).select(
        "component", F.col("first.__file").alias("file"), F.col("first.__row").alias("row")
    )
    same = (F.col("__file") == F.col("file")) & (F.col("__row") == F.col("row"))
    gone = found.join(first, "component").where(~same).select("__file", "__row")
    return without(named, gone, ["__file", "__row"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: documents that hold a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    # Rows that share a doc_id, or have none, are told apart by their texts.
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    own = F.struct("doc_id", "__hash").alias("own")
    found = decontaminate.contaminated(hashed.select(own, "text"), benchmark, "own")
    gone = found.select("own.doc_id", "own.__hash")
    return without(hashed, gone, ["doc_id", "__hash"]).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts gives way to its kind in brackets."""
    found = pii.with_candidates(docs.select("text")).select("candidates")
    masked = pii.mask(docs, pii.fit(found))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and the bytes they decode to: the text again."""
    found = bpe.round_trip(docs, ids="token_ids")
    return found.select("doc_id", "token_ids", "n_tokens", "decoded_sha256")


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The machines, the classifier and the merges are not SQL; a test has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
