"""Documents to clean training text: five stages, each on all that its predecessor kept.

A stage is a function of (spark, documents, folder of tables); its result is written and
read again as the next one's documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import bpe, decontam, line_dedup, quality
from starflow.llm.common import Scratch, column, free_name
from starflow.llm.near_dup import near_duplicates
from starflow.llm.queries import read, tokenizer

#: Documents with a lower score go.
GOOD = 0.7
#: Documents that share so many hundredths of their shingles are near duplicates (op8's own query asks for 85).
NEAR = 80
#: Words that the encoder keeps between batches, and bytes of text it holds: few, as the workers
#: of other stages hold memory too.
WORDS, SIZE = 100_000, 1 << 20


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, fitted on the labels, does not reject."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return quality.scored(docs, model).where(F.col(score) >= GOOD).drop(score)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stood earlier; documents of which nothing is left go."""
    lines, removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    out = line_dedup.without_repeats(docs, grow=True)
    left = (F.col(removed) == 0) | F.col("text").rlike(r"\S")
    return out.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*map(column, docs.columns))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    gone = near_duplicates(docs, percent=NEAR).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*map(column, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    name = free_name(docs, "matches")
    found = decontam.with_matches(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size(name) == 0).drop(name)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document, and whether they read back as its text."""
    path = tokenizer("byte_bpe_50k.json")
    ids, back = free_name(docs, "ids"), free_name(docs, "decoded")
    out = bpe.round_trip(docs, path, ids=ids, decoded=back, words=WORDS, size=SIZE)
    same = F.coalesce("text", F.lit("")) == F.col(back)
    return out.withColumn("n_tokens", F.size(ids).cast("long")).withColumn("round_trip", same).drop(back)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("minhash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("bpe encoding and decoding", bpe_encoding),
]

#: A fitted classifier is beyond SQL; ``tests/llm`` holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents to tokens."""
    scratch, docs = Scratch(spark), read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
