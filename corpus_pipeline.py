"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, personal data, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``:

1. ``quality``: documents that the classifier scores below 0.3 go.
2. ``near_duplicates``: of each group linked by a similarity of 0.8 or more
   (five-word shingles) the document with the smallest id stays.
3. ``decontamination``: documents in which a benchmark window occurs go.
4. ``private_data``: personal data is masked in the text.
5. ``sentencepiece``: the text is encoded, and decoded again from its ids.

Cases: the operators' own (see their modules).  Rows without an id, and rows
that repeat one, are judged, kept, masked and encoded each by itself.  An empty
table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import decontamination, near_duplicates, private_data, quality, unigram
from clinlake.llm.common import cut, table
from clinlake.llm.queries import tokenizer_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels")))
    return quality.good_documents(docs, model, threshold=0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.first_copies(docs, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private_data.redact(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = unigram.Model.load(tokenizer_file("piece_bpe_32k.model"))
    return unigram.round_trip(docs, model, every=True).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "text")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("private_data", private_data_stage),
    ("sentencepiece", sentencepiece_stage),
]

# The classifier, the graph of contexts and the encoding are not expressible in SQL; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
