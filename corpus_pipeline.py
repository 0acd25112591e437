"""A training corpus from ``documents``: five stages, each one operator of ``tallyframe.llm`` at work on
all that the stage before kept.

1. quality: documents that the classifier, learnt from ``labels``, rejects go.
2. near_duplicates: one document of each group of near copies stays (five words, similarity 0.8).
3. secrets: reported secrets are masked in the texts.
4. mixing: sources are brought to their target shares; documents are dropped or repeated for it.
5. pieces: texts become SentencePiece ids, which decode to them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm.common import read
from tallyframe.llm.mixing import mix
from tallyframe.llm.near_dedup import without_near_duplicates
from tallyframe.llm.piece_transducer import encode_pieces
from tallyframe.llm.quality import accepted
from tallyframe.llm.queries import tokenizer_path
from tallyframe.llm.secret_scan import redacted
from tallyframe.workers import remove_folder, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_pieces(docs, tokenizer_path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"), check=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("pieces", pieces)]

#: Hinge-loss fitting, MinHash and merging pairs have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``. What each keeps is written as Parquet in the shared folder of
    ``spark.checkpoint.dir`` and read as the next one's input."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:  # nothing reads it any more
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return docs
