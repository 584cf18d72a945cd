"""Training-data pipeline over ``documents``: five stages, each working on what the one before kept.

1. quality: documents that the classifier rejects (score under 0.7) go.
2. near duplicates: of each class of linked documents the one with the least id stays.
3. benchmark: documents that hold a benchmark window go.
4. secrets: spans of secrets are masked in the texts, and n_chars follows.
5. byte-level BPE: token ids of every document, and the digest of the text they decode to.

Every stage gives all columns of ``documents`` but the last, which gives ids, tokens and
digests. A session with
stages written between them reads each stage's own Parquet; ``run`` stages through the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import bpe, decontaminate, jaccard, quality, secrets
from vellum.llm.common import staged, table

#: The stages train a model and encode with a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = quality.score(docs.withColumnRenamed("score", "_score"), model, keep=True).filter(F.col("score") >= quality.GOOD)
    return kept.drop("score").withColumnRenamed("_score", "score")


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs, path, keep=["lang", "source"])
    decoded = bpe.decode(encoded, path, keep=("lang", "source"))
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        "token_ids",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", no_near_duplicates),
    ("benchmark", no_benchmark),
    ("secrets", no_secrets),
    ("tokens", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
