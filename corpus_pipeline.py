"""Five stages that turn the documents table into sampled token ids.

Each stage takes what the one before kept: reject documents of low quality, keep one document of each group
of near duplicates, remove passages that earlier documents have, take each source to its target share, and
encode. ``run`` applies them in order; each stage's result is written to the checkpoint folder before the
next one reads it. Each stage is judged on its own input:

- rows with a null id are documents of their own: no stage drops them as a copy, all may reject or mix them
- null, empty and blank texts have nothing to learn from, share or mix: they stay until the mixture, which
  takes no words of them
- of repeated rows of one id, and of several texts under one id, the near-duplicate stage keeps one row (the
  text with the smallest hash)
- very long texts go through whole; extra columns are carried along, whatever their names, up to the mixture
- an empty table gives an empty result with the same columns
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.llm import automata, dart, importance, mixing, pieces
from chronolith.llm.common import cut, release
from chronolith.llm.queries import source_weights


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What importance resampling keeps; everything if the labels don't tell good from bad."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance.classify(docs, labels, keep=docs.columns, only_kept=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and one row of each id that isn't null."""
    found = cut(dart.near_duplicates(docs))
    release(spark)
    dropped = found.where("NOT kept").select("doc_id").distinct()
    rest = docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
    again = cut(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    if not again.take(1):
        return rest
    one = rest.join(again.hint("shuffle_hash"), "doc_id", "left_semi").select(*docs.columns)
    one = one.groupBy(F.col("doc_id").alias("id")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("x")).select("x.*")
    return rest.join(again.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns).unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that a smaller id has too; a text left whole is unchanged."""
    # one column carries the others, so that no name of theirs meets one of the operator's
    carried = F.struct(*(F.col(c).alias(f"x{i}") for i, c in enumerate(docs.columns) if c != "text")).alias("carried")
    rest = automata.remove_repeats(docs.select("doc_id", "text", carried), keep=["carried"])
    own = {c: F.col(f"carried.x{i}") for i, c in enumerate(docs.columns) if c != "text"} | {"text": F.col("kept_text")}
    if "n_chars" in own:
        own["n_chars"] = F.length("kept_text").cast(dict(docs.dtypes)["n_chars"])
    return rest.select(*(own[c].alias(c) for c in docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target share of words: rows taken whole, twice, in part (leading words) or not at all."""
    return mixing.materialise(docs, F.array("source"), source_weights)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of two sampled segmentations of each row; other columns end here."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding", encode),
]

#: The stages train, search and sample: no SQL statement expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
