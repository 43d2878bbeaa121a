"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import automata, dart, descent, importance, licences, mixing, oracles, pieces, quality_rules, recurrent, toxicity
from .common import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_weights(names: list) -> list[float]:
    """Weights 3, 1, 2, repeating, for sources in code point order, null last."""
    return [(3.0, 1.0, 2.0)[i % 3] for i in range(len(names))]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), F.array("source"), source_weights)
    own = F.col("sources")[0]
    return mixed.select("doc_id", "size", own["source_size"].alias("source_size"), own["target"].alias("target"), "taken")


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descent.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), train_on=~held_out)
    out = toxicity.score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "lang_threshold", "toxic")


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(_table(spark, sf_dir, "documents"))
    return out.withColumns({f"digest_{i}": F.when(F.col(f"ids_{i}").isNotNull(), F.xxhash64(f"ids_{i}")) for i in (1, 2)})


def op6_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    out = recurrent.score(_table(spark, sf_dir, "documents"), train_on=~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automata.remove_repeats(_table(spark, sf_dir, "documents"), digest=True)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.recognise(_table(spark, sf_dir, "documents"))


def op10_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_nn_descent": op2_nn_descent,
    "op3_toxicity": op3_toxicity,
    "op4_dart_minhash": op4_dart_minhash,
    "op5_sampled_pieces": op5_sampled_pieces,
    "op6_recurrent_lm": op6_recurrent_lm,
    "op7_importance": op7_importance,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_licences": op9_licences,
    "op10_divergence": op10_divergence,
}

ORACLE = oracles.ORACLE
