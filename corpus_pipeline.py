"""From raw documents to packed sequences: quality, language, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.llm import language, quality
from feedjobs.llm.mixing import WORD, mix
from feedjobs.llm.near_dup import keep_one, near_duplicates
from feedjobs.llm.packing import pack
from feedjobs.llm.queries import tokenizer_path
from feedjobs.llm.shared import drop, step, written

#: A text of which no language knows this share of n-grams is in none of the learned languages.
LEAST_LANGUAGE = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking predicts as good.

    Null and empty texts have no features and are judged by that; repeated rows are judged alike. Without labels of both kinds all stay. Very long texts are read whole.
    """
    ranking = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, ranking, keep=docs.columns, out="_quality_score")
    return scored.where(F.col("_quality_score") >= quality.THRESHOLD).select(docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learned from the corpus.

    Null texts and texts without letters go; repeated rows are judged alike. Where no row has a lang, no language is learned and all rows go.
    """
    found = language.predict(docs, language.learn(docs), keep=docs.columns, out=("_language", "_language_score"))
    return found.where((F.col("_language") != "und") & (F.col("_language_score") >= LEAST_LANGUAGE)).select(docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates.

    Rows are told apart by text: those without an id, or with a shared one, are classed by their own texts. Null texts stay, one an id; texts without words are one class.
    """
    return keep_one(docs, near_duplicates(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a source's last one is cut to the words that are taken.

    A source whose target is below its size gives part of its documents: that is the mix. Each source gives its target's whole part of words exactly.
    Rows that agree in all columns are one document that the mix takes as often as all of them. A cut text is its words, joined by blanks. Null and
    wordless texts are never taken; a null source is one source.
    """
    row = F.xxhash64(*docs.columns)
    plan = mix(docs.select("doc_id", "source", "text", row.alias("_mix_row")), extra=["_mix_row"]).where("size > 0")
    keys = [F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"), F.col("_mix_row").alias("_mix_is")]
    plan = plan.groupBy(*keys).agg(F.sum("taken").alias("_mix_taken"), F.count(F.lit(1)).alias("_mix_rows")).where("_mix_taken > 0")
    same = (F.col("_mix_row") == F.col("_mix_is")) & F.col("doc_id").eqNullSafe(F.col("_mix_id")) & F.col("source").eqNullSafe(F.col("_mix_source"))
    met = docs.withColumn("_mix_row", row).join(plan, same)
    once = met.where("_mix_rows = 1").unionByName(met.where("_mix_rows > 1").dropDuplicates(["_mix_is", "doc_id", "source"]))
    copies = F.ceil(F.col("_mix_taken") / F.col("_mix_size"))
    rows = once.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    left = F.col("_mix_taken") - (F.col("_mix_copy") - 1) * F.col("_mix_size")
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), 1, F.greatest(left, F.lit(1)).cast("int")), " ")
    cut = left < F.col("_mix_size")
    rows = rows.withColumn("text", F.when(cut, part).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids, one row a piece. Null and empty texts are one end mark; repeated rows are packed as often as they stand."""
    return pack(docs, tokenizer_path(), window=2048, end_id=1)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_dup", near_dup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: The stages learn models and read a vocabulary, which SQL can't express; tests hold each stage against a brute-force form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again as the next one's input, and what it no longer needs is deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with step(spark) as paths:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
            made = paths.pop()
        if before:
            drop(spark, before)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
