"""Train and evaluation sets that share no question template, and mixing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import QUESTION_LABEL, numerals, split_answer, split_question, template
from .ordering import hash_key, mark_first


def chat(system: str, question: Column, answer: Column) -> Column:
    """A three-message record."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(system)), message("user", question), message("assistant", answer))


def template_split(
    rows: DataFrame, id: str = "id", text: str = "text", train_cap: int = 4, eval_cap: int = 3,
    eval_share: float = 0.15, numeral_mode: str = "bengali", system: str = "", seed: int = 42,
) -> DataFrame:
    """Chat records with ``side`` train or eval; whole templates are held out.

    Rows of a template are capped before anything is joined: Spark limits each
    template ahead of the shuffle, so one that holds a third of all rows sends
    no more than any other.
    """
    known = rows.withColumn("template", F.coalesce(template(text), F.lit("")))
    rank = F.row_number().over(Window.partitionBy("template").orderBy(hash_key(seed, id), id))
    capped = known.withColumn("_rank", rank).filter(F.col("_rank") <= max(train_cap, eval_cap))
    held = mark_first(
        known.select("template").distinct(), seed, "template",
        lambda total: F.greatest(F.lit(1), F.floor(total * F.lit(eval_share))), "_held")
    sided = capped.join(held, "template").withColumn("side", F.when(F.col("_held"), "eval").otherwise("train"))
    cap = F.when(F.col("_held"), eval_cap).otherwise(train_cap)
    uniform = numerals(text, numeral_mode)
    return sided.filter(F.col("_rank") <= cap).select(
        id, "side", "template", chat(system, split_question(uniform), split_answer(uniform)).alias("messages"),
        *[c for c in ("band", "subject", "topic") if c in rows.columns])


def template_sides(rows: DataFrame, text: str = "text", eval_share: float = 0.15, seed: int = 42) -> DataFrame:
    """Each template with its number of rows and its side."""
    counts = rows.select(template(text).alias("template")).groupBy("template").agg(F.count("*").alias("rows"))
    held = mark_first(
        counts, seed, "template", lambda total: F.greatest(F.lit(1), F.floor(total * F.lit(eval_share))), "_held")
    return held.select("template", "rows", F.when(F.col("_held"), "eval").otherwise("train").alias("side"))


def identity_rows(
    spark: SparkSession, pairs: Sequence[tuple[str, str]], system: str = "", repeats: int = 3,
) -> DataFrame:
    """Fixed question-answer pairs, repeated, marked as such. The texts belong to
    the caller; they go into the training side only."""
    given = spark.createDataFrame(list(pairs), "question string, answer string")
    return given.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).select(
        F.lit("train").alias("side"), chat(system, F.col("question"), F.col("answer")).alias("messages"),
        F.lit("meta").alias("band"), F.lit("identity").alias("subject"), F.lit("persona").alias("topic"))


def record_template(messages: Column) -> Column:
    """Template of a finished record, whose question lost its label."""
    return template(F.concat(F.lit(f"{QUESTION_LABEL}: "), F.get(messages, F.lit(1))["content"]))


def overlap(records: DataFrame) -> DataFrame:
    """Templates on both sides; identity rows do not count. Must be none."""
    marked = records.filter(F.coalesce(F.col("subject"), F.lit("")) != "identity").select(
        record_template(F.col("messages")).alias("template"), "side")
    train, held = (marked.filter(F.col("side") == side).select("template") for side in ("train", "eval"))
    return train.intersect(held)


def data_card(records: DataFrame, sides: DataFrame) -> DataFrame:
    """Row, template and overlap counts of a split, one row."""
    def one(df: DataFrame) -> DataFrame:
        return df.withColumn("_one", F.lit(1))

    rows = records.agg(
        F.count_if(F.col("side") == "train").alias("train_rows"),
        F.count_if(F.col("subject") == "identity").alias("identity_rows"),
        F.count_if(F.col("side") == "eval").alias("eval_rows"))
    templates = sides.agg(
        F.count("*").alias("templates"),
        F.count_if(F.col("side") == "train").alias("train_templates"),
        F.count_if(F.col("side") == "eval").alias("eval_templates"))
    shared = overlap(records).agg(F.count("*").alias("template_overlap"))
    return one(rows).join(one(templates), "_one").join(one(shared), "_one").drop("_one")


# ---- mixing and halving -----------------------------------------------------

def mix_general(sft: DataFrame, general: DataFrame, id: str, share: float = 0.25, seed: int = 42) -> DataFrame:
    """All records with as many general ones as bring their part to ``share``,
    taken in hash order, or all there are; ``general`` tells the origin."""
    size = sft.agg(F.count("*").alias("_sft"))
    wanted = F.bround(F.col("_sft") * F.lit(share / (1 - share)))
    taken = mark_first(general, seed, id, lambda total: F.least(total, wanted.cast("long")), "_taken", size)
    return sft.withColumn("general", F.lit(False)).unionByName(
        taken.filter("_taken").drop("_taken").withColumn("general", F.lit(True)), allowMissingColumns=True)


def mix_report(mixed: DataFrame, share: float = 0.25) -> DataFrame:
    """Counts, the share reached and whether general records ran short."""
    counts = mixed.agg(F.count_if(~F.col("general")).alias("sft"), F.count_if("general").alias("general_used"))
    return counts.select(
        "sft", "general_used", (F.col("sft") + F.col("general_used")).alias("total"),
        (F.col("general_used") / F.greatest(F.lit(1), F.col("sft") + F.col("general_used"))).alias("share"),
        (F.col("general_used") < F.bround(F.col("sft") * F.lit(share / (1 - share)))).alias("short"))


def share_split(df: DataFrame, id: str, test_share: float = 0.5, seed: int = 3407) -> DataFrame:
    """Random row split of exact size in hash order; the test side rounds up."""
    marked = mark_first(df, seed, id, lambda total: F.ceil(total * F.lit(test_share)), "_test")
    return marked.withColumn("side", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")
