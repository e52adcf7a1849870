"""Record validation: first-failing-rule checks and accumulating checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.meta import judge_context, parse_curriculum
from ..functions.text import blank, col, content_hash, has_garbage, has_mixed_script, strip, text_issues
from ..session import checkpointed

ROLES = ("system", "user", "assistant")

# Reasons of rejection.
NO_MESSAGES = "schema: root object missing messages array"
TOO_FEW = "schema: messages needs at least 3 items"
WRONG_ROLES = "schema: first 3 roles must be [system, user, assistant]"
EMPTY_USER = "schema: empty user content"
EMPTY_ASSISTANT = "schema: empty assistant content"
GARBAGE = "garbled: currency/copyright noise"
MIXED = "garbled: mixed_script Bengali+Devanagari"
EXACT_COPY = "exact_dupe"
BAD_JSON = "schema: json_decode_error"

INTEGRITY_STAGE = "stage1_integrity"
MEANING_STAGE = "semantic_dupe"


def content(messages: Column | str, place: int) -> Column:
    return F.coalesce(F.get(col(messages), F.lit(place))["content"], F.lit(""))


def first_fault(messages: Column | str, load_issue: Column | None = None) -> Column:
    """The first rule a record breaks, null when it breaks none.

    ``load_issue`` is what the reader noted about the line, if anything.
    """
    m = col(messages)
    roles = [F.coalesce(F.get(m, F.lit(i))["role"], F.lit("")) for i in range(3)]
    wrong = reduce(Column.__or__, [got != want for got, want in zip(roles, ROLES)])
    user, assistant = content(m, 1), content(m, 2)
    fault = (
        F.when(F.coalesce(F.size(m), F.lit(0)) < 3, TOO_FEW)
        .when(wrong, WRONG_ROLES)
        .when(blank(user), EMPTY_USER)
        .when(blank(assistant), EMPTY_ASSISTANT)
        .when(has_garbage(user) | has_garbage(assistant), GARBAGE)
        .when(has_mixed_script(user) | has_mixed_script(assistant), MIXED)
    )
    return fault if load_issue is None else F.coalesce(load_issue, fault)


def check_records(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Rules one to seven: adds ``reason``, ``meta`` and, for passers, ``hash``."""
    noted = F.col("load_issue") if "load_issue" in df.columns else None
    checked = df.withColumn("reason", first_fault(messages, noted))
    past_schema = F.col("reason").isNull() | F.col("reason").startswith("garbled")
    user = F.when(F.col("reason").isNull(), content(messages, 1))
    return checked.withColumn("meta", F.when(past_schema, parse_curriculum(content(messages, 0)))).withColumn(
        "hash", content_hash(user))


def numbered(checked: DataFrame) -> DataFrame:
    """The checked rows with a unique ``_row``, written once, so the rules and hashes are worked out once however often the rows are read."""
    return checkpointed(checked.withColumn("_row", F.monotonically_increasing_id()), codec="zstd")


def mark_exact_copies(checked: DataFrame, id: str = "id") -> DataFrame:
    """Rule eight: of the passers with one hash only the first stays, by id and, where ids repeat, by row."""
    return mark_first_of_hash(numbered(checked), id)


def mark_first_of_hash(rows: DataFrame, id: str = "id") -> DataFrame:
    """``mark_exact_copies`` of rows that are written or kept already and carry a unique ``_row``.

    First rows come from a combined aggregate and return by a join on the row, so a hash shared by very many never
    meets in one task.
    """
    first = rows.filter("reason is null").groupBy("hash").agg(F.min(F.struct(id, "_row")).alias("_f")).select(
        F.col("_f._row").alias("_row"), F.lit(True).alias("_is_first"))
    marked = rows.join(first, "_row", "left")
    copy = F.col("reason").isNull() & F.col("_is_first").isNull()
    return marked.withColumn("reason", F.when(copy, EXACT_COPY).otherwise(F.col("reason"))).drop("_row", "_is_first")


def validate_records(df: DataFrame, id: str = "id", messages: str = "messages") -> DataFrame:
    """All structural rules; ``reason`` is null for the records that pass."""
    return mark_exact_copies(check_records(df, messages), id)


def passed(validated: DataFrame) -> DataFrame:
    return validated.filter("reason is null")


def quarantined(validated: DataFrame) -> DataFrame:
    """Rejection records: id, stage, reasons, warns, meta and messages."""
    return validated.filter("reason is not null").select(
        "id", F.lit(INTEGRITY_STAGE).alias("stage"), F.array("reason").alias("reasons"),
        F.array().cast("array<string>").alias("warns"), "meta", "messages")


def rejection_report(kept: DataFrame, rejected: DataFrame, top: int = 10) -> DataFrame:
    """Totals and pass rates of a run, one row, with the top quarantine reasons."""
    stage = F.col("stage")
    counts = rejected.select(stage).unionByName(kept.select(F.lit("clean").alias("stage"))).agg(
        F.count("*").alias("total"),
        F.count_if(stage != INTEGRITY_STAGE).alias("stage1_pass"),
        F.count_if(stage == INTEGRITY_STAGE).alias("stage1_quarantine"),
        F.count_if(stage == MEANING_STAGE).alias("semantic_dropped"),
        F.count_if(stage == "clean").alias("final_clean"),
        F.count_if(stage != "clean").alias("rejected_total"),
    )
    rate = lambda c: F.round(F.col(c) / F.greatest(F.lit(1), F.col("total")), 4)
    totals = counts.withColumn("stage1_pass_rate", rate("stage1_pass")).withColumn(
        "final_pass_rate", rate("final_clean")).withColumn("_one", F.lit(1))
    reasons = top_reasons(rejected, top).agg(
        F.lit(1).alias("_one"), F.sort_array(F.collect_list(F.struct("rank", "reason", "count"))).alias("top_reasons"))
    return totals.join(reasons, "_one", "left").drop("_one")


def top_reasons(rejected: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent quarantine reasons with rank, ties by first id."""
    from pyspark.sql import Window

    counts = (
        rejected.filter(F.col("stage") == INTEGRITY_STAGE)
        .select("id", F.explode("reasons").alias("reason"))
        .groupBy("reason").agg(F.count("*").alias("count"), F.min("id").alias("_first"))
        .orderBy(F.desc("count"), "_first").limit(k)
    )
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "_first"))
    return counts.withColumn("rank", rank).select("rank", "reason", "count")


def partition_check(kept: DataFrame, rejected: DataFrame, total: DataFrame) -> DataFrame:
    """Kept plus rejected must be all: counts and verdict in one row."""
    sides = (
        kept.select(F.lit("clean").alias("side"))
        .unionByName(rejected.select(F.lit("rejected").alias("side")))
        .unionByName(total.select(F.lit("total").alias("side")))
    )
    counts = sides.agg(*[F.count_if(F.col("side") == s).alias(s) for s in ("clean", "rejected", "total")])
    return counts.withColumn("holds", F.col("clean") + F.col("rejected") == F.col("total"))


# ---- accumulating checks ----------------------------------------------------

def _last_content(messages: Column, role: str) -> Column:
    of_role = F.filter(messages, lambda m: (m["role"] == role) & m["content"].isNotNull())
    return F.coalesce(F.try_element_at(of_role, F.lit(-1))["content"], F.lit(""))


def parse_rows(df: DataFrame, id: str = "row_id", messages: str = "messages") -> DataFrame:
    """Context, question and answer of each record with every issue found.

    The last message of a role counts. Issues of the reader (``load_issue``)
    stand alone; others are ``"; "``-joined in fixed order.
    """
    noted = F.col("load_issue") if "load_issue" in df.columns else F.lit(None).cast("string")
    m = F.coalesce(F.col(messages), F.array().cast(df.schema[messages].dataType))
    base = df.select(
        F.col(id),
        noted.alias("_noted"),
        F.col(messages).isNull().alias("_absent"),
        _last_content(m, "system").alias("_system"),
        strip(_last_content(m, "user")).alias("question"),
        strip(_last_content(m, "assistant")).alias("answer"),
    ).withColumn("context", judge_context("_system"))
    issues = F.array_join(F.array(
        F.when(F.col("_system") == "", "missing system message")
        .when(F.col("context") == "", "metadata missing or could not be extracted"),
        F.when(F.col("question") == "", "missing user question"),
        F.when(F.col("answer") == "", "missing assistant answer"),
    ), "; ")
    unusable = F.coalesce(F.col("_noted"), F.when(F.col("_absent"), "messages is missing or not a list"))
    return base.select(
        id, "context", "question", "answer",
        F.coalesce(unusable, issues).alias("schema_issues"),
        F.when(unusable.isNotNull(), "").otherwise(text_issues("answer")).alias("text_quality_issues"),
    ).withColumn("schema_valid", F.col("schema_issues") == "")


# ---- file contracts ---------------------------------------------------------

def repeated_ids(df: DataFrame, id: str) -> DataFrame:
    return df.groupBy(id).agg(F.count("*").alias("count")).filter("count > 1")


def generation_check(df: DataFrame, id: str = "id", generation: str = "generation") -> DataFrame:
    """Lines, unique ids and empty generations of an output file."""
    return df.agg(
        F.count("*").alias("lines"),
        F.count_distinct(id).alias("unique_ids"),
        F.count_if(blank(generation)).alias("empty_generations"),
    )


def contract_violations(df: DataFrame, required: list[str], id: str = "id", generation: str = "generation") -> DataFrame:
    """Missing keys, empty generations and surplus ids, one row."""
    absent = [c for c in required if c not in df.columns]
    null_key = reduce(Column.__or__, [F.col(c).isNull() for c in required if c in df.columns], F.lit(bool(absent)))
    empty = blank(generation) if generation in df.columns else F.lit(True)
    return df.agg(
        F.count_if(null_key).alias("missing_keys"),
        F.count_if(empty).alias("empty_generations"),
        (F.count(id) - F.count_distinct(id)).alias("duplicate_ids"),
    )


def require(df: DataFrame, violations: DataFrame, message: str) -> DataFrame:
    """``df`` unchanged, or a failed job when any violation count is above zero."""
    worst = reduce(Column.__add__, [F.col(c) for c in violations.columns])
    guard = violations.select(
        F.when(worst > 0, F.raise_error(F.lit(message))).otherwise(F.lit(1)).cast("int").alias("_ok"))
    return df.withColumn("_ok", F.lit(1)).join(F.broadcast(guard), "_ok").drop("_ok")
