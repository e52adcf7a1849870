"""JSON Lines and JSON readers for chat records and flat records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.text import blank, strict_json
from ..operators.validate import BAD_JSON, NO_MESSAGES, TOO_FEW, contract_violations, require

MESSAGE = StructType([StructField("role", StringType()), StructField("content", StringType())])
RECORD = StructType([
    StructField("messages", ArrayType(MESSAGE)),
    StructField("band", StringType()),
    StructField("subject", StringType()),
    StructField("topic", StringType()),
])

#: File blocks whose offsets are sent to every executor; beyond that lines are joined to them by shuffle.
MOST_BLOCKS = 100_000

# Keys that a generation file must hold.
GENERATION_KEYS = [
    "id", "subject", "grade", "district", "topic", "context", "question", "reference_answer", "generation"]


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files with their physical number from zero, blank ones counted.

    A row knows its file block and its place in the task's sequence; adding the
    sizes of the blocks before gives the number. Only one row per file block is
    ever ordered.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
    )
    blocks = lines.groupBy("_file", "_start").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_start", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    few = offsets.limit(MOST_BLOCKS + 1).count() <= MOST_BLOCKS
    return lines.join(F.broadcast(offsets) if few else offsets, ["_file", "_start"]).select(
        (F.col("_before") + F.col("_place") - F.col("_first")).alias("id"), "value")


def parse_chat_lines(lines: DataFrame, schema: StructType = RECORD) -> DataFrame:
    """Parse ``value`` of non-blank lines: the record's columns and ``fault``.

    ``fault`` is ``bad_json``, ``not_object``, ``no_messages``,
    ``messages_not_list`` or null. Every line must be one JSON value with nothing
    after it; a faulty line has null columns.
    """
    tree = F.col("_tree")
    parsed = lines.filter(~blank("value")).withColumn("_tree", strict_json("value"))
    parsed = parsed.withColumn("_record", F.when(tree.isNotNull(), F.from_json("value", schema)))
    fault = (
        F.when(tree.isNull(), "bad_json")
        .when(F.col("_record.messages").isNotNull(), F.lit(None))
        .when(~F.schema_of_variant(tree).startswith("OBJECT"), "not_object")
        .when(F.try_variant_get(tree, "$.messages", "variant").isNull(), "no_messages")
        .otherwise("messages_not_list")
    )
    return parsed.select(
        *[c for c in lines.columns if c != "value"],
        *[F.col(f"_record.{f.name}").alias(f.name) for f in schema.fields],
        fault.alias("fault"),
    )


def integrity_issue(fault: Column | str = "fault") -> Column:
    """Reader faults in the words of the first-failing-rule check."""
    fault = F.col(fault) if isinstance(fault, str) else fault
    return (
        F.when(fault == "bad_json", BAD_JSON)
        .when(fault.isin("not_object", "no_messages"), NO_MESSAGES)
        .when(fault == "messages_not_list", TOO_FEW)
    )


def row_issue(fault: Column | str = "fault", id: str = "id") -> Column:
    """Reader faults in the words of the accumulating check."""
    fault = F.col(fault) if isinstance(fault, str) else fault
    return (
        F.when(fault == "bad_json", F.concat(F.lit("Invalid JSONL at line "), F.col(id) + 1))
        .when(fault == "not_object", "row is not a JSON object")
        .when(fault.isNotNull(), "messages is missing or not a list")
    )


def read_chat_jsonl(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Records with at least three messages; other lines are left out."""
    parsed = parse_chat_lines(numbered_lines(spark, path))
    return parsed.filter(F.size("messages") >= 3).drop("fault")


def read_jsonl_quarantine(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All non-blank lines; ``load_issue`` feeds the structural rules."""
    parsed = parse_chat_lines(numbered_lines(spark, path))
    return parsed.withColumn("load_issue", integrity_issue()).drop("fault")


def read_jsonl_with_error_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All non-blank lines by ``row_id``, their position among the non-blank
    ones; ``load_issue`` feeds the accumulating check."""
    from ..operators.ordering import with_position

    parsed = parse_chat_lines(numbered_lines(spark, path))
    return with_position(parsed.withColumn("load_issue", row_issue()), "id", "row_id").drop("fault", "id")


def read_json(spark: SparkSession, path: str, schema: StructType = RECORD) -> DataFrame:
    """A ``.json`` file holding a list or one object, or a ``.jsonl`` file; a
    malformed one fails the job."""
    if path.lower().endswith(".jsonl"):
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    if path.lower().endswith(".json"):
        return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
    raise ValueError(f"neither .json nor .jsonl: {path}")


def read_flat_jsonl(spark: SparkSession, paths: Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """Flat records pooled from several files; a malformed line fails the job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(list(paths), mode="FAILFAST")


def read_generations(spark: SparkSession, path: str) -> DataFrame:
    """Generations for judging. Bad JSON, a missing key, an empty generation or a
    repeated id fails the job."""
    fields = [StructField(k, StringType()) for k in [*GENERATION_KEYS, "finish_reason"]]
    schema = StructType([*fields, StructField("truncated", StringType())])
    rows = spark.read.schema(schema).json(path, mode="FAILFAST").withColumn(
        "truncated", F.coalesce(F.col("truncated") == "true", F.lit(False)))
    broken = contract_violations(rows, GENERATION_KEYS)
    return require(rows, broken, "generation file: missing keys, empty generations or repeated ids")


def assemble_chats(turns: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """Chat records from a table of turns; a record is one row, as in the files."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn), F.col(role), F.col(text))))
    messages = F.transform(ordered, lambda m: F.struct(m[role].alias("role"), m[text].alias("content")))
    return turns.groupBy(F.col(id).alias("id")).agg(messages.alias("messages"))
