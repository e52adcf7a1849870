"""Writers: JSON Lines, CSV reports, nested summaries and resumable results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions.text import drop_control


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines in UTF-8, one part file per partition."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; quotes are doubled, line breaks in values stay."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_summary(sections: dict[str, DataFrame], path: str) -> None:
    """One nested JSON row; each section is a report frame of a few rows, bounded by the report's own form."""
    whole = None
    for name, df in sections.items():
        rows = df.agg(F.collect_list(F.struct(*df.columns)).alias(name)).withColumn("_one", F.lit(1))
        whole = rows if whole is None else whole.join(rows, "_one")
    whole.drop("_one").coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """Sections of any length as JSON Lines, a folder each, so none passes one task or the driver."""
    for name, df in sections.items():
        write_jsonl(df, f"{path}/{name}")


def read_section(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A section that ``write_sections`` wrote."""
    return spark.read.schema(schema).json(f"{path}/{name}")


def write_sorted_jsonl(df: DataFrame, path: str, *keys: str) -> None:
    """JSON Lines whose part files follow each other in the order of the keys."""
    write_jsonl(df.orderBy(*keys), path)


def without_control(df: DataFrame) -> DataFrame:
    """Control characters removed from every string column."""
    return df.select(*[
        drop_control(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields])


def done_ids(spark: SparkSession, path: str, id: str) -> DataFrame | None:
    """Ids in an earlier run's output, or None before the first run."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).select(id)
    except AnalysisException:
        return None


def pending(df: DataFrame, done: DataFrame | None, id: str) -> DataFrame:
    """Rows whose id has no result yet."""
    return df if done is None else df.join(done.select(id), id, "left_anti")


def append_results(df: DataFrame, path: str) -> None:
    """Add a run's results; a later run reads their ids and skips them."""
    df.write.mode("append").parquet(path)
