"""Judging runs: parse, score what is pending, merge and report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import requests, stats, verdicts
from ..operators.dedup import keep_last
from ..operators.validate import parse_rows
from ..sources.writers import append_results, done_ids, pending


@dataclass
class Judged:
    report: DataFrame
    scores: DataFrame
    counts: DataFrame


def judge_records(records: DataFrame, scorer: Callable, results_path: str, run: int = 0, row_id: str = "row_id") -> Judged:
    """Five-dimension judging of records (row_id, messages).

    Results are appended to ``results_path``; a later call with a higher ``run``
    scores only rows without a result. The last result of a row counts.
    """
    spark = records.sparkSession
    parsed = parse_rows(records, row_id)
    waiting = pending(parsed, done_ids(spark, results_path, row_id), row_id)
    scored = requests.score_batches(
        waiting.filter("schema_valid").select(row_id, "context", "question", "answer", "text_quality_issues"), scorer, row_id, verdicts.FIVE,
        check=requests.clamped_scores)
    fresh = verdicts.with_verdict(scored).unionByName(verdicts.schema_failed(waiting))
    append_results(fresh.withColumn("run", F.lit(run)), results_path)
    results = keep_last(spark.read.parquet(results_path), row_id, "run").drop("run")
    report = verdicts.final_report(parsed, results)
    return Judged(report, stats.describe_scores(report, [*verdicts.FIVE, "overall_score"]), verdicts.pass_counts(report))


def judge_generations(rows: DataFrame, scorer: Callable, results_path: str) -> DataFrame:
    """Six-dimension judging, one row per request; truncated rows cost none. A
    row that got no valid reply stays pending for the next run.

    Returns the row of rule violations over all results so far."""
    spark = rows.sparkSession
    waiting = pending(rows, done_ids(spark, results_path, "id"), "id")
    auto = verdicts.auto_marked(waiting)
    asked = requests.single_prompts(verdicts.to_judge(waiting))
    scored = requests.score_batches(asked, scorer, "id", verdicts.SIX, rows=1, check=requests.whole_scores)
    scored = scored.filter(reduce(Column.__and__, [F.col(d).isNotNull() for d in verdicts.SIX]))
    judged = scored.withColumn("final_score", verdicts.final_score(verdicts.SIX)).withColumn("judged", F.lit("llm"))
    about = rows.select("id", "subject", "grade", "district", "topic", "context")
    append_results(about.join(judged.unionByName(auto), "id"), results_path)
    return verdicts.verdict_check(spark.read.parquet(results_path))
