"""Structural validation, then keep-first removal of near copies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import neardup, validate
from ..session import checkpointed
from ..sources.writers import write_jsonl, write_sorted_jsonl


@dataclass
class Cleaned:
    clean: DataFrame
    quarantine: DataFrame
    near_copies: DataFrame
    rejected: DataFrame
    report: DataFrame

    def write(self, folder: str) -> None:
        write_jsonl(self.clean.select("messages"), f"{folder}/clean")
        write_jsonl(self.quarantine, f"{folder}/quarantine")
        write_jsonl(self.near_copies, f"{folder}/near_copies")
        write_sorted_jsonl(self.rejected, f"{folder}/rejected", "id")
        write_jsonl(self.report.coalesce(1), f"{folder}/report")


def clean_corpus(records: DataFrame, vectors: DataFrame | None = None, threshold: float = 0.88) -> Cleaned:
    """Clean records (id, messages and, from a reader, load_issue).

    Near copies are looked for inside subject and class, by the cosine of
    ``vectors`` (id, vector: unit vectors of user and assistant text) or, without
    any, by the Jaccard of token sets.
    """
    checked = validate.numbered(validate.check_records(records))
    marked = validate.mark_first_of_hash(checked.select("id", "_row", F.col("_row").alias("_at"), "reason", "hash"))
    blocks = [
        F.coalesce("meta.subject_norm", F.lit("?")).alias("_subject"), F.coalesce("meta.class", F.lit("?")).alias("_class")]
    keys, past_rules = ["_subject", "_class"], checked.filter("reason is null")
    if vectors is None:
        # the texts stay where they lie, only their sets are sent
        tokens = neardup.token_set(neardup.pair_text(validate.content("messages", 1), validate.content("messages", 2)))
        sets = validate.mark_first_of_hash(past_rules.select("id", "_row", "reason", "hash", *blocks, tokens.alias("_set")))
        verdicts = neardup.dedup_by_sets(validate.passed(sets), "id", "_set", keys, threshold)
    else:
        good = validate.passed(validate.mark_first_of_hash(past_rules.select("id", "_row", "reason", "hash", *blocks)))
        verdicts = neardup.dedup_by_vector(good.join(vectors, "id"), "id", "vector", keys, threshold)
    settled = validate.passed(marked).join(verdicts, "id", "left").withColumn("kept", F.coalesce(F.col("kept"), F.lit(True)))
    settled = checkpointed(settled.unionByName(marked.filter("reason is not null"), allowMissingColumns=True).select(
        F.col("_at").alias("_row"), "reason", "kept", "vs", "sim"))
    others = [c for c in checked.columns if c not in ("id", "reason", "_row")]
    judged = checked.drop("reason").join(settled, "_row")
    quarantine = validate.quarantined(judged)
    clean = judged.filter("reason is null and kept").select("id", *others)
    copies = judged.filter("reason is null and not kept").select(
        "id", F.lit(validate.MEANING_STAGE).alias("stage"), F.array(neardup.reason(F.col("vs"), F.col("sim"))).alias("reasons"),
        F.array().cast("array<string>").alias("warns"), "meta", "messages")
    rejected = quarantine.unionByName(copies)
    return Cleaned(clean, quarantine, copies, rejected, validate.rejection_report(clean, rejected))
