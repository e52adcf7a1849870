"""A tuning set from raw rows: split by template, identity rows, general data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.text import render_chat
from ..operators import split
from ..operators.ordering import shuffled
from ..sources.writers import write_jsonl
from .report import card_text


@dataclass
class TuningSet:
    train: DataFrame
    held_out: DataFrame
    card: DataFrame
    text_card: str

    def write(self, folder: str) -> None:
        write_jsonl(self.train, f"{folder}/train")
        write_jsonl(self.held_out, f"{folder}/eval")
        self.card.sparkSession.createDataFrame([(self.text_card,)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{folder}/data_card")


def build_tuning_set(
    rows: DataFrame, id: str = "id", identity: Sequence[tuple[str, str]] = (), system: str = "", train_cap: int = 4, eval_cap: int = 3,
    eval_share: float = 0.15, numeral_mode: str = "bengali", seed: int = 42,
) -> TuningSet:
    """Split, add the caller's identity rows to training, shuffle, prove the split."""
    records = split.template_split(rows, id, "text", train_cap, eval_cap, eval_share, numeral_mode, system, seed)
    key = F.concat(F.lit("row-"), F.col(id).cast("string")).alias("_key")
    keep = ["side", "messages", "band", "subject", "topic"]
    records = records.select(key, *keep)
    if identity:
        fixed = split.identity_rows(rows.sparkSession, identity, system)
        # Repeats of an identity row share a key: equal rows may come in any order.
        named = F.concat(F.lit("identity-"), F.md5(F.to_json("messages"))).alias("_key")
        records = records.unionByName(fixed.select(named, *keep))
    card = split.data_card(records, split.template_sides(rows, "text", eval_share, seed))
    ordered = shuffled(records, seed, "_key").drop("_key")
    return TuningSet(
        ordered.filter("side = 'train'").drop("side"), ordered.filter("side = 'eval'").drop("side"), card,
        card_text(card, numeral_mode, train_cap))


def training_texts(records: DataFrame, turn: str | None = None) -> DataFrame:
    """One training string per record; ``turn`` is the chat template."""
    rendered = render_chat("messages") if turn is None else render_chat("messages", turn)
    return records.select(rendered.alias("text"))
