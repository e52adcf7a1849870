"""Short texts rendered on the driver from bounded report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

MOST_LINES = 500


def table_markdown(df: DataFrame, places: int = 3) -> str:
    """A markdown table of a report frame; a long one shows its first rows and says so, the whole is in the written sections."""
    rows = df.limit(MOST_LINES + 1).collect()
    more = len(rows) > MOST_LINES

    def cell(v) -> str:
        return "-" if v is None else f"{v:.{places}f}" if isinstance(v, float) else str(v)

    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    shown = ["| " + " | ".join(map(cell, r)) + " |" for r in rows[:MOST_LINES]]
    return "\n".join([*lines, *shown, *(["", f"The first {MOST_LINES} rows."] if more else [])])


def audit_markdown(audit) -> str:
    """The audit as a readable report."""
    overall = audit.overall.first()
    views = audit.views.select("view", "count", "score", "sim_mean", "jaccard_mean", "distinct_2", "duplicate_rate").orderBy("view")
    parts = [
        "# Diversity audit", f"{overall['rows']} rows, mean score of the views {overall['score']:.1f} of 100.",
        "## Views", table_markdown(views),
        "## Entropies", table_markdown(audit.entropies),
        "## Chapter coverage", table_markdown(audit.coverage),
        "## Rows of each subject in each class", table_markdown(audit.matrix),
        "## By subject", table_markdown(audit.by_subject.orderBy("subject")),
        "## By class", table_markdown(audit.by_class.orderBy("class")),
    ]
    return "\n\n".join(parts) + "\n"


def write_markdown(text: str, path: str, spark) -> None:
    """A rendered report as one text file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def card_text(card: DataFrame, numeral_mode: str, cap: int) -> str:
    """The data card of a split as text."""
    row = card.first().asDict()
    facts = {**row, "numeral_mode": numeral_mode, "cap_per_template": cap}
    return "".join(f"{name}={value}\n" for name, value in facts.items())
