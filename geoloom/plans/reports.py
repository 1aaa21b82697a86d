"""Small reports on the driver: markdown tables and sentences from aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows that a report may show.
MOST = 2000


def markdown(df: DataFrame, order: list[str] | None = None, most: int = MOST) -> str:
    """A markdown table of an aggregated table (a report shows ``most`` rows)."""
    rows = (df.orderBy(*order) if order else df).limit(most).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows])


def licence_report(df: DataFrame) -> str:
    """Licences and the sources under each."""
    from pyspark.sql import functions as F

    by = df.groupBy("licence", "redistributable").agg(F.count("*").alias("sources"))
    return "# Licences\n\n" + markdown(by, ["licence"])


def coverage_sentence(row: dict) -> str:
    return f"{row['layer']}: {row['n_done']} done, {row['n_candidate']} planned, {row['n_absent']} absent ({row['pct_done']} %)."
