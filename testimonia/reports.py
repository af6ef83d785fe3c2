"""Reports: lines made by the engine, and small tables written out on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from testimonia.functions import text as T


def claim_line(claim: Column, day: Column, page: Column, speaker: Column, text: Column) -> Column:
    """"- [id | Day d, p.x — speaker] text": the id cut to ten characters, the text to 300; what is not known is left out."""
    where = F.concat(F.lit("Day "), F.coalesce(day.cast("string"), F.lit("None")), F.when(page.isNotNull(), F.concat(F.lit(", p."), page.cast("string"))).otherwise(F.lit("")))
    who = F.when(F.coalesce(speaker, F.lit("")) != "", F.concat(F.lit(" — "), speaker)).otherwise(F.lit(""))
    return F.concat(F.lit("- ["), F.substring(claim, 1, 10), F.lit(" | "), where, who, F.lit("] "), T.clipped(text, 300))


def integrity_lines(pairs: DataFrame) -> DataFrame:
    """doc_a, doc_b and line: what an integrity report says of the documents that repeat each other."""
    percent = lambda c: F.format_string("%.1f%%", F.col(c) * 100)
    line = F.concat(F.lit("duplicate content: "), F.substring("doc_a", 1, 12), F.lit(" and "), F.substring("doc_b", 1, 12), F.lit(" (containment "), percent("a_in_b"), F.lit(" / "), percent("b_in_a"), F.lit(")"))
    return pairs.where("is_duplicate").select("doc_a", "doc_b", line.alias("line"))


def markdown(rows: DataFrame, most: int = 200) -> str:
    """A small table in Markdown; more than ``most`` rows are refused, a report being no place for a table's contents."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows")
    cell = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in found]) + "\n"
