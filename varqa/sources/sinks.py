"""Sinks: JSON lines, documents, upserts, gated and resumable writes (SNK)."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, *order: str, files: int | None = None) -> None:
    """Whole-folder overwrite, nulls kept, rows in order; in one file only where asked for (SNK01, SNK04)."""
    x = df.orderBy(*order) if order else df
    (x.coalesce(files) if files else x).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json(value, path: str) -> None:
    """One small document, pretty-printed (SNK02, SNK14)."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="\n") as f:
        f.write(json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def search_documents(poems: DataFrame, terms: DataFrame) -> DataFrame:
    """id, type, title, poet_id, text for the site's search (SNK03, PRJ13, FN33)."""
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")), F.coalesce(F.array_join("themes", " "), F.lit("")))
    p = poems.where(F.col("public").eqNullSafe(True)).select("id", F.lit("poem").alias("type"), "title", "poet_id", text.alias("text"))
    return p.unionByName(terms.select("id", F.lit("term").alias("type"), F.col("headword").alias("title"), F.lit(None).cast("string").alias("poet_id"), F.concat_ws(" ", "headword", "meaning").alias("text")))


def markdown_table(df: DataFrame, *order: str, most: int = 10_000) -> str:
    """A report of the first `most` rows, which says how many more there are; the DataFrame remains the product (SNK05)."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows[:most])]
    if len(rows) > most:
        lines.append(f"\nThe first {most} of {df.count()} rows.")
    return "\n".join(lines) + "\n"


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new in place of those with the same key (SNK06)."""
    return old.join(new, key, "left_anti").unionByName(new, allowMissingColumns=True)


def resume(index: DataFrame, records: DataFrame, key: str, make: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, bool]:
    """(index with the missing records made, whether the counts now agree) (SNK07, SNK08, SNK10, GATE15)."""
    out = index.unionByName(make(records.join(index.select(key), key, "left_anti")))
    return out, out.select(key).distinct().count() == records.select(key).distinct().count()


def append_numbered(old: DataFrame, new: DataFrame, prefix: str, order: Column) -> DataFrame:
    """new rows with ids that go on after the greatest one there (SNK09)."""
    from ..operators.common import with_positions

    top = old.agg(F.coalesce(F.max(F.regexp_extract("id", r"(\d+)$", 1).try_cast("long")), F.lit(0)).alias("_top"))
    placed = with_positions(new.withColumn("_order", order), "_n", "_order")  # counted over ranges, not in one task
    made = placed.crossJoin(F.broadcast(top)).withColumn("id", F.concat(F.lit(prefix), F.lpad((F.col("_top") + F.col("_n") + 1).cast("string"), 5, "0"))).drop("_top", "_n", "_order")
    return old.unionByName(made, allowMissingColumns=True)


def replace_section(text: str, heading: str, body: str) -> str:
    """text with only the bytes under `# heading` changed (SNK11)."""
    lines, out, inside = text.splitlines(keepends=True), [], False
    for line in lines:
        if line.startswith("# "):
            inside = line[2:].strip().lower() == heading.lower()
            out.append(line)
            if inside:
                out.append(body if body.endswith("\n") else body + "\n")
        elif not inside:
            out.append(line)
    return "".join(out)


def rename_heading(text: str, old: str, new: str) -> str:
    """text with one heading renamed; all other lines stay byte for byte (SNK12)."""
    return "".join("# " + new + line[len("# " + old) :] if line.rstrip("\r\n") == "# " + old else line for line in text.splitlines(keepends=True))


def gated_write(df: DataFrame, violations: DataFrame, write: Callable[[DataFrame], None]) -> list:
    """Writes df only where there are no violations; else nothing, and some of them are returned (all gates)."""
    found = violations.limit(100).collect()
    if not found:
        write(df)
    return found


def bundle_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """name, rows, sha256 (of the sorted row hashes' sums, so order doesn't count) (SNK15, TRN04)."""
    out = None
    for name, df in tables.items():
        h = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
        one = df.select(F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)").alias("h")).agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.sha2(F.coalesce(F.sum("h"), F.lit(0)).cast("string"), 256).alias("sha256"))
        out = one if out is None else out.unionByName(one)
    return out


def new_entry(template: str, **values: str) -> str:
    """A document from a template with {{name}} slots (SNK13)."""
    for k, v in values.items():
        template = template.replace("{{" + k + "}}", v)
    return template
