"""Writers of labels, manifests, reports (SNK-03..10)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANIFEST = (
    "dataset_id", "relative_path", "sha256", "merged_filename", "original_filename", "split", "width", "height", "file_hash", "perceptual_hash", "annotation_count",
    "label_count", "overall_score", "status",
)
REPORT_ROWS = 1000


def write_label_files(lines: DataFrame, folder: str) -> None:
    """One text file per image below ``folder``/image_id=<id>/ from (image_id, label_text) (SNK-03)."""
    lines.select("image_id", F.col("label_text").alias("value")).repartition("image_id").write.partitionBy("image_id").text(folder)


def write_csv(report: DataFrame, folder: str) -> None:
    """A small report as one CSV with header (SNK-07)."""
    report.coalesce(1).write.option("header", "true").csv(folder)


def write_manifest(rows: DataFrame, folder: str) -> None:
    """The merged manifest: 14 columns, missing ones empty, range-sorted (SNK-10, SRT-02)."""
    columns = [F.col(c).cast("string").alias(c) if c in rows.columns else F.lit("").alias(c) for c in MANIFEST]
    rows.select(columns).fillna("").orderBy("dataset_id", "merged_filename").write.option("header", "true").csv(folder)


def json_manifest(rows: DataFrame) -> DataFrame:
    """One JSON document a row (SNK-06)."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def run_config(**values) -> str:
    return json.dumps(values, sort_keys=True, indent=2)


def data_yaml(names: tuple[str, ...], splits: dict[str, str]) -> str:
    """A ``data.yaml`` (SNK-05)."""
    return "\n".join([*(f"{k}: {v}" for k, v in splits.items()), f"nc: {len(names)}", "names: [" + ", ".join(f"'{n}'" for n in names) + "]", ""])


def markdown_report(title: str, summary: str, sections: dict[str, DataFrame | str]) -> str:
    """Title, summary and sections; tables are small aggregates (SNK-08), a larger one is refused."""
    parts = [f"# {title}", "", summary, ""]
    for name, body in sections.items():
        parts += [f"## {name}", ""]
        if isinstance(body, str):
            parts += [body, ""]
            continue
        rows = body.limit(REPORT_ROWS + 1).collect()
        if len(rows) > REPORT_ROWS:
            raise ValueError(f"section {name!r}: more than {REPORT_ROWS} rows; write it as a table of its own")
        parts += ["| " + " | ".join(body.columns) + " |", "| " + " | ".join("---" for _ in body.columns) + " |"]
        parts += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in rows]
        parts.append("")
    return "\n".join(parts)


def bar(n: int, most: int, width: int = 40) -> str:
    """A bar of at most ``width`` blocks."""
    return "█" * (0 if most <= 0 else min(width, round(n * width / most)))


def changelog(old: str, entry: str) -> str:
    """``entry`` put before the older ones, below the title (SNK-09)."""
    title, _, rest = old.partition("\n") if old.startswith("# ") else ("# Changelog", "", old)
    return f"{title}\n\n{entry.strip()}\n{rest if rest.startswith(chr(10)) else chr(10) + rest}"
