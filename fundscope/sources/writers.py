"""Sinks: tables, JSON, CSV, Markdown, and snapshots that a merge can be replayed from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rebuild(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def json_report(df: DataFrame, path: str) -> None:
    """One JSON object per line, nested values kept."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def ranked_csv(df: DataFrame, path: str, order: Sequence[Column], rank: str = "rank") -> None:
    """CSV with a header and a rank column; a report, so its rows are few."""
    df.withColumn(rank, F.row_number().over(Window.orderBy(*order))).select(rank, *df.columns).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def bars(df: DataFrame, n: str, width: int = 40) -> DataFrame:
    """``bar``: as many marks as the value has of the largest one's ``width``."""
    most = F.max(n).over(Window.partitionBy(F.lit(1)))
    return df.withColumn("bar", F.repeat(F.lit("#"), F.coalesce(F.round(width * F.col(n) / F.nullif(most, F.lit(0))), F.lit(0)).cast("int")))


def _few(df: DataFrame, most: int) -> list:
    """All rows; more than ``most`` are refused, as a page would leave some out unseen."""
    rows = list(df.limit(most + 1).toLocalIterator())
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; a page holds no more, write them as a table")
    return rows


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small table as Markdown; ``most`` bounds what the driver sees, and larger tables are refused."""
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    for row in _few(df, most):
        lines.append("| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in row) + " |")
    return "\n".join(lines) + "\n"


def html(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small table as HTML, escaped; larger ones than ``most`` rows are refused."""
    from html import escape

    head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{'' if v is None else escape(str(v))}</td>" for v in r) + "</tr>" for r in _few(df, most))
    return f"<h2>{escape(title)}</h2><table><tr>{head}</tr>{body}</table>"


def snapshot(df: DataFrame, root: str, label: str) -> DataFrame:
    """Write the records before anything is merged; ``replay`` reads them again."""
    df.write.mode("overwrite").parquet(f"{root}/snapshot={label}")
    return replay(df.sparkSession, root, label)


def replay(spark, root: str, label: str) -> DataFrame:
    return spark.read.parquet(f"{root}/snapshot={label}")
