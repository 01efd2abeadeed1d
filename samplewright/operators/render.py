"""Texts and files made from rows: templates, version documents, mails, report pages, long metric tables.

Texts of a row are columns; files are written by Spark's text and Parquet writers, so any
path that Hadoop knows will do. A document of one file is for rows that are few by nature
(versions, sections, metrics of a run): its lines are ordered and written by one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplewright.functions import text as X


def filled(template: str, **values: Column) -> Column:
    """The template with `{{name}}` replaced by the named columns; null counts as empty.

    A name without a column is a ValueError, so that no hole is left in a text.
    """
    parts: list[Column] = []
    for k, part in enumerate(re.split(r"\{\{\s*(\w+)\s*\}\}", template)):
        if k % 2 and part not in values:
            raise ValueError(f"nothing given for {part}")
        parts.append(F.coalesce(values[part].cast("string"), F.lit("")) if k % 2 else F.lit(part))
    return F.concat(*parts)


def yaml_scalar(value: Column) -> Column:
    """A text as YAML: plain where that is safe, else in single quotes; null as null."""
    plain = F.rlike(value, F.lit(r"^[A-Za-z_][A-Za-z0-9_./+-]*$")) & ~F.lower(value).isin("true", "false", "null", "yes", "no", "on", "off", "y", "n")
    return F.when(value.isNull(), "null").when(plain, value).otherwise(F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")))


def version_documents(rows: DataFrame, group: str, tool: str, version: str) -> DataFrame:
    """group and `body`: a YAML block of the group's tools with their versions, sorted by tool."""
    line = F.concat(F.lit("  "), yaml_scalar(F.col(tool)), F.lit(": "), yaml_scalar(F.col(version)))
    listed = rows.groupBy(group).agg(F.array_sort(F.collect_set(F.struct(F.col(tool).alias("t"), line.alias("l")))).alias("_l"))
    body = F.concat(yaml_scalar(F.col(group)), F.lit(":\n"), F.array_join(F.transform("_l", lambda x: x["l"]), "\n"))
    return listed.select(group, body.alias("body"))


def version_section(rows: DataFrame, group: str, html: str, row: str = "row") -> DataFrame:
    """group and `body`: the group's table body from the ordered table rows of `versions.table_rows`."""
    listed = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(row).alias("n"), F.col(html).alias("h")))).alias("_r"))
    return listed.select(group, F.concat(F.lit("<tbody>"), F.array_join(F.transform("_r", lambda x: x["h"]), ""), F.lit("</tbody>")).alias("body"))


def table_page(bodies: DataFrame, headings: list[str]) -> str:
    """One HTML table of the groups' bodies, which are few, with a head. Groups come in order."""
    head = "".join(f"<th>{h}</th>" for h in headings)
    rows = [r["body"] for r in bodies.orderBy(bodies.columns[0]).collect()]
    return f"<table><thead><tr>{head}</tr></thead>{''.join(rows)}</table>"


def section_document(name: str, title: str, html: str) -> str:
    """A custom section of a report as YAML: its id, heading, kind and HTML."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return "\n".join([f"id: {quoted(name)}", f"section_name: {quoted(title)}", "plot_type: 'html'", "data: |", *("  " + x for x in html.split("\n"))])


def mail(subject: Column, status: Column, facts: Column) -> Column:
    """A mail as struct (subject, text, html); `facts` is a map of names to texts, listed in the order of the names."""
    pairs = F.array_sort(F.map_entries(facts))
    lines = F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")
    cells = F.array_join(F.transform(pairs, lambda e: F.concat(F.lit("<tr><th>"), X.escaped(e["key"]), F.lit("</th><td>"), X.escaped(F.coalesce(e["value"], F.lit(""))), F.lit("</td></tr>"))), "")
    text = filled("{{subject}}\n\n{{status}}\n\n{{lines}}\n", subject=subject, status=status, lines=lines)
    html = filled("<h1>{{subject}}</h1><p>{{status}}</p><table>{{cells}}</table>", subject=X.escaped(subject), status=X.escaped(status), cells=cells)
    return F.struct(subject.alias("subject"), text.alias("text"), html.alias("html"))


def long_metrics(*tables: tuple[DataFrame, str, str, str | None, str]) -> DataFrame:
    """sample, metric, at, value of many metric tables: (table, sample column, metric's name, place column or None, value column).

    One union: the metrics of all samples as rows, to be pivoted or written as they are.
    """
    out = None
    for df, sample, metric, at, value in tables:
        place = F.lit(None).cast("double") if at is None else F.col(at).cast("double")
        rows = df.select(F.col(sample).cast("string").alias("sample"), F.lit(metric).alias("metric"), place.alias("at"), F.col(value).cast("double").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def write_metrics(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Long metrics as Parquet, one folder for each metric."""
    metrics.write.mode(mode).partitionBy("metric").parquet(path)


def write_document(rows: DataFrame, body: str, order: list[str], path: str, mode: str = "errorifexists") -> None:
    """A text file (one part below `path`) of a column's texts in order; for rows that are few by nature."""
    rows.repartition(1).sortWithinPartitions(*order).select(F.col(body).alias("value")).write.mode(mode).text(path)


def write_collected(rows: DataFrame, body: str, order: list[str], path: str, by: str | None = None, mode: str = "errorifexists") -> None:
    """Texts collected to ordered files: one for each value of `by`, spread over tasks, or range after range of the order.

    Without `by` the rows are sorted as a whole and the parts' names follow the order, so no
    task holds more than its range.
    """
    if by is None:
        rows.orderBy(*order).select(F.col(body).alias("value")).write.mode(mode).text(path)
    else:
        dealt = rows.repartition(by).sortWithinPartitions(by, *order)
        dealt.select(F.col(by), F.col(body).alias("value")).write.mode(mode).partitionBy(by).text(path)
