"""Reports across samples: pivots, sections, notices and payloads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplewright.functions import text as X


def pivoted(metrics: DataFrame, by: str, metric: str, value: str, names: list[str]) -> DataFrame:
    """One row for each sample and a column for each named metric; the names make it one pass."""
    return metrics.groupBy(by).pivot(metric, names).agg(F.sum(value))


def ordered_sections(sections: DataFrame, orders: DataFrame) -> DataFrame:
    """Sections with their numeric order, 0 where none is set."""
    known = orders.select(F.col("section").alias("_s"), F.col("order_no"))
    return sections.join(known, F.col("section") == F.col("_s"), "left").drop("_s").withColumn("order_no", F.coalesce("order_no", F.lit(0)))


def definition_list(rows: DataFrame, group: str, name: str, value: str, order: str) -> DataFrame:
    """group and `html`: a heading and a definition list of the group's rows, escaped; unset values as N/A."""
    item = F.concat(F.lit("<dt>"), X.escaped(F.col(name)), F.lit("</dt><dd><samp>"), F.coalesce(F.nullif(X.escaped(F.col(value)), F.lit("")), F.lit("N/A")), F.lit("</samp></dd>"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(order), item.alias("i"))))
    body = F.array_join(F.transform(listed, lambda r: r["i"]), "")
    return rows.groupBy(group).agg(body.alias("_body")).select(group, F.concat(F.lit("<p><b>"), X.escaped(F.col(group)), F.lit("</b></p><dl>"), "_body", F.lit("</dl>")).alias("html"))


def recipient(email: Column, on_fail: Column, success: Column) -> Column:
    """Who is told: `email`, or the other address after a failure; null for nobody."""
    none = F.lit(None).cast("string")
    return F.coalesce(X.or_default(email, none), F.when(~success, X.or_default(on_fail, none)))


def attaches(size: Column, cap: Column, fallback: Column) -> Column:
    """Whether a report of this size goes with the mail: below the cap, or up to it by the fallback mailer."""
    return F.when(fallback, size <= cap).otherwise(size < cap)


def payload_kind(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("hooks.slack.com")), "slack").otherwise("card")


def completion(success: Column, ignored: Column) -> Column:
    """A run's outcome in a few words; ignored failures are named."""
    return F.when(~success, "run failed").when(ignored == 0, "run finished").otherwise("run finished, some tasks failed and were ignored")


def payload(kind: str, name: str, version: str, success: bool, command: str, summary: dict[str, str], error: str = "", when: str = "", took: str = "") -> str:
    """The JSON text that a webhook gets; a summary entry named hook_url is hidden.

    kind: "slack" or "card". when and took, the run's end and duration, are shown if given.
    """
    run = f"{name} {version}".strip()
    outcome = "The run finished." if success else "The run failed."
    shown = [("Started with", command), ("Ended", when), ("Took", took), ("Failure", "" if success else error or "no message")]
    shown += [(k, "(hidden)" if k == "hook_url" else v) for k, v in summary.items()]
    facts = [{"title": title, "value": value} for title, value in shown if value]
    # The keys and kinds that the two payload formats ask for.
    if kind == "slack":
        return json.dumps({"attachments": [{"fallback": f"{run}: {outcome}", "color": "good" if success else "danger", "text": f"{run}: {outcome}", "fields": facts}]})
    body = [{"type": "TextBlock", "text": f"{run}: {outcome}", "wrap": True}, {"type": "FactSet", "facts": facts}]
    card = {"type": "AdaptiveCard", "version": "1.2", "body": body}
    return json.dumps({"type": "message", "attachments": [{"contentType": "application/vnd.microsoft.card.adaptive", "contentUrl": None, "content": card}]})
