"""Tool calls: checking them, tickets, calendar answers, and their traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.ranking import STRETCH, last_before, stretches
from folioflow.functions.text import ordered_text

# The delimiter, and each tool's required arguments.
DELIMITER = "___"
TOOL_ARGUMENTS = {
    "create_ticket": ("category", "summary"),
    "get_calendar_events": ("date",),
    "send_jabber_message": ("recipient", "message"),
}
TOOL_NAME_PATH = "$.event.contentBlockStart.start.toolUse.name"


def validate_calls(
    calls: DataFrame, schema: dict[str, tuple[str, ...]] = TOOL_ARGUMENTS
) -> tuple[DataFrame, DataFrame]:
    """(valid, errors) of (call_id, tool_name, args MAP).

    The tool is what follows the first delimiter. Errors carry a ``reason``:
    no delimiter, unknown tool, or required arguments that are missing.
    """
    at = F.instr("tool_name", DELIMITER)
    tool = F.substr("tool_name", at + len(DELIMITER))
    required = F.lit(None).cast("array<string>")
    for name, arguments in schema.items():
        required = F.when(tool == name, F.array(*[F.lit(a) for a in arguments])).otherwise(required)
    missing = F.array_except(
        required, F.coalesce(F.map_keys("args"), F.expr("CAST(array() AS array<string>)"))
    )
    reason = (
        F.when(F.coalesce(at, F.lit(0)) == 0, F.lit(f"tool name has no {DELIMITER}"))
        .when(required.isNull(), F.concat(F.lit("Unknown tool: "), tool))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    )
    checked = calls.withColumns({"tool": F.when(at > 0, tool), "reason": reason})
    return (
        checked.filter(F.col("reason").isNull()).drop("reason"),
        checked.filter(F.col("reason").isNotNull()),
    )


def ticket_rows(valid: DataFrame) -> DataFrame:
    """(call_id, ticket_id, status, category, summary) of valid create calls.

    Further details (``details MAP``) are folded into the summary in their own
    order. The id is a hash of the call id, so a rerun gives the same ticket.
    """
    details = (
        F.array_join(
            F.transform(
                F.map_entries("details"),
                lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("None"))),
            ),
            ", ",
        )
        if "details" in valid.columns
        else F.lit("")
    )
    summary = F.col("args")["summary"]
    return valid.filter(F.col("tool") == "create_ticket").select(
        "call_id",
        F.concat(F.lit("SMAX-"), F.upper(F.md5(F.col("call_id").cast("string")))).alias("ticket_id"),
        F.lit("created").alias("status"),
        F.col("args")["category"].alias("category"),
        F.when(
            F.coalesce(details, F.lit("")) != "", F.concat(summary, F.lit(" ("), details, F.lit(")"))
        )
        .otherwise(summary)
        .alias("summary"),
    )


def calendar_lookup(
    requests: DataFrame, calendar: DataFrame, keys: tuple[str, ...] = ("date",)
) -> DataFrame:
    """(request_id, answer): the events of the date in order, one per line.

    ``calendar`` is (keys, position, event). With the owner among the keys a
    group is one person's day. Only days that are asked for are gathered. A day is
    put in order and joined stretch by stretch, and then the stretches are joined, so
    no task sorts a busy day; its text is still one cell.
    """
    wanted = requests.select(*keys).distinct()
    asked = calendar.join(wanted, list(keys), "left_semi").select(*keys, "position", "event")
    days = (
        stretches(asked, keys, [F.col("position"), F.col("event")])
        .groupBy(*keys, STRETCH)
        .agg(F.sort_array(F.collect_list(F.struct("position", "event"))).alias("e"))
        .select(*keys, STRETCH, F.array_join(F.transform("e", lambda x: x["event"]), "\n").alias("part"))
        .groupBy(*keys)
        .agg(ordered_text(F.col(STRETCH), F.col("part"), "\n").alias("events"))
    )
    return requests.join(days, list(keys), "left").select(
        "request_id",
        F.coalesce(
            "events", F.concat(F.lit("No events found for "), F.col("date").cast("string"), F.lit("."))
        ).alias("answer"),
    )


def trace_calls(events: DataFrame, column: str = "props") -> DataFrame:
    """Events that name a tool, with a ``trace`` line; the rest drop out."""
    name = F.get_json_object(F.col(column), TOOL_NAME_PATH)
    return (
        events.withColumn("tool_name", name)
        .filter(F.coalesce(F.col("tool_name"), F.lit("")) != "")
        .withColumn("trace", F.concat(F.lit("Called tool: `"), "tool_name", F.lit("`")))
    )


def trace_by_request(trace: DataFrame, requests: DataFrame, keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Trace lines with the request started last at or before them.

    ``trace`` is (keys, ts, line_id), ``requests`` (keys, ts, request_id).
    Lines from before a user's first request drop out. An as-of join as a union
    and a carried value: no inequality join. Rows are dealt in even ranges of (keys,
    time), and one row per user and range carries the last request over, so a user
    who has nearly all rows is spread over all tasks.
    """
    both = (
        requests.select(*keys, "ts", F.lit(0).alias("kind"), "request_id", F.lit(None).cast(trace.schema["line_id"].dataType).alias("line_id"))
        .unionByName(
            trace.select(*keys, "ts", F.lit(1).alias("kind"), F.lit(None).cast(requests.schema["request_id"].dataType).alias("request_id"), "line_id")
        )
    )
    order = [F.col("ts"), F.col("kind"), F.coalesce("request_id", "line_id")]
    cut = stretches(both, keys, order)
    joined = last_before(cut, keys, order, F.col(STRETCH), F.col("request_id"), "current_request")
    return joined.filter((F.col("kind") == 1) & F.col("current_request").isNotNull()).select(
        *keys, "ts", "line_id", F.col("current_request").alias("request_id")
    )
