"""Small talk, routing, leaked calls, and questions about attached files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.plan import bound, once
from folioflow.functions.text import words

# The openings that are nothing but small talk, the shape of a
# call that leaked into a reply, section headers, labels and limits.
GREETING = r"""(?iu)^\s*(hi|hello|hey|yo|sup|what'?s\s*up|how'?s\s*it\s*going|how\s*are\s*you|good\s*(morning|afternoon|evening)|thanks|thank\s*you|bye|goodbye)\s*(everyone|everybody)?\s*[!.?]*\s*$"""  # noqa: E501
LEAKED_CALL = r'''(?s)\{\s*"name"\s*:\s*"(ask_hr|ask_safety|ask_operations)"\s*,\s*"parameters"\s*:\s*(\{.*\})\s*\}'''
SECTION_HEADERS = {
    "vision": 'What the image "{name}" shows',
    "bda": 'Contents of "{name}"',
    "textract": 'Form fields read from "{name}"',
    "spreadsheet": 'Spreadsheet "{name}" as CSV',
    "plaintext": 'Contents of the file "{name}"',
}
OTHER_HEADER = 'Contents of "{name}"'
TRUNCATED = "\n[...truncated...]"
CONTEXT_CHARS = {"local": 6_000, "hosted": 200_000}
SOURCE_LABELS = {
    "vision": "read as an image",
    "plaintext": "read directly",
    "spreadsheet": "parsed locally",
    "pdf-text": "read locally (PDF text)",
    "textract": "read with Textract",
    "bda": "read with Bedrock Data Automation",
}
FROM_CACHE = "from cache"
PREVIEW_CHARS = 3_000
NOT_FOUND = {
    "hr": "No matching HR documents found.",
    "safety": "No matching safety documents found.",
    "operations": "No matching operations documents found.",
}

# Ours: the reply names no company, and routing is by weighted words, not by a model.
GREETING_REPLY = "Hi! I'm the assistant. I can help with HR, Safety, or Operations — what do you need?"
# (word, area, weight): an area is taken from a score of LEAST_SCORE on, so words that
# are in many requests count only together.
ROUTE_WORDS = [
    *[(w, "hr", 2) for w in ("onboarding", "benefits", "pto", "payroll", "vacation", "orientation", "insurance", "timesheet")],
    *[(w, "hr", 1) for w in ("pay", "policy", "hire", "leave", "enroll", "manager")],
    *[(w, "safety", 2) for w in ("ppe", "safety", "hazard", "hazards", "osha", "incident", "injury", "lockout", "tagout")],
    *[(w, "safety", 1) for w in ("harness", "helmet", "spill", "fire", "wear", "report")],
    *[(w, "operations", 2) for w in ("sop", "sops", "schedule", "schedules", "scheduling", "calendar", "ticket", "tickets", "jabber")],
    *[(w, "operations", 1) for w in ("shift", "handoff", "crane", "dock", "line", "manager")],
]
LEAST_SCORE = 2
# (pattern, effect, area), the first that ends it wins: ``only`` sends a request to the
# area and nowhere else, ``add`` sends it there too, ``never`` keeps it from there.
ROUTE_PRECEDENCE = [
    (
        r"\b(send|message|notify)\b.*\bjabber\b|\bjabber\b.*\bsaying\b|"
        r"\b(open|file|submit|create|log)\b.*\b(ticket|request)\b|"
        r"\b(check|look up|show)\b.*\bcalendar\b",
        "only",
        "operations",
    ),
    (r"\bppe\b|protective equipment", "add", "safety"),
    (r"\bppe\b|protective equipment", "never", "operations"),
]
AREAS = ("hr", "safety", "operations")
OTHERWISE = "web"


def split_greetings(messages: DataFrame, reply: str = GREETING_REPLY) -> tuple[DataFrame, DataFrame]:
    """(greetings, rest): messages that are only small talk get ``reply``."""
    small = F.coalesce(F.col("text").rlike(GREETING), F.lit(False))
    return messages.filter(small).withColumn("reply", F.lit(reply)), messages.filter(~small)


def routes_of(
    text: Column,
    words: list[tuple[str, str, int]] = ROUTE_WORDS,
    precedence: list[tuple[str, str, str]] = ROUTE_PRECEDENCE,
    least: int = LEAST_SCORE,
) -> Column:
    """(route, score) of the areas that a message goes to.

    The score of an area is the sum of the weights of its words that stand in the
    message, each counted once. Precedence is looked at in order; no area at all
    means the web.
    """
    weights: dict[str, list[tuple[str, int]]] = {}
    for word, area, weight in words:
        weights.setdefault(word, []).append((area, weight))
    entry = lambda a, w: F.struct(F.lit(a).alias("area"), F.lit(w).alias("weight"))
    known = F.create_map(*[x for word, own in weights.items() for x in (F.lit(word), F.array(*[entry(*o) for o in own]))])
    lowered = F.lower(text)
    tokens = F.array_distinct(F.regexp_extract_all(lowered, F.lit(r"[\p{L}]+"), F.lit(0)))
    hits = F.flatten(
        F.transform(F.filter(tokens, lambda t: t.isin(list(weights))), lambda t: F.try_element_at(known, t))
    )
    route = lambda area, score: F.struct(F.lit(area).alias("route"), score.alias("score"))

    def chosen(found: Column) -> Column:
        def total(area: str) -> Column:
            own = F.filter(found, lambda h: h["area"] == area)
            return F.aggregate(own, F.lit(0), lambda sum_, h: sum_ + h["weight"])

        score = {area: total(area) for area in AREAS}
        taken = {area: score[area] >= least for area in AREAS}
        only = None
        for pattern, effect, area in precedence:
            if effect == "add":
                taken[area] = taken[area] | lowered.rlike(pattern)
            elif effect == "never":
                taken[area] = taken[area] & ~lowered.rlike(pattern)
            else:
                fits = F.array(route(area, score[area]))
                only = F.when(lowered.rlike(pattern), fits) if only is None else only.when(lowered.rlike(pattern), fits)
        listed = F.array_compact(F.array(*[F.when(taken[area], route(area, score[area])) for area in AREAS]))
        rest = F.when(F.size(listed) > 0, listed).otherwise(F.array(route(OTHERWISE, F.lit(0))))
        return rest if only is None else only.otherwise(rest)

    return bound(F.coalesce(hits, F.expr("CAST(array() AS array<struct<area:string,weight:int>>)")), chosen)


def route_requests(messages: DataFrame, **rules) -> DataFrame:
    """One row per message and route, with the score of the route."""
    routed = messages.withColumn("_route", F.explode_outer(routes_of(F.coalesce("text", F.lit("")), **rules)))
    return routed.select(*messages.columns, "_route.route", "_route.score")


def recover_tool_calls(replies: DataFrame) -> DataFrame:
    """Adds ``tool_name`` and ``question`` where a reply is a leaked call.

    Arguments are read as they are, or with ``\\'`` repaired; the question must
    be a non-empty string. Other replies get NULLs.
    """
    raw = F.nullif(F.regexp_extract("text", LEAKED_CALL, 2), F.lit(""))
    parsed = F.coalesce(
        F.call_function("try_parse_json", raw),
        F.call_function("try_parse_json", F.replace(raw, F.lit("\\'"), F.lit("'"))),
    )

    def read(args: Column) -> dict[str, Column]:
        variant = F.call_function("try_variant_get", args, F.lit("$.question"), F.lit("variant"))
        text = F.call_function("try_variant_get", args, F.lit("$.question"), F.lit("string"))
        usable = (F.call_function("schema_of_variant", variant) == "STRING") & (text != "")
        return {
            "tool_name": F.when(usable, F.regexp_extract("text", LEAKED_CALL, 1)),
            "question": F.when(usable, text),
        }

    return once(replies, parsed, read)


def _by_extractor(templates: dict[str, str], other: Column, build) -> Column:
    chosen = None
    for extractor, template in templates.items():
        test = F.col("extractor") == extractor
        chosen = (F if chosen is None else chosen).when(test, build(template))
    return chosen.otherwise(other)


def _header(template: str) -> Column:
    before, after = template.split("{name}")
    return F.concat(F.lit(before), F.col("filename"), F.lit(after))


def document_context(
    questions: DataFrame, documents: DataFrame, max_chars: int = CONTEXT_CHARS["hosted"]
) -> DataFrame:
    """(question_id, prompt): attached texts under headers, then the question.

    ``documents`` is (question_id, position, filename, text, extractor). Each
    text is cut before the shuffle, so no more than ``max_chars`` of it moves.
    """
    excerpt = F.when(
        F.length("text") > max_chars, F.concat(F.substring("text", 1, max_chars), F.lit(TRUNCATED))
    ).otherwise(F.col("text"))
    section = F.concat(
        F.lit("--- "),
        _by_extractor(SECTION_HEADERS, _header(OTHER_HEADER), _header),
        F.lit(" ---\n"),
        excerpt,
    )
    gathered = (
        documents.select("question_id", "position", section.alias("section"))
        .groupBy("question_id")
        .agg(F.sort_array(F.collect_list(F.struct("position", "section"))).alias("s"))
        .select("question_id", F.array_join(F.transform("s", lambda x: x["section"]), "\n\n").alias("context"))
    )
    return questions.join(gathered, "question_id", "left").select(
        "question_id",
        F.concat(
            F.coalesce("context", F.lit("")), F.lit("\n\n--- Question ---\n"), F.col("question")
        ).alias("prompt"),
    )


def document_summary(documents: DataFrame) -> DataFrame:
    """Adds ``n_words``, ``preview``, ``source_label`` and ``caption``."""
    cached = (
        F.coalesce(F.col("from_cache"), F.lit(False)) if "from_cache" in documents.columns else F.lit(False)
    )
    label = F.when(cached, F.lit(FROM_CACHE)).otherwise(
        _by_extractor(SOURCE_LABELS, F.col("extractor"), F.lit)
    )
    return (
        documents.withColumn("n_words", F.size(words(F.col("text"))))
        .withColumn("preview", F.substring("text", 1, PREVIEW_CHARS))
        .withColumn("source_label", label)
        .withColumn(
            "caption", F.concat(F.format_number("n_words", 0), F.lit(" words · "), F.col("source_label"))
        )
    )
