"""Screening of messages and replies by a rule table.

A rule is a phrase of a category, for one or both sides. Each phrase is anchored at
the word of it that fewest rules have. A text looks its words up among the anchors, by
their first letters, and only where one stands is the neighbourhood compared with the
phrases of that anchor. So the work grows with the text and not with the number of
rules, and nothing is joined or shuffled: the index is part of the expression.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions import pii
from folioflow.functions.plan import bound, once

# Refusals, masks, and the action names of stored assessments.
BLOCKED_INPUT = "Sorry, I can't help with that request."
BLOCKED_OUTPUT = "Sorry, I can't provide that response."
MASKS = {
    "EMAIL_ADDRESS": "{EMAIL}",
    "PHONE_NUMBER": "{PHONE}",
    "US_SSN": "{US_SOCIAL_SECURITY_NUMBER}",
}
INTERVENED = "GUARDRAIL_INTERVENED"


#: Rules that fit into an expression, and words of a phrase; more are refused.
MOST_RULES = 5_000
MOST_WORDS = 12
#: Letters by which words are looked up. The last word of a phrase may go on in the text.
HEAD = 4
WORD = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Screen:
    """A category and the phrases that put a text in it; which side it is on."""

    category: str
    phrases: tuple[str, ...]
    on_input: bool = True
    on_output: bool = True


# The categories and sides are the reference's; the phrases are ours, as the
# service that judges there is a model.
SCREENS: tuple[Screen, ...] = (
    Screen("HATE", ("hate those people", "racial slur", "subhuman")),
    Screen("INSULTS", ("you are an idiot", "you idiot", "stupid moron")),
    Screen("SEXUAL", ("sexually explicit", "pornographic")),
    Screen("VIOLENCE", ("build a bomb", "how to kill", "shoot someone")),
    Screen("MISCONDUCT", ("launder money", "steal a badge", "forge a permit")),
    Screen(
        "PROMPT_ATTACK",
        ("ignore previous instructions", "ignore all instructions", "reveal your system prompt"),
        on_output=False,
    ),
    Screen(
        "ExportControlledTechnicalData",
        (
            "hull design specification",
            "technical drawing",
            "weapons system",
            "technical data package",
            "export-controlled",
            "itar data",
        ),
    ),
)


def rule_table(spark: SparkSession, screens: tuple[Screen, ...] = SCREENS) -> DataFrame:
    """(category, phrase, on_input, on_output) of the rules above."""
    rows = [(s.category, phrase, s.on_input, s.on_output) for s in screens for phrase in s.phrases]
    return spark.createDataFrame(rows, "category STRING, phrase STRING, on_input BOOLEAN, on_output BOOLEAN")


def phrase_words(phrase: str) -> list[str]:
    return regex.findall(WORD, phrase.lower())


def phrase_index(rules: list[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    """Head of an anchor: (category, phrase), with a blank before the phrase.

    An anchor has ``HEAD`` letters where a phrase has such a word, so that its last
    word may go on; a phrase of shorter words is anchored at one that is not its last,
    or, if it is its only word, stands for itself alone, and ends with a blank.
    """
    split = [(category, phrase_words(phrase)) for category, phrase in rules]
    uses = Counter(word[:HEAD] for _, words in split for word in set(words))
    index: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for category, words in split:
        if not words:
            continue
        if len(words) > MOST_WORDS:
            raise ValueError(f"a phrase has more than {MOST_WORDS} words: {' '.join(words)}")
        whole = len(words) == 1 and len(words[0]) < HEAD
        anchors = [w for w in words if len(w) >= HEAD] or (words if whole else words[:-1])
        rarest = min(anchors, key=lambda w: (uses[w[:HEAD]], -len(w), w))
        index[rarest[:HEAD]].append((category, " " + " ".join(words) + " " * whole))
    return dict(index)


def matched_categories(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Sorted categories of the phrases that a text holds, word by word."""
    index = phrase_index(rules)
    none = F.expr("CAST(array() AS array<string>)")
    if not index:
        return none
    entry = lambda c, p: F.struct(F.lit(c).alias("category"), F.lit(p).alias("phrase"))
    known = F.create_map(*[x for head, own in index.items() for x in (F.lit(head), F.array(*[entry(*o) for o in own]))])
    heads = list(index)

    def of_words(words: Column) -> Column:
        near = F.filter(
            F.transform(words, lambda w, i: F.struct(F.substring(w, 1, HEAD).alias("head"), i.alias("at"))),
            lambda x: x["head"].isin(heads),
        )

        def found(x: Column) -> Column:
            around = F.slice(words, F.greatest(x["at"] + 1 - MOST_WORDS, F.lit(1)), F.lit(2 * MOST_WORDS + 1))
            context = F.concat(F.lit(" "), F.array_join(around, " "), F.lit(" "))
            held = F.filter(F.try_element_at(known, x["head"]), lambda r: F.contains(context, r["phrase"]))
            return F.transform(held, lambda r: r["category"])

        return F.array_sort(F.array_distinct(F.flatten(F.transform(near, found))))

    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(bound(words, of_words), none)


def _screened(df: DataFrame, rules: DataFrame | None, side: str, refusal: str) -> DataFrame:
    table = rule_table(df.sparkSession) if rules is None else rules
    rows = table.filter(F.col(side)).select("category", "phrase").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = matched_categories(F.col("text"), [tuple(r) for r in rows])
    text = F.col("text")

    def decided(categories: Column) -> dict[str, Column]:
        blocked = F.size(categories) > 0
        return {
            "categories": categories,
            "blocked": blocked,
            "text": F.when(blocked, F.lit(refusal)).otherwise(text),
        }

    return once(df, found, decided)


def screen_input(messages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Adds ``blocked`` and ``categories``; a blocked message's text becomes
    the input refusal. Nothing is masked on this side. ``rules`` is a table as that
    of ``rule_table``, which is used where none is given."""
    return _screened(messages, rules, "on_input", BLOCKED_INPUT)


def screen_output(replies: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """The same for replies, and e-mails, phones and SSNs become masks.

    Names are left alone. Masks go in the order SSN, phone, e-mail.
    """
    screened = _screened(replies, rules, "on_output", BLOCKED_OUTPUT)
    masked = F.col("text")
    by_entity = {r.entity: r.pattern for r in pii.RULES if r.name in ("ssn", "phone", "email")}
    for entity in ("US_SSN", "PHONE_NUMBER", "EMAIL_ADDRESS"):
        masked = F.regexp_replace(masked, by_entity[entity], F.lit(MASKS[entity].replace("{", r"\{")))
    return screened.withColumn("text", masked)


def fold_assessments(responses: DataFrame) -> DataFrame:
    """Adds ``blocked`` and ``decided_text`` from (response_json, text).

    Not intervened keeps the text. Otherwise the outputs joined, or the text
    when they are empty; blocked if any item of any policy is BLOCKED. Policies
    are parsed level by level, so one odd value cannot hide the others. A
    response that cannot be read counts as blocked.
    """

    def blocked_item(item):
        return F.coalesce(F.from_json(item, "action STRING")["action"] == "BLOCKED", F.lit(False))

    def nested(level, schema):
        return F.coalesce(F.map_values(F.from_json(level, "MAP<STRING, STRING>")), F.expr("CAST(array() AS array<string>)"))

    def any_in(values, test):
        return F.coalesce(F.exists(values, test), F.lit(False))

    any_blocked = any_in(
        F.col("_r.assessments"),
        lambda assessment: any_in(
            nested(assessment, None),
            lambda policy: any_in(
                nested(policy, None),
                lambda items: any_in(F.from_json(items, "ARRAY<STRING>"), blocked_item),
            ),
        ),
    )
    output = F.array_join(
        F.transform(F.col("_r.outputs"), lambda o: F.coalesce(o["text"], F.lit(""))), ""
    )
    intervened = F.coalesce(F.col("_r.action") == INTERVENED, F.lit(False))
    readable = F.call_function("try_parse_json", F.col("response_json")).isNotNull()
    return (
        responses.withColumn("_r", F.from_json("response_json", schemas.SCREENING))
        .withColumn(
            "blocked",
            F.when(~readable, True).otherwise(intervened & any_blocked),
        )
        .withColumn(
            "decided_text",
            F.when(intervened, F.coalesce(F.nullif(output, F.lit("")), F.col("text"))).otherwise(
                F.col("text")
            ),
        )
        .drop("_r")
    )
