"""Personal data: the rule table and the column expressions that apply it.

Every expression works inside one row, so redaction never shuffles. A rule's
pattern is a literal, because Spark then compiles it once per task; the few
rules are looped over while the plan is built, not joined to rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.plan import bound

# The entities redacted by default, the score floor, and the two
# number shapes that count as a social security number with their scores.
DEFAULT_ENTITIES = (
    "PERSON",
    "EMAIL_ADDRESS",
    "PHONE_NUMBER",
    "US_SSN",
    "US_ITIN",
    "CREDIT_CARD",
    "US_BANK_NUMBER",
    "IBAN_CODE",
    "US_PASSPORT",
    "US_DRIVER_LICENSE",
    "MEDICAL_LICENSE",
    "CRYPTO",
)
DEFAULT_THRESHOLD = 0.35
OFF_WORDS = ("off", "0", "false", "no")
SSN_DELIMITED = (r"\b[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}\b", 0.6)
SSN_NINE_DIGITS = (r"\b[0-9]{9}\b", 0.3)
SSN_CONTEXT = ("ssn", "social security", "social-security")

# Ours: how far back a context word may stand, and what it adds to a score.
CONTEXT_WORDS_BACK = 5
CONTEXT_BOOST = 0.35

# Hits walked at a time when offsets are added up, and characters looked at before
# a hit at first.
BLOCK = 500
WINDOW = 200

SPAN_TYPE = "array<struct<entity:string,start:int,stop:int,score:double>>"
EMPTY_SPANS = f"CAST(array() AS {SPAN_TYPE})"


@dataclass(frozen=True)
class Rule:
    """One shape of personal data.

    ``needs`` is a cheap test that every hit passes (a character class), so that
    most texts never meet the pattern. ``check`` names a check-digit test.
    """

    name: str
    entity: str
    pattern: str
    score: float
    context: tuple[str, ...] = ()
    check: str | None = None
    needs: str = "[0-9]"


# Patterns from public formats, apart from the two SSN shapes above.
CARD_PATTERN = r"\b[0-9](?:[ -]?[0-9]){12,15}\b"
RULES: tuple[Rule, ...] = (
    Rule(
        "email",
        "EMAIL_ADDRESS",
        r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b",
        1.0,
        needs="@",
    ),
    Rule("card", "CREDIT_CARD", CARD_PATTERN, 1.0, check="luhn"),
    Rule(
        "phone",
        "PHONE_NUMBER",
        r"(?:\+[0-9]{1,2}[ .-]?)?(?:\([0-9]{3}\) ?|\b[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}\b",
        0.4,
    ),
    Rule("ssn", "US_SSN", *SSN_DELIMITED, context=SSN_CONTEXT),
    Rule("ssn-nine-digits", "US_SSN", *SSN_NINE_DIGITS, context=SSN_CONTEXT),
    Rule(
        "itin",
        "US_ITIN",
        r"\b9[0-9]{2}[- ](?:5[0-9]|6[0-5]|7[0-9]|8[0-8]|9[0-24-9])[- ][0-9]{4}\b",
        0.5,
    ),
    Rule(
        "iban",
        "IBAN_CODE",
        r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        1.0,
        check="mod97",
    ),
    Rule(
        "bank",
        "US_BANK_NUMBER",
        r"\b[0-9]{8,17}\b",
        0.05,
        context=("account", "bank", "acct", "routing"),
    ),
    Rule(
        "passport",
        "US_PASSPORT",
        r"\b(?:[A-Z][0-9]{8}|[0-9]{9})\b",
        0.05,
        context=("passport",),
    ),
    Rule(
        "driver-license",
        "US_DRIVER_LICENSE",
        r"\b[A-Z][0-9]{7,12}\b",
        0.2,
        context=("driver", "license", "licence"),
    ),
    Rule("medical-license", "MEDICAL_LICENSE", r"\b[A-Z][A-Z9][0-9]{7}\b", 1.0, check="dea"),
    Rule(
        "crypto",
        "CRYPTO",
        r"\b(?:bc1[a-z0-9]{25,59}|[13][a-km-zA-HJ-NP-Z1-9]{25,34})\b",
        0.5,
    ),
)


@dataclass(frozen=True)
class RedactionSettings:
    """How to redact. ``from_options`` reads the loose text forms of it."""

    enabled: bool = True
    entities: tuple[str, ...] = DEFAULT_ENTITIES
    threshold: float = DEFAULT_THRESHOLD
    rules: tuple[Rule, ...] = RULES

    @classmethod
    def from_options(
        cls, switch: str = "on", entities: str = "", threshold: str | float | None = None
    ) -> "RedactionSettings":
        """Off is any of off, 0, false, no; a list of entities replaces the
        default one; a threshold that is not a number means the default."""
        listed = tuple(e.strip() for e in entities.split(",") if e.strip())
        try:
            floor = DEFAULT_THRESHOLD if threshold is None else float(threshold)
        except ValueError:
            floor = DEFAULT_THRESHOLD
        return cls(
            enabled=switch.strip().lower() not in OFF_WORDS,
            entities=listed or DEFAULT_ENTITIES,
            threshold=floor,
        )


def digits_only(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _mod97(hit: Column) -> Column:
    """ISO 13616: move four characters to the end, letters to 10..35, mod 97."""
    compact = F.upper(F.regexp_replace(hit, " ", ""))
    rotated = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))
    return (
        F.aggregate(
            F.filter(F.split(rotated, ""), lambda ch: ch != ""),
            F.lit(0),
            lambda acc, ch: F.when(
                ch.between("0", "9"), F.pmod(acc * 10 + F.ascii(ch) - 48, F.lit(97))
            ).otherwise(F.pmod(acc * 100 + F.ascii(ch) - 55, F.lit(97))),
        )
        == 1
    )


def _dea(hit: Column) -> Column:
    """Public check of a DEA number: (d1+d3+d5) + 2(d2+d4+d6) ends on d7."""
    d = [F.substr(hit, F.lit(i), F.lit(1)).cast("int") for i in range(3, 10)]
    return F.pmod(d[0] + d[2] + d[4] + (d[1] + d[3] + d[5]) * 2, F.lit(10)) == d[6]


def passes_check(hit: Column, check: str | None) -> Column:
    if check == "luhn":
        return F.call_function("luhn_check", digits_only(hit))
    if check == "mod97":
        return _mod97(hit)
    if check == "dea":
        return _dea(hit)
    return F.lit(True)


def pattern_hits(text: Column, pattern: str) -> Column:
    """All matches of a literal pattern as (start, stop, hit).

    Spark returns matched values but not their places, so the text is also
    split by the pattern, and the lengths of pieces and hits are added up.
    Offsets count characters (code points) from 0; ``stop`` is exclusive.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern)
    steps = F.filter(
        F.zip_with(
            pieces, hits, lambda piece, hit: F.struct(F.length(piece).alias("gap"), hit.alias("hit"))
        ),
        lambda step: step["hit"].isNotNull(),
    )
    empty = F.expr(
        "struct(0 AS pos, CAST(array() AS array<struct<start:int,stop:int,hit:string>>) AS found)"
    )

    def walk(acc: Column, step: Column) -> Column:
        start = acc["pos"] + step["gap"]
        stop = start + F.length(step["hit"])
        return F.struct(
            stop.alias("pos"),
            F.concat(
                acc["found"],
                F.array(F.struct(start.alias("start"), stop.alias("stop"), step["hit"].alias("hit"))),
            ).alias("found"),
        )

    # Appending to an array copies it, so long lists are walked in blocks and
    # the blocks are then shifted: n * BLOCK copies instead of n * n.
    def in_blocks(found: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.greatest(F.size(found), F.lit(1)) - 1) / BLOCK).cast("int")),
            lambda b: b * BLOCK + 1,
        )
        return _shift_blocks(F.transform(blocks, lambda at: F.aggregate(F.slice(found, at, F.lit(BLOCK)), empty, walk)))

    return bound(steps, in_blocks)


def _shift_blocks(walked: Column) -> Column:
    """Add to every block the length of the blocks before it, then flatten."""
    start = F.expr(
        "struct(0 AS base, CAST(array() AS array<array<struct<start:int,stop:int,hit:string>>>) AS out)"
    )

    def shift(acc: Column, block: Column) -> Column:
        moved = F.transform(
            block["found"],
            lambda h: F.struct(
                (h["start"] + acc["base"]).alias("start"),
                (h["stop"] + acc["base"]).alias("stop"),
                h["hit"].alias("hit"),
            ),
        )
        return F.struct(
            (acc["base"] + block["pos"]).alias("base"),
            F.concat(acc["out"], F.array(moved)).alias("out"),
        )

    return F.aggregate(walked, start, shift, lambda acc: F.flatten(acc["out"]))


def words_before(text: Column, start: Column, n: int = CONTEXT_WORDS_BACK) -> Column:
    """The ``n`` words before an offset, lower-cased, in reading order.

    A window is looked at first. Only where it holds no more than ``n`` words, so that
    the first of them may be cut, is all of the text before the offset.
    """
    cut = lambda part: F.split(F.rtrim(part), r"\s+")
    window = F.substr(text, F.greatest(start - WINDOW, F.lit(0)) + 1, F.least(start, F.lit(WINDOW)))
    before = bound(
        cut(window),
        lambda near: F.when((F.size(near) > n) | (start <= WINDOW), near).otherwise(cut(F.substr(text, F.lit(1), start))),
    )
    return bound(
        before, lambda w: F.lower(F.array_join(F.slice(w, F.greatest(F.size(w) - (n - 1), F.lit(1)), F.lit(n)), " "))
    )


def rule_spans(text: Column, rule: Rule, threshold: float) -> Column:
    """Spans of one rule at or over the threshold, context boost included."""
    found = pattern_hits(text, rule.pattern)
    if rule.check:
        found = F.filter(found, lambda h: F.coalesce(passes_check(h["hit"], rule.check), F.lit(False)))

    def scored(h: Column) -> Column:
        score: Column = F.lit(float(rule.score))
        if rule.context and rule.score < 1.0:
            near = words_before(text, h["start"])
            seen = F.lit(False)
            for word in rule.context:
                seen = seen | near.contains(word)
            score = F.when(seen, F.lit(min(1.0, round(rule.score + CONTEXT_BOOST, 6)))).otherwise(score)
        return F.struct(
            F.lit(rule.entity).alias("entity"),
            h["start"].alias("start"),
            h["stop"].alias("stop"),
            score.alias("score"),
        )

    spans = F.transform(found, scored)
    if rule.score < threshold:
        spans = F.filter(spans, lambda s: s["score"] >= threshold)
    gate = text.rlike(rule.pattern)
    if rule.score < threshold:
        # A weak shape can only count beside one of its context words.
        # Words of one context may stand on two lines.
        gate = gate & text.rlike("(?iu)" + "|".join(c.replace(" ", r"\s+") for c in rule.context))
    return F.when(gate, spans.cast(SPAN_TYPE)).otherwise(F.expr(EMPTY_SPANS))


def active_rules(settings: RedactionSettings) -> list[Rule]:
    """Rules that can still produce a span under these settings."""
    return [
        r
        for r in settings.rules
        if r.entity in settings.entities
        and (
            r.score >= settings.threshold
            or (r.context and r.score + CONTEXT_BOOST >= settings.threshold)
        )
    ]


def text_spans(text: Column, settings: RedactionSettings = RedactionSettings()) -> Column:
    """Every hit of every active rule, before overlaps are resolved."""
    groups: dict[str, list[Column]] = {}
    for rule in active_rules(settings):
        groups.setdefault(rule.needs, []).append(rule_spans(text, rule, settings.threshold))
    parts = [
        F.when(text.rlike(needs), F.concat(*spans)).otherwise(F.expr(EMPTY_SPANS))
        for needs, spans in groups.items()
    ]
    return F.concat(*parts) if parts else F.expr(EMPTY_SPANS)


def resolve_spans(spans: Column) -> Column:
    """A non-overlapping subset: higher score, then longer, then leftmost."""
    kept = "CAST(array() AS array<struct<start:int,stop:int,entity:string,score:double>>)"

    def slim(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            s["entity"].alias("entity"),
            s["score"].alias("score"),
        )

    by_place = F.sort_array(F.transform(spans, slim))
    ranked = F.sort_array(
        F.transform(
            spans,
            lambda s: F.struct(
                (-s["score"]).alias("r1"),
                (s["start"] - s["stop"]).alias("r2"),
                s["start"].alias("start"),
                s["stop"].alias("stop"),
                s["entity"].alias("entity"),
                s["score"].alias("score"),
            ),
        )
    )

    def keep(acc: Column, s: Column) -> Column:
        clash = F.exists(acc, lambda a: (a["start"] < s["stop"]) & (s["start"] < a["stop"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(slim(s))))

    # Most texts have no overlap: then the sorted list is the answer.
    clear = F.forall(
        F.zip_with(
            by_place,
            F.slice(by_place, F.lit(2), F.greatest(F.size(by_place), F.lit(1))),
            lambda a, b: b["start"].isNull() | (b["start"] >= a["stop"]),
        ),
        lambda ok: ok,
    )
    return F.when(clear, by_place).otherwise(F.sort_array(F.aggregate(ranked, F.expr(kept), keep)))


def replace_spans(text: Column, resolved: Column) -> Column:
    """Text with every (sorted, non-overlapping) span replaced by ``[ENTITY]``."""
    from_here = F.concat(F.array(F.lit(0)), F.transform(resolved, lambda s: s["stop"]))
    parts = F.zip_with(
        from_here,
        resolved,
        lambda at, s: F.when(s["start"].isNull(), F.substr(text, at + 1)).otherwise(
            F.concat(F.substr(text, at + 1, s["start"] - at), F.lit("["), s["entity"], F.lit("]"))
        ),
    )
    return F.array_join(parts, "")


def count_entities(spans: Column) -> Column:
    """Hits per entity as a map; empty when there are none."""
    entities = F.sort_array(F.array_distinct(F.transform(spans, lambda s: s["entity"])))
    return F.map_from_entries(
        F.transform(
            entities,
            lambda e: F.struct(
                e.alias("key"), F.size(F.filter(spans, lambda s: s["entity"] == e)).alias("value")
            ),
        )
    )


def card_shapes_only(text: Column) -> Column:
    """How many card-shaped numbers fail the check digit (and so stay)."""
    return F.when(
        text.rlike("[0-9]") & text.rlike(CARD_PATTERN),
        F.size(
            F.filter(
                F.regexp_extract_all(text, F.lit(CARD_PATTERN), F.lit(0)),
                lambda hit: ~F.call_function("luhn_check", digits_only(hit)),
            )
        ),
    ).otherwise(F.lit(0))
