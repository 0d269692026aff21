"""Chat memory: recent turns, expiry, and lasting facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.ranking import STRETCH, position_in_group, stretches

# How long turns live, how many are read back, how many facts.
TURN_DAYS = 7
LAST_K = 5
NEWEST_FACTS = 200
TOP_FACTS = 5
FACT_BATCH = 5
KEPT_ROLES = ("user", "assistant")
MIN_FACT_WORD = 3

# Ours: what a user says of themselves, and how it is kept, in the third person.
FACT_PATTERNS: tuple[tuple[str, str], ...] = (
    (r"(?iu)\bmy name is ([\p{L}][\p{L}' -]*[\p{L}])", "The user's name is {}"),
    (r"(?iu)\bmy badge number is ([\p{L}\p{N}-]+)", "The user's badge number is {}"),
    (r"(?iu)\bmy supervisor is ([\p{L}][\p{L}' -]*[\p{L}])", "The user's supervisor is {}"),
    (r"(?iu)\bi work in (?:the )?([\p{L}][\p{L} -]*[\p{L}])", "The user works in {}"),
    (r"(?iu)\bi prefer ([^.!?\n]*[^.!?\s])", "The user prefers {}"),
)


def append_turns(messages: DataFrame) -> DataFrame:
    """Messages with text as turns: (…, ``expires_at``) seven days on."""
    return messages.filter(F.coalesce(F.col("text"), F.lit("")) != "").withColumn(
        "expires_at", F.col("ts") + F.expr(f"INTERVAL {TURN_DAYS} DAYS")
    )


def last_k_turns(turns: DataFrame, k: int = LAST_K, keys: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """The newest ``2k`` messages per session, oldest first in ``position``.

    The cut comes before the role filter, so other roles use up places. Row
    numbers with a limit are cut on each side of the shuffle, so a session of
    any length sends at most ``2k`` rows per task.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc("seq"))
    in_order = Window.partitionBy(*keys).orderBy("seq")
    return (
        turns.withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= 2 * k)
        .drop("_n")
        .withColumn("role", F.lower("role"))
        .filter(F.col("role").isin(*KEPT_ROLES))
        .withColumn("position", F.row_number().over(in_order))
    )


def expire_turns(turns: DataFrame, now: Column) -> DataFrame:
    """Rows past ``expires_at`` leave. Rows without one (facts) never do."""
    return turns.filter(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def extract_facts(turns: DataFrame, patterns: tuple[tuple[str, str], ...] = FACT_PATTERNS) -> DataFrame:
    """(actor_id, seq, fact_no, text): facts in user turns, by phrase patterns.

    Other roles are dropped first, so nothing an assistant says becomes a fact.
    """

    def found(pattern: str, template: str) -> Column:
        before, after = template.split("{}")
        return F.transform(
            F.regexp_extract_all("text", F.lit(pattern), F.lit(1)),
            lambda value: F.concat(F.lit(before), value, F.lit(after)),
        )

    said = turns.filter(F.lower("role") == "user")
    return said.select(
        "actor_id",
        "seq",
        F.posexplode_outer(F.concat(*[found(p, t) for p, t in patterns])).alias("fact_no", "text"),
    ).filter(F.col("text").isNotNull())


def parse_fact_batches(batches: DataFrame) -> DataFrame:
    """Stored extractor output ``[{"content": ...}]`` as one row per fact.

    Output that is not such a list gives none.
    """
    carried = [c for c in batches.columns if c != "facts_json"]
    return (
        batches.select(
            *carried,
            F.posexplode_outer(F.from_json("facts_json", schemas.FACT_BATCH)).alias("fact_no", "f"),
        )
        .select(*carried, "fact_no", F.col("f.content").alias("text"))
        .filter(F.col("text").isNotNull())
    )


def add_facts(new: DataFrame, facts: DataFrame) -> DataFrame:
    """New facts that are not known yet, one per (actor, text), the earliest.

    All stored facts are looked at; the reference looks at the newest 200 only,
    so there an older copy can come in again.
    """
    fresh = new.groupBy("actor_id", "text").agg(F.min("seq").alias("seq"))
    return fresh.join(facts.select("actor_id", "text"), ["actor_id", "text"], "left_anti").select(
        "actor_id", "seq", "text"
    )


def rank_facts(queries: DataFrame, facts: DataFrame, k: int = TOP_FACTS) -> DataFrame:
    """(query_id, rank, score, text): the best facts for every query.

    Of the actor's newest 200 facts, by how many query words they hold as
    substrings; ties newest first, and facts without any still fill places.
    Per actor at most 200 facts are kept before and after the shuffle, and a
    query then ranks them inside its own row.
    """
    k = k or TOP_FACTS
    newest = Window.partitionBy("actor_id").orderBy(F.desc("seq"))
    remembered = (
        facts.select("actor_id", "seq", "text")
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= NEWEST_FACTS)
        .groupBy("actor_id")
        .agg(F.collect_list(F.struct("seq", F.col("text").alias("fact"), F.lower("text").alias("low"))).alias("facts"))
    )
    asked = queries.select(
        "query_id",
        "actor_id",
        F.array_distinct(
            F.filter(
                F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)),
                lambda w: F.length(w) >= MIN_FACT_WORD,
            )
        ).alias("query_words"),
    )
    scored = asked.join(remembered, "actor_id").select(
        "query_id",
        F.slice(
            F.sort_array(
                F.transform(
                    "facts",
                    lambda f: F.struct(
                        F.size(F.filter("query_words", lambda w: F.contains(f["low"], w))).alias("score"),
                        f["seq"].alias("seq"),
                        f["fact"].alias("fact"),
                    ),
                ),
                asc=False,
            ),
            1,
            k,
        ).alias("best"),
    )
    return scored.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "b.score", F.col("b.fact").alias("text")
    )


def fact_batches(turns: DataFrame, n: int = FACT_BATCH, keys: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """(keys, batch_no, turns, text): user turns, ``n`` at a time, in order.

    Places are found per even stretch of (keys, seq) and carried over, so one
    endless session does not end up in one task, whatever its order keys are.
    """
    said = turns.filter(F.lower("role") == "user").select(*keys, "seq", "text")
    placed = position_in_group(stretches(said, keys, [F.col("seq")]), keys, [F.col("seq")], F.col(STRETCH))
    batch = F.floor((F.col("position") - 1) / n).cast("bigint")
    return (
        placed.withColumn("batch_no", batch)
        .groupBy(*keys, "batch_no")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "text"))).alias("t"))
        .select(
            *keys,
            "batch_no",
            F.size("t").alias("turns"),
            F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text"),
        )
    )
