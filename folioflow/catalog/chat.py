"""Queries over conversations and events: memory, screening, calls, limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import inputs
from folioflow.catalog.registry import query
from folioflow.functions import pii
from folioflow.operators import limits, memory, route, screen, toolcalls
from folioflow.session import new_run_folder
from folioflow.streaming import streams

_EMAIL, _PHONE = (next(r.pattern for r in pii.RULES if r.name == name) for name in ("email", "phone"))

_LAST = """
SELECT session_id, role, text, seq,
       (row_number() OVER (PARTITION BY session_id ORDER BY seq))::INT AS position
FROM (SELECT conv_id AS session_id, turn AS seq, role, text FROM conversations
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4)
WHERE role IN ('user', 'assistant')
"""


@query("last_k_turns", _LAST)
def last_k_turns(spark: SparkSession, folder: str) -> DataFrame:
    return memory.last_k_turns(inputs.turns(spark, folder), 2).select(
        "session_id", "role", "text", "seq", "position"
    )


@query(
    "append_turns",
    """
SELECT conv_id AS session_id, turn AS seq, role, text,
       TIMESTAMP '2024-01-08' + to_hours(conv_id) + to_minutes(turn) AS expires_at
FROM conversations WHERE coalesce(text, '') <> ''
""",
)
def append_turns(spark: SparkSession, folder: str) -> DataFrame:
    return memory.append_turns(inputs.turns(spark, folder)).select(
        "session_id", "seq", "role", "text", F.col("expires_at").cast("timestamp_ntz").alias("expires_at")
    )


@query(
    "expire_turns",
    """
SELECT conv_id AS session_id, turn AS seq FROM conversations
WHERE TIMESTAMP '2024-01-08' + to_hours(conv_id) + to_minutes(turn) > TIMESTAMP '2024-01-10'
""",
)
def expire_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = memory.append_turns(inputs.turns(spark, folder))
    return memory.expire_turns(turns, F.lit("2024-01-10").cast("timestamp")).select("session_id", "seq")


@query(
    "rank_facts",
    """
WITH f AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
q AS (SELECT conv_id * 1000 + turn AS query_id, conv_id,
        list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) > 2)) AS words
      FROM conversations WHERE role = 'assistant'),
s AS (SELECT query_id, f.turn, f.text, len(list_filter(words, lambda w: contains(lower(f.text), w)))::INT AS score
      FROM q JOIN f USING (conv_id))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, turn DESC))::INT AS rank, score, text
FROM s QUALIFY rank <= 5
""",
)
def rank_facts(spark: SparkSession, folder: str) -> DataFrame:
    """User turns are the facts, and assistant turns ask for them."""
    turns = inputs.turns(spark, folder)
    asked = turns.filter(F.col("role") == "assistant").select(
        (F.col("actor_id") * 1000 + F.col("seq")).alias("query_id"), "actor_id", "text"
    )
    return memory.rank_facts(asked, turns.filter(F.col("role") == "user"))


@query(
    "fact_batches",
    """
WITH u AS (SELECT conv_id, turn, text, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2 AS b
           FROM conversations WHERE role = 'user')
SELECT conv_id AS session_id, b::BIGINT AS batch_no, count(*)::INT AS turns, string_agg(text, chr(10) ORDER BY turn) AS text
FROM u GROUP BY 1, 2
""",
)
def fact_batches(spark: SparkSession, folder: str) -> DataFrame:
    return memory.fact_batches(inputs.turns(spark, folder), 2)


_SAID = {
    "My name is {a} Ka": "The user''s name is {a} Ka",
    "My badge number is {n}": "The user''s badge number is {n}",
    "My supervisor is {a} Lo": "The user''s supervisor is {a} Lo",
    "I work in the {a} hall": "The user works in {a} hall",
    "I prefer {a} and tea": "The user prefers {a} and tea",
}


@query(
    "extract_facts",
    "WITH t AS (SELECT conv_id, turn, 'Mr ' || translate(conv_id || 'x' || turn, '0123456789', 'abcdefghij') AS a, conv_id || '-' || turn AS n FROM conversations WHERE role = 'user')"
    + " UNION ALL ".join(
        f"\nSELECT conv_id AS actor_id, turn AS seq, 0 AS fact_no, replace(replace('{fact}', '{{a}}', a), '{{n}}', n) AS text FROM t WHERE (conv_id + turn) % 5 = {i}"
        for i, fact in enumerate(_SAID.values())
    ),
)
def extract_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn says one of five things of its speaker; only users' become facts."""
    number = F.concat_ws("-", "actor_id", "seq")
    name = F.concat(F.lit("Mr "), F.translate(F.concat_ws("x", "actor_id", "seq"), "0123456789", "abcdefghij"))
    kinds = [F.replace(F.replace(F.lit(said), F.lit("{a}"), name), F.lit("{n}"), number) for said in _SAID]
    said = F.concat(F.element_at(F.array(*kinds), ((F.col("actor_id") + F.col("seq")) % 5).cast("int") + 1), F.lit(". "), "text")
    return memory.extract_facts(inputs.turns(spark, folder).withColumn("text", said))


@query(
    "parse_fact_batches",
    "SELECT conv_id AS actor_id, turn AS seq, 0 AS fact_no, text FROM conversations WHERE role <> 'system'",
)
def parse_fact_batches(spark: SparkSession, folder: str) -> DataFrame:
    """System turns stand for output that is not a list of facts."""
    good = F.to_json(F.array(F.struct(F.col("text").alias("content"))))
    batches = inputs.turns(spark, folder).select(
        "actor_id", "seq", F.when(F.col("role") == "system", F.col("text")).otherwise(good).alias("facts_json")
    )
    return memory.parse_fact_batches(batches)


@query(
    "add_facts",
    """
SELECT user_id AS actor_id, min(event_id) AS seq, event_type AS text FROM events
WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE value >= 60) GROUP BY 1, 3
""",
)
def add_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Types of event per user; those of dear events are known already."""
    seen = inputs.events(spark, folder).select(
        F.col("user_id").alias("actor_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("text"), "value"
    )
    return memory.add_facts(seen.drop("value"), seen.filter(F.col("value") >= 60))


@query("stream_last_k", _LAST)
def stream_last_k(spark: SparkSession, folder: str) -> DataFrame:
    """The history kept by the stream after all turns have arrived."""
    arriving = streams.table_stream(spark, folder, "conversations").select(
        F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), "role", "text"
    )
    out = new_run_folder(spark, "history")
    streams.run_available(
        streams.stream_last_k(arriving, 2),
        new_run_folder(spark, "state"),
        lambda batch, _: batch.write.mode("append").parquet(out),
        "update",
    )
    return spark.read.schema(streams.HISTORY).parquet(out).select(
        F.col("session_id").cast("bigint").alias("session_id"), "role", "text", "seq", "position"
    )


@query(
    "stream_turns",
    """
WITH t AS (SELECT *, TIMESTAMP '2024-01-01' + to_hours(3 * conv_id) + to_minutes(turn) AS ts FROM conversations WHERE coalesce(text, '') <> '')
SELECT conv_id AS session_id, turn AS seq, role, text FROM t WHERE ts > (SELECT max(ts) FROM t) - INTERVAL 7 DAYS
""",
)
def stream_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns that are appended and have not expired, after all have arrived in any order."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    turns = inputs.turns(spark, folder).select(
        "session_id", "seq", "role", "text",
        (start + F.make_dt_interval(F.lit(0), (3 * F.col("session_id")).cast("int"), F.col("seq").cast("int"))).alias("ts"),
    )
    out, state = new_run_folder(spark, "turns"), new_run_folder(spark, "state")
    waves = [turns.filter(F.pmod(F.xxhash64("session_id", "seq"), F.lit(3)) == n) for n in range(3)]
    streams.in_waves(
        waves,
        lambda arriving: streams.run_available(
            streams.turn_events(arriving), state, lambda rows, _: rows.write.mode("append").parquet(out), timers=True
        ),
    )
    live = streams.live_turns(spark.read.schema(streams.TURN_EVENTS).parquet(out))
    return live.withColumn("session_id", F.col("session_id").cast("bigint"))


_WORD_ROWS = ", ".join(f"('{w}', '{a}', {n})" for w, a, n in route.ROUTE_WORDS)
_HITS = route.ROUTE_PRECEDENCE[0][0]


@query(
    "route_requests",
    rf"""
WITH rule(word, area, weight) AS (VALUES {_WORD_ROWS}),
numbered AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS i FROM (SELECT DISTINCT word FROM rule)),
asked(i, more) AS (VALUES (0, 'send a jabber to Ka'), (1, 'wear protective equipment'), (2, ''), (3, 'which ppe for the schedule'), (4, 'open a new ticket')),
message AS (
  SELECT doc_id AS msg_id, lower(text || ' ' || a.word || ' ' || b.word || ' ' || more) AS low
  FROM documents
  JOIN numbered a ON a.i = doc_id % (SELECT count(*) FROM numbered)
  JOIN numbered b ON b.i = doc_id * 7 % (SELECT count(*) FROM numbered)
  JOIN asked ON asked.i = CASE WHEN doc_id % 3 = 0 THEN doc_id // 3 % 5 ELSE 2 END),
token AS (SELECT msg_id, unnest(list_distinct(regexp_extract_all(low, '\p{{L}}+'))) AS word FROM message),
scored AS (SELECT msg_id, area, sum(weight)::INT AS score FROM token JOIN rule USING (word) GROUP BY ALL),
every AS (
  SELECT msg_id, low, area, coalesce(score, 0) AS score FROM message CROSS JOIN (SELECT DISTINCT area FROM rule)
  LEFT JOIN scored USING (msg_id, area)),
judged AS (
  SELECT *, regexp_matches(low, '{_HITS}', 's') AS acts, regexp_matches(low, '\bppe\b|protective equipment') AS protective FROM every),
taken AS (
  SELECT msg_id, area AS route, score, acts, CASE
    WHEN acts THEN area = 'operations' WHEN area = 'safety' THEN score >= 2 OR protective
    WHEN area = 'operations' THEN score >= 2 AND NOT protective ELSE score >= 2 END AS yes
  FROM judged)
SELECT msg_id, route, score FROM taken WHERE yes
UNION ALL
SELECT msg_id, 'web', 0 FROM taken GROUP BY msg_id HAVING NOT bool_or(yes)
""",
)
def route_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that end with two words of the rules, and some with a request."""
    words = sorted({w for w, _, _ in route.ROUTE_WORDS})
    more = ["send a jabber to Ka", "wear protective equipment", "", "which ppe for the schedule", "open a new ticket"]
    key = F.col("doc_key")
    pick = lambda listed, at: F.element_at(F.array(*[F.lit(x) for x in listed]), at.cast("int") + 1)
    asked = inputs.documents(spark, folder).select(
        key.alias("msg_id"),
        F.concat_ws(
            " ",
            F.col("text"),
            pick(words, key % len(words)),
            pick(words, key * 7 % len(words)),
            F.when(key % 3 == 0, pick(more, F.floor(key / 3) % 5)).otherwise(""),
        ).alias("text"),
    )
    return route.route_requests(asked).select("msg_id", "route", "score")


@query(
    "split_greetings",
    "SELECT conv_id, turn, role = 'user' AS small_talk FROM conversations",
)
def split_greetings(spark: SparkSession, folder: str) -> DataFrame:
    """Users greet; the others say the same with more after it."""
    said = inputs.turns(spark, folder).select(
        F.col("session_id").alias("conv_id"),
        F.col("seq").alias("turn"),
        F.when(F.col("role") == "user", F.lit(" Good  morning everyone!? "))
        .otherwise(F.concat(F.lit("Good morning everyone! "), "text"))
        .alias("text"),
    )
    small, rest = route.split_greetings(said)
    return small.select("conv_id", "turn", F.lit(True).alias("small_talk")).unionByName(
        rest.select("conv_id", "turn", F.lit(False).alias("small_talk"))
    )


_PHRASES = [(c.category, p, c.on_input, c.on_output) for c in screen.SCREENS for p in c.phrases]
_RULE_ROWS = ", ".join(f"({i}, '{c}', '{p}', {str(a).lower()}, {str(b).lower()})" for i, (c, p, a, b) in enumerate(_PHRASES))
_SCREENED = rf"""
WITH planted(i, category, phrase, on_input, on_output) AS (VALUES {_RULE_ROWS}),
rule AS (
  SELECT category, ' ' || array_to_string(regexp_extract_all(lower(phrase), '[\p{{L}}\p{{N}}]+'), ' ') AS phrase, on_input, on_output FROM planted
  UNION ALL
  SELECT 'ITEM', ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')[1:4], ' '), true, item_id % 2 = 0 FROM benchmark),
said AS (
  SELECT doc_id AS msg_id, CASE WHEN doc_id % 4 = 0 THEN 'Ka. ' || upper(phrase) || 's; ' || text ELSE text END AS text
  FROM documents JOIN planted ON i = doc_id // 4 % {len(_PHRASES)}
  UNION ALL
  SELECT -1 - conv_id * 1000 - turn, text FROM conversations),
norm AS (SELECT msg_id, text, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), ' ') || ' ' AS words FROM said),
met AS (SELECT msg_id, list_sort(list_distinct(list(category))) AS c FROM norm JOIN rule ON contains(words, phrase) AND {{side}} GROUP BY msg_id)
"""


def _screening(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Messages, a fourth of the documents with a phrase in other letters, and rules:
    those of the library, and the first words of each benchmark item."""
    items = inputs.questions(spark, folder).select(
        F.lit("ITEM").alias("category"),
        F.array_join(F.slice(F.regexp_extract_all("text", F.lit(screen.WORD), F.lit(0)), 1, 4), " ").alias("phrase"),
        F.lit(True).alias("on_input"),
        (F.col("id") % 2 == 0).alias("on_output"),
    )
    phrase = F.element_at(F.array(*[F.lit(p) for _, p, _, _ in _PHRASES]), (F.floor(F.col("doc_key") / 4) % len(_PHRASES)).cast("int") + 1)
    planted = F.concat(F.lit("Ka. "), F.upper(phrase), F.lit("s; "), F.col("text"))
    said = inputs.documents(spark, folder).select(
        F.col("doc_key").alias("msg_id"), F.when(F.col("doc_key") % 4 == 0, planted).otherwise(F.col("text")).alias("text")
    )
    turns = inputs.turns(spark, folder).select((-1 - F.col("session_id") * 1000 - F.col("seq")).alias("msg_id"), "text")
    return said.unionByName(turns), screen.rule_table(spark).unionByName(items)


@query(
    "screen_input",
    _SCREENED.replace("{side}", "on_input")
    + """SELECT msg_id, coalesce(array_to_string(c, ','), '') AS categories, c IS NOT NULL AS blocked,
       CASE WHEN c IS NULL THEN text ELSE 'Sorry, I can''t help with that request.' END AS text
FROM norm LEFT JOIN met USING (msg_id)""",
)
def screen_input(spark: SparkSession, folder: str) -> DataFrame:
    said, rules = _screening(spark, folder)
    return screen.screen_input(said, rules).select("msg_id", F.array_join("categories", ",").alias("categories"), "blocked", "text")


@query(
    "screen_output",
    _SCREENED.replace("{side}", "on_output")
    + rf"""SELECT msg_id, c IS NOT NULL AS blocked, CASE WHEN c IS NOT NULL THEN 'Sorry, I can''t provide that response.' ELSE
       regexp_replace(regexp_replace(regexp_replace(text, '{pii.SSN_DELIMITED[0]}', '{{US_SOCIAL_SECURITY_NUMBER}}', 'g'),
         '{_PHONE}', '{{PHONE}}', 'g'), '{_EMAIL}', '{{EMAIL}}', 'g') END AS text
FROM norm LEFT JOIN met USING (msg_id)""",
)
def screen_output(spark: SparkSession, folder: str) -> DataFrame:
    """The texts hold e-mails and telephone numbers of their own."""
    said, rules = _screening(spark, folder)
    return screen.screen_output(said, rules).select("msg_id", "blocked", "text")


@query(
    "fold_assessments",
    """
SELECT event_id AS msg_id, event_type IN ('click', 'error') AS blocked,
       CASE event_type WHEN 'view' THEN 'masked ' || props WHEN 'click' THEN 'refused' ELSE props END AS decided_text
FROM events
""",
)
def fold_assessments(spark: SparkSession, folder: str) -> DataFrame:
    """Views are masked, clicks blocked beside an odd number, errors unreadable,
    sign-ups blocked without intervention; purchases pass."""
    policy = '"assessments": [{"usage": 3, "topicPolicy": {"n": 1, "topics": [{"action": "%s"}]}}]}'
    outputs = F.concat(F.lit('{"action": "GUARDRAIL_INTERVENED", "outputs": ['), F.to_json(F.struct(F.concat(F.lit("masked "), "props").alias("text"))), F.lit("], " + policy % "ANONYMIZED"))
    response = (
        F.when(F.col("event_type") == "view", outputs)
        .when(F.col("event_type") == "click", F.lit('{"action": "GUARDRAIL_INTERVENED", "outputs": [{"text": "refused"}], ' + policy % "BLOCKED"))
        .when(F.col("event_type") == "error", F.lit('{"action": '))
        .when(F.col("event_type") == "signup", F.lit('{"action": "NONE", ' + policy % "BLOCKED"))
        .otherwise(F.lit('{"action": "NONE"}'))
    )
    given = inputs.events(spark, folder).select(
        F.col("event_id").alias("msg_id"), F.col("props").alias("text"), response.alias("response_json")
    )
    return screen.fold_assessments(given).select("msg_id", "blocked", "decided_text")


@query(
    "recover_tool_calls",
    """
SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'ask_hr' END AS tool_name,
       CASE WHEN role = 'assistant' THEN text || ' it''s' END AS question
FROM conversations
""",
)
def recover_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Assistants leak calls with a bad escape; users leak one with a number."""
    asked = F.replace(F.to_json(F.struct(F.concat(F.col("text"), F.lit(" it~s")).alias("question"))), F.lit("~"), F.lit("\\'"))
    params = F.when(F.col("role") == "user", F.lit('{"question": 7}')).otherwise(asked)
    leaked = F.concat(F.lit('Sure: {"name": "ask_hr",\n "parameters": '), params, F.lit("} done"))
    said = inputs.turns(spark, folder).select(
        F.col("session_id").alias("conv_id"), F.col("seq").alias("turn"),
        F.when(F.col("role") == "system", F.col("text")).otherwise(leaked).alias("text"),
    )
    return route.recover_tool_calls(said).select("conv_id", "turn", "tool_name", "question")


@query(
    "document_context",
    """
WITH s AS (SELECT conv_id, turn, '--- ' || CASE role WHEN 'user' THEN 'What the image "t' || turn || '" shows'
         ELSE 'Contents of "t' || turn || '"' END || ' ---' || chr(10)
         || CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || chr(10) || '[...truncated...]' ELSE text END AS section
       FROM conversations)
SELECT conv_id AS question_id, string_agg(section, chr(10) || chr(10) ORDER BY turn) || chr(10) || chr(10)
       || '--- Question ---' || chr(10) || 'What is in ' || conv_id || '?' AS prompt
FROM s GROUP BY conv_id
""",
)
def document_context(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.turns(spark, folder)
    attached = turns.select(
        F.col("session_id").alias("question_id"), F.col("seq").alias("position"), "text",
        F.concat(F.lit("t"), F.col("seq").cast("string")).alias("filename"),
        F.when(F.col("role") == "user", "vision").otherwise("pdf-text").alias("extractor"),
    )
    asked = turns.select(F.col("session_id").alias("question_id")).distinct().withColumn(
        "question", F.concat_ws("", F.lit("What is in "), "question_id", F.lit("?"))
    )
    return route.document_context(asked, attached, 100)


@query(
    "validate_calls",
    """
SELECT event_id AS call_id, CASE
  WHEN event_type = 'error' THEN 'tool name has no ___' WHEN event_type = 'signup' THEN 'Unknown tool: restart_line'
  WHEN event_type = 'purchase' AND value < 20 THEN 'missing: summary'
  WHEN event_type = 'view' AND value < 20 THEN 'missing: message' END AS reason
FROM events
""",
)
def validate_calls(spark: SparkSession, folder: str) -> DataFrame:
    valid, errors = toolcalls.validate_calls(inputs.tool_calls(spark, folder))
    return valid.select("call_id", F.lit(None).cast("string").alias("reason")).unionByName(
        errors.select("call_id", "reason")
    )


@query(
    "ticket_rows",
    """
SELECT event_id AS call_id, 'SMAX-' || upper(md5(event_id::VARCHAR)) AS ticket_id, 'created' AS status,
  event_type AS category, props || CASE WHEN value >= 50 THEN ' (user=' || user_id || ', day=' || strftime(ts, '%Y-%m-%d') || ')' ELSE '' END AS summary
FROM events WHERE event_type = 'purchase' AND value >= 20
""",
)
def ticket_rows(spark: SparkSession, folder: str) -> DataFrame:
    return toolcalls.ticket_rows(toolcalls.validate_calls(inputs.tool_calls(spark, folder))[0])


@query(
    "calendar_lookup",
    """
WITH e AS (SELECT user_id, ts::DATE AS date, string_agg(event_type, chr(10) ORDER BY event_id) AS events
           FROM events WHERE event_type <> 'signup' GROUP BY 1, 2)
SELECT event_id AS request_id, coalesce(events, 'No events found for ' || ts::DATE || '.') AS answer
FROM events s LEFT JOIN e ON s.user_id = e.user_id AND s.ts::DATE = e.date WHERE event_type = 'signup'
""",
)
def calendar_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups ask for their user's other events of the day."""
    events = inputs.events(spark, folder).withColumn("date", F.to_date("ts"))
    asked = events.filter(F.col("event_type") == "signup").select(F.col("event_id").alias("request_id"), "user_id", "date")
    days = events.filter(F.col("event_type") != "signup").select(
        "user_id", "date", F.col("event_id").alias("position"), F.col("event_type").alias("event")
    )
    return toolcalls.calendar_lookup(asked, days, ("user_id", "date"))


@query(
    "trace_calls",
    "SELECT event_id, 'Called tool: `' || event_type || '`' AS trace FROM events WHERE value >= 20",
)
def trace_calls(spark: SparkSession, folder: str) -> DataFrame:
    named = F.to_json(F.struct(F.struct(F.struct(F.struct(F.struct(F.col("event_type").alias("name")).alias("toolUse")).alias("start")).alias("contentBlockStart")).alias("event")))
    events = inputs.events(spark, folder).withColumn("props", F.when(F.col("value") >= 20, named).otherwise(F.col("props")))
    return toolcalls.trace_calls(events).select("event_id", "trace")


@query(
    "trace_by_request",
    """
SELECT user_id, line_id, request_id FROM (
  SELECT user_id, event_id AS line_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_type <> 'signup', event_id ROWS UNBOUNDED PRECEDING) AS request_id FROM events)
WHERE event_type <> 'signup' AND request_id IS NOT NULL
""",
)
def trace_by_request(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.events(spark, folder)
    return toolcalls.trace_by_request(
        events.filter(F.col("event_type") != "signup").select("user_id", "ts", F.col("event_id").alias("line_id")),
        events.filter(F.col("event_type") == "signup").select("user_id", "ts", F.col("event_id").alias("request_id")),
    ).select("user_id", "line_id", "request_id")


@query(
    "rate_limit",
    """
SELECT user_id AS key, event_id, in_window FROM (
  SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTES PRECEDING AND CURRENT ROW) AS in_window
  FROM events) WHERE in_window > 2
""",
)
def rate_limit(spark: SparkSession, folder: str) -> DataFrame:
    requests = inputs.events(spark, folder).select(F.col("user_id").alias("key"), "ts", "event_id")
    return limits.rate_limit(requests, 2, 60).select("key", "event_id", "in_window")


@query(
    "rate_limit_stream",
    """
WITH kept AS (SELECT user_id AS key, ts FROM events WHERE NOT (event_id % 10 = 7 AND ts < TIMESTAMP '2024-01-10')),
opened AS (SELECT key, unnest([floor(epoch(ts) / 900)::BIGINT * 900 - 900 * k FOR k IN range(4)]) AS s FROM kept)
SELECT key, make_timestamp(s * 1000000) AS window_start, make_timestamp((s + 3600) * 1000000) AS window_end, count(*) AS requests
FROM opened GROUP BY key, s HAVING count(*) > 2
""",
)
def rate_limit_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of an hour. Requests arrive in three waves, a day late at most counts:
    some of the last day before the second wave come with it and count, some of before
    the tenth come with the third, when their windows have closed, and do not."""
    requests = inputs.events(spark, folder).select(F.col("user_id").alias("key"), "ts", "event_id")
    at = lambda day: F.lit(f"2024-01-{day} 00:00:00").cast("timestamp")
    ts, digit = F.col("ts"), F.col("event_id") % 10
    wave = (
        F.when((digit == 7) & (ts < at("10")), 2)
        .when((digit == 3) & ts.between(at("14"), at("15")), 1)
        .when(ts < at("15"), 0)
        .when(ts < at("22"), 1)
        .otherwise(2)
    )
    out, state = new_run_folder(spark, "alerts"), new_run_folder(spark, "state")
    streams.in_waves(
        [requests.filter(wave == n) for n in range(3)],
        lambda arriving: streams.run_available(
            streams.rate_limit_stream(arriving, 2, 60, "15 minutes", "1 day"),
            state,
            lambda rows, _: rows.write.mode("append").parquet(out),
            "update",
        ),
    )
    naive = lambda name: F.col(name).cast("timestamp_ntz").alias(name)
    return streams.newest_alerts(spark.read.parquet(out)).select("key", naive("window_start"), naive("window_end"), "requests")


@query(
    "budget_alerts",
    """
WITH d AS (SELECT o_orderdate::DATE AS day, sum(o_totalprice) AS a FROM orders GROUP BY 1),
r AS (SELECT day, date_trunc('month', day)::DATE AS month, sum(a) OVER (PARTITION BY date_trunc('month', day) ORDER BY day) AS s FROM d),
x AS (SELECT month, day, 'ACTUAL' AS alert, 50.0::DOUBLE AS threshold, s AS amount FROM r WHERE s > 20e6
  UNION ALL SELECT month, day, 'ACTUAL', 90.0, s FROM r WHERE s > 36e6
  UNION ALL SELECT month, day, 'FORECASTED', 100.0, s * day(last_day(day)) / day(day) FROM r WHERE s * day(last_day(day)) / day(day) > 40e6)
SELECT month, alert, threshold, min(day) AS first_day, round(arg_min(amount, day), 2) AS amount FROM x GROUP BY 1, 2, 3
""",
)
def budget_alerts(spark: SparkSession, folder: str) -> DataFrame:
    spend = inputs.table(spark, folder, "orders").select(F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"))
    return limits.budget_alerts(spend, 40e6).withColumn("amount", F.round("amount", 2))


@query(
    "retention_plan",
    """
SELECT CASE event_type WHEN 'click' THEN 'uploads/' WHEN 'view' THEN 'bda-output/' ELSE 'extract-cache/' END || event_id AS key
FROM events WHERE event_type IN ('click', 'view') AND ts < TIMESTAMP '2024-01-15' - INTERVAL 1 DAY
""",
)
def retention_plan(spark: SparkSession, folder: str) -> DataFrame:
    prefix = F.when(F.col("event_type") == "click", "uploads/").when(F.col("event_type") == "view", "bda-output/").otherwise("extract-cache/")
    objects = inputs.events(spark, folder).select(
        F.concat(prefix, F.col("event_id").cast("string")).alias("key"), F.col("ts").alias("last_modified")
    )
    return limits.retention_plan(objects, F.lit("2024-01-15").cast("timestamp")).select("key")


@query(
    "purge_plan",
    """
WITH k AS (SELECT 'uploads/' || l_returnflag || '/' AS prefix, 'uploads/' || l_returnflag || '/' || l_orderkey || '-' || l_linenumber AS key
           FROM lineitem WHERE l_returnflag <> 'N')
SELECT prefix, key, ((row_number() OVER (PARTITION BY prefix ORDER BY md5(key), key) - 1) // 1000)::BIGINT AS batch_no FROM k
""",
)
def purge_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Returned and accepted lines are purged; the others share the bucket."""
    objects = inputs.table(spark, folder, "lineitem").select(
        F.concat_ws("", F.lit("uploads/"), "l_returnflag", F.lit("/"), "l_orderkey", F.lit("-"), "l_linenumber").alias("key"),
        F.concat(F.lit("uploads/"), "l_returnflag", F.lit("/")).alias("prefix"),
        "l_returnflag",
    )
    return limits.purge_plan(objects.select("key"), objects.filter(F.col("l_returnflag") != "N").select("prefix"))
