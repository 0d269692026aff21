"""Cases with known answers on small rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.pii import RedactionSettings
from folioflow.functions.ranking import position_in_group
from folioflow.functions.text import words
from folioflow.operators import cache, chunks, classify, extract, failures, limits, memory, passages, redact, route, search, screen
from folioflow.plans import ask, ingest
from folioflow.sources import sinks

NAMES = [
    ("scan.png", "image"), ("SCAN.JPG", "image"), ("photo.jpeg", "image"), ("diagram.webp", "image"),
    ("manual.pdf", "document"), ("briefing.mp3", "audio"), ("briefing.wav", "audio"),
    ("walkthrough.mp4", "video"), ("walkthrough.mov", "video"), ("dock_status.xlsx", "spreadsheet"),
    ("notes.txt", "text"), ("handler.py", "text"), ("App.tsx", "text"), ("Main.java", "text"),
    ("query.sql", "text"), ("config.yaml", "text"), ("data.csv", "text"), ("Dockerfile", "text"),
    ("prod.env", "text"), (".env", None), ("x.", None),
]


def test_classify_by_name(spark):
    files = spark.createDataFrame([(n,) for n, _ in NAMES], "filename string")
    good, bad = classify.classify_files(files)
    got = {r.filename: r.modality for r in good.collect()}
    assert got == {n: m for n, m in NAMES if m}
    reasons = {r.filename: r.reason for r in bad.collect()}
    assert set(reasons) == {".env", "x."}
    assert "no extension" in reasons[".env"]


def test_sniffing(spark):
    rows = [
        ("notes.qqq", b"Crane maintenance Tuesday.", True),
        ("archive.zip", b"PK\x03\x04\x00\x00\x00", False),
        ("empty.q", b"", True),
        ("ff.q", b"\xff", True),
        ("cut.q", b"a" * 8191 + "é".encode(), True),
        ("late.q", b"a" * 8192 + b"\x00", True),
        ("early.q", b"a" * 8191 + b"\x00", False),
        ("bad.q", b"\xff" + b"a" * 20, False),
    ]
    df = spark.createDataFrame([(n, bytearray(b)) for n, b, _ in rows], "filename string, content binary")
    got = {r.filename: r.is_text for r in classify.sniff_text(df).collect()}
    assert got == {n: t for n, _, t in rows}


LETTER = (
    "Dear tenants of Alder Court,\n\n"
    "the lift stands still from 4 March; parts (order QX/77-204) are on their way. "
    "Whoever needs help with shopping rings Priya Anand at (555) 010-4477, "
    "or writes to help+lift@alder.example.net. "
    "A deposit goes to card 4111 1111 1111 1111, never to the old one. "
    "Mr Feld, of flat 12, had his ITIN 912-78-1234 on the notice board: please take it down.\n\n"
    "With kind regards, Priya Anand"
)


def test_redaction(spark):
    rows = [
        ("a", LETTER), ("b", "   "), ("c", ""), ("d", "His social security number is 123456789 ok"),
        ("e", "part 123456789 only"), ("f", "card 4111 1111 1111 1111 and 4111 1111 1111 1112"),
        ("h", "social\nsecurity number 123456789"),
        ("g", "\U0001F600 mail a@b.co \U0001F600 end"),
    ]
    docs = spark.createDataFrame(rows, "doc_key string, text string")
    names = spark.createDataFrame([("Priya Anand",), ("Feld",), ("Priya",)], "name string")
    spans = redact.redact_person_names(docs, names)
    done = redact.redact_text(docs, extra_spans=spans)
    got = {r.doc_key: r for r in redact.redaction_gate(done, names=names).collect()}
    assert {r.doc_key: r.text for r in redact.redact_text(docs, names=names).collect()} == {k: r.text for k, r in got.items()}
    for leaked in ("Priya", "Feld", "010-4477", "alder.example.net", "4111", "912-78-1234"):
        assert leaked not in got["a"].text
    for kept in ("Alder Court", "QX/77-204", "4 March", "flat 12", "[PERSON]", "[US_SSN]", "[CREDIT_CARD]"):
        assert kept in got["a"].text
    assert got["b"].text == "   " and got["c"].text == ""
    assert got["h"].text == "social\nsecurity number [US_SSN]"
    assert got["d"].text == "His social security number is [US_SSN] ok"
    assert got["e"].text == "part 123456789 only"
    assert got["f"].text == "card [CREDIT_CARD] and 4111 1111 1111 1112" and got["f"].card_shapes == 1
    assert got["g"].text == "\U0001F600 mail [EMAIL_ADDRESS] \U0001F600 end"
    again = {r.doc_key: r.text for r in redact.redact_text(done).collect()}
    assert again == {k: r.text for k, r in got.items()}
    with pytest.raises(Exception, match="personal data left"):
        redact.redaction_gate(docs, names_required=False).collect()
    with pytest.raises(redact.RedactionUnavailable):
        redact.redaction_gate(docs, RedactionSettings(rules=()))
    with pytest.raises(redact.RedactionUnavailable):
        redact.redaction_gate(docs)


def test_names_of_any_number_of_words(spark, monkeypatch):
    texts = {
        "a": "met Maria del Carmen, then MARIA  DEL\r\nCARMEN today",
        "b": "Juan Carlos de la Vega y Soto came; Ines\u00a0Okafor too",
        "c": "Maria, del Carmen and Maria del",
        "d": "J. R. Moreno wrote; Ines Okafor-Lund did not",
        "e": "",
        "f": None,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_key string, text string")
    names = ["Maria  del Carmen", "Juan Carlos de la Vega y Soto", " Ines Okafor ", "Carlos de", "J. R. Moreno", "--", "", None]
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    for at_once in (200_000, 2):
        monkeypatch.setattr(redact, "NAMES_AT_ONCE", at_once)
        spans = redact.redact_person_names(docs, listed).collect()
        got = sorted((s.doc_key, texts[s.doc_key][s.start : s.stop]) for s in spans)
        assert got == [
            ("a", "MARIA  DEL\r\nCARMEN"), ("a", "Maria del Carmen"),
            ("b", "Ines\u00a0Okafor"), ("b", "Juan Carlos de la Vega y Soto"), ("d", "J. R. Moreno"),
        ]
    assert redact.redact_person_names(docs, listed.filter("name = '--'")).count() == 0


def test_audit_counts_with_subtotals(spark):
    rows = [(1, "mail a@b.example.com, a@c.example.com", "bda", "en"), (2, "mail a@b.example.com", "bda", None), (3, "card 4111 1111 1111 1112", "vision", "en"), (4, None, "vision", "en")]
    done = redact.redact_text(spark.createDataFrame(rows, "doc_key int, text string, extractor string, lang string"))
    got = sorted((tuple(r) for r in redact.redaction_audit(done).collect()), key=str)
    mail, card = "EMAIL_ADDRESS", "CARD_SHAPE_ONLY"
    wanted = [
        (None, None, None, 4, 3),
        (mail, None, None, 3, 2), (mail, "bda", None, 3, 2), (mail, "bda", "en", 2, 1), (mail, "bda", None, 1, 1),
        (card, None, None, 1, 1), (card, "vision", None, 1, 1), (card, "vision", "en", 1, 1),
    ]
    assert got == sorted(wanted, key=str)


def test_off_switch(spark):
    docs = spark.createDataFrame([("a", LETTER)], "doc_key string, text string")
    row = redact.redact_text(docs, RedactionSettings.from_options("OFF")).first()
    assert row.text == LETTER and row.engine == "disabled"
    assert RedactionSettings.from_options(threshold="x").threshold == 0.35


def test_flatten_results(spark):
    rows = [
        ("v", '[{"video": {"transcript": {"representation": {"text": "Walkthrough of bay 3."}}}, "chapters": [{"summary": "A welder inspects a hull seam."}]}]'),
        ("p", '[{"pages": [{"representation": {"markdown": "", "text": " one "}}, null, {"representation": null}], "audio": null}, {"pages": [{"representation": {"text": "two"}}]}]'),
        ("bad", "not json"),
    ]
    good, bad = extract.flatten_results(spark.createDataFrame(rows, "doc_key string, segments_json string"))
    got = {r.doc_key: r.text for r in good.collect()}
    assert got == {"v": "Walkthrough of bay 3.\n\nA welder inspects a hull seam.", "p": "one\n\ntwo"}
    assert [r.doc_key for r in bad.collect()] == ["bad"]


def test_cache_keys(spark):
    df = spark.createDataFrame([("a", bytearray(b"same")), ("b", bytearray(b"same")), ("c", bytearray(b"other"))], "filename string, content binary")
    plain = {r.filename: r.cache_key for r in cache.cache_keys(df).collect()}
    assert plain["a"] == plain["b"] != plain["c"]
    forms = cache.cache_keys(df, True).first().cache_key
    tables = cache.cache_keys(df, True, ("FORMS", "TABLES")).first().cache_key
    assert len({plain["a"], forms, tables}) == 3


def test_purge_batches(spark):
    keys = [f"bda-output/job/{i}.json" for i in range(1500)] + ["uploads/other/keep.pdf", "bda-output/job2/x"]
    plan = limits.purge_plan(
        spark.createDataFrame([(k,) for k in keys], "key string"),
        spark.createDataFrame([("bda-output/job/",)], "prefix string"),
    )
    sizes = {r.batch_no: r["count"] for r in plan.groupBy("batch_no").count().collect()}
    assert sizes == {0: 1000, 1: 500}


def test_purge_by_a_prefix_within_a_name(spark):
    objects = spark.createDataFrame([("uploads/abc/x",), ("uploads/b",), ("up",)], "key string")
    wanted = spark.createDataFrame([("uploads/a",), ("uploads/",), ("uploads/",), (None,)], "prefix string")
    got = {(r.prefix, r.batch_no, r.key) for r in limits.purge_plan(objects, wanted).collect()}
    assert got == {("uploads/a", 0, "uploads/abc/x"), ("uploads/", 0, "uploads/abc/x"), ("uploads/", 0, "uploads/b")}
    assert limits.purge_plan(objects, wanted.filter("false")).count() == 0


def test_rate_limit_of_a_hot_key_and_of_none(spark):
    # Key "hot" and no key at all, both with many requests at the same instants.
    times = [1_704_067_200_000_000 + 1_000_000 * (i // 7) * (1 + i % 3) + (i % 2) for i in range(2_000)]
    rows = [("hot", t) for t in times] + [(None, t) for t in times[:900]] + [("cold", times[0]), ("hot", None)]
    asked = spark.createDataFrame(rows, "key string, us bigint").select("key", F.timestamp_micros("us").alias("ts"))
    got = sorted(
        ((r.key or "", r.us, r.in_window) for r in limits.rate_limit(asked, 40, 1).select("key", F.unix_micros("ts").alias("us"), "in_window").collect())
    )
    want = []
    for key in ("hot", None):
        own = [t for k, t in rows if k == key and t is not None]
        for t in own:
            held = sum(t - 60_000_000 <= u <= t for u in own)
            if held > 40:
                want.append((key or "", t, held))
    assert got == sorted(want) and len(want) > 100


def test_approximate_search_recall(spark):
    import numpy as np

    random = np.random.default_rng(3)
    vectors = random.standard_normal((600, 32))
    asked = vectors[:20] + 0.5 * random.standard_normal((20, 32))
    table = lambda rows: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id int, vector array<double>")
    queries, stored = table(asked), table(vectors)
    exact = search.search_vectors(queries, stored)
    near = passages.search_vectors_lsh(queries, stored)
    assert passages.recall(near, exact).first()["recall"] >= 0.9
    assert passages.candidates(queries, stored).count() < 20 * 600
    same = near.join(exact.withColumnsRenamed({"score": "s", "rank": "r"}), ["query_id", "id"])
    assert same.filter("abs(score - s) > 1e-6").count() == 0


def test_last_k_cuts_before_roles(spark):
    rows = [("s", i, "system" if i == 4 else "user", f"t{i}") for i in range(5)]
    turns = spark.createDataFrame(rows, "session_id string, seq bigint, role string, text string")
    assert [r.text for r in memory.last_k_turns(turns, 1).orderBy("position").collect()] == ["t3"]


def test_rank_facts_counts_substrings(spark):
    facts = spark.createDataFrame([("u", 1, "works in a department"), ("u", 2, "likes tea")], "actor_id string, seq bigint, text string")
    asked = spark.createDataFrame([(1, "u", "Art?")], "query_id int, actor_id string, text string")
    got = memory.rank_facts(asked, facts).orderBy("rank").collect()
    assert [(r.text, r.score) for r in got] == [("works in a department", 1), ("likes tea", 0)]


def test_rate_limit_edges(spark):
    rows = [("k", f"2024-01-01 00:0{m}:00", m) for m in range(6)] + [("j", "2024-01-01 00:00:00", 9)]
    df = spark.createDataFrame(rows, "key string, t string, id int").withColumn("ts", F.to_timestamp("t"))
    assert {(r.id, r.in_window) for r in limits.rate_limit(df, 5, 5).collect()} == {(5, 6)}


def test_term_search_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, [rng.randrange(12) for _ in range(rng.randrange(9))]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "id int, terms array<int>")
    got = {(r.query_id, r.id): (round(r.score, 9), r["rank"]) for r in search.search_hashed(vectors.filter("id % 30 = 0"), vectors, 3).collect()}
    want = {}
    for q, asked in rows[::30]:
        a = Counter(asked)
        scored = []
        for i, terms in rows:
            b = Counter(terms)
            dot = sum(a[t] * b[t] for t in a)
            if dot:
                scored.append((-dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())), i))
        for rank, (score, i) in enumerate(sorted(scored)[:3], 1):
            want[q, i] = (round(-score, 9), rank)
    assert got == want


def test_term_search_adds_up_rows_of_one_id(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(60)]) if i % 3 else 100 + i, [rng.choice([*"abcdefghijkl", None]) for _ in range(rng.randrange(9))]) for i in range(200)]
    texts = spark.createDataFrame([*rows, (7, None)], "id int, terms array<string>")
    asked = texts.filter("id % 5 = 0 or id is null")
    summed = {}
    for i, terms in rows:
        summed.setdefault(i, Counter()).update(terms)
    order = lambda i: (i is not None, i or 0)
    want = set()
    for q in [i for i in summed if i is None or i % 5 == 0]:
        a, scored = summed[q], []
        for i, b in summed.items():
            dot = sum(a[t] * b[t] for t in a if t)
            if dot:
                scored.append((-dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())), order(i), i))
        want |= {(q, i, n, round(-s, 9)) for n, (s, _, i) in enumerate(sorted(scored)[:4], 1)}
    for rows_at_once, terms_at_once in ((8_192, 1_000_000), (7, 9), (50, 100)):
        monkeypatch.setattr(search, "TERM_ROWS", rows_at_once)
        monkeypatch.setattr(search, "QUERY_ROWS", rows_at_once)
        monkeypatch.setattr(search, "TERMS_AT_ONCE", terms_at_once)
        got = search.search_hashed(asked, texts, 4).collect()
        assert {(r.query_id, r.id, r["rank"], round(r.score, 9)) for r in got} == want


def test_products_are_added_up_in_parts(monkeypatch):
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 3, (40, 15))
    rows = [{"id": i, "terms": np.repeat(np.arange(15), own).tolist(), "tfs": None} for i, own in enumerate(counts)]
    table = pa.Table.from_pylist(rows, pa.schema([("id", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]))
    asked = search.Postings(table.slice(0, 9)).by_term()
    for products in (4_000_000, 200, 7, 1):
        monkeypatch.setattr(search, "PRODUCTS", products)
        assert (search.Postings(table).dots(asked) == counts[:9] @ counts.T).all()


def test_terms_and_products_are_not_shuffled(spark):
    vectors = spark.createDataFrame([(i, [i % 5, i % 7]) for i in range(100)], "id int, terms array<int>")
    plan = search.search_hashed(vectors, vectors, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and "Aggregate" not in plan


def test_vector_search_by_groups_and_blocks(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(f"v{i:03}", [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(120)]
    vectors = spark.createDataFrame(rows, "id string, vector array<double>")
    whole = sorted(map(tuple, search.search_vectors(vectors, vectors, 4).collect()))
    monkeypatch.setattr(search, "GROUP_ROWS", 10)
    monkeypatch.setattr(search, "QUERY_ROWS", 7)
    assert sorted(map(tuple, search.search_vectors(vectors, vectors, 4).collect())) == whole and len(whole) == 480


def test_entities_are_decoded_once(spark):
    cases = {"&eacute;t&#233; &#xE9;": "été é", "&amp;lt; &lt;": "&lt; <", "&nope; &#0; &#xD800; &": "&nope; &#0; &#xD800; &",
             "&#128512;&apos;&hearts;": "\U0001f600'♥", "a&nbsp;b": "a\xa0b", None: None}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert [r[0] for r in df.select(passages.unescaped(F.col("t"))).collect()] == list(cases.values())


def test_routing_and_leaks(spark):
    rows = [(1, "what PPE do I need for the shift"), (2, "send a jabber about my PTO"), (3, "tallest building?")]
    df = spark.createDataFrame(rows, "msg_id int, text string")
    assert {(r.msg_id, r.route) for r in route.route_requests(df).collect()} == {(1, "safety"), (2, "operations"), (3, "web")}
    leak = spark.createDataFrame([('{"name": "ask_hr", "parameters": {"question": "what\\\'s PTO"}}',), ('{"name": "ask_hr", "parameters": {"question": 3}}',)], "text string")
    assert [r.question for r in route.recover_tool_calls(leak).collect()] == ["what's PTO", None]


def test_failures_and_screens(spark):
    df = spark.createDataFrame([("d", "Starting knowledge base sync", "ResourceNotFoundException", "not found")], "doc_key string, doing string, code string, message string")
    assert "KNOWLEDGE_BASE_ID" in failures.failure_report(df).first().report
    said = spark.createDataFrame([(1, "Give me the technical drawings for the submarine hull")], "id int, text string")
    assert screen.screen_input(said).first().text == screen.BLOCKED_INPUT


def test_positions_keep_null_keys(spark):
    rows = [(None, 1), (None, 2), ("a", 1), ("a", 250)]
    df = spark.createDataFrame(rows, "k string, n int")
    placed = position_in_group(df, ["k"], [F.col("n")], F.floor(F.col("n") / 100))
    assert sorted((r.k or "", r.position) for r in placed.collect()) == [("", 1), ("", 2), ("a", 1), ("a", 2)]


def test_upload_job_runs(spark, tmp_path):
    files = spark.createDataFrame(
        [("u/a.txt", "a.txt", bytearray(b"plain words by Ka Lo")), ("u/b.png", "b.png", bytearray(b"\x89PNG")), ("u/c.png", "c.png", bytearray(b"\x89PNG2"))],
        "path string, filename string, content binary",
    )
    keyed = cache.cache_keys(classify.classify_files(files)[0], True)
    extracted = keyed.filter("filename = 'b.png'").select("cache_key", F.lit("a crane").alias("text"))
    none = spark.createDataFrame([], schemas.CACHE)
    with pytest.raises(redact.RedactionUnavailable):
        ingest.ingest_files(files, extracted, none, forms_mode=True)
    names = spark.createDataFrame([("Ka Lo",)], "name string")
    stored, published = f"{tmp_path}/cache", f"{tmp_path}/published"
    for number in range(2):
        run = ingest.ingest_files(files, extracted, sinks.read_or_empty(spark, stored, schemas.CACHE), forms_mode=True, names=names)
        assert run.extracted.count() == 1 - number
        rejects = ingest.store(run, stored, published, f"run-{number}")
        assert [r.filename for r in rejects.collect()] == ["c.png"]
        rows = sinks.read_published(spark, published).collect()
        assert sorted((r.source_filename, r.text) for r in rows) == [("a.txt", "plain words by [PERSON]"), ("b.png", "a crane")]
    assert {r["mode"] for r in sinks.read_or_empty(spark, stored, schemas.CACHE).collect()} == {cache.cache_mode(True)}


def test_questions_are_answered_by_route(spark):
    said = [(1, "hello!"), (2, "where is the ppe for the crane"), (3, "give me the technical drawings"), (4, "who painted the ceiling"), (5, "vacation moonlight")]
    messages = spark.createDataFrame(said, "msg_id int, text string")
    corpus = spark.createDataFrame([("d:0", "the ppe hangs beside the crane"), ("e:0", "nothing else")], "chunk_id string, text string")
    pages = spark.createDataFrame([(1, "http://a", "<title>Ceiling</title>painted by M.")], "page_id int, url string, html string")
    got = ask.ask(messages, corpus, pages)
    assert [r.msg_id for r in got.greetings.collect()] == [1] and [r.msg_id for r in got.refused.collect()] == [3]
    answers = {(r.msg_id, r.route): r.text for r in got.answers.collect()}
    assert set(answers) == {(2, "safety"), (4, "web"), (5, "hr")}
    assert answers[2, "safety"] == "the ppe hangs beside the crane" and "Source: http://a" in answers[4, "web"]
    assert answers[5, "hr"] == route.NOT_FOUND["hr"]


def test_chunks_are_embedded_by_a_model_of_the_task(spark):
    parts = spark.createDataFrame([("a:0", "xx"), ("a:1", "y")], "chunk_id string, text string")
    make = lambda: lambda texts: [[len(t), 1] for t in texts]
    assert {r.chunk_id: list(r.embedding) for r in chunks.embed_with_model(parts, make, 2).collect()} == {"a:0": [2.0, 1.0], "a:1": [1.0, 1.0]}
    with pytest.raises(Exception, match="do not have 3 values"):
        chunks.embed_with_model(parts, make, 3).collect()


def test_chunks_are_hashed_once(spark):
    many = "to be  or not\tTO be \u00c9 " + "be " * 50_000
    rows = [("a:0", many), ("a:0", "to"), (None, "to"), ("b:0", " \u2003"), ("b:1", ""), ("b:2", None)]
    got = chunks.embed_chunks(spark.createDataFrame(rows, "chunk_id string, text string"), 1 << 20)
    bucket = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % (1 << 20) for w in ("to", "be", "or", "not", "\u00e9")}
    counts = {"to": 2, "be": 50_002, "or": 1, "not": 1, "\u00e9": 1}
    norm = math.sqrt(sum(n * n for n in counts.values()))
    want = [("a:0", bucket[w], n, n / norm) for w, n in counts.items()] + [("a:0", bucket["to"], 1, 1.0), (None, bucket["to"], 1, 1.0)]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    # What is made of a whole chunk must not be made beside its terms, once for each of them.
    assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()


def test_words_are_split_alike_in_both_engines(spark):
    odd = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    rows = [(c + "a" + c + c + "b" + c,) for c in odd]
    texts = spark.createDataFrame(rows, "text string").select(F.lower("text").alias("text"))
    hashed = chunks.hash_vectors(texts, "text").collect()
    split = {r.text: r.w for r in texts.select("text", words(F.col("text")).alias("w")).collect()}
    made = Counter(len(split[r.id]) for r in hashed)
    assert len(hashed) == len(rows) and set(made) == {1, 2} and made[2] == 29
    for r in hashed:
        assert split[r.id] == r.id.split()
        assert r.terms == [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 1024 for w in split[r.id]]
