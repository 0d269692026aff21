"""What arrives in parts: publishing, the index, turns, rates, files; and what is dealt in stretches."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import pii
from folioflow.functions.keys import one_per_key
from folioflow.functions.pii import RedactionSettings
from folioflow.functions.ranking import STRETCH, stretches
from folioflow.operators import cache, extract, limits, memory, redact, screen, toolcalls
from folioflow.sources import files, ledger, sinks
from folioflow.streaming import streams

DOCS = "filename string, text string, extractor string, modality string"
NO_NAMES = RedactionSettings(entities=("EMAIL_ADDRESS", "PHONE_NUMBER"))


def documents(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t, "bda", "text") for i, t in enumerate(texts)], DOCS)


def published(spark, path):
    return sorted(r.text for r in sinks.read_published(spark, path).collect())


def test_a_batch_that_failed_before_its_record_leaves_one_copy(spark, tmp_path, monkeypatch):
    path, each = str(tmp_path), sinks.publish_each(str(tmp_path), "s")
    each(documents(spark, "one"), 0)
    commit = ledger.commit

    def fail(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(ledger, "commit", fail)
    with pytest.raises(OSError):
        each(documents(spark, "one", "two", "two"), 1)
    assert published(spark, path) == ["one"]
    monkeypatch.setattr(ledger, "commit", commit)
    each(documents(spark, "one", "two", "two", "  "), 1)
    each(documents(spark, "one", "two", "two"), 1)
    assert published(spark, path) == ["one", "two", "two"]  # two files of one text
    assert ledger.committed(spark, path) == ["s-0", "s-1"]


def test_planted_data_leaves_the_published_table_as_it_was(spark, tmp_path):
    path = str(tmp_path)
    sinks.publish_documents(documents(spark, "clean"), path, check=redact.check_staged(NO_NAMES))
    with pytest.raises(redact.RedactionUnavailable, match="1 staged"):
        sinks.publish_documents(documents(spark, "fine", "write to a@b.example.com"), path, "bad", redact.check_staged(NO_NAMES))
    names = spark.createDataFrame([("Ka Lo",)], "name string")
    with pytest.raises(redact.RedactionUnavailable):
        sinks.publish_documents(documents(spark, "said Ka  Lo"), path, "bad", redact.check_staged(names=names))
    with pytest.raises(redact.RedactionUnavailable):
        sinks.publish_documents(documents(spark, "fine"), path, "bad", redact.check_staged())
    assert published(spark, path) == ["clean"]
    sinks.publish_documents(documents(spark, "fine"), path, "bad", redact.check_staged(names=names))
    assert published(spark, path) == ["clean", "fine"]


def test_a_finder_is_merged_with_the_list_and_stops_the_write(spark, tmp_path):
    docs = spark.createDataFrame([("a", "Ka Lo met Mi Ru of Po"), ("b", None)], "doc_key string, text string")
    names = spark.createDataFrame([("Mi Ru of Po",), ("Ka",)], "name string")

    def capitals():
        import re

        return lambda texts: [[(*m.span(), 0.6) for m in re.finditer("[A-Z][a-z] [A-Z][a-z]", t)] for t in texts]

    spans = redact.redact_person_names(docs, names, capitals).collect()
    assert sorted((s.start, s.stop, s.score) for s in spans) == [(0, 2, 0.85), (10, 21, 0.85)]
    only = redact.redact_person_names(docs, finder=capitals).collect()
    assert sorted((s.start, s.stop) for s in only) == [(0, 5), (10, 15)]

    def broken():
        raise OSError("no model")

    with pytest.raises(Exception, match="no model"):
        redact.redact_text(docs, finder=broken).write.parquet(f"{tmp_path}/out")
    with pytest.raises(redact.RedactionUnavailable):
        redact.redact_person_names(docs)


def test_one_row_of_each_key(spark):
    rows = spark.createDataFrame([(k, n, f"{k}{n}") for k in "abc" for n in range(3) if (k, n) not in {("c", 0), ("c", 1)}], "k string, n int, t string")
    held = spark.createDataFrame([("b",), ("b",), ("z",)], "k string")
    got = one_per_key(rows, "k", [-F.col("n")], held)
    assert got.columns == rows.columns and sorted(map(tuple, got.collect())) == [("a", 2, "a2"), ("c", 2, "c2")]


def chunk_texts(spark, path):
    return sorted((r.doc_key, r.text) for r in streams.read_index(spark, path).collect())


def test_the_index_follows_its_documents(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    rows = lambda *x: spark.createDataFrame(list(x), "doc_key string, text string")
    streams.index_batch(rows(("a", "one"), ("b", "two"), ("b", "two"), ("x", None)), path, "0")
    streams.index_batch(rows(("a", "one more"), ("c", "three")), path, "1")
    files_before = ledger.committed(spark, path)
    streams.index_batch(rows(("a", "lost"), ("c", "lost")), path, "1")
    assert ledger.committed(spark, path) == files_before
    assert chunk_texts(spark, path) == [("a", "one more"), ("b", "two"), ("c", "three")]
    streams.index_batch(rows(("b", None), ("c", "three")), path, "2")
    assert chunk_texts(spark, path) == [("a", "one more"), ("c", "three")]
    monkeypatch.setattr(ledger, "commit", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        streams.index_batch(rows(("a", "half done"),), path, "3")
    monkeypatch.undo()
    assert chunk_texts(spark, path) == [("a", "one more"), ("c", "three")]
    streams.index_batch(rows(("b", "back"), ("a", "one more")), path, "3")
    assert chunk_texts(spark, path) == [("a", "one more"), ("b", "back"), ("c", "three")]


@pytest.mark.parametrize("seed", [1, 2])
def test_turns_expire_alike_in_any_order_of_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(f"s{i % 4}", i, f"2024-01-{1 + i % 28:02} 0{i % 10}:00:00", "user", "" if i % 9 == 0 else f"t{i}") for i in range(60)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "session_id string, seq bigint, at string, role string, text string").withColumn("ts", F.to_timestamp("at"))
    out, cut = f"{tmp_path}/out", rng.randrange(10, 50)
    index = {r[1]: n for n, r in enumerate(rows)}
    early = [s for s, n in index.items() if n < cut]
    streams.in_waves(
        [turns.filter(F.col("seq").isin(early)), turns.filter(~F.col("seq").isin(early))],
        lambda arriving: streams.run_available(
            streams.turn_events(arriving), f"{tmp_path}/state", lambda b, _: b.write.mode("append").parquet(out), timers=True
        ),
    )
    live = streams.live_turns(spark.read.schema(streams.TURN_EVENTS).parquet(out))
    newest = turns.filter("text <> ''").agg(F.max("ts")).first()[0]
    wanted = memory.expire_turns(memory.append_turns(turns), F.lit(newest))
    assert sorted(r.seq for r in live.collect()) == sorted(r.seq for r in wanted.collect())


def test_rates_of_a_stream_equal_those_of_a_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), 1_704_067_200 + rng.randrange(4_000)) for _ in range(900)]
    asked = spark.createDataFrame(rows, "key string, s bigint").select("key", F.timestamp_seconds("s").alias("ts"))
    out = f"{tmp_path}/out"
    streams.in_waves(
        [asked.filter(F.pmod(F.xxhash64("ts", "key"), F.lit(2)) == n) for n in range(2)],
        lambda arriving: streams.run_available(
            streams.rate_limit_stream(arriving, 20, lateness="2 hours"), f"{tmp_path}/state", lambda b, _: b.write.mode("append").parquet(out), "update"
        ),
    )
    got = streams.newest_alerts(spark.read.parquet(out))
    wanted = asked.groupBy(F.window("ts", "5 minutes", "30 seconds").alias("w"), "key").count().filter("count > 20")
    assert sorted((r.key or "", r.window_start, r.requests) for r in got.collect()) == sorted((r.key or "", r.w.start, r["count"]) for r in wanted.collect())


def test_files_are_read_once_by_a_stream(spark, tmp_path):
    rows = [(f"n{i}.txt", None if i == 3 else bytearray(b"x" * i)) for i in range(6)]
    folder, out = f"{tmp_path}/up", f"{tmp_path}/out"
    for part in (rows[:4], rows[4:]):
        files.write_files(spark.createDataFrame(part, "filename string, content binary"), folder).collect()
        for _ in range(2):
            arriving = files.read_files(spark, folder, stream=True).select("filename", "size")
            streams.run_available(arriving, f"{tmp_path}/state", lambda b, _: b.write.mode("append").parquet(out))
    at_once = files.read_files(spark, folder).select("filename", "size")
    wanted = [(f"n{i}.txt", i) for i in (1, 2, 4, 5)]  # empty files give no row
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, at_once.collect())) == wanted


def test_files_are_listed_by_tasks(spark, tmp_path):
    up = tmp_path / "up"
    for name in ("a.txt", "b c.txt", "d/e/f.pdf", "d/.g", "_h/i.txt", "d/k=1/j%20.txt", "_l=2/m.txt", "n._COPYING_", "empty"):
        (up / name).parent.mkdir(parents=True, exist_ok=True)
        (up / name).write_bytes(b"" if name == "empty" else name.encode() * 3)
    wanted = sorted(map(tuple, files._listed_by_driver(spark, str(up), False, True).collect()))
    rows = files.read_files(spark, str(up))
    assert sorted(map(tuple, rows.collect())) == wanted and len(wanted) == 5
    assert "FileScan" not in rows._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in rows.select("filename", "size")._jdf.queryExecution().optimizedPlan().toString()
    arriving = files.read_files(spark, str(up), stream=True)
    streams.run_available(arriving, f"{tmp_path}/state", lambda b, _: b.write.mode("append").parquet(f"{tmp_path}/out"))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == wanted
    assert [r.filename for r in files.read_files(spark, f"{up}/a.txt").collect()] == ["a.txt"]
    assert sorted(r.filename for r in files.read_files(spark, f"{up}/*.txt").collect()) == ["a.txt", "b c.txt"]


def test_a_table_is_streamed_from_a_file_or_a_folder(spark, tmp_path):
    turns = spark.createDataFrame([(i % 7, i, "user", f"t{i}") for i in range(60)], "session_id bigint, seq bigint, role string, text string")
    turns.repartition(4).write.parquet(f"{tmp_path}/many/said.parquet")
    turns.coalesce(1).write.parquet(f"{tmp_path}/one-file")
    (tmp_path / "one").mkdir()
    next((tmp_path / "one-file").glob("part-*")).rename(tmp_path / "one" / "said.parquet")
    wanted = sorted((str(r.session_id), r.position, r.text) for r in memory.last_k_turns(turns, 2).collect())
    for kind in ("many", "one"):
        turns.write.parquet(f"{tmp_path}/{kind}/other.parquet")
        arriving, out = streams.table_stream(spark, f"{tmp_path}/{kind}", "said"), f"{tmp_path}/{kind}-out"
        streams.run_available(streams.stream_last_k(arriving, 2), f"{tmp_path}/{kind}-state", lambda b, _: b.write.mode("append").parquet(out), "update")
        assert sorted((r.session_id, r.position, r.text) for r in spark.read.parquet(out).collect()) == wanted


def test_a_user_with_nearly_all_rows_is_spread(spark):
    rows = [("hot", i, i) for i in range(9_500)] + [(f"u{i % 50}", i, 10_000 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "user_id string, s bigint, n bigint").select("user_id", F.timestamp_seconds("s").alias("ts"), "n")
    parts = {r[STRETCH]: r["count"] for r in stretches(df, ["user_id"], [F.col("ts")]).groupBy(STRETCH).count().collect()}
    assert len(parts) == 8 and max(parts.values()) < 2 * len(rows) / 8
    asked, lines = df.filter("n % 100 = 0"), df.filter("n % 100 <> 0")
    got = toolcalls.trace_by_request(lines.withColumnRenamed("n", "line_id"), asked.withColumnRenamed("n", "request_id"))
    last, wanted = {}, set()
    for user, s, n in sorted(rows, key=lambda r: (r[0], r[1])):
        if n % 100 == 0:
            last[user] = n
        elif user in last:
            wanted.add((user, n, last[user]))
    assert {(r.user_id, r.line_id, r.request_id) for r in got.collect()} == wanted


def test_long_prefixes_are_kept(spark):
    prefix = "k" * 1_500
    objects = spark.createDataFrame([(prefix + "/a",), ("k",)], "key string")
    plan = limits.purge_plan(objects, spark.createDataFrame([(prefix,)], "prefix string"))
    assert [(r.prefix, r.key) for r in plan.collect()] == [(prefix, prefix + "/a")]


def test_empty_forms_and_workbooks_keep_their_row(spark):
    blocks = spark.createDataFrame([("d", 0, "p", "PAGE", None, None, None, None)], "doc_key string, pos int, id string, block_type string, text string, relationships array<struct<type:string,ids:array<string>>>, entity_types array<string>, selection_status string")
    assert [tuple(r) for r in extract.form_fields(blocks)[0].collect()] == [("d", "")]
    cells = spark.createDataFrame([("w", 0, "S", 0, ["head"])], "doc_key string, sheet_no int, sheet_name string, row_no int, cells array<string>")
    assert [tuple(r) for r in extract.sheets_to_text(cells).collect()] == [("w", "")]


def test_no_content_is_shuffled_by_the_cache(spark):
    keyed = spark.createDataFrame([("a", "k", "text", bytearray(b"x")), ("b", "l", "image", bytearray(b"y"))], "path string, cache_key string, modality string, content binary")
    entries = spark.createDataFrame([("l", '{"text": "t"}')], "cache_key string, entry string")
    hits, misses = cache.cache_split(keyed, entries)
    assert hits.count() == 1 and [(r.path, bytes(r.content)) for r in misses.collect()] == [("a", b"x")]
    plan = misses._jdf.queryExecution().optimizedPlan().toString()
    below = [part.split("Project [")[1].split("]")[0] for part in plan.split("Join ")[1:]]
    assert below and not any("content" in columns for columns in below)


def test_phrases_of_rules(spark):
    rules = spark.createDataFrame(
        [("A", "IT", True, True), ("B", "go to it", True, True), ("C", "technical drawing", True, True), ("D", "of", False, True), ("A", "red-hot", True, True)],
        "category string, phrase string, on_input boolean, on_output boolean",
    )
    cases = {"it, is": "A", "items": "", "Go to item 3": "B", "go  to, IT": "A,B", "Technical DRAWINGS of": "C", "a technical  redrawing": "", "red hot": "A", "infrared hot": "", "": "", None: ""}
    said = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "id int, text string")
    got = {r.id: ",".join(r.categories) for r in screen.screen_input(said, rules).collect()}
    assert got == dict(enumerate(cases.values()))


def test_words_before_a_hit_do_not_depend_on_the_window(spark, monkeypatch):
    text = " ".join(f"w{i}" * (1 + i % 9) for i in range(200)) + "  end"
    df = spark.createDataFrame([(text, at) for at in (0, 3, 190, 201, 640, len(text))], "t string, at int")
    near = lambda: [r[0] for r in df.select(pii.words_before(F.col("t"), F.col("at"))).collect()]
    shown = near()
    assert shown == [" ".join(text[:at].rstrip(" ").lower().split()[-5:]) for at in (0, 3, 190, 201, 640, len(text))]
    monkeypatch.setattr(pii, "WINDOW", 12)
    assert near() == shown
