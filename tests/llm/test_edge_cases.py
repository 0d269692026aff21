"""Cases that once went wrong, and whole results against slow versions."""

import random
import struct
import weakref

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from folioflow.llm import (
    batches,
    bpe_trie,
    chat_trees,
    decontaminate,
    license_scan,
    packing,
    quality_bands,
    queries,
    simhash_ring,
    token_counts,
    toxicity,
    url_rules,
    warc_index,
)

SMALL = "/root/testdata/sf0.001"


def words(seed, count):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("aeioklmnrst", k=rng.randint(2, 8))) for _ in range(count))


# Toxicity


def labelled_docs(spark, n=40, pad=0):
    rows = [(i, words(i, 30) + " vile" * (i % 2) + " x" * pad, "en") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")


def test_labels_of_other_documents_use_up_no_place_in_the_sample(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(10_000 + i, 0) for i in range(8_000)], "doc_id BIGINT, toxic INT")
    settings = toxicity.Settings(sample_docs=50, epochs=1)
    sample = toxicity.training_sample(labelled_docs(spark), labels, settings)
    assert len(sample) > 25 and {r["_toxic"] for r in sample} == {0, 1}
    assert toxicity.train(labelled_docs(spark), labels, settings) is not None


def test_a_rare_class_finds_a_place_in_the_sample(spark):
    docs = labelled_docs(spark, 200)
    labels = spark.createDataFrame([(i, int(i in (7, 11, 12, 13))) for i in range(200)], "doc_id BIGINT, toxic INT")
    sample = toxicity.training_sample(docs, labels, toxicity.Settings(sample_docs=6))
    assert {r["_toxic"] for r in sample} == {0, 1} and len(sample) <= 6


def test_training_that_cannot_be_is_not_silent(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id BIGINT, toxic INT")
    with pytest.raises(ValueError):
        toxicity.train(labelled_docs(spark, pad=100), labels, toxicity.Settings(sample_chars=50))


def test_scores_equal_a_slow_forward_pass(spark):
    docs = labelled_docs(spark, 120)
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id BIGINT, toxic INT")
    model = toxicity.train(docs, labels, toxicity.Settings(epochs=2))

    def slow(text):
        own = toxicity.words_of(text.encode())
        found = toxicity.piece_buckets(own, model.tables.shape[1])
        vectors = [np.concatenate([model.tables[k][row[k]] for k in range(len(row))]) for row in found]
        best = []
        for width, filters in model.filters.items():
            for f in range(filters.shape[2]):
                answers = []
                for at in range(len(vectors)):
                    window = vectors[at : at + width] + [np.zeros_like(vectors[0])] * (at + width - len(vectors))
                    answers.append(sum(float(v @ filters[step][:, f]) for step, v in enumerate(window)))
                best.append(max([*answers, 0.0]))  # the places behind a text answer 0
        hidden = np.maximum(np.array(best) + model.bias, 0)
        return 1 / (1 + np.exp(-(hidden @ model.weights + model.offset)))

    rows = toxicity.toxicity_scores(docs.limit(60), model).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert abs(r["score"] - slow(texts[r["doc_id"]])) < 1e-4


# URL rules


def test_few_urls_make_no_rule(spark):
    rows = [(f"https://site{i % 50}.example.com/p{i % 50}/", i < 2) for i in range(500)]
    labelled = spark.createDataFrame(rows, "url STRING, bad BOOLEAN")
    assert url_rules.mine_rules(labelled).count() == 0
    loose = url_rules.Settings(least_urls=1, sigmas=0.0, confidence=0.05)
    assert url_rules.mine_rules(labelled, loose).count() > 0


def test_chance_makes_no_rule(spark):
    rng = random.Random(3)
    rows = [(f"https://h{rng.randrange(12)}.example.com/a{rng.randrange(9)}/", rng.random() < 0.5) for _ in range(3_000)]
    labelled = spark.createDataFrame(rows, "url STRING, bad BOOLEAN")
    assert url_rules.mine_rules(labelled).count() == 0


def test_keys_of_a_template_are_one_item(spark):
    query = "&".join(f"key{i}=1" for i in range(40))
    rows = [(f"https://a.example.com/x/{i}?{query}", True) for i in range(60)]
    rows += [(f"https://b{i % 30}.example.com/y/{i}", False) for i in range(600)]
    labelled = spark.createDataFrame(rows, "url STRING, bad BOOLEAN")
    rules = url_rules.mine_rules(labelled)
    assert rules.count() == 1 and len(rules.first()["members"][0]) == 42
    pages = spark.createDataFrame([(1, "https://c.example.com/?key7=2"), (2, "https://c.example.com/?other=2")], "page_id INT, url STRING")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(pages, labelled).collect()} == {1: "block", 2: "allow"}


def test_hosts_paths_and_stated_rules_equal_sql(spark):
    rows = queries.op2_url_rules(spark, SMALL).select("page_id", "host", "path", "rule", "verdict").collect()
    stated = ", ".join(f"('{r}', '{v}')" for r, v in queries.STATED)
    wanted = duckdb.sql(rf"""
        WITH cut AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] ELSE '' END AS rest
          FROM '{SMALL}/pages.parquet'),
        part AS (
          SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        stated(rule, verdict) AS (VALUES {stated}),
        fits AS (
          SELECT page_id, rule, verdict FROM part JOIN stated
            ON ('.' || host).ends_with('.' || split_part(rule, '/', 1)) AND path.starts_with(rule[position('/' IN rule):])
          QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
        SELECT page_id, host, path, rule, verdict FROM part LEFT JOIN fits USING (page_id)""").fetchall()
    assert len(rows) == len(wanted) >= 50
    got = {r["page_id"]: r for r in rows}
    for page_id, host, path, rule, verdict in wanted:
        r = got[page_id]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict


# WARC


def test_captures_without_time_and_with_text_ids(spark):
    rows = [("b%\n2", "http://h/x", "one", None), ("a", "http://h/x", "one", "2024-01-01T00:00:00Z"), (None, "http://h/", "two", None)]
    captures = spark.createDataFrame(rows, "page_id STRING, url STRING, html STRING, captured_at STRING")
    got = warc_index.capture_history(warc_index.write_archives(captures), warc_index.id_type(captures)).collect()
    assert [(r["page_id"], r["captured_at"], r["record_type"], r["refers_to"]) for r in got] == [
        (None, warc_index.NO_TIME, "response", None),
        ("b%\n2", warc_index.NO_TIME, "revisit", "a"),
        ("a", "2024-01-01T00:00:00Z", "response", None),
    ]


def test_warc_rows_equal_sql(spark):
    got = queries.op7_warc_index(spark, SMALL).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    wanted = duckdb.sql(f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM '{SMALL}/pages.parquet'),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, strlen(html), CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END, nullif(first, page_id)
        FROM f""").fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


# Benchmark items, roles, licences


def test_items_may_have_any_id(spark):
    docs = spark.createDataFrame([(1, words(1, 50))], "doc_id BIGINT, text STRING")
    items = spark.createDataFrame([("é-1", words(1, 50)), ("b", words(2, 50))], "item_id STRING, text STRING")
    assert [tuple(r) for r in decontaminate.contained_items(docs, items).collect()] == [(1, "é-1", 1.0)]


@pytest.mark.parametrize("role", ["a\x00b", "\\", "\\n", "\\\\n", "\n\\", "\\\n\\\\", "<|x\\|>\x00\\n", ""])
def test_roles_come_back(spark, role):
    escaped = spark.range(1).select(chat_trees.escape_role(F.lit(role)).alias("r"))
    assert "\n" not in escaped.first()["r"]
    assert escaped.select(chat_trees.unescape_role(F.col("r"))).first()[0] == role


def test_licence_rules_go_by_places(spark):
    said = license_scan.SENTENCES
    text = " ".join(said[i] for i in ("mit-grant", "mit-keep-notice", "mit-as-is", "mit-liability"))
    rows = [(1, text + " Other words. " + said["mit-grant"] + " more"), (2, "Licensed under the MIT license."), (3, said["bsd-grant"])]
    rows[0] = (1, text + "\n\nOther words.\n\n" + said["mit-grant"])
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r["rules"] for r in license_scan.scan_licences(frame).collect()}
    assert got == {1: "mit-text,mit-grant", 2: "mit-notice", 3: "bsd-grant"}


def test_licence_tables_may_be_others(spark):
    sentences = spark.createDataFrame([("Use it under licence A.", "a"), ("Not for sale under licence A.", "b")], "text STRING, sentence_id STRING")
    rules = spark.createDataFrame(
        [(2, "both", "A", "x", ["a", "b"]), (1, "one", "A", "x", ["a"])],
        "place INT, rule STRING, licence STRING, kind STRING, sentence_ids ARRAY<STRING>",
    )
    docs = spark.createDataFrame([(1, "use it, under Licence A. Not for sale under licence a.")], "doc_id INT, text STRING")
    (row,) = license_scan.scan_licences(docs, sentences, rules).collect()
    assert (row["sentence_ids"], row["rules"], row["licences"]) == ("a,b", "both", "A")


# Fingerprints and counts


def slow_fingerprint(text):
    own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        own = own.replace(c, " ")
    own = [w for w in own.split(" ") if w]
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + 4]), 42) for i in range(max(1, len(own) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_a_slow_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = simhash_ring.simhash_components(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {k: f"{slow_fingerprint(t):016x}" for k, t in texts.items()}


def test_many_fingerprints_of_one_key(spark):
    # All share the first segment and more, so whole keys hold thousands of them.
    rng = random.Random(8)
    base = rng.getrandbits(64)
    values = sorted({base ^ (rng.getrandbits(20) << 44) for _ in range(6_000)})
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    found = simhash_ring.links(spark.createDataFrame([(v,) for v in signed], "_fp BIGINT"), simhash_ring.Settings(crowded=1_000))
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in found.limit(2_000).collect())
    roots = {r.node: r.root for r in simhash_ring.components(found).collect()}
    # By brute force, over the 20 bits that differ: grow one component.
    array = np.array(values, dtype=np.uint64)
    label = np.full(len(array), -1)
    groups = 0
    for i in range(len(array)):
        if label[i] < 0:
            todo, label[i] = [i], groups
            while todo:
                near = np.flatnonzero((np.bitwise_count(array ^ array[todo.pop()]) <= 4) & (label < 0))
                label[near] = groups
                todo += near.tolist()
            groups += 1
    assert len({roots.get(v, v) for v in signed}) == groups


def test_near_copies_keep_one_row(spark):
    text = words(4, 60)
    rows = [(5, text, "a"), (5, text, "b"), (9, text, "c"), (None, text, "d"), (7, words(5, 60), "e"), (7, words(6, 60), "f"), (8, None, "g")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, _k STRING")
    kept = simhash_ring.drop_near_copies(docs).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == sorted([(5, text), (7, words(5, 60)), (7, words(6, 60)), (8, "")])


def test_texts_are_not_shuffled_for_few_near_copies(spark, monkeypatch):
    rows = [(i, words(i // 2 if i < 20 else i, 30)) for i in range(60)] + [(3, words(1, 30)), (50, words(50, 30))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash_ring.drop_near_copies(docs)
        joins = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in joins and "SortMergeJoin" not in joins
        got = sorted(map(tuple, kept.collect()))
        monkeypatch.setattr(simhash_ring, "BROADCAST_KEYS", 0)
        kept = simhash_ring.drop_near_copies(docs)
        assert "SortMergeJoin" in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, kept.collect())) == got and [i for i, _ in got] == [*range(0, 20, 2), *range(20, 60)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quality_counts_equal_sql(spark):
    rows = queries.op8_quality_bands(spark, SMALL).collect()
    wanted = duckdb.sql(rf"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
          FROM '{SMALL}/documents.parquet'),
        places AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS t FROM places),
        twice AS (SELECT * FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
        inside AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
        lines AS (
          SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1)
        SELECT doc_id, len(w), length(array_to_string(w, '')), len(regexp_extract_all(text, '[#*$%&|<>]')),
               coalesce(lines.n, 0), coalesce(inside.n, 0),
               len(w) < 20 OR 100 * coalesce(inside.n, 0) > 30 * len(w)
        FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN inside USING (doc_id)""").fetchall()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(wanted)


# Memory


def test_slices_are_bounded_by_bytes():
    texts = ["x" * 3_000_000] * 5 + ["y" * 20_000_000] + ["z"] * 1_500
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["a", "b"])
    parts = list(batches.slices(iter([batch])))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(len(texts)))
    sizes = [int(batches.row_bytes(p).sum()) for p in parts]
    assert all(s <= batches.SLICE_BYTES or p.num_rows == 1 for s, p in zip(sizes, parts))
    assert max(p.num_rows for p in parts) <= batches.SLICE_ROWS


def test_long_runs_are_not_kept_without_bound():
    rng = random.Random(2)
    runs = [("%030x" % rng.getrandbits(120)) * 30_000 for _ in range(3)]  # 0.9 MB each, no blank in them
    counter = token_counts.PieceCounter(packing_path())
    counter_bound, token_counts.KNOWN_CHARS = token_counts.KNOWN_CHARS, 1_000_000
    try:
        first = counter([runs[0].encode()])["n_tokens"]
        counter([runs[1].encode(), runs[2].encode()])
        assert counter([runs[0].encode()])["n_tokens"] == first
        assert sum(map(len, counter.pieces)) <= 2_000_000
    finally:
        token_counts.KNOWN_CHARS = counter_bound
    ids = packing.Encoder(packing_path())(runs[0][:50_000])
    assert len(ids) // 4 == counter([runs[0][:50_000].encode()])["n_tokens"][0]
    known = decontaminate.WordHashes()
    assert known[b"q" * 10_000] == xxhash.xxh64_intdigest(b"q" * 10_000) and not known


def packing_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_known_words_are_forgotten_over_their_characters(monkeypatch):
    import public_tokenizers

    codec = bpe_trie.Codec(public_tokenizers.path("word_bpe_49k.json"))
    texts = [words(i, 300).encode() for i in range(6)]
    wanted = codec(texts)
    monkeypatch.setattr(bpe_trie, "KNOWN_CHARS", 500)
    again = bpe_trie.Codec(public_tokenizers.path("word_bpe_49k.json"))
    got = [again([t]) for t in texts]
    assert [g["ids_sha256"][0] for g in got] == wanted["ids_sha256"]
    assert struct.calcsize("<I") == 4


# What workers hold


def test_codec_holds_two_generations_of_words():
    import public_tokenizers

    codec = bpe_trie.Codec(public_tokenizers.path("word_bpe_49k.json"))
    many = 20_000
    for at in range(0, 15 * many, many):
        codec([" ".join("w" + np.base_repr(i, 26).translate(str.maketrans("0123456789", "qrstuvwxyz")) for i in range(at, at + many)).encode()])
        assert len(codec.known) + len(codec.older) <= 300_000
    assert "library" not in vars(codec)


def test_words_met_again_move_to_the_new_generation(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe_trie, "KNOWN_WORDS", 3)
    codec = bpe_trie.Codec(public_tokenizers.path("word_bpe_49k.json"))
    first = codec([b"alpha beta gamma delta"])
    encoded = []
    encode = codec.trie.encode
    monkeypatch.setattr(codec.trie, "encode", lambda words: encode(encoded.extend(words) or words))
    assert codec([b"alpha beta gamma delta"]) == first
    codec([b"alpha omega"])
    assert encoded == ["omega"]


def test_batches_reach_python_in_bounded_bytes(spark):
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100_000).alias("text"))
    measured = batches.measure(docs, ["doc_id"], "text", lambda: lambda texts: {"n": list(map(len, texts))}, "n BIGINT")
    assert measured.agg(F.sum("n")).first()[0] == 400 * 100_000

    def sizes(parts):
        return (pa.RecordBatch.from_pydict({"n": [part.nbytes]}) for part in parts)

    assert docs.mapInArrow(sizes, "n BIGINT").agg(F.max("n")).first()[0] < 2 * batches.SLICE_BYTES


def test_memory_is_given_back_when_a_task_ends(monkeypatch):
    made, alive = [], []
    monkeypatch.setattr(batches, "give_back", lambda: alive.extend(ref() for ref in made))

    def run(parts):
        kernel = {1}
        made.append(weakref.ref(kernel))
        yield from parts

    assert list(batches.leaving_nothing(run)(iter([1, 2]))) == [1, 2]
    assert alive == [None]


def test_small_frames_need_no_python(spark):
    schema = "_id TIMESTAMP, n DECIMAL(9,2), s STRING"
    rows = spark.sql("SELECT timestamp'2024-07-01 12:00:00' _id, 1.50BD n, 'a' s UNION ALL SELECT NULL, NULL, NULL").to(
        spark.createDataFrame([], schema).schema
    )
    made = toxicity.small_frame(spark, rows.collect(), rows.schema)
    assert "LocalTableScan" in made._jdf.queryExecution().toString()
    assert made.schema == rows.schema and made.exceptAll(rows).isEmpty() and made.count() == 2
