"""The ten operators against brute force, libraries and awkward rows."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from folioflow.llm import (
    bpe_trie,
    chat_trees,
    decontaminate,
    license_scan,
    quality_bands,
    simhash_ring,
    token_counts,
    toxicity,
    url_rules,
    warc_index,
)

WORDS = [a + b for a in "ka lo mi ru se ta".split() for b in "ne po ri sa tu".split()]


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(count))


AWKWARD = [
    (1, None, "en", None),
    (2, "", None, "x"),
    (3, " \n\t ", "en", "x"),
    (4, prose(4, 60), "en", "x"),
    (4, prose(4, 60), "en", "x"),
    (5, prose(4, 60), "de", None),
    (None, prose(6, 40), "en", "x"),
    (None, None, None, None),
    (7, prose(7, 60_000), "fr", "x"),
    (8, "été naïve \U0001f600 中文 \x1c\x85 <|endoftext|> don't", "fr", "x"),
    (9, "one two three", "en", "x"),
]
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, _fp STRING"


@pytest.fixture(scope="module")
def docs(spark):
    # _fp, score, kept and _text clash with names used inside.
    frame = spark.createDataFrame(AWKWARD, COLUMNS)
    return frame.withColumns({"score": F.lit("s"), "kept": F.lit(1), "_text": F.lit("t"), "threshold": F.lit(0)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def keyed(rows):
    return sorted(map(str, rows))


def labelled(spark):
    rows = [(i, prose(i, 30) + (" vile scumling" if i % 4 == 0 else ""), ["en", "de"][i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (3, None), (5, 0)], "doc_id BIGINT, toxic INT"
    )
    return docs, labels


def test_toxicity_learns_and_knows_unseen_forms(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels, toxicity.Settings(epochs=4))
    rows = toxicity.toxicity_scores(docs, model).collect()
    held = [r for r in rows if r.held_out]
    assert 40 < len(held) < 120
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) >= 0.95
    more = spark.createDataFrame([(1, prose(1, 30) + " scumlings", "en"), (2, prose(2, 30), "en")], docs.schema)
    score = {r.doc_id: r.score for r in toxicity.toxicity_scores(more, model).collect()}
    assert score[1] > 0.5 > score[2]
    assert {r.doc_id for r in toxicity.drop_toxic(more, model).collect()} == {2}


def test_toxicity_awkward_rows(spark, docs, none):
    _, labels = labelled(spark)
    model = toxicity.train(*labelled(spark), toxicity.Settings(epochs=1, buckets=1 << 12))
    rows = toxicity.toxicity_scores(docs, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    assert toxicity.train(none, labels) is None
    assert {r.score for r in toxicity.toxicity_scores(docs, None).collect()} == {0.0}
    assert toxicity.drop_toxic(none, model).columns == docs.columns
    assert toxicity.drop_toxic(docs, None).count() == len(AWKWARD)


def test_toxicity_thresholds_come_from_all_labelled_rows(spark):
    rows = [(i, prose(i, 30) + (" vile scumling" if i % 3 == 0 else ""), ["en", "es"][i % 2]) for i in range(600)]
    docs = spark.createDataFrame(rows + [(601, "x " * 5000, "fr")], "doc_id BIGINT, text STRING, lang STRING")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in [*range(600), 601]], "doc_id BIGINT, toxic INT")
    settings = toxicity.Settings(epochs=4, sample_docs=50)
    model = toxicity.train(docs, labels, settings)
    assert len(model.learned) <= 50 and set(model.thresholds) == {None, "en", "es"}
    counts = toxicity.score_counts(docs, labels, model, settings.least_positive).collect()
    free = labels.filter(~toxicity.is_held_out(F.col("doc_id"))).count()
    assert sum(r.total for r in counts) == free - len(model.learned)
    assert {r.lang for r in counts} == {None, "en", "es"}


def test_toxicity_threshold_is_near_the_best():
    random = np.random.default_rng(3)
    toxic = random.random(3000) < 0.1
    scores = np.clip(random.normal(0.3 + 0.25 * toxic, 0.1), 0, 1)
    bins = np.minimum((scores * toxicity.BINS).astype(int), toxicity.BINS - 1)
    cut = toxicity.best_threshold(np.bincount(bins, minlength=toxicity.BINS), np.bincount(bins[toxic], minlength=toxicity.BINS))

    def f1(at):
        return 2 * (toxic & (scores >= at)).sum() / ((scores >= at).sum() + toxic.sum())

    assert f1(cut) >= max(map(f1, scores)) - 0.025


def test_toxicity_reads_to_the_end_of_long_texts(spark):
    model = toxicity.train(*labelled(spark), toxicity.Settings(epochs=4))
    scorer = toxicity.Scorer(model)
    clean = prose(9, 150_000)
    low, high = scorer([clean.encode(), (clean + " vile scumling").encode()])
    assert high > 0.5 > low


def brute_repeated(words, size):
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    seen = Counter(windows)
    return len({j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + size)})


def test_repeated_words_by_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(50))]
        words += words[: rng.randrange(30)]
        assert quality_bands.repeated_words(words, 8) == brute_repeated(words, 8)


def test_quality_counts_and_verdicts(spark, docs, none):
    rows = {r.doc_id: r for r in quality_bands.quality_verdicts(docs).collect() if r.doc_id is not None}
    assert (rows[1].n_words, rows[1].base_failed, rows[1].kept, rows[1].ratio) == (0, True, False, None)
    assert (rows[9].n_words, rows[9].word_chars, rows[9].base_failed) == (3, 11, True)
    assert rows[8].word_chars == len("été naïve \U0001f600 中文 \x1c\x85 <|endoftext|> don't".replace(" ", ""))
    assert rows[8].n_symbols == 4
    judge = quality_bands.Judge()
    noise = np.random.default_rng(1).integers(33, 127, 20_000).astype(np.uint8).tobytes().replace(b"$", b" ")
    good = " ".join(f"{w}{i * 7919 % 9973}" if i % 3 else w for i, w in enumerate(prose(1, 3000).split())).encode()
    assert not judge.one(noise)[6]
    assert judge.one(b"a\nb\na\n\n\n")[3] == 1
    assert not judge.one((prose(2, 30) + "\n").encode() * 50)[6]
    half = good[: len(good) // 2] + b" ".join(b"%d" % (i % 10) for i in range(40_000))
    assert judge.one(half)[9] > 0.25 * judge.one(half)[8]
    assert quality_bands.keep_good(none).columns == docs.columns
    kept = quality_bands.keep_good(docs).collect()
    assert all(len(r) == len(docs.columns) for r in kept)


def components_by_brute_force(values, distance=4):
    up = {v: v for v in values}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def neighbours(seed, centres, copies, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        base = rng.getrandbits(64)
        for _ in range(copies):
            value = base
            for bit in rng.sample(range(64), rng.randrange(flips)):
                value ^= 1 << bit
            out.add(value)
    return sorted(out)


@pytest.mark.parametrize("chain", [1, 2, 3, 4])
def test_ring_keys_miss_no_link(chain):
    settings = simhash_ring.Settings(chain=chain)
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys, others = simhash_ring.ring_keys(a, settings), simhash_ring.ring_keys(b, settings)
    sets = len(simhash_ring.chosen_halves(chain))
    found = np.zeros(len(a), bool)
    for kind in range(keys.shape[1]):
        within = simhash_ring.within_chain(a ^ b, np.full(len(a), kind // sets), settings)
        found |= (keys[:, kind] == others[:, kind]) & within
    assert found.all()


def groups_of(spark, values, settings):
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in values], "_fp BIGINT")
    found = simhash_ring.links(nodes, settings)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= settings.distance for r in found.collect())
    root = {r.node: r.root for r in simhash_ring.components(found).collect()}
    groups = {}
    for v in values:
        groups.setdefault(root.get(signed(v), signed(v)), set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("distance", [4, 3])
def test_crowded_keys_give_the_same_groups(spark, distance):
    settings = simhash_ring.Settings(distance=distance, crowded=5)
    free = simhash_ring.free_bits(0, settings)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = set(neighbours(3, 4, 6, 6))
    for _ in range(120):
        value = base
        for bit in rng.sample(free, rng.randrange(7)):
            value ^= 1 << bit
        values.add(value)
    wanted = {}
    for v, top in components_by_brute_force(values, distance).items():
        wanted.setdefault(top, set()).add(v)
    assert groups_of(spark, sorted(values), settings) == sorted(map(sorted, wanted.values()))


def test_links_and_components(spark):
    values = neighbours(1, 12, 12, 6)
    want = components_by_brute_force(values)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in values], "_fp BIGINT")
    found = simhash_ring.components(simhash_ring.links(nodes))
    root = {r.node: r.root for r in found.collect()}
    groups, wanted = {}, {}
    for v in values:
        groups.setdefault(root.get(signed(v), signed(v)), set()).add(v)
        wanted.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_simhash_awkward_rows(spark, docs, none):
    rows = simhash_ring.simhash_components(docs).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == "0" * 16 and by_id[3].component_id == 1
    assert by_id[5].component_id == 4
    kept = simhash_ring.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, None, 7, 8, 9])
    assert simhash_ring.simhash_components(none).count() == 0
    assert simhash_ring.drop_near_copies(none).count() == 0


def test_decontamination_by_brute_force(spark, docs, none):
    items = [(i, prose(100 + i, 12 + i)) for i in range(12)] + [(50, "alpha beta"), (51, None), (52, ""), (53, "alpha beta")]
    texts = []
    for i in range(40):
        own = prose(500 + i, 3_000 if i % 7 == 0 else 50)
        if i % 3 == 0:
            words = items[i % 12][1].split()
            own += " X " + " ".join(words[: len(words) - i % 5]).upper() + " . " + own
        if i % 8 == 0:
            own += " Alpha, BETA!"
        texts.append((i, own))
    frame = spark.createDataFrame(texts + [(98, None), (99, "")], "doc_id BIGINT, text STRING")
    item_frame = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    want = set()
    for item, text in items:
        words = decontaminate.words_of((text or "").encode())
        size = min(5, len(words))
        if words:
            own = decontaminate.shingle_texts(words, size)
            for doc, body in texts:
                found = own & decontaminate.shingle_texts(decontaminate.words_of(body.encode()), size)
                if len(found) >= 0.8 * len(own):
                    want.add((doc, item, len(found) / len(own)))
    for settings in (decontaminate.Settings(), decontaminate.Settings(block_items=3)):
        got = {tuple(r) for r in decontaminate.contained_items(frame, item_frame, settings).collect()}
        assert got == want and len(want) > 10
        clean = decontaminate.drop_contaminated(frame, item_frame, settings).collect()
        assert {r.doc_id for r in clean} == {d for d, _ in texts + [(98, 0), (99, 0)]} - {d for d, _, _ in want}
    assert decontaminate.contained_items(docs, item_frame.filter("false")).count() == 0
    assert decontaminate.drop_contaminated(none, item_frame).columns == docs.columns
    assert decontaminate.drop_contaminated(docs, item_frame).count() == len(AWKWARD)


def random_texts(count):
    rng = random.Random(8)
    letters = "abcdesStTrlvmd'<|>endoftext ÀéßΣςσİıﬁ \t\n\x0b\x1c\x85\xa0한글中0½²\U0001f600́‍\x00!?.,-_&"
    fuzz = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(count)]
    return fuzz + ["<|endoftext|>a", "x<|startoftext|> y", "WE'RE 'sun", "ΑΣ ΑΣΑ", prose(1, 500), "", None]


def test_decontamination_finds_items_of_one_shingle():
    # 2,000 items of five words, each in a document of its own of 400 words.
    items = [f"i{n} a{n} b{n} c{n} d{n}".encode() for n in range(2_000)]
    block = decontaminate.ItemBlock(items, decontaminate.Settings())
    for n, item in enumerate(items):
        filler = [f"w{n}x{i}" for i in range(395)]
        text = " ".join(filler[: n % 395]).encode() + b" " + item + b" " + " ".join(filler[n % 395 :]).encode()
        assert block.matches(text) == [(n, 1.0)]


def test_bpe_trie_equals_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, texts = Tokenizer.from_file(path), random_texts(1500)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for row in bpe_trie.encode_documents(frame, path).collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_trie_of_one_long_word():
    path = public_tokenizers.path("word_bpe_49k.json")
    codec, library = bpe_trie.Codec(path), Tokenizer.from_file(path)
    letters = random.Random(5)
    for size in (20_000, 200_000):  # the shorter one first: its memory is looked at before the longer is tried
        word = "".join(letters.choices("acgt" if size == 20_000 else "etaoinshrdlu", k=size))
        tracemalloc.start()
        got = codec([word.encode()])
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 1_000 * size
        ids = library.encode(word, add_special_tokens=False).ids
        assert got["n_tokens"] == [len(ids)]
        assert got["ids_sha256"] == [hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()]
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got["decoded_sha256"] == [hashlib.sha256(decoded.encode()).hexdigest()]


def test_bpe_trie_tries_only_tokens_that_end_at_a_symbol():
    class Counted(dict):
        asked = 0

        def __contains__(self, key):
            Counted.asked += 1
            return super().__contains__(key)

    path = public_tokenizers.path("word_bpe_49k.json")
    codec, library = bpe_trie.Codec(path), Tokenizer.from_file(path)
    codec.trie.tokens = Counted({t: codec.vocabulary.ids[t] for t in codec.trie.tokens})
    letters = random.Random(9)
    syllables = ["the", "ing", "tion", "er", "st", "an", "on", "\u00e9", "ou", "ment"]
    texts = [" ".join("".join(letters.choices(syllables, k=5)) for _ in range(2_000)) for _ in range(3)]
    for text in texts:
        Counted.asked = 0
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec([text.encode()])["ids_sha256"] == [hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()]
    assert Counted.asked < len(texts[-1]) / 4  # the steps are known by now


def test_bpe_trie_cuts_at_blanks_as_the_library_does():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [" a\xa0b\tc d\xa0", "don't 's's  x'll\r\nIt'S", "a\x1cb\x0bc\x0cd\x85e\x1f", "\xc9\xa0\u0130\xe9, 'RE", "   ", "\xa0"]
    texts += ["a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|", "\u2003\u3000x\u0301 \u4e2d!\U0001f600y\u200b", "", "!!a1.2b\x00c"]
    codec = bpe_trie.Codec(path)
    for _ in range(2):
        got = codec([t.encode() for t in texts])
        for at, text in enumerate(texts):
            ids = library.encode(text, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            assert got["n_tokens"][at] == len(ids), text
            assert got["ids_sha256"][at] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), text
            assert got["decoded_sha256"][at] == hashlib.sha256(decoded.encode()).hexdigest(), text


def test_bpe_trie_forgets_words_over_its_bound(monkeypatch):
    monkeypatch.setattr(bpe_trie, "KNOWN_WORDS", 5)
    codec = bpe_trie.Codec(public_tokenizers.path("word_bpe_49k.json"))
    texts = [prose(i, 40).encode() for i in range(3)]
    first = [codec([t]) for t in texts]
    assert [codec([t]) for t in texts] == first


def test_token_counts_equal_the_library(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, texts = Tokenizer.from_file(path), random_texts(1500)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for row in token_counts.token_counts(frame, path).collect():
        text = texts[row.doc_id] or ""
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids), text
        assert row.n_bytes == len(text.encode()) and row.over_limit == (row.n_tokens > 1024)
    assert token_counts.token_counts(docs, path).count() == len(AWKWARD)
    assert token_counts.token_counts(none, path).count() == 0
    assert bpe_trie.encode_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert bpe_trie.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")).count() == len(AWKWARD)


def test_chat_trees_choose_the_best_branch(spark):
    rows = [
        ("a", None, "user", "q", 0.0),
        ("b", "a", "assistant", "weak", 0.1),
        ("c", "a", "assistant", "good <|im_end|> <\\| x", 0.9),
        ("d", "c", "us\\er\n", None, 0.8),
        ("e", "b", "user", "more", 0.2),
        ("f", "lost", None, "alone", None),
        ("g", "h", "user", "cycle", 1.0),
        ("h", "g", "user", "cycle", 1.0),
        (None, "a", "user", "no id", 9.0),
        ("b", "a", "assistant", "weak", 0.1),
    ]
    frame = spark.createDataFrame(rows, "node STRING, parent STRING, role STRING, text STRING, score DOUBLE")
    frame = frame.withColumns({"up": F.lit(1), "root": F.lit(2), "leaf": F.lit(3)})
    best = {r.root: r for r in chat_trees.format_trees(frame).collect()}
    assert set(best) == {"a", "f"} and best["a"].leaf == "d"
    turns = chat_trees.format_trees(frame).filter("root = 'a'").select(
        chat_trees.read_turns(F.col("formatted")).alias("t"),
        chat_trees.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).first()
    assert [tuple(t) for t in turns.t] == [("user", "q"), ("assistant", "good <|im_end|> <\\| x"), ("us\\er\n", "")]
    assert turns.loss == "good <|im_end|> <\\| x"
    two = chat_trees.format_trees(frame, top=2).filter("root = 'a'").collect()
    assert sorted((r.rank, r.leaf) for r in two) == [(1, "d"), (2, "e")]
    assert chat_trees.format_trees(frame.filter("false")).count() == 0


def test_chat_trees_of_long_lines(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)] + [(None, None, None, None), (2, 5, "user", "x"), (2, 5, "user", "x")]
    talks = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    found = chat_trees.format_trees(chat_trees.linear_messages(talks))
    named = found.withColumn("conv_id", F.nullif(F.col("root.conv"), F.lit("")).cast("bigint"))
    got = {r.conv_id: r for r in chat_trees.read_back(named).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 70, 2: 2, None: 1}
    lines = "".join(f"{r}\n{t}\n" for _, _, r, t in rows[:70])
    assert got[1].turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
    loss = "".join(t for _, _, r, t in rows[:70] if r == "assistant")
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_url_rules(spark):
    rows = [(i, f"https://{'spam' if i % 4 == 0 else 'news'}.example.com/{'win' if i % 8 == 0 else 'a'}/{i}?p=1", i % 8 == 0) for i in range(400)]
    labelled_urls = spark.createDataFrame(rows, "page_id BIGINT, url STRING, bad BOOLEAN")
    urls = {
        1: ("HTTP://Spam.Example.com/win/7", "spam.example.com", "/win/7", None, "block"),
        2: ("http://spam.example.com/a/7", "spam.example.com", "/a/7", None, "block"),
        3: ("https://x.EXAMPLE.org/es/1#f", "x.example.org", "/es/1", "example.org/es/", "block"),
        4: ("https://x.example.org/en/12", "x.example.org", "/en/12", "example.org/en/1", "block"),
        5: ("https://x.example.org/en/2?u=://", "x.example.org", "/en/2", "org/", "allow"),
        6: ("https://example.org", "example.org", "", None, "allow"),
        7: ("https://badexample.com/de/x", "badexample.com", "/de/x", "com/de/", "block"),
        8: ("no scheme", "", "", None, "allow"),
        9: (None, "", "", None, "allow"),
    }
    stated = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
    pages = spark.createDataFrame([(k, v[0]) for k, v in urls.items()] + [(None, None), (1, urls[1][0])], "page_id BIGINT, url STRING")
    pages = pages.withColumns({"confidence": F.lit(1), "mined": F.lit(2)})
    settings = url_rules.Settings(support=0.02, confidence=0.45)
    rules = url_rules.mine_rules(labelled_urls, settings)
    # By brute force: every combination of tokens under the same limits.
    sets = [(frozenset(r.t), r.bad) for r in labelled_urls.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    single = Counter(t for s, _ in sets for t in s)
    telling = {t for t, n in single.items() if 0.02 * 400 <= n < 0.9 * 400}
    total, bad = Counter(), Counter()
    for s, flag in sets:
        own = sorted(s & telling)
        for mask in range(1, 1 << len(own)):
            combo = tuple(t for i, t in enumerate(own) if mask >> i & 1)
            total[combo] += 1
            bad[combo] += flag
    sure = {c: bad[c] / total[c] for c in total if bad[c] >= 8 and bad[c] / total[c] >= 0.45}
    want = {c for c in sure if not any(len(c) > 1 and sure.get(c[:i] + c[i + 1 :], -1) >= sure[c] for i in range(len(c)))}
    assert {tuple(r.antecedent) for r in rules.collect()} == want and want
    got = url_rules.judge_urls(pages, labelled_urls, stated, settings).collect()
    assert len(got) == len(urls) + 2
    for row in got:
        if row.page_id is not None:
            assert (row.host, row.path, row.rule, row.verdict) == urls[row.page_id][1:], row
    assert url_rules.judge_urls(pages.filter("false"), labelled_urls, stated, settings).count() == 0
    assert url_rules.judge_urls(pages, labelled_urls.filter("false"), stated, settings).count() == len(urls) + 2


def test_warc_round_trip(spark):
    rows = [
        (3, "http://b.example.com/x", "same"),
        (1, "http://a.example.com/y y\r\n", "same"),
        (2, "http://a.example.com/y", None),
        (4, None, ""),
        (5, "http://b.example.com/x", "ünï\r\n\r\nWARC/1.1" * 5000),
        (1, "http://a.example.com/y y\r\n", "same"),
        (None, "http://c.example.com/", "same"),
        (None, "http://c.example.com/", "only"),
    ]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").withColumns(
        {"captured_at": F.lit("2024-01-01T00:00:00Z"), "sha": F.lit(1), "first": F.lit(2)}
    )
    got = warc_index.capture_history(warc_index.write_archives(pages)).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got) == sorted(
        [(3, 4, "revisit", 1), (1, 4, "response", 0), (1, 4, "response", 0), (2, 0, "response", 0), (4, 0, "revisit", 2),
         (5, len(("ünï\r\n\r\nWARC/1.1" * 5000).encode()), "response", 0), (0, 4, "revisit", 1), (0, 4, "response", 0)]
    )
    keys = [(r.url_key, r.captured_at, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert warc_index.capture_history(warc_index.write_archives(pages.filter("false"))).count() == 0


def test_loser_tree_merges():
    rng = random.Random(1)
    for runs in range(0, 9):
        lists = [sorted(rng.randrange(50) for _ in range(rng.randrange(12))) for _ in range(runs)]
        assert list(warc_index.LoserTree(lists, lambda x: x)) == sorted(x for own in lists for x in own)


def test_licence_rules(spark, docs, none):
    said = license_scan.SENTENCES
    mit = [said[i] for i in ("mit-grant", "mit-keep-notice", "mit-as-is", "mit-liability")]
    wrapped = "MIT License\n\n" + "\n\n".join(s.replace(" ", "\n", 9) for s in mit)
    rows = [
        (1, wrapped), (2, " ".join([mit[1], mit[0]])), (3, "Intro\nreleased   under THE mit license.\nAll rights reserved."),
        (4, said["apache-2.0-terms"] + " " + said["apache-2.0-copy"] + "\n\n" + said["apache-2.0-as-is"] + " " + said["apache-2.0-see"]),
        (5, "unlicensed"), (6, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in license_scan.scan_licences(frame).collect()}
    assert got[1].rules == "mit-text,mit-title" and got[1].licences == "MIT"
    assert got[2].rules == "mit-grant"
    assert got[3].rules == "mit-notice,reserved" and got[3].kinds == "permissive,reserved"
    assert got[4].rules == "apache-header"
    assert got[5].rules == got[6].rules == ""
    assert license_scan.scan_licences(docs).count() == len(AWKWARD)
    assert license_scan.scan_licences(none).count() == 0
    import re
    for sentence in said.values():
        assert re.search(license_scan.ANCHORS, sentence) or "obtain a copy" in sentence.lower()


def test_pipeline_stages_on_awkward_rows(spark, docs, none, tmp_path):
    _, labels = labelled(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id BIGINT, text STRING").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for frame in (docs, none):
        frame.select("doc_id", "text", "lang", "score").write.parquet(str(tmp_path / "documents.parquet"), mode="overwrite")
        current = spark.read.parquet(str(tmp_path / "documents.parquet"))
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            after = stage(spark, current, str(tmp_path))
            if number < len(corpus_pipeline.STAGES) - 1:
                assert after.columns == current.columns
                assert after.count() <= current.count()
        assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
