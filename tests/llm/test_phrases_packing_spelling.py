"""Phrases, packing and spelling variants against brute force and awkward rows."""

import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioflow.llm import packing, phrases, spelling

COLUMNS = "doc_id BIGINT, text STRING, lang STRING, n STRING"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def prose(seed, count, words="ka lomi ru seta nepo ris atu".split()):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n", "\t"]) for _ in range(count))


AWKWARD = [
    (1, None, "en", None),
    (2, "", None, "x"),
    (3, " \n\t ,.", "en", "x"),
    (4, prose(4, 400), "en", "x"),
    (4, prose(4, 400), "en", "x"),
    (5, prose(5, 300), None, None),
    (None, prose(6, 300), "und", "x"),
    (None, None, None, None),
    (7, "a a a a a a a a a a a a a a. Été ÉTÉ\x1c\xa0naïve <|endoftext|> 中文 don't", "fr", "x"),
    (8, "seta " * 40_000, "de", "x"),
    (9, "x" * 200_000 + " ka", "fr", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # n, word, phrase and length clash with names used inside.
    frame = spark.createDataFrame(AWKWARD, COLUMNS)
    return frame.withColumns({"word": F.lit("w"), "phrase": F.lit(1), "length": F.lit("t"), "_text": F.lit(0)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


# Phrases


def brute_phrases(rows, s):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, s.most_words + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) >= s.least_words and a >= s.least_count}
        kept = []
        for p, a in candidates.items():
            around = [
                f for q, f in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * f >= s.inside_percent * a for f in around):
                continue
            score, _, l, r = min((s.scale * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[: s.top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return out


@pytest.mark.parametrize(
    "settings",
    [phrases.Settings(), phrases.Settings(most_words=5, least_words=3, top=7, least_count=2), phrases.Settings(least_count=2, modulus=1, longest=2)],
)
def test_phrases_equal_brute_force(docs, settings):
    rows = phrases.collocations(docs, settings).collect()
    assert len(rows) > 10
    assert {tuple(r) for r in rows} == brute_phrases(AWKWARD, settings) and len(rows) == len(set(rows))


def test_phrases_of_no_rows(none):
    assert phrases.collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(none).count() == 0


@pytest.mark.parametrize("longest", [2, 5, 64])
def test_chunks_own_each_word_once_and_say_so_themselves(spark, monkeypatch, longest):
    settings = phrases.Settings(longest=longest, least_count=1)
    text = prose(1, 3_000)
    frame = spark.createDataFrame([(text, "en")], "text STRING, lang STRING")
    everything = spark.sparkContext.broadcast(np.full(1 << 20, 2**64 - 1, dtype=np.uint64))
    pieces = [p.split() for p in re.split("[,.\n]", text)]
    whole = Counter()
    for block, known in ((4_000_000, 400_000), (99, 400_000), (999, 12)):
        monkeypatch.setattr(phrases, "BLOCK", block)
        monkeypatch.setattr(phrases, "KNOWN", known)
        rows = phrases.named(phrases.parse(frame, everything, settings)).collect()
        owned = 0
        for row in rows:
            foreign, *words = row["text"].encode().split(b" ")
            own = len(words) - int(foreign)
            # What a chunk owns follows from its words: up to a trigger, the most, or its end.
            most = min(len(words), longest)
            assert own == next((i for i in range(1, most) if phrases.is_trigger(words[i], settings.modulus)), most)
            owned += own * row["n"]
        # Last chunks of one word hold no phrase, and are left out.
        ones = sum(len(p) for p in pieces) - owned
        assert 0 <= ones <= len(pieces)
        found = Counter({r["text"]: r["n"] for r in rows})
        assert not whole or found == whole
        whole = found


def test_a_filter_never_says_no_to_what_it_holds(spark):
    held = [("en", f"w{i} v{i % 7}", 1) for i in range(5_000)]
    slots = phrases.make_filter(spark.createDataFrame(held, "lang STRING, text STRING, n INT"), 2, 18)
    holds = phrases.Filter(slots.value, 18)

    def asked(pairs, lang="en"):
        words = phrases.Words(lang)
        numbers = words.numbers([w.encode() for text in pairs for w in text.split()])
        return holds(phrases.part_hashes(words.hashes[numbers], 2)[::2])

    assert asked([text for _, text, _ in held]).all()
    assert asked([f"w{i} v{i % 7}" for i in range(5_000)], "de").mean() < 0.1


def test_scores_are_exact_beyond_64_bits(spark):
    n = 3_000_000_019
    rows = [("en", "a", n, 1), ("en", "b", n + 2, 1), ("en", "a b", n, 2)]
    frequent = spark.createDataFrame(rows, "lang STRING, text STRING, n BIGINT, words INT")
    (row,) = phrases.scored(frequent).collect()
    assert row["score"] == 1_000_000 * n * n // (n * (n + 2))


# Packing


def check_packed(rows, docs, capacity, end_id=0):
    library = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc_id, text, *_ in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return filled


@pytest.mark.parametrize("capacity", [2_048, 50, 7])
def test_packing_is_whole_and_gapless(docs, capacity):
    check_packed(packing.pack_documents(docs, PATH, capacity).collect(), AWKWARD, capacity)


def test_packing_of_no_rows(none):
    packed = packing.pack_documents(none, PATH)
    assert packed.count() == 0
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_sequences_hold_the_ids(docs):
    packed = packing.pack_documents(docs.filter("doc_id < 8"), PATH, 100, end_id=9, with_ids=True)
    rows = packed.collect()
    for s in packing.sequences(packed).collect():
        assert s["length"] * 4 == len(s["ids"]) <= 400
        for doc_id, start in zip(s["doc_ids"], s["starts"]):
            (part,) = [r for r in rows if (r["sequence_id"], r["offset"]) == (s["sequence_id"], start)]
            assert part["doc_id"] == doc_id and s["ids"][4 * start : 4 * (start + part["length"])] == part["ids"]


def test_ids_are_those_of_the_library(docs):
    library = Tokenizer.from_file(PATH)
    encode = packing.Encoder(PATH)
    rng = random.Random(4)
    odd = "aZ é ß ñ œ 中文 \U0001f600 \u0301 \u200b \xa0 \u2028 ' 's 'll don't 12 ½ ² _ -- \t \n\n  \r\n \x00 \x1c \x85 <|endoftext|> <|end".split(" ")
    texts = ["".join(rng.choice(odd) + rng.choice(["", " ", "  ", "\n"]) for _ in range(60)) for _ in range(400)]
    texts += [prose(3, 2_000), "y" * 5_000, " " * 5_000 + "x", "x" + "\n" * 3_000, "é" * 1_500, "<|endoftext|>" * 200, ""]
    for text in texts:
        assert struct.unpack(f"<{len(encode(text)) // 4}I", encode(text)) == tuple(library.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("seed", range(30))
def test_runs_place_each_piece_once_and_well(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 2_048])
    counts = {rng.randint(1, capacity): rng.randint(0, 50) for _ in range(rng.randint(1, 60))}
    spots = defaultdict(list)
    ranks = defaultdict(set)
    for run in packing.plan_runs(counts, capacity):
        for rank in range(run.rank, run.end):
            ranks[run.length].add(rank)
            sequence, place = divmod(rank - run.rank, run.each)
            spots[run.sequence + sequence].append((run.offset + place * run.length, run.length))
    assert {x: len(r) for x, r in ranks.items()} == {x: n for x, n in counts.items() if n}
    for parts in spots.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in parts) <= 2
    # No more sequences than best fit, item by item and the longest first, takes.
    gaps = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [g for g in range(len(gaps)) if gaps[g] >= length]
        if fitting:
            gaps[min(fitting, key=gaps.__getitem__)] -= length
        else:
            gaps.append(capacity - length)
    assert len(spots) <= len(gaps) * 1.02 + 1


# Spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_near(words):
    return {frozenset((a, b)) for a, b in combinations(words, 2) if near(a, b)}


def some_words(seed, count, letters="abé", least=5, most=8):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(count)})


@pytest.mark.parametrize("seed", range(20))
def test_composed_acceptors_accept_each_near_pair_once(seed):
    words = some_words(seed, 60, "ab", 5, 6)
    short, long = ([w for w in words if len(w) == n] for n in (5, 6))
    found = Counter(map(frozenset, spelling.near_pairs(short, long, 0, 6)))
    assert set(found.values()) <= {1}
    assert set(found) == {p for p in brute_near(words) if min(map(len, p)) == 5}


@pytest.mark.parametrize("most", [2_000, 100, 4])
def test_near_words_equal_brute_force_whatever_the_partitions(spark, most):
    # A beginning, and an end, that most words share; few letters, so many edits meet.
    words = [("template" + w) for w in some_words(1, 250, "abc", 3, 5)] + [w + "ending" for w in some_words(2, 120, "ab", 2, 6)]
    words = sorted({*words, *some_words(3, 200), *(("a" * n) for n in range(5, 40))})
    rng = random.Random(9)
    n = {w: rng.choice([3, 5, 5, 80]) for w in words}
    frame = spark.createDataFrame(list(n.items()), "word STRING, n BIGINT")
    rows = {r["word"]: (r["n_near"], r["form"], r["form_n"]) for r in spelling.near_words(frame, most).collect()}
    around = defaultdict(list)
    for a, b in map(tuple, brute_near(words)):
        around[a].append(b)
        around[b].append(a)
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in around.items()}
    assert rows == {w: (len(v), best[w], n[best[w]]) for w, v in around.items()}


def test_long_words_are_compared(spark):
    base = "".join(random.Random(5).choices("abcdef", k=30_000))
    words = [base, base[:9_000] + base[9_001:], base[:20_000] + "q" + base[20_001:], base[::-1]]
    frame = spark.createDataFrame([(w, 3) for w in words], "word STRING, n BIGINT")
    assert {r["word"]: r["n_near"] for r in spelling.near_words(frame).collect()} == {words[0]: 2, words[1]: 1, words[2]: 1}


def brute_counts(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5}


def test_words_are_counted_as_told(spark, docs, monkeypatch):
    many = [(i, prose(i, 200, some_words(i, 80)), "en", None) for i in range(60)]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(many, COLUMNS).select("doc_id", "text"))
    monkeypatch.setattr(spelling, "BLOCK", 100)
    rows = {r["word"]: r["n"] for r in spelling.count_words(frame).collect()}
    assert rows == brute_counts([*AWKWARD, *many])


def test_forms_lead_to_roots(spark):
    text = " ".join(["colour"] * 40 + ["color"] * 15 + ["colop", "colours"] * 6 + ["single"] * 3)
    frame = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    rows = {r["word"]: r for r in spelling.spelling_variants(frame).collect()}
    counts = {w: n for w, n in brute_counts([(1, text)]).items() if n >= 3}
    assert {w: r["n"] for w, r in rows.items()} == counts
    for word, r in rows.items():
        others = [w for w in counts if near(w, word)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= 2 * counts[word] else None
        assert (r["n_near"], r["form"], r["form_n"]) == (len(others), form, form and counts[form])
        root = word
        while rows[root]["form"]:
            root = rows[root]["form"]
        assert r["root"] == root
    assert rows["colop"]["root"] == "colour" and rows["single"]["root"] == "single"


def test_spelling_of_awkward_rows(docs, none):
    rows = spelling.spelling_variants(docs).collect()
    assert {r["word"]: r["n"] for r in rows} == {w: n for w, n in brute_counts(AWKWARD).items() if n >= 3}
    assert spelling.spelling_variants(none).count() == 0


def test_chunks_are_cut_into_words_a_distinct_word_at_a_time(spark, monkeypatch):
    """Chunks of few words: what Python looks up are their distinct words, many chunks at once."""
    looked: list[int] = []

    class Counted(phrases.Words):
        def numbers(self, words):
            looked.append(len(words))
            return super().numbers(words)

    monkeypatch.setattr(phrases, "Words", Counted)
    monkeypatch.setattr(phrases, "summed", lambda rows, run: run)
    monkeypatch.setattr(phrases, "named", lambda sums: sums)
    chunks = [f"{i % 3} w{i % 7} x{i % 11} y{i % 13}" for i in range(3_000)]
    cols = {"lang": ["en", "de"] * 1_500, "text": chunks, "n": [1 + i % 4 for i in range(3_000)]}
    batches = pa.table(cols).to_batches(500)
    wanted: Counter = Counter()
    for lang, chunk, n in zip(cols["lang"], chunks, cols["n"]):
        digit, *words = chunk.split()
        for at in range(min(len(words) - int(digit), len(words) - 1)):
            wanted[f"{lang}\t{words[at]} {words[at + 1]}"] += n
    got: Counter = Counter()
    for batch in phrases.count_phrases(None, 2, None)(iter(batches)):
        for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got[key.decode()] += n
    assert got == wanted
    assert sum(looked) < 500  # 3,000 chunks of 4 words before
