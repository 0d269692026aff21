"""Collocations: phrases whose words stand together more often than apart.

Counting is by prefix-free parsing. A piece of text is cut before each trigger, a
word chosen by its own hash, into chunks; a chunk keeps the first words of the next
one, as many as a phrase may reach over the cut. Where a chunk's own words end
follows from its words alone, so equal chunks are equal parses; that number is kept
with the chunk, so that it need not be found again. Chunks are counted
first, and the phrases inside a chunk once for all its occurrences, weighted by
them: those that start in its own words, so a phrase over a cut is counted once.

No phrase is more frequent than its parts. Words are therefore counted first, and
pieces end at words that are too rare; then phrases of two words, and longer ones
only where both of their parts, but for the last and but for the first word, are
frequent. Which words and parts are is told to the tasks by a filter of fixed size
that may say yes too often, never no: it saves work and decides nothing.

Everything is per language. All counts are sums with a combine in each task; parts
are met with their phrases by equi-joins among frequent phrases.

Defined results: a NULL text is empty and a NULL language ``und``; repeated rows
count each; other columns are ignored; no rows give no phrases.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.batches import free_name, raw_texts, slices
from folioflow.session import new_run_folder


class Settings(NamedTuple):
    least_words: int = 2
    most_words: int = 3
    least_count: int = 10
    #: Percent of a phrase's occurrences inside a longer one from which on it goes.
    inside_percent: int = 50
    top: int = 2_000
    scale: int = 1_000_000
    #: One word in so many is a trigger; a chunk without one is cut after ``longest``.
    modulus: int = 12
    longest: int = 64
    #: Bits of the filter of frequent words and parts, as a power of two.
    filter_bits: int = 26


#: Lower case; what ends a piece becomes STOP, which no word holds, and a tab a blank.
ENDS = b".,;:!?\n\x0b\x0c\r"
STOP = b"."
LOWER = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + STOP * len(ENDS) + b" "
)
#: A chunk's key starts with the number of words that are not its own.
DIGITS = [b"%d" % i for i in range(10)]
#: Sums that a task holds before it hands them on; texts over ``LONG`` bytes count by their bytes.
HELD = 400_000
LONG = 1_000
#: Bytes of text, words of a language and places of phrases that are held at a time.
BLOCK = 4_000_000
KNOWN = 400_000
PLACES = 2_000_000
#: Rows of the dictionary that are cut into words at a time.
CHUNKS = 60_000
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Between language and text in a key; no word holds it.
BAR = b"\t"


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in fewer batches, of CHUNKS rows or BLOCK bytes, and a batch more, at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNKS or sum(b.nbytes for b in held) >= BLOCK:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and the place among them of each word."""
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def blocks_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lower case, and a STOP for what ends a piece.

    A long text comes in blocks that end with a piece, so a block is as large as the
    longest piece at most, or a little more than BLOCK.
    """
    clean = text.translate(LOWER)
    start = 0
    while start < len(clean):
        stop = clean.find(STOP, start + BLOCK) + 1 or len(clean)
        yield clean[start:stop].replace(STOP, b" . ").split()
        start = stop


class Words(dict):
    """Numbers of words in one language, with their hashes. STOP and the digits come first."""

    def __init__(self, lang: str) -> None:
        self.prefix = lang.encode() + BAR
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.texts: list[bytes] = []
        self.letters = 0
        self.hashes = np.zeros(1_024, dtype=np.uint64)
        self.hashed = 0
        self.numbers([STOP, *DIGITS])

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.texts)
        self.texts.append(word)
        self.letters += len(word)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        new = self.texts[self.hashed :]
        if new:
            if len(self.texts) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes[: self.hashed], np.zeros(2 * len(self.texts), np.uint64)])
            digest, prefix = xxhash.xxh64_intdigest, self.prefix
            self.hashes[self.hashed : len(self.texts)] = [digest(prefix + word) for word in new]
            self.hashed = len(self.texts)
        return found

    def full(self) -> bool:
        return len(self.texts) > KNOWN or self.letters > KNOWN * 20


def spots(hashes: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two places (slot, bit) in a filter of so many bits for each hash."""
    high = hashes >> np.uint64(64 - bits), (hashes * MIX) >> np.uint64(64 - bits)
    return [((h >> np.uint64(6)).astype(np.int64), h & np.uint64(63)) for h in high]


def part_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the parts of so many words from each place on; the last places have none."""
    made = words[: len(words) - size + 1].copy()
    for step in range(1, size):
        made = made * MIX + words[step : len(words) - size + 1 + step]
    return made


class Filter:
    """What may be frequent: no is sure."""

    def __init__(self, slots: np.ndarray, bits: int) -> None:
        self.slots, self.bits = slots, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        (a, x), (b, y) = spots(hashes, self.bits)
        return (self.slots[a] >> x & self.slots[b] >> y & np.uint64(1)).astype(bool)


def make_filter(frequent: DataFrame, size: int, bits: int) -> Broadcast:
    """The slots of a filter of (lang, text) with so many words each.

    Slots are filled on Spark, one row each; there are ``2 ** bits / 64`` of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, Words] = {}
        for batch in batches:
            texts: dict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                texts[lang] += text.split(b" ")
            for lang, flat in texts.items():
                words = by_lang.setdefault(lang, Words(lang))
                numbers = words.numbers(flat)
                parts = part_hashes(words.hashes[numbers], size)[::size]
                slots, own = (np.concatenate(x) for x in zip(*spots(parts, bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array((np.uint64(1) << own).view(np.int64))], names=["slot", "bits"]
                )
                if words.full():
                    words.reset()

    found = frequent.select("lang", "text").mapInArrow(run, "slot BIGINT, bits BIGINT")
    rows = found.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    slots = np.zeros(1 << bits - 6, dtype=np.uint64)
    slots[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(slots)


class Sums:
    """Counts of texts by language, handed on as batches before they grow too many."""

    def __init__(self) -> None:
        self.by_lang: dict[str, Counter[bytes]] = defaultdict(Counter)
        self.long = 0

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """(key, n); a key is the language, a bar and the text."""
        if not last and sum(map(len, self.by_lang.values())) + self.long // LONG < HELD:
            return
        for lang, counts in self.by_lang.items():
            prefix, texts, numbers = lang.encode() + BAR, list(counts), list(counts.values())
            for start in range(0, len(texts), 20_000):
                keys = [prefix + text for text in texts[start : start + 20_000]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(numbers[start : start + 20_000], pa.int64())], names=["key", "n"]
                )
        self.by_lang.clear()
        self.long = 0


def summed(rows: DataFrame, run) -> DataFrame:
    """(key, n) of what the tasks have counted."""
    return rows.mapInArrow(run, "key BINARY, n BIGINT").groupBy("key").agg(F.sum("n").alias("n"))


def named(sums: DataFrame) -> DataFrame:
    """(lang, text, n) of (key, n)."""
    text = F.substring_index(F.col("key").cast("string"), BAR.decode(), -1)
    lang = F.expr("cast(substring(key, 1, octet_length(key) - octet_length(text) - 1) as string)")
    return sums.select("key", text.alias("text"), "n").select(lang.alias("lang"), "text", "n")


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias(free_name(docs, "_lang")),
        F.col("text").cast("string").alias(free_name(docs, "_text")),
    )


def count_words(docs: DataFrame) -> DataFrame:
    """(key, n) of all words; the empty word has the number of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for part in slices(batches):
            for lang, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1))):
                for tokens in blocks_of(raw or b""):
                    counts = sums.by_lang[lang]
                    counts.update(tokens)
                    counts[b""] += len(tokens) - counts.pop(STOP, 0)
                    if len(tokens) * LONG < len(raw):
                        sums.long += len(raw)
                    yield from sums.batches()
        yield from sums.batches(last=True)

    return summed(texts_of(docs), run).filter(F.col("n") > 0)


def is_trigger(word: bytes, modulus: int) -> bool:
    return zlib.crc32(word) % modulus == 0


def chunk_places(plain: np.ndarray, trigger: np.ndarray, overlap: int, longest: int) -> tuple[np.ndarray, ...]:
    """(first, end of its own, end) of the chunks in a row of words.

    Chunks lie in runs of ``plain`` words. They start with their run, with a trigger,
    or after ``longest`` words without one.
    """
    breaks = np.flatnonzero(np.append(~plain, True))
    first = plain & np.append(True, ~plain[:-1]) if len(plain) else plain
    starts = np.flatnonzero(first | (plain & trigger))
    run_ends = breaks[np.searchsorted(breaks, starts)]
    ends = np.minimum(np.append(starts[1:], len(plain)), run_ends)
    parts = -(-(ends - starts) // longest)
    if (parts > 1).any():
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + step * longest
        ends, run_ends = np.minimum(np.repeat(ends, parts), starts + longest), np.repeat(run_ends, parts)
    return starts, ends, np.minimum(ends + overlap, run_ends)


def parse(docs: DataFrame, frequent: Broadcast, settings: Settings = Settings()) -> DataFrame:
    """(key, n): the dictionary of chunks of two words and more.

    The text of a key starts with the number of words that the chunk does not own.
    """
    overlap, longest = settings.most_words - 1, settings.longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        may_be = Filter(frequent.value, settings.filter_bits)
        by_lang: dict[str, Words] = {}
        told: dict[str, tuple[np.ndarray, np.ndarray]] = {}  # by word: frequent, a trigger

        def kinds(lang: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
            plain, trigger = told.get(lang, (np.zeros(0, bool), np.zeros(0, bool)))
            new = words.texts[len(plain) :]
            if new:
                also = may_be(words.hashes[len(plain) : words.hashed])
                cuts = np.array([is_trigger(w, settings.modulus) for w in new])
                if not len(plain):
                    also[0] = False  # STOP
                plain, trigger = np.append(plain, also), np.append(trigger, cuts)
                told[lang] = plain, trigger
            return plain, trigger

        def count(lang: str, tokens: list[bytes]) -> None:
            words = by_lang.setdefault(lang, Words(lang))
            numbers = words.numbers(tokens)
            plain, trigger = kinds(lang, words)
            places = chunk_places(plain[numbers], trigger[numbers], overlap, longest)
            counts = sums.by_lang[lang]
            for first, end, stop in zip(*(x.tolist() for x in places)):
                if stop - first > 1:
                    counts[DIGITS[stop - end] + b" " + b" ".join(tokens[first:stop])] += 1
            if words.full():
                words.reset()
                del told[lang]

        for part in slices(batches):
            waiting: dict[str, list[bytes]] = defaultdict(list)
            for lang, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1))):
                for tokens in blocks_of(raw or b""):
                    if len(tokens) * LONG < len(raw):
                        sums.long += settings.most_words * len(raw)
                    waiting[lang] += [*tokens, STOP]
                    if len(waiting[lang]) > BLOCK // 8:
                        count(lang, waiting.pop(lang))
            for lang, tokens in waiting.items():
                count(lang, tokens)
            yield from sums.batches()
        yield from sums.batches(last=True)

    return summed(texts_of(docs), run)


class Places:
    """Phrases as numbers of words, and how often their chunks occur, of one language."""

    def __init__(self, lang: str) -> None:
        self.words = Words(lang)
        self.rows: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.held = 0

    def add(self, rows: np.ndarray, weights: np.ndarray) -> None:
        self.rows.append(rows.astype(np.int32))
        self.weights.append(weights)
        self.held += len(weights)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """(key, n) of the distinct phrases."""
        if self.held:
            rows, weights = np.concatenate(self.rows, axis=1).astype(np.int64), np.concatenate(self.weights)
            codes, many, most = rows[0], len(self.words.texts), len(self.words.texts)
            for more in rows[1:]:
                if most * many >= 1 << 63:
                    codes, most = np.unique(codes, return_inverse=True)[1], len(codes)
                codes, most = codes * many + more, most * many
            order = np.argsort(codes)
            codes = codes[order]
            begins = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            sums, firsts = np.add.reduceat(weights[order], begins), order[begins]
            texts = pa.array(self.words.texts, pa.binary())
            for start in range(0, len(firsts), 50_000):
                part = firsts[start : start + 50_000]
                parts = [texts.take(pa.array(own[part])) for own in rows]
                phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                keys = pc.binary_join_element_wise(
                    pa.scalar(self.words.prefix, pa.binary()), phrases, pa.scalar(b"", pa.binary())
                )
                yield pa.RecordBatch.from_arrays([keys, pa.array(sums[start : start + 50_000])], names=["key", "n"])
            self.rows, self.weights, self.held = [], [], 0
        if self.words.full():
            self.words.reset()


def count_phrases(dictionary: DataFrame, size: int, frequent: Broadcast | None, settings: Settings = Settings()) -> DataFrame:
    """(key, n) of the phrases of so many words, both of whose parts ``frequent`` may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_be = None if frequent is None else Filter(frequent.value, settings.filter_bits)
        by_lang: dict[str, Places] = {}
        for part in gathered(slices(batches, rows=CHUNKS)):
            langs = part.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                places = by_lang[lang] if lang in by_lang else by_lang.setdefault(lang, Places(lang))
                mine = pc.equal(langs.indices, code)
                # All chunks in one row, each a digit and its words.
                lists = pc.split_pattern(part.column(1).filter(mine).cast(pa.large_binary()), b" ")
                words, at = distinct(lists.flatten())
                numbers = places.words.numbers(words.to_pylist())[at]
                counts = part.column(2).filter(mine).to_numpy()
                offsets = lists.offsets.to_numpy()
                begins, ends = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
                own = np.minimum(ends - (numbers[begins] - 1), ends - size + 1) - begins - 1
                own = np.maximum(own, 0)
                total = int(own.sum())
                at = np.arange(total) + np.repeat(begins + 1 - (np.cumsum(own) - own), own)
                weights = np.repeat(counts, own)
                if may_be is not None and total:
                    parts = may_be(part_hashes(places.words.hashes[numbers], size - 1))
                    both = parts[at] & parts[at + 1]
                    at, weights = at[both], weights[both]
                places.add(np.stack([numbers[at + step] for step in range(size)]), weights)
            if sum(p.held for p in by_lang.values()) > PLACES or any(p.words.full() for p in by_lang.values()):
                for places in by_lang.values():
                    yield from places.batches()
        for places in by_lang.values():
            yield from places.batches()

    return summed(named(dictionary), run)


def scored(frequent: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, phrase, a, l, r, score): each phrase by its lowest-scoring cut."""
    cuts = (
        frequent.filter(F.col("words") >= settings.least_words)
        .select("lang", F.col("text").alias("phrase"), F.col("n").alias("a"), "words")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    )
    firsts = frequent.select("lang", F.col("text").alias("first"), F.col("n").alias("l"))
    rests = frequent.select("lang", F.col("text").alias("rest"), F.col("n").alias("r"))
    exact = "cast({0} as decimal(18,0)) * cast({1} as decimal(18,0))"
    score = F.expr(f"cast({settings.scale} * ({exact.format('a', 'a')}) as decimal(38,0)) div ({exact.format('l', 'r')})")
    return (
        cuts.join(firsts, ["lang", "first"])
        .join(rests, ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )


def inside_longer(frequent: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, phrase, longer): the count of the most frequent longer phrase around a phrase."""
    parts = F.split("text", " ")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(settings.least_words), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda at: F.array_join(F.slice("_parts", at, size), " "),
            ),
        )
    )
    return (
        frequent.filter(F.col("words") > settings.least_words)
        .withColumn("_parts", parts)
        .select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each language.

    Words, the dictionary and frequent phrases are written to the shared folder.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "phrases")

    def write_frequent(sums: DataFrame, size: int) -> DataFrame:
        enough = named(sums.filter(F.col("n") >= settings.least_count)).withColumn("words", F.lit(size))
        enough.write.parquet(f"{folder}/frequent/size={size}")
        return spark.read.schema("lang STRING, text STRING, n BIGINT, words INT").parquet(f"{folder}/frequent/size={size}")

    count_words(docs).write.parquet(f"{folder}/words")
    words = spark.read.schema("key BINARY, n BIGINT").parquet(f"{folder}/words")
    empty = F.substring(F.col("key"), -1, 1) == F.lit(BAR)
    totals = named(words.filter(empty)).select("lang", "n")
    frequent = write_frequent(words.filter(~empty), 1)
    parse(docs, make_filter(frequent, 1, settings.filter_bits), settings).write.parquet(f"{folder}/dictionary")
    dictionary = spark.read.schema("key BINARY, n BIGINT").parquet(f"{folder}/dictionary")
    known = None
    for size in range(2, settings.most_words + 1):
        found = write_frequent(count_phrases(dictionary, size, known, settings), size)
        known = make_filter(found, size, settings.filter_bits) if size < settings.most_words else None
        frequent = frequent.unionByName(found)
    kept = (
        scored(frequent, settings)
        .join(inside_longer(frequent, settings), ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < settings.inside_percent * F.col("a")))
    )
    # The best of each share of a language first, so that no task orders a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    best = (
        kept.withColumn("_share", share)
        .withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order)))
        .filter(F.col("_place") <= settings.top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
        .filter(F.col("rank") <= settings.top)
    )
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece),
gram AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM split
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  FROM split),
counted AS (SELECT lang, words, phrase, count(*) AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE words = 1 GROUP BY lang),
candidate AS (SELECT *, string_split(phrase, ' ') AS p FROM counted WHERE words > 1 AND f >= 10),
cut AS (
  SELECT lang, words, phrase, f AS a, 1 AS k, p[1] AS first, array_to_string(p[2:], ' ') AS rest FROM candidate
  UNION ALL
  SELECT lang, words, phrase, f, 2, p[1] || ' ' || p[2], p[3] FROM candidate WHERE words = 3),
judged AS (
  SELECT cut.lang, cut.words, cut.phrase, cut.a, k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * cut.a * cut.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut
  JOIN counted x ON x.lang = cut.lang AND x.phrase = cut.first
  JOIN counted y ON y.lang = cut.lang AND y.phrase = cut.rest),
lowest AS (
  SELECT * FROM judged
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, p[1] || ' ' || p[2] AS phrase, f FROM candidate WHERE words = 3
    UNION ALL
    SELECT lang, p[2] || ' ' || p[3], f FROM candidate WHERE words = 3) GROUP BY ALL),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase)
  WHERE longer.f IS NULL OR 100 * longer.f < 50 * a)
SELECT kept.lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) kept
JOIN total USING (lang)
WHERE rank <= 2000
"""
