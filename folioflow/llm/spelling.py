"""Spelling variants: words one edit apart, and the form that most texts use.

Near words are the pairs that the composition vocabulary o one-edit transducer o
vocabulary accepts. Its states are (left state, edited or not, right state); before
the edit both sides have read the same letters, after it they must read the same
rest. A pair is accepted on one path only: the edit stands at the first place where
the words differ.

The composition is cut up by initial states. With m letters in the shorter word, a
pair differs either behind its first m // 2 letters or before its last m - m // 2;
so it lies in the partition of words that start, or (read backwards) end, with the
same half. In a partition the words become a minimal acyclic acceptor, which numbers
its words, and the composition is walked from there; its states are shared by all
lengths, so that two equal rests are known to be equal without being read.

A partition of more than ``most`` words is cut further: to longer shared beginnings,
and, for edits at the letters in between, to words that are equal but for that one
letter. This is done for each crowded half alone, by counts of its beginnings.

Defined results: a NULL text has no words, a NULL id is empty in what is hashed;
repeated rows count each; other columns are ignored; no rows give no words. A task
holds a partition at a time: ``most`` words, each of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import free_name, raw_texts, slices
from folioflow.session import new_run_folder

LEAST_LETTERS, LEAST_COUNT, SPOILED, TIMES = 5, 3, 97, 2
#: Words that meet in one partition.
MOST = 2_000
#: Distinct words that a task counts before it hands the counts on, and letters of long ones.
HELD_WORDS, HELD_LETTERS = 400_000, 32_000_000
BLOCK = 1_000_000

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
NO_LETTER = re.compile("[^A-Za-zÀ-ÿ]")
FORWARD, BACKWARD = 0, 1
#: Kinds of partitions: a shared beginning, or equal but for one letter.
BEGINNING, REPLACED, INSERTED = 0, 1, 2


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, spoiled: int = SPOILED) -> DataFrame:
    """(word, n) of all words, after a letter of one word in ``spoiled`` is deleted."""
    # A run can only lose a letter, so shorter runs give no word.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_letters)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(free_name(docs, "_id")),
        F.col("text").cast("string").alias(free_name(docs, "_text")),
    )

    def blocks(text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > BLOCK:
            cut = NO_LETTER.search(text, start + BLOCK)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.end()
        yield text[start:] if start else text

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        letters = 0
        for part in slices(batches):
            for doc, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1))):
                if not raw:
                    continue
                base = zlib.crc32(f"{doc}:".encode())
                text = raw.translate(LOWER).decode("utf-8", "replace")
                own = Counter(chain.from_iterable(map(runs.findall, blocks(text))))
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), base)
                    if h % spoiled == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    counts[word] += n
                    if len(word) > 100:
                        letters += len(word)
                if len(counts) > HELD_WORDS or letters > HELD_LETTERS:
                    yield batch(counts)
                    counts, letters = Counter(), 0
        yield batch(counts)

    found = rows.mapInArrow(run, "word STRING, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.char_length("word") >= least_letters)


class Acceptor:
    """Minimal acyclic acceptors of sets of words of one length each, with shared states.

    State 0 is the end. A word's number among the sorted words of its set is the sum
    of the offsets along its path.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]  # letter: (state, offset)
        self.sizes = [1]
        self.known: dict[tuple, int] = {}

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.arcs)
            made, before = {}, 0
            for letter, child in arcs:
                made[letter] = (child, before)
                before += self.sizes[child]
            self.arcs.append(made)
            self.sizes.append(before)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state of sorted, distinct words of one length."""
        length = len(words[0])
        open_: list[list[tuple[str, int]]] = [[] for _ in range(length)]
        previous = words[0]

        def close(depth: int) -> None:
            state = 0
            for d in range(length - 1, depth, -1):
                state = self._state([*open_[d], (previous[d], state)])
                open_[d] = []
            open_[depth].append((previous[depth], state))

        for word in words[1:]:
            depth = next(d for d in range(length) if word[d] != previous[d])
            close(depth)
            previous = word
        close(0)
        return self._state(open_[0])


def equal_rests(acceptor: Acceptor, s: int, t: int, i: int, j: int, but: str | None = None) -> Iterator[tuple[int, int]]:
    """Numbers of the words that go on alike from two states; ``but``: not with this letter first."""
    arcs, sizes = acceptor.arcs, acceptor.sizes
    todo = [(s, t, i, j, but)]
    while todo:
        s, t, i, j, but = todo.pop()
        if s == t and but is None:
            for k in range(sizes[s]):
                yield i + k, j + k
            continue
        left, right = arcs[s], arcs[t]
        for letter in left.keys() & right.keys():
            if letter != but:
                (a, x), (b, y) = left[letter], right[letter]
                todo.append((a, b, i + x, j + y, None))
        if s == t == 0:  # the end, whatever letter may not follow
            yield i, j


def replaced(acceptor: Acceptor, root: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Numbers of words that differ in one letter, at a place from ``low`` to below ``high``."""
    arcs = acceptor.arcs
    todo = [(root, 0, 0)]
    while todo:
        state, i, depth = todo.pop()
        own = list(arcs[state].items())
        for at, (_, (a, x)) in enumerate(own):
            if low <= depth and len(own) > 1:
                for _, (b, y) in own[at + 1 :]:
                    yield from equal_rests(acceptor, a, b, i + x, i + y)
            if depth + 1 < high and a:
                todo.append((a, i + x, depth + 1))


def inserted(acceptor: Acceptor, short: int, long: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Numbers (shorter word, longer word): the longer has one letter more, where they first differ."""
    arcs = acceptor.arcs
    todo = [(short, long, 0, 0, 0)]
    while todo:
        s, t, i, j, depth = todo.pop()
        left, right = arcs[s], arcs[t]
        if low <= depth:
            for letter, (b, y) in right.items():
                yield from equal_rests(acceptor, s, b, i, j + y, letter)
        if depth + 1 < high:
            for letter in left.keys() & right.keys():
                (a, x), (b, y) = left[letter], right[letter]
                todo.append((a, b, i + x, j + y, depth + 1))


def near_pairs(short: list[str], long: list[str], low: int, high: int) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart whose first difference is at a place from ``low`` to below ``high``.

    ``short`` and ``long`` are sorted, distinct, and each of one length, one apart.
    Pairs of two long words are not looked for.
    """
    acceptor = Acceptor()
    if not short:
        return
    root = acceptor.add(short)
    for i, j in replaced(acceptor, root, low, high):
        yield short[i], short[j]
    if long:
        for i, j in inserted(acceptor, root, acceptor.add(long), low, high):
            yield short[i], long[j]


def partitions(words: DataFrame, most: int = MOST, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(side, m, kind, place, members): words that may be near, once for each way to be so.

    ``place`` is how many letters a partition of kind ``BEGINNING`` shares, and else
    where its words differ; members are (oriented word, n, whether it is the longer).
    """
    length = F.char_length("word")
    roles = F.filter(
        F.array(
            F.struct(length.alias("m"), F.lit(False).alias("long")),
            F.struct((length - 1).alias("m"), F.lit(True).alias("long")),
        ),
        lambda role: role["m"] >= least_letters,
    )
    sides = F.array(
        F.struct(F.lit(FORWARD).alias("side"), F.col("word").alias("o")),
        F.struct(F.lit(BACKWARD).alias("side"), F.reverse("word").alias("o")),
    )
    half = F.floor(F.col("m") / 2).cast("int")

    def head(size: Column) -> Column:
        return F.xxhash64(F.substring(F.col("o"), F.lit(1), size))

    rows = (
        words.select("word", "n", F.inline(roles))
        .select("n", "m", "long", F.inline(sides))
        .withColumn("place", F.when(F.col("side") == FORWARD, half).otherwise(F.col("m") - half))
        .withColumn("head", head(F.col("place")))
    )
    key = ["side", "m", "head"]
    crowded = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).drop("_n")
    calm = rows.join(crowded, key, "left_anti")
    busy = rows.join(crowded, key, "left_semi").withColumnRenamed("place", "base").drop("head")
    # The shortest beginning of each word that few enough words share.
    deeper = busy.withColumn("place", F.explode(F.sequence(F.col("base"), F.col("m")))).withColumn(
        "head", head(F.col("place"))
    )
    step = ["side", "m", "place", "head"]
    fits = deeper.groupBy(*step).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= most).drop("_n")
    split = (
        deeper.join(fits, step, "left_semi")
        .groupBy("side", "m", "o", "n", "long", "base")
        .agg(F.min("place").alias("place"))
    )
    between = split.filter(F.col("place") > F.col("base")).withColumn(
        "at", F.explode(F.sequence(F.col("base"), F.col("place") - 1))
    )
    without = F.concat(
        F.substring(F.col("o"), F.lit(1), F.col("at")), F.lit("\n"), F.substring(F.col("o"), F.col("at") + 2, F.char_length("o"))
    )
    gap = F.concat(
        F.substring(F.col("o"), F.lit(1), F.col("at")), F.lit("\n"), F.substring(F.col("o"), F.col("at") + 1, F.char_length("o"))
    )
    same = ["side", "m", "kind", "place", "head", "o", "n", "long"]
    begun = [
        part.withColumn("kind", F.lit(BEGINNING)).withColumn("head", head(F.col("place"))).select(*same)
        for part in (calm, split)
    ]
    one_letter = [
        between.filter(only)
        .withColumn("kind", F.lit(kind))
        .withColumn("head", F.xxhash64(rest))
        .withColumn("place", F.col("at"))
        .select(*same)
        for kind, only, rest in (
            (REPLACED, ~F.col("long"), without),
            (INSERTED, F.lit(True), F.when(F.col("long"), without).otherwise(gap)),
        )
    ]
    every = begun[0].unionByName(begun[1]).unionByName(one_letter[0]).unionByName(one_letter[1])
    return (
        every.groupBy("side", "m", "kind", "place", "head")
        .agg(F.collect_list(F.struct("o", "n", "long")).alias("members"))
        .filter((F.size("members") > 1) & F.exists("members", lambda x: ~x["long"]))
        .drop("head")
    )


def near_words(words: DataFrame, most: int = MOST, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word, n_near, form, form_n) of words (word, n) that have near words.

    ``form`` is the near word of largest n, the first of several in code-point order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int, str]] = []
            for row in batch.to_pylist():
                counts = {x["o"]: x["n"] for x in row["members"]}
                m, side = row["m"], row["side"]
                low = row["place"]
                high = m + 1 if row["kind"] == BEGINNING else low + 1
                short, long = (sorted(o for o in counts if len(o) == size) for size in (m, m + 1))
                best: dict[str, tuple[int, int, str]] = {}
                for u, v in near_pairs(short, long, low, high):
                    if row["kind"] == INSERTED and len(u) == len(v):
                        continue
                    if side == BACKWARD and u[len(u) - m // 2 :] == v[len(v) - m // 2 :]:
                        continue  # the first half is the same too, so the other side has the pair
                    for a, b in ((u, v), (v, u)):
                        near, n, form = best.get(a, (0, -1, ""))
                        word = b if side == FORWARD else b[::-1]
                        better = counts[b] > n or counts[b] == n and word < form
                        best[a] = (near + 1, *((counts[b], word) if better else (n, form)))
                turned = (lambda o: o) if side == FORWARD else (lambda o: o[::-1])
                out += [(turned(o), *x) for o, x in best.items()]
            columns = list(zip(*out)) if out else [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "near", "form_n", "form"]
            )

    found = partitions(words, most, least_letters).mapInArrow(run, "word STRING, near BIGINT, form_n BIGINT, form STRING")
    first = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), first.alias("_first"))
        .select("word", "n_near", "_first.form", (-F.col("_first.less")).alias("form_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words (word, form): the last word that forms lead to.

    Each round doubles the steps taken. A form is at least twice as frequent as its
    word, so there are few steps whatever the size of the vocabulary.
    """
    spark = forms.sparkSession
    folder = new_run_folder(spark, "spelling-roots")
    forms.select("word", F.col("form").alias("root")).write.parquet(f"{folder}/0")
    number = 0
    while True:
        now = spark.read.parquet(f"{folder}/{number}")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        number += 1
        moved = now.join(ahead, "root", "left")
        moved.select(
            "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")
        ).write.parquet(f"{folder}/{number}")
        done = spark.read.parquet(f"{folder}/{number}")
        if done.filter("moved").isEmpty():
            return done.select("word", "root")


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that is frequent enough.

    The vocabulary and what is found near its words are written to the shared folder.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "spelling")
    count_words(docs).filter(F.col("n") >= least_count).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    near_words(words, most).write.parquet(f"{folder}/near")
    near = spark.read.parquet(f"{folder}/near")
    follows = F.col("form_n") >= TIMES * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(follows, F.col("form")).alias("form"),
        F.when(follows, F.col("form_n")).alias("form_n"),
    )
    ends = roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# crc32 is folded over the bytes of a string of Latin-1 letters by the table of its polynomial.
SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          b::BIGINT) ORDER BY b) AS t
  FROM range(256) r(b)),
doc AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
run AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[a-z\x{C0}-\x{FF}]{5,}')) AS run FROM doc),
counted AS (SELECT doc_id, run, count(*) AS n FROM run GROUP BY ALL),
spelled AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
              ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END)) AS bytes
  FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(bytes,
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295::BIGINT), 4294967295) AS h
  FROM spelled, crc),
word AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
         ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
gone AS (
  SELECT word, n, length(word) AS size, i, left(word, i) || substr(word, i + 2) AS rest
  FROM word, LATERAL (SELECT unnest(range(length(word))) AS i)),
pair AS (
  SELECT a.word AS word, b.word AS other, b.n AS m FROM gone a JOIN gone b
    ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION
  SELECT a.rest, a.word, a.n FROM gone a JOIN word b ON a.rest = b.word
  UNION
  SELECT a.word, a.rest, b.n FROM gone a JOIN word b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -m, other := other)) AS best FROM pair GROUP BY word),
judged AS (
  SELECT word.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.less >= 2 * n THEN best.other END AS form,
         CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
  FROM word LEFT JOIN near USING (word)),
path AS (
  SELECT word, word AS stop, 0 AS step FROM judged
  UNION ALL
  SELECT path.word, judged.form, step + 1 FROM path JOIN judged ON judged.word = path.stop
  WHERE judged.form IS NOT NULL),
ended AS (SELECT word, arg_max(stop, step) AS root FROM path GROUP BY word)
SELECT judged.word, form, root, n, n_near, form_n FROM judged JOIN ended USING (word)
"""
