"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item is contained in a long document if the document holds at least
0.8 of the item's distinct five-word shingles. The similarity of the two sets is
then tiny, so plain MinHash misses it. Here documents are partitioned by size:
a document of up to u distinct shingles gets a one-permutation MinHash with 16 * u
bins, so every class, however long its documents, keeps the same small number of
shingles per bin and a shingle survives as its bin's minimum with a chance of
about 0.97. An item is looked up in each class with the same bins. Items whose
minima meet the document's in at least a share of the needed bins are
candidates; items of few shingles, where one lost minimum may decide, are looked
up under four permutations, so that one is missed about once in a million.
Candidates are verified by counting their shingles, as text, in the whole
document, so no result rests on a hash.

Documents are read once and nothing is shuffled. Items are sent to the tasks in
blocks of at most ``block_items`` items and ``block_chars`` characters, which
bounds what is broadcast; each block passes over the documents once.

Words are runs of letters, digits and characters beyond ASCII, with A-Z lowered.
Defined results: an item of fewer than five words is one shingle of all its
words; items without words, and NULL and empty texts, match nothing; repeated
rows of either side match each; NULL ids are carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from folioflow.llm.batches import keep, raw_texts, slices

# Bytes of words: digits, letters in lower case, all of non-ASCII; others are blanks.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
MIXER = np.uint64(0x9E3779B97F4A7C15)
KNOWN_WORDS = 300_000
KEPT_BYTES = 100  # longer words are hashed each time


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    containment: float = 0.8
    bins_per_shingle: int = 16
    candidate_share: float = 0.25  # of the needed shingles, that must meet as minima
    short: int = 8  # needed shingles up to which an item gets more permutations
    permutations: int = 4  # at most 4: rotations of the hash by 16 bits
    block_items: int = 50_000
    block_chars: int = 16_000_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= KEPT_BYTES:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = value
        return value


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_TABLE).split()


def shingle_hashes(words: list[bytes], size: int, known: WordHashes) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` words."""
    count = len(words) - size + 1
    if count < 1:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(count, dtype=np.uint64)
    for step in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MIXER + codes[step : step + count]
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIXER
    return mixed ^ (mixed >> np.uint64(29))


def shingle_texts(words: list[bytes], size: int) -> set[bytes]:
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def bin_minima(hashes: np.ndarray, log_bins: int) -> np.ndarray:
    """The least hash of each bin in use; a bin is a hash's top bits. Sorted."""
    ordered = np.sort(hashes)
    bins = ordered >> np.uint64(64 - log_bins)
    return ordered[np.concatenate([[True], bins[1:] != bins[:-1]])] if len(ordered) else ordered


def turned(hashes: np.ndarray, turn: int) -> np.ndarray:
    """The hashes as another permutation orders them."""
    return (hashes << np.uint64(16 * turn)) | (hashes >> np.uint64(64 - 16 * turn)) if turn else hashes


def size_class(shingles: int, settings: Settings) -> int:
    """log2 of the bins for documents with so many shingles."""
    return max(4, (max(1, shingles) * settings.bins_per_shingle - 1).bit_length())


class ItemBlock:
    """A block of items, with an index of their minima for each size class."""

    def __init__(self, texts: list[bytes | None], settings: Settings) -> None:
        self.settings = settings
        self.known = WordHashes()
        self.groups: dict[int, list[int]] = {}
        self.shingles: list[set[bytes]] = []
        self.needed: list[int] = []
        self.hashes: list[np.ndarray] = []
        for number, raw in enumerate(texts):
            words = words_of(raw)
            size = min(settings.shingle, len(words))
            found = shingle_texts(words, size) if words else set()
            self.shingles.append(found)
            self.needed.append(-int(-settings.containment * len(found) // 1))
            self.hashes.append(np.unique(shingle_hashes(words, size, self.known)) if words else np.zeros(0, np.uint64))
            if words:
                self.groups.setdefault(size, []).append(number)
        few = settings.short
        self.short = {size: [n for n in own if self.needed[n] <= few] for size, own in self.groups.items()}
        self.index: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.maybe = {size: self._table(own) for size, own in self.groups.items()}
        self.maybe_short = {size: self._table(own) for size, own in self.short.items() if own}

    def _table(self, numbers: list[int]) -> np.ndarray:
        """Which values of the hash's top bits some shingle of these items has."""
        table = np.zeros(1 << 20, dtype=bool)
        table[np.concatenate([self.hashes[n] for n in numbers]) >> np.uint64(44)] = True
        return table

    def minima(self, size: int, log_bins: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, item) of the items' minima in a class, sorted by hash."""
        if (size, log_bins, turn) not in self.index:
            numbers = self.short[size] if turn else self.groups[size]
            parts = [bin_minima(turned(self.hashes[n], turn), log_bins) for n in numbers]
            hashes = np.concatenate(parts)
            owners = np.repeat(numbers, [len(p) for p in parts])
            order = np.argsort(hashes, kind="stable")
            self.index[size, log_bins, turn] = hashes[order], owners[order]
        return self.index[size, log_bins, turn]

    def candidates(self, hashes: np.ndarray, size: int) -> set[int]:
        """Items of a shingle size whose minima meet those of a document's hashes."""
        # No minimum can meet where no shingle of any item is: most texts end here.
        if not len(hashes) or not self.maybe[size][hashes >> np.uint64(44)].any():
            return set()
        log_bins = size_class(len(hashes), self.settings)
        more = size in self.maybe_short and self.maybe_short[size][hashes >> np.uint64(44)].any()
        found: set[int] = set()
        for turn in range(self.settings.permutations if more else 1):
            own = bin_minima(turned(hashes, turn), log_bins)
            index, owners = self.minima(size, log_bins, turn)
            begin, end = np.searchsorted(index, own), np.searchsorted(index, own, side="right")
            met = [owners[a:b] for a, b in zip(begin, end) if b > a]
            if met:
                items, counts = np.unique(np.concatenate(met), return_counts=True)
                for item, count in zip(items.tolist(), counts.tolist()):
                    if count >= max(1, int(self.settings.candidate_share * self.needed[item])):
                        found.add(item)
        return found

    def matches(self, raw: bytes | None) -> list[tuple[int, float]]:
        """(item number, containment) of the items that a text contains."""
        words = words_of(raw)
        found = []
        for size in self.groups:
            met = self.candidates(shingle_hashes(words, size, self.known), size)
            texts = shingle_texts(words, size) if met else set()
            for item in met:
                hits = len(self.shingles[item] & texts)
                if hits >= self.needed[item]:
                    found.append((item, hits / len(self.shingles[item])))
        return sorted(found)


def item_blocks(items: DataFrame, settings: Settings) -> Iterator[list[tuple]]:
    """(item_id, text) rows in blocks of bounded size, fetched one at a time."""
    block, chars = [], 0
    rows = items.select("item_id", F.col("text").cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        size = len(row["text"] or b"")
        if block and (len(block) >= settings.block_items or chars + size > settings.block_chars):
            yield block
            block, chars = [], 0
        block.append((row["item_id"], bytes(row["text"]) if row["text"] is not None else None))
        chars += size
    yield block


def contained_items(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, containment) of every item contained in a document."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType(
        [rows.schema["doc_id"], items.schema["item_id"], *StructType.fromDDL("containment DOUBLE").fields]
    )
    out = None
    for block in item_blocks(items, settings):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        found = rows.mapInArrow(_search(sent, settings, to_arrow_type(items.schema["item_id"].dataType)), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(sent, settings: Settings, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = ItemBlock([text for _, text in sent.value], settings)
        ids = [item for item, _ in sent.value]
        for part in slices(batches):
            found = [block.matches(raw) for raw in raw_texts(part.column(1))]
            owners = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = [m for f in found for m in f]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(owners),
                    pa.array([ids[n] for n, _ in flat], kind),
                    pa.array([c for _, c in flat], pa.float64()),
                ],
                names=["doc_id", "item_id", "containment"],
            )

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns, that contain no item."""
    for rows in item_blocks(items, settings):
        sent = docs.sparkSession.sparkContext.broadcast([text for _, text in rows])

        def make(sent=sent):
            block = ItemBlock(sent.value, settings)
            return lambda texts: [not block.matches(t) for t in texts]

        docs = keep(docs, ["text"], make)
    return docs


# The same rows by brute force: every item against every document's shingles.
SQL = r"""
WITH words AS (
  SELECT item_id, doc_id, w FROM (
    SELECT item_id, NULL::BIGINT AS doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10ffff}]+') AS w
    FROM benchmark
    UNION ALL
    SELECT NULL, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10ffff}]+')
    FROM documents)),
items AS (
  SELECT item_id, least(len(w), 5) AS size,
         unnest(list_distinct([array_to_string(w[i:i + least(len(w), 5) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 5) + 2)])) AS s
  FROM words WHERE item_id IS NOT NULL AND len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
docs AS (
  SELECT doc_id, size,
         unnest(list_distinct([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)])) AS s
  FROM words, sizes WHERE doc_id IS NOT NULL AND len(w) >= size),
counts AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id)
SELECT doc_id, item_id, count(*) / n::DOUBLE AS containment
FROM docs JOIN items USING (size, s) JOIN counts USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= 0.8 * n
"""
