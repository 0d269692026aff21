"""SimHash near-duplicates, with candidates found by the pigeonring principle.

A fingerprint of 64 bits is cut into 5 segments that stand in a ring. If two
fingerprints differ in at most 4 bits, then from some segment on the differences
of the first l segments sum to at most 4 * l / 5, rounded down, for every l: the
first segment is equal, the first two differ in at most 1 bit, the first three in
at most 2, and so on. The rule is used twice:

- To find candidates. Within a chain of c segments each segment after the first
  has two halves. Under the budgets at least c - 1 of these halves are equal, of
  which at least k lie in the first k segments for every k. So two linked
  fingerprints agree on one of the keys (start, first segment, c - 1 halves).
  Chains of 3 segments make 25 keys of about 26 bits for each fingerprint.
- To prune. Candidates of a key are checked segment by segment along the chain,
  and only those within every budget reach the full Hamming distance.

Equal fingerprints are one node. A key's fingerprints are compared where Spark
has sorted them together, and only the links that join two groups leave the
task: a key of n fingerprints gives n - 1 links at most, whatever the number of
its pairs. Keys are counted first. Of those with more than ``crowded``
fingerprints the rows go another way, by the values that lie midway: two
fingerprints are within the distance exactly if a value is within half of it, rounded
down, of one and within the rest of the other. Such values are many, and few
fingerprints share one, so a crowded key spreads over all tasks. Each way gives links
that are true and that join the same groups.

Defined results: NULL and empty texts have fingerprint zero and are linked like
any other. Among rows of a component the least id counts, NULL last, so a
component has NULL as its id only if all its rows do. Repeated rows are one
node and each keep their row; of equal rows ``drop_near_copies`` keeps one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import free_name, measure
from folioflow.llm.components import components
from folioflow.session import new_run_folder

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BITS = 64
HASHES_AT_ONCE = 1 << 16
MIDDLES_AT_ONCE = 1 << 20
KIND_SHIFT = 48  # a key's kind stands above its bits
BROADCAST_KEYS = 1_000_000  # keys of 16 bytes that go to every task at most


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    distance: int = 4
    seed: int = 42
    chain: int = 3  # segments that a key takes part in
    crowded: int = 2_048  # fingerprints of a key beyond which its rows are spread


# ---------------------------------------------------------------- fingerprints


def fingerprint(raw: bytes | None, settings: Settings = Settings()) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    words = (raw or b"").translate(LOWER).split()
    if not words:
        return 0
    line, size = b" ".join(words), settings.shingle
    if len(words) <= size:
        return xxhash.xxh64_intdigest(line, settings.seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    digest, seed = xxhash.xxh64_intdigest, settings.seed
    count = len(words) - size + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, HASHES_AT_ONCE):
        stop = min(count, at + HASHES_AT_ONCE)
        spans = zip(begins[at:stop].tolist(), ends[at + size - 1 : stop + size - 1].tolist())
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def with_fingerprints(
    docs: DataFrame, carried: list[str], settings: Settings = Settings(), name: str = "_fp"
) -> DataFrame:
    """``carried`` columns and the fingerprint as a signed long."""

    def make():
        def kernel(texts):
            values = np.array([fingerprint(t, settings) for t in texts], dtype=np.uint64)
            return {name: values.view(np.int64)}

        return kernel

    return measure(docs, carried, "text", make, f"{name} BIGINT")


# ---------------------------------------------------------------- the ring


def ring(distance: int) -> tuple[list[tuple[int, int]], list[np.uint64]]:
    """Halves as (shift, bits), two for each of distance + 1 segments; segment masks."""
    segments = distance + 1
    cuts = [BITS * i // (2 * segments) for i in range(2 * segments + 1)]
    halves = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    masks = [
        np.uint64(sum(((1 << bits) - 1) << shift for shift, bits in halves[2 * i : 2 * i + 2])) for i in range(segments)
    ]
    return halves, masks


def chosen_halves(chain: int) -> list[tuple[int, ...]]:
    """The sets of chain - 1 halves, at least k of them within the first k segments."""
    return [
        halves
        for halves in combinations(range(2 * (chain - 1)), chain - 1)
        if all(sum(h < 2 * k for h in halves) >= k for k in range(1, chain))
    ]


def ring_keys(values: np.ndarray, settings: Settings) -> np.ndarray:
    """(fingerprint, key): the number of the key's kind over its bits."""
    halves, _ = ring(settings.distance)
    parts = [(values >> np.uint64(s)) & np.uint64((1 << b) - 1) for s, b in halves]
    kinds = []
    for start in range(settings.distance + 1):
        for more in chosen_halves(settings.chain):
            used = [2 * start, 2 * start + 1, *[(2 * start + 2 + h) % len(halves) for h in more]]
            key = np.zeros(len(values), dtype=np.uint64)
            for h in used:
                key = (key << np.uint64(halves[h][1])) | parts[h]
            kinds.append(key | np.uint64(len(kinds) << KIND_SHIFT))
    return np.stack(kinds, axis=1)


def within_chain(differing: np.ndarray, start: np.ndarray, settings: Settings) -> np.ndarray:
    """Whether differences stay within budget along the whole ring from ``start``.

    The last budget, over all segments, is the full Hamming distance.
    """
    _, masks = ring(settings.distance)
    segments = len(masks)
    table = np.array(masks, dtype=np.uint64)
    seen = np.zeros(len(differing), dtype=np.int64)
    ok = np.ones(len(differing), dtype=bool)
    left = np.arange(len(differing))
    for step in range(segments):
        mask = table[(start[left] + step) % segments]
        seen[left] += np.bitwise_count(differing[left] & mask)
        passed = seen[left] <= settings.distance * (step + 1) // segments
        ok[left[~passed]] = False
        left = left[passed]
    return ok


# ---------------------------------------------------------------- links


class Groups:
    """Union-find over the positions of one key's fingerprints."""

    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, pairs) -> list[int]:
        """Joins pairs; the positions of those that joined two groups."""
        joined = []
        for place, (a, b) in enumerate(pairs):
            x, y = self.find(a), self.find(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                joined.append(place)
        return joined


def pair_links(values: np.ndarray, start: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Links of one key that join two of its groups, pair by pair."""
    groups = Groups(len(values))
    found_a, found_b = [], []
    for gap in range(1, len(values)):
        a = np.arange(len(values) - gap)
        ok = within_chain(values[a] ^ values[a + gap], np.full(len(a), start), settings)
        hits = a[ok]
        kept = groups.join(zip(hits.tolist(), (hits + gap).tolist()))
        found_a.append(hits[kept])
        found_b.append(hits[kept] + gap)
    return values[np.concatenate(found_a)], values[np.concatenate(found_b)]


def free_bits(kind: int, settings: Settings) -> list[int]:
    """Bits that keys of a kind do not hold, so that may differ among their fingerprints."""
    halves, _ = ring(settings.distance)
    sets = chosen_halves(settings.chain)
    start, more = divmod(kind, len(sets))
    held = {2 * start, 2 * start + 1, *[(2 * start + 2 + h) % len(halves) for h in sets[more]]}
    return [s + i for h, (s, n) in enumerate(halves) if h not in held for i in range(n)]


def flips(free: list[int], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Changes of up to half the distance, rounded up; and which are of it rounded down."""
    sets = [bits for n in range(distance - distance // 2 + 1) for bits in combinations(free, n)]
    masks = np.array([sum(1 << b for b in bits) for bits in sets], dtype=np.uint64)
    return masks, np.array([len(bits) <= distance // 2 for bits in sets])


def midway_links(keyed: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) of the fingerprints (key, _fp) that share a midway value.

    A value has few fingerprints, as they differ from it in few bits. One that is
    within the smaller half is linked to all others; these links are within the
    distance, and any two within it meet at some value in this way.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for kind in np.unique(keys >> KIND_SHIFT).tolist():
                if kind not in known:
                    known[kind] = flips(free_bits(kind, settings), settings.distance)
                masks, near = known[kind]
                own = values[keys >> KIND_SHIFT == kind]
                step = max(1, MIDDLES_AT_ONCE // len(masks))
                for at in range(0, len(own), step):
                    part = own[at : at + step]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((part[:, None] ^ masks).ravel().view(np.int64)),
                            pa.array(np.repeat(part, len(masks)).view(np.int64)),
                            pa.array(np.tile(near, len(part))),
                        ],
                        names=["middle", "_fp", "near"],
                    )

    middles = keyed.mapInArrow(spread, "middle BIGINT, _fp BIGINT, near BOOLEAN")
    return (
        middles.groupBy("middle")
        .agg(F.min(F.when(F.col("near"), F.col("_fp"))).alias("a"), F.collect_set("_fp").alias("all"))
        .filter(F.col("a").isNotNull() & (F.size("all") > 1))
        .select("a", F.explode("all").alias("b"))
        .filter(F.col("a") != F.col("b"))
    )


def key_links(keys: np.ndarray, values: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys; runs are whole and sorted by key."""
    sets = chosen_halves(settings.chain)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)
    begins, sizes = edges[:-1], np.diff(edges)
    kinds = (keys[begins] >> KIND_SHIFT).astype(np.int64)
    out_a, out_b = [], []
    # Keys of two or three fingerprints, nearly all of them, are done at once.
    for a, b in ((0, 1), (1, 2), (0, 2)):
        own = (sizes > b) & (sizes <= 3)
        left, right = values[begins[own] + a], values[begins[own] + b]
        ok = within_chain(left ^ right, kinds[own] // len(sets), settings)
        out_a.append(left[ok])
        out_b.append(right[ok])
    for run in np.flatnonzero(sizes > 3):
        own = values[begins[run] : begins[run] + sizes[run]]
        a, b = pair_links(own, int(kinds[run]) // len(sets), settings)
        out_a.append(a)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(nodes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, b): links between distinct fingerprints ``_fp`` that connect all that
    are within the distance of each other.

    Crowded keys are written to the shared folder; there is one for ``crowded``
    rows at most, and mostly none.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = ring_keys(values, settings)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(values, keys.shape[1]).view(np.int64))],
                names=["key", "_fp"],
            )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        waiting = [none]  # the last key seen, which may go on in the next batch

        def linked(parts):
            keys, values = (np.concatenate(x) for x in zip(*parts))
            a, b = key_links(keys, values, settings)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            ended = waiting[-1][0]
            if last or (len(ended) and ended[-1] != keys[-1]):
                yield linked([*waiting, (keys[:last], values[:last])])
                waiting = [none]
            waiting.append((keys[last:], values[last:]))
        yield linked(waiting)

    spark = nodes.sparkSession
    folder = new_run_folder(spark, "crowded-keys")
    keyed = nodes.select("_fp").mapInArrow(spread, "key BIGINT, _fp BIGINT")
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    counts.filter(F.col("n") > settings.crowded).select("key").write.parquet(folder)
    crowded = spark.read.schema("key BIGINT").parquet(folder)
    if crowded.isEmpty():
        calm, busy = keyed, None
    else:
        calm, busy = keyed.join(crowded, "key", "left_anti"), keyed.join(crowded, "key", "left_semi")
    found = calm.repartition("key").sortWithinPartitions("key").mapInArrow(link, "a BIGINT, b BIGINT")
    return found if busy is None else found.unionByName(midway_links(busy, settings))


# ---------------------------------------------------------------- operators


def _classes(rows: DataFrame, settings: Settings) -> DataFrame:
    """(_fp, _first, _root) of distinct fingerprints from (doc_id, _fp)."""
    spark = rows.sparkSession
    folder = new_run_folder(spark, "simhash")
    rows.groupBy("_fp").agg(F.min("doc_id").alias("_first")).write.parquet(f"{folder}/nodes")
    nodes = spark.read.schema(f"_fp BIGINT, _first {rows.schema['doc_id'].dataType.simpleString()}").parquet(
        f"{folder}/nodes"
    )
    found = components(links(nodes, settings)).withColumnRenamed("node", "_fp")
    return nodes.join(found, "_fp", "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root")
    )


def simhash_components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of (doc_id, text)."""
    spark = docs.sparkSession
    path = f"{new_run_folder(spark, 'fingerprints')}/rows"
    rows = with_fingerprints(docs, ["doc_id"], settings)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    classes = _classes(rows, settings)
    least = classes.groupBy("_root").agg(F.min("_first").alias("component_id"))
    ids = classes.join(least, "_root").select("_fp", "component_id")
    return rows.join(ids, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def judged_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(_k, _i, n, stays) of each distinct text and id, as hashes, with the number of its rows.

    Of each component the row of the least id stays, NULL last. Where that id has
    several texts in the component, the one with the least fingerprint, and of these
    the one that hashes least.
    """
    spark = docs.sparkSession
    path = f"{new_run_folder(spark, 'fingerprints')}/rows"
    keyed = docs.select("doc_id", "text", *[key.alias(name) for name, key in text_keys().items()])
    rows = with_fingerprints(keyed, ["doc_id", *text_keys()], settings)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "_fp", "_k", "_i")
    texts = (
        rows.join(_classes(rows, settings).select("_fp", "_root"), "_fp")
        .groupBy("_root", "_k", "_i")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_order"))
    )
    first = texts.groupBy("_root").agg(F.min("_order").alias("_first"))
    stays = (F.col("_k") == F.col("_first._k")) & (F.col("_i") == F.col("_first._i"))
    return texts.join(first, "_root").select("_k", "_i", "n", stays.alias("stays"))


def text_keys() -> dict[str, Column]:
    return {"_k": F.xxhash64("text"), "_i": F.xxhash64("doc_id")}


def drop_near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns: of each component one row, as ``judged_texts`` says.

    What goes is a table of hashes, which is counted. Texts meet it without being
    shuffled up to ``BROADCAST_KEYS`` rows, and are shuffled once beyond. Of rows of one
    id and text that stays one is kept; only those are brought together.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "near-copies")
    judged_texts(docs, settings).write.parquet(f"{folder}/judged")
    judged = spark.read.schema("_k BIGINT, _i BIGINT, n BIGINT, stays BOOLEAN").parquet(f"{folder}/judged")
    names = {name: free_name(docs, name) for name in text_keys()}
    keyed = docs.withColumns({names[name]: key for name, key in text_keys().items()})
    tables = []
    for kind, test in (("gone", ~F.col("stays") | (F.col("n") > 1)), ("repeated", F.col("stays") & (F.col("n") > 1))):
        judged.filter(test).select(*[F.col(a).alias(b) for a, b in names.items()]).write.parquet(f"{folder}/{kind}")
        keys = spark.read.schema(f"`{names['_k']}` BIGINT, `{names['_i']}` BIGINT").parquet(f"{folder}/{kind}")
        tables.append(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys)
    gone, repeated = tables
    on = list(names.values())
    single = keyed.join(gone, on, "left_anti")
    return single.unionByName(keyed.join(repeated, on, "left_semi").dropDuplicates(on)).select(*docs.columns)
