"""Toxicity of whole texts by a convolutional classifier trained in numpy.

Words are looked up in hashed tables, one for the whole word and one for each
of its first 3 to 6 letters, so that an unseen form of a known stem is known
too. The rows of a word's tables lie side by side and form its vector. Filters
of width 1, 2 and 3 slide over the vectors, the largest answer of each filter
in a text is kept, and a logistic unit turns the answers into a score from 0 to
1. A text of any length is read whole: its maximum is taken piece by piece.

Fitting uses a bounded sample of labelled rows (``Settings.sample_docs`` texts
of at most ``sample_chars`` characters). The thresholds come from all labelled
rows that are neither held out nor learned from: they are scored on Spark, and
only (id, language, score) is shuffled to meet the labels. Scoring itself is
row-local, without shuffle. The score sees the text alone. ``lang`` only chooses
the threshold.

Defined results: NULL and empty texts score like a text without known words;
rows without id are scored and count as not held out; a repeated row is scored
each time; labels that are NULL are not used, and a document labelled twice
counts as toxic if one label says so. Without usable labels of both classes all
scores are 0 and nothing is flagged. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, TimestampType

from folioflow.llm.batches import keep, measure

WORD = re.compile(r"\w+")
PREFIXES = (0, 3, 4, 5, 6)  # 0: the whole word
WIDTHS = {1: 12, 2: 4, 3: 4}  # filters by width
PAD = 2  # zero rows after each text: windows from its words stay within it
KNOWN_WORDS = 300_000
KNOWN_CHARS = 32_000_000
SEGMENT = 65_536
BINS = 1_024  # of scores; a power of two, so that a bin's edge is exact


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 5_000
    sample_chars: int = 8_000
    buckets: int = 1 << 17
    values: int = 2
    epochs: int = 6
    batch: int = 64
    rate: float = 0.02
    seed: int = 7
    least_positive: int = 15  # toxic texts a language needs for a threshold of its own


@dataclass
class Model:
    tables: np.ndarray  # (pieces, buckets, values)
    filters: dict[int, np.ndarray]  # width -> (width, vector, filters)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[str | None, float]
    learned: list  # ids trained on


def is_held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text divides by 5; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def piece_buckets(words: list[str], buckets: int) -> np.ndarray:
    """(word, piece) -> bucket. A prefix as long as the word is the word marked."""
    crc, mask = zlib.crc32, buckets - 1
    rows = []
    for word in words:
        raw = word.encode("utf-8", "surrogatepass")
        rows.append([crc(raw) & mask] + [crc(word[:n].encode("utf-8", "surrogatepass"), n) & mask for n in PREFIXES[1:]])
    return np.array(rows, dtype=np.int64).reshape(-1, len(PREFIXES))


class Vocabulary(dict):
    """Word to row number; new words are noted until ``flush`` makes their rows."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.held = 0

    def __missing__(self, word: str) -> int:
        self.held += len(word)
        self[word] = place = len(self)
        self.new.append(word)
        return place


def words_of(raw: bytes | None) -> list[str]:
    return WORD.findall(raw.decode("utf-8", "replace").lower()) if raw else []


# ---------------------------------------------------------------- forward


def responses(vectors: np.ndarray, known: np.ndarray, model: Model) -> list[np.ndarray]:
    """Per width, the filters' answers to the windows from each place of padded
    vectors. At the padding, whose windows may reach the next text, they are 0."""
    out = []
    for width, filters in model.filters.items():
        n = len(vectors)
        answer = vectors @ filters[0]
        for step in range(1, width):
            answer[: n - step] += vectors[step:] @ filters[step]
        answer[~known] = 0
        out.append(answer)
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Scorer:
    """Scores texts with a fitted model; word vectors are kept up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.size = model.tables.shape[0] * model.tables.shape[2]
        self.reset()

    def reset(self) -> None:
        self.vocabulary = Vocabulary()
        self.rows = np.zeros((1024, self.size), dtype=np.float32)

    def _learn(self) -> None:
        new = self.vocabulary.new
        if not new:
            return
        end = len(self.vocabulary)
        if end > len(self.rows):
            grown = np.zeros((2 * end, self.size), dtype=np.float32)
            grown[: len(self.rows)] = self.rows
            self.rows = grown
        found = piece_buckets(new, self.model.tables.shape[1])
        self.rows[end - len(new) : end] = gather(self.model.tables, found)
        new.clear()

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        best = np.full((len(texts), len(self.model.bias)), -np.inf, dtype=np.float32)
        owners: list[int] = []
        parts: list[np.ndarray] = []
        waiting = 0
        for number, raw in enumerate(texts):
            words = words_of(raw)
            for start in range(0, max(1, len(words)), SEGMENT):
                piece = words[start : start + SEGMENT + PAD]
                parts.append(np.fromiter(map(self.vocabulary.__getitem__, piece), np.int64, len(piece)))
                owners.append(number)
                waiting += len(piece)
                if waiting >= SEGMENT:
                    self._pool(best, owners, parts)
                    owners, parts, waiting = [], [], 0
        if parts:
            self._pool(best, owners, parts)
        hidden = np.maximum(best + self.model.bias, 0)
        return logistic(hidden.astype(np.float64) @ self.model.weights + self.model.offset)

    def _pool(self, best: np.ndarray, owners: list[int], parts: list[np.ndarray]) -> None:
        self._learn()
        places, starts = padded(parts)
        known = places >= 0
        vectors = np.where(known[:, None], self.rows[places], np.float32(0))
        answers = responses(vectors, known, self.model)
        pooled = np.concatenate([np.maximum.reduceat(r, starts) for r in answers], axis=1)
        np.maximum.at(best, np.array(owners), pooled)
        if len(self.vocabulary) > KNOWN_WORDS or self.vocabulary.held > KNOWN_CHARS:
            self.reset()


def padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one row of places, each followed by PAD places of -1."""
    gap = np.full(PAD, -1, dtype=np.int64)
    sizes = np.array([len(p) + PAD for p in parts])
    return np.concatenate([x for p in parts for x in (p, gap)]), np.concatenate([[0], np.cumsum(sizes)[:-1]])


def gather(tables: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.concatenate([tables[k][found[:, k]] for k in range(len(tables))], axis=1)


# ---------------------------------------------------------------- fitting


def usable_labels(labels: DataFrame) -> DataFrame:
    """(_id, _toxic) of each labelled id that is not held out."""
    return (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
        .filter(F.col("_id").isNotNull() & F.col("_toxic").isNotNull() & ~is_held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
    )


def learnable(docs: DataFrame, labels: DataFrame, most_chars: int | None = None) -> DataFrame:
    """(_id, _toxic) of the labelled, not held out ids whose text is there, and not too long."""
    fits = F.col("text").isNotNull() if most_chars is None else F.length("text") <= most_chars
    there = docs.filter(fits).select(F.col("doc_id").alias("_id"))
    return usable_labels(labels).join(there, "_id", "left_semi")


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> list:
    """(text, lang, toxic) of a bounded sample of labelled rows that are not held out.

    Of the labelled ids whose text is there, and not too long, those with the
    smallest hashes are taken, ``sample_docs`` of them, which bounds what is
    broadcast and what comes back. Where these are all of one class, half of them
    make room for the first of the other.
    """
    ids = learnable(docs, labels, settings.sample_chars)
    chosen = first_ids(ids, settings.sample_docs)
    classes = {r["_toxic"] for r in chosen}
    if len(classes) == 1:
        others = first_ids(ids.filter(F.col("_toxic") != classes.pop()), max(1, settings.sample_docs // 2))
        chosen = [*chosen[: max(1, settings.sample_docs - len(others))], *others]
    if not chosen:
        return []
    kept = small_frame(docs.sparkSession, chosen, ids.schema)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    found = (
        docs.select(F.col("doc_id").alias("_id"), "text", lang.alias("_lang"))
        .filter(F.length("text") <= settings.sample_chars)
        .join(F.broadcast(kept), "_id")
        .groupBy("_id", "_toxic")
        .agg(F.min(F.struct("text", "_lang")).alias("_d"))
        .select("_id", "_toxic", F.col("_d.text").cast("binary").alias("text"), F.col("_d._lang").alias("lang"))
    )
    return sorted(found.collect(), key=lambda r: r["_id"])


def first_ids(ids: DataFrame, n: int) -> list:
    return ids.orderBy(F.xxhash64("_id"), "_id").limit(n).collect()


def small_frame(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """The rows as a local table. From a list, Spark would start a second set of Python
    workers on each executor to read them."""
    columns = []
    for place, field in enumerate(schema.fields):
        kind, values = to_arrow_type(field.dataType), [r[place] for r in rows]
        if isinstance(field.dataType, TimestampType):  # collected in local time
            values = [v if v is None else v.astimezone() for v in values]
        columns.append(pa.array(values, kind))
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def document_frequency_scores(
    places: list[np.ndarray], toxic: np.ndarray, pieces: np.ndarray, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per piece bucket, how far its toxic share is from the mean, in standard
    deviations; and whether the bucket was seen at all."""
    owner = np.repeat(np.arange(len(places)), [len(p) for p in places])
    flat = np.concatenate(places) if places else np.zeros(0, np.int64)
    rate = toxic.mean()
    scores = np.zeros((len(PREFIXES), buckets), dtype=np.float32)
    seen = np.zeros((len(PREFIXES), buckets), dtype=bool)
    for k in range(len(PREFIXES)):
        pairs = np.unique(owner * buckets + pieces[flat, k])
        texts, bucket = pairs // buckets, pairs % buckets
        total = np.bincount(bucket, minlength=buckets)
        bad = np.bincount(bucket, weights=toxic[texts], minlength=buckets)
        scores[k] = (bad - total * rate) / np.sqrt(total * rate * (1 - rate) + 1)
        seen[k] = total > 0
    return np.clip(scores, -8, 8) / 4, seen


def fit(sample: list, settings: Settings = Settings()) -> Model | None:
    """The model of (_id, text, _toxic) rows; None without both classes.

    A fifth of the rows is not trained on, so that small tables have rows for
    the thresholds too. Until those are set, 0.5 holds for all.
    """
    toxic = np.array([int(r["_toxic"] > 0) for r in sample], dtype=np.int64)
    if len(sample) == 0 or toxic.min() == toxic.max():
        return None
    random = np.random.default_rng(settings.seed)
    vocabulary = Vocabulary()
    places = []
    for row in sample:
        words = words_of(row["text"])
        places.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
    pieces = piece_buckets(list(vocabulary), settings.buckets)
    order = random.permutation(len(sample))
    trained = order[len(sample) // 5 :]
    if toxic[trained].min() == toxic[trained].max():
        trained = order
    scores, seen = document_frequency_scores([places[i] for i in trained], toxic[trained], pieces, settings.buckets)
    model = _start(scores, seen, float(toxic[trained].mean()), settings, random)
    _train(model, places, toxic, pieces, trained, settings, random)
    model.learned = [sample[i]["_id"] for i in trained]
    return model


def _start(scores, seen, rate: float, settings: Settings, random) -> Model:
    """First weights: the first value of a piece is its score, the others are
    small; pieces never seen are zero, so unknown words say nothing."""
    tables = random.normal(0, 0.05, (*scores.shape, settings.values)).astype(np.float32)
    tables[:, :, 0] = scores
    tables *= seen[:, :, None]
    size = len(PREFIXES) * settings.values
    filters = {}
    for width, count in WIDTHS.items():
        first = random.normal(0, 0.1, (width, size, count)).astype(np.float32)
        first[0, :: settings.values] += random.uniform(0, 0.6, (len(PREFIXES), count)).astype(np.float32)
        filters[width] = first
    total = sum(WIDTHS.values())
    return Model(
        tables, filters, np.zeros(total, np.float32), np.full(total, 0.1), float(np.log(rate / (1 - rate))) - 1.0, {None: 0.5}, []
    )


def _train(model: Model, places, toxic, pieces, trained, settings: Settings, random) -> None:
    """Adam on the dense weights, Adagrad on the rows of the tables.

    Max pooling lets the error reach one window per filter and text, so only
    those windows are gathered for the backward step.
    """
    dense = [*model.filters.values(), model.bias, model.weights]
    first, second = [np.zeros_like(w) for w in dense], [np.zeros_like(w) for w in dense]
    squares = np.full(model.tables.shape, 1e-2, dtype=np.float32)
    offsets = np.cumsum([0, *WIDTHS.values()])
    step = 0
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        for start in range(0, len(trained), settings.batch):
            chosen = trained[start : start + settings.batch]
            at, starts = padded([places[i] for i in chosen])
            known = at >= 0
            rows = pieces[np.where(known, at, 0)]
            vectors = gather(model.tables, rows) * known[:, None]
            ends = [*starts[1:], len(at)]
            answers = responses(vectors, known, model)
            where = np.concatenate(
                [np.stack([a + r[a:b].argmax(axis=0) for a, b in zip(starts, ends)]) for r in answers], axis=1
            )
            pooled = np.concatenate(
                [np.take_along_axis(r, where[:, offsets[k] : offsets[k + 1]], 0) for k, r in enumerate(answers)], axis=1
            )
            hidden = np.maximum(pooled + model.bias, 0)
            score = logistic(hidden @ model.weights + model.offset)
            error = (score - toxic[chosen]) / len(chosen)
            back = (error[:, None] * model.weights) * (hidden > 0)
            grads = []
            moved = np.zeros_like(vectors)
            for k, (width, filters) in enumerate(model.filters.items()):
                grad = np.zeros_like(filters)
                own = where[:, offsets[k] : offsets[k + 1]]
                piece = (back[:, offsets[k] : offsets[k + 1]] * known[own]).astype(np.float32)
                for offset in range(width):
                    place = np.minimum(own + offset, len(vectors) - 1)
                    grad[offset] = np.einsum("tf,tfd->df", piece, vectors[place])
                    np.add.at(moved, place, piece[:, :, None] * filters[offset].T[None])
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ error + 1e-4 * model.weights]
            step += 1
            for weight, grad, m, v in zip(dense, grads, first, second):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            model.offset -= rate * float(error.sum())
            touched = np.flatnonzero(known & np.any(moved != 0, axis=1))
            values = settings.values
            for k in range(len(PREFIXES)):
                bucket, grad = rows[touched, k], moved[touched, k * values : (k + 1) * values]
                np.add.at(squares[k], bucket, grad * grad)
                np.subtract.at(model.tables[k], bucket, 0.5 * rate * grad / np.sqrt(squares[k][bucket]))


def best_threshold(total: np.ndarray, toxic: np.ndarray) -> float:
    """Of the cuts whose F1 is within 0.02 of the best, the nearest to 0.5.

    Takes the rows and the toxic rows of each bin; cuts are the bins' edges. A
    small sample says little about the tails, so the result is kept within 0.2
    and 0.8.
    """
    cuts = np.arange(BINS + 1) / BINS
    flagged = np.append(np.cumsum(total[::-1])[::-1], 0)
    hits = np.append(np.cumsum(toxic[::-1])[::-1], 0)
    f1 = 2 * hits / np.maximum(1, flagged + hits[0])
    good = cuts[f1 >= f1.max() - 0.02]
    return float(np.clip(good[np.abs(good - 0.5).argmin()], 0.2, 0.8))


def score_counts(docs: DataFrame, labels: DataFrame, model: Model, least_positive: int) -> DataFrame:
    """(lang, bin, total, toxic) over the labelled rows that are neither held out
    nor learned from, NULL texts left out.

    Languages with fewer toxic rows than ``least_positive``, and rows without
    language, are added up under NULL. A row that is there twice counts twice.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    learned = small_frame(
        docs.sparkSession, [(i,) for i in model.learned], StructType([StructField("_id", docs.schema["doc_id"].dataType)])
    )
    rows = (
        docs.select(F.col("doc_id").alias("_id"), "text", lang.cast("string").alias("_lang"))
        .filter(F.col("text").isNotNull() & F.col("_id").isNotNull() & ~is_held_out(F.col("_id")))
        .join(F.broadcast(learned), "_id", "left_anti")
    )
    edge = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int")
    counts = (
        _scored(rows, ["_id", "_lang"], model)
        .join(usable_labels(labels), "_id")
        .groupBy("_lang", edge.alias("bin"))
        .agg(F.count(F.lit(1)).alias("total"), F.sum((F.col("_toxic") > 0).cast("long")).alias("toxic"))
    )
    return (
        counts.groupBy("_lang")
        .agg(F.sum("toxic").alias("_n"), F.collect_list(F.struct("bin", "total", "toxic")).alias("_bins"))
        .select(F.when(F.col("_n") >= least_positive, F.col("_lang")).alias("lang"), F.inline("_bins"))
        .groupBy("lang", "bin")
        .agg(F.sum("total").alias("total"), F.sum("toxic").alias("toxic"))
    )


def thresholds(counts: list) -> dict[str | None, float]:
    """Threshold by language, and under None, of all rows, the one for the others."""
    by_lang: dict[str | None, np.ndarray] = {None: np.zeros((2, BINS), dtype=np.int64)}
    for r in counts:
        for lang in {None, r["lang"]}:
            by_lang.setdefault(lang, np.zeros((2, BINS), dtype=np.int64))[:, r["bin"]] += (r["total"], r["toxic"])
    return {lang: best_threshold(*own) if own[1].any() else 0.5 for lang, own in by_lang.items()}


# ---------------------------------------------------------------- operators


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Fit on a bounded sample of the labelled documents (doc_id, text, lang), and
    set the thresholds by all labelled documents it has not learned from.

    None where the labelled documents are not of both classes. Where they are, but
    only by texts that are too long for the sample, nothing can be learned and it
    raises: a filter that keeps everything must not go unseen.
    """
    model = fit(training_sample(docs, labels, settings), settings)
    if model is None:
        classes = learnable(docs, labels).select("_toxic").distinct().count()
        if classes > 1:
            raise ValueError("labelled documents are of both classes, but not those short enough to learn from")
    if model is not None:
        model.thresholds = thresholds(score_counts(docs, labels, model, settings.least_positive).collect())
    return model


def _send(docs: DataFrame, model: Model | None):
    """The model's arrays as a broadcast; their size is fixed by the settings."""
    return docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)


def _scored(rows: DataFrame, carried: list[str], model: Model | None) -> DataFrame:
    """``carried`` columns and the score of ``text``, one row per row."""
    sent = _send(rows, model)

    def make():
        if sent.value is None:
            return lambda texts: {"score": [0.0] * len(texts)}
        scorer = Scorer(Model(**sent.value))
        return lambda texts: {"score": scorer(texts)}

    return measure(rows, carried, "text", make, "score DOUBLE")


def toxicity_scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, flagged) of every row.

    ``predicted`` cuts the score at 0.5, ``flagged`` at the language's threshold.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", lang.cast("string").alias("_lang"))
    scored = _scored(rows, ["doc_id", "_lang"], model)
    cut = F.lit(model.thresholds[None] if model else 0.5)
    for name, value in (model.thresholds if model else {}).items():
        if name is not None:
            cut = F.when(F.col("_lang") == name, F.lit(value)).otherwise(cut)
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        cut.alias("threshold"),
        (F.col("score") >= cut).alias("flagged"),
    )


def drop_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents, all columns, whose score is under their language's threshold."""
    sent = _send(docs, model)
    columns = ["text", "lang"] if "lang" in docs.columns else ["text"]

    def make():
        if sent.value is None:
            return lambda texts, *_: [True] * len(texts)
        scorer, cuts = Scorer(Model(**sent.value)), sent.value["thresholds"]

        def kernel(texts, langs=None):
            scores = scorer(texts)
            return [bool(s < cuts.get(x, cuts[None])) for s, x in zip(scores, langs or [None] * len(texts))]

        return kernel

    return keep(docs, columns, make)
