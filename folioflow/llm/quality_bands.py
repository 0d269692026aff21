"""Quality rules by compression: zstandard ratios within bands for the length.

The ratio is compressed over plain UTF-8 bytes, of the whole text and of chunks
of a fixed size. A low ratio means the text repeats itself, a high one that it
is not language (keys, encoded data). Short texts compress badly and long ones
well, so each length has limits of its own. The whole text has to lie within
its band, and at most a fixed share of its chunks may lie outside of theirs; so
a long text is not saved by its good parts from being half junk.

Base counts are taken over words ``[^\\x20\\x09-\\x0D]+`` of the whole text; a
text of fewer than 20 words, or with over 30 % of its words in repeated windows
of 8 words, fails before any compression.

Defined results: NULL and empty texts have no words and fail the base; repeated
rows are judged each; NULL ids are carried; other columns are ignored by
``quality_verdicts`` and kept by ``keep_good``. Row-local, without shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from folioflow.llm.batches import keep, measure

WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"

# (texts under this many bytes, lowest ratio, highest ratio)
Band = tuple[float, float, float]
BANDS: tuple[Band, ...] = (
    (128, 0.40, 1.60),
    (256, 0.42, 0.98),
    (512, 0.43, 0.86),
    (1_024, 0.41, 0.77),
    (2_048, 0.38, 0.70),
    (4_096, 0.36, 0.66),
    (8_192, 0.34, 0.63),
    (16_384, 0.32, 0.62),
    (65_536, 0.29, 0.61),
    (float("inf"), 0.22, 0.60),
)


@dataclass(frozen=True)
class Limits:
    bands: tuple[Band, ...] = BANDS
    chunk: int = 4_096
    chunk_band: tuple[float, float] = (0.30, 0.66)
    bad_chunks: float = 0.25  # share of chunks that may be outside
    level: int = 3
    least_words: int = 20
    window: int = 8
    repeated_percent: int = 30


MEASURED = (
    "n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT, "
    "base_failed BOOLEAN, kept BOOLEAN, ratio DOUBLE, n_chunks BIGINT, n_bad_chunks BIGINT"
)


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows that are found twice or more, the first included.

    Windows are compared by hash first; only where hashes meet are they ranked
    exactly, by doubling: the rank of 2k words comes from two ranks of k words.
    """
    places = len(words) - window + 1
    if places < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(places, dtype=np.uint64)
    for step in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[step : step + places]
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    known: dict[bytes, int] = {}
    ranks = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    for step in range(1, window):  # ranks of windows of step + 1 words
        single = ranks if step == 1 else grown
        pairs = single[:-1] * len(words) + ranks[step:] if step > 1 else ranks[:-1] * len(words) + ranks[1:]
        grown = np.unique(pairs, return_inverse=True)[1]
    seen = np.bincount(grown)
    twice = np.flatnonzero(seen[grown] > 1)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def chunks(raw: bytes, size: int) -> list[bytes]:
    """Pieces of ``size`` bytes; a rest under half a piece joins the one before."""
    count = max(1, (len(raw) + size // 2) // size)
    return [raw[i * size : (i + 1) * size if i < count - 1 else len(raw)] for i in range(count)]


class Judge:
    """Counts and verdict of texts; one compressor per task."""

    def __init__(self, limits: Limits = Limits()) -> None:
        self.limits = limits
        self.zstd = zstandard.ZstdCompressor(level=limits.level)

    def _ratio(self, raw: bytes) -> float:
        return len(self.zstd.compress(raw)) / len(raw)

    def one(self, raw: bytes | None) -> tuple:
        limits = self.limits
        raw = raw or b""
        words = raw.split()
        bare = len(raw.translate(None, WHITE))
        continuation = len(raw) - len(raw.decode("utf-8", "replace")) if raw else 0
        lines = [x for x in raw.split(b"\n") if x.strip()]
        repeated = repeated_words(words, limits.window)
        failed = len(words) < limits.least_words or 100 * repeated > limits.repeated_percent * len(words)
        ratio, parts, outside, kept = None, 0, 0, False
        if raw:
            ratio = self._ratio(raw)
            low, high = next(b[1:] for b in limits.bands if len(raw) < b[0])
            pieces = chunks(raw, limits.chunk)
            if len(raw) >= 2 * limits.chunk:
                parts = len(pieces)
                outside = sum(not limits.chunk_band[0] <= self._ratio(p) <= limits.chunk_band[1] for p in pieces)
            kept = not failed and low <= ratio <= high and outside <= limits.bad_chunks * parts
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        return (
            len(words), bare - continuation, symbols, len(lines) - len(set(lines)), repeated,
            failed, kept, ratio, parts, outside,
        )

    def __call__(self, texts: list[bytes | None]) -> dict[str, list]:
        names = [part.split()[0] for part in MEASURED.split(", ")]
        rows = [self.one(t) for t in texts]
        return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}


def quality_verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, counts, base_failed, kept, ratio, chunk counts) of every row.

    ``ratio`` is NULL for empty texts; chunks are counted for texts of two or more.
    """
    return measure(docs, ["doc_id"], "text", lambda: Judge(limits), MEASURED)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents, all columns, that are kept."""

    def make():
        judge = Judge(limits)
        return lambda texts: [judge.one(t)[6] for t in texts]

    return keep(docs, ["text"], make)
