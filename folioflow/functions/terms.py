"""Column functions over hashed terms, worked out in Arrow batches.

Interpreted lambdas over arrays cost microseconds a word here; these see a batch at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Distinct words that are Python objects at a time.
WORDS_AT_ONCE = 100_000


def first_bits(words: pa.Array) -> np.ndarray:
    """The first 32 bits of the MD5 of each word."""
    bits = np.empty(len(words), np.uint32)
    for start in range(0, len(words), WORDS_AT_ONCE):
        some = words.slice(start, WORDS_AT_ONCE).cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        digests = b"".join([hashlib.md5(word).digest() for word in some])
        bits[start : start + len(some)] = np.frombuffer(digests, ">u4")[::4]
    return bits


def term_buckets(dims: int = 1024):
    """Buckets of the words of a text, in their order, as a function of a text column.

    ARRAY<INT>: the first 32 bits of a word's MD5, modulo ``dims``; NULL for NULL. Arrow
    splits at the white space of ``functions.text.words`` and leaves empty words at the
    ends of a text. A distinct word of a batch is hashed once.
    """

    @F.arrow_udf("array<int>")
    def buckets(texts: pa.Array) -> pa.Array:
        split = pc.utf8_split_whitespace(texts)
        words = split.flatten()
        coded = words.dictionary_encode()
        terms = (first_bits(coded.dictionary) % dims).astype(np.int32)[coded.indices.to_numpy()]
        full = pc.binary_length(words).to_numpy() > 0
        sizes = pc.list_value_length(split).fill_null(0).to_numpy(zero_copy_only=False)
        ends = from_zero(full)[from_zero(sizes)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(terms[full]), mask=texts.is_null())

    return buckets


def from_zero(sizes: np.ndarray) -> np.ndarray:
    """Where each of the pieces of these sizes begins, and where the last ends."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def term_counts():
    """Counts of the terms of an array, as a function of a column ARRAY<INT>.

    STRUCT<norm2 BIGINT, runs ARRAY<STRUCT<term INT, tf INT>>>: the distinct terms, which are not
    negative, in order, with their frequencies, and the sum of the frequencies' squares.
    """

    @F.arrow_udf("struct<norm2 bigint, runs array<struct<term int, tf int>>>")
    def counts(lists: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists), dtype=np.int64), sizes)
        places, tf = np.unique(row << 32 | lists.flatten().to_numpy(zero_copy_only=False), return_counts=True)
        ends = np.searchsorted(places, np.arange(len(lists) + 1, dtype=np.int64) << 32)
        squares = from_zero(tf * tf)[ends]
        runs = pa.StructArray.from_arrays(
            [pa.array((places & 0xFFFFFFFF).astype(np.int32)), pa.array(tf.astype(np.int32))], ["term", "tf"]
        )
        runs = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), runs)
        return pa.StructArray.from_arrays([pa.array(np.diff(squares)), runs], ["norm2", "runs"])

    return counts
