"""Fixed-size chunks of documents and their hashed term vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.terms import term_buckets, term_counts
from folioflow.functions.text import words

# Ours: the reference names the fixed-size strategy but no sizes in words.
CHUNK_WORDS = 60
CHUNK_OVERLAP = 12
DIMS = 1024

# Source attributes that ride along on every chunk where the table has them.
ATTRIBUTES = ("source_filename", "source_modality", "extractor", "lang")


def chunk_fixed(documents: DataFrame, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Documents cut into overlapping chunks of ``size`` words.

    (chunk_id, doc_key, chunk_no, text, attributes...). The last chunk starts
    where words remain that no chunk before it holds. Blank text has no chunk.
    Row-local: a generator over slices of the row's own word array.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap
    carried = [c for c in ATTRIBUTES if c in documents.columns]
    worded = documents.select("doc_key", *carried, words(F.col("text")).alias("_w"))
    last = F.greatest(F.ceil((F.size("_w") - overlap) / step).cast("int") - 1, F.lit(0))
    pieces = F.transform(
        F.when(F.size("_w") > 0, F.sequence(F.lit(0), last)),
        lambda i: F.array_join(F.slice(F.col("_w"), i * step + 1, size), " "),
    )
    # posexplode_outer, then a filter: see pii_spans.
    return (
        worded.select("doc_key", *carried, F.posexplode_outer(pieces).alias("chunk_no", "text"))
        .filter(F.col("chunk_no").isNotNull())
        .select(
            F.concat_ws(":", F.col("doc_key").cast("string"), "chunk_no").alias("chunk_id"),
            "doc_key",
            "chunk_no",
            "text",
            *carried,
        )
    )


def hash_vectors(texts: DataFrame, id_column: str, dims: int = DIMS) -> DataFrame:
    """Hashed term vectors in the packed form that searching reads.

    (id, terms ARRAY<INT>): the bucket of every lower-cased word, repeats kept,
    so frequencies and lengths are whole numbers wherever they are summed up.
    """
    return texts.select(F.col(id_column).alias("id"), term_buckets(dims)(F.lower("text")).alias("terms"))


def embed_chunks(chunks: DataFrame, dims: int = DIMS) -> DataFrame:
    """Unit-length hashed vectors in long form: (chunk_id, bucket, tf, weight).

    Frequencies are counted inside the row, so nothing is shuffled. The norm is made
    before the rows of terms: beside a generator it would be made again for each of them.
    """
    counted = hash_vectors(chunks, "chunk_id", dims).select("id", term_counts()("terms").alias("counts"))
    normed = counted.select("id", F.sqrt(F.col("counts.norm2").cast("double")).alias("norm"), F.col("counts.runs").alias("runs"))
    return (
        normed.select(F.col("id").alias("chunk_id"), "norm", F.explode_outer("runs").alias("v"))
        .filter(F.col("v").isNotNull())
        .select(
            "chunk_id",
            F.col("v.term").alias("bucket"),
            F.col("v.tf").alias("tf"),
            (F.col("v.tf") / F.col("norm")).alias("weight"),
        )
    )


def embed_with_model(chunks: DataFrame, embed_batch, dims: int) -> DataFrame:
    """Vectors from a model instead: (chunk_id, embedding ARRAY<FLOAT>).

    ``embed_batch`` makes, once per task, a function from a list of texts to a
    list of vectors; texts reach it in Arrow batches.
    """

    def run(batches):
        model = embed_batch()
        for frame in batches:
            vectors = [list(map(float, v)) for v in model(list(frame["text"]))]
            if any(len(v) != dims for v in vectors):
                raise ValueError(f"the model's vectors do not have {dims} values")
            yield frame[["chunk_id"]].assign(embedding=vectors)

    return chunks.select("chunk_id", "text").mapInPandas(run, "chunk_id string, embedding array<float>")
