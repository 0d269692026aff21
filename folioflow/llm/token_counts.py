"""Token counts from piece counts of distinct pre-tokens, without any ids.

A text is cut before each run of white space. The byte-level pattern never
joins characters over such a cut, so the tokens of a text are those of its
pre-tokens together. In each task the pieces of a distinct pre-token are counted
once, by the tokenizers library; the counts are then met with each text's own
frequencies, and only sums leave the task. Counted pre-tokens are kept up to a
bound of their number and of their characters.

The two tables are met inside the tasks and not by a shuffle: at 0.5 GB of
documents the frequencies have 70 million rows of text and pre-token, several
times the input in shuffled bytes.

Defined results: NULL and empty texts have 0 tokens and 0 bytes; repeated rows
are counted each; NULL ids are carried; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter

from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from folioflow.llm.batches import measure

# White space as Unicode has it; Python's own class has four control characters more.
_WHITE = "\t-\r \x85\xa0  -     　"
PRETOKEN = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
KNOWN = 400_000
KNOWN_CHARS = 32_000_000
LIMIT = 1_024
MEASURED = "n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"


class PieceCounter:
    def __init__(self, path: str, limit: int = LIMIT) -> None:
        # The library's threads keep caches of words that outlive their tokenizer,
        # so a worker would grow with each task. A task is one thread's work, and
        # no pre-token is counted twice, so neither is of use here.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.model._resize_cache(0)
        self.library.no_truncation()
        self.library.no_padding()
        self.limit = limit
        self.pieces: dict[str, int] = {}
        self.held = 0

    def _count(self, pretokens: list[str]) -> None:
        for start in range(0, len(pretokens), 10_000):
            part = pretokens[start : start + 10_000]
            coded = self.library.encode_batch_fast(part, add_special_tokens=False)
            self.pieces.update(zip(part, map(len, coded)))
        self.held += sum(map(len, pretokens))

    def __call__(self, texts: list[bytes | None]) -> dict[str, list]:
        frequencies = [Counter(PRETOKEN.findall(t.decode("utf-8", "replace"))) if t else {} for t in texts]
        if len(self.pieces) > KNOWN or self.held > KNOWN_CHARS:
            self.pieces.clear()
            self.held = 0
        self._count(list(set().union(*frequencies).difference(self.pieces)))
        pieces = self.pieces
        totals = [sum(n * pieces[p] for p, n in own.items()) for own in frequencies]
        return {
            "n_bytes": [len(t or b"") for t in texts],
            "n_tokens": totals,
            "over_limit": [n > self.limit for n in totals],
        }


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    ``path`` is the tokenizer's file, at the same place on every worker.
    """
    return measure(docs, ["doc_id"], "text", lambda: PieceCounter(path, limit), MEASURED)
