"""BPE encoding over a trie of distinct words, and decoding of the ids.

Words that a task has not met are put into a trie, symbol by symbol. A walk
through it, in the order of the words, gives each node the last token of its prefix: the
longest vocabulary entry that ends there and that the merges leave beside the
last token of what precedes it. The encoding of a prefix is the encoding of the
rest plus that token, so a prefix that many words share is worked out once. A
word's last symbol carries the end-of-word mark and so has a node of its own.

Normalising, splitting and special tokens go by the tokenizer's own file. Words
that a task knows are looked up, up to a bound: of two generations the older goes,
less what was met again. Row-local, without shuffle.

Defined results: NULL and empty texts have no tokens; repeated rows are encoded
each; NULL ids are carried; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from folioflow.llm.batches import measure

# Texts of these characters are normalised and split here; others by the library.
# The blanks among them end every word.
COMMON = re.compile(r"[\t\n\r -~\xa0-\u024f\u2010-\u201f\u2026\u20ac]*")
KNOWN_WORDS = 120_000  # of a generation
KNOWN_CHARS = 16_000_000  # of its words, their ids and their decoded texts
KNOWN_PAIRS = 300_000

# Byte-level vocabularies write a byte as a printable character: most of Latin-1
# as itself, the others in order from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
TO_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
FROM_BYTES = {c: b for b, c in TO_BYTES.items()}
# (size, id) of the tokens that may end at a place, longest first.
Ending = tuple[tuple[int, int], ...]
MEASURED = "n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"


class Vocabulary:
    """Token strings and merges of a BPE file, with the pairs that merges keep."""

    def __init__(self, model: dict) -> None:
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.ranks: dict[tuple[str, str], int] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if not isinstance(merge, str) else merge.split(" ")
            self.ranks.setdefault((a, b), rank)
            whole = a + b
            if whole not in self.halves or self.ranks[a, b] < self.ranks[self.halves[whole]]:
                self.halves[whole] = (a, b)

    def length(self, token: str) -> int:
        """Symbols of a token; the end mark belongs to its last symbol."""
        return len(token) - (len(self.end) if self.end and token.endswith(self.end) and token != self.end else 0)

    def keeps(self, left: str, right: str, below: int = 1 << 60) -> bool:
        """Whether the symbols of ``left`` and ``right``, merged by the rules of
        ranks under ``below``, end in these two tokens.

        The two tokens' merges are undone, latest first; at no stage may a merge
        over the seam come before the merge that was undone.
        """
        a, b, limit = left, right, below
        while True:
            rank = self.ranks.get((a, b))
            if rank is not None and rank < limit:
                return False
            made_a = self.ranks[self.halves[a]] if a in self.halves else -1
            made_b = self.ranks[self.halves[b]] if b in self.halves else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = made_a, self.halves[a][1]
            else:  # of equal merges the left one comes first, and so the seam's
                limit, b = made_b + 1, self.halves[b][0]


class WordTrie:
    """Encodings of words, made together by one walk over their trie.

    Beside the last token, a node has the longest end of its prefix with which a
    token begins. One look-up leads from there over a symbol, and gives the tokens
    that end in that symbol, so none is tried that does not stand there.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.whole: dict[str, bool] = {}
        self.tokens: dict[str, int] = {}
        self.texts = {i: t for t, i in vocabulary.ids.items()}
        # Beginnings of tokens, by number; the first is empty.
        self.begins: dict[str, int] = {"": 0}
        for token, number in vocabulary.ids.items():
            size = vocabulary.length(token)
            if size > 1 and token in vocabulary.halves and self._is_whole(token):
                self.tokens[token] = number
                for stop in range(size if len(token) == size else size - 1, 0, -1):
                    if token[:stop] in self.begins:  # and so are those before it
                        break
                    self.begins[token[:stop]] = len(self.begins)
        self.names = list(self.begins)
        self._forget()
        self.kept: dict[int, bool] = {}
        self.many = max(vocabulary.ids.values(), default=0) + 1

    def _forget(self) -> None:
        """Drops the steps that were kept."""
        self.steps: list[dict[str, tuple[int, Ending]]] = [{} for _ in self.begins]
        self.leaves: list[dict[str, Ending]] = [{} for _ in self.begins]
        self.held = 0

    def _ending(self, tail: str, mark: str) -> Ending:
        """(size, id) of the tokens at the end of ``tail``, longest first."""
        size = len(tail)
        own = [(size - at, self.tokens[tail[at:] + mark]) for at in range(size - 1) if tail[at:] + mark in self.tokens]
        return (*own, (1, self.vocabulary.ids[tail[-1] + mark]))

    def _step(self, begin: int, symbol: str) -> tuple[int, Ending]:
        tail = longest = self.names[begin] + symbol
        while longest not in self.begins:
            longest = longest[1:]
        self.held += 1
        self.steps[begin][symbol] = made = (self.begins[longest], self._ending(tail, ""))
        return made

    def _leaf(self, begin: int, symbol: str) -> Ending:
        self.held += 1
        self.leaves[begin][symbol] = made = self._ending(self.names[begin] + symbol, self.vocabulary.end)
        return made

    def _keeps(self, pair: int) -> bool:
        if len(self.kept) > KNOWN_PAIRS:
            self.kept.clear()
        left, right = divmod(pair, self.many)
        self.kept[pair] = ok = self.vocabulary.keeps(self.texts[left], self.texts[right])
        return ok

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Ids of each distinct word of byte characters.

        In their order the words are the leaves of a walk through the trie, depth
        first: what a word shares with the one before it is the path that stays.
        """
        if self.held > KNOWN_PAIRS:
            self._forget()
        # States by depth: the last token's id, the depth it began at, and the end
        # that begins a token. The ids of a prefix are read back at leaves only.
        numbers: list[int] = [-1]
        began: list[int] = [0]
        states: list[int] = [0]
        steps, leaves, kept, many = self.steps, self.leaves, self.kept.get, self.many
        previous = ""
        for word in sorted(words):
            depth = 1
            for a, b in zip(previous, word):
                if a != b:
                    break
                depth += 1
            # The last symbol of a word is a leaf, and on no other path.
            depth = min(depth, len(previous)) or 1
            previous = word
            del numbers[depth:], began[depth:], states[depth:]
            state = states[-1]
            for symbol in word[depth - 1 : -1]:
                state, ending = steps[state].get(symbol) or self._step(state, symbol)
                for size, number in ending:
                    if size == 1 or size == depth:
                        break
                    pair = numbers[depth - size] * many + number
                    ok = kept(pair)
                    if self._keeps(pair) if ok is None else ok:
                        break
                numbers.append(number)
                began.append(depth - size)
                states.append(state)
                depth += 1
            symbol = word[-1]
            for size, number in leaves[state].get(symbol) or self._leaf(state, symbol):
                if size == 1 or size == depth:
                    break
                pair = numbers[depth - size] * many + number
                ok = kept(pair)
                if self._keeps(pair) if ok is None else ok:
                    break
            coded, at = [number], depth - size
            while at:
                coded.append(numbers[at])
                at = began[at]
            coded.reverse()
            yield word, coded

    def _is_whole(self, token: str) -> bool:
        """Whether the merges make the token of its own symbols."""
        if token not in self.whole:
            halves = self.vocabulary.halves.get(token)
            self.whole[token] = halves is None or (
                self._is_whole(halves[0])
                and self._is_whole(halves[1])
                and self.vocabulary.keeps(*halves, self.vocabulary.ranks[halves])
            )
        return self.whole[token]


class Codec:
    """Encodes and decodes texts as the tokenizer in a file does."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.vocabulary = Vocabulary(content["model"])
        self.trie = WordTrie(self.vocabulary)
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.tokens = {i: t for t, i in {**self.vocabulary.ids, **self.specials}.items()}
        steps = content["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.bytes = {i: t.encode() for i, t in self.tokens.items()}
        # By word: ids and decoded text.
        self.always = {c: (struct.pack("<I", i), c.encode()) for c, i in self.specials.items()}
        self.always[""] = b"", b""  # a text without words
        self.known: dict[str, tuple[bytes, bytes]] = dict(self.always)
        self.older: dict[str, tuple[bytes, bytes]] = {}  # the generation before
        self.held = 0
        self.by_library: set[str] = set()  # words that the library has cut

    @cached_property
    def library(self) -> Tokenizer:
        """For uncommon texts; most tasks never load it."""
        return Tokenizer.from_file(self.path)

    def _clean(self, text: str) -> str:
        """The text in stretches between blanks, each of whole words; special tokens
        are stretches of their own, as they stand in the text."""
        if "<|" in text:
            parts = self.split.split(text)
            return " ".join([w for p in parts for w in ([p] if p in self.specials else self._cut(p))])
        if not COMMON.fullmatch(text):
            return " ".join(self._cut(text))
        if text.isascii():
            return text.lower().strip()
        return unicodedata.normalize("NFC", text).lower().replace("\xa0", " ").strip()

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            clean = text.lower()
        elif COMMON.fullmatch(text):
            clean = unicodedata.normalize("NFC", text).lower()
        else:
            clean = self.library.normalizer.normalize_str(text)
            back = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]
            words = [w.translate(FROM_BYTES).encode("latin-1").decode() for w in back]
            self.by_library.update(words)
            return words
        return self.pattern.findall(clean)

    def _learn(self, stretches: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Encodes the words that are not known, in one trie; what stretches of
        several words make up, which is not kept."""
        find, whole, known, texts = self.pattern.findall, self.by_library, self.known, self.bytes
        gc.disable()  # many small objects without cycles
        try:
            cut = {s: found for s in stretches if not (s.isalpha() or s in whole) and (found := find(s)) != [s]}
            words = stretches.difference(cut).union(*cut.values()).difference(known)
            whole.clear()
            for word in words.intersection(self.older):
                known[word] = a, b = self.older[word]
                self.held += len(word) + len(a) + len(b)
            words.difference_update(self.older)
            as_bytes = {w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(TO_BYTES): w for w in words}
            for coded, ids in self.trie.encode(as_bytes):
                known[as_bytes[coded]] = a, b = struct.pack(f"<{len(ids)}I", *ids), b" ".join([texts[i] for i in ids])
                self.held += len(coded) + len(a) + len(b)
            made = {s: [known[w] for w in parts] for s, parts in cut.items()}
            return {s: (b"".join([m[0] for m in own]), b" ".join([m[1] for m in own])) for s, own in made.items()}
        finally:
            gc.enable()

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by blanks, as without a decoder in the file."""
        return " ".join([self.tokens[i] for i in ids])

    def __call__(self, texts: list[bytes | None]) -> dict[str, list]:
        clean = [self._clean(t.decode("utf-8", "replace")) if t else "" for t in texts]
        stretches = pc.ascii_split_whitespace(pa.array(clean, pa.large_string()))
        coded = stretches.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > KNOWN_WORDS or self.held > KNOWN_CHARS:
            self.older, self.known = self.known, dict(self.always)
            self.held = 0
        several = self._learn(set(distinct).difference(self.known))
        made = [several[s] if s in several else self.known[s] for s in distinct]

        def joined(place: int, between: bytes) -> list[bytes]:
            parts = pa.array([m[place] for m in made], pa.large_binary()).take(coded.indices)
            lists = pa.LargeListArray.from_arrays(stretches.offsets.cast(pa.int64()), parts)
            return pc.binary_join(lists, pa.scalar(between, pa.large_binary())).to_pylist()

        ids = joined(0, b"")
        return {
            "n_tokens": [len(i) // 4 for i in ids],
            "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
            "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in joined(1, b" ")],
        }


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    ``path`` is the tokenizer's file, at the same place on every worker.
    """
    return measure(docs, ["doc_id"], "text", lambda: Codec(path), MEASURED)
