"""Token counts of whole texts by rank-synchronous merging of a BPE vocabulary with word ends.

The tokenizer file gives the vocabulary and the order of merges; the merging is done here. All
pre-tokens of a batch of texts that were not met before lie in one flat array of symbols. Each
round looks up the ranks of all neighbouring pairs, finds the lowest of every pre-token and
merges it there at every place, in all pre-tokens at once. Pre-tokens without a known pair leave
the array; the symbols they have left are their tokens. Since every symbol is made by one pair
only (checked when the file is read), a merge never makes a pair of lower rank, so the rounds
give what merging one pair at a time does.

Texts of ordinary Latin letters are cut into pre-tokens by one expression; all others go through
the file's own normalizer and pre-tokenizer. Both are cut at spaces into blocks first, which
changes nothing, as no pre-token holds a space.

Null and empty texts have no tokens. Repeated rows are counted each, ids may be null, other
columns are not looked at; an empty table gives an empty result. A special token's string in a
text is one token, as the library has it. Memory grows with the longest run without a space.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logledger.llm.staging import text_batches

LIMIT = 2048
#: Pre-tokens a worker remembers; beyond, it starts anew. Bounds memory, changes no result.
REMEMBERED = 1_000_000
#: Characters cut into pre-tokens at once, and pre-tokens' characters merged at once.
BLOCK = 1 << 18
WAITING = 1 << 20
_FAR = np.iinfo(np.int64).max
#: Letters, white space and signs whose class, lower case and composition are the same in every
#: version of Unicode. Texts with any other character go to the file's own rules.
_LETTERS = "a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-įı-ňŊ-ž"
_PLAIN = re.compile(rf"[ -~\n\t\xa1-\xa9\xab\xac\xae-\xb1\xb6\xb7\xbb\xbf{_LETTERS}–—‘-„…€]*")


def _expression(pattern: str) -> re.Pattern:
    """The file's pattern over the characters of ``_PLAIN``."""
    letters = "a-z\xdf-\xf6\xf8-ž"
    return re.compile(
        pattern.replace(r"[\p{L}]", f"[{letters}]")
        .replace(r"[\p{N}]", "[0-9]")
        .replace(r"\p{L}", letters)
        .replace(r"\p{N}", "0-9")
    )


class Merges:
    """The vocabulary's symbols as numbers and its merges as a sorted table of pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = [t["content"] for t in held["added_tokens"]]
        self.pattern = _pattern(held["pre_tokenizer"])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) != len(made):
            raise ValueError("a symbol is made by two merges: rounds by rank would not be exact")
        self.width = max(self.ids.values()) + 1
        keys = np.array([self.ids[a] * self.width + self.ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made

    def symbols(self, shown: str) -> list[int]:
        """The first symbols of a pre-token: its characters, the last with the word's end."""
        return [*(self.ids[c] for c in shown[:-1]), self.ids[shown[-1] + self.end]]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _FAR)

    def counts(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token (of one character or more, in byte letters)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter((s for p in pieces for s in self.symbols(p)), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(pieces)), lengths)
        found = np.zeros(len(pieces), np.int64)
        while len(flat):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            rank = np.full(len(flat), _FAR)
            rank[:-1] = self._pair_ranks(flat[:-1], flat[1:])
            rank[first[1:] - 1] = _FAR  # a pair ends with its pre-token
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(first, append=len(flat))
            done = lowest == _FAR
            found[owner[first[done]]] = sizes[done]
            merged = (rank == np.repeat(lowest, sizes)) & (rank != _FAR)
            # Of places side by side (as in three equal symbols) every other one, from the left.
            places = np.flatnonzero(merged)
            chain = np.flatnonzero(np.diff(places, prepend=-2) != 1)
            turn = np.arange(len(places)) - np.repeat(chain, np.diff(chain, append=len(places)))
            places = places[turn % 2 == 0]
            flat[places] = self.made[rank[places]]
            kept = np.repeat(~done, sizes)
            kept[places + 1] = False
            flat, owner = flat[kept], owner[kept]
        return found


def _pattern(rule: dict) -> str:
    rules = rule.get("pretokenizers", [rule])
    return next(r["pattern"]["Regex"] for r in rules if r["type"] == "Split")


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text in parts cut before spaces."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


class Counter(dict):
    """Pre-token -> its number of tokens; texts ask for many at once."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        self.expression = _expression(self.merges.pattern)
        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        self.special = re.compile("|".join(map(re.escape, self.merges.special)) or r"(?!)")

    def _pieces(self, block: str) -> list[str]:
        """Pre-tokens of a block without special tokens, in lower case letters (plain texts) or
        marked as byte letters already."""
        if _PLAIN.fullmatch(block):
            return self.expression.findall(block.lower())
        shown = self.normalizer.normalize_str(block)
        return ["\0" + p for p, _ in self.cutter.pre_tokenize_str(shown)]

    def _learn(self, pieces: set[str]) -> None:
        new = list(pieces)
        shown = [p[1:] if p[0] == "\0" else p.encode().decode("latin-1").translate(_LETTER) for p in new]
        self.update(zip(new, self.merges.counts(shown).tolist(), strict=True))

    def of(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text."""
        total: list[int] = []
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            if len(self) > REMEMBERED:
                self.clear()
            new = {p for _, pieces in waiting for p in pieces if p not in self}
            if new:
                self._learn(new)
            for number, pieces in waiting:
                total[number] += sum(map(self.__getitem__, pieces))
            waiting.clear()

        for number, text in enumerate(texts):
            text = text or ""
            total.append(0)
            for block in blocks(text):
                parts = self.special.split(block)
                total[number] += len(parts) - 1
                waiting += [(number, self._pieces(p)) for p in parts if p]
                held += len(block)
                if held > WAITING:
                    settle()
                    held = 0
        settle()
        return total


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one printable character: printable Latin-1
    stands for itself, the others follow from code point 256 on in order."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in itself else next(others)) for b in range(256)}


_LETTER = str.maketrans(_byte_letters())


@cache
def counter(path: str) -> Counter:
    """One per Python worker: workers are reused from task to task."""
    return Counter(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def _counts_task(path: str | None, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = counter(path or default_path())
    for batch in batches:
        texts = batch["text"].to_pylist()
        tokens = np.array(counts.of(texts), np.int64)
        sizes = [len((t or "").encode()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
            [c.split()[0] for c in _COUNTS.split(", ")],
        )


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document. One scan, no shuffle."""
    text_batches(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text")
    return rows.mapInArrow(partial(_counts_task, path, limit), _COUNTS)
