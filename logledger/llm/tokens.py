"""Token ids of whole texts by a byte-level BPE file of the tokenizers library.

The library is asked once for each distinct piece of text in a worker. Pieces are cut where
the tokenizer's own rule always cuts: before a space and around a line break that stand alone
among other characters, and between a word and the punctuation behind it. Texts with any other
white space, or with the string of an added token, go to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa

END = 0
#: Pieces a worker remembers; beyond, it starts anew. Bounds memory, changes no result.
REMEMBERED = 800_000
_ID = np.dtype("<u4")
_COUNTED = "<%dI"
#: Fixed value: white space other than space and line break.
_OTHER_SPACE = (
    "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_ODD = ("\0", "  ", "\n\n", " \n", *_OTHER_SPACE)
_ODD_ASCII = tuple(x for x in _ODD if x.isascii())
#: A word of letters whose class no Unicode version changed, and marks that start no suffix.
_WORD = re.compile(r"( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f]+)([^\w\s'\xb2\xb3\xb9\xbc-\xbe]*)")


def _byte_letters() -> list[str]:
    """Byte-level BPE writes each byte as one printable character: printable Latin-1 stands
    for itself, the others follow from code point 256 on in order."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in itself else next(others)) for b in range(256)]


class Pieces(dict):
    """Piece -> its ids as little-endian 32-bit numbers, found on demand."""

    def __init__(self, path: str, special_as_text: bool = False):
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # By the library's default a special token's string in a text gives its id.
        self.library.encode_special_tokens = special_as_text
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.model = self.library.model
        self.letters = str.maketrans(dict(enumerate(_byte_letters())))

    def whole(self, text: str) -> bytes:
        found = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, _ID).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and (piece[1:] if piece[:1] == " " else piece).isalpha():
            found = self._word(piece)
        elif not (word := _WORD.fullmatch(piece)):
            found = self.whole(piece)
        elif word[2]:
            found = self[word[1]] + self[word[2]]
        else:
            found = self._word(piece)
        self[piece] = found
        return found

    def _word(self, piece: str) -> bytes:
        """One word is one unit of the tokenizer's rule: its BPE model takes it directly."""
        if piece.isascii():
            # Of a word's ASCII characters only the space has another letter.
            shown = piece.replace(" ", self.letters[32])
        else:
            shown = piece.encode().decode("latin-1").translate(self.letters)
        return pack(_COUNTED % len(found := self.model.tokenize(shown)), *[t.id for t in found])

    def ids(self, text: str) -> bytes:
        if any(x in text for x in (_ODD_ASCII if text.isascii() else _ODD)) or any(
            x in text for x in self.added
        ):
            return self.whole(text)
        if len(self) > REMEMBERED:
            self.clear()
        pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.__getitem__, pieces))


@cache
def encoder(path: str, special_as_text: bool = False) -> Pieces:
    """One per Python worker: workers are reused from task to task."""
    return Pieces(path, special_as_text)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def document_ids(text: str | None, pieces: Pieces) -> bytes:
    """Ids of a document with the end id."""
    return pieces.ids(text or "") + END.to_bytes(4, "little")


def encoded(
    path: str | None, batches: Iterator[pa.RecordBatch], special_as_text: bool = False
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches with a column ``text`` and, beside each, the ids of its documents."""
    pieces = encoder(path or default_path(), special_as_text)
    for batch in batches:
        yield batch, [document_ids(t, pieces) for t in batch["text"].to_pylist()]
