"""Token ids of whole texts by the tokenizers library, as little-endian 32-bit bytes.

A text is cut only where the tokenizer is known to cut as well. The ids of each piece are
remembered, so a frequent word is encoded once a worker and not once an occurrence. Plain pieces
(a run of Latin letters or of ASCII signs, with at most one blank before it) are a single
pre-token and go straight to the library's merge model; all other pieces go through its whole
pipeline. Texts with other white space than blanks and line feeds, and those that hold a special token, are encoded as one piece. The
memory is bounded: a full table is emptied before the next slice of texts.
"""

from __future__ import annotations

import os
import re
from array import array

#: Pieces a worker remembers.
REMEMBERED = 600_000
#: Longer pieces are encoded, not remembered.
LONGEST = 64

OTHER_SPACE = re.compile(r"[^\S \n]")
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: ASCII signs but the apostrophe, which may begin a contraction.
SIGNS = r"!-&(-/:-@\[-`{-~"
#: Each match starts and ends where every byte-level pre-tokeniser starts and ends a token: before
#: a blank that follows something else, and between a whole run of letters and a sign or digit.
PIECE = re.compile(
    rf"[ \n]*[{LETTERS}]+(?=[ \n'0-9{SIGNS}]|\Z)|[ \n]*[{SIGNS}]+(?=[ \n]|\Z)|[ \n]*[^ \n]+|[ \n]+"
)
PLAIN = re.compile(rf" ?(?:[{LETTERS}]+|[{SIGNS}]+)\Z")


def byte_letters() -> dict[int, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the other bytes in order from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()
BLANK = chr(BYTE_LETTERS[32])

_encoders: dict[tuple[str, bool], Encoder] = {}


class Encoder(dict):
    """Ids by piece; what is not remembered yet is encoded on the way.

    ``specials`` says what a special token's string inside a text is: by default the special token, as the library
    has it; with False it is ordinary text.
    """

    def __init__(self, path: str, blanks_matter: bool, specials: bool = True) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        names = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()] if specials else []
        # A text with one of these in it is not cut.
        self.whole = re.compile("|".join([OTHER_SPACE.pattern, *map(re.escape, names)]))
        self.model = self.tokenizer.model
        self.blanks_matter = blanks_matter

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > LONGEST:
            return self.through(piece)
        ids = self.plain(piece) if PLAIN.match(piece) else self.through(piece)
        self[piece] = ids
        return ids

    def through(self, piece: str) -> bytes:
        """The ids of a piece by the library's whole pipeline."""
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def plain(self, piece: str) -> bytes:
        """The ids of one pre-token."""
        if not self.blanks_matter:
            piece = piece.lstrip(" ").lower()
        if piece.isascii():
            # Of the plain ASCII characters only the blank has another letter.
            letters = piece.replace(" ", BLANK)
        else:
            letters = piece.encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        if len(self) > REMEMBERED:
            self.clear()
        look = self.__getitem__
        return [self.through(text) if self.whole.search(text) else b"".join(map(look, PIECE.findall(text))) for text in texts]


def encoder(path: str, blanks_matter: bool) -> Encoder:
    """The worker's encoder for a byte-level vocabulary; ``blanks_matter`` unless the tokenizer
    lower-cases and drops white space."""
    if (path, blanks_matter) not in _encoders:
        _encoders[path, blanks_matter] = Encoder(path, blanks_matter)
    return _encoders[path, blanks_matter]
