"""Token ids of public tokenizer files, with a cache of the pieces between blanks.

The pre-tokenizers of both files end a token before a single blank between two visible
characters, and neither normaliser looks across one.  So a text's ids are the ids of its pieces in a row, and a piece
that was met before needs no second encoding.  Where blanks stand beside other white space
the pieces stay together.

Texts in Latin letters with single blanks and line breaks are cut further, at every change between letters and
others, since a run of letters is a pre-token of its own unless an apostrophe comes before it.  A new word of
Latin letters goes straight to the tokenizer's model.  Every other piece goes through the whole tokenizer.

Many such texts are cut at once as arrays of bytes, so that a piece is looked up once for all its occurrences in them.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import pyarrow as pa  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: Pieces a worker remembers unless told otherwise, and the longest piece it does.
CACHE_PIECES = 400_000
CACHE_LENGTH = 64
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)")
_WITH_BLANK = re.compile(rf" ?[{_LETTERS}]+|[^{_LETTERS}]+?(?= ?[{_LETTERS}]|\Z)")
_WITHOUT_BLANK = re.compile(rf"[{_LETTERS}]+|[^{_LETTERS} ]+")
#: Whether a Latin-1 byte is a letter.
_IS_LETTER = np.array([bool(re.match(f"[{_LETTERS}]", chr(b))) for b in range(256)])


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level files: itself if visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder(dict):
    """Ids of a tokenizer file as unsigned 32-bit little-endian bytes, by piece (text, or the bytes of Latin-1 text)."""

    def __init__(self, path: str, pieces: int = CACHE_PIECES) -> None:
        super().__init__()
        self.room = pieces
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        probe = self.tokenizer.normalizer.normalize_str("A é") if self.tokenizer.normalizer else "A é"
        self.lower = probe == "a é"
        self.keeps_blank = self._whole(" a") != self._whole("a")
        self.plain = all(self._whole(p) == self._straight(p) for p in (" Éab", "ab", " a", "Zß"))
        self.cut = _WITH_BLANK if self.keeps_blank else _WITHOUT_BLANK

    def _whole(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _straight(self, piece: str) -> bytes | None:
        """Ids of a plain word, None for other pieces."""
        if piece.isascii():
            word = piece[1:] if piece[0] == " " else piece
            if not word.isalpha():
                return None
            made = word.lower() if self.lower else word
            if self.keeps_blank and word is not piece:
                made = self.letters[32] + made
            return array("I", [t.id for t in self.model.tokenize(made)]).tobytes()
        parts = _PLAIN.fullmatch(piece)
        if not parts:
            return None
        blank, word = parts.groups()
        made = (blank if self.keeps_blank else "") + (word.lower() if self.lower else word)
        if blank or not made.isascii():
            made = made.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(made)]).tobytes()

    def __missing__(self, piece: str | bytes) -> bytes:
        text = piece.decode("latin-1") if isinstance(piece, bytes) else piece
        ids = self._straight(text) if self.plain else None
        if ids is None:
            ids = self._whole(text)
        if len(piece) <= CACHE_LENGTH:
            self[piece] = ids
        return ids

    def _stands_alone(self, text: str) -> bool:
        """No white space beside other white space, no contraction, no special token: words stand alone."""
        apart = "  " not in text and " \n" not in text and "\n " not in text and "\n\n" not in text and text[:1] != " " and text[-1:] != " "
        return self.plain and apart and _is_latin(text) and text.replace("\n", "").isprintable()

    def pieces(self, text: str) -> list[str]:
        if self._stands_alone(text):
            return self.cut.findall(text.lower() if self.lower else text)
        parts = text.split(" ")
        pieces = [parts[0], *[" " + p for p in parts[1:]]]
        # a cut needs a visible character on either side
        out, open_ = [], True
        for piece in pieces:
            joined = open_ or len(piece) < 2 or piece[1].isspace()
            if joined and out:
                out[-1] += piece
            else:
                out.append(piece)
            open_ = not piece or piece[-1].isspace()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, without special tokens of its own."""
        if len(self) > self.room:
            self.clear()
        return [b"".join(map(self.__getitem__, self.pieces(t))) for t in texts]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """As ``encode``, with the pieces of all texts of single words looked up together; best with some MB of text."""
        if not self.keeps_blank:
            return self.encode(texts)
        alone = [i for i, text in enumerate(texts) if text and self._stands_alone(text)]
        others = sorted(set(range(len(texts))).difference(alone))
        out = [b""] * len(texts)
        for i, ids in zip(others, self.encode([texts[i] for i in others]), strict=True):
            out[i] = ids
        if alone:
            for i, ids in zip(alone, self._joint([(texts[i].lower() if self.lower else texts[i]).encode("latin-1") for i in alone]), strict=True):
                out[i] = ids
        return out

    def _joint(self, texts: list[bytes]) -> list[bytes]:
        """The ids of Latin-1 texts that are not empty and whose words stand alone."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.cumsum([0, *map(len, texts)])
        letter = _IS_LETTER.take(data)
        cut = np.zeros(len(data) + 1, bool)
        cut[starts] = True
        # a piece ends behind letters, and begins at letters or at the blank before them
        turns = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        cut[turns - (letter.take(turns) & (data.take(turns - 1) == 32))] = True
        ends = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
        found = pieces.dictionary_encode()
        known = list(map(self.__getitem__, found.dictionary.to_numpy(zero_copy_only=False)))
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, first = np.frombuffer(b"".join(known), np.uint32), np.cumsum(size) - size
        which = found.indices.to_numpy()
        sizes = size.take(which)
        behind = np.cumsum(sizes)
        places = np.repeat(first.take(which) - (behind - sizes), sizes)
        places += np.arange(len(places))
        raw = ids.take(places).tobytes()
        bounds = (4 * np.concatenate([[0], behind]).take(np.searchsorted(ends, starts))).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


def _is_latin(text: str) -> bool:
    """Whether all is Latin-1, whose lower case goes letter by letter, without what parts words or marks special tokens."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "'" not in text and "<" not in text


@lru_cache(maxsize=4)
def encoder(name: str, pieces: int = CACHE_PIECES) -> Encoder:
    """The encoder of a file of the public tokenizers (or of a path), read once in a worker, which remembers about so many pieces."""
    return Encoder(name if os.path.isabs(name) else public_tokenizers.path(name), pieces)
