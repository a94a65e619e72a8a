"""Token ids of public vocabularies, with the pieces between blanks remembered.

Byte-level BPE, word-end BPE and SentencePiece BPE never join tokens over a single blank or line end, so a text is cut
there and a worker encodes a frequent piece once. A text with white space in runs, or with what could be the string of
a special token, is encoded whole. Ids are those of the plain library call, as bytes: unsigned 16-bit little-endian, or
32-bit where the vocabulary needs it.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from unicodedata import is_normalized

#: Pieces of a generation, of which a worker remembers two (about 130 bytes a piece), and the longest piece that it remembers.
MEMO_PIECES, MEMO_CHARS = 600_000, 40
#: A line end, or the text's start, before a piece. Texts that hold these characters are encoded whole.
AFTER_LINE, AT_START = "\x00", "\x01"
#: Punctuation that is always a pre-token of its own behind letters (the apostrophe is not).
_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+([!#$%&()*+,\-./:;<=>?@\[\\\]^`{|}~]+)?")
_RUNS = ("  ", "\n\n", "\n ", " \n")
#: Marks cut off (see HuggingFace.cut) from something else than a letter or digit.
_NOT_CUT = re.compile(" \x01(?<=[\\W_] \x01)")


def byte_letters() -> dict[int, str]:
    """The printable characters that byte-level BPE writes for bytes: printable ones as they are, others from U+0100 on."""
    table, free = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[b] = chr(b)
        else:
            table[b], free = chr(free), free + 1
    return table


class Memo(dict):
    """Piece to id bytes; encode_piece finds what is missing. What the last two generations haven't asked for is forgotten."""

    def __init__(self, encode_piece, limit: int = MEMO_PIECES):
        super().__init__()
        self.encode_piece, self.limit, self.former = encode_piece, limit, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.former.get(piece)
        if found is None:
            found = self.encode_piece(piece)
            if len(piece) > MEMO_CHARS:
                return found
        if len(self) >= self.limit:
            self.former = dict(self)
            self.clear()
        self[piece] = found
        return found


class Encoder:
    """encode(text) gives the ids of a whole text as bytes of .dtype."""

    dtype = "<u2"

    def __init__(self):
        self.memo = Memo(self.piece)

    def pack(self, ids) -> bytes:
        out = array("H" if self.dtype == "<u2" else "I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        if AFTER_LINE in text or AT_START in text or any(x in text for x in _RUNS):
            return self.whole(text)
        if not text or text.isspace() or self.is_special(text):
            return self.whole(text)
        return b"".join(map(self.memo.__getitem__, (AT_START + self.cut(text).replace("\n", " " + AFTER_LINE)).split(" ")))

    def cut(self, text: str) -> str:
        """The text with blanks, and AT_START behind them, where it can be cut besides."""
        return text

    def is_special(self, text: str) -> bool:
        """Whether pieces might give other ids than the text."""
        return False

    def piece(self, piece: str) -> bytes:
        if piece[:1] == AFTER_LINE:
            return self.whole("\n" + piece[1:])
        return self.whole(piece[1:] if piece[:1] == AT_START else " " + piece)

    def whole(self, text: str) -> bytes:
        raise NotImplementedError


class HuggingFace(Encoder):
    """A file of the tokenizers library, with all that the plain call does: the string of a special token in a text becomes that token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = os.path.commonprefix(special)[:2] if special else None
        self.model = self.tokenizer.model
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.spaced = self.tokenizer.encode(" a", add_special_tokens=False).ids != self.tokenizer.encode("a", add_special_tokens=False).ids
        self.folds = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.blank = self.letters[32] if self.spaced else ""
        self.normalises = self.tokenizer.normalizer is not None
        self.line_end = self.whole("\n")
        super().__init__()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def is_special(self, text: str) -> bool:
        return self.special is not None and self.special in text

    def cut(self, text: str) -> str:
        """Full stops and commas between a letter or digit and white space are pre-tokens of their own.

        A normaliser may end a letter in a combining mark, which joins them; lower case does so with one letter alone.
        """
        if self.normalises and ("İ" in text or not is_normalized("NFC", text)):
            return text
        out = text
        for mark in ",.":
            out = out.replace(mark + " ", f" {AT_START}{mark} ").replace(mark + "\n", f" {AT_START}{mark}\n")
        return text if _NOT_CUT.search(out) else out

    def piece(self, piece: str) -> bytes:
        """Letters and the punctuation behind them are pre-tokens: the model alone encodes the letters."""
        mark = piece[0] if piece and piece[0] in (AFTER_LINE, AT_START) else ""
        word = piece[1:] if mark else piece
        plain = _WORD.fullmatch(word)
        if not plain:
            if mark == AFTER_LINE and word and not word[0].isspace():
                return self.line_end + self.memo[AT_START + word]
            return super().piece(piece)
        if at := plain.start(1) + 1:  # where the punctuation begins
            return self.memo[mark + word[: at - 1]] + self.memo[AT_START + word[at - 1 :]]
        if not word.isascii():
            word = (word.lower() if self.folds else word).encode().decode("latin-1").translate(self.letters)
        elif self.folds:
            word = word.lower()
        ids = self.pack([t.id for t in self.model.tokenize(word if mark else self.blank + word)])
        return self.line_end + ids if mark == AFTER_LINE else ids


class SentencePiece(Encoder):
    """A SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.dtype = "<u2" if self.model.vocab_size() <= 1 << 16 else "<u4"
        self.byte_ids = frozenset(i for i in range(self.model.vocab_size()) if self.model.is_byte(i))
        super().__init__()

    def whole(self, text: str) -> bytes:
        return self.pack(self.model.encode(text, num_threads=1))

    def is_special(self, text: str) -> bool:
        return text[0] == " "  # joined with the blank that the model puts before a text

    def piece(self, piece: str) -> bytes:
        """The model itself puts a blank before a text, so a piece after a line end is the line end's ids and the rest."""
        if piece[:1] in (AFTER_LINE, AT_START):
            mark, piece = piece[0], piece[1:]
            if mark == AT_START:
                return self.whole(piece) or self.pack([self.model.piece_to_id("▁")])
            return self.whole("\n" + piece)[self.width("\n") :]
        return self.whole(piece) if piece else self.pack([self.model.piece_to_id("▁")])

    def width(self, text: str) -> int:
        """Bytes that the blank put before a line end takes."""
        ids = self.model.encode(text, num_threads=1)
        return 2 * (len(ids) - 1) if self.dtype == "<u2" else 4 * (len(ids) - 1)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file; a worker keeps it, with its memo, from task to task."""
    return SentencePiece(path) if path.endswith(".model") else HuggingFace(path)


@contextmanager
def only_within(enc: Encoder, limit: int) -> Iterator[None]:
    """Let an encoder remember pieces within the context only, so many a generation: for workers that do other work before and after."""
    enc.memo = Memo(enc.piece, limit)
    try:
        yield
    finally:
        enc.memo = Memo(enc.piece)
