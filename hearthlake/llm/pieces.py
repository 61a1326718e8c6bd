"""Pre-tokens of a text, cut as the word tokenizer cuts them, and the ids of one pre-token.

A text of letters below U+0250, digits, ASCII punctuation and white space ("plain") is lower-cased and
cut by one pattern. In any other text, words between ASCII white space that are not plain stay
whole and go through the whole tokenizer, which never joins anything across white space.
"""

from __future__ import annotations

import os
import re

import public_tokenizers
from tokenizers import Tokenizer

TOKENIZER = "word_bpe_49k.json"

# Characters that normalisation leaves alone, the letters and digits they have
# once lower-cased, the pattern that cuts words, and the tokenizer's byte alphabet.
_PLAIN = "!-~\xa1-\xac\xae-įĲ-ɏ"
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ʯⱥⱦ"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_DIGITS}]|[^\\s{_LETTERS}{_DIGITS}]+")
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

#: The byte alphabet as a table for ``str.translate``.
_SHOWN = {b: ord(c) for b, c in _BYTES.items()}
_PLAIN_TEXT = re.compile(f"[\t-\r {_PLAIN}]*")
_SPACE = re.compile("[\t-\r ]+")
#: Begins every special string; texts with it are not plain.
_SPECIAL = "<|"


def _is_plain(text: str) -> bool:
    return _SPECIAL not in text and _PLAIN_TEXT.fullmatch(text) is not None


def pre_tokens(text: str | None) -> list[str]:
    """The pre-tokens in order; none for NULL."""
    if not text:
        return []
    if _is_plain(text):
        return _PIECE.findall(text.lower())
    out: list[str] = []
    for word in _SPACE.split(text):
        if _is_plain(word):
            out += _PIECE.findall(word.lower())
        else:
            out.append(word)
    return out


class PieceModel:
    """Token ids of single pre-tokens."""

    def __init__(self, name: str = TOKENIZER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model

    def _tokens(self, piece: str):
        """The model's tokens of a plain pre-token; None for any other."""
        if piece.isascii():
            return self.model.tokenize(piece) if piece.isprintable() and _SPECIAL not in piece else None
        return self.model.tokenize(piece.encode().decode("latin-1").translate(_SHOWN)) if _is_plain(piece) else None

    def ids(self, piece: str) -> list[int]:
        tokens = self._tokens(piece)
        return self.tokenizer.encode(piece, add_special_tokens=False).ids if tokens is None else [t.id for t in tokens]

    def length(self, piece: str) -> int:
        tokens = self._tokens(piece)
        return len(self.ids(piece) if tokens is None else tokens)
