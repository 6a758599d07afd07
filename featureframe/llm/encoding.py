"""Token ids of whole texts, by the tokenizers library and a local vocabulary file.

Most of the library's time goes into splitting text by patterns. Texts of Latin
letters, digits, ASCII signs, blanks and line breaks are split here by the
vocabulary's own pattern, spelled out for these characters, and each distinct piece
goes through the library's merges once while it is remembered. All other texts go
through the whole library, cut where no piece can span. Ids are the library's either
way; tests hold them against its plain ``encode``.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from featureframe.llm.common import chunks

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Latin letters whose lower case and composed form stay within the range.
_LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-įı-ſ"
_PLAIN = re.compile(r"[\n\x20-\x7e\xc0-įı-ſ]*")

#: The patterns byte-level and word-end vocabularies split text by, for plain texts.
_BYTE_LEVEL = re.compile(
    rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
)
_WORD_END = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_WORD_END_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


class TextEncoder:
    """Ids of texts as little-endian bytes of ``dtype``.

    At most ``limit`` pieces are remembered; then all are forgotten, which costs time
    but changes no result. The name of a special token inside a text is that token, as it
    is to the library, unless ``names_are_text``.
    """

    def __init__(self, vocabulary: bytes, limit: int = 500_000, names_are_text: bool = False):
        from tokenizers import Tokenizer

        text = vocabulary.decode("utf-8")
        self._library = Tokenizer.from_str(text)
        self._library.encode_special_tokens = names_are_text
        described = json.loads(text)
        names = "|".join(re.escape(token["content"]) for token in described.get("added_tokens", []))
        # whichever way the vocabulary wants them spelled: such texts go through the library
        self._names = re.compile(names or "(?!)", re.IGNORECASE)
        self._merges = self._library.model
        size = self._library.get_vocab_size(with_added_tokens=True)
        #: The narrowest type that holds every id.
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._limit = limit
        self._known: dict[str, bytes] = {}
        self._letters = _byte_letters()
        self._pattern, self._lower = self._plain_pattern(described)

    @staticmethod
    def _plain_pattern(described: dict) -> tuple[re.Pattern | None, bool]:
        """How plain texts are split, or None where this module doesn't know the vocabulary's way."""
        before, splitter = described.get("normalizer"), described.get("pre_tokenizer") or {}
        if before is None and splitter.get("type") == "ByteLevel":
            known = splitter.get("use_regex") and not splitter.get("add_prefix_space")
            return (_BYTE_LEVEL if known else None), False
        steps = [step.get("type") for step in (before or {}).get("normalizers", [])]
        parts = splitter.get("pretokenizers", [{}])
        if steps == ["NFC", "Replace", "Lowercase"] and parts[0].get("pattern") == {"Regex": _WORD_END_PATTERN}:
            return _WORD_END, True
        return None, False

    def __call__(self, text: str) -> bytes:
        if self._pattern is None or not _PLAIN.fullmatch(text) or self._names.search(text):
            return b"".join(self._by_library(chunks(text)))
        pieces = self._pattern.findall(text.lower() if self._lower else text)
        try:
            return b"".join(map(self._known.__getitem__, pieces))
        except KeyError:
            own = self._learn(pieces)
            return b"".join(map(own.__getitem__, pieces))

    def _by_library(self, parts: list[str]) -> list[bytes]:
        encoded = self._library.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(one.ids, self.dtype).tobytes() for one in encoded]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        missing = set(pieces).difference(self._known)
        if len(self._known) + len(missing) > self._limit:
            self._known.clear()
            missing = set(pieces)
        tokenize, letters, dtype = self._merges.tokenize, self._letters, self.dtype
        for piece in missing:
            mapped = piece.encode("utf-8").decode("latin-1").translate(letters)
            self._known[piece] = np.array([token.id for token in tokenize(mapped)], dtype).tobytes()
        return self._known


@lru_cache(maxsize=2)
def text_encoder(vocabulary: bytes) -> TextEncoder:
    """One encoder for all tasks of a Python worker, with the pieces it remembers."""
    return TextEncoder(vocabulary)
