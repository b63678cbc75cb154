"""Token ids of whole texts by a stored tokenizer file, with a memo of words.

The library spends nearly all its time on merging the bytes of one word, and
words repeat. A text made only of characters whose class is certain (printable
ASCII, Latin letters, common white space) is cut by the file's own splitting
rule, and each piece is looked up in a bounded memo; a missing piece goes through
the library's model. Any other text, and any text that holds a special string,
goes through the library whole. Both ways give the library's ids (tests compare
them on random texts).
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from functools import lru_cache

LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(f"[ -~\n\t\r{LETTERS}]*").fullmatch
_CUT = {
    # words with their leading space, as the byte-level rule cuts them
    "ByteLevel": re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"),
    # lower-cased words without white space, digits one by one
    "Sequence": re.compile(rf"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+"),
}


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the letters from U+0100 on, in byte order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def file_digest(path: str) -> str:
    """Digest that names a tokenizer version: its file and the library's version."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


class _Memo(dict):
    """Piece of text -> what ``of`` makes of its ids; at most ``most`` pieces stay."""

    def __init__(self, model, of, most: int):
        super().__init__()
        self.model, self.of, self.most = model, of, most
        self.letters = {i: c for i, c in enumerate(_byte_letters())}

    def __missing__(self, piece: str):
        got = self.of([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))])
        if len(self) < self.most:
            self[piece] = got
        return got


class Tokenizer:
    """``count(text)`` and ``ids(text)`` (little-endian uint32 bytes)."""

    def __init__(self, path: str, memo: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        kind = about["pre_tokenizer"]["type"]
        self.lower = about["normalizer"] is not None
        self.cut = _CUT[kind].findall
        self.special = re.compile("|".join(re.escape(t["content"]) for t in about["added_tokens"]) or "(?!)").search
        model = self.library.model
        self.sizes = _Memo(model, len, memo)
        self.packed = _Memo(model, lambda ids: struct.pack(f"<{len(ids)}I", *ids), memo)

    def _pieces(self, text: str):
        if not _PLAIN(text) or self.special(text):
            return None
        return self.cut(text.lower() if self.lower else text)

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def count(self, text: str) -> int:
        pieces = self._pieces(text)
        return len(self._whole(text)) if pieces is None else sum(map(self.sizes.__getitem__, pieces))

    def ids(self, text: str) -> bytes:
        pieces = self._pieces(text)
        if pieces is None:
            whole = self._whole(text)
            return struct.pack(f"<{len(whole)}I", *whole)
        return b"".join(map(self.packed.__getitem__, pieces))


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    """One tokenizer per file and Python worker, so its memo lives across tasks."""
    return Tokenizer(path)
