"""Token ids of whole texts with a public tokenizer file, as little-endian 32-bit bytes.

Both vocabularies split a text at white space before anything else, so a run of blanks with the
word behind it has the same ids wherever it stands. Each run is encoded once and remembered;
a text is then a join of remembered byte strings. For a vocabulary that lower-cases, texts of Latin-1 characters are lower-cased first, which
leaves fewer different runs; their lower case and normal form are the same everywhere. A text with a blank other than
space and newline, where Python's and the tokenizer's ideas of white space could differ, is encoded whole,
and so is a text that holds an added token of the file (``<|endoftext|>``), which gets that token's id.
New runs that are one word of Latin letters with plain marks behind go straight to the
library's BPE model; all others go through the whole tokenizer.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

# Runs that a Python worker remembers before it starts anew, and the longest of them; bounds its memory at about 80 MB.
MEMO_RUNS, MEMO_LENGTH = 400_000, 64

_OTHER_BLANK = re.compile(r"[^\S \n]")
# The same among Latin-1 characters.
_LATIN_BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
_ONE_WORD = re.compile(r"([ ]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|%$&*#=+]*)")


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE shows for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return table


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Memo(dict):
    """The ids of runs; one that is not there is encoded when it is asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, run: str) -> bytes:
        ids = self.encode(run)
        if len(run) <= MEMO_LENGTH:
            if len(self) >= MEMO_RUNS:
                self.clear()
            self[run] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.lowers = self.tokenizer.normalizer is not None
        self.runs = str.split if self.lowers else re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
        self.letters = _byte_letters()
        self.memo = _Memo(self._run)
        self.pieces: dict[str, bytes] = {}

    def forget(self) -> None:
        """Free what is remembered; workers outlive tasks."""
        self.memo.clear()
        self.pieces.clear()

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _model_ids(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _run(self, run: str) -> bytes:
        word = _ONE_WORD.fullmatch(run)
        if word is None:
            return self.whole(run)
        space, letters, marks = word.groups()
        piece = letters.lower() if self.lowers else space + letters
        if not marks:
            return self._model_ids(piece)
        if marks not in self.pieces:
            if len(self.pieces) >= 10_000:
                self.pieces.clear()
            self.pieces[marks] = self._model_ids(marks)
        return (self.memo.get(piece) or self._model_ids(piece)) + self.pieces[marks]

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text (null: none)."""
        if not text:
            return b""
        latin = _latin(text)
        blank = any(map(text.__contains__, _LATIN_BLANKS)) if latin else _OTHER_BLANK.search(text)
        if blank or any(token in text for token in self.added):
            return self.whole(text)
        if self.lowers and latin:
            lowered = text.lower()
            # Only as it is spelled in the file is an added token one.
            if not any(token in lowered for token in self.added):
                text = lowered
        return b"".join(map(self.memo.__getitem__, self.runs(text)))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker."""
    return Encoder(path)


def forgetting(path: str, run):
    """A function over batches that frees the encoder's memory when its task ends."""

    @functools.wraps(run)
    def freed(batches):
        try:
            yield from run(batches)
        finally:
            encoder(path).forget()

    return freed


def public_tokenizer(name: str) -> str:
    """Where the installed file of a public tokenizer is."""
    import public_tokenizers

    return public_tokenizers.path(name)
