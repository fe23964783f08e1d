"""Encoding of texts by the tokenizers library, with each distinct piece of text encoded once.

Byte-pair merges never cross a pre-token, so a text may be cut at places that are pre-token borders
for certain, the pieces encoded by the library, and the ids joined. Where a text has anything for which
the borders are not certain, the whole text goes to the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array

_LATIN = "A-Za-z0-9À-ÖØ-öø-ÿ"
_STOPS = ".,;:!?|#$%&*"
#: White space runs stay with what follows; runs of letters and digits end before white space or plain punctuation.
_BYTE_PIECES = re.compile(rf"[ \n]*+[{_LATIN}]++(?=[ \n{_STOPS}]|$)|[ \n]*+[^ \n]++|[ \n]++")
_WORD_PIECES = re.compile(rf"[a-z0-9ß-öø-ÿ]++(?=[ \n{_STOPS}]|$)|[^ \n]++")
_BYTE_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LOWER_WORD = re.compile(r"[a-zß-öø-ÿ]+")
_ODD_SPACE = re.compile(r"[^\S \n]")

#: Distinct pieces that a worker remembers (about 250 bytes each) before it starts anew.
REMEMBERED = 250_000


def byte_alphabet() -> dict[int, int]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Known(dict):
    """ids of pieces, encoded when they are first asked for; None for a piece that must not be cut off its text."""

    def __init__(self, owner: Encoder):
        super().__init__()
        self.most = owner.remembered
        self.word, self.uncut, self.spelled, self.model, self.library, self.code = owner.one_word.fullmatch, owner.uncut, owner.spelled, owner.model.tokenize, owner.library.encode, owner.code

    def __missing__(self, piece: str) -> bytes | None:
        if len(self) >= self.most:
            self.clear()
        if self.uncut and self.uncut(piece):
            self[piece] = None
            return None
        if self.spelled and self.word(piece):  # a single pre-token: straight to the model, in its own alphabet
            ids = [t.id for t in self.model(piece.encode().decode("latin-1").translate(self.spelled))]
        else:
            ids = self.library(piece, add_special_tokens=False).ids
        made = self[piece] = array(self.code, ids).tobytes()
        return made


class Encoder:
    """ids of texts as little-endian bytes of `dtype`, as the library gives them with add_special_tokens=False: none are
    added, but the strings of added tokens in a text have the ids of these tokens."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.added = [t["content"] for t in made.get("added_tokens") or ()]
        self.vocabulary = self.library.get_vocab_size()
        self.code, self.dtype = ("H", "<u2") if self.vocabulary <= 1 << 16 else ("I", "<u4")
        self.model = self.library.model
        self.spelled: dict[int, int] = {}
        self.one_word, self.uncut = _BYTE_WORD, None
        self.pieces = self._cut_for(made)
        self.known = Known(self)
        self.lowers = self.pieces == self._word_pieces or any(t.get("normalized") for t in made.get("added_tokens") or ())

    def _cut_for(self, made: dict):
        before, normal = made.get("pre_tokenizer") or {}, made.get("normalizer") or {}
        if before.get("type") == "ByteLevel" and not normal and not before.get("add_prefix_space") and before.get("use_regex", True):
            self.spelled, self.one_word = byte_alphabet(), _BYTE_WORD
            self.uncut = _ODD_SPACE.search  # it may belong to a run with the spaces around it
            return _BYTE_PIECES.findall
        steps = [s.get("type") for s in before.get("pretokenizers", ())]
        normals = [n.get("type") for n in normal.get("normalizers", ())]
        if steps == ["Split", "ByteLevel"] and normals == ["NFC", "Replace", "Lowercase"] and before["pretokenizers"][0]["behavior"] == "Removed" and not before["pretokenizers"][1].get("add_prefix_space"):
            self.spelled, self.one_word = byte_alphabet(), _LOWER_WORD
            return self._word_pieces
        return lambda text: [text]

    @staticmethod
    def _word_pieces(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [x for x in text.replace("\n", " ").split(" ") if x]
        return _WORD_PIECES.findall(text.lower())

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _has_added(self, text: str) -> bool:
        """Whether a text has the string of an added token, or its pieces could have it once they are lower-cased."""
        low = text.lower() if self.lowers else text
        return any(x in text or x.lower() in low for x in self.added)

    def encode(self, texts: list[str]) -> list[bytes]:
        get, out = self.known.__getitem__, []
        for text in texts:
            if self._has_added(text):
                out.append(self._whole(text))
                continue
            try:
                out.append(b"".join(map(get, self.pieces(text))))
            except TypeError:
                out.append(self._whole(text))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One per worker process; a worker that turns to another file forgets the first."""
    if path not in _encoders or _encoders[path].remembered != remembered:
        _encoders.clear()
        _encoders[path] = Encoder(path, remembered)
    return _encoders[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
