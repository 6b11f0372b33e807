"""Tokenizing whole texts with a bounded cache of words.

A text is cut where the tokenizer's own pre-tokenizer is sure to cut, so that the ids of the text are those of the
pieces in a row. The ids of each distinct piece come from the tokenizers library once and are kept; texts for which the
cut isn't sure, or that hold the string of an added token, go to the library whole.
"""

from __future__ import annotations

import importlib
import os
import re
from contextlib import suppress
from itertools import islice

import numpy as np

from .caches import claim

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Pieces kept in a worker, under 200 bytes each: of words, and of bytes.
#: When it is full the half that came last goes: common pieces come early.
KEPT_WORDS, KEPT_BYTES = 1_200_000, 800_000
_TWO_SPACES = re.compile(r"\s\s")
_encoders: dict[str, "Encoder"] = {}


def vocabulary_path(name: str) -> str:
    """A path as given, or the place of a file of the installed public tokenizers."""
    return name if "/" in name else importlib.import_module("public_tokenizers").path(name)


def encoder(name: str, specials_as_text: bool = False, kept: int | None = None) -> "Encoder":
    """One encoder for each vocabulary, bound of kept pieces and worker process."""
    claim("tokens", _encoders.clear)
    if (key := f"{name}:{specials_as_text}:{kept}") not in _encoders:
        _encoders[key] = Encoder(name, specials_as_text, kept)
    return _encoders[key]


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit bytes.

    They are those of the library as it is loaded: the string of an added token becomes its id. With specials_as_text
    such strings are ordinary text. At most kept pieces are held (None: as many as is usual for the vocabulary), which
    changes how long it takes, never the ids.
    """

    def __init__(self, name: str, specials_as_text: bool = False, kept: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(name))
        self.library.encode_special_tokens = specials_as_text
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids over 16 bits aren't supported here")
        # The word vocabulary drops white space and ignores case; in the byte vocabulary a piece starts with its space.
        self.by_word = "lower" in str(self.library.normalizer).lower()
        self.mark = " \x01 " if self.by_word else "\n"
        self.mark_ids = self._library([self.mark])[0]
        self.kept: dict[bytes, bytes] = {b"": b""}
        self.most = kept or (KEPT_WORDS if self.by_word else KEPT_BYTES)
        # in lower case, as pieces of the word vocabulary are: none may become an added token by that
        self.added = tuple({t.content.encode().lower() for t in self.library.get_added_tokens_decoder().values() if t.content.strip()})

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<u2") for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, text: str) -> list[bytes] | None:
        """None: to be encoded whole."""
        data = text.encode("utf-8", "surrogatepass")
        low = data.lower()  # ASCII letters only, which the library lowers too
        if any(t in low for t in self.added):
            return None
        if self.by_word:
            return None if b"\x01" in data else low.split()
        # with no two white spaces in a row each space starts a piece, and each line end is one
        if "\0" in text or _TWO_SPACES.search(text):
            return None
        return data.replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0").split(b"\0")

    def _learn(self, new: set[bytes]) -> None:
        """Joined by a mark that is always a token of its own, many new pieces are encoded at once.

        A comma or full stop after an ASCII letter is always cut off, so it is taken from the piece's end.
        """
        ends_so = {x for x in new if x[-1:] in b",." and len(x) > 1 and x[-2:-1].isalpha()}
        if ends_so:
            self._learn(({x[:-1] for x in ends_so} | {b",", b"."} | new.difference(ends_so)).difference(self.kept))
            self.kept.update((x, self.kept[x[:-1]] + self.kept[x[-1:]]) for x in ends_so)
            return
        plain = [x for x in new if self.by_word or len(x.split()) == 1 and x.split()[0] == x.lstrip(b" ") and not x[-1:].isspace()]
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            ids = self._library([self.mark.encode().join(some).decode()])[0]
            ends = np.flatnonzero(ids == self.mark_ids[0]) if len(self.mark_ids) == 1 else np.empty(0, int)
            if len(ends) != len(some) - 1:
                for x, y in zip(some, self._library([x.decode() for x in some])):
                    self.kept[x] = y.tobytes()
                continue
            raw, start = ids.tobytes(), 0
            for x, end in zip(some, [*ends.tolist(), len(ids)]):
                self.kept[x] = raw[2 * start : 2 * end]
                start = end + 1
        for x in new.difference(plain):
            self.kept[x] = self._library([x.decode()])[0].tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as empty."""
        pieces = [self._pieces(x) if x else [] for x in texts]
        get, found, new = self.kept.get, [], set()
        for words in pieces:
            got, gaps = None if words is None else list(map(get, words)), []
            if got and None in got:
                at = got.index(None)
                with suppress(ValueError):  # no further gap
                    while True:
                        gaps.append(at)
                        new.add(words[at])
                        at = got.index(None, at + 1)
            found.append((got, gaps))
        if new:
            self._learn(new)
        out = []
        for text, words, (got, gaps) in zip(texts, pieces, found):
            if words is None:
                out.append(self._library([text])[0].tobytes())
                continue
            for at in gaps:
                got[at] = self.kept[words[at]]
            out.append(b"".join(got))
        if len(self.kept) > self.most:
            self.kept = dict(islice(self.kept.items(), self.most // 2))
        return out
