"""Token ids of whole texts by public vocabularies, text by text the same as the libraries give, from a store of cuts.

A text is cut where no token can reach across, and every distinct cut is encoded once: the first ``cap`` distinct
cuts of a Python worker are kept for good, all others for their batch.  Word vocabularies fold case, so there texts are
lower-cased before they are cut where that is safe, and the words of cuts without the signs around them are kept too.  New ones are encoded many in one string, whose ids are dealt back by the tokens' byte lengths (byte-level vocabularies) or by the word-end marks (word
vocabularies); where that does not come out even, each cut is encoded alone.
"""
from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate, chain, compress, islice, repeat
from operator import is_

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Cuts kept for good by a Python worker: about 200 bytes each.
CAP = 800_000
JOINED = 400

#: A blank after white space; the search goes from blank to blank.
_SPACE_RUN = re.compile(r" (?<=\s\s)")
_CUT = re.compile(r"(?<=\S)(?= )")
#: White space other than blank, tab and line ends, on which libraries differ.
_ODD = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_ODD_SPACE = re.compile(f"[{''.join(map(chr, _ODD))}]")
_PLAIN_SPACE = re.compile(r"[ \t-\r]+")
#: Letters that lower-casing and composition leave single letters: one word of them is one unit of a word vocabulary.
_LETTERS = [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x131, 0x148), (0x14A, 0x17E)]
_LETTER = "".join(f"{chr(a)}-{chr(b)}" for a, b in _LETTERS)
_PLAIN_WORD = re.compile(f"[{_LETTER}]+")
#: A word with signs around it falls into units there; not with an apostrophe, nor with the sign that opens special tokens.
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
_IN_SIGNS = re.compile(f"([{re.escape(_SIGNS.replace('<', ''))}]*)([{_LETTER}]+)([{re.escape(_SIGNS)}]*)")
#: In a text without these, lower-casing first changes no id; "<" opens special tokens, whose case counts.
_OTHER = re.compile(rf"[^\x00-;=-\x7f{_LETTER}]")


def space_cuts(text: str) -> list[str]:
    """``text`` cut before every blank that follows no white space; empty texts have no cut."""
    if "\0" in text or _SPACE_RUN.search(text):
        return [c for c in _CUT.split(text) if c]
    cuts = text.replace(" ", "\0 ").split("\0")
    return cuts if cuts[0] else cuts[1:]


def word_cuts(text: str) -> list[str]:
    """The runs without white space, in lower case where the text's case tells nothing."""
    if "<" not in text and (text.isascii() or not _OTHER.search(text)):
        text = text.lower()
    return [w for w in _PLAIN_SPACE.split(text) if w] if _ODD_SPACE.search(text) else text.split()


class Store:
    """Values of cuts, made by ``make`` for many distinct cuts at once; the first ``cap`` are kept for good."""

    def __init__(self, make: Callable[[list[str]], list], cap: int = CAP):
        self.make, self.cap, self.known = make, cap, {}

    def values(self, cuts: list[list[str]]) -> list[list]:
        """The value of every cut of every text."""
        # a batch makes many short-lived lists and no cycles: collecting them in between only costs time
        paused = gc.isenabled()
        gc.disable()
        try:
            return self._values(cuts)
        finally:
            if paused:
                gc.enable()

    def _values(self, cuts: list[list[str]]) -> list[list]:
        flat = list(chain.from_iterable(cuts))
        found = list(map(self.known.get, flat))
        missing = list(compress(range(len(flat)), map(is_, found, repeat(None))))
        if missing:
            unknown = [flat[i] for i in missing]
            keys = list(dict.fromkeys(unknown))
            fresh = dict(zip(keys, self.make(keys), strict=True))
            for i, v in zip(missing, map(fresh.__getitem__, unknown), strict=True):
                found[i] = v
            room = max(0, self.cap - len(self.known))
            self.known.update(fresh if room >= len(fresh) else islice(fresh.items(), room))
        ends = list(accumulate(map(len, cuts)))
        return [found[a:b] for a, b in zip([0, *ends], ends)]


class Vocabulary:
    """A vocabulary file of the ``tokenizers`` library: ``ids_of`` encodes cuts, ``encode`` whole texts.

    ``plain``: strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False, cap: int = CAP):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.size = self.tokenizer.get_vocab_size()
        tokens = [added.get(i, self.tokenizer.id_to_token(i) or "") for i in range(self.size)]
        self.by_words = any(t.endswith("</w>") for t in tokens)
        self.lengths = np.array([len(t.encode()) if i in added else len(t) for i, t in enumerate(tokens)], np.int64)
        self.ends = np.array([t.endswith("</w>") for t in tokens])
        self.cut = word_cuts if self.by_words else space_cuts
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.store, self.units = Store(self.ids_of, cap), Store(self._units, cap)

    def _alone(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joins(self, cut: str) -> bool:
        if self.by_words:
            return _PLAIN_WORD.fullmatch(cut) is not None
        return cut[0] == " " and not cut[-1].isspace()

    def _ends(self, ids: np.ndarray, cuts: list[str]) -> np.ndarray | None:
        """Where each cut of a joined string ends in its ids; None where cuts and tokens do not end together."""
        if self.by_words:
            ends = np.flatnonzero(self.ends[ids]) + 1
            return ends if len(ends) == len(cuts) and ends[-1] == len(ids) else None
        reach, goal = np.cumsum(self.lengths[ids]), np.cumsum([len(c.encode()) for c in cuts])
        ends = np.searchsorted(reach, goal) + 1
        return ends if ends[-1] == len(ids) and (reach[ends - 1] == goal).all() else None

    def _parts(self, cut: str) -> tuple[str, ...]:
        """A word vocabulary's cut, or its word and signs where these are units of their own."""
        if cut.isascii() and cut.isalpha():
            return (cut.lower(),)
        if m := _IN_SIGNS.fullmatch(cut):
            return tuple([p for p in (m[1], m[2].lower(), m[3]) if p])
        return (cut,)

    def ids_of(self, cuts: list[str]) -> list[bytes]:
        """Ids of each cut, as little-endian bytes of ``kind``."""
        if not self.by_words:  # signs after a byte-level cut cost less encoded with it than looked up apart
            return self._units(cuts)
        known = self.units.known
        parts = list(map(self._parts, cuts))
        flat = list(chain.from_iterable(parts))
        new = list(dict.fromkeys(compress(flat, map(is_, map(known.get, flat), repeat(None)))))
        more = dict(zip(new, self.units.make(new), strict=True)) if new else {}
        room = max(0, self.units.cap - len(known))
        known.update(more if room >= len(more) else islice(more.items(), room))
        values = [more[u] if v is None else v for u, v in zip(flat, map(known.get, flat), strict=True)]
        if len(flat) == len(parts):
            return values
        ends = list(accumulate(map(len, parts)))
        return [values[a] if b == a + 1 else b"".join(values[a:b]) for a, b in zip([0, *ends], ends)]

    def _units(self, cuts: list[str]) -> list[bytes]:
        out: dict[str, bytes] = {}
        joined = [c for c in cuts if self._joins(c)]
        blocks = [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)]
        between = " " if self.by_words else ""
        for block, ids in zip(blocks, self._alone([between.join(b) for b in blocks]), strict=True):
            if (ends := self._ends(ids, block)) is not None:
                raw, at = ids.tobytes(), (ends * self.kind.itemsize).tolist()
                out.update((c, raw[a:b]) for c, a, b in zip(block, [0, *at], at))
        rest = [c for c in cuts if c not in out]
        out.update((c, ids.tobytes()) for c, ids in zip(rest, self._alone(rest), strict=True))
        return [out[c] for c in cuts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian bytes of ``kind``."""
        return [b"".join(v) for v in self.store.values([self.cut(t) for t in texts])]


@lru_cache(maxsize=2)
def vocabulary(path: str, plain: bool = False) -> Vocabulary:
    """One vocabulary, with its store, for all tasks of a Python worker."""
    return Vocabulary(path, plain)
