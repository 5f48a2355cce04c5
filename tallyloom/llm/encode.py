"""Token ids of whole texts, by the vocabulary files of public tokenizers.

A tokenizer is a file whose path is a parameter. Texts are cut where the tokenizer
itself always cuts, and each distinct piece is encoded once and kept while the worker
lives, which gives the same ids several times as fast.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Unicode white space as the byte-level pre-tokenizer sees it, and Latin letters.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
_MARKS = r"!-&(-/:-@\[-`{-~"  # all of ASCII's but the apostrophe, which may begin a contraction
#: Where both kinds of pre-tokenizer surely cut: where a run of Latin letters meets a mark, a digit or
#: white space, and where a run of marks meets any of the others.
_LATIN = rf"{_LETTERS}(?=[{_MARKS}0-9 \t-\r]|\Z)"
_RUN = rf"[{_MARKS}]+(?=[A-Za-z0-9 \t-\r]|\Z)"
#: "byte": one space joins what comes after it, as in byte-level BPE. "word": white space is dropped, but ends of lines.
#: What is neither a Latin word nor marks is taken up to the next white space as a whole.
PIECES = {
    "byte": re.compile(rf" ?{_LATIN}| ?{_RUN}| ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"),
    "word": re.compile(rf"{_LATIN}|{_RUN}|[^ \t-\r]+|\n"),
}
#: Pieces that are one word for both tokenizers themselves, which only their models have to cut further.
PLAIN = re.compile(rf" ?(?:{_LETTERS}|[{_MARKS}]+)")
#: Characters that may compose with others before case is lost.
BEYOND = re.compile(r"[^\x00-\xff]")
#: What byte-level models call the bytes of a text: the printable ones as in Latin-1, the others in turn from 256.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = {byte: chr(256 + n) for n, byte in enumerate(x for x in range(256) if x not in _PRINTABLE)}


def _picked(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` numbered ``at``, of which run n ends at ``ends[n]``, and where each ends now."""
    sizes = np.diff(ends, prepend=0)[at]
    stops = np.cumsum(sizes)
    return values[np.repeat(ends[at] - stops, sizes) + np.arange(sizes.sum())], stops


class Encoder:
    """Encodes texts with one tokenizer file.

    Pieces of at most ``LONGEST`` characters are remembered in two generations of at most
    ``MOST`` each, about 200 bytes a piece: a piece met again moves to the newer one, and
    when that is full it becomes the older one. So common pieces stay, at any size of
    the input, and memory is bounded.

    With ``specials`` the strings of special tokens get their special ids, as the library
    does by default; without, they are ordinary text, so that no text can forge the end
    of a document.
    """

    LONGEST, MOST = 32, 500_000

    def __init__(self, path: str, kind: str, specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()] if specials else []
        self.kind, self.pattern, self.known, self.older = kind, PIECES[kind], {}, {}
        normal = self.tokenizer.normalizer
        self.lower = normal is not None and normal.normalize_str("AZ") == "az"
        self.model = self.tokenizer.model.tokenize
        trial = [" word", "Étude", "&&"] if kind == "byte" else ["Word", "Étude", "&&"]
        self.direct = all(self._modelled(x) == self._library([x])[0] for x in trial)

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text, unsigned 32-bit; none for an empty text."""
        return self.encoded([text])[0]

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, unsigned 32-bit. Pieces that are not known yet are encoded
        together, once for all the texts."""
        whole, plain = {}, []
        for n, text in enumerate(texts):
            views = (text, text.lower()) if self.lower else (text,)
            if any(x in view for x in self.special for view in views):  # they cut a text before anything else does
                whole[n] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
                plain.append("")
            else:  # where case is lost anyway, fewer pieces differ; beyond Latin-1 it is lost only after composing
                plain.append(views[-1] if not BEYOND.search(text) else text)
        ids, ends = self._by_words(plain) if self.kind == "word" else self._by_pieces(plain)
        return [whole[n] if n in whole else ids[a:b] for n, (a, b) in enumerate(zip([0, *ends], ends, strict=False))]

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """All ids of the texts in a row and where each text's end. White space is dropped, so Arrow cuts
        the texts there and numbers their words; each differing word is cut further once, in lines of words."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.values.dictionary_encode()
        lines = "\n".join([*coded.dictionary.to_numpy(zero_copy_only=False), ""])
        pieces = pa.array(self.pattern.findall(lines), pa.large_string())
        ids, ends = self._ids(pieces)
        ids, ends = _picked(ids, ends[pc.equal(pieces, "\n").to_numpy(zero_copy_only=False)], coded.indices.to_numpy())
        return ids, np.append(0, ends)[split.offsets.to_numpy()[1:]].tolist()

    def _by_pieces(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        cut = list(map(self.pattern.findall, texts))
        ids, ends = self._ids(pa.array(list(chain.from_iterable(cut)), pa.large_string()))
        return ids, np.append(0, ends)[np.cumsum(list(map(len, cut)))].tolist()

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row and where each piece's end."""
        coded = pieces.dictionary_encode()
        found = self._looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return _picked(np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes), coded.indices.to_numpy())

    def _looked_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of differing pieces as bytes of unsigned 32-bit integers."""
        found = list(map(self.known.get, pieces))
        lost = [n for n, v in enumerate(found) if v is None]
        if lost:
            older = self.older.get
            again = {x: v for n in lost if (v := older(x := pieces[n])) is not None}
            again.update(self._encoded([x for n in lost if (x := pieces[n]) not in again]))
            for n in lost:
                found[n] = again[pieces[n]]
            if len(self.known) + len(lost) > self.MOST:
                self.known, self.older = {}, self.known
            longest = self.LONGEST
            self.known.update((x, v) for x, v in again.items() if len(x) <= longest)
        return found

    def stream(self, texts: Iterable[str], chunk: int = 1 << 21) -> Iterator[np.ndarray]:
        """The ids of each text in turn; texts of about ``chunk`` characters at a time go together."""
        held, size = [], 0
        for text in chain(texts, [None]):
            if text is None or size >= chunk:
                yield from self.encoded(held)
                held, size = [], 0
            if text is not None:
                held.append(text)
                size += len(text)

    def _modelled(self, piece: str) -> bytes:
        """The ids of a plain piece, by the model alone."""
        low = piece.lower() if self.lower else piece
        named = low.replace(" ", BYTES[32]) if low.isascii() else low.encode().decode("latin-1").translate(BYTES)
        return array("I", [x.id for x in self.model(named)]).tobytes()

    def _library(self, pieces: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)] if pieces else []

    def _encoded(self, fresh: list[str]) -> dict[str, bytes]:
        """Ids of each piece as bytes: of plain ones by the model, of others by all that the library does."""
        plain, one = PLAIN.fullmatch, self._modelled
        here = {x: one(x) for x in fresh if plain(x)} if self.direct else {}
        rest = [x for x in fresh if x not in here]
        here.update(zip(rest, self._library(rest), strict=True))
        return here


@lru_cache(maxsize=4)
def encoder(path: str, kind: str, specials: bool = False) -> Encoder:
    """The worker's own encoder of a file."""
    return Encoder(path, kind, specials)
