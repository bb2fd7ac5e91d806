"""Token ids of texts by a tokenizer file of the ``tokenizers`` library.

The library spends most of its time on words it has seen before. A byte-level BPE encodes
each piece that its pre-tokenizer cuts by itself, so here a batch of texts is cut into
pieces, the library's model encodes each *different* piece once, and the ids of all pieces
are put together by numpy. Pieces are remembered from batch to batch, up to a bound.

That is done for texts of ASCII and Latin-1 letters, where the cutting pattern is the same
under Python's and the library's idea of a letter. Any other text, and any tokenizer of
another build, is encoded by the library as a whole. Ids are the same either way.

A text that holds the string of an added token (``<|endoftext|>``) is encoded by the library as
a whole too, which gives that token its id, as a plain call does.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np

#: Remembered pieces; beyond the bound they are forgotten and the next texts start anew.
MAX_PIECES = 400_000
#: Characters of texts that are cut into pieces together.
TOGETHER = 1 << 20

_LATIN = "À-ÖØ-öø-ÿ"
_LOWER_LATIN = "ß-öø-ÿ"
_OTHER = re.compile(f"[^\t\n\r -~{_LATIN}]")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
#: The two ways of cutting, for letters as above.
_BYTE_LEVEL = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^\sA-Za-z0-9{_LATIN}]+|\s+(?!\S)|\s+"
)
_WORDS = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)|[a-z{_LOWER_LATIN}]+|[0-9]|[^\sa-z0-9{_LOWER_LATIN}]+"
)


def _alphabet() -> dict[int, int]:
    """Byte-level spelling: printable bytes stand for themselves, others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    spelled = {b: b for b in printable} | {b: 256 + n for n, b in enumerate(others)}
    return spelled | {ord("\n"): ord("\n")}


_ALPHABET = _alphabet()


class _Known(dict):
    """A number for each piece; new ones are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes batches of texts; one for each Python worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.cut, self.lower = _cutting(json.loads(self.library.to_str()))
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _learn(self) -> None:
        """Encodes the new pieces by the library's model."""
        pieces, self.known.new = self.known.new, []
        first, count = len(self.known) - len(pieces), len(pieces)
        # A line feed parts the pieces below; those that hold one go apart.
        plain = [p for p in pieces if "\n" not in p]
        spelled = "\n".join(plain).encode().decode("latin-1").translate(_ALPHABET).split("\n")
        tokenize = self.library.model.tokenize
        found = iter([[t.id for t in tokenize(s)] for s in spelled] if plain else [])
        encode = self.library.encode
        each = [
            encode(p, add_special_tokens=False).ids if "\n" in p else next(found) for p in pieces
        ]
        sizes = np.fromiter(map(len, each), np.int64, count)
        end = self.used + int(sizes.sum())
        self.ids = _room(self.ids, end)
        self.starts = _room(self.starts, first + count)
        self.sizes = _room(self.sizes, first + count)
        self.starts[first : first + count] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first : first + count] = sizes
        self.ids[self.used : end] = np.fromiter(chain.from_iterable(each), np.uint32)
        self.used = end

    def _pieces(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > MAX_PIECES:
            self._forget()
        each = [self.cut.findall(t.lower() if self.lower else t) for t in texts]
        total = sum(map(len, each))
        pieces = chain.from_iterable(each)
        index = np.fromiter(map(self.known.__getitem__, pieces), np.int64, total)
        if self.known.new:
            self._learn()
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        move = self.starts[index] - (ends - sizes)
        ids = self.ids[np.repeat(move, sizes) + np.arange(total)]
        bounds = np.append(0, np.cumsum([len(e) for e in each]))
        return ids, np.diff(np.append(0, ends)[bounds])

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, as 32-bit numbers, in order. None counts as empty."""
        waiting: list[str] = []
        held = 0
        for text in texts:
            text = text or ""
            if self._whole(text):
                yield from self._together(waiting)
                waiting, held = [], 0
                yield np.array(
                    self.library.encode(text, add_special_tokens=False).ids, np.uint32
                )
            elif len(text) > TOGETHER:
                yield from self._together(waiting)
                waiting, held = [], 0
                yield np.concatenate([self._pieces([part])[0] for part in _parts(text)])
            else:
                waiting.append(text)
                held += len(text)
                if held >= TOGETHER:
                    yield from self._together(waiting)
                    waiting, held = [], 0
        yield from self._together(waiting)

    def _whole(self, text: str) -> bool:
        """Whether the library has to see the text as a whole."""
        if self.cut is None or _OTHER.search(text):
            return True
        return bool(self.added and self.added.search(text))

    def _together(self, texts: list[str]) -> Iterator[np.ndarray]:
        if texts:
            ids, sizes = self._pieces(texts)
            yield from np.split(ids, np.cumsum(sizes)[:-1])


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.append(array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype))


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that are encoded alike apart and together."""
    at = 0
    while at < len(text):
        edge = _BOUNDARY.search(text, at + TOGETHER)
        end = edge.start() if edge else len(text)
        yield text[at:end]
        at = end


def _cutting(config: dict) -> tuple[re.Pattern | None, bool]:
    """The pattern that cuts as the tokenizer does and whether it lower-cases; or None."""
    if config["model"]["type"] != "BPE" or config["model"].get("dropout"):
        return None, False
    before, normal = config["pre_tokenizer"] or {}, config["normalizer"]
    if before.get("type") == "ByteLevel" and normal is None:
        fits = before["use_regex"] and not before["add_prefix_space"]
        return (_BYTE_LEVEL if fits else None), False
    steps = [s["type"] for s in (normal or {}).get("normalizers", [])]
    inner = [s["type"] for s in before.get("pretokenizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and inner == ["Split", "ByteLevel"]:
        return _WORDS, True
    return None, False


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
