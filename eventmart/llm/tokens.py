"""Token ids of whole texts by the ``tokenizers`` library, a piece at a time.

The word vocabulary lower-cases a text, drops white space and cuts the rest into
pieces by a pattern of its own; the ids of a text are those of its pieces in turn.
Pieces repeat far more than texts do: each new one is handed to the library's
model, and its ids are kept as bytes in a bounded table per worker, as are those of
whole words. Words are split off and told apart by Arrow for many texts at once, so that
each is looked up once for them all and the ids are gathered by its place.
A vocabulary that cuts texts otherwise is refused. Only characters of which
it is certain that they need no normalising are cut here; chunks with others go
through the library's whole path (normaliser, pattern, byte level).
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_PIECES = 500_000  # less than 200 MB
LONGEST_KEPT = 64
SLICE_CHARS = 4 << 20  # texts whose words are told apart at a time, one text at least

# Characters beyond white space, ASCII and composed Latin letters.
ODD = re.compile(r"[^\t\n\r -~À-ÿ]")
# Fixed values of the vocabulary's file: how it cuts a text into pieces.
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# All others, as Latin-1 bytes.
EVEN = bytes([*b"\t\n\r", *range(32, 127), *range(0xC0, 0x100)])
# The same pattern for lower-case text without those characters.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write for each byte: visible
    characters stand for themselves, the others follow from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(visible))
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Known(dict):
    """Ids of pieces; a new piece is looked up where it is missed."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids


def _even(text: str) -> bool:
    """Whether ``ODD`` finds nothing in ``text``; much faster than a search."""
    try:
        return not text.encode("latin-1").translate(None, EVEN)
    except UnicodeEncodeError:
        return False


def _slices(texts: Iterable[str]) -> Iterator[list[str]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


class ChunkIds:
    """Texts to ids (little-endian unsigned 32-bit, as bytes)."""

    def __init__(self, path: str, most: int = MOST_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if json.loads(self.library.to_str())["pre_tokenizer"] != PRE_TOKENIZER:
            raise ValueError(f"{path} doesn't cut texts as the word vocabulary does")
        self.tokenize = self.library.model.tokenize
        self.signs = byte_signs()
        self.most = most
        self.known = _Known(self._word)

    def _word(self, word: str) -> bytes:
        if word.isalpha():  # letters only are one piece
            return self._piece(word)
        pieces = PIECES.findall(word)
        # A piece is a word of its own, so both share one table.
        return self._piece(word) if pieces == [word] else b"".join(map(self.known.__getitem__, pieces))

    def _piece(self, piece: str) -> bytes:
        signs = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.signs)
        return array("I", [t.id for t in self.tokenize(signs)]).tobytes()

    def _plain(self, text: str) -> bytes:
        # No piece spans white space, which is dropped: a word's pieces are its own.
        return b"".join(map(self.known.__getitem__, text.lower().split()))

    def _plain_together(self, texts: list[str]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        told = words.values.dictionary_encode()
        ids = map(self.known.__getitem__, told.dictionary.to_numpy(zero_copy_only=False).tolist())
        found = pa.array(list(ids), pa.large_binary()).take(told.indices)
        ends = np.frombuffer(found.buffers()[1], np.int64)[words.offsets.to_numpy()].tolist()
        raw = found.buffers()[2].to_pybytes() if ends[-1] else b""
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode`` of each text in turn, a slice of them at a time."""
        for some in _slices(texts):
            plain = [_even(t) and "<|" not in t for t in some]
            if len(self.known) > self.most:
                self.known.clear()
            together = iter(self._plain_together([t for t, p in zip(some, plain, strict=True) if p]))
            yield from (next(together) if p else self.encode(t) for t, p in zip(some, plain, strict=True))

    def forget(self) -> None:
        """Give the table's memory back: a worker lives on for the tasks of other stages."""
        self.known.clear()
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> bytes:
        if len(self.known) > self.most:
            self.known.clear()
        if _even(text) and "<|" not in text:
            return self._plain(text)
        out = []
        for chunk in text.replace("\n", " ").split(" "):
            if not _even(chunk) or "<|" in chunk:
                ids = self.library.encode(chunk, add_special_tokens=False).ids
                out.append(array("I", ids).tobytes())
            else:
                out.append(self._plain(chunk))
        return b"".join(out)


_LOADED: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """The encoder of this worker for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = ChunkIds(path)
    return _LOADED[path]


def vocabulary(path: str | None) -> str:
    """A vocabulary file: the one named, or the public word vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
