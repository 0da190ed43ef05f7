"""SentencePiece encoding and decoding by a streaming Viterbi search.

A model file of merged pieces (BPE) cuts a text by merging neighbours, the best
score first. The same cut is found as a shortest path: a piece may follow another
one exactly if merging the two pieces' characters gives these two pieces again,
and every beginning of a text has exactly one last piece that may follow the last
piece of what is before it. So each boundary has one back pointer, found among
the pieces that end there, and no path's cost but whether it may exist decides.

The search keeps a window only. A boundary lives as long as a piece that begins
there may still go on. Whenever the paths back from all living boundaries meet in
one, the ids up to it are given off and forgotten, so memory does not grow with
the text. No piece with other characters has the blank sign inside, so the search
is over before every blank sign that follows another character; the stretches
between repeat, and their ids are kept in a bounded table per worker. A new stretch is
cut further wherever no piece has its two neighbouring characters side by side, as
nothing is merged across: what stands beside a word doesn't make it another one. Short
parts are searched as a whole, long ones as a stream.

A character without a piece becomes its UTF-8 bytes. Text is taken as it is (the
model's normaliser is the identity); a blank is put in front, as the model asks,
and taken off again.

Defined results: null and empty texts have no ids. Decoding gives back every
text exactly; the blank sign itself, in a text, is written as its bytes for that.
Repeated rows are encoded each; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import text_or_empty, workers_import

BLANK = "▁"  # the model's sign for a blank (fixed)
OWN_SIGN = BLANK + "itself"  # stands for that sign where a text has it
MOST_STRETCHES = 1_000_000
LONGEST_KEPT = 48
MOST_PAIRS = 500_000
NEVER = float("-inf")  # the score of what is no piece

NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6  # kinds of pieces in a model file (fixed)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a serialised message; groups don't occur."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) of every id of a model file."""
    with open(path, "rb") as file:
        data = file.read()
    pieces = []
    for field, value in _fields(data):
        if field == 1:
            own = dict(_fields(value))
            score = np.frombuffer(own.get(2, b"\0\0\0\0"), dtype="<f4")[0]
            pieces.append((own[1].decode(), float(score), own.get(3, NORMAL)))
    return pieces


class StreamingViterbi:
    """The cut of a stream of characters, found with a bounded window."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.pieces = pieces
        self.ids = {p: (i, s) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
        self.score = {p: s for p, (_, s) in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_id = next((i for i, (p, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        # A tree of characters: for each the tree below it, and the piece that ends there or -1.
        self.tree: dict[str, tuple[dict, int]] = {}
        for piece, (i, _) in self.ids.items():
            node = self.tree
            for character in piece[:-1]:
                node = node.setdefault(character, ({}, -1))[0]
            below = node.get(piece[-1:], ({}, -1))[0]
            node[piece[-1:]] = (below, i)
        self.neighbours = {pair for piece in self.ids for pair in pairwise(piece)}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.widest = 0

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging, the best score first."""
        parts, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in pairwise(parts)]
        while scores and (best := max(scores)) > NEVER:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def _follows(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``before`` (-1: nothing, or no piece)."""
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            text = self.pieces[piece][0]
            first = [self.pieces[before][0]] if before >= 0 else []
            known = self.merged("".join(first) + text) == [*first, text]
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _of_character(self, character: str) -> list[int]:
        if not self.bytes:
            return [self.unknown_id]
        return [self.bytes[b] for b in (BLANK if character == OWN_SIGN else character).encode()]

    def feed(self, characters: Iterable[str]) -> Iterator[int]:
        """Give off ids as soon as all living paths agree on them."""
        tree, pairs = self.tree, self.pairs
        window: list[str] = []  # characters since the last agreed boundary
        back, made = [0], [-1]  # per boundary of the window: where its last piece begins, and which it is
        open_: list[tuple[int, dict]] = []
        end = 0
        for character in characters:
            window.append(character)
            open_.append((end, tree))
            end += 1
            start, piece, still = end - 1, -1, []
            for begin, node in open_:
                below = node.get(character)
                if below is None:
                    continue
                node, found = below
                if node:
                    still.append((begin, node))
                if found >= 0 and piece < 0:
                    may = pairs.get((made[begin], found))
                    if self._follows(made[begin], found) if may is None else may:
                        start, piece = begin, found
            open_ = still
            back.append(start)
            made.append(piece)
            if end > self.widest:
                self.widest = end
            if not open_ or end % self.longest == 0:
                agreed = self._agreed({begin for begin, _ in open_} | {end}, back)
                if agreed:
                    yield from self._path(window, back, made, agreed)
                    back = [0] + [b - agreed for b in back[agreed + 1 :]]
                    made = made[agreed:]
                    open_ = [(begin - agreed, node) for begin, node in open_]
                    window = window[agreed:]
                    end -= agreed
        yield from self._path(window, back, made, end)

    def whole(self, text: str) -> list[int]:
        """What ``feed`` gives off for a short text, with a window as long as the text."""
        tree, pairs, size = self.tree, self.pairs, len(text)
        back, made = list(range(-1, size)), [-1] * (size + 1)
        for begin in range(size):
            node, before = tree, made[begin]
            for end in range(begin, size):
                below = node.get(text[end])
                if below is None:
                    break
                node, found = below
                if found >= 0 and made[end + 1] < 0:
                    may = pairs.get((before, found))
                    if self._follows(before, found) if may is None else may:
                        back[end + 1], made[end + 1] = begin, found
        return self._path(text, back, made, size)

    def parts(self, text: str) -> Iterator[str]:
        """``text`` cut where no piece has the two characters side by side: nothing is
        merged across, so that each part's ids are its own."""
        joined, begin = bytes(map(self.neighbours.__contains__, pairwise(text))), 0
        while end := joined.find(0, begin) + 1:
            yield text[begin:end]
            begin = end
        yield text[begin:]

    @staticmethod
    def _agreed(alive: set[int], back: list[int]) -> int:
        """The last boundary that the paths to all living boundaries share."""
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(back[last])
        return alive.pop()

    def _path(self, window: Sequence[str], back: list[int], made: list[int], end: int) -> list[int]:
        parts = []
        while end:
            start = back[end]
            parts.append([made[end]] if made[end] >= 0 else self._of_character(window[start]))
            end = start
        return [i for part in reversed(parts) for i in part]


class _Known(dict):
    """Ids as bytes, of at most ``MOST_STRETCHES`` short texts; a new one is made where it is missed."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, text: str) -> bytes:
        ids = self.make(text)
        if len(text) <= LONGEST_KEPT:
            if len(self) >= MOST_STRETCHES:
                self.clear()
            self[text] = ids
        return ids


class PieceCodec:
    """Texts to ids and back; stretches that repeat are kept."""

    def __init__(self, path: str):
        self.viterbi = StreamingViterbi(read_model(path))
        # Pieces with a blank sign inside consist of blank signs only, or no
        # boundary before a blank sign would be safe.
        self.cuts = all(BLANK not in p[1:] or not p.strip(BLANK) for p in self.viterbi.ids)
        # Stretches without the blank sign they begin with, and parts behind a stretch's first.
        self.known, self.behind = _Known(self._stretch), _Known(self._part)
        self.text_of: list[bytes] = []
        for piece, _, kind in self.viterbi.pieces:
            if kind == BYTE:
                self.text_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.text_of.append(piece.replace(BLANK, " ").encode() if kind in (NORMAL, USER_DEFINED) else b"")

    def _stretches(self, text: str) -> list[str]:
        """Cut before every blank sign that follows another character; the sign that
        every stretch begins with is left out."""
        if not self.cuts:
            return [text.replace(" ", BLANK)]
        parts = text.split(" ")
        if "" not in parts:
            return parts
        out, blanks = [], ""
        for part in parts:
            if part:
                out.append(blanks + part)
                blanks = ""
            else:
                blanks += BLANK
        if blanks:
            out.append(blanks[1:])
        return out

    def _stretch(self, rest: str) -> bytes:
        """The ids of a stretch, by its parts."""
        parts = self.viterbi.parts(BLANK + rest)
        first = next(parts)[1:]
        if len(first) == len(rest):
            return self._part(BLANK + rest)
        return self.known[first] + b"".join(map(self.behind.__getitem__, parts))

    def _part(self, part: str) -> bytes:
        found = self.viterbi.whole(part) if len(part) <= LONGEST_KEPT else self.viterbi.feed(part)
        return array("i", found).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as int32."""
        if not text:
            return np.empty(0, dtype=np.int32)
        if BLANK in text:
            signs = {" ": BLANK, BLANK: OWN_SIGN}
            return np.fromiter(self.viterbi.feed([BLANK, *(signs.get(c, c) for c in text)]), dtype=np.int32)
        return np.frombuffer(b"".join(map(self.known.__getitem__, self._stretches(text))), dtype=np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join(map(self.text_of.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", errors="replace")


_LOADED: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _LOADED:
        _LOADED[path] = PieceCodec(path)
    return _LOADED[path]


def model_file(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encoder(path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            ids = [encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return encoded


def encode_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model_path: str | None = None
) -> DataFrame:
    """doc_id, ids (array<int>)."""
    workers_import(docs.sparkSession)
    source = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_encoder(model_file(model_path)), f"doc_id {id_type}, ids array<int>")


def _decoder(path: str):
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path).decode
        for batch in batches:
            texts = [decode(i) if i is not None else None for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                names=["doc_id", "ids", "text"],
            )

    return decoded


def decode_ids(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, ids, text of a frame with doc_id and ids; null ids give null."""
    workers_import(encoded.sparkSession)
    source = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_decoder(model_file(model_path)), f"doc_id {id_type}, ids array<int>, text string")


def _both(path: str):
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [own.encode(t) for t in texts]
            same = [own.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(same, pa.bool_()),
                ],
                names=["doc_id", "ids", "same_text"],
            )

    return both


def round_trip(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model_path: str | None = None
) -> DataFrame:
    """doc_id, ids, and same_text: whether decoding the ids gives the text back."""
    workers_import(docs.sparkSession)
    source = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        _both(model_file(model_path)), f"doc_id {id_type}, ids array<int>, same_text boolean"
    )
