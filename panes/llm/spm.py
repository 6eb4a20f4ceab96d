"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The encoder walks over the characters of a normalised text and keeps, for each
position, the last piece of the best path to it (its backpointer).  Only as many
positions as the longest piece has characters can still be continued; whenever
the paths back from all of them meet in one boundary, the ids before it are
committed and forgotten.  The window is bounded by the longest piece, however
long the text is.

The best path depends on the model's kind.  ``unigram``: the largest sum of
scores.  ``bpe``: a prefix of a text has one encoding, and a path is that encoding
just if each pair of neighbouring pieces is what byte-pair merging makes of the
two together; so a path may be continued by a piece only if that holds for it and
the piece before.  The ids equal those of the SentencePiece library.

No piece has a space after another character, so paths always meet at the end
of a word; what a task has encoded between two such boundaries it remembers by
its text.  What it has not, it encodes in sorted order: the best paths to the
positions of a shared beginning are those found for the text before.

Defined results.  Null and empty texts have no ids and decode to an empty text.
Characters without a piece become byte pieces, so decoding returns the text
itself, with one exception: U+2581, which stands for a space in pieces, comes
back as a space.  Equal texts have equal ids.  An empty table gives no rows.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package
from .words import Recent, coded, gather, shared_beginnings, slices

SPACE = "▁"
#: Segments between boundaries, and pairs of pieces, that a worker remembers (twice so many at most).
REMEMBERED = 200_000
#: Positions between two tries to commit; no longer segments are remembered.
STRIDE = 64


class Pieces:
    """The vocabulary of a model file."""

    def __init__(self, model: bytes, kind: str = "bpe"):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        self.kind = kind
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.id = {p: sp.piece_to_id(p) for p in self.score}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.raw = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else
                    sp.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        self.longest = max(map(len, self.score))
        #: A score below that of any piece, for a character without one.
        self.missing = min(self.score.values()) - 10
        self.pairs = Recent(REMEMBERED)
        self.suffixes()

    def suffixes(self) -> None:
        """An automaton over characters (Aho and Corasick, 1975): ``ending[state]`` has the
        pieces that end where the state is reached, longest first, with their sizes."""
        self.go: list[dict[str, int]] = [{}]
        own: list[str | None] = [None]
        for piece in self.score:
            at = 0
            for c in piece:
                if c not in self.go[at]:
                    self.go[at][c] = len(self.go)
                    self.go.append({})
                    own.append(None)
                at = self.go[at][c]
            own[at] = piece
        self.found = 0  # steps remembered beside the pieces' own
        self.ending: list[tuple] = [()] * len(self.go)
        self.shorter = [0] * len(self.go)
        children = [dict(x) for x in self.go]  # ``go`` grows by what ``step`` finds
        level = list(children[0].values())
        while level:
            for at in level:
                rest = self.ending[self.shorter[at]]
                self.ending[at] = ((len(own[at]), own[at]), *rest) if own[at] is not None else rest
                for c, child in children[at].items():
                    low = self.shorter[at]
                    while low and c not in children[low]:
                        low = self.shorter[low]
                    self.shorter[child] = children[low].get(c, 0)
            level = [x for at in level for x in children[at].values()]

    def step(self, state: int, c: str) -> int:
        """The state after one more character."""
        at = state
        while c not in self.go[at] and at:
            at = self.shorter[at]
        found = self.go[at].get(c, 0)
        if found and self.found < REMEMBERED:
            self.found += 1
            self.go[state][c] = found
        return found

    def ids_of(self, pieces: list[str]) -> list[int]:
        try:
            return [self.id[piece] for piece in pieces]
        except KeyError:
            out = []
        for piece in pieces:
            own = self.id.get(piece)
            if own is not None:
                out.append(own)
            else:
                out += [self.byte[b] for b in piece.encode()]
        return out

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short text: the best pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, before: str, piece: str) -> bool:
        """Whether merging leaves the two pieces as they are, side by side."""
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            known = self.merged(before + piece) == ([before, piece] if before else [piece])
            self.pairs.put(key, known)
        return known


class Viterbi:
    """Encodes a stream of characters; ``feed`` and ``close`` return what is committed."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.back: list[str] = [""]  # the last piece of the path to each position from the last committed boundary on
        self.total = [0.0]  # of a unigram model
        self.states = [0]  # of the pieces' automaton, at each position

    def _path(self, end: int) -> list[str]:
        """The pieces of the path from the boundary to ``end``."""
        pieces = []
        while end:
            pieces.append(self.back[end])
            end -= len(self.back[end])
        return pieces[::-1]

    def _commit(self, ends: list[int]) -> list[int]:
        """The ids before the last boundary that the paths back from all ``ends`` share."""
        fronts = set(ends)
        while len(fronts) > 1:
            last = max(fronts)
            fronts.remove(last)
            fronts.add(last - len(self.back[last]))
        at = fronts.pop()
        pieces = self._path(at)
        if pieces:
            self.back, self.states = self.back[at:], self.states[at:]
            self.total = [t - self.total[at] for t in self.total[at:]]
        return self.p.ids_of(pieces)

    def feed(self, text: str) -> list[int]:
        """Find the last piece of the best path to each position, committing on the way."""
        out, longest = [], self.p.longest
        walk = self._merge if self.p.kind == "bpe" else self._score
        for i in range(0, len(text), STRIDE):
            walk(text[i:i + STRIDE])
            if len(self.back) > STRIDE + longest + 1:
                out += self._commit(list(range(len(self.back) - longest, len(self.back))))
        return out

    def _merge(self, text: str) -> None:
        """``feed`` for byte-pair merging: the one piece that may follow the piece before it."""
        p, back, states = self.p, self.back, self.states
        go, ending, known = p.go, p.ending, p.pairs.new
        state, end = states[-1], len(back)
        for c in text:
            state = go[state].get(c) or p.step(state, c)
            for size, piece in ending[state]:
                if size <= end:
                    fits = known.get((back[end - size], piece))
                    if fits is None:
                        fits = p.follows(back[end - size], piece)
                        known = p.pairs.new
                    if fits:
                        break
            else:
                piece = self._without_piece(c, end)
            back.append(piece)
            states.append(state)
            end += 1

    def _score(self, text: str) -> None:
        """``feed`` for sums of scores."""
        p, back, total, states = self.p, self.back, self.total, self.states
        state = states[-1]
        for c in text:
            state = p.go[state].get(c) or p.step(state, c)
            end, best, most = len(back), None, 0.0
            for size, piece in p.ending[state]:
                if size <= end and (best is None or total[end - size] + p.score[piece] > most):
                    best, most = piece, total[end - size] + p.score[piece]
            if best is None:
                best, most = self._without_piece(c, end), total[end - 1] + p.missing
            back.append(best)
            total.append(most)
            states.append(state)

    def _without_piece(self, c: str, end: int) -> str:
        """The character itself, where no piece ends."""
        if c in self.p.score:
            raise ValueError(f"no piece ends at {(''.join(self._path(end - 1)) + c)[-self.p.longest:]!r}")
        return c

    def rewind(self, size: int) -> None:
        """Forget all but ``size`` characters since the last committed boundary."""
        del self.back[size + 1:], self.states[size + 1:], self.total[size + 1:]

    def pending(self) -> list[int]:
        """The ids that ``close`` would return, committing none."""
        return self.p.ids_of(self._path(len(self.back) - 1))

    def close(self) -> list[int]:
        return self._commit([len(self.back) - 1])


class Encoder:
    """Ids of texts, remembering segments between sure boundaries."""

    def __init__(self, model: bytes, kind: str = "bpe"):
        self.pieces = Pieces(model, kind)
        self.known = Recent(REMEMBERED)
        inside = [p for p in self.pieces.score if SPACE in p.lstrip(SPACE)]
        #: Paths meet where a run of spaces begins, if no piece has a space after another character.
        self.split = None if inside else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        #: A line end without a piece is a boundary on either side.
        self.by_lines = self.split is not None and not any("\n" in p for p in self.pieces.score)

    def segment(self, text: str) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            v = Viterbi(self.pieces)
            ids = array("i", v.feed(text) + v.close()).tobytes()
            if len(text) <= STRIDE:
                self.known.put(text, ids)
        return ids

    def segments(self, texts: list[str]) -> list[bytes]:
        """``segment`` of distinct texts; a beginning that sorted neighbours share is walked once."""
        found = dict(zip(texts, map(self.known.get, texts), strict=True))
        short = sorted(t for t, ids in found.items() if ids is None and len(t) <= STRIDE)
        v = Viterbi(self.pieces)
        for text, same in zip(short, shared_beginnings(short), strict=True):
            v.rewind(same)
            v.feed(text[same:])
            found[text] = ids = array("i", v.pending()).tobytes()
            self.known.put(text, ids)
        return [self.segment(t) if ids is None else ids for t, ids in found.items()]

    def one(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        whole = SPACE + text.replace(" ", SPACE)
        segments = self.split.findall(whole) if self.split else [whole]
        return np.frombuffer(b"".join(map(self.segment, segments)), "<i4")

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text's own."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, SPACE)))
        odd = odd.to_numpy(zero_copy_only=False) | (not self.by_lines)
        plain = texts.filter(pa.array(~odd))
        # Single spaces only: a segment begins at each space, and at each line end and after it.
        marked = pc.replace_substring(pc.replace_substring(plain, " ", " " + SPACE), "\n", " \n ")
        large = lambda x: pa.scalar(x, pa.large_string())
        marked = pc.if_else(pc.equal(plain, ""), large(""), pc.binary_join_element_wise(large(SPACE), marked, large("")))
        lists = pc.split_pattern(marked, " ")
        flat = lists.flatten()
        owner = np.repeat(np.flatnonzero(~odd), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        codes, distinct = coded(flat.filter(pa.array(full)))
        owner = owner[full]
        found = self.segments(distinct)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        values = np.frombuffer(b"".join(found), "<i4")
        ids = gather(values, (np.cumsum(sizes) - sizes)[codes], sizes[codes])
        counts = np.bincount(owner, sizes[codes], len(texts)).astype(np.int64)
        if odd.any():
            pieces = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(odd):
                pieces[i] = self.one(texts[int(i)].as_py())
                counts[i] = len(pieces[i])
            ids = np.concatenate(pieces)
        return ids, np.concatenate(([0], np.cumsum(counts)))


def decode(ids: list[int], raw: list[bytes]) -> str:
    """The text of ids; the space put before a text is taken off again."""
    return b"".join(map(raw.__getitem__, ids)).removeprefix(b" ").decode(errors="replace")


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def encoder(model: bytes, kind: str) -> Encoder:
    """One for each model and worker process."""
    key = (hash(model), kind)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model, kind)
    return _ENCODERS[key]


def encode_texts(docs: DataFrame, model: bytes, kind: str = "bpe", decoded: bool = False) -> DataFrame:
    """doc_id and ids of every row of ``docs`` (doc_id, text); ``model``: a model file's contents.

    With ``decoded`` also the text that the ids decode to.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
                          + [T.StructField("decoded", T.StringType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, kind)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = encode(part.column(1))
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))]
                if decoded:
                    raw = encode.pieces.raw
                    columns.append(pa.array([decode(ids[a:b].tolist(), raw) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_column(ids: Column, model: bytes, kind: str = "bpe") -> Column:
    """The texts of a column of ids."""
    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        raw = encoder(model, kind).pieces.raw
        return pa.array([decode(x.values.to_pylist(), raw) if x.is_valid else "" for x in lists], pa.string())

    return decoded(ids)
