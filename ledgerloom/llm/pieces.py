"""Exact BPE encoding of whole texts with a SentencePiece model, and decoding.

The library merges the best pair again and again. The same result is found left to right:

* a sequence of pieces is the encoding of its text exactly if every two neighbours are the
  encoding of the two together (a merge across a border, the first one in time, would also
  happen among these two alone). ``compatible`` decides that by re-merging the two and keeps
  the answer;
* an Aho-Corasick automaton gives the longest piece at every position; from there
  ``encode_run`` takes the longest piece that is compatible with the one before it, then
  shorter ones, and steps back when none is left. The encoding of a prefix is unique, so a
  position that failed once fails for good: a bitfield keeps these, which makes the
  search linear.

Characters outside the vocabulary never merge and become byte pieces. Where no piece of the
model has a space sign after another character, texts are cut before each run of spaces, and
the encoding of such a part is kept in a bounded table of the task.

Models: type BPE, normaliser "identity" without removal of white space (others raise
``ValueError``). A null text is empty and has no ids; repeated rows are encoded each on its own;
other columns of the documents do not matter unless named in ``keep``. An empty table
gives no rows. The model's pieces (its file, bounded by the vocabulary) go to
the tasks with the function; executors need not see the file.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Parts and pairs that a task remembers before it begins anew.
MEMO = 600_000
UNKNOWN_SURFACE = " ⁇ "


@dataclass(frozen=True)
class PieceModel:
    """Pieces of a model by id: text, score and kind ("piece", "byte", "control", "unknown")."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[str, ...]
    dummy_prefix: bool
    byte_fallback: bool

    @cached_property
    def key(self) -> str:
        return hashlib.sha256(repr((self.pieces, self.scores, self.kinds, self.dummy_prefix)).encode()).hexdigest()


def read_model(path: str) -> PieceModel:
    """The pieces of a model file, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    kind = {1: "piece", 2: "unknown", 3: "control", 6: "byte"}
    if train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only BPE models with the identity normaliser are read")
    if train.treat_whitespace_as_suffix or any(p.type not in kind for p in model.pieces):
        raise ValueError("models with space as suffix, user-defined or unused pieces are not read")
    return PieceModel(
        tuple(p.piece for p in model.pieces), tuple(p.score for p in model.pieces),
        tuple(kind[p.type] for p in model.pieces), norm.add_dummy_prefix, train.byte_fallback,
    )




def _byte(piece: str) -> int:
    """65 for the piece "<0x41>"."""
    return int(piece[3:5], 16)


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("ledgerloom-per-byte", _one_byte)


class PieceCoder:
    """Encoder and decoder of one model; keeps what it learned about pairs and parts."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == "piece"}
        self.unknown = model.kinds.index("unknown")
        self.bytes = {_byte(p): i for i, p in enumerate(model.pieces) if model.kinds[i] == "byte"}
        self.letters = {p for p in self.ids if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        # the next shorter piece that begins a piece
        self.shorter = {}
        for piece, i in self.ids.items():
            self.shorter[i] = next((self.ids[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), None)
        # spaces only at the beginning of pieces: texts can be cut before them
        cut = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.parts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if cut else "(?s:.+)").findall
        self.plain = cut and model.dummy_prefix and "\n" not in self.letters
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known = _Parts(self)
        self.raw = {str(i): self._raw(i) for i in range(len(model.pieces))}
        self.controls = {str(i) for i, k in enumerate(model.kinds) if k == "control"}

    def _raw(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == "byte":
            return bytes([_byte(piece)])
        if kind == "control":
            return b""
        return (UNKNOWN_SURFACE if kind == "unknown" else piece.replace(SPACE, " ")).encode()

    def merged(self, text: str) -> list[str]:
        """What merging gives: the pair with the best score first, the leftmost of equal ones."""
        parts, ids, scores = list(text), self.ids, self.model.scores
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int | None, right: int) -> bool:
        """Whether the two pieces (the second alone, at the beginning) come out of merging their text."""
        known = self.pairs.get((left, right))
        if known is None:
            pieces = self.model.pieces
            want = [pieces[right]] if left is None else [pieces[left], pieces[right]]
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged("".join(want)) == want
        return known

    def encode_run(self, text: str) -> list[int]:
        """Ids of a text of characters that are all pieces."""
        pairs, shorter, pieces = self.pairs, self.shorter, self.model.pieces
        failed = bytearray((len(text) >> 3) + 1)
        out: list[int] = []
        starts: list[int] = []
        at, left = 0, None
        # leftmost longest matches lie end to end, as every character is a piece
        matches = self.automaton.iter_long(text)
        size, piece = next(matches)[1]
        longest = True  # the matches go on behind the piece at hand
        while True:
            while piece is not None:
                end = at + size
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = pairs.get((left, piece))
                    if fits or (fits is None and self.compatible(left, piece)):
                        break
                piece = shorter[piece]
                size = len(pieces[piece]) if piece is not None else 0
                longest = False
            if piece is None:  # nothing fits here: the piece before has to be shorter
                failed[at >> 3] |= 1 << (at & 7)
                at, piece = starts.pop(), shorter[out.pop()]
                size = len(pieces[piece]) if piece is not None else 0
                left = out[-1] if out else None
                continue
            out.append(piece)
            starts.append(at)
            at += size
            if at == len(text):
                return out
            left = piece
            if not longest:
                matches, longest = self.automaton.iter_long(text, at), True
            size, piece = next(matches)[1]

    def encode_part(self, text: str) -> list[int]:
        if self.letters.issuperset(text):
            return self.encode_run(text)
        out: list[int] = []
        begin = 0
        for k, letter in enumerate(text):
            if letter not in self.letters:
                if begin < k:
                    out += self.encode_run(text[begin:k])
                out += [self.bytes[x] for x in letter.encode()] if self.model.byte_fallback else [self.unknown]
                begin = k + 1
        return out + self.encode_run(text[begin:]) if begin < len(text) else out

    def _escaped(self, text: str) -> str:
        return (SPACE if self.model.dummy_prefix and text else "") + text.replace(" ", SPACE)

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(self._escaped(text)) for i in self.encode_part(part)]

    def _cut(self, text: str) -> list[str]:
        """The parts of an escaped text. Line ends that are no pieces begin parts of their own, and the
        space sign before other parts is left out, where single spaces make that clear."""
        if self.plain:
            spread = text.replace("\n", " \n")
            if not (SPACE in text or "  " in spread or spread[:1] in ("", " ") or spread[-1] == " "):
                return spread.split(" ")
        return self.parts(self._escaped(text))

    def written(self, text: str) -> str:
        """The ids as decimals joined by commas."""
        return ",".join(map(self.known.__getitem__, self._cut(text)))

    def decode_written(self, ids: str) -> str:
        """The text of ids as ``written`` gives them; bytes that are no character become U+FFFD each,
        control ids give nothing, but bytes on two sides of one make no character together."""
        numbers = ids.split(",") if ids else []
        if self.controls.isdisjoint(numbers):
            groups = [numbers]
        else:
            groups = [list(g) for control, g in groupby(numbers, self.controls.__contains__) if not control]
        text = "".join(b"".join(map(self.raw.__getitem__, g)).decode("utf-8", "ledgerloom-per-byte") for g in groups)
        if self.model.dummy_prefix and groups and groups[0]:
            first = int(groups[0][0])
            if self.model.kinds[first] == "piece" and self.model.pieces[first].startswith(SPACE):
                return text[1:]
        return text

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_written(",".join(map(str, ids)))


class _Parts(dict):
    """Written ids of the parts met so far; begins anew when it is full."""

    def __init__(self, coder: PieceCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, part: str) -> str:
        whole = SPACE + part if self.coder.plain and part[0] not in SPACE + "\n" else part
        ids = ",".join(map(str, self.coder.encode_part(whole)))
        if len(self) >= MEMO:
            self.clear()
        if len(part) <= 64:
            self[part] = ids
        return ids


_coders: dict[str, PieceCoder] = {}


def coder_of(model: PieceModel) -> PieceCoder:
    """The coder of a model in this process; a task that follows in it goes on with the same one."""
    if model.key not in _coders:
        _coders.clear()
        _coders[model.key] = PieceCoder(model)
    return _coders[model.key]


def encode(docs: DataFrame, model: PieceModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``docs(text, ...)`` -> the kept columns and ``ids`` (array of int)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    @F.pandas_udf("array<int>")
    def ids(texts):
        coder = coder_of(shared.value)
        return texts.map(lambda t: coder.encode(t or ""))

    return docs.select(*keep, ids("text").alias("ids"))


def decode(coded: DataFrame, model: PieceModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``coded(ids, ...)`` -> the kept columns and ``text``; null ids decode to the empty text."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text(ids):
        coder = coder_of(shared.value)
        return ids.map(lambda x: coder.decode([] if x is None else x))

    return coded.select(*keep, text("ids").alias("text"))


def digests(docs: DataFrame, model: PieceModel) -> DataFrame:
    """Each document encoded and decoded again: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared.value)
        for batch in batches:
            sizes, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = coder.written(text.as_py() or "")
                sizes.append(ids.count(",") + 1 if ids else 0)
                coded.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode_written(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(coded), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
