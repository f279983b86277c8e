"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file: the normaliser (a leading space, spaces to U+2581),
the lexicon (a trie whose ends put out piece ids, with arcs to byte pieces for characters it lacks)
and a constraint over neighbouring pieces. Composed with a text they give a lattice of
segmentations; its shortest path in the tropical semiring (costs add up, the least one wins) is the
encoding.

The models at hand are BPE models, whose encoding isn't the segmentation with the best sum of piece
scores, but the one that merging in order of the scores ends with. That one is characterised by its
neighbours: a segmentation is what merging ends with if and only if merging any two neighbouring
pieces' text alone ends with these two pieces. So the constraint lets a pair of neighbours pass at
no cost or not at all, and each piece costs one; the ids equal those of the reference library.
Decoding is the inverse machine: every id puts out its bytes.

No piece of such a vocabulary goes on after a space that follows another character, so a text's
lattice falls into parts at the spaces, and equal parts of a task are solved once.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from .tables import ship, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
START = -1
#: Solved parts (twice as many: recent ones and those before) and checked neighbours a worker holds on to.
PARTS, PAIRS = 100_000, 300_000
SLICE = 128
#: Ids that are decoded at once.
DECODED = 1 << 18

_machines: dict[str, "Transducer"] = {}


def _fields(message: bytes):
    """(number, value) of a protocol buffer message: whole numbers, or bytes."""
    at, end = 0, len(message)

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, message[at : at + size]
            at += size


# Field numbers of a model file and the kinds that are understood.
PIECE, TRAINER, NORMALISER = 1, 2, 3
MODEL_TYPE, BPE, SUFFIX_SPACE = 3, 2, 24
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
PIECE_KIND, USER_DEFINED, UNUSED = 3, 4, 5


def check_model(path: str) -> None:
    """Refuse a model whose encoding this machine would get wrong: other than BPE, with a
    normaliser of its own, with pieces that are matched before merging or left out of it."""
    with open(path, "rb") as file:
        parts = list(_fields(file.read()))
    trainer = dict(f for n, v in parts if n == TRAINER for f in _fields(v))
    normaliser = dict(f for n, v in parts if n == NORMALISER for f in _fields(v))
    found = []
    if trainer.get(MODEL_TYPE, 1) != BPE:
        found.append("no BPE model")
    if normaliser.get(CHARACTER_MAP) or normaliser.get(REMOVE_SPACES, 1):
        found.append("a normaliser that changes characters or spaces")
    if not normaliser.get(DUMMY_PREFIX, 1) or not normaliser.get(ESCAPE_SPACES, 1) or trainer.get(SUFFIX_SPACE, 0):
        found.append("spaces marked in another way")
    if any(dict(_fields(v)).get(PIECE_KIND, 1) in (USER_DEFINED, UNUSED) for n, v in parts if n == PIECE):
        found.append("user-defined or unused pieces")
    if found:
        raise ValueError(f"{path} isn't supported: {', '.join(found)}")


def load(path: str = MODEL) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind is normal, byte, unknown or control."""
    import sentencepiece

    check_model(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else "control" if model.is_control(i) else "normal"
    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())]


class Transducer:
    """The composed machine of one vocabulary. Characters outside it have the id -2 - code point
    inside the lattice and come out as byte pieces."""

    def __init__(self, vocabulary: list[tuple[str, float, str]]):
        normal = {p: (i, s) for i, (p, s, k) in enumerate(vocabulary) if k == "normal"}
        self.normal = normal
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(vocabulary) if k == "byte"}
        self.unknown = next((i for i, (_, _, k) in enumerate(vocabulary) if k == "unknown"), None)
        self.text = [p for p, _, _ in vocabulary]
        #: A node maps characters to nodes and None to the (length, id) of the pieces that end on
        #: the way to it, the longest last.
        self.root: dict = {None: ()}
        for piece in sorted(normal):
            node = self.root
            for k, c in enumerate(piece, 1):
                if c not in node:
                    end = normal.get(piece[:k])
                    own = node[None] if k > 1 or end is not None else ((1, -2 - ord(c)),)
                    node[c] = {None: own if end is None else (*own, (k, end[0]))}
                node = node[c]
        falls_apart = all(SPACE not in p.lstrip(SPACE) for p in normal)
        # parts are kept with plain spaces, which takes less memory
        self.part = re.compile(" *[^ ]+| +" if falls_apart else r"(?s).+")
        self.number = "H" if len(vocabulary) <= 1 << 16 else "i"
        self.out = [self._bytes(*v) for v in vocabulary]
        self.blob = np.frombuffer(b"".join(self.out), np.uint8)
        self.lengths = np.array([len(b) for b in self.out], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        self.sides: dict[tuple[int, bool], tuple] = {}

    @staticmethod
    def _bytes(piece, _, kind):
        if kind == "byte":
            return bytes([int(piece[3:5], 16)])
        return {"control": b"", "unknown": " ⁇ ".encode()}.get(kind, piece.replace(SPACE, " ").encode())

    def merging(self, text: str, right: bool) -> tuple[str, list[tuple[float, str]]] | None:
        """How merging the best-scored neighbours (the leftmost of equals) makes one piece of the
        text: its outermost character on one side, and per step the score and the outermost symbol
        after it. None if it ends with more than one symbol."""
        symbols, steps = list(text), []
        outermost = symbols[-right]
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                known = self.normal.get(symbols[i] + symbols[i + 1])
                if known is not None and (best is None or known[1] > best):
                    best, at = known[1], i
            if at < 0:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best, symbols[-right]))
        return outermost, steps

    def label(self, i: int) -> str:
        return self.text[i] if i >= 0 else chr(-2 - i)

    def side(self, i: int, right: bool):
        known = self.sides.get((i, right))
        if known is None:
            known = self.sides[i, right] = self.merging(self.label(i), right) or ()
        return known

    def next_to(self, before: int) -> dict[int, bool]:
        """The constraint's arcs out of one piece that are known so far."""
        known = self.pairs.get(before)
        if known is None:
            if self.n_pairs >= PAIRS:
                self.pairs.clear()
                self.n_pairs = 0
            known = self.pairs[before] = {}
        return known

    def apart(self, before: int, piece: int) -> bool:
        """Whether the constraint lets two pieces be neighbours: merging both texts side by side
        never finds the pair across the border better than what is next on either side."""
        b = self.side(piece, False)
        if before == START or not b:
            return bool(b)
        a = self.side(before, True)
        if not a:
            return False
        (left, a_steps), (right, b_steps) = a, b
        i = j = 0
        while True:
            across = self.normal.get(left + right)
            pa = a_steps[i][0] if i < len(a_steps) else None
            pb = b_steps[j][0] if j < len(b_steps) else None
            # of equal scores the leftmost comes first: left side, border, right side
            if across is not None and (pa is None or across[1] > pa) and (pb is None or across[1] >= pb):
                return False
            if pa is None and pb is None:
                return True
            if pb is None or (pa is not None and pa >= pb):
                left = a_steps[i][1]
                i += 1
            else:
                right = b_steps[j][1]
                j += 1

    def shortest_path(self, text: str) -> list[int]:
        """Lattice ids of the cheapest path for a normalised text.

        The constraint's weights are zero or infinite and only one path is finite, so the search
        goes depth first, longest pieces first, and never enters a state twice that led nowhere."""
        n, root, pairs = len(text), self.root, self.pairs
        dead: set[tuple[int, int]] = set()
        path, stack, before, at = [], [], START, 0
        while True:
            # the lexicon's ways on from here
            node, to = root, at
            while to < n:
                way = node.get(text[to])
                if way is None:
                    break
                node = way
                to += 1
            open_ = node[None] or ((1, -2 - ord(text[at])),)
            left, known = len(open_), pairs.get(before)
            if known is None:
                known = self.next_to(before)
            while True:
                if not left:
                    dead.add((at, before))
                    at, before, known, open_, left = stack.pop()
                    path.pop()
                    continue
                left -= 1
                size, piece = open_[left]
                ok = known.get(piece)
                if ok is None:
                    ok = known[piece] = self.apart(before, piece)
                    self.n_pairs += 1
                if ok and not (dead and (at + size, piece) in dead):
                    break
            path.append(piece)
            if at + size == n:
                return path
            stack.append((at, before, known, open_, left))
            at, before = at + size, piece

    def solve(self, part: str) -> bytes:
        """The part's ids as packed numbers."""
        if len(self.parts) >= PARTS:
            self.older, self.parts = self.parts, {}
        known = self.older.get(part)
        if known is not None:
            self.parts[part] = known
            return known
        ids = self.shortest_path(part.replace(" ", SPACE))
        if min(ids) < 0:
            path, ids = ids, []
            for i in path:
                if i >= 0:
                    ids.append(i)
                elif self.byte:
                    ids += [self.byte[b] for b in chr(-2 - i).encode()]
                else:
                    ids.append(self.unknown)
        out = self.parts[part] = array(self.number, ids).tobytes()
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        solve = self.solve
        packed = b"".join([self.parts.get(p) or solve(p) for p in self.part.findall(" " + text.replace(SPACE, " "))])
        return np.frombuffer(packed, self.number).astype(np.int32)

    def decode(self, ids) -> str:
        out = self.out
        text = b"".join([out[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes that ids put out, without the space that encoding puts first."""
        out = []
        for at in range(0, len(ids), DECODED):
            part = ids[at : at + DECODED]
            size = self.lengths[part]
            ends = np.cumsum(size)
            out.append(self.blob[np.repeat(self.starts[part] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out).removeprefix(b" ")


def _machine(shared):
    name, vocabulary = shared.value
    if name not in _machines:
        _machines.clear()
        _machines[name] = Transducer(vocabulary)
    return _machines[name]


def _encode(shared, names):
    def run(batches):
        machine = _machine(shared)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                ids = [machine.encode(t or "") for t in part.column("_text").to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [kernel.lists(flat, offsets, pa.int32())], names=[*names, "_ids"])

    return run


def _decode(shared, names):
    def run(batches):
        machine = _machine(shared)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [None if i is None else machine.decode(i) for i in part.column("_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(texts, pa.string())], names=[*names, "_decoded"])

    return run


def _round_trip(shared, names):
    """Ids and, from them, the text again, in one pass."""
    space = SPACE.encode()

    def run(batches):
        machine = _machine(shared)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                ids, same = [], []
                for text in part.column("_text").to_pylist():
                    own = machine.encode(text or "")
                    ids.append(own)
                    same.append(machine.decoded(own) == (text or "").encode().replace(space, b" "))
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [kernel.lists(flat, offsets, pa.int32()), pa.array(same, pa.bool_())], names=[*names, "_ids", "_same"]
                )
                del ids, flat, part
            kernel.release()

    return run


def _mapped(docs: DataFrame, keep: list[str], source: str, as_source: str, made: dict[str, tuple[str, str]], run, path: str) -> DataFrame:
    """Columns ``keep`` and what ``run`` makes of ``source``; ``made``: column -> (inner name, type)."""
    spark = ship(docs.sparkSession)
    names = [c for c in keep if c not in made]
    own = [f"c{i}" for i in range(len(names))]
    inner = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(names, own)], F.col(f"`{source}`").alias(as_source))
    kinds = [f"{c} {inner.schema[c].dataType.simpleString()}" for c in own]
    shared = spark.sparkContext.broadcast((path, load(path)))
    out = inner.mapInArrow(run(shared, own), ", ".join([*kinds, *[f"{name} {kind}" for name, kind in made.values()]]))
    return out.select(*[F.col(o).alias(c) for c, o in zip(names, own)], *[F.col(name).alias(c) for c, (name, _) in made.items()])


def encode(docs: DataFrame, text: str = "text", as_column: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with the piece ids of each text as array<int>; every other column stays.

    Null and empty texts have no ids. Texts of any length are encoded whole, repeated rows one by
    one. A literal U+2581 is read as a space, as the library does."""
    return _mapped(docs, docs.columns, text, "_text", {as_column: ("_ids", "array<int>")}, _encode, model)


def decode(encoded: DataFrame, ids: str = "ids", as_column: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of each row's ids; null ids give null."""
    return _mapped(encoded, encoded.columns, ids, "_ids", {as_column: ("_decoded", "string")}, _decode, model)


def round_trip(docs: DataFrame, text: str = "text", keep: list[str] | None = None, model: str = MODEL) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ids and whether decoding them gives the text again
    (spaces for U+2581), in one pass. Columns ``ids`` and ``round_trip`` of ``docs`` are replaced."""
    made = {"ids": ("_ids", "array<int>"), "round_trip": ("_same", "boolean")}
    return _mapped(docs, docs.columns if keep is None else keep, text, "_text", made, _round_trip, model)


NAME = "op9_sentencepiece_transducer"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "round_trip")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns and their piece ids, checked by decoding."""
    coded = round_trip(docs)
    return coded.withColumn("n_pieces", F.size("ids"))
