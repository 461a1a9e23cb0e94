"""Packing into sequences by vector bin packing.

Pieces of documents are placed under simultaneous limits on tokens, segments and loss-bearing tokens. An open sequence
takes, of the pieces at hand, the one whose demand has the largest dot product with what the sequence has left; when none
fits whole, the best one is cut. Every partition packs its own documents with a bounded stock of pieces, so nothing is
shuffled and a lost task is simply run again.

A sequence costs nothing beyond its tokens when their number is a power of two, else it is padded to the full length.
What a partition has left at its end is therefore cut at powers of two.

Defined results: a null text counts as empty and gives the end token alone; repeated rows are packed each on their own;
an empty table gives an empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = 1
BATCH = 1_000
#: More than any limit: the demand of a place in the stock that is empty.
TAKEN = 2**62


@dataclass(frozen=True)
class Limits:
    """Of one sequence. A piece's first token follows nothing in its sequence and bears no loss."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2047
    #: Pieces a partition holds at once to choose from.
    stock: int = 128


@dataclass
class Piece:
    row: int
    ids: np.ndarray
    loss: np.ndarray  # of each token, 0 or 1
    start: int
    total: int
    demand: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.demand = np.array([len(self.ids), 1, self.loss.sum()], dtype=np.int64)

    def cut(self, at: int) -> tuple[Piece, Piece]:
        second = self.loss[at:].copy()
        second[0] = 0
        return (
            Piece(self.row, self.ids[:at], self.loss[:at], self.start, self.total),
            Piece(self.row, self.ids[at:], second, self.start + at, self.total),
        )


def pack(pieces: Iterable[Piece], limits: Limits = Limits()) -> Iterator[list[Piece]]:
    """Sequences, each a list of pieces in order, within the limits."""
    if min(limits.tokens, limits.segments, limits.stock) < 1 or limits.loss < 0:
        raise ValueError("the limits leave no room for a single token")
    most = (limits.tokens, limits.segments, max(limits.loss, 1))
    caps = (limits.tokens, limits.segments, limits.loss)
    source, stock, done = iter(pieces), [None] * limits.stock, False
    # demands of the stock, one row a limit, and their shares of the limits; what is taken demands too much to fit
    demands = np.full((3, limits.stock), TAKEN, dtype=np.int64)
    shares = np.zeros((3, limits.stock))
    free = np.zeros(limits.stock, dtype=bool)
    held = 0

    def put(at: int, piece: Piece | None) -> None:
        nonlocal held
        if stock[at] is not None:
            held -= len(stock[at].ids)
        stock[at], free[at] = piece, piece is not None
        demands[:, at] = TAKEN if piece is None else piece.demand
        if piece is not None:
            held += len(piece.ids)
            shares[:, at] = piece.demand / most

    while True:
        if not done:
            for at in np.flatnonzero(~free).tolist():
                if (piece := next(source, None)) is None:
                    done = True
                    break
                put(at, piece)
        if not held:
            return
        left = list(caps)
        if done and held < limits.tokens:
            left[0] = 1 << (held.bit_length() - 1)  # the largest power of two still filled
        sequence: list[Piece] = []
        aside: list[tuple[int, Piece]] = []
        while left[0] > 0 and left[1] > 0 and held:
            fits = (demands[0] <= left[0]) & (demands[1] <= left[1]) & (demands[2] <= left[2])
            score = shares[0] * (left[0] / most[0]) + shares[1] * (left[1] / most[1]) + shares[2] * (left[2] / most[2])
            whole = np.where(fits, score, -1.0)
            at = int(whole.argmax())
            if whole[at] >= 0:
                sequence.append(stock[at])
                left = [a - int(b) for a, b in zip(left, stock[at].demand)]
                put(at, None)
                continue
            at = int(np.where(free, score, -1.0).argmax())
            piece = stock[at]
            size = int(np.searchsorted(np.cumsum(piece.loss[: left[0]]), left[2], side="right"))
            put(at, None)
            if size == 0:
                aside.append((at, piece))
                continue
            first, second = piece.cut(size)
            sequence.append(first)
            left = [a - int(b) for a, b in zip(left, first.demand)]
            aside.append((at, second))
        for at, piece in aside:
            put(at, piece)
        size = sum(len(p.ids) for p in sequence)
        if done and size < limits.tokens and size & (size - 1):
            # another limit than that on tokens closed it: what exceeds a power of two goes back
            over = size - (1 << (size.bit_length() - 1))
            while over:
                piece = sequence.pop()
                if len(piece.ids) > over:
                    first, piece = piece.cut(len(piece.ids) - over)
                    sequence.append(first)
                over -= len(piece.ids)
                if free.all():  # cutting may leave one piece more than there is room for
                    stock, free = [*stock, None], np.append(free, False)
                    demands, shares = np.hstack([demands, np.full((3, 1), TAKEN)]), np.hstack([shares, np.zeros((3, 1))])
                put(int(np.flatnonzero(~free)[0]), piece)
        yield sequence


#: How the vocabulary's byte-level coding splits text (fixed by the vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _assumed(described: dict, path: str) -> None:
    """The file must describe what the coder below does: byte-level BPE whose merges are ranked like their ids."""
    model, split = described["model"], described["pre_tokenizer"] or {}
    plain = [f for f in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(f)]
    if (
        described["normalizer"] is not None
        or model["type"] != "BPE"
        or plain
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
    ):
        raise ValueError(f"{path}: not a plain byte-level vocabulary")
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError(f"{path}: the order of merges is not that of the ids")


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids by a byte-level vocabulary file of the tokenizers library; strings of special tokens are ordinary text.

    Made once in a worker process, whatever the number of its tasks.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    _assumed(described, path)
    special = {token["content"] for token in described["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in described["model"]["vocab"].items() if t not in special}
    whole = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: np.frombuffer(array("I", whole(text)), dtype=np.uint32)


def packed(documents: DataFrame, tokenizer: str, limits: Limits = Limits(), keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per piece: keys, start, length, ids (little-endian 32-bit), loss_tokens, doc_tokens, sequence_id, offset, row_id.

    row_id tells rows with equal keys apart (repeated documents, for instance): each row's pieces have one of their own.
    """
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_type

    import pyarrow as pa

    def run(batches):
        task = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        names: dict[int, tuple] = {}
        left: dict[int, int] = {}

        def pieces():
            row = 0
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(len(keys))]
                for i, text in enumerate(batch.column(len(keys)).to_pylist()):
                    ids = np.append(encode(text or ""), np.uint32(END)).astype("<u4", copy=False)
                    loss = np.ones(len(ids), dtype=np.int8)
                    names[row], left[row] = tuple(c[i] for c in columns), len(ids)
                    for start in range(0, len(ids), limits.tokens):
                        loss[start] = 0
                        yield Piece(row, ids[start : start + limits.tokens], loss[start : start + limits.tokens], start, len(ids))
                    row += 1

        rows: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*rows), types)], names=out)

        for number, sequence in enumerate(pack(pieces(), limits)):
            offset = 0
            for piece in sequence:
                n = len(piece.ids)
                rows.append((*names[piece.row], piece.start, n, piece.ids.tobytes(), int(piece.loss.sum()), piece.total, (task << 40) + number, offset, (task << 40) + piece.row))
                offset += n
                left[piece.row] -= n
                if not left[piece.row]:
                    del names[piece.row], left[piece.row]
            if len(rows) >= BATCH:
                yield batch()
                rows = []
        if rows:
            yield batch()

    fields = documents.select(*keys).schema.fields
    types = [
        *[to_arrow_type(f.dataType) for f in fields],
        pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    ]
    out = [*[f"k{i}" for i in range(len(keys))], "start", "length", "ids", "loss_tokens", "doc_tokens", "sequence_id", "offset", "row_id"]
    schema = ", ".join([f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)]) + (
        ", start bigint, length bigint, ids binary, loss_tokens bigint, doc_tokens bigint, sequence_id bigint, offset bigint, row_id bigint"
    )
    return (
        documents.select(*keys, F.col("text"))
        .mapInArrow(run, schema)
        .withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
    )
