"""Documents packed into sequences of one length, balanced by what attention over them costs.

A document's cost is linear in its tokens plus quadratic (attention). Tasks pack their own rows in
windows of about a million tokens, so nothing is shuffled and no task holds more than a window. In a
window, pieces of a full sequence stand alone; the rest of the documents, longest first, go to the
sequence of lowest cost among those with room for them. When none has room, the document is cut to
fill the cheapest ones. Tokens beyond the last full sequence of a window wait for the next one; at
the end of a task they fill sequences whose lengths are powers of two, which need no padding.
"""

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerloom.llm.common import narrowed, slices, tidy, utf8
from ledgerloom.llm.token_counts import tokenizer
from ledgerloom.llm.units import UnitTable, cut_finer, unit_ids, words

Piece = tuple[int, int, int]  # document, start, length


def cost(length, linear: float = 1.0, quadratic: float = 1 / 2048):
    """Estimated cost of attending over ``length`` tokens of one document."""
    return linear * length + quadratic * length * length


def fill(pieces: list[Piece], capacity: int, linear: float, quadratic: float) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences and the pieces that are left, fewer tokens than one sequence holds."""
    done = []
    rest = []
    for doc, start, length in pieces:
        while length >= capacity:
            done.append([(doc, start, capacity)])
            start, length = start + capacity, length - capacity
        if length:
            rest.append((doc, start, length))
    rest.sort(key=lambda p: (-p[2], p[0], p[1]))
    count = sum(p[2] for p in rest) // capacity
    if not count:
        return done, rest
    held: list[list[Piece]] = [[] for _ in range(count)]
    room, spent = np.full(count, capacity), np.zeros(count)
    left = []
    for doc, start, length in rest:
        while length:
            fits = np.flatnonzero(room >= length)
            if not len(fits):
                fits = np.flatnonzero(room)
            if not len(fits):
                left.append((doc, start, length))
                break
            k = fits[np.argmin(spent[fits])]
            part = min(length, int(room[k]))
            held[k].append((doc, start, part))
            room[k] -= part
            spent[k] += cost(part, linear, quadratic)
            start, length = start + part, length - part
    return done + held, left


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """Sequences whose lengths are falling powers of two, holding all pieces in order."""
    total, out = sum(p[2] for p in pieces), []
    waiting = list(reversed(pieces))
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        held = []
        while size:
            doc, start, length = waiting.pop()
            part = min(size, length)
            held.append((doc, start, part))
            size -= part
            if part < length:
                waiting.append((doc, start + part, length - part))
        out.append(held)
    return out


@functools.cache
def _word_ids(path: str) -> tuple[UnitTable, bool]:
    """Ids of words, kept for all tasks of a process, and whether words are cut at punctuation too."""
    known = tokenizer(path)
    return UnitTable(lambda units: unit_ids(known, units, " \x01 "), most=500_000), cut_finer(known)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Pieces of batches joined up to about ``limit`` text bytes, so that a word is looked up once for more rows, and the rows of each piece."""
    held, size = [], 0
    for batch in batches:
        for piece in slices(batch, "text", limit):
            if held and size + piece.nbytes > limit:
                yield pa.concat_batches(held), [x.num_rows for x in held]
                held, size = [], 0
            held.append(piece)
            size += piece.nbytes
    if held:
        yield pa.concat_batches(held), [x.num_rows for x in held]


def _pack(path: str, end: int, capacity: int, window: int, linear: float, quadratic: float, with_ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end], "<u4")
        (table, finer), schema = _word_ids(path), _schema(with_ids)
        number = TaskContext.get().partitionId() << 33
        docs: list[tuple[object, np.ndarray]] = []
        pieces: list[Piece] = []
        held = 0

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            out = []
            for sequence in sequences:
                offset = 0
                for doc, start, length in sequence:
                    name, ids = docs[doc]
                    part = ids[start:start + length]
                    row = (name, start, length, zlib.crc32(part), len(ids), number, offset)
                    out.append((*row, part.tolist()) if with_ids else row)
                    offset += length
                number += 1
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

        for joined, counts in _gathered(batches, 1 << 22):
            packed, edges = table(*words(*utf8(joined.column("text")), finer))
            ids = packed.view("<u4")
            found = zip(joined.column("doc_id").to_pylist(), (edges[:-1] // 4).tolist(), (edges[1:] // 4).tolist())
            for count in counts:
                for name, a, b in itertools.islice(found, count):
                    whole = np.concatenate([ids[a:b], tail])
                    pieces.append((len(docs), 0, len(whole)))
                    docs.append((name, whole))
                    held += len(whole)
                if held >= window:
                    done, pieces = fill(pieces, capacity, linear, quadratic)
                    yield rows(done)
                    used = sorted({p[0] for p in pieces})
                    place = {d: i for i, d in enumerate(used)}
                    docs = [docs[d] for d in used]
                    pieces = [(place[d], s, n) for d, s, n in pieces]
                    held = sum(p[2] for p in pieces)
        done, pieces = fill(pieces, capacity, linear, quadratic)
        yield rows(done + powers_of_two(pieces))
    return run


def _schema(with_ids: bool) -> pa.Schema:
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return pa.schema([*((n, pa.int64()) for n in names), *([("ids", pa.list_(pa.int64()))] if with_ids else [])])


def pack(docs: DataFrame, path: str, end: int = 2, capacity: int = 4096, window: int = 1 << 20,
         linear: float = 1.0, quadratic: float = 1 / 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``capacity`` tokens.

    ``path`` is a tokenizer file whose words are split at white space; each document's ids are
    followed by ``end``. Returns ``doc_id``, ``start`` (ids of the document before the piece),
    ``length``, ``ids_crc32`` (of little-endian 32-bit ids), ``doc_tokens``, ``sequence_id``,
    ``offset`` (place in the sequence) and, with ``with_ids``, ``ids``. Each id lies in one piece.

    Null text counts as empty: the end id alone. Rows with a null or repeated ``doc_id`` are packed as documents of their
    own; other columns are ignored; an empty table gives an empty result. Sequences are numbered by
    task, so the numbers are unique but not consecutive.
    """
    result = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<long>" * with_ids
    return narrowed(docs).mapInArrow(_pack(path, end, capacity, window, linear, quadratic, with_ids), result)
