"""Merge-type SentencePiece vocabularies: encoding by an agenda of symbol pairs, and decoding.

A text becomes its characters, spaces as U+2581. All adjacent pairs whose join is a piece wait on an
agenda ordered by score, then place; the best is merged and its new neighbours join the agenda, until
it is empty. Characters that are no piece become byte pieces.

No piece of such a vocabulary has U+2581 after another character, which is checked on loading, so no merge
crosses the start of a run of spaces: each distinct run-and-word is encoded once in a task. Every
freshly encoded unit is checked against the sentencepiece library, batch by batch, and a difference
raises an error.
"""

import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import narrowed, slices, utf8
from ledgerloom.llm.units import UnitTable, cut_at, strings

SPACE = "▁"


class MergeVocabulary:
    """Pieces, scores and byte pieces of a model file, with the library's processor for checks."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as layout

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = layout.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, layout.ModelProto.SentencePiece
        if model.trainer_spec.model_type != layout.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a merge-type vocabulary with byte pieces is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("a vocabulary without normalization is needed")
        self.ids, self.rank, self.bytes = {}, {}, {}
        for i, piece in enumerate(model.pieces):
            if piece.type == kinds.BYTE:
                self.bytes[int(piece.piece[3:5], 16)] = i
            elif piece.type == kinds.NORMAL:
                self.ids[piece.piece] = i
                self.rank[piece.piece] = -piece.score
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that cross word starts")
        self.end = self.library.eos_id()
        decimals = [f"{i} ".encode() for i in range(len(model.pieces))]
        self.decimals = pa.array(decimals, pa.large_binary())

    def encode(self, symbols: str) -> list[int]:
        """Ids of a text whose spaces are U+2581 already."""
        parts, rank = list(symbols), self.rank
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(rank[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in rank]
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = after[i] if parts[i] else n
            if j >= n or parts[i] + parts[j] != piece:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = piece, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := piece + parts[k]) in rank:
                    heapq.heappush(agenda, (rank[p], i, p))
            if (k := before[i]) >= 0 and (p := parts[k] + piece) in rank:
                heapq.heappush(agenda, (rank[p], k, p))
        found = []
        for part in parts:
            if part:
                known = self.ids.get(part)
                if known is not None:
                    found.append(known)
                else:
                    found += [self.bytes[b] for b in part.encode()]
        return found


@functools.cache
def vocabulary(path: str) -> MergeVocabulary:
    return MergeVocabulary(path)


def encoded_units(known: MergeVocabulary):
    """Ids of units as packed 32-bit numbers, each batch checked against the library.

    A unit that starts with a space stands for itself; the library would put a space before it, so
    the check gives it the text after that space.
    """
    def resolve(units: list[str]) -> list[bytes]:
        ids = [known.encode(u.replace(" ", SPACE)) for u in units]
        checked = known.library.encode([u[1:] for u in units], num_threads=1)
        for unit, own, theirs in zip(units, ids, checked):
            if own != theirs and unit != " ":  # the library drops a text that is empty without its first space
                raise ValueError(f"the agenda and the sentencepiece library disagree on {unit[:80]!r}")
        return [np.array(x, np.uint32).tobytes() for x in ids]
    return resolve


@functools.cache
def unit_table(path: str) -> UnitTable:
    """Ids of units, kept for all tasks of a process."""
    return UnitTable(encoded_units(vocabulary(path)))


def prefixed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space put before each that is not empty."""
    filled = np.diff(offsets) > 0
    added = np.concatenate(([0], np.cumsum(filled)))
    out = np.full(len(data) + int(filled.sum()), 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    keep[(offsets + added)[:-1][filled]] = False
    out[keep] = data
    return out, offsets + added


def _run(path: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        table = unit_table(path)
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = prefixed(*utf8(piece.column("text")))
                space = data == 0x20
                # U+2581 itself counts as a space; rows that hold it are encoded as one unit
                marked = np.zeros(len(data), np.int64)
                if len(data) > 2:
                    marked[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
                literal = np.diff(np.concatenate(([0], np.cumsum(marked)))[offsets]) > 0
                space[1:] &= data[:-1] != 0x20
                starts = np.flatnonzero(space)
                starts = starts[~literal[np.searchsorted(offsets, starts, "right") - 1]]
                held, edges = table(*cut_at(starts, data, offsets))
                ids, edges = held.view(np.uint32), edges // 4
                decimal = known.decimals.take(pa.array(ids))
                places = np.frombuffer(decimal.buffers()[1], np.int64)[decimal.offset:decimal.offset + len(decimal) + 1] if len(ids) else np.zeros(1, np.int64)
                raw = memoryview(decimal.buffers()[2] or b"") if len(ids) else memoryview(b"")
                lists = [ids[a:b].tolist() + [known.end] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                decoded = known.library.decode(lists, num_threads=1)
                tail = str(known.end).encode()
                hashes = []
                for a, b in zip(places[edges[:-1]].tolist(), places[edges[1:]].tolist()):
                    digest = hashlib.sha256(raw[a:b])
                    digest.update(tail)
                    hashes.append(digest.hexdigest())
                columns = [piece.column("doc_id"), pa.array(np.diff(edges) + 1), pa.array(hashes, pa.string()),
                           pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if texts:
                    columns += [pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_decode(docs: DataFrame, path: str, texts: bool = False) -> DataFrame:
    """Each text's ids with an end id, and the text that they decode to, as counts and hashes.

    Columns: ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space),
    ``decoded_sha256`` and, with ``texts``, ``ids`` and ``decoded``. ``path`` is a merge-type model
    file readable on every executor. Null text counts as empty: the end id alone. Every row gives one row, whatever its
    ``doc_id``; other columns are ignored; an empty table gives an empty result.
    """
    result = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * texts
    return narrowed(docs).mapInArrow(_run(path, texts), result)


__all__ = ["MergeVocabulary", "encode_decode", "prefixed", "strings", "vocabulary"]
