"""Token counts of byte-level BPE, exact for texts of any length.

A space between two characters that are no white space always starts a new piece of the split that
precedes the merges: no alternative of the pattern runs over such a space from the left, and none
looks back. So does a single line break between two such characters, on both of its sides. At such stable
boundaries a text may be cut without changing its tokens.

Documents over ``huge`` bytes are encoded in overlapping chunks with offsets. Two neighbours are
spliced at a stable boundary in their overlap where both have a token start. Overlaps reach back to two
such boundaries, and are doubled where the tokens do not meet there. Other documents are cut at all
their stable boundaries and each distinct unit is encoded once; those with other white space are
encoded whole.
"""

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import _SPACE, narrowed, slices, utf8
from ledgerloom.llm.units import UnitTable, cut_at, unit_ids

RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


@functools.cache
def tokenizer(path: str):
    """The tokenizer of a file, without truncation or padding; one for each process, on one core as a task is."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def _unit_sizes(path: str) -> UnitTable:
    """Token counts of units, kept for all tasks of a process. A line break is a piece of its own between units that hold none."""
    known = tokenizer(path)

    def sizes(units: list[str]) -> list[bytes]:
        plain = [u for u in units if "\n" not in u]
        found = dict(zip(plain, unit_ids(known, plain, "\n")))
        return [len(found[u]).to_bytes(4, "little") if u in found else (4 * len(known.encode(u, add_special_tokens=False))).to_bytes(4, "little") for u in units]

    return UnitTable(sizes)


# A space whose neighbours are no white space: cutting the text before it leaves all tokens as they are.
_STABLE = re.compile(r"(?<=\S) (?=\S)")


def chunked_count(encode, text: str, chunk: int = 1 << 14, overlap: int = 256) -> int:
    """Tokens of a text, from overlapping chunks of ``chunk`` characters or more.

    ``encode`` gives the offsets of a text's tokens. Tokens that start before the splice count from
    the left chunk, the others from the right one. The end of a chunk may cut a piece in two, which
    only touches tokens after its last stable boundary, so a splice lies at least one stable
    boundary before the end.

    Where a chunk ends, and how far the next one reaches back, follows from the stable boundaries, which are known before
    anything is encoded: each chunk brings two new ones, or the rest of the text. So a character lies
    in two chunks at most, however far apart the boundaries are. Should the tokens of two chunks not meet at them, the
    overlap doubles, and once it is the whole left chunk, that chunk doubles.
    """
    whole = len(text)
    marks = np.fromiter((m.start() for m in _STABLE.finditer(text)), np.int64)

    def reach(after: int, least: int) -> int:
        """The least end of a chunk, ``least`` or more, with two boundaries behind ``after`` well inside it."""
        second = np.searchsorted(marks, after, "right") + 1
        return whole if second >= len(marks) else min(whole, max(least, int(marks[second]) + 2))

    def token_starts(begin: int, end: int) -> np.ndarray:
        return begin + np.array([a for a, _ in encode(text[begin:end])], np.int64)

    total, start, width = 0, 0, overlap
    end = reach(0, chunk)
    left = token_starts(0, end)
    while end < whole:
        inside = int(np.searchsorted(marks, end - 1))
        begin = max(start, min(end - width, int(marks[inside - 2]) - 1))
        after = reach(end, end + chunk)
        right = token_starts(begin, after)
        places = marks[np.searchsorted(marks, begin, "right"):inside]
        places = places[np.isin(places, left) & np.isin(places, right)]
        if len(places) >= 2:
            splice = places[(len(places) - 1) // 2]
            total += int(np.count_nonzero(left < splice))
            left, start, end, width = right[right >= splice], begin, after, overlap
        elif begin > start:
            width *= 2
        else:
            end = reach(end, 2 * end - start)
            left, width = token_starts(start, end), overlap
    return total + len(left)


def regular(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows whose only white space are single spaces and line breaks inside the text."""
    n = len(offsets) - 1
    if not len(data):
        return np.ones(n, bool)
    space = _SPACE[data]
    odd = space & (data != 0x20) & (data != 0x0A)
    odd |= (data >= 0x1C) & (data <= 0x1F)
    odd[1:] |= space[1:] & space[:-1]
    b, c = data[:-1], data[1:]
    odd[:-1] |= (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    odd[:-1] |= ((b == 0xE1) & (c == 0x9A)) | ((b == 0xE2) & ((c == 0x80) | (c == 0x81))) | ((b == 0xE3) & (c == 0x80))
    filled = np.diff(offsets) > 0
    odd[offsets[:-1][filled]] |= space[offsets[:-1][filled]]
    odd[offsets[1:][filled] - 1] |= space[offsets[1:][filled] - 1]
    return np.diff(np.concatenate(([0], np.cumsum(odd)))[offsets]) == 0


def _count(path: str, limit: int, huge: int, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(path)

        def offsets_of(text: str) -> list[tuple[int, int]]:
            return known.encode(text, add_special_tokens=False).offsets

        table = _unit_sizes(path)
        for batch in batches:
            for piece in slices(batch, "text", 1 << 22):
                data, offsets = utf8(piece.column("text"))
                size = np.diff(offsets)
                plain = regular(data, offsets) & (size <= huge)
                line = np.flatnonzero(data == 0x0A)
                starts = np.concatenate([np.flatnonzero(data == 0x20), line, line[line + 1 < len(data)] + 1])
                of = np.searchsorted(offsets, starts, "right") - 1
                units, bounds = cut_at(starts[plain[of]], data, offsets)
                whole = np.flatnonzero(~plain)
                if len(whole):
                    units = _without(units, bounds, plain)
                    bounds = np.concatenate(([0], np.cumsum(np.where(plain, np.diff(bounds), 0))))
                held, edges = table(units, bounds)
                counts = np.concatenate(([0], np.cumsum(held.view(np.uint32).astype(np.int64))))
                counts = np.diff(counts[edges // 4]) // 4
                for i in whole.tolist():
                    text = data[offsets[i]:offsets[i + 1]].tobytes().decode()
                    counts[i] = chunked_count(offsets_of, text, chunk, overlap) if size[i] > huge else len(known.encode(text, add_special_tokens=False))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(size), pa.array(counts), pa.array(counts > limit)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def _without(units: pa.LargeStringArray, bounds: np.ndarray, keep: np.ndarray) -> pa.LargeStringArray:
    return units.filter(pa.array(np.repeat(keep, np.diff(bounds))))


def token_counts(docs: DataFrame, path: str, limit: int = 512, huge: int = 1 << 15, chunk: int = 1 << 14, overlap: int = 256) -> DataFrame:
    """UTF-8 bytes and tokens of each text by the byte-level BPE tokenizer in the file ``path``.

    Special strings inside texts are handled as the library does by default; no special token is
    added, nothing truncated or padded. ``over_limit`` tells whether there are more than ``limit`` tokens. Null text
    counts as empty: no bytes, no tokens. Every row gives one row, whatever its ``doc_id`` (null and
    repeated ones included); other columns are ignored; an empty table gives an empty result. The file must be
    readable on every executor.
    """
    if not 2 * overlap <= chunk <= huge:
        raise ValueError("2 * overlap <= chunk <= huge is required")
    return narrowed(docs).mapInArrow(_count(path, limit, huge, chunk, overlap), RESULT)
