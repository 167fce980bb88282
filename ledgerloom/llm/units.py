"""Texts cut into units that a tokenizer treats independently, each distinct unit tokenized once.

Where a tokenizer can join nothing across a boundary, the ids of a text are those of its units in
order. Units are cut in numpy and numbered by Arrow; a bounded table in each task keeps what the
units seen so far gave. Fresh units are encoded many to a text, with a mark between them.
"""

import itertools
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from ledgerloom.llm.common import _SPACE, utf8

#: ASCII punctuation but those that special tokens are written with.
_MARKS = b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = True
_MARK[list(_MARKS)] = True


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.LargeStringArray:
    """Text array over bytes that are cut at ``offsets``, without a copy of the bytes."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def cut_at(starts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Units that begin at ``starts`` and at each row's start, and where each row's units begin."""
    begin = np.zeros(len(data), bool)
    begin[starts] = True
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    begins = np.flatnonzero(begin)
    return strings(data, np.append(begins, len(data))), np.searchsorted(begins, offsets)


def words(data: np.ndarray, offsets: np.ndarray, finer: bool = False) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Runs of bytes other than ASCII white space, and where each row's runs begin.

    With ``finer`` a run is also cut between an ASCII letter and a mark of ``_MARKS`` that follows it, and
    between such a mark and a letter after it, but not after an apostrophe.
    """
    keep = ~_SPACE[data]
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    begin = keep.copy()
    begin[1:] &= ~keep[:-1]
    inner = offsets[:-1][np.diff(offsets) > 0]
    begin[inner] = keep[inner]
    if finer:
        letter, mark = _LETTER[data], _MARK[data]
        begin[1:] |= letter[:-1] & mark[1:] | mark[:-1] & letter[1:] & (data[:-1] != 0x27)
    starts = np.flatnonzero(begin)
    return strings(data[keep], np.append(kept_before[starts], kept_before[-1])), np.searchsorted(starts, offsets)


def cut_finer(known) -> bool:
    """Whether the tokenizer ``known`` itself cuts wherever ``words`` does with ``finer``.

    Its pieces must be contractions, runs of letters, single digits or runs of other marks, and what changes a text
    before that must not reach over two ASCII characters; no added token may be cut.
    """
    spec = json.loads(known.to_str())
    before, split = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    before, split = before.get("normalizers", [before] if before else []), split.get("pretokenizers", [split])[0]
    return all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} for x in before) \
        and split.get("pattern") == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"} and (split["behavior"], split["invert"]) == ("Removed", True) \
        and all(len(words(*utf8(pa.array([x["content"]])), finer=True)[0]) == 1 for x in spec["added_tokens"])


def unit_ids(known, units: list[str], mark: str, width: int = 256) -> list[bytes]:
    """Little-endian 32-bit ids of each unit by the tokenizer ``known``.

    ``mark`` holds what separates two units: nothing may join across it, and it gives one id of its own.
    A text where that id stands more often than marks do has it in a unit too, and is encoded unit by unit.
    """
    sign = known.encode(mark, add_special_tokens=False).ids
    if len(sign) != 1:
        width = 1
    groups = [units[i:i + width] for i in range(0, len(units), width)]
    out: list[bytes] = []
    for group, found in zip(groups, known.encode_batch_fast([mark.join(g) for g in groups], add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        if len(group) > 1:
            cuts = np.flatnonzero(ids == sign[0])
            if len(cuts) != len(group) - 1:
                out.extend(np.array(x.ids, "<u4").tobytes() for x in known.encode_batch_fast(group, add_special_tokens=False))
                continue
            held, cuts = ids.tobytes(), (4 * cuts).tolist()
            out.extend(held[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(held)]))
        else:
            out.append(ids.tobytes())
    return out


class UnitTable:
    """Packed results of units: ``resolve`` gives one bytes object for each of a list of units.

    At most ``most`` units are remembered, and only those of at most ``longest`` characters, which bounds the memory. They
    stand in two halves: when the newer is full, the older is forgotten, so units that come again and again stay.
    """

    def __init__(self, resolve: Callable[[list[str]], list[bytes]], most: int = 1_000_000, longest: int = 64):
        self.resolve, self.most, self.longest, self.known, self.older = resolve, most, longest, {}, {}

    def _remember(self, units: dict[str, bytes]) -> None:
        if len(self.known) + len(units) > self.most // 2:
            self.older, self.known = self.known, {}
        self.known.update(itertools.islice(units.items(), self.most // 2))

    def __call__(self, units: pa.LargeStringArray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Results of all units, joined, and where each row's results begin in them."""
        if not len(units):
            return np.empty(0, np.uint8), np.zeros(len(bounds), np.int64)
        numbered = units.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            fresh = [i for i in missing if distinct[i] not in self.older]
            results = dict(zip(fresh, self.resolve([distinct[i] for i in fresh])))
            for i in missing:
                found[i] = results[i] if i in results else self.older[distinct[i]]
            self._remember({distinct[i]: found[i] for i in missing if len(distinct[i]) <= self.longest})
        taken = pa.array(found, pa.large_binary()).take(numbered.indices)
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
        held = np.frombuffer(taken.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        return held, (offsets - offsets[0])[bounds]
