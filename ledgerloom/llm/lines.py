"""Counts and features of every line of every text, in numpy over whole batches."""

import numpy as np

from ledgerloom.llm.common import _SPACE, group_starts, prefix_sums, range_hash, window_hash, word_spans

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_CLASSES = (
    np.isin(np.arange(256), np.arange(97, 123)),  # small letters
    np.isin(np.arange(256), np.arange(65, 91)),  # capitals
    np.isin(np.arange(256), np.arange(48, 58)),  # digits
    np.isin(np.arange(256), np.frombuffer(b".,;:'\"?-()", np.uint8)),
    np.isin(np.arange(256), np.frombuffer(b"!", np.uint8)),
    _SYMBOLS,
    np.arange(256) >= 128,
)
WINDOW = 8
#: Features of a line by itself; a line also has those of its two neighbours.
OWN = len(_CLASSES) + 7
WIDTH = 3 * OWN + 1


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds])


def _repeated(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values stand twice or more in their row, and which of those are not the first."""
    order = np.lexsort((np.arange(len(value)), value, row))
    starts = group_starts(row[order], value[order])
    size = np.diff(np.append(starts, len(order)))
    again, later = np.zeros(len(value), bool), np.zeros(len(value), bool)
    again[order] = np.repeat(size > 1, size)
    second = np.ones(len(value), bool)
    second[starts] = False
    later[order] = second
    return again, later


def line_tables(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Per row: counts of words, their characters, symbols, repeated lines and repeated words, and
    where its lines begin. Per line: length in bytes and features (``WIDTH`` columns)."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    row_of_break = np.searchsorted(offsets, breaks, "right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(rows), row_of_break])
    order = np.argsort(owner, kind="stable")
    starts, owner = starts[order], owner[order]
    first_line = np.searchsorted(owner, np.arange(rows + 1))
    ends = np.append(starts[1:] - 1, len(data))
    last = first_line[1:] - 1
    ends[last] = offsets[1:]
    length = ends - starts

    word_start, word_end, first_word = word_spans(data, offsets)
    word_row = np.repeat(np.arange(rows), np.diff(first_word))
    sums = prefix_sums(data)
    word = range_hash(sums, word_start, word_end)
    word_line = np.searchsorted(np.where(length > 0, starts, starts), word_start, "right") - 1
    n_words = np.diff(first_word)
    line_words = np.bincount(word_line, minlength=len(starts))

    windows = window_hash(word, WINDOW)
    inside = word_row[:len(windows)] == word_row[WINDOW - 1:] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    again, _ = _repeated(word_row[at], windows[at])
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0

    _, word_later = _repeated(word_line, word)
    _, line_later = _repeated(owner, range_hash(sums, starts, ends))
    line_later &= line_words > 0

    own = np.zeros((len(starts), OWN), np.float32)
    size = np.maximum(length, 1)
    bounds = np.stack([starts, ends], 1)
    for i, kind in enumerate(_CLASSES):
        totals = np.concatenate(([0], np.cumsum(kind[data])))
        own[:, i] = (totals[bounds[:, 1]] - totals[bounds[:, 0]]) / size
    k, per = len(_CLASSES), np.maximum(line_words, 1)
    own[:, k] = np.log1p(length) / 8
    own[:, k + 1] = np.bincount(word_line, word_end - word_start, len(starts)) / per / 10
    own[:, k + 2] = np.bincount(word_line, word_later, len(starts)) / per
    own[:, k + 3] = np.bincount(word_line, covered, len(starts)) / per
    own[:, k + 4] = line_later
    own[:, k + 5] = line_words == 0
    own[:, k + 6] = np.minimum(line_words, 50) / 50
    features = np.zeros((len(starts), WIDTH), np.float32)
    features[:, :OWN] = own
    follows = owner[1:] == owner[:-1]
    features[1:, OWN:2 * OWN] = own[:-1] * follows[:, None]
    features[:-1, 2 * OWN:3 * OWN] = own[1:] * follows[:, None]
    features[:, -1] = 1
    space = _SPACE[data]
    return {
        "n_words": n_words, "word_chars": _sums(~space & ((data & 0xC0) != 0x80), offsets), "n_symbols": _sums(_SYMBOLS[data], offsets),
        "n_dup_lines": np.diff(np.concatenate(([0], np.cumsum(line_later)))[first_line]),
        "n_repeat_words": np.diff(np.concatenate(([0], np.cumsum(covered)))[first_word]),
        "first_line": first_line, "length": length, "features": features,
    }
