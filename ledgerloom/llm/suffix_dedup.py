"""Exact repeated byte strings across a corpus, found with enhanced suffix arrays.

A string of ``length`` bytes is found through its anchor: the 32-byte gram with the least hash among
its grams. Equal strings have equal anchors, so the suffix array need not be one for the corpus: each
group of anchors with the same gram gets its own, over the bytes around them. The steps:

1. Tasks hash the grams of their documents and send gram, a hash of the bytes around the anchor
   (its context: all strings that contain it) and the place. A task sends equal contexts once, with
   the first place; the later places are spans to remove at once.
2. For each gram, later places of equal contexts are spans to remove. Grams with several different
   contexts ask for the first one of each.
3. Documents hand out the contexts asked for.
4. For each gram a suffix array of those contexts is sorted, its common-prefix interval tree is
   walked with a stack, and groups of repeats that cannot be extended to the left are read off with
   all their occurrences. Every occurrence but the first gives a span.
5. Documents drop their spans.

Documents are dealt by hash of ``doc_id``, grams by their hash; exact copies travel as one place for each task, so
a hot group does not meet in one task with all its rows. Contexts that differ do meet, at 168 bytes
each; a gram with more than 2,000 of them (a common line, say) is split by twice as many bytes, those
that its strings hold on the side where they reach further, so only contexts that share those meet.
Where more than 2,000 share those too, their strings are told apart by hash. A task sends a string once, with
its first place, and joins the later places to spans at once; first places of one string meet in one bucket,
as many as tasks hold it, and no join multiplies them.
Marks leave tasks and groups undealt, in few rows; they are dealt to documents in two steps, so their rows grow with tasks
times eighths of buckets at most and not with buckets times buckets.
Equality of contexts and strings is decided by 64-bit hashes within a gram and by bytes in step 4.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    Scatter, any_bucket, bucket_count, gathered, group_starts, mix, narrowed, prefix_sums, ragged, range_hash, slices, tidy, utf8,
)
from ledgerloom.llm.keys import distinct_ids
from ledgerloom.sources.workspace import Workspace

GRAM = 32
_PLACE_BITS = 21
_SEGMENT = 1 << 20
_ANCHOR = {"gram": np.uint32, "context": np.uint64, "doc": np.int64, "pos": np.int32, "left": np.int16, "size": np.int16}
_MARK = {"doc": np.int64, "pos": np.int32, "size": np.int32, "left": np.int16, "asks": np.int64, "hot": np.int8}
_STRING = {"key": np.uint64, "doc": np.int64, "pos": np.int32}
_CONTEXT = {"asks": np.int64, "doc": np.int64, "pos": np.int32, "size": np.int16, "left": np.int16, "content": np.uint8}


def _bucket_of(docs: np.ndarray) -> np.ndarray:
    return mix(docs.astype(np.uint64))


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of ``length`` bytes inside the rows that ``bounds`` separate.

    Returns row, place in ``data``, gram hash, context hash, start and end of the context.
    """
    n, reach = len(data) - length + 1, length - GRAM
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if n <= 0:
        return none
    sums = prefix_sums(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = range_hash(sums, places, places + GRAM)
    least = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | places.astype(np.uint64)
    span = 1
    while span * 2 <= reach + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = reach + 1 - span
    least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
    row_of = np.searchsorted(bounds, np.arange(n), "right") - 1
    inside = np.arange(n) + length <= bounds[row_of + 1]
    chosen = (least[:n][inside] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    if not len(chosen):
        return none
    at = chosen[group_starts(chosen)]
    row = np.searchsorted(bounds, at, "right") - 1
    lo, hi = np.maximum(bounds[row], at - reach), np.minimum(bounds[row + 1], at + length)
    context = mix(range_hash(sums, lo, hi) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return row, at, grams[at], context, lo, hi


def _segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of rows up to a segment's size (first row, row after, start, end); a longer row is cut
    into overlapping segments that leave no string out."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + _SEGMENT, "right")) - 1)
        lo, hi = int(offsets[start]), int(offsets[end])
        while hi - lo > _SEGMENT:
            yield start, end, lo, lo + _SEGMENT
            lo += _SEGMENT - 2 * length
        yield start, end, lo, hi
        start = end


def _first_of_equal(gram, context, doc, pos):
    """Order by gram, context, place, and where a new (gram, context) starts."""
    order = np.lexsort((pos, doc, context, gram))
    return order, group_starts(gram[order], context[order])


def _later(doc: np.ndarray, pos: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of sorted groups that stand at another place than the first of their group."""
    first = np.repeat(starts, np.diff(np.append(starts, len(doc))))
    return (doc != doc[first]) | (pos != pos[first])


class _Marks:
    """Marks that a task or a group has made, handed out as few rows of packed columns, not dealt yet."""

    def __init__(self):
        self.parts: list[list[np.ndarray]] = []

    def add(self, *arrays: np.ndarray) -> None:
        if len(arrays[0]):
            self.parts.append([np.asarray(a).astype(t, copy=False) for a, t in zip(arrays, _MARK.values())])

    def flush(self, buckets: int) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*self.parts)]
        self.parts = []
        for a in range(0, len(columns[0]) if columns else 0, 1 << 18):
            piece = [c[a:a + (1 << 18)] for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([any_bucket(piece[0], buckets)], pa.int32()),
                                              *(pa.array([c.tobytes()], pa.binary()) for c in piece)], _NAMES)

    def table(self, buckets: int) -> pa.Table:
        empty = pa.RecordBatch.from_arrays([pa.nulls(0, pa.int32())] * 2 + [pa.nulls(0, pa.binary())] * 6, _NAMES)
        return pa.Table.from_batches(list(self.flush(buckets)) or [empty])


def _dealt(buckets: int, together: int):
    """Packed marks dealt by document, ``together`` neighbouring buckets as one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Scatter(-(-buckets // together), _MARK)
        for batch in batches:
            for cells in zip(*(batch.column(name).to_pylist() for name in _NAMES[2:])):
                columns = [np.frombuffer(x, t) for x, t in zip(cells, _MARK.values())]
                bucket = (_bucket_of(columns[0]) >> np.uint64(32)) % np.uint64(buckets)
                sent.add(bucket // np.uint64(together) << np.uint64(32), *columns)
                if sent.full:
                    yield from (_tagged(1, b) for b in sent.flush())
        yield from (_tagged(1, b) for b in sent.flush())
    return run


def _by_document(found: DataFrame, buckets: int) -> DataFrame:
    """Marks of groups by the bucket of their document.

    Dealt by each group, most of them would lie alone in a row, as there are as many buckets as groups. So each task
    deals those of all its groups over runs of eight buckets, and the task that gets such a run deals it over its buckets.
    """
    return found.mapInArrow(_dealt(buckets, 8), _PACKED).repartition("bucket").mapInArrow(_dealt(buckets, 1), _PACKED)


def _find_anchors(length: int, buckets: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, marks, held = Scatter(buckets, _ANCHOR), _Marks(), []

        def settle():
            if not held:
                return
            gram, context, doc, pos, left, size = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order, starts = _first_of_equal(gram, context, doc, pos)
            gram, context, doc, pos, left, size = (x[order] for x in (gram, context, doc, pos, left, size))
            sent.add(gram[starts], (gram[starts] & np.uint64(0xFFFFFFFF)), *(x[starts] for x in (context, doc, pos, left, size)))
            later = _later(doc, pos, starts)
            marks.add(doc[later], (pos - left)[later], size[later], left[later], np.full(int(later.sum()), -1), np.zeros(int(later.sum())))
            yield from (_tagged(0, out) for out in sent.flush())
            yield from marks.flush(buckets)

        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = utf8(piece.column("text"))
                ids = np.asarray(piece.column("doc_id"))
                for first, after, lo, hi in _segments(offsets, length):
                    bounds = np.clip(offsets[first:after + 1], lo, hi) - lo
                    row, at, gram, context, start, end = anchors(data[lo:hi], bounds, length)
                    place = lo + at - offsets[first + row]
                    held.append((gram, context, ids[first + row], place.astype(np.int32), (at - start).astype(np.int16), (end - start).astype(np.int16)))
                if sum(len(x[0]) for x in held) >= 1 << 18:
                    yield from settle()
        yield from settle()
    return run


_NAMES = ["kind", "bucket", *(f"c{i}" for i in range(6))]
_PACKED = "kind int, bucket int, " + ", ".join(f"{c} binary" for c in _NAMES[2:])


def _tagged(kind: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    columns = [batch.column(i) for i in range(1, batch.num_columns)]
    columns += [pa.nulls(batch.num_rows, pa.binary())] * (6 - len(columns))
    return pa.RecordBatch.from_arrays([pa.array([kind] * batch.num_rows, pa.int32()), batch.column(0), *columns], _NAMES)


def _unpacked(table: pa.Table, columns: dict[str, type]) -> list[np.ndarray]:
    return gathered(table.rename_columns(["kind", "bucket", *columns, *(f"_{i}" for i in range(6 - len(columns)))]), columns)


def _compare_contexts(split: int, buckets: int):
    """Step 2, on the anchors of one bucket; marks that tasks made already pass through."""
    def run(table: pa.Table) -> pa.Table:
        kinds, marks = np.asarray(table["kind"]), _Marks()
        marks.add(*_unpacked(table.filter(pa.array(kinds == 1)), _MARK))
        gram, context, doc, pos, left, size = _unpacked(table.filter(pa.array(kinds == 0)), _ANCHOR)
        if len(gram):
            bucket = table["bucket"][0].as_py()
            order, starts = _first_of_equal(gram, context, doc, pos)
            gram, context, doc, pos, left, size = (x[order] for x in (gram, context, doc, pos, left, size))
            later = _later(doc, pos, starts)
            groups = group_starts(gram[starts])
            sizes = np.diff(np.append(groups, len(starts)))
            contexts = np.repeat(sizes, sizes)
            asked = starts[contexts > 1]
            asks = (np.int64(bucket) << np.int64(32)) | gram[asked].astype(np.int64)
            marks.add(doc[later], (pos - left)[later], size[later], left[later], np.full(int(later.sum()), -1), np.zeros(int(later.sum())))
            marks.add(doc[asked], (pos - left)[asked], size[asked], left[asked], asks, (contexts > split)[contexts > 1])
        return marks.table(buckets)
    return run


def _by_doc(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of marks by document, and where the marks of each of ``ids`` start and end."""
    order = np.argsort(doc, kind="stable")
    return order, np.searchsorted(doc[order], ids, "left"), np.searchsorted(doc[order], ids, "right")


def _narrowed_contexts(data, start, left, size, asks, length, buckets, side):
    """Contexts of a hot gram narrowed to the strings that start far before it (side 0) or not (side
    1), grouped by the bytes that all those strings hold: twice as many as the gram has.

    Returns which contexts hold such strings, how far their starts move, their sizes and new groups.
    """
    half = (length - GRAM) // 2
    anchor, end = start + left, start + size
    if side == 0:  # strings that start at half + 1 bytes before the gram or earlier
        core, core_end = anchor - half - 1, anchor + GRAM
        low, high = start, np.minimum(end, anchor - half - 1 + length)
    else:
        core, core_end = anchor, anchor - half + length
        low, high = np.maximum(start, anchor - half), end
    fits = np.flatnonzero((core >= low) & (core_end <= high))
    core, width = core[fits], int((core_end - core)[0]) if len(core) else 0
    held = data[ragged(core, np.full(len(core), width))]
    edges = np.arange(len(core)) * width
    key = mix(range_hash(prefix_sums(held), edges, edges + width) + mix(asks[fits].astype(np.uint64) * np.uint64(2) + np.uint64(side)))
    bucket = (key >> np.uint64(32)) % np.uint64(buckets)
    group = (bucket << np.uint64(32) | key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return fits, (low - start)[fits], (high - low)[fits], group


def _hand_out(length: int, buckets: int):
    """Step 3: the bytes of the contexts asked for, from the documents of one bucket."""
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        doc, pos, size, left, asks, hot = _unpacked(table, _MARK)
        wanted = asks >= 0
        doc, pos, size, left, asks = doc[wanted], pos[wanted], size[wanted], left[wanted], asks[wanted]
        hot = hot[wanted] > 0
        out = []
        if len(doc) and docs.num_rows:
            data, offsets = utf8(docs["text"])
            ids = np.asarray(docs["doc_id"])
            by_id = np.argsort(ids, kind="stable")
            row = by_id[np.searchsorted(ids[by_id], doc)]
            start = offsets[row] + pos
            if hot.any():
                halves = [_narrowed_contexts(data, start[hot], left[hot], size[hot], asks[hot], length, buckets, side) for side in (0, 1)]
                picked = [np.flatnonzero(~hot), *(np.flatnonzero(hot)[h[0]] for h in halves)]
                shift = np.concatenate([np.zeros(len(picked[0]), np.int64), *(h[1] for h in halves)])
                size = np.concatenate([size[~hot], *(h[2] for h in halves)])
                asks = np.concatenate([asks[~hot], *(h[3] for h in halves)])
                picked = np.concatenate(picked)
                start, doc, pos, left = start[picked] + shift, doc[picked], pos[picked] + shift, left[picked] - shift
            target = (asks >> np.int64(32)).astype(np.int64)
            order = np.lexsort((pos, doc, asks))
            cuts = np.append(group_starts(target[order]), len(order))
            for a, b in zip(cuts[:-1], cuts[1:]):
                k = order[a:b]
                content = data[ragged(start[k], size[k].astype(np.int64))]
                out.append({"bucket": int(target[k[0]]), "asks": asks[k].tobytes(), "doc": doc[k].tobytes(), "pos": pos[k].astype(np.int32).tobytes(),
                            "size": size[k].astype(np.int16).tobytes(), "left": left[k].astype(np.int16).tobytes(), "content": content.tobytes()})
        return pa.Table.from_pylist(out, pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in _CONTEXT)]))
    return run


def interval_tree(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """Intervals of a suffix array whose suffixes share ``least`` bytes or more, children first.

    ``lcp[i]`` is the common prefix of suffixes ``i`` and ``i + 1``. Yields the shared length, first
    and last suffix, and where the interval's children start.
    """
    stack: list[tuple[int, int, list[int]]] = []
    for i, shared in enumerate([*lcp.tolist(), 0]):
        shared = shared if shared >= least else 0
        start = i
        while stack and stack[-1][0] > shared:
            depth, start, parts = stack.pop()
            yield depth, start, i, parts
        if shared:
            if stack and stack[-1][0] == shared:
                stack[-1][2].append(i + 1)
            else:
                stack.append((shared, start, [start, i + 1]))


def maximal_repeats(group: np.ndarray, place: np.ndarray, content: np.ndarray, sums: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                    first: np.ndarray, last: np.ndarray, length: int):
    """Repeats of ``length`` bytes or more among the contexts of each group.

    ``place`` orders the contexts' first bytes in the corpus; suffixes start at the offsets from
    ``first`` up to ``last`` in each context. Yields (shared length, occurrences,
    children): occurrences are places of all suffixes of the interval, in suffix order. Only
    intervals whose occurrences differ in the byte before them, or stand at a context's edge, are
    yielded: the others are part of a longer repeat. Suffixes that every occurrence extends to the
    left alike are left out before sorting, as they start no such repeat.
    """
    counts = np.maximum(last - first, 0)
    at, owner = ragged(starts + first, counts), np.repeat(np.arange(len(starts)), counts)
    if not len(at):
        return
    where = place[owner] + (at - starts[owner])
    window = mix(range_hash(sums, at, at + length) + group[owner].astype(np.uint64))
    order = np.argsort(window, kind="stable")
    cuts = group_starts(window[order])
    which = np.empty(len(at), np.int64)
    which[order] = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(at))))
    number = np.diff(np.append(cuts, len(at)))
    here = np.add.reduceat(mix(where[order].astype(np.uint64)), cuts)
    nexts = np.add.reduceat(mix((where[order] + 1).astype(np.uint64)), cuts)
    again = number[which] > 1
    inner = np.zeros(len(at), bool)
    inner[1:] = (owner[1:] == owner[:-1]) & (number[which[1:]] == number[which[:-1]]) & (here[which[1:]] == nexts[which[:-1]])
    kept = np.flatnonzero(again & ~inner)
    if not len(kept):
        return
    at, owner, where = at[kept], owner[kept], where[kept]
    left = np.where(at > starts[owner], content[np.maximum(at - 1, 0)].astype(np.int64), -1 - np.arange(len(at)))
    room = (starts + sizes)[owner] - at
    wide = int(room.max())
    rows = np.zeros((len(at), wide + 8), np.uint8)
    rows[:, :8] = group[owner].astype(">u8").view(np.uint8).reshape(-1, 8)
    flat = ragged(at, room)
    rows[np.repeat(np.arange(len(at)), room), 8 + flat - np.repeat(at, room)] = content[flat]
    order = np.argsort(rows.view(f"S{wide + 8}").ravel(), kind="stable")
    rows, where, left, room = rows[order], where[order], left[order], room[order]
    differ = rows[1:] != rows[:-1]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), wide + 8) - 8
    lcp = np.maximum(np.minimum(np.minimum(same, room[1:]), room[:-1]), 0)
    for depth, first, last, parts in interval_tree(lcp, length):
        if (left[first:last + 1] != left[first]).any():
            yield depth, where[first:last + 1], [p - first for p in parts]


def _whole_groups(groups: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole groups of sorted rows, of ``most`` rows or, if that is more, one group."""
    cuts, start = np.append(group_starts(groups), len(groups)), 0
    while start < len(groups):
        end = int(cuts[max(np.searchsorted(cuts, start + most, "right") - 1, np.searchsorted(cuts, start, "right"))])
        yield start, end
        start = end


def _suffix_arrays(length: int, buckets: int):
    """Step 4, on the contexts of one bucket."""
    def run(table: pa.Table) -> pa.Table:
        asks, doc, pos, size, left, content = gathered(table, _CONTEXT)
        size, left = size.astype(np.int64), left.astype(np.int64)
        starts = np.cumsum(size) - size
        order = np.argsort(asks, kind="stable")
        marks = _Marks()
        for a, b in _whole_groups(asks[order], 1 << 13):
            k = order[a:b]
            ids, rank = np.unique(doc[k], return_inverse=True)
            place = (rank.astype(np.int64) << np.int64(32)) | pos[k].astype(np.int64)
            longest: dict[int, int] = {}
            part, edges = content[ragged(starts[k], size[k])], np.cumsum(size[k]) - size[k]
            # equal strings stand alike around their anchor, so a large group is done in several
            # ranges of offsets from the anchor
            sums, step = prefix_sums(part), max(1, (1 << 18) // len(k))
            for low in range(0, length - GRAM + 1, step):
                offset = left[k] - low
                first, last = np.maximum(offset - step + 1, 0), np.minimum(offset, size[k] - length) + 1
                for depth, occurrences, children in maximal_repeats(asks[k], place, part, sums, edges, size[k], first, last, length):
                    # the first place of each child may still be the first of the whole; all others
                    # have got the child's longer span already
                    least = np.minimum.reduceat(occurrences, children)
                    earliest = least.min()
                    for p in least[least != earliest].tolist():
                        if longest.get(p, 0) < depth:
                            longest[p] = depth
            if longest:
                found = np.fromiter(longest, np.int64, len(longest))
                docs = ids[found >> np.int64(32)]
                marks.add(docs, found & np.int64(0xFFFFFFFF), np.fromiter(longest.values(), np.int64, len(longest)),
                          np.zeros(len(found)), np.full(len(found), -1), np.zeros(len(found)))
        return marks.table(buckets)
    return run


def _group_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cell in batch.column("asks").to_pylist():
            asks, n = np.unique(np.frombuffer(cell, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(asks), pa.array(n)], ["asks", "n"])


def _picked(batches: Iterator[pa.RecordBatch], large: np.ndarray, inside: bool) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Bucket and contexts of each packed row: those of the ``large`` groups (sorted) or the others."""
    for batch in batches:
        for bucket, *cells in zip(*(batch.column(c).to_pylist() for c in ("bucket", *_CONTEXT))):
            *columns, content = (np.frombuffer(x, t) for x, t in zip(cells, _CONTEXT.values()))
            asks, size = columns[0], columns[3].astype(np.int64)
            wanted = (large[np.minimum(np.searchsorted(large, asks), len(large) - 1)] == asks) == inside
            if wanted.any():
                yield bucket, [*(c[wanted] for c in columns), content[ragged((np.cumsum(size) - size)[wanted], size[wanted])]]


def _contexts_of(large: np.ndarray, inside: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, columns in _picked(batches, large, inside):
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], ["bucket", *_CONTEXT])
    return run


def _merged(doc: np.ndarray, pos: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and size of the spans that strings of ``length`` bytes cover together."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order].astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] - pos[:-1] > length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], pos[first], pos[last] + length - pos[first]


def _fold_strings(key, doc, pos, length: int, marks: _Marks):
    """First place of each string, in order of its hash; spans of the later places go to ``marks``."""
    order = np.lexsort((pos, doc, key))
    key, doc, pos = key[order], doc[order], pos[order]
    starts = group_starts(key)
    later = _later(doc, pos, starts)
    if later.any():
        where, start, size = _merged(doc[later], pos[later], length)
        none = np.zeros(len(where))
        marks.add(where, start, size, none, none - 1, none)
    return key[starts], doc[starts], pos[starts]


def _strings(length: int, large: np.ndarray, buckets: int):
    """Hash and first place of the strings of large groups' contexts, once for each task and its first million strings
    (and so on); spans of the later places."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, marks, held = Scatter(buckets, _STRING), _Marks(), []

        def settle():
            if not held:
                return
            key, *place = _fold_strings(*(np.concatenate(x) for x in zip(*held)), length, marks)
            held.clear()
            sent.add(key, key, *place)
            yield from (_tagged(0, out) for out in sent.flush())
            yield from marks.flush(buckets)

        for _, whole in _picked(batches, large, True):
            *columns, content = whole
            edges = np.cumsum(columns[3], dtype=np.int64) - columns[3]
            for a in range(0, len(edges), 1 << 12):
                asks, doc, pos, size, _ = (c[a:a + (1 << 12)] for c in columns)
                begin, number = edges[a:a + (1 << 12)], np.maximum(size.astype(np.int64) - length + 1, 0)
                low = int(begin[0])
                at, owner = ragged(begin - low, number), np.repeat(np.arange(len(asks)), number)
                key = mix(range_hash(prefix_sums(content[low:int(begin[-1]) + int(size[-1])]), at, at + length) + asks[owner].astype(np.uint64))
                held.append((key, doc[owner], pos[owner] + at - (begin - low)[owner]))
                if sum(len(x[0]) for x in held) >= 1 << 20:
                    yield from settle()
        yield from settle()
    return run


def _compare_strings(length: int, buckets: int):
    """Spans of the later places of the strings of one bucket; those that tasks found already pass through."""
    def run(table: pa.Table) -> pa.Table:
        kinds, marks = np.asarray(table["kind"]), _Marks()
        marks.add(*_unpacked(table.filter(pa.array(kinds == 1)), _MARK))
        _fold_strings(*_unpacked(table.filter(pa.array(kinds == 0)), _STRING), length, marks)
        return marks.table(buckets)
    return run


def _spans_of_contexts(contexts: DataFrame, length: int, buckets: int, split: int) -> DataFrame:
    """Step 4: marks of all repeats among the contexts of each group, groups above ``split`` string by string.

    The driver holds 8 bytes for each such group, so for every ``split`` contexts at most.
    """
    sizes = contexts.mapInArrow(_group_sizes, "asks long, n long").groupBy("asks").agg(F.sum("n").alias("n"))
    large = np.sort(np.array([r.asks for r in sizes.where(F.col("n") > split).select("asks").collect()], np.int64))
    if not len(large):
        return contexts.groupBy("bucket").applyInArrow(_suffix_arrays(length, buckets), _PACKED)
    others = contexts.mapInArrow(_contexts_of(large, False), Scatter.schema(_CONTEXT)).groupBy("bucket").applyInArrow(_suffix_arrays(length, buckets), _PACKED)
    strings = contexts.mapInArrow(_strings(length, large, buckets), _PACKED)
    return others.unionByName(strings.groupBy("bucket").applyInArrow(_compare_strings(length, buckets), _PACKED))


def kept_ranges(size: int, starts: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[int, int]], int, int]:
    """Byte ranges outside all spans, bytes inside them, and the number of maximal runs of those."""
    kept, at, removed, runs = [], 0, 0, 0
    if len(starts):
        order = np.argsort(starts, kind="stable")
        starts, reach = starts[order], np.maximum.accumulate(ends[order])
        new = np.append(True, starts[1:] > reach[:-1])
        firsts = starts[new].tolist()
        lasts = reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)].tolist()
        for a, b in zip(firsts, lasts):
            if a > at:
                kept.append((at, a))
            removed, runs, at = removed + b - a, runs + 1, b
    if at < size:
        kept.append((at, size))
    return kept, removed, runs


def _cut_out(texts: bool):
    """Step 5, on the documents of one bucket."""
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        doc, pos, size, _, asks, _ = _unpacked(table, _MARK)
        span = asks < 0
        doc, pos, size = doc[span], pos[span].astype(np.int64), size[span].astype(np.int64)
        data, offsets = utf8(docs["text"])
        ids = np.asarray(docs["doc_id"])
        order, first, last = _by_doc(ids, doc)
        pos, end = pos[order], (pos + size)[order]
        raw, null = memoryview(data.tobytes()), docs["text"].is_null().to_pylist()
        out = {"doc_id": docs["own_id"], "n_bytes": np.diff(offsets), "n_removed": [], "n_spans": [], "kept_sha256": []}
        if texts:
            out["kept_text"] = []
        for i in range(len(ids)):
            a, b = int(offsets[i]), int(offsets[i + 1])
            ranges, removed, runs = kept_ranges(b - a, pos[first[i]:last[i]], end[first[i]:last[i]])
            kept = b"".join(raw[a + x:a + y] for x, y in ranges)
            out["n_removed"].append(removed)
            out["n_spans"].append(runs)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if texts:
                out["kept_text"].append(None if null[i] else kept.decode("utf-8", "ignore"))
        return pa.table(out, schema=_result(texts))
    return run


def _result(texts: bool) -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                      ("kept_sha256", pa.string()), *([("kept_text", pa.string())] if texts else [])])


def remove_repeats(docs: DataFrame, space: Workspace, length: int = 100, texts: bool = False, split: int = 2000) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts earlier.

    Earlier means in a document of smaller ``doc_id`` or before it in the same document; overlaps
    count, strings never cross documents, and all are judged on the input. Returns ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, with
    ``texts``, ``kept_text`` (a character that was cut in two is dropped there).

    Grams with more than ``split`` different contexts are split, and their parts again if they have more; that changes no result.

    Null text counts as empty and stays null in ``kept_text``; texts shorter than ``length`` are kept whole; an empty
    table gives an empty result. Rows with a null ``doc_id`` are left out. Of rows that share a ``doc_id`` the
    first by text counts under it, the others as documents after all others, in order of id and text; each has
    its own row in the result. Other columns are ignored.
    """
    if length < GRAM + 2:
        raise ValueError(f"length must be {GRAM + 2} or more")
    spark, docs = docs.sparkSession, distinct_ids(narrowed(docs).where("doc_id IS NOT NULL"), space, own="own_id")
    buckets = bucket_count(spark)
    sent = docs.select("doc_id", "text").mapInArrow(_find_anchors(length, buckets), _PACKED)
    marks = space.write(_by_document(sent.groupBy("bucket").applyInArrow(_compare_contexts(split, buckets), _PACKED), buckets), "marks")
    dealt = docs.mapInArrow(_with_bucket(buckets), "doc_id long, text string, own_id long, bucket int")
    contexts = space.write(dealt.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(_hand_out(length, buckets), Scatter.schema(_CONTEXT)), "contexts")
    spans = marks.unionByName(_by_document(_spans_of_contexts(contexts, length, buckets, split), buckets))
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * texts
    return dealt.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(_cut_out(texts), result)


def _with_bucket(buckets: int):
    """Each document with the bucket its marks go to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = (_bucket_of(np.asarray(batch.column("doc_id"))) >> np.uint64(32)) % np.uint64(buckets)
            yield batch.append_column("bucket", pa.array(bucket.astype(np.int32), pa.int32()))
    return run
