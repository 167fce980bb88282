"""Documents whose word shingles overlap enough, joined exactly through PartEnum signatures.

A document's set holds the hashes of its distinct runs of ``width`` words. Two sets of Jaccard
similarity ``t`` or more have at most ``k`` elements that only one of them holds, where ``k`` follows
from the sizes. So sizes are cut into bands, each with the ``k`` of its largest set, and in each band
the domain of elements is partitioned twice: into first-level parts, and each of those into two. If
every first-level part had a difference in both halves there would be more than ``k`` differences,
so similar sets agree in some subset that leaves one half out: they share the signature (band,
first-level part, half, content). A set signs in its own band and, if a larger partner may stand in
the next, there too. There are half as many parts again as that needs, so a set may leave out weak halves: it signs
those of ``c`` elements or more, for the largest ``c`` that leaves more halves than there can be
differences. Then some signed half has no difference, and the partner with the larger ``c`` decides
for both. Shingles that very many documents hold (a common line's) are left out of the halves: that
only takes differences away, so nothing is lost, and which ones are left out changes no result. A
set too uneven for any ``c`` also signs its rarest elements (prefix filter), which finds
the pairs of two such sets. No link is lost; the test against all pairs is in the tests.

Signatures are dealt by hash in packed columns. Copies of a set are folded in each task before that. Sets that share a
signature are compared with the least of them. Those still in different components after that meet
each other under a bound: for each set, which bins of the domain hold an odd number of its elements.
Two sets differ in at least as many elements as these bits differ, so pairs beyond the bound
cannot link and never leave the join.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    Scatter, any_bucket, bucket_count, gathered, group_starts, mix, narrowed, ragged, range_hash, prefix_sums, slices, tidy, utf8, window_hash, word_spans,
)
from ledgerloom.llm.components import components
from ledgerloom.sources.workspace import Workspace

_SIGNED = {"sig": np.uint32, "low": np.uint32, "high": np.int32}
_PACKED = "kind int, bucket int, c0 binary, c1 binary, c2 binary"
_SETS, _SIGNATURES, _PAIRS, _MEMBERS, _LINKS = range(5)
#: Sets that a task remembers to tell their copies without signatures.
SEEN = 200_000
#: Groups of up to so many members are compared each with each at once where neighbours are compared too.
WHOLE = 8
#: Bins whose parity bounds the difference of two sets from below, in words of 64 bits.
_PARITY = [f"parity{i}" for i in range(8)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, row after row, and the size of each set.

    A to Z count as a to z. A row of fewer than ``width`` words has one shingle, the whole of it.
    """
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = word_spans(data, offsets)
    words = range_hash(prefix_sums(data), starts, ends)
    runs = window_hash(words, width)
    sets, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    bounds = first.tolist()
    for i in range(len(sizes)):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= width:
            found = np.sort(runs[a:b - width + 1])
            found = found[group_starts(found)]
        elif b > a:
            found = window_hash(words[a:b], b - a) + np.uint64(b - a)
        else:
            continue
        sets.append(found)
        sizes[i] = len(found)
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), sizes


def _most_differing(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    """Largest symmetric difference of two sets of these sizes that are similar enough."""
    return (100 - percent) * (small + large) // (100 + percent)


def signatures(elements: np.ndarray, sizes: np.ndarray, percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature hashes of all sets and the row each belongs to; ``common`` elements (sorted) stand back."""
    rare = ~_among(elements, common)
    rows = np.arange(len(sizes))
    spread = mix(elements)
    found, owners = [], []
    uneven = np.zeros(len(sizes), bool)
    own = np.frexp(np.maximum(sizes, 1).astype(float))[1] - 1
    largest_partner = sizes * 100 // percent
    for step in (0, 1):
        band = own + step
        low, high = np.int64(1) << band, (np.int64(2) << band) - 1
        active = (sizes > 0) & (largest_partner >= low)
        if not active.any():
            continue
        k = _most_differing(high, high, percent)
        halves = np.where(active, 2 * (3 * (k + 1) // 4 + 1), 0)
        row = np.repeat(rows, np.where(active, sizes, 0))
        held = ragged((np.cumsum(sizes) - sizes)[active], sizes[active])
        base = np.cumsum(halves) - halves
        slot = base[row] + (spread[held] % halves[row].astype(np.uint64)).astype(np.int64)
        content = np.zeros(int(halves.sum()), np.uint64)
        signed = rare[held]
        slot = slot[signed]
        np.add.at(content, slot, mix(elements[held[signed]] + np.uint64(1)))
        held_by = np.bincount(slot, minlength=len(content))
        of = np.repeat(rows, halves)
        part = np.arange(len(content)) - base[of]
        differing = _most_differing(sizes, np.minimum(high, largest_partner), percent)
        weakest = np.zeros(len(sizes), np.int64)
        for c in range(1, 9):
            weakest[np.bincount(of[held_by >= c], minlength=len(sizes)) > differing] = c
        uneven |= active & (weakest == 0)
        full = held_by >= np.maximum(weakest, 1)[of]
        tag = mix((band[of] << 40 | part).astype(np.uint64))
        found.append(mix(content + tag)[full])
        owners.append(of[full])
    for i in np.flatnonzero(uneven):
        a = int(sizes[:i].sum())
        n = int(sizes[i])
        order = np.lexsort((elements[a:a + n], ~rare[a:a + n]))
        rarest = elements[a:a + n][order][:n - -(-n * percent // 100) + 1]
        found.append(mix(rarest ^ np.uint64(0x5851F42D4C957F2D)))
        owners.append(np.full(len(rarest), i))
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _among(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(values), bool)
    return found[np.minimum(np.searchsorted(found, values), len(found) - 1)] == values


def _often(width: int, share: float):
    """Shingles that a share of a task's documents hold, with their number, chunk by chunk."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs = [], 0

        def counted() -> pa.RecordBatch:
            values, number = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            most = number >= max(3, share * docs)
            return pa.RecordBatch.from_arrays([pa.array(values[most].view(np.int64)), pa.array(number[most])], ["shingle", "n"])

        for batch in batches:
            for piece in slices(batch, "text"):
                elements, sizes = shingle_sets(*utf8(piece.column("text")), width)
                held.append(elements)
                docs += len(sizes)
                if sum(map(len, held)) >= 1 << 21:
                    yield counted()
                    held, docs = [], 0
        yield counted()
    return run


def common_shingles(docs: DataFrame, width: int, share: float) -> np.ndarray:
    """Shingles in at least about ``share`` of all documents, sorted.

    A shingle so frequent in the corpus is so in some chunk of it, and chunks report those that are.
    There are at most the mean set size divided by ``share`` of them, so they fit the driver.
    """
    total = docs.count()
    found = docs.mapInArrow(_often(width, share), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= share * total)
    return np.sort(np.array([r.shingle for r in found.select("shingle").collect()], np.int64).view(np.uint64))


def parities(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each set, as 64-bit words, the bins that hold an odd number of its elements."""
    bins = 64 * len(_PARITY)
    slot = np.repeat(np.arange(len(sizes)) * bins, sizes) + (mix(elements) % np.uint64(bins)).astype(np.int64)
    odd = np.bincount(slot, minlength=len(sizes) * bins) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sizes), bins), axis=1).view(np.int64)


def _planes(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return docs & 0xFFFFFFFF, docs >> 32


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return high.astype(np.int64) << 32 | low.astype(np.int64)


def _row(kind: int, bucket: int, *arrays: np.ndarray) -> pa.RecordBatch:
    cells = [a.tobytes() for a in arrays] + [None] * (3 - len(arrays))
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)],
                                      ["kind", "bucket", "c0", "c1", "c2"])


def _sign(width: int, percent: int, common: np.ndarray, buckets: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, seen = Scatter(buckets, _SIGNED, 1 << 21), {}

        def flush():
            for out in sent.flush():
                yield pa.RecordBatch.from_arrays([pa.array([_SIGNATURES] * out.num_rows, pa.int32()), *out.columns], ["kind", "bucket", "c0", "c1", "c2"])

        for batch in batches:
            for piece in slices(batch, "text"):
                ids = np.asarray(piece.column("doc_id"))
                elements, sizes = shingle_sets(*utf8(piece.column("text")), width)
                through = any_bucket(ids, buckets)
                yield _row(_SETS, through, ids, sizes, parities(elements, sizes))
                ends = np.cumsum(sizes)
                sums = np.concatenate(([0], np.cumsum(mix(elements)))).astype(np.uint64)
                again = np.concatenate(([0], np.cumsum(mix(elements ^ np.uint64(0x2545F4914F6CDD1D))))).astype(np.uint64)
                marks = zip((sums[ends] - sums[ends - sizes]).tolist(), (again[ends] - again[ends - sizes]).tolist(), sizes.tolist())
                if len(seen) > SEEN:
                    seen.clear()  # a later copy then sends its signatures and is linked by them
                first = np.array([seen.setdefault(m, d) if m[2] else d for m, d in zip(marks, ids.tolist())], np.int64)
                copy = first != ids
                if copy.any():
                    yield _row(_LINKS, through, ids[copy], first[copy])
                lone = np.repeat(~copy, sizes)
                found, owner = signatures(elements[lone], sizes[~copy], percent, common)
                sent.add(found, found & np.uint64(0xFFFFFFFF), *_planes(ids[~copy][owner]))
                if sent.full:
                    yield from flush()
        yield from flush()
    return run


def _group(chain: bool = False):
    """Pairs with the least member and, for larger groups, the members, of one bucket's signatures.

    With ``chain`` there are also pairs of neighbours, and a group of up to ``WHOLE`` has all its pairs instead: they cost less
    than its members would.
    """
    def run(table: pa.Table) -> pa.Table:
        kinds = np.asarray(table["kind"])
        out = [table.filter(pa.array(kinds != _SIGNATURES))]
        sig, low, high = gathered(table.filter(pa.array(kinds == _SIGNATURES)).rename_columns(["kind", "bucket", *_SIGNED]), _SIGNED)
        if len(sig):
            bucket, doc = table["bucket"][0].as_py(), _joined(low, high)
            order = np.argsort(sig, kind="stable")
            sig, doc = sig[order], doc[order]
            again = np.zeros(len(sig), bool)
            same = sig[1:] == sig[:-1]
            again[1:] |= same
            again[:-1] |= same
            sig, doc = sig[again], doc[again]
            order = np.lexsort((doc, sig))
            sig, doc = sig[order], doc[order]
            once = group_starts(sig, doc)
            sig, doc = sig[once], doc[once]
            cuts = group_starts(sig)
            sizes = np.diff(np.append(cuts, len(sig)))
            if len(cuts):
                names = mix(np.add.reduceat(mix(doc.astype(np.uint64)), cuts)) & np.uint64((1 << 63) - 1)
                _, first = np.unique(names, return_index=True)
                first = first[sizes[first] > 1]
                names, cuts, sizes = names[first].astype(np.int64), cuts[first], sizes[first]
                others = doc[ragged(cuts + 1, sizes - 1)]
                pairs = [(np.repeat(doc[cuts], sizes - 1), others)]
                large = sizes > 2
                if chain:
                    large = sizes > WHOLE
                    follow = ragged((cuts + 2)[large], (sizes - 2)[large])
                    pairs.append((doc[follow - 1], doc[follow]))
                    inner = np.where(sizes <= WHOLE, sizes - 2, 0)
                    at = ragged(cuts + 1, inner)
                    rest = np.repeat(cuts + sizes, inner) - at - 1
                    pairs.append((doc[np.repeat(at, rest)], doc[ragged(at + 1, rest)]))
                a, b = (np.concatenate(x) for x in zip(*pairs))
                order = np.lexsort((b, a))
                once = order[group_starts(a[order], b[order])]
                out.append(pa.Table.from_batches([_row(_PAIRS, bucket, a[once], b[once])]))
                out.append(pa.Table.from_batches([_row(_MEMBERS, bucket, np.repeat(names[large], sizes[large]), doc[ragged(cuts[large], sizes[large])])]))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in zip(batch.column("c0").to_pylist(), batch.column("c1").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, np.int64)), pa.array(np.frombuffer(b, np.int64))], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cells in zip(*(batch.column(c).to_pylist() for c in ("c0", "c1", "c2"))):
            ids, sizes, bits = (np.frombuffer(x, np.int64) for x in cells)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sizes), *map(pa.array, bits.reshape(len(ids), -1).T)], ["doc_id", "n_shingles", *_PARITY])


def _similar(width: int, percent: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", 1 << 19):
                for piece in slices(part, "text_b", 1 << 19):
                    sides = []
                    for side in ("text_a", "text_b"):
                        elements, sizes = shingle_sets(*utf8(piece.column(side)), width)
                        sides.append(np.split(elements, np.cumsum(sizes)[:-1]))
                    shared = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)], np.int64)
                    total = np.array([len(x) + len(y) for x, y in zip(*sides)], np.int64)
                    linked = (shared > 0) & (100 * shared >= percent * (total - shared))
                    yield pa.RecordBatch.from_arrays([piece.column("a").filter(pa.array(linked)), piece.column("b").filter(pa.array(linked))], ["a", "b"])
    return run


def _verified(docs: DataFrame, pairs: DataFrame, space: Workspace, width: int, percent: int) -> DataFrame:
    """The pairs whose sets really are similar; only texts that stand in a pair are moved."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = space.write(docs.join(needed, "doc_id", "left_semi"), "texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return space.write(both.mapInArrow(_similar(width, percent), "a long, b long").distinct(), "links")


def similar_documents(docs: DataFrame, space: Workspace, width: int = 5, percent: int = 80, common_share: float = 0.002) -> tuple[DataFrame, DataFrame]:
    """Each document's set size and the component of documents linked by Jaccard similarity.

    Two documents link when 100 times the intersection of their sets is ``percent`` or more times
    the union. Returns (``doc_id``, ``n_shingles``, ``component_id``), where the component is the
    least ``doc_id`` reachable by links, and the links that join components. ``common_share`` sets from
    which share of documents on a shingle counts as common; it changes no result.

    Null text and text without words give an empty set, which links with nothing. Rows with a null
    ``doc_id`` are left out; rows that repeat a ``doc_id`` share its component; other columns are
    ignored; an empty table gives an empty result.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    docs = narrowed(docs).where("doc_id IS NOT NULL")
    buckets = bucket_count(docs.sparkSession)
    common = common_shingles(docs, width, common_share)
    signed = docs.mapInArrow(_sign(width, percent, common, buckets), _PACKED)
    found = space.write(signed.groupBy("bucket").applyInArrow(_group(), _PACKED), "candidates")

    def part(kind: int) -> DataFrame:
        return found.where(F.col("kind") == kind).mapInArrow(_spread, "a long, b long")

    copies = part(_LINKS)
    links = copies.unionByName(_verified(docs, part(_PAIRS).distinct(), space, width, percent))
    near = components(links, space)
    sets = found.where(F.col("kind") == _SETS).mapInArrow(_sets, f"doc_id long, n_shingles long, {' long, '.join(_PARITY)} long")
    # members of one signature that are still apart: all within the bound are compared
    members = part(_MEMBERS).distinct().withColumnsRenamed({"a": "name", "b": "doc"})
    members = members.join(near.withColumnRenamed("node", "doc"), "doc", "left").select("name", "doc", F.coalesce("root", "doc").alias("root"))
    apart = members.groupBy("name").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("name")
    apart = space.write(members.join(apart, "name", "left_semi").join(sets.withColumnRenamed("doc_id", "doc"), "doc"), "apart")
    differing = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in _PARITY), F.lit(0))
    differing = F.greatest(differing, F.abs(F.col("x.n_shingles") - F.col("y.n_shingles")))
    possible = (100 + percent) * differing <= (100 - percent) * (F.col("x.n_shingles") + F.col("y.n_shingles"))
    pairs = apart.alias("x").join(apart.alias("y"), (F.col("x.name") == F.col("y.name")) & (F.col("x.root") < F.col("y.root")) & possible) \
        .select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()
    links = space.write(links.unionByName(_verified(docs, pairs, space, width, percent)), "links")
    whole = components(links, space)
    result = sets.select("doc_id", "n_shingles").join(whole.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    return result, links
