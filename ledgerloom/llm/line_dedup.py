"""Near-equal lines across a corpus: MinHash candidates, exact verification, one line kept of each group.

Lines are lower-cased and cut into character shingles. One-permutation hashing gives each distinct
line ``rows * bands`` minima (each shingle falls into one bin; empty bins borrow from the next full
one), and lines that agree on all rows of a band are candidates: at similarity 0.8 a pair is missed in
all 20 bands of 6 rows with a chance of 0.2 percent. Candidates of a band are compared with the
least of them and with their neighbour in order of hash, by exact Jaccard similarity, and in a band of up to ``ngram_join.WHOLE``
lines each with each: a number of pairs in proportion to the band. That order is the same in all bands, so this alone does not find every link:
members still in different components after it meet each other, under a bound that no similar pair exceeds
(sizes, and which bins of the domain hold an odd number of shingles), and the pairs within it are compared too. Union-find
over tasks joins the links, and of each component the occurrence in the smallest document, first line, stays.

Line texts move only for candidates. Each task, and then each bucket, keeps a line's first place only: its later places are
removed whatever else the line is linked with, so they meet nothing but their documents.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import _BASE_INVERSE, Scatter, any_bucket, bucket_count, gathered, group_starts, mix, narrowed, powers, prefix_sums, ragged, range_hash, slices, tidy, utf8
from ledgerloom.llm.components import components
from ledgerloom.llm.ngram_join import _MEMBERS, _PACKED, _PAIRS, _PARITY, _SIGNATURES, _SIGNED, _group, _planes, _row, _spread, parities
from ledgerloom.llm.units import strings
from ledgerloom.sources.workspace import Workspace

_LINES, _FIRST = 5, 6
_PLACE = {"line": np.int64, "doc": np.int64, "number": np.int64}
#: Up to this many needed line hashes (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LINES = 1_000_000
#: Places of lines that a task holds before it keeps the first of each line only.
HELD = 1 << 18
#: Lines that a task remembers, to send each once.
SEEN = 500_000
#: Members of a band that one task compares with as many others.
CELL = 1024


def _lowered(column: pa.Array) -> pa.Array:
    return pa.array([None if t is None else t.lower() for t in column.to_pylist()], pa.large_string())


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in its row, start and end of every line that is not blank."""
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.argsort(owner, kind="stable")
    owner, starts = owner[order], starts[order]
    first = np.searchsorted(owner, np.arange(len(offsets)))
    ends = np.append(starts[1:] - 1, len(data))
    ends[first[1:] - 1] = offsets[1:]
    number = np.arange(len(starts)) - first[owner]
    filled = np.concatenate(([0], np.cumsum((data != 0x20) & ((data < 9) | (data > 13)))))
    kept = filled[ends] > filled[starts]
    return owner[kept], number[kept], starts[kept], ends[kept]


def shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-character shingles of each byte range, range after range, and how many
    each has; a shorter range is one shingle."""
    held = data[ragged(starts, ends - starts)]
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
    lead = np.flatnonzero((held & 0xC0) != 0x80)
    first = np.searchsorted(lead, bounds)
    chars = np.diff(first)
    number = np.maximum(chars - size + 1, 1)
    edge, sums = np.append(lead, len(held)), prefix_sums(held)
    out = np.zeros(int(number.sum()), np.uint64)
    if len(lead) >= size:
        # every run of ``size`` characters, then those within a range
        at_edge, begin = sums[edge], edge[:-size]
        runs = mix((at_edge[size:] - at_edge[:-size]) * powers(len(sums), _BASE_INVERSE)[begin] + (edge[size:] - begin).astype(np.uint64))
        out = runs[np.minimum(ragged(first[:-1], number), len(runs) - 1)]
    short = np.flatnonzero(chars < size)
    out[(np.cumsum(number) - number)[short]] = range_hash(sums, bounds[:-1][short], bounds[1:][short])
    return out, number


def sorted_runs(values: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The values of each row in rising order; ``number`` tells how many each row has.

    Rows of similar length are sorted together, in tables of at most about 65,536 cells or one row.
    """
    out = np.empty_like(values)
    begin, by = np.cumsum(number) - number, np.argsort(number, kind="stable")
    lengths = number[by]
    a = int(np.searchsorted(lengths, 1))
    while a < len(by):
        # no row is less than half as long as another in its table
        b = min(int(np.searchsorted(lengths, 2 * lengths[a])), a + max(1, (1 << 15) // int(lengths[a])))
        place = begin[by[a:b], None] + np.arange(lengths[b - 1])
        held = np.arange(lengths[b - 1]) < lengths[a:b, None]
        table = np.full(held.shape, np.iinfo(values.dtype).max, values.dtype)
        table[held] = values[place[held]]
        table.sort(axis=1)
        out[place[held]] = table[held]
        a = b
    return out


def minima(hashes: np.ndarray, number: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minima of each line, ``bins`` columns."""
    n = len(number)
    owner = np.repeat(np.arange(n), number)
    bin_of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    out = np.full(n * bins, np.iinfo(np.uint32).max, np.uint32)
    np.minimum.at(out, owner * bins + bin_of, (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    out = out.reshape(n, bins)
    twice = np.concatenate([out, out], axis=1)
    full = twice != np.iinfo(np.uint32).max
    place = np.where(full, np.arange(2 * bins, dtype=np.int16 if bins < 8192 else np.int64), 4 * bins)
    nearest = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :bins]
    borrowed = np.take_along_axis(twice, np.minimum(nearest, 2 * bins - 1), axis=1).astype(np.uint64)
    return mix(borrowed + ((nearest - np.arange(bins)).astype(np.uint64) << np.uint64(32)))


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """A key for each band of ``rows`` columns."""
    n, bins = values.shape
    bands = bins // rows
    parts = values[:, :bands * rows].reshape(n, bands, rows)
    return mix((parts * powers(rows)[:rows]).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def first_places(line: np.ndarray, doc: np.ndarray, number: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Each line with its first place, by document and number, and the documents and numbers of all other places."""
    order = np.argsort(line)
    line, doc, number = line[order], doc[order], number[order]
    starts = group_starts(line)
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(line))))
    least = np.minimum.reduceat(doc, starts)
    there = doc == least[of]
    lowest = np.minimum.reduceat(np.where(there, number, np.iinfo(np.int64).max), starts)
    later = ~there | (number != lowest[of])
    return (line[starts], least, lowest), (doc[later], number[later])


def _fresh(names: np.ndarray, seen: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names that are not in ``seen``, which gets them and is cleared when it is large, and where each first stands."""
    distinct, first = np.unique(names, return_index=True)
    new = np.array([x not in seen for x in distinct.tolist()], bool)
    if len(seen) > SEEN:
        seen.clear()
    seen.update(distinct[new].tolist())
    return distinct[new], first[new]


def _sign(size: int, rows: int, bands: int, buckets: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, seen, held = Scatter(buckets, _SIGNED), set(), []

        def dealt(kind: int, packed: Scatter):
            for out in packed.flush():
                yield pa.RecordBatch.from_arrays([pa.array([kind] * out.num_rows, pa.int32()), *out.columns], ["kind", "bucket", "c0", "c1", "c2"])

        def places():
            if held:
                through = any_bucket(held[0][1], buckets)
                first, gone = first_places(*(np.concatenate(x) for x in zip(*held)))
                held.clear()
                packed = Scatter(buckets, _PLACE)
                packed.add(mix(first[0]), *first)
                yield from dealt(_FIRST, packed)
                yield _row(_LINES, through, *gone)

        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = utf8(_lowered(piece.column("text")))
                ids = np.asarray(piece.column("doc_id"))
                owner, number, starts, ends = split_lines(data, offsets)
                if not len(owner):
                    continue
                name = range_hash(prefix_sums(data), starts, ends).view(np.int64)
                held.append((name, ids[owner], number))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield from places()
                _, first = _fresh(name, seen)
                for a in range(0, len(first), 512):
                    k = first[a:a + 512]
                    keys = band_keys(minima(*shingles(data, starts[k], ends[k], size), rows * bands), rows)
                    sent.add(keys.ravel(), (keys & np.uint64(0xFFFFFFFF)).ravel(), *_planes(np.repeat(name[k], bands)))
                if sent.full:
                    yield from dealt(_SIGNATURES, sent)
        yield from dealt(_SIGNATURES, sent)
        yield from places()
    return run


def _meet():
    """Pairs and members of one bucket's signatures; first and later places of its lines."""
    grouped = _group(chain=True)

    def run(table: pa.Table) -> pa.Table:
        here = np.asarray(table["kind"]) == _FIRST
        out = [grouped(table.filter(pa.array(~here)))]
        if here.any():
            bucket = table["bucket"][0].as_py()
            first, gone = first_places(*gathered(table.filter(pa.array(here)).rename_columns(["kind", "bucket", *_PLACE]), _PLACE))
            out.append(pa.Table.from_batches([_row(_FIRST, bucket, *first)]))
            if len(gone[0]):
                out.append(pa.Table.from_batches([_row(_LINES, bucket, *gone)]))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cells in zip(*(batch.column(c).to_pylist() for c in ("c0", "c1", "c2"))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, np.int64)) for x in cells], ["line", "doc_id", "number"])


def _gone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of removed lines, a list for each document of a packed row."""
    for batch in batches:
        for cells in zip(batch.column("c0").to_pylist(), batch.column("c1").to_pylist()):
            doc, number = (np.frombuffer(x, np.int64) for x in cells)
            order = np.argsort(doc, kind="stable")
            doc, number = doc[order], number[order]
            starts = group_starts(doc)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(doc)), pa.int32()), pa.array(number))
            yield pa.RecordBatch.from_arrays([pa.array(doc[starts]), lists], ["doc_id", "numbers"])


@tidy
def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their removed lines, in time linear in their length."""
    for batch in batches:
        for piece in slices(batch, "text"):
            texts, removed = piece.column("text").to_pylist(), [set(x or ()) for x in piece.column("removed").to_pylist()]
            lines = [0 if t is None else t.count("\n") + 1 for t in texts]
            kept = ["\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone) if gone else t for t, gone in zip(texts, removed)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(lines, pa.int64()), pa.array([len(x) for x in removed], pa.int64()),
                                              pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_removed", "kept_text"])


@tidy
def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct lines of a task, as far as it remembers them, with their hash."""
    seen: set[int] = set()
    for batch in batches:
        for piece in slices(batch, "text"):
            data, offsets = utf8(_lowered(piece.column("text")))
            _, _, starts, ends = split_lines(data, offsets)
            name, first = _fresh(range_hash(prefix_sums(data), starts, ends).view(np.int64), seen)
            starts, lengths = starts[first], (ends - starts)[first]
            k = strings(data[ragged(starts, lengths)], np.concatenate(([0], np.cumsum(lengths))))
            yield pa.RecordBatch.from_arrays([pa.array(name), k.cast(pa.string())], ["line", "text"])


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, row after row, and the row of each."""
    data, offsets = utf8(column)
    values, number = shingles(data, offsets[:-1], offsets[1:], size)
    values, owner = sorted_runs(values, number), np.repeat(np.arange(len(number)), number)
    once = group_starts(owner, values)
    return owner[once], values[once]


def _sets_of(ids: pa.Array, column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of the sets of each row, made once for the rows of one id."""
    _, first, of = np.unique(np.asarray(ids), return_index=True, return_inverse=True)
    owner, values = _sets(column.take(pa.array(first)), size)
    sizes = np.bincount(owner, minlength=len(first))
    return sizes[of], values[ragged((np.cumsum(sizes) - sizes)[of], sizes[of])]


def _bounds(size: int):
    """Set size and parities of each line."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 19):
                owner, values = _sets(piece.column("text"), size)
                sizes = np.bincount(owner, minlength=piece.num_rows)
                bits = parities(values, sizes).reshape(len(sizes), -1)
                yield pa.RecordBatch.from_arrays([piece.column("line"), pa.array(sizes), *map(pa.array, bits.T)], ["line", "n_shingles", *_PARITY])
    return run


def _similar(size: int, percent: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text_b", 1 << 19):
                sizes, sets = zip(*(_sets_of(piece.column(side), piece.column(f"text_{side}"), size) for side in ("a", "b")))
                n = piece.num_rows
                begin = np.cumsum(sizes[0] + sizes[1]) - sizes[0] - sizes[1]
                both = np.empty(sum(map(len, sets)), np.uint64)
                both[ragged(begin, sizes[0])], both[ragged(begin + sizes[0], sizes[1])] = sets
                both, owner = sorted_runs(both, sizes[0] + sizes[1]), np.repeat(np.arange(n), sizes[0] + sizes[1])
                union = np.bincount(owner[group_starts(owner, both)], minlength=n)
                shared = sizes[0] + sizes[1] - union
                linked = pa.array(100 * shared >= percent * union)
                yield pa.RecordBatch.from_arrays([piece.column("a").filter(linked), piece.column("b").filter(linked)], ["a", "b"])
    return run


def _needed_texts(docs: DataFrame, pairs: DataFrame, space: Workspace) -> DataFrame:
    """Every line that stands in a pair, once, with its text."""
    needed = space.write(pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct(), "needed")
    side = F.broadcast(needed) if needed.count() <= BROADCAST_LINES else needed
    texts = docs.mapInArrow(_texts, "line long, text string").join(side, "line", "left_semi").groupBy("line").agg(F.first("text").alias("text"))
    return space.write(texts, "texts")


def _verified(texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets really are similar."""
    both = pairs.join(texts.select(F.col("line").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("line").alias("b"), F.col("text").alias("text_b")), "b")
    return both.mapInArrow(_similar(size, percent), "a long, b long")


def _still_apart(members: DataFrame, near: DataFrame, texts: DataFrame, space: Workspace, size: int, percent: int) -> DataFrame:
    """Pairs of members of one band in different components that may be similar by the bound.

    A band of many such members is cut into a grid of cells of at most about ``CELL`` by ``CELL``, so no task
    compares a whole band with itself. Lines carry their bands (at most as many as a line has), and a pair leaves the join
    under the least band that both hold, so just once.
    """
    members = members.join(near.withColumnRenamed("node", "line"), "line", "left").select("name", "line", F.coalesce("root", "line").alias("root"))
    bands = members.groupBy("name").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n")).where("least < most") \
        .select("name", F.ceil(F.col("n") / CELL).cast("int").alias("cells"))
    apart = space.write(members.join(bands, "name"), "apart")
    names = apart.groupBy("line").agg(F.collect_list("name").alias("names"))
    bounds = texts.join(names.select("line"), "line", "left_semi").mapInArrow(_bounds(size), f"line long, n_shingles long, {' long, '.join(_PARITY)} long")
    apart = space.write(apart.join(names, "line").join(bounds, "line").withColumn("own", F.pmod(F.xxhash64("line"), F.col("cells")).cast("int")), "apart")
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    x = apart.withColumn("row", F.col("own")).withColumn("column", every).alias("x")
    y = apart.withColumn("column", F.col("own")).withColumn("row", every).alias("y")
    differing = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in _PARITY), F.lit(0))
    differing = F.greatest(differing, F.abs(F.col("x.n_shingles") - F.col("y.n_shingles")))
    possible = (100 + percent) * differing <= (100 - percent) * (F.col("x.n_shingles") + F.col("y.n_shingles"))
    same_cell = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("name", "row", "column")]
    here = F.array_min(F.array_intersect("x.names", "y.names")) == F.col("x.name")
    return x.join(y, [*same_cell, F.col("x.root") < F.col("y.root"), possible, here]) \
        .select(F.least("x.line", "y.line").alias("a"), F.greatest("x.line", "y.line").alias("b"))


def _joined(near: DataFrame, more: DataFrame, space: Workspace) -> DataFrame:
    """Components of the links of ``near`` and ``more``, found from the roots that ``more`` joins alone."""
    for side in ("a", "b"):
        more = more.join(near.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    found = components(more.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), space)
    moved = near.join(found.select(F.col("node").alias("root"), F.col("root").alias("least")), "root", "left").select("node", F.coalesce("least", "root").alias("root"))
    return space.write(moved.unionByName(found), "forest")


def drop_near_lines(docs: DataFrame, space: Workspace, size: int = 8, percent: int = 80, rows: int = 6, bands: int = 20) -> DataFrame:
    """Each document without the lines that repeat an earlier one, exactly or nearly.

    Two lines link when their sets of ``size``-character shingles (lower case) have a Jaccard
    similarity of ``percent`` or more; a component's first line stays, by ``doc_id`` and then place.
    Returns ``doc_id``, ``n_lines``, ``n_removed`` and ``kept_text``.

    Blank lines stay. Null text stays null, with no lines. A document may lose all its lines; its text is then
    empty. Rows must have distinct ``doc_id``; those with a null one are left out, other columns are
    ignored, and an empty table gives an empty result. Lines are told apart by 64-bit hashes.
    """
    docs = narrowed(docs).where("doc_id IS NOT NULL")
    buckets = bucket_count(docs.sparkSession)
    found = space.write(docs.mapInArrow(_sign(size, rows, bands, buckets), _PACKED).groupBy("bucket").applyInArrow(_meet(), _PACKED), "lines")

    def part(kind: int) -> DataFrame:
        return found.where(F.col("kind") == kind).mapInArrow(_spread, "a long, b long")

    pairs = space.write(part(_PAIRS).distinct(), "pairs")
    texts = _needed_texts(docs, pairs, space)
    links = space.write(_verified(texts, pairs, size, percent), "links")
    near = components(links, space)
    # members of a band all stand in pairs, so their texts are there already
    members = part(_MEMBERS).distinct().withColumnsRenamed({"a": "name", "b": "line"})
    more = space.write(_verified(texts, _still_apart(members, near, texts, space, size, percent), size, percent), "links")
    if not more.isEmpty():
        near = _joined(near, more, space)

    # first places of linked lines; the others have nothing but their own later places
    few = near.count() <= BROADCAST_LINES
    linked = near.unionByName(near.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "line")
    places = found.where(F.col("kind") == _FIRST).mapInArrow(_places, "line long, doc_id long, number long")
    places = space.write(places.join(F.broadcast(linked) if few else linked, "line").select("root", "doc_id", "number"), "places")
    place = F.struct("doc_id", "number")
    first = places.groupBy("root").agg(F.min(place).alias("first"))
    later = places.join(F.broadcast(first) if few else first, "root").where(place != F.col("first")).select("doc_id", F.array("number").alias("numbers"))
    gone = found.where(F.col("kind") == _LINES).mapInArrow(_gone, "doc_id long, numbers array<long>")
    removed = gone.unionByName(later).groupBy("doc_id").agg(F.flatten(F.collect_list("numbers")).alias("removed"))
    # the text is dealt once, unsorted; what is removed joins it
    return docs.join(removed.hint("shuffle_hash"), "doc_id", "left").mapInArrow(_without, "doc_id long, n_lines long, n_removed long, kept_text string")
