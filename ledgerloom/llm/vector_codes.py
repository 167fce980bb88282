"""Product-quantised codes of vectors, by Lloyd rounds that compare moved entries only.

Components become whole numbers, so sums and distances are exact whatever the order rows are read in.
Each row keeps, for every part, the entry it is assigned to and the exact distance to it. When entries
have moved, a part whose own entry stayed fixed compares only the moved ones against that distance: the
fixed ones cannot have come nearer, and of equal distances the lower index wins as in a full scan.
Parts whose entry moved are compared with all entries.

Rows stay in Spark; what meets on the driver are the codebooks and their sums, whose size is
``parts * entries`` whatever the input.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import Workspace

#: Scaled components below this keep distances and sums exact in 64 bits.
_LARGEST = 1 << 27
_SUMS = "part int, entry int, count long, sums array<long>"


def _state(label: str) -> str:
    return f"vec_id long, label {label}, vector array<long>, code binary, distance array<long>"


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point the entry of least squared distance, the lower index on ties, and that distance."""
    apart = np.zeros((len(points), len(book)), np.int64)
    for j in range(points.shape[1]):
        gap = points[:, j, None] - book[None, :, j]
        apart += gap * gap
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(points)), best]


def reassigned(points: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``code`` and ``distance`` against ``book``, given those against the book before ``moved`` entries moved."""
    code, distance = code.copy(), distance.copy()
    again = moved[code]
    if again.any():
        code[again], distance[again] = nearest_entries(points[again], book)
    active = np.flatnonzero(moved)
    kept = np.flatnonzero(~again)
    if len(active) and len(kept):
        entry, apart = nearest_entries(points[kept], book[active])
        entry = active[entry]
        nearer = (apart < distance[kept]) | ((apart == distance[kept]) & (entry < code[kept]))
        code[kept[nearer]], distance[kept[nearer]] = entry[nearer], apart[nearer]
    return code, distance


def _points(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """Vectors of a batch as rows, parts, components."""
    flat = np.asarray(batch.column("vector").flatten(), np.int64)
    return flat.reshape(batch.num_rows, parts, -1)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), pa.int64()))


def _codes_of(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, parts)


def _assign(books: np.ndarray, moved: np.ndarray | None):
    """Rows with their codes against ``books``; without ``moved`` every part is compared with all entries."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch, parts)
            code = np.zeros((batch.num_rows, parts), np.uint8)
            distance = np.zeros((batch.num_rows, parts), np.int64)
            if moved is not None and batch.num_rows:
                code = _codes_of(batch.column("code"), parts).copy()
                distance = np.asarray(batch.column("distance").flatten(), np.int64).reshape(-1, parts).copy()
            for p in range(parts if batch.num_rows else 0):
                if moved is None:
                    code[:, p], distance[:, p] = nearest_entries(points[:, p], books[p])
                elif moved[p].any():
                    code[:, p], distance[:, p] = reassigned(points[:, p], books[p], moved[p], code[:, p].astype(np.int64), distance[:, p])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("vector"), pa.array([row.tobytes() for row in code], pa.binary()), _lists(distance)],
                ["vec_id", "label", "vector", "code", "distance"])
    return run


def _sums(parts: int, entries: int):
    """A row for each part and entry that a task has points of: how many, and their component sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(parts * entries, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            points, code = _points(batch, parts), _codes_of(batch.column("code"), parts)
            if sums is None:
                sums = np.zeros((parts * entries, points.shape[2]), np.int64)
            slot = (code + np.arange(parts) * entries).reshape(-1)
            np.add.at(count, slot, 1)
            np.add.at(sums, slot, points.reshape(len(slot), -1))
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array((used // entries).astype(np.int32)), pa.array((used % entries).astype(np.int32)), pa.array(count[used]), _lists(sums[used])],
                ["part", "entry", "count", "sums"])
    return run


def _moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every used entry moved to the floor of its points' mean. Sums fold in tasks, then by part and entry."""
    parts, entries, width = books.shape
    folded = state.select("vector", "code").mapInArrow(_sums(parts, entries), _SUMS).groupBy("part", "entry").agg(
        F.sum("count").alias("count"), *[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(width)])
    out = books.copy()
    for row in folded.collect():  # at most parts * entries rows
        out[row.part, row.entry] = [row[f"s{j}"] // row["count"] for j in range(width)]
    return out


def scaled(vectors: DataFrame, parts: int, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label`` and the vector as whole numbers ``floor(scale * x)``, of rows that take part.

    Left out are rows whose vector is null or holds a null or non-finite component, and vectors of another length than
    most of those that ``parts`` divides. A scaled component beyond 2**27 is an error: its distances could not be exact in 64 bits.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                           F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull()).where(finite)
    fits = (F.size("embedding") > 0) & (F.size("embedding") % parts == 0)
    usual = known.where(fits).groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    whole = F.transform("embedding", lambda x: F.when(F.abs(x * scale) < _LARGEST, F.floor(x * float(scale)).cast("long"))
                        .otherwise(F.raise_error(F.lit("vector component too large for exact codes")).cast("long")))
    return known.where(F.size("embedding") == (usual.dims if usual else -1)).select("vec_id", "label", whole.alias("vector"))


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks of the vectors of the ``entries`` smallest ids, nulls last; of a repeated id the least vector. None without rows."""
    ids = [r.vec_id for r in rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    if not ids:
        return None
    wanted = F.col("vec_id").isin([i for i in ids if i is not None])
    wanted = wanted | F.col("vec_id").isNull() if None in ids else wanted
    seeds = rows.where(wanted).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(F.col("vec_id").asc_nulls_last()).collect()
    return np.array([r.vector for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()


def trained(vectors: DataFrame, workspace: Workspace, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, np.ndarray | None]:
    """Rows with their last code and distances, and the codebooks (part, entry, component)."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index must fit a byte")
    rows, schema = workspace.write(scaled(vectors, parts, scale), "scaled"), _state(vectors.schema["label"].dataType.simpleString())
    books = first_books(rows, parts, entries)
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    state, moved = rows, None
    for i in range(rounds):
        state = workspace.write(state.mapInArrow(_assign(books, moved), schema), f"assigned{i}")
        after = _moved_books(state, books)
        moved, books = (after != books).any(axis=2), after
    return workspace.write(state.mapInArrow(_assign(books, moved), schema), "coded"), books


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def codes(vectors: DataFrame, workspace: Workspace, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """``vec_id``, ``code`` (entry of each part, two hex digits), ``error`` (squared distances summed over the parts),
    ``label_error`` (errors summed over the rows of one label, nulls together) and ``codebooks_sha256``.

    Rows that take part are those of ``scaled``; each gives one row, repeated rows and null ids included. With fewer
    distinct ids than ``entries`` the codebooks are that short. An empty table gives an empty result. Other columns are ignored.
    """
    state, books = trained(vectors, workspace, parts, entries, rounds)
    total = F.aggregate("distance", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), total.alias("error"))
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(books) if books is not None else None).cast("string").alias("codebooks_sha256"))
