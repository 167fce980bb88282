"""Linear-chain conditional random field with two labels, over many sequences at once, in numpy.

A line's unary score for label 1 is linear in its features, which include its neighbours'; label 0
scores 0. Labels of neighbouring lines add a transition score. Sequences are sorted by length, so
each step of a recursion is one operation over all sequences that are still going on.
"""

from dataclasses import dataclass
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import literal_frame
from ledgerloom.llm.common import narrowed, slices, tidy, utf8
from ledgerloom.llm.lines import WIDTH, line_tables


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


class _Steps:
    """The places of sequences, step by step, for those long enough to have that step."""

    def __init__(self, first: np.ndarray):
        size = np.diff(first)
        self.order = np.argsort(-size, kind="stable")
        self.start, self.size = first[:-1][self.order], size[self.order]
        self.longest = int(size.max()) if len(size) else 0
        self.active = np.searchsorted(-self.size, -np.arange(self.longest), "left")

    def at(self, step: int) -> np.ndarray:
        return self.start[:self.active[step]] + step


@dataclass
class Chain:
    """Weights of features for label 1, and ``move[a, b]``, the score of label ``b`` after ``a``."""

    weights: np.ndarray
    move: np.ndarray

    def marginals(self, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of label 1 for each line, expected moves, and each sequence's log norm."""
        unary = features @ self.weights
        n, steps = len(unary), _Steps(first)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[:, 1] = unary
        for t in range(1, steps.longest):
            i = steps.at(t)
            p = forward[i - 1]
            forward[i, 0] = _add(p[:, 0] + self.move[0, 0], p[:, 1] + self.move[1, 0])
            forward[i, 1] = _add(p[:, 0] + self.move[0, 1], p[:, 1] + self.move[1, 1]) + unary[i]
        for t in range(steps.longest - 1, 0, -1):
            i = steps.at(t)
            b0, b1 = backward[i, 0], backward[i, 1] + unary[i]
            backward[i - 1, 0] = _add(b0 + self.move[0, 0], b1 + self.move[0, 1])
            backward[i - 1, 1] = _add(b0 + self.move[1, 0], b1 + self.move[1, 1])
        total = forward + backward
        norm = _add(total[:, 0], total[:, 1])
        inner = np.ones(n, bool)
        inner[first[:-1][np.diff(first) > 0]] = False
        i = np.flatnonzero(inner)
        moves = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                moves[a, b] = np.exp(forward[i - 1, a] + self.move[a, b] + b * unary[i] + backward[i, b] - norm[i]).sum()
        return np.exp(total[:, 1] - norm), moves, norm

    def viterbi(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The likeliest labels of each sequence's lines; equal scores choose label 1."""
        unary = features @ self.weights
        n, steps = len(unary), _Steps(first)
        best, came = np.zeros((n, 2)), np.zeros((n, 2), np.int8)
        best[:, 1] = unary
        for t in range(1, steps.longest):
            i = steps.at(t)
            for b in (0, 1):
                stay, go = best[i - 1, 0] + self.move[0, b], best[i - 1, 1] + self.move[1, b]
                came[i, b] = go >= stay
                best[i, b] = np.maximum(stay, go) + b * unary[i]
        labels = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(steps.longest - 1, 0, -1):
            i = steps.at(t)
            labels[i - 1] = came[i, labels[i]]
        return labels


def train(features: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = 120, rate: float = 0.15, penalty: float = 1e-3) -> Chain:
    """Fit a chain to labelled lines by Adam on the mean log-likelihood of a line."""
    n = max(len(labels), 1)
    inner = np.ones(len(labels), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    i = np.flatnonzero(inner)
    moved = np.zeros((2, 2))
    np.add.at(moved, (labels[i - 1], labels[i]), 1)
    size = features.shape[1]
    values, mean, spread = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, rounds + 1):
        chain = Chain(values[:size], values[size:].reshape(2, 2))
        share, moves, _ = chain.marginals(features, first)
        gradient = np.concatenate([features.T @ (labels - share), (moved - moves).ravel()]) / n - penalty * values
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient ** 2
        values = values + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.99 ** step)) + 1e-8)
    return Chain(values[:size].copy(), values[size:].reshape(2, 2).copy())


@tidy
def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            found = line_tables(*utf8(piece.column("text")))
            first = found["first_line"].tolist()
            cells = [found["features"][a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            sizes = [found["length"][a:b].astype(np.int64).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([piece.column("label"), pa.array(cells, pa.binary()), pa.array(sizes, pa.binary())], ["label", "features", "sizes"])


def fold(column, parts: int):
    """The part a document belongs to: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


@dataclass
class Sample:
    """Lines of labelled documents, and how frequent label 1 is among all labelled ones."""

    features: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    labels: np.ndarray
    share: float


def within(sizes: list[int], budget: int) -> list[bool]:
    """Which of the sizes, in order, fit into the budget; one that no longer fits is passed over."""
    kept, used = [], 0
    for size in sizes:
        kept.append(used + size <= budget)
        used += size * kept[-1]
    return kept


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int, held_out: int | None, parts: int = 5,
                    lines: int = 250_000) -> Sample:
    """At most ``per_class`` documents of each label, those of least hash of their id, and at most ``lines`` lines of each.

    Documents are taken whole, in the order of the hash; one that would exceed the lines left is passed
    over. Rows of the part ``held_out`` are left out, before anything is learned. The ids are broadcast:
    there are at most ``2 * per_class`` of them. Null labels and ids count as unlabelled; rows that share an id are taken together.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")) \
        .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    if held_out is not None:
        marked = marked.where(fold("doc_id", parts) != held_out)
    counts = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    chosen = [marked.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    found = narrowed(docs).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    breaks = F.octet_length("text") - F.octet_length(F.translate("text", "\n", "")) + 1
    sized = found.groupBy("label", "doc_id").agg(F.sum(F.coalesce(breaks, F.lit(1))).alias("n")) \
        .orderBy("label", F.xxhash64("doc_id"), "doc_id").collect()
    kept = []
    for v in (0, 1):
        own = [r for r in sized if r.label == v]
        kept += [(r.doc_id, v) for r, fits in zip(own, within([r.n for r in own], lines)) if fits]
    taken = literal_frame(docs.sparkSession, kept, [("doc_id", "bigint"), ("label", "int")])
    joined = narrowed(docs).join(F.broadcast(taken), "doc_id").select("label", "text")
    rows = joined.mapInArrow(_featured, "label int, features binary, sizes binary").collect()
    blocks = [np.frombuffer(r.features, np.float32).reshape(-1, WIDTH) for r in rows]
    first = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype(np.int64)
    return Sample(np.concatenate(blocks) if blocks else np.zeros((0, WIDTH), np.float32),
                  np.concatenate([np.frombuffer(r.sizes, np.int64) for r in rows]) if rows else np.zeros(0, np.int64), first,
                  np.array([r.label for r in rows], np.int64), counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 1.0)


def fit(sample: Sample) -> Chain | None:
    """A chain fitted with each document's label on all its lines; none without both labels."""
    if len(set(sample.labels.tolist())) < 2:
        return None
    return train(sample.features, sample.first, np.repeat(sample.labels, np.diff(sample.first)))


def weighted_share(values: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of line values in each sequence, weighted by length; by number where all are empty."""
    def sums(x):
        return np.diff(np.concatenate(([0.0], np.cumsum(x)))[first])
    weight = sums(sizes)
    return np.where(weight > 0, sums(values * sizes) / np.maximum(weight, 1), sums(values) / np.maximum(np.diff(first), 1))
