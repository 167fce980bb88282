"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One replaced letter raises one letter's count and lowers another's, one inserted letter raises one; so a near
word of equal length lies within L1 distance two, one that is longer by a letter within one. Words are searched
per pair of lengths (equal, or one apart): a tree's boxes that cannot hold such a vector are pruned, words left
in a leaf are compared by vector, then letter by letter.

The tops of the trees come from a bounded sample and deal the words over groups: each word lives in one leaf of its
length's tree and is asked in every leaf, of its own and the next length, whose box it may reach. A group holds one
leaf, or a hashed cell of one that is too large, and builds the rest of the tree over it.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import Workspace

#: Words of one group, counted as if of 16 letters; leaves of the sampled trees are at least this large.
GROUP_WORDS = 16_384
#: Most leaves of all sampled trees; beyond this many groups' worth of words, groups grow instead.
MOST_LEAVES = 4_096
#: Sampled words for each leaf of a sampled tree.
SAMPLED = 16
_BINS = 32
#: Words of a leaf inside a group.
_LEAF = 48
_BIN_OF = np.array([c - 97 if 97 <= c < 123 else 26 + c % 6 for c in range(256)], np.int64)

#: In lower-cased text; the class that also names A-Z takes the regex engine seven times as long.
_BETWEEN_RUNS = r"[^a-z\u00C0-\u00FF]+"
_HOME = "length int, leaf int, cell int, word string, n long"
_EDGES = "word string, near string, near_n long"


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes; all letters are below U+0100."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """How often each bin of letters occurs: a to z one by one, all others in six bins."""
    slot = _BIN_OF[rows] + np.arange(len(rows))[:, None] * _BINS
    return np.bincount(slot.reshape(-1), minlength=len(rows) * _BINS).reshape(-1, _BINS).astype(np.int32)


class CountTree:
    """k-d tree over whole-number points. Its leaves cut all of space; ``members`` are the points of each."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.axis, self.cut, self.child, self.members = [], [], [], []
        stack = [(np.arange(len(points)), -1, 0)]
        while stack:
            held, parent, side = stack.pop()
            node = len(self.axis)
            if parent >= 0:
                self.child[parent][side] = node
            here = points[held]
            axis = int(here.var(axis=0).argmax()) if len(held) > leaf else 0
            values = here[:, axis]
            if len(held) <= leaf or values.min() == values.max():
                self.axis.append(-1)
                self.cut.append(len(self.members))
                self.child.append([-1, -1])
                self.members.append(held)
                continue
            # the values up to the cut go left; some are always left for the right
            cut = min(int(np.partition(values, len(values) // 2)[len(values) // 2]), int(values.max()) - 1)
            left = values <= cut
            self.axis.append(axis)
            self.cut.append(cut)
            self.child.append([-1, -1])
            stack += [(held[left], node, 0), (held[~left], node, 1)]

    def visits(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the queries that may reach them: by raising counts by ``up`` and lowering others by ``down`` at most."""
        free = np.zeros(len(queries), np.int32)
        stack = [(0, np.arange(len(queries)), free, free, {}, {})]
        while stack:
            node, asked, raised, lowered, low, high = stack.pop()
            axis, cut = self.axis[node], self.cut[node]
            if axis < 0:
                yield cut, asked
                continue
            at = queries[asked, axis]
            # right of the cut a count is at least cut + 1, left of it at most cut
            more = np.maximum(cut + 1 - at, 0) - (np.maximum(low[axis] - at, 0) if axis in low else 0) + raised
            less = np.maximum(at - cut, 0) - (np.maximum(at - high[axis], 0) if axis in high else 0) + lowered
            right, left = more <= up, less <= down
            if right.any():
                stack.append((self.child[node][1], asked[right], more[right], lowered[right], {**low, axis: cut + 1}, high))
            if left.any():
                stack.append((self.child[node][0], asked[left], raised[left], less[left], low, {**high, axis: cut}))


def one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced letter, or by one inserted where ``longer`` has one more."""
    if shorter.shape[1] == longer.shape[1]:
        return (shorter != longer).sum(axis=1) == 1
    width = shorter.shape[1]
    front, back = shorter == longer[:, :-1], (shorter == longer[:, 1:])[:, ::-1]
    run = lambda same: np.where(same.all(axis=1), width, same.argmin(axis=1))
    return run(front) + run(back) >= width


def packed(points: np.ndarray) -> np.ndarray:
    """Letter counts as one number, two bits a bin and carries taken along, so a difference of two is that of their vectors."""
    return (points.astype(np.int64) << np.arange(0, 2 * _BINS, 2)).sum(axis=1)


def _may_be_near(gap: np.ndarray, equal: bool) -> np.ndarray:
    """Whether packed vectors ``gap`` apart may be one edit apart: one bin more and one less, or none, or one more only.

    4**i less 4**j is a run of ones, which its lowest bit carries over into one bit. Other gaps may look so too, never the other way round.
    """
    if not equal:
        return (gap > 0) & (gap & (gap - 1) == 0)
    size = np.abs(gap)
    size += size & -size
    return size & (size - 1) == 0


def near_pairs(tree: CountTree, home: np.ndarray, asked: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``asked`` and ``home`` (letters, the latter in ``tree``) that are one edit apart, each pair once.

    ``most`` bounds what one step compares.
    """
    equal = home.shape[1] == asked.shape[1]
    queries = letter_counts(asked)
    there, here = packed(letter_counts(home)), packed(queries)
    wide = max(1, most // home.shape[1])
    for leaf, reached in tree.visits(queries, 1, int(equal)):
        members = tree.members[leaf]
        for i in range(0, len(members), most):
            some = members[i:i + most]
            step = max(1, most // len(some))
            for j in range(0, len(reached), step):
                part = reached[j:j + step]
                a, b = np.nonzero(_may_be_near(there[some][None] - here[part][:, None], equal))
                for k in range(0, len(a), wide):
                    x, y = part[a[k:k + wide]], some[b[k:k + wide]]
                    true = one_edit(asked[x], home[y])
                    if true.any():
                        yield x[true], y[true]


def _cell(word: str, cells: int) -> int:
    return zlib.crc32(word.encode()) % cells if cells > 1 else 0


def _rows(lengths: list, leaves: list, cells: list, words: list, counts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lengths, pa.int32()), pa.array(leaves, pa.int32()), pa.array(cells, pa.int32()),
                                       pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["length", "leaf", "cell", "word", "n"])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], list[int]]]:
    words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
    held: dict[int, tuple[list, list]] = {}
    for word, n in zip(words, counts):
        own = held.setdefault(len(word), ([], []))
        own[0].append(word)
        own[1].append(n)
    for length, (some, numbers) in held.items():
        yield length, some, numbers


def _at_home(trees: dict[int, CountTree], cells: dict[tuple[int, int], int]):
    """Each word once, under its leaf and cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, words, counts in _by_length(batch):
                leaf = np.zeros(len(words), np.int64)
                if length in trees:
                    for where, who in trees[length].visits(letter_counts(letters(words)), 0, 0):
                        leaf[who] = where
                own = leaf.tolist()
                yield _rows([length] * len(words), own, [_cell(w, cells.get((length, x), 1)) for w, x in zip(words, own)], words, counts)
    return run


def _asked(trees: dict[int, CountTree], cells: dict[tuple[int, int], int]):
    """Each word under every leaf, of its own length and the next, that may hold a near word, and all cells of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, words, counts in _by_length(batch):
                points = None
                for target in (length, length + 1):
                    if target in trees:
                        points = letter_counts(letters(words)) if points is None else points
                        found = trees[target].visits(points, 1, int(target == length))
                    else:
                        found = [(0, np.arange(len(words)))]
                    for leaf, who in found:
                        for cell in range(cells.get((target, leaf), 1)):
                            k = len(who)
                            yield _rows([target] * k, [leaf] * k, [cell] * k, [words[i] for i in who], [counts[i] for i in who])
    return run


def _meet(home: pa.Table, asked: pa.Table) -> pa.Table:
    out: tuple[list, list, list] = ([], [], [])
    if home.num_rows and asked.num_rows:
        words, counts = home["word"].to_pylist(), home["n"].to_pylist()
        rows, length = letters(words), len(words[0])
        tree = CountTree(letter_counts(rows), _LEAF)
        other, numbers = asked["word"].to_pylist(), asked["n"].to_pylist()
        for size in (length, length - 1):
            at = [i for i, w in enumerate(other) if len(w) == size]
            if not at or not size:
                continue
            for x, y in near_pairs(tree, rows, letters([other[i] for i in at])):
                for a, b in zip(x.tolist(), y.tolist()):
                    a = at[a]
                    out[0].append(other[a])
                    out[1].append(words[b])
                    out[2].append(counts[b])
                    if size < length:  # a word of this length is not asked among shorter ones
                        out[0].append(words[b])
                        out[1].append(other[a])
                        out[2].append(numbers[a])
    return pa.table([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["word", "near", "near_n"])


def _lower(run: Column) -> Column:
    return F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, letters_least: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """``word`` and ``n`` of the runs of letters in all texts, A to Z in lower case.

    Where ``every`` divides the crc32 of ``<doc_id>:<run>`` the run loses the code point at that crc32 modulo its length; a null
    ``doc_id`` is written as nothing. Words have ``letters_least`` code points and ``least`` occurrences at least.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # lower-casing A to Z first moves no border of a run; shorter runs cannot make a word, as they never grow
    split = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.split(_lower(text), _BETWEEN_RUNS).alias("runs"))
    named = split.select("doc", F.explode_outer("runs").alias("run")).where(F.length("run") >= letters_least)
    hashed = named.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    place = F.col("h") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), place.cast("int")), F.substring("run", (place + 2).cast("int"), F.length("run")))
    words = hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= letters_least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _trees(words: DataFrame, group: int, most: int) -> dict[int, CountTree]:
    """A tree for each length with more words than a group takes, over a sample by hash of at most ``SAMPLED * most`` words or so."""
    large = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("k")).where(F.col("k") > group).collect()
    if not large:
        return {}
    total = sum(r.k for r in large)
    leaf = max(group, total // most)
    every = max(1, leaf // SAMPLED)
    chosen = words.where(F.length("word").isin([r.length for r in large])).where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0)
    sample: dict[int, list[str]] = {}
    for row in chosen.select("word").collect():
        sample.setdefault(len(row.word), []).append(row.word)
    return {length: CountTree(letter_counts(letters(sorted(some))), SAMPLED) for length, some in sample.items()}


def near_words(words: DataFrame, workspace: Workspace, group: int = GROUP_WORDS, most: int = MOST_LEAVES) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for all words of ``word`` and ``n`` that are one edit apart, both ways round.

    ``words`` must be distinct and already written, as it is read several times.
    """
    trees = _trees(words, group, most)
    leaves = words.mapInArrow(_at_home(trees, {}), _HOME)
    weight = F.sum(F.greatest(F.col("length"), F.lit(16)).cast("long"))
    # a leaf that holds more than two groups' worth of letters is cut into cells; there are few, as each holds that many
    heavy = leaves.groupBy("length", "leaf").agg(weight.alias("weight")).where(F.col("weight") > 32 * group).collect()
    cells = {(r.length, r.leaf): -(-r.weight // (16 * group)) for r in heavy}
    home = words.mapInArrow(_at_home(trees, cells), _HOME)
    asked = words.mapInArrow(_asked(trees, cells), _HOME)
    keys = ["length", "leaf", "cell"]
    return home.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_meet, _EDGES)


def roots(forms: DataFrame, workspace: Workspace, longest: int) -> DataFrame:
    """``word`` and ``root`` of ``word`` and ``form``: forms followed to the last, for chains of at most ``longest`` steps.

    Each round follows twice as many steps as the one before.
    """
    links = workspace.write(forms.select("word", F.col("form").alias("root")), "forms")
    for i in range(max(0, math.ceil(math.log2(max(longest, 1))))):
        onward = links.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        links = workspace.write(links.join(onward, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_on", "root").alias("root")), f"roots{i}")
    return links


def spelling_variants(docs: DataFrame, workspace: Workspace, ratio: int = 10, letters_least: int = 7, least: int = 2) -> DataFrame:
    """Words of ``doc_id`` and ``text`` with the form each is taken to be a variant of.

    Returns ``word``, ``form`` (of the words one edit away the one of largest ``n``, ties to the first in code-point order, if it occurs
    ``ratio`` times as often at least; else null), ``root`` (the last of the forms of forms; the word itself without one), ``n``, ``n_near``
    (words one edit away) and ``form_n``.

    Null and empty texts hold no words; a null ``doc_id`` counts as empty text in the hash; repeated rows count as often as
    they stand there; other columns are ignored. Without words the result is empty.
    """
    words = workspace.write(word_counts(docs, letters_least, least), "words")
    nears = near_words(words, workspace).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    takes = -F.col("best.less") >= ratio * F.col("n")
    told = workspace.write(words.join(nears, "word", "left").select(
        "word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, -F.col("best.less")).alias("form_n")), "variants")
    # counts grow by the ratio with each form, so the most frequent one bounds how long a chain can be
    top = told.agg(F.max("form_n")).first()[0]
    longest = int(math.log(top / least, ratio) + 1e-9) if top else 0
    ends = roots(told.where("form IS NOT NULL"), workspace, longest)
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
