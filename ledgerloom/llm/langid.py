"""Language of a text: hashed byte n-grams, averaged embeddings and a linear softmax, in numpy.

As the softmax is linear, embeddings and weights multiply into one table of class scores for each hash bucket;
a text's scores are the mean of its n-grams' rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import narrowed, slices, utf8
from ledgerloom.llm.crf import fold

RESULT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
SIZES = (2, 3, 4)
BUCKETS = 1 << 14


def ngram_buckets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each n-gram size, the bucket of the n-gram at each byte; ``BUCKETS`` where it would leave its row."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    end = np.repeat(offsets[1:], np.diff(offsets))
    out = []
    for size in SIZES:
        value = np.full(len(low), size, np.uint32)
        for i in range(size):
            value *= np.uint32(0x01000193)
            value[:max(len(low) - i, 0)] ^= low[i:]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x85EBCA6B)
        out.append(np.where(np.arange(len(low)) + size <= end, value >> np.uint32(32 - 14), BUCKETS).astype(np.int32))
    return out


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Chance of each language for each row."""
        rows = len(offsets) - 1
        total, number = np.zeros((rows, len(self.langs))), np.zeros(rows)
        filled = np.flatnonzero(np.diff(offsets) > 0)
        for bucket in ngram_buckets(data, offsets) if len(filled) else ():
            total[filled] += np.add.reduceat(self.table[bucket], offsets[:-1][filled], axis=0)
            number[filled] += np.add.reduceat(bucket < BUCKETS, offsets[:-1][filled], dtype=np.int64)
        return _softmax((total / np.maximum(number, 1)[:, None] + self.bias) / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sampled text as n-gram counts: at most ``BUCKETS`` of them, whatever its length."""
    for batch in batches:
        for piece in slices(batch, "text"):
            data, offsets = utf8(piece.column("text"))
            found = ngram_buckets(data, offsets)
            ids, counts = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                held = np.bincount(np.concatenate([x[a:b] for x in found]), minlength=BUCKETS + 1)[:BUCKETS]
                used = np.flatnonzero(held)
                ids.append(used.astype(np.int32).tobytes())
                counts.append(held[used].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([piece.column("lang"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["lang", "ids", "counts"])


def train(langs: list[str], labels: np.ndarray, ids: list[np.ndarray], counts: list[np.ndarray], width: int = 16, epochs: int = 6,
          rate: float = 2.0, seed: int = 7, reject: float = 0.01) -> Model:
    """Stochastic gradient descent over small batches; a tenth is held back for temperature and threshold.

    The threshold is the confidence below which a share ``reject`` of the held-back texts fall.
    """
    chance = np.random.default_rng(seed)
    embed = chance.normal(0, 0.1, (BUCKETS, width))
    weights, bias = chance.normal(0, 0.3, (width, len(langs))), np.zeros(len(langs))
    order = chance.permutation(len(labels))
    back, kept = order[:len(order) // 10], order[len(order) // 10:]

    def means(rows):
        size = np.array([len(ids[r]) for r in rows])
        at = np.concatenate([ids[r] for r in rows])
        share = np.concatenate([counts[r] / max(counts[r].sum(), 1) for r in rows])
        owner = np.repeat(np.arange(len(rows)), size)
        out = np.zeros((len(rows), width))
        for d in range(width):
            out[:, d] = np.bincount(owner, embed[at, d] * share, len(rows))
        return out, at, share, owner

    for epoch in range(epochs):
        for start in range(0, len(kept), 32):
            rows = kept[start:start + 32]
            hidden, at, share, owner = means(rows)
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error /= len(rows)
            pull = error @ weights.T
            step = rate * (1 - epoch / epochs)
            weights -= step * hidden.T @ error
            bias -= step * 0.1 * error.sum(axis=0)
            for d in range(width):
                embed[:, d] -= 20 * step * np.bincount(at, pull[owner, d] * share, BUCKETS)
    table = np.zeros((BUCKETS + 1, len(langs)), np.float32)
    table[:-1] = embed @ weights
    temperature, least = 1.0, 0.0
    if len(back):
        scores = means(back)[0] @ weights + bias
        choices = np.geomspace(0.1, 5, 40)
        loss = [-np.log(_softmax(scores / t)[np.arange(len(back)), labels[back]] + 1e-12).mean() for t in choices]
        temperature = float(choices[int(np.argmin(loss))])
        least = float(np.quantile(_softmax(scores / temperature).max(axis=1), reject))
    return Model(langs, table, bias, temperature, least)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 19):
                letters = np.array([_has_letter(x) for x in piece.column("text").to_pylist()], bool)
                score, pred = np.zeros(piece.num_rows), ["und"] * piece.num_rows
                if model is not None:
                    chances = model.probabilities(*utf8(piece.column("text")))
                    best = chances.argmax(axis=1)
                    score = np.where(letters, chances[np.arange(len(best)), best], 0.0)
                    pred = [model.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())]
                rejected = ~letters | (score < (model.least if model else 1.0))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)],
                                                 ["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def identify(docs: DataFrame, per_lang: int = 500, held_out: int = 2, parts: int = 4) -> DataFrame:
    """The language of every text, with its calibrated chance.

    Learns from text and non-null ``lang`` of at most ``per_lang`` documents of each language (a
    bounded sample, those of least hash of their id), none in part ``held_out`` of the crc32 fold. ``lang_pred`` is
    ``und`` with score 0 where the text is null or has no letter; ``rejected`` also marks texts less
    certain than all but a hundredth of the texts held back in training.

    Every row gives one row, whatever its ``doc_id`` (null counts as not held out); columns other
    than ``doc_id``, ``text`` and ``lang`` are ignored; an empty table gives an empty result.
    Without any language to learn, all texts are ``und``.
    """
    known = narrowed(docs, F.col("lang").cast("string").alias("lang"))
    usable = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(fold("doc_id", parts) != held_out, F.lit(False)))
    langs = sorted(r.lang for r in usable.select("lang").distinct().collect())
    model = None
    if langs:
        picked = [usable.where(F.col("lang") == x).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_lang) for x in langs]
        ids = picked[0]
        for more in picked[1:]:
            ids = ids.unionByName(more)
        rows = usable.join(F.broadcast(ids.distinct()), "doc_id").select("lang", "text").mapInArrow(_counted, "lang string, ids binary, counts binary").collect()
        rows = [r for r in rows if len(r.ids)]
        if rows:
            rows.sort(key=lambda r: (r.lang, r.ids))
            model = train(langs, np.array([langs.index(r.lang) for r in rows]), [np.frombuffer(r.ids, np.int32) for r in rows], [np.frombuffer(r.counts, np.float32) for r in rows])
    marked = narrowed(docs, F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"))
    return marked.mapInArrow(_predict(model), RESULT)
