"""Document quality from line labels: marginals of a conditional random field, weighted by length."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import narrowed, slices, utf8
from ledgerloom.llm.crf import Chain, Sample, fit, fold, labelled_sample, weighted_share
from ledgerloom.llm.lines import line_tables

RESULT = "doc_id long, held_out boolean, score double, predicted int"


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibration(share: np.ndarray, labels: np.ndarray, frequent: float) -> tuple[float, float]:
    """Slope and offset that turn a share of good lines into the chance of label 1.

    Logistic regression by Newton's method on the sample, with rows weighted so that the labels are
    as frequent as among all labelled documents.
    """
    x = np.stack([_logit(share), np.ones(len(share))], 1)
    ones = max(labels.mean(), 1e-9)
    weight = np.where(labels == 1, frequent / ones, (1 - frequent) / max(1 - ones, 1e-9))
    b = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        b = b + np.clip(np.linalg.solve(curve, x.T @ (weight * (labels - p)) - 1e-2 * (b - [1, 0])), -2, 2)
    return float(max(b[0], 0.05)), float(b[1])


def _score(chain: Chain | None, slope: float, offset: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                if chain is None:
                    score = np.full(piece.num_rows, offset)
                else:
                    found = line_tables(*utf8(piece.column("text")))
                    good, _, _ = chain.marginals(found["features"], found["first_line"])
                    share = weighted_share(good, found["length"], found["first_line"])
                    score = 1 / (1 + np.exp(-(slope * _logit(share) + offset)))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 2000, threshold: float = 0.3, held_out: int = 0, parts: int = 5,
                   lines: int = 250_000) -> DataFrame:
    """Score every text for quality, from 0 to 1, higher for label 1.

    The chain learns from at most ``per_class`` documents and ``lines`` lines of each label (a bounded sample of
    labelled rows, documents whole), none of them in part ``held_out`` of the crc32 fold; each document's label is
    given to all its lines. A score is the length-weighted mean of the lines' marginals, calibrated
    on the same sample. Only the text is an input of it.

    Null text counts as empty and is scored like any other; a null ``doc_id`` gives ``held_out``
    false; repeated rows each give a row; other columns are ignored; an empty table gives an empty
    result. Without both labels in the sample every score is the share of label 1.
    """
    sample: Sample = labelled_sample(docs, labels, "quality", per_class, held_out, parts, lines)
    chain = fit(sample)
    slope, offset = 1.0, sample.share
    if chain is not None:
        good, _, _ = chain.marginals(sample.features, sample.first)
        slope, offset = calibration(weighted_share(good, sample.sizes, sample.first), sample.labels, sample.share)
    marked = narrowed(docs, F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"))
    return marked.mapInArrow(_score(chain, slope, offset, threshold), RESULT)
