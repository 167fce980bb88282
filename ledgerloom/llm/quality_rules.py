"""Quality rules on whole texts: repetition and length limits, then line labelling by Viterbi."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import narrowed, slices, tidy, utf8
from ledgerloom.llm.crf import Chain, fit, labelled_sample, weighted_share
from ledgerloom.llm.lines import line_tables

RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(chain: Chain | None, least_words: int, most_repeated: int, least_content: float):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found = line_tables(*utf8(piece.column("text")))
                failed = (found["n_words"] < least_words) | (100 * found["n_repeat_words"] > most_repeated * found["n_words"])
                labels = chain.viterbi(found["features"], found["first_line"]) if chain is not None else np.ones(len(found["length"]))
                share = weighted_share(labels, found["length"], found["first_line"])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *(pa.array(found[c].astype(np.int64)) for c in _COUNTS), pa.array(failed), pa.array(~failed & (share >= least_content)), pa.array(share)],
                    ["doc_id", *_COUNTS, "base_failed", "kept", "content_share"])
    return run


def judged(docs: DataFrame, labels: DataFrame, per_class: int = 2000, least_words: int = 20, most_repeated: int = 30, least_content: float = 0.5,
           lines: int = 250_000) -> DataFrame:
    """Counts of each text and whether it is kept.

    A text fails the base rules with fewer than ``least_words`` words or more than ``most_repeated``
    percent of them in 8-word windows found twice or more. Of the others, those are kept whose lines
    of content, by Viterbi decoding, hold ``least_content`` or more of the bytes. The chain learns
    from at most ``per_class`` documents and ``lines`` lines of each quality label (a bounded sample, documents
    whole), each label given to all the document's lines: boilerplate for 0, content for 1; without both labels all lines are content.

    Null text counts as empty: no words, so the base rules fail. Every row gives one row, whatever
    its ``doc_id``; other columns are ignored; an empty table gives an empty result.
    """
    chain = fit(labelled_sample(docs, labels, "quality", per_class, None, lines=lines))
    return narrowed(docs).mapInArrow(_judge(chain, least_words, most_repeated, least_content), RESULT)
