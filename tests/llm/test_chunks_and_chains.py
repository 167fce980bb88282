"""Chunked token counts of unbroken texts, and the chain of line labels against all labellings."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest

from ledgerloom.llm import crf, quality_crf, quality_rules, token_counts
from ledgerloom.llm.lines import WIDTH

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def spread_texts():
    rng = random.Random(5)
    letters = "abcdefghij漢字é0189.,-"
    run = lambda n: "".join(rng.choices(letters, k=n))
    words = lambda n: " ".join(run(rng.randint(1, 9)) for _ in range(n))
    return {
        "one run": run(60_000), "words": words(12_000), "words, then a run": words(300) + " " + run(50_000), "a run, then words": run(50_000) + " " + words(300),
        "runs between words": " ".join(run(rng.choice([3, 9000, 30_000])) for _ in range(8)), "one boundary": run(30_000) + " " + run(30_000),
        "blanks only": " " * 30_000, "double blanks": "  ".join(run(5) for _ in range(8000)), "line breaks": "\n".join(run(7) for _ in range(6000)),
        "space at the ends": " " + run(40_000) + " ", "empty": "",
    }


@pytest.mark.parametrize("chunk, overlap", [(1 << 14, 256), (512, 16), (64, 2)])
def test_chunked_counts_equal_the_library_and_encode_no_text_often(chunk, overlap):
    known = token_counts.tokenizer(BYTE_BPE)
    for name, text in spread_texts().items():
        encoded = []

        def offsets(piece):
            encoded.append(len(piece))
            return known.encode(piece, add_special_tokens=False).offsets

        assert token_counts.chunked_count(offsets, text, chunk, overlap) == len(known.encode(text, add_special_tokens=False)), name
        assert sum(encoded) <= 2.5 * len(text) + chunk, name


def test_chunks_whose_tokens_do_not_meet_are_widened():
    """A stand-in encoder whose chunks differ from the whole text until they are long enough on both sides."""
    text = "ab cd " * 2000

    def offsets(piece):
        return [(i, i + 1) for i in range(0 if len(piece) >= 2000 else 1, len(piece), 3)]

    assert token_counts.chunked_count(offsets, text, 512, 16) == len(text) // 3


def labellings(chain, features):
    """Score of every labelling of one sequence."""
    unary = features @ chain.weights
    out = {}
    for labels in itertools.product((0, 1), repeat=len(unary)):
        out[labels] = sum(u * y for u, y in zip(unary, labels)) + sum(chain.move[a, b] for a, b in zip(labels, labels[1:]))
    return out


def test_marginals_norm_moves_and_best_labels_equal_enumeration():
    rng = np.random.default_rng(2)
    chain = crf.Chain(rng.normal(size=3), rng.normal(size=(2, 2)))
    sizes = [1, 5, 10, 2, 7, 1, 3]
    first = np.concatenate(([0], np.cumsum(sizes)))
    features = rng.normal(size=(first[-1], 3))
    share, moves, norm = chain.marginals(features, first)
    best = chain.viterbi(features, first)
    want_moves = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        scores = labellings(chain, features[a:b])
        total = np.logaddexp.reduce(list(scores.values()))
        chance = {y: np.exp(s - total) for y, s in scores.items()}
        assert np.allclose(norm[a:b], total)
        assert np.allclose(share[a:b], [sum(p for y, p in chance.items() if y[i]) for i in range(b - a)])
        assert tuple(best[a:b]) == max(scores, key=scores.get)
        for y, p in chance.items():
            for pair in zip(y, y[1:]):
                want_moves[pair] += p
    assert np.allclose(moves, want_moves)


def test_equal_scores_choose_label_one():
    chain = crf.Chain(np.zeros(1), np.zeros((2, 2)))
    assert chain.viterbi(np.zeros((4, 1)), np.array([0, 4])).tolist() == [1, 1, 1, 1]


def test_training_follows_the_gradient_of_the_likelihood():
    rng = np.random.default_rng(4)
    first = np.array([0, 4, 9, 10])
    features = rng.normal(size=(10, 2))
    labels = rng.integers(0, 2, 10)

    def likelihood(values):
        chain = crf.Chain(values[:2], values[2:].reshape(2, 2))
        total = 0.0
        for a, b in zip(first[:-1], first[1:]):
            scores = labellings(chain, features[a:b])
            total += scores[tuple(labels[a:b])] - np.logaddexp.reduce(list(scores.values()))
        return total / len(labels) - 5e-4 * values @ values

    chain = crf.train(features, first, labels, rounds=2000, rate=0.02)
    found = np.concatenate([chain.weights, chain.move.ravel()])
    for i in range(6):
        step = np.zeros(6)
        step[i] = 1e-5
        assert abs(likelihood(found + step) - likelihood(found - step)) / 2e-5 < 2e-3


def test_budget_of_lines_passes_over_documents_that_do_not_fit():
    assert crf.within([3, 9, 4, 3, 1], 10) == [True, False, True, True, False]
    assert crf.within([], 5) == []


def test_sample_keeps_whole_documents_within_the_budget_of_lines(spark):
    good = "a fine line of plain words in a row"
    rows = [(i, "\n".join([good if i % 2 else "#*$ | <> &&"] * (5000 if i in (3, 4) else 6)), "clash") for i in range(1, 41)]
    docs = spark.createDataFrame(rows + [(41, None, ""), (42, "", "")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 43)], "doc_id long, quality int")
    found = crf.labelled_sample(docs, labels, "quality", 100, None, lines=90)
    sizes = np.diff(found.first)
    assert set(sizes.tolist()) <= {1, 6}
    for v in (0, 1):
        assert 84 <= sizes[found.labels == v].sum() <= 90
    assert found.features.shape == (sizes.sum(), WIDTH)
    everything = crf.labelled_sample(docs, labels, "quality", 100, None)
    assert len(everything.labels) == 42 and np.diff(everything.first).sum() == 2 * 5000 + 38 * 6 + 2
    scores = {r.doc_id: r.score for r in quality_crf.quality_scores(docs, labels, lines=90).collect()}
    assert len(scores) == 42 and scores[3] > 0.5 > scores[4]
    assert quality_rules.judged(docs, labels, lines=90).count() == 42
