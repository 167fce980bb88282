"""The text operators against brute force, the libraries and held-out labels, and on odd inputs."""

import hashlib
import random
import re
import time
import types
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    ann, common, components, langid, line_dedup, ngram_join, packing, quality_crf, quality_rules, sentencepiece_bpe, suffix_dedup, token_counts,
)
from ledgerloom.llm.common import utf8
from ledgerloom.llm.units import UnitTable, cut_finer, strings, unit_ids, words
from tests.parity import duck

FOLDER = "/root/testdata/sf0.001"
BYTE_BPE, WORD_BPE, PIECE_BPE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions beside a frozen lake at dawn and nobody ever asks them why they do it there"
ODD = [
    None, "", " ", "\n\n", "a", "one two", PASSAGE, PASSAGE, PASSAGE + " indeed", "X " + PASSAGE + "\n" + PASSAGE, "ab " * 3000, "a" * 20000, "é漢字 😀\tΣΑΣ İ\x1cx",
    "▁ a ▁▁b <s> </s> <0x0A>", "x<|endoftext|>y  z \n lead", "don't we'll 12 345\n\nit's", "ends \n", "\nstarts", "line one is here\nline one is here\nother line",
    "#*$ | <> && %% " * 30, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(61)), "nul\x00byte\x00s",
]


def frame(spark, texts, first=1):
    rows = [(first + i, t, "en", "s", 0, "clash", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket string, kind int")


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


# line dedup

def line_brute(texts):
    lines = [(t.lower(), d, n) for d, text in sorted(texts.items()) if text for n, t in enumerate(l for l in text.split("\n")) if re.search(r"[^\x20\x09-\x0D]", t)]
    shingles = {t: {t[k:k + 8] for k in range(max(len(t) - 7, 1))} for t, _, _ in lines}
    names, union = list(shingles), Union()
    for i, a in enumerate(names):
        for j in range(i):
            x, y = shingles[a], shingles[names[j]]
            if 0.8 * max(len(x), len(y)) <= min(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                union.join(i, j)
    place = {a: union.find(i) for i, a in enumerate(names)}
    first, removed = {}, Counter()
    for t, d, n in lines:
        if first.setdefault(place[t], (d, n)) != (d, n):
            removed[d] += 1
    return removed


def test_line_dedup_equals_brute_force(spark, workspace, odd, docs):
    for df in (odd, docs.where("n_chars < 1500")):
        texts = texts_of(df)
        removed = line_brute(texts)
        for r in line_dedup.drop_near_lines(df, workspace).collect():
            assert r.n_removed == removed[r.doc_id], r
            assert (r.kept_text is None) == (texts[r.doc_id] is None)


def template_lines(pairs=40, singles=120):
    """Lines of one template, dissimilar (0.78) but for planted pairs (0.816), which mostly meet in bands of many others."""
    chance = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    prefix = "".join(chance.choice(letters, 85))
    codes = ["".join(letters[[c // 26, c % 26]]) for c in chance.permutation(26 * 26)]
    lines = [prefix + code + "".join(chance.choice(letters, 9)) for i, code in enumerate(codes[:pairs + singles]) for _ in range(2 if i < pairs else 1)]
    return [lines[i] for i in chance.permutation(len(lines))]


def test_line_dedup_links_members_that_are_no_neighbours(spark, workspace, monkeypatch):
    df = frame(spark, template_lines())
    removed = line_brute(texts_of(df))
    assert sum(removed.values()) >= 40
    for cell in (line_dedup.CELL, 7):
        monkeypatch.setattr(line_dedup, "CELL", cell)
        found = {r.doc_id: r.n_removed for r in line_dedup.drop_near_lines(df, workspace).collect()}
        assert {d: n for d, n in found.items() if n} == removed


def test_pairs_are_compared_by_sorted_rows(monkeypatch):
    """Rows of very different length, repeated values and the largest value, in tables no larger than twice their rows."""
    rng, cells, full = np.random.default_rng(4), [], np.full
    number = np.array([0, 1, 40_000, 0, *rng.integers(0, 90, 500), 3, 70_000])
    values = rng.integers(0, 50, number.sum()).astype(np.uint64)
    values[values == 7] = np.iinfo(np.uint64).max
    monkeypatch.setattr(np, "full", lambda shape, *more: cells.append(shape) or full(shape, *more))
    found = line_dedup.sorted_runs(values, number)
    edges = np.concatenate(([0], np.cumsum(number)))
    assert all((found[a:b] == np.sort(values[a:b])).all() for a, b in zip(edges, edges[1:]))
    assert sum(a * b for a, b in cells) <= 2 * len(values) and max(a * b for a, b in cells) <= max(1 << 16, number.max())
    lines = ["", "a", "abcdefgh", "ab" * 40, "ab" * 39 + "x", "h\u00e9 \u6f22\u5b57 " * 9, PASSAGE, PASSAGE + "!", PASSAGE[:40]]
    pairs = [(x, y) for x in lines for y in lines]
    batch = pa.RecordBatch.from_pylist([{"a": i, "b": -i, "text_a": x, "text_b": y} for i, (x, y) in enumerate(pairs)])
    grams = {x: {x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in lines}
    links = [i for i, (x, y) in enumerate(pairs) if 100 * len(grams[x] & grams[y]) >= 80 * len(grams[x] | grams[y])]
    assert [i for out in line_dedup._similar(8, 80)(iter([batch])) for i in out["a"].to_pylist()] == links


def test_rounds_of_components_write_few_files(spark, workspace):
    rows = [(i, i + 1) for i in range(300) if i % 10 < 9]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        near = components.components(spark.createDataFrame(rows, "a long, b long").repartition(8), workspace)
        assert {r.node: r.root for r in near.collect()} == {i: i - i % 10 for i in range(300) if i % 10}
        assert len(near.inputFiles()) <= 2
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_lines_of_a_long_text_are_cut_in_linear_time(spark, workspace):
    """A text of 200,000 lines that all repeat those of another."""
    lines = "\n".join(f"line number {i} of this text" for i in range(200_000))
    begun = time.monotonic()
    found = line_dedup._without(iter([pa.RecordBatch.from_pylist([{"doc_id": 2, "text": lines, "removed": list(range(0, 200_000, 2))},
                                                                  {"doc_id": 3, "text": None, "removed": None}, {"doc_id": 4, "text": "", "removed": None}])]))
    rows = [r for batch in found for r in batch.to_pylist()]
    assert time.monotonic() - begun < 10
    assert [(r["n_lines"], r["n_removed"]) for r in rows] == [(200_000, 100_000), (0, 0), (1, 0)]
    assert rows[0]["kept_text"] == "\n".join(lines.split("\n")[1::2]) and rows[1]["kept_text"] is None


def test_rows_that_pass_through_are_spread_over_buckets(spark, docs):
    """Each task has few of them, so they must not start at the same bucket in all."""
    many = docs.select("doc_id", "text").repartition(32)
    for signed, kind in ((many.mapInArrow(line_dedup._sign(8, 6, 20, 256), line_dedup._PACKED), line_dedup._LINES),
                         (many.mapInArrow(ngram_join._sign(5, 80, np.empty(0, np.uint64), 256), ngram_join._PACKED), ngram_join._SETS)):
        sizes = [r["count"] for r in signed.where(F.col("kind") == kind).groupBy("bucket").count().collect()]
        assert sum(sizes) >= 30 and max(sizes) <= 6


def packed(found, kind):
    """Columns of the packed rows of one kind."""
    rows = [r for batch in found for r in batch.to_pylist() if r["kind"] == kind]
    return list(zip(*(np.concatenate([np.frombuffer(r[c], np.int64) for r in rows] or [np.empty(0, np.int64)]).tolist()
                      for c in ("c0", "c1", "c2") if not rows or rows[0][c] is not None)))


def test_a_line_leaves_a_task_and_its_bucket_with_its_first_place():
    """A line in all documents, twice in some: one place to compare, the others removed at once, in any order of rows."""
    texts = [(d, f"the very common line\nown line number {d} of all" + "\nthe very common line" * (d % 2)) for d in (7, 3, 9, 4, 3)]
    batches = [pa.RecordBatch.from_pylist([{"doc_id": d, "text": x}]) for d, x in texts]
    signed = list(line_dedup._sign(8, 6, 20, 1)(iter(batches)))
    first, gone = packed(signed, line_dedup._FIRST), packed(signed, line_dedup._LINES)
    assert sorted(x[1:] for x in first) == [(3, 0), (3, 1), (4, 1), (7, 1), (9, 1)]
    # the rows of document 3 stand at one place
    assert sorted(gone) == [(3, 2), (3, 2), (4, 0), (7, 0), (7, 2), (9, 0), (9, 2)]
    met = line_dedup._meet()(pa.concat_tables([pa.Table.from_batches([b]) for b in 2 * signed])).to_batches()
    assert sorted(packed(met, line_dedup._FIRST)) == sorted(first) and sorted(packed(met, line_dedup._LINES)) == sorted(2 * gone)


def test_small_bands_are_compared_at_once():
    """All pairs of a band of up to eight lines, so none of them has to meet again; larger ones send their members."""
    sizes = (2, 4, 8, 9)
    sig, lines = np.repeat(np.arange(4), sizes).astype(np.uint32), np.arange(sum(sizes)) + (1 << 33)
    planes = [x.astype(t) for x, t in zip(ngram_join._planes(lines), (np.uint32, np.int32))]
    found = ngram_join._group(chain=True)(pa.Table.from_batches([ngram_join._row(ngram_join._SIGNATURES, 0, sig, *planes)])).to_batches()
    bands = np.split(lines, np.cumsum(sizes)[:-1])
    pairs = {(a, b) for band in bands[:3] for a in band.tolist() for b in band.tolist() if a < b}
    pairs |= {(bands[3][0], b) for b in bands[3][1:].tolist()} | set(zip(bands[3][1:].tolist(), bands[3][2:].tolist()))
    got = packed(found, ngram_join._PAIRS)
    assert len(got) == len(pairs) and set(got) == pairs
    assert sorted(x[1] for x in packed(found, ngram_join._MEMBERS)) == bands[3].tolist()


def test_more_links_join_components_through_their_roots(spark, workspace):
    near = components.components(spark.createDataFrame([(1, 5), (5, 9), (2, 6), (3, 7)], "a long, b long"), workspace)
    for more in ([(9, 6)], [(6, 7), (4, 9), (10, 11)], [(1, 2), (2, 3)]):
        whole = components.components(spark.createDataFrame([(1, 5), (5, 9), (2, 6), (3, 7), *more], "a long, b long"), workspace)
        found = line_dedup._joined(near, spark.createDataFrame(more, "a long, b long"), workspace)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_workers_keep_little_after_a_task(monkeypatch):
    """Each scan of texts gives memory back when its task ends; tables of powers are not kept for each length."""
    given, real = [], common.give_back
    monkeypatch.setattr(common, "give_back", lambda: (given.append(sum(x.nbytes for x in common._POWERS.values())), real()))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 0))
    batches = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": " ".join(f"word{i * j % 977}" for j in range(n))}]) for i, n in enumerate((10, 9_000, 20_000, 40_000))]
    scans = (quality_rules._judge(None, 20, 30, 0.5), line_dedup._sign(8, 6, 20, 4), line_dedup._texts, ngram_join._often(5, 0.002),
             ngram_join._sign(5, 80, np.empty(0, np.uint64), 4), suffix_dedup._find_anchors(100, 4), packing._pack(WORD_BPE, 2, 4096, 1 << 20, 1.0, 1 / 2048, False))
    for i, scan in enumerate(scans, 1):
        assert list(scan(iter(batches)))
        assert len(given) == i and not common._POWERS
    assert 0 < max(given) <= 2 * 8 << 19


# n-gram join

def set_of(text, lower=str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def join_brute(texts):
    sets, union = {d: set_of(t) for d, t in texts.items()}, Union()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                union.join(a, b)
    return {d: (len(s), union.find(d)) for d, s in sets.items()}


def near_copies(n=60):
    """Texts of 30 to 200 words and copies of them with a few words changed."""
    chance = np.random.default_rng(3)
    out = []
    for _ in range(n // 4):
        words = [f"t{x}" for x in chance.integers(0, 500, chance.integers(30, 200))]
        for changes in (0, 1, 2, 4):
            copy = list(words)
            for at in chance.integers(0, len(copy), changes):
                copy[at] = "changed"
            out.append(" ".join(copy))
    return out


def test_ngram_join_equals_brute_force(spark, workspace, odd):
    for df in (odd, frame(spark, near_copies())):
        for share in (0.002, 0.2):
            found, _ = ngram_join.similar_documents(df, workspace, common_share=share)
            assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == join_brute(texts_of(df))


def test_similar_sets_share_a_signature():
    chance, common = np.random.default_rng(5), np.empty(0, np.uint64)
    for size in [1, 2, 3, 5, 9, 17, 40, 100, 255, 300]:
        for _ in range(10):
            a = np.unique(chance.integers(0, 1 << 63, size).astype(np.uint64))
            drop = chance.integers(0, size // 9 + 1)
            b = np.unique(np.concatenate([a[drop:], chance.integers(0, 1 << 63, drop).astype(np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
                continue
            found, owner = ngram_join.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 80, common)
            assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())


def test_components_of_a_long_chain(spark, workspace):
    links = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(links, workspace).collect()
    assert {(r.node, r.root) for r in found} == {(i, 1) for i in range(2, 401)}


# suffix arrays

def repeats_brute(texts, length, raw=False):
    seen, out = set(), {}
    for d in sorted(texts):
        b = (texts[d] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(b[i:i + length])
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, kept if raw else hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, workspace, odd, docs):
    for df, split in ((odd, 2000), (odd, 1), (docs, 1)):
        want = repeats_brute(texts_of(df), 100)
        got = suffix_dedup.remove_repeats(df, workspace, split=split).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_no_large_group_of_contexts_meets_in_one_task(spark, workspace, monkeypatch):
    inner = suffix_dedup._suffix_arrays

    def watched(length, buckets):
        work = inner(length, buckets)

        def run(table):
            asks = np.frombuffer(b"".join(table["asks"].to_pylist()), np.int64)
            if len(asks) and np.unique(asks, return_counts=True)[1].max() > 10:
                raise ValueError("a large group in one task")
            return work(table)
        return run

    chance = np.random.default_rng(13)
    edges = ["".join(chance.choice(list("abcdefgh "), 150)) for _ in range(80)]
    df = frame(spark, [edges[2 * i] + PASSAGE[:110] + edges[2 * i + 1] for i in range(40)])
    monkeypatch.setattr(suffix_dedup, "_suffix_arrays", watched)
    got = suffix_dedup.remove_repeats(df, workspace, split=10).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == repeats_brute(texts_of(df), 100)


def test_marks_leave_tasks_and_groups_in_few_rows():
    buckets = 4096
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([PASSAGE] * 300, pa.string())], ["doc_id", "text"])
    sent = pa.Table.from_batches(list(suffix_dedup._find_anchors(100, buckets)(iter([batch]))))
    marks = sent.filter(pa.array(np.asarray(sent["kind"]) == 1))
    assert marks.num_rows == 1
    found = suffix_dedup._compare_contexts(2000, buckets)(sent)
    assert found.num_rows == 1
    coarse = pa.Table.from_batches(list(suffix_dedup._dealt(buckets, 8)(iter(found.to_batches()))))
    fine = pa.Table.from_batches(list(suffix_dedup._dealt(buckets, 1)(iter(coarse.to_batches()))))
    docs = [np.frombuffer(x, np.int64) for x in fine["c0"].to_pylist()]
    assert set(np.concatenate(docs).tolist()) == set(range(1, 300))
    for bucket, held in zip(fine["bucket"].to_pylist(), docs):
        assert set(((suffix_dedup._bucket_of(held) >> np.uint64(32)) % np.uint64(buckets)).tolist()) == {bucket}


def test_members_still_apart_meet_once_whatever_bands_they_share(spark, workspace):
    lines = {1: "the cat sat on the mat by the door", 2: "the cat sat on the mat by the doors", 3: "an entirely different line of text", 4: "the cat sat on the mat by the floor"}
    texts = workspace.write(spark.createDataFrame(list(lines.items()), "line long, text string"), "texts")
    bands = {10: [1, 2, 3], 11: [1, 2, 4], 12: [2, 1, 4, 3], 13: [3]}
    members = workspace.write(spark.createDataFrame([(n, m) for n, held in bands.items() for m in held], "name long, line long"), "members")
    near = spark.createDataFrame([(4, 1)], "node long, root long")
    got = [tuple(r) for r in line_dedup._still_apart(members, near, texts, workspace, 8, 80).collect()]
    assert len(got) == len(set(got)) and (1, 2) in got and (1, 4) not in got and set(got) <= {(1, 2), (2, 4), (1, 3), (2, 3), (3, 4)}


def test_repeats_of_rows_that_share_an_id(spark, workspace):
    texts = [(7, PASSAGE), (7, "b " + PASSAGE), (3, PASSAGE[5:]), (7, PASSAGE), (2, None), (2, ""), (None, PASSAGE), (9, PASSAGE[:130])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, workspace, split=1).collect()
    # as if the later rows of an id stood after all others: rows by place, then what each id has
    order = [(2, None), (3, PASSAGE[5:]), (7, "b " + PASSAGE), (9, PASSAGE[:130]), (2, ""), (7, PASSAGE), (7, PASSAGE)]
    want = repeats_brute(dict(enumerate(t for _, t in order)), 100)
    assert Counter(tuple(r) for r in got) == Counter((order[i][0], *row) for i, row in want.items())


def test_strings_that_overlap_or_touch_join_to_one_span():
    doc, pos = np.array([2, 1, 1, 1, 2]), np.array([0, 111, 0, 10, 101])
    assert [x.tolist() for x in suffix_dedup._merged(doc, pos, 100)] == [[1, 1, 2, 2], [0, 111, 0, 101], [110, 100, 100, 100]]


def test_interval_tree_has_all_occurrences():
    lcp = np.array([3, 5, 5, 0, 4])
    found = [(depth, first, last) for depth, first, last, _ in suffix_dedup.interval_tree(lcp, 3)]
    assert found == [(5, 1, 3), (3, 0, 3), (4, 4, 5)]


# packing

def test_packing_round_trip(odd, docs):
    known = token_counts.tokenizer(WORD_BPE)
    for df in (odd, docs):
        rows = packing.pack(df, WORD_BPE, with_ids=True, window=1 << 14).collect()
        pieces, places = defaultdict(dict), defaultdict(list)
        for r in rows:
            pieces[r.doc_id][r.start] = r
            places[r.sequence_id].append((r.offset, r.length))
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) and len(r.ids) == r.length
        for d, text in texts_of(df).items():
            ids = known.encode(text or "", add_special_tokens=False).ids + [2]
            assert [i for s in sorted(pieces[d]) for i in pieces[d][s].ids] == ids
            assert all(r.doc_tokens == len(ids) for r in pieces[d].values())
        for held in places.values():
            end = 0
            for offset, length in sorted(held):
                assert offset == end
                end += length
            assert end == 4096 or end & (end - 1) == 0


def test_packing_balances_cost():
    pieces = [(i, 0, n) for i, n in enumerate([3000, 2000, 1500, 1500, 1000, 900, 700, 600, 500, 400] * 4)]
    done, left = packing.fill(pieces, 4096, 1.0, 1 / 2048)
    assert sum(p[2] for p in left) < 4096 and all(sum(p[2] for p in s) == 4096 for s in done)


# tokenizers

def test_token_counts_equal_the_library(odd, docs):
    known = token_counts.tokenizer(BYTE_BPE)
    for df, sizes in ((odd, {"huge": 256, "chunk": 128, "overlap": 8}), (odd, {}), (docs, {"huge": 512, "chunk": 300, "overlap": 16})):
        texts = texts_of(df)
        for r in token_counts.token_counts(df, BYTE_BPE, **sizes).collect():
            n = len(known.encode(texts[r.doc_id] or "", add_special_tokens=False))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)


def test_sentencepiece_equals_the_library(odd, docs):
    library = sentencepiece_bpe.vocabulary(PIECE_BPE).library
    for df in (odd, docs):
        texts = texts_of(df)
        for r in sentencepiece_bpe.encode_decode(df, PIECE_BPE, texts=True).collect():
            ids = library.encode(texts[r.doc_id] or "", add_eos=True)
            assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


# classifiers

def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_crf.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_language_of_texts_of_a_few_bytes(spark):
    long = "some words of a long text " * 24_000
    for texts in (["a"], ["ok"], ["abc"], [long, "ok", long]):
        rows = langid.identify(frame(spark, texts).coalesce(1)).collect()
        assert sorted(r.doc_id for r in rows) == list(range(1, len(texts) + 1))


def test_quality_rules_count_as_defined(odd, docs, labels):
    for df in (odd, docs):
        texts = texts_of(df)
        for r in quality_rules.judged(df, labels).collect():
            text = texts[r.doc_id] or ""
            w = re.findall(r"[^\x20\x09-\x0D]+", text)
            windows, covered, seen, repeated = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set(), set(), 0
            for i in range(len(w) - 7):
                if windows[tuple(w[i:i + 8])] > 1:
                    covered.update(range(i, i + 8))
            for line in text.split("\n"):
                if re.search(r"[^\x20\x09-\x0D]", line):
                    repeated += line in seen
                    seen.add(line)
            failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
            assert tuple(r)[1:7] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed)
            assert not (failed and r.kept)


def test_clean_documents_are_kept(docs, labels):
    rows = quality_rules.judged(docs, labels).join(labels.where("quality = 1"), "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept for r in rows) >= 0.98 * len(rows)


# neighbours

def test_neighbours_recall_and_odd_vectors(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = vectors.collect()
    names, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in ann.nearest(vectors, shard=100, block=8).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hit = 0
    for i in np.flatnonzero(names % 20 == 0):
        scores = (x * x[i]).sum(1)
        scores[i] = -np.inf
        want = names[np.lexsort((names, -scores))[:20]].tolist()
        hit += len(set(want) & {v for v, _ in found[names[i]]})
        assert all(abs(s - (x[names == v][0] * x[i]).sum()) < 1e-12 for v, s in found[names[i]])
    assert hit >= 0.9 * 20 * len(found)
    odd = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [2.0, 0.0]), (8, []), (None, [1.0, 1.0]), (20, [0.0, 3.0])]
    got = ann.nearest(spark.createDataFrame(odd, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got if r.query_id == 0] == [(0, 1, 7, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 20, 0.0)]


# empty tables and the pipeline

def test_empty_tables(spark, workspace, docs, labels):
    none = docs.limit(0)
    for df in (
        line_dedup.drop_near_lines(none, workspace), ngram_join.similar_documents(none, workspace)[0], packing.pack(none, WORD_BPE), quality_crf.quality_scores(none, labels),
        sentencepiece_bpe.encode_decode(none, PIECE_BPE), suffix_dedup.remove_repeats(none, workspace), langid.identify(none), quality_rules.judged(none, labels),
        token_counts.token_counts(none, BYTE_BPE), ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert df.count() == 0


def test_sql_agrees(spark, docs, workspace):
    from ledgerloom.llm.queries import ORACLE_SQL
    con = duck(FOLDER)
    found, _ = ngram_join.similar_documents(docs, workspace)
    assert {tuple(r) for r in found.collect()} == set(con.execute(ORACLE_SQL["op2_ngram_jaccard_join"]).fetchall())


def test_pipeline_stages(spark, workspace, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "suffix-array dedup", "packing"]
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = workspace.write(stage(spark, held, FOLDER), "stage")
        assert after.columns == docs.columns
        assert 0 < after.count() <= held.count()
        if name == "suffix-array dedup":
            want = {d: v[3].decode("utf-8", "ignore") for d, v in repeats_brute(texts_of(held), 100, raw=True).items()}
            assert texts_of(after) == {d: t for d, t in want.items() if re.search(r"[^\x20\x09-\x0D]", t)}
        if name == "n-gram Jaccard join":
            assert {r.doc_id for r in after.collect()} == {d for d, (_, root) in join_brute(texts_of(held)).items() if d == root}
        held = after
    packed = corpus_pipeline.STAGES[-1][1](spark, held, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in held.select("doc_id").collect()}


def test_units_joined_by_a_mark_equal_single_ones():
    """The mark inside units, special strings, units longer than the table keeps, and a table that overflows."""
    known = token_counts.tokenizer(WORD_BPE)
    units = ["plain", "\x01", "a\x01b", "<|endoftext|>", "Ünïcode!?", "e\u0301", "x" * 500, "'s", "1234", "\u0301", "漢字"] * 20
    single = [np.array(x.ids, "<u4").tobytes() for x in known.encode_batch_fast(units, add_special_tokens=False)]
    assert unit_ids(known, units, " \x01 ") == single
    assert unit_ids(known, units[:1], " \x01 ") == single[:1] and unit_ids(known, [], " \x01 ") == []
    table = UnitTable(lambda u: unit_ids(known, u, " \x01 "), most=3)
    bounds = np.cumsum([0, *(len(u.encode()) for u in units)])
    for _ in range(2):
        held, edges = table(strings(np.frombuffer("".join(units).encode(), np.uint8), bounds), np.arange(len(units) + 1))
        assert [held[a:b].tobytes() for a, b in zip(edges, edges[1:])] == single
    assert max(map(len, table.known), default=0) <= table.longest


def test_units_that_recur_are_resolved_once():
    asked = Counter()

    def resolve(units):
        asked.update(units)
        return [u.encode() for u in units]

    table = UnitTable(resolve, most=100)
    for i in range(20):
        units = [f"often{j}" for j in range(20)] + [f"rare{i}-{j}" for j in range(20)]
        data, offsets = utf8(pa.array(units))
        held, bounds = table(strings(data, offsets), np.arange(len(units) + 1))
        assert [held[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])] == units
        assert len(table.known) + len(table.older) <= 100
    assert all(asked[f"often{j}"] == 1 for j in range(20))


def test_words_cut_at_punctuation_give_the_ids_of_the_library():
    known = token_counts.tokenizer(WORD_BPE)
    assert cut_finer(known) and not cut_finer(token_counts.tokenizer(BYTE_BPE))
    rng = random.Random(5)
    parts = ["a", "Zs", "re", "ll", "'", "''", ",", "=", "=\u0338", "<", "|", "<|endoftext|>", "<|endoftext|", "-", "\u0301", "\u00e9", "7", "\u2026", " ", "\n", "\x01", "\u03a3", "\u00a0", "_", "don't", "K\u212a", "\\"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    units, first = words(*utf8(pa.array(texts)), finer=True)
    assert len(units) > len(words(*utf8(pa.array(texts)))[0])
    held, bounds = UnitTable(lambda u: unit_ids(known, u, " \x01 "))(units, first)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert np.frombuffer(held[a:b], "<u4").tolist() == known.encode(text, add_special_tokens=False).ids, text


def test_pipeline_keeps_rows_of_repeated_and_null_ids(spark, workspace, docs, labels):
    kept = quality_rules.judged(docs, labels).where("kept").join(labels.where("quality = 1"), "doc_id", "left_semi")
    clean = docs.join(kept, "doc_id", "left_semi").orderBy("doc_id").limit(12).collect()
    rows = [tuple(r) for r in clean[:4]]
    id_at = docs.columns.index("doc_id")

    def under(r, doc_id):
        return (*tuple(r)[:id_at], doc_id, *tuple(r)[id_at + 1:])

    rows += [tuple(clean[0]), under(clean[4], clean[0].doc_id), under(clean[5], clean[0].doc_id), under(clean[6], None), under(clean[7], None), under(clean[7], None)]
    df = workspace.write(spark.createDataFrame(rows, docs.schema), "odd_ids")
    after = workspace.write(corpus_pipeline.quality(spark, df, FOLDER), "stage")
    texts = texts_of(after)
    assert len(texts) == after.count() == len(rows) and None not in texts
    assert Counter(texts.values()) == Counter(r[docs.columns.index("text")] for r in rows)
    assert {r[id_at] for r in rows if r[id_at] is not None} <= set(texts)
    removed = line_brute(texts)
    told = corpus_pipeline.lines(spark, after, FOLDER).collect()
    assert len({r.doc_id for r in told}) == len(told) == 8
    assert all(len(r.text.split("\n")) == len(texts[r.doc_id].split("\n")) - removed[r.doc_id] for r in told)
