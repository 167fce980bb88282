"""Licence scans, vector codes and spelling variants against brute force and SQL, and on odd inputs."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_module
from ledgerloom.llm import license_scan, spelling, vector_codes
from tests.llm.test_operators import FOLDER, ODD, frame
from tests.parity import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_vector_codes", "op13_spelling_variants"])
def test_query_equals_sql(spark, name):
    problem, _ = compare(spark, duck(FOLDER), FOLDER, name, entry_module.oracle_sql()[name])
    assert not problem


# licence scans

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def scan_brute(text):
    w, places, base, labels, score = words(text), [], set(), set(), 0.0
    for i, (label, body) in enumerate([*license_scan.PHRASES, *license_scan.NOTICES]):
        t, phrase = words(body), i < len(license_scan.PHRASES)
        hits = {(p - q, q) for p in range(len(w) - 1) for q in range(len(t) - 1) if w[p:p + 2] == t[q:q + 2]}
        needed = len(t) - 1 - (0 if phrase else 2 * (len(t) // license_scan.EDIT_EVERY))
        for d in {d for d, _ in hits}:
            covered = len({q for x, q in hits if abs(x - d) <= (0 if phrase else license_scan.DRIFT)})
            score = max(score, covered / (len(t) - 1))
            if covered >= needed:
                labels.add(label)
                if phrase:
                    base.add(label)
                    places.append(d)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


LONG_NOTICE = license_scan.NOTICES[1][1]
NOTICES = [
    "MIT License", "mit  LICENSE\nmit license apache license", "the MIT-License; GNU General Public License general public license",
    "general public domain license", "x " * 50 + LONG_NOTICE + " y" * 50, LONG_NOTICE.replace("charge", "any charge whatsoever"),
    LONG_NOTICE.replace("copy, modify, merge", "sell"), " ".join(LONG_NOTICE.split()[:20]), (LONG_NOTICE + "\n") * 3, "Licensed under CC BY-NC 4.0.",
    "licensed under CC-BY 4.0", "mit", "license mit", "mit license" * 400, "MİT license", "mit\x00license", "mit·license é mit license",
]


def test_license_scan_equals_brute_force(spark):
    texts = [*ODD, *NOTICES]
    got = {r.doc_id: tuple(r)[1:] for r in license_scan.scan(frame(spark, texts)).collect()}
    assert got == {i + 1: scan_brute(t) for i, t in enumerate(texts)}


def test_license_scan_keeps_repeated_rows_and_ids(spark):
    rows = [(1, NOTICES[0]), (1, NOTICES[0]), (1, NOTICES[1]), (1, None), (None, NOTICES[1]), (None, NOTICES[1]), (2, "")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == Counter((d, *scan_brute(t)) for d, t in rows)


def test_license_scan_of_a_very_long_text_and_none(spark):
    text = "filler words here " * 100_000 + "apache license" + " more filler" * 100_000
    row = license_scan.scan(frame(spark, [text])).collect()[0]
    assert (row.n_words, row.n_base, row.first_word, row.base_labels) == (500_002, 1, 300_000, "apache")
    assert license_scan.scan(frame(spark, ["x"]).where("false")).collect() == []


def test_license_scan_runs_no_python(spark):
    plan = license_scan.scan(frame(spark, NOTICES))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_license_spans_tell_where_a_notice_stands(spark):
    known = license_scan.templates(spark)
    text = "a b c " + LONG_NOTICE.replace("charge", "any charge whatsoever")
    spans = license_scan.license_spans(license_scan.votes(frame(spark, [text]), known), known).where("held").collect()
    assert [(r.label, 3 <= r.diagonal <= 5) for r in spans] == [("mit", True)]


# vector codes

def codes_brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, _, v in kept]
    seeds = {}
    for (i, _, v), c in zip(kept, cut):
        if i not in seeds or v < seeds[i][0]:
            seeds[i] = (v, c)
    order = sorted(seeds, key=lambda i: (i is None, i))[:entries]
    books = [[seeds[i][1][p] for i in order] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((far(c[p], y), e) for e, y in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        own = assigned()
        for p in range(parts):
            for e in range(len(order)):
                held = [c[p] for c, a in zip(cut, own) if a[p][1] == e]
                if held:
                    books[p][e] = tuple(sum(x) // len(held) for x in zip(*held))
    own = assigned()
    errors = [sum(d for d, _ in a) for a in own]
    by_label = Counter()
    for (_, label, _), e in zip(kept, errors):
        by_label[label] += e
    sha = vector_codes.fingerprint(np.array(books))
    return Counter((i, "".join(f"{e:02x}" for _, e in a), e, by_label[label], sha) for (i, label, _), a, e in zip(kept, own, errors))


VECTORS = "vec_id long, embedding array<float>, label int, code string, distance int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 1) for i, label, v in rows], VECTORS)


def test_vector_codes_equal_brute_force(spark, workspace):
    chance = np.random.default_rng(5)
    rows = [(int(i), [None, 1, 2][int(i) % 3], [float(x) for x in chance.integers(-6, 6, 32) / 512]) for i in chance.permutation(150)]
    rows += [(3, 1, rows[0][2]), (3, 1, rows[0][2]), (None, None, rows[1][2])]  # repeated ids and rows, a null id
    odd = [(900, 1, None), (901, 1, [None] * 32), (902, 2, [float("nan")] * 32), (903, 2, [float("inf")] + [0.0] * 31)]
    got = Counter(tuple(r) for r in vector_codes.codes(vectors(spark, rows + odd), workspace).collect())
    assert got == codes_brute(rows)
    few = [(7, None, [0.5] * 16), (5, 1, [-0.25] * 16), (6, 1, [-0.25] * 16)]
    assert Counter(tuple(r) for r in vector_codes.codes(vectors(spark, few), workspace).collect()) == codes_brute(few)
    # another length than most, a length that no part count divides, and the empty vector take no part
    mixed = few + [(1, 1, [0.5] * 32), (2, 1, [0.5] * 5), (4, 1, [])]
    assert Counter(tuple(r) for r in vector_codes.codes(vectors(spark, mixed), workspace).collect()) == codes_brute(few)


def test_vector_codes_of_no_rows_and_of_huge_components(spark, workspace):
    none = vector_codes.codes(vectors(spark, [(1, 1, None)]), workspace)
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes.codes(vectors(spark, [(1, 1, [1e30] * 16)]), workspace).collect()


def test_moved_entries_only_equal_a_full_scan():
    chance = np.random.default_rng(3)
    for _ in range(60):
        points, book = chance.integers(-4, 5, (200, 2)), chance.integers(-4, 5, (12, 2))
        code, distance = vector_codes.nearest_entries(points, book)
        moved = chance.random(12) < chance.random()
        after = np.where(moved[:, None], chance.integers(-4, 5, (12, 2)), book)
        got, want = vector_codes.reassigned(points, after, moved, code, distance), vector_codes.nearest_entries(points, after)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# spelling variants

def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_brute(rows):
    n = counted(rows)
    nears = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(x, key=lambda o: (-n[o], o)) for w, x in nears.items() if x}
    form = {w: x for w, x in best.items() if n[x] >= 10 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n[w], len(nears[w]), n.get(form.get(w))) for w in n}


def spelling_rows():
    chance = np.random.default_rng(8)
    stems = ["".join(chance.choice(list("abenrstéÀ"), size)) for size in (7, 8, 8, 9, 11, 30) for _ in range(4)]
    text = []
    for s in stems:
        text += [s] * int(chance.integers(2, 260))
        for _ in range(6):
            i = int(chance.integers(len(s)))
            text += [s[:i] + "x" + s[i:], s[:i] + s[i + 1:], s[:i] + "q" + s[i + 1:], s[::-1]] * int(chance.integers(1, 4))
    # a chain of forms: each word over ten times as frequent as the one before
    text += ["chainaaa"] * 4 + ["chainaab"] * 60 + ["chainabb"] * 900
    text = [text[i] for i in chance.permutation(len(text))]
    rows = [(i, " ".join(text[i * 40:(i + 1) * 40])) for i in range(len(text) // 40 + 1)]
    return rows + [(None, "Wordless WORDLESS wordless"), (None, None), (5, ""), (6, "a" * 20_000 + " " + "a" * 20_000), (6, "ÿÀ×÷çÿÀÿ ÿÀ×÷çÿÀÿ"), (7, "short x 12")]


@pytest.mark.parametrize("group", [spelling.GROUP_WORDS, 24])
def test_spelling_variants_equal_brute_force(spark, workspace, monkeypatch, group):
    """With small groups the words of one length are dealt over many leaves and cells."""
    rows = spelling_rows()
    df = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "doc_id long, text string, word string, n int")
    want = variants_brute(rows)
    assert any(r[2] != (r[1] or r[0]) for r in want)
    if group != spelling.GROUP_WORDS:
        monkeypatch.setattr(spelling.near_words, "__defaults__", (group, 64))
    got = spelling.spelling_variants(df, workspace).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_no_words_give_no_variants(spark, workspace):
    assert spelling.spelling_variants(frame(spark, [None, "", "ab cd"]), workspace).collect() == []


def test_tree_leaves_cut_space_and_prune_soundly():
    chance = np.random.default_rng(2)
    points = chance.integers(0, 4, (500, 32)).astype(np.int32)
    tree = spelling.CountTree(points, 10)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(500))
    homes = {int(i): leaf for leaf, who in tree.visits(points, 0, 0) for i in who}
    assert all(i in tree.members[leaf] for i, leaf in homes.items()) and len(homes) == 500
    queries = points.copy()
    queries[np.arange(500), chance.integers(0, 32, 500)] += 1  # the point is one lowered count away
    reached = {(int(i), leaf) for leaf, who in tree.visits(queries, 0, 1) for i in who}
    assert all((i, leaf) in reached for i, leaf in homes.items())


def test_packed_counts_never_miss_an_edit():
    chance = np.random.default_rng(4)
    for size in (7, 12, 90):
        a = chance.integers(97, 123, (400, size)).astype(np.uint8)
        b = a.copy()
        b[np.arange(400), chance.integers(0, size, 400)] = chance.integers(192, 256, 400)
        longer = np.insert(a, size // 2, chance.integers(97, 123), axis=1)
        pack = lambda rows: spelling.packed(spelling.letter_counts(rows))
        assert spelling._may_be_near(pack(b) - pack(a), True).all() and spelling._may_be_near(pack(longer) - pack(a), False).all()
        assert spelling.one_edit(a, b).all() and spelling.one_edit(a, longer).all() and not spelling.one_edit(a, a).any()
