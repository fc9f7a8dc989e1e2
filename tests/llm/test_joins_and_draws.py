"""The n-gram Jaccard join, embedding whitening and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from test_llm_operators import DOCS, ROWS, WHITE, got, order_of

from mediacurate.llm import importance, jaccard_join, queries, whitening


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# --- 11 ------------------------------------------------------------------------------


def plain_similar(rows, size=3, percent=90):
    sets, root, first = [], list(range(len(rows))), {}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, r in enumerate(rows):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        words = [w for w in low.translate(str.maketrans(WHITE, " " * 6)).split(" ") if w]
        sets.append(frozenset(" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))) if words else frozenset())
        if words:
            root[find(i)] = find(first.setdefault(sets[i], i))
    ordered = sorted(first.items(), key=lambda x: len(x[0]))
    for place, (a, i) in enumerate(ordered):
        for b, j in ordered[place + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr)


SIMILAR = ("doc_id", "n_shingles", "component_id")
SMALL = {"tile_bytes": 4000, "tile_sets": 3}


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_similar_groups(docs, nothing, limits):
    assert got(jaccard_join.similar_groups(docs, **limits), *SIMILAR) == plain_similar(ROWS)
    assert jaccard_join.similar_groups(nothing, **limits).count() == 0


def test_join_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert got(queries.op11_jaccard_join(spark, sf_dir), *SIMILAR) == plain_similar(rows)


def edited(draw, words, vocabulary, many):
    words = list(words)
    for _ in range(many):
        kind, at = draw.random(), draw.randrange(len(words))
        if kind < 0.4:
            words[at] = draw.choice(vocabulary)
        elif kind < 0.7:
            words.insert(at, draw.choice(vocabulary))
        elif len(words) > 1:
            words.pop(at)
    return words


@pytest.mark.parametrize("percent, limits", [(90, SMALL), (75, {})])
def test_copies_with_edits_and_a_passage_that_a_third_shares(spark, percent, limits):
    draw = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for n in [1, 2, 3, 5, 9, 10, 11, 12, 13, 15, 20, 22, 40, 80, 150, 400, 1500] * 2:
        base = [draw.choice(vocabulary) for _ in range(n)]
        texts += [edited(draw, base, vocabulary, draw.randint(0, max(1, n // 20))) for _ in range(10)]
    shared = [draw.choice(vocabulary) for _ in range(60)]
    texts += [shared + [draw.choice(vocabulary) for _ in range(tail)] for tail in (3, 4, 5, 12) for _ in range(45)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    draw.shuffle(rows)
    made = jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), percent=percent, **limits)
    assert got(made, *SIMILAR) == plain_similar(rows, percent=percent)


def test_sets_that_link_share_a_key():
    draw = np.random.default_rng(4)
    bands = jaccard_join.Bands(90)
    for n in [9, 10, 19, 30, 77, 500, 4000] * 30:
        whole = np.unique(draw.integers(0, 2**64, n, np.uint64))
        gone = draw.integers(0, n // 10 + 1)  # n - gone of n are shared
        part = np.sort(draw.permutation(whole)[gone:])
        if gone and 10 * len(part) >= 9 * n:
            assert np.intersect1d(bands.keys(whole), bands.keys(part)).size


def test_bits_that_differ_bound_the_overlap():
    draw = np.random.default_rng(5)
    for n in (5, 64, 300):
        pool = draw.integers(0, 2**64, 2 * n, np.uint64)
        a, b = (np.unique(draw.permutation(pool)[:n]) for _ in range(2))
        maps = jaccard_join.bitmaps(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 512)
        differ = int(np.bitwise_count(maps[0] ^ maps[1]).sum())
        assert (len(a) + len(b) - differ) // 2 >= len(np.intersect1d(a, b))


# --- 12 ------------------------------------------------------------------------------


def assert_whitened(made, rows, wanted=8):
    """``made`` against an eigendecomposition of the whole covariance."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    longest = max(len(v) for _, v in good)
    x = np.floor(1024 * np.array([[*v, *[0.0] * (longest - len(v))] for _, v in good])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    spread = (x * n - sums) / n
    values, vectors = np.linalg.eigh(spread.T @ spread / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    many = int(np.count_nonzero(values > 2.0**-40 * values[0]))
    found = made.collect()
    assert len(found) == n * many
    deviations = [sum(d * d for d in row) for row in (x * n - sums).tolist()]
    assert sorted(((r.vec_id, r.deviation) for r in found), key=repr) == sorted([(i, d) for (i, _), d in zip(good, deviations, strict=True)] * many, key=repr)
    for k in range(many):
        mine = [r for r in found if r.component == k + 1]
        assert all(r.n == n and r.identity_error < 1e-9 for r in mine)
        assert abs(mine[0].explained - values[k] / (spread**2).sum() * n) <= 1e-12
        want = spread @ vectors[:, k] / math.sqrt(values[k])
        signs = [sorted((r.vec_id if r.vec_id is not None else -1, round(sign * r.whitened, 6)) for r in mine) for sign in (1, -1)]
        wanted_rows = sorted((i if i is not None else -1, round(float(w), 6)) for (i, _), w in zip(good, want, strict=True))
        assert any(np.allclose([b for _, b in s], [b for _, b in wanted_rows], atol=2e-6) for s in signs)


def test_whitening_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    assert_whitened(queries.op12_whitening(spark, sf_dir), rows)


VECTORS = "vec_id bigint, embedding array<double>, x string, component int"


def test_whitening_of_edge_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.standard_normal(5) * [9, 3, 2, 1, 0.5]).tolist(), "a", 1) for i in range(60)]
    rows += [(60, None, "a", 1), (61, [1.0, None, 2.0], "a", 1), (62, [float("nan")], "a", 1), (63, [float("inf")] * 5, "a", 1)]
    rows += [(64, [], None, None), (65, [1.0, 2.0], None, None), (None, [0.0] * 5, None, None), (3, [1.0] * 5, None, None), *[(70, [2.0] * 5, "a", 1)] * 30]
    frame = spark.createDataFrame(rows, VECTORS).repartition(4)
    assert_whitened(whitening.whitened(frame), [r[:2] for r in rows])
    assert_whitened(whitening.whitened(frame, wanted=2), [r[:2] for r in rows], 2)
    flat = [(i, [float(i), 2.0 * i, 3.0]) for i in range(9)]
    assert_whitened(whitening.whitened(spark.createDataFrame(flat, "vec_id bigint, embedding array<float>")), flat)
    for some in ([], [(1, [1.0, 2.0], "a", 1)], [(1, [1.0], "a", 1), (2, [1.0], "a", 1)], [(1, None, "a", 1)], [(1, [], "a", 1)]):
        assert whitening.whitened(spark.createDataFrame(some, VECTORS)).count() == 0


def test_deviations_beyond_64_bits_are_null():
    assert whitening._deviations(np.array([[3, 4], [2**32, 2**32]])) == [25, None]


@pytest.mark.parametrize("spectrum", [[2.0**-i for i in range(60)], [50, 9, 9, 9, 9, 8.9999999, *[1 + i / 500 for i in range(194)]], [1.0] * 12, [5, 0, 0]])
def test_eigenpairs_to_double_precision(spectrum):
    size = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))[0]
    whole = turn @ np.diag(spectrum) @ turn.T
    passes = []
    values, vectors = whitening.eigenpairs(lambda v: passes.append(v.shape[1]) or whole @ v, size)
    want = sorted(spectrum)[::-1][:8]
    assert np.allclose(values, want, rtol=0, atol=1e-13 * want[0]) and np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-13)
    assert np.linalg.norm(whole @ vectors - vectors * values, axis=0).max() < 1e-12 * want[0] and len(passes) < 200


# --- 13 ------------------------------------------------------------------------------


def plain_draw(rows, items, buckets=10_000, longest=1, least=20, drawn=(10, 100)):
    def features(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(run.encode()) % buckets for run in runs]

    source, target = [0] * buckets, [0] * buckets
    each = [features(r[1]) for r in rows]
    for counts, texts in ((source, each), (target, map(features, items))):
        for _, found in texts:
            for f in found:
                counts[f] += 1
    many, wanted = sum(source), sum(target)
    gains = [math.floor(1000 * math.log((t + 1) * (many + buckets) / ((s + 1) * (wanted + buckets)))) for s, t in zip(source, target, strict=True)]
    out = []
    for r, (n_words, found) in zip(rows, each, strict=True):
        weight = sum(gains[f] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((n_words, r[0], len(found), weight, score))
    ranked = sorted((x for x in out if x[0] >= least), key=lambda x: (-x[4], order_of(x[1])))
    ranks = {id(x): i + 1 for i, x in enumerate(ranked[: drawn[0] * len(ranked) // drawn[1]])}
    return sorted(((*x[1:], ranks.get(id(x))) for x in out), key=repr)


DRAWN = ("doc_id", "n_features", "weight", "score", "rank")
ITEMS = ["alpha alpha beta", None, "", "Délta x1, x1! line of some length", "word"]


@pytest.mark.parametrize("longest, buckets, drawn, accuracy", [(1, 10_000, (10, 100), 10_000), (2, 70_000, (50, 100), 3), (1, 5, (1, 1), 10), (1, 7, (0, 1), 10)])
def test_resampling(spark, docs, nothing, longest, buckets, drawn, accuracy):
    target = spark.createDataFrame([(t, 1, 1) for t in ITEMS], "text string, at int, doc_id int")
    kind = {"buckets": buckets, "longest": longest, "drawn": drawn}
    made = importance.resampled(docs, target, accuracy=accuracy, least_words=3, **kind)
    assert got(made, *DRAWN) == plain_draw(ROWS, ITEMS, least=3, **kind)
    assert importance.resampled(nothing, target, **kind).count() == 0
    bare = importance.resampled(docs, target.limit(0), least_words=3, **kind)
    assert got(bare, *DRAWN) == plain_draw(ROWS, [], least=3, **kind)


def test_rows_alike_in_id_and_score_get_ranks_of_their_own(spark):
    rows = [(i % 5 if i % 3 else None, "same few words " * 10) for i in range(300)]
    made = importance.resampled(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), spark.createDataFrame([("same",)], "text string"), accuracy=5)
    assert sorted(r.rank for r in made.filter("rank IS NOT NULL").collect()) == list(range(1, 31))
    assert got(made, *DRAWN[:4]) == [x[:4] for x in plain_draw(rows, ["same"])]


@pytest.mark.parametrize("accuracy", [2, 10, 1000])
def test_bracket_holds_the_cutoff_however_coarse_the_sketch(spark, accuracy):
    draw = random.Random(accuracy)
    scores = [draw.randint(-50, 50) for _ in range(500)] + [7] * 300
    frame = spark.createDataFrame(list(zip(scores, range(800), range(800))), "score bigint, doc_id bigint, at bigint").repartition(3)
    ordered = sorted(zip(scores, range(800)), key=lambda x: (-x[0], x[1]))
    for wanted in (1, 80, 333, 800):
        lo, hi, above = importance.bracket(frame, 800, wanted, accuracy)
        assert above == sum(hi is not None and s > hi for s in scores) < wanted
        last = importance.cutoff(frame, 800, wanted, accuracy)
        assert (last.score, last.doc_id) == ordered[wanted - 1] and (lo is None or lo <= last.score)
