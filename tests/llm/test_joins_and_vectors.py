"""Similarity join, vector codes and centroid clusters against brute force, with their odd cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from spellcast.llm import centroid_clusters, gnat, queries, signature_join, vector_codes
from spellcast.llm.text import long_lists, mixed, set_lists, shingles

NAN, INF = float("nan"), float("inf")


def prose(n, seed, letters="abcdefghij"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))


def edited(text, every, mark):
    return " ".join(f"{w}{mark}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def shingled(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def joined(rows):
    """component_id of every row, by comparing all pairs."""
    sets = [shingled(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            one_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if a and b and (one_id or 100 * len(a & b) >= 80 * len(a | b)):
                group[top(i)] = top(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None) if sets[i] else doc))
    return sorted(out, key=repr)


LONG, MID, SHARED = prose(3000, 1), prose(150, 2), prose(60, 3)
TEXTS = [
    (10, LONG), (11, edited(LONG, 60, "x")), (12, edited(LONG, 22, "x")), (13, edited(LONG, 60, "y").upper()),
    (20, MID), (21, edited(MID, 75, "x")), (22, MID + " " + prose(30, 4)), (23, MID + " " + prose(60, 5)), (24, MID), (None, MID),
    (30, None), (31, ""), (32, " \n\t"), (33, "one two"), (34, "One  two"), (35, "one two three four five six seven eight"),
    (36, "one two three four five six seven eight nine"), (37, "one two three four five six seven"),
    (40, SHARED + " " + prose(10, 6)), (41, SHARED + " " + prose(10, 7)), (42, SHARED + " " + prose(4, 8)), (43, SHARED),
    (50, prose(100, 9)), (50, prose(80, 10)), (51, prose(80, 10)), (52, edited(prose(100, 9), 90, "z")), (50, prose(100, 9)),
    (None, prose(90, 11)), (None, edited(prose(90, 11), 85, "q")), (60, "word " * 500), (61, "word " * 20),
]


def test_join_equals_all_pairs(spark):
    rng = random.Random(3)
    base = [prose(n, 100 + n) for n in (6, 9, 14, 25, 60, 200)]
    more = [(1000 + i, " ".join(w if rng.random() > rate else w + "k" for w in rng.choice(base).split())) for i, rate in enumerate([0, 0.005, 0.01, 0.03] * 20)]
    rows = TEXTS + more
    frame = spark.createDataFrame([(i, t, "x", 7, 8) for i, t in rows], "doc_id long, text string, node string, n long, sig long")
    got = [tuple(r) for r in signature_join.components(frame).collect()]
    assert sorted(got, key=repr) == joined(rows)


def test_join_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    out = signature_join.components(frame)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


@pytest.mark.parametrize("n", [4, 5, 7, 12, 20, 45, 46, 110, 400, 2500])
def test_similar_sets_share_a_signature(n):
    rng = np.random.default_rng(n)
    for trial in range(60 if n < 500 else 8):
        b = n + int(rng.integers(0, signature_join.partner(n) - n + 1))
        most = signature_join.differences(n, b)
        gone = (most - (b - n)) // 2  # of each set, besides the surplus of the larger one
        pool = mixed(np.arange(n + b, dtype=np.uint64) + np.uint64(trial * 100000), 9)
        one, two = pool[:n], np.concatenate([pool[gone:n], pool[n : n + b - n + gone]])
        shared = n - gone
        assert len(two) == b and 100 * shared >= 80 * (n + b - shared)
        found, of = signature_join.signatures(np.concatenate([one, two]), np.array([len(one), len(one) + len(two)]))
        assert np.intersect1d(found[of == 0], found[of == 1]).size


def test_unrelated_sets_share_no_signature():
    sizes = [5, 30] * 300
    found, of = signature_join.signatures(mixed(np.arange(sum(sizes), dtype=np.uint64), 5), np.cumsum(sizes))
    assert set(of.tolist()) == set(range(600))
    assert len(set(zip(found.tolist(), of.tolist()))) == len(set(found.tolist()))


def test_set_lists_equal_shingles():
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 4, n).astype(np.uint64) for n in (0, 1, 3, 4, 5, 6, 0, 40, 200, 0)] + [np.zeros(0, dtype=np.uint64)]
    for part in (rows, rows[:1], rows[7:8], []):
        values, ends = set_lists(long_lists(part), 5)
        got = np.split(values, ends[:-1]) if part else []
        assert [g.tolist() for g in got] == [shingles(r, 5).tolist() for r in part]


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_tree_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (256, 4))  # many ties and equal entries where the spread is small
    queries_ = np.concatenate([rng.integers(-spread, spread + 1, (500, 4)), entries[:50]])
    number, square = gnat.nearest(gnat.build(entries), entries, queries_)
    d = ((queries_[:, None, :] - entries[None]) ** 2).sum(-1)
    assert (number == d.argmin(1)).all() and (square == d.min(1)).all()


def test_tree_search_skips_subtrees(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.integers(-10**6, 10**6, (16, 8))
    entries = (centres[:, None, :] + rng.integers(-50, 50, (16, 16, 8))).reshape(-1, 8)
    tree, compared = gnat.build(entries), []
    plain = gnat.distances
    monkeypatch.setattr(gnat, "distances", lambda q, e: compared.append(len(q) * len(e)) or plain(q, e))
    gnat.nearest(tree, entries, entries + 1)
    assert sum(compared) < 256 * 256 / 3


def digest(values):
    return hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()


def codes_of(rows, scale, parts, size, rounds):
    good = [(i, label, v) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in good if len(v) % parts == 0]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    good = [r for r in good if len(r[2]) == len(good[0][2])]
    w = len(good[0][2]) // parts
    cut = [[r[2][p * w : p * w + w] for r in good] for p in range(parts)]
    books = [[list(v) for v in c[:size]] for c in cut]

    def nearest(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for v in cut[p]:
                mine.setdefault(nearest(books[p], v)[1], []).append(v)
            for k, vs in mine.items():
                books[p][k] = [sum(x) // len(vs) for x in zip(*vs)]
    out = []
    for r, row in enumerate(good):
        found = [nearest(books[p], cut[p][r]) for p in range(parts)]
        out.append((row[0], row[1], "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    totals = {}
    for _, label, _, e in out:
        totals[label] = totals.get(label, 0) + e
    flat = digest([x for b in books for e in b for x in e])
    return sorted(((i, c, e, totals[label], flat) for i, label, c, e in out), key=repr)


def vectors(width, n=400):
    rng = random.Random(width)
    rows = [(i, rng.choice([1, 2, None]), [rng.choice([-1, 1]) * rng.random() * (i % 7) for _ in range(width)]) for i in range(n, 0, -1)]
    same = [0.25] * width
    odd = [None, [], [None] * width, [NAN] + [0.0] * (width - 1), [INF] * width, [0.5] * (width + 4), [0.5] * 3]
    rows += [(1000 + k, 9, v) for k, v in enumerate(odd)] + [(2000 + k, 2, same) for k in range(30)]
    return rows + [(None, 1, same), (7, 2, [-0.1] * width), (7, None, [0.1] * width), (7, None, [0.1] * width)]


def test_vector_codes_equal_brute_force(spark, tmp_path):
    rows = vectors(64)
    frame = spark.createDataFrame([(i, label, v, "x", 1) for i, label, v in rows], "vec_id long, label int, embedding array<double>, part string, v int")
    frame.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in queries.op12_vector_codes(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == codes_of(rows, 1024, 4, 256, 4)


def test_codes_decode_to_their_entries(spark):
    frame = spark.createDataFrame([(i, 0, [float(i % 3)] * 8) for i in range(20)], "vec_id long, label int, embedding array<float>")
    coded, books = vector_codes.compress(frame)
    for r in coded.collect():
        assert vector_codes.decode(r.codes, books).tolist() == [1024 * (r.vec_id % 3)] * 8 and r.error == 0


def test_vector_operators_on_an_empty_table(spark, tmp_path):
    for k, rows in enumerate(([], [(1, 1, None)])):
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        for query in (queries.op12_vector_codes, queries.op13_centroid_clusters):
            assert query(spark, f"{tmp_path}/{k}").count() == 0


def clusters_of(rows):
    good = [(i, [math.floor(64 * x) for x in v]) for i, _, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:16]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(3):
        mine = {}
        for _, v in good:
            mine.setdefault(nearest(v)[1], []).append(v)
        for k, vs in mine.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in good]
    inertia = {}
    for _, d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digest(centroids[k])) for i, d, k in found), key=repr)


def test_clusters_equal_brute_force(spark, tmp_path):
    rows = vectors(64) + [(3000 + k, 5, [100.0 * (k % 4), 2000.0] + [0.0] * 62) for k in range(40)]
    frame = spark.createDataFrame([(i, label, v, "x", 1.5) for i, label, v in rows], "vec_id long, label int, embedding array<double>, cluster string, bound double")
    frame.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in queries.op13_centroid_clusters(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == clusters_of(rows)


def test_bounds_spare_scans(spark):
    rng = random.Random(8)
    centres = [[rng.uniform(-50, 50) for _ in range(64)] for _ in range(16)]
    rows = [(i, [x + rng.gauss(0, 1) for x in centres[i % 16]]) for i in range(800)]
    out = centroid_clusters.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert out.filter("not scanned").count() > 400


def test_planar_bound_holds_and_beats_the_drift():
    rng = np.random.default_rng(4)
    less = 0
    for _ in range(300):
        c, a = rng.normal(0, 10, (2, 5))
        b, radius = a + rng.normal(0, 3, 5), rng.uniform(0, 8)
        bound, move = centroid_clusters.nearer_by(a, b, c, radius), np.linalg.norm(a - b)
        x = rng.normal(size=(2000, 5))
        x = c + radius * x / np.linalg.norm(x, axis=1)[:, None] * rng.uniform(0, 1, (2000, 1)) ** 0.2
        nearer = np.linalg.norm(x - a, axis=1) - np.linalg.norm(x - b, axis=1)
        assert nearer.max() <= bound + 1e-9 and bound <= move * (1 + 1e-8)
        less += bound < move * 0.99
    assert less > 150
