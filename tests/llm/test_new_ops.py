"""Vector codes, periodic runs and the Jaccard join against plain Python and SQL."""

import hashlib
import json
import random
import zlib

import duckdb
import numpy as np
import pytest

from milldam.llm import codes, components, jaccard, queries, runs


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, name, sf):
    got = queries.QUERIES[name](spark, f"/root/testdata/{sf}")
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"create view {t} as select * from '/root/testdata/{sf}/{t}.parquet'")
    want = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())


# ---- vector codes ----------------------------------------------------------------------------------------------------


def plain_codes(rows, positions=16, entries=64, rounds=2):
    """rows (vec_id, vector of integers, label) -> codes, errors and books, in plain Python."""
    width = -(-max(len(v) for _, v, _ in rows) // positions)
    cut = [[tuple((list(v) + [0] * (positions * width))[p * width : (p + 1) * width]) for p in range(positions)] for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(positions)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(positions):
            held = {}
            for c in cut:
                held.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(x) // len(held[k]) for x in zip(*held[k], strict=True)) if k in held else e for k, e in enumerate(books[p])]
    best = [[near(c[p], books[p]) for p in range(positions)] for c in cut]
    return ["".join(f"{k:02x}" for _, k in b) for b in best], [sum(d for d, _ in b) for b in best], ",".join(str(x) for book in books for e in book for x in e)


def test_codes_are_the_plain_ones(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(7, rows[7][1], 3), (7, rows[8][1], 3), (None, rows[3][1], None), (900, [0.5] * 20, 1), (901, [], 1), (902, [-3e4] * 32, 2), (903, [9e6] * 32, 2)]
    rows += [(i, rows[0][1], 1) for i in range(1000, 1200)]  # a vector with many copies
    bad = [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 32, 1), (503, [float("inf")] * 32, 1)]
    df = spark.createDataFrame([(*r, "x", 0) for r in [*rows, *bad]], "vec_id long, embedding array<double>, label int, code string, n long").repartition(5)
    got = codes.compressed(df).collect()
    whole = [(i, [max(-(2**31), min(2**31 - 1, int(np.floor(x * 256)))) for x in v], label) for i, v, label in rows]
    want, errors, listed = plain_codes(whole)
    errors = [min(e, 2**63 - 1) for e in errors]
    sums = {}
    for (_, _, label), e in zip(whole, errors, strict=True):
        sums[label] = sums.get(label, 0) + e
    full = sorted((str(i), str(label), c, e, min(sums[label], 2**63 - 1)) for (i, _, label), c, e in zip(whole, want, errors, strict=True))
    assert sorted((str(r.vec_id), str(r.label), r.code, r.error, r.label_error) for r in got) == full
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(listed.encode()).hexdigest()}


def test_code_edges(spark):
    empty = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert codes.compressed(empty).count() == 0 and codes.compressed(empty.limit(0)).columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    one = codes.compressed(spark.createDataFrame([(1, [0.5] * 16, None)], "vec_id long, embedding array<float>, label int")).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00" * 16, 0, 0)]
    rows = [(i, [float(i % 50), 1.0], 0) for i in range(100)]
    two = codes.codebooks(codes.kept_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), "vec_id", "embedding", "label", 256), 2, 8, 4)
    plain = plain_codes([(i, [int(x * 256) for x in v], 0) for i, v, _ in rows], 2, 8, 4)[2]
    assert ",".join(map(str, two.ravel().tolist())) == plain


# ---- periodic runs -----------------------------------------------------------------------------------------------------


def plain_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.choice([0, 1, 5, 12, 30, 80, 150]), rng.choice([1, 2, 3, 50])
    w = [f"w{rng.randrange(k)}" for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 9)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.5:
            w[rng.randrange(n)] = "other"
    return w + w if rng.random() < 0.2 else w


def test_runs_and_extensions():
    rng = random.Random(1)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randint(1, 12))]
        assert [list(map(tuple, x.tolist())) for x in runs.runs(texts)] == [plain_runs(w) for w in texts]
        words, _ = runs.numbered(texts)
        if len(words) > 1:
            grammar = runs.Grammar(words)
            i = np.array([rng.randrange(len(words) - 1) for _ in range(40)])
            j = np.array([rng.randrange(x + 1, len(words)) for x in i])
            for ahead in (True, False):
                for a, b, got in zip(i, j, grammar.extension(i, j, ahead), strict=True):
                    step, n = (1, 0) if ahead else (-1, 0)
                    x, y = (a, b) if ahead else (a - 1, b - 1)
                    while 0 <= x and y < len(words) and words[x] == words[y]:
                        x, y, n = x + step, y + step, n + 1
                    assert got == n
    long = [[*("a b".split() * 5000)], ["x"] * 50000, [str(i % 777) for i in range(20000)]]
    assert [x.tolist() for x in runs.runs(long)] == [[[0, 10000, 2]], [[0, 50000, 1]], [[0, 20000, 777]]]


def test_runs_of_documents(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a " * 30, "A a " * 10, "é\x1ea " * 14, "z " * 11] + [" ".join(some_words(rng)) for _ in range(80)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in runs.op12_periodic_runs(spark, str(tmp_path)).collect()}
    changed = 0
    for i, text in enumerate(texts):
        w = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        found = plain_runs(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[i]
        assert (r.n_words, r.n_runs) == (n, len(found))
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest()
        kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n_ for s, n_, q in found)]
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()
    assert changed >= 5
    odd = spark.createDataFrame([(None, "a " * 12, "x"), (5, "a " * 12, "y")], "doc_id long, text string, n_runs string")
    assert [(r.n_runs, r.collapsed) for r in runs.periodic(odd).collect()] == [(1, "a")] * 2 and runs.periodic(odd.limit(0)).count() == 0


# ---- the Jaccard join --------------------------------------------------------------------------------------------------


def plain_groups(texts, ids=None):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    ids, up = ids or list(range(len(texts))), list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for k in range(len(texts)):
        if ids[k] is not None:
            least[root(k)] = min(least.get(root(k), ids[k]), ids[k])
    return [(ids[k], len(sets[k]), least.get(root(k)) if sets[k] else ids[k]) for k in range(len(texts))]


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_join_is_all_pairs(spark):
    """Near copies at the border, in small and in crowded groups, texts with a common passage, and short texts."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = [None, "", " \n", "one", "One", "one two", "a b c d e", "a b c d e f", "a b c d e f g"]
    for size in (8, 9, 12, 20, 40, 90, 200):
        base = [word() for _ in range(size)]
        texts += [edited(rng, base, rng.randrange(4)) for _ in range(6)] + [" ".join(base[k:]) for k in range(4)]
    base = [word() for _ in range(150)]
    texts += [edited(rng, base, rng.randrange(1, 6)) for _ in range(90)]  # every key is crowded
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(k % 40)] + passage + [word() for _ in range(k % 7)]) for k in range(70)]
    texts += [texts[20]] * 30
    want = plain_groups(texts)
    got = sorted(map(tuple, jaccard.grouped(frame(spark, texts)).collect()))
    assert got == sorted(want)
    roots = {r[2] for r in want}
    assert 60 < len(roots) < len(texts) - 100


def test_join_of_generated_pairs(spark):
    """One pair at each size, just under or over the border."""
    rng = random.Random(12)
    texts = []
    for n in list(range(5, 40)) + [64, 100, 333, 700]:
        base = [f"v{rng.randrange(10**7)}" for _ in range(n + 4)]
        keep = rng.choice([-(-8 * n // 10), 8 * n // 10 - 1])
        texts += [" ".join(base), " ".join(base[: keep + 4])]
    assert sorted(map(tuple, jaccard.grouped(frame(spark, texts)).collect())) == sorted(plain_groups(texts))


def test_join_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h", "o"), (3, "A b c d e f g h", "o"), (3, "a b c d e f g", "o"), (None, "only me here", "o"), (9, None, "o"), (9, "", "o")], "doc_id long, text string, key string")
    assert sorted(map(str, map(tuple, jaccard.grouped(df).collect()))) == sorted(map(str, [(None, 4, 3), (3, 4, 3), (3, 3, 3), (None, 1, None), (9, 0, 9), (9, 0, 9)]))
    assert jaccard.grouped(df.limit(0)).count() == 0 and json.dumps(jaccard.grouped(df).columns) == '["doc_id", "n_shingles", "component_id"]'


@pytest.mark.parametrize("hub", [1, 1 << 20])
def test_components_with_and_without_hubs(spark, hub):
    rng = random.Random(hub)
    edges = [(i, i + 1) for i in range(0, 40)] + [(200, x) for x in range(201, 260)] + [(x, 400) for x in range(300, 360)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(110)] + [(5, 5), (-3, 7), (7, -3), (-3, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    got = components.components(spark.createDataFrame(edges, "u long, v long").repartition(3), hub).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in root)
    assert components.components(spark.createDataFrame([(1, 1)], "u long, v long"), hub).count() == 0
