"""Vector operators against brute force in whole numbers and in other precisions."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from shelfline.llm import pivots, registry, whitening
from shelfline.llm.common import prepare

from ..conftest import DATA

NAN, INF = float("nan"), float("inf")


def some(seed, n, dims):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [[c + rng.gauss(0, 0.3) for c in centres[i % 5]] for i in range(n)]


#: Vectors with nulls, non-finite and missing components, ties, repeated ids and rows, another length.
ROWS = [
    (1, None, 1), (2, [], 1), (3, [1.0, NAN, 0.0, 0.0, 1.0, 2.0], 1), (4, [1.0, INF, 0.0, 0.0, 1.0, 2.0], 1), (5, [1.0, None, 0.0, 0.0, 1.0, 2.0], None),
    *((10 + i, v, i % 3 if i % 4 else None) for i, v in enumerate(some(1, 120, 6))), (12, some(1, 120, 6)[2], 2), (12, some(1, 120, 6)[2], 2), (None, some(2, 1, 6)[0], None),
    (11, some(3, 1, 6)[0], 1), (200, [1.0, 2.0], 1), (201, [0.0] * 6, 1), (202, [0.0] * 6, 2),
]


def whole(rows):
    return [r for r in rows if r[1] and len(r[1]) == 6 and all(x is not None and math.isfinite(x) for x in r[1])]


@pytest.fixture(scope="module")
def table(spark):
    prepare(spark)
    return spark.createDataFrame([(i, v, g, "q") for i, v, g in ROWS], "vec_id bigint, embedding array<double>, label int, error string").repartition(4).cache()


def lloyd(rows, parts, entries, rounds):
    """Codes and errors by comparing every part with every entry."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-6 // parts)
    cut = lambda v: [[math.floor(256 * x) for x in v + [0.0] * (parts * width - 6)][j * width : (j + 1) * width] for j in range(parts)]
    x = [cut(v) for _, v, _ in rows]
    books = [[x[i][j] for i in range(min(entries, len(x)))] for j in range(parts)]
    near = lambda p, book: min((sum((a - b) ** 2 for a, b in zip(p, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for j in range(parts):
            groups = defaultdict(list)
            for v in x:
                groups[near(v[j], books[j])[1]].append(v[j])
            books[j] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[j])]
    found = [[near(v[j], books[j]) for j in range(parts)] for v in x]
    labels = defaultdict(int)
    for (_, _, g), f in zip(rows, found, strict=True):
        labels[g] += sum(d for d, _ in f)
    return Counter((i, g, bytes(k for _, k in f), sum(d for d, _ in f), labels[g]) for (i, _, g), f in zip(rows, found, strict=True)), books


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(3, 16, 2), (2, 5, 4), (4, 256, 1), (6, 64, 2)])
@pytest.mark.parametrize("small", [True, False])
def test_codes(table, monkeypatch, parts, entries, rounds, small):
    if not small:
        monkeypatch.setattr(pivots, "is_small", lambda df: False)
    coded, books = pivots.compress(table, parts=parts, entries=entries, rounds=rounds)
    want, want_books = lloyd(whole(ROWS), parts, entries, rounds)
    assert Counter((r.vec_id, r.label, bytes(r.codes), r.error, r.label_error) for r in coded.collect()) == want
    assert books.tolist() == want_books
    text = ",".join(str(x) for book in want_books for e in book for x in e)
    assert pivots.book_hash(books) == hashlib.sha256(text.encode()).hexdigest()


def test_bounds_prune_and_are_never_too_high():
    rng = np.random.default_rng(4)
    x, entries = rng.integers(-3000, 3000, (500, 4)), rng.integers(-3000, 3000, (64, 4))
    entries[40] = entries[3]  # a tie goes to the first
    for count in (1, 2, 5):
        fixed = pivots.choose_pivots(entries, count)
        far = lambda a, b: np.sqrt(pivots.squares(a[:, None], b[None])).astype(np.float32)
        index, found, evaluated = pivots.nearest(x, far(x, fixed), entries, far(entries, fixed))
        full = pivots.squares(x[:, None], entries[None])
        assert (index == full.argmin(axis=1)).all() and (found == full.min(axis=1)).all()
        assert evaluated < full.size * {1: 0.9, 2: 0.7, 5: 0.5}[count]  # evenly spread points: the hard case


def test_codes_of_extremes(spark):
    big = spark.createDataFrame([(1, [3e38, -3e38], 1), (2, [1e5, 0.5], 1), (3, [0.1, -0.1], None)], "vec_id bigint, embedding array<double>, label int")
    rows = {r.vec_id: r for r in pivots.compress(big, parts=2, entries=2, rounds=1)[0].collect()}
    assert len(rows) == 3 and all(r.error >= 0 for r in rows.values())
    assert pivots.compress(big.limit(0))[0].count() == pivots.compress(big.filter("vec_id = 9"))[0].count() == 0


def exact_moments(x):
    n, dims = len(x), len(x[0])
    s = [sum(v[i] for v in x) for i in range(dims)]
    return s, [[Fraction(n * sum(v[i] * v[j] for v in x) - s[i] * s[j], n * n) for j in range(dims)] for i in range(dims)]


def test_whitening(table):
    rows = whole(ROWS)
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in rows]
    s, cov = exact_moments(x)
    n = len(x)
    got = whitening.whiten(table, components=4).collect()
    assert len(got) == 4 * n and {r.component for r in got} == {1, 2, 3, 4} and {r.n for r in got} == {n}
    want = Counter((i, sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True))) for (i, _, _), v in zip(rows, x, strict=True))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == want
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    centred = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(v, s, strict=True)] for v in x])
    for k in range(1, 5):
        white = centred @ vectors[:, -k] / math.sqrt(values[-k])
        mine = sorted(r.whitened for r in got if r.component == k)
        assert np.allclose(mine, np.sort(white), atol=1e-9) or np.allclose(mine, np.sort(-white), atol=1e-9)
        e = next(r.explained for r in got if r.component == k)
        assert {r.explained for r in got if r.component == k} == {e} and e == pytest.approx(values[-k] / values.sum(), rel=1e-12)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_of_few_and_flat_rows(spark, table):
    assert whitening.whiten(table.limit(0)).count() == whitening.whiten(table.filter("vec_id = 2")).count() == 0
    one = whitening.whiten(table.filter("vec_id = 20")).collect()
    assert len(one) == 6 and all(r.whitened == r.explained == r.deviation == r.identity_error == 0 for r in one)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(10)], "vec_id bigint, embedding array<double>")
    rows = whitening.whiten(line).collect()
    assert {r.component: r.explained for r in rows} == {1: pytest.approx(1.0), 2: 0.0, 3: 0.0} and rows[0].identity_error < 1e-9
    assert all((r.whitened == 0) == (r.component > 1) for r in rows)
    huge = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4e9])], "vec_id bigint, embedding array<double>")
    assert len(whitening.whiten(huge).collect()) == 6


def reflected(values, seed):
    """A symmetric matrix with these eigenvalues and its eigenvectors, exact up to the last rounding."""
    rng = random.Random(seed)
    d = len(values)
    u = [rng.randint(-9, 9) or 1 for _ in range(d)]
    norm = sum(c * c for c in u)
    q = [[Fraction(int(i == j)) - Fraction(2 * u[i] * u[j], norm) for j in range(d)] for i in range(d)]
    a = [[sum(q[i][k] * values[k] * q[j][k] for k in range(d)) for j in range(d)] for i in range(d)]
    exact = lambda f: np.longdouble(f.numerator) / np.longdouble(f.denominator) if abs(f.numerator) < 2**60 > f.denominator else np.longdouble(str(f.numerator)) / np.longdouble(str(f.denominator))
    return np.array([[exact(v) for v in row] for row in a]), np.array([[exact(v) for v in row] for row in q])


@pytest.mark.parametrize("values", [
    [Fraction(9), Fraction(7), Fraction(4), Fraction(1), Fraction(1, 3)],
    [Fraction(5), 5 - Fraction(1, 10**7), 5 - Fraction(2, 10**7), Fraction(1), 1 + Fraction(1, 10**5), Fraction(1, 2)],
    [Fraction(3) + Fraction(k, 10**10) for k in range(4)] + [Fraction(1, 10**3), Fraction(2)],
    [Fraction(4), Fraction(4), Fraction(4), Fraction(2), Fraction(1, 7)],
    [Fraction(0), Fraction(0), Fraction(1), Fraction(2), Fraction(3)],
])
def test_refined_eigenvectors(values):
    a, q = reflected(values, len(values))
    found, x = whitening.eigenvectors(a)
    order = sorted(range(len(values)), key=lambda k: -values[k])
    want = np.array([float(values[k]) for k in order])
    assert np.allclose(found.astype(float), want, rtol=1e-16 * 50, atol=1e-17)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17 * 4 * float(abs(want).max())
    for at, k in enumerate(order):
        gap = min(abs(values[k] - v) for j, v in enumerate(values) if j != k)
        if gap:  # a single eigenvalue has one direction
            assert 1 - abs(float(q[:, k] @ x[:, at])) < 1e-15 and np.abs(np.abs(q[:, k]) - np.abs(x[:, at])).max() < 1e-17 * max(40.0, 4 / float(gap))


def test_whitening_query(spark):
    rows = registry.queries()["op13_whiten"](spark, f"{DATA}/sf0.001").collect()
    import pyarrow.parquet as pq

    stored = pq.read_table(f"{DATA}/sf0.001/embeddings.parquet").to_pydict()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in stored["embedding"]]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert len(rows) == 8 * n and rows[0].identity_error < 1e-9
    deviation = {i: sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in zip(stored["vec_id"], x, strict=True)}
    assert {r.vec_id: r.deviation for r in rows} == deviation
    values, vectors = np.linalg.eigh(np.cov(np.array(x, dtype=float).T, bias=True))
    white = ((np.array(x, dtype=float) - np.array(s) / n) @ vectors[:, ::-1][:, :8]) / np.sqrt(values[::-1][:8])
    mine = np.zeros_like(white)
    at = {i: k for k, i in enumerate(stored["vec_id"])}
    for r in rows:
        mine[at[r.vec_id], r.component - 1] = r.whitened
    assert np.allclose(np.abs(mine), np.abs(white), atol=1e-8)
