import math
import random
from hashlib import sha256

import numpy as np
import pytest

from acadlake.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, entries=256, rounds=4, scale=1024):
    """The contract, one distance at a time: {(vec_id): (code, error, label_error)}, digest."""
    ok = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(ok[0][1]) // 4
    parts = [[r[1][p * width:(p + 1) * width] for r in ok] for p in range(4)]
    books = [[list(x) for x in part[:entries]] for part in parts]

    def assign(part, book):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book)) for x in part]

    for _ in range(rounds):
        for p in range(4):
            by = {}
            for x, (_, j) in zip(parts[p], assign(parts[p], books[p])):
                by.setdefault(j, []).append(x)
            for j, xs in by.items():
                books[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
    final = [assign(parts[p], books[p]) for p in range(4)]
    out = [(r[0], "".join(f"{final[p][k][1]:02x}" for p in range(4)), sum(final[p][k][0] for p in range(4)), r[2])
           for k, r in enumerate(ok)]
    by = {}
    for r in out:
        by[r[3]] = by.get(r[3], 0) + r[2]
    digest = sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(r[0]), r[1], r[2], by[r[3]]) for r in out), digest


@pytest.mark.parametrize("leaves", [1, 3, 256])
def test_trie_equals_all_distances(monkeypatch, leaves):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    for n, width, spread, entries in ((0, 3, 2, 4), (1, 1, 5, 1), (400, 4, 2, 16), (700, 5, 300, 64), (50, 3, 1 << 40, 7)):
        parts = np.unique(rng.integers(-spread, spread + 1, (n, width)), axis=0)
        book = rng.integers(-spread, spread + 1, (entries, width))
        code, error = codes.nearest(parts, book)
        want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book)) for x in parts]
        assert [(int(e), int(c)) for c, e in zip(code, error)] == want


def test_shared_prefixes_are_computed_once():
    """Fewer entry vectors than components: 1,000 leaves over 3 levels with 10 values each need 1,110."""
    parts = np.array([[a, b, c] for a in range(10) for b in range(10) for c in range(10)])

    class Counted(np.ndarray):
        made = 0

        def __sub__(self, other):
            out = np.asarray(self) - np.asarray(other)
            Counted.made += 1 if out.ndim == 1 else len(out)
            return out

    code, _ = codes.nearest(parts.view(Counted), np.array([[0, 0, 0], [9, 9, 9]]))
    assert len(code) == 1000 and Counted.made < 1200


def run(spark, rows, **args):
    coded, books = codes.vector_codes(spark.createDataFrame(rows, SCHEMA), **args)
    got = codes.with_label_error(coded).collect()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got), codes.codebooks_digest(books)


@pytest.mark.parametrize("entries,n", [(256, 40), (8, 300)])
def test_codes_against_plain_python(spark, entries, n):
    rng = random.Random(n)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, rng.uniform(-1, 1)]) for _ in range(8)], rng.choice([None, 0, 1]))
            for i in range(n)]
    rows += [(n + i, rows[0][1], 7) for i in range(n // 2)]         # a hot vector
    assert run(spark, rows, entries=entries) == plain(rows, entries)


def test_unused_entries_stay_and_ties_go_low(spark):
    # rows 0 and 1 are equal: entry 1 never wins, so it keeps its value
    rows = [(0, [0.0] * 4, 1), (1, [0.0] * 4, 1), (2, [1.0] * 4, 1), (3, [1.0] * 4, 1)]
    got, digest = run(spark, rows, entries=3)
    assert (got, digest) == plain(rows, 3)
    assert "01" not in {c[i:i + 2] for _, c, _, _ in got for i in (0, 2, 4, 6)}


def test_edge_rows(spark):
    inf = float("inf")
    rows = [(5, None, 1), (6, [1.0, None, 0.0, 0.0], 1), (7, [inf, 0.0, 0.0, 0.0], 1), (8, [float("nan")] * 4, 1),
            (1, [0.1, -0.2, 0.3, 0.4], None), (1, [0.1, -0.2, 0.3, 0.4], None), (None, [0.5, 0.5, -0.0001, 2.0], 2)]
    assert run(spark, rows) == plain(rows)
    odd = [(2, [1.0, 2.0, 3.0], 1), (3, [], 1), (4, [1.0] * 8, 1)]
    got, _ = run(spark, rows + odd)
    assert [r for r in got if r[1] is None] == [(str(i), None, None, None) for i in (2, 3, 4)]
    assert [r for r in got if r[1] is not None] == plain(rows)[0]
    assert run(spark, []) == ([], sha256(b"").hexdigest())


def test_very_large_components(spark):
    rows = [(0, [1e19, 0.0, -1e300, 1.0], 1), (1, [-1e19, 5.0, 1e300, 2.0], 1), (2, [0.0, 0.0, 0.0, 3.0], None)]
    got, _ = run(spark, rows, entries=1, rounds=1)
    assert len(got) == 3 and all(r[2] == codes.MOST_LONG for r in got[:2])


def test_other_columns(spark):
    from edge import with_clashes
    df = with_clashes(spark.createDataFrame([(0, [1.0] * 4, 1), (1, [2.0] * 4, 1)], SCHEMA))
    coded, _ = codes.vector_codes(df.withColumn("v", df["label"]).withColumn("part", df["label"]))
    assert coded.count() == 2
