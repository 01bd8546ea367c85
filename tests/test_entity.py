"""Fuzzy grouping (Q7) against the sequential brute force."""

import bruteforce as B
import pytest

from acadlake.operators.entity import fuzzy_groups, lcs_length
from acadlake.views import domain


def test_lcs_bitparallel_matches_dp():
    import random
    rnd = random.Random(7)
    for _ in range(300):
        a = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 30)))
        b = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 30)))
        assert lcs_length(a, b) == B.lcs(a, b)


def _check(spark, rows):
    df = spark.createDataFrame(rows, "linha bigint, nome string")
    got = {r["linha"]: (r["id"], r["sugerido"]) for r in fuzzy_groups(df, "linha", "nome").collect()}
    assert got == B.greedy_groups(rows)


def test_handmade_fixture(spark):
    rows = [(1, "Universidade Federal Fluminense - 2021"), (2, "UNIVERSIDADE FEDERAL FLUMINENSE"),
            (3, "Universidade Federal Fluminens 2019"), (4, "Centro Universitario X"), (5, None),
            (6, "Centro Universitário X"), (7, "nan"), (8, "Escola Tecnica 2020"), (9, ""), (10, "---"),
            (11, "Escola Tecnica Estadual"), (12, "Universidade Federal Fluminense2022")]
    _check(spark, rows)


def test_institution_table(spark, sf):
    inst = domain(spark, sf).institution
    rows = sorted((r["linha"], r["nome_instituicao"]) for r in inst.collect())
    _check(spark, rows)


def _random_names(seed: int, n: int):
    import random
    rnd = random.Random(seed)
    words = ["universidade", "federal", "centro", "escola", "tecnica", "instituto", "sul", "norte", "rio", "ab", "x"]
    out = []
    for i in range(n):
        name = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))
        r = rnd.random()
        if r < 0.2 and name:
            j = rnd.randrange(len(name))
            name = name[:j] + rnd.choice("aeiouz") + name[j + 1:]          # typo
        elif r < 0.35:
            name = name.upper() + " - " + str(rnd.randint(2000, 2024))
        elif r < 0.45:
            name = name + str(rnd.randint(1990, 2030))
        elif r < 0.5:
            name = None
        out.append((i + 1, name))
    return out


@pytest.mark.parametrize("seed,threshold", [(1, 90), (2, 90), (3, 80)])
def test_random_near_duplicates(spark, seed, threshold):
    rows = _random_names(seed, 160)
    df = spark.createDataFrame(rows, "linha bigint, nome string")
    got = {r["linha"]: (r["id"], r["sugerido"]) for r in fuzzy_groups(df, "linha", "nome", threshold).collect()}
    assert got == B.greedy_groups(rows, threshold)


@pytest.mark.parametrize("threshold", [60, 80, 85, 90, 95])
def test_pairs_of_short_names_match_all_pairs(spark, threshold):
    import random

    from acadlake.operators.entity import similar_pairs
    rnd = random.Random(threshold)
    names = sorted({"abc", "abxc", "a", "b", "ab", *("".join(rnd.choices("abx ", k=rnd.randint(1, 12))).strip() or "z"
                                                     for _ in range(250))})
    df = spark.createDataFrame(list(enumerate(names)), "pos bigint, chave string")
    got = {tuple(r) for r in similar_pairs(df, threshold).collect()}
    assert got == {(i, j) for j, y in enumerate(names) for i, x in enumerate(names[:j]) if B.similar(x, y, threshold)}
