"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for operators 11 to 13."""

import random
import re

import numpy as np
import pytest

import brute
from pyspark.sql import functions as F
from conftest import SMALL
from ratewell.llm import negatives, queries, spelling, syncmers
from test_cases import LONG, messy, nothing  # noqa: F401  fixtures

# ---- 11


def vectors(n, seed=1):
    """Clusters, ties, repeated rows, zero vectors, several lengths and dimensions, nulls."""
    r = random.Random(seed)
    centres = [[r.randint(-90, 90) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centres[i % 6]
        scale = r.choice((1, 1, 1, 3, 20))
        rows.append((i, r.choice((0, 1, i % 3)), [scale * (x + r.randint(-9, 9)) for x in c]))
    rows += rows[:5] + [(n, 1, [0] * 8), (n + 1, 0, [0] * 8), (n + 2, 1, []), (n + 3, 0, []), (n + 5, 1, []), (n + 4, 1, [5, 6, 7]), (n + 6, 1, [5, 6, 8]), (n + 7, 0, [3, 2, 1])]
    return rows + [(None, 1, [1] * 8), (7_000, None, [1] * 8), (7_007, 1, None), (7_014, 1, [None] * 8)]


SCHEMA = "vec_id bigint, label int, vector array<bigint>"


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(vectors(600), SCHEMA).repartition(3).selectExpr("*", "1 as id", "2 as dim", "3 as length", "4 as vec", "5 as hash", "6 as window")


@pytest.mark.parametrize("settings", [{}, {"BUCKET_ROWS": 40, "WAVE_BYTES": 512, "WIDE": 1.0, "HEAD_ROWS": 20}, {"WIDE": 0.0, "CELLS": 64, "HEAD_ROWS": 1}])
def test_hard_negatives(monkeypatch, points, settings):
    for name, value in settings.items():
        monkeypatch.setattr(negatives, name, value)
    got = sorted(map(tuple, negatives.mine(points, F.col("vec_id") % 7 == 0).collect()))
    assert got == brute.hard_negatives(vectors(600), lambda i: i % 7 == 0) and len({g[0] for g in got}) > 50


def test_coordinate_lists_prune_and_lose_nothing():
    r = np.random.default_rng(3)
    centre = r.normal(size=(1, 16))
    rows = np.concatenate([100 * r.normal(size=(900, 16)), 100 * (centre + 0.05 * r.normal(size=(100, 16)))]).astype(np.int64)
    bucket = negatives.Bucket(np.arange(1000), np.zeros(1000, np.int64), rows)
    query = (100 * centre).astype(np.int64)
    floor = np.array([int(0.98 * bucket.longest * np.sqrt((query**2).sum()) / 2)])
    wave = negatives.Wave(np.array([-1]), np.array([0]), query, np.array([0]), floor, floor, True, 5)
    parts = list(negatives.candidates(bucket, wave, floor))
    want = np.flatnonzero(rows @ query[0] >= floor[0])
    assert sorted(np.concatenate([p[1] for p in parts])) == want.tolist() and bucket.lists


def test_great_numbers_and_an_empty_table(spark, points):
    big = [(0, 1, [2**62, -(2**62)]), (1, 1, [2**62, 5]), (2, 0, [2**40, 0]), (3, 0, [1, 0]), (4, 0, [2**29, 0])]
    got = negatives.mine(spark.createDataFrame(big, SCHEMA), F.col("vec_id") == 0).collect()
    assert [r.positive_id for r in got] == [1] and all(0 < r.negative_score <= 0.9 * r.positive_score for r in got)
    assert negatives.mine(points.where("false"), F.col("vec_id") == 0).collect() == []
    assert negatives.mine(points, F.lit(False)).collect() == []


# ---- 12


def words_of(seed=5):
    """Texts with hubs, variants in all positions, anagrams, letters beyond ASCII and rare words."""
    r = random.Random(seed)
    letters = "abcdeéÉÿ÷"
    stems = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "bananas", "banansa"]
    texts = []
    for d in range(300):
        out = []
        for _ in range(40):
            w = r.choice(stems)
            if r.random() < 0.3:
                i = r.randrange(len(w))
                w = r.choice((w[:i] + w[i + 1 :], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1 :]))
            out.append(w.upper() if r.random() < 0.1 else w)
        texts.append((d, r.choice((" ", "-", "1", "Ā")).join(out)))
    texts += [(400 + i, " ".join(["rootword"] * 80 + ["rootwore"] * 12 + ["rootwoe"])) for i in range(20)]
    return texts + [(None, " ".join(["nullid"] * 6)), (900, None), (901, ""), (901, ""), (902, "x" * 70_000 + " "), (903, ("y" * 70_000 + " ") * 5), (906, ("y" * 69_999 + " ") * 30)]


@pytest.mark.parametrize("settings", [{}, {"PART_WORDS": 7, "PIECE": 50, "HELD": 20, "COMPARED": 10}])
def test_spelling(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(spelling, name, value)
    docs = words_of()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).selectExpr("*", "1 as word", "2 as n", "3 as id", "4 as key", "5 as part")
    got = {r.word: tuple(r)[1:] for r in spelling.variants(df, noise=7).collect()}
    want = brute.spelling([(d, t) for d, t in docs if d is None or d < 902], noise=7)
    long = {w for w in got if len(w) > 1000}
    assert {w: v for w, v in got.items() if w not in long} == want and sum(v[0] is not None for v in want.values()) > 20
    assert {(w[0], len(w), v[3]) for w, v in got.items() if w in long} == {("y", 69_999, 1), ("y", 70_000, 1)}
    assert any(v[1] != v[0] for v in want.values() if v[0])


def test_no_words(messy, nothing):  # noqa: F811
    assert spelling.variants(nothing).collect() == []
    assert {r.word for r in spelling.variants(messy, least_letters=1, least_count=1).where("n >= 60000").collect()} >= {"w", "x"}


# ---- 13


def test_fingerprints_of_messy_texts(messy, nothing):  # noqa: F811
    rows = syncmers.fingerprints(messy).collect()
    texts = messy.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    want = sorted(("" if t.doc_id is None else str(t.doc_id), "".join(f"{x % 2**64:016X}" for x in brute.fingerprint(t.text))) for t in texts)
    assert sorted(("" if r.doc_id is None else str(r.doc_id), r.fingerprint) for r in rows) == want
    assert syncmers.fingerprints(nothing).collect() == [] and syncmers.edited(nothing).collect() == []


def test_edited_texts(spark, messy):  # noqa: F811
    got = syncmers.edited(messy).collect()
    assert len(got) == messy.count() and {r.n_chars for r in got if r.doc_id == 13} == {70_000}
    docs = [(1, "ein zwei drei vier fünf sechs sieben acht 日本語テキスト"), (2, "!?"), (3, ""), (5, LONG), (4, "a b c d e f g h i j k l m \U0001f600 n o p")]
    df = spark.createDataFrame([*docs, docs[0], docs[3]], "doc_id int, text string")
    rows = [tuple(r)[:7] for r in syncmers.edited(df).collect()]
    assert len(rows) == 7 and {r[0]: r[1:] for r in rows} == brute.edited(docs)
    alone = syncmers.edited(df.where("doc_id = 4")).collect()[0]
    assert alone.near_next == 1.0 and {tuple(r)[:7] for r in [alone]} == {(4, *brute.edited(docs[4:])[4])}


def test_shared_places(spark):
    body = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(body, "one more beginning " + body)], "x string, y string")
    df = syncmers.with_fingerprint(syncmers.with_fingerprint(df, "x", "a"), "y", "b")
    pairs = df.select(syncmers.shared("a", "b").alias("p")).first().p
    assert len(pairs) > 10 and {p.b - p.a for p in pairs} == {3} and [p.a for p in pairs] == sorted(p.a for p in pairs)


def test_no_python_in_the_plan(spark, capsys):
    queries.op13_fingerprints(spark, SMALL).explain("formatted")
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", capsys.readouterr().out)
