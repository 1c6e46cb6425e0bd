"""Fill-in-the-middle examples, the Jaccard join and hard negatives against plain versions."""

import random
from collections import Counter
from math import floor, isfinite

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotwise.llm import infill, jaccard, negatives, sets
from slotwise.llm.queries import QUERIES


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_fill_in_middle(docs, cases):
    want = Counter((r[0], *brute.infill(r[0], r[1])) for r in cases)
    made = infill.examples(docs)
    assert Counter(rows_of(made, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) == want
    assert Counter(rows_of(infill.restored(made), "doc_id", "restored")) == Counter((r[0], r[1] or "") for r in cases)


def test_all_forms_occur_and_markers_stay_plain(spark):
    rows = [(i, f"some words <P{i}, more <S <M and > é😀\n{i}") for i in range(300)] + [(-i, f"a <{m}> b") for i, m in enumerate("PSM")]
    made = infill.restored(infill.examples(texts_of(spark, rows))).collect()
    assert {r.restored for r in made} == {t for _, t in rows}
    assert {r.form for r in made if r.doc_id <= 0 and "> b" in r.output} == {"plain"}
    share = Counter(r.form for r in made if r.doc_id > 0)
    assert share["plain"] / 299 < 0.2 < share["psm"] / 299 and 0.05 < share["spm"] / 299 < 0.4


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="<>PSM ab\né", max_size=25), min_size=1, max_size=30))
def test_examples_are_taken_apart_exactly(spark, said):
    made = infill.restored(infill.examples(texts_of(spark, list(enumerate(said)))))
    assert dict(rows_of(made, "doc_id", "restored")) == dict(enumerate(said))


def test_jaccard_join(docs, cases):
    got = rows_of(jaccard.jaccard_join(docs), "doc_id", "n_shingles", "component_id")
    assert Counter(got) == Counter(brute.jaccard_components([r[:2] for r in cases], 85))


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**9)}"
    return words


def family_texts():
    """Copies with few and many edits, texts made of shared passages, a chain, short and equal texts."""
    draw = random.Random(4)
    word = lambda: f"w{draw.randrange(3000)}"
    passages = [[word() for _ in range(60)] for _ in range(6)]
    texts = []
    for _ in range(25):
        base = [word() for _ in range(draw.choice([6, 9, 40, 150, 400]))]
        texts += [edited(draw, base, draw.randrange(len(base) // 20 + 2)) for _ in range(8)]
    for _ in range(120):
        some = draw.sample(passages, 3)
        texts.append([w for p in some for w in p] + [word() for _ in range(draw.choice([1, 4, 30]))])
    chain = [word() for _ in range(200)]
    for i in range(20):
        chain = [*chain[8:], *[word() for _ in range(8)]]
        texts.append(chain)
    texts += [[word()] for _ in range(5)] + [["same"]] * 3 + [texts[0]] * 4 + [[]] * 3
    draw.shuffle(texts)
    return [(i, " ".join(t).upper() if i % 3 else "\n".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("percent", [85, 60])
def test_jaccard_join_of_families(spark, percent):
    rows = family_texts()
    got = rows_of(jaccard.jaccard_join(texts_of(spark, rows), percent), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == sorted(brute.jaccard_components(rows, percent))


def test_jaccard_join_on_given_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = rows_of(QUERIES["op12_jaccard_join"](spark, sf), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == sorted(brute.jaccard_components(rows, 85))


def test_linked_sets_share_a_signature(monkeypatch):
    """Pairs at the threshold, with tokens of all classes, share a combination whatever tokens are missing."""
    monkeypatch.setattr(jaccard, "FREQUENT", (3, 9))
    draw = np.random.default_rng(2)
    for trial in range(400):
        n = int(draw.choice([6, 7, 12, 30, 70, 128, 300, 1000]))
        universe = np.unique(draw.integers(-(2**62), 2**62, 2 * n + 40))
        share = np.array([[0.9, 0.05, 0.05], [0.1, 0.5, 0.4], [0.02, 0.08, 0.9]][trial % 3])
        count = dict(zip(universe.tolist(), draw.choice([2, 6, 20], len(universe), p=share).tolist()))
        base = draw.permutation(universe)[:n]
        spare = np.setdiff1d(universe, base)
        swapped = int(draw.integers(0, max(1, int(0.09 * n)) + 1))
        other = np.concatenate([base[swapped:], spare[: draw.integers(0, swapped + 1)]])
        if 100 * len(np.intersect1d(base, other)) < 85 * len(np.union1d(base, other)):
            continue
        found = []
        for tokens in (base, other):
            zone = np.sort(tokens.view(np.uint64))[: jaccard.zone_size(len(tokens), 85)].view(np.int64)
            counts = np.array([count[t] for t in zone.tolist()])
            need = len(zone) - jaccard.least_shared(len(tokens), 85) + 1
            found.append(jaccard.signatures(zone, counts, int(need), len(tokens), 85))
        assert found[0] & found[1], (n, swapped, trial)


def test_large_group_is_compared_with_its_pivot_first(spark, monkeypatch):
    """Groups and cells beyond a chunk keep all links, those among points that do not link to the pivot as well."""
    monkeypatch.setattr(sets, "SET_CHUNK", 8)
    monkeypatch.setattr(sets, "GROUP_SETS", 20)
    monkeypatch.setattr(jaccard, "ZONE_CHUNK", 8)
    draw = random.Random(9)
    base = [f"w{draw.randrange(5000)}" for _ in range(150)]
    rows = [(i, " ".join(edited(draw, base, draw.randrange(1, 9)))) for i in range(60)]
    got = rows_of(jaccard.jaccard_join(texts_of(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == sorted(brute.jaccard_components(rows, 85))


@pytest.mark.parametrize("df", ["docs", "nothing"])
def test_empty_tables_and_columns(request, df):
    df = request.getfixturevalue(df)
    empty = df.limit(0)
    assert infill.restored(infill.examples(empty)).collect() == [] and jaccard.jaccard_join(empty).collect() == []


def test_product_is_exact():
    draw = np.random.default_rng(0)
    for shape in ((1, 1, 1), (33, 64, 65), (100, 96, 301), (65, 129, 67), (40, 0, 50)):
        x, y = (draw.integers(-(2**24), 2**24, s) for s in (shape[:2], shape[1:]))
        assert (negatives.product(x, y) == x @ y).all()


VECTORS = "vec_id bigint, embedding array<double>, label int, strip int, block string, Label string, vector int"


def vectors():
    draw = random.Random(1)
    rows = [(i, [round(draw.uniform(-1, 1), 2) for _ in range(9)], draw.randrange(3)) for i in range(330)]
    rows += [(400 + i, rows[100][1], i % 3) for i in range(12)]  # ties
    rows += [rows[7], rows[7], rows[0], (0, rows[5][1], 1), (200, rows[9][1], 2)]  # repeated rows, repeated ids
    rows += [(600, None, 1), (700, [1.0] * 9, None), (800, [float("nan")] + [1.0] * 8, 1), (900, [float("inf")] * 9, 1), (1000, [None, *[1.0] * 8], 0)]
    rows += [(None, [1.0] * 9, 1), (1100, [], 0), (1200, [0.5, 0.25], 1), (1300, [1e300] * 9, 2), (1400, [0.0] * 9, 2), (1500, [0.1] * 9, 99)]
    return rows


def test_hard_negatives(spark):
    df = spark.createDataFrame([(*r, 1, "x", "clash", 5) for r in vectors()], VECTORS).repartition(3)
    proper = [r for r in vectors() if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and isfinite(x) and abs(256 * x) <= 2**24 for x in r[1])]
    # Equal rows count once; of rows that share an id only, the hash tells which is first.
    row = {(r.vec_id, r.label, tuple(r.vector)): r._row for r in negatives.scaled(df).collect()}
    distinct = sorted({(r[0], r[2], tuple(floor(256 * x) for x in r[1])) for r in proper}, key=lambda r: (r[0], row[r]))
    assert len(distinct) == len(row)
    want = brute.hard_negatives(distinct, lambda r: r[0] % 100 == 0)
    for sizes in ({}, {"strip_rows": 40, "block_rows": 3}):
        got = rows_of(negatives.mine(negatives.scaled(df), F.col("vec_id") % 100 == 0, **sizes), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        assert Counter(got) == Counter(want)
    assert negatives.mine(negatives.scaled(df.limit(0)), F.col("vec_id") % 100 == 0).collect() == []
