"""The stages of the pipeline, each against a plain version on its own input."""

from collections import Counter, defaultdict

import brute
import pytest

import corpus_pipeline as pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    root = tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, sf).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out.append((before, docs.collect(), docs.columns))
    return out


def test_stages_in_order(results):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "source_mix", "shards"]
    assert all(columns == COLUMNS for _, _, columns in results[:-1]) and results[-1][2][:5] == COLUMNS


def test_quality_stage(results, spark, sf):
    before, after, _ = results[0]
    kept = {r.doc_id for r in after}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in before:
        n, _, _, _, repeat = brute.quality(r.text)
        failed = n < 20 or 100 * repeat > 30 * n
        assert not (failed and r.doc_id in kept)
        if labels.get(r.doc_id) == 1 and not failed:
            assert r.doc_id in kept


def test_near_duplicate_stage(results):
    before, after, _ = results[1]
    kept = {r.doc_id for r in after}
    held = {r.doc_id: set(brute.shingles(r.text, 5)) for r in before}
    owners = defaultdict(list)
    for doc, some in held.items():
        for s in some:
            owners[s].append(doc)
    shared = Counter((a, b) for docs in owners.values() for a in docs for b in docs if a < b)
    alike = {p: n / len(held[p[0]] | held[p[1]]) for p, n in shared.items()}
    group = {d: d for d in held}
    for (a, b), j in alike.items():
        if j >= 0.8 and group[a] != group[b]:
            old, new = group[b], group[a]
            group.update({d: new for d, g in group.items() if g == old})
    smallest = {}
    for d, g in group.items():
        smallest[g] = min(d, smallest.get(g, d))
    assert kept == set(smallest.values())


def test_decontamination_stage(results, spark, sf):
    before, after, _ = results[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {doc for doc, *_ in brute.leaks([(r.doc_id, r.text) for r in before], items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - bad


def test_mix_stage(results):
    before, after, _ = results[3]
    size, source = {r.doc_id: len(brute.words(r.text)) for r in before}, {r.doc_id: r.source for r in before}
    text = {r.doc_id: r.text for r in before}
    taken, by_source, total = Counter(), Counter(), Counter()
    for r in after:
        assert r.text in text[r.doc_id] and r.source == source[r.doc_id] and r.n_chars == len(r.text)
        taken[r.doc_id] += len(brute.words(r.text))
    for doc, n in taken.items():
        assert n <= 3 * size[doc]
        by_source[source[doc]] += n
    for doc, n in size.items():
        total[source[doc]] += n
    names = sorted(total)
    for name, want in zip(names, brute.targets([total[n] for n in names])):
        assert abs(by_source[name] - want) <= 128


def test_shard_stage(results):
    before, after, _ = results[4]
    assert Counter((r.doc_id, r.text) for r in after) == Counter((r.doc_id, r.text) for r in before)
    slots = defaultdict(list)
    for r in after:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_same(results, spark, sf):
    got = Counter((r.doc_id, r.text, r.shard) for r in pipeline.run(spark, sf).collect())
    assert got == Counter((r.doc_id, r.text, r.shard) for r in results[-1][1])
