"""Operators on documents against plain versions, on hard cases and on the smallest test data."""

import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from pyspark.sql import functions as F

from slotwise.llm import boosting, decontamination, mixing, neardup, pii, quality, secrets, sets, sharding, tokencount
from slotwise.llm.common import repeated_rows, row_hash, with_copies
from slotwise.llm.queries import QUERIES
from slotwise.llm.spans import apart
from slotwise.session import stored


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.fixture(scope="module")
def real(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return table, [(r.doc_id, r.text, r.lang, r.source) for r in table.collect()]


def both(docs, cases, real):
    return ((docs, cases), real)


def test_mix(docs, cases, real):
    for df, rows in both(docs, cases, real):
        got = mixing.taken(mixing.Mix(df, block_words=16)).collect()
        assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(brute.words(r[1]))) for r in rows)
        assert all(0 <= r.taken <= 3 * r.size for r in got)
        sizes = Counter()
        for _, text, _, source in rows:
            sizes[source] += len(brute.words(text))
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        wanted = dict(zip(names, map(float, brute.targets([sizes[n] for n in names]))))
        assert {(r.source_size, round(r.target, 6)) for r in got} == {(sizes[n], round(wanted[n], 6)) for n in names}
        for n in names:
            # Sources may share figures; their sums then do too.
            some = [m for m in names if (sizes[m], wanted[m]) == (sizes[n], wanted[n])]
            taken = sum(r.taken for r in got if (r.source_size, r.target) == (sizes[n], wanted[n]))
            assert abs(taken - len(some) * wanted[n]) <= 16 * len(some)


def test_mix_is_repeatable_and_blocks_hold_whole_texts(docs, cases):
    first, second = (sorted(map(str, mixing.mixed_documents(docs, block_words=16).collect())) for _ in range(2))
    assert first == second
    pieces = mixing.Mix(docs, block_words=16).blocks().selectExpr("explode(pieces) p").selectExpr("p.start", "p.first_word", "p.piece", "p.words").collect()
    texts = {}
    for r in sorted(pieces, key=lambda r: (r.start, r.first_word)):
        texts.setdefault(r.start, []).append(r.piece)
        assert len(brute.words(r.piece)) == r.words <= 16
    whole = Counter(t for _, t, _, _ in cases if brute.words(t))
    # Streams of several sources may start at the same place: compare all text in sum.
    assert sum(len("".join(p)) for p in texts.values()) == sum(len(t) * n for t, n in whole.items())


def test_targets_against_plain_version():
    for sizes in ([1, 1, 1], [100, 1, 1], [0, 5, 3, 100, 7], [1, 0, 0], [0, 0], [], [3, 10**12, 5, 9]):
        assert mixing.targets(sizes) == brute.targets(sizes)


def test_permutations():
    for n in (1, 2, 3, 17, 64, 1000):
        index = np.arange(n)
        shuffled = mixing.permuted(index, n, np.full(n, 99, np.uint64))
        assert sorted(shuffled.tolist()) == list(range(n))


def test_near_duplicates(docs, cases, real):
    for df, rows in both(docs, cases, real):
        prints = [brute.fingerprint(r[1]) for r in rows]
        found = brute.components([r[0] for r in rows], prints, 4)
        want = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, found))
        assert Counter(rows_of(neardup.near_duplicates(df), "doc_id", "fingerprint", "component_id")) == want


def test_dense_group_and_chain(spark, monkeypatch):
    """A crowded cell cut into chunks, and a chain whose ends are far apart, stay one component each."""
    monkeypatch.setattr(neardup, "CHUNK", 16)
    center = 0x0123456789ABCDEF
    dense = [center ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i, 12)]
    chain = [0x7777 << 40]
    for i in range(12):
        chain.append(chain[-1] ^ (0b111 << (3 * i)))
    prints = list(dict.fromkeys(dense + chain))
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id bigint, fp bigint")
    got = dict(rows_of(neardup.components(df), "doc_id", "component_id"))
    assert [got[i] for i in range(len(prints))] == brute.components(list(range(len(prints))), prints, 4)


def test_crowded_cells_are_counted_in_parts(spark):
    points = spark.createDataFrame([(i, i, 7 if i < 50 else i) for i in range(60)], "fp bigint, word bigint, cell bigint")
    links = neardup._linked(points, 64)
    assert "Window" not in links._jdf.queryExecution().toString()
    assert {r.b for r in neardup.connected(links).selectExpr("fp b").collect()} == set(range(50))


def test_embedding_bounds_the_distance():
    x, y = np.random.default_rng(0).integers(0, 2**63, (2, 2000), dtype=np.uint64)
    assert (np.bitwise_count(neardup._embed(x) ^ neardup._embed(y)) <= np.bitwise_count(x ^ y)).all()


def test_unique_documents(docs, cases, spark):
    got = rows_of(neardup.unique_documents(docs), "doc_id", "text")
    assert len(got) == len(set(got))
    # Blank texts are one group, the repeated row another; the rest differ.
    different = {t for _, t, _, _ in cases if brute.words(t)}
    assert {t for _, t in got if brute.words(t)} <= different
    assert sum(not brute.words(t) for _, t in got) == 1 and (2, None) in got
    assert Counter(t for _, t in got)["twice told tale " * 3] == 1


def test_unique_documents_finds_edited_copies(spark):
    draw = np.random.default_rng(1)
    base = [[f"w{x}" for x in draw.integers(0, 5000, 200)] for _ in range(30)]
    rows = []
    for k, w in enumerate(base):
        rows.append((1000 * k, " ".join(w)))
        for c in range(1, 6):
            copy = list(w)
            for at in draw.integers(0, len(w), 3):
                copy[at] = f"new{draw.integers(0, 10**9)}"
            rows.append((1000 * k + c, " ".join(copy)))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in neardup.unique_documents(df).collect()) == [1000 * k for k in range(30)]


def test_cells_miss_few_links():
    """Pairs of sets at a similarity of 0.8 share a cell, unrelated ones hardly ever; the miss rate holds at any size."""
    draw = np.random.default_rng(5)
    near, far = 0, 0
    for _ in range(400):
        shared, one, two = (draw.integers(0, 2**64, n, dtype=np.uint64) for n in (160, 20, 20))
        x, y = np.concatenate([shared, one]), np.concatenate([shared, two])
        near += bool(set(neardup.cells_of(x)) & set(neardup.cells_of(y)))
        far += bool(set(neardup.cells_of(x)) & set(neardup.cells_of(draw.integers(0, 2**64, 180, dtype=np.uint64))))
    assert near == 400 and far == 0 and neardup.missed(0.8) < 2e-5


def test_repeated_shingles_do_not_hide_a_copy(spark):
    """A copy with a long line of dashes is a copy; unrelated texts that share such a line are not."""
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 5000, 1000)) for _ in range(10)]
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, t + "\n" + "- " * 34) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in neardup.unique_documents(df).collect()) == list(range(0, 20, 2))


def test_cells_are_not_broadcast(spark):
    """Spark takes exploded cells for as small as the few points they come from."""
    points = spark.range(3000).select(F.xxhash64(F.col("id") % 2900).alias("fp")).distinct()
    points = stored(points.union(points.select(F.col("fp").bitwiseXOR(F.lit(1)))), "points")
    links = neardup.grid_links(points)
    assert links.count() >= 2900
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_personal_data(docs, cases, real):
    model = pii.train(real[0])
    for df, rows in both(docs, cases, real):
        if df is docs:
            rows = [r for r in rows if r[0] != 14]  # the plain version cannot convert thousands of digits
        got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(df, model).collect())
        for doc, text, _, _ in rows:
            spans = brute.personal(text)
            count = Counter(s[0] for s in spans)
            got.subtract([(doc, *[count[k] for k in pii.KINDS], brute.sha(spans))])
        left = +got
        assert not -got and all(k[0] == 14 for k in left) and sum(left.values()) == (1 if df is docs else 0)
    for _, text, _, _ in cases:
        base, every = pii.all_spans(text or "", model)
        assert set(base) <= set(every)


def test_trees_select_other_spellings(real):
    """Held-out accuracy: spellings that no base pattern has, in unseen texts."""
    model = pii.train(real[0])
    good = bad = total = 0
    for i in range(60):
        phone, noise = f"(2{i % 10}{i // 10}) 555-{1000 + 37 * i}", f"2024-{1 + i % 12:02d}-{1 + i % 28:02d} 10:{i:02d}:00"
        text = f"and the answer of her was {phone} for all"
        total += 1
        good += any(s[0] == "phone" and text[s[1] : s[2]] == phone for s in pii.all_spans(text, model)[1])
        bad += bool(pii.all_spans(f"and the answer of her was {noise} for all", model)[1])
    assert bad <= 0.05 * total and good >= 0.8 * total


def test_mail_names_are_marked_whole(real):
    """Names whose last part a base pattern takes, and very long ones, leave nothing unmarked."""
    model = pii.train(real[0])
    for name in ("josé.garcia", "müller.anna", "é" * 3 + "x", "a" * 300, "ß" + "b" * 200):
        text = f"write to {name}@example.com for more"
        base, every = pii.all_spans(text, model)
        assert ("email", 9, 9 + len(name) + 12) in every and set(base) <= set(every)
        assert pii.masked(text, every) == "write to [EMAIL] for more"


def test_trees_select_families_without_base_pattern(real):
    """IPv6 addresses, cards of 13 to 15 digits, mail names outside ASCII: in unseen texts, with look-alikes."""
    model = pii.train(real[0])
    assert all(t < 1.0 for t in model.thresholds.values())
    draw, found = np.random.default_rng(9), Counter()

    def wholly(kind, body):
        text = f"and the answer of her was {body} for all"
        return (kind, 26, 26 + len(body)) in pii.all_spans(text, model)[1]

    for i in range(50):
        digits = "".join(map(str, draw.integers(0, 10, 13)))
        amex = next(c for d in range(10) if pii.luhn(c := f"3{'47'[i % 2]}{digits[:12]}{d}"))
        six = ":".join(f"{x:x}" for x in draw.integers(4096, 65536, 8))
        found["six"] += wholly("ip", six)
        found["short six"] += wholly("ip", f"fe80::{six[:9]}")
        found["amex"] += wholly("card", amex)
        found["spaced amex"] += wholly("card", f"{amex[:4]} {amex[4:10]} {amex[10:]}")
        found["mail"] += wholly("email", f"n{digits[:3]}.josé@mail{i}.example.org")
        found["phone"] += wholly("phone", f"({digits[:3]}) 555-{1000 + 37 * i}")
        wrong = amex[:-1] + str((int(amex[-1]) + 1 + i % 8) % 10)
        mac = ":".join(f"{x:02x}" for x in draw.integers(0, 256, 6))
        found["bad"] += wholly("card", wrong) + wholly("ip", mac) + wholly("ip", f"10:{i:02d}:59")
    assert found["bad"] <= 5 and all(found[k] >= 40 for k in ("six", "short six", "amex", "spaced amex", "mail", "phone")), found


def test_rare_kinds_are_sampled(spark):
    """A few documents with a telephone number among very many with other digits still train the trees."""
    rows = [(i, f"line {i} of the list has {i * 7} entries") for i in range(4000)]
    rows += [(5000 + i, f"and then of her was +1 (2{i % 10}{i // 10}) 555-{1000 + 41 * i} for all") for i in range(30)]
    model = pii.train(spark.createDataFrame(rows, "doc_id bigint, text string"), sample_rows=50)
    text = "and then of her was (743) 555-3824 for all"
    assert model.thresholds["phone"] < 1.0 and ("phone", 20, 34) in pii.all_spans(text, model)[1]


def test_trees_count_every_document(spark, monkeypatch):
    """Far more documents than a sample would take: the examples of each are counted, at any resolution."""
    rows = [(i, f"and then of her was +1 (2{i % 10}{i // 10 % 10}) 555-{1000 + i} for all" if i % 2 else f"line {i} of 8.8.{i % 300}.9") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, seen = sum(len(pii.examples(t)) for _, t in rows), []

    def fit(x, y, **options):
        seen.append((len(x), int(options["copies"].sum())))
        return boosting.fit(x, y, **options)

    def threshold(probability, truth, precision, copies):
        seen.append((len(copies), int(copies.sum())))
        return 1.0

    monkeypatch.setattr(pii, "fit", fit)
    monkeypatch.setattr(pii, "_threshold", threshold)
    for limit in (pii.MAX_ROWS, 200):
        seen.clear()
        monkeypatch.setattr(pii, "MAX_ROWS", limit)
        pii.train(docs)
        assert sum(n for _, n in seen) == want and sum(n for n, _ in seen) <= limit


def test_no_text_is_left_out_of_the_training(spark, monkeypatch):
    """Texts without digits and at signs have examples too, and an old caller's `sample_rows` drops none."""
    rows = [(i, f"line {i} of 8.8.{i % 300}.9") for i in range(40)] + [(100 + i, "the dead:beef:cafe and face:bad:bed") for i in range(40)] + [(None, "x 8.8.8.8"), (7, None)]
    want, seen = sum(len(pii.examples(t or "")) for _, t in rows), []
    monkeypatch.setattr(pii, "fit", lambda x, y, **options: (seen.append(int(options["copies"].sum())), boosting.fit(x, y, **options))[1])
    monkeypatch.setattr(pii, "_threshold", lambda probability, truth, precision, copies: (seen.append(int(copies.sum())), 1.0)[1])
    for some in (None, 5):
        seen.clear()
        pii.train(spark.createDataFrame(rows, "doc_id bigint, text string"), some)
        assert sum(seen) == want > 40 * len(pii.examples(rows[0][1]))


def test_binned_examples_fit_the_same_trees(spark, monkeypatch):
    """Long spans and many digits around them: the trees are those of the examples as they are."""
    draw, got = np.random.default_rng(5), []
    rows = [(i, f"{'ab' * (i % 90)}{i}@{'cd' * (i * 7 % 120)}.org or +1 (2{i % 10}{i // 10 % 10}) 555-{1000 + i} or {'1' * draw.integers(1, 150)}") for i in range(300)]
    monkeypatch.setattr(pii, "fit", lambda x, y, **options: (got.append((x, options)), boosting.fit(x, y, **options))[1])
    trees = pii.train(spark.createDataFrame(rows, "doc_id bigint, text string")).trees
    raw = [(e, t) for t in (r[1] for r in rows) for e in pii.examples(t)]
    x = np.array([e[0] for e, _ in raw], float)
    # Held-out texts are the first by crc32, so the training examples are those of the other texts.
    n = int(got[0][1]["copies"].sum())
    crc = np.array([zlib.crc32(t.encode()) >> pii.CELL_BITS for _, t in raw])
    kind = x[:, :4].argmax(axis=1)
    positive = {t: {int(np.argmax(e[0][:4])) for e in pii.examples(t) if e[1]} for _, t in rows}
    good = np.array([k in positive[t] for k, (_, t) in zip(kind, raw)])
    groups = {}
    for g, _, c in {((int(k), bool(y)), t, c) for k, y, (_, t), c in zip(kind, good, raw, crc)}:
        groups.setdefault(g, []).append(int(c))
    last = {g: _last_held(cells) for g, cells in groups.items()}
    kept = np.array([c > last[(int(k), bool(y))] for k, y, c in zip(kind, good, crc)])
    assert kept.sum() == n and len(got[0][0]) < n
    many = np.bincount(kind[kept], minlength=4)
    weight = np.minimum(1.0, pii.KIND_WEIGHT / np.maximum(many, 1))[kind[kept]]
    plain = boosting.fit(x[kept], np.array([e[1] for e, _ in raw])[kept], trees=80, depth=4, weight=weight)
    assert np.allclose(plain.score(x), trees.score(x))


def _last_held(cells):
    """The cell of the last held-out text: one in four, never all."""
    order = sorted(cells)
    for at in sorted(set(order)):
        seen = sum(c <= at for c in order)
        if seen * pii.FOLDS >= len(order):
            return at if seen < len(order) else at - 1


def test_copies_of_rows_fit_the_same_trees():
    draw = np.random.default_rng(3)
    x, copies = draw.integers(0, 9, (300, 4)).astype(float), draw.integers(1, 6, 300)
    y = (x[:, 0] + x[:, 1] > 8).astype(float)
    few, all_ = boosting.fit(x, y, copies=copies), boosting.fit(np.repeat(x, copies, axis=0), np.repeat(y, copies))
    assert np.allclose(few.score(x), all_.score(x))


def test_token_counts(docs, cases, real):
    encode = secrets.encoding(open(secrets.VOCABULARY, "rb").read()).encode_ordinary
    for df, rows in both(docs, cases, real):
        got = Counter(rows_of(tokencount.token_counts(df, block_tokens=64), "doc_id", "n_tokens"))
        assert got == Counter((r[0], len(encode(r[1] or ""))) for r in rows)


def test_vocabularies_that_do_not_fit_are_refused(docs, tmp_path):
    import base64

    for ids in ([*range(256), 50256], [*range(256), 70_000]):
        path = tmp_path / "v.tiktoken"
        path.write_text("".join(f"{base64.b64encode(bytes([i]) if i < 256 else b'ab').decode()} {i}\n" for i in ids))
        with pytest.raises(ValueError, match="16 bits"):
            tokencount.write_flat(docs, str(tmp_path / "flat"), str(path))


def test_separators_across_blocks(spark):
    """Documents over many blocks, blocks without separator, empty documents, no final separator, small groups."""
    lengths = {0: [3, 0, 0, 25, 1, 7], 1: [], 2: [40, 40]}
    blocks, want = [], []
    for file, sizes in lengths.items():
        flat = [t for n in sizes for t in [*[5] * n, 50256]]
        tail = 2 if file == 0 else 0
        flat += [5] * tail
        want += [(file, i, n) for i, n in enumerate([*sizes, *[tail] * bool(tail)])]
        blocks += [(file, b, bytearray(np.array(flat[4 * b : 4 * b + 4], "<u2").tobytes())) for b in range(-(-len(flat) // 4))]
    df = spark.createDataFrame(blocks, "file bigint, block bigint, data binary")
    assert sorted(rows_of(tokencount.document_counts(df, group=3), "file", "ordinal", "n_tokens")) == want


def test_quality(docs, cases, real, spark, sf):
    model = quality.train(real[0], spark.read.parquet(f"{sf}/labels.parquet"))
    for df, rows in both(docs, cases, real):
        got = quality.judge(df, model).collect()
        assert Counter((r.doc_id, *[r[c] for c in quality.COUNTS]) for r in got) == Counter((r[0], *brute.quality(r[1])) for r in rows)
        for r in got:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)


def test_quality_on_held_out_labels(spark, sf):
    big = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    held = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.97


def test_quality_without_labels(docs, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id bigint, quality int")
    judged = quality.judge(docs, quality.train(docs, labels)).collect()
    assert all(r.kept != r.base_failed for r in judged)


def test_leaks(docs, cases, real, spark, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    odd = [(100, None), (101, ""), (102, "twice TOLD tale twice told tale"), (103, "née größe"), (104, " ".join(cases[0][1].split()[3:30])), (104, "x" * 200_000), (105, "lazy dog"), (106, "WORD5"), (107, "brew another pot of"), (108, "window.\nSecond line")]
    more = spark.createDataFrame(odd, "item_id bigint, text string").withColumnRenamed("text", "text")
    for (df, rows), (table, some) in zip(both(docs, cases, real), ((more, odd), (bench, items))):
        want = Counter(brute.leaks([(r[0], r[1]) for r in rows], some))
        for block in (10, 10**6):
            got = rows_of(decontamination.find_leaks(df, table, block_shingles=block), "doc_id", "item_id", "n_shingles", "n_shared")
            assert Counter(got) == want and want
        bad = {w[0] for w in want}
        left = Counter(rows_of(decontamination.clean(df, table), "doc_id", "text"))
        texts = {r[1] for r in rows if brute.leaks([(0, r[1])], some)}
        assert left == Counter((r[0], r[1]) for r in rows if r[1] not in texts) and bad


def test_shards(docs, cases, real):
    for df, rows in both(docs, cases, real):
        got = sharding.shard(df, shards=5, part_bytes=1 << 12).collect()
        want = Counter((r[0], r[1], len((r[1] or "").encode()) + 16) for r in rows)
        assert Counter((r.doc_id, r.text, r["size"]) for r in got) == want
        load = Counter()
        for r in got:
            load[r.shard] += r["size"]
        largest, share = max(w[2] for w in want), sum(load.values()) / 5
        assert all(abs(load[s] - share) <= 2 * max(0.1 * share, largest) for s in range(5))
        for s in load:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_hot_group_is_cut_and_small_ones_are_not(spark):
    rows = [(i, "the same text" if i < 300 else f"text number {i % 450} and more", "en", "s", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = sharding.shard(df, shards=8, part_bytes=1 << 10).collect()
    load, where = Counter(), {}
    for r in got:
        load[r.shard] += r["size"]
        where.setdefault(r.text, set()).add(r.shard)
    assert max(load.values()) - min(load.values()) < 0.15 * sum(load.values()) / 8
    assert len(where["the same text"]) > 1 and all(len(v) == 1 for t, v in where.items() if t != "the same text")
    again = sharding.shard(df.repartition(7), shards=8, part_bytes=1 << 10).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_long_row_elsewhere_does_not_loosen_the_cut(spark):
    """A group of small rows at a boundary is cut, however long a row of another text is."""
    rows = [(i << 30, 100) for i in range(40)] + [((100 << 30) + i, 100) for i in range(80)]
    rows += [(200 << 30, 5000)] + [((300 + i) << 30, 100) for i in range(10)]
    keys = spark.createDataFrame(rows, "_key bigint, _bytes bigint")
    (cut,) = sharding.find_splitters(keys, 2, 0.01, 0.1)
    assert abs(sum(b for k, b in rows if k < cut) - 9000) <= 900


def test_secrets(docs, cases, real):
    for df, rows in both(docs, cases, real):
        got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan(df).collect())
        want = Counter()
        for doc, text, _, _ in rows:
            spans = brute.secret(text)
            count = Counter(s[0] for s in spans)
            want[(doc, *[count[k] for k in secrets.KINDS], brute.sha(spans))] += 1
        assert got == want


def test_random_strings_and_exclusions():
    tokens = secrets.encoding(open(secrets.VOCABULARY, "rb").read())

    def found(text):
        return [text[a:b] for _, a, b in secrets.random_spans(text, tokens, secrets.base_spans(text), secrets.MAX_RATIO)]

    key = "Zx9qL0vT7wKpR3mYhB8nQeUd41sGfJcA"
    assert found(f"the key {key} is here") == [key]
    for harmless in ("D41D8CD98F00B204E9800998ECF8427E", "123E4567-E89B-12D3-A456-426614174000", "this_is_the_user_name_of_the_account", "12345678901234567890123", "internationalization_and_localization"):
        assert found(f"see {harmless} here") == []


def test_random_strings_of_one_case_short_ones_and_those_behind_names():
    tokens = secrets.encoding(open(secrets.VOCABULARY, "rb").read())
    draw = np.random.default_rng(8)

    def found(text):
        return [text[a:b] for _, a, b in secrets.random_spans(text, tokens, secrets.base_spans(text), secrets.MAX_RATIO)]

    def some(letters, n):
        return "".join(draw.choice(list(letters), n))

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    for letters, n in ((lower, 24), (upper, 24), (upper + lower + "0123456789", 12), (upper + lower + "0123456789", 16)):
        keys = [some(letters, n) for _ in range(100)]
        assert sum(found(f"the key {k} is here") == [k] for k in keys) >= 97
    for _ in range(50):
        key = "-".join(some(upper, 5) for _ in range(5))
        assert found(f"the key {key} is here") == [key]
        long = some(upper + lower + "0123456789", 20)
        name = "internationalization_and_localization_application_configuration_identification"
        assert found(f"the {name}={long} is here") == [long]
        assert found(f"the {name}/{long} is here") == [long]
    for harmless in ("2024-01-15T10", "20240115T101530Z", "+1-743-555-3824", "978-3-16-148410-0", "THE_QUICK_BROWN_FOX", "getUserNameById", "src/main/java/com/example", "configuration", "verantwoordelijkheid", "=-=-=-=-=-=-=-", "+----+-----+----+"):
        assert found(f"see {harmless} here") == []


def test_empty_tables(nothing, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    model = quality.train(nothing, labels)
    frames = [
        mixing.taken(mixing.Mix(nothing)),
        mixing.mixed_documents(nothing),
        neardup.near_duplicates(nothing),
        neardup.unique_documents(nothing),
        pii.find(nothing, pii.train(nothing)),
        tokencount.token_counts(nothing),
        quality.judge(nothing, model),
        decontamination.find_leaks(nothing, items),
        decontamination.clean(nothing, items),
        sharding.shard(nothing),
        secrets.scan(nothing),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_contract_columns(spark, sf):
    for name, want in {
        "op1_mix_sources": "doc_id size source_size target taken",
        "op3_near_duplicates": "doc_id fingerprint component_id",
        "op4_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op7_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op9_histogram_shards": "doc_id size text_crc32 law shard slot grown_shard",
        "op10_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    }.items():
        df = QUERIES[name](spark, sf)
        assert df.columns[: len(want.split())] == want.split()
        assert df.count() == 200
    crc = QUERIES["op9_histogram_shards"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert all(r.text_crc32 == zlib.crc32(r.text.encode()) for r in crc)


def test_shared_shingles_and_pivots(spark, monkeypatch):
    draw = np.random.default_rng(4)
    some = [np.unique(draw.integers(0, 60, draw.integers(0, 40))) for _ in range(50)]
    offsets = np.cumsum([0, *map(len, some)])
    monkeypatch.setattr(sets, "_COLUMNS", 16)
    got = sets.shared_shingles(np.concatenate(some), offsets)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(some) for j, b in enumerate(some) if i != j)
    assert sets.shared_shingles(np.zeros(0, np.int64), np.zeros(3, np.int64)).shape == (2, 2)
    # A group of more points than one task takes: a chain in which only neighbours are similar, and one outsider.
    monkeypatch.setattr(sets, "SET_CHUNK", 3)
    monkeypatch.setattr(sets, "GROUP_SETS", 5)
    rows = [(k, list(range(8 * k, 8 * k + 100))) for k in range(20)] + [(99, list(range(5000, 5100)))]
    frame = spark.createDataFrame(rows, "point bigint, tokens array<bigint>")
    frame = frame.union(frame.limit(3))  # a point may be listed twice
    groups = frame.select("point", F.lit(7).cast("long").alias("cell")).distinct()
    roots = {r.fp: r.root for r in neardup.connected(sets.verified(frame, groups, 80)).collect()}
    assert set(roots) == set(range(20)) and len(set(roots.values())) == 1


def test_equal_rows_are_cut_between_copies(spark):
    """A row repeated very often beside different ones: even shards, and slots in key order within each at any part size."""
    rows = [(7, "one row again and again", "en", "s", 0)] * 2000 + [(100 + i, f"text number {i} and more", "en", "s", 0) for i in range(2001)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for part in (64 << 20, 1 << 10):
        got = sharding.shard(df, shards=40, part_bytes=part).collect()
        load = Counter()
        for r in got:
            load[r.shard] += r["size"]
        share = sum(load.values()) / 40
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows) and len(load) == 40
        assert max(load.values()) <= 1.15 * share and min(load.values()) >= 0.85 * share


def test_shards_are_sorted_at_any_part_size(spark):
    rows = [(i, f"text number {i % 700}", "en", "s", 0) for i in range(1500)] + [(2000 + i, "hot " * 9, "en", "s", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for part in (64 << 20, 1 << 12, 1 << 9):
        placed = sharding.shard(df, shards=4, part_bytes=part).withColumn("_text", sharding.text_key())
        got = placed.orderBy("shard", "slot").select("shard", "slot", "_text").collect()
        for s in range(4):
            keys = [r["_text"] for r in got if r.shard == s]
            assert keys == sorted(keys) and [r.slot for r in got if r.shard == s] == list(range(len(keys)))


def test_copies_are_numbered(spark):
    rows = [(1, "a")] * 2500 + [(2, "b")] * 2 + [(3, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_row", row_hash("doc_id", "text"))
    got = Counter(rows_of(with_copies(df, repeated_rows(df)), "doc_id", "_copy"))
    assert got == Counter([(1, i) for i in range(2500)] + [(2, 0), (2, 1), (3, 0)])


def test_repeated_rows_are_mixed_like_others(spark):
    rows = [(1, "a row of words", "en", "s1", 0)] * 3000 + [(i, f"other words {i} here", "en", "s2", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    mix = mixing.Mix(df, block_words=16)
    assert mix.narrow.groupBy("_bucket").count().agg({"count": "max"}).first()[0] < 1500
    got = mixing.taken(mix).collect()
    assert len(got) == 3050 and all(r.taken <= 3 * r["size"] for r in got)
    for name in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == name]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 16


def test_place_of_inverts_the_permutation():
    for n in (1, 2, 3, 17, 1000, 70_000):
        for key in (99, 12345678901234567):
            place = mixing.place_of(n - 1, n, np.uint64(key))
            assert mixing.permuted(np.array([place]), n, np.array([key], np.uint64))[0] == n - 1


def test_secret_scan_leaves_prose_alone(spark, sf):
    """On 1,000 documents at most one false span per 100,000 words, and random mixed strings are found."""
    big = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    got = secrets.scan(big).collect()
    texts = {r.doc_id: r.text for r in big.collect()}
    n_words = sum(len(brute.words(t)) for t in texts.values())
    prose = [texts[r.doc_id][int(a) : int(b)] for r in got for kind, a, b in (s.split(":") for s in r.spans.split(",") if s) if kind == "random"]
    assert sum(s.isalpha() for s in prose) <= n_words / 1e5, prose
    tokens, draw = secrets.encoding(open(secrets.VOCABULARY, "rb").read()), np.random.default_rng(3)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    for n in (12, 16, 20, 32):
        keys = ["".join(draw.choice(letters, n)) for _ in range(200)]
        found = [secrets.random_spans(f"the key {k} is", tokens, secrets.base_spans(f"the key {k} is"), secrets.MAX_RATIO) for k in keys]
        assert sum(f == [("random", 8, 8 + n)] for f in found) >= 190


def test_spans_apart():
    draw = np.random.default_rng(6)
    spans = [("x", int(a), int(a + b)) for a, b in zip(draw.integers(0, 300, 200), draw.integers(1, 9, 200))]
    found = [(float(p), s) for p, s in zip(draw.integers(0, 5, 150), spans)]
    taken, want = [s[1:] for s in spans[150:]], []
    for _, s in sorted(found, key=lambda f: (-f[0], f[1][1], f[1][2], f[1][0])):
        if all(s[2] <= a or b <= s[1] for a, b in taken):
            want.append(s), taken.append(s[1:])
    assert apart(found, spans[150:]) == want and want
