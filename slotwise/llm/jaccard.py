"""N-gram Jaccard join (op 12) over token-combination prefixes.

A document is the set of its distinct 4-word shingles, each a 64-bit hash: the tokens. Two sets link when their Jaccard
similarity is `percent` (85) or more. Equal sets are one point; only points are compared.

1. Zones. A point with n tokens misses at most e = n - ceil(percent n / 100) of them in a linked point. Its zone is the
   2e + SPARE smallest tokens; the zones of linked points share all but e tokens of the one that ends first. So a third
   of the tokens is enough to search with, and texts that share a passage, but little else, part here.
2. Prefixes. Tokens are counted over all zones and ordered by that count. Tokens of one zone only come first; they use
   up the prefix without being indexed, and a point without further need of tokens has no link at all. Tokens in up
   to FREQUENT[0] zones are indexed alone. Those above are dealt to token classes, and each class indexes pairs or (above
   FREQUENT[1]) triples of its tokens; a class of k-token combinations adds k - 1 tokens to the prefix, which is
   extended until no e misses can remove every combination. The number of classes follows the size of the set, by
   levels of a factor two, and a set near the next level is indexed on both.
3. Cells. Points that share a combination meet. Similar texts share very many, so the combinations with the same
   smallest point form one cell, in which each point is listed once. Inside a cell the overlaps of the zones are counted
   by matrix products, and points that can still be linked are joined to one star.
4. Verification (`sets.verified`). The groups of these stars hold texts that are similar to a good half. A group that
   fits one task is compared there exactly. In a larger one every point is compared with one pivot, which is linear, and
   only those that do not link to the pivot are then compared with the rest of their group, in chunks.

Links are exact up to collisions of 64-bit hashes. Components are found by contraction over stored tables.

Defined results: a null or blank text has no tokens and is linked with nothing, its `component_id` being its own id;
repeated rows and equal texts share a component; a component without any id has a null `component_id`; extra columns
are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import pick, pieces, prepare, row_hash, text_buffer
from slotwise.llm.neardup import connected, shingle_hashes
from slotwise.llm.sets import near_texts, shared_shingles, star_edges, verified
from slotwise.session import stored

SHINGLE, PERCENT = 4, 85
SPARE = 8  # tokens of a zone beyond twice the misses
FREQUENT = (64, 1024)  # zones that hold a token: above the first, pairs are indexed, above the second, triples
GROUP = 8  # tokens of a class, about, in the prefix of a set
ZONE_CHUNK = 1024  # zones of a cell that one task compares with as many others


def zone_size(n, percent: int):
    return np.minimum(n, 2 * ((100 - percent) * n // 100) + SPARE)


def least_shared(n, percent: int):
    """Tokens that the zones of a set of n tokens and of any linked set share at least."""
    smallest = -(-percent * n // 100)
    return zone_size(smallest, percent) - (100 - percent) * smallest // 100


def classes(level: int, percent: int) -> int:
    """Classes of pairs, and as many of triples, for sets of about 2^level tokens; 0: tokens are indexed alone."""
    count = max(1, (100 - percent) * 2**level // 100 // GROUP)
    return count if 3 * count < least_shared(-(-percent * 2**level // 100), percent) else 0


def levels(n: int, percent: int) -> list[int]:
    """Levels that a set of n tokens is indexed on: its own, and the next if a linked set can lie there."""
    own = n.bit_length() - 1
    return [own, own + 1] if n * 100 // percent >= 2 ** (own + 1) else [own]


def signatures(tokens: np.ndarray, counts: np.ndarray, need: int, n: int, percent: int) -> set[int]:
    """What a set is indexed under: tokens and hashes of combinations. `need`: weight of its prefix beyond unique tokens."""
    out: set[int] = set()
    order = np.lexsort((tokens, counts))
    ordered = list(zip(tokens[order].tolist(), np.searchsorted(FREQUENT, counts[order], side="left").tolist()))
    for level in levels(n, percent):
        many, left, held = classes(level, percent), need, defaultdict(list)
        for token, frequent in ordered:
            if left <= 0:
                break
            if not frequent or not many:
                out.add(token)
                left -= 1
                continue
            own = held[frequent, token % many]
            own.append(token)
            left -= len(own) > frequent
        for (frequent, _), some in held.items():
            for combination in combinations(some, frequent + 1):
                digest = xxhash.xxh64_intdigest(np.array([level, *combination], np.int64).tobytes(), frequent)
                out.add(digest - 2**64 if digest >= 2**63 else digest)
    return out


def token_sets(rows: DataFrame, keep: tuple[str, ...], shingle: int, cut, shape: str) -> DataFrame:
    """The columns `keep` and what `cut` makes of the sorted tokens of each `text`."""
    kinds = dict(rows.dtypes)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_buffer(batch.column("text"))
            whole = data.tobytes()
            sets = [np.unique(shingle_hashes(whole[a:b], shingle)) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | cut(sets))

    return rows.select(*keep, "text").mapInArrow(told, ", ".join([*(f"{c} {kinds[c]}" for c in keep), shape]))


def _zones(percent: int):
    def cut(sets: list[np.ndarray]) -> dict[str, pa.Array]:
        n = np.array([len(s) for s in sets], np.int64)
        prints = [xxhash.xxh64_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
        zones = [s[:z].view(np.int64) for s, z in zip(sets, zone_size(n, percent).tolist())]
        return {"fp": pa.array(np.array(prints, np.uint64).view(np.int64)), "n": pa.array(n), "zone": pa.array(zones, pa.list_(pa.int64()))}

    return cut


def _indexed(percent: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("shared")
            tokens, counts = (np.asarray(f) for f in column.flatten().flatten())
            offsets = np.asarray(column.offsets)
            offsets = offsets - offsets[0]
            points, owners = [], []
            for point, n, a, b in zip(batch.column("point").to_pylist(), batch.column("n").to_pylist(), offsets[:-1], offsets[1:]):
                found = signatures(tokens[a:b], counts[a:b], int(b - a - least_shared(n, percent) + 1), n, percent)
                points.append(np.fromiter(found, np.int64, len(found)))
                owners.append(np.full(len(found), point))
            yield pa.RecordBatch.from_pydict({"sig": pa.array(np.concatenate(points)), "point": pa.array(np.concatenate(owners), pa.int64())})

    return index


def _dealt(placed: DataFrame, chunk: int) -> DataFrame:
    """Lists of points that meet; a row of `placed` is a point in one `cell` of `members` points. Crowded cells go by chunks."""
    chunks = F.ceil(F.col("members") / chunk)
    point = F.struct(*[c for c in placed.columns if c not in ("cell", "members")]).alias("point")
    sent = placed.withColumn("i", F.pmod(F.xxhash64("point"), chunks)).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    tasks = sent.select(point, "cell", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    return tasks.groupBy("cell", "i", "j").agg(F.collect_list("point").alias("points")).where(F.size("points") > 1).select("points")


def _overlaps(percent: int):
    """Stars of the points of a cell whose zones share as many tokens as linked ones must."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                names, sizes, zones = batch.column("points").slice(i, 1).flatten().flatten()
                offsets = np.asarray(zones.offsets)
                shared = shared_shingles(np.asarray(zones.flatten()), offsets - offsets[0])
                n = np.asarray(sizes)
                least = zone_size(n, percent) - (100 - percent) * n // 100
                near = shared >= np.minimum(least[:, None], least[None, :])
                near &= percent * np.maximum(n[:, None], n[None, :]) <= 100 * np.minimum(n[:, None], n[None, :])
                np.fill_diagonal(near, False)
                a, b = star_edges(np.asarray(names), near)
                first.append(a)
                second.append(b)
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(first)), "b": pa.array(np.concatenate(second))})

    return links


def _least(size: Column, percent: int) -> Column:
    """`least_shared` as a column."""
    smallest = F.floor((percent * size + 99) / 100)
    misses = F.floor((100 - percent) * smallest / 100)
    return F.least(smallest, 2 * misses + SPARE) - misses


def jaccard_join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, over links of a Jaccard similarity of `percent` or more."""
    prepare(docs.sparkSession)
    rows = pick(docs, "doc_id", "text").withColumn("_row", row_hash("doc_id", "text"))
    kind = dict(rows.dtypes)["doc_id"]
    told = token_sets(rows, ("doc_id", "_row"), shingle, _zones(percent), "fp bigint, n bigint, zone array<bigint>")
    prints = stored(told, "prints")
    members = prints.select("doc_id", "_row", "fp", "n")
    # One row of each set, whose text stands for it. Sets of so few tokens that one miss is too many link to equal ones only.
    chosen = members.where(F.floor((100 - percent) * F.floor(100 * F.col("n") / percent) / 100) > 0).groupBy("fp").agg(F.min("_row").alias("_row"))
    zones = prints.join(chosen, ["fp", "_row"], "left_semi").dropDuplicates(["fp"]).select(F.col("fp").alias("point"), "n", "zone")
    zones = stored(zones, "zones")
    labels = connected(stored(_links(rows, chosen, zones, percent, shingle), "links"))
    named = members.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = named.join(labels, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    found = stored(roots.select("fp", "root").join(least, "root").select("fp", "component_id"), "components")
    alone = members.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return members.where("n > 0").join(found, "fp").select("doc_id", F.col("n").alias("n_shingles"), F.col("component_id").cast(kind).alias("component_id")).union(alone)


def _links(rows: DataFrame, chosen: DataFrame, zones: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Edges (a, b) among points that connect exactly those that chains of links connect."""
    held = zones.select("point", "n", F.explode("zone").alias("token"))
    counts = held.groupBy("token").agg(F.count("*").alias("zones")).where("zones > 1")
    met = held.join(counts, "token").groupBy("point", "n").agg(F.collect_list(F.struct("token", "zones")).alias("shared"))
    indexed = stored(met.where(F.size("shared") >= _least(F.col("n"), percent)), "shared")
    sigs = stored(indexed.mapInArrow(_indexed(percent), "sig bigint, point bigint"), "signatures")
    heads = sigs.groupBy("sig").agg(F.min("point").alias("cell"), F.count("*").alias("some")).where("some > 1").drop("some")
    met = stored(sigs.join(heads, "sig").select("cell", "point").distinct(), "cells")
    sizes = met.groupBy("cell").agg(F.count("*").alias("members"))
    short = indexed.select("point", "n", F.transform("shared", lambda s: s["token"]).alias("zone"))
    placed = met.join(sizes, "cell").join(short, "point")
    stars = _dealt(placed.select("point", "n", "zone", "cell", "members"), ZONE_CHUNK).mapInArrow(_overlaps(percent), "a bigint, b bigint").distinct()
    groups = stored(connected(stored(stars, "links")).select(F.col("fp").alias("point"), F.col("root").alias("cell")), "groups")
    wanted = stored(groups.join(chosen.select(F.col("fp").alias("point"), "_row"), "point").select("point", "_row"), "wanted")
    sets = token_sets(near_texts(rows, wanted), ("point",), shingle, lambda s: {"tokens": pa.array([x.view(np.int64) for x in s], pa.list_(pa.int64()))}, "tokens array<bigint>")
    return verified(sets, groups, percent)
