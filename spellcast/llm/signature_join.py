"""Similarity join of shingle sets by PartEnum signatures, confirmed on full sets.

Sets with a Jaccard similarity of ``PERCENT`` differ in at most (a + b) * (100 - PERCENT) / (100 +
PERCENT) shingles, where a and b are their sizes. Sizes are cut into bands; around each border between
two of them lies a further band, a seam, so that two similar sets always share a band.

1. In a band where similar sets differ in at most k shingles, the shingle domain is cut by hash into
   more than k / (K2 + 1) partitions, and each of these into N2 cells. Then in one partition two similar
   sets differ in at most K2 shingles, so N2 - K2 of its cells hold the same shingles in both.
2. For every partition and every choice of N2 - K2 of its cells a set has one signature, a hash of its
   shingles in these cells. So two similar sets share a signature.
3. A choice of cells that is empty in a set says nothing, and would bring all such sets together. A
   partition with at least K2 + 1 filled cells needs no signature of empty ones, as a filled cell is
   among those that agree. So a set is signed in its first partitions only, up to as many of that kind
   as must hold one in which it agrees with any similar set, and for filled choices only. Where it has
   too few, it is signed again with another hash, until it has enough or ``TRIES`` is reached, when
   it gives its empty signatures too. No pair is lost: under the first hash under which either set has
   enough, both are signed, and the set with more partitions is signed in all those of the other.
4. Sets that share a signature are candidates; signatures with the same sets are one bucket. Candidates
   with so many shingles that no other candidate has that they can't reach the limit are set aside,
   which most are that share only a passage. Every bucket has a leader; in ``ROUNDS`` rounds, with other
   leaders each, a set is compared with the one that leads most of its buckets in other components,
   one pair a set. In the end the members outside a bucket's main component are compared
   with its other components. Pairs are screened by bounds (sizes, shingles of their own, and parities of
   shingle counts by hash, which bound the number of different ones from below) and confirmed by
   intersecting the full sets.

Equal sets collapse to one before anything is compared; no pairs within a component are made.

Defined cases: NULL and empty texts have no shingles and link with nothing; texts of fewer words than
a shingle are one shingle; rows that share an id are one document, whose texts are linked, each with
its row; a row without id has the smallest id of its component, or NULL if that has none; ids below
-2**62 are reserved; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.llm.components import connect
from spellcast.llm.text import keyed_hashes, long_lists, mixed, set_lists, slices
from spellcast.session import checkpointed, shared_folder
from spellcast.sources.io import delete_path

WORDS = 5
PERCENT = 80
#: Differences that a partition may have, and cells of a partition.
K2, N2 = 1, 3
#: Sizes of a band: from one size up to this often the largest size similar to the one before.
STEPS = 4
#: Times that every set is compared with a leader before pairs are.
ROUNDS = 4
#: Hashes under which a set is signed before its empty signatures are needed.
TRIES = 8
#: Hash cells, a multiple of 64. The cells in which two sets have an odd and an even number of shingles
#: are no more than the shingles in which they differ.
CELLS = 1024
#: Bits of the filter of wanted documents; its size is fixed, and a full filter lets every document pass.
FILTER_BITS = 24

_CHOICES = list(combinations(range(N2), N2 - K2))


def differences(a: int, b: int) -> int:
    """The most shingles in which similar sets of these sizes can differ."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def partner(n: int) -> int:
    """The largest size of a set similar to one of size ``n``."""
    return n * 100 // PERCENT


@lru_cache(maxsize=2**16)
def bands(n: int) -> tuple[tuple[int, int, int], ...]:
    """The bands of a set of size ``n``: number, most differences in the band, and most for this set."""
    found, low, i = [], 1, 0
    while PERCENT * low <= 100 * n:
        high = low
        for _ in range(STEPS):
            high = partner(high)
        if low <= n <= high:
            found.append((2 * i, differences(high, high), differences(n, min(high, partner(n)))))
        if n <= partner(high) and high < partner(n):  # the seam between this band and the next
            found.append((2 * i + 1, differences(high, partner(high)), differences(n, partner(n) if n <= high else high)))
        low, i = high + 1, i + 1
    return tuple(found)


def signatures(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets that follow each other in ``values``, and the number of the set of each.

    Sets so small that only equal ones are similar have none, as equal sets are one.
    """
    starts = np.concatenate([[0], ends[:-1]])
    jobs = [(k, band, most, own) for k, n in enumerate((ends - starts).tolist()) for band, most, own in bands(n) if own]
    out, of = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for seed in range(TRIES):
        if not jobs:
            break
        doc, band, most, own = np.array(jobs, dtype=np.int64).T
        need = own // (K2 + 1) + 1
        parts = most // (K2 + 1) + 1
        parts += parts // 16
        n = (ends - starts)[doc]
        job = np.repeat(np.arange(len(jobs)), n)
        place = np.arange(len(job)) + np.repeat(starts[doc] - (np.cumsum(n) - n), n)
        tag = (band * TRIES + seed + 1).astype(np.uint64) << np.uint64(36)
        spread = mixed(values[place] ^ tag[job])
        first = np.cumsum(parts) - parts
        cell = ((spread >> np.uint64(32)) * (parts * N2).astype(np.uint64)[job] >> np.uint64(32)).astype(np.int64) + (first * N2)[job]
        sums = np.zeros(parts.sum() * N2, dtype=np.uint64)
        np.add.at(sums, cell, mixed(spread))
        filled = (np.bincount(cell, minlength=len(sums)) > 0).reshape(-1, N2)
        sums = sums.reshape(-1, N2)
        of_part = np.repeat(np.arange(len(jobs)), parts)
        good = np.cumsum(filled.sum(axis=1) > K2)
        before = np.concatenate([[0], good])  # good partitions of all jobs before each partition
        enough = before[first + parts] - before[first] >= need
        asked = before[:-1] - before[first][of_part] < need[of_part]
        last = seed == TRIES - 1
        slot = (np.arange(len(of_part)) - first[of_part]).astype(np.uint64)
        for c, choice in enumerate(_CHOICES):
            taken = asked & (filled[:, choice].any(axis=1) | (last & ~enough[of_part]))
            salt = mixed(slot[taken] * np.uint64(len(_CHOICES)) + np.uint64(c) + tag[of_part[taken]])
            out.append(mixed(sums[taken][:, choice].sum(axis=1, dtype=np.uint64) ^ salt))
            of.append(doc[of_part[taken]])
        jobs = [j for j, done in zip(jobs, enough.tolist()) if not done]
    return np.concatenate(out), np.concatenate(of)


def _digests(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of each whole set."""
    out = []
    for seed in (1, 2):
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(values, seed), dtype=np.uint64)])
        out.append((total[ends] - total[np.concatenate([[0], ends[:-1]])]).view(np.int64))
    return out[0], out[1]


def sized(keyed: DataFrame) -> DataFrame:
    """Per row: key, doc_id, n (set size) and two digests of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values, ends = set_lists(part.column("h"), WORDS)
                k1, k2 = _digests(values, ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), pa.array(np.diff(ends, prepend=0)), pa.array(k1), pa.array(k2)],
                    names=["key", "doc_id", "n", "k1", "k2"],
                )

    return keyed.mapInArrow(run, "key long, doc_id long, n long, k1 long, k2 long")


def _filter_place(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 64 - FILTER_BITS)


def wanted_filter(keys: DataFrame) -> np.ndarray:
    """A bit for the hash of every key, gathered word by word on the executors; 2 MB at most."""
    place = _filter_place(F.col("key"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(2 ** (FILTER_BITS - 6), dtype=np.uint64)
    found = words.toArrow()
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _passing(part: pa.RecordBatch, wanted: np.ndarray) -> pa.RecordBatch:
    """The rows whose document passes the filter."""
    place = part.column("place").to_numpy()
    return part.filter(pa.array(wanted[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1) == 1))


def _placed(keyed: DataFrame) -> DataFrame:
    return keyed.select("key", _filter_place(F.col("key")).alias("place"), "h")


def signed(keyed: DataFrame) -> DataFrame:
    """Rows (key, sig), one a signature. Of equal sets that a task reads, the first one is signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in slices(batch):
                values, ends = set_lists(part.column("h"), WORDS)
                new = []
                for digest in zip(*(k.tolist() for k in _digests(values, ends))):
                    new.append(digest not in seen)
                    seen.add(digest)
                size = np.diff(ends, prepend=0)
                chosen = np.array(new, dtype=bool)
                found, of = signatures(values[np.repeat(chosen, size)], np.cumsum(size[chosen]))
                keys = part.column("key").to_numpy()[chosen][of]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(found.view(np.int64))], names=["key", "sig"])

    return keyed.select("key", "h").mapInArrow(run, "key long not null, sig long not null")


def sharing(every: DataFrame) -> DataFrame:
    """Rows of ``every`` (key, sig) whose signature another document has too; both sides read one shuffle."""
    return every.alias("a").join(every.alias("b"), F.expr("a.sig = b.sig and a.key <> b.key"), "left_semi")


def shingled(keyed: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Rows (key, k1, k2, shingles, odd) of the texts that pass the filter: the set, its digests and the parities by hash cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                part = _passing(part, wanted)
                if not part.num_rows:
                    continue
                values, ends = set_lists(part.column("h"), WORDS)
                k1, k2 = _digests(values, ends)
                found = np.split(values, ends[:-1])
                odd = [parities(s) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(k1), pa.array(k2), long_lists(found), long_lists(odd)],
                    names=["key", "k1", "k2", "shingles", "odd"],
                )

    return _placed(keyed).mapInArrow(run, "key long, k1 long, k2 long, shingles array<long>, odd array<long>")


def parities(values: np.ndarray) -> np.ndarray:
    """A bit a hash cell: whether the set has an odd number of shingles there."""
    counts = np.bincount((mixed(values, 3) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<u8").astype(np.uint64)


def own_counts(keyed: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Rows (key, own): for documents that pass the filter, how many shingles no other one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                part = _passing(part, wanted)
                values, ends = set_lists(part.column("h"), WORDS)
                keys = np.repeat(part.column("key").to_numpy(), np.diff(ends, prepend=0))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values.view(np.int64))], names=["key", "shingle"])

    each = _placed(keyed).mapInArrow(run, "key long, shingle long")
    single = each.groupBy("shingle").agg(F.min("key").alias("key"), F.max("key").alias("last")).filter("key = last")
    return single.groupBy("key").agg(F.count(F.lit(1)).alias("own"))


def _may_link(n_a: Column, own_a: Column, odd_a: Column, n_b: Column, own_b: Column, odd_b: Column) -> Column:
    """Whether two sets can reach the limit by their sizes, own shingles and parities."""
    most = F.least(n_a - own_a, n_b - own_b)
    apart = reduce(lambda a, b: a + b, [F.bit_count(odd_a[i].bitwiseXOR(odd_b[i])) for i in range(CELLS // 64)])
    return (100 * most >= PERCENT * (n_a + n_b - most)) & (apart * (100 + PERCENT) <= (n_a + n_b) * (100 - PERCENT))


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with columns of ``table`` (node, ...) for both ends, named column_a and column_b."""
    for end in "ab":
        pairs = pairs.join(table.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
    return pairs


def _links(pairs: DataFrame, facts: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the limit."""
    seen = _both(pairs, facts, "n", "own", "odd").filter(_may_link(*(F.col(f"{c}_{e}") for e in "ab" for c in ("n", "own", "odd"))))
    full = _both(seen.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n")), sets, "shingles")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return full.select("a", "b", "n", shared.alias("shared")).filter(100 * F.col("shared") >= PERCENT * (F.col("n") - F.col("shared"))).select("a", "b")


def _buckets(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (bucket, node): the sets that share signatures; signatures with the same documents are one bucket.

    ``nodes`` (key, node) gives the sets of a document's texts. Rows of one signature are only
    brought together in joins and sums, which can be split; the name of a bucket is a hash of its
    documents, and a chance collision of two would only add candidates.
    """
    spark = keyed.sparkSession
    place = f"{shared_folder(spark)}/signatures-{uuid.uuid4().hex}"
    sharing(signed(keyed)).write.parquet(place)
    shared = spark.read.schema("key long, sig long").parquet(place)
    content = shared.groupBy("sig").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y")
    )
    bucket = F.xxhash64("n", "x", "y").alias("bucket")
    members = checkpointed(shared.join(content.select("sig", bucket), "sig").select("bucket", "key").distinct())
    delete_path(spark, place)
    members = members.join(nodes, "key").select("bucket", "node").distinct()
    several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    return checkpointed(members.join(several, "bucket"))


def _led(members: DataFrame, labels: DataFrame, order: Column) -> DataFrame:
    """Pairs (a, b, buckets) of a bucket's leader and its members in other components, with the buckets that give a pair."""
    placed = members.join(labels, "node")
    leaders = placed.groupBy("bucket").agg(F.min_by(F.struct("node", "comp"), order).alias("lead"))
    apart = placed.join(leaders, "bucket").filter("lead.comp <> comp").select(F.col("node").alias("a"), F.col("lead.node").alias("b"))
    return apart.groupBy("a", "b").agg(F.count(F.lit(1)).alias("buckets"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id that links lead to."""
    keyed = keyed_hashes(docs, id_col, text_col)
    rows = checkpointed(sized(keyed))
    distinct = rows.filter("n > 0").groupBy("k1", "k2").agg(F.min("key").alias("key"), F.min("doc_id").alias("least"), F.min("n").alias("n"))
    distinct = checkpointed(distinct.withColumn("node", F.monotonically_increasing_id()))
    nodes = rows.filter("n > 0").join(distinct.select("k1", "k2", "node"), ["k1", "k2"]).select("key", "node").distinct()

    several = checkpointed(nodes.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b"))

    # Sets that can't reach the limit with any other candidate go; documents with several texts stay.
    members = _buckets(keyed, nodes)
    same = ["key", "k1", "k2"]
    found = checkpointed(distinct.join(members.select("node").distinct(), "node", "left_semi").select(*same, "node", "n"))
    own = own_counts(keyed, wanted_filter(found.select("key"))).join(several.select("key"), "key", "left_anti")
    able = found.join(own, "key", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    able = checkpointed(able.filter(100 * (F.col("n") - F.col("own")) >= PERCENT * F.col("n")))
    members = checkpointed(members.join(able.select("node"), "node"))
    full = shingled(keyed, wanted_filter(able.select("key")))
    sets = checkpointed(full.join(able, same).dropDuplicates(same).select("node", "n", "own", "odd", "shingles"))
    facts = sets.drop("shingles")

    # Texts of one document are linked, whatever they share.
    of_one = checkpointed(nodes.join(several, "key").filter(F.col("node") > F.col("a")).select("a", F.col("node").alias("b")))
    start = able.select("node").union(of_one.select("a")).union(of_one.select("b")).distinct()
    labels = connect(checkpointed(start.select("node", F.col("node").alias("comp"))), of_one)

    # Every set with the leader that it shares most buckets with, other leaders each time.
    for seed in range(ROUNDS):
        order = F.xxhash64("node", F.lit(seed)) if seed else F.col("node")
        most = _led(members, labels, order).groupBy("a").agg(F.max_by("b", F.struct("buckets", "b")).alias("b"))
        labels = connect(labels, checkpointed(_links(most, facts, sets)))

    # What is left: members of a bucket outside its main component against its other components.
    placed = members.select("bucket", "node").join(labels, "node")
    counts = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    split = counts.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    rest = checkpointed(placed.join(split.select("bucket", "main"), "bucket").join(facts, "node"))
    outside = rest.filter("comp <> main").select("bucket", *(F.col(c).alias(f"{c}_a") for c in ("node", "comp", "n", "own", "odd")))
    apart = outside.join(rest, "bucket").filter(
        (F.col("comp_a") != F.col("comp"))
        & ((F.col("comp") == F.col("main")) | (F.col("node_a") < F.col("node")))
        & _may_link(*map(F.col, ("n_a", "own_a", "odd_a", "n", "own", "odd")))
    )
    labels = connect(labels, checkpointed(_links(apart.select(F.col("node_a").alias("a"), F.col("node").alias("b")).distinct(), facts, sets)))

    least = labels.join(distinct.select("node", "least"), "node")
    least = least.join(least.groupBy("comp").agg(F.min("least").alias("of_comp")), "comp").select("node", "of_comp")
    known = distinct.select("k1", "k2", "node", "least").join(least, "node", "left").select("k1", "k2", F.coalesce("of_comp", "least").alias("component"))
    found = rows.withColumn("has", F.col("n") > 0).join(known.withColumn("has", F.lit(True)), ["k1", "k2", "has"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
