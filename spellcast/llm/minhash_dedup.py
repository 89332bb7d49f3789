"""Near-duplicate components by b-bit MinHash, confirmed on full shingle sets.

1. Every document gets its set size, a key of its whole set, band keys of its MinHash minima and a
   signature of their lowest ``BITS`` bits. The sketches are written once to the checkpoint folder.
2. Documents with equal sets collapse to the smallest id before anything is compared, so exact copies
   never meet in pairs.
3. Representatives that share a band are candidates; a filter of fixed size keeps most other texts from
   being shuffled to them. Those with so many shingles of their own (in no
   other candidate's set) that no link is possible are set aside, in two passes; this is exact.
4. In a few rounds (over some bands, then over all, by the smallest share of own shingles and then by
   scattered ids) every band has one leader that the members of other components are compared with;
   afterwards only members that are still in another component than the band's main one are compared
   with all of the band's other components, each pair in the first band that it shares. So the pairs
   within one component are never enumerated, and no pair that could connect two components is left out.
5. Pairs are screened by their sizes and own shingles, which bound the similarity, and by the
   similarity that the signatures' equal fields give after correction for chance collisions; links are
   then confirmed by intersecting the full sets.

With 51 bands of 5 minima a pair at similarity 0.75 shares no band with probability 1e-6; the screen
stands 4 standard deviations below the limit.

Defined cases: NULL and empty texts have no shingles and link with nothing; texts of fewer words than
a shingle are one shingle; equal sets are linked; rows that share an id are one document, whose texts
are linked, each with its row; rows without id that share a text are one document as well, their
component is the smallest id linked with it or NULL if there is none, and of a component without ids
one document is kept; ids below -2**61 are reserved; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.llm.components import connect
from spellcast.llm.text import document_key, hash_lists, long_lists, lower_ascii, mixed, shingles, slices, word_hashes, words
from spellcast.session import checkpointed

WORDS = 5
PERCENT = 75
BANDS, ROWS, BITS = 51, 5, 2
FIRST_BANDS = 4
#: Bits of the filter of candidates' ids; its size is fixed.
FILTER_BITS = 24
#: Estimated similarity below which a candidate pair isn't looked at in full.
SCREEN = 0.62

_MINIMA = BANDS * ROWS
_FIELDS = 64 // BITS
_LONGS = -(-_MINIMA // _FIELDS)
_random = np.random.default_rng(20240607)
_FACTOR = _random.integers(0, 2**63, _MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDEND = _random.integers(0, 2**63, _MINIMA, dtype=np.uint64) * np.uint64(2)
_BAND_SEED = _random.integers(0, 2**63, BANDS, dtype=np.uint64)


def minima(values: np.ndarray) -> np.ndarray:
    """MinHash minima of a set of hashes, in blocks so that a long set needs no more memory."""
    out = np.full(_MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(values), 1024):
            part = values[start : start + 1024, None] * _FACTOR + _ADDEND
            np.minimum(out, part.min(axis=0), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    key = _BAND_SEED.copy()
    for row in least.reshape(BANDS, ROWS).T:
        key = mixed(key ^ row)
    return key


def packed(least: np.ndarray) -> np.ndarray:
    """The lowest bits of all minima, a fixed number of fields to a 64-bit word."""
    low = np.zeros(_LONGS * _FIELDS, dtype=np.uint64)
    low[:_MINIMA] = (least >> np.uint64(7)) & np.uint64(2**BITS - 1)
    shifts = np.arange(_FIELDS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(_LONGS, _FIELDS) << shifts, axis=1)


def similarity(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures, corrected for equal bits by chance."""
    differ = F.lit(0)
    for i in range(_LONGS):
        x = a[i].bitwiseXOR(b[i])
        differ = differ + F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(0x5555555555555555)))
    chance = 1 / 2**BITS
    return ((1 - differ / _MINIMA) - chance) / (1 - chance)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, two keys of the whole set, band keys and packed signature."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), word_hashes(lower_ascii(F.col(text_col))).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for part in slices(batch):
                sizes, keys, bands, bits = [], [], [], []
                for h in hash_lists(part.column("h")):
                    s = shingles(h, WORDS)
                    sizes.append(len(s))
                    with np.errstate(over="ignore"):
                        keys.append((mixed(s, 1).sum(dtype=np.uint64), mixed(s, 2).sum(dtype=np.uint64)))
                    least = minima(s) if len(s) else None
                    bands.append(none if least is None else band_keys(least))
                    bits.append(none if least is None else packed(least))
                k = np.array(keys, dtype=np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]), long_lists(bands), long_lists(bits)],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "bits"],
                )

    return rows.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, bits array<long>")


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and the sorted hashes of its distinct shingles."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), word_hashes(lower_ascii(F.col(text_col))).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = long_lists([shingles(h, WORDS) for h in hash_lists(part.column("h"))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], names=["doc_id", "shingles"])

    return rows.mapInArrow(run, "doc_id long, shingles array<long>")


def _likely(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``texts`` without most of those whose doc_id is no node, so that few texts are shuffled to be joined.

    A bit for the hash of every node, 64 to a row: a table of at most ``2**(FILTER_BITS - 6)`` rows,
    whatever the number of nodes. A full table lets every text pass; the join that follows is exact.
    """

    def bit(key: Column) -> tuple[Column, Column]:
        place = F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 64 - FILTER_BITS)
        return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))

    word, mask = bit(F.col("node"))
    table = nodes.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    word, mask = bit(F.col("doc_id"))
    return texts.join(F.broadcast(table), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(mask) != 0), "left_semi")


def _own_counts(sets: DataFrame) -> DataFrame:
    """Per node of ``sets`` (node, shingles): its size n and its own shingles, those that no other set has.

    Nodes with several sets (rows that share an id) get no own ones, so that they are never set aside.
    """
    each = sets.select("node", F.explode("shingles").alias("shingle"))
    single = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("node").alias("node")).filter("sets = 1")
    own = single.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.groupBy("node").agg(F.count(F.lit(1)).alias("sets"), F.max(F.size("shingles")).alias("n"))
    return sizes.join(own, "node", "left").select("node", "n", F.when(F.col("sets") == 1, F.coalesce("own", F.lit(0))).otherwise(F.lit(0)).alias("own"))


def _reachable(n_a: Column, own_a: Column, n_b: Column, own_b: Column) -> Column:
    """Whether two sets of these sizes, which don't share their own shingles, can reach the limit."""
    most = F.least(n_a - own_a, n_b - own_b)
    return 100 * most >= PERCENT * (n_a + n_b - most)


def _with(pairs: DataFrame, table: DataFrame, key: str, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with columns of ``table`` for both ends, named column_a and column_b."""
    for end in "ab":
        pairs = pairs.join(table.select(F.col(key).alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
    return pairs


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the limit."""
    both = _with(pairs, sets, "node", "shingles")
    n = F.size("shingles_a") + F.size("shingles_b")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both.select("a", "b", n.alias("n"), shared.alias("shared")).filter(100 * F.col("shared") >= PERCENT * (F.col("n") - F.col("shared"))).select("a", "b")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable) and kept, where an id has one text."""
    rows = checkpointed(sketches(docs, id_col, text_col))
    leads = rows.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("lead"))
    distinct = rows.join(leads.withColumnRenamed("lead", "doc_id"), ["k1", "k2", "doc_id"], "left_semi").dropDuplicates(["k1", "k2", "doc_id"])

    # Bands with two members or more; one shuffle serves the count and the join.
    spread = distinct.select(F.posexplode("bands").alias("slot", "band"), F.col("doc_id").alias("node")).repartition("band")
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("band")
    members = checkpointed(spread.join(shared, "band"))
    nodes = members.select("node").distinct()
    texts = _likely(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), nodes)
    sets = checkpointed(
        shingle_sets(texts.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")).distinct()
        .withColumnRenamed("doc_id", "node")
    )

    # Sets that can't reach the limit with any other go; the second pass counts without them.
    for _ in range(2):
        able = checkpointed(_own_counts(sets).filter(100 * (F.col("n") - F.col("own")) >= PERCENT * F.col("n")))
        sets = sets.join(able.select("node"), "node", "left_semi")
    sets = checkpointed(sets)
    members = checkpointed(members.join(able.select("node", (F.col("own") / F.col("n")).alias("share")), "node"))
    labels = checkpointed(able.select("node", F.col("node").alias("comp")))
    keys = F.transform("bands", lambda k: F.shiftright(k, 32).cast("int"))
    signatures = checkpointed(distinct.select(F.col("doc_id").alias("node"), "bits", keys.alias("keys")).join(able, "node"))

    # A few bands first: they connect most of a large group, whose members need no further pairs then.
    central = F.struct("share", "node")
    for slots, order in ((FIRST_BANDS, central), (BANDS, central), (BANDS, F.xxhash64("node"))):
        placed = members.filter(F.col("slot") < slots).join(labels, "node")
        leaders = placed.groupBy("band").agg(F.min_by(F.struct("node", "comp"), order).alias("lead"))
        apart = placed.join(leaders, "band").filter("lead.comp <> comp").select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
        seen = _with(apart, signatures, "node", "bits", "n", "own")
        alike = seen.filter(_reachable(*map(F.col, ("n_a", "own_a", "n_b", "own_b"))) & (similarity(F.col("bits_a"), F.col("bits_b")) >= SCREEN)).select("a", "b")
        labels = connect(labels, checkpointed(_confirmed(alike, sets)))

    # What is left: members of a band outside its main component against all its other components.
    placed = members.select("slot", "band", "node").join(labels, "node")
    counts = placed.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed_bands = counts.groupBy("band").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    rest = checkpointed(placed.join(mixed_bands.select("band", "main"), "band").join(signatures, "node"))
    outside = rest.filter("comp <> main").select("band", *(F.col(c).alias(f"{c}_a") for c in ("node", "comp", "bits", "keys", "n", "own")))
    apart = outside.join(rest, "band").filter(
        (F.col("comp_a") != F.col("comp"))
        & ((F.col("comp") == F.col("main")) | (F.col("node_a") < F.col("node")))
        & _reachable(*map(F.col, ("n_a", "own_a", "n", "own")))
        & (similarity(F.col("bits_a"), F.col("bits")) >= SCREEN)
        & ~F.arrays_overlap(F.slice("keys_a", F.lit(1), F.col("slot")), F.slice("keys", F.lit(1), F.col("slot")))
    )
    labels = connect(labels, checkpointed(_confirmed(apart.select(F.col("node_a").alias("a"), F.col("node").alias("b")).distinct(), sets)))

    known = rows.select("doc_id", "n_shingles", "k1", "k2").join(leads, ["k1", "k2"], "left")
    lead = F.when(F.col("n_shingles") > 0, F.col("lead"))
    found = known.withColumn("node", F.coalesce(lead, F.col("doc_id"))).join(labels, "node", "left")
    component = F.coalesce("comp", "node")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _named(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (key, doc_id, text) with a key for every document and text, and the ids with several texts.

    The key is the id; rows without id, and those of an id with several texts, have one made from the text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    mark = F.xxhash64(lower_ascii(F.coalesce("text", F.lit(""))))
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).filter("a <> b")
    several = checkpointed(several.select(F.col("doc_id").alias("of"), F.lit(True).alias("many")))
    key = document_key(F.col("doc_id"), F.col("text"))
    if several.isEmpty():
        return rows.select(key.alias("key"), "doc_id", "text"), several
    made = F.lit(-(2**61) - 1) - F.xxhash64("doc_id", mark).bitwiseAND(F.lit(2**61 - 1))
    joined = rows.join(several, F.col("doc_id") == F.col("of"), "left")
    return joined.select(F.when(F.col("many"), made).otherwise(key).alias("key"), "doc_id", "text"), several


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable), kept, and the row's key."""
    named, several = _named(docs, id_col, text_col)
    found = linked(named, "key", "text").select(F.col("doc_id").alias("key"), "n_shingles", F.col("component_id").alias("comp"))
    # Only components with a made key, the smallest of their keys, need another name.
    made = found.filter("comp < 0 and n_shingles > 0")
    if several.isEmpty() and made.isEmpty():
        kept = F.coalesce(F.col("key") == F.col("comp"), F.lit(True))
        return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("comp").alias("component_id"), kept.alias("kept"), "key")
    found = checkpointed(found)
    ids = named.select("key", "doc_id").distinct()
    parts = found.filter("n_shingles > 0").select("key", "comp").distinct().join(ids, "key")
    own = parts.join(several, F.col("doc_id") == F.col("of")).select("doc_id", "comp").distinct()
    first = own.groupBy("doc_id").agg(F.min("comp").alias("a"))
    links = checkpointed(own.join(first, "doc_id").filter("comp <> a").select("a", F.col("comp").alias("b")))
    start = parts.select(F.col("comp").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    labels = connect(checkpointed(start), links).select(F.col("node").alias("comp"), F.col("comp").alias("whole"))
    least = parts.join(labels, "comp").groupBy("whole").agg(F.min("doc_id").alias("component"), F.min("key").alias("first"))
    names = labels.join(least, "whole").select("comp", "component", "first", F.lit(True).alias("has"))
    rows = found.withColumn("has", F.col("n_shingles") > 0).join(ids, "key").join(names, ["comp", "has"], "left")
    kept = F.when(~F.col("has"), True).when(F.col("component").isNull(), F.col("key") == F.col("first")).otherwise(F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)))
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), kept.alias("kept"), "key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are not kept; of rows without id and with one text, one row stays.

    A document goes with all its rows, those with an empty text too.
    """
    gone = components(docs, id_col, text_col).filter("not kept")
    known, key = F.col(id_col).isNotNull(), document_key(F.col(id_col), F.col(text_col))
    name = F.coalesce("doc_id", "key")
    left = docs.withColumn("__key", key).join(gone.select(name.alias("__key")).distinct(), "__key", "left_anti")
    known = known | (F.size(words(F.col(text_col))) == 0)
    return left.filter(known).unionByName(left.filter(~known).dropDuplicates(["__key"])).drop("__key")
