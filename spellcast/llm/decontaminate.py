"""Benchmark decontamination: size-partitioned MinHash containment search, confirmed exactly.

Test items are partitioned by their number of shingles into classes up to 16, 32, 64, ... For each
class, documents are cut into windows of twice the class bound that advance by the bound, so an item
lies inside one window of similar size however long the document is; its containment then shows as a
similarity that plain MinHash can see. Windows and items are sketched by ``MINIMA`` hash minima, and
equal minima make a candidate. (With one minimum to a band, an item of more than 8 shingles that is contained
to 75 % of them is missed with probability below 1e-5.) Smaller items are too unlike such a window; of
these, so many shingles that a document with 75 % of the item has one of them are looked up among all
shingles of the documents, which misses none. Candidates are confirmed on the full sets of shingles.

Before the join, minima of documents pass a bitmap of the items' minima. Its size is fixed, so it can
be sent to all tasks; when items outgrow it, more minima pass and the join gives the same result.

Defined cases: NULL and empty texts contain nothing and are contained in nothing; the words of a text
with fewer than a shingle has are one shingle, so a short item is found where it is a whole text;
rows that share an id are searched one by one, and pairs are distinct; documents and items without id
are searched like others, those with one text as one (their pairs have a NULL there); other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spellcast.llm.text import document_key, hash_lists, keyed_hashes, long_lists, mixed, shingles, slices, window_hashes
from spellcast.session import checkpointed

WORDS = 5
PERCENT = 75
MINIMA = 64
SMALLEST_CLASS = 16
#: The class of items that are found by their shingles, of up to so many shingles.
PROBED = 8
BITMAP_BITS = 23

_random = np.random.default_rng(77)
_FACTOR = _random.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDEND = _random.integers(0, 2**63, MINIMA, dtype=np.uint64)
_SLOT = np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def _hashed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return values[:, None] * _FACTOR + _ADDEND


def _keys(least: np.ndarray, bound: int) -> np.ndarray:
    """Minima with their slot and size class in one 64-bit key."""
    return mixed(least ^ _SLOT, bound)


def size_class(n: int) -> int:
    return PROBED if n <= PROBED else max(SMALLEST_CLASS, 1 << (n - 1).bit_length())


def item_keys(values: np.ndarray, bound: int) -> np.ndarray:
    """Keys that find an item of these shingles: minima, or for a small item shingles of which a match has one at least."""
    if bound == PROBED:
        needed = -(-PERCENT * len(values) // 100)
        return mixed(values[: len(values) - needed + 1], PROBED)
    return _keys(_hashed(values).min(axis=0), bound)


def item_sketches(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Per item: item (its key), item_id, size class, shingles, sketch keys."""
    rows = keyed_hashes(items, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [shingles(h, WORDS) for h in hash_lists(part.column("h"))]
                bounds = [size_class(len(s)) if len(s) else 0 for s in sets]
                keys = [item_keys(s, b) if b else s for s, b in zip(sets, bounds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), pa.array(bounds, pa.int32()), long_lists(sets), long_lists(keys)],
                    names=["item", "item_id", "bound", "shingles", "keys"],
                )

    return rows.mapInArrow(run, "item long, item_id long, bound int, shingles array<long>, keys array<long>").filter("bound > 0")


def _passing(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = keys >> np.uint64(64 - BITMAP_BITS)
    return keys[(bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]


def document_keys(values: np.ndarray, bounds: list[int], bitmap: np.ndarray) -> np.ndarray:
    """Keys of all windows of one document, for every size class, that pass the bitmap."""
    found, least, width = [], None, 0
    for bound in bounds:
        if bound == PROBED:
            found.append(_passing(mixed(values, PROBED), bitmap))
            continue
        if least is None:
            starts = np.arange(0, len(values), bound)
            # Minima of blocks, taken in parts so that a long document needs no more memory.
            step = max(1, 4096 // bound)
            least = np.concatenate([
                np.minimum.reduceat(_hashed(values[starts[i] : starts[i] + step * bound]), starts[i : i + step] - starts[i], axis=0)
                for i in range(0, len(starts), step)
            ])
        else:
            least = np.minimum.reduceat(least, np.arange(0, len(least), bound // width), axis=0)
        width = bound
        windows = np.minimum(least[:-1], least[1:]) if len(least) > 1 else least
        found.append(_passing(_keys(windows, bound).ravel(), bitmap))
    return np.unique(np.concatenate(found))


def shingle_sets(keyed: DataFrame) -> DataFrame:
    """Per row (key, doc_id, h): key, doc_id and its distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = long_lists([shingles(h, WORDS) for h in hash_lists(part.column("h"))])
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("doc_id"), sets], names=["key", "doc_id", "doc_shingles"])

    return keyed.mapInArrow(run, "key long, doc_id long, doc_shingles array<long>")


def item_bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for the first bits of every key (column key), gathered on the executors: 2**BITMAP_BITS of them."""
    place = keys.select(F.shiftrightunsigned("key", 64 - BITMAP_BITS).alias("place"))
    bits = F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    found = place.groupBy(F.shiftright("place", 6).alias("word")).agg(bits).toArrow()
    words = np.zeros(1 << (BITMAP_BITS - 6), dtype="<u8")
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words.view(np.uint8)


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **item_columns: str) -> DataFrame:
    """Pairs (doc_id, item_id) with n_item and n_shared shingles, where n_shared reaches 75 % of n_item; and the document's key."""
    sketched = checkpointed(item_sketches(items, **item_columns))
    exploded = sketched.select("item", F.explode("keys").alias("key"))
    bounds = sorted(r.bound for r in sketched.select("bound").distinct().collect())  # at most one per power of two
    sent = docs.sparkSession.sparkContext.broadcast(item_bitmap(exploded))
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = []
                for h in hash_lists(part.column("h")):
                    values = window_hashes(h, min(WORDS, len(h))) if len(h) else h
                    found.append(document_keys(values, bounds, sent.value) if len(values) and bounds else values[:0])
                ids = np.repeat(part.column("key").to_numpy(), list(map(len, found)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate(found).view(np.int64))], names=["doc", "key"])

    hits = keyed_hashes(named, "doc_id", "text").select("key", "h").mapInArrow(run, "doc long, key long")
    pairs = checkpointed(hits.join(exploded, "key").select(F.col("doc").alias("key"), "item").distinct())
    placed = named.withColumn("_key", document_key(F.col("doc_id"), F.col("text")))
    candidates = placed.join(pairs.select(F.col("key").alias("_key")).distinct(), "_key", "left_semi")
    sizes = shingle_sets(keyed_hashes(candidates, "doc_id", "text")).join(pairs, "key").join(sketched.select("item", "item_id", "shingles"), "item").select(
        "key", "doc_id", "item", "item_id",
        F.size("shingles").cast("long").alias("n_item"),
        F.size(F.array_intersect("shingles", "doc_shingles")).cast("long").alias("n_shared"),
    )
    best = sizes.groupBy("key", "doc_id", "item", "item_id").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))
    return best.filter(100 * F.col("n_shared") >= PERCENT * F.col("n_item")).select("doc_id", "item_id", "n_item", "n_shared", "key")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **item_columns: str) -> DataFrame:
    """Rows of ``docs`` that contain no test item."""
    leaks = contained(docs, items, id_col, text_col, **item_columns).select(F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", document_key(F.col(id_col), F.col(text_col)))
    return keyed.join(leaks, "__key", "left_anti").drop("__key")
