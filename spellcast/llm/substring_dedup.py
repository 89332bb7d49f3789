"""Substring dedup on a De Bruijn graph of word windows.

A window of ``WORDS`` words is an edge between its first and its last words. Only windows that occur
in two documents or more can be removed, so the graph is built of those:

0. Documents with the text of a smaller id lose every window, so they stay out of the graph.
1. Minimizers (the smallest hash of ``CORE`` consecutive words inside a window) are counted over all
   documents. Equal windows have equal minimizers, so a window whose minimizer is in one document only
   is unique. This sends about a quarter of a row per window through the shuffle instead of one.
2. The other windows become edges: hash and source coordinate (document, key of the text, position).
   Per hash: the smallest source, and a fingerprint of all its coordinates and of those one word
   further on. The fingerprint is a sum, in which repeated rows don't cancel, and the key keeps apart
   the texts of rows that share an id.
3. An edge continues the one before it in the smallest source where the path does not branch: the
   coordinates after the former are the coordinates of the latter. Joined along the source coordinates,
   such edges compact to paths (first edge, number of edges, source).
4. First edges are joined to their occurrences, which gives spans (document, start, length, source
   document, source start). A span is verified by comparing the digests of the words at both
   coordinates; verified spans in documents after their source are removed.

Defined cases: NULL and empty texts have no words; texts shorter than a window lose nothing; rows that
share an id are one document, so they never remove from each other, and each gets its row; rows with a
NULL id are one document after all others; other columns are ignored unless carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spellcast.llm.text import hash_lists, slices, window_hashes, word_hashes

WORDS = 13
CORE = 6
_LAST = 2**63 - 1


def minimizers(hashes: np.ndarray, words: int = WORDS, core: int = CORE) -> np.ndarray:
    """Per window of ``words`` words: the smallest scattered hash of its ``core``-word parts."""
    if len(hashes) < words:
        return np.zeros(0, dtype=np.uint64)
    parts = window_hashes(hashes, core)
    return np.lib.stride_tricks.sliding_window_view(parts, words - core + 1).min(axis=1)


def _anchors(texts: DataFrame, words: int) -> DataFrame:
    """Distinct minimizers of every document."""
    rows = texts.withColumn("h", word_hashes(F.col("text"))).drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [np.unique(minimizers(h, words)) for h in hash_lists(part.column("h"))]
                ids = np.repeat(part.column("doc_id").to_numpy(zero_copy_only=False), list(map(len, found)))
                flat = np.concatenate(found).view(np.int64)
                for start in range(0, len(flat), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(flat[start : start + 100_000]), pa.array(ids[start : start + 100_000])], names=["anchor", "doc_id"])

    return rows.mapInArrow(run, "anchor long, doc_id long")


def _edges(rows: DataFrame, words: int) -> DataFrame:
    """Windows with a shared minimizer: edge hash and source coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 64):
                ids, keys = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "key"))
                for doc_id, key, h, shared in zip(ids, keys, hash_lists(part.column("h")), hash_lists(part.column("anchors"))):
                    least = minimizers(h, words)
                    shared = np.sort(shared)
                    at = np.minimum(np.searchsorted(shared, least), len(shared) - 1)
                    places = np.flatnonzero(shared[at] == least)
                    edges = window_hashes(h, words)
                    for start in range(0, len(places), 100_000):
                        p = places[start : start + 100_000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(edges[p].view(np.int64)), *(pa.array(np.full(len(p), x, dtype=np.int64)) for x in (doc_id, key)), pa.array(p.astype(np.int32))],
                            names=["edge", "doc_id", "key", "pos"],
                        )

    return rows.mapInArrow(run, "edge long, doc_id long, key long, pos int")


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _digests(rows: DataFrame) -> DataFrame:
    """Digests of the requested word spans (start, n) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, starts, lengths, digests = [], [], [], []
                for doc_id, text, spans in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                    words = text.encode().split()
                    for s in spans:
                        ids.append(doc_id)
                        starts.append(s["start"])
                        lengths.append(s["n"])
                        digests.append(_digest(words[s["start"] : s["start"] + s["n"]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(digests, pa.binary())],
                    names=["source", "source_start", "n", "digest"],
                )

    return rows.mapInArrow(run, "source long, source_start int, n int, digest binary")


def paths(edges: DataFrame, words: int = WORDS) -> DataFrame:
    """Nonbranching paths of edges that occur in two documents or more.

    Per path: its first edge, the smallest source coordinate, and the number of words it spans.
    ``edges`` must be partitioned by ``edge``.
    """
    def places(further: int) -> list[Column]:
        # Both halves of the hashes are summed, so that no sum overflows below 2**31 places.
        place = F.xxhash64("doc_id", "key", F.col("pos") + further)
        return [F.sum(place.bitwiseAND(F.lit(2**32 - 1))), F.sum(F.shiftrightunsigned(place, 32))]

    sums = {"at": places(0), "after": places(1)}
    distinct = edges.groupBy("edge").agg(
        F.min(F.struct("doc_id", "key", "pos")).alias("first"), F.max("doc_id").alias("last_doc"),
        *(half.alias(f"{name}_{i}") for name, halves in sums.items() for i, half in enumerate(halves)),
    ).filter("first.doc_id < last_doc")
    placed = distinct.select(
        "edge", F.col("first.doc_id").alias("source"), F.col("first.key").alias("source_key"), F.col("first.pos").alias("source_start"),
        *(F.xxhash64(f"{name}_0", f"{name}_1").alias(name) for name in sums),
    )
    along = Window.partitionBy("source", "source_key").orderBy("source_start")
    before = F.lag(F.struct("source_start", "after")).over(along)
    continues = (before["source_start"] == F.col("source_start") - 1) & (before["after"] == F.col("at"))
    heads = placed.withColumn("is_head", ~F.coalesce(continues, F.lit(False)))
    heads = heads.withColumn("path", F.sum(F.col("is_head").cast("int")).over(along))
    return heads.groupBy("source", "source_key", "path").agg(
        F.min("source_start").alias("source_start"),
        F.min_by("edge", "source_start").alias("edge"),
        (F.count(F.lit(1)) + words - 1).cast("int").alias("n"),
    ).drop("path", "source_key")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, text, carried (a struct of the named columns), n_words, n_removed, kept_text.

    ``kept_text`` has the kept words joined by single spaces. All parts form one query. The texts and
    the edges are used several times with the same columns and filters, so that each of them is
    shuffled once and read again.
    """
    carried = F.struct(*(carry or (id_col,)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("whole"), carried.alias("carried")
    )
    short = rows.select("doc_id", "whole")
    leads = short.groupBy("whole").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).filter("lead < last")
    copies = short.join(leads, "whole").filter("lead < doc_id").groupBy("doc_id").agg(F.collect_set("whole").alias("copied"))
    by_doc = rows.repartition("doc_id").join(copies, "doc_id", "left").withColumn("is_copy", F.coalesce(F.array_contains("copied", F.col("whole")), F.lit(False)))
    own = by_doc.filter("not is_copy")

    anchors = _anchors(own.select("doc_id", "text", "carried"), words)
    shared = anchors.withColumn("docs", F.count(F.lit(1)).over(Window.partitionBy("anchor"))).filter("docs > 1")
    wanted = shared.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    found = own.join(wanted, "doc_id").select("doc_id", word_hashes(F.col("text")).alias("h"), F.xxhash64("whole").alias("key"), "anchors", "carried")
    edges = _edges(found, words).filter("edge is not null and doc_id is not null").repartition("edge")

    places = edges.select("edge", "doc_id", "key", F.col("pos").alias("start"))
    spans = paths(edges, words).join(places, "edge").filter("source < doc_id")
    asked = spans.groupBy("source", "source_start", "n").agg(F.min(F.struct("doc_id", "key", "start")).alias("asker"))
    asked = asked.groupBy(F.col("source").alias("doc_id")).agg(F.collect_list(F.struct(F.col("source_start").alias("start"), "n", "asker")).alias("spans"))
    digests = _digests(own.join(asked, "doc_id").select("doc_id", "text", "carried", "spans")).distinct()
    checked = spans.join(digests, ["source", "source_start", "n"])
    checked = checked.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "digest", "key")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = {name: part.column(name) for name in ("doc_id", "text", "carried")}
                sizes, removed, kept = [], [], []
                for text, key, is_copy, found in zip(*(part.column(c).to_pylist() for c in ("text", "key", "is_copy", "spans"))):
                    tokens = text.encode().split()
                    keep = bytearray(b"\0" if is_copy and len(tokens) >= words else b"\1") * len(tokens)
                    for s in found or ():
                        a, b = s["start"], s["start"] + s["n"]
                        if s["key"] == key and _digest(tokens[a:b]) == s["digest"]:
                            keep[a:b] = bytes(b - a)
                    left = tokens if not found and not is_copy else [w for w, k in zip(tokens, keep) if k]
                    sizes.append(len(tokens))
                    removed.append(len(tokens) - len(left))
                    kept.append(b" ".join(left).decode())
                out |= {"n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())}
                yield pa.RecordBatch.from_pydict(out)

    judged = by_doc.join(checked, "doc_id", "left").select("doc_id", "text", F.xxhash64("whole").alias("key"), "carried", "is_copy", "spans")
    carried_type = dict(rows.dtypes)["carried"]
    out = judged.mapInArrow(run, f"doc_id long, text string, carried {carried_type}, n_words long, n_removed long, kept_text string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_LAST)))
