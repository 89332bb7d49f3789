"""Compression of vectors to one code a part: integer codebooks, searched with a GNAT over their entries.

1. Components become integers ``floor(scale * x)``; a vector is cut into equal consecutive parts.
2. Each part's codebook starts as that part of the vectors with the smallest ids.
3. Each round assigns every part to the nearest entry of its codebook (ties to the lower number) with
   a tree built over the entries, and replaces the entries by the floor of their parts' mean. Tasks
   send one partial sum for each entry they used; the driver holds only the codebooks, whose size is
   set by the parameters. Vectors are read from their source in every round; nothing is kept of them.
4. A last assignment gives the codes.

Defined cases: rows whose vector is NULL, empty, or has a NULL, NaN or infinite component are dropped,
and so are vectors of another length than that of the row with the smallest id whose length can be cut
into the parts; rows without id come last in the order of ids; rows that share an id are told apart by
their components; a component over ``vectors.LARGEST / scale`` is an error; rows without label are one
label; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spellcast.llm import gnat
from spellcast.llm.vectors import matrix, scaled, summed, usable
from spellcast.session import checkpointed

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors searched at once in a task, which bounds its memory.
BLOCK = 2048


def integer_vectors(rows: DataFrame, vector_col: str, keep: list[str], scale: int, parts: int) -> tuple[DataFrame, int]:
    """``rows`` as (kept columns, v) with integer vectors of the common length, and that length (0: no row)."""
    good = rows.filter(usable(F.col(vector_col)) & (F.size(vector_col) % parts == 0))
    first = good.orderBy(F.col(keep[0]).asc_nulls_last(), F.col(vector_col)).select(F.size(vector_col)).first()
    width = first[0] if first else 0
    same = good.filter(F.size(vector_col) == width)
    return same.select(*keep, scaled(F.col(vector_col), scale).alias("v")), width


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def _assigned(books: list[np.ndarray], trees: list[gnat.Node], v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances of all vectors, a column a part."""
    cut = np.split(v, len(books), axis=1)
    found = [gnat.nearest(t, b, q) for t, b, q in zip(trees, books, cut)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def partial_sums(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Rows (part, entry, n, sums): what each task's vectors add to the entries nearest to their parts."""
    trees, part_width = [gnat.build(b) for b in books], books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros_like(b) for b in books]
        for block in _blocks(batches):
            v = matrix(block.column("v"), part_width * len(books))
            numbers, _ = _assigned(books, trees, v)
            for p, cut in enumerate(np.split(v, len(books), axis=1)):
                counts[p] += np.bincount(numbers[:, p], minlength=len(books[p]))
                np.add.at(sums[p], numbers[:, p], cut)
        for p, n in enumerate(counts):
            used = np.flatnonzero(n)
            flat = pa.array(sums[p][used].ravel())
            ends = pa.array(np.arange(len(used) + 1, dtype=np.int32) * part_width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, dtype=np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used]), pa.ListArray.from_arrays(ends, flat)],
                names=["part", "entry", "n", "sums"],
            )

    return vectors.select("v").mapInArrow(run, "part int, entry int, n long, sums array<long>")


def fit(vectors: DataFrame, width: int, order: list, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, one matrix a part, after the given number of rounds."""
    start = np.array([r.v for r in vectors.orderBy(*order, "v").limit(entries).select("v").collect()], dtype=np.int64).reshape(-1, width)
    books = np.split(start, parts, axis=1)
    for _ in range(rounds):
        for r in summed(partial_sums(vectors, books), ["part", "entry"], width // parts).collect():
            books[r.part][r.entry] = np.array(r.sums, dtype=np.int64) // r.n
    return books


def encode(vectors: DataFrame, books: list[np.ndarray], keep: list[str]) -> DataFrame:
    """``keep`` with ``codes`` (entry numbers by part) and ``error`` (squared distances summed over parts)."""
    trees, width = [gnat.build(b) for b in books], sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            numbers, squares = _assigned(books, trees, matrix(block.column("v"), width))
            ends = pa.array(np.arange(block.num_rows + 1, dtype=np.int32) * len(books))
            codes = pa.ListArray.from_arrays(ends, pa.array(numbers.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in keep), codes, pa.array(squares.sum(axis=1))], names=[*keep, "codes", "error"])

    kept = vectors.select(*keep, "v")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "v")
    return kept.mapInArrow(run, f"{schema}, codes array<int>, error long")


def decode(codes: list[int], books: list[np.ndarray]) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([b[c] for b, c in zip(books, codes)])


def book_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, in decimal with commas between."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """Per kept row id, label, codes, error and the error summed over its label; and the codebooks."""
    named = rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    vectors, width = integer_vectors(named, "vector", ["vec_id", "label"], SCALE, PARTS)
    if width == 0:
        kind = dict(named.dtypes)
        empty = named.sparkSession.createDataFrame([], f"vec_id {kind['vec_id']}, label {kind['label']}, codes array<int>, error long, label_error long")
        return empty, []
    books = fit(vectors, width, [F.col("vec_id").asc_nulls_last()])
    coded = checkpointed(encode(vectors, books, ["vec_id", "label"]))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
    return out.select("vec_id", "label", "codes", "error", "label_error"), books
