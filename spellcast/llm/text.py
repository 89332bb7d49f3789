"""Word splitting and window hashing shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: Column) -> Column:
    """Words between ASCII white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_hashes(text: Column) -> Column:
    """One 64-bit hash per word."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def keyed_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (key, doc_id, h): word hashes, and the id or, without one, a number made from the text.

    Such a number lies below -2**62, where no ids are allowed.
    """
    return docs.select(document_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("doc_id"), word_hashes(lower_ascii(F.col(text_col))).alias("h"))


def document_key(doc_id: Column, text: Column) -> Column:
    made = F.lit(-(2**62) - 1) - F.xxhash64(lower_ascii(text)).bitwiseAND(F.lit(2**62 - 1))
    return F.coalesce(doc_id.cast("long"), made)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that scatters them over the whole range."""
    with np.errstate(over="ignore"):
        v = values ^ np.uint64(seed)
        v = (v ^ (v >> np.uint64(30))) * _MIX
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` consecutive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        v = hashes[:n].copy()
        for j in range(1, k):
            v *= _STEP
            v += hashes[j : j + n]
    return mixed(v)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct shingle hashes, sorted; fewer than ``k`` words are one shingle, none give none."""
    if len(hashes) == 0:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(window_hashes(hashes, min(k, len(hashes))))


def set_lists(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of every row of a list<int64> column of word hashes: all sets in one array, and their ends."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    hashes = column.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(hashes))  # words from here to the row's end
    found, of = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for width in range(1, k + 1):
        inside = size == width if width < k else size >= k
        begins = (left[: max(len(hashes) - width + 1, 0)] >= width) & inside[row[: max(len(hashes) - width + 1, 0)]]
        if begins.any():
            found.append(window_hashes(hashes, width)[begins])
            of.append(row[: len(begins)][begins])
    values, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    values, of = values[order], of[order]
    ends = np.cumsum(np.bincount(of, minlength=len(size)))
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.cumsum(np.bincount(of[new], minlength=len(size)))


def hash_lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list<int64> column as unsigned arrays; NULL rows are empty."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield values[a:b]


def long_lists(rows: list[np.ndarray]) -> pa.Array:
    """Unsigned arrays as one list<int64> column."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def slices(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    """The batch in parts of a few hundred documents, which bounds the memory of array work."""
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)
