"""Byte-pair encoding by longest matches with backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives, for every position of a piece, the longest token
that starts there. The encoder takes longest tokens from the left; a token may follow another only
if the two are compatible, that is, if merging their joined bytes gives the same two tokens back. The
answers are kept in a table. Where nothing fits, the position is marked dead and the encoder steps
back. This yields the merge order's own result without running the merges over the text.

Pieces are what the vocabulary's pattern cuts off, so they repeat; encoded pieces are remembered up
to ``CACHE_PIECES`` per worker and then computed anew, which changes speed only.

Decoding looks up (offset, length) of every id in one byte string of all tokens.

Defined cases: NULL and empty texts give no ids and an empty text; the special token's own string in a
text becomes its id, as the public library does by default; repeated rows each get their row; other
columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spellcast.llm.text import slices

CACHE_PIECES = 600_000
#: Fixed value: the pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in vocabulary files: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one vocabulary file; built once per worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocabulary = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.ids = vocabulary
        self.bytes_of = {v: k for k, v in vocabulary.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for n, (a, b) in enumerate(pairs):
            a, b = as_bytes(a), as_bytes(b)
            pair, whole = (vocabulary[a], vocabulary[b]), vocabulary[a + b]
            self.rank.setdefault(pair, n)
            # A token is what its first possible merge makes of two tokens that fit each other.
            if whole not in self.halves:
                self.halves[whole], self.made[whole] = pair, n
        self.compatible: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.tokens = ahocorasick.Automaton()
        self.usable = {}
        for token, i in vocabulary.items():
            # A token that no merge makes, or whose halves would merge otherwise, never occurs.
            if len(token) == 1 or i in self.halves and self._rebuilt(i):
                self.usable[token] = i
                self.tokens.add_word(token.decode("latin-1"), len(token))
        self.tokens.make_automaton()
        top = max([*self.bytes_of, *self.special.values()]) + 1
        whole = self.bytes_of | {i: s.encode() for s, i in self.special.items()}
        self.blob = np.frombuffer(b"".join(whole.get(i, b"") for i in range(top)), dtype=np.uint8)
        self.offsets = np.cumsum([0, *(len(whole.get(i, b"")) for i in range(top))])
        self.cache: dict[str, tuple[int, ...]] = {}

    def _rebuilt(self, token: int) -> bool:
        """Whether the halves of a token fit each other up to the merge that makes it."""
        left, right = self.halves[token]
        rank = self.rank[left, right]
        edge = [(a, min(e, rank)) for a, e in self._edge(left, 1)], [(b, min(e, rank)) for b, e in self._edge(right, 0)]
        return self._edges_hold(*edge)

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens leaves just these two.

        Both tokens grow along the parts that touch: the right edge of ``left`` and the left edge of
        ``right``. They fit unless a merge across the border has a lower rank than the next merges of
        both edges; of equal ranks the one further left comes first.
        """
        known = self.compatible.get((left, right))
        if known is None:
            known = self._edges_hold(self._edge(left, 1), self._edge(right, 0))
            if len(self.compatible) < 2 * CACHE_PIECES:
                self.compatible[left, right] = known
        return known

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Parts of a token on one side, from its byte to itself, each with the rank of the merge that ends it."""
        found = self.edges[side].get(token)
        if found is None:
            found, ends = [], float("inf")
            part = token
            while True:
                found.append((part, ends))
                if part not in self.halves:
                    break
                ends = self.made[part]
                part = self.halves[part][side]
            found.reverse()
            self.edges[side][token] = found
        return found

    def _edges_hold(self, left: list[tuple[int, float]], right: list[tuple[int, float]]) -> bool:
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = left[i], right[j]
            across = self.rank.get((a, b))
            if across is not None and across < a_ends and across <= b_ends:
                return False
            if a_ends <= b_ends:
                if i + 1 == len(left):
                    return True
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        if (whole := self.usable.get(piece)) is not None:
            return (whole,)
        n = len(piece)
        longest = [1] * n
        for end, length in self.tokens.iter(piece.decode("latin-1")):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        out: list[int] = []
        starts: list[int] = []
        usable, known, dead = self.usable, self.compatible, set()
        at, length, last = 0, longest[0], -1
        while at < n:
            while length:
                token = usable.get(piece[at : at + length])
                if token is not None and at + length not in dead:
                    if last < 0:
                        break
                    fits = known.get((last, token))
                    if fits or fits is None and self._fits(last, token):
                        break
                length -= 1
            if length:
                out.append(token)
                starts.append(at)
                last = token
                at += length
                length = longest[at] if at < n else 0
            else:
                dead.add(at)
                out.pop()
                last = out[-1] if out else -1
                back = starts.pop()
                length = at - back - 1
                at = back
        return tuple(out)

    def _plain(self, text: str) -> Iterator[int]:
        pieces = self.pattern.findall(text)
        cache = self.cache
        new = {p: self.encode_piece(p.encode()) for p in set(pieces).difference(cache)}
        if len(cache) < CACHE_PIECES:
            cache |= new
            return chain.from_iterable(map(cache.__getitem__, pieces))
        return chain.from_iterable([new[p] if p in new else cache[p] for p in pieces])

    def encode(self, text: str) -> np.ndarray:
        if not self.special_pattern or not self.special_pattern.search(text):
            return np.fromiter(self._plain(text), dtype=np.int32)
        out: list[int] = []
        at = 0
        for m in self.special_pattern.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return np.array(out + list(self._plain(text[at:])), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ``ids``; byte sequences that are no UTF-8 become replacement characters."""
        if len(ids) == 0:
            return ""
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)
        return self.blob[places].tobytes().decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _ids(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from slices(b, 128)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Per row: doc_id, ids and, with ``decoded``, the text that the ids give back.

    ``path`` is a vocabulary file that every executor can read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for part in _parts(batches):
            ids = [c.encode(x.as_py() or "") for x in part.column("text")]
            columns = {"doc_id": part.column("doc_id"), "ids": _ids(ids)}
            if decoded:
                columns["decoded"] = pa.array([c.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of ``encode``'s result: doc_id, ids and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for part in _parts(batches):
            texts = pa.array([c.decode(np.array(x.as_py() or [], dtype=np.int32)) for x in part.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), texts], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, ids array<int>, decoded string")
