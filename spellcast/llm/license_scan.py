"""License scan: identifier tags and notice phrases found by an Aho-Corasick automaton.

The lower-cased words of a text, joined by single spaces, run once through an automaton of all
phrases; a match counts where it starts and ends at word borders, and the spaces before it give its
word position. ``SPDX-License-Identifier`` tags are followed by an expression, which a shunting-yard
parser turns into its licenses and into whether a set of allowed licenses satisfies it.

Defined cases: NULL and empty texts have no words, no labels and score 0; matches may overlap and all
count; an expression that cannot be parsed adds no label; repeated rows each get their row; other
columns are ignored.

``score`` is 0 without any match, else 1 - 1/(1 + matches) raised by full tags to 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The phrases of the registered query and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notices of the method.
MORE_PHRASES = {
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by 4 0": "cc-by",
    "cc0": "cc0",
    "creative commons": "creative-commons",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "permission is hereby granted free of charge": "mit",
}
TAG = "spdx license identifier"
#: Families of identifiers by their first part.
FAMILIES = ("agpl", "apache", "bsd", "cc0", "cc-by-nc", "cc-by-sa", "cc-by", "epl", "gpl", "isc", "lgpl", "mit", "mpl", "unlicense", "zlib")
ALLOWED = frozenset(("apache", "bsd", "cc0", "cc-by", "isc", "mit", "unlicense", "zlib"))

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_EXPRESSION = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str | None:
    name = identifier.lower()
    return next((f for f in sorted(FAMILIES, key=len, reverse=True) if name == f or name.startswith(f + "-") or name.startswith(f + "+")), None)


def postfix(expression: str) -> list[str] | None:
    """Operands and operators in evaluation order; NULL if the text does not start with an expression.

    Reading stops at the first token that cannot continue the expression (a comment's end, prose).
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = True
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if operand:
            if low == "(":
                waiting.append(low)
            elif low in _BINDS or low == ")":
                return None
            else:
                out.append(token)
                operand = False
        elif low in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand = True
        elif low == ")" and "(" in waiting:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            break
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(steps: list[str], allowed: frozenset[str] = ALLOWED) -> tuple[bool, set[str]]:
    """Whether ``allowed`` families satisfy the expression, and the families it names."""
    stack: list[bool | None] = []
    names: set[str] = set()
    for step in steps:
        if step.lower() not in _BINDS:
            f = family(step)
            stack.append(f in allowed if f else False)
            if f:
                names.add(f)
            continue
        right, left = stack.pop(), stack.pop()
        # An exception only adds permissions to the license before it.
        stack.append(left if step.lower() == "with" else left and right if step.lower() == "and" else left or right)
    return bool(stack[0]), names


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase, label in [*BASE_PHRASES.items(), *MORE_PHRASES.items(), (TAG, None)]:
        a.add_word(f" {phrase} ", (len(phrase.split()), label, phrase in BASE_PHRASES))
    a.make_automaton()
    return a


def scan_text(text: str) -> dict:
    joined = b" ".join(text.encode("utf-8", "replace").translate(_FOLD).split())
    padded = f" {joined.decode('latin-1')} "
    base, labels, base_labels, tagged, matches = [], set(), set(), False, 0
    n_ended, counted = 0, 0  # words that end before the position ``counted``; matches come in order of their ends
    for end, (n, label, is_base) in _automaton().iter(padded):
        if label is None:
            tagged = True
            continue
        matches += 1
        labels.add(label)
        if is_base:
            n_ended += padded.count(" ", counted, end)
            counted = end
            base.append(n_ended - n)
            base_labels.add(label)
    satisfied, parsed = None, 0
    for expression in _EXPRESSION.findall(text) if tagged else ():
        steps = postfix(expression)
        if steps is None:
            continue
        parsed += 1
        ok, names = evaluate(steps)
        satisfied = ok if satisfied is None else satisfied and ok
        labels |= names
    return {
        "n_words": joined.count(b" ") + 1 if joined else 0,
        "n_base": len(base),
        "first_word": min(base, default=None),
        "last_word": max(base, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": 1.0 if parsed else 1.0 - 1.0 / (1 + matches),
        "permitted": satisfied,
    }


FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("permitted", pa.bool_()),
]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, counts and positions of base phrases, labels, score, and whether tags permit use."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan_text(x.as_py() or "") for x in b.column("text")]
            columns = [pa.array([f[name] for f in found], kind) for name, kind in FIELDS]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", *(n for n, _ in FIELDS)])

    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permitted boolean"
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {schema}")
