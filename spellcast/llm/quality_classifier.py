"""Quality classifier: hierarchical empirical Bayes over features, hosts and paths of hosts.

Document evidence. Every document is described by a set of tokens: its words, and the grades of a few
measures (symbols, capitals, repeats, length). For each of the two faults (low quality, toxicity) the
labelled documents give, per token, the share of faulty documents among those that have it, shrunk
toward the share in all by a beta prior. Its log odds over the global ones are the token's weight. A
document's evidence is the weight of its strongest token: signs of a fault come together, so they are
not added up, and tokens that are hardly ever the strongest are dropped. The ``TOKENS`` tokens that explain most faulty documents form the model. Groups of near
copies among the labelled documents count once, or their common words would look like signs.

Sites. The share of faulty documents that this evidence gives is summed per path (host and language)
and per host. A path's rate is shrunk toward its host's, and a host's toward the global rate, each by a
beta prior of fixed strength; the log odds of the path's rate against the global one are added to the
document's evidence. So sparse sites count as average ones.

The model is fitted on at most ``LABELLED`` labelled rows, those with the smallest scattered ids, which
bounds what is sent to the tasks. All documents are counted and judged.

Defined cases: NULL and empty texts carry only the grade of their length; without labels nothing is
rejected; labels with NULLs are ignored for that fault; repeated ids each get their row; NULL hosts and
languages are values of their own; other columns are kept by ``good`` and ignored otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.llm.text import LOWER, UPPER, slices, words
from spellcast.session import checkpointed

LABELLED = 50_000
TOKENS = 5_000
#: Fewest labelled documents with a token, and the strength of the prior of its share of faulty ones.
SUPPORT = 10
TOKEN_STRENGTH = 10.0
#: Signs of a document this close to its strongest one count as strongest, too.
NEAR = 1.0
#: Minima by which labelled near copies are told.
COPY_MINIMA = 8
HOST_STRENGTH, PATH_STRENGTH = 200.0, 50.0
#: Sites are sent to all tasks up to this number and joined by shuffling beyond it.
SMALL_SITES = 50_000
FAULTS = ("low_quality", "toxic")

_SYMBOLS = b"#*$%&|<>"
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_EDGES = b".,;:!?\"'()[]"


def signs(text: str) -> set[bytes]:
    """The words of a text without case and outer punctuation, and the grades of its measures."""
    raw = text.encode()
    tokens = raw.translate(_FOLD).split()
    n = len(tokens)
    out = {w.strip(_EDGES) for w in tokens}
    out.discard(b"")

    def grade(name: str, share: float, *limits: float) -> None:
        out.add(f" {name} {sum(share >= x for x in limits)}".encode())

    size = max(1, len(raw))
    letters = size - len(raw.translate(None, UPPER.encode() + LOWER.encode()))
    out.add(f" length {min(12, n.bit_length())}".encode())
    grade("symbols", (len(raw) - len(raw.translate(None, _SYMBOLS))) / max(1, n), 0.02, 0.05, 0.1, 0.2, 0.4, 1)
    grade("capitals", (len(raw) - len(raw.translate(None, UPPER.encode()))) / max(1, letters), 0.1, 0.2, 0.3, 0.5, 0.8)
    grade("shouts", raw.count(b"!!") / max(1, n), 0.02, 0.1, 0.3, 0.6)
    triples = set(zip(tokens, tokens[1:], tokens[2:]))
    grade("repeats", 1 - len(triples) / max(1, n - 2) if n > 2 else 0.0, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7)
    grade("runs", sum(a == b for a, b in zip(tokens, tokens[1:])) / max(1, n), 0.02, 0.05, 0.1, 0.2, 0.5)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, tuple[float, dict[bytes, float]]]:
    """Per fault: the prior log odds and the weights of at most ``TOKENS`` tokens."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).alias(FAULTS[0]), (F.col("toxic") == 1).alias(FAULTS[1]))
    chosen = chosen.filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = checkpointed(rows)
    rows = rows.join(_single(rows), "doc_id", "left_semi").select("text", *FAULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [signs(t or "") | {b" all"} for t in part.column("text").to_pylist()]
                sizes = [len(f) for f in found]
                columns = [pa.array([t for f in found for t in f], pa.binary())]
                for fault in FAULTS:
                    columns.append(pa.array([v for v, n in zip(part.column(fault).to_pylist(), sizes) for _ in range(n)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=["token", *FAULTS])

    long = rows.mapInArrow(run, "token binary, " + ", ".join(f"{f} boolean" for f in FAULTS))
    counts = long.groupBy("token").agg(
        *(F.count_if(F.col(f) == v).alias(f"{f}_{v}") for f in FAULTS for v in (True, False))
    )
    counts = checkpointed(counts.filter(" + ".join(f"{f}_{v}" for f in FAULTS for v in (True, False)) + f" >= {SUPPORT}"))
    total = counts.filter(F.col("token") == F.lit(b" all")).first()
    model = {}
    for fault in FAULTS:
        yes, no = (total[f"{fault}_True"], total[f"{fault}_False"]) if total else (0, 0)
        if not yes or not no:
            model[fault] = (-math.inf, {})
            continue
        a, b = F.col(f"{fault}_True"), F.col(f"{fault}_False")
        prior = math.log(yes / no)
        share = (a + TOKEN_STRENGTH * yes / (yes + no)) / (a + b + TOKEN_STRENGTH)
        weighted = counts.filter(F.col("token") != F.lit(b" all")).select("token", a.alias("faulty"), (_odds(share) - prior).alias("weight"))
        top = weighted.filter("weight > 1").orderBy(F.desc(F.col("faulty") * F.col("weight")), "token").limit(TOKENS).collect()
        weights = {bytes(r.token): r.weight for r in top}
        needed = _strongest(rows.filter(fault), weights)
        model[fault] = (prior, {t: w for t, w in weights.items() if t in needed})
    return model


def _single(labelled: DataFrame) -> DataFrame:
    """Ids of labelled documents that share no minimum of their shingles with a smaller id."""
    shingle = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - 4)), lambda i: F.xxhash64(F.slice(w, i, 5)))
    hashed = labelled.select("doc_id", F.transform(F.array(words(F.col("text"))), shingle)[0].alias("h"))
    minima = [F.array_min(F.transform("h", lambda x, n=n: F.xxhash64(x, F.lit(n)))) for n in range(COPY_MINIMA)]
    slots = hashed.select("doc_id", F.posexplode(F.array(*minima)).alias("slot", "least"))
    firsts = slots.groupBy("slot", "least").agg(F.min("doc_id").alias("first"))
    return slots.join(firsts, ["slot", "least"]).groupBy("doc_id").agg(F.min("first").alias("first")).filter("first = doc_id").select("doc_id")


def _strongest(faulty: DataFrame, weights: dict[bytes, float]) -> set[bytes]:
    """Tokens among the strongest signs of enough faulty documents; the others only keep them company."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strongest = []
            for text in batch.column("text").to_pylist():
                present = {t: weights[t] for t in weights.keys() & signs(text or "")}
                limit = max(present.values(), default=0.0) - NEAR
                strongest += [t for t, w in present.items() if w >= limit]
            yield pa.RecordBatch.from_arrays([pa.array(strongest, pa.binary())], names=["token"])

    found = faulty.select("text").mapInArrow(run, "token binary").groupBy("token").count()
    return {bytes(r.token) for r in found.filter(f"count >= {SUPPORT // 2}").collect()}


def evidence(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """The named columns of ``docs`` with the log odds per fault of its text."""
    rows = docs.select(*(F.col(f"`{c}`") for c in columns), F.col("text").alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [signs(t or "") for t in part.column("__text").to_pylist()]
                out = [part.column(n) for n in columns]
                for fault in FAULTS:
                    prior, weights = sent.value[fault]
                    known = weights.keys()
                    out.append(pa.array([max(-50.0, prior + max((weights[t] for t in known & f), default=0.0)) for f in found], pa.float64()))
                yield pa.RecordBatch.from_arrays(out, names=[*columns, *(f"__{f}" for f in FAULTS)])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in columns) + "".join(f", __{f} double" for f in FAULTS)
    return rows.mapInArrow(run, schema)


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_odds(judged: DataFrame) -> DataFrame:
    """Per (host, path): log odds of the shrunk path rate against the global rate, per fault."""
    likely = [(1 / (1 + F.exp(-F.col(f"__{f}")))).alias(f) for f in FAULTS]
    per_path = checkpointed(judged.select("__host", "__path", *likely).groupBy("__host", "__path").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f).alias(f) for f in FAULTS)))
    whole = per_path.agg(F.sum("n").alias("n"), *(F.sum(f).alias(f) for f in FAULTS)).first()
    hosts = per_path.groupBy("__host").agg(F.sum("n").alias("host_n"), *(F.sum(f).alias(f"host_{f}") for f in FAULTS))
    out = per_path.join(hosts, "__host")
    columns = []
    for f in FAULTS:
        mean = min(max((whole[f] or 0.0) / (whole.n or 1), 1e-6), 1 - 1e-6)
        host = (F.col(f"host_{f}") + HOST_STRENGTH * mean) / (F.col("host_n") + HOST_STRENGTH)
        path = (F.col(f) + PATH_STRENGTH * host) / (F.col("n") + PATH_STRENGTH)
        columns.append((_odds(path) - math.log(mean / (1 - mean))).alias(f"__site_{f}"))
    return out.select("__host", "__path", *columns)


def judge(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of ``docs`` with the posterior log odds of both faults, ``__odds_<fault>``.

    Texts are read once to count over all documents and once more to judge; they are not shuffled.
    """
    model = fit(docs, labels)
    named = docs.withColumns({"__host": F.coalesce(F.col("source").cast("string"), F.lit("")), "__path": F.coalesce(F.col("lang").cast("string"), F.lit(""))})
    own = [c for c in columns if c != "text"]
    seen = evidence(named, model, ["__host", "__path", *(c for c in own)])
    if "text" not in columns:
        seen = checkpointed(seen)
    sites = checkpointed(site_odds(seen))
    bounded = sites.count() <= SMALL_SITES
    rows = evidence(named, model, ["__host", "__path", *columns]) if "text" in columns else seen
    joined = rows.join(F.broadcast(sites) if bounded else sites, ["__host", "__path"])
    return joined.select(*(F.col(f"`{c}`") for c in columns), *((F.col(f"__{f}") + F.col(f"__site_{f}")).alias(f"__odds_{f}") for f in FAULTS))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are more likely without either fault than with it."""
    judged = judge(docs, labels, docs.columns)
    return judged.filter(" and ".join(f"__odds_{f} <= 0" for f in FAULTS)).select(*(F.col(f"`{c}`") for c in docs.columns))
