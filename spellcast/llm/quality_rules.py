"""Quality rules with host verdicts, in DataFrame functions only.

Every document gets counts from its whole text and a base verdict. Failures are then summed per
host, each host's failure rate is shrunk by a beta prior fitted to all hosts by moments, and hosts
whose shrunk rate passes ``host_limit`` lose all their documents.

Repeated 8-word windows are found inside the row: window hashes are sorted together with their
positions, equal neighbours are repeats, and the gaps between repeated positions give the number of
covered words. No window leaves its row, so nothing but one short row per document is shuffled.

Defined cases: NULL and empty texts have zero words and fail; a NULL host is a host of its own;
repeated rows each count and each get their row; columns other than the named ones are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.llm.text import words
from spellcast.session import checkpointed

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

_SPACES = " \t\n\x0b\f\r"


def _repeated_words(tokens: Column) -> Column:
    """Words of ``tokens`` inside windows that occur twice or more, first occurrences included."""
    k = REPEAT_WINDOW
    starts = F.sequence(F.lit(1), F.size(tokens) - F.lit(k - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, k)))

    def positions(hashes):
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(pairs):
            n = F.size(pairs)
            same = lambda p, j: p["h"] == F.get(pairs, j)["h"]
            kept = F.filter(pairs, lambda p, j: F.coalesce((j > 0) & same(p, j - 1), F.lit(False)) | F.coalesce((j < n - 1) & same(p, j + 1), F.lit(False)))
            return F.sort_array(F.transform(kept, lambda p: p["i"]))

        return F.transform(F.array(pairs), repeated)[0]

    def covered(at):
        # A repeated window adds its whole length, or only the gap to the next one.
        last = F.size(at) - 1
        parts = F.transform(at, lambda p, j: F.when(j == last, F.lit(k)).otherwise(F.least(F.lit(k), F.get(at, j + 1) - p)))
        return F.aggregate(parts, F.lit(0), lambda a, x: a + x)

    def counted(hashes):
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, F.transform(F.array(positions(hashes)), covered)[0]).otherwise(F.lit(0))

    return F.when(F.size(tokens) > k, F.transform(F.array(hashes), counted)[0]).otherwise(F.lit(0)).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts of every document and its base verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"))

    def counts(tokens):
        return F.struct(F.size(tokens).cast("long").alias("n_words"), _repeated_words(tokens).alias("n_repeat_words"))

    out = rows.select(
        "doc_id",
        "host",
        F.transform(F.array(words(text)), counts)[0].alias("c"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
    ).select("doc_id", "host", "c.n_words", "word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def host_rates(rows: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk toward the rate of all hosts."""
    hosts = checkpointed(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")))
    rate = F.col("failed") / F.col("n")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("n") * rate * rate).alias("square")).first()
    n, mean = total.n or 0, (total.failed or 0) / (total.n or 1)
    noise = mean * (1 - mean) * total.hosts / n if n else 0.0
    between = (total.square or 0.0) / n - mean * mean - noise if n else 0.0
    strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6
    return hosts.withColumn("shrunk_rate", (F.col("failed") + mean * strength) / (F.col("n") + strength))


def apply_rules(docs: DataFrame, host_limit: float = 0.8, **columns: str) -> DataFrame:
    """``measured`` with ``kept``: the base verdict and the host's verdict joined back."""
    rows = checkpointed(measured(docs, **columns))
    hosts = host_rates(rows).select("host", (F.col("shrunk_rate") > host_limit).alias("host_failed"), "shrunk_rate")
    return rows.join(hosts, "host").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )
