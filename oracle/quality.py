"""DuckDB texts for the consistency checks."""

from __future__ import annotations

from oracle.base import cte, query
from oracle.evaluation import rnd
from spellcast.plans.quality_queries import CATEGORIES, LONG_TAIL, NUMERIC

ORACLE: dict[str, str] = {}
_ALL = ["row_id", "event_date", "status", "priority", "segment", "customer_name", "state", "note", *NUMERIC]


def _per_column(sql: str, cols) -> str:
    return " UNION ALL ".join(sql.replace("$c", c) for c in cols)


ORACLE["quality_schema"] = query(
    _per_column(
        """SELECT '$c' AS column_name, count(*) FILTER (WHERE dataset = 'train' AND $c IS NOT NULL) AS train_values,
                  CASE WHEN '$c' <> 'note' THEN count(*) FILTER (WHERE dataset = 'cmp' AND $c IS NOT NULL) END
                      AS cmp_values, '$c' <> 'note' AS schema_passed FROM checked""",
        _ALL,
    )
    + " UNION ALL SELECT 'extra', NULL, count(*) FILTER (WHERE dataset = 'cmp' AND amount IS NOT NULL), false FROM checked",
    "checked",
)
ORACLE["quality_dtype"] = query(
    _per_column(
        """SELECT '$c' AS column_name, count(*) FILTER (WHERE dataset = 'train' AND $c IS NOT NULL) AS train_values,
                  count(*) FILTER (WHERE dataset = 'cmp' AND $c IS NOT NULL) AS cmp_values,
                  '$c' <> 'row_id' AS type_passed FROM checked""",
        _ALL,
    ),
    "checked",
)
ORACLE["quality_duplicates"] = query(
    f"""SELECT dataset, n_rows, duplicates, {rnd('duplicate_pct')}, duplicates = 0 AS passed FROM (
        SELECT dataset, count(*) AS n_rows, count(*) - count(DISTINCT (customer_name, event_date)) AS duplicates,
               (count(*) - count(DISTINCT (customer_name, event_date))) * 100.0::DOUBLE / count(*) AS duplicate_pct
        FROM checked GROUP BY dataset)""",
    "checked",
)
cte(
    "missing",
    "SELECT *, CASE rule WHEN 'none' THEN cmp_pct <= 0.05 WHEN 'within' THEN cmp_pct BETWEEN train_pct - 10 AND train_pct + 10 "
    "ELSE true END AS passed FROM (SELECT *, CASE WHEN train_pct < 0.05 THEN 'none' WHEN train_pct < 70 THEN 'within' "
    "ELSE 'unchecked' END AS rule FROM ("
    + _per_column(
        """SELECT '$c' AS column_name,
                  avg(CASE WHEN $c IS NULL THEN 1 ELSE 0 END) FILTER (WHERE dataset = 'train') * 100.0::DOUBLE AS train_pct,
                  avg(CASE WHEN $c IS NULL THEN 1 ELSE 0 END) FILTER (WHERE dataset = 'cmp') * 100.0::DOUBLE AS cmp_pct
           FROM checked""",
        NUMERIC + CATEGORIES + LONG_TAIL,
    )
    + "))",
    "checked",
)
ORACLE["quality_missing"] = query(f"SELECT column_name, {rnd('train_pct', 'cmp_pct')}, rule, passed FROM missing", "missing")


def _shares(name: str, source: str, cols, value: str, *needs: str) -> None:
    cells = _per_column(f"SELECT '$c' AS column_name, dataset, {value} AS value FROM {source}", cols)
    cte(
        name,
        f"""SELECT column_name, value, count(*) FILTER (WHERE dataset = 'train') AS train_n,
                   count(*) FILTER (WHERE dataset = 'cmp') AS cmp_n,
                   count(*) FILTER (WHERE dataset = 'train')
                       / CAST(sum(count(*) FILTER (WHERE dataset = 'train')) OVER (PARTITION BY column_name) AS DOUBLE)
                       AS train_share,
                   count(*) FILTER (WHERE dataset = 'cmp')
                       / CAST(sum(count(*) FILTER (WHERE dataset = 'cmp')) OVER (PARTITION BY column_name) AS DOUBLE)
                       AS cmp_share
            FROM ({cells}) WHERE value IS NOT NULL GROUP BY column_name, value""",
        *needs,
    )


def _head_tail(shares: str, head: float) -> str:
    return f"""SELECT *, head_max_diff <= 0.1 AND tail_diff <= 0.1 AS passed FROM (
        SELECT column_name,
               coalesce(max(abs(train_share - cmp_share)) FILTER (WHERE train_share > {head}), 0) AS head_max_diff,
               abs(coalesce(sum(train_share) FILTER (WHERE train_n > 0 AND train_share <= {head}), 0)
                   - coalesce(sum(cmp_share) FILTER (WHERE train_n > 0 AND train_share <= {head}), 0)) AS tail_diff,
               coalesce(sum(cmp_share) FILTER (WHERE train_n = 0), 0) AS new_share
        FROM {shares} GROUP BY column_name)"""


_text = "upper(trim(coalesce(CAST($c AS VARCHAR), 'nan'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))"
_shares("sh_tail", "checked", LONG_TAIL + CATEGORIES, "CAST($c AS VARCHAR)", "checked")
_shares("sh_tail2", "checked", LONG_TAIL, "CAST($c AS VARCHAR)", "checked")
_shares("sh_len2", "checked", LONG_TAIL, "length(coalesce($c, 'nan'))", "checked")
_shares("sh_len", "texts", ["text", "lang", "source"], "length(coalesce($c, 'nan'))", "texts")
_shares("sh_unique", "checked", CATEGORIES, _text, "checked")
_shares("sh_top", "checked", CATEGORIES + LONG_TAIL, _text, "checked")
_HT = ("head_max_diff", "tail_diff", "new_share")
cte("long_tail", _head_tail("sh_tail", 0.03), "sh_tail")
cte("long_tail2", _head_tail("sh_tail2", 0.03), "sh_tail2")
cte("lengths", _head_tail("sh_len", 0.05), "sh_len")
cte("lengths2", _head_tail("sh_len2", 0.05), "sh_len2")
ORACLE["quality_long_tail"] = query(f"SELECT column_name, {rnd(*_HT)}, passed FROM long_tail", "long_tail")
ORACLE["quality_length"] = query(f"SELECT column_name, {rnd(*_HT)}, passed FROM lengths", "lengths")
cte(
    "uniques",
    """SELECT *, shifted = 0 AS passed FROM (
        SELECT column_name, count(*) AS "values", max(abs(train_share - cmp_share)) AS max_diff,
               count(*) FILTER (WHERE abs(train_share - cmp_share) > 0.1) AS shifted
        FROM sh_unique GROUP BY column_name)""",
    "sh_unique",
)
ORACLE["quality_unique"] = query(f'SELECT column_name, "values", {rnd("max_diff")}, shifted, passed FROM uniques', "uniques")
ORACLE["quality_top_values"] = query(
    f"""SELECT column_name, value, dataset, n, {rnd('share')}, CAST(rank AS INT) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY column_name, dataset ORDER BY n DESC, value) AS rank FROM (
            SELECT column_name, value, 'train' AS dataset, train_n AS n, train_share AS share FROM sh_top
            UNION ALL SELECT column_name, value, 'cmp', cmp_n, cmp_share FROM sh_top) WHERE n > 0)
        WHERE rank <= 10""",
    "sh_top",
)
cte(
    "bands",
    _per_column(
        """SELECT '$c' AS column_name, p10 - 1.5::DOUBLE * (p90 - p10) AS lower, p90 + 1.5::DOUBLE * (p90 - p10) AS upper
           FROM (SELECT quantile_cont($c, 0.1) AS p10, quantile_cont($c, 0.9) AS p90 FROM checked WHERE dataset = 'train')""",
        NUMERIC,
    ),
    "checked",
)


def _band(d: str) -> str:
    return ", ".join(
        f"avg(CASE WHEN {t} THEN 1 ELSE 0 END) FILTER (WHERE dataset = '{d}') * 100.0::DOUBLE AS {d}_{n}"
        for n, t in (("nulls", "$c IS NULL"), ("below", "$c < lower"), ("within", "$c >= lower AND $c <= upper"), ("above", "$c > upper"))
    )


cte(
    "outliers",
    "SELECT *, greatest(abs(train_nulls - cmp_nulls), abs(train_below - cmp_below), abs(train_within - cmp_within), "
    "abs(train_above - cmp_above)) <= 10 AS passed FROM ("
    + _per_column(
        f"""SELECT '$c' AS column_name, {_band('train')}, {_band('cmp')}, max(lower) AS lower, max(upper) AS upper
            FROM checked JOIN bands ON column_name = '$c'""",
        NUMERIC,
    )
    + ")",
    "checked", "bands",
)
_OUT = [f"{d}_{n}" for d in ("train", "cmp") for n in ("nulls", "below", "within", "above")] + ["lower", "upper"]
ORACLE["quality_outlier"] = query(f"SELECT column_name, {rnd(*_OUT, digits=6)}, passed FROM outliers", "outliers")
cte(
    "shifts",
    "SELECT *, column_name = 'shifted' AS key_feature, (cmp_value - train_value) / nullif(train_value, 0) * 100.0::DOUBLE "
    "AS percent_diff, coalesce(abs((cmp_value - train_value) / nullif(train_value, 0)) <= 0.1, true) AS passed FROM ("
    + _per_column(
        """SELECT '$c' AS column_name, 'Mean' AS statistic, avg($c) FILTER (WHERE dataset = 'train') AS train_value,
                  avg($c) FILTER (WHERE dataset = 'cmp') AS cmp_value FROM checked
           UNION ALL SELECT '$c', 'Median', median($c) FILTER (WHERE dataset = 'train'),
                  median($c) FILTER (WHERE dataset = 'cmp') FROM checked""",
        NUMERIC,
    )
    + ")",
    "checked",
)
_SHIFT = f"column_name, statistic, {rnd('train_value', 'cmp_value', 'percent_diff', digits=6)}, key_feature, passed"
ORACLE["quality_distribution"] = query(f"SELECT {_SHIFT} FROM shifts", "shifts")
ORACLE["quality_drift_table"] = query(f"SELECT {_SHIFT} FROM shifts WHERE NOT passed", "shifts")
_status = "count(*) AS checked, count(*) FILTER (WHERE NOT passed) AS failed"
_n = len(_ALL)
cte(
    "all_checks",
    f"""SELECT check_name, checked, failed, CASE WHEN failed = 0 THEN 'PASS' WHEN check_name IN ('Schema Check', 'Data Type Check')
               THEN 'FAIL' ELSE 'WARNING' END AS status FROM (
        SELECT 'Schema Check' AS check_name, CAST({_n} AS BIGINT) AS checked, CAST(0 AS BIGINT) AS failed
        UNION ALL SELECT 'Data Type Check', {_n}, 0
        UNION ALL SELECT 'Duplicate Check', count(*), count(*) FILTER (WHERE d > 0)
            FROM (SELECT dataset, count(*) - count(DISTINCT row_id) AS d FROM checked GROUP BY dataset)
        UNION ALL SELECT 'Missing Value Check', {_status} FROM missing
        UNION ALL SELECT 'Long Tail Check', {_status} FROM long_tail2
        UNION ALL SELECT 'Length Distribution Check', {_status} FROM lengths2
        UNION ALL SELECT 'Outlier Check', {_status} FROM outliers
        UNION ALL SELECT 'Unique Value Check', {_status} FROM uniques
        UNION ALL SELECT 'Data Distribution Check', {_status} FROM shifts)""",
    "checked", "missing", "long_tail2", "lengths2", "outliers", "uniques", "shifts",
)
ORACLE["quality_checks"] = query("SELECT * FROM all_checks", "all_checks")
ORACLE["quality_verdict"] = query(
    """SELECT count(*) FILTER (WHERE failed > 0) AS failed_checks,
              CASE WHEN bool_or(failed > 0 AND check_name IN ('Schema Check', 'Data Type Check')) THEN 'FAIL'
                   WHEN bool_or(failed > 0 AND check_name <> 'Length Distribution Check') THEN 'PASS with WARNING'
                   ELSE 'PASS' END AS overall_status FROM all_checks""",
    "all_checks",
)
_texts = [c for c in _ALL if c not in ("row_id", "event_date", *NUMERIC)]
ORACLE["column_routing"] = query(
    _per_column(
        """SELECT '$c' AS column_name, count(DISTINCT $c) AS distinct_values,
                  CASE WHEN count(DISTINCT $c) < 50 THEN 'category' ELSE 'long_tail' END AS route
           FROM checked WHERE dataset = 'train'""",
        _texts,
    )
    + " UNION ALL "
    + _per_column("SELECT '$c', NULL, 'numeric'", ["row_id", *NUMERIC]),
    "checked",
)


def _profile(cols, numeric: bool) -> str:
    num = (
        """min($c) AS min, max($c) AS max, avg($c) AS mean, stddev_samp($c) AS std, quantile_cont($c, 0.05) AS p05,
           quantile_cont($c, 0.25) AS p25, quantile_cont($c, 0.5) AS p50, quantile_cont($c, 0.75) AS p75,
           quantile_cont($c, 0.95) AS p95"""
        if numeric
        else ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("min", "max", "mean", "std", "p05", "p25", "p50", "p75", "p95"))
    )
    return _per_column(
        f"""SELECT dataset, '$c' AS column_name, count(*) AS n_rows, count(*) - count($c) AS nulls,
                   count(DISTINCT $c) AS distinct_values,
                   (SELECT max(n) FROM (SELECT i.$c, count(*) AS n FROM checked i WHERE i.dataset = o.dataset
                                        AND i.$c IS NOT NULL GROUP BY 1)) AS top_count,
                   {'NULL' if numeric else """(SELECT arg_min(v, lpad(CAST(1000000000 - n AS VARCHAR), 12, '0') || v) FROM (
                      SELECT CAST(i.$c AS VARCHAR) AS v, count(*) AS n FROM checked i WHERE i.dataset = o.dataset AND i.$c IS NOT NULL GROUP BY 1))"""} AS top_value, {num}
            FROM checked o GROUP BY dataset""",
        cols,
    )


ORACLE["column_profile"] = query(
    f"""SELECT dataset, column_name, n_rows, nulls, distinct_values, top_count, top_value,
        {rnd('min', 'max', 'mean', 'std', 'p05', 'p25', 'p50', 'p75', 'p95', digits=6)}
        FROM ({_profile(NUMERIC, True)} UNION ALL {_profile(CATEGORIES + LONG_TAIL, False)})""",
    "checked",
)
