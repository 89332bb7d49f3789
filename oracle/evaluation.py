"""DuckDB texts for scored rows."""

from __future__ import annotations

from oracle.base import cte, query, select
from spellcast.operators.scoring import DECILE_CUTOFFS, TIER_CUTOFFS, TIER_SHARES
from spellcast.plans.evaluation_queries import COEFFICIENTS, DESCRIPTIONS, TRAIN_END, VAL_END

cte(
    "sc",
    f"""SELECT *, CASE WHEN event_date < DATE '{TRAIN_END}' THEN 'train'
                       WHEN event_date < DATE '{VAL_END}' THEN 'val' ELSE 'oos' END AS split FROM scored""",
    "scored",
)
cte(
    "sm",
    """SELECT 'champion' AS model, * FROM sc UNION ALL
       SELECT 'previous' AS model, * REPLACE (floor((prob * 0.6::DOUBLE + mod(row_id * 31, 97) / 97.0::DOUBLE * 0.4::DOUBLE) * 997.0::DOUBLE) / 997.0::DOUBLE AS prob)
       FROM sc""",
    "sc",
)
cte(
    "seg",
    """SELECT 'overall' AS segment, * FROM sm UNION ALL
       SELECT CASE firstaction_bool WHEN 0 THEN 'circle_backs' ELSE 'undecideds' END, * FROM sm""",
    "sm",
)
cte("bins", "SELECT unnest([10, 20, 50, 100]) AS n_bins")
_STATS = """count(*) AS counts, CAST(sum(target) AS BIGINT) AS positives, min(prob) AS min_prob, max(prob) AS max_prob,
    avg(prob) AS mean_prob, median(prob) AS median_prob, stddev_samp(prob) AS std_prob"""
cte(
    "tiles",
    " UNION ALL ".join(
        f"""SELECT model, row_id, prob, target, {n} AS n_bins, ntile({n}) OVER
            (PARTITION BY model ORDER BY prob DESC, row_id) AS bucket FROM sm WHERE split = 'train'"""
        for n in (10, 20, 50, 100)
    ),
    "sm",
)
cte(
    "qt",
    f"""SELECT *, positives * 100.0::DOUBLE / counts AS target_rate_pct,
               positives * 100.0::DOUBLE / sum(positives) OVER (PARTITION BY model, n_bins) AS overall_target_pct
        FROM (SELECT model, n_bins, CAST(bucket AS INT) AS bucket, {_STATS} FROM tiles GROUP BY ALL)""",
    "tiles",
)
cte(
    "cut",
    """SELECT model, n_bins, bucket, CASE WHEN bucket = n_bins THEN 0.0 ELSE min_prob END AS lower,
              coalesce(lag(min_prob) OVER (PARTITION BY model, n_bins ORDER BY bucket), 10.0::DOUBLE) AS upper
       FROM qt""",
    "qt",
)
cte("totals", "SELECT model, split, segment, CAST(sum(target) AS BIGINT) AS total_pos, count(*) AS total_rows FROM seg GROUP BY ALL", "seg")
cte(
    "applied",
    f"""SELECT t.model, t.split, t.segment, c.n_bins, c.bucket, coalesce(counts, 0) AS counts,
               coalesce(positives, 0) AS positives, min_prob, max_prob, mean_prob, median_prob, std_prob,
               CASE WHEN counts > 0 THEN positives * 100.0::DOUBLE / counts ELSE 0 END AS target_rate_pct,
               CASE WHEN total_pos > 0 THEN coalesce(positives, 0) * 100.0::DOUBLE / total_pos ELSE 0 END
                   AS overall_target_pct
        FROM totals t JOIN cut c ON c.model = t.model
        LEFT JOIN (SELECT s.model, s.split, s.segment, c.n_bins, c.bucket, {_STATS}
                   FROM seg s JOIN cut c ON c.model = s.model AND s.prob >= c.lower AND s.prob < c.upper GROUP BY ALL) x
          ON x.model = t.model AND x.split = t.split AND x.segment = t.segment AND x.n_bins = c.n_bins
         AND x.bucket = c.bucket""",
    "totals", "cut", "seg",
)


def rnd(*cols: str, digits: int = 9) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


_P = ("min_prob", "max_prob", "mean_prob", "median_prob", "std_prob", "target_rate_pct", "overall_target_pct")
ORACLE: dict[str, str] = {}
ORACLE["date_split"] = select("sc", "row_id, event_date, split")
ORACLE["split_summary"] = query(
    """SELECT split, count(*) AS n_rows, min(event_date) AS first_date, max(event_date) AS last_date,
              round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM sc), 9) AS share_pct, true AS boundary_ok
       FROM sc GROUP BY split""",
    "sc",
)
ORACLE["quantile_table"] = query(f"SELECT n_bins, bucket, counts, positives, {rnd(*_P)} FROM qt WHERE model = 'champion'", "qt")
ORACLE["cutoffs"] = query("SELECT n_bins, bucket, lower, upper FROM cut WHERE model = 'champion'", "cut")
ORACLE["apply_cutoffs"] = query(
    f"""SELECT split, n_bins, bucket, counts, positives, {rnd(*_P)} FROM applied
        WHERE model = 'champion' AND segment = 'overall' AND split <> 'train'""",
    "applied",
)
ORACLE["segment_deciles"] = query(
    f"""SELECT split, segment, n_bins, bucket, counts, positives, {rnd(*_P)} FROM applied
        WHERE model = 'champion' AND n_bins IN (10, 20)""",
    "applied",
)
# The training split's own panels are its equal-count buckets; only other rows are cut by its bounds.
cte(
    "panels",
    f"""SELECT model, split, segment, n_bins, bucket, counts, positives, {', '.join(_P)} FROM applied
        WHERE split <> 'train' OR segment <> 'overall'
        UNION ALL
        SELECT model, 'train', 'overall', n_bins, bucket, counts, positives, {', '.join(_P)} FROM qt""",
    "applied", "qt",
)
_CAPTURE = """SELECT model, split, sum(overall_target_pct) AS top_capture_pct FROM panels
    WHERE segment = 'overall' AND n_bins = 20 AND bucket <= 3 GROUP BY ALL"""
cte("capture", _CAPTURE, "panels")
ORACLE["top15_capture"] = query(f"SELECT split, {rnd('top_capture_pct')} FROM capture WHERE model = 'champion'", "capture")
ORACLE["results_long"] = query(
    f"SELECT model, split AS dataset, segment, n_bins, bucket, counts, positives, {rnd(*_P)} FROM panels", "panels"
)
_AGE = """CASE WHEN account_age <= 730 THEN 'LT2YR_OLD' WHEN account_age <= 1460 THEN 'BT2_4YR_OLD'
    WHEN account_age <= 2190 THEN 'BT4_6YR_OLD' WHEN account_age <= 2920 THEN 'BT6_8YR_OLD'
    WHEN account_age <= 3650 THEN 'BT8_10YR_OLD' WHEN account_age <= 4380 THEN 'BT10_12YR_OLD' ELSE 'GT12YR_OLD' END"""
ORACLE["age_table"] = query(
    f"""SELECT split, segment, age_bin, counts, positives, {rnd(*_P)},
               round((positives * 100.0::DOUBLE / counts) / (total_pos * 100.0::DOUBLE / total_rows), 9) AS lift
        FROM (SELECT x.*, positives * 100.0::DOUBLE / counts AS target_rate_pct,
                     positives * 100.0::DOUBLE / total_pos AS overall_target_pct, total_pos, total_rows
              FROM (SELECT split, segment, {_AGE} AS age_bin, {_STATS} FROM seg WHERE model = 'champion' GROUP BY ALL) x
              JOIN totals t ON t.model = 'champion' AND t.split = x.split AND t.segment = x.segment)""",
    "seg", "totals",
)
cte(
    "auc",
    """SELECT model, split,
              sum(neg * (pos_above - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS roc_auc,
              sum(pos * pos_above / n_above::DOUBLE) / sum(pos) AS average_precision
       FROM (SELECT *, n - pos AS neg, sum(pos) OVER w AS pos_above, sum(n) OVER w AS n_above
             FROM (SELECT model, split, prob, CAST(count(*) AS DOUBLE) AS n, CAST(sum(target) AS DOUBLE) AS pos
                   FROM sm GROUP BY ALL)
             WINDOW w AS (PARTITION BY model, split ORDER BY prob DESC))
       GROUP BY ALL""",
    "sm",
)
ORACLE["auc_ap"] = query(f"SELECT model, split, {rnd('roc_auc', 'average_precision')} FROM auc", "auc")
cte(
    "cm",
    """SELECT g.model, g.split, a.actual, p.predicted, count(s.row_id) AS n
       FROM (SELECT DISTINCT model, split FROM sm) g, (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted)
       LEFT JOIN sm s ON s.model = g.model AND s.split = g.split AND s.target = a.actual
             AND CASE WHEN s.prob >= 0.5 THEN 1 ELSE 0 END = p.predicted
       GROUP BY ALL""".replace(
        "(SELECT DISTINCT model, split FROM sm) g, (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted)",
        "(SELECT DISTINCT model, split FROM sm) g CROSS JOIN (VALUES (0), (1)) a(actual) CROSS JOIN (VALUES (0), (1)) p(predicted)",
    ),
    "sm",
)
ORACLE["confusion"] = select("cm")
cte(
    "cells",
    """SELECT model, split, CAST(sum(n) FILTER (WHERE actual = 1 AND predicted = 1) AS DOUBLE) AS tp,
              CAST(sum(n) FILTER (WHERE actual = 0 AND predicted = 1) AS DOUBLE) AS fp,
              CAST(sum(n) FILTER (WHERE actual = 1 AND predicted = 0) AS DOUBLE) AS fn,
              CAST(sum(n) FILTER (WHERE actual = 0 AND predicted = 0) AS DOUBLE) AS tn FROM cm GROUP BY ALL""",
    "cm",
)
cte(
    "thr",
    """SELECT model, split, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
              CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
              CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM cells""",
    "cells",
)
cte(
    "per_class",
    """SELECT model, split, '1' AS label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
              CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
              CAST(tp + fn AS BIGINT) AS support FROM cells
       UNION ALL
       SELECT model, split, '0', CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END,
              CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END,
              CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END,
              CAST(tn + fp AS BIGINT) FROM cells""",
    "cells",
)
ORACLE["class_report"] = query(
    f"""SELECT model, split, label, {rnd('precision', 'recall', 'f1')}, support FROM (
        SELECT * FROM per_class UNION ALL
        SELECT model, split, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT)
        FROM per_class GROUP BY ALL UNION ALL
        SELECT model, split, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
               sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class GROUP BY ALL)""",
    "per_class",
)
ORACLE["leaderboard"] = query(
    f"""SELECT a.model, a.split AS dataset, {rnd('roc_auc', 'average_precision', 'accuracy', 'precision', 'recall', 'f1',
        'top_capture_pct')}, CAST(model_rank AS INT) AS model_rank
        FROM auc a JOIN thr t ON a.model = t.model AND a.split = t.split
        JOIN capture c ON c.model = a.model AND c.split = a.split
        JOIN (SELECT a.model, row_number() OVER (ORDER BY top_capture_pct DESC, roc_auc DESC, a.model) AS model_rank
              FROM auc a JOIN capture c ON a.model = c.model AND a.split = c.split WHERE a.split = 'oos') r
          ON r.model = a.model""",
    "auc", "thr", "capture",
)


def _tier(version: str, prob: str = "prob") -> str:
    c = TIER_CUTOFFS[version]
    return f"""CASE WHEN {prob} >= {c['Very_High']}::DOUBLE THEN 'Very High' WHEN {prob} >= {c['High']}::DOUBLE THEN 'High'
        WHEN {prob} >= {c['Medium']}::DOUBLE THEN 'Medium' WHEN {prob} >= {c['Low']}::DOUBLE THEN 'Low' ELSE 'Very Low' END"""


def _decile(version: str) -> str:
    c = DECILE_CUTOFFS[version]
    arms = " ".join(f"WHEN prob >= {c[f'd{11 - d}_min']}::DOUBLE THEN {d}" for d in range(1, 10))
    return f"CASE {arms} ELSE 10 END"


cte("tiered", f"SELECT *, {_tier('august')} AS opt_in_category FROM sc", "sc")
cte("tier_names", """SELECT * FROM (VALUES ('Very High', 0), ('High', 1), ('Medium', 2), ('Low', 3), ('Very Low', 4))
    t(opt_in_category, tier_order)""")
ORACLE["tier_assign"] = query(
    f"""SELECT row_id, opt_in_category, {_tier('june')} AS june_category,
               CASE WHEN opt_in_category = 'Very High' THEN 1 ELSE 0 END AS campaign_flag FROM tiered""",
    "tiered",
)
ORACLE["decile_assign"] = query(
    f"SELECT row_id, {_decile('june')} AS decile_june, {_decile('august')} AS decile_august FROM sc", "sc"
)
cte(
    "ordered",
    """SELECT t.*, row_number() OVER (ORDER BY tier_order, prob DESC, row_id) AS call_target_order,
              row_number() OVER (PARTITION BY opt_in_category ORDER BY prob DESC, row_id) AS opt_in_order_within_category
       FROM tiered t JOIN tier_names USING (opt_in_category)""",
    "tiered", "tier_names",
)
ORACLE["call_order"] = select(
    "ordered", "row_id, opt_in_category, prob AS opt_in_probability, call_target_order, opt_in_order_within_category"
)
ORACLE["tier_distribution"] = query(
    """SELECT opt_in_category, tier_order, count(row_id) AS n,
              round(count(row_id) * 100.0::DOUBLE / (SELECT count(*) FROM tiered), 9) AS share_pct
       FROM tier_names LEFT JOIN tiered USING (opt_in_category) GROUP BY ALL""",
    "tier_names", "tiered",
)
ORACLE["score_decile_table"] = query(
    f"""SELECT d.decile, count(s.row_id) AS counts, CAST(coalesce(sum(target), 0) AS BIGINT) AS positives,
               round(CASE WHEN count(s.row_id) > 0 THEN sum(target) * 100.0::DOUBLE / count(s.row_id) ELSE 0 END, 4)
                   AS target_rate_pct,
               round(coalesce(sum(target), 0) * 100.0::DOUBLE / (SELECT sum(target) FROM sc), 4) AS overall_target_pct,
               round(CASE WHEN count(s.row_id) > 0 THEN sum(target) / count(s.row_id)::DOUBLE
                     / (SELECT avg(target) FROM sc) ELSE 0 END, 4) AS lift,
               round(min(prob), 6) AS min_prob, round(max(prob), 6) AS max_prob
        FROM (SELECT CAST(unnest(range(1, 11)) AS INT) AS decile) d
        LEFT JOIN (SELECT *, {_decile('august')} AS decile FROM sc) s ON s.decile = d.decile GROUP BY d.decile""",
    "sc",
)
cte("doy", "SELECT *, dayofyear(event_date) AS day_of_year FROM sc", "sc")
cte("means", f"SELECT {', '.join(f'round(avg({c}), 6) AS m_{c}' for c in COEFFICIENTS)} FROM doy", "doy")
cte(
    "contrib",
    " UNION ALL ".join(
        f"""SELECT row_id, '{c}' AS feature, {w}::DOUBLE * (CAST({c} AS DOUBLE) - m_{c}) AS contribution,
                   CAST({c} AS DOUBLE) AS value FROM doy, means"""
        for c, w in COEFFICIENTS.items()
    ),
    "doy", "means",
)
ORACLE["linear_contributions"] = query("SELECT row_id, feature, contribution, value FROM contrib", "contrib")


def _drivers(top_n: int, threshold: float) -> str:
    names = " ".join(f"WHEN '{f}' THEN '{d}'" for f, d in DESCRIPTIONS.items())
    cols = ", ".join(
        f"max(CASE WHEN rn = {i} THEN CASE feature {names} ELSE feature END END) AS optindriver_{i}, "
        f"max(CASE WHEN rn = {i} THEN value END) AS optindriver_{i}_value"
        for i in range(1, top_n + 1)
    )
    return f"""SELECT sc.row_id, {cols} FROM sc LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(contribution) DESC, feature) AS rn
        FROM contrib WHERE abs(contribution) >= {threshold}) d ON d.row_id = sc.row_id GROUP BY sc.row_id"""


ORACLE["top_drivers"] = query(_drivers(3, 0.3), "sc", "contrib")
cte("drivers5", _drivers(5, 0.005), "sc", "contrib")
ORACLE["output_select"] = query(
    f"""SELECT o.row_id AS ROW_ID, o.event_date AS EVENT_DATE,
        {', '.join(f'd.{c} AS {c.upper()}' for c in COEFFICIENTS)}, o.prob AS OPT_IN_PROBABILITY,
        o.opt_in_category AS OPT_IN_CATEGORY, o.opt_in_order_within_category AS OPT_IN_ORDER_WITHIN_CATEGORY,
        o.call_target_order AS CALL_TARGET_ORDER,
        {', '.join(f'v.optindriver_{i} AS OPTINDRIVER_{i}, v.optindriver_{i}_value AS OPTINDRIVER_{i}_VALUE' for i in range(1, 6))}
        FROM ordered o JOIN doy d ON o.row_id = d.row_id JOIN drivers5 v ON v.row_id = o.row_id""",
    "ordered", "doy", "drivers5",
)
_shares = ", ".join(f"('{t}', {s})" for t, s in TIER_SHARES.items())
ORACLE["tier_cutoffs_fit"] = query(
    f"""SELECT tier, r.row_number, prob AS cutoff FROM (
            SELECT prob, row_number() OVER (ORDER BY prob DESC, row_id) AS row_number FROM sc WHERE split = 'train') r
        JOIN (SELECT tier, greatest(CAST(floor(share::DOUBLE * (SELECT count(*) FROM sc WHERE split = 'train')) AS BIGINT), 1)
                     AS row_number FROM (VALUES {_shares}) t(tier, share)) p ON p.row_number = r.row_number""",
    "sc",
)
cte(
    "tier_table",
    """SELECT opt_in_category, n, positives, n * 100.0::DOUBLE / sum(n) OVER () AS share_pct,
              positives * 100.0::DOUBLE / n AS rate_pct,
              positives * 100.0::DOUBLE / sum(positives) OVER () AS capture_pct,
              (positives / n::DOUBLE) / (sum(positives) OVER () / sum(n) OVER ()) AS lift,
              CAST(sum(n) OVER w AS BIGINT) AS list_size,
              sum(positives) OVER w * 100.0::DOUBLE / sum(positives) OVER () AS list_capture_pct, tier_order
       FROM (SELECT opt_in_category, tier_order, count(*) AS n, CAST(sum(target) AS BIGINT) AS positives
             FROM tiered JOIN tier_names USING (opt_in_category) GROUP BY ALL)
       WINDOW w AS (ORDER BY tier_order)""",
    "tiered", "tier_names",
)
ORACLE["tier_table"] = query(
    f"""SELECT opt_in_category, n, positives, {rnd('share_pct', 'rate_pct', 'capture_pct', 'lift')}, list_size,
        {rnd('list_capture_pct')} FROM tier_table""",
    "tier_table",
)
ORACLE["outreach_scenarios"] = query(
    f"SELECT tier_order + 1 AS scenario, list_size, {rnd('list_capture_pct')} FROM tier_table WHERE tier_order < 3", "tier_table"
)
cte(
    "segref",
    """SELECT a.model, a.segment, total_rows AS segment_rows, total_pos * 100.0::DOUBLE / total_rows AS base_rate_pct,
              counts AS decile1_count, target_rate_pct AS decile1_rate_pct,
              target_rate_pct / (total_pos * 100.0::DOUBLE / total_rows) AS decile1_lift,
              overall_target_pct AS decile1_capture_pct
       FROM applied a JOIN totals t ON a.model = t.model AND a.split = t.split AND a.segment = t.segment
       WHERE a.split = 'oos' AND n_bins = 10 AND bucket = 1""",
    "applied", "totals",
)
ORACLE["segment_reference"] = query(
    f"""SELECT segment, segment_rows, {rnd('base_rate_pct')}, decile1_count,
        {rnd('decile1_rate_pct', 'decile1_lift', 'decile1_capture_pct')} FROM segref WHERE model = 'champion'""",
    "segref",
)
ORACLE["champion_compare"] = query(
    """SELECT c.segment, round(c.decile1_lift, 9) AS champion_lift, round(p.decile1_lift, 9) AS previous_lift,
              round(c.decile1_lift / p.decile1_lift, 9) AS lift_gain
       FROM segref c JOIN segref p ON c.segment = p.segment WHERE c.model = 'champion' AND p.model = 'previous'""",
    "segref",
)
