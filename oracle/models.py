"""DuckDB texts for encoding, sampling counts, selection and artifacts."""

from __future__ import annotations

from oracle.base import cte, query
from oracle.evaluation import rnd
from spellcast.plans.evaluation_queries import TRAIN_END, VAL_END

ORACLE: dict[str, str] = {}
cte(
    "bn",
    f"""SELECT *, CASE WHEN event_date < DATE '{TRAIN_END}' THEN 'train'
                       WHEN event_date < DATE '{VAL_END}' THEN 'val' ELSE 'oos' END AS split FROM binned""",
    "binned",
)
ORACLE["target_encode"] = query(
    """SELECT row_id, b.state, round(coalesce(rate, g), 9) AS state_rate
       FROM bn b CROSS JOIN (SELECT avg(target) AS g FROM bn WHERE split = 'train')
       LEFT JOIN (SELECT state, (avg(target) * count(target) + (SELECT avg(target) FROM bn WHERE split = 'train') * 100.0::DOUBLE)
                         / (count(target) + 100.0::DOUBLE) AS rate
                  FROM bn WHERE split = 'train' GROUP BY state) r ON r.state = b.state""",
    "bn",
)
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
ORACLE["one_hot"] = query(
    "SELECT row_id, "
    + ", ".join(
        f'CASE WHEN {c} = \'{v}\' THEN 1 ELSE 0 END AS "{c}_{v}"'
        for c, values in (("segment", _SEGMENTS), ("taxonomygeneral", _REGIONS))
        for v in values
    )
    + " FROM bn",
    "bn",
)
ORACLE["one_hot_table"] = query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS level, row_number() OVER (ORDER BY {c}) AS position, count(*) AS n FROM bn GROUP BY {c}"
        for c in ("segment", "taxonomygeneral")
    )
    + ")",
    "bn",
)
ORACLE["level_dictionary"] = query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {x} AS level, count(*) AS n, row_number() OVER (ORDER BY {x} NULLS LAST) - 1 AS position FROM bn GROUP BY {x}"
        for c, x in (("segment", "segment"), ("taxonomygeneral", "taxonomygeneral"), ("cell", "nullif(state || '-' || cycle, 'CHINA-7')"))
    ),
    "bn",
)
ORACLE["level_positions"] = query(
    """SELECT row_id, coalesce(position, (SELECT count(DISTINCT state || '-' || cycle || '-' || segment) FROM bn WHERE split = 'train' AND cycle > 3)) AS position
       FROM bn LEFT JOIN (
         SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS position
         FROM (SELECT DISTINCT state || '-' || cycle || '-' || segment AS cell FROM bn WHERE split = 'train' AND cycle > 3))
       ON cell = state || '-' || cycle || '-' || segment""",
    "bn",
)
ORACLE["undersample_counts"] = query(
    """SELECT split, target, count(*) AS n_before,
              CASE WHEN split = 'train' AND target = 0
                   THEN least(count(*), 2 * (SELECT count(*) FROM bn WHERE split = 'train' AND target = 1))
                   ELSE count(*) END AS n_after
       FROM bn GROUP BY split, target""",
    "bn",
)
ORACLE["class_weights"] = query(
    f"""SELECT target, n, {rnd('balanced_weight', 'scale_weight')} FROM (
        SELECT target, count(*) AS n, sum(count(*)) OVER () / (count(*) * 2.0::DOUBLE) AS balanced_weight,
               CASE WHEN target = 1 THEN (sum(count(*)) OVER () - count(*)) / CAST(count(*) AS DOUBLE) ELSE 1.0 END
                   AS scale_weight
        FROM bn WHERE split = 'train' GROUP BY target)""",
    "bn",
)
_F = ["amount", "amount_twin", "balance", "cycle"]
cte(
    "pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, {i} AS ia, '{b}' AS b, {j} AS ib, corr({a}, {b}) AS r FROM bn"
        for i, a in enumerate(_F) for j, b in enumerate(_F)
    ),
    "bn",
)
# Groups of these features are cliques, so the smallest partner is the group.
ORACLE["correlation_select"] = query(
    f"""SELECT feature, group_of, {rnd('target_correlation', digits=6)},
               row_number() OVER (PARTITION BY group_of ORDER BY abs(target_correlation) DESC, i) = 1 AS kept
        FROM (SELECT a AS feature, ia AS i, arg_min(b, ib) FILTER (WHERE abs(r) > 0.8) AS group_of FROM pairs GROUP BY ALL) g
        JOIN ({' UNION ALL '.join(f"SELECT '{a}' AS f, corr({a}, target) AS target_correlation FROM bn" for a in _F)}) t
          ON t.f = g.feature""",
    "pairs", "bn",
)
cte(
    "gaps",
    """SELECT target, balance, cycle, CASE WHEN row_id % 3 <> 0 THEN amount END AS amount_gaps,
              CASE WHEN row_id % 5 < 3 THEN amount_twin END AS twin_gaps,
              CASE WHEN row_id % 7 = 0 OR cycle > 60 THEN balance END AS balance_gaps FROM bn""",
    "bn",
)
_G = ["balance", "amount_gaps", "twin_gaps", "balance_gaps", "cycle"]
cte(
    "gap_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, {i} AS ia, '{b}' AS b, {j} AS ib, corr({a}, {b}) AS r FROM gaps"
        for i, a in enumerate(_G) for j, b in enumerate(_G)
    ),
    "gaps",
)
ORACLE["correlation_with_gaps"] = query(
    f"""SELECT feature, group_of, {rnd('target_correlation', digits=6)},
               row_number() OVER (PARTITION BY group_of ORDER BY abs(target_correlation) DESC, i) = 1 AS kept
        FROM (SELECT a AS feature, ia AS i, arg_min(b, ib) FILTER (WHERE abs(r) > 0.8) AS group_of FROM gap_pairs GROUP BY ALL) g
        JOIN ({' UNION ALL '.join(f"SELECT '{a}' AS f, corr({a}, target) AS target_correlation FROM gaps" for a in _G)}) t
          ON t.f = g.feature""",
    "gap_pairs", "gaps", "bn",
)
ORACLE["latest_version"] = query("SELECT path FROM artifacts ORDER BY modified DESC, path DESC LIMIT 1", "artifacts")
ORACLE["latest_per_model"] = query(
    """SELECT model, max(path) AS path, max(stamp) AS stamp FROM (
        SELECT path, string_split(replace(string_split(path, '/')[-1], '.model', ''), '__')[2] AS model,
               string_split(replace(string_split(path, '/')[-1], '.model', ''), '__')[3] AS stamp FROM artifacts)
       GROUP BY model""",
    "artifacts",
)
