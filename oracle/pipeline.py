"""DuckDB texts for the training-table build, written naively: one join per aggregate."""

from __future__ import annotations

from oracle.base import cte
from spellcast.config import (
    CALL_ACTION,
    CALL_REASONS,
    CANCELLED_STATUS,
    FIXTURE_SETTINGS as S,
    PRODUCT_LINES,
    VALID_STATUSES,
)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _typed(status: str) -> str:
    cols = ", ".join(
        f"CASE WHEN p.productline = '{line}' THEN p.paymentcount ELSE 0 END AS {name}paymentcount, "
        f"CASE WHEN p.productline = '{line}' THEN p.paymentamount ELSE 0.0 END AS {name}paymentamount"
        for name, line in PRODUCT_LINES.items()
    )
    return f"""
        SELECT p.*, e.providercreatedon, {cols}
        FROM payments p JOIN providers e ON p.tin = e.tin AND p.providerid = e.providerid
        WHERE p.statusname IN {status} AND p.paymentamount > {S.min_amount}
          AND e.providercreatedon >= DATE '{S.created_from}'"""


cte("bronze_payments", _typed(_in(VALID_STATUSES)), "payments", "providers")
cte("bronze_cancelled", _typed(_in([CANCELLED_STATUS])), "payments", "providers")
cte(
    "eligible",
    f"""
    SELECT e.*, ach.firstachpaydate, a.date_first_ach_optin, a.date_last_ach_optin, a.ach_optin_count,
           CASE WHEN ach.firstachpaydate IS NULL THEN 0 ELSE 1 END AS optin_ach,
           vcc.firstvccpaydate, v.date_first_vcc_optin, v.date_last_vcc_optin, v.vcc_optin_count,
           CASE WHEN vcc.firstvccpaydate IS NULL THEN 0 ELSE 1 END AS optin_vcc,
           o.optout_counts, o.date_first_optout, o.date_last_optout
    FROM providers e
    LEFT JOIN (SELECT tin, providerid, min(paymentweek) AS firstachpaydate FROM bronze_payments
               WHERE productline = 'ACH+' GROUP BY ALL) ach
      ON e.tin = ach.tin AND e.providerid = ach.providerid
    LEFT JOIN (SELECT tin, providerid, min(paymentweek) AS firstvccpaydate FROM bronze_payments
               WHERE productline = 'VCC' GROUP BY ALL) vcc
      ON e.tin = vcc.tin AND e.providerid = vcc.providerid
    LEFT JOIN (SELECT tin, providerid, count(DISTINCT statusstartdate) AS optout_counts,
                      min(statusstartdate) AS date_first_optout, max(statusstartdate) AS date_last_optout
               FROM history WHERE statusname = 'Opt-Out' GROUP BY ALL) o
      ON e.tin = o.tin AND e.providerid = o.providerid
    LEFT JOIN (SELECT tin, providerid, min(statusstartdate) AS date_first_ach_optin,
                      max(statusstartdate) AS date_last_ach_optin,
                      count(DISTINCT statusstartdate) AS ach_optin_count
               FROM history WHERE statusname = 'Opt-In' AND productlinename LIKE '%VRA%' GROUP BY ALL) a
      ON e.tin = a.tin AND e.providerid = a.providerid
    LEFT JOIN (SELECT tin, providerid, min(statusstartdate) AS date_first_vcc_optin,
                      max(statusstartdate) AS date_last_vcc_optin,
                      count(DISTINCT statusstartdate) AS vcc_optin_count
               FROM history WHERE statusname = 'Opt-In' AND productlinename LIKE '%Select%' GROUP BY ALL) v
      ON e.tin = v.tin AND e.providerid = v.providerid
    WHERE e.providercreatedon >= DATE '{S.created_from}'""",
    "providers", "history", "bronze_payments",
)
ATTRS = "segment, apv, providertype, taxonomygeneral, taxonomyspecialty, state, providercreatedon"
_LEAST = "CASE WHEN {0} IS NOT NULL AND {1} IS NOT NULL THEN least({0}, {1}) END"
_ACH = _LEAST.format("firstachpaydate", "date_first_ach_optin")
_VCC = _LEAST.format("firstvccpaydate", "date_first_vcc_optin")
_COHORT0 = f"""
    SELECT concat(tin, ' | ', providerid) AS tpid, tin, providerid, {ATTRS},
           providercreatedon AS date_start, {{end}} AS date_end,
           {{end}} - providercreatedon AS time_of_study,
           {{ach}} AS optin_target_ach, {{vcc}} AS optin_target_vcc,
           'Provider All Time Opt Outs = 0' AS silver_cohort
    FROM eligible WHERE optout_counts IS NULL AND optin_ach = {{is_ach}} AND optin_vcc = {{is_vcc}}"""
cte(
    "cohort0_spells",
    " UNION ".join(
        [
            _COHORT0.format(end=f"({_ACH})", ach=1, vcc=0, is_ach=1, is_vcc=0),
            _COHORT0.format(end=f"({_VCC})", ach=0, vcc=1, is_ach=0, is_vcc=1),
            _COHORT0.format(
                end=f"(CASE WHEN ({_ACH}) < ({_VCC}) THEN ({_ACH}) ELSE ({_VCC}) END)",
                ach=f"CASE WHEN ({_ACH}) <= ({_VCC}) THEN 1 ELSE 0 END",
                vcc=f"CASE WHEN ({_VCC}) <= ({_ACH}) THEN 1 ELSE 0 END",
                is_ach=1, is_vcc=1,
            ),
            _COHORT0.format(end=f"DATE '{S.as_of}'", ach=0, vcc=0, is_ach=0, is_vcc=0),
        ]
    ),
    "eligible",
)
cte(
    "raw_actions",
    """
    SELECT tin, providerid, providercreatedon AS action_date, 'Account Creation' AS action_type,
           CAST(NULL AS VARCHAR) AS productline, 0 AS action_rank
    FROM eligible WHERE optout_counts >= 1
    UNION ALL
    SELECT h.tin, h.providerid, h.statusstartdate, 'Opt-Out', NULL, 1
    FROM history h JOIN eligible e ON e.tin = h.tin AND e.providerid = h.providerid
    WHERE h.statusname = 'Opt-Out' AND e.optout_counts >= 1
    UNION ALL
    SELECT p.tin, p.providerid, p.paymentweek, 'Opt-In', p.productline, 2
    FROM bronze_payments p JOIN eligible e ON e.tin = p.tin AND e.providerid = p.providerid
    WHERE p.productline IN ('ACH+', 'VCC') AND e.optout_counts >= 1
    UNION ALL
    SELECT h.tin, h.providerid, h.statusstartdate, 'Opt-In',
           CASE WHEN h.productlinename LIKE '%VRA%' THEN 'ACH+' ELSE 'VCC' END, 2
    FROM history h JOIN eligible e ON e.tin = h.tin AND e.providerid = h.providerid
    WHERE h.statusname = 'Opt-In' AND (h.productlinename LIKE '%VRA%' OR h.productlinename LIKE '%Select%')
      AND e.optout_counts >= 1""",
    "eligible", "bronze_payments", "history",
)
cte(
    "action_timeline",
    """
    SELECT a.tin, a.providerid, a.action_date, a.action_type, a.productline, a.action_rank,
           CASE WHEN e.optout_counts = 1 THEN 1 ELSE 2 END AS cohort, count(*) AS n_events
    FROM raw_actions a JOIN eligible e ON a.tin = e.tin AND a.providerid = e.providerid
    GROUP BY ALL""",
    "raw_actions", "eligible",
)
_ORDER = "PARTITION BY tin, providerid ORDER BY action_date, action_rank, productline"
cte(
    "next_action",
    f"""
    SELECT *, lead(action_date) OVER w AS next_action_date, lead(action_type) OVER w AS next_action_type,
           lead(productline) OVER w AS next_productline
    FROM action_timeline WINDOW w AS ({_ORDER})""",
    "action_timeline",
)
# From the uncollapsed actions; repeated equal opt-outs give zero-length spells, of which
# the first one per day is kept.
cte(
    "optout_spells",
    f"""
    SELECT * EXCLUDE (rn), concat(tin, ' | ', providerid) AS tpid
    FROM (
        SELECT t.tin, t.providerid, t.cohort, date_start, date_end, start_status, end_status, next_productline,
               CAST(sum(CASE WHEN end_status = 'Opt-In' THEN 1 ELSE 0 END) OVER b AS BIGINT) AS previousoptincount,
               CAST(sum(CASE WHEN end_status = 'Opt-In' AND next_productline = 'ACH+' THEN 1 ELSE 0 END)
                    OVER b AS BIGINT) AS previousachoptincount,
               CAST(sum(CASE WHEN end_status = 'Opt-In' AND next_productline = 'VCC' THEN 1 ELSE 0 END)
                    OVER b AS BIGINT) AS previousvccoptincount,
               lag(date_start) OVER w AS previous_start_date, lag(start_status) OVER w AS previous_start_status,
               lag(date_end) OVER w AS previous_end_date, lag(end_status) OVER w AS previous_end_status,
               lead(date_start) OVER w AS next_start_date, lead(start_status) OVER w AS next_start_status,
               CASE WHEN lag(end_status) OVER w = 'Opt-In' THEN date_start - lag(date_end) OVER w END
                   AS lastoptinduration,
               date_end - date_start AS time_of_study,
               CASE WHEN end_status = 'Opt-In' AND next_productline = 'ACH+' THEN 1 ELSE 0 END AS optin_target_ach,
               CASE WHEN end_status = 'Opt-In' AND next_productline = 'VCC' THEN 1 ELSE 0 END AS optin_target_vcc,
               {ATTRS},
               row_number() OVER (PARTITION BY t.tin, t.providerid, date_start, date_end, start_status, end_status
                                  ORDER BY seq) AS rn
        FROM (
            SELECT tin, providerid, cohort, seq, action_rank, action_date AS date_start,
                   coalesce(next_date, DATE '{S.as_of}') AS date_end, action_type AS start_status,
                   next_type AS end_status, next_productline
            FROM (
                SELECT a.*, CASE WHEN e.optout_counts = 1 THEN 1 ELSE 2 END AS cohort,
                       row_number() OVER w AS seq,
                       lead(action_date) OVER w AS next_date, lead(action_type) OVER w AS next_type,
                       lead(productline) OVER w AS next_productline
                FROM raw_actions a JOIN eligible e ON a.tin = e.tin AND a.providerid = e.providerid
                WINDOW w AS (PARTITION BY a.tin, a.providerid ORDER BY action_date, action_rank, productline)
            )
            WHERE action_type = 'Account Creation'
               OR (action_type = 'Opt-Out' AND (next_type = 'Opt-In' OR next_type IS NULL
                                                OR (cohort = 2 AND next_type = 'Opt-Out')))
        ) t JOIN eligible e ON t.tin = e.tin AND t.providerid = e.providerid
        WINDOW w AS (PARTITION BY t.tin, t.providerid ORDER BY date_start, action_rank, seq),
               b AS (PARTITION BY t.tin, t.providerid ORDER BY date_start, action_rank, seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )
    WHERE rn = 1 OR date_start <> date_end""",
    "raw_actions", "eligible",
)
_IN_SPELL = """
    LEFT JOIN (SELECT t.tin, t.providerid, t.date_start, t.date_end,
                      CAST(coalesce(sum(p.{0}paymentcount), 0) AS BIGINT) AS n
               FROM (SELECT DISTINCT tin, providerid, date_start, date_end, next_start_date FROM optout_spells) t
               JOIN bronze_payments p ON t.tin = p.tin AND t.providerid = p.providerid
                AND p.paymentweek BETWEEN t.date_end AND coalesce(t.next_start_date, DATE '{2}')
               WHERE p.productline = '{1}' GROUP BY ALL) {0}
      ON o.tin = {0}.tin AND o.providerid = {0}.providerid AND o.date_start = {0}.date_start
     AND o.date_end = {0}.date_end"""
cte(
    "target_repair",
    f"""
    SELECT *, CASE WHEN semi_row_eligible = 1 THEN optin_target_ach
                   WHEN optin_target_vcc = 1 AND ach_counts_during_optin IS NOT NULL THEN 1
                   ELSE 0 END AS new_optin_target_ach,
              CASE WHEN semi_row_eligible = 1 THEN optin_target_vcc
                   WHEN optin_target_ach = 1 AND vcc_counts_during_optin IS NOT NULL THEN 1
                   ELSE 0 END AS new_optin_target_vcc
    FROM (
        SELECT o.*, ach.n AS ach_counts_during_optin, vcc.n AS vcc_counts_during_optin,
               CASE WHEN o.cohort = 1 THEN 'Provider All Time Opt Outs = 1'
                    ELSE 'Provider All Time Opt Outs > 1' END AS silver_cohort,
               CASE WHEN (optin_target_ach = 0 AND optin_target_vcc = 0)
                      OR (optin_target_ach = 1 AND ach.n IS NOT NULL)
                      OR (optin_target_vcc = 1 AND vcc.n IS NOT NULL) THEN 1 ELSE 0 END AS semi_row_eligible
        FROM optout_spells o {_IN_SPELL.format('ach', 'ACH+', S.as_of)} {_IN_SPELL.format('vcc', 'VCC', S.as_of)}
    )""",
    "optout_spells", "bronze_payments",
)
_SPELL_COLS = (
    f"tpid, tin, providerid, {ATTRS}, date_start, date_end, previousoptincount, previousachoptincount, "
    "previousvccoptincount, lastoptinduration, time_of_study"
)
cte(
    "all_spells",
    f"""
    SELECT tpid, tin, providerid, {ATTRS}, date_start, date_end, CAST(0 AS BIGINT) AS previousoptincount,
           CAST(0 AS BIGINT) AS previousachoptincount, CAST(0 AS BIGINT) AS previousvccoptincount,
           CAST(NULL AS BIGINT) AS lastoptinduration, time_of_study, optin_target_ach, optin_target_vcc,
           silver_cohort
    FROM cohort0_spells
    UNION
    SELECT {_SPELL_COLS}, new_optin_target_ach, new_optin_target_vcc, silver_cohort
    FROM target_repair""",
    "cohort0_spells", "target_repair",
)
cte(
    "date_spine",
    f"""
    SELECT CAST(d AS DATE) AS snap_dt
    FROM generate_series(TIMESTAMP '{S.spine_start}', TIMESTAMP '{S.spine_end}', INTERVAL 1 DAY) g(d)
    WHERE day(d) IN (1, 15)""",
)
cte(
    "snapshot_rows",
    """
    SELECT DISTINCT s.*, d.snap_dt AS date_end_oos, d.snap_dt - s.date_start AS duration_oos
    FROM all_spells s JOIN date_spine d ON d.snap_dt > s.date_start AND d.snap_dt <= s.date_end""",
    "all_spells", "date_spine",
)
cte(
    "horizon_label",
    f"""
    SELECT * EXCLUDE (date_end, date_end_oos, duration_oos, time_of_study, optin_target_ach, optin_target_vcc),
           date_end_oos AS date_end, duration_oos AS duration,
           CAST(date_end_oos + INTERVAL {S.horizon_days} DAY AS DATE) AS date_end_plus_30,
           CASE WHEN date_end BETWEEN date_end_oos AND date_end_oos + INTERVAL {S.horizon_days} DAY
                 AND optin_target_ach = 1 THEN 1 ELSE 0 END AS opt_in_ach,
           CASE WHEN date_end BETWEEN date_end_oos AND date_end_oos + INTERVAL {S.horizon_days} DAY
                 AND optin_target_vcc = 1 THEN 1 ELSE 0 END AS opt_in_vcc
    FROM snapshot_rows""",
    "snapshot_rows",
)
cte("gold", f"SELECT * FROM horizon_label WHERE duration > {S.min_duration}", "horizon_label")

ROW = "g.tin, g.providerid, g.date_start, g.date_end"
_LIFETIME = {
    "sumcheckpayment": "p.productline = 'Check'",
    "sumachpayment": "p.productline = 'ACH+'",
    "sumvccpayment": "p.productline = 'VCC'",
    "sumpayersponsoredpayment": "p.productline = 'PayerSponsoredACH'",
    "sumreversalpayment": "p.productline = 'ACH Reversal'",
    "sumtotalpayment": "p.productline != 'ACH Reversal'",
    "sumimportantpayment": "(p.productline = 'Check' OR p.productline = 'PayerSponsoredACH')",
}
_LISTS = {
    "sumcheckpayment": "payerid_list_check",
    "cancelledcheckpayment": "cancelled_payeridlist_check",
    "sumachpayment": "payerid_list_ach",
    "sumvccpayment": "payerid_list_vcc",
    "sumpayersponsoredpayment": "payerid_list_payersponsored",
    "sumreversalpayment": "payerid_list_reversal",
    "sumtotalpayment": "payerid_list_total",
    "sumimportantpayment": "payerid_list_important",
}


def _sums(prefix: str, source: str, where: str, lower: str, suffix: str = "", lists: bool = False) -> str:
    extra = (
        f", string_agg(DISTINCT CAST(p.payerid AS VARCHAR), ', ' ORDER BY p.payerid) AS {_LISTS[prefix]}"
        if lists else ""
    )
    return f"""
        SELECT {ROW}, CAST(sum(p.paymentcount) AS BIGINT) AS {prefix}count{suffix},
               round(sum(p.paymentamount), 2) AS {prefix}amount{suffix}{extra}
        FROM gold g JOIN {source} p ON g.tin = p.tin AND g.providerid = p.providerid
         AND p.paymentweek >= {lower} AND p.paymentweek < g.date_end
        WHERE {where} GROUP BY ALL"""


def _last(column: str, source: str, where: str) -> str:
    return f"""
        SELECT {ROW}, max(p.paymentweek) AS {column}
        FROM gold g JOIN {source} p ON g.tin = p.tin AND g.providerid = p.providerid
         AND p.paymentweek >= g.date_start AND p.paymentweek < g.date_end
        WHERE p.productline = 'Check' AND {where} GROUP BY ALL"""


def _star(parts: dict[str, str], base: str = "SELECT tin, providerid, date_start, date_end FROM gold") -> str:
    """Left join each part, keyed by the full row key, onto the base rows."""
    joins = "\n".join(
        f"LEFT JOIN ({sql}) {a} ON b.tin = {a}.tin AND b.providerid = {a}.providerid "
        f"AND b.date_start = {a}.date_start AND b.date_end = {a}.date_end"
        for a, sql in parts.items()
    )
    cols = ", ".join(f"{a}.* EXCLUDE (tin, providerid, date_start, date_end)" for a in parts)
    return f"SELECT b.*, {cols} FROM ({base}) b {joins}"


_CHECK = _LIFETIME["sumcheckpayment"]
_BY_PRODUCT = {
    f"l{i}": _sums(p, "bronze_payments", w, "g.date_start") for i, (p, w) in enumerate(_LIFETIME.items())
} | {
    "lx": _sums("cancelledcheckpayment", "bronze_cancelled", _CHECK, "g.date_start"),
    "ld": _last("lastcheckdate", "bronze_payments", "p.statusname = 'Processed - Paid'"),
    "lc": _last("lastcancelledcheckdate", "bronze_cancelled", "p.statusname = 'Cancelled'"),
}
_TRAILING = {}
for _k in S.trailing_days:
    _lo = f"g.date_end - INTERVAL {_k} DAY"
    _TRAILING[f"v{_k}"] = _sums("sumcheckpayment", "bronze_payments", _CHECK, _lo, str(_k))
    _TRAILING[f"x{_k}"] = _sums("cancelledcheckpayment", "bronze_cancelled", _CHECK, _lo, str(_k))
cte("lookback_by_product", _star(_BY_PRODUCT), "gold", "bronze_payments", "bronze_cancelled")
cte("lookback_trailing", _star(_TRAILING), "gold", "bronze_payments", "bronze_cancelled")


def _list(prefix: str, source: str, where: str) -> str:
    return f"""
        SELECT {ROW}, string_agg(DISTINCT p.payerid, ', ' ORDER BY p.payerid) AS {_LISTS[prefix]}
        FROM gold g JOIN {source} p ON g.tin = p.tin AND g.providerid = p.providerid
         AND p.paymentweek >= g.date_start AND p.paymentweek < g.date_end
        WHERE {where} GROUP BY ALL"""


cte(
    "payer_lists",
    _star(
        {f"p{i}": _list(p, "bronze_payments", w) for i, (p, w) in enumerate(_LIFETIME.items())}
        | {"px": _list("cancelledcheckpayment", "bronze_cancelled", _CHECK)}
    ),
    "gold", "bronze_payments", "bronze_cancelled",
)


def _optouts(suffix: str, lower: str) -> str:
    note = "lower(coalesce(h.notes, ''))"
    return f"""
        SELECT {ROW}, count(h.tin) AS total_prev_optouts{suffix},
               max(h.statusstartdate) AS date_last_optout{suffix},
               arg_max_null(h.notes, h.statusstartdate::VARCHAR || coalesce(h.notes, ''))
                   FILTER (WHERE h.tin IS NOT NULL) AS last_optout_note{suffix},
               CASE WHEN coalesce(bool_or({note} LIKE '%fee%' OR {note} LIKE '%want to pay to be paid%'),
                                  false) THEN 1 ELSE 0 END AS optout_notes_fee_flag{suffix},
               CASE WHEN coalesce(bool_or({note} LIKE '%understand%' OR {note} LIKE '%agree to product%'),
                                  false) THEN 1 ELSE 0 END AS optout_notes_dont_understand_agree_flag{suffix}
        FROM gold g LEFT JOIN history h ON h.tin = g.tin AND h.providerid = g.providerid
         AND h.statusname = 'Opt-Out' AND h.optout_reason = 0 AND h.statusstartdate < g.date_end {lower}
        GROUP BY ALL"""


cte("prior_optouts", _optouts("", ""), "gold", "history")
cte(
    "prior_optouts_year",
    _optouts("_last_year", f"AND h.statusstartdate >= g.date_end - INTERVAL {S.optout_lookback_days} DAY"),
    "gold", "history",
)


def _calls(column: str, lower: str) -> str:
    return f"""
        SELECT {ROW}, CAST(sum(CASE WHEN i.actionname = '{CALL_ACTION}'
                                     AND i.actionreasonname IN {_in(CALL_REASONS)} THEN 1 ELSE 0 END)
                           AS BIGINT) AS {column}
        FROM gold g LEFT JOIN interactions i ON g.tin = i.tin AND g.providerid = i.providerid
         AND i.interactiondate >= {lower} AND i.interactiondate < g.date_end
        GROUP BY ALL"""


cte(
    "phone_counts",
    _star(
        {"c": _calls("phonecount", "g.date_start")}
        | {f"c{k}": _calls(f"phonecount{k}", f"g.date_end - INTERVAL {k} DAY") for k in S.trailing_days}
    ),
    "gold", "interactions",
)
cte(
    "exclusion_flags",
    f"""
    SELECT tin, providerid, bool_or(donotcall) AS donotcall, bool_or(globalexcluded) AS globalexcluded,
           bool_or(statusid = {S.sponsored_status_id} AND productlineid = {S.sponsored_product_id}
                   AND (iswhitelabel OR isdirectzero)) AS payersponsored
    FROM provider_map m JOIN provider_flags f ON m.providerid = f.providerid GROUP BY tin, m.providerid
    """.replace("SELECT tin, providerid,", "SELECT tin, m.providerid,"),
    "provider_map", "provider_flags",
)
_KEYED = "AND b.date_start = {0}.date_start AND b.date_end = {0}.date_end"
cte(
    "training_row",
    f"""
    SELECT b.*, bp.* EXCLUDE (tin, providerid, date_start, date_end),
           tr.* EXCLUDE (tin, providerid, date_start, date_end),
           pl.* EXCLUDE (tin, providerid, date_start, date_end),
           oo.* EXCLUDE (tin, providerid, date_start, date_end),
           oy.* EXCLUDE (tin, providerid, date_start, date_end),
           pc.* EXCLUDE (tin, providerid, date_start, date_end),
           ex.* EXCLUDE (tin, providerid),
           b.date_end - bp.lastcheckdate AS time_since_last_check_payment,
           b.date_end - bp.lastcancelledcheckdate AS time_since_last_cancelled_check_payment,
           CASE WHEN concat(', ', pl.payerid_list_important, ', ') LIKE '%, {S.focus_payer}, %' THEN 1 ELSE 0 END
               AS imp_contains_metlife,
           CASE WHEN pl.payerid_list_important = '{S.focus_payer}' THEN 1 ELSE 0 END AS imp_is_only_metlife
    FROM gold b
    """
    + "\n".join(
        f"LEFT JOIN {t} {a} ON b.tin = {a}.tin AND b.providerid = {a}.providerid {_KEYED.format(a)}"
        for a, t in {
            "bp": "lookback_by_product", "tr": "lookback_trailing", "pl": "payer_lists",
            "oo": "prior_optouts", "oy": "prior_optouts_year", "pc": "phone_counts",
        }.items()
    )
    + """
    LEFT JOIN exclusion_flags ex ON b.tin = ex.tin AND b.providerid = ex.providerid
    WHERE bp.sumimportantpaymentcount > 0""",
    "gold", "lookback_by_product", "lookback_trailing", "payer_lists", "prior_optouts",
    "prior_optouts_year", "phone_counts", "exclusion_flags",
)
