"""Oracle SQL per query key."""

from __future__ import annotations

import oracle.pipeline  # noqa: F401  (registers its texts)
from oracle.base import query, select
from oracle.evaluation import ORACLE as EVALUATION
from oracle.models import ORACLE as MODELS
from oracle.quality import ORACLE as QUALITY
from oracle.features import FEATURE_KEYS, FILLED, RECENT, ROW

ORACLE: dict[str, str] = {
    "bronze_payments": select("bronze_payments"),
    "bronze_cancelled": select("bronze_cancelled"),
    "eligible_providers": select("eligible"),
    "cohort0_spells": select("cohort0_spells"),
    "action_timeline": select("action_timeline", "* EXCLUDE (action_rank)"),
    "next_action": select("next_action"),
    "optout_spells": select("optout_spells"),
    "target_repair": select("target_repair"),
    "all_spells": select("all_spells"),
    "date_spine": query(
        """SELECT d.snap_dt, count(r.tin) AS spells FROM date_spine d
           LEFT JOIN snapshot_rows r ON r.date_end_oos = d.snap_dt GROUP BY d.snap_dt""",
        "date_spine", "snapshot_rows",
    ),
    "snapshot_rows": select("snapshot_rows"),
    "horizon_label": select("gold"),
    "label_rate_by_month": query(
        """SELECT CAST(date_trunc('month', g.date_end) AS DATE) AS month, count(*) AS snapshots,
                  CAST(sum(opt_in_ach) AS BIGINT) AS ach_optins, CAST(sum(opt_in_vcc) AS BIGINT) AS vcc_optins,
                  round(avg(opt_in_ach), 8) AS ach_rate,
                  CAST(coalesce(sum(sumcheckpaymentcount90), 0) AS BIGINT) AS checks_90
           FROM gold g JOIN lookback_trailing l ON g.tin = l.tin AND g.providerid = l.providerid
            AND g.date_start = l.date_start AND g.date_end = l.date_end GROUP BY 1""",
        "gold", "lookback_trailing",
    ),
    "lookback_by_product": select("lookback_by_product"),
    "lookback_trailing": select("lookback_trailing"),
    "payer_lists": select("payer_lists"),
    "prior_optouts": select("prior_optouts"),
    "prior_optouts_year": select("prior_optouts_year"),
    "phone_counts": select("phone_counts"),
    "exclusion_flags": select("exclusion_flags"),
    "gold_training_row": select("training_row"),
    "training_run": query(
        """SELECT CAST(date_trunc('month', date_end) AS DATE) AS month, count(*) AS n_rows, 0 AS rebuilt,
                  CAST(sum(sumtotalpaymentcount) AS BIGINT) AS payments FROM training_row GROUP BY 1""",
        "training_row",
    ),
}
ORACLE |= {k: select(k) for k in FEATURE_KEYS}
ORACLE["feat_fill_filter"] = select("prepared", ", ".join([ROW, "duration", *FILLED, *RECENT]))
ORACLE |= EVALUATION
ORACLE |= QUALITY
ORACLE |= MODELS
