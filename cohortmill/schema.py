"""Column names and labels shared by the whole package."""

from __future__ import annotations

# Profit types scanned by default.
PROFIT_TYPES = ["e_supplier_profit", "licai_order_profit", "ad_profit"]

# Profit types valued by the linear (regression) model.
LINEAR_TYPES = ["e_supplier_profit", "common_order_profit", "tao2_order_profit", "zy_order_profit"]

# Profit types valued by the multiplicative model.
MULTIPLE_TYPES = ["ad_profit", "ad_common_profit", "ad_licai_profit", "licai_order_profit"]

# Measures every value workload needs.
COUNT_MEASURES = ["reg_user_cnt", "isprofit_d07_cnt"]
PROFIT_MEASURES = ["profit_d07", "profit_m01", "profit_y01", "profit_pm08", "profit_mm03"]
MEASURES = COUNT_MEASURES + PROFIT_MEASURES

MONTHS = [f"{n:02d}" for n in range(1, 37)]
MONTH_PROFITS = [f"profit_m{n}" for n in MONTHS]

# Four-level hierarchy, fine to coarse, as (compute label, refer label).
HIERARCHY = [
    ("channel_class", "channel_class_value_refer"),
    ("channel_category", "channel_category_value_refer"),
    ("channel_department", "channel_department_value_refer"),
    ("all_compute", "all_refer"),
]
COMPUTE_COLS = [compute for compute, _ in HIERARCHY]
REFER_COLS = [refer for _, refer in HIERARCHY]

# Six-column hierarchy, fine to coarse.
DIMENSIONS = [
    "ora_source",
    "ora_channel",
    "ora_activity_type",
    "ora_parent_channel",
    "ora_channel_type",
    "ora_business_type",
]

# Fixed value: label of a rolled-up dimension.
ROLLED_UP = "-"
