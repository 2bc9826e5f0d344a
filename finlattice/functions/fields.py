"""Field sets and tolerances of the checks (fixed values)."""

INCOME_FIELDS = {"Banking": "net_interest_income", "Insurance": "net_premium"}

EXPECTED = {
    "pl": ("revenue_net", "gross_profit", "net_profit", "profit_before_tax"),
    "bs": ("total_assets", "total_equity", "total_liabilities"),
    "cf": ("cfo", "cfi", "cff"),
}
MUST_BE_POSITIVE = {
    "pl": ("revenue_gross", "revenue_net", "fee_income", "interest_income", "premium_income", "dividend_income"),
    "bs": ("total_assets", "total_equity", "share_capital", "cash_and_equivalents", "inventory", "receivables"),
    "cf": (),
}
REQUIRED = ("ticker", "period_end", "canonical_field", "value", "statement_type")
UNITS = ("thousands", "millions", "rupees", "full_rupees")

PL_REVENUE = (
    "revenue_net", "revenue_gross", "revenue", "net_interest_income", "interest_income", "net_premium", "gross_premium", "underwriting_profit",
    "dividend_income", "royalty_income", "total_income", "revenue_lease_financing", "revenue_diminishing_musharaka", "capacity_revenue",
    "energy_revenue", "turnover", "lease_income", "share_of_associates", "share_of_profit_in_associates", "other_income",
)
PL_BOTTOM = ("net_profit", "profit_after_tax", "net_profit_parent")

#: Candidates for the field that outliers are judged by, in order.
REFERENCE_FIELDS = {"pl": ("revenue_net", "net_profit", "gross_profit"), "cf": ("cfo", "net_cash_change", "cash_end"), "bs": ("total_assets",)}

#: What net profit may further hold, in the order of trial.
PL_EXTRAS = ("share_of_associates", "share_of_joint_ventures", "gain_on_disposal", "loss_on_disposal", "other_non_operating", "other_income")

CF_RECONCILING = (
    "fx_adjustment", "fx_effect_on_cash", "cash_flow_assets_held_for_sale", "net_cash_assets_held_for_sale", "non_current_asset_held_for_sale",
    "cash_from_discontinued_ops", "net_cash_inflow_amalgamation", "cash_from_merger", "cash_from_acquisition", "transfer_upon_amalgamation",
    "effect_of_amalgamation", "transfer_from_amalgamation", "cash_from_acquisitions", "cash_on_acquisition", "cash_from_business_combination",
    "cash_of_subsidiary_at_disposal", "cash_from_subsidiary_disposal", "cash_transferred_to_subsidiary", "cash_transferred_to_subsidiaries",
    "cash_equivalents_of_ncpl", "cash_equivalents_ncpl", "cash_equivalents_from_demerged_associate", "short_term_borrowings_start",
    "short_term_borrowings_transferred",
)

CRITICAL = ("total_assets", "total_equity", "total_liabilities", "total_equity_and_liabilities", "net_profit", "revenue_net", "profit_before_tax", "cfo", "cash_end", "cash_start")
