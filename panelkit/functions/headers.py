"""Column-header status and label categories: ordered rules, first match wins."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelkit.functions.text import Col, as_col, let, lookup, rule_chain, squeeze

# --- fixed values ----------------------------------------------------------------------------------
NOT_FINAL_RULES = [
    ("preliminary", r"\bprel\b|\bpreliminary\b|\bprovisional\b"),
    ("estimate", r"\best\b|\bestimated?\b"),
    ("projection", r"\bproj\b|\bprojections?\b|\bforecast\b"),
]
STATUS_RULES = NOT_FINAL_RULES + [
    ("actual", r"\bactual\b|\boutturn\b|\bfinal\b"),
    ("historical", r"\bhistorical\b|\bhistory\b"),
]
ELIGIBLE = ["actual", "historical"]
NOT_FINAL = ["preliminary", "estimate", "projection"]
REASON_STATUS = {
    "year_not_in_table": "year_not_in_table",
    "year_only_in_merged_range": "merged_range_only",
    "column_is_preliminary": "rejected_not_actual",
    "column_is_estimate": "rejected_not_actual",
    "column_is_projection": "rejected_not_actual",
    "status_unclear": "rejected_not_actual",
    "values_unreadable": "values_unreadable",
}
FLOW_RULES = [
    ("Privatization", r"privati"),
    ("Contingent liabilities", r"contingent|implicit liabilit|implicit or contingent"),
    ("Debt relief", r"debt relief|hipc|mdri"),
    ("Asset accumulation", r"asset accum|accumulation of|liquid asset|deposit|financial asset"),
]
FLOW_PLACEHOLDER = r"e\.g\.?,?\s*(?:privati|contingent|debt relief|drawdown of deposit|deposit)"
DRIVER_RULES = [
    ("Contingent liab. / bank recap / SOE",
     r"contingent|bank|recap|financial sector|guarantee|soe|state[- ]owned|bodens"),
    ("Privatization", r"privati"),
    ("Deposits / asset accumulation",
     r"deposit|financial assets|drawdown|net lend|equity|investment fund|asset accum|liquid assets|selected assets|"
     r"esm|euro ?area loans"),
    ("Debt relief / restructuring / arrears", r"hipc|mdri|relief|forgive|restructur|arrears|haircut"),
    ("Valuation / exchange rate", r"exchange|valuation|inflation"),
]
# ---------------------------------------------------------------------------------------------------


def header_status(c: Col) -> Column:
    text = F.lower(squeeze(F.coalesce(as_col(c).cast("string"), F.lit(""))))
    return let(text, lambda t: rule_chain(t, STATUS_RULES, "unknown"))


def explicit_not_final(c: Column) -> Column:
    """preliminary / estimate / projection when the text says so, else NULL."""
    return let(F.lower(squeeze(c)), lambda t: rule_chain(t, NOT_FINAL_RULES))


def status_of(c: Col) -> Column:
    return F.lower(F.trim(F.coalesce(as_col(c).cast("string"), F.lit(""))))


def answer_status(reason: Col) -> Column:
    return F.coalesce(lookup(REASON_STATUS, as_col(reason)), F.lit("not_extracted"))


def label_category(label: Col, rules=None, exclude: str | None = FLOW_PLACEHOLDER, default: str = "Other") -> Column:
    """Category of a label. The exclusion is tested first; no match (or no label) gives the default."""
    def of(low: Column) -> Column:
        ruled = rule_chain(low, rules or FLOW_RULES, default)
        return F.when(low.rlike(exclude), F.lit(default)).otherwise(ruled) if exclude else ruled
    return let(F.lower(F.coalesce(as_col(label), F.lit(""))), of)


def driver_category(label: Col, rules=None, missing: str = "No sub-item reported",
                    default: str = "Other / unspecified") -> Column:
    return F.when(as_col(label).isNull() | (F.lower(as_col(label)) == "nan"), F.lit(missing)).otherwise(
        label_category(label, rules or DRIVER_RULES, None, default))
