"""Line-item ids: category, level, parent, sort key, column names."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelkit.functions.text import Col, as_col, let, lookup, strip

# --- fixed values ----------------------------------------------------------------------------------
CATEGORIES = ["change_in_debt", "identified_flows", "primary_balance",
              "automatic_debt_dynamics", "other_identified_flows", "residual"]
ROLES = ["debt_level"] + CATEGORIES           # debt_level is read but never flattened
ITEM_ID = r"^[1-6](?:\.\d+)*$"
# ---------------------------------------------------------------------------------------------------
CATEGORY_OF_ID = {str(n): name for n, name in enumerate(CATEGORIES, start=1)}


def top_category(hid: Col) -> Column:
    return lookup(CATEGORY_OF_ID, F.split_part(strip(hid), F.lit("."), F.lit(1)))


def level(hid: Col) -> Column:
    return F.size(F.split(strip(hid), "[.]")) - 1


def parent_id(hid: Col) -> Column:
    return F.when(strip(hid).contains("."), F.regexp_replace(strip(hid), r"\.[^.]*$", ""))


def sort_key(hid: Col) -> Column:
    """array<int>: 5.2 before 5.10; a part that is not a number sorts last."""
    return F.transform(F.split(as_col(hid), "[.]"),
                       lambda p: F.coalesce(F.when(p.rlike(r"^\d+$"), p.try_cast("int")), F.lit(1000000)))


def slug(label: Col, max_len: int = 40) -> Column:
    """Column-name form of a label: no footnotes, brackets, numbering or 'of which'; cut at a word."""
    s = F.lower(as_col(label))
    s = F.regexp_replace(s, r"\b\d+/", " ")
    s = F.regexp_replace(s, r"\([^)]*\)", " ")
    s = F.regexp_replace(s, r"^\s*\d+\.?\s+", "")
    s = F.regexp_replace(s, r"^\s*(?:of which|o/w)\s*:?\s*", "")
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    def shorten(t: Column) -> Column:
        return F.when(F.length(t) <= max_len, t).otherwise(let(F.substring(t, 1, max_len + 1), lambda cut: F.when(
            cut.contains("_"), F.regexp_replace(cut, "_[^_]*$", "")).otherwise(cut)))
    return let(F.regexp_replace(let(s, shorten), "^_+|_+$", ""), lambda t: F.when(t == "", "item").otherwise(t))


def column_name(hid: Col, category: Col, label: Col) -> Column:
    """h5_other_identified_flows for a top item, h5_1_<label slug> below it."""
    hid = as_col(hid)
    name = F.when(hid.contains("."), F.coalesce(slug(label), F.lit("item"))).otherwise(as_col(category))
    return F.concat(F.lit("h"), F.replace(hid, F.lit("."), F.lit("_")), F.lit("_"), name)
