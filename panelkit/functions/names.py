"""One spelling per entity name."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.text import Col, as_col, found, label_key, let, lookup, squeeze, strip

# --- fixed values: official or older names -> the name used in the panel ---------------------------
ALIASES = {
    "cote d'ivoire": "Côte d'Ivoire",
    "côte d'ivoire": "Côte d'Ivoire",
    "democratic republic of sao tome and principe": "São Tomé and Príncipe",
    "democratic republic of são tomé and príncipe": "São Tomé and Príncipe",
    "democratic republic of são tomé": "São Tomé and Príncipe",
    "democratic republic of sao tome": "São Tomé and Príncipe",
    "democratic republic of timor-leste": "Timor-Leste",
    "republic of timor-leste": "Timor-Leste",
    "democratic republic of the congo": "Democratic Republic of the Congo",
    "republic of congo": "Republic of Congo",
    "islamic republic of afghanistan": "Afghanistan",
    "islamic republic of iran": "Iran",
    "islamic republic of mauritania": "Mauritania",
    "kingdom of eswatini": "Eswatini",
    "kingdom of swaziland": "Eswatini",
    "kingdom of lesotho": "Lesotho",
    "lao people's democratic republic": "Lao PDR",
    "people's republic of china": "China",
    "former yugoslav republic of macedonia": "North Macedonia",
    "republic of north macedonia": "North Macedonia",
    "republic of the marshall islands": "Marshall Islands",
    "union of comoros": "Comoros",
    "union of the comoros": "Comoros",
    "united republic of tanzania": "Tanzania",
    "republic of tanzania": "Tanzania",
    "federated states of micronesia": "Micronesia",
    "arab republic of egypt": "Egypt",
    "federal democratic republic of ethiopia": "Ethiopia",
    "brunei darussalam": "Brunei",
    "republic of korea": "Korea",
    "cape verde": "Cabo Verde",
    "turkey": "Türkiye",
    "democratic republic of congo": "Democratic Republic of the Congo",
    "principality of andorra": "Andorra",
    "principality of liechtenstein": "Liechtenstein",
}
KEY_ALIASES = {
    "azerbaijan republic": "azerbaijan",
    "islamic state of afghanistan": "afghanistan",
    "socialist people's libyan arab jamahiriya": "libya",
    "swaziland": "eswatini",
    "federal republic of yugoslavia": "serbia and montenegro",
    "hong kong special administrative region": "hong kong sar, china",
    "macao special administrative region": "macao sar, china",
}
REGIONAL = (r"(?i)cluster|multi-country|central and eastern europe|euro area|"
            r"monetary (?:community|union)|currency union")
UNIONS = ["Euro Area", "Central African Economic and Monetary Community",
          "Eastern Caribbean Currency Union", "West African Economic and Monetary Union"]
# ---------------------------------------------------------------------------------------------------
# names that no rule but the table concerns: words of letters and digits, none of the titles below in front
PLAIN = r"^(?!(?i:the|republic|kingdom|people) )[A-Za-z0-9]+(?: [A-Za-z0-9]+)*\z"


def normalize_entity(c: Col, aliases: dict[str, str] | None = None) -> Column:
    table = ALIASES if aliases is None else aliases
    c = as_col(c)
    s = F.translate(strip(c), "’İ̇", "'I")
    s = F.regexp_replace(s, r"\bSt\.(?=\S)", "St. ")
    s = F.regexp_replace(F.regexp_replace(s, "[–—]+", "-"), r"\s*-\s*", "-")
    s = F.regexp_replace(s, r"(?i)^the\s+", "")

    def named(n: Column) -> Column:
        low = n["low"]
        of_china = low.startswith("people's republic of china-") & (F.length(low) > 27)
        crown = low.startswith("kingdom of ") & low.contains("netherland")
        part = F.regexp_replace(found(low, r"^kingdom of (?:the )?netherlands?-(.+)$", 1), r"^the\s+", "")
        return (
            F.when(of_china, F.when(low.contains("hong kong"), "Hong Kong SAR, China").otherwise("Macao SAR, China"))
            .when(crown & low.rlike(r"^kingdom of (?:the )?netherlands?$"), "Netherlands")
            .when(crown & low.rlike(r"^kingdom of (?:the )?netherlands?-."), let(part, lambda p: F.when(p == "netherlands", "Netherlands")
                  .when(p == "aruba", "Aruba").otherwise("Curaçao and Sint Maarten")))
            .otherwise(F.coalesce(lookup(table, low), F.when(low.startswith("republic of "), let(
                F.trim(F.substring(n["s"], 13, 2147483647)), lambda r: F.when(r != "", F.coalesce(lookup(table, F.lower(r)), r)))), n["s"])))
    return F.when(c.rlike(PLAIN), F.coalesce(lookup(table, F.lower(c)), c)).otherwise(
        let(s, lambda t: let(F.struct(t.alias("s"), F.lower(t).alias("low")), named)))


def entity_key(c: Col) -> Column:
    """Case-insensitive key of the normalised name, with the extra aliases."""
    key = F.replace(F.lower(normalize_entity(c)), F.lit("ß"), F.lit("ss"))
    return let(key, lambda k: F.coalesce(lookup(KEY_ALIASES, k), k))


def loose_key(c: Col) -> Column:
    """Key for matching names against a lookup table: case, dashes and spacing do not matter."""
    s = F.translate(strip(c), "’–—", "'--")
    return F.lower(F.replace(squeeze(s), F.lit(" - "), F.lit("-")))


def report_entity(file_name: Col, fallback: Col) -> Column:
    """Entity of a report: prefix of its file name, else the entity column; normalised."""
    return normalize_entity(F.coalesce(found(file_name, r"^(.*?)_\d{4}-\d{2}-\d{2}", 1), as_col(fallback)))


def is_regional(c: Col) -> Column:
    return as_col(c).rlike(REGIONAL)


def is_union(stem: Col, unions: list[str] | None = None) -> Column:
    """The report belongs to a union of countries (prefix match on the label key)."""
    prefixes = F.array(*[label_key(F.lit(name)) for name in (unions or UNIONS)])
    return let(label_key(stem), lambda key: F.exists(prefixes, lambda p: F.startswith(key, p)))


def split_reports(reports: DataFrame, entities: DataFrame, raw: str = "entity_raw", key: str = "entity_key") -> DataFrame:
    """Adds `kept_as`: regional, outside_panel or kept (one left join with the distinct entity keys)."""
    known = entities.select(key).distinct().withColumn("in_panel", F.lit(True))
    return (reports.join(known, key, "left")
            .withColumn("kept_as", F.when(is_regional(raw), "regional")
                        .when(F.col("in_panel").isNull(), "outside_panel").otherwise("kept"))
            .drop("in_panel"))
