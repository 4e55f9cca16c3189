"""What is in the panel, where it came from, and why the rest is missing."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions import items as I
from panelkit.functions.names import entity_key, normalize_entity
from panelkit.functions.numbers import strict_number
from panelkit.functions.text import Col, as_col, blank_to_null, lookup
from panelkit.functions.years import effective_label, effective_year
from panelkit.operators import pick
from panelkit.operators.measures import set_counts
from panelkit.operators.spread import number_rows, split_join

# --- fixed values ----------------------------------------------------------------------------------
SOURCE_LABELS = {"round1": "Round 1", "round2": "Round 2", "round3": "Round 3", "gapfill": "Gap fill"}
SOURCE_CODES = {"Round 1": "1", "Round 2": "2", "Round 3": "3", "Gap fill": "g"}
REASONS = ["not_gap_candidate", "report_exists_field_missing", "unresolved", "unresolved_no_candidate_reports",
           "pending_api_error", "gapfill_resolved_but_field_missing"]
STATUS_RANK = {"resolved": 0, "resolved_with_warning": 0, "unresolved": 1, "pending_api_error": 2,
               "unresolved_no_candidate_reports": 3}
# ---------------------------------------------------------------------------------------------------
PRIORITY = list(SOURCE_LABELS)


def load_values(rows: DataFrame, ids: list[str] | None = None, keep: list[str] = ()) -> DataFrame:
    """Rows with a usable year and a strict number: + effective_year, value_num, country_key, country_label.

    Year first, then last_actual_year; a range stands for its end year. The label is the most common spelling.
    """
    wanted = ["country", "hierarchy_id", "value", "year", "last_actual_year", "source_round", "gapfill_run", *keep]
    df = rows.select(*[c for c in dict.fromkeys(wanted) if c in rows.columns])
    for c in ("source_round", "gapfill_run"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    if ids is not None:
        df = df.filter(F.col("hierarchy_id").isin(list(ids)))
    # year and number are bound to a row before it is filtered by them: a filter on the columns would be pushed down to where they come
    # from, with a copy of the label's making for each mention of it, and plans of megabytes are kept and sent by the driver
    read = F.struct(effective_year("__label").alias("effective_year"), strict_number("value").alias("value_num"))
    df = df.withColumn("__label", effective_label(df.columns)).select(*df.columns, F.explode(F.array(read)).alias("__read")).select(*df.columns, "__read.*")
    df = df.filter("effective_year is not null and value_num is not null")
    # names are normalised once per spelling, not once per row
    spellings = df.groupBy("country").agg(F.count("*").alias("__n")).withColumn("__norm", normalize_entity("country")) \
        .withColumn("country_key", F.lower("__norm"))
    labels = spellings.groupBy("country_key", "__norm").agg(F.sum("__n").alias("__n")).groupBy("country_key").agg(
        F.min_by("__norm", F.struct(-F.col("__n"), F.col("__norm"))).alias("country_label"))
    names = spellings.select("country", "country_key").join(labels, "country_key")
    return split_join(df, names, ["country"]).drop("year", "last_actual_year")


def universe(rows: DataFrame, key=entity_key) -> DataFrame:
    """Every entity of the file, also one without any usable value."""
    return rows.filter("country is not null").select("country").distinct().select(key("country").alias("country_key")).distinct()


def year_grid(entities: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Entity x year, by exploding the year range of every entity."""
    return entities.withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))


def indicators(rows: DataFrame) -> DataFrame:
    """One row per hierarchy_id: column name, level, category, three most common labels, row count."""
    r = rows.filter("hierarchy_id is not null")
    level = pick.most_common(r.withColumn("lv", F.col("level").try_cast("double").cast("int")), ["hierarchy_id"], "lv", "level")
    top = pick.most_common(r, ["hierarchy_id"], "top_category")
    label = pick.most_common(r, ["hierarchy_id"], "label_verbatim", "__label")
    three = pick.most_common_n(r, ["hierarchy_id"], "label_verbatim", 3, "most_common_labels")
    n = r.groupBy("hierarchy_id").agg(F.count("*").alias("n_rows"))
    out = n.join(top, "hierarchy_id", "left").join(level, "hierarchy_id", "left").join(label, "hierarchy_id", "left") \
        .join(three, "hierarchy_id", "left")
    return out.select(I.column_name("hierarchy_id", "top_category", "__label").alias("column"), "hierarchy_id", "level",
                      "top_category", "most_common_labels", "n_rows")


def pick_indicators(dictionary: list[tuple[str, str]], wanted: str | list[str]) -> list[str]:
    """Column names for loosely written indicator names (the dictionary is the small, collected one)."""
    columns = [c for c, _ in dictionary]
    short = {"h" + hid.replace(".", "_"): c for c, hid in dictionary}
    names = [wanted] if isinstance(wanted, str) else wanted
    keys = {n: "_".join(n.strip().lower().replace("-", " ").split()) for n in names}
    got = {n: k if k in columns else short.get(k) for n, k in keys.items()}
    unknown = [n for n, c in got.items() if c is None]
    if unknown:
        raise ValueError(f"indicators not found: {unknown}. Available columns: {', '.join(columns)}")
    return list(dict.fromkeys(got.values()))


def value_sources(values: DataFrame) -> DataFrame:
    """(hierarchy_id, country_key, year, source): label of the best source per item and country-year."""
    best = values.groupBy("hierarchy_id", "country_key", F.col("effective_year").alias("year")).agg(
        F.min_by("source_round", F.struct(pick.priority_rank("source_round", PRIORITY), F.col("source_round"))).alias("s"))
    return best.select("hierarchy_id", "country_key", "year", F.coalesce(lookup(SOURCE_LABELS, F.col("s")), F.col("s")).alias("source"))


@dataclass(frozen=True)
class CoverageMap:
    """One row per entity and year of a calendar: `flags` (bits IN_FILE, REPORT, TABLE) and the words `w0`, `w1`, ... that hold,
    for every item, one bit per source that has a value, best source lowest, and one for all sources that are not listed."""
    rows: DataFrame
    items: tuple[str, ...]
    sources: tuple[str, ...]

    def field(self, item: str) -> Column:
        """The source bits of an item; 0 without a value."""
        width, per = _field_layout(self.sources)
        at = self.items.index(item)
        return F.shiftright(F.col(f"w{at // per}"), width * (at % per)).bitwiseAND(F.lit((1 << width) - 1))

    def flag(self, bit: int) -> Column:
        return F.col("flags").bitwiseAND(F.lit(bit)) != 0


IN_FILE, REPORT, TABLE = 1, 2, 4


def _field_layout(sources: tuple[str, ...]) -> tuple[int, int]:
    """(bits of an item, items of a word)."""
    width = len(sources) + 1
    return width, 62 // width


def coverage_map(rows: DataFrame, first: int, last: int, report_years: DataFrame, items: list[str], table_year: Column | None = None,
                 sources: list[str] = PRIORITY, key=entity_key) -> CoverageMap:
    """Coverage of every entity of the file in every year, as bits.

    Line items meet once, as bits of their report's label, before they leave their task; labels and names are read after that,
    once per report; the calendar of an entity is one row of at most last - first + 1 entries, so that no grid is joined.
    report_years: (country_key, year) with a report; table_year: the year that a row's report has a table for (null: none).
    """
    items, sources = tuple(dict.fromkeys(items)), tuple(sources)
    width, per = _field_layout(sources)
    words = [f"w{i}" for i in range(max(1, -(-len(items) // per)))]
    place = F.array_position(F.array(*[F.lit(i) for i in items]).cast("array<string>"), F.col("hierarchy_id")).cast("int") - 1
    has = (F.col("__at") >= 0) & strict_number("value").isNotNull()
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__at") % per * width + pick.priority_rank("source_round", list(sources)))
    r = rows.filter("country is not null").select("country", effective_label(rows.columns).alias("__label"), "value", "source_round", place.alias("__at"),
                                                  (F.lit(None) if table_year is None else table_year).cast("int").alias("__table"))
    of_reports = r.withColumn("__bit", F.when(has, bit)).groupBy("country", "__label", "__table").agg(
        *[F.bit_or(F.when(F.floor(F.col("__at") / per) == i, F.col("__bit"))).alias(w) for i, w in enumerate(words)])

    def entry(year: Column, flags: int, *bits: Column) -> Column:
        return F.struct(year.cast("int").alias("year"), F.lit(flags).alias("flags"), *[b.alias(w) for b, w in zip(bits, words, strict=True)])
    none = [F.lit(None).cast("long")] * len(words)
    seen = of_reports.select(key("country").alias("country_key"), F.inline(F.array(
        entry(effective_year("__label"), IN_FILE, *map(F.col, words)), entry(F.when(F.col("__table").isNotNull(), F.col("__table")), IN_FILE | TABLE, *none))))
    # a report without a table year has told of itself by its first entry
    seen = seen.filter((F.col("flags") == IN_FILE) | F.col("year").isNotNull())
    reported = report_years.select("country_key", F.inline(F.array(entry(F.col("year"), REPORT, *none))))
    years = seen.unionByName(reported).groupBy("country_key", "year").agg(F.bit_or("flags").alias("flags"), *[F.bit_or(w).alias(w) for w in words])
    cell = F.struct("flags", *words)
    entities = years.groupBy("country_key").agg(F.bit_or("flags").alias("__all"), F.collect_list(F.when(
        F.col("year").between(first, last), F.struct("year", cell.alias("cell")))).alias("__cells"))
    grid = entities.filter(F.col("__all").bitwiseAND(F.lit(IN_FILE)) != 0).select(
        "country_key", F.map_from_entries("__cells").alias("__map"), F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    got = F.try_element_at("__map", F.col("year"))
    return CoverageMap(grid.select("country_key", "year", *[F.coalesce(got[c], F.lit(0)).alias(c) for c in ("flags", *words)]), items, sources)


def coverage_wide(cover: CoverageMap, columns: list[tuple[str, str]]) -> DataFrame:
    """Yes/No for a report, a table and every (column name, hierarchy_id)."""
    def shown(c: Column) -> Column:
        return F.when(c, "Yes").otherwise("No")
    return cover.rows.select("country_key", "year", shown(cover.flag(REPORT)).alias("has_staff_report"), shown(cover.flag(TABLE)).alias("has_dsa_table"),
                             *[shown(cover.field(h) != 0).alias(c) for c, h in columns])


def sources_wide(cover: CoverageMap, columns: list[tuple[str, str]], labels: dict[str, str] = SOURCE_LABELS) -> DataFrame:
    """The label of the best source instead of Yes/No; blank without a value, "Other" for a source that is not listed."""
    names = [labels.get(s, s) for s in cover.sources] + ["Other"]

    def best(f: Column) -> Column:
        # the lowest bit set is the best source
        return F.coalesce(*[F.when(f.bitwiseAND(F.lit(1 << i)) != 0, n) for i, n in enumerate(names)], F.lit(""))
    return cover.rows.select("country_key", "year", *[best(cover.field(h)).alias(c) for c, h in columns])


def item_totals(cover: CoverageMap, columns: list[tuple[str, str]]) -> DataFrame:
    """(column, hierarchy_id, country_years_with_value, by source best first) of the listed items, from one aggregate."""
    n = F.count_if
    totals = [F.struct(F.lit(c).alias("column"), F.lit(h).alias("hierarchy_id"), n(cover.field(h) != 0).alias("country_years_with_value"),
                       *[n(cover.field(h).bitwiseAND(F.lit((2 << i) - 1)) == 1 << i).alias(f"n_{s}") for i, s in enumerate(cover.sources)]) for c, h in columns]
    return cover.rows.agg(F.array(*totals).alias("t")).select(F.inline("t"))


def yes_by_year(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Per year: entities in the panel and how many have Yes in each column."""
    return wide.groupBy("year").agg(F.count("*").alias("n_entities"), *[F.count_if(F.col(c) == "Yes").alias(f"n_{c}") for c in columns])


def compact_strings(wide: DataFrame, columns: list[str], codes: dict[str, str], entity: str = "country_key") -> DataFrame:
    """One string per entity and column: a character per year in year order (bounded by the calendar)."""
    def code(c: str) -> Column:
        return F.coalesce(lookup(codes, F.col(c)), F.lit("0"))
    return wide.groupBy(entity).agg(*[
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("year").alias("y"), code(c).alias("c")))),
                                 lambda s: s["c"]), "").alias(c) for c in columns])


def reports_per_year(reports: DataFrame, entity: str = "country_key", year: str = "year") -> DataFrame:
    """Reports and distinct entities per publication year (entities counted after grouping per entity)."""
    per = reports.groupBy(year, entity).agg(F.count("*").alias("n"))
    return per.groupBy(year).agg(F.sum("n").alias("n_reports"), F.count(entity).alias("n_entities"))


def year_table(reports: DataFrame, values: DataFrame, all_years: bool = True) -> DataFrame:
    """Per year: reports, entities with reports, entities with data (full outer, or the report years only)."""
    rep = reports_per_year(reports)
    data = values.select(F.col("effective_year").alias("year"), "country_key").distinct().groupBy("year").agg(F.count("*").alias("n_with_data"))
    return rep.join(data, "year", "full" if all_years else "left").select(
        "year", F.coalesce("n_reports", F.lit(0)).alias("n_reports"), F.coalesce("n_entities", F.lit(0)).alias("n_entities"), "n_with_data")


# ---- duplicates and conflicts --------------------------------------------------------------------------

def coverage_by_year(values: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Per item and year: rows, entities, entities with several rows, entities whose rows conflict."""
    per = values.groupBy("hierarchy_id", "effective_year", "country_key").agg(
        F.count("*").alias("n"), (F.max("value_num") - F.min("value_num")).alias("d"))
    return per.groupBy("hierarchy_id", F.col("effective_year").alias("year")).agg(
        F.count("*").alias("n_countries_available"), F.sum("n").alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("n_countries_with_duplicate_rows"),
        F.count_if((F.col("n") > 1) & (F.col("d") > tolerance)).alias("n_countries_with_conflicting_values"))


def duplicate_detail(values: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Every row of a country-year that has several rows, with its place among them and the conflict flag.

    Long form of the value list: the list of one key has no bound, a row per value has no such limit.
    """
    keys = ["hierarchy_id", "effective_year", "country_key"]
    dup = pick.per_key_duplicates(values, keys, "value_num", tolerance)
    tag = F.when((F.col("source_round") == "gapfill") & F.col("gapfill_run").isNotNull(), F.concat(F.lit("gapfill_"), F.col("gapfill_run"))) \
        .otherwise(F.coalesce("source_round", F.lit("")))
    return split_join(values, dup.select(*keys, "n_rows", "conflicting"), keys).select(*keys, "country_label", "value_num", tag.alias("source"), "n_rows", "conflicting")


# ---- availability ---------------------------------------------------------------------------------------

def observed_reports(rows: DataFrame) -> DataFrame:
    """(country_key, year) with a report of rounds 1 to 3, whatever was read from it."""
    # a missing source is not gap fill
    return (rows.filter(~F.col("source_round").eqNullSafe(F.lit("gapfill"))).select("country", "last_actual_year").distinct()
            .select(F.lower(normalize_entity("country")).alias("country_key"),
                    effective_year(F.coalesce(blank_to_null("last_actual_year"), F.lit(""))).alias("year"))
            .filter("year is not null").distinct())


def best_targets(resolution: DataFrame, runs: list[str]) -> DataFrame:
    """One row per (country_key, year) listed by several runs: most informative status, then oldest run."""
    r = resolution.withColumn("country_key", F.lower(normalize_entity("country"))).withColumn("year", F.col("gap_year").cast("int"))
    rank = F.coalesce(lookup({k: str(v) for k, v in STATUS_RANK.items()}, F.col("final_status")).cast("int"), F.lit(len(STATUS_RANK)))
    extra = [c for c in ("gap_id", "n_attempts", "last_failure_status", "last_failure_detail") if c in r.columns]
    r = r.select("country_key", "year", "final_status", "gapfill_run", *extra, rank.alias("__r"))
    return pick.smallest(r, ["country_key", "year"], [F.col("__r"), pick.priority_rank("gapfill_run", runs),
                                                      F.col("final_status"), *[F.col(c) for c in extra[:1]]]).drop("__r")


def availability(grid: DataFrame, values: DataFrame, observed: DataFrame, targets: DataFrame) -> DataFrame:
    """Grid + source_tag of the available cells, reason of the others, and the run that targeted them."""
    keys = ["country_key", "year"]
    src = pick.source_by_run(values.withColumn("year", F.col("effective_year")), keys)
    obs = observed.select(*keys).distinct().withColumn("__o", F.lit(True))
    j = grid.join(src, keys, "left").join(obs, keys, "left").join(targets, keys, "left")
    reason = (F.when(F.col("final_status").isNull(), F.when(F.col("__o"), "report_exists_field_missing").otherwise("not_gap_candidate"))
              .when(F.col("final_status").isin("resolved", "resolved_with_warning"), "gapfill_resolved_but_field_missing")
              .otherwise(F.col("final_status")))
    return j.withColumn("reason", F.when(F.col("source_tag").isNull(), reason)).drop("__o")


def availability_by_year(cells: DataFrame, runs: list[str] = ()) -> DataFrame:
    """Per year: available by source (gap fill by run), unavailable by reason. `other` holds any reason outside
    the six, so the reasons always add up."""
    tag, why = F.col("source_tag"), F.col("reason")
    gap = F.coalesce(tag.startswith("gapfill"), F.lit(False))
    return cells.groupBy("year").agg(
        F.count("*").alias("total_countries"), F.count(tag).alias("n_available"), F.count(why).alias("n_unavailable"),
        *[F.count_if(tag == r).alias(f"n_{r}") for r in ("round1", "round2", "round3")], F.count_if(gap).alias("n_gapfill"),
        *[F.count_if(tag == f"gapfill:{r}").alias(f"n_gapfill_run_{r}") for r in runs],
        *[F.count_if(why == r).alias(f"n_unavail_{r}") for r in REASONS],
        F.count_if(why.isNotNull() & ~why.isin(REASONS)).alias("n_unavail_other"),
        *[F.count_if(why.isNotNull() & (F.col("gapfill_run") == r)).alias(f"n_unavail_gap_target_run_{r}") for r in runs])


def source_table(cells: DataFrame) -> DataFrame:
    """The availability counts reduced to the source columns."""
    return availability_by_year(cells).select("year", "total_countries", "n_round1", "n_round2", "n_round3", "n_gapfill", "n_unavailable")


def unavailable(cells: DataFrame) -> DataFrame:
    """One row per unavailable cell with its reason and, when there is one, the gap-fill target behind it."""
    return cells.filter("source_tag is null").drop("source_tag", "final_status")


def no_later_report(cells: DataFrame, report_years: DataFrame, k: int) -> DataFrame:
    """Unavailable cells (country_key, year) with `later`: does a report of the next k years exist?"""
    keys = ["country_key", "year"]
    due = (cells.filter("source_tag is null").select(*keys)
           .withColumn("pub_year", F.explode(F.sequence(F.col("year") + 1, F.col("year") + k))))
    pub = report_years.select("country_key", F.col("year").alias("pub_year")).distinct()
    later = due.join(pub, ["country_key", "pub_year"], "left_semi").select(*keys).distinct().withColumn("__l", F.lit(True))
    return cells.filter("source_tag is null").select(*keys).join(later, keys, "left") \
        .select(*keys, F.coalesce("__l", F.lit(False)).alias("later"))


def later_report_by_year(cells: DataFrame, report_years: DataFrame, k: int) -> DataFrame:
    """Per year: unavailable, with and without a report in T+1..T+k; partial when T+k lies past the last report."""
    last = report_years.agg(F.max("year").alias("y")).scalar()
    return no_later_report(cells, report_years, k).groupBy("year").agg(
        F.count("*").alias("n_unavailable"), F.count_if("later").alias("n_later"), F.count_if(~F.col("later")).alias("n_no_later")) \
        .withColumn("partial", F.col("year") + k > last)


# ---- panel statistics and browsing ------------------------------------------------------------------------

def panel_stats(rows: DataFrame, year: str = "year") -> DataFrame:
    """(measure, item, n): rows, reports, entities, country-years, rows by source and by origin; the panel is read once."""
    from panelkit.functions.names import report_entity
    origin = ["update_origin"] if "update_origin" in rows.columns else []
    r = rows.select("json_file", report_entity("pdf_file_name", "country").alias("entity"), F.coalesce(year, F.lit("")).alias("year"),
                    *[F.coalesce(c, F.lit("")).alias(c) for c in ("source_round", *origin)])
    n, one = F.col("n"), F.lit(1)
    sets = {(): [("rows", None, n)], ("json_file",): [("reports", None, F.when(F.col("json_file").isNotNull(), one))],
            ("entity",): [("countries", None, F.when(F.col("entity").isNotNull(), one))], ("entity", "year"): [("country_years", None, one)],
            ("source_round",): [("source", F.col("source_round"), n)]}
    if origin:
        sets["update_origin",] = [("origin", F.col("update_origin"), n)]
    return set_counts(r, sets)


def source_by_year(rows: DataFrame, year: str = "year", ties: list[Column] = ()) -> DataFrame:
    """Country-years by year and source, one source per country-year (the first row in `ties` order wins)."""
    from panelkit.functions.names import report_entity
    r = rows.filter(F.col(year).rlike(r"^\d{4}$")).select(
        report_entity("pdf_file_name", "country").alias("c"), F.col(year).alias("y"),
        F.struct(*(ties or [F.col("json_file")])).alias("o"), "source_round")
    first = r.groupBy("c", "y").agg(F.min_by("source_round", "o").alias("source_round"))
    return first.groupBy(F.col("y").alias("year"), "source_round").agg(F.count("*").alias("n"))


def panel_subset(rows: DataFrame, country: str | None = None, year: str | None = None, source: str | None = None,
                 origin: str | None = None, top_only: bool = False, item: str | None = None) -> DataFrame:
    """The rows of the panel that a reader asks for."""
    out = rows
    if country:
        out = out.filter(F.lower(F.coalesce("country", F.lit(""))).contains(country.strip().lower()))
    if year:
        out = out.filter(F.col("year" if "year" in rows.columns else "last_actual_year") == year)
    if source:
        out = out.filter(F.col("source_round") == source)
    if origin:
        out = out.filter(F.coalesce("update_origin", F.lit("")) == ("" if origin == "none" else origin))
    if top_only:
        out = out.filter(~F.coalesce("hierarchy_id", F.lit("")).contains("."))
    if item:
        out = out.filter(F.col("hierarchy_id") == item)
    return out


def browse_panel(rows: DataFrame, order: list[str], page: int = 0, size: int = 100, after: tuple | None = None, **wanted) -> DataFrame:
    """Rows of `panel_subset`, one page of them in a stable order: by its number, or, for readers who turn pages one by one,
    the rows `after` the last key (values of `order`) they have seen, which sorts and skips nothing before it."""
    out = panel_subset(rows, **wanted)
    if after is None:
        return out.orderBy(*order).offset(page * size).limit(size)
    key = F.struct(*order)
    last = F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(order, after, strict=True)])
    if after[0] is not None:
        out = out.filter(F.col(order[0]) >= F.lit(after[0]))           # this part reaches the scan
    return out.filter(key > last).orderBy(*order).limit(size)


def write_positions(rows: DataFrame, order: list[str], path: str) -> None:
    """The rows with their `position` from 1 in the given order, written in that order: any page of them is a range of
    positions, of which file statistics name the few row groups."""
    numbered = number_rows(rows, order)
    numbered.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").parquet(path)


def page_at(positions: DataFrame, page: int, size: int = 100) -> DataFrame:
    """Page number `page` (from 0) of a table written by `write_positions`; any page costs the same."""
    return positions.filter((F.col("position") > page * size) & (F.col("position") <= (page + 1) * size)).orderBy("position")


def browse_coverage(wide: DataFrame, country: str | None = None, year: int | None = None, only_reported: bool = False) -> DataFrame:
    """Coverage rows by name part and year; optionally only entities that ever had a report."""
    out = wide
    if only_reported:
        ever = wide.filter("has_staff_report = 'Yes'").select("country_key").distinct()
        out = out.join(ever, "country_key", "left_semi")
    if year is not None:
        out = out.filter(F.col("year") == year)
    return out.filter(F.col("country_key").contains(country.strip().lower())) if country else out


def overview(parts: dict[str, DataFrame], review: DataFrame | None = None, review_source: str = "round3") -> DataFrame:
    """(source, rows, reports, reviewed, total) of the rows that are ready, one row per part.

    With `review` (the queue of reports a person looks at, by status) its part says how many are done of how many; rows and
    reports of a part that has none are 0.
    """
    tagged = [df.select(F.lit(name).alias("source"), "json_file", F.lit(None).cast("string").alias("status"), F.lit(True).alias("ready")) for name, df in parts.items()]
    if review is not None:
        tagged.append(review.select(F.lit(review_source).alias("source"), F.lit(None).cast("string").alias("json_file"), F.col("status"), F.lit(False).alias("ready")))
    rows = reduce(DataFrame.unionByName, tagged)
    # one row per report first: the lines of a report meet in their tasks
    per = rows.groupBy("source", "json_file").agg(F.count_if("ready").alias("rows"), F.count_if(~F.col("ready")).alias("total"),
                                                  F.count_if(~F.col("ready") & (F.col("status") != "todo")).alias("reviewed"))
    names = rows.sparkSession.createDataFrame([(n, None, 0, 0, 0) for n in dict.fromkeys([*parts, *([review_source] if review is not None else [])])], per.schema)
    waits = F.col("source") == review_source if review is not None else F.lit(False)
    return per.unionByName(names).groupBy("source").agg(
        F.sum("rows").alias("rows"), F.count_if((F.col("rows") > 0) & F.col("json_file").isNotNull()).alias("reports"),
        F.sum("reviewed").alias("reviewed"), F.sum("total").alias("total")) \
        .withColumns({c: F.when(waits, F.col(c)) for c in ("reviewed", "total")})
