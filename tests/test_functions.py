"""Column functions: names, years, numbers, items, headers, file names."""
from pyspark.sql import functions as F

from panelkit.functions import files, headers, items, names, numbers, text, years


def column(spark, fn, values):
    """fn applied to a column of values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_normalize_entity(spark):
    cases = {
        "The Bahamas": "Bahamas", " Republic of Turkey ": "Türkiye", "Turki̇ye": "Turkiye", "St.Vincent": "St. Vincent",
        "People’s Republic of China – Hong Kong": "Hong Kong SAR, China", "People's Republic of China-Macao": "Macao SAR, China",
        "Kingdom of the Netherlands - Aruba": "Aruba", "Kingdom Of Netherlands-the Netherlands": "Netherlands",
        "Kingdom of the Netherlands—Curaçao and Sint Maarten": "Curaçao and Sint Maarten", "kingdom of the netherlands": "Netherlands",
        "Timor — Leste": "Timor-Leste", "Republic of Poland": "Poland", "COTE D'IVOIRE": "Côte d'Ivoire", "Chad": "Chad",
        "Republic of Korea": "Korea", "democratic republic of são tomé": "São Tomé and Príncipe",
    }
    assert column(spark, names.normalize_entity, list(cases)) == list(cases.values())


def test_keys_and_filters(spark):
    assert column(spark, names.entity_key, ["Swaziland", "Azerbaijan Republic", "Straße"]) == ["eswatini", "azerbaijan", "strasse"]
    assert column(spark, names.loose_key, ["Côte  d’Ivoire", "A – B", "A-B"]) == ["côte d'ivoire", "a-b", "a-b"]
    assert column(spark, names.is_regional, ["Euro Area", "Chad", "X Monetary Union"]) == [True, False, True]
    assert column(spark, names.is_union, ["Euro Area_2020-01-01", "Chad_2020-01-01", "west-african economic and monetary union_2019"]) == [True, False, True]


def test_parse_year_label(spark):
    cases = {
        "2019": ("single", 2019, 2019, ""), "2012/13": ("single", 2013, 2013, "fiscal_year_end_of_2012/13"),
        "FY2012": ("single", 2012, 2012, "fy_label"), "FY 2012-13": ("single", 2013, 2013, "fiscal_year_end_of_FY 2012-13"),
        "2002-2010": ("range", 2002, 2010, "multi_year_range_2002-2010"), "1999/00": ("invalid", None, None, "unparsed_1999/00"),
        "Act. 2015": ("single", 2015, 2015, "extracted_from_text_Act. 2015"), "2015 or 2016": ("invalid", None, None, "unparsed_2015 or 2016"),
        "nan": ("invalid", None, None, "missing"), "  ": ("invalid", None, None, "missing"), None: ("invalid", None, None, "missing"),
        "2013/2012": ("invalid", None, None, "unparsed_2013/2012"), "1999/2000": ("single", 2000, 2000, "fiscal_year_end_of_1999/2000"),
    }
    assert [tuple(r) for r in column(spark, years.parse_year_label, list(cases))] == list(cases.values())


def test_year_for_comparison_and_tokens(spark):
    assert column(spark, years.year_for_comparison, ["2012/13", "FY2013", "2013", "2009-2014", "Avg. 2013", None, "nan"]) == [
        "2013", "2013", "2013", "2009-2014", "avg. 2013", None, None]
    assert column(spark, years.year_token, ["x 2012 and 2013/14", "2010-11", "Est. 2012", "none"]) == ["2013/14", "2010-11", "2012", None]
    assert column(spark, years.leftmost_year_token, ["x 2012 and 2013/14", "2013/14"]) == ["2012", "2013/14"]


def test_two_orders_of_the_effective_year(spark):
    df = spark.createDataFrame([("2015", "2018"), ("", "2018"), (None, " 2018 "), ("2015", None)], "year string, last_actual_year string")
    rows = df.select(years.effective_label(df.columns, True), years.effective_label(df.columns, False)).collect()
    assert [tuple(r) for r in rows] == [("2015", "2018"), ("2018", "2018"), ("2018", "2018"), ("2015", "2015")]


def test_three_number_parsers(spark):
    v = ["1,169.28", " 1.5 ", "−0.3", "–2", "1d", "nan", "1e3", "", None, "n.a.", ".5"]
    assert column(spark, numbers.strict_number, v) == [None, 1.5, None, None, None, None, 1000.0, None, None, None, 0.5]
    assert column(spark, numbers.comma_number, v)[:4] == [1169.28, 1.5, None, None]
    assert column(spark, numbers.any_minus_number, v)[:4] == [1169.28, 1.5, -0.3, -2.0]


def test_same(spark):
    pairs = [("1.50", "1.5", True), ("-0.0", "0.0", True), (None, "", True), (None, "0", False), ("n.a.", "N.A. ", True),
             ("1", "n.a.", False), ("1", "1.0000000001", True), ("1", "1.001", False), ("1,169.28", "1169.28", True)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string, e boolean")
    df = df.withColumn("x", numbers.comparable("a")).withColumn("y", numbers.comparable("b"))
    rows = df.orderBy("i").select(numbers.same(F.col("x"), F.col("y")), "e").collect()
    assert all(r[0] == r[1] for r in rows)


def test_small_text_functions(spark):
    assert column(spark, numbers.int_text, ["65.0", "0.00", "a", "nan", None, "-3.0"]) == ["65", "0", "a", None, None, "-3"]
    assert column(spark, numbers.tri_state, [" true", "FALSE", "x", None]) == [True, False, None, None]
    assert column(spark, text.title_case, ["CÔTE D'IVOIRE", "são tomé", "a-b 3c"]) == ["Côte D'Ivoire", "São Tomé", "A-B 3C"]
    vals = [0.0, 1.5, -2.0, 1234567.0, 0.00001234, 0.0001, 123456.0, 100.0, 0.1 + 0.2, 999999.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double").orderBy("i")
    assert [r[0] for r in df.select(text.general_number_text("v")).collect()] == [f"{v:g}" for v in vals]
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 3)], "a int, b int")
    assert [r[0] for r in df.select(text.percent_text("a", "b")).collect()] == ["33.3%", "n/a", "66.7%"]


def test_items(spark):
    assert column(spark, items.top_category, ["5.1.2", "1", "7", None]) == ["other_identified_flows", "change_in_debt", None, None]
    assert column(spark, items.parent_id, ["5.1.2", "5"]) == ["5.1", None]
    assert column(spark, items.sort_key, ["5.10", "5.2", "5.x"]) == [[5, 10], [5, 2], [5, 1000000]]
    assert column(spark, items.slug, ["12 Of which: Grants (1+2) 3/", "", "Contribution from real exchange rate depreciation and more"]) == [
        "grants", "item", "contribution_from_real_exchange_rate"]
    assert column(spark, items.slug, ["of which: grants", "o/w interest"]) == ["grants", "interest"]


def test_headers(spark):
    assert column(spark, headers.header_status, ["Proj. 2016", "Prel.", "Est 2015", "Actual", "Historical", "2015", "Final outturn", "estimates"]) == [
        "projection", "preliminary", "estimate", "actual", "historical", "unknown", "actual", "unknown"]
    assert column(spark, headers.answer_status, ["year_not_in_table", "column_is_estimate", "other", None]) == [
        "year_not_in_table", "rejected_not_actual", "not_extracted", "not_extracted"]
    assert column(spark, headers.label_category, ["Privatization/Drawdown of Deposits", "Please specify (1) (e.g., drawdown of deposits)", "HIPC relief", None]) == [
        "Privatization", "Other", "Debt relief", "Other"]
    assert column(spark, headers.driver_category, ["Bank recapitalization", None, "MDRI", "misc"]) == [
        "Contingent liab. / bank recap / SOE", "No sub-item reported", "Debt relief / restructuring / arrears", "Other / unspecified"]


def test_files(spark):
    r = column(spark, files.report_file, ["Haiti_2020-04-20_CR2020-123.pdf", "notes.pdf", "X_2020-13-45.pdf"])
    assert (r[0]["entity"], str(r[0]["date"]), r[0]["year"]) == ("Haiti", "2020-04-20", 2020)
    assert r[1] is None and r[2]["date"] is None and r[2]["year"] == 2020
    s = column(spark, files.selected_name, ["Haiti_2020-04-20_CR2020-123_pages_5_8.pdf", "Haiti_2020-04-20_page_6_table_crop_fallback.pdf", "x.pdf"])
    assert tuple(s[0]) == ("Haiti_2020-04-20_CR2020-123", "selected_pdf_direct", 0)
    assert tuple(s[1]) == ("Haiti_2020-04-20", "pymupdf_pillow_table_crop_fallback", 2) and s[2] is None
    df = spark.createDataFrame([(y,) for y in (1995, 1996, 2000, 2001, 2020, 2021, 2026, 2027)], "y int")
    assert [r[0] for r in df.select(years.batch_of_year("y")).collect()] == [
        "Other", "1996-2000", "1996-2000", "2001-2005", "2016-2020", "2021-2026", "2021-2026", "Other"]
