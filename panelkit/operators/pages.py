"""Rank pages of documents by phrases, and choose the pages worth reading.

Input is a table (doc, page_no, text) with pages numbered from 1. Pages are scored row by row; only short
score rows are shuffled, never the text of pages that are not chosen.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.functions.text import Col, as_col, let
from panelkit.operators import pick
from panelkit.operators.spread import running_sum, split_join

# --- fixed values: phrases of the default ranking ---------------------------------------------------
PHRASE_WEIGHTS = {
    "public sector debt sustainability framework": 18,
    "public dsa - baseline scenario": 18,
    "sovereign risk and debt sustainability framework": 18,
    "contribution to change in public debt": 16,
    "contribution to changes in public debt": 16,
    "contributions to changes in public debt": 16,
    "contribution of identified flows": 12,
    "identified debt-creating flows": 12,
    "other identified debt-creating flows": 10,
    "automatic debt dynamics": 10,
    "drivers of debt dynamics": 9,
    "change in gross public sector debt": 9,
    "change in public sector debt": 9,
    "change in gross public debt": 9,
    "change in public debt": 8,
    "baseline scenario": 5,
    "public debt": 3,
    "residual": 2,
}
TITLE_PHRASES = [
    "public sector debt sustainability framework", "public dsa - baseline scenario",
    "sovereign risk and debt sustainability framework", "contribution to change in public debt",
    "contribution to changes in public debt", "contributions to changes in public debt",
]
ROW_PHRASES = ["identified debt-creating flows", "contribution of identified flows", "automatic debt dynamics",
               "other identified debt-creating flows", "residual"]
CONTEXT_PHRASES = [
    "debt sustainability", "public dsa", "baseline scenario", "contribution to change in public debt",
    "contributions to changes in public debt", "change in public debt", "identified debt-creating flows",
    "automatic debt dynamics", "public sector debt sustainability framework", "drivers of debt dynamics",
]
MIN_SCORE, TITLE_BONUS, ROW_BONUS = 18, 12, 10
# ----------------------------------------------------------------------------------------------------
NUMBER = r"(?<!\d)-?\d+(?:\.\d+)?"


def _lower(text: Col) -> Column:
    return F.lower(F.regexp_replace(as_col(text), r"\s+", " "))


def _hits(low: Column, phrases: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.contains(low, F.lit(p)).cast("int") for p in phrases], F.lit(0))


def matched_phrases(low: Column, phrases: list[str]) -> Column:
    """The phrases found in a lower-case text."""
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(p)), F.lit(p)) for p in phrases]))


def phrase_score(low: Column, weights: dict[str, int] = PHRASE_WEIGHTS, title: list[str] = TITLE_PHRASES,
                 rows: list[str] = ROW_PHRASES) -> Column:
    """Sum of the weights of the phrases in a lower-case text + title bonus + bonus for two row phrases."""
    base = reduce(lambda a, b: a + b, [F.when(F.contains(low, F.lit(p)), w).otherwise(0) for p, w in weights.items()])
    return (base + F.when(_hits(low, title) > 0, TITLE_BONUS).otherwise(0) + F.when(_hits(low, rows) >= 2, ROW_BONUS).otherwise(0))


def looks_like_image(text: Col, least: int = 12) -> Column:
    """Fewer than `least` numbers in the page text."""
    return F.regexp_count(as_col(text), F.lit(NUMBER)) < least


def page_counts(pages: DataFrame, doc: str) -> DataFrame:
    return pages.groupBy(doc).agg(F.max("page_no").alias("n_pages"))


def _top(scored: DataFrame, doc: str, order: list[Column], n: int) -> DataFrame:
    """Best n rows per document; the limit is applied in every task before rows are exchanged."""
    w = Window.partitionBy(doc).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def keyword_pages(pages: DataFrame, doc: str, weights=PHRASE_WEIGHTS, title=TITLE_PHRASES, rows=ROW_PHRASES,
                  min_score: int = MIN_SCORE, top: int = 5, around: int = 2) -> DataFrame:
    """Top pages per document (score desc, page asc) with the page range around each, clipped to the document."""
    # the lower-case text is bound once for all phrase tests; the other facts are worked out for hits only
    score = let(_lower("text"), lambda low: phrase_score(low, weights, title, rows))
    s = pages.select(doc, "page_no", "text", score.alias("score")).filter(F.col("score") >= min_score)
    facts = let(_lower("text"), lambda low: F.struct(matched_phrases(low, list(weights)).alias("matched_phrases"),
                                                     (_hits(low, rows) > 0).alias("has_row_phrase")))
    s = s.select(doc, "page_no", "score", looks_like_image("text").alias("likely_image_based"), facts.alias("__f")) \
        .select(doc, "page_no", "score", "likely_image_based", "__f.*")
    best = _top(s, doc, [F.desc("score"), F.asc("page_no")], top)
    return best.join(page_counts(pages, doc), doc).select(
        doc, "rank", "page_no", "score", F.greatest(F.lit(1), F.col("page_no") - around).alias("start_page"),
        F.least("n_pages", F.col("page_no") + around).alias("end_page"), "likely_image_based", "matched_phrases", "has_row_phrase")


def keyword_pages_by_count(pages: DataFrame, doc: str, phrases: list[str], bonus_phrase: str, top: int = 5) -> DataFrame:
    """Older ranking: number of phrases, + 5 for one of them; later pages win ties; ranges from -1 to +4."""
    facts = let(F.lower("text"), lambda low: F.struct(
        _hits(low, phrases).alias("n"), F.when(F.contains(low, F.lit(bonus_phrase)), 5).otherwise(0).alias("bonus")))
    s = pages.select(doc, "page_no", facts.alias("f")).select(doc, "page_no", "f.n", (F.col("f.n") + F.col("f.bonus")).alias("score"))
    best = _top(s.filter("n > 0"), doc, [F.desc("score"), F.desc("page_no")], top)
    return best.select(doc, "rank", "page_no", "score", F.greatest(F.lit(1), F.col("page_no") - 1).alias("start_page"),
                       (F.col("page_no") + 4).alias("end_page"))


def context_pages(pages: DataFrame, doc: str, phrases: list[str] = CONTEXT_PHRASES, first: int = 10, last: int = 30,
                  around: int = 2) -> DataFrame:
    """Pages to show as context: the first, the last, and every page near a phrase (doc, page_no, text)."""
    near = (pages.filter(let(_lower("text"), lambda low: _hits(low, phrases) > 0)).select(doc, "page_no")
            .withColumn("page_no", F.explode(F.sequence(F.col("page_no") - around, F.col("page_no") + around)))
            .distinct().withColumn("__near", F.lit(True)))
    sized = split_join(pages, page_counts(pages, doc), [doc])
    return (sized.join(near, [doc, "page_no"], "left")
            .filter((F.col("page_no") <= first) | (F.col("page_no") > F.col("n_pages") - last) | F.col("__near"))
            .select(doc, "page_no", "text"))


def _heading(doc: str) -> Column:
    return F.concat(F.lit("PDF file: "), F.col(doc).cast("string"), F.lit("\n"))


def context_long(pages: DataFrame, doc: str, **options) -> DataFrame:
    """The whole context of every document, one row per page (doc, page_no, start, text): the page's text under its own
    heading, and where it starts in the document's context, whose first characters are "PDF file: ", the document and a
    line feed. Nothing is cut, and no document is gathered in one row; a page without text is an empty place.
    """
    piece = F.concat(F.lit("\n\n--- PAGE "), F.col("page_no").cast("string"), F.lit(" ---\n"), F.col("text"))
    kept = context_pages(pages, doc, **options).select(doc, "page_no", piece.alias("text"))
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    ends = running_sum(kept.select(doc, "page_no", length.alias("len")), doc, "page_no", "len", "upto")
    starts = ends.select(doc, "page_no", (F.length(_heading(doc)) + F.col("upto") - F.col("len")).alias("start"))
    return split_join(kept, starts, [doc, "page_no"]).select(doc, "page_no", "start", "text")


def context_text(pages: DataFrame, doc: str, limit: int, **options) -> DataFrame:
    """The context pages of every document as one text, cut at the caller's `limit` of characters (a feature of the reader).

    Pages past the limit are dropped before anything is gathered: the text of one document never exceeds the limit.
    `context_long` has the whole.
    """
    parts = context_long(pages, doc, **options).filter((F.col("start") < limit) & F.col("text").isNotNull()) \
        .select(doc, "page_no", F.left("text", F.lit(limit) - F.col("start").cast("int")).alias("piece"))
    body = parts.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("page_no", "piece"))).alias("p"))
    return body.select(doc, F.left(F.concat(_heading(doc), F.array_join(F.transform("p", lambda s: s["piece"]), "")), F.lit(limit)).alias("context"))


def clamp_range(start: Col, end: Col, primary: Col, total: Col) -> Column:
    """struct(start, end, primary) of a page range inside a document of `total` pages."""
    s = F.greatest(F.lit(1), as_col(start))
    e = F.least(as_col(total), F.greatest(s, as_col(end)))
    p = as_col(primary)
    return F.struct(s.alias("start_page"), e.alias("end_page"),
                    F.when(p.between(s, e), p).otherwise(F.floor((s + e) / 2)).cast("int").alias("primary_page"))


def next_candidate(keyword: DataFrame, located: DataFrame, sent: DataFrame, totals: DataFrame, doc: str) -> DataFrame:
    """The next page range per document that was not sent yet.

    Keyword pages with row phrases come first, then the locator's ranges after its best one. located: (doc, rank,
    ord, start_page, end_page); sent: (doc, primary_page); totals: (doc, n_pages).
    """
    a = keyword.filter("has_row_phrase").select(doc, F.lit(0).alias("kind"), F.col("rank").alias("place"), F.lit(0).alias("ord"),
                                                "start_page", "end_page", F.col("page_no").alias("primary_page"))
    rank = F.coalesce(F.col("rank"), F.lit(99))
    # the locator lists a handful of ranges; its best one was already tried
    best = located.groupBy(doc).agg(F.min(F.struct(rank.alias("rank"), F.col("ord"))).alias("b"))
    b = located.withColumn("rank", rank).join(best, doc).filter(F.struct("rank", "ord") != F.col("b")) \
        .filter("start_page is not null and end_page is not null").join(totals, doc)
    s = F.greatest(F.lit(1), F.least("start_page", "n_pages"))
    e = F.least("n_pages", F.greatest(s, F.col("end_page")))
    b = b.select(doc, F.lit(1).alias("kind"), F.col("rank").alias("place"), "ord", s.alias("start_page"), e.alias("end_page"),
                 F.floor((s + e) / 2).cast("int").alias("primary_page"))
    options = a.unionByName(b).join(sent.select(doc, "primary_page").distinct(), [doc, "primary_page"], "left_anti")
    return pick.smallest(options, [doc], [F.col("kind"), F.col("place"), F.col("ord")])


def choose_selected(files: DataFrame, sent: DataFrame, max_bytes: int) -> DataFrame:
    """The selected-page file of every stem: the one recorded as sent (best folder first), else the best method
    among files within the size limit. files: (stem, name, dir, dir_rank, method_rank, size); sent: (stem, dir, name)."""
    rec = files.join(sent.select("stem", "dir", "name").distinct(), ["stem", "dir", "name"], "left_semi")
    first = pick.smallest(rec, ["stem"], [F.col("dir_rank"), F.col("name")]).withColumn("source", F.lit("timing"))
    rest = files.filter(F.col("size") <= max_bytes).join(first.select("stem"), "stem", "left_anti")
    other = pick.smallest(rest, ["stem"], [F.col("dir_rank"), F.col("method_rank"), F.col("name")]).withColumn("source", F.lit("filename"))
    return first.unionByName(other)
