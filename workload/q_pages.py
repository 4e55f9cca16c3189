"""Pages of documents ranked by phrases; a conversation is a document, its turns are the pages."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import pages as P
from panelkit.operators.spread import dealt
from workload import roles as R
from workload.registry import query

# phrases that occur in the given texts, with weights
WEIGHTS = {"the ": 6, "with ": 5, "and ": 4, "that ": 9, "la ": 3, "le ": 3, "und ": 4, "shall": 12, "not in": 7}
TITLE = ["that ", "shall"]
ROWS = ["with ", "and ", "le "]


def pages(spark, sf):
    c = R.table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).cast("int").alias("page_no"), "text")


def lines(spark, sf):
    """Every line of every document as a page of it."""
    return dealt(R.table(spark, sf, "documents").select("doc_id", "text")).select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "text")) \
        .select("doc", (F.col("pos") + 1).cast("int").alias("page_no"), "text")


PAGES = r"pg AS (SELECT conv_id AS doc, CAST(turn + 1 AS INT) AS page_no, text, lower(regexp_replace(text, '\s+', ' ', 'g')) AS low FROM conversations), np AS (SELECT doc, max(page_no) AS n_pages FROM pg GROUP BY 1)"
LINES = r"pg AS (SELECT doc_id AS doc, CAST(u.i AS INT) AS page_no, u.x AS text, lower(regexp_replace(u.x, '\s+', ' ', 'g')) AS low FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(x, i)), np AS (SELECT doc, max(page_no) AS n_pages FROM pg GROUP BY 1)"


def hits(phrases):
    return " + ".join(f"contains(low, '{p}')::INT" for p in phrases)


SCORE = " + ".join(f"contains(low, '{p}')::INT * {w}" for p, w in WEIGHTS.items())
RANK = f"""sc AS (SELECT doc, page_no, ({SCORE}) + CASE WHEN ({hits(TITLE)}) > 0 THEN 12 ELSE 0 END + CASE WHEN ({hits(ROWS)}) >= 2 THEN 10 ELSE 0 END AS score, len(regexp_extract_all(text, '-?\\d+(?:\\.\\d+)?')) < 12 AS img,
  array_to_string(list_filter([{", ".join(f"CASE WHEN contains(low, '{p}') THEN '{p}' END" for p in WEIGHTS)}], lambda x : x IS NOT NULL), '|') AS m, ({hits(ROWS)}) > 0 AS hr FROM pg),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC, page_no) AS rank FROM sc WHERE score >= 18),
kw AS (SELECT doc, CAST(rank AS INT) AS rank, page_no, CAST(score AS INT) AS score, greatest(1, page_no - 2) AS start_page, least(n_pages, page_no + 2) AS end_page, img AS likely_image_based, m AS matched_phrases, hr FROM rk JOIN np USING (doc) WHERE rank <= 5)""".replace("\\\\", "\\")


def ranked(p):
    return P.keyword_pages(p, "doc", WEIGHTS, TITLE, ROWS)


@query("page_ranking", f"WITH {PAGES}, {RANK} SELECT * EXCLUDE (hr) FROM kw")
def page_ranking(spark, sf):
    """The five best pages of a document by weighted phrases, with the range around each."""
    return ranked(pages(spark, sf)).withColumn("matched_phrases", F.array_join("matched_phrases", "|")).drop("has_row_phrase")


@query("line_ranking", f"WITH {LINES}, {RANK} SELECT * EXCLUDE (hr) FROM kw")
def line_ranking(spark, sf):
    """The same over every line of every document."""
    return ranked(lines(spark, sf)).withColumn("matched_phrases", F.array_join("matched_phrases", "|")).drop("has_row_phrase")


COUNT = list(WEIGHTS)
@query("page_ranking_by_count", f"""WITH {PAGES}, sc AS (SELECT doc, page_no, ({" + ".join(f"contains(lower(text), '{p}')::INT" for p in COUNT)}) AS n, CASE WHEN contains(lower(text), 'shall') THEN 5 ELSE 0 END AS b FROM pg),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n + b DESC, page_no DESC) AS rank FROM sc WHERE n > 0)
SELECT doc, CAST(rank AS INT) AS rank, page_no, CAST(n + b AS INT) AS score, greatest(1, page_no - 1) AS start_page, page_no + 4 AS end_page FROM rk WHERE rank <= 5""")
def page_ranking_by_count(spark, sf):
    """The older ranking: number of phrases with a bonus, later pages first."""
    return P.keyword_pages_by_count(pages(spark, sf), "doc", COUNT, "shall")


NEAR = ["shall", "that "]
CTX = f"""nr AS (SELECT DISTINCT doc, page_no + d AS page_no FROM pg, (VALUES (-2), (-1), (0), (1), (2)) t(d) WHERE ({hits(NEAR)}) > 0),
cx AS (SELECT pg.* FROM pg JOIN np USING (doc) WHERE page_no <= 2 OR page_no > n_pages - 3 OR EXISTS (SELECT 1 FROM nr WHERE nr.doc = pg.doc AND nr.page_no = pg.page_no))"""


@query("context_pages", f"WITH {LINES}, {CTX} SELECT doc, page_no, length(text) AS n FROM cx")
def context_pages(spark, sf):
    """First and last pages and every page near a phrase."""
    return P.context_pages(lines(spark, sf), "doc", NEAR, 2, 3).select("doc", "page_no", F.length("text").cast("long").alias("n"))


@query("context_text", f"""WITH {LINES}, {CTX} SELECT doc, left('PDF file: ' || doc || chr(10) || string_agg(chr(10) || chr(10) || '--- PAGE ' || page_no || ' ---' || chr(10) || text, '' ORDER BY page_no), 900) AS context FROM cx GROUP BY doc""")
def context_text(spark, sf):
    """The context of a document as one text, cut at a length (a feature of the reader)."""
    return P.context_text(lines(spark, sf), "doc", 900, phrases=NEAR, first=2, last=3)


@query("context_long", f"""WITH {LINES}, {CTX}, pc AS (SELECT doc, page_no, chr(10) || chr(10) || '--- PAGE ' || page_no || ' ---' || chr(10) || text AS text FROM cx)
SELECT doc, page_no, CAST(length('PDF file: ' || doc || chr(10)) + sum(length(text)) OVER (PARTITION BY doc ORDER BY page_no) - length(text) AS BIGINT) AS start, text FROM pc""")
def context_long(spark, sf):
    """The whole context of a document, page by page, with each page's place in it."""
    return P.context_long(lines(spark, sf), "doc", phrases=NEAR, first=2, last=3)


@query("next_candidate_page", f"""WITH {PAGES}, {RANK}, loc AS (SELECT conv_id AS doc, CASE WHEN turn % 4 = 3 THEN NULL ELSE CAST(turn % 4 + 1 AS INT) END AS rank, CAST(turn AS INT) AS ord, CAST(turn AS INT) AS s, CAST(turn + 3 AS INT) AS e FROM conversations),
lr AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY coalesce(rank, 99), ord) AS r FROM loc), lc AS (SELECT doc, coalesce(rank, 99) AS rank, ord, greatest(1, least(s, n_pages)) AS s, least(n_pages, greatest(greatest(1, least(s, n_pages)), e)) AS e FROM lr JOIN np USING (doc) WHERE r > 1),
op AS (SELECT doc, 0 AS kind, rank AS place, 0 AS ord, start_page, end_page, page_no AS primary_page FROM kw WHERE hr UNION ALL SELECT doc, 1, rank, ord, s, e, CAST((s + e) // 2 AS INT) FROM lc)
SELECT doc, kind, place, start_page, end_page, primary_page FROM op WHERE NOT EXISTS (SELECT 1 FROM conversations v WHERE v.conv_id = doc AND v.turn + 1 = primary_page AND v.role = 'system') QUALIFY row_number() OVER (PARTITION BY doc ORDER BY kind, place, ord) = 1""")
def next_candidate_page(spark, sf):
    """The next page range that was not sent yet: keyword pages, then the locator's lower ranks."""
    p, c = pages(spark, sf), R.table(spark, sf, "conversations")
    located = c.select(F.col("conv_id").alias("doc"), F.when(F.col("turn") % 4 < 3, F.col("turn") % 4 + 1).cast("int").alias("rank"), F.col("turn").cast("int").alias("ord"),
                       F.col("turn").cast("int").alias("start_page"), (F.col("turn") + 3).cast("int").alias("end_page"))
    sent = c.filter("role = 'system'").select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).cast("int").alias("primary_page"))
    return P.next_candidate(ranked(p), located, sent, P.page_counts(p, "doc"), "doc").select("doc", "kind", "place", "start_page", "end_page", "primary_page")


@query("page_range_clamp", """WITH c AS (SELECT conv_id, turn, greatest(1, turn - 2) AS s, turn * 3 AS e0, length(text) % 9 AS p FROM conversations), d AS (SELECT *, least(6, greatest(s, e0)) AS e FROM c)
SELECT conv_id, turn, CAST(s AS INT) AS start_page, CAST(e AS INT) AS end_page, CAST(CASE WHEN p BETWEEN s AND e THEN p ELSE floor((s + e) / 2) END AS INT) AS primary_page FROM d""")
def page_range_clamp(spark, sf):
    c, t = R.table(spark, sf, "conversations"), F.col("turn").cast("int")
    return c.select("conv_id", "turn", P.clamp_range(t - 2, t * 3, F.length("text") % 9, F.lit(6)).alias("r")).select("conv_id", "turn", "r.*")
