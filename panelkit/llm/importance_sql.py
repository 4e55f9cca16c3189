"""SQL of op12_importance_resampling: checksums of the distinct features byte by byte, then counts, gains and ranks."""
from panelkit.llm.repair_sql import CRC_TABLE, crc32

_BYTES = "list_transform(range(0, length(hex(f)) // 2), lambda i: CAST('0x' || hex(f)[2 * i + 1 : 2 * i + 2] AS BIGINT))"
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _runs(rows: str) -> str:
    return " UNION ALL ".join(
        f"SELECT d, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i : i + {n - 1}], ' '))) AS f FROM {rows}" for n in (1, 2, 3))


SQL = f"""
WITH RECURSIVE {CRC_TABLE},
docs AS (SELECT row_number() OVER () AS d, CAST(doc_id AS BIGINT) AS doc_id, coalesce({_WORDS}, []) AS w FROM documents),
wanted AS (SELECT 0 AS d, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
found AS MATERIALIZED ({_runs('docs')}),
target AS MATERIALIZED ({_runs('wanted')}),
known AS (SELECT f, {crc32(_BYTES)} % 10000 AS bucket FROM (SELECT f FROM found UNION SELECT f FROM target), crc),
hashed AS MATERIALIZED (SELECT d, bucket FROM found JOIN known USING (f)),
source_n AS (SELECT bucket, count(*) AS s FROM hashed GROUP BY bucket),
target_n AS (SELECT bucket, count(*) AS t FROM target JOIN known USING (f) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0)::DOUBLE FROM source_n) + 10000)
    / ((s + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0)::DOUBLE FROM target_n) + 10000)))) AS gain FROM source_n LEFT JOIN target_n USING (bucket)),
weighed AS (SELECT d, CAST(sum(gain) AS BIGINT) AS weight, count(*) AS n_features FROM hashed JOIN gains USING (bucket) GROUP BY d),
scored AS (SELECT d, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (d)),
placed AS (SELECT d, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * (SELECT count(*) FROM placed) // 100 THEN rank END AS rank
FROM scored LEFT JOIN placed USING (d)"""
