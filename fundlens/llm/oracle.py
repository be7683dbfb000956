"""DuckDB SQL of the queries that SQL can express."""

OP2 = """
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][(rank - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS wanted
  FROM s
), o AS (
  SELECT *, weight * (wanted - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > cap AS above
  FROM w
), t AS (
  SELECT source, source_size, CASE WHEN above THEN cap ELSE
         weight * (wanted - coalesce(sum(cap) FILTER (above) OVER (), 0)) / sum(weight) FILTER (NOT above) OVER () END AS target
  FROM o
), g AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole FROM t
), u AS (
  SELECT source, place, size, sum(size) AS words FROM d GROUP BY ALL
), r AS (
  SELECT source, place, size, words / 2 + coalesce(sum(words) OVER (PARTITION BY source ORDER BY place, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS middle
  FROM u
)
SELECT d.doc_id, d.size, g.source_size, g.target, d.size * copies AS taken, copies FROM (
  SELECT d.*, g.whole + CASE WHEN r.middle <= g.target - g.whole * g.source_size THEN 1 ELSE 0 END AS copies
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
  JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.place = r.place AND d.size = r.size) d
JOIN g ON d.source IS NOT DISTINCT FROM g.source
"""

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w::DOUBLE[], c.w::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

OP12 = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), p AS (
  SELECT doc, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), s AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w
), g AS (
  SELECT lang, k, words[i:i + k - 1] AS phrase FROM s, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(words)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), often AS (
  SELECT * FROM f WHERE f >= 100
), cut AS (
  SELECT c.lang, c.phrase, c.f AS a, n.n, l.f AS l, r.f AS r, l.k AS first,
         CAST((1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM often c JOIN n ON c.lang = n.lang
  JOIN often l ON l.lang = c.lang AND l.k < c.k AND l.phrase = c.phrase[1:l.k]
  JOIN often r ON r.lang = c.lang AND r.k = c.k - l.k AND r.phrase = c.phrase[l.k + 1:c.k]
  WHERE c.k > 1
), least AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, first) = 1
), inside AS (
  SELECT lang, phrase[1:k - 1] AS phrase, f FROM often WHERE k > 2
  UNION ALL SELECT lang, phrase[2:k], f FROM often WHERE k > 2
), kept AS (
  SELECT * FROM least c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.f >= c.a)
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
         array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
  FROM kept
)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op2_mixing": OP2, "op3_exact_top_k": OP3, "op12_collocations": OP12}
