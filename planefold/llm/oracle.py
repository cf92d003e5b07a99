"""SQL for the queries that SQL can express."""

SUBSTRING = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS s FROM w, unnest(range(1, len(ws) - 11)) t(i)
), first_doc AS (
  SELECT s, min(doc_id) AS d FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM win JOIN first_doc USING (s), unnest(range(0, 13)) r(k) WHERE d < doc_id
), listed AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM w LEFT JOIN listed USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS s FROM w, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) t(i)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
)
SELECT w.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(y)::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.x = w.doc_id GROUP BY w.doc_id
"""

CONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), pat AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS s
  FROM bw, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) t(i) WHERE len(ws) > 0
), ms AS (
  SELECT DISTINCT m FROM pat
), win AS (
  SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS s FROM dw, ms, unnest(range(1, len(ws) - m + 2)) t(i)
), occ AS (
  SELECT doc_id, i, m, item_id FROM win JOIN pat USING (m, s)
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM occ, unnest(range(0, m)) r(k) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM occ GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

MERKLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
    list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text], lambda v: coalesce(strlen(v) || ':' || v, '-')) AS own,
    list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')], lambda v: coalesce(strlen(v) || ':' || v, '-')) AS lower_,
    xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, tree, sha256(array_to_string(own, '')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(array_to_string(lower_, '')) ELSE sha256(array_to_string(own, '')) END AS claimed,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n
  FROM docs
), node AS (
  SELECT tree, 0 AS level, place, n, leaf AS h FROM leaf
  UNION ALL
  SELECT tree, any_value(level) + 1, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM node WHERE n > 1 GROUP BY tree, place // 16
), subroot AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM node WHERE n = 1
), upper_ AS (
  SELECT 0 AS level, place, n, h FROM subroot
  UNION ALL
  SELECT any_value(level) + 1, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM upper_ WHERE n > 1 GROUP BY place // 16
), run AS (
  SELECT 0 AS part, tree, level, place // 16 AS run, list(h ORDER BY place) AS hs FROM node WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT 1, '', level, place // 16, list(h ORDER BY place) FROM upper_ WHERE n > 1 GROUP BY ALL
), climb AS (
  SELECT doc_id, tree, 0 AS part, 0 AS level, place, n, '' AS proof, claimed AS h FROM leaf
  UNION ALL
  SELECT c.doc_id, c.tree, CASE WHEN c.n = 1 THEN 1 ELSE c.part END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n = 1 THEN s.place ELSE c.place // 16 END, CASE WHEN c.n = 1 THEN s.n ELSE (c.n + 15) // 16 END,
    CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || array_to_string(r.hs[:c.place % 16], '') || array_to_string(r.hs[c.place % 16 + 2:], '') END,
    CASE WHEN c.n = 1 THEN c.h ELSE sha256(array_to_string(r.hs[:c.place % 16], '') || c.h || array_to_string(r.hs[c.place % 16 + 2:], '')) END
  FROM climb c JOIN subroot s ON s.tree = c.tree
  LEFT JOIN run r ON c.n > 1 AND r.part = c.part AND r.level = c.level AND r.run = c.place // 16 AND r.tree = CASE WHEN c.part = 0 THEN c.tree ELSE '' END
  WHERE c.n > 1 OR c.part = 0
)
SELECT l.doc_id, l.leaf, s.h AS subroot, u.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = u.h AS verified
FROM leaf l JOIN subroot s USING (tree) JOIN climb c ON c.doc_id = l.doc_id AND c.part = 1 AND c.n = 1 JOIN upper_ u ON u.n = 1
"""

ORACLE = {
    "op1_substring_dedup": SUBSTRING,
    "op3_benchmark_decontamination": CONTAMINATION,
    "op10_ngram_jaccard_join": JACCARD,
    "op11_merkle_manifest": MERKLE,
}
