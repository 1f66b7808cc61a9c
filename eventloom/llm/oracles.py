"""SQL statements (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from eventloom.llm.licences import LEAST, TEMPLATES, WORDINGS, template_terms, wording_vectors

# sets of five-word shingles, links of pairs with a common shingle, smallest reachable id
NEAR_DUPLICATES = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS doc_id, a AS target FROM both_ways
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON e.a = r.target
), smallest AS (SELECT doc_id, min(target) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(m.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN smallest m USING (doc_id)
"""

# windows of ten item words (or a whole shorter item), joined with the windows of documents
DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS shown
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS shown
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)
), found AS (
  SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, shown)
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, i, size FROM found), range(0, 10) t(k) WHERE k < size GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# CRC-32 byte by byte over a table made from its polynomial
SHARDS = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(n))
), sized AS (
  SELECT doc_id, source, coalesce(text, '') AS text, md5('17:' || CAST(doc_id AS VARCHAR)) AS shuffle_key FROM documents
), bytes AS (
  SELECT doc_id, list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(text) * 2, 2), lambda i: CAST('0x' || hx[i:i + 1] AS BIGINT))) AS b
  FROM (SELECT doc_id, text, hex(encode(text)) AS hx FROM sized)
), crcs AS (
  SELECT doc_id, xor(4294967295::BIGINT, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS text_crc32 FROM bytes, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY shuffle_key, doc_id) AS r, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM sized
), placed AS (
  SELECT *, row_number() OVER (ORDER BY CAST(2 * r - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), source, doc_id) - 1 AS p FROM ranked
), cut AS (SELECT *, p * 40 // total AS shard FROM placed)
SELECT doc_id, CAST(strlen(text) + 16 AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(p - (shard * total + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut JOIN crcs USING (doc_id)
"""

# all scores by counting, in 64-bit integers
RANKED_SEARCH = r"""
WITH worded AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), sized AS (SELECT doc_id, r, w, CAST(len(w) AS BIGINT) AS n FROM worded WHERE len(w) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS d, CAST(sum(n) AS BIGINT) AS l FROM sized),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), counts AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM sized) WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(d) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM counts, totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term)
  JOIN (SELECT r, doc_id, 100 - 50 + (50 * n * d) // l AS m FROM sized, totals) USING (r) GROUP BY item_id, doc_id, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


def _licences() -> str:
    """Every passage against every template and wording, without a choice of candidates."""
    vectors = wording_vectors(TEMPLATES, WORDINGS)
    unknown = template_terms()[1]
    values = ", ".join(f"({n}, '{w}', '{name}', {weight!r}::DOUBLE, {idf[w]!r}::DOUBLE)" for n, (name, weights, idf) in enumerate(vectors) for w, weight in weights.items())
    return rf"""
WITH terms(template, word, license, weight, idf) AS (VALUES {values}),
placed AS (
  SELECT doc_id, text, concat_ws('/', source, CAST(doc_id // 1000 AS VARCHAR), CAST(doc_id // 100 % 10 AS VARCHAR)) AS own_folder, source,
    CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN doc_id % 4 ELSE 3 END AS level
  FROM documents
), files AS (
  SELECT doc_id, text, CASE level WHEN 0 THEN source WHEN 1 THEN concat_ws('/', source, CAST(doc_id // 1000 AS VARCHAR)) ELSE own_folder END AS folder,
    CASE WHEN level < 3 THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS name
  FROM placed
), parts AS (
  SELECT doc_id, passage, row_number() OVER () AS part FROM (
    SELECT doc_id, unnest(list_distinct(list_concat(list_concat(string_split(text, chr(10)), string_split_regex(text, '\n[ \t\r]*\n')), [text]))) AS passage FROM files)
), bags AS (
  SELECT doc_id, part, word, count(*) AS n FROM (
    SELECT doc_id, part, unnest(string_split_regex(translate(passage, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+')) AS word FROM parts)
  WHERE word <> '' GROUP BY ALL
), norms AS (
  SELECT part, sqrt(sum(power(n * coalesce(idf, {unknown!r}::DOUBLE), 2))) AS norm
  FROM bags LEFT JOIN (SELECT word, min(idf) AS idf FROM terms GROUP BY word) USING (word) GROUP BY part
), alike AS (
  SELECT doc_id, license, round(sum(n * idf * weight) / any_value(norm), 6) AS similarity
  FROM bags JOIN terms USING (word) JOIN norms USING (part) GROUP BY doc_id, part, template, license
), own AS (
  SELECT doc_id, license, similarity FROM alike WHERE similarity >= {LEAST}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, license) = 1
), stated AS (
  SELECT folder, license FROM files JOIN own USING (doc_id) WHERE regexp_matches(name, '(?i)^(licen[sc]e|copying|notice)(\.[^/]*)?$')
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY similarity DESC, license) = 1
), nearest AS (
  SELECT f.folder, s.folder AS licensed_folder, s.license AS from_folder
  FROM (SELECT DISTINCT folder FROM files) f JOIN stated s ON f.folder = s.folder OR starts_with(f.folder, s.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(s.folder) DESC) = 1
)
SELECT f.doc_id, f.folder || '/' || f.name AS path, coalesce(o.license, n.from_folder) AS license, o.similarity,
  CASE WHEN o.license IS NOT NULL THEN 'own' WHEN n.from_folder IS NOT NULL THEN 'folder' END AS origin,
  CASE WHEN o.license IS NULL THEN n.licensed_folder END AS licensed_folder
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN nearest n ON n.folder = f.folder
"""


ORACLES = {
    "op3_near_duplicates": NEAR_DUPLICATES,
    "op4_decontamination": DECONTAMINATION,
    "op5_interleaved_shards": SHARDS,
    "op9_licences": _licences(),
    "op11_ranked_search": RANKED_SEARCH,
}
