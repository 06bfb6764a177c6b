"""The operators' results in SQL, where SQL can say them."""

MIXING = r"""
WITH measured AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mixing:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS ord
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS size,
    CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS weight
  FROM measured GROUP BY source
), steps AS (
  SELECT *, 3 * size AS cap,
    row_number() OVER o AS place,
    (sum(size) OVER () - coalesce(sum(3 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM sizes WINDOW o AS (ORDER BY 3 * size / weight, source NULLS LAST)
), final AS (
  SELECT arg_min(level, place) AS level FROM steps WHERE level * weight <= cap
), targets AS (
  SELECT source, size AS source_size,
    CASE WHEN final.level * weight > cap THEN CAST(cap AS DOUBLE) ELSE final.level * weight END AS target
  FROM steps, final
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
  FROM targets
), ranked AS (
  SELECT m.doc_id, m.size, p.source_size, p.target, p.whole,
    p.target - p.whole * p.source_size AS rest,
    sum(m.size) OVER (PARTITION BY m.source ORDER BY m.ord) AS upto,
    sum(m.size) OVER (PARTITION BY m.source, m.ord) AS own
  FROM measured m JOIN parts p ON m.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(least(whole + CASE WHEN 2 * upto - own <= 2 * rest AND source_size > 0 THEN 1 ELSE 0 END, 3) AS BIGINT) * size AS taken,
  CAST(least(whole + CASE WHEN 2 * upto - own <= 2 * rest AND source_size > 0 THEN 1 ELSE 0 END, 3) AS BIGINT) AS copies
FROM ranked
"""

MINHASH = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 2
    THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
    ELSE w END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach(u, v) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), named AS (
  SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN named USING (doc_id)
"""

LINES = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), each AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM split
), windows AS (
  SELECT doc_id, place, row(line, lead(line) OVER d, lead(line, 2) OVER d) AS w,
    lead(place, 2) OVER d IS NOT NULL AS whole
  FROM each WINDOW d AS (PARTITION BY doc_id ORDER BY place)
), later AS (
  SELECT doc_id, place FROM windows WHERE whole
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, place) > 1
), gone AS (
  SELECT DISTINCT doc_id, place + step AS place FROM later, (SELECT unnest([0, 1, 2]) AS step)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
  CAST(count(gone.place) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY each.place) FILTER (WHERE gone.place IS NULL), '')) AS kept_sha256
FROM each LEFT JOIN gone USING (doc_id, place)
GROUP BY doc_id
"""

WORDS = r"""
WITH split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS l FROM documents
), each AS (
  SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS place FROM split
), windows AS (
  SELECT doc_id, unnest(range(1, len(l) - 11)) AS place,
    unnest(list_transform(range(1, len(l) - 11), lambda i: md5(array_to_string(l[i:i+12], ' ')))) AS w
  FROM split WHERE len(l) >= 13
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, place + step AS place
  FROM windows JOIN firsts USING (w), (SELECT unnest(range(13)) AS step)
  WHERE doc_id > first
), counted AS (
  SELECT doc_id, count(*) AS n_words, count(gone.place) AS n_removed,
    string_agg(word, ' ' ORDER BY each.place) FILTER (WHERE gone.place IS NULL) AS kept
  FROM each LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN counted USING (doc_id)
"""

VECTORS = r"""
WITH RECURSIVE sound AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(u, v) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), named AS (
  SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
), counted AS (
  SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN named USING (vec_id) LEFT JOIN counted USING (vec_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, bit by bit."""
    byte = " + ".join(
        f"{weight} * (instr('0123456789ABCDEF', substr(hex({text}), 2 * i - {back}, 1)) - 1)"
        for weight, back in ((16, 1), (1, 0))
    )
    bits = f"list_transform(range(1, len(hex({text})) // 2 + 1), lambda i: [{byte}, 0, 0, 0, 0, 0, 0, 0])"
    step = "xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))"
    whole = f"list_concat([CAST(4294967295 AS BIGINT)], CAST(flatten({bits}) AS BIGINT[]))"
    return f"xor(list_reduce({whole}, lambda a, e: {step}), 4294967295)"


TRIE = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(turn ORDER BY place) AS turns FROM turns GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own
), rebuilt AS MATERIALIZED (
  SELECT heads.conv_id,
    list_concat(coalesce(own.turns[1:heads.h], []), heads.turns[heads.h + 1:]) AS turns
  FROM heads LEFT JOIN own ON own.conv_id = heads.conv_id - heads.conv_id % 20
), members AS (
  SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), nodes AS MATERIALIZED (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL
), kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), valued AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes LEFT JOIN kids USING (path)
), above AS (
  SELECT path[1:d] AS path, n_children, saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued)
), sums AS (
  SELECT path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM above GROUP BY path
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id,
  CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN sums USING (path)
LEFT JOIN nodes p ON v.depth > 0 AND p.path = v.path[1:v.depth - 1]
"""

SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS c
  FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS MATERIALIZED (
  SELECT w, c, {_crc32("(CAST(doc_id AS VARCHAR) || ':' || w)")} AS h FROM lowered
), words AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word,
    CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(c) >= 3 AND length(word) >= 5
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), short AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM places
), near AS MATERIALIZED (
  SELECT a.word AS u, b.word AS v FROM short a JOIN short b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT short.word, s FROM short JOIN words ON s = words.word
  UNION SELECT s, short.word FROM short JOIN words ON s = words.word
), best AS (
  SELECT u AS word, count(*) AS n_near, arg_min(v, row(-n, v)) AS form, max(n) AS form_n
  FROM near JOIN words ON v = words.word GROUP BY u
), formed AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain(word, stop) AS (
  SELECT word, word FROM formed
  UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON chain.stop = formed.word WHERE formed.form IS NOT NULL
), roots AS (
  SELECT chain.word, chain.stop AS root FROM chain JOIN formed ON chain.stop = formed.word WHERE formed.form IS NULL
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM formed JOIN roots USING (word)
"""

ORACLE = {
    "op4_recompression": WORDS,
    "op5_minhash": MINHASH,
    "op8_mixing": MIXING,
    "op10_line_dedup": LINES,
    "op11_vectors": VECTORS,
    "op12_prefix_trie": TRIE,
    "op13_spelling": SPELLING,
}
