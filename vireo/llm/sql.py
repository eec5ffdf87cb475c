"""What the queries must give, as SQL, where SQL can say it."""



def edited(path: str, cost: str | int, letter: str) -> str:
    """A path, written as nine digits of cost, a colon and its edits, with one more edit in front; null costs leave it out."""
    return f"printf('%09d:{letter}%s', CAST(substr({path}, 1, 9) AS INTEGER) + {cost}, substr({path}, 11))"


def cheapest(after: str, need: str) -> str:
    """The cheapest path from the row `l` on, whose own edit comes first, where roles so far end in `after`."""
    keep = f"CASE WHEN lower(l) = '{need}' THEN {edited(need, 'cut', 'K')} END"
    system = f"CASE WHEN lower(l) = 's' THEN {edited('s', 'cut', 'K')} END" if after == "e" else "NULL"
    return f"least({edited(after, 3, 'D')}, CASE WHEN l <> 'd' THEN {edited(need, '2 + cut', 'R')} END, {keep}, {system}) AS {after}"


def with_insertions(after: str, *needs: str) -> str:
    paths = [edited(n, 2 * (i + 1), "I" * (i + 1)) for i, n in enumerate(needs)]
    return f"least({after}, {', '.join(paths)}) AS {after}"


SQL = {
    "op1_norm_sorted_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_multi_index_neardup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS id, vec_id AS low FROM v UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.id WHERE r.low < l.b),
c AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.id AS vec_id, coalesce(n.n, 0) AS n_links, component_id, c.id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.id""",
    "op8_superminhash_neardup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 80 * (x.n + y.n - met)),
reach AS (SELECT doc_id AS id, doc_id AS low FROM documents UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.id WHERE r.low < l.b),
c AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id)
SELECT c.id AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.id""",
    "op11_signature_repair": rf"""
WITH RECURSIVE steps AS (SELECT n, n::BIGINT AS v, 0 AS k FROM range(256) t(n) UNION ALL SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS t FROM steps WHERE k = 8),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
d AS (SELECT k.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS kind FROM k, crc),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER c AS pos, left(role, 1) AS initial, lag(left(role, 1)) OVER c AS before FROM m WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault FROM o),
l AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' ELSE CASE WHEN initial IN ('s', 'u', 'a') THEN CASE WHEN fault IS NULL THEN initial ELSE upper(initial) END WHEN fault IS NULL THEN 'x' ELSE 'X' END END AS letter FROM f),
c AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, string_agg(letter, '' ORDER BY pos) AS signature FROM l GROUP BY conv_id),
r AS (SELECT signature, length(signature) AS i, '000000000:' AS e, '000000004:II' AS s, '000000002:I' AS u, '000000000:' AS a FROM (SELECT DISTINCT signature FROM c) UNION ALL
  SELECT signature, i, {with_insertions("e", "u", "a")}, {with_insertions("s", "u", "a")}, {with_insertions("u", "a")}, {with_insertions("a", "u")} FROM (
    SELECT signature, i, {cheapest("e", "u")}, {cheapest("s", "u")}, {cheapest("u", "a")}, {cheapest("a", "u")} FROM (
      SELECT signature, i - 1 AS i, e, s, u, a, substr(signature, i, 1) AS l, CASE WHEN substr(signature, i, 1) IN ('S', 'U', 'A', 'X') THEN 1 ELSE 0 END AS cut FROM r WHERE i > 0))),
b AS (SELECT c.*, CAST(substr(e, 1, 9) AS BIGINT) AS cost, substr(e, 11) AS audit FROM c JOIN r USING (signature) WHERE r.i = 0),
x AS (SELECT conv_id, substr(audit, j, 1) AS edit, length(replace(substr(audit, 1, j), 'I', '')) AS pos, length(replace(substr(audit, 1, j), 'D', '')) AS n FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM b)),
y AS (SELECT x.*, l.role, l.text, max(CASE WHEN x.n = 1 AND x.edit = 'K' AND l.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv_id) AS led FROM x LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM x.conv_id AND l.pos = x.pos AND x.edit <> 'I' WHERE x.edit <> 'D'),
z AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (n - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY n) AS lines FROM y GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op13_positional_index": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i : i + 9], ' '))) AS key FROM b WHERE len(w) > 0),
s AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n),
o AS (SELECT DISTINCT r, i, s.n, item_id FROM (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM s) s JOIN p ON p.n = s.n AND p.key = s.key),
h AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)""",
}
