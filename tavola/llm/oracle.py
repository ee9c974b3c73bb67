"""DuckDB SQL for the queries that SQL can state.

The others have none: nearest neighbours found by an index, trained models, encodings by a
vocabulary, bin packing, and a shuffle by Spark's hash. tests/llm holds those against brute force.
"""

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
classes AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
shingles AS (SELECT c, n, unnest(s) AS x FROM classes),
common AS (
  SELECT a.c AS u, b.c AS v, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.c < b.c GROUP BY a.c, b.c),
links AS (
  SELECT u, v FROM common WHERE 100 * k >= 85 * (m + n - k)
  UNION SELECT v, u FROM common WHERE 100 * k >= 85 * (m + n - k)),
reach AS (
  SELECT c AS a, c AS b FROM classes
  UNION SELECT r.a, l.v FROM reach r JOIN links l ON r.b = l.u),
comps AS (SELECT a AS c, min(b) AS comp FROM reach GROUP BY a)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(p.comp, d.doc_id) AS component_id,
       d.doc_id = coalesce(p.comp, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN comps p ON p.c = c.c
"""

# Pieces up to and with the next separator, from the left, are what the operator's cuts give. Words
# that their MD5 picks are marked first, as leaves end behind them too.
_MARKED = r"""array_to_string(list_transform(
    regexp_extract_all(replace({text}, chr(1), chr(1) || chr(1)), '(?s)[^ \n]*[ \n]|[^ \n]+$'),
    lambda word: if(starts_with(md5(word), '0') AND regexp_matches(word, '[^.!?] $'), word || chr(1) || chr(2), word)), '')"""
_TREE = r"""list_transform(regexp_extract_all({text}, '(?s).*?\n\n|.+$'), lambda section:
    list_transform(regexp_extract_all(section, '(?s).*?\n|.+$'), lambda paragraph:
      list_transform(regexp_extract_all(paragraph, '(?s).*?(?:[.!?] |\x01\x02)|.+$'), lambda sentence: sha256('leaf:' || sentence))))"""
_ROOT = """sha256('document:' || array_to_string(list_transform({tree}, lambda ps: sha256('section:' ||
    array_to_string(list_transform(ps, lambda ls: sha256('paragraph:' || array_to_string(ls, ''))), ''))), ''))"""
_LIKE = """CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST(len(list_intersect({a}, {b})) AS DOUBLE)
    / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"""

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars,
         coalesce(lead(text) OVER w, first_value(text) OVER w) AS following
  FROM d WINDOW w AS (ORDER BY doc_id, text)),
e AS (
  SELECT *, substring(text, 1, n_chars - n_chars // 2) || substring(following, 1, n_chars // 2) AS edited FROM n),
t AS (
  SELECT doc_id, n_chars, edited, {_TREE.format(text='own_marked')} AS own, {_TREE.format(text='edited_marked')} AS changed,
         {_TREE.format(text='next_marked')} AS after
  FROM (SELECT *, {_MARKED.format(text='text')} AS own_marked, {_MARKED.format(text='edited')} AS edited_marked,
               {_MARKED.format(text='following')} AS next_marked FROM e)),
l AS (
  SELECT *, list_distinct(flatten(flatten(own))) AS a, list_distinct(flatten(flatten(changed))) AS b,
         list_distinct(flatten(flatten(after))) AS c FROM t)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_ROOT.format(tree='own')} AS fingerprint,
       {_ROOT.format(tree='changed')} AS edited_fingerprint, {_LIKE.format(a='a', b='b')} AS near_edited,
       {_LIKE.format(a='a', b='c')} AS near_next
FROM l
"""

OP7 = r"""
WITH c AS (
  SELECT conv_id, turn, role, trim(coalesce(text, ''), E' \t\n\r\v\f') AS text,
         lower(regexp_replace(trim(coalesce(text, ''), E' \t\n\r\v\f'), '\s+', ' ', 'g')) AS same FROM conversations),
o AS (
  SELECT *, lag(same, 1) OVER w AS one, lag(same, 2) OVER w AS two
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
f AS (SELECT conv_id, same, min(turn) AS first FROM c WHERE same <> '' GROUP BY conv_id, same),
p AS (
  SELECT o.*, f.first AS parent_turn, g.first AS second
  FROM o LEFT JOIN f ON f.conv_id = o.conv_id AND f.same = o.one AND f.first < o.turn
  LEFT JOIN f g ON g.conv_id = o.conv_id AND g.same = o.two AND g.first < o.turn),
r AS (
  WITH RECURSIVE up AS (
    SELECT conv_id, turn, turn AS place, 0 AS depth FROM p
    UNION ALL
    SELECT up.conv_id, up.turn, p.parent_turn, up.depth + 1
    FROM up JOIN p ON p.conv_id = up.conv_id AND p.turn = up.place AND p.parent_turn IS NOT NULL)
  SELECT conv_id, turn, min(place) AS first_turn, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT p.conv_id, p.turn, p.role, p.text,
       CAST((coalesce(one, '') <> '')::INT + (coalesce(two, '') <> '')::INT AS INT) AS n_quotes,
       CAST((parent_turn IS NOT NULL)::INT + (second IS NOT NULL)::INT AS INT) AS n_linked,
       parent_turn, first_turn, CAST(depth AS INT) AS depth
FROM p JOIN r ON r.conv_id = p.conv_id AND r.turn = p.turn
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS p FROM pieces)),
sized AS (SELECT lang, len(w) AS size, k, w FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
totals AS (SELECT lang, CAST(sum(size) AS BIGINT) AS n FROM sized WHERE k = 1 GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, size - k + 2), lambda i: w[i:i + k - 1])) AS g FROM sized),
f AS (SELECT lang, g, len(g) AS size, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30),
inner_parts AS (
  SELECT lang, f, size, unnest(flatten(list_transform(range(2, size), lambda k: list_transform(range(1, size - k + 2), lambda i: g[i:i + k - 1])))) AS g
  FROM f WHERE size > 2),
longer AS (SELECT lang, g, max(f) AS most FROM inner_parts GROUP BY lang, g),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, unnest(range(1, c.size)) AS k
  FROM f c LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g
  WHERE c.size > 1 AND NOT coalesce(100::HUGEINT * o.most >= 80::HUGEINT * c.f, false)),
scored AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
s AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
asked AS (SELECT DISTINCT term FROM q),
held AS (
  SELECT row_no, doc_id, size, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, len(w) AS size, unnest(w) AS term FROM d) x SEMI JOIN asked USING (term) GROUP BY row_no, doc_id, size, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, s GROUP BY term),
scores AS (
  SELECT item_id, row_no, doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * size * n) // l)))) AS BIGINT) AS score
  FROM held JOIN weights w USING (term) JOIN q USING (term), s GROUP BY item_id, row_no, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

ORACLE_SQL: dict[str, str] = {"op2_minhash": OP2, "op3_merkle": OP3, "op7_quote_linking": OP7, "op11_collocations": OP11, "op12_lexical_search": OP12}
