"""The text queries as plain SQL, where SQL can express them: brute force, for small tables."""

from __future__ import annotations

from dqgate.llm.licenses import TEMPLATES

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, {_WORDS.format(text=_LOWER.format(text="text"))} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id,
    unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM split WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (
  SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(least, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""

LINE_RULES = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format(text="text")} AS w,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), judged AS (
  SELECT *,
    list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS spoken,
    list_filter(lines, lambda x: NOT (
      (NOT regexp_matches(x, '[.!?:;,…。！？"''”’»)\]\x{{2013}}\x{{2014}}-][\x20\x09-\x0D]*\z')
        AND len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) BETWEEN 1 AND 4)
      OR len(regexp_extract_all(x, '[#*$%&|<>]')) * 100 > length(x) * 5
      OR (NOT regexp_matches(x, '[\p{{Ll}}\p{{Lo}}\p{{Lm}}]') AND regexp_matches(x, '\p{{Lu}}[^\n]*\p{{Lu}}'))
      OR regexp_matches(x, '(?i)^[\x20\x09-\x0D]*(home|menu|next|previous|back|top|log ?in|sign (in|up)|register|contact( us)?|about( us)?|site ?map|skip to (main )?content|search|share|read more)[\x20\x09-\x0D]*([|>»/·•][^\n]*)?\z')
      OR regexp_matches(x, '(?i)(javascript|cookie policy|use of cookies|uses cookies|privacy policy|terms of (use|service)|all rights reserved|lorem ipsum|click here|subscribe to our|powered by)')
    )) AS passed
  FROM split
), counted AS (
  SELECT j.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(spoken) - len(list_distinct(spoken)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words,
    length(array_to_string(lines, '')) AS whole,
    length(array_to_string(lines, '')) - length(array_to_string(passed, '')) AS n_lost_chars
  FROM judged j LEFT JOIN covered c ON c.doc_id = j.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_chars,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_chars * 100 <= whole * 30 AS kept
FROM counted
"""

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, line, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY doc_id ORDER BY line) AS place
  FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
      unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents
  ) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), met AS (
  SELECT b.doc_id, b.line, b.words, b.place, a.doc_id AS other, b.place - a.place AS gap
  FROM lines b JOIN lines a ON a.x = b.x AND (b.doc_id, b.place) > (a.doc_id, a.place)
), islands AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id, other, gap ORDER BY place) AS island FROM met
), runs AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id, other, gap, island) AS run_words FROM islands
), removed AS (
  SELECT DISTINCT doc_id, line, words FROM runs WHERE run_words >= 50
), by_doc AS (
  SELECT doc_id, count(*) AS n, sum(words) AS words, string_agg(line::varchar, ',' ORDER BY line) AS which
  FROM removed GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
  coalesce(n, 0) AS n_removed, coalesce(words, 0)::bigint AS removed_words, coalesce(which, '') AS removed_lines
FROM documents d LEFT JOIN by_doc b ON b.doc_id = d.doc_id
"""

NEIGHBOURS = """
WITH usable AS (
  SELECT vec_id, embedding::double[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20
"""

_TEMPLATES = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES.items())
_TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*')"

LICENSES = f"""
WITH templates(name, text) AS (VALUES {_TEMPLATES}),
split AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
own AS (
  SELECT DISTINCT name, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM (SELECT name, {_TOKENS} AS w FROM templates)
), sizes AS (
  SELECT name, count(*) AS n FROM own GROUP BY name
), said AS (
  SELECT doc_id, i - 1 AS word, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)
), met AS (
  SELECT doc_id, name, n, count(DISTINCT s) AS found, min(word) AS word
  FROM said JOIN own USING (s) JOIN sizes USING (name)
  GROUP BY doc_id, name, n HAVING count(DISTINCT s) * 100 >= n * 75
), listed AS (
  SELECT doc_id, count(*) AS n,
    string_agg(name || ':' || found || '/' || n || '@' || word, ',' ORDER BY name) AS licenses
  FROM met GROUP BY doc_id
)
SELECT s.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_licenses, coalesce(licenses, '') AS licenses
FROM split s LEFT JOIN listed l ON l.doc_id = s.doc_id
"""

_TERMS = f"regexp_extract_all({_LOWER.format(text="coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

LEXICAL_SEARCH = f"""
WITH docs AS (
  SELECT row, doc_id, {_TERMS} AS w FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), known AS (
  SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::bigint AS total FROM docs
), tfs AS (
  SELECT row, doc_id, n, t, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS t FROM docs) GROUP BY ALL
), weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint AS weight FROM tfs, known GROUP BY t
), asked AS (
  SELECT DISTINCT item, item_id, t
  FROM (SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS t FROM benchmark)
), scored AS (
  SELECT item, item_id, row, doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // total))))::bigint AS score
  FROM asked JOIN tfs USING (t) JOIN weights USING (t), known GROUP BY ALL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::int AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""

# The checksum by a table of 256 remainders, a byte of the text at a time.
SPELLING = """
WITH RECURSIVE bits(byte, step, value) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END FROM bits WHERE step < 8
), remainders AS (
  SELECT list(value ORDER BY byte) AS r FROM bits WHERE step = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
), hashed AS (
  SELECT run, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, strlen(hex(encode(key))) // 2 + 1),
      lambda i: ('0x' || substr(hex(encode(key)), (2 * i - 1)::bigint, 2))::bigint)),
    lambda a, b: xor(a >> 8, r[1 + (xor(a, b) & 255)])), 4294967295) AS h
  FROM (SELECT run, coalesce(doc_id::varchar, '') || ':' || run AS key FROM runs WHERE length(run) >= 7), remainders
), words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), cut AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.rest
), best AS (
  SELECT x.word, count(*) AS n_near, min({'n': -b.n, 'word': encode(x.near)}) AS top
  FROM near x JOIN words b ON b.word = x.near GROUP BY x.word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top.n >= 10 * w.n THEN decode(top.word) END AS form, CASE WHEN -top.n >= 10 * w.n THEN -top.n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), follow AS (
  SELECT word, word AS last, 0 AS steps FROM forms
  UNION ALL
  SELECT f.word, n.form, steps + 1 FROM follow f JOIN forms n ON n.word = f.last WHERE n.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(last, steps) AS root FROM follow GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON r.word = f.word
"""

_ESCAPED = (
    r"regexp_replace(regexp_replace({text}, '<(\\*(\|[A-Za-z0-9_]+\|>|/?s>))', '<\\\1', 'g'),"
    r" '\[(\\*/?INST\])', '[\\\1', 'g')"
)
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|start|><|says|><|end|>') + length({_ESCAPED.format(text="role")}) + length({_ESCAPED.format(text="text")}))::bigint
    AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op2_near_dedup": NEAR_DEDUP,
    "op4_line_rules": LINE_RULES,
    "op5_neighbours": NEIGHBOURS,
    "op7_licenses": LICENSES,
    "op9_line_dedup": LINE_DEDUP,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_spelling": SPELLING,
    "op13_chat": CHAT,
}
