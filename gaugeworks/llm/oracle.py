"""DuckDB SQL for the queries that SQL can express."""

LINES = r"""
parts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
),
line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM parts
),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (FROM common)) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos)
                  FILTER (key NOT IN (FROM common)), '') AS text
  FROM keyed GROUP BY doc_id
)"""

PHRASES = r"""
pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
listed AS (
  SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
),
word AS (
  SELECT lang, piece_id, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM listed
),
chain AS (
  SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3, lead(w1, 3) OVER piece AS w4
  FROM word WINDOW piece AS (PARTITION BY piece_id ORDER BY i)
),
f AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM chain GROUP BY lang, phrase
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 AS phrase, count(*) FROM chain WHERE w2 IS NOT NULL GROUP BY lang, phrase
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*)
            FROM chain WHERE w3 IS NOT NULL GROUP BY lang, phrase
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS phrase, count(*)
            FROM chain WHERE w4 IS NOT NULL GROUP BY lang, phrase
),
able AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
kept AS (
  SELECT * FROM able AS p WHERE NOT EXISTS (
    SELECT 1 FROM able AS q
    WHERE q.lang = p.lang AND q.k > p.k AND 100::HUGEINT * q.a >= 80::HUGEINT * p.a
      AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
),
cut AS (SELECT *, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS w FROM kept),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, 2000000::HUGEINT * cut.a // (x.a + y.a) AS score
  FROM cut
  JOIN f AS x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:j], ' ')
  JOIN f AS y ON y.lang = cut.lang AND y.phrase = array_to_string(w[j + 1:], ' ')
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
),
total AS (SELECT lang, count(*) AS n FROM chain GROUP BY lang)"""

#: The checksum of the decimal id, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda bits, step: CASE WHEN bits % 2 = 1 THEN xor(bits // 2, 3988292384) ELSE bits // 2 END)))"""

RUNS = rf"""
doc AS (
  SELECT doc_id, {CRC32} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
sized AS (SELECT *, len(words) AS n FROM doc),
planted AS (
  SELECT doc_id, words, n, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, h // 10 AS g FROM sized
),
original AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i, n, a, g FROM planted),
taken AS (
  SELECT doc_id, i, n, CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END AS src
  FROM original
),
word AS (
  SELECT taken.doc_id, taken.i, taken.n, original.word
  FROM taken JOIN original ON original.doc_id = taken.doc_id AND original.i = taken.src
),
pair AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM word AS x JOIN word AS y
    ON y.doc_id = x.doc_id AND y.word = x.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
placed AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM pair),
repeated AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM placed
  GROUP BY doc_id, q, stretch HAVING count(*) + q >= greatest(6, 4 * q)
),
run AS (
  SELECT * FROM repeated AS r WHERE NOT EXISTS (
    SELECT 1 FROM repeated AS o
    WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.l >= r.s + r.l)
),
best AS (
  SELECT doc_id, s, l, q FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l / q DESC, s, q) = 1
),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM run GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run),
collapsed AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)"""

#: ``op12_periodic_runs``. Four of its columns are null for documents without a run, and tools turn whole
#: numbers with nulls into other types, so the rows are compared in tests/llm and not by the driver.
PERIODIC_RUNS = f"""WITH {RUNS}
SELECT documents.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period,
       1000 * l // q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(collapsed.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op5_line_dedup": f"""WITH {LINES}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept""",
    "op11_phrases": f"""WITH {PHRASES}
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
