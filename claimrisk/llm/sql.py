"""DuckDB SQL that computes the rows of the corpus queries SQL can express."""

from __future__ import annotations

SHARD = """
    CASE WHEN {new} AND ln((('0x' || substr(md5(k || '/2'), 1, 13))::BIGINT + 1) / 4503599627370496.0)
              > greatest(r0, r1) THEN 8
         WHEN r0 > r1 THEN CASE WHEN k00 > k01 THEN CASE WHEN s0 > s1 THEN 0 ELSE 1 END
                                ELSE CASE WHEN s2 > s3 THEN 2 ELSE 3 END END
         ELSE CASE WHEN k10 > k11 THEN CASE WHEN s4 > s5 THEN 4 ELSE 5 END
                   ELSE CASE WHEN s6 > s7 THEN 6 ELSE 7 END END END::INTEGER"""
NODES = {"r0": ("/0", 4), "r1": ("/1", 4), "k00": ("/0/0", 2), "k01": ("/0/1", 2),
         "k10": ("/1/0", 2), "k11": ("/1/1", 2)}
NODES |= {f"s{n}": (f"/{n // 4}/{n // 2 % 2}/{n}", 1) for n in range(8)}
DRAWN = ",\n    ".join(
    f"ln((('0x' || substr(md5(k || '{name}'), 1, 13))::BIGINT + 1) / 4503599627370496.0) / {w} AS {n}"
    for n, (name, w) in NODES.items())

# Steps of the checksum of one byte; CRC32 takes bytes and the column l.
LOOKUP = """
bits AS (
    SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS n FROM range(256) t(b)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1
    FROM bits WHERE n < 8),
lookup AS (SELECT list(c ORDER BY b) AS l FROM bits WHERE n = 8)"""
CRC32 = """xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            range(octet_length({0})),
            lambda i: ('0x' || substr(hex({0}), 2 * i + 1, 2))::BIGINT)),
        lambda a, b: xor(a >> 8, l[(xor(a, b) & 255) + 1])), 4294967295)"""

SHARDING_SQL = f"""
WITH RECURSIVE {LOOKUP.strip()},
docs AS (
    SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, encode(coalesce(text, '')) AS bytes
    FROM documents),
drawn AS (
    SELECT doc_id, k, octet_length(bytes) + 1 AS size,
    {CRC32.format("bytes")} AS text_crc32,
    {DRAWN}
    FROM docs, lookup),
placed AS (
    SELECT *, {SHARD.format(new="FALSE")} AS shard, {SHARD.format(new="TRUE")} AS grown_shard
    FROM drawn)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY substr(md5(k), 1, 3), doc_id, text_crc32, size)
        - 1 AS slot,
    grown_shard
FROM placed
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words one edit apart: one is the other without a letter, or both are equal without the letter
# at the same place.
VARIANTS_SQL = f"""
WITH RECURSIVE {LOOKUP.strip()},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' AS k, translate(run, '{UPPER}', '{LOWER}') AS low,
        count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
          FROM documents)
    GROUP BY ALL),
keyed AS (SELECT low, c, encode(k || low) AS bytes FROM runs),
hashed AS (SELECT low, c, {CRC32.format("bytes")} AS h FROM keyed, lookup),
words AS (
    SELECT word, sum(c)::BIGINT AS n FROM (
        SELECT c, CASE WHEN h % 199 = 0 THEN substr(low, 1, h % length(low)) || substr(low, h % length(low) + 2)
            ELSE low END AS word
        FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
    UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word),
best AS (
    SELECT near.word, count(*) AS n_near, max(words.n) AS most,
        arg_min(near.other, {{'a': -words.n, 'b': near.other}}) AS other
    FROM near JOIN words ON words.word = near.other GROUP BY near.word),
forms AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN other END AS form,
        CASE WHEN most >= 5 * n THEN most END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word),
paths AS (
    SELECT word, word AS onward, 0 AS steps FROM forms
    UNION ALL
    SELECT paths.word, forms.form, steps + 1 FROM paths JOIN forms ON forms.word = paths.onward
    WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(onward, steps) AS root FROM paths GROUP BY word)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN roots ON roots.word = forms.word
"""

# Row by row the cheapest way into every state (0 start, 1 system, 2 user, 3 assistant), ties by
# audit; ``ins`` are runs of inserted rows.
REPAIR_SQL = f"""
WITH RECURSIVE {LOOKUP.strip()},
kinds AS (
    SELECT *, {CRC32.format("bytes")} % 20 AS kind FROM (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') AS cid,
            encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS bytes
        FROM conversations), lookup),
damaged AS (
    SELECT cid, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds JOIN (VALUES (0), (1)) AS again(again) ON again = 0 OR kind = 3 WHERE kind <> 0),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
    FROM damaged),
faulted AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
        WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'd'
        WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 't'
        ELSE '' END AS fault,
        lag(role) OVER (PARTITION BY cid ORDER BY i) AS earlier
    FROM numbered),
counted AS (
    SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (earlier IS NOT NULL AND substr(earlier, 1, 1) || substr(role, 1, 1)
            NOT IN ('su', 'ua', 'au')) AS illegal,
        max(i) AS n
    FROM faulted GROUP BY cid),
ins(a, b, cost, audit, lines) AS (VALUES
    (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'),
    (2, 3, 5, 'I', chr(10) || 'assistant:'), (3, 2, 5, 'I', chr(10) || 'user:'),
    (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
moves(a, initial, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ways AS (
    SELECT cid, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM counted
    UNION ALL
    SELECT cid, i, st, cost, audit, lines FROM (
        SELECT w.cid, w.i + 1 AS i, e.b AS st, w.cost + ins.cost + e.cost AS cost,
            w.audit || ins.audit || e.audit AS audit, w.lines || ins.lines || e.line AS lines
        FROM ways w JOIN ins ON ins.a = w.st JOIN faulted f ON f.cid = w.cid AND f.i = w.i + 1,
        LATERAL (
            SELECT ins.b AS b, 2 AS cost, 'D' AS audit, '' AS line
            UNION ALL
            SELECT m.b, CASE f.fault WHEN 't' THEN 5 ELSE 0 END, 'K', chr(10) || f.role || ':' || f.text
            FROM moves m WHERE m.a = ins.b AND m.initial = substr(f.role, 1, 1) AND f.fault IN ('', 't')
            UNION ALL
            SELECT m.b, CASE f.fault WHEN 't' THEN 6 ELSE 1 END, 'R',
                chr(10) || CASE m.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text
            FROM moves m WHERE m.a = ins.b AND m.initial <> 's' AND f.fault IN ('', 't')) e)
    QUALIFY row_number() OVER (PARTITION BY cid, st ORDER BY cost, audit) = 1),
ended AS (
    SELECT c.cid, w.cost + ins.cost AS cost, w.audit || ins.audit AS audit, w.lines || ins.lines AS lines
    FROM counted c JOIN ways w ON w.cid = c.cid AND w.i = c.n JOIN ins ON ins.a = w.st AND ins.b IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY c.cid ORDER BY w.cost + ins.cost, w.audit || ins.audit) = 1)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN counted ON counted.cid = coalesce(every.conv_id::VARCHAR, ' ')
LEFT JOIN ended ON ended.cid = counted.cid
"""
