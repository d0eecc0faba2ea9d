"""DuckDB SQL for the queries that SQL can express, written from the rules of their results."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
often AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM win JOIN often USING (h)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP2 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
       FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks)),
hit AS (SELECT doc_id, item_id, i, dw.k AS k FROM dw JOIN bw ON dw.k = bw.k AND dw.t = bw.t),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS t
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.t, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP3 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + length(regexp_replace(text, '[\\#<]', 'xx', 'g')) + 14)::BIGINT AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant' ELSE false END AND (after IS NOT NULL OR role = 'assistant')) AS valid_order
FROM o GROUP BY conv_id
"""

_OP10 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h,
                  ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS h2 FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
o AS (SELECT *, coalesce(sum(size) OVER u, 0) AS size_before, coalesce(sum(weight) OVER u, 0) AS weight_before FROM w
      WINDOW u AS (ORDER BY size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(size) FROM s) - 2.0::DOUBLE * size_before) / ((SELECT sum(weight) FROM w) - weight_before) AS level FROM o),
t AS (SELECT source, size, least((SELECT arg_min(level, size / weight) FROM l WHERE level * weight <= 2.0::DOUBLE * size) * weight, 2.0::DOUBLE * size) AS target FROM l),
c AS (SELECT *, CASE WHEN size > 0 THEN least(floor(target / size), 2)::BIGINT ELSE 0 END AS copies FROM t),
g AS (SELECT d.*, c.size AS source_size, c.target, c.copies, c.target - c.copies * c.size AS open,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h, h2 ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, coalesce(target, 0) AS target,
       (size * (copies + (before + size <= open OR before <= open AND 2 * (open - before) > size)::INT))::BIGINT AS taken FROM g
"""


def _crc32() -> str:
    """CRC-32 of the decimal text of doc_id, four bits at a time."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ 0xEDB88320 * (i & 1)
        table.append(i)
    half = "xor({0} >> 4, {1}[({0} & 15) + 1])".format
    step = half(half("xor(crc, byte)", table), table)
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {digits}), lambda crc, byte: {step}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}, '-')"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
_OP12 = f"""
WITH RECURSIVE
d AS (SELECT doc_id, source, sha256({_HEAD} || {_field("text")}) AS leaf,
             CASE WHEN {_crc32()} % 2 = 0 THEN sha256({_HEAD} || {_field("replace(text, chr(10), '')")}) END AS changed FROM documents),
l AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS id FROM d
      WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
up AS (SELECT 0 AS level, source, i, leaf AS h, n FROM l
       UNION ALL SELECT level + 1, source, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 2) // 3 FROM up WHERE n > 1 GROUP BY level, source, i // 3),
s AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, i, h, n FROM s
        UNION ALL SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 2) // 3 FROM top WHERE n > 1 GROUP BY level, i // 3),
nodes AS (SELECT 0 AS tree, level, source, i, h FROM up WHERE n > 1 UNION ALL SELECT 1, level, NULL, i, h FROM top WHERE n > 1),
near AS (SELECT tree, level, source, i,
                coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
                coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
         FROM nodes WINDOW r AS (PARTITION BY tree, level, source, i // 3 ORDER BY i)),
walk AS (SELECT id, source, i, 0 AS level, '' AS proof, coalesce(changed, leaf) AS h FROM l
         UNION ALL SELECT id, w.source, w.i // 3, w.level + 1, proof || a || b, sha256(a || w.h || b)
                   FROM walk w JOIN near x ON tree = 0 AND w.level = x.level AND w.source IS NOT DISTINCT FROM x.source AND w.i = x.i),
half AS (SELECT id, arg_max(proof, level) AS proof, arg_max(h, level) AS h, any_value(source) AS source FROM walk GROUP BY id),
rise AS (SELECT id, s.i, 0 AS level, proof, half.h FROM half JOIN s ON half.source IS NOT DISTINCT FROM s.source
         UNION ALL SELECT id, w.i // 3, w.level + 1, proof || a || b, sha256(a || w.h || b)
                   FROM rise w JOIN near x ON tree = 1 AND w.level = x.level AND w.i = x.i),
done AS (SELECT id, sha256(arg_max(proof, level)) AS proof_sha256, arg_max(h, level) AS folded_root FROM rise GROUP BY id),
root AS (SELECT h FROM top WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, (SELECT h FROM root) AS root, proof_sha256, folded_root, folded_root = (SELECT h FROM root) AS verified
FROM l JOIN done USING (id) JOIN s ON l.source IS NOT DISTINCT FROM s.source
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": _OP1,
    "op2_decontaminate": _OP2,
    "op3_chat_format": _OP3,
    "op10_mixing": _OP10,
    "op12_merkle_manifest": _OP12,
}
