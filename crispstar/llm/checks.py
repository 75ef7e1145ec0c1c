"""The results of the queries that SQL can express, as DuckDB statements."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"

_EXACT = rf"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

_SUBSTRING = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
w AS (
    SELECT doc_id, i, array_to_string(list_slice(words, i, i + 34), ' ') AS seq
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)
),
hit AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY seq) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM hit, range(35) AS r(o)),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
stay AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept
    FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN stay USING (doc_id)
"""

_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
) WHERE rank <= 5
"""


def _apportioned(name: str, source: str, group: str, party: str, votes: str, seats: str) -> str:
    """Sainte-Lague by ranking every quotient of every party."""
    return f"""
{name}_seat AS (
    SELECT {group}, {party}, row_number() OVER (PARTITION BY {group} ORDER BY {votes} / (2 * h + 1) DESC, {party} NULLS LAST) AS place,
           {seats} AS seats
    FROM {source}, LATERAL (SELECT unnest(range(0, {seats} + 1)) AS h) WHERE {votes} > 0
),
{name} AS (SELECT {group}, {party}, count(*) AS quota FROM {name}_seat WHERE place <= seats GROUP BY ALL)"""


_NUMBER = "('0x' || substr({}, 1, 7))::BIGINT"
_DRAWS = """CASE WHEN {0} = 0 THEN 0 ELSE
    sh[(({0} * 16 - 1) // n + 1)::INTEGER].earlier + rounds * ({0} - sh[(({0} * 16 - 1) // n + 1)::INTEGER].lo)
    + (({0} - sh[(({0} * 16 - 1) // n + 1)::INTEGER].lo)::HUGEINT * sh[(({0} * 16 - 1) // n + 1)::INTEGER].extra
       + sh[(({0} * 16 - 1) // n + 1)::INTEGER].start) // sh[(({0} * 16 - 1) // n + 1)::INTEGER].nb
    - sh[(({0} * 16 - 1) // n + 1)::INTEGER].start // sh[(({0} * 16 - 1) // n + 1)::INTEGER].nb END"""


def _words_upto(word: str) -> str:
    whole, after = _DRAWS.format(f"({word} // 64)"), _DRAWS.format(f"({word} // 64 + 1)")
    return f"(({whole}) * 64 + CASE WHEN {word} % 64 = 0 THEN 0 ELSE (({after}) - ({whole})) * ({word} % 64) END)"


_MIX = rf"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
           md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS salt
    FROM documents
),
so AS (
    SELECT 0 AS every, source, source_size, 3.0::DOUBLE * source_size AS lim,
           ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
    FROM (SELECT coalesce(source, chr(1114111)) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL)
),
ra AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS rate
    FROM so WINDOW b AS (ORDER BY lim / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
fr AS (SELECT arg_min(rate, lim / weight) AS free FROM ra WHERE lim > weight * rate),
ta AS (SELECT every, source, source_size, CASE WHEN lim <= weight * rate THEN lim ELSE weight * (SELECT free FROM fr) END AS target FROM ra),
tb AS (SELECT *, floor(sum(target) OVER () / 64 + 0.5)::BIGINT AS seats FROM ta),
{_apportioned("qs", "tb", "every", "source", "target", "seats")},
wa AS (
    SELECT ta.*, ceil(source_size / 64)::BIGINT AS n, CASE WHEN quota > 0 AND source_size >= 64 THEN quota * 64.0::DOUBLE ELSE target END AS wanted
    FROM ta LEFT JOIN qs USING (source) WHERE source_size > 0
),
ro AS (SELECT *, least(floor(wanted / source_size), 3)::BIGINT AS rounds FROM wa),
re AS (
    SELECT *, CASE WHEN rounds < 3 THEN least(greatest(floor((wanted - rounds * source_size) / least(source_size, 64) + 0.5), 0), n) ELSE 0 END::BIGINT AS rest
    FROM ro
),
st AS (SELECT *, shard * n // 16 AS lo, (shard + 1) * n // 16 - shard * n // 16 AS nb FROM re, (SELECT unnest(range(0, 16)) AS shard)),
{_apportioned("qd", "st", "source", "shard", "nb", "rest")},
sh AS (
    SELECT source, any_value(n) AS n, any_value(rounds) AS rounds, list({{'lo': lo, 'nb': nb, 'extra': extra, 'earlier': earlier, 'start': start}} ORDER BY shard) AS sh
    FROM (SELECT st.*, coalesce(quota, 0) AS extra, coalesce(sum(rounds * nb + coalesce(quota, 0)) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier,
                 CASE WHEN nb > 0 THEN {_NUMBER.format("md5(concat_ws(':', 'mix', nullif(source, chr(1114111)), shard::VARCHAR))")} % nb ELSE 0 END AS start
          FROM st LEFT JOIN qd USING (source, shard))
    GROUP BY source
),
po AS (
    SELECT doc_id, size, coalesce(source, chr(1114111)) AS source,
           sum(size) OVER (PARTITION BY source ORDER BY salt, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e
    FROM d
)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN {_words_upto("e")} - {_words_upto("(e - size)")} ELSE 0 END::BIGINT AS taken
FROM po JOIN ta USING (source) LEFT JOIN sh USING (source)
"""

# The unsigned CRC-32 of a short ASCII text, byte by byte and bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda r, b: list_reduce(list_concat([xor(r, b)], range(8)), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def _counted(*values: str) -> str:
    """SQL for values put together, each with its length in bytes, NULL as a dash."""
    return " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values)


def _levels(name: str, leaves: str) -> str:
    """All levels above ``leaves(tree, pos, n, h)``."""
    return f"""
{name} AS (
    SELECT tree, 0 AS level, pos, n, h FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n
)"""


def _ways(name: str, levels: str, start: str) -> str:
    """Each row of ``start(row, tree, pos, folded, proof)`` on its way up."""
    return f"""
{name} AS (
    SELECT row, tree, 0 AS level, pos, folded, proof FROM {start}
    UNION ALL
    SELECT row, w.tree, w.level + 1, w.pos // 2,
           sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || folded WHEN s.h IS NULL THEN folded ELSE folded || s.h END), proof || coalesce(s.h, '')
    FROM {name} w JOIN {levels} me ON me.tree = w.tree AND me.level = w.level AND me.pos = w.pos AND me.n > 1
    LEFT JOIN {levels} s ON s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.pos, 1)
)"""


_MERKLE = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, lang, sha256({_counted("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
           CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0
                THEN sha256({_counted("doc_id", "source", "lang", "(n_chars + 1)", "text")}) END AS presented
    FROM documents
),
p AS (
    SELECT *, row_number() OVER () AS row, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
    FROM d
),
low AS (SELECT tree, pos, n, leaf AS h FROM p),{_levels("lv", "low")},
sub AS (SELECT tree, h FROM lv WHERE n = 1),
high AS (SELECT 0 AS tree, tree - 1 AS pos, count(*) OVER () AS n, h FROM sub),{_levels("tv", "high")},
beg AS (SELECT row, tree, pos, coalesce(presented, leaf) AS folded, '' AS proof FROM p),{_ways("wa", "lv", "beg")},
mid AS (SELECT row, 0 AS tree, w.tree - 1 AS pos, folded, proof FROM wa w JOIN lv USING (tree, level) WHERE lv.n = 1),{_ways("wb", "tv", "mid")}
SELECT doc_id, leaf, sub.h AS subroot, tv.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = tv.h AS verified
FROM wb JOIN tv ON tv.n = 1 AND tv.level = wb.level JOIN p USING (row) JOIN sub ON sub.tree = p.tree
"""

_TRIE = f"""
WITH t AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i,
           {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
    FROM conversations WHERE conv_id IS NOT NULL
),
o AS (SELECT c, list(said ORDER BY i) AS said, {_CRC32.format("c::VARCHAR")} % 9 AS h FROM t GROUP BY c),
r AS (SELECT o.c, list_concat(coalesce(list_slice(b.said, 1, o.h), []), list_slice(o.said, o.h + 1, len(o.said))) AS said FROM o LEFT JOIN o b ON b.c = o.c - o.c % 5),
p AS (SELECT c, d, list_slice(said, 1, d) AS prefix, d = len(said) AS ends, CASE WHEN d = 0 THEN 0 ELSE strlen(said[d].text) END AS size
      FROM (SELECT c, said, unnest(range(0, len(said) + 1)) AS d FROM r)),
n AS (SELECT min(c) AS c, d, prefix, count(*) AS n_convs, any_value(size) AS size,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY d, prefix),
l AS (SELECT n.*, up.c AS up FROM n LEFT JOIN n up ON n.d > 0 AND up.d = n.d - 1 AND up.prefix = list_slice(n.prefix, 1, n.d - 1)),
k AS (SELECT l.*, (SELECT count(*) FROM l x WHERE x.up = l.c AND x.d = l.d + 1) AS n_children FROM l),
s AS (SELECT a.c, a.d, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.size)::BIGINT AS saved_tokens
      FROM k u JOIN p ON p.c = u.c AND p.d <= u.d JOIN k a ON a.d = p.d AND a.prefix = p.prefix GROUP BY a.c, a.d)
SELECT c AS conv_id, d AS depth, up AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM k JOIN s USING (c, d)
"""

CHECKS: dict[str, str] = {
    "op3_exact_dedup": _EXACT,
    "op4_substring_dedup": _SUBSTRING,
    "op6_exact_top_k": _TOP_K,
    "op10_source_mixing": _MIX,
    "op11_merkle_manifest": _MERKLE,
    "op12_prefix_trie": _TRIE,
}
