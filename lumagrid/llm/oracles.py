"""DuckDB SQL with the same rows as the queries of this subpackage."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5 = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_window AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(10, len(w)) AS size,
           array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
    FROM item, unnest(range(1, 2 + greatest(len(w), 10) - 10)) AS t(i)
    WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
    FROM doc CROSS JOIN sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
),
hit AS (
    SELECT d.doc_id, d.i, d.size, t.item_id
    FROM doc_window d JOIN item_window t ON d.size = t.size AND d.words = t.words
),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP8 = """
WITH usable AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
component AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS d FROM usable),
score AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(sum(q.x * r.x) AS BIGINT) AS score
    FROM component q JOIN component r ON q.d = r.d AND q.vec_id <> r.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY ALL
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM score
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP10 = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM doc, unnest(range(1, 2 + greatest(len(w), 5) - 5)) AS t(i) WHERE len(w) > 0
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
link AS (
    SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 100 * shared >= 85 * (p.n + q.n - shared)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM doc
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN component USING (doc_id)
"""



def _codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds as a chain of tables: book0, then pick1 (nearest entries) and book1 (their floored means), and so on."""

    def pick(n: int, book: str) -> str:
        return f"""pick{n} AS MATERIALIZED (
    SELECT v, vec_id, part, v_part, min(struct_pack(d := d, entry := entry)) AS best
    FROM (SELECT k.v, k.vec_id, k.part, k.v_part, b.entry,
                 list_sum(list_transform(list_zip(k.v_part, b.value), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
          FROM piece k JOIN {book} b USING (part))
    GROUP BY v, vec_id, part, v_part
)"""

    def moved(n: int) -> str:
        return f"""mean{n} AS (
    SELECT part, entry, list(m ORDER BY pos) AS value
    FROM (SELECT part, best.entry AS entry, pos, CAST(floor(sum(v_part[pos]) / count(*)) AS BIGINT) AS m
          FROM pick{n}, unnest(range(1, len(v_part) + 1)) AS t(pos) GROUP BY part, best.entry, pos)
    GROUP BY part, entry
),
book{n} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.value, b.value) AS value
    FROM book{n - 1} b LEFT JOIN mean{n} m USING (part, entry)
)"""

    chain = ",\n".join(f"{pick(n, f'book{n - 1}')},\n{moved(n)}" for n in range(1, rounds + 1))
    return f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS v, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS value
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
),
piece AS MATERIALIZED (
    SELECT v, vec_id, part, value[part * len(value) // {parts} + 1 : (part + 1) * len(value) // {parts}] AS v_part
    FROM kept, unnest(range({parts})) AS t(part)
),
book0 AS MATERIALIZED (SELECT part, v - 1 AS entry, v_part AS value FROM piece WHERE v <= {entries}),
{chain},
{pick(rounds + 1, f"book{rounds}")},
coded AS (
    SELECT v, vec_id, string_agg(printf('%02x', CAST(best.entry AS INTEGER)), '' ORDER BY part) AS code,
           CAST(sum(best.d) AS BIGINT) AS error
    FROM pick{rounds + 1} GROUP BY v, vec_id
),
book AS (
    SELECT sha256(string_agg(array_to_string(value, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
),
labelled AS (SELECT c.*, k.label FROM coded c JOIN kept k USING (v)),
by_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM labelled GROUP BY label)
SELECT l.vec_id, l.code, l.error, b.label_error, book.codebooks_sha256
FROM labelled l JOIN by_label b ON l.label IS NOT DISTINCT FROM b.label CROSS JOIN book
"""


LLM_ORACLES: dict[str, str] = {
    "op5_decontamination": OP5,
    "op8_topk": OP8,
    "op10_minhash": OP10,
    "op12_codes": _codes(),
}
