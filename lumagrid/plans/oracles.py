"""The queries as SQL over the same tables, written independently of the DataFrame code."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _bytes(expr: str) -> str:
    return f"list_transform(regexp_extract_all(hex({expr}), '..'), lambda v: ('0x' || v)::INT)"


def _text_images(name: str, source: str, id_column: str) -> str:
    """CTEs ``{name}`` (image_id, width, height, b) and ``{name}_px`` for 32-wide text images."""
    return f"""{name}_raw AS (
  SELECT {id_column} AS image_id, {_bytes('encode(text)')} AS b FROM {source}),
{name} AS (
  SELECT image_id, 32 AS width, ((len(b) + 31) // 32)::INT AS height,
         list_resize(b, ((len(b) + 31) // 32) * 32, 0) AS b
  FROM {name}_raw WHERE len(b) > 0)"""


def _px(name: str) -> str:
    return f"""{name}_px AS (
  SELECT image_id, width, height, (pos % width)::INT AS x, (pos // width)::INT AS y, gray
  FROM (SELECT image_id, width, height, unnest(b) AS gray,
               generate_subscripts(b, 1) - 1 AS pos FROM {name}))"""


def _bins(name: str) -> str:
    return f"""{name}_bins AS (
  SELECT image_id, gray, count(*) AS n FROM {name}_px GROUP BY ALL)"""


def _dense(name: str) -> str:
    return f"""{name}_dense AS (
  SELECT i.image_id, string_agg(coalesce(n, 0)::VARCHAR, ',' ORDER BY g.gray) AS csv
  FROM (SELECT image_id FROM {name}) i CROSS JOIN (SELECT unnest(range(256))::INT AS gray) g
  LEFT JOIN {name}_bins h ON h.image_id = i.image_id AND h.gray = g.gray
  GROUP BY i.image_id)"""


DOC = _text_images("doc", "documents", "doc_id")
ITEM = _text_images("item", "benchmark", "item_id")
VEC = """vec AS (
  SELECT vec_id AS image_id, label, 8 AS width, 8 AS height,
         list_transform(embedding, lambda v: greatest(0, least(255,
           floor((v::DOUBLE + 0.5::DOUBLE) * 255.0::DOUBLE)::INT))) AS b
  FROM embeddings)"""
PLATE = f"""sheet AS (
  SELECT doc_id // 100 AS sheet, {_bytes("encode(string_agg(text, '' ORDER BY doc_id))")} AS b
  FROM documents GROUP BY doc_id // 100),
plate_cut AS (
  SELECT sheet, b, unnest(range((len(b) - 1) // 262144 + 1)) AS n FROM sheet),
plate AS (
  SELECT sheet * 1000000 + n AS image_id, 512 AS width, 512 AS height,
         list_resize(b[n * 262144 + 1 : (n + 1) * 262144], 262144, 0) AS b FROM plate_cut)"""
DOC_PX, DOC_BINS = _with(DOC, _px("doc")), _with(DOC, _px("doc"), _bins("doc"))
VEC_PX = _with(VEC, _px("vec"))

ORACLES["pixels"] = (
    DOC_PX
    + """SELECT image_id, width, height, count(*) AS pixels, sum(gray)::BIGINT AS gray_sum,
  sum(x * gray)::BIGINT AS x_sum, sum(y * gray)::BIGINT AS y_sum,
  sum((x + 1)::BIGINT * (y + 1) * gray * gray)::BIGINT AS spot_sum
FROM doc_px GROUP BY ALL"""
)

ORACLES["gray_from_rgb"] = (
    _with(
        f"""raw AS (SELECT doc_id AS image_id, {_bytes('encode(text)')} AS b FROM documents)""",
        """full_rows AS (SELECT image_id, list_resize(b, ((len(b) + 2) // 3) * 3, 0) AS b
  FROM raw WHERE len(b) > 0)""",
        """spots AS (SELECT image_id, b, unnest(range(0, len(b), 3)) AS i FROM full_rows)""",
    )
    + """SELECT image_id, trunc(0.299::DOUBLE * b[i + 1] + 0.587::DOUBLE * b[i + 2]
         + 0.114::DOUBLE * b[i + 3])::INT AS gray, count(*) AS n
FROM spots GROUP BY ALL"""
)

ORACLES["gray_lut"] = (
    _with(
        DOC,
        _px("doc"),
        """curve AS (SELECT v::INT AS v, round(255 * CASE WHEN v / 255.0::DOUBLE <= 0.0031308
      THEN 12.92 * (v / 255.0::DOUBLE)
      ELSE 1.055 * pow(v / 255.0::DOUBLE, 1 / 2.4::DOUBLE) - 0.055 END)::INT AS s
  FROM (SELECT unnest(range(256)) AS v))""",
        """shown AS (SELECT v, trunc(0.299::DOUBLE * s + 0.587::DOUBLE * s + 0.114::DOUBLE * s)::INT AS shown
  FROM curve)""",
    )
    + "SELECT image_id, shown, count(*) AS n FROM doc_px JOIN shown ON gray = v GROUP BY ALL"
)

ORACLES["histogram_bins"] = DOC_BINS + "SELECT * FROM doc_bins"
ORACLES["histogram_dense"] = (
    _with(DOC, _px("doc"), _bins("doc"), _dense("doc"))
    + "SELECT doc.image_id, width, height, csv FROM doc JOIN doc_dense USING (image_id)"
)
ORACLES["histogram_dense_from_bins"] = (
    _with(VEC, _px("vec"), _bins("vec"), _dense("vec")) + "SELECT image_id, csv FROM vec_dense"
)
ORACLES["histogram_summary"] = (
    DOC_PX
    + """SELECT image_id, width, height, count(*) AS total_pixels, count(DISTINCT gray)::INT AS used_grays
FROM doc_px GROUP BY ALL"""
)
ORACLES["histogram_detail"] = (
    _with(VEC, _px("vec"), _bins("vec"), _dense("vec"))
    + """SELECT image_id, 'Filename:' || image_id || chr(10) || 'Size:8x8' || chr(10)
  || 'Histogram:' || csv AS detail FROM vec_dense"""
)
ORACLES["hist_text_roundtrip"] = (
    _with(DOC, _px("doc"), _bins("doc"), _dense("doc")) + "SELECT image_id, csv FROM doc_dense"
)
ORACLES["hist_parse"] = (
    _with(VEC)
    + """, given AS (
  SELECT doc_id AS id, 'text' AS kind, text AS csv FROM documents
  UNION ALL SELECT image_id, 'short', array_to_string(b, ', ') FROM vec
  UNION ALL SELECT image_id, 'long', array_to_string(b || b || b || b || b, ', ') FROM vec),
parsed AS (
  SELECT id, kind, list_transform(string_split(csv, ','), lambda t: try_cast(trim(t) AS INT))[1:256] AS h
  FROM given WHERE regexp_full_match(csv, '[ 0-9,+-]*'))
SELECT id, kind, array_to_string(list_resize(h, 256, 0), ',') AS csv
FROM parsed WHERE len(list_filter(h, lambda v: v IS NULL)) = 0"""
)

ORACLES["hist_search"] = (
    _with(VEC, _px("vec"), _bins("vec"))
    + """, q AS (SELECT gray, n AS qn FROM vec_bins WHERE image_id = 0),
scored AS (
  SELECT image_id, sum(least(n, coalesce(qn, 0))) AS inter, sum(n) AS total
  FROM vec_bins LEFT JOIN q USING (gray) GROUP BY image_id)
SELECT image_id, inter::DOUBLE / (total + (SELECT sum(qn) FROM q) - inter)::DOUBLE AS similarity
FROM scored ORDER BY similarity DESC, image_id LIMIT 5"""
)


def _dense_search(images: str, name: str) -> str:
    return (
        _with(images, _px(name), _bins(name))
        + f""", q AS (SELECT gray, n AS qn FROM {name}_bins WHERE image_id = 0),
scored AS (
  SELECT image_id, sum(least(coalesce(n, 0), coalesce(qn, 0))) AS low,
         sum(greatest(coalesce(n, 0), coalesce(qn, 0))) AS high
  FROM (SELECT i.image_id, g.gray, n, qn
        FROM (SELECT image_id FROM {name}) i CROSS JOIN (SELECT unnest(range(256))::INT AS gray) g
        LEFT JOIN {name}_bins h ON h.image_id = i.image_id AND h.gray = g.gray
        LEFT JOIN q ON q.gray = g.gray)
  GROUP BY image_id)
SELECT image_id, low::DOUBLE / high::DOUBLE AS similarity
FROM scored ORDER BY similarity DESC, image_id LIMIT 5"""
    )


ORACLES["hist_search_dense"] = _dense_search(DOC, "doc")
ORACLES["hist_search_stored"] = _dense_search(DOC, "doc")
ORACLES["search_plates"] = _dense_search(PLATE, "plate")
ORACLES["histogram_plates"] = (
    _with(PLATE, _px("plate"), _bins("plate"), _dense("plate")) + "SELECT image_id, csv FROM plate_dense"
)
ORACLES["hist_search_multi"] = (
    _with(DOC, _px("doc"), _bins("doc"), ITEM, _px("item"), _bins("item"))
    + """, sizes AS (SELECT image_id, sum(n) AS total FROM doc_bins GROUP BY image_id),
asked AS (SELECT image_id AS query_id, sum(n) AS qtotal FROM item_bins GROUP BY image_id),
shared AS (
  SELECT q.image_id AS query_id, d.image_id, sum(least(d.n, q.n)) AS inter
  FROM doc_bins d JOIN item_bins q USING (gray) GROUP BY ALL),
scored AS (
  SELECT query_id, image_id,
    coalesce(inter, 0)::DOUBLE / (total + qtotal - coalesce(inter, 0))::DOUBLE AS similarity
  FROM asked CROSS JOIN sizes LEFT JOIN shared USING (query_id, image_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, image_id)::INT AS rank
  FROM scored)
SELECT query_id, image_id, similarity, rank FROM ranked WHERE rank <= 5"""
)



def _cluster_rounds(rounds: int) -> str:
    """Assignments and centres by turns, from the seeds in ``centre0``."""
    near = """SELECT p.image_id, c.cluster, any_value(pp) - 2 * sum(p.v * c.v) + any_value(cc) AS gap
  FROM point p JOIN norm USING (image_id) JOIN {c} c USING (bin)
  JOIN (SELECT cluster, sum(v * v) AS cc FROM {c} GROUP BY cluster) USING (cluster)
  GROUP BY p.image_id, c.cluster QUALIFY row_number() OVER (PARTITION BY p.image_id ORDER BY gap, cluster) = 1"""
    steps = []
    for r in range(rounds):
        steps.append(f"near{r} AS MATERIALIZED ({near.format(c=f'centre{r}')})")
        steps.append(f"""centre{r + 1} AS MATERIALIZED (
  SELECT cluster, bin, sum(v) // count(*) AS v FROM near{r} JOIN point USING (image_id) GROUP BY cluster, bin
  UNION ALL SELECT * FROM centre{r} WHERE cluster NOT IN (SELECT cluster FROM near{r}))""")
    steps.append(f"last AS ({near.format(c=f'centre{rounds}')})")
    return ",\n".join(steps)


ORACLES["content_clusters"] = (
    _with(
        DOC,
        _px("doc"),
        _bins("doc"),
        """point AS MATERIALIZED (
  SELECT i.image_id, g.bin, coalesce(n, 0)::HUGEINT * 65536 // len(b) AS v
  FROM doc i CROSS JOIN (SELECT unnest(range(256))::INT AS bin) g
  LEFT JOIN doc_bins h ON h.image_id = i.image_id AND h.gray = g.bin)""",
        "norm AS MATERIALIZED (SELECT image_id, sum(v * v) AS pp FROM point GROUP BY image_id)",
        """seed AS MATERIALIZED (
  SELECT csv, row_number() OVER (ORDER BY md5(csv)) - 1 AS cluster FROM (
    SELECT DISTINCT string_agg(v::VARCHAR, ',' ORDER BY bin) AS csv FROM point GROUP BY image_id)
  QUALIFY cluster < 8)""",
        """centre0 AS MATERIALIZED (
  SELECT cluster, generate_subscripts(string_split(csv, ','), 1) - 1 AS bin,
    unnest(string_split(csv, ','))::HUGEINT AS v FROM seed)""",
        _cluster_rounds(4),
    )
    + "SELECT image_id, cluster::INT AS cluster, gap::BIGINT AS distance FROM last"
)

_FOLDED = """, hists AS (
  SELECT image_id, string_agg(gray || ':' || n, ',' ORDER BY gray) AS h, sum(n) AS total
  FROM doc_bins GROUP BY image_id),
keepers AS (SELECT h, min(image_id) AS keeper, count(*) AS copies, any_value(total) AS total
  FROM hists GROUP BY h)"""
_PAIRS = """, kept AS (SELECT k.keeper AS id, copies, total, gray, n
  FROM keepers k JOIN doc_bins b ON b.image_id = k.keeper),
shared AS (
  SELECT a.id AS a, b.id AS b, any_value(a.copies) AS a_copies, any_value(b.copies) AS b_copies,
    any_value(a.total) AS asize, any_value(b.total) AS bsize, sum(least(a.n, b.n)) AS inter
  FROM kept a JOIN kept b ON a.gray = b.gray AND a.id < b.id GROUP BY a.id, b.id),
pairs AS MATERIALIZED (
  SELECT a, b, inter::DOUBLE / (asize + bsize - inter)::DOUBLE AS similarity, a_copies, b_copies
  FROM shared WHERE inter::DOUBLE / (asize + bsize - inter)::DOUBLE > 0.98::DOUBLE)"""
ORACLES["duplicate_pairs"] = DOC_BINS + _FOLDED + _PAIRS + " SELECT * FROM pairs"
ORACLES["duplicate_families"] = (
    DOC_BINS
    + _FOLDED
    + _PAIRS
    + """,
links AS MATERIALIZED (SELECT a AS u, b AS v FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (
  SELECT DISTINCT u, u AS root FROM links
  UNION SELECT links.v, root FROM reached JOIN links USING (u)),
family AS (SELECT u, min(root) AS family FROM reached GROUP BY u),
counted AS (SELECT u, count(*) AS links FROM links GROUP BY u)
SELECT keeper AS image_id, copies, coalesce(family, keeper) AS family, coalesce(links, 0) AS links
FROM keepers LEFT JOIN family ON family.u = keeper LEFT JOIN counted ON counted.u = keeper"""
)
ORACLES["duplicate_copies"] = (
    DOC_BINS
    + _FOLDED
    + " SELECT image_id, keeper FROM hists JOIN keepers USING (h) WHERE image_id <> keeper"
)


def _windows(mode: str, threshold: str) -> str:
    near = "abs(gray - fg) < 5" if mode == "score" else "abs(gray - fg) <= 5"
    return (
        _with(
            DOC,
            _px("doc"),
            """feature AS (
  SELECT 0 AS feature_id, x - 8 AS fx, y - 4 AS fy, gray AS fg, 6 AS fw, 4 AS fh
  FROM doc_px WHERE image_id = 0 AND x BETWEEN 8 AND 13 AND y BETWEEN 4 AND 7
  UNION ALL
  SELECT 1, x, y, gray, 8, 3 FROM doc_px WHERE image_id = 0 AND x < 8 AND y < 3)""",
            f"""window_sums AS (
  SELECT feature_id::BIGINT AS feature_id, image_id, (x - fx)::INT AS x, (y - fy)::INT AS y,
    count_if({near})::BIGINT AS matching, sum(abs(gray - fg)) AS diff
  FROM doc_px JOIN feature ON x - fx BETWEEN 0 AND width - fw AND y - fy BETWEEN 0 AND height - fh
  GROUP BY ALL)""",
            f"""hits AS (
  SELECT feature_id, image_id, x, y, matching, (matching::DOUBLE / 24.0::DOUBLE
    + (1.0::DOUBLE - diff::DOUBLE / 24.0::DOUBLE / 255.0::DOUBLE)) / 2.0::DOUBLE AS similarity
  FROM window_sums)""",
            f"""found AS (SELECT * FROM hits WHERE {
                f"similarity >= {threshold}::DOUBLE" if mode == "score" else f"matching >= trunc(24 * {threshold}::DOUBLE)"
            })""",
        )
    )


ORACLES["feature_search_many"] = (
    _with(
        DOC,
        ITEM,
        "template AS (SELECT image_id AS feature_id, b[1:30] AS f FROM item)",
        """doc_line AS (
  SELECT image_id, y, b[y * 32 + 1 : y * 32 + 32] AS line
  FROM (SELECT image_id, b, unnest(range(height)) AS y FROM doc))""",
        "place AS (SELECT image_id, y, x, line[x + 1 : x + 30] AS w FROM doc_line, (SELECT unnest(range(3)) AS x))",
        """gaps AS (
  SELECT feature_id, image_id, x, y, list_transform(list_zip(w, f), lambda z: abs(z[1] - z[2])) AS gap
  FROM place CROSS JOIN template)""",
        """scored AS (
  SELECT feature_id, image_id, x, y, len(list_filter(gap, lambda g: g < 5))::BIGINT AS matching, list_sum(gap) AS diff FROM gaps)""",
    )
    + """SELECT * FROM (
  SELECT feature_id, image_id, x::INT AS x, y::INT AS y, (matching::DOUBLE / 30.0::DOUBLE
    + (1.0::DOUBLE - diff::DOUBLE / 30.0::DOUBLE / 255.0::DOUBLE)) / 2.0::DOUBLE AS similarity, matching FROM scored)
WHERE similarity >= 0.95::DOUBLE"""
)


_COUNTED = """SELECT feature_id, image_id, count(*) AS match_count, max(similarity) AS best
FROM found GROUP BY feature_id, image_id"""
ORACLES["feature_search"] = (
    _windows("score", "0.95") + "SELECT feature_id, image_id, x, y, similarity FROM found"
)
ORACLES["feature_images"] = _windows("score", "0.95") + _COUNTED
ORACLES["feature_images_all"] = _windows("score", "0.95") + f"""
SELECT f.feature_id::BIGINT AS feature_id, doc.image_id, coalesce(match_count, 0) AS match_count, best
FROM doc CROSS JOIN (SELECT DISTINCT feature_id FROM feature) f
LEFT JOIN ({_COUNTED}) c ON c.image_id = doc.image_id AND c.feature_id = f.feature_id"""
ORACLES["feature_locations"] = _windows("score", "0.95") + """
SELECT feature_id, image_id, string_agg('(' || x || ',' || y || ')', ' ' ORDER BY y, x) AS locations
FROM found GROUP BY feature_id, image_id"""
ORACLES["feature_first"] = _windows("score", "0.95") + f"""
SELECT * EXCLUDE (place, total), greatest(total - 5, 0) AS more FROM (
  SELECT *, row_number() OVER (PARTITION BY feature_id ORDER BY image_id) AS place,
    count(*) OVER (PARTITION BY feature_id) AS total FROM ({_COUNTED}) c) WHERE place <= 5"""
ORACLES["feature_search_count"] = (
    _windows("count", "0.9")
    + "SELECT feature_id, image_id, count(*) AS match_count FROM found GROUP BY ALL"
)
ORACLES["watermark_images"] = (
    _windows("score", "0.98")
    + "SELECT feature_id, image_id, count(*) AS match_count FROM found GROUP BY ALL"
)


def _tampered(images: str, px: str, suspects: str, exclude_self: bool = True) -> str:
    """CTEs of the comparison: ``compared``, ``blocks``, ``bad`` and ``ranked``."""
    self_test = "AND l.image_id <> s.suspect_id" if exclude_self else ""
    return _with(
        images,
        _px(px),
        f"suspects AS ({suspects})",
        f"""compared AS (
  SELECT s.suspect_id, l.image_id, l.width, l.height, l.x, l.y, abs(l.gray - s.gray) > 20 AS differs
  FROM {px}_px l JOIN suspects s
    ON l.width = s.width AND l.height = s.height AND l.x = s.x AND l.y = s.y {self_test})""",
        """blocks AS (
  SELECT suspect_id, image_id, width, height, (x // 16)::INT AS bx, (y // 16)::INT AS "by",
    count_if(differs)::BIGINT AS diff, count(*) AS pixels
  FROM compared GROUP BY ALL)""",
        """bad AS (
  SELECT suspect_id, image_id, bx, "by", bx * 16 AS start_x, "by" * 16 AS start_y,
    least(bx * 16 + 16, width) - 1 AS end_x, least("by" * 16 + 16, height) - 1 AS end_y,
    diff AS pixel_count
  FROM blocks WHERE diff > 0.3::DOUBLE * pixels)""",
        """ranked AS (
  SELECT suspect_id, image_id, sum(pixels - diff)::BIGINT AS matching_pixels,
    sum(pixels)::BIGINT AS total_pixels,
    sum(pixels - diff)::DOUBLE / sum(pixels)::DOUBLE AS similarity
  FROM blocks GROUP BY ALL)""",
    )


_PLAIN = "SELECT image_id AS suspect_id, width, height, x, y, gray FROM {}_px WHERE image_id = 0"
_PLANTED = (
    _PLAIN.format("doc")
    + """ UNION ALL SELECT -1, width, height, x, y,
    CASE WHEN x BETWEEN 4 AND 11 AND y BETWEEN 16 AND 27 THEN (gray + 128) % 256 ELSE gray END
  FROM doc_px WHERE image_id = 0"""
)
_DOC_BOTH = _tampered(DOC, "doc", _PLANTED)
ORACLES["tamper_pixels"] = _DOC_BOTH + "SELECT suspect_id, image_id, x, y, differs FROM compared"
ORACLES["tamper_blocks"] = _DOC_BOTH + 'SELECT suspect_id, image_id, bx, "by", diff, pixels FROM blocks'
ORACLES["tamper_regions"] = (
    _DOC_BOTH + "SELECT suspect_id, image_id, start_x, start_y, end_x, end_y, pixel_count FROM bad"
)
_RANKED = "SELECT image_id, matching_pixels, total_pixels, similarity FROM ranked"
ORACLES["tamper_rank"] = _tampered(PLATE, "plate", _PLAIN.format("plate")) + _RANKED
ORACLES["tamper_rank_pixels"] = _tampered(VEC, "vec", _PLAIN.format("vec")) + _RANKED
ORACLES["tamper_report"] = (
    _tampered(DOC, "doc", _PLANTED, False)
    + """, best AS (
  SELECT *, row_number() OVER (PARTITION BY suspect_id ORDER BY matching_pixels DESC, image_id)::INT AS rank
  FROM ranked),
listed AS (
  SELECT *, row_number() OVER (PARTITION BY suspect_id, image_id
    ORDER BY pixel_count DESC, start_y, start_x) AS place FROM bad),
told AS (
  SELECT suspect_id, image_id, count(*)::INT AS region_count,
    string_agg(concat_ws(',', start_x, start_y, end_x, end_y, pixel_count), ';' ORDER BY place)
      FILTER (place <= 5) AS regions_top
  FROM listed GROUP BY ALL)
SELECT suspect_id, image_id, rank, matching_pixels, total_pixels, similarity,
  coalesce(region_count, 0) AS region_count,
  greatest(coalesce(region_count, 0) - 5, 0) AS regions_more, coalesce(regions_top, '') AS regions_top
FROM best LEFT JOIN told USING (suspect_id, image_id) WHERE rank <= 3"""
)
ORACLES["tamper_best_per_key"] = (
    _tampered(DOC, "doc", _PLANTED)
    + "SELECT image_id, max(matching_pixels) AS matching_pixels FROM ranked GROUP BY image_id"
)
_MERGED = """, reach AS (
  SELECT suspect_id, image_id, bx, "by", "by" * 100000 + bx AS label FROM bad
  UNION
  SELECT n.suspect_id, n.image_id, n.bx, n."by", r.label
  FROM reach r JOIN bad n ON n.suspect_id = r.suspect_id AND n.image_id = r.image_id
    AND abs(n.bx - r.bx) + abs(n."by" - r."by") = 1),
grouped AS (
  SELECT suspect_id, image_id, bx, "by", min(label) AS label FROM reach GROUP BY ALL)
SELECT suspect_id, image_id, min(start_x) AS start_x, min(start_y) AS start_y,
  max(end_x) AS end_x, max(end_y) AS end_y, sum(pixel_count)::BIGINT AS pixel_count
FROM grouped JOIN bad USING (suspect_id, image_id, bx, "by")
GROUP BY suspect_id, image_id, label"""
ORACLES["tamper_regions_merged"] = _tampered(DOC, "doc", _PLANTED, False) + _MERGED
_ITEMS = _tampered(
    ",\n".join((DOC, ITEM, _px("item"))),
    "doc",
    "SELECT image_id AS suspect_id, width, height, x, y, gray FROM item_px",
    False,
)
ORACLES["tamper_regions_banded"] = _ITEMS + _MERGED
ORACLES["tamper_rank_many"] = _ITEMS + """SELECT r.*, coalesce(n, 0)::INT AS region_count FROM ranked r
LEFT JOIN (SELECT suspect_id, image_id, count(*) AS n FROM bad GROUP BY ALL) b
  ON b.suspect_id = r.suspect_id AND b.image_id = r.image_id"""
ORACLES["tamper_percent"] = (
    _tampered(DOC, "doc", _PLANTED, False)
    + "SELECT suspect_id, image_id, printf('%.2f%%', similarity * 100) AS share FROM ranked"
)
ORACLES["export_results"] = (
    _DOC_BOTH
    + """, told AS (SELECT suspect_id, image_id, count(*)::INT AS region_count FROM bad GROUP BY ALL)
SELECT suspect_id, image_id, matching_pixels, similarity, coalesce(region_count, 0) AS region_count
FROM ranked LEFT JOIN told USING (suspect_id, image_id)"""
)

_DOC_SIZES = "SELECT image_id, width, height, len(b)::BIGINT AS pixels FROM doc"
_VEC_SIZES = "SELECT image_id, width, height, 64::BIGINT AS pixels FROM vec"
ORACLES["batch_ingest"] = _with(DOC) + _DOC_SIZES
ORACLES["stream_ingest"] = _with(DOC) + _DOC_SIZES
ORACLES["hist_scan"] = ORACLES["histogram_dense"]
ORACLES["image_upsert"] = (
    _with(DOC, VEC)
    + f"{_VEC_SIZES} UNION ALL {_DOC_SIZES} WHERE image_id NOT IN (SELECT image_id FROM vec)"
)
ORACLES["image_last_write"] = (
    _with(
        DOC,
        """written AS (
  SELECT 2 AS batch, image_id // 2 AS key, * FROM doc UNION ALL SELECT 3, image_id // 3, * FROM doc)""",
    )
    + """SELECT key AS image_id, width, height, len(b)::BIGINT AS pixels FROM written
QUALIFY row_number() OVER (PARTITION BY key ORDER BY batch DESC, image_id DESC) = 1"""
)
ORACLES["image_last_write_all"] = (
    _with(DOC)
    + """SELECT image_id // 2 AS image_id, width, height, len(b)::BIGINT AS pixels FROM doc
QUALIFY row_number() OVER (PARTITION BY image_id // 2 ORDER BY image_id % 3 <> 0 DESC, image_id DESC) = 1"""
)
ORACLES["image_delete"] = (
    _with(DOC) + f"{_DOC_SIZES} WHERE image_id NOT IN (SELECT doc_id FROM labels)"
)
ORACLES["image_get"] = (
    _with(DOC)
    + """SELECT image_id, width, height,
  array_to_string(list_transform(b, lambda v: printf('%02X', v)), '') AS gray FROM doc WHERE image_id = 7"""
)
ORACLES["image_get_many"] = (
    _with(
        DOC,
        """asked AS (SELECT doc_id AS image_id FROM labels UNION SELECT -doc_id - 1 FROM labels),
kept AS (SELECT * FROM doc WHERE image_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0))""",
    )
    + """SELECT a.image_id, k.image_id IS NOT NULL AS found, width, height, len(b)::BIGINT AS pixels
FROM asked a LEFT JOIN kept k ON k.image_id = a.image_id"""
)
ORACLES["image_exists"] = "SELECT count(*) > 0 AS has_images FROM documents WHERE text <> ''"
ORACLES["image_count"] = "SELECT count(*) AS images FROM documents WHERE text <> ''"
ORACLES["pack_images"] = (
    _with(DOC)
    + """SELECT image_id, width, height,
  md5(unhex(array_to_string(list_transform(b, lambda v: printf('%02X', v)), ''))) AS digest FROM doc"""
)
_UNION = """SELECT image_id, width, height, 'table' AS source FROM vec
UNION ALL SELECT image_id, width, height, 'files' FROM doc
WHERE image_id NOT IN (SELECT image_id FROM vec)"""
ORACLES["library_union"] = _with(DOC, VEC) + _UNION
ORACLES["library_status"] = (
    _with(DOC, VEC) + f"SELECT source, count(*) AS images FROM ({_UNION}) GROUP BY source"
)
ORACLES["library_join"] = (
    _with(DOC, VEC)
    + "SELECT doc.image_id, doc.width, doc.height FROM doc JOIN vec ON doc.image_id = vec.image_id"
)
ORACLES["library_list"] = (
    _with(DOC)
    + """SELECT image_id, width, height, (SELECT greatest(count(*) - 20, 0) FROM doc) AS more
FROM doc ORDER BY image_id LIMIT 20"""
)
ORACLES["processed_images"] = "SELECT DISTINCT conv_id AS image_id FROM conversations"

ORACLES["scan_images"] = (
    _with(VEC, _px("vec"))
    + """SELECT image_id, width, height, x, y,
  trunc(0.299::DOUBLE * gray + 0.587::DOUBLE * gray + 0.114::DOUBLE * gray)::INT AS gray
FROM vec_px WHERE image_id IN (SELECT vec_id FROM embeddings WHERE label <> 0)"""
)
ORACLES["decode_rejects"] = "SELECT vec_id AS image_id FROM embeddings WHERE label = 0"
ORACLES["ingest_counters"] = """SELECT CASE WHEN label = 0 THEN 'failed to read' ELSE 'processed' END AS status,
  count(*) AS images FROM embeddings GROUP BY ALL"""

LOG = """task_log AS (
  SELECT event_id AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
    'TASK_' || user_id || '_' || day(ts) AS task_id, event_type AS task_type,
    CASE WHEN event_type IN ('view', 'click') THEN 'STARTED' WHEN event_type = 'error' THEN 'FAILED'
      ELSE 'COMPLETED' END AS status, props AS details, value, ts AS moment
  FROM events),
latest AS (
  SELECT * FROM task_log QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY seq DESC) = 1)"""
ORACLES["batch_upload"] = ORACLES["ingest_counters"]
ORACLES["log_roundtrip"] = (
    _with(LOG) + "SELECT seq, ts, task_id, task_type, status, details FROM task_log"
)
ORACLES["log_parse"] = (
    _with(LOG)
    + """SELECT seq, ts, task_id, task_type, status,
  CASE WHEN task_type = 'view' THEN 'a|' || details ELSE details END AS details
FROM task_log WHERE task_type <> 'signup' AND NOT (task_type = 'error' AND value > 50)"""
)
ORACLES["log_rejects"] = (
    _with(LOG)
    + """SELECT seq, concat_ws('|', ts, task_id, task_type, 'PAUSED', details) AS line,
  'unknown status' AS reason FROM task_log WHERE task_type = 'signup'
UNION ALL SELECT seq, concat_ws('|', ts, task_id, task_type), 'too few parts'
FROM task_log WHERE task_type = 'error' AND value > 50"""
)
ORACLES["log_plain_latest"] = _with(LOG) + "SELECT task_id, task_type, status, details FROM latest"
ORACLES["log_latest"] = _with(LOG) + "SELECT task_id, status FROM latest"
ORACLES["log_incomplete"] = (
    _with(LOG) + "SELECT task_id, status FROM latest WHERE status = 'STARTED'"
)
ORACLES["log_redo"] = (
    _with(LOG) + "SELECT task_id, task_type, details FROM latest WHERE status = 'STARTED'"
)
ORACLES["log_summary"] = (
    _with(LOG)
    + """SELECT count(*) AS total, count_if(status = 'STARTED')::BIGINT AS started,
  count_if(status = 'COMPLETED')::BIGINT AS completed, count_if(status = 'FAILED')::BIGINT AS failed,
  (SELECT count(*) FROM latest WHERE status = 'STARTED') AS open FROM task_log"""
)
ORACLES["log_tail"] = (
    _with(LOG)
    + """SELECT seq, ts, task_id, task_type, status, details,
  (SELECT greatest(count(*) - 20, 0) FROM task_log) AS earlier
FROM task_log ORDER BY seq DESC LIMIT 20"""
)
ORACLES["stream_open_tasks"] = (
    _with(LOG)
    + """SELECT task_id, moment AS started, moment + INTERVAL 30 MINUTE AS deadline FROM latest WHERE status = 'STARTED'
  AND epoch_ms(moment + INTERVAL 90 MINUTE) <= (SELECT epoch_ms(max(moment)) FROM task_log)"""
)

ACCESS = """access_log AS (
  SELECT event_id AS seq, ts, 'SEARCH_' || user_id AS result_key,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'put' ELSE 'get' END AS op FROM events),
stats AS (
  SELECT result_key, max(ts) AS last_access, count(*) AS accesses,
    max(ts) FILTER (op = 'put') AS last_put FROM access_log GROUP BY result_key)"""
_RECENT = "ORDER BY last_access DESC, result_key LIMIT 20"
ORACLES["access_stats"] = _with(ACCESS) + "SELECT * FROM stats"
ORACLES["recent_results"] = (
    _with(ACCESS) + f"SELECT result_key, last_access, accesses FROM stats {_RECENT}"
)
ORACLES["recent_results_live"] = (
    _with(ACCESS)
    + f"""SELECT result_key, last_access, coalesce(
  (SELECT max(ts) FROM access_log) - last_put >= INTERVAL 3600 SECOND, TRUE) AS expired
FROM stats {_RECENT}"""
)
_REUSED = """SELECT seq, result_key, ts,
  coalesce(epoch_us(ts) - epoch_us(written) < 3600000000, false) AS hit FROM (
  SELECT *, last_value(CASE WHEN op = 'put' THEN ts END IGNORE NULLS) OVER (
    PARTITION BY result_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS written
  FROM access_log) WHERE op = 'get'"""
ORACLES["result_reuse"] = _with(ACCESS) + _REUSED
ORACLES["result_reuse_pieces"] = ORACLES["result_reuse"]
ORACLES["result_misses"] = (
    _with(ACCESS) + f"SELECT result_key, count(*) AS requests FROM ({_REUSED}) WHERE NOT hit GROUP BY result_key"
)
ORACLES["result_preview"] = """SELECT doc_id,
  CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS preview FROM documents"""
ORACLES["result_keys"] = """SELECT doc_id, 'SEARCH_' || doc_id AS search_key,
  'LOCAL_' || doc_id || '_0.95' AS local_key, 'TAMPER_' || doc_id || '_20' AS tamper_key FROM documents"""
