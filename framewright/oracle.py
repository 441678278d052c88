"""SQL twins of the registered queries, for an engine with the same tables as views."""

from __future__ import annotations

_S = """s AS (
  SELECT user_id AS k, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS i,
    CAST(floor(value) AS BIGINT) AS v, event_type = 'error' AS m, event_type = 'purchase' AS hit, count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""
_F = """f AS (SELECT label AS k, vec_id, embedding, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS i FROM embeddings)"""
_G = (
    _F
    + """, u AS (SELECT k, i, vec_id, unnest(embedding) AS e, unnest(range(len(embedding))) AS pos FROM f),
g AS (SELECT k, i, vec_id, CAST(pos // 8 AS INTEGER) AS y, CAST(pos % 8 AS INTEGER) AS x,
  ((CAST(floor(CAST(e AS DOUBLE) * 256) AS BIGINT) % 256) + 256) % 256 AS v FROM u)"""
)
_WRAP = "sqrt(CAST((({a} - {b}) * ({a} - {b})) % 256 AS DOUBLE))"
_SIGN = _S + """, d AS (SELECT k, i, n, CAST(coalesce(abs(v - lag(v) OVER (PARTITION BY k ORDER BY i)) > 60, false) AS INTEGER) AS sign FROM s)"""
_BACK = "(n - 1 - i)"


def _hits(stride: int, most: int, no_start: str, no_end: str) -> str:
    return f"""WITH {_S} SELECT k,
  CAST(coalesce(min(i) FILTER (hit AND i % {stride} = 0 AND i / {stride} < {most}), {no_start}) AS BIGINT) AS start_idx,
  CAST(coalesce(max(i) FILTER (hit AND {_BACK} % {stride} = 0 AND {_BACK} / {stride} < {most}), {no_end}) AS BIGINT) AS end_idx
FROM s GROUP BY k"""


def _median(source: str, value: str) -> str:
    return f"""SELECT k, i, {value}, CASE WHEN n <= 11 THEN {value} ELSE
    list_sort(list_slice(around, CAST(least(i, 5) - r + 1 AS BIGINT), CAST(least(i, 5) + r + 1 AS BIGINT)))[r + 1] END AS median_v
  FROM (SELECT *, least(i, n - 1 - i, 5) AS r, list({value}) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS around FROM {source})"""


_NEIGHBOURS = """nb AS (SELECT k, i, v, m, n,
  last_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER p AS fv, last_value(CASE WHEN NOT m THEN i END IGNORE NULLS) OVER p AS fi,
  first_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER q AS bv, first_value(CASE WHEN NOT m THEN i END IGNORE NULLS) OVER q AS bi
  FROM s WINDOW p AS (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT k, i, v, m, coalesce(fv, 255) AS forward_v, coalesce(fi, 0) AS forward_i, coalesce(bv, 255) AS backward_v, coalesce(bi, n - 1) AS backward_i FROM nb)"""
_SCORES = """u AS (SELECT vec_id, unnest(embedding) AS e, unnest(range(len(embedding))) AS pos FROM embeddings),
t AS (SELECT vec_id, concat('tag_', pos, '(a)') AS name, CASE WHEN pos % 4 = 3 THEN 4 WHEN pos % 12 = 0 THEN 9 ELSE 0 END AS category, abs(CAST(e AS DOUBLE)) AS p FROM u)"""
_WANTED = """w AS (SELECT doc_id, unnest(CASE lang WHEN 'en' THEN ['a painting', 'a sketch'] WHEN 'fr' THEN ['une toile'] ELSE [] END) AS prompt FROM documents)"""
_UNIFORM = "CAST(CAST(concat('0x', substr(md5(concat(CAST({id} AS VARCHAR), ':42')), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0"


def _morph(mode: str, source: str, lo: int, hi: int) -> str:
    agg = "bool_or" if mode == "dilate" else "bool_and"
    return f"""SELECT a.vec_id, a.x, a.y, {agg}(b.m) AS m FROM {source} a JOIN {source} b
  ON a.vec_id = b.vec_id AND b.x - a.x BETWEEN {lo} AND {hi} AND b.y - a.y BETWEEN {lo} AND {hi} GROUP BY a.vec_id, a.x, a.y"""


_C = (
    _F
    + """, q AS (SELECT k, i, vec_id, embedding, unnest(range(22)) AS p FROM f),
e AS (SELECT k, i, vec_id, CAST(p // 11 AS INTEGER) AS y, CAST(p % 11 AS INTEGER) AS x,
  list_transform([1, 2, 3], lambda j: ((CAST(floor(coalesce(CAST(embedding[3 * p + j] AS DOUBLE), 0.0) * 256) AS BIGINT) % 256) + 256) % 256) AS bgr FROM q)"""
)
_LIN = "list_transform(bgr, lambda c: CASE WHEN c / 255.0 <= 0.04045 THEN c / CAST(255.0 AS DOUBLE) / 12.92 ELSE pow((c / CAST(255.0 AS DOUBLE) + 0.055) / 1.055, 2.4) END)"
_CUBE = "CASE WHEN {t} > 0.008856 THEN cbrt({t}) ELSE 7.787 * {t} + CAST(16.0 AS DOUBLE) / 116.0 END"
_BYTE = "CAST(greatest(0, least(255, floor({v} + 0.5))) AS BIGINT)"
_L = (
    _C
    + f""", l0 AS (SELECT k, i, vec_id, y, x, {_LIN} AS c FROM e),
l1 AS (SELECT k, i, vec_id, y, x, (0.412453 * c[3] + 0.357580 * c[2] + 0.180423 * c[1]) / 0.950456 AS tx, 0.212671 * c[3] + 0.715160 * c[2] + 0.072169 * c[1] AS ty,
  (0.019334 * c[3] + 0.119193 * c[2] + 0.950227 * c[1]) / 1.088754 AS tz FROM l0),
l2 AS (SELECT k, i, vec_id, y, x, CASE WHEN ty > 0.008856 THEN 116.0 * cbrt(ty) - 16.0 ELSE 903.3 * ty END AS li, {_CUBE.format(t="tx")} AS fx, {_CUBE.format(t="ty")} AS fy, {_CUBE.format(t="tz")} AS fz FROM l1),
lab AS (SELECT k, i, vec_id, y, x, {_BYTE.format(v="li * 255.0 / 100.0")} AS l, {_BYTE.format(v="500.0 * (fx - fy) + 128.0")} AS a, {_BYTE.format(v="200.0 * (fy - fz) + 128.0")} AS b FROM l2),
ld AS (SELECT *, lag(l) OVER w AS pl, lag(a) OVER w AS pa, lag(b) OVER w AS pb FROM lab WINDOW w AS (PARTITION BY k, y, x ORDER BY i)),
dist AS (SELECT k, i, vec_id, y, x, pl IS NOT NULL AS known, sqrt(CAST(((l - pl) * (l - pl)) % 256 + ((a - pa) * (a - pa)) % 256 + ((b - pb) * (b - pb)) % 256 AS DOUBLE)) AS d FROM ld)"""
)
_FLAGS = "m AS (SELECT d.doc_id, d.source, d.lang, l.quality = 1 AS processed, l.toxic = 1 AS exclude_video FROM documents d LEFT JOIN labels l USING (doc_id))"
_STARTS = "st AS (SELECT DISTINCT k, CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 10000000 ELSE k END AS at FROM f)"
_DETS = """dt AS (SELECT k, i, vec_id, p, ['logo', '', 'text', 'hand'][(p // 4) % 4 + 1] AS label, embedding[p] AS score, list_transform([0, 1, 2, 3], lambda j: CAST(embedding[p + j] AS DOUBLE) * {scale} + {shift}) AS box
  FROM (SELECT k, i, vec_id, embedding, unnest(range(1, len(embedding), 4)) AS p FROM f))"""


def _window_morph(mode: str, source: str, lo: int, hi: int, frame: str = "vec_id") -> str:
    agg = "bool_or" if mode == "dilate" else "bool_and"
    return f"""SELECT {frame}, x, y, {agg}(m) OVER (PARTITION BY {frame}, x ORDER BY y RANGE BETWEEN {-lo} PRECEDING AND {hi} FOLLOWING) AS m
  FROM (SELECT {frame}, x, y, {agg}(m) OVER (PARTITION BY {frame}, y ORDER BY x RANGE BETWEEN {-lo} PRECEDING AND {hi} FOLLOWING) AS m FROM {source})"""


def _mirror(place: str, n: int) -> str:
    return f"CASE WHEN {place} < 0 THEN -({place}) WHEN {place} >= {n} THEN {2 * (n - 1)} - ({place}) ELSE {place} END"


def _blur(source: str, frame: str, width: int, height: int, weights: list[int], value: str) -> str:
    half = len(weights) // 2
    kernel = ", ".join(f"({d - half}, {w})" for d, w in enumerate(weights))
    same = " AND ".join(f"n.{c} = g.{c}" for c in frame.split(", "))
    own = ", ".join(f"g.{c}" for c in frame.split(", "))
    return f"""SELECT {own}, g.y, g.x, {value} FROM {source} g, (VALUES {kernel}) kx(d, w), (VALUES {kernel}) ky(d, w), {source} n
  WHERE {same} AND n.x = {_mirror("g.x + kx.d", width)} AND n.y = {_mirror("g.y + ky.d", height)} GROUP BY {own}, g.y, g.x"""


_ROUNDED = "(CAST(sum(kx.w * ky.w * {v}) AS BIGINT) + 32768) >> 16"
_SOFT_L = (
    _C.replace("e AS (SELECT k, i, vec_id, CAST", "e0 AS (SELECT k, i, vec_id, CAST")
    + f""", e AS ({_blur("e0", "k, i, vec_id", 11, 2, [70, 116, 70], "[" + ", ".join(_ROUNDED.format(v=f"n.bgr[{c}]") for c in (1, 2, 3)) + "] AS bgr")})"""
    + _L[len(_C) :]
)
_FULL, _FIRST, _LAST = 2**64 - 1, sum(1 << (8 * y) for y in range(8)), sum(1 << (8 * y + 7) for y in range(8))


def _grown(mask: str) -> str:
    """An 8 x 8 mask as one number, dilated by a kernel of three."""
    across = f"list_transform([{mask}], lambda a: a | ((a << 1) & {_FULL - _FIRST}) | ((a >> 1) & {_FULL - _LAST}))[1]"
    return f"list_transform([{across}], lambda b: b | ((b << 8) & {_FULL}) | (b >> 8))[1]"


def _scaled(source: str, along: str, n: str, to: str) -> str:
    """One direction of a bilinear change of size; ``source`` has vec_id, w, h, y, x, v."""
    other = "y" if along == "x" else "x"
    return f"""SELECT s.vec_id, s.w, s.h, s.w2, s.h2, s.{other}, t.o AS {along}, greatest(0, least(255, (CAST(sum(t.part * s.v) AS BIGINT) + 2097152) >> 22)) AS v FROM {source} s JOIN (
    SELECT n, m, o, x, CAST(floor(wt / sum(wt) OVER (PARTITION BY n, m, o) * 4194304 + 0.5) AS BIGINT) AS part FROM (
      SELECT *, greatest(1 - abs((x - (o + 0.5) * n / m + 0.5) / greatest(CAST(n AS DOUBLE) / m, 1)), 0) AS wt FROM (
        SELECT *, unnest(range(n)) AS x FROM (SELECT *, unnest(range(m)) AS o FROM (SELECT DISTINCT CAST({n} AS BIGINT) AS n, CAST({to} AS BIGINT) AS m FROM {source})))
      WHERE x >= greatest(floor((o + 0.5) * n / m - greatest(CAST(n AS DOUBLE) / m, 1) + 0.5), 0) AND x < least(floor((o + 0.5) * n / m + greatest(CAST(n AS DOUBLE) / m, 1) + 0.5), n))
  ) t ON t.n = s.{n} AND t.m = s.{to} AND t.x = s.{along} GROUP BY s.vec_id, s.w, s.h, s.w2, s.h2, s.{other}, t.o"""


SQL: dict[str, str] = {
    "scan_project": "SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k_text, coalesce(json_extract_string(props, '$.title'), '') AS title FROM events",
    "url_expand": """SELECT page_id, host, part, has_query FROM (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, unnest(string_split_regex(regexp_replace(url, '^[a-z]+://[^/]+', ''), '[/?#&]')) AS part,
    contains(url, '?') AS has_query FROM pages) WHERE part <> ''""",
    "register_dedupe": """WITH c AS (
  SELECT CAST(doc_id AS VARCHAR) AS url, md5(text) AS id, source AS channel_id, lang <> 'en' AS strict FROM documents),
a AS (SELECT * FROM c WHERE id NOT IN (SELECT md5(d.text) FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic = 1)
  AND (NOT strict OR channel_id IN ('src1', 'src2', 'src3'))),
r AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY url) = 1)
SELECT channel_id, count(*) AS n_registered FROM r GROUP BY channel_id""",
    "enrich_items": """SELECT doc_id, concat('youtube:', doc_id) AS video_key, concat(lang, '; ', source) AS art, false AS processed, false AS exclude_video FROM documents""",
    "eligible_videos": """SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE NOT coalesce(l.toxic = 1, false) AND d.doc_id IN (SELECT conv_id FROM conversations)""",
    "processed_filter": f"SELECT k, start_idx AS start_frame_idx, end_idx AS end_frame_idx FROM ({_hits(3, 300, '-1', '-1')}) WHERE start_idx >= 0 AND end_idx >= 0",
    "needs_work": "SELECT source, count(*) AS n_open FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT coalesce(l.quality = 1, false) GROUP BY source",
    "frame_count": "SELECT d.doc_id, coalesce(c.n, 0) AS n_frames FROM documents d LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) c ON c.conv_id = d.doc_id",
    "label_counts": "SELECT source, count(*) AS n_videos FROM documents GROUP BY source",
    "split_assign": f"""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'train' ELSE 'test' END
  WHEN u <= 0.8 THEN 'train' WHEN u <= 0.8 + 0.1 THEN 'eval' ELSE 'test' END AS split
FROM (SELECT doc_id, {_UNIFORM.format(id="doc_id")} AS u FROM documents) d LEFT JOIN labels l USING (doc_id)""",
    "folds": """WITH c AS (SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')), doc_id) - 1) % 5 AS INTEGER) AS chunk FROM documents)
SELECT doc_id, source, CAST(fold AS INTEGER) AS fold, CASE WHEN chunk = fold THEN 'test' ELSE 'train' END AS part FROM c, (SELECT unnest(range(5)) AS fold)""",
    "stage_explode": """SELECT doc_id, CAST(stage_no AS INTEGER) AS stage_no, ['extract', 'vary', 'tag'][stage_no + 1] AS stage_name, lang AS config
FROM documents, (SELECT unnest(range(3)) AS stage_no)""",
    "path_build": "SELECT doc_id, concat('out/', source, '/', lpad(CAST(doc_id AS VARCHAR), 8, '0'), '.png') AS path FROM documents",
    "union_pipelines": "SELECT 'documents' AS pipeline, doc_id AS video_id FROM documents UNION ALL SELECT 'pages', page_id FROM pages",
    "meta_upsert": """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 'flagged' END, d.lang) AS lang, coalesce(CAST(l.quality AS BIGINT), d.n_chars) AS size
FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id""",
    "json_meta": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k_value, concat('{"frame_index":', event_id, ',"processor":"', event_type, '"}') AS meta FROM events""",
    "reindex_delete": """SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS ref_idx, role FROM conversations WHERE turn <> 1""",
    "trim_variations": "SELECT conv_id, turn AS ref_idx, role FROM conversations WHERE turn = 0",
    "replace_frames": """WITH n AS (SELECT doc_id * 2 AS doc_id, CAST(quality AS BIGINT) AS n_chars FROM labels WHERE doc_id * 2 IN (SELECT doc_id FROM documents))
SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM n) UNION ALL SELECT doc_id, n_chars FROM n""",
    "append_frames": "SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS frame_no, role FROM conversations",
    "temporal_median": f"WITH {_S} {_median('s', 'v')}",
    "last_clean_fill": f"""WITH {_S} SELECT k, i, coalesce(last_value(CASE WHEN NOT m THEN v END IGNORE NULLS)
  OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS clean_v FROM s""",
    "even_sample": f"""WITH {_S}, b AS (SELECT DISTINCT k, n - 1 AS last, least(n, 1000) AS c FROM s),
j AS (SELECT k, last, c, unnest(range(c)) AS sample_no FROM b),
p AS (SELECT k, CAST(sample_no AS BIGINT) AS sample_no, CAST(CASE WHEN c = 1 THEN 0 WHEN sample_no = c - 1 THEN last ELSE ceil(sample_no * (CAST(last AS DOUBLE) / (c - 1))) END AS BIGINT) AS i FROM j)
SELECT k, i, sample_no, v FROM p JOIN s USING (k, i)""",
    "progress": f"WITH {_S} SELECT k, i, CASE WHEN n > 1 THEN CAST(i AS DOUBLE) / (n - 1) END AS progress FROM s",
    "fixed_trim": f"""WITH {_S} SELECT k, CAST(CASE WHEN count(*) > 60 THEN 30 ELSE 0 END AS BIGINT) AS start_idx, CASE WHEN count(*) > 60 THEN count(*) - 30 ELSE count(*) END AS end_idx FROM s GROUP BY k""",
    "first_last_hit": _hits(30, 300, "-1", "-1"),
    "first_last_hit_library": _hits(10, 200, "0", "max(i)"),
    "still_runs": f"""WITH {_SIGN}, r AS (SELECT k, i, n, sign, sum(sign) OVER (PARTITION BY k ORDER BY i) AS island FROM d),
a AS (SELECT k, island, min(i) AS lo, max(i) AS hi, any_value(n) AS n FROM r WHERE sign = 0 GROUP BY k, island)
SELECT k, lo AS start_idx, hi - 1 AS end_idx FROM a WHERE hi - lo + 1 >= 3 AND n >= 5""",
    "still_runs_timelapse": f"""WITH {_SIGN}, l AS (SELECT *, lag(sign) OVER w AS a, lead(sign) OVER w AS c, lead(sign, 2) OVER w AS e FROM d WINDOW w AS (PARTITION BY k ORDER BY i)),
k AS (SELECT k, i, CASE WHEN i = n - 1 THEN 1 WHEN i = 0 THEN 2 WHEN i >= 2 AND i < n - 2 AND sign = 0 AND c = 0 THEN CASE WHEN a = 0 AND e = 1 THEN 1 WHEN a = 1 AND e = 0 THEN 2 END END AS mark FROM l),
p AS (SELECT k, i, mark, lag(mark) OVER (PARTITION BY k ORDER BY i) AS before, lag(i) OVER (PARTITION BY k ORDER BY i) AS opened FROM k WHERE mark IS NOT NULL)
SELECT k, opened AS start_idx, i AS end_idx FROM p WHERE mark = 1 AND before = 2""",
    "keyframes": f"""WITH {_G}, d AS (SELECT k, i, {_WRAP.format(a="v", b="w")} > 10 AS moved FROM (SELECT *, lag(v) OVER (PARTITION BY k, y, x ORDER BY i) AS w FROM g)),
c AS (SELECT k, i, CAST(count(*) FILTER (moved) >= 24 AS INTEGER) AS sign FROM d GROUP BY k, i),
r AS (SELECT k, i, sign, sum(sign) OVER (PARTITION BY k ORDER BY i) AS island, count(*) OVER (PARTITION BY k) AS n FROM c),
a AS (SELECT k, island, min(i) AS lo, max(i) AS hi, any_value(n) AS n FROM r WHERE sign = 0 GROUP BY k, island)
SELECT k, lo AS start_idx, hi - 1 AS end_idx FROM a WHERE hi - lo + 1 >= 3 AND n >= 5""",
    "window_max_mask": f"WITH {_S} SELECT k, i, v, max(v) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 30 PRECEDING AND 1 FOLLOWING) AS window_max FROM s",
    "band_diff_mask": f"""WITH {_S} SELECT a.k, a.i, a.v, bool_or({_WRAP.format(a="a.v", b="b.v")} > 15.9) AS moved
FROM s a JOIN s b ON a.k = b.k AND b.i BETWEEN a.i - 30 AND a.i + 1 GROUP BY a.k, a.i, a.v""",
    "forward_fill_index": f"WITH {_S}, {_NEIGHBOURS} SELECT * FROM c",
    "distance_blend": f"""WITH {_S}, {_NEIGHBOURS} SELECT k, i, CASE WHEN m THEN CAST(floor(CAST((i - forward_i) * forward_v + (backward_i - i) * backward_v AS DOUBLE)
  / (CAST(backward_i - forward_i AS DOUBLE) + 2.220446049250313e-16)) AS BIGINT) ELSE v END AS blend_v FROM c""",
    "reference_frame": f"WITH {_S} SELECT k, i, v FROM s WHERE i = n - 1",
    "frame_at": f"WITH {_S} SELECT k, i, v FROM s WHERE i = n - 2",
    "stride_limit": f"WITH {_S} SELECT k, i, v FROM s WHERE i % 3 = 0 AND i / 3 < 10",
    "batch_chunks": f"WITH {_S} SELECT k, CAST(i // 16 AS BIGINT) AS batch_no, count(*) AS n FROM s GROUP BY ALL",
    "preview_skip": f"WITH {_S} SELECT k, i, v, concat(lpad(CAST(i AS VARCHAR), 8, '0'), '.png') AS file_name FROM s WHERE i % 2 = 0",
    "runs_on_lineitem": f"""WITH a AS (SELECT l_partkey AS k, CAST(l_quantity AS BIGINT) AS v, l_returnflag = 'R' AS m, count(*) OVER (PARTITION BY l_partkey) AS n,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS i FROM lineitem),
c AS (SELECT k, i, n, coalesce(last_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS v FROM a)
SELECT k, CAST(sum(median_v) AS BIGINT) AS total, count(*) AS n FROM ({_median("c", "v")}) GROUP BY k""",
    "majority_mask": f"WITH {_G} SELECT k, y, x, count(*) FILTER (v > 128) >= (count(*) + 1) // 2 AS majority_m FROM g GROUP BY k, y, x",
    "own_or_majority": f"""WITH {_G}, h AS (SELECT k, i, v > 128 OR count(*) FILTER (v > 128) OVER w >= (count(*) OVER w + 1) // 2 AS u FROM g WINDOW w AS (PARTITION BY k, y, x))
SELECT k, i, count(*) FILTER (u) AS n_masked FROM h GROUP BY k, i""",
    "mask_or": f"WITH {_G} SELECT vec_id, bool_or(v > 250) AS any_m FROM g GROUP BY vec_id",
    "accumulated_mask": f"WITH {_G} SELECT k, y, x, max(v) AS max_v FROM g GROUP BY k, y, x",
    "never_changed": f"""WITH {_G}, d AS (SELECT k, y, x, coalesce({_WRAP.format(a="v", b="w")} > 15.9, false) AS moved FROM (SELECT *, lag(v) OVER (PARTITION BY k, y, x ORDER BY i) AS w FROM g))
SELECT k, y, x, NOT bool_or(moved) AS still FROM d GROUP BY k, y, x""",
    "median_sampled": f"""WITH {_G}, b AS (SELECT k, max(i) AS last FROM f GROUP BY k), j AS (SELECT k, last, unnest(range(100)) AS j FROM b),
p AS (SELECT k, CAST(CASE WHEN j = 99 THEN last ELSE floor(j * (CAST(last AS DOUBLE) / 99)) END AS BIGINT) AS i FROM j)
SELECT k, y, x, CAST(floor(quantile_cont(v, 0.5)) AS BIGINT) AS median_v FROM p JOIN g USING (k, i) GROUP BY k, y, x""",
    "progress_hist": f"""WITH {_S}, p AS (SELECT DISTINCT k, CAST(least(floor(CAST(i AS DOUBLE) / (n - 1) * 100), 99) AS INTEGER) AS bin FROM s WHERE n > 1)
SELECT a.k, a.bin, CAST(p.bin IS NOT NULL AS INTEGER) AS present FROM (SELECT k, CAST(unnest(range(100)) AS INTEGER) AS bin FROM (SELECT DISTINCT k FROM s)) a LEFT JOIN p USING (k, bin)""",
    "minmax_mask": f"""WITH {_G}, r AS (SELECT vec_id, v, min(v) OVER w AS lo, max(v) OVER w AS hi FROM g WINDOW w AS (PARTITION BY vec_id))
SELECT vec_id, count(*) FILTER (hi > lo AND CAST(v - lo AS DOUBLE) / (hi - lo) > 0.25) AS n_near FROM r GROUP BY vec_id""",
    "column_split": f"""WITH {_G}, d AS (SELECT vec_id, x, abs(coalesce(lead(v) OVER w - lag(v) OVER w, 0)) AS c FROM g WINDOW w AS (PARTITION BY vec_id, y ORDER BY x)),
c AS (SELECT vec_id, x, CASE WHEN x >= 2 AND x < 6 THEN sum(c) ELSE 0 END AS s FROM d GROUP BY vec_id, x)
SELECT vec_id, x AS split_x FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, x) = 1""",
    "crop_grid": f"""WITH {_G} SELECT vec_id, count(*) AS n, CAST(sum(v * ((x - 1) + 8 * (y - 1))) AS BIGINT) AS weighted FROM g WHERE x >= 1 AND x < 7 AND y >= 1 AND y < 7 GROUP BY vec_id""",
    "dilate": f"""WITH {_G}, a AS (SELECT vec_id, x, y, v > 250 AS m FROM g), b AS ({_morph("dilate", "a", -2, 1)})
SELECT vec_id, count(*) FILTER (m) AS n, CAST(sum(CASE WHEN m THEN x + 8 * y ELSE 0 END) AS BIGINT) AS places FROM b GROUP BY vec_id""",
    "open_mask": f"""WITH {_G}, a AS (SELECT vec_id, x, y, v > 60 AS m FROM g), b AS ({_morph("erode", "a", -1, 1)}), c AS ({_morph("dilate", "b", -1, 1)})
SELECT vec_id, count(*) FILTER (m) AS n, CAST(sum(CASE WHEN m THEN x + 8 * y ELSE 0 END) AS BIGINT) AS places FROM c GROUP BY vec_id""",
    "lab_diff_wrap": f"""WITH {_G}, w AS (SELECT k, i, vec_id, (y * 8 + x) // 3 AS p, y * 8 + x AS pos, v, lag(v) OVER (PARTITION BY k, y, x ORDER BY i) AS b FROM g),
d AS (SELECT vec_id, p, sqrt(CAST(sum(((v - b) * (v - b)) % 256) AS DOUBLE)) AS d FROM w WHERE b IS NOT NULL GROUP BY vec_id, p)
SELECT vec_id, CAST(count(*) FILTER (d > 10) AS INTEGER) AS n_changed, round(max(d), 6) AS max_distance FROM d GROUP BY vec_id""",
    "box_filter": """WITH d AS (SELECT * FROM (SELECT vec_id, unnest(range(1, len(embedding), 4)) AS p, embedding FROM embeddings), LATERAL (SELECT ['logo', '', 'text', 'hand'][(p // 4) % 4 + 1] AS label) WHERE label <> ''),
s AS (SELECT vec_id, label, list_transform([0, 1, 2, 3], lambda i: greatest(0, least(20, round_even(CAST(embedding[p + i] AS DOUBLE) * 40 + 10, 0)))) AS b FROM d)
SELECT vec_id, label, CAST(greatest(0, b[3] - b[1]) * greatest(0, b[4] - b[2]) AS INTEGER) AS area FROM s
WHERE greatest(0, b[3] - b[1]) * greatest(0, b[4] - b[2]) > 0 AND greatest(0, b[3] - b[1]) * greatest(0, b[4] - b[2]) <= 100""",
    "reference_or_stand_in": """SELECT doc_id, coalesce(c.role, 'not found') AS role, c.role IS NULL AS missing FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT conv_id, role FROM conversations WHERE turn = 2) c ON c.conv_id = d.doc_id""",
    "mcut_threshold": f"""WITH {_SCORES}, r AS (SELECT vec_id, p, lead(p) OVER w AS q, row_number() OVER w AS r FROM t WINDOW w AS (PARTITION BY vec_id ORDER BY p DESC, name))
SELECT vec_id, (p + q) / 2 AS threshold FROM r WHERE q IS NOT NULL QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p - q DESC, r) = 1""",
    "select_tags": f"""WITH {_SCORES}, k AS (SELECT vec_id, category, replace(name, '_', ' ') AS shown, name, p FROM t WHERE (category = 0 AND p > 0.1) OR (category = 4 AND p > 0.15)),
a AS (SELECT vec_id, coalesce(string_agg(shown, ', ' ORDER BY p DESC, name) FILTER (category = 0), '') AS caption, coalesce(string_agg(shown, '|' ORDER BY p DESC, name) FILTER (category = 4), '') AS characters,
  list(replace(replace(shown, '(', '\\('), ')', '\\)') ORDER BY p DESC, name) FILTER (category = 0) AS g FROM k GROUP BY vec_id),
c AS (SELECT e.vec_id, coalesce(replace(replace(caption, '(', '\\('), ')', '\\)'), '') AS caption, coalesce(characters, '') AS characters, array_to_string(list_slice(g, 1, 5), ', ') AS added
  FROM embeddings e LEFT JOIN a USING (vec_id))
SELECT vec_id, caption, characters, (SELECT arg_max(name, struct_pack(p := p, n := name)) FROM t WHERE t.vec_id = c.vec_id AND category = 9) AS rating, CASE WHEN coalesce(added, '') <> '' THEN concat('paint, ', added) ELSE 'paint' END AS prompt FROM c""",
    "best_aspect": """WITH p AS (SELECT p_partkey, CAST(p_size + p_partkey % 40 AS DOUBLE) / p_size AS r FROM part),
c AS (SELECT p_partkey, w, h, i, abs(r - CAST(w AS DOUBLE) / h) AS d FROM p, (VALUES (768, 512, 0), (512, 768, 1), (512, 512, 2)) s(w, h, i))
SELECT p_partkey, w AS best_width, h AS best_height FROM c QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY d, i) = 1""",
    "append_tags": """SELECT doc_id, CASE WHEN lang = 'en' THEN concat('llava=', source) WHEN lang = 'fr' THEN concat('other=', source, ',llava=new') ELSE 'llava=new' END AS captions FROM documents""",
    "prompt_lookup": f"WITH {_WANTED} SELECT doc_id, prompt FROM w",
    "uncovered_prompts": f"""WITH {_WANTED} SELECT doc_id, prompt FROM w
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND CASE WHEN l.quality = 1 THEN 'a painting' ELSE 'une toile' END = w.prompt)""",
    "canvas_by_split": f"""WITH {_G}, d AS (SELECT vec_id, x, abs(coalesce(lead(v) OVER w - lag(v) OVER w, 0)) AS c FROM g WINDOW w AS (PARTITION BY vec_id, y ORDER BY x)),
c AS (SELECT vec_id, x, CASE WHEN x >= 2 AND x < 6 THEN sum(c) ELSE 0 END AS s FROM d GROUP BY vec_id, x),
p AS (SELECT vec_id, x + 2 AS x0 FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, x) = 1)
SELECT vec_id, count(*) AS n, CAST(sum(v * (x - x0 + 1)) AS BIGINT) AS weighted FROM g JOIN p USING (vec_id) WHERE x >= x0 GROUP BY vec_id""",
    "box_fill": """WITH b AS (SELECT vec_id, list_transform(range(1, len(embedding), 2), lambda i: [CAST(floor(abs(CAST(embedding[i] AS DOUBLE)) * 40) AS INTEGER), CAST(floor(abs(CAST(embedding[i + 1] AS DOUBLE)) * 40) AS INTEGER)]) AS b FROM embeddings)
SELECT vec_id, count(*) FILTER (len(list_filter(b, lambda c: x >= c[1] AND x < c[1] + 3 AND y >= c[2] AND y < c[2] + 2)) > 0) AS n
FROM b, (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x) GROUP BY vec_id""",
    "polygon_fill": """WITH s AS (SELECT vec_id, embedding, unnest(range(0, len(embedding), 8)) AS b FROM embeddings),
p AS (SELECT vec_id, b, unnest([1, 2, 3, 4]) AS i, list_transform([1, 3, 5, 7], lambda i: [floor(abs(CAST(embedding[b + i] AS DOUBLE)) * 100), floor(abs(CAST(embedding[b + i + 1] AS DOUBLE)) * 100)]) AS p FROM s),
e AS (SELECT vec_id, b, p[i][1] AS ax, p[i][2] AS ay, p[i % 4 + 1][1] AS qx, p[i % 4 + 1][2] AS qy FROM p),
c AS (SELECT vec_id, b, y, x, count(*) FILTER ((ay > y) <> (qy > y) AND x < ax + (y - ay) * ((qx - ax) / (qy - ay))) AS n
  FROM e, (SELECT unnest(range(16)) AS y), (SELECT unnest(range(16)) AS x) GROUP BY vec_id, b, y, x),
a AS (SELECT vec_id, y, x, bool_or(n % 2 = 1) AS inside FROM c GROUP BY vec_id, y, x)
SELECT vec_id, count(*) FILTER (inside) AS n FROM a GROUP BY vec_id""",
    "resize_geometry": """WITH s AS (SELECT p_partkey, p_size * 7 + 3 AS w, p_partkey % 90 + 11 AS h FROM part),
f AS (SELECT *, least(64 / CAST(w AS DOUBLE), 48 / CAST(h AS DOUBLE)) AS a, greatest(64 / CAST(w AS DOUBLE), 48 / CAST(h AS DOUBLE)) AS b FROM s),
g AS (SELECT *, CAST(greatest(1, floor(w * a)) AS INTEGER) AS fw, CAST(greatest(1, floor(h * a)) AS INTEGER) AS fh FROM f)
SELECT p_partkey, fw AS width, fh AS height, 64 - fw AS "left", 48 - fh AS top, CAST(floor((ceil(w * b) - 64) / 2) AS INTEGER) AS crop_x, CAST(floor((ceil(h * b) - 48) / 2) AS INTEGER) AS crop_y,
  CAST(ceil(w / 8.0) * 8 AS BIGINT) AS padded FROM g""",
    "overlay_blend": f"WITH {_G} SELECT vec_id, CAST(sum(floor(0.5 * v + 0.5 * CASE WHEN v > 128 THEN 255 ELSE 0 END)) AS BIGINT) AS total FROM g GROUP BY vec_id",
    "point_lookup": "SELECT doc_id, source, lang FROM documents WHERE source = 'src3' AND doc_id = 3",
    "override_stage": "SELECT doc_id, 'tag' AS stage_name FROM documents",
    "pager": "SELECT conv_id, turn AS ref_idx, greatest(0, turn - 1) AS previous, least(count(*) OVER (PARTITION BY conv_id) - 1, turn + 1) AS next FROM conversations",
    "clear_tags": "SELECT doc_id, CASE WHEN lang = 'en' THEN 0 ELSE -1 END AS n_tags, lang <> 'en' AS missing FROM documents",
    "lab_values": f"WITH {_L} SELECT vec_id, CAST(sum(l) AS BIGINT) AS l, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b FROM lab GROUP BY vec_id",
    "keyframes_lab": f"""WITH {_L}, c AS (SELECT k, i, CAST(count(*) FILTER (known AND d > 10) >= 13 AS INTEGER) AS sign FROM dist GROUP BY k, i),
r AS (SELECT k, i, sign, sum(sign) OVER (PARTITION BY k ORDER BY i) AS island, count(*) OVER (PARTITION BY k) AS n FROM c),
g AS (SELECT k, island, min(i) AS lo, max(i) AS hi, any_value(n) AS n FROM r WHERE sign = 0 GROUP BY k, island)
SELECT k, lo AS start_idx, hi - 1 AS end_idx FROM g WHERE hi - lo + 1 >= 3 AND n >= 5""",
    "difference_opened": f"""WITH {_L}, m0 AS (SELECT k, i, x, y, d > 8 AS m FROM dist WHERE known), m1 AS ({_window_morph("erode", "m0", -1, 0, "k, i")}), m2 AS ({_window_morph("dilate", "m1", -1, 0, "k, i")})
SELECT k, i, count(*) FILTER (m) AS n, CAST(sum(CASE WHEN m THEN x + 11 * y ELSE 0 END) AS BIGINT) AS places FROM m2 GROUP BY k, i""",
    "split_column_channels": f"""WITH {_C}, v AS (SELECT vec_id, y, x, unnest(bgr) AS v, unnest([0, 1, 2]) AS c FROM e),
d AS (SELECT vec_id, y, x, abs(coalesce(lead(v) OVER w - lag(v) OVER w, 0)) AS g FROM v WINDOW w AS (PARTITION BY vec_id, y, c ORDER BY x)),
h AS (SELECT vec_id, y, x, max(g) AS g FROM d GROUP BY vec_id, y, x),
s AS (SELECT vec_id, x, CASE WHEN x >= 2 AND x < 8 THEN sum(g) ELSE 0 END AS s FROM h GROUP BY vec_id, x)
SELECT vec_id, x AS split_x FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, x) = 1""",
    "swap_channels": f"WITH {_C} SELECT vec_id, CAST(sum(bgr[3] * (x + 1)) AS BIGINT) AS weighted FROM e GROUP BY vec_id",
    "opened_thrice": f"""WITH {_G}, a0 AS (SELECT vec_id, x, y, v > 60 AS m FROM g), a1 AS ({_window_morph("erode", "a0", -1, 0)}), a2 AS ({_window_morph("dilate", "a1", -1, 0)}), a3 AS ({_window_morph("dilate", "a2", -1, 0)}), a4 AS ({_window_morph("dilate", "a3", -1, 0)})
SELECT vec_id, count(*) FILTER (m) AS n, CAST(sum(CASE WHEN m THEN x + 8 * y ELSE 0 END) AS BIGINT) AS places FROM a4 GROUP BY vec_id""",
    "prompt_kernels": f"""WITH {_G}, h AS (SELECT vec_id, x, y, v > 250 AS m FROM g), h1 AS ({_window_morph("dilate", "h", -2, 1)}), j AS (SELECT * FROM h1 UNION ALL SELECT vec_id, x, y, v > 252 FROM g),
o AS (SELECT vec_id, x, y, bool_or(m) AS m FROM j GROUP BY vec_id, x, y), w AS ({_window_morph("dilate", "o", -1, 0)})
SELECT vec_id, count(*) FILTER (m) AS n, CAST(sum(CASE WHEN m THEN x + 8 * y ELSE 0 END) AS BIGINT) AS places FROM w GROUP BY vec_id""",
    "sampled_progress": f"""WITH {_S}, h AS (SELECT * FROM ({_hits(3, 300, '-1', '-1').replace("WITH " + _S, "")}) WHERE start_idx >= 0 AND end_idx >= 0),
b AS (SELECT DISTINCT k, start_idx AS a, end_idx AS z, least(n, 1000) AS c FROM s JOIN h USING (k)), j AS (SELECT *, unnest(range(c)) AS sample_no FROM b),
p AS (SELECT k, a, z, CAST(sample_no AS BIGINT) AS sample_no, CAST(greatest(0, CASE WHEN c = 1 THEN a WHEN sample_no = c - 1 THEN z ELSE ceil(a + sample_no * (CAST(z - a AS DOUBLE) / (c - 1))) END) AS BIGINT) AS i FROM j)
SELECT k, sample_no, i, v, round(CASE WHEN z <> a THEN CAST(i - a AS DOUBLE) / (z - a) END, 9) + 0.0 AS progress FROM p JOIN s USING (k, i)""",
    "split_at_start": f"""WITH {_G}, {_STARTS}, d AS (SELECT k, i, x, abs(coalesce(lead(v) OVER w - lag(v) OVER w, 0)) AS c FROM g WINDOW w AS (PARTITION BY k, i, y ORDER BY x)),
c AS (SELECT k, i, x, CASE WHEN x >= 2 AND x < 6 THEN sum(c) ELSE 0 END AS s FROM d GROUP BY k, i, x),
p AS (SELECT k, i, x FROM c QUALIFY row_number() OVER (PARTITION BY k, i ORDER BY s DESC, x) = 1),
z AS (SELECT st.k, CASE WHEN p.x IS NULL THEN 4 ELSE p.x + 1 END + 2 AS x0 FROM st LEFT JOIN p ON p.k = st.k AND p.i = st.at)
SELECT k, count(*) AS n, CAST(sum(v * (x - x0 + 1)) AS BIGINT) AS weighted FROM g JOIN z USING (k) WHERE x >= x0 GROUP BY k""",
    "canvas_from_boxes": f"""WITH {_F}, {_STARTS}, {_DETS.format(scale=40, shift=10)}, o AS (SELECT st.k, dt.box AS b FROM st LEFT JOIN dt ON dt.k = st.k AND dt.i = st.at AND dt.p = 1 AND dt.k <> 4),
r AS (SELECT k, b IS NOT NULL AND k <> 3 AS fresh, greatest(0, least(20, round_even(b[1], 0))) AS x0, greatest(0, least(16, round_even(b[2], 0))) AS y0, greatest(0, least(20, round_even(b[3], 0))) AS x1, greatest(0, least(16, round_even(b[4], 0))) AS y1 FROM o)
SELECT k, fresh OR k = 3 AS canvas_detected, CASE WHEN fresh THEN concat_ws(',', CAST(least(x0 + 2, 20) AS INTEGER), CAST(least(y0 + 2, 16) AS INTEGER), CAST(greatest(x1 - 2, 0) AS INTEGER), CAST(greatest(y1 - 2, 0) AS INTEGER)) ELSE '1,2,3,4' END AS box FROM r""",
    "logo_masks": f"""WITH {_G}, {_DETS.format(scale=20, shift=2)}, b AS (SELECT vec_id, list_transform(box, lambda c: greatest(0, least(8, round_even(c, 0)))) AS b FROM dt WHERE vec_id % 7 <> 3 AND label <> '' AND score >= 0.05),
v AS (SELECT * FROM b WHERE greatest(0, b[3] - b[1]) * greatest(0, b[4] - b[2]) BETWEEN 1 AND 16), h AS (SELECT DISTINCT g.vec_id, g.x, g.y FROM g JOIN v ON g.vec_id = v.vec_id AND x >= b[1] AND x < b[3] AND y >= b[2] AND y < b[4])
SELECT g.vec_id, count(h.x) AS n, CAST(sum(CASE WHEN h.x IS NOT NULL THEN v ELSE 0 END) AS BIGINT) AS total FROM g LEFT JOIN h ON g.vec_id = h.vec_id AND g.x = h.x AND g.y = h.y GROUP BY g.vec_id""",
    "logo_removal": f"""WITH {_G}, t AS (SELECT *, i % 7 <> 3 AND (v > 240 OR v < 12) AS o FROM g WHERE vec_id % 5 <> 0),
u2 AS (SELECT *, o OR count(*) FILTER (o) OVER w >= (count(*) OVER w + 1) // 2 AS m FROM t WINDOW w AS (PARTITION BY k, y, x)),
z AS (SELECT *, coalesce(last_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), v) AS nv FROM u2 WINDOW w AS (PARTITION BY k, y, x ORDER BY i)),
a AS (SELECT k, i, y, x, nv AS v FROM z UNION ALL SELECT k, i, y, x, v FROM g WHERE vec_id % 5 = 0)
SELECT k, i, CAST(sum(v * (x + 8 * y + 1)) AS BIGINT) AS weighted, true AS done FROM a GROUP BY k, i""",
    "success_counters": "SELECT source, count(*) FILTER (l.quality = 1) AS n_ok, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source",
    "resize_more": """WITH s AS (SELECT p_partkey, p_size * 7 + 3 AS w, p_partkey % 90 + 11 AS h FROM part),
t AS (SELECT *, CAST(CASE WHEN w >= h THEN floor(w * 64 / CAST(h AS DOUBLE)) ELSE 64 END AS INTEGER) AS sw, CAST(CASE WHEN w >= h THEN 64 ELSE floor(h * 64 / CAST(w AS DOUBLE)) END AS INTEGER) AS sh,
  CAST(greatest(1, floor(w * least(64 / CAST(w AS DOUBLE), 48 / CAST(h AS DOUBLE)))) AS INTEGER) AS fw, CAST(greatest(1, floor(h * least(64 / CAST(w AS DOUBLE), 48 / CAST(h AS DOUBLE)))) AS INTEGER) AS fh FROM s)
SELECT p_partkey, sw AS short_w, sh AS short_h, CAST(floor((sw - 64) / 2.0) AS INTEGER) AS crop_x, CAST(floor((sh - 64) / 2.0) AS INTEGER) AS crop_y, 64 AS stretch_w,
  CAST(floor((64 - fw) / 2.0) AS INTEGER) AS box_x, CAST(floor((48 - fh) / 2.0) AS INTEGER) AS box_y, fw AS box_w, round(w / CAST(fw AS DOUBLE), 6) AS scale_x FROM t""",
    "playlist_expand": "SELECT source AS url, doc_id AS id FROM documents UNION ALL SELECT lang, doc_id FROM documents",
    "fetch_absent": "SELECT doc_id, false AS canvas_detected FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM conversations)",
    "retention": f"WITH {_FLAGS} SELECT doc_id, source FROM m WHERE coalesce(processed, false) AND lang = 'en'",
    "toggle_exclude": f"WITH {_FLAGS} SELECT doc_id, CASE WHEN doc_id IN (SELECT conv_id FROM conversations) THEN doc_id % 2 = 0 ELSE coalesce(exclude_video, false) END AS exclude_video FROM m",
    "processed_with_frames": f"SELECT k, start_idx AS start_frame_idx, end_idx AS end_frame_idx FROM ({_hits(3, 300, '-1', '-1')}) WHERE start_idx >= 0 AND end_idx >= 0 AND k IN (SELECT doc_id FROM documents)",
    "needs_logo": f"WITH {_FLAGS} SELECT source, count(*) AS n FROM m WHERE NOT coalesce(processed, false) GROUP BY source",
    "attributes": "SELECT event_id, CAST(json(props) AS VARCHAR) AS props, event_type AS kind, concat('[', event_type) AS broken FROM events",
    "file_stems": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE concat(source, '.mp4.log') END AS stem FROM documents",
    "select_tags_mcut": f"""WITH {_SCORES}, r AS (SELECT vec_id, category, p, lead(p) OVER w AS q, row_number() OVER w AS r FROM t WHERE category IN (0, 4) WINDOW w AS (PARTITION BY vec_id, category ORDER BY p DESC, name)),
h AS (SELECT vec_id, category, (p + q) / 2 AS h FROM r WHERE q IS NOT NULL QUALIFY row_number() OVER (PARTITION BY vec_id, category ORDER BY p - q DESC, r) = 1),
k AS (SELECT t.vec_id, t.category, replace(name, '_', ' ') AS shown, name, p FROM t JOIN h ON t.vec_id = h.vec_id AND t.category = h.category WHERE p > CASE WHEN t.category = 4 THEN greatest(h, 0.15) ELSE h END),
a AS (SELECT vec_id, string_agg(shown, ', ' ORDER BY p DESC, name) FILTER (category = 0) AS caption, string_agg(shown, '|' ORDER BY p DESC, name) FILTER (category = 4) AS characters FROM k GROUP BY vec_id)
SELECT e.vec_id, (SELECT arg_max(name, struct_pack(p := p, n := name)) FROM t WHERE t.vec_id = e.vec_id AND category = 9) AS rating,
  coalesce(replace(replace(caption, '(', '\\('), ')', '\\)'), '') AS caption, coalesce(characters, '') AS characters FROM embeddings e LEFT JOIN a USING (vec_id)""",
    "tag_stage": f"""WITH {_WANTED} SELECT doc_id, prompt, concat(CASE WHEN doc_id % 3 = 1 THEN 'old|' ELSE '' END, 'seen: ', prompt) AS captions FROM w WHERE doc_id % 3 <> 0""",
    "process_lists": f"""WITH {_S}, cl AS (SELECT k, i, n, coalesce(last_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 7) AS v FROM s WHERE k % 3 = 1),
o AS (SELECT k, i, n, v FROM s WHERE k % 3 = 0)
SELECT k, i, median_v AS v FROM ({_median("o", "v")}) WHERE k % 4 <> 0 UNION ALL SELECT k, i, median_v FROM ({_median("cl", "v")}) WHERE k % 4 <> 0
UNION ALL SELECT k, i, v FROM s WHERE k % 3 = 2 AND k % 4 <> 0 AND i = n - 1""",
    "items_jsonl": "SELECT CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 2 = 0 THEN concat(lang, '; ', source) ELSE '' END AS art, doc_id % 5 = 0 AS is_playlist, source AS channel FROM documents",
    "stage_configs": """SELECT name, '{}' AS config, count(*) AS n FROM (SELECT lang AS name FROM documents UNION ALL SELECT source FROM documents WHERE doc_id % 3 <> 0) WHERE name IS NOT NULL GROUP BY name""",
    "register_catalog": """WITH r AS (SELECT md5(text) AS id, source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1)
SELECT source AS channel_id, false AS processed, count(*) AS n FROM r GROUP BY source""",
    "registry_replaced": "SELECT source, count(*) AS n_videos FROM documents GROUP BY source",
    "split_lines": "SELECT 'youtube' AS source, CAST(doc_id AS VARCHAR) AS video_id, CASE WHEN quality = 1 THEN 'train' ELSE 'test' END AS split FROM labels",
    "split_export": f"""SELECT CASE WHEN u <= 0.8 THEN 'train' WHEN u <= 0.8 + 0.1 THEN 'eval' ELSE 'test' END AS split, source, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids
FROM (SELECT doc_id, source, {_UNIFORM.format(id="doc_id")} AS u FROM documents) GROUP BY ALL""",
    "fold_export": """WITH c AS (SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':42')), doc_id) - 1) % 5 AS INTEGER) AS chunk FROM documents)
SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN chunk = fold THEN 'test' ELSE 'train' END AS part, source, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM c, (SELECT unnest(range(5)) AS fold) GROUP BY ALL""",
    "labels_csv": "SELECT concat(lang, ', ', source) AS name, CAST(doc_id % 10 AS INTEGER) AS category, count(*) AS n FROM documents GROUP BY ALL",
    "metadata_files": "SELECT source, lang AS video_id, lang <> 'de' AS ok, CASE WHEN lang <> 'de' THEN count(*) END AS n FROM documents GROUP BY source, lang",
    "log_texts": "SELECT DISTINCT source, lang AS video_id, false AS missing FROM documents UNION ALL SELECT DISTINCT source, 'none', true FROM documents",
    "folder_scan": "SELECT DISTINCT source, lang AS video_id FROM documents",
    "registry_json": """SELECT source, lang AS video_id, concat('{"n":', count(*), '}') AS item FROM documents GROUP BY source, lang""",
    "process_job": f"""WITH {_S}, c AS (SELECT k, i, n, v, coalesce(last_value(CASE WHEN NOT m THEN v END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS w FROM s),
a AS (SELECT k, w AS v FROM c WHERE k % 2 <> 0 AND k % 3 = 0 UNION ALL SELECT k, v FROM c WHERE k % 3 <> 0 AND i = n - 1)
SELECT concat('youtube:', u.k) AS k, true AS processed, n, total FROM (SELECT DISTINCT k FROM s) u LEFT JOIN (SELECT k, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM a GROUP BY k) t ON t.k = u.k""",
    "reference_clean_up": """SELECT 'frames' AS kind, conv_id AS id, CAST(turn AS INTEGER) AS n FROM conversations WHERE turn = 0
UNION ALL SELECT 'tags', doc_id, CASE WHEN lang = 'en' THEN 0 ELSE -1 END FROM documents""",
    "pipelines_export": f"""SELECT source, CAST(doc_id AS VARCHAR) AS video_id, CASE WHEN u <= 0.8 THEN 'train' WHEN u <= 0.8 + 0.1 THEN 'eval' ELSE 'test' END AS split, n_chars
FROM (SELECT *, {_UNIFORM.format(id="doc_id")} AS u FROM documents) WHERE lang <> 'en' AND doc_id % 3 <> 0""",
    "process_pixels": f"""WITH {_G}, h AS (SELECT k, i, y, x, v, v > 250 AS m, max(i) OVER (PARTITION BY k) + 1 AS n FROM g WHERE k <> 7),
c AS (SELECT k, i, y - 1 AS y, x - 1 AS x, v, m, n FROM h WHERE k % 3 = 0 AND n > 2 AND x >= 1 AND x < 7 AND y >= 1 AND y < 5 UNION ALL SELECT k, i, y, x, v, m, n FROM h WHERE k % 3 = 0 AND n <= 2),
cm AS (SELECT k, i, y, x, m, CASE WHEN n <= 3 OR i = 0 OR i = n - 1 THEN v ELSE list_sort(list(v) OVER w)[2] END AS v FROM c WINDOW w AS (PARTITION BY k, y, x ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
l AS (SELECT *, i % 5 <> 0 AS free FROM h WHERE k % 3 = 1),
lm AS (SELECT *, free AND (v > 200 OR count(*) FILTER (free AND v > 200) OVER p >= (count(*) FILTER (free) OVER p + 1) // 2) AS hit FROM l WINDOW p AS (PARTITION BY k, y, x)),
lf AS (SELECT k, i, y, x, m, n, CASE WHEN NOT free THEN v ELSE coalesce(last_value(CASE WHEN free AND NOT hit THEN v END IGNORE NULLS) OVER (PARTITION BY k, y, x ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(CASE WHEN free AND NOT hit THEN v END IGNORE NULLS) OVER (PARTITION BY k, y, x ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), v) END AS v FROM lm),
j AS (SELECT k, n, least(n, 7) AS c, unnest(range(least(n, 7))) AS j FROM (SELECT DISTINCT k, n FROM lf)),
e AS (SELECT j.k, j.j AS i, y, x, m, v FROM j JOIN lf ON j.k = lf.k AND lf.i = CASE WHEN c = 1 THEN 0 WHEN j = c - 1 THEN j.n - 1 ELSE CAST(ceil(j * (CAST(j.n - 1 AS DOUBLE) / (c - 1))) AS BIGINT) END),
d AS (SELECT a.k, a.i, a.y, a.x, any_value(a.v) AS v, bool_or(b.m) AS m FROM h a JOIN h b ON a.k = b.k AND a.i = b.i AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 WHERE a.k % 3 = 2 GROUP BY a.k, a.i, a.y, a.x),
z AS (SELECT k, i, y, x, v, m FROM cm UNION ALL SELECT k, i, y, x, v, m FROM e UNION ALL SELECT k, i, y, x, v, m FROM d)
SELECT k, i, count(*) AS n, CAST(sum(v * (x + 8 * y + 1)) AS BIGINT) AS weighted, count(*) FILTER (m) AS n_masked FROM z GROUP BY k, i""",
    "probed_ends": f"""WITH {_S}, p AS (SELECT k, n, unnest(range(least(300, (n - 1) // 2 + 1))) AS j FROM (SELECT DISTINCT k, n FROM s)),
h AS (SELECT p.k, p.n, p.j, a.hit AS fore, b.hit AS back FROM p JOIN s a ON a.k = p.k AND a.i = 2 * p.j JOIN s b ON b.k = p.k AND b.i = p.n - 1 - 2 * p.j),
m AS (SELECT k, n, min(j) FILTER (fore) AS s, min(j) FILTER (back) AS e, count(*) AS c FROM h GROUP BY k, n),
b AS (SELECT *, least(c, CASE WHEN s IS NULL THEN c ELSE CAST(pow(2, floor(log2(s + 1)) + 1) AS BIGINT) - 1 END) + least(c, CASE WHEN e IS NULL THEN c ELSE CAST(pow(2, floor(log2(e + 1)) + 1) AS BIGINT) - 1 END) AS n_probed FROM m)
SELECT k, CAST(coalesce(2 * s, -1) AS BIGINT) AS start_idx, CAST(coalesce(n - 1 - 2 * e, -1) AS BIGINT) AS end_idx, n_probed FROM b""",
    "never_changed_blurred": f"""WITH {_G}, b AS ({_blur("g", "k, i", 8, 8, [70, 116, 70], _ROUNDED.format(v="n.v") + " AS v")}),
d AS (SELECT k, y, x, v, lag(v) OVER (PARTITION BY k, y, x ORDER BY i) AS w FROM b)
SELECT k, y, x, NOT bool_or(coalesce({_WRAP.format(a="v", b="w")} > 15.98, false)) AS still FROM d GROUP BY k, y, x""",
    "blurred_pixels": f"""WITH {_G}, b AS ({_blur("g", "vec_id", 8, 8, [31, 60, 74, 60, 31], _ROUNDED.format(v="n.v") + " AS v")})
SELECT vec_id, CAST(sum(v * (x + 8 * y + 1)) AS BIGINT) AS weighted FROM b GROUP BY vec_id""",
    "keyframes_blurred": f"""WITH {_SOFT_L}, c AS (SELECT k, i, CAST(count(*) FILTER (known AND d > 10) >= 20 AS INTEGER) AS sign FROM dist GROUP BY k, i),
r AS (SELECT k, i, sign, sum(sign) OVER (PARTITION BY k ORDER BY i) AS island, count(*) OVER (PARTITION BY k) AS n FROM c),
g AS (SELECT k, island, min(i) AS lo, max(i) AS hi, any_value(n) AS n FROM r WHERE sign = 0 GROUP BY k, island)
SELECT k, lo AS start_idx, hi - 1 AS end_idx FROM g WHERE hi - lo + 1 >= 3 AND n >= 5""",
    "movement_mask": f"""WITH {_G}, p AS (SELECT a.k, a.i, b.i AS j, CAST(sum(CASE WHEN {_WRAP.format(a="a.v", b="b.v")} > 6.9 THEN CAST(1 AS HUGEINT) << (8 * a.y + a.x) ELSE 0 END) AS HUGEINT) AS m
  FROM g a JOIN g b ON a.k = b.k AND a.y = b.y AND a.x = b.x AND b.i BETWEEN a.i - 30 AND a.i + 1 AND b.i <> a.i GROUP BY a.k, a.i, b.i),
fd AS (SELECT u.k, u.i, list_reduce(list_prepend(CAST(0 AS HUGEINT), coalesce(list(m ORDER BY j) FILTER (m IS NOT NULL), CAST([] AS HUGEINT[]))),
  lambda acc, now: {_grown(_grown(f"{_FULL} - " + _grown(f"{_FULL} - (acc | now)")))}) AS m FROM (SELECT DISTINCT k, i FROM f) u LEFT JOIN p ON p.k = u.k AND p.i = u.i GROUP BY u.k, u.i)
SELECT k, i, CAST(len(s) AS BIGINT) AS n, CAST(coalesce(list_sum(s), 0) AS BIGINT) AS places FROM (SELECT k, i, list_filter(range(64), lambda b: (m >> CAST(b AS INTEGER)) & 1 = 1) AS s FROM fd)""",
    "resize_pixels": f"""WITH {_G}, o AS (SELECT vec_id, 3 + vec_id % 6 AS w, 6 + vec_id % 3 AS h, y, x, v FROM g WHERE x < 3 + vec_id % 6 AND y < 6 + vec_id % 3),
z AS (SELECT *, greatest(1, CAST(round_even(w * least(12.0::DOUBLE / w, 9.0::DOUBLE / h), 0) AS BIGINT)) AS w2, greatest(1, CAST(round_even(h * least(12.0::DOUBLE / w, 9.0::DOUBLE / h), 0) AS BIGINT)) AS h2 FROM o),
a AS ({_scaled("z", "x", "w", "w2")}), b AS ({_scaled("a", "y", "h", "h2")}), c AS ({_scaled("b", "x", "w2", "w")}), d AS ({_scaled("c", "y", "h2", "h")}),
pad AS (SELECT vec_id, 9 - h2 + y AS y, 12 - w2 + x AS x, v FROM b UNION ALL
  SELECT vec_id, y, x, 7 FROM (SELECT *, unnest(range(12)) AS x FROM (SELECT *, unnest(range(9)) AS y FROM (SELECT DISTINCT vec_id, w2, h2 FROM z))) WHERE x < 12 - w2 OR y < 9 - h2)
SELECT vec_id, count(*) AS n, CAST(sum(v * (x + 12 * y + 1)) AS BIGINT) AS weighted, 'padded' AS kind FROM pad GROUP BY vec_id
UNION ALL SELECT vec_id, count(*), CAST(sum(v * (x + 12 * y + 1)) AS BIGINT), 'back' FROM d GROUP BY vec_id""",
    "items_by_bucket": """SELECT concat(source, ':', doc_id) AS video_key, count(*) AS n_frames FROM documents JOIN conversations ON conv_id = doc_id WHERE lang <> 'en' GROUP BY source, doc_id
UNION ALL SELECT concat(source, ':', doc_id), strlen(c.text) FROM documents d JOIN conversations c ON conv_id = doc_id WHERE doc_id = 3 AND source = 'src3'""",
}
SQL["stream_clean_fill"] = SQL["last_clean_fill"]
SQL["stream_median"] = f"WITH {_S} SELECT k, i, median_v FROM ({_median('s', 'v')})"
SQL["stills"] = f"""WITH {_C}, t AS (SELECT k, y, x, max(bgr[1]) AS b, max(bgr[2]) AS g, max(bgr[3]) AS r FROM e GROUP BY k, y, x)
SELECT 'label' AS source, concat('v', k) AS video_id, CAST(11 AS INTEGER) AS width, CAST(2 AS INTEGER) AS height,
  CAST(sum(b * (3 * (11 * y + x) + 1) + g * (3 * (11 * y + x) + 2) + r * (3 * (11 * y + x) + 3)) AS BIGINT) AS weighted FROM t GROUP BY k"""
