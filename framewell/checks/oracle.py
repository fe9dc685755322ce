"""The registered queries as SQL for another engine (DuckDB dialect).

Written from the definitions, over the same tables, with plain grouping,
window and join clauses.  Single precision is kept where results are single
precision, so that both sides round alike.
"""

from __future__ import annotations

# -- inputs ------------------------------------------------------------------------------------
EV_ALL = """ev_all AS (
  SELECT CAST(event_id // 128 AS BIGINT) AS frame_id, CAST((event_id % 128) // 16 AS INT) AS y,
         CAST(event_id % 16 AS INT) AS x,
         CAST(CASE WHEN value >= 250 THEN 65535 ELSE floor(value * 10) END AS INT) AS adc
  FROM events)"""
EV = EV_ALL + """, ev AS (
  SELECT e.* FROM ev_all e
  JOIN (SELECT frame_id FROM ev_all GROUP BY frame_id HAVING count(*) = 128) f ON e.frame_id = f.frame_id)"""
EMB_ROWS = """emb_rows AS (
  SELECT CAST(vec_id // 10 AS BIGINT) AS frame_id, CAST(vec_id % 10 AS INT) AS y,
         list_transform(embedding, lambda e: CAST(floor(2000 + 200 * CAST(e AS DOUBLE)) AS INT)) AS pixels
  FROM embeddings)"""
EMB = EMB_ROWS + """, emb AS (
  SELECT frame_id, y, CAST(generate_subscripts(pixels, 1) - 1 AS INT) AS x, unnest(pixels) AS adc FROM emb_rows)"""
LI = """li AS (
  SELECT CAST(l_suppkey % 16 AS INT) AS y, CAST(l_partkey % 64 AS INT) AS x,
         CAST(l_quantity * 100 AS INT) AS adc FROM lineitem)"""
OCC = """occ AS (
  SELECT y, x, count(*) FILTER (WHERE adc > 1000) AS hit_count,
         avg(adc) FILTER (WHERE adc NOT IN (0, 65535)) AS mean_adu FROM ev GROUP BY y, x)"""


def grid(height: int, width: int) -> str:
    return f"""grid AS (SELECT CAST(i // {width} AS INT) AS y, CAST(i % {width} AS INT) AS x
      FROM range({height * width}) t(i))"""


def median_map(source: str, height: int, width: int) -> str:
    return grid(height, width) + f""", med AS (
  SELECT g.y, g.x, CAST(m.med AS FLOAT) AS off FROM grid g LEFT JOIN (
    SELECT y, x, quantile_cont(CAST(adc AS DOUBLE), 0.5) AS med FROM {source}
    WHERE adc <> 0 AND adc <> 65535 GROUP BY y, x) m ON g.y = m.y AND g.x = m.x)"""


def clip_map(source: str, height: int, width: int, n_sigma: float, rounds: int = 5) -> str:
    """Unrolled clipping rounds; ``clip`` has the state at the common stop, ``trace`` the rounds."""
    spread = lambda ddof: (
        "sqrt(greatest(CAST(sum(adc * adc * n) AS DOUBLE) - CAST(sum(adc * n) AS DOUBLE) * "
        "(CAST(sum(adc * n) AS DOUBLE) / sum(n)), 0.0) / " + ("sum(n)" if ddof == 0 else "greatest(sum(n) - 1, 1)") + ")"
    )
    sql = f"""h AS (
  SELECT y, x, CAST(adc AS BIGINT) AS adc, count(*) AS n FROM {source} WHERE adc <> 0 AND adc <> 65535 GROUP BY y, x, adc),
r0 AS (SELECT y, x, CAST(sum(adc * n) AS DOUBLE) / sum(n) AS mu, {spread(0)} AS sd, sum(n) AS valid,
         CAST('inf' AS DOUBLE) AS keep FROM h GROUP BY y, x)"""
    for k in range(1, rounds + 1):
        sql += f""",
l{k} AS (SELECT y, x, least(keep, mu + {n_sigma} * sd) AS keep, mu AS old, valid FROM r{k - 1}),
r{k} AS (SELECT l.y, l.x, any_value(l.keep) AS keep, any_value(l.old) AS old, any_value(l.valid) AS valid,
         CAST(sum(adc * n) AS DOUBLE) / sum(n) AS mu, {spread(1)} AS sd, sum(n) AS kept
         FROM l{k} l JOIN h ON h.y = l.y AND h.x = l.x WHERE h.adc <= l.keep GROUP BY l.y, l.x)"""
    union = " UNION ALL ".join(
        f"SELECT {k} AS it, y, x, keep, mu, valid, kept, (mu - old) * (mu - old) > 1e-6 AS moved FROM r{k}"
        for k in range(1, rounds + 1)
    )
    return sql + f""",
states AS ({union}),
totals AS (SELECT it, CAST(sum(valid - kept) AS BIGINT) AS n_clipped, count(*) FILTER (WHERE moved) AS n_changed
           FROM states GROUP BY it),
stop AS (SELECT coalesce(min(it) FILTER (WHERE n_changed = 0), {rounds}) AS it FROM totals),
trace AS (SELECT it AS iteration, n_clipped, n_changed FROM totals WHERE it <= (SELECT it FROM stop)),
{grid(height, width)},
clip AS (SELECT g.y, g.x, CAST(coalesce(s.mu, 0) AS FLOAT) AS off, CAST(coalesce(s.valid - s.kept, 0) AS BIGINT) AS n_clipped,
         CAST(coalesce(s.kept, 0) AS BIGINT) AS n_kept, coalesce(s.keep, CAST('-inf' AS DOUBLE)) AS keep_max
         FROM grid g LEFT JOIN (SELECT * FROM states WHERE it = (SELECT it FROM stop)) s ON g.y = s.y AND g.x = s.x)"""


def noise_map(source: str, height: int, width: int) -> str:
    return f"""noise AS (
  SELECT y, x, CAST(stddev_samp(CAST(adc AS DOUBLE)) AS FLOAT) AS noise FROM {source}
  WHERE adc <> 0 AND adc <> 65535 GROUP BY y, x)"""


def quick(hot: float, cold: float) -> str:
    return f"""{median_map("ev", 8, 16)}, {noise_map("ev", 8, 16)},
ref AS (SELECT quantile_cont(CAST(noise AS DOUBLE), 0.5) AS m FROM noise WHERE noise > 0),
quick AS (SELECT g.y, g.x, m.off, n.noise,
  NOT coalesce(n.noise > 0, false) OR n.noise > {hot} * ref.m OR n.noise < {cold} * ref.m AS is_bad
  FROM grid g JOIN med m ON g.y = m.y AND g.x = m.x LEFT JOIN noise n ON g.y = n.y AND g.x = n.x CROSS JOIN ref)"""


QUICK = EV + ", " + quick(1.2, 0.8)


# -- common mode ------------------------------------------------------------------------------------
def residuals(source: str, offset: str, carry: str = "") -> str:
    return f"""res AS (SELECT p.frame_id, p.y, p.x, p.adc, CAST(p.adc AS FLOAT) - m.off AS r{carry}
      FROM {source} p JOIN {offset} m ON p.y = m.y AND p.x = m.x)"""


MEDIAN = "CAST(quantile_cont(CAST(r AS DOUBLE), 0.5) AS FLOAT)"


def group_medians(asic_width: int, split: bool, usable: str = "true") -> str:
    """``gm``: median per line, block and (if split) parity; ``cm``: stored value per line and block."""
    parity = f"(x % {asic_width}) % 2" if split else "0"
    combine = (
        "CASE WHEN count(v) = 2 THEN (min(v) FILTER (WHERE par = 0) + min(v) FILTER (WHERE par = 1)) "
        "* CAST(0.5 AS FLOAT) ELSE max(v) END"
        if split
        else "max(v)"
    )
    return f"""gm AS (SELECT frame_id, y, x // {asic_width} AS pos, {parity} AS par,
      CAST(quantile_cont(CAST(r AS DOUBLE), 0.5) FILTER (WHERE {usable}) AS FLOAT) AS v
      FROM res GROUP BY 1, 2, 3, 4),
cm AS (SELECT frame_id, y, pos, {combine} AS cm FROM gm GROUP BY frame_id, y, pos)"""


def corrected(asic_width: int, split: bool, carry: str = "") -> str:
    parity = f"(r.x % {asic_width}) % 2" if split else "0"
    return f"""corr AS (SELECT r.frame_id, r.y, r.x, r.adc, r.r - coalesce(g.v, CAST(0 AS FLOAT)) AS value{carry}
      FROM res r JOIN gm g ON g.frame_id = r.frame_id AND g.y = r.y AND g.pos = r.x // {asic_width} AND g.par = {parity})"""


VALID = "adc <> 0 AND adc <> 65535"
EMB_RES = f"{EMB}, {median_map('emb', 10, 64)}, {residuals('emb', 'med')}"
EV_RES = f"{EV}, {median_map('ev', 8, 16)}, {residuals('ev', 'med')}"


def asic(n: int, pos: str = "pos") -> str:
    return f"'C' || CAST({n - 1} - {pos} AS VARCHAR)"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


CLIP3 = f"{EV}, {clip_map('ev', 8, 16, 3.0)}"
CLIP_COLUMNS = """SELECT y, x, round(CAST(off AS DOUBLE), 6) AS offset_sigclip, n_clipped, n_kept,
  round(keep_max, 6) AS keep_max FROM clip"""
N_FRAMES = "(SELECT count(*) FROM ev WHERE y = 0 AND x = 0)"

# -- event maps and masks ------------------------------------------------------------------------------
EV_MAPS = f"""{CLIP3}, {noise_map('ev', 8, 16)},
maps AS (SELECT g.y, g.x, n.noise, c.n_clipped FROM grid g JOIN clip c ON g.y = c.y AND g.x = c.x
         LEFT JOIN noise n ON g.y = n.y AND g.x = n.x)"""


def flags(hot: float, cold: float, max_clip: float, active: str = "x // 8 <> 1") -> str:
    return f"""fref AS (SELECT quantile_cont(CAST(noise AS DOUBLE), 0.5) AS m FROM maps WHERE ({active}) AND noise > 0),
flags AS (SELECT y, x, noise, fref.m AS median_noise, {active} AS is_active, noise IS NULL AS non_finite,
  ({active}) AND coalesce(noise <= 0, false) AS non_positive,
  ({active}) AND coalesce(noise > {hot} * fref.m, false) AS hot,
  ({active}) AND coalesce(noise < {cold} * fref.m, false) AS cold,
  ({active}) AND n_clipped / CAST({N_FRAMES} AS DOUBLE) > {max_clip} AS unstable
  FROM maps CROSS JOIN fref),
mask AS (SELECT *, NOT is_active OR non_finite OR non_positive OR hot OR cold OR unstable AS is_bad FROM flags)"""


EV_MASK = f"{EV_MAPS}, {flags(1.2, 0.8, 0.05)}"
CATEGORIES = f"""{EV_MASK}, cat AS (SELECT y, x, is_bad, is_active,
  CAST(CASE WHEN non_finite THEN 3 WHEN cold THEN 2 WHEN hot THEN 1 WHEN is_bad THEN 4 ELSE 0 END AS INT) AS category
  FROM mask)"""
EV_CORR = f"{residuals('ev', 'medmap')}, {group_medians(8, False, VALID)}, {corrected(8, False)}"
# median map next to a clip map: reuse its grid
MEDMAP = """medmap AS (SELECT g.y, g.x, CAST(m.med AS FLOAT) AS off FROM grid g LEFT JOIN (
    SELECT y, x, quantile_cont(CAST(adc AS DOUBLE), 0.5) AS med FROM ev
    WHERE adc <> 0 AND adc <> 65535 GROUP BY y, x) m ON g.y = m.y AND g.x = m.x)"""
BRIGHT = """bright AS (SELECT c.y, c.x, count(*) FILTER (WHERE value > m.noise * CAST(1.0 AS DOUBLE)) AS n_above,
  count(*) FILTER (WHERE value < m.noise * CAST(-0.5 AS DOUBLE)) AS n_below, count(*) AS n
  FROM corr c JOIN maps m ON c.y = m.y AND c.x = m.x GROUP BY c.y, c.x)"""
HOT_OCC = """oref AS (SELECT quantile_cont(CAST(hit_count AS DOUBLE), 0.5) FILTER (WHERE hit_count > 0) AS h,
  quantile_cont(mean_adu, 0.5) FILTER (WHERE mean_adu > 0) AS a FROM occ),
hotocc AS (SELECT y, x, hit_count, mean_adu, coalesce(hit_count > 1.3 * h OR mean_adu > 1.2 * a, false) AS hot_occupancy
  FROM occ CROSS JOIN oref)"""
EV_OFFSETS = f"""{CLIP3}, {MEDMAP}, offs AS (SELECT c.y, c.x, m.off AS offset_median, c.off AS offset_sigclip, c.n_clipped
  FROM clip c JOIN medmap m ON c.y = m.y AND c.x = m.x)"""


def binned(values: str, low: str, high: str, bins: int) -> str:
    """Counts of the CTE column ``v`` of ``values`` in equal bins."""
    return f"""span AS (SELECT CAST({low} AS DOUBLE) AS lo, CAST({high} AS DOUBLE) AS hi FROM {values}),
placed AS (SELECT least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS INT), {bins - 1}) AS bin
           FROM {values} CROSS JOIN span WHERE v BETWEEN lo AND hi),
counted AS (SELECT bin, count(*) AS n FROM placed GROUP BY bin)
SELECT CAST(b AS INT) AS bin, round(lo + b * ((hi - lo) / {bins}), 6) AS lower, round(lo + (b + 1) * ((hi - lo) / {bins}), 6) AS upper,
       coalesce(n, 0) AS n FROM range({bins}) t(b) CROSS JOIN span LEFT JOIN counted ON counted.bin = b"""


# -- applying a calibration ---------------------------------------------------------------------------------
APPLY_RES = QUICK + """, res AS (SELECT e.frame_id, e.y, e.x, e.adc, q.is_bad,
  CASE WHEN NOT q.is_bad AND e.adc <> 0 AND e.adc <> 65535 THEN CAST(e.adc AS FLOAT) - q.off END AS r
  FROM ev e JOIN quick q ON e.y = q.y AND e.x = q.x)"""


def applied(width: int) -> str:
    return f"""{APPLY_RES}, gm AS (SELECT frame_id, y, x // {width} AS pos, {MEDIAN} AS v FROM res GROUP BY 1, 2, 3),
app AS (SELECT r.frame_id, r.y, r.x, r.adc, CAST(r.r - g.v AS DOUBLE) AS value FROM res r
  JOIN gm g ON g.frame_id = r.frame_id AND g.y = r.y AND g.pos = r.x // {width})"""


APPLIED_CM = f"""WITH {applied(8)} SELECT frame_id, y, CAST(pos AS INT) AS asic_pos, CAST(v AS DOUBLE) AS cm FROM gm"""

# -- full calibration of the event frames --------------------------------------------------------------------
FULL = f"""{CLIP3}, {MEDMAP}, {residuals('ev', 'clip', ', m.keep_max')}, {group_medians(8, True, VALID)},
{corrected(8, True, ', r.keep_max')},
kept AS (SELECT y, x, count(*) FILTER (WHERE {VALID} AND adc <= keep_max) AS n,
  stddev_samp(CAST(value AS DOUBLE)) FILTER (WHERE {VALID} AND adc <= keep_max) AS sd,
  sum(CAST(value AS DOUBLE)) FILTER (WHERE {VALID} AND adc <= keep_max) AS total FROM corr GROUP BY y, x),
fullnoise AS (SELECT y, x, n, CAST(CASE WHEN n >= 2 THEN sd WHEN n = 1 THEN abs(total) / 2 ELSE 0 END AS FLOAT) AS noise
  FROM kept),
maps AS (SELECT c.y, c.x, f.noise, c.n_clipped, c.off AS off_clip, m.off AS off_med FROM clip c
  JOIN fullnoise f ON c.y = f.y AND c.x = f.x JOIN medmap m ON c.y = m.y AND c.x = m.x)"""

# The range 4 .. 43 of the embedding frames, whole lines.
L1_MEDIAN = f"""{EMB}, part AS (SELECT * FROM emb), {median_map('part', 10, 64)},
{residuals('part', 'med')}, {group_medians(64, False, VALID)}, {corrected(64, False)},
maps AS (SELECT y, x, CAST(stddev_samp(CAST(value AS DOUBLE)) AS FLOAT) AS noise FROM corr GROUP BY y, x),
ref AS (SELECT quantile_cont(CAST(noise AS DOUBLE), 0.5) AS m FROM maps WHERE noise > 0)"""

MARKS = """marks AS (SELECT frame_id, count(*) FILTER (WHERE x = 0 AND adc IN (0, 65535)) AS n_bad_markers FROM ev GROUP BY frame_id)"""

ORACLES: dict[str, str] = {
    "a3_frame_inventory": f"""WITH {EV_ALL}, s AS (SELECT frame_id, count(*) AS n FROM ev_all GROUP BY frame_id)
        SELECT count(*) FILTER (WHERE n = 128) AS n_frames,
               CAST(coalesce(sum(n) FILTER (WHERE n <> 128), 0) AS BIGINT) AS orphan_records FROM s""",
    "a3_complete_frames": f"""WITH {EV} SELECT frame_id, count(*) AS n_pixels, CAST(sum(adc) AS BIGINT) AS sum_adc
        FROM ev GROUP BY frame_id""",
    "a4_frame_selection": f"""WITH {EMB_ROWS} SELECT CAST(CASE WHEN frame_id >= 20 THEN 1 ELSE 0 END AS INT) AS file_id,
        CASE WHEN frame_id >= 20 THEN frame_id - 20 ELSE frame_id END AS frame_id, frame_id AS frame_seq,
        count(*) AS n_lines, CAST(sum(pixels[4]) AS BIGINT) AS sum_column_3
        FROM emb_rows WHERE frame_id BETWEEN 5 AND 34 GROUP BY emb_rows.frame_id""",
    "a6_concat_frames": f"""WITH {EMB_ROWS} SELECT CAST(f AS INT) AS file_id, frame_id, count(*) AS n_lines,
        CAST(sum(pixels[64]) AS BIGINT) AS sum_last FROM emb_rows CROSS JOIN range(2) t(f) GROUP BY f, frame_id""",
    "a1_a5_raw_round_trip": f"""WITH {EMB_ROWS} SELECT frame_id AS frame_seq, y,
        CAST(CASE WHEN y = 0 THEN 65535 ELSE 65534 END AS INT) AS marker, pixels[1] AS first_adc, pixels[64] AS last_adc FROM emb_rows""",
    "a8_point_read": f"""WITH {EMB_ROWS}, want(pos, frame_id) AS (VALUES (0, 7), (1, 3), (2, 41), (3, 3))
        SELECT CAST(w.pos AS INT) AS pos, e.frame_id, e.y, e.pixels[1] AS first_adc, e.pixels[64] AS last_adc
        FROM want w JOIN emb_rows e ON e.frame_id = w.frame_id""",
    "a9_marker_status": f"""WITH {EV}, {MARKS} SELECT frame_id, n_bad_markers, n_bad_markers = 0 AS markers_ok FROM marks""",
    "a10_extract_frames": f"""WITH {EMB_ROWS} SELECT frame_id, y, CAST(y // 5 AS INT) AS band, pixels[1] AS first_adc
        FROM emb_rows WHERE frame_id BETWEEN 10 AND 34""",
    "a11_a12_stored_calibration": f"""WITH {QUICK} SELECT y, x, round(CAST(off AS DOUBLE), 6) AS "offset",
        round(CAST(noise AS DOUBLE), 6) AS noise, is_bad, 'median' AS offset_type FROM quick""",
    "a11_published_sets": f"""WITH {QUICK} SELECT y, x, round(CAST(off AS DOUBLE), 6) AS "offset", is_bad AS is_bad_first,
        NOT is_bad AS is_bad_last, CAST(2 AS INT) AS n_versions FROM quick""",
    "a13_map_shape": f"""WITH {EV}, {OCC} SELECT count(*) AS n_rows, count(DISTINCT y * 16 + x) AS n_pixels,
        count(*) FILTER (WHERE y NOT BETWEEN 0 AND 7 OR x NOT BETWEEN 0 AND 15) AS n_outside FROM occ""",
    "b1_valid_values": f"""WITH {EV_ALL} SELECT y, x, count(*) FILTER (WHERE {VALID}) AS n_valid,
        count(*) FILTER (WHERE NOT ({VALID})) AS n_sentinel FROM ev_all GROUP BY y, x""",
    "b2_b3_excluded_pixels": f"""WITH {QUICK} SELECT e.frame_id, count(*) FILTER (WHERE adc = 65535) AS n_overflow,
        count(*) FILTER (WHERE adc = 0) AS n_underflow,
        count(*) FILTER (WHERE is_bad OR adc = 65535 OR adc = 0) AS n_excluded
        FROM ev e JOIN quick q ON e.y = q.y AND e.x = q.x GROUP BY e.frame_id""",
    "b4_asic_geometry": f"""WITH {LI} SELECT CAST(x // 8 AS INT) AS asic_pos, {asic(8, 'x // 8')} AS asic, count(*) AS n,
        min(x) AS x_min, max(x) AS x_max FROM li GROUP BY x // 8""",
    "b4_asic_uneven": f"""WITH {LI} SELECT CASE WHEN x // 9 < 7 THEN {asic(7, 'x // 9')} END AS asic, x // 9 <> 0 AS active,
        count(*) AS n FROM li GROUP BY ALL""",
    "b5_active_pixels": f"""WITH {LI} SELECT y, x, x // 8 NOT IN (0, 5) AS active, count(*) AS n FROM li GROUP BY y, x""",
    "b6_apply_validity": f"""WITH {QUICK} SELECT e.y, e.x,
        count(*) FILTER (WHERE NOT is_bad AND {VALID} AND off IS NOT NULL) AS n_valid
        FROM ev e JOIN quick q ON e.y = q.y AND e.x = q.x GROUP BY e.y, e.x""",
    "b7_c1_offset_subtraction": f"""WITH {EV_RES} SELECT frame_id, y, x, CAST(r AS DOUBLE) AS residual FROM res""",
    "b8_b9_masked_values": f"""WITH {EV} SELECT y, x, count(*) FILTER (WHERE NOT ({VALID})) AS n_nan,
        round(avg(adc) FILTER (WHERE {VALID}), 6) AS mean_finite FROM ev GROUP BY y, x""",
    "d1_median_offset": f"""WITH {EV}, {median_map('ev', 8, 16)} SELECT y, x, CAST(off AS DOUBLE) AS offset_median FROM med""",
    "d1_median_offset_lineitem": f"""WITH {LI}, {median_map('li', 16, 64)}
        SELECT y, x, CAST(off AS DOUBLE) AS offset_median FROM med""",
    "d2_d3_sigma_clip": f"WITH {CLIP3} {CLIP_COLUMNS}",
    "d2_d3_sigma_clip_early_stop": f"WITH {EV}, {clip_map('ev', 8, 16, 4.5)} {CLIP_COLUMNS}",
    "d2_d3_sigma_clip_lineitem": f"WITH {LI}, {clip_map('li', 16, 64, 1.2)} {CLIP_COLUMNS}",
    "d4_clip_trace": f"""WITH {EV}, {clip_map('ev', 8, 16, 4.5)} SELECT CAST(iteration AS INT) AS iteration, n_clipped, n_changed
        FROM trace""",
    "d4_clip_summary": f"""WITH {CLIP3} SELECT round(avg(n_clipped), 6) AS avg_clipped,
        round(avg(n_clipped) / {N_FRAMES} * 100.0, 6) AS avg_clipped_percent, max(n_clipped) AS max_clipped FROM clip""",
    "d5_noise_all_frames": f"""WITH {EMB_RES}, {group_medians(8, False, VALID)}, {corrected(8, False)}
        SELECT y, x, round(CAST(CAST(stddev_samp(CAST(value AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS noise FROM corr GROUP BY y, x""",
    "d6_noise_kept": f"""WITH {CLIP3}, {residuals('ev', 'clip', ', m.keep_max')}, {group_medians(8, False, VALID)},
        {corrected(8, False, ', r.keep_max')}
        SELECT y, x, round(CAST(CAST(CASE WHEN count(*) FILTER (WHERE k) >= 2
            THEN stddev_samp(CAST(value AS DOUBLE)) FILTER (WHERE k)
            ELSE coalesce(abs(sum(CAST(value AS DOUBLE)) FILTER (WHERE k)) / 2, 0) END AS FLOAT) AS DOUBLE), 6) AS noise,
          count(*) FILTER (WHERE k) AS n_kept
        FROM (SELECT *, {VALID} AND adc <= keep_max AS k FROM corr) GROUP BY y, x""",
    "d6_kept_summary": f"""WITH {CLIP3} SELECT round(avg(n_kept), 6) AS avg_kept,
        round(avg(n_kept) / {N_FRAMES} * 100.0, 6) AS avg_kept_percent FROM clip""",
    "d7_residual_noise": f"""WITH {EV_RES} SELECT y, x,
        round(CAST(CAST(stddev_samp(CAST(r AS DOUBLE)) FILTER (WHERE {VALID}) AS FLOAT) AS DOUBLE), 6) AS noise FROM res GROUP BY y, x""",
    "d7_histogram_noise_lineitem": f"""WITH {LI}, {grid(16, 64)}, {noise_map('li', 16, 64)}
        SELECT g.y, g.x, round(CAST(noise AS DOUBLE), 6) AS noise FROM grid g LEFT JOIN noise n ON g.y = n.y AND g.x = n.x""",
    "d8_cm_noise": f"""WITH {EMB_RES}, {group_medians(8, True, VALID)}
        SELECT {asic(8)} AS asic, y, round(CAST(CAST(stddev_samp(CAST(cm AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS cm_noise FROM cm GROUP BY pos, y""",
    "d8_cm_noise_rows": f"""WITH {EMB_RES}, {group_medians(64, False, VALID)}
        SELECT y, round(CAST(CAST(stddev_samp(CAST(cm AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS cm_noise FROM cm GROUP BY y""",
    "e1_e3_cm_asic": f"""WITH {EMB_RES}, {group_medians(8, False, VALID)}
        SELECT frame_id, y, {asic(8)} AS asic, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e1_e3_cm_without_sentinels": f"""WITH {EV_RES}, {group_medians(8, False, VALID)}
        SELECT frame_id, y, {asic(2)} AS asic, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e1_e3_cm_with_sentinels": f"""WITH {EV_RES}, {group_medians(8, False)}
        SELECT frame_id, y, {asic(2)} AS asic, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e1_c5_cm_without_bad_pixels": f"""WITH {QUICK},
        res AS (SELECT e.frame_id, e.y, e.x, e.adc, q.is_bad, CAST(e.adc AS FLOAT) - q.off AS r
                FROM ev e JOIN quick q ON e.y = q.y AND e.x = q.x),
        {group_medians(8, False, VALID + ' AND NOT is_bad')}
        SELECT frame_id, y, {asic(2)} AS asic, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e2_e4_cm_even_odd": f"""WITH {EMB_RES}, {group_medians(8, True, VALID)}
        SELECT frame_id, y, {asic(8)} AS asic, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e5_cm_row": f"""WITH {EMB_RES}, {group_medians(64, False, VALID)} SELECT frame_id, y, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e5_cm_row_even_odd": f"""WITH {EV_RES}, {group_medians(16, True, VALID)}
        SELECT frame_id, y, CAST(cm AS DOUBLE) AS cm FROM cm""",
    "e6_c6_corrected_frames": f"""WITH {EMB_RES}, {group_medians(8, True, VALID)}, {corrected(8, True)}
        SELECT frame_id, y, x, CAST(value AS DOUBLE) AS value FROM corr""",
    "e6_c6_corrected_sentinels": f"""WITH {EV_RES}, {group_medians(8, False, VALID)}, {corrected(8, False)}
        SELECT frame_id, y, x, CAST(value AS DOUBLE) AS value FROM corr""",
    "h1_c6_window_median": f"""WITH {EV_RES}, {group_medians(8, True, VALID)}, {corrected(8, True, ', g.v AS cm')}
        SELECT frame_id, y, x, CAST(cm AS DOUBLE) AS cm, CAST(value AS DOUBLE) AS value FROM corr""",
    "e7_apply_asic": f"WITH {applied(8)} SELECT frame_id, y, x, value FROM app",
    "e7_apply_row": f"WITH {applied(16)} SELECT frame_id, y, x, value FROM app",
    "e7_applied_cm": APPLIED_CM,
    "f1_classified_pixels": f"""WITH {EV_MASK} SELECT y, x, is_active, non_finite, non_positive, hot, cold, unstable, is_bad FROM mask""",
    "f2_class_counts": f"""WITH {EV_MASK} SELECT round(any_value(median_noise), 6) AS median_noise, count(*) FILTER (WHERE hot) AS n_hot,
        count(*) FILTER (WHERE cold) AS n_cold, count(*) FILTER (WHERE non_finite AND is_active) AS n_non_finite,
        count(*) FILTER (WHERE unstable) AS n_unstable, count(*) FILTER (WHERE is_bad AND is_active) AS n_bad_active,
        count(*) FILTER (WHERE is_active) AS n_active,
        round(count(*) FILTER (WHERE is_bad AND is_active) * 100.0 / count(*) FILTER (WHERE is_active), 6) AS bad_percent FROM mask""",
    "f3_simple_mask": f"WITH {QUICK} SELECT y, x, is_bad FROM quick",
    "f4_bright_pixels": f"""WITH {EV_MAPS}, {MEDMAP}, {EV_CORR}, {BRIGHT}
        SELECT y, x, n_above, n_above >= n * 0.16 AS bright FROM bright""",
    "f5_empty_pixels": f"""WITH {EV_MAPS}, {MEDMAP}, {EV_CORR}, {BRIGHT}
        SELECT y, x, n_below, n_below >= n * 0.16 AS "empty" FROM bright""",
    "f6_hot_by_occupancy": f"""WITH {EV}, {OCC}, {HOT_OCC}
        SELECT y, x, hit_count, round(mean_adu, 6) AS mean_adu, hot_occupancy FROM hotocc""",
    "f7_comprehensive_mask": f"""WITH {EV_MAPS}, {MEDMAP}, {EV_CORR}, {BRIGHT}, {OCC}, {HOT_OCC},
        cref AS (SELECT quantile_cont(CAST(noise AS DOUBLE), 0.5) AS m FROM maps WHERE x // 8 <> 1),
        rules AS (SELECT p.y, p.x, p.x // 8 = 1 AS outside, p.noise > 1.2 * m AS noisy, p.noise < 0.8 * m AS cold,
          n_clipped / CAST({N_FRAMES} AS DOUBLE) > 0.05 AS overclipped, n_above >= n * 0.16 AS bright,
          n_below >= n * 0.16 AS "empty", hot_occupancy
          FROM maps p CROSS JOIN cref JOIN bright b ON b.y = p.y AND b.x = p.x JOIN hotocc o ON o.y = p.y AND o.x = p.x)
        SELECT *, outside OR noisy OR cold OR overclipped OR bright OR "empty" OR hot_occupancy AS is_bad FROM rules""",
    "f8_categories": f"WITH {CATEGORIES} SELECT y, x, category FROM cat",
    "f8_category_counts": f"""WITH {CATEGORIES} SELECT count(*) FILTER (WHERE NOT is_bad AND is_active) AS n_good,
        count(*) FILTER (WHERE category = 1) AS n_hot, count(*) FILTER (WHERE category = 2) AS n_cold,
        count(*) FILTER (WHERE category = 3 AND is_active) AS n_non_finite,
        count(*) FILTER (WHERE is_bad) - count(*) FILTER (WHERE category IN (1, 2) OR category = 3 AND is_active) AS n_other
        FROM cat""",
    "f9_bad_per_asic": f"""WITH {EV_MASK} SELECT {asic(2, 'x // 8')} AS asic, count(*) FILTER (WHERE is_bad) AS n_bad
        FROM mask GROUP BY x // 8""",
    "f10_mask_total": f"""WITH {EV_MASK} SELECT count(*) FILTER (WHERE is_bad) AS n_bad, count(*) FILTER (WHERE is_active) AS n_active,
        round(count(*) FILTER (WHERE is_bad) * 100.0 / count(*) FILTER (WHERE is_active), 6) AS bad_percent FROM mask""",
    "h6_bad_coordinates": f"WITH {EV_MASK} SELECT y, x FROM mask WHERE is_bad",
    "g1_offset_summary": f"""WITH {CLIP3}, v AS (SELECT CAST(off AS DOUBLE) AS v FROM clip) SELECT count(v) AS n, round(avg(v), 6) AS mean,
        round(stddev_pop(v), 6) AS std, round(quantile_cont(v, 0.5), 6) AS median FROM v""",
    "g2_offset_histogram": f"""WITH {EV}, {median_map('ev', 8, 16)}, vals AS (SELECT CAST(off AS DOUBLE) AS v FROM med WHERE x // 8 <> 1),
        {binned('vals', 'quantile_cont(v, 0.005)', 'quantile_cont(v, 0.995)', 200)}""",
    "g3_noise_histogram": f"""WITH {EV}, {noise_map('ev', 8, 16)}, vals AS (SELECT CAST(noise AS DOUBLE) AS v FROM noise WHERE x // 8 <> 1 AND noise > 0),
        {binned('vals', '0.0', 'quantile_cont(v, 0.995)', 200).replace('SELECT CAST(0.0', 'SELECT DISTINCT CAST(0.0')}""",
    "g4_full_histogram": f"""WITH {EV_RES}, {group_medians(8, False, VALID)}, {corrected(8, False)},
        vals AS (SELECT CAST(value AS DOUBLE) AS v FROM corr), {binned('vals', 'min(v)', 'max(v)', 100)}""",
    "g5_adjusted_edges": f"""WITH {EV}, {OCC}, p AS (SELECT quantile_cont(mean_adu, 0.005) AS lo, quantile_cont(mean_adu, 0.995) AS hi FROM occ)
        SELECT CAST(i AS INT) AS i, round(lo + (hi - lo) * i / 50, 6) AS edge FROM range(51) t(i) CROSS JOIN p""",
    "g6_offset_limits": f"""WITH {EV_OFFSETS}, v AS (SELECT CAST(offset_median AS DOUBLE) AS v FROM offs UNION ALL
        SELECT CAST(offset_sigclip AS DOUBLE) FROM offs)
        SELECT round(quantile_cont(v, 0.01), 6) AS p1, round(quantile_cont(v, 0.99), 6) AS p99 FROM v""",
    "g6_cm_limits": f"""WITH {EMB_RES}, {group_medians(8, True, VALID)}
        SELECT {asic(8)} AS asic, round(quantile_cont(abs(CAST(cm AS DOUBLE)), 0.99), 6) AS "limit" FROM cm GROUP BY pos""",
    "g7_frame_limits": f"""WITH {applied(8)}, q AS (SELECT frame_id, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
        FROM app GROUP BY frame_id)
        SELECT frame_id, round(coalesce(lo, 0), 6) AS lo, round(coalesce(CASE WHEN hi = lo THEN lo + 1 ELSE hi END, 1), 6) AS hi FROM q""",
    "g8_c8_offset_difference": f"""WITH {EV_OFFSETS} SELECT y, x,
        CASE WHEN x // 8 <> 1 THEN round(CAST(offset_median - offset_sigclip AS DOUBLE), 6) END AS diff FROM offs""",
    "g9_cm_frame_average": f"""WITH {EMB_RES}, {group_medians(8, False, VALID)}
        SELECT frame_id, {asic(8)} AS asic, round(avg(CAST(cm AS DOUBLE)), 6) AS avg_cm FROM cm GROUP BY frame_id, pos""",
    "g10_cm_noise_profile": f"""WITH {EV_RES}, {group_medians(8, False, VALID)}
        SELECT {asic(2)} AS asic, y, round(CAST(CAST(stddev_samp(CAST(cm AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS cm_noise FROM cm GROUP BY pos, y""",
    "g11_clip_map_summary": f"""WITH {CLIP3} SELECT round(avg(n_clipped), 6) AS avg_clipped, greatest(max(n_clipped), 1) AS scale_max FROM clip""",
    "g12_l3_frame_report": f"""WITH {applied(8)}, {MARKS},
        px AS (SELECT frame_id, count(*) - count(value) AS n_masked, min(value) AS lo, max(value) AS hi, avg(value) AS mean,
               stddev_pop(value) AS sd FROM app GROUP BY frame_id),
        c AS (SELECT frame_id, count(v) AS cm_entries, avg(CAST(v AS DOUBLE)) AS cm_mean, stddev_pop(CAST(v AS DOUBLE)) AS cm_std
              FROM gm GROUP BY frame_id)
        SELECT px.frame_id, n_masked, round(lo, 6) AS min_value, round(hi, 6) AS max_value, round(mean, 6) AS mean_value,
          round(sd, 6) AS std_value, round(cm_mean, 6) AS cm_mean, round(cm_std, 6) AS cm_std, cm_entries, n_bad_markers,
          (SELECT count(*) FROM quick WHERE is_bad) AS n_bad_pixels
        FROM px JOIN c ON c.frame_id = px.frame_id JOIN marks m ON m.frame_id = px.frame_id""",
    "g13_noise_without_bad": f"""WITH {EV_MASK} SELECT y, x, CASE WHEN NOT is_bad THEN round(CAST(noise AS DOUBLE), 6) END AS noise FROM mask""",
    "g13_mask_size": f"WITH {EV_MASK} SELECT count(*) FILTER (WHERE is_bad) AS n_bad FROM mask",
    "g14_stored_diagnostics": f"""WITH {EV}, {noise_map('ev', 8, 16)}, vals AS (SELECT CAST(noise AS DOUBLE) AS v FROM noise),
        {binned('vals', 'min(v)', 'max(v)', 100)}""",
    "k1_map_chunks": f"""WITH {EMB} SELECT CAST(frame_id // 16 AS INT) AS chunk_id, count(DISTINCT frame_id) AS n_frames,
        CAST(sum(adc) AS BIGINT) AS sum_adc, max(adc) AS max_adc FROM emb GROUP BY frame_id // 16""",
    "l1_calibration": f"""WITH {FULL}, {flags(1.3, 0.7, 0.05)}
        SELECT k.y, k.x, round(CAST(off_med AS DOUBLE), 6) AS offset_median, round(CAST(off_clip AS DOUBLE), 6) AS offset_sigclip,
          round(CAST(k.noise AS DOUBLE), 6) AS noise, n_clipped, is_bad
        FROM mask k JOIN maps m ON k.y = m.y AND k.x = m.x""",
    "l1_cm_noise": f"""WITH {FULL} SELECT {asic(2)} AS asic, y,
        round(CAST(CAST(stddev_samp(CAST(cm AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS cm_noise FROM cm GROUP BY pos, y""",
    "l1_median_calibration": f"""WITH {L1_MEDIAN} SELECT p.y, p.x, round(CAST(off AS DOUBLE), 6) AS offset_median,
        round(CAST(noise AS DOUBLE), 6) AS noise, noise <= 0 OR noise > 5.0 * ref.m OR noise < 0.1 * ref.m AS is_bad
        FROM maps p JOIN med o ON p.y = o.y AND p.x = o.x CROSS JOIN ref""",
    "l2_quick_calibration": f"""WITH {QUICK} SELECT y, x, round(CAST(off AS DOUBLE), 6) AS "offset", round(CAST(noise AS DOUBLE), 6) AS noise, is_bad
        FROM quick""",
    "j_stream_applied_cm": APPLIED_CM,
}

ORACLES["a8_raw_point_read"] = ORACLES["a8_point_read"]
ORACLES["a4_raw_limits"] = f"""WITH {EMB_ROWS} SELECT frame_id AS frame_seq, y, pixels[1] AS first_adc FROM emb_rows WHERE y < 5"""
ORACLES["k1_raw_chunks"] = ORACLES["k1_map_chunks"]
ORACLES["j_stream_raw"] = ORACLES["a1_a5_raw_round_trip"]
ORACLES["j_stream_frame_report"] = ORACLES["g12_l3_frame_report"]

IRREGULAR = "CASE WHEN x BETWEEN 3 AND 9 THEN 'left' WHEN x BETWEEN 10 AND 30 THEN 'middle' WHEN x BETWEEN 40 AND 62 THEN 'right' END"
ORACLES["c4_irregular_slices"] = f"""WITH {LI} SELECT {IRREGULAR} AS asic, count(*) AS n, min(x) AS x_min, max(x) AS x_max FROM li GROUP BY 1"""
ORACLES["c4_slice_statistics"] = f"""WITH {LI} SELECT {IRREGULAR} AS asic, count(*) AS n, round(avg(CAST(adc AS DOUBLE)), 6) AS mean,
    round(stddev_pop(CAST(adc AS DOUBLE)), 6) AS std FROM li GROUP BY 1"""
ORACLES["e3_irregular"] = f"""WITH {EMB_RES} SELECT frame_id, y, {IRREGULAR} AS asic, CAST({MEDIAN} AS DOUBLE) AS cm
    FROM res WHERE {VALID} AND {IRREGULAR} IS NOT NULL GROUP BY frame_id, y, {IRREGULAR}"""
ORACLES["d2_incremental"] = ORACLES["d2_d3_sigma_clip"]
ORACLES["d1_incremental_lines"] = f"SELECT * FROM ({ORACLES['d1_median_offset']}) WHERE y IN (2, 3, 7)"
ORACLES["a1_transposed"] = f"""WITH {EMB} SELECT x AS y, y AS x, count(*) AS n, CAST(sum(adc) AS BIGINT) AS sum_adc FROM emb GROUP BY 1, 2"""

DIFFS = "SELECT CAST(offset_median - offset_sigclip AS DOUBLE) AS v FROM offs"
ORACLES["g2_difference_histogram"] = f"""WITH {EV_OFFSETS}, vals AS ({DIFFS} WHERE x // 8 <> 1),
    {binned('vals', 'quantile_cont(v, 0.005)', 'quantile_cont(v, 0.995)', 200)}"""
ORACLES["g3_noise_histogram_all"] = f"""WITH {EV}, {noise_map('ev', 8, 16)}, vals AS (SELECT CAST(noise AS DOUBLE) AS v FROM noise),
    {binned('vals', '0.0', 'quantile_cont(v, 0.995)', 200).replace('SELECT CAST(0.0', 'SELECT DISTINCT CAST(0.0')}"""
ORACLES["g4_cm_histogram"] = f"""WITH {EMB_RES}, {group_medians(8, False, VALID)}, vals AS (SELECT CAST(cm AS DOUBLE) AS v FROM cm),
    {binned('vals', 'min(v)', 'max(v)', 100)}"""
ORACLES["g5_event_edges"] = f"""WITH {EV}, p AS (SELECT quantile_cont(CAST(adc AS DOUBLE), 0.005) AS lo, quantile_cont(CAST(adc AS DOUBLE), 0.995) AS hi FROM ev)
    SELECT CAST(i AS INT) AS i, round(lo + (hi - lo) * i / 50, 6) AS edge FROM range(51) t(i) CROSS JOIN p"""
ORACLES["g6_noise_limits"] = f"""WITH {EV}, {noise_map('ev', 8, 16)} SELECT round(quantile_cont(CAST(noise AS DOUBLE), 0.99), 6) AS p99 FROM noise"""
ORACLES["g6_difference_limits"] = f"""WITH {EV_OFFSETS}, d AS ({DIFFS}) SELECT round(quantile_cont(abs(v), 0.99), 6) AS p99 FROM d"""
RUN_MASKS = f"""{EV}, bad AS (SELECT y, x, frame_id % 3 AS run FROM ev GROUP BY ALL HAVING count(*) FILTER (WHERE adc > 1000) >= 3),
    found AS (SELECT y, x, count(*) AS n, max(CAST(run = 0 AS INT)) AS first FROM bad GROUP BY y, x),
    held AS (SELECT 'any' AS held_in, y, x FROM found UNION ALL SELECT 'all', y, x FROM found WHERE n = 3
             UNION ALL SELECT 'first', y, x FROM found WHERE n = 1 AND first = 1)"""
ORACLES["h5_mask_algebra"] = f"WITH {RUN_MASKS} SELECT held_in, CAST(y AS INT) AS y, CAST(x AS INT) AS x FROM held"
ORACLES["h5_mask_sizes"] = f"""WITH {RUN_MASKS} SELECT h AS held_in, (SELECT count(*) FROM held WHERE held_in = h) AS n_pixels
    FROM (VALUES ('any'), ('all')) t(h)"""
