"""The same results as ANSI SQL over the test tables, for an independent engine."""

from __future__ import annotations

from epochloom.constants import BANDS, TRAIN_RATIO

_FS = 64
_KEYS = "l_orderkey, l_linenumber, l_partkey"
_LINE_ORDER = f"time, {_KEYS}, l_extendedprice, c3, cz, c4"
_CHANNELS = ("C3", "Cz", "C4")
_CLASSES = "(VALUES ('A', 1), ('N', 2), ('R', 3)) AS classes(label, place)"

_SAMPLES = """samples AS (
  SELECT l_suppkey AS subject_id, l_linestatus AS run_id,
         epoch_us(l_shipdate) / 1000000.0 AS time, l_returnflag AS task_label,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         l_quantity AS c3, l_discount AS cz, l_tax AS c4
  FROM lineitem)"""

_EPOCHS = f"""{_SAMPLES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id, run_id ORDER BY {_LINE_ORDER}) - 1 AS rn,
         count(*) OVER (PARTITION BY subject_id, run_id) AS n
  FROM samples), epochs AS (
  SELECT *, rn // {_FS} AS epoch_id, rn % {_FS} AS pos FROM numbered WHERE rn // {_FS} < n // {_FS})"""

_LABEL_COUNTS = """label_counts AS (
  SELECT subject_id, run_id, epoch_id, task_label, count(*) AS k FROM epochs GROUP BY ALL),
majority AS (
  SELECT subject_id, run_id, epoch_id, task_label FROM label_counts
  QUALIFY row_number() OVER (PARTITION BY subject_id, run_id, epoch_id ORDER BY k DESC, task_label) = 1)"""


def _power(signal: str, pos: str, size: int) -> str:
    angle = f"2 * pi() * ((k * {pos}) % {size}) / {size}"
    return f"power(sum({signal} * cos({angle})), 2) + power(sum({signal} * sin({angle})), 2)"


def _band(power: str, band: str, hz: float) -> str:
    low, high = BANDS[band]
    return f"coalesce(avg({power}) FILTER (WHERE k * {hz} >= {low} AND k * {hz} < {high}), 0.0)"


_LINE_FEATURES = f"""{_EPOCHS}, {_LABEL_COUNTS}, bins AS (SELECT range AS k FROM range(4, 33)),
spectrum AS (
  SELECT subject_id, run_id, epoch_id, k,
         {", ".join(f"{_power(c, 'pos', 64)} AS p_{c}" for c in _CHANNELS)}
  FROM epochs, bins GROUP BY ALL),
powers AS (
  SELECT subject_id, run_id, epoch_id,
         {", ".join(f"{_band(f'p_{c}', b, 1)} AS {c}_{b}" for c in _CHANNELS for b in BANDS)}
  FROM spectrum GROUP BY ALL),
features AS (SELECT * FROM powers JOIN majority USING (subject_id, run_id, epoch_id))"""

_VECTORS = """cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos
  FROM embeddings)"""

_VECTOR_FEATURES = f"""{_VECTORS}, bins AS (SELECT range AS k FROM range(0, 17)),
spectrum AS (
  SELECT vec_id, label, pos // 32 AS half, k, {_power("v", "(pos % 32)", 32)} AS p
  FROM cells, bins GROUP BY ALL),
powers AS (
  SELECT vec_id, label, half, {", ".join(f"{_band('p', b, 2)} AS {b}" for b in BANDS)}
  FROM spectrum GROUP BY ALL),
wide AS (
  SELECT vec_id, 'T' || (label % 3) AS task_label,
         {", ".join(f"max({b}) FILTER (WHERE half = {h}) AS {c}_{b}" for h, c in enumerate(("C3", "C4")) for b in BANDS)}
  FROM powers GROUP BY vec_id, label),
features AS (
  SELECT *, {", ".join(f"C3_{b} - C4_{b} AS diff_{b}" for b in BANDS)} FROM wide)"""


def _predictions(low: float = 0.04, high: float = 0.07) -> str:
    return f"""predictions AS (
  SELECT l_suppkey AS subject_id, {_KEYS}, l_returnflag AS task_label,
         CASE WHEN l_discount < {low} THEN 0.0 WHEN l_discount < {high} THEN 1.0 ELSE 2.0 END::DOUBLE AS prediction,
         CASE WHEN l_discount < {low} THEN 'A' WHEN l_discount < {high} THEN 'N' ELSE 'R' END AS pred_label
  FROM lineitem)"""


def _scores(keys: str = "") -> str:
    group = f"{keys}, " if keys else ""
    return f"""counts AS (
  SELECT {group}label, place,
         count(*) FILTER (WHERE task_label = label AND pred_label = label) AS tp,
         count(*) FILTER (WHERE task_label <> label AND pred_label = label) AS fp,
         count(*) FILTER (WHERE task_label = label AND pred_label <> label) AS fn
  FROM predictions, {_CLASSES} GROUP BY ALL),
rates AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS recall FROM counts),
scores AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM rates),
weighted AS (
  SELECT {group}sum(tp)::DOUBLE / sum(tp + fn) AS accuracy,
         sum((tp + fn) * f1) / sum(tp + fn) AS f1,
         sum((tp + fn) * precision) / sum(tp + fn) AS precision_weighted,
         sum((tp + fn) * recall) / sum(tp + fn) AS recall_weighted
  FROM scores {f"GROUP BY {keys}" if keys else ""})"""


_WEIGHTED = (
    "round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, "
    "round(precision_weighted, 6) AS precision_weighted, round(recall_weighted, 6) AS recall_weighted"
)

_LIVE = """live AS (
  SELECT event_id, user_id, ts, event_type AS true_label,
         CASE WHEN value < 8 THEN 'click' WHEN value < 30 THEN 'view' ELSE 'error' END AS pred_label,
         epoch_us(ts) // 3600000000 AS epoch_id, (value > 30)::BIGINT AS correct
  FROM events)"""

_LATEST = f"""{_LIVE}, latest AS (
  SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY epoch_id ORDER BY ts DESC, event_id DESC) = 1)"""

_SITES = f"""{_VECTORS}, means AS (
  SELECT 'T' || (label % 3) AS task_label, pos, avg(v) AS value FROM cells GROUP BY ALL),
levels AS (SELECT pos, avg(value) AS level FROM means GROUP BY pos),
ring AS (SELECT *, 1.0 - (2.0 * pos + 1.0) / (SELECT max(pos) + 1 FROM levels) AS h FROM levels),
sites AS (
  SELECT 'E' || pos AS name, level, 0.095 * sqrt(1.0 - h * h) * cos(pos * 2.399963229728653::DOUBLE) AS x,
         0.095 * sqrt(1.0 - h * h) * sin(pos * 2.399963229728653::DOUBLE) AS y, 0.095 * h AS z FROM ring),
angles AS (
  SELECT *, acos(z / greatest(sqrt(x * x + y * y + z * z), 1e-9)) AS theta, atan2(y, x) AS phi FROM sites),
flat AS (
  SELECT *, sin(theta) / (1 + cos(theta) + 1e-9) * cos(phi) AS px,
         sin(theta) / (1 + cos(theta) + 1e-9) * sin(phi) AS py FROM angles),
radius AS (SELECT greatest(1.05 * max(sqrt(px * px + py * py)), 0.6) AS r FROM flat)"""

_RULE = "CASE WHEN C3_alpha > 15000 THEN 'A' WHEN C3_alpha > 11000 THEN 'N' ELSE 'R' END"
_MAP_ROWS = f"""
SELECT subject_id, run_id, epoch_id, channel, round(alpha, 4) AS alpha_power,
       task_label AS true_label, pred_label{{more}}
FROM (SELECT *, {_RULE} AS pred_label FROM features) AS f,
     LATERAL (VALUES ('C3', C3_alpha), ('Cz', Cz_alpha), ('C4', C4_alpha)) AS c(channel, alpha)"""


def _split(side: str) -> str:
    return f"""WITH subjects AS (SELECT DISTINCT l_suppkey FROM lineitem), placed AS (
  SELECT l_suppkey, row_number() OVER (ORDER BY l_suppkey) - 1 < floor(count(*) OVER () * {TRAIN_RATIO}) AS is_train
  FROM subjects) {side}"""


_EPOCH_TOTALS = f"""WITH {_EPOCHS}, {_LABEL_COUNTS}
SELECT e.subject_id, e.run_id, e.epoch_id, count(*) AS n_samples, round(sum(c3), 4) AS sum_c3,
       any_value(m.task_label) AS epoch_label
FROM epochs e JOIN majority m USING (subject_id, run_id, epoch_id)
GROUP BY e.subject_id, e.run_id, e.epoch_id"""

_WEEK_US = 7 * 86400 * 1000000
_RUNS = (("low", 0.02, 0.05), ("middle", 0.04, 0.07), ("high", 0.06, 0.09))
_RUN_METRICS = {
    "accuracy": "test_accuracy", "f1": "test_f1", "precision_weighted": "test_precision_weighted",
    "recall_weighted": "test_recall_weighted",
}


def _run_row(name: str, low: float, high: float) -> str:
    metrics = ", ".join(f"round({m}, 6) AS {t}" for m, t in _RUN_METRICS.items())
    return (
        f"SELECT * FROM (WITH {_predictions(low, high)}, {_scores()} "
        f"SELECT '{name}' AS run_id, '{low}' AS low, '{high}' AS high, {metrics} FROM weighted)"
    )


EXPECTED: dict[str, str] = {
    "band_power": f"""WITH {_VECTORS}, bins AS (SELECT range AS k FROM range(0, 33)),
spectrum AS (SELECT vec_id, k, {_power("v", "pos", 64)} AS p FROM cells, bins GROUP BY ALL)
SELECT vec_id, {", ".join(f"round({_band('p', b, 1)}, 6) AS {b}" for b in BANDS)}
FROM spectrum GROUP BY vec_id""",
    "epoch_features": f"""WITH {_LINE_FEATURES}
SELECT subject_id, run_id, epoch_id, task_label,
       {", ".join(f"round({c}_{b}, 4) AS {c}_{b}" for c in _CHANNELS for b in BANDS)} FROM features""",
    "epoch_quality": f"""WITH {_EPOCHS}
SELECT subject_id, count(DISTINCT (run_id, epoch_id)) AS n_epochs,
       count(*) FILTER (WHERE c3 IS NULL OR cz IS NULL OR c4 IS NULL) AS n_bad
FROM epochs GROUP BY subject_id""",
    "lateralization": f"""WITH {_VECTOR_FEATURES}
SELECT vec_id, {", ".join(f"round(diff_{b}, 6) AS diff_{b}" for b in BANDS)} FROM features""",
    "alpha_by_channel": f"""WITH {_LINE_FEATURES}
SELECT subject_id, run_id, epoch_id, channel, round(alpha, 4) AS alpha_power
FROM features, LATERAL (VALUES ('C3', C3_alpha), ('Cz', Cz_alpha), ('C4', C4_alpha)) AS c(channel, alpha)""",
    "log_features": f"""WITH {_VECTOR_FEATURES}
SELECT vec_id, {", ".join(f"round(log10(greatest({p}_{b}, 1e-12)), 6) AS {p}_{b}" for p in ("C3", "C4", "diff") for b in BANDS)}
FROM features""",
    "epochs_by_time": "SELECT event_id, user_id, epoch_us(ts) // 3600000000 AS epoch_id FROM events",
    "epoch_signals": """
WITH numbered AS (
  SELECT *, epoch_us(ts) // 3600000000 AS epoch_id,
         row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 3600000000 ORDER BY ts, event_id) - 1 AS no
  FROM events)
SELECT user_id, epoch_id, no // 65536 AS segment, count(*) AS n_samples,
       string_agg(round(value * 100)::BIGINT::VARCHAR, ',' ORDER BY ts, event_id) AS signal
FROM numbered GROUP BY 1, 2, 3""",
    "epoch_first_label": f"""
SELECT user_id, epoch_us(ts) // {_WEEK_US} AS epoch_id, first(event_type ORDER BY ts, event_id) AS epoch_label
FROM events GROUP BY 1, 2""",
    "epoch_majority_label": f"""
WITH n AS (SELECT user_id, epoch_us(ts) // {_WEEK_US} AS epoch_id, event_type, count(*) AS k FROM events GROUP BY ALL)
SELECT user_id, epoch_id, event_type AS epoch_label FROM n
QUALIFY row_number() OVER (PARTITION BY user_id, epoch_id ORDER BY k DESC, event_type) = 1""",
    "epochs_by_count": _EPOCH_TOTALS,
    "interval_label": """
WITH t AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us FROM events),
marks AS (
  SELECT user_id, event_id AS idx, us AS onset, us + (6 + 12 * (event_id % 3)) * 3600000000 AS finish
  FROM t WHERE event_type = 'signup')
SELECT t.event_id, coalesce('S' || max(m.idx), 'T0') AS task_label
FROM t LEFT JOIN marks m ON t.user_id = m.user_id AND t.us >= m.onset AND t.us < m.finish
GROUP BY t.event_id""",
    "subject_stats": "SELECT l_suppkey, " + ", ".join(
        f"round(avg({c}), 4) AS {c}_mean, round(stddev_samp({c}), 4) AS {c}_std"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ) + " FROM lineitem GROUP BY l_suppkey",
    "zscore_by_subject": f"SELECT l_suppkey, {_KEYS}, " + ", ".join(
        f"round(({c} - avg({c}) OVER s) / coalesce(stddev_samp({c}) OVER s, 1.0), 6) AS {c}"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ) + " FROM lineitem WINDOW s AS (PARTITION BY l_suppkey)",
    "class_weight": f"""
SELECT {_KEYS}, l_returnflag, CASE WHEN l_returnflag = 'N' THEN 0.5 ELSE 1.0 END::DOUBLE AS weight FROM lineitem""",
    "balanced_weights": f"""
WITH n AS (SELECT l_returnflag, count(*) AS k FROM lineitem GROUP BY 1)
SELECT {_KEYS}, l.l_returnflag,
       round((SELECT sum(k) FROM n)::DOUBLE / ((SELECT count(*) FROM n) * n.k), 6) AS weight
FROM lineitem l JOIN n ON l.l_returnflag = n.l_returnflag""",
    "class_band_means": f"""WITH {_VECTOR_FEATURES}
SELECT task_label, 'C3' AS channel, round(avg(C3_alpha), 6) AS power FROM features GROUP BY task_label
UNION ALL
SELECT task_label, 'C4', round(avg(C4_alpha), 6) FROM features GROUP BY task_label""",
    "class_lateralization": f"WITH {_VECTOR_FEATURES}\n" + "\nUNION ALL\n".join(
        f"SELECT task_label, '{b.capitalize()}' AS band, round(avg(diff_{b}), 6) AS difference "
        "FROM features GROUP BY task_label" for b in BANDS
    ),
    "class_difference": f"WITH {_VECTOR_FEATURES}\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS name, round(avg({c}) FILTER (WHERE task_label = 'T2') "
        f"- avg({c}) FILTER (WHERE task_label = 'T1'), 6) AS difference FROM features"
        for c in ("C3_alpha", "C4_alpha")
    ),
    "band_ranges": f"WITH {_VECTOR_FEATURES}, class_means AS (\n" + "\nUNION ALL\n".join(
        f"SELECT '{b}' AS band, avg({c}_{b}) AS value FROM features GROUP BY task_label"
        for b in BANDS for c in ("C3", "C4")
    ) + """), limits AS (SELECT band, min(value) AS low, max(value) AS high FROM class_means GROUP BY band),
padded AS (SELECT *, CASE WHEN high > low THEN (high - low) * 0.2 ELSE abs(high) * 0.1 + 1e-9 END AS pad FROM limits)
SELECT band, round(low - pad, 6) AS vmin, round(high + pad, 6) AS vmax FROM padded""",
    "split_train": _split(
        f"SELECT l_suppkey, {_KEYS} FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM placed WHERE is_train)"
    ),
    "split_test": _split(
        f"SELECT l_suppkey, {_KEYS} FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM placed WHERE NOT is_train)"
    ),
    "split_counts": _split("""SELECT is_train, count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_subjects
FROM lineitem JOIN placed USING (l_suppkey) GROUP BY is_train"""),
    "confusion_matrix": f"""WITH {_predictions()}, n AS (
  SELECT task_label, pred_label, count(*) AS n FROM predictions GROUP BY ALL),
grid AS (
  SELECT t.label AS truth, p.label AS predicted, coalesce(n.n, 0) AS n
  FROM (SELECT label FROM {_CLASSES}) t CROSS JOIN (SELECT label FROM {_CLASSES}) p
  LEFT JOIN n ON n.task_label = t.label AND n.pred_label = p.label)
SELECT truth, predicted, n, round_even(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY truth), 1) AS pct FROM grid""",
    "class_prf": f"""WITH {_predictions()}, {_scores()}
SELECT label, metric, round(value, 6) AS value FROM scores,
LATERAL (VALUES ('recall', recall), ('precision', precision), ('f1', f1)) AS m(metric, value)""",
    "macro_f1": f"""WITH {_predictions()}, {_scores()}
SELECT round(avg(f1), 6) AS macro_f1, first(label ORDER BY f1, place) AS worst_class FROM scores""",
    "weighted_metrics": f"WITH {_predictions()}, {_scores()} SELECT {_WEIGHTED} FROM weighted",
    "subject_accuracy": f"""WITH {_predictions()}
SELECT subject_id, round(avg((task_label = pred_label)::INT), 6) AS accuracy FROM predictions GROUP BY 1""",
    "subject_tiers": f"""WITH {_predictions()}, a AS (
  SELECT subject_id, avg((task_label = pred_label)::INT) AS accuracy FROM predictions GROUP BY 1)
SELECT subject_id, round(accuracy, 6) AS accuracy,
       CASE WHEN accuracy >= 0.5 THEN 'high' WHEN accuracy >= 0.4 THEN 'medium'
            WHEN accuracy >= 0.33 THEN 'low' ELSE 'poor' END AS tier FROM a""",
    "decode_labels": f"WITH {_predictions()} SELECT {_KEYS}, prediction, pred_label FROM predictions",
    "score_flags": f"WITH {_predictions()} SELECT {_KEYS}, (task_label = pred_label)::BIGINT AS correct FROM predictions",
    "weighted_metrics_all": f"""WITH {_LIVE}, cells AS (
  SELECT user_id, true_label, pred_label, count(*) AS n FROM live GROUP BY ALL),
labels AS (SELECT user_id, true_label AS label FROM cells UNION SELECT user_id, pred_label FROM cells),
counts AS (
  SELECT l.user_id, label, coalesce(sum(n) FILTER (WHERE true_label = label AND pred_label = label), 0) AS tp,
         coalesce(sum(n) FILTER (WHERE true_label <> label AND pred_label = label), 0) AS fp,
         coalesce(sum(n) FILTER (WHERE true_label = label AND pred_label <> label), 0) AS fn
  FROM labels l JOIN cells c ON l.user_id = c.user_id GROUP BY ALL),
rates AS (
  SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r FROM counts)
SELECT user_id, round(sum(tp)::DOUBLE / sum(tp + fn), 6) AS accuracy,
       round(sum((tp + fn) * coalesce(2 * p * r / nullif(p + r, 0), 0)) / sum(tp + fn), 6) AS f1,
       round(sum((tp + fn) * p) / sum(tp + fn), 6) AS precision_weighted,
       round(sum((tp + fn) * r) / sum(tp + fn), 6) AS recall_weighted
FROM rates GROUP BY user_id""",
    "latest_files": "SELECT event_id, user_id FROM events WHERE user_id % 4 >= 2",
    "kpi_summary": f"""WITH {_predictions()}, {_EPOCHS}, subjects AS (SELECT DISTINCT subject_id FROM predictions), placed AS (
  SELECT subject_id, row_number() OVER (ORDER BY subject_id) - 1 < floor(count(*) OVER () * {TRAIN_RATIO}) AS is_train FROM subjects),
a AS (
  SELECT avg((task_label = pred_label)::INT) AS accuracy, count(DISTINCT subject_id) AS n_subjects FROM predictions
  WHERE subject_id IN (SELECT subject_id FROM placed WHERE NOT is_train)),
t AS (SELECT count(*) AS n_rows FROM (SELECT DISTINCT subject_id, run_id, epoch_id FROM epochs))
SELECT round(accuracy, 6) AS accuracy, round((accuracy - 0.333) * 100, 6) AS gain_points, n_rows, n_subjects,
       {(len(_CHANNELS) + 1) * len(BANDS)}::BIGINT AS n_features FROM a, t""",
    "prediction_columns": f"WITH {_predictions()} SELECT subject_id, task_label, prediction FROM predictions",
    "rolling_accuracy": f"""WITH {_LIVE}
SELECT event_id, row_number() OVER u - 1 AS epoch_idx,
       round(avg(correct) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 9 PRECEDING), 6) AS rolling_acc
FROM live WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "prediction_timeline": f"""WITH {_LIVE}
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS epoch_idx, true_label, pred_label,
       CASE WHEN true_label = pred_label THEN 'correct' ELSE 'wrong' END AS marker FROM live""",
    "dedup_latest": f"WITH {_LATEST} SELECT epoch_id, event_id, true_label, correct FROM latest",
    "tail_100": f"WITH {_LATEST} SELECT epoch_id, event_id, correct FROM latest ORDER BY ts DESC, event_id DESC LIMIT 100",
    "latest_snapshot": f"WITH {_LIVE} SELECT epoch_id, event_id FROM live WHERE epoch_id = (SELECT max(epoch_id) FROM live)",
    "live_kpis": f"""WITH {_LIVE}
SELECT count(*) AS n_epochs, sum(correct)::BIGINT AS n_correct, round(avg(correct), 6) AS accuracy,
       count(DISTINCT true_label) AS n_classes, last(epoch_id ORDER BY ts, epoch_id) AS last_epoch_id FROM live""",
    "event_time_axis": f"""WITH {_EPOCHS}
SELECT DISTINCT subject_id, run_id, epoch_id, 1767225600000000 + epoch_id * 2000000 AS event_us FROM epochs""",
    "loop_replay": f"""WITH {_EPOCHS}, listed AS (SELECT DISTINCT subject_id, run_id, epoch_id FROM epochs),
sized AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id, run_id ORDER BY epoch_id) - 1 AS no,
         count(*) OVER (PARTITION BY subject_id, run_id) AS n FROM listed)
SELECT subject_id, run_id, epoch_id, no + n * range AS replay_no
FROM sized, range(0, 16) WHERE no + n * range < 15""",
    "latest_batches": f"""WITH {_LIVE}, b AS (SELECT event_id, epoch_id // 24 AS batch_id FROM live)
SELECT event_id, batch_id FROM b
WHERE batch_id IN (SELECT DISTINCT batch_id FROM b ORDER BY batch_id DESC LIMIT 10)""",
    "union_batches": """
SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN value END AS value,
       CASE WHEN event_type <> 'purchase' THEN event_type END AS event_type FROM events""",
    "electrode_lookup": f"""WITH {_SITES}
SELECT m.task_label, 'E' || m.pos AS channel, round(m.value, 6) AS value, round(x, 6) AS x, round(y, 6) AS y,
       round(z, 6) AS z
FROM means m JOIN sites s ON s.name = 'E' || m.pos WHERE s.level > 0""",
    "electrode_powers": f"""WITH {_SITES}
SELECT name, round(z, 6) AS z, round(value, 6) AS value FROM sites
LEFT JOIN (SELECT 'E' || pos AS name, value FROM means WHERE task_label = 'T1' AND value > 0) USING (name)""",
    "electrode_projection": f"""WITH {_SITES}
SELECT name, round(px, 6) AS px, round(py, 6) AS py, round(r, 6) AS map_radius FROM flat, radius""",
    "scalp_interpolate": f"""WITH {_SITES}, anchors AS (
  SELECT task_label, value, x, y, z FROM means JOIN sites ON name = 'E' || pos WHERE name IN ('E10', 'E30', 'E50')),
weights AS (
  SELECT a.task_label, s.name, a.value,
         exp(-(power(a.x - s.x, 2) + power(a.y - s.y, 2) + power(a.z - s.z, 2)) / (2 * 0.1 * 0.1)) AS w
  FROM anchors a, sites s)
SELECT task_label, name,
       round(CASE WHEN sum(w) < 1e-9 THEN avg(value) ELSE sum(w * value) / sum(w) END, 6) AS value
FROM weights GROUP BY task_label, name""",
    "topomap_grid": f"""WITH {_SITES}, axis AS (SELECT range AS i FROM range(0, 100)),
cells2 AS (
  SELECT a.i AS gx, b.i AS gy, a.i * (2.0 * r / 99) - r AS cx, b.i * (2.0 * r / 99) - r AS cy, r
  FROM axis a, axis b, radius),
weights AS (
  SELECT gx, gy, name, exp(-(power(cx - px, 2) + power(cy - py, 2)) / (2 * 0.25 * 0.25)) AS w
  FROM cells2, flat WHERE cx * cx + cy * cy <= power(r * 0.92, 2)),
mapped AS (
  SELECT task_label, gx, gy, CASE WHEN sum(w) > 1e-9 THEN sum(w * value) / sum(w) END AS value
  FROM weights JOIN means ON name = 'E' || pos GROUP BY task_label, gx, gy),
frame AS (SELECT DISTINCT task_label FROM means)
SELECT f.task_label, c.gx, c.gy, round(m.value, 6) AS value
FROM frame f CROSS JOIN cells2 c LEFT JOIN mapped m USING (task_label, gx, gy)""",
    "difference_map": f"""WITH {_SITES}, anchors AS (
  SELECT name, x, y, z, max(value) FILTER (WHERE task_label = 'T2') - max(value) FILTER (WHERE task_label = 'T1') AS d
  FROM means JOIN sites ON name = 'E' || pos WHERE name IN ('E10', 'E30', 'E50') GROUP BY name, x, y, z),
weights AS (
  SELECT s.name, d, exp(-(power(a.x - s.x, 2) + power(a.y - s.y, 2) + power(a.z - s.z, 2)) / (2 * 0.1 * 0.1)) AS w
  FROM anchors a, sites s),
mapped AS (
  SELECT name, CASE WHEN sum(w) < 1e-9 THEN avg(d) ELSE sum(w * d) / sum(w) END AS difference
  FROM weights GROUP BY name),
reach AS (SELECT greatest(max(abs(difference)) * 1.1, 1e-9) AS v FROM mapped)
SELECT name, round(difference, 6) AS difference, round(-v, 6) AS vmin, round(v, 6) AS vmax FROM mapped, reach""",
    "live_map_range": f"""WITH {_LIVE}, levels AS (
  SELECT true_label, epoch_id, avg(correct) AS level FROM live GROUP BY ALL),
limits AS (SELECT epoch_id, min(level) AS low, max(level) AS high FROM levels GROUP BY epoch_id)
SELECT epoch_id, round(low - CASE WHEN high - low < 1e-9 THEN 0.1 ELSE 0.0 END, 6) AS vmin,
       round(high + CASE WHEN high - low < 1e-9 THEN 0.1 ELSE 0.0 END, 6) AS vmax FROM limits""",
    "signal_sample": f"""WITH {_SAMPLES}, longest AS (
  SELECT subject_id, run_id FROM samples GROUP BY ALL ORDER BY count(*) DESC, subject_id, run_id LIMIT 1)
SELECT time::DOUBLE AS time, {_KEYS}, cz AS "Cz", task_label FROM samples JOIN longest USING (subject_id, run_id)
ORDER BY {_LINE_ORDER} LIMIT 3200""",
    "clean_columns": f"""
SELECT {_KEYS}, l_quantity::FLOAT::DOUBLE AS "C3", l_discount AS "Cz", l_tax AS "C4" FROM lineitem""",
    "partitioned_roundtrip": f"""WITH {_SAMPLES}
SELECT subject_id, run_id, {_KEYS}, c3 AS "C3", cz AS "Cz", c4 AS "C4" FROM samples""",
    "merged_scan": f"""WITH {_SAMPLES}
SELECT {_KEYS}, c3 AS "C3", CASE WHEN run_id = 'O' THEN cz END AS "Cz", CASE WHEN run_id <> 'O' THEN c4 END AS "C4"
FROM samples""",
    "metrics_json": f"WITH {_predictions()}, {_scores()} SELECT {_WEIGHTED} FROM weighted",
    "ingest_pending": """
SELECT o_orderkey AS subject_id, o_orderpriority AS run_id FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "manifest_missing": """
SELECT o_orderkey AS path FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""",
    "ingest_outcomes": """
WITH sizes AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
files AS (SELECT l_suppkey + unnest(range((n + 511) // 512)) AS number FROM sizes),
o AS (
  SELECT CASE number % 5 WHEN 3 THEN 'truncated' WHEN 4 THEN 'skipped' WHEN 0 THEN 'converted' ELSE 'errors' END AS status
  FROM files)
SELECT s.status, count(o.status) AS n FROM (VALUES ('converted'), ('skipped'), ('errors'), ('truncated')) AS s(status)
LEFT JOIN o ON o.status = s.status GROUP BY s.status""",
    "scoring_defaults": """
SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN source END, '?') AS run_id,
       coalesce(toxic::BIGINT, -1) AS run_seq, coalesce('T' || quality, '?') AS pred_label,
       coalesce(1.0 - quality, 0.0)::DOUBLE AS "proba_T0", coalesce(quality, 0)::DOUBLE AS "proba_T1"
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "decode_recordings": f"""WITH {_SAMPLES}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY {_LINE_ORDER}) - 1 AS rn FROM samples),
cut AS (SELECT *, rn // 512 AS rec, rn % 512 AS pos FROM numbered),
opening AS (SELECT subject_id, rec, task_label AS opening FROM cut WHERE pos = 0)
SELECT printf('S%06d', subject_id) AS subject_id, printf('R%02d', rec) AS run_id,
       round(pos / 64.0::DOUBLE, 6) AS time, round(c3, 6) AS "C3", round(cz, 6) AS "Cz", round(c4, 6) AS "C4",
       CASE WHEN pos >= 192 AND pos < 320 THEN 'T9' WHEN pos < 256 THEN opening ELSE 'T0' END AS task_label
FROM cut JOIN opening USING (subject_id, rec)""",
    "compare_runs": f"""WITH {_predictions()}, {_scores("l_orderkey")}, sized AS (
  SELECT l_orderkey, count(*) AS n_lines FROM predictions GROUP BY 1),
kept AS (
  SELECT w.*, o.o_orderdate FROM weighted w JOIN sized USING (l_orderkey) JOIN orders o ON o_orderkey = l_orderkey
  WHERE n_lines > 2 AND o_orderstatus <> 'F'),
steps AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, l_orderkey::VARCHAR) - 1 AS step FROM kept)
SELECT step, l_orderkey::VARCHAR AS run_id, metric, round(value, 6) AS value FROM steps,
LATERAL (VALUES ('test_accuracy', accuracy), ('test_f1', f1), ('test_precision_weighted', precision_weighted),
                ('test_recall_weighted', recall_weighted)) AS m(metric, value)""",
    "run_log": "\nUNION ALL\n".join(_run_row(*run) for run in _RUNS),
    "stream_epochs": "SELECT event_id, user_id, epoch_us(ts) // 3600000000 AS epoch_id FROM events",
    "stream_window_epochs": """
WITH w AS (SELECT *, epoch_us(ts) // 3600000000 AS epoch_id FROM events)
SELECT user_id, epoch_id, count(*) AS n, round(sum(value), 2) AS total,
       first(event_type ORDER BY ts, event_id) AS first_type
FROM w GROUP BY user_id, epoch_id""",
    "stream_dedup": "SELECT event_id, user_id, event_type, value FROM events",
    "replay_epochs": _EPOCH_TOTALS,
    "stream_dual_sink": f"WITH {_LINE_FEATURES}" + _MAP_ROWS.format(
        more=", (task_label = pred_label)::BIGINT AS correct, -1::BIGINT AS run_seq"
    ),
    "live_run_statistics": f"""WITH {_EPOCHS}
SELECT count(*) AS rows_read, count(*) AS rows, count(DISTINCT (subject_id, run_id, epoch_id)) AS epochs,
       count(DISTINCT (subject_id, run_id, epoch_id)) AS predictions, true AS timed FROM epochs""",
    "topomap_explode": f"WITH {_LINE_FEATURES}" + _MAP_ROWS.format(more=""),
    "rf_predictions": f"""WITH {_LINE_FEATURES}, subjects AS (SELECT DISTINCT subject_id FROM features), placed AS (
  SELECT subject_id, row_number() OVER (ORDER BY subject_id) - 1 < floor(count(*) OVER () * {TRAIN_RATIO}) AS is_train FROM subjects)
SELECT subject_id, run_id, epoch_id, task_label, true AS sums_to_one, true AS likeliest, true AS flagged
FROM features WHERE subject_id IN (SELECT subject_id FROM placed WHERE NOT is_train)""",
    "live_rf": f"""WITH {_LINE_FEATURES}
SELECT subject_id, run_id, epoch_id, task_label, true AS sums_to_one, true AS likeliest, true AS flagged FROM features""",
    "model_roundtrip": f"WITH {_LINE_FEATURES} SELECT subject_id, run_id, epoch_id, true AS same FROM features",
    "stream_score": f"""WITH {_LINE_FEATURES}
SELECT subject_id, run_id, epoch_id, task_label AS true_label, true AS same_label, true AS same_chances FROM features""",
    "rf_metrics": """
SELECT 0.0::DOUBLE AS accuracy_gap, 0.0::DOUBLE AS f1_gap, 0.0::DOUBLE AS precision_weighted_gap,
       0.0::DOUBLE AS recall_weighted_gap, true AS in_range""",
    "cv_grid": """
SELECT t.n AS num_trees, d.n AS max_depth, true AS in_range FROM (VALUES (50), (100)) AS t(n), (VALUES (5), (10)) AS d(n)""",
    "feature_importance": f"""
SELECT c || '_' || b AS feature, true AS in_range, true AS shares, true AS tiered
FROM (VALUES ('C3'), ('Cz'), ('C4'), ('diff')) AS c(c), (VALUES {", ".join(f"('{b}')" for b in BANDS)}) AS b(b)""",
    "separable_labels": """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <= 20 THEN 'A' ELSE 'N' END AS pred_label, 1::BIGINT AS correct
FROM lineitem WHERE l_quantity <= 20 OR l_quantity >= 31""",
}
