"""The registered queries in SQL for DuckDB."""

from __future__ import annotations

DAY = 24 * 3600 * 1_000_000
ORIGIN = 1_704_067_200_000_000

KIND = "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END"
READINGS = f"""readings AS (
  SELECT user_id AS event, {KIND} AS string, (event_id % 4)::int AS om, 0 AS pmt, (event_id % 3)::int AS vector_index,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS item, event_id AS ord,
         'Run=1|Event=' || user_id || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id,
         'string=' || coalesce(({KIND})::varchar, 'nan') || '|om=' || (event_id % 4) || '|pmt=0' AS dom_id
  FROM events)"""
WIDE = f"""{READINGS}, wide AS (
  SELECT event_id, dom_id, arg_min(item, ord) FILTER (WHERE vector_index = 0 AND item IS NOT NULL) AS p0,
         arg_min(item, ord) FILTER (WHERE vector_index = 1 AND item IS NOT NULL) AS p1,
         arg_min(item, ord) FILTER (WHERE vector_index = 2 AND item IS NOT NULL) AS p2
  FROM readings WHERE item IS NOT NULL GROUP BY ALL)"""
NAMED = "p0 AS level, p1 AS share_0p01, p2 AS share_0p5"
TRUTH = """truth AS (
  SELECT 'Run=1|Event=' || o_orderkey || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id, o_orderkey AS event,
         o_totalprice AS "PrimaryNeutrinoEnergy", o_orderstatus, o_orderpriority, o_orderkey AS _ord
  FROM orders)"""
SPLIT = f"""{TRUTH}, split AS (
  SELECT 'train' AS split, * FROM truth WHERE event % 5 > 1
  UNION ALL SELECT 'validation', * FROM truth WHERE event % 5 = 0
  UNION ALL SELECT 'test', * FROM truth WHERE event % 5 = 1)"""
REPEATED = """truth AS (
  SELECT 'Run=1|Event=' || o_custkey || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id,
         o_totalprice AS "PrimaryNeutrinoEnergy", o_orderstatus, o_orderkey AS _ord
  FROM orders)"""
MATRIX = f"{WIDE}, rows AS (SELECT *, (row_number() OVER (PARTITION BY event_id ORDER BY dom_id) - 1)::int AS r FROM wide)"
INDEXED = f"{SPLIT}, indexed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY _ord) - 1 AS idx FROM split)"
PULSES = f"""pulses AS (
  SELECT user_id AS event, {KIND} AS string, CASE WHEN event_id % 11 = 0 THEN 'Other' ELSE 'InIceDSTPulses' END AS series,
         epoch_us(ts) AS time, value::decimal(12,2) AS charge, event_id AS ord
  FROM events)"""
SERIES = f"{PULSES}, used AS (SELECT * FROM pulses WHERE series = 'InIceDSTPulses' AND time IS NOT NULL AND charge IS NOT NULL)"
BRIGHT = f"""{PULSES}, bright AS (SELECT * REPLACE (CASE WHEN ord % 3 = 0 THEN 0 ELSE event END AS event, CASE WHEN ord % 3 = 0 THEN 0 ELSE string END AS string) FROM pulses)"""
WINDOWS = f"{PULSES}, windows AS (SELECT event, string, time - 3600000000 AS start, time + 3600000000 AS stop FROM pulses WHERE ord % 5 = 0)"
SUMMED = """summed AS (
  SELECT *, min(time) OVER k AS first, sum(charge) OVER k AS total, sum(charge) OVER r AS running
  FROM used WINDOW k AS (PARTITION BY event, string), r AS (PARTITION BY event, string ORDER BY time, ord ROWS UNBOUNDED PRECEDING))"""


def _until(days: int) -> str:
    return f"coalesce(sum(charge) FILTER (WHERE time - first <= {days * DAY}), 0)::double AS charge_until_t_{days * DAY}"


def _share(p: float) -> str:
    return f"min(time) FILTER (WHERE running::double >= {p}::double * total::double)::double AS time_at_charge_percentile_{str(p).replace('.', 'p')}"


def _shift(source: str) -> str:
    return f"""means AS (
  SELECT event, CASE WHEN sum(charge) <> 0 THEN round(sum(charge * (time - {ORIGIN})::decimal(20,0))::double / sum(charge)::double)::bigint + {ORIGIN} ELSE 0 END AS shift
  FROM {source} WHERE time IS NOT NULL AND charge IS NOT NULL GROUP BY event)
SELECT ord AS _ord, p.event AS "Event", time - shift AS time FROM {source} p JOIN means m ON p.event IS NOT DISTINCT FROM m.event WHERE time IS NOT NULL AND charge IS NOT NULL"""


FEATURES = ", ".join(["sum(charge)::double AS total_charge", "min(time)::double AS t_first_pulse", *[_until(d) for d in (1, 3, 10)], "(max(time) - min(time))::double AS t_spread", *[_share(p) for p in (0.01, 0.5, 0.9)]])
EXTRACTED = f"""{WINDOWS}, kept AS (
  SELECT * FROM pulses p WHERE series = 'InIceDSTPulses' AND string IS DISTINCT FROM 1
     AND NOT EXISTS (SELECT 1 FROM windows w WHERE w.event = p.event AND w.string = p.string AND w.start <= p.time AND p.time < w.stop)),
means AS (
  SELECT event, CASE WHEN sum(charge) <> 0 THEN round(sum(charge * (time - {ORIGIN})::decimal(20,0))::double / sum(charge)::double)::bigint + {ORIGIN} ELSE 0 END AS shift
  FROM kept GROUP BY event),
used AS (SELECT k.event, string, charge, ord, time - shift AS time FROM kept k JOIN means m ON k.event IS NOT DISTINCT FROM m.event), {SUMMED},
vectors AS (
  SELECT 'Run=1|Event=' || event || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id, 'string=' || string || '|om=0|pmt=0' AS dom_id, {FEATURES}
  FROM summed GROUP BY event, string)"""
NAMES = ["total_charge", "t_first_pulse", *[f"charge_until_t_{d * DAY}" for d in (1, 3, 10)], "t_spread", *[f"time_at_charge_percentile_{p}" for p in ("0p01", "0p5", "0p9")]]
LINES = """lines AS (
  SELECT 'Run=1|Event=' || l_orderkey || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id, 'string=' || l_suppkey || '|om=0|pmt=0' AS dom_id,
         l_linenumber - 1 AS vector_index, l_quantity AS item, (l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS ord
  FROM lineitem)"""

VECTORS = f"""{SERIES}, {SUMMED}, vectors AS (
  SELECT 'Run=1|Event=' || event || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id, 'string=' || string || '|om=0|pmt=0' AS dom_id, {FEATURES}
  FROM summed GROUP BY event, string)"""
KEYED = "'Run=1|Event=' || o_orderkey || '|SubEvent=0|SubEventStream=InIceSplit'"

SQL = {
    "composite_key": f"WITH {READINGS} SELECT ord AS _ord, event_id, dom_id FROM readings",
    "unpack_key": f"WITH {READINGS} SELECT ord AS _ord, string, om, pmt, om::varchar AS om_text FROM readings",
    "event_number": "SELECT o_orderkey AS _ord, o_orderkey AS event, 3::bigint AS first_event FROM orders",
    "pivot_first": f"WITH {WIDE} SELECT * FROM wide",
    "pivot_named": f"WITH {WIDE} SELECT event_id, dom_id, {NAMED} FROM wide",
    "pivot_lines": f"WITH {LINES} SELECT event_id, dom_id, " + ", ".join(f"arg_min(item, ord) FILTER (WHERE vector_index = {k}) AS p{k}" for k in range(7)) + " FROM lines GROUP BY ALL",
    "truth_reshape": f"WITH {TRUTH} SELECT * EXCLUDE (event) FROM truth",
    "vector_map": f"WITH {READINGS} SELECT vector_index, feature, count(item) AS n, min(item) AS least, max(item) AS most FROM readings JOIN (VALUES (0, 'level'), (1, 'share_0.01'), (2, 'share_0.5')) m(vector_index, feature) USING (vector_index) GROUP BY ALL",
    "split_filter": f"""WITH {TRUTH} SELECT event_id, "PrimaryNeutrinoEnergy" FROM truth WHERE event % 5 > 1 AND "PrimaryNeutrinoEnergy" > 1000 AND o_orderstatus IS DISTINCT FROM 'P'""",
    "split_all": f"WITH {SPLIT} SELECT split, event_id FROM split",
    "split_counts": f"WITH {SPLIT} SELECT split, count(*) AS n FROM split GROUP BY split",
    "split_audit": f"WITH {TRUTH} SELECT ((event % 5 > 1)::int + (event % 4 = 0)::int + (event % 5 = 1)::int)::int AS n_splits, count(*) AS n FROM truth GROUP BY 1",
    "split_features": f"WITH {SPLIT}, {WIDE} SELECT split, count(*) AS n_rows, count(DISTINCT event_id) AS n_events, sum(p2::decimal(18,2))::double AS share FROM split JOIN wide USING (event_id) GROUP BY split",
    "sample_index": f"WITH {INDEXED} SELECT split, idx, event_id FROM indexed",
    "label_last_wins": f"""WITH {REPEATED}, last AS (SELECT event_id, arg_max((("PrimaryNeutrinoEnergy", o_orderstatus)), _ord) AS l FROM truth GROUP BY event_id) SELECT event_id, l[1] AS "PrimaryNeutrinoEnergy", l[2] AS o_orderstatus FROM last""",
    "label_projection": f'WITH {TRUTH} SELECT event_id, o_orderpriority, "PrimaryNeutrinoEnergy" FROM truth',
    "sample_join": f'WITH {TRUTH}, {WIDE} SELECT event_id, "PrimaryNeutrinoEnergy", dom_id, {NAMED} FROM truth JOIN wide USING (event_id)',
    "events_without_features": f"WITH {TRUTH} SELECT event_id FROM truth WHERE event NOT IN (SELECT l_orderkey FROM lineitem)",
    "duplicate_truth": f"WITH {REPEATED} SELECT event_id, count(*) AS n FROM truth GROUP BY event_id HAVING count(*) > 1",
    "unmapped_positions": f"WITH {LINES} SELECT vector_index, count(*) AS n FROM lines WHERE vector_index >= 3 GROUP BY 1",
    "bad_event_ids": "SELECT 'Run=1|Event=-' || o_orderkey || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id, o_orderkey AS _ord FROM orders WHERE o_orderkey % 2 = 1",
    "event_matrix": f"WITH {MATRIX} SELECT event_id, r, c, (CASE c WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)::float AS value FROM rows, (SELECT unnest([0, 1, 2])::int AS c)",
    "sample_with_sensors": f"WITH {MATRIX} SELECT event_id, r, regexp_extract(dom_id, 'string=(\\d+)', 1)::int AS string, regexp_extract(dom_id, 'om=(\\d+)', 1)::int AS om, 0 AS pmt, p0::float AS level FROM rows",
    "training_table": f"""WITH {INDEXED}, {WIDE}, sized AS (SELECT event_id, count(*)::int AS n_sensors FROM wide GROUP BY event_id)
SELECT split, idx, event_id, n_sensors, 3 AS n_features, "PrimaryNeutrinoEnergy"::float AS label FROM indexed JOIN sized USING (event_id)""",
    "one_sample": f"WITH {INDEXED}, {MATRIX} SELECT split, idx, event_id, r, p0::float AS level FROM indexed JOIN rows USING (event_id) WHERE split = 'train' AND idx = 3",
    "event_point_lookup": f"WITH {WIDE} SELECT event_id, dom_id, {NAMED} FROM wide WHERE event_id = 'Run=1|Event=7|SubEvent=0|SubEventStream=InIceSplit'",
    "sensor_coordinates": 'SELECT l_orderkey AS "Event", l_linenumber - 1 AS vector_index, l_quantity AS item, l_suppkey::int AS string, 0 AS om, 0 AS pmt, s_nationkey::double AS x, s_suppkey::double AS y, s_acctbal AS z FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey',
    "feature_profile": f"WITH {SERIES} SELECT 'Run=1|Event=' || event || '|SubEvent=0|SubEventStream=InIceSplit' AS event_id, 'string=' || string || '|om=0|pmt=0' AS dom_id, any_value(s_nationkey)::double AS x, any_value(s_suppkey)::double AS y, any_value(s_acctbal) AS z, sum(charge)::double AS value FROM used LEFT JOIN supplier ON string = s_suppkey GROUP BY event, string",
    "sensors_without_geometry": "SELECT DISTINCT l_suppkey::int AS string, 0 AS om, 0 AS pmt FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0)",
    "series_select": f'WITH {PULSES} SELECT ord AS _ord, event AS "Event", time FROM pulses WHERE series = \'InIceDSTPulses\'',
    "stream_select": f'WITH {READINGS} SELECT ord AS _ord, event AS "Event", item FROM readings WHERE ord % 4 <> 0',
    "exclude_sensors": f'WITH {PULSES} SELECT ord AS _ord, event AS "Event", string FROM pulses WHERE string IS DISTINCT FROM 1',
    "exclude_windows_partial": f'WITH {WINDOWS} SELECT ord AS _ord, event AS "Event", time FROM pulses p WHERE NOT EXISTS (SELECT 1 FROM windows w WHERE w.event = p.event AND w.string = p.string AND w.start <= p.time AND p.time < w.stop)',
    "exclude_windows_full": f'WITH {WINDOWS} SELECT ord AS _ord, event AS "Event", time FROM pulses p WHERE NOT EXISTS (SELECT 1 FROM windows w WHERE w.event = p.event AND w.string = p.string)',
    "charge_weighted_shift": f"WITH {PULSES}, {_shift('pulses')}",
    "shift_with_missing_ids": f"WITH {PULSES}, partly AS (SELECT * REPLACE (CASE WHEN event % 3 <> 0 THEN event END AS event) FROM pulses), {_shift('partly')}",
    "total_charge": f'WITH {SERIES} SELECT event AS "Event", string, sum(charge)::double AS total_charge FROM used GROUP BY ALL',
    "first_pulse": f'WITH {SERIES} SELECT event AS "Event", string, min(time)::double AS t_first_pulse FROM used GROUP BY ALL',
    "charge_until_t": f'WITH {SERIES}, {SUMMED} SELECT event AS "Event", string, {", ".join(_until(d) for d in (1, 3, 10))} FROM summed GROUP BY event, string',
    "t_spread": f'WITH {SERIES} SELECT event AS "Event", string, (max(time) - min(time))::double AS t_spread FROM used GROUP BY event, string',
    "time_at_percentile": f'WITH {SERIES}, {SUMMED} SELECT event AS "Event", string, {", ".join(_share(p) for p in (0.01, 0.5, 0.9))} FROM summed GROUP BY event, string',
    "feature_vector_wide": f"WITH {EXTRACTED} SELECT * FROM vectors",
    "feature_vector_long": f"WITH {EXTRACTED} " + " UNION ALL ".join(f"SELECT event_id, dom_id, {k} AS vector_index, {n} AS item FROM vectors" for k, n in enumerate(NAMES)),
    "classification_join": f"""WITH {SERIES}, summed AS (SELECT event, sum(charge)::double AS total_charge FROM used GROUP BY event)
SELECT event AS "Event", total_charge, substr(o_orderpriority, 1, 1)::int AS classification FROM summed LEFT JOIN orders ON event = o_orderkey""",
    "table_fingerprint": "SELECT o_orderkey AS _ord, sha256('Event=' || o_orderkey || '|' || o_orderstatus) AS digest FROM orders",
    "registry": f"""WITH {INDEXED}, {WIDE} SELECT split, idx, event_id, "PrimaryNeutrinoEnergy"::float AS label, true AS reused FROM indexed WHERE event_id IN (SELECT event_id FROM wide)""",
    "stored_truth": f"WITH {TRUTH} SELECT * EXCLUDE (event) FROM truth",
    "stored_profile": f"""WITH {WIDE}, ids AS (SELECT *, regexp_extract(dom_id, 'string=(\\d+)', 1)::int AS string, regexp_extract(dom_id, 'om=(\\d+)', 1)::int AS om FROM wide)
SELECT event_id, dom_id, s_nationkey::double AS x, s_suppkey::double AS y, s_acctbal AS z, p0 AS value FROM ids LEFT JOIN supplier ON string = s_suppkey AND om = 0""",
    "own_converter": f"""WITH {INDEXED}, {WIDE}, sized AS (SELECT event_id, count(*)::int AS n_sensors FROM wide GROUP BY event_id)
SELECT split, idx, event_id, n_sensors, ("PrimaryNeutrinoEnergy" / 2)::float AS label FROM indexed JOIN sized USING (event_id)""",
    "extraction_outputs": f"WITH {VECTORS} "
    + " UNION ALL ".join(f"SELECT 'features' AS output, event_id, dom_id, {k} AS vector_index, {n} AS value FROM vectors" for k, n in enumerate(NAMES))
    + "".join(
        f" UNION ALL SELECT '{name}', {KEYED}, NULL, NULL, ({value})::double FROM orders"
        for name, value in {"truth": "o_totalprice", "classification": "substr(o_orderpriority, 1, 1)::int", "entry_energy": "o_totalprice / 2", "deposited_energy": "o_totalprice / 4"}.items()
    ),
    "read_many_files": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders",
    "read_csv_files": "SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders",
    "read_by_name": "SELECT event_id, user_id, value, event_id AS _ord FROM events",
    "suffix_filter": "SELECT o_orderkey, o_custkey, o_orderkey AS _ord FROM orders WHERE o_orderkey % 2 = 0",
    "geometry_scan": "SELECT s_suppkey::int AS string, 0 AS om, 0 AS pmt, s_nationkey::double AS x, s_suppkey::double AS y, s_acctbal AS z FROM supplier",
    "concatenated": f"""WITH {TRUTH} SELECT event_id, "PrimaryNeutrinoEnergy", row_number() OVER (ORDER BY event % 5 DESC, _ord) - 1 AS position FROM truth WHERE event % 5 < 2""",
    "fingerprint_files": "SELECT sha256(string_agg(o_orderkey || ' ' || o_orderstatus || chr(10), '' ORDER BY o_orderkey)) AS digest FROM orders GROUP BY o_orderkey // 1000",
    "own_builder": f'WITH {SERIES} SELECT event AS "Event", string, count(*) AS n_pulses, sum(charge)::double AS total_charge FROM used GROUP BY ALL',
    "own_vectorised": f"""WITH {BRIGHT}, used AS (SELECT *, (time - {ORIGIN}) // 3600000000 AS t, (charge * 100)::hugeint AS q FROM bright WHERE series = 'InIceDSTPulses' AND time IS NOT NULL AND charge IS NOT NULL),
sums AS (SELECT event, string, count(*)::hugeint AS n, sum(t) AS t, sum(q) AS q, sum(t * q) AS tq, sum(t * t) AS tt, sum(charge) AS total FROM used GROUP BY ALL)
SELECT event AS "Event", string, CASE WHEN n * tt - t * t <> 0 THEN (n * tq - t * q)::double / (n * tt - t * t)::double END AS charge_slope, total::double AS total_charge FROM sums""",
    "bright_sensor_charges": f"""WITH {BRIGHT}, used AS (SELECT * FROM bright WHERE series = 'InIceDSTPulses' AND time IS NOT NULL AND charge IS NOT NULL), {SUMMED}
SELECT event AS "Event", string, {", ".join([*[_until(d) for d in (1, 3, 10)], *[_share(p) for p in (0.01, 0.5, 0.9)]])} FROM summed GROUP BY event, string""",
    "overlapping_windows": f"""WITH {BRIGHT}, windows AS (SELECT event, string, time - (ord % 25) * 3600000000 AS start, time + (ord % 24 - 1) * 3600000000 AS stop FROM bright WHERE ord % 35 < 3)
SELECT ord AS _ord, event AS "Event", time FROM bright p WHERE NOT EXISTS (SELECT 1 FROM windows w WHERE w.event = p.event AND w.string = p.string AND w.start <= p.time AND p.time < w.stop)""",
    "extraction_chain": f"WITH {EXTRACTED} SELECT * FROM vectors",
    "matrix_blocks": f"WITH {MATRIX} SELECT event_id, (r // 4)::bigint AS block, r::bigint AS r, c, (CASE c WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)::float AS value FROM rows, (SELECT unnest([0, 1, 2])::int AS c)",
    "events_lookup": f"WITH {WIDE} SELECT event_id, dom_id, {NAMED} FROM wide WHERE event_id IN (SELECT 'Run=1|Event=' || k || '|SubEvent=0|SubEventStream=InIceSplit' FROM range(1, 1000, 10) t(k))",
    "training_manifest": f"WITH {INDEXED}, {WIDE} SELECT split, count(*)::bigint AS n, min(idx) AS first, max(idx) AS last, 0::bigint AS overlaps FROM indexed WHERE event_id IN (SELECT event_id FROM wide) GROUP BY split",
    "rebuilt": "SELECT o_orderkey, o_totalprice, false AS reused, 1 AS version FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice, true, 2 FROM orders",
    "remembered_files": "SELECT sha256(string_agg(o_orderkey || ' ' || o_orderstatus || chr(10), '' ORDER BY o_orderkey)) AS digest FROM orders GROUP BY o_orderkey // 1000",
    "parquet_roundtrip": f"WITH {WIDE} SELECT event_id, dom_id, {NAMED}, NULL::double AS absent FROM wide",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
