"""The SQL each query must agree with, in DuckDB's dialect."""

from starflow.plans.xxhash import row_id

VISITS = """
visits AS (
  SELECT event_id,
         concat('P', user_id) AS patient_id,
         CASE WHEN event_id % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(floor(value) AS INT) AS age,
         event_type AS department,
         CASE WHEN event_id % 23 = 0 THEN NULL
              WHEN event_id % 20 = 0 THEN ts + INTERVAL 400 DAY
              ELSE ts END AS admission_in,
         CASE WHEN event_id % 11 = 0 THEN NULL
              ELSE ts + to_hours(CAST((event_id * 37) % 72 + 1 AS INT)) END AS discharge_time,
         CAST(event_id % 500 + 1 AS INT) AS bed_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id % 7 + 1 AS INT) END AS hospital_id,
         CAST((day(ts) - 1) // 10 AS INT) AS batch
  FROM events
)"""

# Event text and its parsed fields.
RAW = """
raw AS (
  SELECT event_id, batch, CASE WHEN event_id % 31 = 0 THEN substr(full_text, 1, 20) ELSE full_text END AS raw_json
  FROM (
    SELECT event_id, batch, '{' || concat_ws(',',
        CASE WHEN event_id % 101 <> 0 THEN '"patient_id":"' || patient_id || '"' END,
        '"gender":"' || gender || '"',
        '"age":' || age,
        '"department":"' || department || '"',
        CASE WHEN event_id % 23 = 0 THEN '"admission_time":"not-a-time"'
             ELSE '"admission_time":"' || strftime(admission_in, '%Y-%m-%dT%H:%M:%S.%f') || '"' END,
        '"discharge_time":"' || strftime(discharge_time, '%Y-%m-%dT%H:%M:%S.%f') || '"',
        '"bed_id":' || bed_id,
        '"hospital_id":' || hospital_id) || '}' AS full_text
    FROM visits)
),
parsed AS (
  SELECT event_id,
         CASE WHEN event_id % 31 <> 0 AND event_id % 101 <> 0 THEN patient_id END AS patient_id,
         CASE WHEN event_id % 31 <> 0 THEN gender END AS gender,
         CASE WHEN event_id % 31 <> 0 THEN age END AS age,
         CASE WHEN event_id % 31 <> 0 THEN department END AS department,
         CASE WHEN event_id % 31 = 0 THEN NULL
              WHEN event_id % 23 = 0 THEN 'not-a-time'
              ELSE strftime(admission_in, '%Y-%m-%dT%H:%M:%S.%f') END AS admission_time,
         CASE WHEN event_id % 31 <> 0
              THEN strftime(discharge_time, '%Y-%m-%dT%H:%M:%S.%f') END AS discharge_time,
         CASE WHEN event_id % 31 <> 0 THEN bed_id END AS bed_id,
         CASE WHEN event_id % 31 <> 0 THEN hospital_id END AS hospital_id
  FROM visits
)"""

SILVER = """
silver AS (
  SELECT patient_id, gender, CASE WHEN age > 100 THEN 90 ELSE age END AS age, department,
         CASE WHEN admission_in IS NULL OR admission_in > TIMESTAMP '2024-01-31'
              THEN TIMESTAMP '2024-01-31' ELSE admission_in END AS admission_time,
         discharge_time, bed_id, hospital_id, event_id, batch,
         admission_in IS NULL OR admission_in > TIMESTAMP '2024-01-31' AS admission_repaired
  FROM visits
),
hashed AS (
  SELECT *, sha256(patient_id) AS patient_sk,
         sha256(concat_ws('||', coalesce(gender, 'NA'), coalesce(CAST(age AS VARCHAR), 'NA'))) AS attr_hash,
         sha256(concat_ws('||', coalesce(department, 'NA'),
                          coalesce(CAST(hospital_id AS VARCHAR), 'NA'))) AS department_sk
  FROM silver
)"""


def _history(name: str, rows: str, arrival: str = "batch", guard: bool = False) -> str:
    """Versions after the batches of ``rows``, as CTE ``name``."""
    guarded = (
        f"""SELECT * FROM (
      SELECT *, max(admission_time) OVER (PARTITION BY patient_id ORDER BY {arrival}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {name}_latest)
    WHERE seen IS NULL OR admission_time > seen"""
        if guard
        else f"SELECT * FROM {name}_latest"
    )
    return f"""
{name}_latest AS (
  SELECT *, {arrival} AS arrival FROM {rows}
  QUALIFY row_number() OVER (PARTITION BY batch, patient_id ORDER BY admission_time DESC, event_id DESC) = 1
),
{name}_changes AS (
  SELECT * FROM (
    SELECT *, lag(attr_hash) OVER (PARTITION BY patient_id ORDER BY {arrival}) AS hash_before
    FROM ({guarded}))
  WHERE hash_before IS NULL OR hash_before <> attr_hash
),
{name} AS (
  SELECT patient_sk, patient_id, gender, age, attr_hash, effective_from,
         lead(effective_from) OVER (PARTITION BY patient_id ORDER BY effective_from) AS effective_to,
         lead(effective_from) OVER (PARTITION BY patient_id ORDER BY effective_from) IS NULL AS is_current
  FROM (SELECT *, TIMESTAMP '2024-01-11' + to_days(CAST(10 * arrival AS INT)) AS effective_from FROM {name}_changes)
)"""


KEY = "patient_id, department, hospital_id, admission_time"


def _facts(name: str, rows: str, ingested: str = "2024-01-31") -> str:
    """One fact per natural key of ``rows``, as CTE ``name``."""
    return f"""
{name} AS (
  SELECT patient_sk, department_sk, admission_time, discharge_time,
         CAST(admission_time AS DATE) AS admission_date,
         date_diff('second', date_trunc('second', admission_time), date_trunc('second', discharge_time)) / 3600.0
           AS length_of_stay_hours,
         coalesce(discharge_time > TIMESTAMP '2024-01-31', false) AS is_currently_admitted,
         bed_id, TIMESTAMP '{ingested}' AS event_ingestion_time,
         patient_id, department, hospital_id, event_id
  FROM {rows}
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY event_id DESC) = 1
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select.strip()


BASE = (VISITS, SILVER)
HISTORY = (*BASE, _history("dim", "hashed"))
FACTS = (*BASE, _facts("fact", "hashed"))
STAR = (*HISTORY, _facts("fact", "hashed"))

FACT_COLUMNS = (
    "patient_sk, department_sk, admission_time, discharge_time, admission_date, length_of_stay_hours, "
    "is_currently_admitted, bed_id, event_ingestion_time"
)
ALL_VERSIONS = _with(*HISTORY, select="SELECT * FROM dim")
MEMBERS = _with(*BASE, select="SELECT DISTINCT department, hospital_id, department_sk FROM hashed")
PARSED_TIMES = """CASE WHEN admission_time <> 'not-a-time'
         THEN strptime(admission_time, '%Y-%m-%dT%H:%M:%S.%f') END AS admission_time,
       strptime(discharge_time, '%Y-%m-%dT%H:%M:%S.%f') AS discharge_time"""

LATE = (*BASE, _history("dim", "hashed", "(3 - batch) % 3", guard=True))


def _occupancy(condition: str) -> str:
    return _with(
        *STAR,
        select=f"""
SELECT d.gender,
       CAST(count(CASE WHEN f.is_currently_admitted THEN f.bed_id END) AS DOUBLE)
         / nullif(CAST(count(f.bed_id) AS DOUBLE), 0) * 100 AS bed_occupancy_percent
FROM fact f JOIN dim d ON f.patient_sk = d.patient_sk AND {condition}
GROUP BY d.gender""",
    )


def _turnover(condition: str) -> str:
    hospital = "coalesce(CAST(f.hospital_id AS VARCHAR), '')"
    visit = f"f.patient_id || '/' || f.department || '/' || {hospital} || '/' || f.admission_time"
    return _with(
        *STAR,
        select=f"""
SELECT d.gender,
       CAST(count(DISTINCT {visit}) AS DOUBLE)
         / nullif(CAST(count(DISTINCT f.bed_id) AS DOUBLE), 0) AS bed_turnover_rate
FROM fact f JOIN dim d ON f.patient_sk = d.patient_sk AND {condition}
GROUP BY d.gender""",
    )


# Target: facts of batches 0 and 1; source: batch 2 and batch 1 again, discharged later.
UPSERT = _with(
    *BASE,
    "early AS (SELECT * FROM hashed WHERE batch <= 1)",
    """late AS (SELECT * REPLACE (CASE WHEN batch = 1 THEN discharge_time + INTERVAL 5 HOURS
                                  ELSE discharge_time END AS discharge_time)
          FROM hashed WHERE batch >= 1)""",
    _facts("t", "early", "2024-01-21"),
    _facts("s", "late", "2024-01-31"),
    select="""
SELECT coalesce(t.patient_sk, s.patient_sk) AS patient_sk,
       coalesce(t.department_sk, s.department_sk) AS department_sk,
       coalesce(t.admission_time, s.admission_time) AS admission_time,
       CASE WHEN s.event_id IS NOT NULL THEN s.discharge_time ELSE t.discharge_time END AS discharge_time,
       coalesce(t.admission_date, s.admission_date) AS admission_date,
       CASE WHEN s.event_id IS NOT NULL THEN s.length_of_stay_hours
            ELSE t.length_of_stay_hours END AS length_of_stay_hours,
       CASE WHEN s.event_id IS NOT NULL THEN s.is_currently_admitted
            ELSE t.is_currently_admitted END AS is_currently_admitted,
       CASE WHEN t.event_id IS NOT NULL THEN t.bed_id ELSE s.bed_id END AS bed_id,
       coalesce(s.event_ingestion_time, t.event_ingestion_time) AS event_ingestion_time,
       coalesce(t.patient_id, s.patient_id) AS patient_id,
       coalesce(t.department, s.department) AS department,
       CASE WHEN t.event_id IS NOT NULL THEN t.hospital_id ELSE s.hospital_id END AS hospital_id
FROM t FULL OUTER JOIN s
  ON t.patient_id = s.patient_id AND t.department = s.department AND t.admission_time = s.admission_time
 AND coalesce(t.hospital_id, -1) = coalesce(s.hospital_id, -1)""",
)

# Bed from the first batch a visit came in, the refreshed columns from the last.
STREAMED_FACTS = _with(
    *BASE,
    f"""per_batch AS (
  SELECT * FROM hashed
  QUALIFY row_number() OVER (PARTITION BY batch, {KEY} ORDER BY event_id DESC) = 1
)""",
    f"first_seen AS (SELECT * FROM per_batch QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY batch) = 1)",
    f"""last_seen AS (
  SELECT * FROM per_batch QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY batch DESC) = 1
)""",
    _facts("newest", "last_seen"),
    select="""
SELECT n.patient_sk, n.department_sk, n.admission_time, n.discharge_time, n.admission_date,
       n.length_of_stay_hours, n.is_currently_admitted, o.bed_id,
       TIMESTAMP '2024-01-11' + to_days(CAST(10 * l.batch AS INT)) AS event_ingestion_time,
       n.patient_id, n.department, n.hospital_id
FROM newest n
JOIN last_seen l ON l.event_id = n.event_id
JOIN first_seen o
  ON o.patient_id = n.patient_id AND o.department = n.department AND o.admission_time = n.admission_time
 AND coalesce(o.hospital_id, -1) = coalesce(n.hospital_id, -1)""",
)

# The turnover after each batch: a visit counts from its first batch on, with the bed it had then.
TURNOVER_BY_BATCH = _with(
    *HISTORY,
    f"""first_seen AS (
  SELECT * FROM hashed QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY batch, event_id DESC) = 1
)""",
    select="""
SELECT t.batch, d.gender, CAST(count(*) AS DOUBLE) / nullif(CAST(count(DISTINCT f.bed_id) AS DOUBLE), 0) AS bed_turnover_rate
FROM (SELECT DISTINCT batch FROM hashed) t
JOIN first_seen f ON f.batch <= t.batch
JOIN dim d ON d.patient_sk = f.patient_sk AND d.is_current
GROUP BY t.batch, d.gender""",
)

LANDED = _with(VISITS, RAW, select="SELECT event_id, length(raw_json) AS n_chars FROM raw")
SERVED_FACTS = _with(*FACTS, select=f"SELECT {FACT_COLUMNS} FROM fact")
STORED_FACTS = _with(
    *FACTS,
    select="SELECT * EXCLUDE (patient_sk, department_sk, event_id) FROM fact",
)

ORACLES = {
    # scans, literals, raw rows
    "stream_table_scan": "SELECT * FROM events",
    "batch_table_scan": "SELECT * FROM events",
    "dim_patient_current": _with(*HISTORY, select="SELECT patient_sk, patient_id FROM dim WHERE is_current"),
    "literal_rows": _with(
        VISITS,
        RAW,
        select="""
SELECT patient_id, gender, age, department, admission_time, discharge_time, bed_id, hospital_id
FROM parsed WHERE patient_id IS NOT NULL
UNION ALL
SELECT 'P1', 'Male', 41, 'view', '2024-01-09T07:15:30.250000', '2024-01-12T16:40:00.500000', 212, 3""",
    ),
    "raw_from_bytes": _with(VISITS, RAW, select='SELECT event_id AS "offset", raw_json FROM raw'),
    "json_parse_visits": _with(VISITS, RAW, select="SELECT * FROM parsed"),
    "parse_timestamps": _with(VISITS, RAW, select=f"SELECT event_id, {PARSED_TIMES} FROM parsed"),
    "land_raw_stream": LANDED,
    "land_raw_backfill": LANDED,
    "land_raw_folded": LANDED,
    # cleaning
    "conform_columns": _with(
        VISITS,
        select="""
SELECT event_id, patient_id, gender, age, department, admission_in AS admission_time, discharge_time, bed_id,
       CAST(NULL AS INT) AS hospital_id FROM visits""",
    ),
    "clean_admission_time": _with(*BASE, select="SELECT event_id, admission_time, admission_repaired FROM silver"),
    "clean_age": _with(*BASE, select="SELECT event_id, age FROM silver"),
    "silver_visits": _with(*BASE, select="SELECT * FROM silver"),
    "silver_from_raw": _with(
        *BASE, select="SELECT * FROM silver WHERE event_id % 31 <> 0 AND event_id % 101 <> 0"
    ),
    "quarantine_rows": _with(
        VISITS,
        select="""
SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'malformed' ELSE 'missing_key' END AS reason
FROM visits WHERE event_id % 31 = 0 OR event_id % 101 = 0""",
    ),
    "schema_merge_read": _with(
        *BASE,
        select="""
SELECT event_id, patient_id, CASE WHEN batch > 0 THEN hospital_id END AS hospital_id, batch FROM silver""",
    ),
    # keys
    "attr_fingerprint": _with(*BASE, select="SELECT event_id, attr_hash FROM hashed"),
    "surrogate_keys": _with(*BASE, select="SELECT event_id, patient_sk, department_sk FROM hashed"),
    "fact_row_id_groups": _with(*BASE, select=f"SELECT {KEY}, count(*) AS visits FROM silver GROUP BY ALL"),
    # dimensions
    "latest_per_patient": _with(
        *BASE,
        select="""
SELECT event_id, patient_id, gender, age, admission_time FROM silver
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY admission_time DESC, event_id DESC) = 1""",
    ),
    "scd2_history": ALL_VERSIONS,
    "scd2_step": ALL_VERSIONS,
    "scd2_insert": ALL_VERSIONS,
    "scd2_expire": _with(
        *BASE,
        "early AS (SELECT * FROM hashed WHERE batch <= 1)",
        _history("dim", "early"),
        """newest AS (
  SELECT patient_id AS id, attr_hash AS new_hash FROM hashed WHERE batch = 2
  QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY admission_time DESC, event_id DESC) = 1
)""",
        select="""
SELECT * EXCLUDE (id, new_hash, effective_to, is_current),
       CASE WHEN is_current AND new_hash <> attr_hash THEN TIMESTAMP '2024-01-31'
            ELSE effective_to END AS effective_to,
       is_current AND NOT coalesce(new_hash <> attr_hash, false) AS is_current
FROM dim LEFT JOIN newest ON id = patient_id""",
    ),
    "scd2_late_events": _with(*LATE, select="SELECT * FROM dim"),
    "scd2_late_history": _with(*LATE, select="SELECT * FROM dim"),
    "stream_dim_patient": ALL_VERSIONS,
    "stream_incremental_rerun": ALL_VERSIONS,
    "stream_replay_idempotent": ALL_VERSIONS,
    "dim_department_members": MEMBERS,
    "dim_department_merge": MEMBERS,
    "stream_dim_department": MEMBERS,
    "dim_date": _with(
        *BASE,
        select="""
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
       CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
       CAST(weekofyear(d) AS INT) AS week_of_year
FROM (SELECT unnest(generate_series(min(CAST(admission_time AS DATE)), max(CAST(admission_time AS DATE)),
                                    INTERVAL 1 DAY)) AS d FROM silver)""",
    ),
    # facts
    "fact_measures": _with(
        *BASE,
        select="""
SELECT event_id, CAST(admission_time AS DATE) AS admission_date,
       date_diff('second', date_trunc('second', admission_time), date_trunc('second', discharge_time)) / 3600.0
         AS length_of_stay_hours,
       coalesce(discharge_time > TIMESTAMP '2024-01-31', false) AS is_currently_admitted,
       discharge_time IS NULL AS is_open_stay
FROM silver""",
    ),
    "fact_lookup_patient": _with(*FACTS, select=f"SELECT {KEY}, bed_id, patient_sk FROM fact"),
    "fact_lookup_department": _with(*FACTS, select=f"SELECT {KEY}, bed_id, department_sk FROM fact"),
    "fact_unresolved_keys": _with(
        *FACTS,
        "members AS (SELECT DISTINCT department_sk AS known FROM hashed WHERE batch = 0)",
        select=f"""
SELECT {KEY}, patient_missing, department_missing FROM (
  SELECT *, patient_id IN ('P1', 'P2', 'P3', 'P4', 'P5') AS patient_missing, known IS NULL AS department_missing
  FROM fact LEFT JOIN members ON known = department_sk)
WHERE patient_missing OR department_missing""",
    ),
    "fact_upsert": UPSERT,
    "stream_fact": STREAMED_FACTS,
    "fact_partitioned_roundtrip": STORED_FACTS,
    # KPIs
    "kpi_bed_occupancy": _occupancy("d.is_current"),
    "kpi_bed_occupancy_all_versions": _occupancy("true"),
    "kpi_bed_turnover": _turnover("d.is_current"),
    "kpi_bed_turnover_all_versions": _turnover("true"),
    # catalog and exports
    "ddl_declared_table": ALL_VERSIONS,
    "ddl_registered_table": STORED_FACTS,
    "serve_dim_patient": _with(
        *HISTORY,
        select="""
SELECT patient_id, gender, age, effective_from, patient_sk AS surrogate_key, effective_to, is_current FROM dim""",
    ),
    "serve_dim_department": _with(
        *BASE, select="SELECT DISTINCT department_sk AS surrogate_key, department, hospital_id FROM hashed"
    ),
    "serve_fact": SERVED_FACTS,
    "serve_fact_select": SERVED_FACTS,
}
ORACLES["serve_fact_refresh"] = ORACLES["serve_fact"]
ORACLES["fact_resolved_late"] = ORACLES["serve_fact"]
ORACLES["stream_fact_by_arrival"] = ORACLES["stream_fact_resolved"] = ORACLES["stream_fact"]
ORACLES["land_backfill_after_clean"] = _with(
    *BASE, select="SELECT * EXCLUDE (batch) FROM silver WHERE event_id % 31 <> 0 AND event_id % 101 <> 0"
)
# A week's reports come at its end; the state of week e goes once a week w has passed with
# end(w) - 5 days >= end(e) + 5 days, and the key is new to the weeks after w.
ORACLES["stream_dedup_within_horizon"] = """
WITH RECURSIVE reports AS (
  SELECT DISTINCT event_type AS department, CAST(event_id % 500 + 1 AS INT) AS bed_id,
         CAST((day(ts) - 1) // 7 AS INT) AS batch
  FROM events
),
ends AS (SELECT DISTINCT batch, TIMESTAMP '2024-01-08' + to_days(CAST(7 * batch AS INT)) AS reported FROM reports),
seen AS (
  SELECT department, bed_id, min(batch) AS batch FROM reports GROUP BY department, bed_id
  UNION ALL
  SELECT s.department, s.bed_id, min(r.batch)
  FROM seen s
  JOIN ends e ON e.batch = s.batch
  JOIN reports r ON r.department = s.department AND r.bed_id = s.bed_id
  WHERE EXISTS (SELECT 1 FROM ends w WHERE w.batch < r.batch AND w.reported - INTERVAL 5 DAY >= e.reported + INTERVAL 5 DAY)
  GROUP BY s.department, s.bed_id, s.batch
)
SELECT department, bed_id, batch, reported FROM seen JOIN ends USING (batch)"""
ORACLES["scd2_event_time_history"] = _with(
    *BASE,
    """points AS (
  SELECT * FROM hashed
  QUALIFY row_number() OVER (PARTITION BY patient_id, admission_time ORDER BY event_id DESC) = 1
)""",
    """changes AS (
  SELECT * FROM (
    SELECT *, lag(attr_hash) OVER (PARTITION BY patient_id ORDER BY admission_time) AS hash_before FROM points)
  WHERE hash_before IS NULL OR hash_before <> attr_hash
)""",
    select="""
SELECT patient_sk, patient_id, gender, age, attr_hash, admission_time AS effective_from,
       lead(admission_time) OVER (PARTITION BY patient_id ORDER BY admission_time) AS effective_to,
       lead(admission_time) OVER (PARTITION BY patient_id ORDER BY admission_time) IS NULL AS is_current
FROM changes""",
)
ORACLES["kpi_turnover_incremental"] = TURNOVER_BY_BATCH
ORACLES["serve_fact_increment"] = f"SELECT {FACT_COLUMNS} FROM ({STREAMED_FACTS})"
ORACLES["fact_row_id"] = row_id(_with(*BASE, select="SELECT * FROM silver"), "event_id")
