"""The queries again as DuckDB SQL, written from the rules and not from the
Spark code. ``CTES`` are named parts; a query lists the parts it needs."""

from __future__ import annotations

from ..constants import DEFAULTS
from . import adapter as A

CTES: dict[str, tuple[list[str], str]] = {}
ORACLE: dict[str, str] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (needs.split(), body)


def oracle(name: str, needs: str, select: str) -> None:
    ordered: list[str] = []

    def visit(part: str) -> None:
        for before in CTES[part][0]:
            visit(before)
        if part not in ordered:
            ordered.append(part)

    for part in needs.split():
        visit(part)
    head = ",\n".join(f"{p} AS ({CTES[p][1]})" for p in ordered)
    ORACLE[name] = (f"WITH {head}\n" if head else "") + select


# ---- raw stand-ins -------------------------------------------------------

cte(
    "adm",
    "",
    """SELECT user_id, min(epoch_us(ts)) + (CASE WHEN user_id % 2 = 0 THEN 20 ELSE 40 END) * CAST(60000000 AS BIGINT) AS admit_us,
       max(epoch_us(ts)) AS last_us FROM events GROUP BY user_id""",
)
cte(
    "patient",
    "adm",
    """SELECT 'p' || CAST(user_id - user_id % 2 AS VARCHAR) AS uniquepid, user_id AS patientunitstayid,
       user_id // 3 AS patienthealthsystemstayid,
       CASE WHEN user_id % 10 = 0 THEN '> 89' WHEN user_id % 10 = 1 THEN '' ELSE CAST(15 + user_id % 70 AS VARCHAR) END AS age,
       CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       'e' || CAST(user_id % 5 AS VARCHAR) AS ethnicity,
       CAST(2014 + user_id % 2 AS INTEGER) AS hospitaldischargeyear,
       CASE WHEN user_id % 13 <> 12 THEN CAST(floor((last_us - admit_us) / 6e7) AS BIGINT) END AS unitdischargeoffset,
       CASE WHEN user_id % 7 = 0 THEN 'Expired' WHEN user_id % 7 = 1 THEN NULL ELSE 'Alive' END AS unitdischargestatus,
       CAST(CASE WHEN user_id % 11 = 0 THEN 0 ELSE 150 + user_id % 40 END AS DOUBLE) AS admissionheight,
       CAST(CASE WHEN user_id % 17 = 0 THEN 0 ELSE 50 + user_id % 60 END AS DOUBLE) AS admissionweight,
       CAST(CASE WHEN user_id % 3 = 0 THEN NULL ELSE 48 + user_id % 60 END AS DOUBLE) AS dischargeweight FROM adm""",
)
cte(
    "ev",
    "adm",
    """SELECT event_id, e.user_id AS patientunitstayid, event_type, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
       CAST(floor((epoch_us(ts) - admit_us) / 6e7) AS BIGINT) AS off
       FROM events e JOIN adm a ON e.user_id = a.user_id""",
)
cte(
    "infusionDrug",
    "ev",
    """SELECT event_id AS infusiondrugid, patientunitstayid, off AS infusionoffset,
       CASE k % 3 WHEN 0 THEN 'Norepinephrine (mcg/min)' WHEN 1 THEN 'Dopamine (ml/hr)' ELSE 'Saline' END AS drugname,
       CASE WHEN k % 9 = 0 THEN 'OFF' WHEN k % 11 = 0 THEN '1d' ELSE CAST(k AS VARCHAR) END AS drugrate,
       CAST(CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 5 THEN 0 ELSE 1 + k % 7 END AS DOUBLE) AS infusionrate,
       CASE WHEN k % 4 <> 0 THEN value END AS drugamount, value AS volumeoffluid
       FROM ev WHERE event_type = 'error'""",
)
cte(
    "intakeOutput",
    "ev",
    """SELECT patientunitstayid, off AS intakeoutputoffset,
       CASE WHEN k % 31 = 0 THEN NULL WHEN k % 2 = 0 THEN 'flowsheet/Intake/x' ELSE 'flowsheet/Output/x' END AS cellpath,
       'c' || CAST((k // 2) % 4 AS VARCHAR) AS celllabel, CASE WHEN k % 13 <> 0 THEN value END AS cellvaluenumeric
       FROM ev WHERE event_type = 'signup'""",
)
cte(
    "treatment_once",
    "ev",
    """SELECT event_id AS treatmentid, patientunitstayid, off AS treatmentoffset,
       CASE WHEN k % 6 = 0 THEN 'Ventilator' ELSE 't' || CAST(k % 6 AS VARCHAR) END AS treatmentstring
       FROM ev WHERE event_type = 'signup'""",
)
cte(
    "nurseCharting",
    "ev",
    """SELECT event_id AS nursingchartid, patientunitstayid, off AS nursingchartoffset,
       CASE WHEN k % 29 = 0 THEN NULL WHEN k % 23 = 0 THEN 'OFF'
            WHEN event_type = 'click' THEN CAST(45 + (v % 1000) // 10 AS VARCHAR) || '.' || CAST(v % 10 AS VARCHAR)
            ELSE CAST(30 + (v % 600) // 10 AS VARCHAR) || '.' || CAST(v % 10 AS VARCHAR) END AS nursingchartvalue,
       CASE WHEN event_type = 'click' THEN 'ABPs' ELSE 'ABPd' END AS nursingchartcelltypevallabel
       FROM (SELECT *, CAST(floor(value * 10) AS BIGINT) AS v FROM ev) WHERE event_type IN ('click', 'view')""",
)
cte(
    "respiratoryCharting",
    "ev",
    """SELECT event_id AS respchartid, patientunitstayid, off AS respchartoffset,
       CASE WHEN event_type = 'error' THEN 'RT Vent On/Off' ELSE 'FiO2' END AS respchartvaluelabel,
       CASE WHEN event_type = 'signup' THEN CAST(21 + k % 70 AS VARCHAR) WHEN k % 3 = 0 THEN 'Start'
            WHEN k % 3 = 1 THEN 'Off' ELSE 'Continued' END AS respchartvalue
       FROM ev WHERE event_type = 'error' OR (event_type = 'signup' AND k % 3 = 0)""",
)
cte(
    "vitals_long",
    "ev",
    """SELECT event_id AS nursingchartid, patientunitstayid, off AS event_min, label AS nursingchartcelltypevallabel,
              v AS nursingchartvalue FROM (
       SELECT event_id, patientunitstayid, off, 'temperature' AS label, CASE WHEN k % 3 = 0 THEN 35.0::DOUBLE + k % 20 END AS v FROM ev WHERE event_type = 'click'
       UNION ALL SELECT event_id, patientunitstayid, off, 'heartrate', 60.0::DOUBLE + k FROM ev WHERE event_type = 'click'
       UNION ALL SELECT event_id, patientunitstayid, off, 'systemicsystolic', CASE WHEN k % 5 = 0 THEN 90.0::DOUBLE + k END FROM ev WHERE event_type = 'click'
       UNION ALL SELECT event_id, patientunitstayid, off, 'systemicdiastolic', CASE WHEN k % 5 = 1 THEN 50.0::DOUBLE + k END FROM ev WHERE event_type = 'click'
       UNION ALL SELECT event_id, patientunitstayid, off, 'noninvasivesystolic', 80.0::DOUBLE + k FROM ev WHERE event_type = 'view'
       UNION ALL SELECT event_id, patientunitstayid, off, 'cardiacoutput', CASE WHEN k % 8 = 0 THEN 3.0::DOUBLE + k % 4 END FROM ev WHERE event_type = 'view')
       WHERE v IS NOT NULL""",
)
cte(
    "micro_long",
    "ev",
    """SELECT event_id AS labid, patientunitstayid, off AS event_min, 's' || CAST(k % 4 AS VARCHAR) AS labname
       FROM ev WHERE event_type = 'signup' AND k % 3 <> 0
       UNION ALL SELECT event_id, patientunitstayid, off, 'a' || CAST(k % 5 AS VARCHAR)
       FROM ev WHERE event_type = 'signup' AND k % 4 <> 0""",
)
cte(
    "lab_all",
    "ev",
    """SELECT event_id AS labid, patientunitstayid, off AS event_min, k % 7 = 0 AS custom,
       CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN 'OFF'
            ELSE CAST((v % 400) // 100 AS VARCHAR) || '.' || lpad(CAST(v % 100 AS VARCHAR), 2, '0') END AS labresult,
       CASE WHEN k % 2 = 0 THEN 'Lactate' WHEN k % 8 = 1 THEN 'FIO2 (%)' WHEN k % 8 = 3 THEN 'PaO2' ELSE 'Creatinine' END AS labname,
       CASE WHEN k % 7 = 0 THEN 'Not exist' WHEN k % 5 <> 0 THEN 'mmol/L' ELSE '0' END AS labmeasurenamesystem
       FROM (SELECT *, CAST(floor(value * 10) AS BIGINT) AS v FROM ev) WHERE event_type = 'purchase'""",
)
cte(
    "dx_raw",
    "",
    """SELECT l_orderkey AS patientunitstayid,
       CASE WHEN p_size % 17 = 0 THEN NULL
            WHEN p_size % 5 = 0 THEN CAST(30 + n AS VARCHAR) || '.' || CAST(p_size AS VARCHAR)
            ELSE CAST(30 + n AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) || ', ' ||
              CASE WHEN p_size % 7 = 0 THEN 'S' || CAST(n AS VARCHAR) || '.0' WHEN p_size % 11 = 0 THEN 'J93.1'
                   WHEN p_size % 13 = 0 THEN 'G50.8' WHEN p_size % 19 = 0 THEN 'I51.4'
                   ELSE 'I' || CAST(20 + n + (p_size % 3) * 25 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) END
       END AS code
       FROM lineitem JOIN (SELECT *, CAST(substring(p_brand, 7) AS INTEGER) AS n FROM part) ON l_partkey = p_partkey""",
)
cte(
    "dx",
    "dx_raw",
    """SELECT patientunitstayid, replace(trim(split_part(code, ',', 1)), '.', '') AS icd9,
       replace(trim(split_part(code, ',', 2)), '.', '') AS icd10 FROM dx_raw WHERE code LIKE '%,%'""",
)

# ---- cohort --------------------------------------------------------------

cte(
    "visits",
    "patient",
    """SELECT uniquepid, patientunitstayid, patienthealthsystemstayid, CAST(0 AS BIGINT) AS unitadmissionoffset,
       unitdischargeoffset, unitdischargeoffset AS los_min, hospitaldischargeyear AS min_valid_year, unitdischargestatus,
       TRY_CAST(nullif(regexp_extract(age, '[0-9]+'), '') AS DOUBLE) AS Age, gender, ethnicity,
       admissionheight, admissionweight, dischargeweight
       FROM patient WHERE TRY_CAST(nullif(regexp_extract(age, '[0-9]+'), '') AS DOUBLE) >= 18""",
)
cte(
    "cohort",
    "visits",
    """SELECT uniquepid, patientunitstayid, unitadmissionoffset, unitdischargeoffset, Age, gender, ethnicity,
       admissionheight, admissionweight,
       CAST(CASE WHEN unitdischargestatus = 'Expired' AND unitdischargeoffset >= 0 THEN 1 ELSE 0 END AS INTEGER) AS label,
       coalesce(unitdischargestatus, '0') AS unitdischargestatus, patienthealthsystemstayid,
       coalesce(dischargeweight, 0) AS dischargeweight FROM visits WHERE unitdischargeoffset IS NOT NULL""",
)
cte(
    "stays",
    "cohort",
    """SELECT * REPLACE (CAST(Age AS INTEGER) AS Age) FROM (
       SELECT *, unitdischargeoffset AS los_min, CAST(round_even(unitdischargeoffset / 60.0, 0) AS BIGINT) AS los FROM cohort)
       WHERE los > 0""",
)
cte("grid", "stays", "SELECT patientunitstayid, los, unnest(range(los)) AS hour FROM stays")

NUM = "CASE WHEN regexp_matches({c}, '[0-9.][dDfF]\\s*$') OR lower(trim({c})) = 'nan' THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"


def num(c: str) -> str:
    return NUM.format(c=c)


def hour(minute: str) -> str:
    return f"CAST(round_even({minute} / 60.0, 0) AS BIGINT)"


def hour_up(minute: str) -> str:
    return f"CAST(ceil({minute} / 60.0) AS BIGINT)"


cte(
    "chart_num",
    "nurseCharting",
    f"""SELECT patientunitstayid, nursingchartoffset AS event_min, nursingchartcelltypevallabel AS label, v AS value
       FROM (SELECT *, {num('nursingchartvalue')} AS v FROM nurseCharting) WHERE v IS NOT NULL""",
)
cte(
    "lab_num",
    "lab_all",
    f"""SELECT patientunitstayid, event_min, labname AS label, v AS value
       FROM (SELECT *, {num('labresult')} AS v FROM lab_all WHERE NOT custom) WHERE v IS NOT NULL""",
)


def points(source: str, minute: str = "event_min") -> str:
    return f"""SELECT p.*, {hour(minute)} AS hour, s.los, s.uniquepid
       FROM {source} p JOIN stays s ON p.patientunitstayid = s.patientunitstayid
       WHERE {hour(minute)} >= 0 AND {hour(minute)} < s.los"""


cte("chart_pts", "chart_num stays", points("chart_num"))
cte("lab_pts", "lab_num stays", points("lab_num"))
cte(
    "intake",
    "intakeOutput cohort",
    """SELECT i.patientunitstayid, c.uniquepid, celllabel, coalesce(cellvaluenumeric, 0) AS value, intakeoutputoffset AS start_min,
       intakeoutputoffset + 1 AS stop_min FROM intakeOutput i JOIN cohort c ON i.patientunitstayid = c.patientunitstayid
       WHERE cellpath ILIKE '%intake%'""",
)
cte(
    "output",
    "intakeOutput cohort",
    """SELECT i.patientunitstayid, c.uniquepid, celllabel, coalesce(cellvaluenumeric, 0) AS value, intakeoutputoffset AS event_min,
       c.unitdischargeoffset FROM intakeOutput i JOIN cohort c ON i.patientunitstayid = c.patientunitstayid
       WHERE cellpath ILIKE '%output%'""",
)
cte(
    "infusion",
    "infusionDrug cohort",
    """SELECT infusiondrugid, patientunitstayid, uniquepid, drugname, drugrate, coalesce(unit, '0') AS unit_time,
       infusionoffset AS start_min,
       CASE WHEN infusionrate = 0 THEN infusionoffset
            WHEN unit = 'mcg/min' THEN infusionoffset + CAST(ceil(volumeoffluid / infusionrate) AS BIGINT)
            WHEN unit = 'ml/hr' THEN infusionoffset + CAST(ceil(60 * volumeoffluid / infusionrate) AS BIGINT)
            ELSE 0 END AS stop_min, infusionrate, drugamount, volumeoffluid
       FROM (SELECT i.infusiondrugid, i.patientunitstayid, c.uniquepid, drugname, drugrate, infusionoffset,
               nullif(regexp_extract(drugname, '\\(([^)]+)\\)$', 1), '') AS unit, coalesce(infusionrate, 0) AS infusionrate,
               coalesce(drugamount, 0) AS drugamount, volumeoffluid
             FROM infusionDrug i JOIN cohort c ON i.patientunitstayid = c.patientunitstayid)""",
)
cte(
    "intake_iv",
    "intake stays",
    f"""SELECT patientunitstayid, celllabel, value, start_hour, least(start_hour + 1, los) AS stop_hour
       FROM (SELECT i.*, {hour('start_min')} AS start_hour, s.los FROM intake i JOIN stays s USING (patientunitstayid))
       WHERE start_hour >= 0 AND start_hour < los""",
)
cte(
    "infusion_iv",
    "infusion stays",
    f"""SELECT infusiondrugid, patientunitstayid, drugname, start_hour, least(stop_hour, los) AS stop_hour, {num('drugrate')} AS amount,
       infusionrate FROM (SELECT i.*, {hour('start_min')} AS start_hour, {hour_up('stop_min')} AS stop_hour, s.los
         FROM infusion i JOIN stays s USING (patientunitstayid))
       WHERE stop_hour > start_hour AND start_hour > 0 AND start_hour < los""",
)
cte(
    "vent",
    "respiratoryCharting",
    """SELECT first(respchartid ORDER BY respchartoffset, respchartid) FILTER (respchartvalue = 'Start') AS respchartid,
       patientunitstayid,
       first(respchartoffset ORDER BY respchartoffset, respchartid) FILTER (respchartvalue = 'Start') AS start_min,
       coalesce(last(respchartoffset ORDER BY respchartoffset, respchartid) FILTER (respchartvalue = 'Off'),
                last(respchartoffset ORDER BY respchartoffset, respchartid)) AS stop_min,
       'Ventilator' AS label FROM respiratoryCharting WHERE respchartvaluelabel = 'RT Vent On/Off'
       GROUP BY patientunitstayid HAVING count(*) FILTER (respchartvalue = 'Start') > 0""",
)
cte(
    "vent_iv",
    "vent stays",
    f"""SELECT patientunitstayid, start_hour, least(stop_hour, los) AS stop_hour
       FROM (SELECT v.patientunitstayid, {hour('start_min')} AS start_hour, {hour_up('stop_min')} AS stop_hour, los
             FROM vent v JOIN stays s USING (patientunitstayid))
       WHERE stop_hour > start_hour AND start_hour >= 0 AND start_hour < los""",
)
cte(
    "treated",
    "treatment_once stays",
    f"""SELECT treatmentid, patientunitstayid, uniquepid, treatmentstring, {hour('treatmentoffset')} AS hour
       FROM treatment_once t JOIN stays s USING (patientunitstayid)
       WHERE treatmentstring <> 'Ventilator' AND {hour('treatmentoffset')} >= 0 AND {hour('treatmentoffset')} < los""",
)


def pivot(source: str, label: str, value: str, names: dict[str, str]) -> str:
    cells = ", ".join(f"avg({value}) FILTER ({label} = '{k}') AS {v}" for k, v in names.items())
    return f"SELECT patientunitstayid, hour, {cells} FROM {source} GROUP BY patientunitstayid, hour"


def fill(source: str, names: list[str], has: str) -> str:
    """Forward fill on the grid; stays without any row of the family get 0."""
    cells = ", ".join(
        f"CASE WHEN h.patientunitstayid IS NULL THEN 0 ELSE last_value(c.{n} IGNORE NULLS) OVER w END AS {n}" for n in names
    )
    return f"""SELECT g.patientunitstayid, g.hour, {cells} FROM grid g
       LEFT JOIN {source} c ON c.patientunitstayid = g.patientunitstayid AND c.hour = g.hour
       LEFT JOIN (SELECT DISTINCT patientunitstayid FROM {has}) h ON h.patientunitstayid = g.patientunitstayid
       WINDOW w AS (PARTITION BY g.patientunitstayid ORDER BY g.hour)"""


def expand(source: str, label: str, values: dict[str, str]) -> str:
    """Active hours: the latest start at or before the hour, while it runs."""
    means = ", ".join(f"avg(coalesce({v}, 0)) AS {k}" for k, v in values.items())
    return f"""SELECT patientunitstayid, {label}, unnest(range(start_hour, CAST(least(ceil(stop), coalesce(nxt, ceil(stop))) AS BIGINT))) AS hour,
       {', '.join(values)} FROM (
         SELECT *, lead(start_hour) OVER (PARTITION BY patientunitstayid, {label} ORDER BY start_hour) AS nxt FROM (
           SELECT patientunitstayid, {label}, start_hour, avg(stop_hour) AS stop, {means} FROM {source}
           GROUP BY patientunitstayid, {label}, start_hour))"""


cte("chart_cells", "chart_pts", pivot("chart_pts", "label", "value", {"ABPs": "ABPs", "ABPd": "ABPd"}))
cte("lab_cells", "lab_pts", pivot("lab_pts", "label", "value", {"Lactate": "Lactate", "Creatinine": "Creatinine"}))
cte("chart_ff", "grid chart_cells chart_pts", fill("chart_cells", ["ABPs", "ABPd"], "chart_pts"))
cte("lab_ff", "grid lab_cells lab_pts", fill("lab_cells", ["Lactate", "Creatinine"], "lab_pts"))
cte("drug_on", "infusion_iv", expand("infusion_iv", "drugname", {"amount": "amount", "rate": "infusionrate"}))
cte(
    "state_in",
    "chart_ff lab_ff drug_on",
    """SELECT c.patientunitstayid, c.hour, (2 * coalesce(ABPd, 75) + coalesce(ABPs, 125)) / 3 AS map,
       coalesce(Lactate, 1.1) AS lactate, CAST(coalesce(dose, 0) > 0 AS INTEGER) AS vaso
       FROM chart_ff c JOIN lab_ff l ON l.patientunitstayid = c.patientunitstayid AND l.hour = c.hour
       LEFT JOIN (SELECT patientunitstayid, hour, sum(amount) AS dose FROM drug_on WHERE drugname <> 'Saline'
                  GROUP BY patientunitstayid, hour) d ON d.patientunitstayid = c.patientunitstayid AND d.hour = c.hour""",
)
STATE = """SELECT *, CASE WHEN avg(map) OVER w > 65 AND max(vaso) OVER w = 0 AND min(lactate) OVER w < 2 THEN 'no_circ'
       WHEN (avg(map) OVER w <= 65 OR max(vaso) OVER w = 1) AND max(lactate) OVER w >= 2 THEN 'circ' ELSE 'ambiguous' END AS Annotation
       FROM {source} WINDOW w AS (PARTITION BY patientunitstayid ORDER BY hour RANGE BETWEEN 1 PRECEDING AND CURRENT ROW)"""
NEXT = """SELECT *, CAST(coalesce(max(CASE WHEN Annotation = 'circ' THEN 1 ELSE 0 END) OVER (PARTITION BY patientunitstayid
       ORDER BY hour RANGE BETWEEN 1 FOLLOWING AND 12 FOLLOWING), 0) AS INTEGER) AS Shock_next_12h FROM {source}"""
cte("state", "state_in", STATE.format(source="state_in"))
cte("outlook", "state", NEXT.format(source="state"))

# ---- queries -------------------------------------------------------------

oracle(
    "src_events",
    "",
    "SELECT event_id, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
)
oracle(
    "null_policy",
    "infusionDrug",
    """SELECT infusiondrugid, patientunitstayid, coalesce(drugrate, '0') AS drugrate, infusionrate,
       coalesce(drugamount, 0) AS drugamount FROM infusionDrug WHERE infusionrate IS NOT NULL""",
)
oracle(
    "numeric_coerce",
    "",
    """SELECT event_id, CAST(k AS DOUBLE) AS number FROM (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
       FROM events) WHERE k % 9 <> 0 AND k % 11 <> 0 AND k % 13 <> 0""",
)
oracle("dedupe_events", "treatment_once", "SELECT * FROM treatment_once")
oracle(
    "sink_roundtrip",
    "treatment_once",
    """SELECT patientunitstayid, treatmentid, treatmentstring FROM treatment_once
       UNION ALL SELECT patientunitstayid, treatmentid, treatmentstring FROM treatment_once WHERE treatmentid % 5 = 0""",
)
oracle(
    "read_csv_roundtrip",
    "infusionDrug",
    """SELECT infusiondrugid, patientunitstayid, infusionoffset, drugname, drugrate, infusionrate, drugamount, volumeoffluid
       FROM infusionDrug""",
)
oracle(
    "read_dictionary",
    "",
    "SELECT p_brand AS itemstring, arg_max(p_name, p_partkey) AS altername FROM part GROUP BY p_brand",
)
oracle(
    "profile_counts",
    "stays",
    """SELECT count(DISTINCT uniquepid) AS patients, count(DISTINCT patientunitstayid) AS stays, count(DISTINCT gender) AS genders,
       count(DISTINCT ethnicity) AS ethnicities, CAST(sum(los) AS BIGINT) AS expected_hours FROM stays""",
)
oracle(
    "profile_events",
    "output stays",
    f"""SELECT count(DISTINCT celllabel) AS items, count(DISTINCT o.patientunitstayid) AS stays, count(*) AS rows
       FROM output o JOIN stays s ON s.patientunitstayid = o.patientunitstayid
       WHERE {hour('event_min')} >= 0 AND {hour('event_min')} < los""",
)
oracle("label_frequencies", "lab_all", "SELECT labname, count(*) AS rows FROM lab_all WHERE NOT custom GROUP BY labname")
oracle("cohort_visits", "visits", "SELECT * FROM visits")
oracle(
    "cohort_invalid",
    "visits",
    "SELECT uniquepid, patientunitstayid, unitdischargeoffset, Age FROM visits WHERE unitdischargeoffset IS NULL",
)
oracle("cohort_mortality", "cohort", "SELECT * FROM cohort")
oracle(
    "cohort_summary",
    "cohort",
    """SELECT count(*) AS records, count(DISTINCT uniquepid) AS patients, count(*) FILTER (label = 1) AS positive,
       count(*) FILTER (label = 0) AS negative FROM cohort""",
)
oracle("cohort_los", "stays", "SELECT uniquepid, patientunitstayid, los_min, los, Age, label FROM stays")
oracle(
    "cohort_restrict",
    "chart_pts",
    "SELECT patientunitstayid, hour, label, round(value, 6) AS value FROM chart_pts WHERE los >= 700",
)
oracle(
    "cohort_required_items",
    "chart_num lab_num stays",
    """SELECT s.patientunitstayid, s.uniquepid, s.los FROM stays s WHERE s.patientunitstayid IN (
         SELECT patientunitstayid FROM chart_num WHERE label = 'ABPs' AND value > 70
         INTERSECT SELECT patientunitstayid FROM chart_num WHERE label = 'ABPd' AND value > 50
         INTERSECT SELECT patientunitstayid FROM lab_num WHERE label = 'Lactate' AND value > 3.5)""",
)
CODES = """CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INTEGER) AS gender,
       CAST(dense_rank() OVER (ORDER BY ethnicity) - 1 AS INTEGER) AS ethnicity"""
oracle("label_encode", "stays", f"SELECT patientunitstayid, {CODES} FROM stays")
oracle(
    "join_inner_cohort",
    "nurseCharting stays",
    "SELECT nursingchartid, n.patientunitstayid, s.uniquepid FROM nurseCharting n JOIN stays s ON n.patientunitstayid = s.patientunitstayid",
)
for _name in ("join_left_los", "join_salted"):
    oracle(
        _name,
        "nurseCharting stays",
        """SELECT nursingchartid, n.patientunitstayid, s.los FROM nurseCharting n
           LEFT JOIN stays s ON n.patientunitstayid = s.patientunitstayid""",
    )
oracle(
    "join_semi",
    "lab_all stays",
    "SELECT labid, patientunitstayid FROM lab_all WHERE NOT custom AND patientunitstayid IN (SELECT patientunitstayid FROM stays)",
)
oracle(
    "join_anti_zero_weight",
    "lab_all stays",
    """SELECT labid, patientunitstayid FROM lab_all WHERE NOT custom
       AND patientunitstayid NOT IN (SELECT patientunitstayid FROM stays WHERE admissionweight = 0)""",
)
oracle(
    "join_left_stay_hour",
    "grid intakeOutput",
    f"""SELECT patientunitstayid, hour, CAST((patientunitstayid, hour) IN (SELECT (patientunitstayid, {hour('intakeoutputoffset')})
       FROM intakeOutput WHERE cellpath LIKE '%Intake%' AND celllabel IN ('c1', 'c3')) AS INTEGER) AS given FROM grid""",
)
oracle(
    "extract_infusion",
    "infusion",
    """SELECT infusiondrugid, patientunitstayid, uniquepid, drugname, drugrate, unit_time, start_min, stop_min,
       round(infusionrate, 6) AS infusionrate, round(drugamount, 6) AS drugamount, round(volumeoffluid, 6) AS volumeoffluid FROM infusion""",
)
oracle(
    "infusion_stop_time",
    "",
    """SELECT l_orderkey, l_linenumber, l_partkey AS start, unit,
       CASE WHEN l_discount = 0 THEN l_partkey
            WHEN unit IN ('mcg/kg/min', 'ml') THEN l_partkey + CAST(ceil(l_quantity / l_discount) AS BIGINT)
            WHEN unit = 'ml/hr' THEN l_partkey + CAST(ceil(60 * l_quantity / l_discount) AS BIGINT) ELSE 0 END AS stop
       FROM (SELECT *, CASE l_linenumber % 5 WHEN 0 THEN 'mcg/kg/min' WHEN 1 THEN 'ml/hr' WHEN 2 THEN 'ml' WHEN 3 THEN 'unlisted' END AS unit
             FROM lineitem)""",
)
oracle(
    "extract_intake",
    "intake stays",
    """SELECT patientunitstayid, uniquepid, celllabel, round(value, 6) AS value, start_min, stop_min FROM intake
       WHERE patientunitstayid IN (SELECT patientunitstayid FROM stays)""",
)
oracle(
    "extract_output",
    "output stays",
    """SELECT patientunitstayid, uniquepid, celllabel, round(value, 6) AS value, event_min, unitdischargeoffset FROM output
       WHERE patientunitstayid IN (SELECT patientunitstayid FROM stays)""",
)
oracle(
    "extract_treatment",
    "treatment_once stays",
    """SELECT treatmentid, t.patientunitstayid, s.patienthealthsystemstayid, treatmentstring, treatmentoffset AS event_min
       FROM treatment_once t JOIN stays s ON t.patientunitstayid = s.patientunitstayid""",
)
oracle(
    "extract_labs",
    "lab_all stays",
    """SELECT labid, l.patientunitstayid, s.uniquepid, labname, labresult, labmeasurenamesystem, event_min
       FROM lab_all l JOIN stays s ON l.patientunitstayid = s.patientunitstayid WHERE labresult IS NOT NULL""",
)
cte(
    "chart_all",
    "nurseCharting respiratoryCharting",
    """SELECT nursingchartid, patientunitstayid, nursingchartoffset AS event_min, nursingchartcelltypevallabel, nursingchartvalue FROM nurseCharting
       UNION ALL SELECT respchartid, patientunitstayid, respchartoffset, respchartvaluelabel, respchartvalue FROM respiratoryCharting""",
)
oracle(
    "extract_chart",
    "chart_all stays",
    """SELECT DISTINCT c.*, s.uniquepid FROM chart_all c JOIN stays s ON c.patientunitstayid = s.patientunitstayid
       WHERE nursingchartvalue IS NOT NULL""",
)
oracle(
    "extract_vitals",
    "vitals_long stays",
    "SELECT v.*, s.uniquepid FROM vitals_long v JOIN stays s ON v.patientunitstayid = s.patientunitstayid",
)
oracle(
    "extract_micro",
    "micro_long stays",
    """SELECT labid, m.patientunitstayid, s.uniquepid, labname, event_min FROM micro_long m
       JOIN stays s ON m.patientunitstayid = s.patientunitstayid""",
)
oracle("vent_intervals", "vent", "SELECT * FROM vent")
oracle(
    "unpivot_vitals",
    "",
    """SELECT l_orderkey, l_linenumber, label, value FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
       FROM lineitem) UNPIVOT (value FOR label IN (l_quantity, l_extendedprice, l_discount, l_tax))""",
)
oracle(
    "feature_select",
    "",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'basic' WHEN p_type = 'LARGE' THEN 'big'
       ELSE lower(p_type) END AS label FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO'""",
)


def mapped(c: str, family: str) -> str:
    pairs = dict(A.DICTIONARIES[family])
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


oracle(
    "feature_select_union",
    "chart_num vitals_long stays",
    f"""SELECT patientunitstayid, event_min, label, round(value, 6) AS value FROM (
         SELECT patientunitstayid, event_min, {mapped('label', 'chart')} AS label, value FROM chart_num
         UNION ALL SELECT v.patientunitstayid, event_min, {mapped('nursingchartcelltypevallabel', 'chart')}, nursingchartvalue
         FROM vitals_long v JOIN stays s ON s.patientunitstayid = v.patientunitstayid) WHERE label IS NOT NULL""",
)
cte(
    "bounds",
    "",
    """SELECT l_returnflag, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.02) AS lo,
       quantile_cont(l_extendedprice, 0.98) AS hi FROM lineitem GROUP BY l_returnflag""",
)
oracle("outlier_bounds", "bounds", "SELECT l_returnflag, n, round(lo, 6) AS lo, round(hi, 6) AS hi FROM bounds")
oracle(
    "outlier_trim",
    "bounds",
    """SELECT l_orderkey, l_linenumber, l.l_returnflag, round(l_extendedprice, 6) AS l_extendedprice FROM lineitem l
       JOIN bounds b ON b.l_returnflag = l.l_returnflag WHERE l_extendedprice BETWEEN lo AND hi""",
)
oracle(
    "outlier_winsorize",
    "bounds",
    """SELECT l_orderkey, l_linenumber, l.l_returnflag, round(greatest(lo, least(hi, l_extendedprice)), 6) AS l_extendedprice
       FROM lineitem l JOIN bounds b ON b.l_returnflag = l.l_returnflag""",
)
cte(
    "nurse_num",
    "nurseCharting",
    f"""SELECT nursingchartid, label, v FROM (SELECT nursingchartid, nursingchartcelltypevallabel AS label,
         {num('nursingchartvalue')} AS v FROM nurseCharting) WHERE v IS NOT NULL""",
)
oracle(
    "clean_chart",
    "nurse_num",
    """SELECT nursingchartid, n.label, round(greatest(lo, least(hi, v)), 6) AS value FROM nurse_num n
       JOIN (SELECT label, quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM nurse_num GROUP BY label) b
       ON b.label = n.label""",
)
oracle("resample_points", "chart_pts", "SELECT patientunitstayid, label, hour, los, round(value, 6) AS value FROM chart_pts")
oracle("resample_treatment", "treated", "SELECT treatmentid, patientunitstayid, treatmentstring, hour FROM treated")
oracle(
    "resample_intake",
    "intake_iv",
    "SELECT patientunitstayid, celllabel, start_hour, stop_hour, round(value, 6) AS value FROM intake_iv",
)
oracle(
    "resample_intervals",
    "infusion_iv",
    """SELECT infusiondrugid, patientunitstayid, drugname, start_hour, stop_hour, amount, round(infusionrate, 6) AS infusionrate
       FROM infusion_iv""",
)
cte("micro_pts", "micro_long stays", points("micro_long"))
oracle(
    "union_procedures",
    "treated micro_pts",
    """SELECT uniquepid, patientunitstayid, treatmentid, treatmentstring, hour FROM treated
       UNION ALL SELECT uniquepid, patientunitstayid, labid, labname, hour FROM micro_pts""",
)
oracle("hour_grid", "grid", "SELECT patientunitstayid, los, hour FROM grid")
oracle(
    "pivot_hourly_mean",
    "chart_cells",
    "SELECT patientunitstayid, hour, round(ABPs, 6) AS ABPs, round(ABPd, 6) AS ABPd FROM chart_cells",
)
oracle(
    "ffill_hourly",
    "chart_ff lab_ff",
    """SELECT patientunitstayid, hour, round(ABPs, 6) AS ABPs, round(ABPd, 6) AS ABPd, round(Lactate, 6) AS Lactate,
       round(Creatinine, 6) AS Creatinine FROM chart_ff JOIN lab_ff USING (patientunitstayid, hour)""",
)
oracle(
    "pivot_presence",
    "treated",
    "SELECT patientunitstayid, hour, "
    + ", ".join(f"CAST(count(*) FILTER (treatmentstring = 't{i}') > 0 AS INTEGER) AS t{i}" for i in range(1, 6))
    + " FROM treated GROUP BY patientunitstayid, hour",
)
cte(
    "output_pts",
    "output stays",
    f"""SELECT o.patientunitstayid, celllabel, value, {hour('event_min')} AS hour FROM output o JOIN stays s USING (patientunitstayid)
       WHERE {hour('event_min')} >= 0 AND {hour('event_min')} < los""",
)
oracle(
    "pivot_output",
    "grid output_pts",
    "SELECT g.patientunitstayid, g.hour, "
    + ", ".join(f"round(coalesce(avg(value) FILTER (celllabel = 'c{i}'), 0), 6) AS c{i}" for i in range(4))
    + """ FROM grid g LEFT JOIN output_pts o ON o.patientunitstayid = g.patientunitstayid AND o.hour = g.hour
       GROUP BY g.patientunitstayid, g.hour""",
)
cte(
    "special_cells",
    "chart_pts",
    """SELECT patientunitstayid, hour, avg(value) FILTER (label = 'ABPs') AS ABPs, avg(value) FILTER (label = 'ABPd') AS ABPd,
       avg(value) FILTER (label = 'ABPs' AND event_min % 5 = 0) AS charted_map,
       count(*) FILTER (label = 'ABPd' AND patientunitstayid % 3 = 0) AS charted_ecmo FROM chart_pts GROUP BY patientunitstayid, hour""",
)
cte(
    "special_ff",
    "grid special_cells",
    """SELECT g.patientunitstayid, g.hour, charted_map, coalesce(charted_ecmo, 0) AS charted_ecmo,
       last_value(ABPs IGNORE NULLS) OVER w AS ABPs, last_value(ABPd IGNORE NULLS) OVER w AS ABPd,
       sum(coalesce(charted_ecmo, 0)) OVER (PARTITION BY g.patientunitstayid) AS any_ecmo,
       count(c.patientunitstayid) OVER (PARTITION BY g.patientunitstayid) AS any_row
       FROM grid g LEFT JOIN special_cells c ON c.patientunitstayid = g.patientunitstayid AND c.hour = g.hour
       WINDOW w AS (PARTITION BY g.patientunitstayid ORDER BY g.hour)""",
)
oracle(
    "chart_special",
    "special_ff",
    """SELECT patientunitstayid, hour, CASE WHEN any_row = 0 THEN 0 ELSE round(ABPs, 6) END AS ABPs,
       CASE WHEN any_row = 0 THEN 0 ELSE round(ABPd, 6) END AS ABPd,
       CASE WHEN any_row = 0 THEN 0.0::DOUBLE WHEN any_ecmo > 0 THEN CAST(charted_ecmo > 0 AS DOUBLE) END AS ECMO,
       CASE WHEN any_row = 0 THEN 0 ELSE round(coalesce(charted_map, (ABPs + 2 * ABPd) / 3), 6) END AS MAP FROM special_ff""",
)
oracle(
    "vent_hourly",
    "grid vent_iv",
    """SELECT g.patientunitstayid, g.hour, CAST(v.patientunitstayid IS NOT NULL AS INTEGER) AS ventilated FROM grid g
       LEFT JOIN vent_iv v ON v.patientunitstayid = g.patientunitstayid AND g.hour >= v.start_hour AND g.hour < v.stop_hour""",
)
cte(
    "intake_late",
    "intake_iv",
    "SELECT * FROM intake_iv WHERE start_hour > 0",
)
cte("intake_on", "intake_late", expand("intake_late", "celllabel", {"dose": "value"}))
oracle("interval_expand", "intake_on", "SELECT patientunitstayid, celllabel, hour, round(dose, 6) AS dose FROM intake_on")
oracle(
    "interval_expand_rate",
    "drug_on",
    "SELECT patientunitstayid, drugname, hour, round(amount, 6) AS amount, round(rate, 6) AS rate FROM drug_on",
)
_DRUG = {"Dopamine (ml/hr)": "Dopamine", "Norepinephrine (mcg/min)": "Norepinephrine", "Saline": "Saline"}
oracle(
    "tabular_wide",
    "chart_ff lab_ff drug_on treated",
    "SELECT c.patientunitstayid, c.hour, round(ABPs, 6) AS chart__ABPs, round(ABPd, 6) AS chart__ABPd, "
    "round(Lactate, 6) AS lab__Lactate, round(Creatinine, 6) AS lab__Creatinine, "
    + ", ".join(f"round(coalesce(d.a_{v}, 0), 6) AS ing__{v}, round(coalesce(d.r_{v}, 0), 6) AS rate__{v}" for v in _DRUG.values())
    + ", CAST(coalesce(t.t1, 0) AS DOUBLE) AS proc__t1, CAST(coalesce(t.t2, 0) AS DOUBLE) AS proc__t2 FROM chart_ff c "
    "JOIN lab_ff l ON l.patientunitstayid = c.patientunitstayid AND l.hour = c.hour LEFT JOIN (SELECT patientunitstayid, hour, "
    + ", ".join(
        f"max(amount) FILTER (drugname = '{k}') AS a_{v}, max(rate) FILTER (drugname = '{k}') AS r_{v}" for k, v in _DRUG.items()
    )
    + """ FROM drug_on GROUP BY patientunitstayid, hour) d ON d.patientunitstayid = c.patientunitstayid AND d.hour = c.hour
       LEFT JOIN (SELECT patientunitstayid, hour, max(CAST(treatmentstring = 't1' AS INTEGER)) AS t1,
         max(CAST(treatmentstring = 't2' AS INTEGER)) AS t2 FROM treated GROUP BY patientunitstayid, hour) t
       ON t.patientunitstayid = c.patientunitstayid AND t.hour = c.hour""",
)
oracle(
    "integrate_static",
    "stays chart_ff",
    f"""SELECT c.patientunitstayid, c.hour, s.uniquepid, s.Age, s.gender, s.ethnicity, s.admissionheight, s.admissionweight,
       round(c.ABPs, 6) AS ABPs FROM chart_ff c
       JOIN (SELECT * REPLACE ({CODES.replace(' AS gender', ' AS gender').replace(' AS ethnicity', ' AS ethnicity')}) FROM stays) s
       ON s.patientunitstayid = c.patientunitstayid""",
)
oracle(
    "merge_channels",
    "",
    """SELECT l_orderkey, l_linenumber, round(height, 6) AS height, CAST(height = 0 AS INTEGER) AS height_fillna,
       round(e, 6) AS Temperature, round(coalesce(t, e), 6) AS PEEP, round(coalesce(e, t), 6) AS fio2,
       round(l_quantity + l_discount, 6) AS dopamine, round(l_quantity, 6) AS Saline, round(l_tax, 6) AS Saline_rate
       FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN 0.0::DOUBLE ELSE 170.0::DOUBLE END AS height,
               CASE WHEN l_linenumber % 2 = 0 THEN l_tax END AS e, CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END AS t FROM lineitem)""",
)
oracle(
    "unit_convert_amount",
    "",
    """SELECT l_orderkey, l_linenumber, round(l_quantity * 1.4::DOUBLE / 1000, 9) AS nore_ml, round(l_discount * 1.4::DOUBLE / 1000, 9) AS nore_med_ml,
       round(l_extendedprice / 1000, 9) AS nore_mcg, round(l_tax * 1000 * (40 + l_quantity), 9) AS nore_mcgkg FROM lineitem""",
)
oracle(
    "unit_convert_rate",
    "",
    """SELECT l_orderkey, l_linenumber, round(l_discount * 60 * 1.4::DOUBLE * 1000, 9) AS nore_ml_rate,
       round(l_quantity / (40 + l_quantity), 9) AS nore_mcg_rate, round(l_tax * 1000 / (40 + l_quantity) * 60, 9) AS nore_mg_rate FROM lineitem""",
)
oracle(
    "unit_convert_insulin",
    "",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / 100, 9) AS from_ml, round(l_extendedprice * 0.0256::DOUBLE, 9) AS from_mcg FROM lineitem""",
)
oracle(
    "unit_convert_misc",
    "",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice / 530, 9) AS unit_mg,
       round(l_extendedprice / 530 * (40 + l_quantity), 8) AS unitkg_mg,
       round(l_extendedprice / 530 * 1000 / (40 + l_quantity) * 60, 5) AS unithr_rate FROM lineitem""",
)
oracle(
    "drug_totals",
    "",
    """SELECT l_orderkey, l_linenumber,
       round(q * 1.4::DOUBLE / 1000 + d * 1.4::DOUBLE / 1000 + p / 1000 + t * 1000 * w + d, 7) AS norepinephrine_mg,
       round(d * 60 * 1.4::DOUBLE * 1000 + q / w + t * 1000 / w * 60 + t, 7) AS norepinephrine_rate,
       round(q * 1.3::DOUBLE / 1000 + d, 7) AS epinephrine_mg, round(q / w + d, 7) AS epinephrine_rate,
       round(q * 1.26::DOUBLE / 1000, 7) AS dopamine_mg, round(d * 60 * 1.26::DOUBLE * 1000 + t, 7) AS dopamine_rate,
       round(q * 12.5::DOUBLE, 7) AS dobutamine_mg, round(t * 60 * 12.5::DOUBLE, 7) AS dobutamine_rate,
       round(p / 1000, 7) AS phenylephrine_mg, 0.0::DOUBLE AS phenylephrine_rate,
       round(q * 1.6::DOUBLE / 1000 + d, 7) AS vasopressin_mg, 0.0::DOUBLE AS vasopressin_rate,
       round(q * 1.2::DOUBLE / 1000 + d + t, 7) AS labetalol_mg, round(q * 1.344::DOUBLE / 1000, 7) AS milrinone_mg, 1 AS vasoactive
       FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice AS p, l_discount AS d, l_tax AS t, 40 + l_quantity AS w FROM lineitem)""",
)
oracle(
    "group_sums",
    "",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / 100 + l_extendedprice * 0.0256::DOUBLE, 7) AS insulin,
       round(l_quantity + CASE WHEN l_linenumber = 2 THEN 0 ELSE l_tax END, 7) AS nutrition,
       round(l_quantity + l_discount + CASE WHEN l_linenumber = 1 THEN 0 ELSE l_tax END, 7) AS saline,
       round(l_quantity + l_tax, 7) AS dextrose, round(l_quantity / 100, 7) AS heparin, round(l_discount, 7) AS water,
       round(l_tax, 7) AS esmolol FROM lineitem""",
)
cte(
    "cryst_iv",
    "intakeOutput stays",
    f"""SELECT i.patientunitstayid, celllabel, cellvaluenumeric AS value, {hour('intakeoutputoffset')} AS start_hour,
       least({hour('intakeoutputoffset')} + 1, los) AS stop_hour FROM intakeOutput i JOIN stays s USING (patientunitstayid)
       WHERE cellpath ILIKE '%intake%' AND celllabel = 'c2' AND intakeoutputoffset >= 0 AND {hour('intakeoutputoffset')} < los""",
)
cte("cryst_on", "cryst_iv", expand("cryst_iv", "celllabel", {"dose": "value"}))
oracle(
    "fluids_total",
    "grid intake_on cryst_on",
    """SELECT g.patientunitstayid, g.hour, round(coalesce(a.dose, 0) + coalesce(b.dose, 0) * 100 + coalesce(c.dose, 0), 6) AS fluids FROM grid g
       LEFT JOIN intake_on a ON a.patientunitstayid = g.patientunitstayid AND a.hour = g.hour AND a.celllabel = 'c0'
       LEFT JOIN intake_on b ON b.patientunitstayid = g.patientunitstayid AND b.hour = g.hour AND b.celllabel = 'c1'
       LEFT JOIN cryst_on c ON c.patientunitstayid = g.patientunitstayid AND c.hour = g.hour""",
)
oracle(
    "positive_flag",
    "",
    """SELECT l_orderkey, l_linenumber, CAST(l_discount - 0.05::DOUBLE > 0 AS INTEGER) AS given,
       CAST(l_linenumber <> 3 AND l_discount + l_tax > 0 AS INTEGER) AS beta_blocker FROM lineitem""",
)
oracle(
    "default_impute",
    "chart_ff lab_ff",
    """SELECT patientunitstayid, hour, round(coalesce(a, 125), 6) AS ABPs, CAST(a IS NULL AS INTEGER) AS ABPs_fillna,
       round(coalesce(Creatinine, 0.7), 6) AS Creatinine, CAST(Creatinine IS NULL AS INTEGER) AS Creatinine_fillna,
       21.0::DOUBLE AS fio2, 1 AS fio2_fillna, 7.0::DOUBLE AS pH, 36.5::DOUBLE AS Temperature
       FROM (SELECT *, CASE WHEN ABPs > 100 THEN NULL ELSE ABPs END AS a FROM chart_ff JOIN lab_ff USING (patientunitstayid, hour))""",
)
_SEEN = {"ABPs": "ABPs", "ABPd": "ABPd", "Creatinine": "Creatinine", "Lactate": "Lactate"}
oracle(
    "default_impute_all",
    "chart_ff lab_ff",
    "SELECT patientunitstayid, hour, "
    + ", ".join(
        f'round(coalesce({_SEEN[c]}, {v}), 6) AS "{c}", CAST({_SEEN[c]} IS NULL AS INTEGER) AS "{c}_fillna"'
        if c in _SEEN
        else f'CAST({v} AS DOUBLE) AS "{c}", 1 AS "{c}_fillna"'
        for c, v in DEFAULTS.items()
    )
    + " FROM chart_ff JOIN lab_ff USING (patientunitstayid, hour)",
)
oracle(
    "derived_impute",
    "chart_ff stays",
    """SELECT c.patientunitstayid, c.hour, CAST(admissionheight = 0 AS INTEGER) AS height_fillna,
       round((2 * coalesce(ABPd, 75) + coalesce(ABPs, 125)) / 3, 6) AS MAP, 1 AS MAP_fillna,
       round(3.5::DOUBLE * 0.007184::DOUBLE * (pow(admissionweight, 0.425::DOUBLE) * pow(admissionheight, 0.725::DOUBLE)), 6) AS cardiac_output,
       1 AS cardiac_output_fillna, round(75 / (21 / 100.0::DOUBLE), 6) AS pf_ratio
       FROM chart_ff c JOIN stays s ON s.patientunitstayid = c.patientunitstayid""",
)
GROUP_TESTS = {
    "suspected_infection": "icd10 LIKE 'I44%' OR icd9 LIKE '38%' OR icd9 LIKE '4%'",
    "Acute_Myocardial_Infarction": "icd10[:3] IN ('I21', 'I22')",
    "End-Stage_Cardiomyopathy": "icd10[:3] = 'I42'",
    "Adv__Valvular_HD": "icd10[:3] IN ('I34', 'I35', 'I36', 'I37', 'I38', 'I39')",
    "Myocarditis": "icd10 LIKE 'I40%' OR icd10 LIKE 'I514%'",
    "Arrhythmia": "icd10[:3] IN ('I47', 'I48', 'I49')",
    "spinal_cord_injury": "icd10[:3] IN ('G50', '805', '806')",
    "Pulmonary_Embolism": "icd10[:3] = 'I26'",
    "Tension_Pneumothorax": "icd10[:3] = 'J93'",
    "hypovolemia_external": "icd10[:1] IN ('S', 'T')",
    "hypovolemia_internal": "regexp_matches(icd10, '^I6[0-9]')",
}
oracle("dx_code_split", "dx", "SELECT patientunitstayid, icd9, icd10 FROM dx")
oracle(
    "dx_prefix_match",
    "dx",
    " UNION ALL ".join(
        f"SELECT DISTINCT patientunitstayid, '{name}' AS grp FROM dx WHERE {test}" for name, test in GROUP_TESTS.items()
    ),
)
oracle(
    "dx_long_list",
    "dx",
    """SELECT DISTINCT patientunitstayid, 'suspected_infection' AS grp FROM dx
       WHERE regexp_matches(icd10, '^[A-L][0-9][0-9]') OR regexp_matches(icd9, '^[1-3][0-9][0-9]')""",
)
oracle(
    "dx_flags",
    "dx",
    "SELECT o_orderkey AS patientunitstayid, "
    + ", ".join(
        f"CAST(o_orderkey IN (SELECT patientunitstayid FROM dx WHERE {test}) AS INTEGER) AS {name.replace('-', '_')}"
        for name, test in GROUP_TESTS.items()
    )
    + " FROM orders",
)
oracle(
    "treatment_flag",
    "stays treatment_once",
    """SELECT patientunitstayid, CAST(patientunitstayid IN (SELECT patientunitstayid FROM treatment_once
       WHERE treatmentstring = 't1') AS INTEGER) AS blood_culture FROM stays""",
)
oracle(
    "score_gcs",
    "",
    """SELECT l_orderkey, l_linenumber, CAST(3 + l_quantity % 6 + l_linenumber % 4 + l_partkey % 5 AS DOUBLE) AS GCS_score FROM lineitem""",
)
SOFA = """SELECT *, Sofa_Respiration + Sofa_Coagulation + Sofa_Liver + Sofa_Cardiovascular + Sofa_GCS + Sofa_Urine AS SoFa_score FROM (
  SELECT *, CASE WHEN pf > 300 AND pf < 400 THEN 1 WHEN pf > 200 AND pf <= 300 THEN 2 WHEN vent > 0 AND pf > 100 AND pf <= 200 THEN 3
                 WHEN vent > 0 AND pf <= 100 THEN 4 ELSE 0 END AS Sofa_Respiration,
    CASE WHEN plt <= 20 THEN 4 WHEN plt <= 50 THEN 3 WHEN plt <= 100 THEN 2 WHEN plt <= 150 THEN 1 ELSE 0 END AS Sofa_Coagulation,
    CASE WHEN bili BETWEEN 1.2 AND 1.9 THEN 1 WHEN bili BETWEEN 2 AND 5.9 THEN 2 WHEN bili BETWEEN 6 AND 11.9 THEN 3
         WHEN bili >= 12 THEN 4 ELSE 0 END AS Sofa_Liver,
    CASE WHEN dopa > 15 OR epi > 0.1 OR nore > 0.1 THEN 4 WHEN dopa > 5 AND epi <= 0.1 THEN 3 WHEN dopa <= 5 OR dopa_mg > 0 THEN 2
         WHEN map < 70 THEN 1 ELSE 0 END AS Sofa_Cardiovascular,
    CASE WHEN gcs BETWEEN 13 AND 14 THEN 1 WHEN gcs BETWEEN 10 AND 12 THEN 2 WHEN gcs BETWEEN 6 AND 9 THEN 3 WHEN gcs < 6 THEN 4 ELSE 0 END AS Sofa_GCS,
    CASE WHEN crea < 1.2 THEN 0 WHEN crea BETWEEN 1.2 AND 1.9 THEN 1 WHEN crea BETWEEN 2.0 AND 3.4 THEN 2
         WHEN crea BETWEEN 3.5 AND 4.9 OR urine BETWEEN 200 AND 500 THEN 3 WHEN crea > 5 OR urine < 200 THEN 4 ELSE 0 END AS Sofa_Urine
  FROM {source})"""
cte(
    "sofa_in",
    "",
    """SELECT l_orderkey, l_linenumber, l_quantity * 10 AS pf, l_linenumber % 2 AS vent, l_extendedprice % 200 AS plt, l_extendedprice % 14 AS bili,
       50 + l_quantity AS map, CASE WHEN l_suppkey % 3 = 0 THEN l_quantity / 2 ELSE 0 END AS dopa, CASE WHEN l_suppkey % 3 = 0 THEN l_tax ELSE 0 END AS dopa_mg,
       CASE WHEN l_suppkey % 5 = 0 THEN l_tax * 2 ELSE 0 END AS epi, CASE WHEN l_suppkey % 7 = 0 THEN l_tax * 2 ELSE 0 END AS nore,
       3 + (l_partkey % 25) / 2 AS gcs, l_extendedprice % 6 AS crea, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_extendedprice % 700 END AS urine
       FROM lineitem""",
)
cte("sofa", "sofa_in", SOFA.format(source="sofa_in"))
oracle(
    "score_sofa",
    "sofa",
    """SELECT l_orderkey, l_linenumber, Sofa_Respiration, Sofa_Coagulation, Sofa_Liver, Sofa_Cardiovascular, Sofa_GCS, Sofa_Urine, SoFa_score
       FROM sofa""",
)
oracle(
    "label_state",
    "state",
    "SELECT patientunitstayid, hour, round(map, 6) AS MAP, round(lactate, 6) AS Lactate, Annotation FROM state",
)
oracle("label_next12h", "outlook", "SELECT patientunitstayid, hour, Annotation, Shock_next_12h FROM outlook")
oracle(
    "state_outlook",
    "outlook",
    """SELECT patientunitstayid, hour, round(map, 6) AS MAP, round(lactate, 6) AS Lactate, vaso AS vasoactive, Annotation, Shock_next_12h
       FROM outlook""",
)
oracle(
    "label_crosstab",
    "outlook",
    "SELECT Annotation, Shock_next_12h, count(*) AS rows FROM outlook GROUP BY Annotation, Shock_next_12h",
)

# ---- the final table -----------------------------------------------------

cte(
    "f_chart",
    "chart_all vitals_long stays",
    f"""SELECT c.patientunitstayid, event_min, {mapped('l', 'chart')} AS label, v AS value FROM (
         SELECT patientunitstayid, event_min, nursingchartcelltypevallabel AS l, {num('nursingchartvalue')} AS v
         FROM (SELECT DISTINCT * FROM chart_all)
         UNION ALL SELECT patientunitstayid, event_min, nursingchartcelltypevallabel, nursingchartvalue FROM vitals_long) c
       JOIN stays s ON s.patientunitstayid = c.patientunitstayid WHERE v IS NOT NULL AND {mapped('l', 'chart')} IS NOT NULL""",
)
cte(
    "f_lab_all",
    "lab_all stays",
    f"""SELECT l.patientunitstayid, event_min, labname AS label, v AS value
       FROM (SELECT *, {num('labresult')} AS v FROM lab_all) l JOIN stays s ON s.patientunitstayid = l.patientunitstayid WHERE v IS NOT NULL""",
)
cte(
    "f_lab",
    "f_lab_all",
    """SELECT l.* FROM f_lab_all l JOIN (SELECT label, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi
       FROM f_lab_all GROUP BY label) b ON b.label = l.label WHERE value BETWEEN lo AND hi""",
)
cte("f_chart_pts", "f_chart stays", points("f_chart"))
cte("f_lab_pts", "f_lab stays", points("f_lab"))
cte(
    "f_stays",
    "stays f_chart_pts f_lab_pts treatment_once dx",
    f"""SELECT * REPLACE ({CODES}), CAST(patientunitstayid IN (SELECT patientunitstayid FROM treatment_once WHERE treatmentstring = 't5') AS INTEGER) AS cultured,
       CAST(patientunitstayid IN (SELECT patientunitstayid FROM dx WHERE {GROUP_TESTS['suspected_infection']}) AS INTEGER) AS suspected_infection,
       CAST(patientunitstayid IN (SELECT patientunitstayid FROM dx WHERE {GROUP_TESTS['Acute_Myocardial_Infarction']}) AS INTEGER) AS infarction
       FROM stays WHERE los >= 24 AND patientunitstayid IN (
         SELECT patientunitstayid FROM f_chart_pts WHERE label = 'ABPs' INTERSECT SELECT patientunitstayid FROM f_chart_pts WHERE label = 'ABPd'
         INTERSECT SELECT patientunitstayid FROM f_lab_pts WHERE label = 'Lactate')""",
)
cte("f_grid", "f_stays", "SELECT patientunitstayid, unnest(range(los)) AS hour FROM f_stays WHERE admissionweight <> 0")
_CHART = {
    "ABPs": "abps", "ABPd": "abpd", "FIO2 (%)": "cfio2", "Temperature": "temp", "HR": "hr", "Cardiac Output": "co", "NIBPs": "nibps",
}
_LAB = {"Lactate": "lact", "Creatinine": "crea", "FIO2 (%)": "lfio2", "PaO2": "pao2"}
cte("f_chart_cells", "f_chart_pts", pivot("f_chart_pts", "label", "value", _CHART))
cte("f_lab_cells", "f_lab_pts", pivot("f_lab_pts", "label", "value", _LAB))
cte(
    "f_ff",
    "f_grid f_chart_cells f_lab_cells",
    "SELECT g.patientunitstayid, g.hour, "
    + ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in [*_CHART.values(), *_LAB.values()])
    + """ FROM f_grid g LEFT JOIN f_chart_cells c ON c.patientunitstayid = g.patientunitstayid AND c.hour = g.hour
       LEFT JOIN f_lab_cells l ON l.patientunitstayid = g.patientunitstayid AND l.hour = g.hour
       WINDOW w AS (PARTITION BY g.patientunitstayid ORDER BY g.hour)""",
)
cte(
    "f_doses",
    "intake_on drug_on cryst_on",
    """SELECT patientunitstayid, hour, max(x) FILTER (n = 'c0') AS c0, max(x) FILTER (n = 'c1') AS c1, max(x) FILTER (n = 'c2') AS c2,
       max(x) FILTER (n = 'c3') AS c3, max(x) FILTER (n = 'Norepinephrine (mcg/min)') AS nore, max(r) FILTER (n = 'Norepinephrine (mcg/min)') AS nore_rate,
       max(x) FILTER (n = 'Dopamine (ml/hr)') AS dopa, max(r) FILTER (n = 'Dopamine (ml/hr)') AS dopa_rate, max(x) FILTER (n = 'Saline') AS saline,
       max(x) FILTER (n = 'cryst') AS cryst FROM (
         SELECT patientunitstayid, hour, celllabel AS n, dose AS x, 0 AS r FROM intake_on
         UNION ALL SELECT patientunitstayid, hour, drugname, amount, rate FROM drug_on
         UNION ALL SELECT patientunitstayid, hour, 'cryst', dose, 0 FROM cryst_on) GROUP BY patientunitstayid, hour""",
)
cte(
    "f_marks",
    "treated intakeOutput output_pts",
    f"""SELECT patientunitstayid, hour, max(culture) AS culture, max(dialysis) AS dialysis, max(abx) AS abx, avg(urine) AS urine FROM (
         SELECT patientunitstayid, hour, CAST(treatmentstring = 't1' AS INTEGER) AS culture, CAST(treatmentstring IN ('t2', 't3') AS INTEGER) AS dialysis,
           0 AS abx, NULL AS urine FROM treated
         UNION ALL SELECT patientunitstayid, {hour('intakeoutputoffset')}, 0, 0, 1, NULL FROM intakeOutput
           WHERE cellpath ILIKE '%intake%' AND celllabel = 'c1'
         UNION ALL SELECT patientunitstayid, hour, 0, 0, 0, value FROM output_pts WHERE celllabel IN ('c0', 'c1'))
       GROUP BY patientunitstayid, hour""",
)
cte(
    "f_in",
    "f_ff f_doses f_marks f_stays vent_iv",
    """SELECT f.patientunitstayid, f.hour, s.* EXCLUDE (patientunitstayid), (2 * coalesce(abpd, 75) + coalesce(abps, 125)) / 3 AS map,
       coalesce(lact, 1.1) AS lactate, coalesce(crea, 0.7) AS crea, coalesce(lfio2, cfio2, 21) AS fio2,
       coalesce(CASE WHEN temp <= 50 THEN temp END, 36.5) AS temp, coalesce(hr, 70) AS hr,
       coalesce(co, 3.5::DOUBLE * 0.007184::DOUBLE * (pow(admissionweight, 0.425::DOUBLE) * pow(admissionheight, 0.725::DOUBLE))) AS co,
       coalesce(pao2, 75) / (coalesce(lfio2, cfio2, 21) / 100) AS pf,
       coalesce(d.c0, 0) * 1.4::DOUBLE / 1000 + coalesce(d.nore, 0) / 1000 AS nore_mg, coalesce(d.nore_rate, 0) / admissionweight AS nore,
       coalesce(d.dopa, 0) * 1.26::DOUBLE / 1000 AS dopa_mg, coalesce(d.dopa_rate, 0) * 60 * 1.26::DOUBLE * 1000 AS dopa, 0 AS epi,
       coalesce(d.saline, 0) + coalesce(d.c2, 0) + coalesce(d.c1, 0) + coalesce(d.cryst, 0) AS fluids,
       CAST(coalesce(d.c3, 0) > 0 OR coalesce(m.abx, 0) > 0 AS INTEGER) AS antibiotics, coalesce(m.urine, 0) AS urine,
       CAST(s.cultured > 0 OR coalesce(m.culture, 0) > 0 AS INTEGER) AS culture, CAST(coalesce(m.dialysis, 0) AS DOUBLE) AS dialysis,
       CAST(v.patientunitstayid IS NOT NULL AS INTEGER) AS vent, 300 AS plt, 2 AS bili, 15 AS gcs
       FROM f_ff f JOIN f_stays s ON s.patientunitstayid = f.patientunitstayid
       LEFT JOIN f_doses d ON d.patientunitstayid = f.patientunitstayid AND d.hour = f.hour
       LEFT JOIN f_marks m ON m.patientunitstayid = f.patientunitstayid AND m.hour = f.hour
       LEFT JOIN vent_iv v ON v.patientunitstayid = f.patientunitstayid AND f.hour >= v.start_hour AND f.hour < v.stop_hour""",
)
cte("f_vaso", "f_in", "SELECT *, CAST(nore_mg + dopa_mg > 0 AS INTEGER) AS vaso FROM f_in")
cte("f_sofa", "f_vaso", SOFA.format(source="f_vaso"))
cte("f_state", "f_sofa", STATE.format(source="f_sofa"))
cte("f_next", "f_state", NEXT.format(source="f_state"))
oracle(
    "final_table",
    "f_next",
    """SELECT patientunitstayid, hour, uniquepid, Age, gender, ethnicity, admissionweight AS weight, suspected_infection, infarction,
       culture AS blood_culture, dialysis, round(urine, 6) AS urine, round(map, 6) AS MAP, 1 AS MAP_fillna, round(lactate, 6) AS Lactate,
       round(crea, 6) AS Creatinine, round(fio2, 6) AS fio2, round(temp, 6) AS Temperature, round(hr, 6) AS HR, round(co, 6) AS cardiac_output,
       round(nore_mg, 9) AS norepinephrine_mg, round(nore, 6) AS norepinephrine_rate, round(dopa_mg, 9) AS dopamine_mg, round(dopa, 6) AS dopamine_rate,
       round(fluids, 6) AS fluids, antibiotics AS Antibiotics, vaso AS vasoactive, vent AS ventilated, Sofa_Respiration, Sofa_Cardiovascular,
       Sofa_Urine, SoFa_score, Annotation, Shock_next_12h FROM f_next""",
)

# Every column of it, once with the corrected and once with the published rules.
cte(
    "f_culture",
    "micro_pts",
    """SELECT patientunitstayid, hour, 1 AS marked FROM micro_pts WHERE labname IN ('s1', 'a1') GROUP BY patientunitstayid, hour""",
)
cte(
    "f_groups",
    "f_stays dx",
    "SELECT patientunitstayid, "
    + ", ".join(
        f'CAST(patientunitstayid IN (SELECT patientunitstayid FROM dx WHERE {test}) AS INTEGER) AS "{name}"'
        for name, test in GROUP_TESTS.items()
    )
    + " FROM f_stays",
)
_STRICT = SOFA.replace("WHEN dopa <= 5 OR dopa_mg > 0", "WHEN (dopa > 0 AND dopa <= 5) OR dopa_mg > 0")
_FILLED = {
    "NIBPs": ("nibps", "nibps"), "HR": ("hr", "raw_hr"), "Temperature": ("temp", "raw_temp"), "ABPs": ("abps", "abps"),
    "ABPd": ("abpd", "abpd"), "Lactate": ("lact", "lact"), "Creatinine": ("crea", "raw_crea"), "PaO2": ("pao2", "pao2"),
    "FIO2 (%)": ("fio2", "raw_fio2"),
}
_NO_DRUG = ["Epinephrine (MG)", "Epinephrine (MCG/KG/MIN)_Rate", "Dobutamine (MG)", "Dobutamine (MCG/KG/MIN)_Rate", "Phenylephrine (MG)",
            "Phenylephrine (MCG/KG/MIN)_Rate", "Vasopressin (MG)", "Vasopressin (MCG/KG/MIN)_Rate", "Milrinone (MG)"]
for _query, _mode, _rates, _sofa in (
    ("pipeline_final", "c", "nore, dopa * admissionweight_share AS dopa", _STRICT),
    ("pipeline_published", "p", "0.0::DOUBLE AS nore, 0.0::DOUBLE AS dopa", SOFA),
):
    cte(
        f"f_in_{_mode}",
        "f_in f_ff f_groups f_culture",
        f"""SELECT i.* EXCLUDE (nore, dopa, admissionweight_share, suspected_infection), {_rates}, g.* EXCLUDE (patientunitstayid),
           f.abps, f.abpd, f.nibps, f.lact, f.pao2, f.hr AS raw_hr, f.crea AS raw_crea, coalesce(f.lfio2, f.cfio2) AS raw_fio2,
           CASE WHEN f.temp <= 50 THEN f.temp END AS raw_temp, f.co AS raw_co, coalesce(u.marked, 0) AS micro
           FROM (SELECT *, 1 / (60.0::DOUBLE * 60 * admissionweight) AS admissionweight_share FROM f_in) i
           JOIN f_ff f ON f.patientunitstayid = i.patientunitstayid AND f.hour = i.hour
           JOIN f_groups g ON g.patientunitstayid = i.patientunitstayid
           LEFT JOIN f_culture u ON u.patientunitstayid = i.patientunitstayid AND u.hour = i.hour""",
    )
    cte(f"f_vaso_{_mode}", f"f_in_{_mode}", f"SELECT *, CAST(nore_mg + dopa_mg > 0 AS INTEGER) AS vaso FROM f_in_{_mode}")
    cte(f"f_sofa_{_mode}", f"f_vaso_{_mode}", _sofa.format(source=f"f_vaso_{_mode}"))
    cte(f"f_state_{_mode}", f"f_sofa_{_mode}", STATE.format(source=f"f_sofa_{_mode}"))
    cte(f"f_next_{_mode}", f"f_state_{_mode}", NEXT.format(source=f"f_state_{_mode}"))
    _groups = {g: g for g in GROUP_TESTS}
    if _mode == "p":
        _groups["Myocarditis"] = _groups.pop("Arrhythmia")
    oracle(
        _query,
        f"f_next_{_mode}",
        "SELECT patientunitstayid, hour AS Time_since_ICU_admission, uniquepid, Age, gender, ethnicity, admissionheight AS height, "
        "CAST(admissionheight = 0 AS INTEGER) AS height_fillna, admissionweight AS weight, "
        + ", ".join(f'"{source}" AS "{name}"' for name, source in _groups.items())
        + ", culture AS \"Blood culture\", CAST(micro AS DOUBLE) AS \"Culture\", dialysis AS \"Dialysis\", round(urine, 6) AS \"Urine output\", "
        + ", ".join(
            f'round(coalesce({_FILLED[c][0]}, {v}), 6) AS "{c}", CAST({_FILLED[c][1]} IS NULL AS INTEGER) AS "{c}_fillna"'
            if c in _FILLED
            else f'CAST({v} AS DOUBLE) AS "{c}", 1 AS "{c}_fillna"'
            for c, v in DEFAULTS.items()
        )
        + ", CAST(vent AS DOUBLE) AS \"Ventilator\", "
        + ", ".join(f'0.0::DOUBLE AS "{c}"' for c in _NO_DRUG)
        + """, round(nore_mg, 9) AS "Norepinephrine (MG)", round(nore, 6) AS "Norepinephrine (MCG/KG/MIN)_Rate",
           round(dopa_mg, 9) AS "Dopamine (MG)", round(dopa, 6) AS "Dopamine (MCG/KG/MIN)_Rate", antibiotics AS "Antibiotics",
           round(map, 6) AS "MAP", 1 AS "MAP_fillna", round(co, 6) AS "Cardiac Output", CAST(raw_co IS NULL AS INTEGER) AS "Cardiac Output_fillna",
           round(pf, 6) AS "PaO2/FiO2", vaso AS "vasoactive/inotropic", round(fluids, 6) AS "Fluids(ml)", 15.0::DOUBLE AS "GCS_score",
           Sofa_Respiration, Sofa_Coagulation, Sofa_Liver, Sofa_Cardiovascular, Sofa_GCS, Sofa_Urine, SoFa_score, Annotation, Shock_next_12h """
        + f"FROM f_next_{_mode}",
    )

# ---- runs, counters, long forms ------------------------------------------

oracle(
    "stages_resumed",
    "stays",
    "SELECT patientunitstayid, los, 'reused' AS cohort, 'plan' AS stays FROM stays WHERE los >= 700",
)
oracle(
    "read_counters",
    "lab_all",
    """SELECT 'lab' AS "table", unnest(['read', 'rows', 'bad labid', 'bad patientunitstayid', 'bad labresultoffset', 'far labresultoffset'])
       AS counter, unnest([count(*), count(*), 0, 0, count(*) FILTER (labid % 7 = 0), 0]) AS value FROM lab_all WHERE NOT custom""",
)
_EVER = "CAST(max(coalesce(CAST({test} AS INTEGER), 0)) AS INTEGER) AS {name}"
oracle(
    "dx_prefix_table",
    "dx",
    "SELECT patientunitstayid, "
    + ", ".join(
        _EVER.format(
            test=test
            if name != "suspected_infection"
            else "(icd10[:4] IN (SELECT icd10[:4] FROM dx WHERE icd10 LIKE 'I%' AND length(icd10) > 3 AND ascii(icd10[4:4]) % 2 = 0))",
            name=name.replace("-", "_"),
        )
        for name, test in GROUP_TESTS.items()
    )
    + " FROM dx GROUP BY patientunitstayid",
)


def held(points: str, family: str) -> str:
    return f"""SELECT patientunitstayid, '{family}' AS family, label, hour, los, avg(value) AS value,
       coalesce(lead(hour) OVER (PARTITION BY patientunitstayid, label ORDER BY hour), los) AS until
       FROM {points} GROUP BY patientunitstayid, label, hour, los"""


cte(
    "infusion_cells",
    "infusion_iv stays",
    """SELECT i.patientunitstayid, drugname AS label, start_hour AS hour, avg(stop_hour) AS stop, los,
       avg(coalesce(amount, 0)) AS amount, avg(coalesce(infusionrate, 0)) AS rate
       FROM infusion_iv i JOIN stays s USING (patientunitstayid) WHERE start_hour > 0 GROUP BY ALL""",
)
cte(
    "infusion_runs",
    "infusion_cells",
    """SELECT *, CAST(least(ceil(stop), lead(hour, 1, los) OVER (PARTITION BY patientunitstayid, label ORDER BY hour), los) AS BIGINT) AS until
       FROM infusion_cells""",
)
oracle(
    "tabular_long",
    "chart_pts lab_pts infusion_runs",
    f"""SELECT patientunitstayid, family, label, hour, until, round(value, 6) AS value FROM (
       {held('chart_pts', 'chart')} UNION ALL {held('lab_pts', 'lab')}) WHERE until > hour
       UNION ALL SELECT patientunitstayid, unnest(['ing', 'rate']), label, hour, until, round(unnest([amount, rate]), 6)
       FROM infusion_runs WHERE until > hour""",
)
cte(
    "infusion_totals",
    "infusion_runs stays",
    """SELECT patientunitstayid, unnest(range(hour, until)) AS hour, total, value FROM (
       SELECT r.patientunitstayid, hour, until,
         unnest(CASE r.label WHEN 'Saline' THEN ['Nacl n% (sum)']
                WHEN 'Dopamine (ml/hr)' THEN ['Dopamine (MG)', 'Dopamine (MCG/KG/MIN)_Rate']
                ELSE ['Norepinephrine (MG)', 'Norepinephrine (MCG/KG/MIN)_Rate'] END) AS total,
         unnest(CASE r.label WHEN 'Saline' THEN [amount]
                WHEN 'Dopamine (ml/hr)' THEN [amount * 1.26::DOUBLE / 1000, rate * 60 * 1.26::DOUBLE * 1000]
                ELSE [amount / 1000, rate / nullif(admissionweight, 0)] END) AS value
       FROM infusion_runs r JOIN stays s USING (patientunitstayid)) WHERE value IS NOT NULL AND until > hour""",
)
oracle(
    "totals_long",
    "infusion_totals",
    """SELECT patientunitstayid, hour, total, round(sum(value), 5) AS value FROM infusion_totals
       GROUP BY patientunitstayid, hour, total""",
)
