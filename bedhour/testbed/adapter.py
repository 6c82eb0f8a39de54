"""Raw intensive-care tables derived from the ``events``, ``lineitem`` and
``part`` test tables. One user is one stay; time starts 20 or 40 minutes after
the user's first event, so some events fall before admission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import STAY
from ..operators.joins import balanced_join
from ..sources import write_stage


# Fixed schemas, so that no job runs to find them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: admission and last event, in microseconds."""
    micros = F.expr("unix_micros(cast(ts as timestamp))")
    delay = F.when(F.col("user_id") % 2 == 0, 20).otherwise(40)
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.min(micros).alias("first_us"), F.max(micros).alias("last_us"))
        .select("user_id", (F.col("first_us") + delay.cast("bigint") * 60_000_000).alias("admit_us"), "last_us")
    )


def _minutes(to_us: str) -> F.Column:
    return F.floor((F.expr(to_us) - F.col("admit_us")) / F.lit(6e7)).cast("bigint")


def patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admissions(spark, sf_dir).select(
        F.expr("concat('p', user_id - user_id % 2)").alias("uniquepid"),
        F.col("user_id").alias(STAY),
        F.expr("user_id div 3").alias("patienthealthsystemstayid"),
        F.expr(
            "case when user_id % 10 = 0 then '> 89' when user_id % 10 = 1 then '' "
            "else cast(15 + user_id % 70 as string) end"
        ).alias("age"),
        F.expr("case when user_id % 2 = 0 then 'Female' else 'Male' end").alias("gender"),
        F.expr("concat('e', user_id % 5)").alias("ethnicity"),
        F.expr("cast(2014 + user_id % 2 as int)").alias("hospitaldischargeyear"),
        F.when(F.col("user_id") % 13 != 12, _minutes("last_us")).alias("unitdischargeoffset"),
        F.expr(
            "case when user_id % 7 = 0 then 'Expired' when user_id % 7 = 1 then null else 'Alive' end"
        ).alias("unitdischargestatus"),
        F.expr("cast(case when user_id % 11 = 0 then 0 else 150 + user_id % 40 end as double)").alias(
            "admissionheight"
        ),
        F.expr("cast(case when user_id % 17 = 0 then 0 else 50 + user_id % 60 end as double)").alias(
            "admissionweight"
        ),
        F.expr("cast(case when user_id % 3 = 0 then null else 48 + user_id % 60 end as double)").alias(
            "dischargeweight"
        ),
    )


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their stay, minute since admission and the number in props."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.expr("unix_micros(cast(ts as timestamp))").alias("us"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    joined = balanced_join(events, admissions(spark, sf_dir).select("user_id", "admit_us"), "user_id")
    return joined.select(
        "event_id", F.col("user_id").alias(STAY), "event_type", "value", "k", _minutes("us").alias("off")
    )


def diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code pairs from the part of each order line; the order is the stay."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(STAY), F.col("l_linenumber").cast("bigint").alias("diagnosisoffset"),
        F.col("l_partkey").alias("p_partkey"),
    )
    number = "cast(substring(p_brand, 7) as int)"
    codes = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr(
            f"""case when p_size % 17 = 0 then null
                     when p_size % 5 = 0 then concat(30 + {number}, '.', p_size)
                     else concat(30 + {number}, '.', p_size, ', ',
                       case when p_size % 7 = 0 then concat('S', {number}, '.0')
                            when p_size % 11 = 0 then 'J93.1'
                            when p_size % 13 = 0 then 'G50.8'
                            when p_size % 19 = 0 then 'I51.4'
                            else concat('I', 20 + {number} + (p_size % 3) * 25, '.', p_size % 10) end)
                end"""
        ).alias("icd9code"),
    )
    return balanced_join(lines, codes, "p_partkey").drop("p_partkey")


_RAW = {
    "infusionDrug": (
        "event_type = 'error'",
        [
            "event_id as infusiondrugid",
            STAY,
            "off as infusionoffset",
            "case k % 3 when 0 then 'Norepinephrine (mcg/min)' when 1 then 'Dopamine (ml/hr)' "
            "else 'Saline' end as drugname",
            "case when k % 9 = 0 then 'OFF' when k % 11 = 0 then '1d' else cast(k as string) end as drugrate",
            "cast(case when k % 10 = 0 then null when k % 10 = 5 then 0 else 1 + k % 7 end as double) "
            "as infusionrate",
            "case when k % 4 <> 0 then value end as drugamount",
            "value as volumeoffluid",
        ],
    ),
    "intakeOutput": (
        "event_type = 'signup'",
        [
            STAY,
            "off as intakeoutputoffset",
            "case when k % 31 = 0 then null when k % 2 = 0 then 'flowsheet/Intake/x' "
            "else 'flowsheet/Output/x' end as cellpath",
            "concat('c', floor(k / 2) % 4) as celllabel",
            "case when k % 13 <> 0 then value end as cellvaluenumeric",
        ],
    ),
    "treatment": (
        "event_type = 'signup'",
        [
            "event_id as treatmentid",
            STAY,
            "off as treatmentoffset",
            "case when k % 6 = 0 then 'Ventilator' else concat('t', k % 6) end as treatmentstring",
        ],
    ),
    "nurseCharting": (
        "event_type in ('click', 'view')",
        [
            "event_id as nursingchartid",
            STAY,
            "off as nursingchartoffset",
            "case when k % 29 = 0 then null when k % 23 = 0 then 'OFF' when event_type = 'click' then "
            "concat(45 + floor(floor(value * 10) % 1000 / 10), '.', floor(value * 10) % 10) else "
            "concat(30 + floor(floor(value * 10) % 600 / 10), '.', floor(value * 10) % 10) end as nursingchartvalue",
            "case when event_type = 'click' then 'ABPs' else 'ABPd' end as nursingchartcelltypevallabel",
        ],
    ),
    "respiratoryCharting": (
        "event_type = 'error' or (event_type = 'signup' and k % 3 = 0)",
        [
            "event_id as respchartid",
            STAY,
            "off as respchartoffset",
            "off + 1 as respchartentryoffset",
            "'respFlow' as respcharttypecat",
            "case when event_type = 'error' then 'RT Vent On/Off' else 'FiO2' end as respchartvaluelabel",
            "case when event_type = 'signup' then cast(21 + k % 70 as string) when k % 3 = 0 then 'Start' "
            "when k % 3 = 1 then 'Off' else 'Continued' end as respchartvalue",
        ],
    ),
    "vitalPeriodic": (
        "event_type = 'click'",
        [
            "event_id as vitalperiodicid",
            STAY,
            "off as observationoffset",
            "case when k % 3 = 0 then 35.0D + k % 20 end as temperature",
            "cast(null as double) as sao2",
            "60.0D + k as heartrate",
            "cast(null as double) as respiration",
            "cast(null as double) as cvp",
            "cast(null as double) as etco2",
            "case when k % 5 = 0 then 90.0D + k end as systemicsystolic",
            "case when k % 5 = 1 then 50.0D + k end as systemicdiastolic",
        ],
    ),
    "vitalAperiodic": (
        "event_type = 'view'",
        [
            "event_id as vitalaperiodicid",
            STAY,
            "off as observationoffset",
            "80.0D + k as noninvasivesystolic",
            "cast(null as double) as noninvasivediastolic",
            "cast(null as double) as paop",
            "case when k % 8 = 0 then 3.0D + k % 4 end as cardiacoutput",
        ],
    ),
    "microLab": (
        "event_type = 'signup'",
        [
            "event_id as microlabid",
            STAY,
            "off as culturetakenoffset",
            "case when k % 3 <> 0 then concat('s', k % 4) end as culturesite",
            "case when k % 4 <> 0 then concat('a', k % 5) end as antibiotic",
        ],
    ),
}

_LAB_TEXT = (
    "case when k % 17 = 0 then null when k % 19 = 0 then 'OFF' else "
    "concat(floor(floor(value * 10) % 400 / 100), '.', lpad(cast(floor(value * 10) % 100 as string), 2, '0')) end"
)
_LAB_NAME = (
    "case when k % 2 = 0 then 'Lactate' when k % 8 = 1 then 'FIO2 (%)' when k % 8 = 3 then 'PaO2' "
    "else 'Creatinine' end"
)
_RAW["lab"] = (
    "event_type = 'purchase' and k % 7 <> 0",
    [
        "event_id as labid",
        STAY,
        "off as labresultoffset",
        f"{_LAB_TEXT} as labresult",
        f"{_LAB_NAME} as labname",
        "case when k % 5 <> 0 then 'mmol/L' end as labmeasurenamesystem",
    ],
)
_RAW["customLab"] = (
    "event_type = 'purchase' and k % 7 = 0",
    [
        "event_id as customlabid",
        STAY,
        "off as labotheroffset",
        f"{_LAB_TEXT} as labotherresult",
        f"{_LAB_NAME} as labothername",
    ],
)


def raw_table(
    spark: SparkSession, sf_dir: str, name: str, events: DataFrame | None = None
) -> DataFrame:
    if name == "patient":
        return patient(spark, sf_dir)
    if name == "diagnosis":
        return diagnosis(spark, sf_dir)
    condition, columns = _RAW[name]
    events = offsets(spark, sf_dir) if events is None else events
    rows = events.where(condition).selectExpr(*columns)
    if name == "treatment":
        # Some entries twice, as the raw table has them.
        rows = rows.unionByName(rows.where("treatmentid % 5 = 0"))
    return rows


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw tables; the events with their offsets are written once first."""
    events = write_stage(offsets(spark, sf_dir))
    return {name: raw_table(spark, sf_dir, name, events) for name in ["patient", "diagnosis", *_RAW]}


def dictionary(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    rows = [
        F.struct(F.lit(a).alias("itemstring"), F.lit(b).alias("altername"), F.lit(i).cast("bigint").alias("position"))
        for i, (a, b) in enumerate(pairs)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


# Dictionaries of the final table: itemstring, altername.
DICTIONARIES: dict[str, list[tuple[str, str]]] = {
    "med": [
        ("c0", "med_Norepinephrine (ml)"),
        ("c1", "med_Water"),
        ("c2", "med_Dextrose 5%"),
        ("c3", "replaced by the next entry"),
        ("c3", "med_Antibiotics (ml)"),
    ],
    "ing": [
        ("Norepinephrine (mcg/min)", "Norepinephrine (mcg)"),
        ("Dopamine (ml/hr)", "Dopamine (ml)"),
        ("Saline", "NaCl 0.9%"),
    ],
    "proc": [("t1", "Blood culture"), ("t2", "Dialysis"), ("t3", "Dialysis"), ("Ventilator", "Ventilator")],
    "micro": [("s1", "Culture"), ("a1", "Culture")],
    "out": [("c0", "Urine output"), ("c1", "Urine output")],
    "chart": [
        ("ABPs", "ABPs"),
        ("ABPd", "ABPd"),
        ("FiO2", "FIO2 (%)"),
        ("temperature", "Temperature"),
        ("heartrate", "HR"),
        ("systemicsystolic", "ABPs"),
        ("systemicdiastolic", "ABPd"),
        ("noninvasivesystolic", "NIBPs"),
        ("cardiacoutput", "Cardiac Output"),
    ],
    "lab": [("Lactate", "Lactate"), ("Creatinine", "Creatinine"), ("FIO2 (%)", "FIO2 (%)"), ("PaO2", "PaO2")],
}


def dictionaries(spark: SparkSession) -> dict[str, DataFrame]:
    return {family: dictionary(spark, pairs) for family, pairs in DICTIONARIES.items()}
