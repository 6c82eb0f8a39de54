"""One query per operator over the test tables. Each reads whole tables.

Keys match ``oracle.ORACLE``; computed doubles are rounded so that two engines
print the same value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import STAY
from ..constants import DEFAULTS
from ..functions import col, contains_text
from ..operators import (
    align,
    channels,
    clean,
    cohort,
    diagnosis,
    extract,
    factors,
    hours,
    impute,
    joins,
    labels,
    profile,
    scores,
    select,
    tabular,
    units,
)
from ..operators.tabular import Stream
from ..plans.dataset import ADDED_FLUID, Mode, crystalloid_intervals, final_dataset
from ..plans.stages import Outliers, clean_events
from ..plans.run import source_report
from ..sources import Stages, hadoop_path, read_observed, read_table, write_stage
from ..sources import read_dictionary as read_names
from . import adapter as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round(col(c) if isinstance(c, str) else c, digits)


# ---- shared inputs -------------------------------------------------------


def visits(s: SparkSession, d: str) -> DataFrame:
    return cohort.visit_table(A.patient(s, d))


def stays(s: SparkSession, d: str) -> DataFrame:
    return cohort.los_hours(cohort.build_cohort(A.patient(s, d)))


def raw(s: SparkSession, d: str, name: str, events: DataFrame | None = None) -> DataFrame:
    return A.raw_table(s, d, name, events)


def shared(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The stays, and the events with their offsets, written once for queries
    that use several families."""
    return write_stage(stays(s, d)), write_stage(A.offsets(s, d))


def chart_values(s: SparkSession, d: str, events: DataFrame | None = None) -> DataFrame:
    rows = clean.coerce_numeric(raw(s, d, "nurseCharting", events), "nursingchartvalue")
    return rows.select(
        STAY,
        F.col("nursingchartoffset").alias("event_min"),
        F.col("nursingchartcelltypevallabel").alias("label"),
        F.col("nursingchartvalue").alias("value"),
    )


def lab_values(s: SparkSession, d: str, events: DataFrame | None = None) -> DataFrame:
    rows = clean.coerce_numeric(raw(s, d, "lab", events), "labresult")
    return rows.select(
        STAY,
        F.col("labresultoffset").alias("event_min"),
        F.col("labname").alias("label"),
        F.col("labresult").alias("value"),
    )


def intake(s: SparkSession, d: str, st: DataFrame) -> DataFrame:
    return extract.extract_intake(raw(s, d, "intakeOutput"), st)


def infusion(s: SparkSession, d: str, st: DataFrame, events: DataFrame | None = None) -> DataFrame:
    return extract.extract_infusion(raw(s, d, "infusionDrug", events), st)


CHART = ["ABPd", "ABPs"]
LAB = ["Creatinine", "Lactate"]
DRUGS = ["Dopamine (ml/hr)", "Norepinephrine (mcg/min)", "Saline"]


def hold_streams(s: SparkSession, d: str, st: DataFrame, events: DataFrame | None = None) -> dict[str, Stream]:
    return {
        "chart": Stream(align.align_points(chart_values(s, d, events), st), "hold", {"chart": "value"}),
        "lab": Stream(align.align_points(lab_values(s, d, events), st), "hold", {"lab": "value"}),
    }


def infusion_stream(s: SparkSession, d: str, st: DataFrame, events: DataFrame | None = None) -> Stream:
    rows = align.align_infusion(infusion(s, d, st, events), st, drop_hour_zero=True)
    return Stream(rows, "interval", {"ing": "amount", "rate": "infusionrate"}, "drugname")


def state_inputs(s: SparkSession, d: str, halo: tuple[int, int]) -> DataFrame:
    """Hourly mean pressure, lactate and vasoactive flag."""
    st, events = shared(s, d)
    streams = {**hold_streams(s, d, st, events), "ing": infusion_stream(s, d, st, events)}
    wide = tabular.tabularize(
        st, streams, labels={"chart": CHART, "lab": LAB, "ing": DRUGS}, halo=halo
    )
    filled = impute.default_impute(
        channels.merge_channels(wide.drop("los")), {"ABPs": 125, "ABPd": 75, "Lactate": 1.1}
    )
    pressors = ["Norepinephrine (mcg/min)", "Dopamine (ml/hr)"]
    return impute.vasoactive_flag(
        filled.withColumn("MAP", (2 * col("ABPd") + col("ABPs")) / 3), pressors
    ).select(
        STAY, "hour", *(["block", "halo"] if any(halo) else []), "MAP", "Lactate", col("vasoactive/inotropic")
    )


# ---- sources, nulls, profile --------------------------------------------


@query
def src_events(s, d):
    return A.table(s, d, "events").select(
        "event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


@query
def null_policy(s, d):
    rows = raw(s, d, "infusionDrug").select("infusiondrugid", STAY, "drugrate", "infusionrate", "drugamount")
    return cohort.fill_missing(rows.na.drop(subset=["infusionrate"]), keep_null=["infusionrate"])


@query
def numeric_coerce(s, d):
    k = F.get_json_object("props", "$.k").cast("int")
    text = (
        F.when(k % 9 == 0, "OFF").when(k % 11 == 0, "1d").when(k % 13 == 0, "nan").otherwise(k.cast("string"))
    )
    rows = A.table(s, d, "events").select("event_id", text.alias("txt"))
    return clean.coerce_numeric(rows, "txt").select("event_id", F.col("txt").alias("number"))


@query
def dedupe_events(s, d):
    return raw(s, d, "treatment").dropDuplicates()


@query
def sink_roundtrip(s, d):
    rows = raw(s, d, "treatment")
    return write_stage(rows, columns=[STAY, "treatmentid", "treatmentstring"], cluster_by=[STAY])


@query
def read_csv_roundtrip(s, d):
    """A raw table written as CSV and read by the library's own reader."""
    folder = Stages(s)
    rows = raw(s, d, "infusionDrug")
    rows.write.option("header", True).csv(folder.path("infusionDrug.csv"))
    return read_table(s, folder.path("infusionDrug.csv"), "infusionDrug")


@query
def read_counters(s, d):
    """What was counted while raw tables with odd values were read and written."""
    folder = Stages(s)
    rows = raw(s, d, "lab").withColumn("labresultoffset", F.when(F.col("labid") % 7 == 0, F.lit("late")).otherwise(F.col("labresultoffset").cast("string")))
    rows.withColumn("labid", F.when(F.col("labid") % 11 != 0, F.col("labid"))).write.option("header", True).csv(folder.path("lab.csv"))
    table, seen = read_observed(s, folder.path("lab.csv"), "lab")
    folder.write(table, "source-lab", observations=[seen])
    return source_report(s, folder)


@query
def stages_resumed(s, d):
    """A named run done again with another option: the stage follows the option."""
    name = f"resumed-{uuid.uuid4().hex}"
    for hours_least in (24, 700):
        stages = Stages(s, name)
        base = stages.write(stays(s, d).select(STAY, "los"), "cohort")
        kept = stages.write(cohort.min_stay(base, hours_least), "stays")
    files, at = hadoop_path(s, stages.folder)
    files.deleteOnExit(at)
    why = F.create_map(*[F.lit(x) for pair in stages.history.items() for x in pair])
    return kept.select(STAY, "los", why["cohort"].alias("cohort"), why["stays"].alias("stays"))


@query
def read_dictionary(s, d):
    """A label dictionary as CSV, of whose repeated labels the last entry counts."""
    folder = Stages(s)
    rows = A.table(s, d, "part").selectExpr("p_brand as itemstring", "p_name as altername", "p_partkey as position")
    rows.write.option("header", True).csv(folder.path("names.csv"))
    return select.dictionary_map(read_names(s, folder.path("names.csv")))


@query
def profile_counts(s, d):
    return profile.stay_counts(stays(s, d))


@query
def profile_events(s, d):
    st = stays(s, d)
    rows = extract.extract_output(raw(s, d, "intakeOutput"), st).select(STAY, "event_min", "celllabel")
    return profile.event_counts(align.align_points(rows, st), "celllabel")


@query
def label_frequencies(s, d):
    return profile.label_frequencies(raw(s, d, "lab").select("labname"), "labname")


# ---- cohort --------------------------------------------------------------


@query
def cohort_visits(s, d):
    return visits(s, d)


@query
def cohort_invalid(s, d):
    return cohort.invalid_visits(visits(s, d)).select("uniquepid", STAY, "unitdischargeoffset", "Age")


@query
def cohort_mortality(s, d):
    return cohort.mortality_label(visits(s, d)).select(*cohort.COHORT_COLUMNS, "dischargeweight")


@query
def cohort_summary(s, d):
    return cohort.cohort_summary(cohort.build_cohort(A.patient(s, d)))


@query
def cohort_los(s, d):
    return stays(s, d).select("uniquepid", STAY, "los_min", "los", "Age", "label")


@query
def cohort_restrict(s, d):
    st = stays(s, d)
    events = align.align_points(chart_values(s, d), st).drop("los")
    return cohort.restrict_events(events, cohort.min_stay(st, 700)).select(STAY, "hour", "label", r("value").alias("value"))


@query
def cohort_required_items(s, d):
    labelled = chart_values(s, d).unionByName(lab_values(s, d)).where(
        F.when(F.col("label") == "Lactate", F.col("value") > 3.5)
        .when(F.col("label") == "ABPs", F.col("value") > 70)
        .otherwise(F.col("value") > 50)
    )
    found = cohort.stays_with_items(labelled, ["Lactate", "ABPs", "ABPd"])
    return joins.stays_within(stays(s, d), found, STAY).select(STAY, "uniquepid", "los")


@query
def label_encode(s, d):
    st = stays(s, d).select(STAY, "gender", "ethnicity")
    return tabular.encode_labels(st, ["gender", "ethnicity"])


# ---- joins ---------------------------------------------------------------


@query
def join_inner_cohort(s, d):
    return extract.with_cohort(
        raw(s, d, "nurseCharting").select("nursingchartid", STAY), stays(s, d), ["uniquepid", STAY]
    )


@query
def join_left_los(s, d):
    return joins.balanced_join(
        raw(s, d, "nurseCharting").select("nursingchartid", STAY), stays(s, d).select(STAY, "los"), STAY, "left"
    )


@query
def join_semi(s, d):
    return joins.stays_within(raw(s, d, "lab").select("labid", STAY), stays(s, d), STAY)


@query
def join_anti_zero_weight(s, d):
    rows = raw(s, d, "lab").select("labid", STAY)
    return channels.drop_weightless(rows, stays(s, d))


@query
def join_salted(s, d):
    """The join used beyond the broadcast size, forced."""
    return joins.salted_join(
        raw(s, d, "nurseCharting").select("nursingchartid", STAY), stays(s, d).select(STAY, "los"), [STAY], "left"
    )


@query
def join_left_stay_hour(s, d):
    grid = hours.hour_grid(stays(s, d).select(STAY, "los"))
    flags = diagnosis.label_hours(raw(s, d, "intakeOutput").where(contains_text("cellpath", "intake")), ["c1", "c3"], "given")
    return diagnosis.attach_flags(grid.drop("los"), flags, [STAY, "hour"], ["given"], unique=True)


# ---- extraction ----------------------------------------------------------


@query
def extract_infusion(s, d):
    return infusion(s, d, stays(s, d)).select(
        "infusiondrugid", STAY, "uniquepid", "drugname", "drugrate", "unit_time",
        "start_min", "stop_min", r("infusionrate").alias("infusionrate"), r("drugamount").alias("drugamount"),
        r("volumeoffluid").alias("volumeoffluid"),
    )


@query
def infusion_stop_time(s, d):
    """Stop rule over order lines: rate is the discount, volume the quantity."""
    unit = F.expr(
        "case l_linenumber % 5 when 0 then 'mcg/kg/min' when 1 then 'ml/hr' when 2 then 'ml' "
        "when 3 then 'unlisted' end"
    )
    rows = A.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("start"),
        F.col("l_discount").alias("rate"), F.col("l_quantity").alias("volume"), unit.alias("unit"),
    )
    return rows.withColumn("stop", extract.infusion_stop("start", "rate", "volume", "unit")).select(
        "l_orderkey", "l_linenumber", "start", "stop", "unit"
    )


@query
def extract_intake(s, d):
    return intake(s, d, stays(s, d)).select(STAY, "uniquepid", "celllabel", r("cellvaluenumeric").alias("value"), "start_min", "stop_min")


@query
def extract_output(s, d):
    return extract.extract_output(raw(s, d, "intakeOutput"), stays(s, d)).select(
        STAY, "uniquepid", "celllabel", r("cellvaluenumeric").alias("value"), "event_min", "unitdischargeoffset"
    )


@query
def extract_treatment(s, d):
    return extract.extract_treatment(raw(s, d, "treatment"), stays(s, d)).select(
        "treatmentid", STAY, "patienthealthsystemstayid", "treatmentstring", "event_min"
    )


@query
def extract_labs(s, d):
    return extract.extract_labs(raw(s, d, "lab"), raw(s, d, "customLab"), stays(s, d)).select(
        "labid", STAY, "uniquepid", "labname", "labresult", "labmeasurenamesystem", "event_min"
    )


@query
def extract_chart(s, d):
    return extract.extract_chart(raw(s, d, "nurseCharting"), raw(s, d, "respiratoryCharting"), stays(s, d))


@query
def extract_vitals(s, d):
    return extract.extract_vitals(raw(s, d, "vitalPeriodic"), raw(s, d, "vitalAperiodic"), stays(s, d))


@query
def extract_micro(s, d):
    return extract.extract_micro(raw(s, d, "microLab"), stays(s, d)).select("labid", STAY, "uniquepid", "labname", "event_min")


@query
def vent_intervals(s, d):
    return extract.vent_intervals(raw(s, d, "respiratoryCharting"))


@query
def unpivot_vitals(s, d):
    rows = A.table(s, d, "lineitem")
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return extract.unpivot_values(rows.select("l_orderkey", "l_linenumber", *measures), ["l_orderkey", "l_linenumber"], measures, "label", "value")


# ---- selection and cleaning ---------------------------------------------


def part_dictionary(s: SparkSession, d: str) -> DataFrame:
    """Part types: two share a name, one is left out, one is listed twice."""
    types = A.table(s, d, "part").select(F.col("p_type").alias("itemstring")).distinct()
    name = F.when(F.col("itemstring").isin("ECONOMY", "SMALL"), "basic").otherwise(F.lower("itemstring"))
    first = types.where(F.col("itemstring") != "PROMO").withColumn("altername", name).withColumn("position", F.lit(0))
    again = types.where(F.col("itemstring") == "LARGE").withColumn("altername", F.lit("big")).withColumn("position", F.lit(1))
    return first.unionByName(again)


def part_lines(s: SparkSession, d: str) -> DataFrame:
    lines = A.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), "l_quantity")
    parts = A.table(s, d, "part").select("p_partkey", F.col("p_type").alias("label"))
    return joins.balanced_join(lines, parts, "p_partkey").drop("p_partkey")


@query
def feature_select(s, d):
    return select.select_features(part_lines(s, d), part_dictionary(s, d), "label")


@query
def feature_select_union(s, d):
    charted = chart_values(s, d)
    vitals = extract.extract_vitals(raw(s, d, "vitalPeriodic"), raw(s, d, "vitalAperiodic"), stays(s, d)).select(
        STAY, "event_min", F.col("nursingchartcelltypevallabel").alias("label"), F.col("nursingchartvalue").alias("value")
    )
    names = A.dictionary(s, A.DICTIONARIES["chart"])
    return select.select_union([charted, vitals], names, "label").select(STAY, "event_min", "label", r("value").alias("value"))


def price_bounds(s: SparkSession, d: str) -> DataFrame:
    return clean.percentile_bounds(A.table(s, d, "lineitem"), "l_returnflag", "l_extendedprice")


@query
def outlier_bounds(s, d):
    return price_bounds(s, d).select("l_returnflag", "n", r("lo").alias("lo"), r("hi").alias("hi"))


@query
def outlier_trim(s, d):
    rows = A.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return clean.outlier_trim(rows, price_bounds(s, d), "l_returnflag", "l_extendedprice").withColumn(
        "l_extendedprice", r("l_extendedprice")
    )


@query
def outlier_winsorize(s, d):
    rows = A.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return clean.outlier_winsorize(rows, price_bounds(s, d), "l_returnflag", "l_extendedprice").withColumn(
        "l_extendedprice", r("l_extendedprice")
    )


@query
def clean_chart(s, d):
    """Charted values moved onto their label's 5th and 95th percentile."""
    rows = raw(s, d, "nurseCharting").select("nursingchartid", "nursingchartcelltypevallabel", "nursingchartvalue")
    out = clean_events({"chart": rows}, chart=Outliers(5, 95, impute=True))["chart"]
    return out.select("nursingchartid", F.col("nursingchartcelltypevallabel").alias("label"), r("nursingchartvalue").alias("value"))


# ---- alignment -----------------------------------------------------------


@query
def resample_points(s, d):
    return align.align_points(chart_values(s, d), stays(s, d)).select(STAY, "label", "hour", "los", r("value").alias("value"))


@query
def resample_treatment(s, d):
    st = stays(s, d)
    rows = extract.extract_treatment(raw(s, d, "treatment"), st)
    return align.align_treatment(rows, st).select(STAY, "treatmentid", "treatmentstring", "hour")


@query
def resample_intake(s, d):
    st = stays(s, d)
    return align.align_intake(intake(s, d, st), st).select(
        STAY, "celllabel", "start_hour", "stop_hour", r("cellvaluenumeric").alias("value")
    )


@query
def resample_intervals(s, d):
    st = stays(s, d)
    return align.align_infusion(infusion(s, d, st), st, drop_hour_zero=True).select(
        "infusiondrugid", STAY, "drugname", "start_hour", "stop_hour", "amount", r("infusionrate").alias("infusionrate")
    )


@query
def union_procedures(s, d):
    st = stays(s, d)
    micro = align.align_points(extract.extract_micro(raw(s, d, "microLab"), st), st)
    treated = align.align_treatment(extract.extract_treatment(raw(s, d, "treatment"), st), st)
    return align.union_procedures(micro, treated).drop("los")


# ---- tabularisation ------------------------------------------------------


@query
def hour_grid(s, d):
    return hours.hour_grid(stays(s, d).select(STAY, "los"))


@query
def pivot_hourly_mean(s, d):
    points = align.align_points(chart_values(s, d), stays(s, d))
    wide = tabular.hourly_mean_pivot(points, "label", "value", CHART)
    return wide.select(STAY, "hour", *[r(c).alias(c) for c in CHART])


@query
def ffill_hourly(s, d):
    st, events = shared(s, d)
    wide = tabular.tabularize(st, hold_streams(s, d, st, events), labels={"chart": CHART, "lab": LAB}, block_hours=240)
    return tabular.tabular_output(wide).select(
        STAY, "hour", *[r(f"chart__{c}").alias(c) for c in CHART], *[r(f"lab__{c}").alias(c) for c in LAB]
    )


@query
def pivot_presence(s, d):
    st = stays(s, d)
    treated = align.align_treatment(extract.extract_treatment(raw(s, d, "treatment"), st), st)
    return tabular.presence_pivot(treated, "treatmentstring", ["t1", "t2", "t3", "t4", "t5"])


@query
def pivot_output(s, d):
    st = stays(s, d)
    out = align.align_points(extract.extract_output(raw(s, d, "intakeOutput"), st), st)
    streams = {"out": Stream(out, "hourly", {"out": "cellvaluenumeric"}, "celllabel")}
    names = ["c0", "c1", "c2", "c3"]
    wide = tabular.tabular_output(tabular.tabularize(st, streams, labels={"out": names}))
    return wide.select(STAY, "hour", *[r(f"out__{c}").alias(c) for c in names])


@query
def chart_special(s, d):
    """MAP is charted for one in five pressures, ECMO for one stay in three."""
    st = stays(s, d)
    rows = chart_values(s, d)
    charted = rows.where((F.col("event_min") % 5 == 0) & (F.col("label") == "ABPs")).withColumn("label", F.lit("MAP"))
    ecmo = rows.where((F.col(STAY) % 3 == 0) & (F.col("label") == "ABPd")).withColumn("label", F.lit("ECMO"))
    points = align.align_points(rows.unionByName(charted).unionByName(ecmo), st)
    streams = {"chart": Stream(points, "hold", {"chart": "value"})}
    names = [*CHART, "ECMO", "MAP"]
    wide = tabular.tabular_output(tabular.tabularize(st, streams, labels={"chart": names}))
    return wide.select(STAY, "hour", *[r(f"chart__{c}").alias(c) for c in names])


@query
def vent_hourly(s, d):
    st = stays(s, d)
    vent = align.align_intervals(extract.vent_intervals(raw(s, d, "respiratoryCharting")), st)
    streams = {"vent": Stream(vent.withColumn("on", F.lit(1.0)), "interval", {"vent": "on"})}
    wide = tabular.tabular_output(tabular.tabularize(st, streams, labels={"vent": ["Ventilator"]}))
    return wide.select(STAY, "hour", col("vent__Ventilator").cast("int").alias("ventilated"))


@query
def interval_expand(s, d):
    st = stays(s, d)
    rows = align.align_intake(intake(s, d, st), st, drop_hour_zero=True)
    return hours.expand_intervals(rows, "celllabel", ["cellvaluenumeric"]).select(
        STAY, "celllabel", "hour", r("cellvaluenumeric").alias("dose")
    )


@query
def interval_expand_rate(s, d):
    st = stays(s, d)
    rows = align.align_infusion(infusion(s, d, st), st, drop_hour_zero=True)
    return hours.expand_intervals(rows, "drugname", ["amount", "infusionrate"]).select(
        STAY, "drugname", "hour", r("amount").alias("amount"), r("infusionrate").alias("rate")
    )


@query
def tabular_wide(s, d):
    st, events = shared(s, d)
    treated = align.align_treatment(extract.extract_treatment(raw(s, d, "treatment", events), st), st)
    streams = {
        **hold_streams(s, d, st, events),
        "ing": infusion_stream(s, d, st, events),
        "proc": Stream(treated, "flag", {"proc": "treatmentstring"}, "treatmentstring"),
    }
    names = {"chart": CHART, "lab": LAB, "ing": DRUGS, "proc": ["t1", "t2"]}
    wide = tabular.tabular_output(tabular.tabularize(st, streams, labels=names))
    return wide.select(
        STAY, "hour", *[r(c).alias(c.replace(" ", "_").split("(")[0].rstrip("_")) for c in wide.columns if "__" in c]
    )


@query
def tabular_long(s, d):
    """The long form, for more labels than a table has columns."""
    st, events = shared(s, d)
    streams = {**hold_streams(s, d, st, events), "ing": infusion_stream(s, d, st, events)}
    return tabular.long_table(streams).withColumn("value", r("value"))


@query
def integrate_static(s, d):
    st = tabular.encode_labels(stays(s, d), ["gender", "ethnicity"])
    streams = {"chart": hold_streams(s, d, st)["chart"]}
    static = ["uniquepid", "Age", "gender", "ethnicity", "admissionheight", "admissionweight"]
    wide = tabular.tabular_output(tabular.tabularize(st, streams, labels={"chart": ["ABPs"]}, static=static))
    return wide.select(STAY, "hour", *static, r("chart__ABPs").alias("ABPs"))


# ---- channels, units, sums ----------------------------------------------


def line_columns(s: SparkSession, d: str, columns: dict[str, str]) -> DataFrame:
    """Order lines as rows of a wide table: column name to source expression."""
    return A.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.expr(e).cast("double").alias(c) for c, e in columns.items()]
    )


DRUG_COLUMNS = {
    "weight": "40 + l_quantity",
    "Norepinephrine (ml)": "l_quantity",
    "med_Norepinephrine (ml)": "l_discount",
    "Norepinephrine (mcg)": "l_extendedprice",
    "Norepinephrine (mcg/kg)": "l_tax",
    "Norepinephrine (mg)": "l_discount",
    "Norepinephrine (mcg/kg)_rate": "l_tax",
    "Norepinephrine (ml)_rate": "l_discount",
    "Norepinephrine (mcg)_rate": "l_quantity",
    "Norepinephrine (mg)_rate": "l_tax",
    "Epinephrine (ml)": "l_quantity",
    "Epinephrine (mg)": "l_discount",
    "Epinephrine (mcg)_rate": "l_quantity",
    "Epinephrine (mcg/kg)_rate": "l_discount",
    "Dopamine (ml)": "l_quantity",
    "Dopamine (mg)": "l_extendedprice",
    "Dopamine (ml)_rate": "l_discount",
    "Dopamine (mcg/kg)_rate": "l_tax",
    "Dobutamine (ml)": "l_quantity",
    "Dobutamine (ml)_rate": "l_tax",
    "Phenylephrine (mcg)": "l_extendedprice",
    "Vasopressin (ml)": "l_quantity",
    "Vasopressin (mg)": "l_discount",
    "Labetalol (ml)": "l_quantity",
    "Labetalol(mg)": "l_discount",
    "Labetalol (mg)": "l_tax",
    "med_Milrinone (ml)": "l_quantity",
}


@query
def merge_channels(s, d):
    rows = line_columns(
        s,
        d,
        {
            "chart__Temperature": "l_quantity",
            "lab__Temperature": "if(l_linenumber % 2 = 0, l_tax, null)",
            "chart__PEEP": "if(l_linenumber % 3 = 0, l_quantity, null)",
            "lab__PEEP": "if(l_linenumber % 2 = 0, l_tax, null)",
            "chart__FIO2 (%)": "if(l_linenumber % 3 = 0, l_quantity, null)",
            "lab__FIO2 (%)": "if(l_linenumber % 2 = 0, l_tax, null)",
            "med__med_Dopamine (ml)": "l_quantity",
            "ing__med_Dopamine (ml)": "l_discount",
            "rate__med_Dopamine (ml)": "l_tax",
            "ing__Saline": "l_quantity",
            "rate__Saline": "l_tax",
            "height": "if(l_linenumber = 1, 0, 170)",
        },
    )
    flat = channels.merge_channels(rows)
    names = {"FIO2 (%)": "fio2", "med_Dopamine (ml)": "dopamine"}
    return flat.select(*[r(c).alias(names.get(c, c)) if c not in ("l_orderkey", "l_linenumber", "height_fillna") else col(c) for c in flat.columns])


@query
def unit_convert_amount(s, d):
    rows = line_columns(s, d, DRUG_COLUMNS)
    _, amounts, _, _ = units.convert_drug(rows.columns, "nore")
    names = ["nore_ml", "nore_med_ml", "nore_mcg", "nore_mcgkg"]
    return rows.select("l_orderkey", "l_linenumber", *[r(a, 9).alias(n) for a, n in zip(amounts.values(), names, strict=True)])


@query
def unit_convert_rate(s, d):
    rows = line_columns(s, d, DRUG_COLUMNS)
    _, _, rates, _ = units.convert_drug(rows.columns, "nore")
    names = ["nore_ml_rate", "nore_mcg_rate", "nore_mg_rate"]
    return rows.select("l_orderkey", "l_linenumber", *[r(a, 9).alias(n) for a, n in zip(rates.values(), names, strict=True)])


@query
def unit_convert_insulin(s, d):
    rows = line_columns(s, d, {"Insulin (ml)": "l_quantity", "med_Insulin (mcg)": "l_extendedprice", "Insulin_rate": "l_tax"})
    _, amounts = units.convert_units(rows.columns, "insulin")
    return rows.select("l_orderkey", "l_linenumber", *[r(a, 9).alias(n) for a, n in zip(amounts.values(), ["from_ml", "from_mcg"], strict=True)])


@query
def unit_convert_misc(s, d):
    rows = line_columns(s, d, {"x": "l_extendedprice", "weight": "40 + l_quantity"})
    x, w = F.col("x"), F.col("weight")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        r(units.unit_to_mg(x), 9).alias("unit_mg"),
        r(units.unitkg_to_mg(x, w), 8).alias("unitkg_mg"),
        r(units.unithr_to_mcgkgmin(x, w), 5).alias("unithr_rate"),
    )


@query
def drug_totals(s, d):
    totals, _ = units.drug_totals(line_columns(s, d, DRUG_COLUMNS))
    flagged = impute.vasoactive_flag(totals)
    names = {
        c: c.replace(" (MG)", "_mg").replace(" (MCG/KG/MIN)_Rate", "_rate").lower()
        for c in flagged.columns
        if "(M" in c
    }
    return flagged.select(
        "l_orderkey", "l_linenumber", *[r(c, 7).alias(n) for c, n in names.items()],
        col("vasoactive/inotropic").alias("vasoactive"),
    )


@query
def totals_long(s, d):
    """Totals from the long table, with the conversions as a table."""
    st, events = shared(s, d)
    rows = infusion(s, d, st, events)
    named = select.select_features(rows, A.dictionary(s, A.DICTIONARIES["ing"]), "drugname")
    aligned = align.align_infusion(named, st, drop_hour_zero=True)
    long = tabular.long_table({"ing": Stream(aligned, "interval", {"ing": "amount", "rate": "infusionrate"}, "drugname")})
    out = factors.hourly_totals(long, st, factors.default_factors(s), "admissionweight")
    return out.withColumn("value", r("value", 5))


SUM_COLUMNS = {
    "Insulin (ml)": "l_quantity",
    "Insulin (mcg)": "l_extendedprice",
    "Enteral Nutrition": "l_quantity",
    "Enteral Nutrition_rate": "l_extendedprice",
    "Enteral Nutrition Ingredient_rate": "l_extendedprice",
    "med_Nutrition_rate": "l_quantity",
    "med_Nutrition": "if(l_linenumber = 2, null, l_tax)",
    "med_NaCl 0.9%": "l_quantity",
    "NaCl 0.9%": "l_discount",
    "NaCl 0.9%_rate": "l_extendedprice",
    "med_NaCl 3%": "if(l_linenumber = 1, null, l_tax)",
    "med_Dextrose 5%": "l_quantity",
    "Dextrose 10%": "l_tax",
    "Dextrose 10%_rate": "l_extendedprice",
    "Heparin (ml)": "l_quantity",
    "Heparin (ml)_rate": "l_extendedprice",
    "Insulin (ml)_rate": "l_extendedprice",
    "med_Water": "l_discount",
    "med_Esmolol": "l_tax",
}


@query
def group_sums(s, d):
    out = units.group_sums(line_columns(s, d, SUM_COLUMNS))
    names = {
        "Insulin (Unit)": "insulin", "Nutrition (ml)": "nutrition", "Nacl n% (sum)": "saline",
        "Dextrose n% (sum)": "dextrose", "Heparin sodium (Unit)": "heparin", "Water": "water", "Esmolol (MG)": "esmolol",
    }
    return out.select("l_orderkey", "l_linenumber", *[r(c, 7).alias(n) for c, n in names.items()])


@query
def fluids_total(s, d):
    """Order lines as fluids, plus the hourly crystalloids of the intake table."""
    st = stays(s, d)
    added = crystalloid_intervals(raw(s, d, "intakeOutput"), st, "c2")
    base = align.align_intake(intake(s, d, st), st, drop_hour_zero=True)
    streams = {
        "med": Stream(base, "interval", {"med": "cellvaluenumeric"}, "celllabel"),
        "cryst": Stream(added, "interval", {"cryst": "dose"}),
    }
    wide = tabular.tabular_output(tabular.tabularize(st, streams, labels={"med": ["c0", "c1"], "cryst": [ADDED_FLUID]}))
    flat = channels.merge_channels(wide).withColumnsRenamed({"c0": "Water", "c1": "Heparin sodium (Unit)"})
    return impute.fluids_total(flat, ADDED_FLUID).select(STAY, "hour", r("Fluids(ml)").alias("fluids"))


@query
def positive_flag(s, d):
    rows = line_columns(
        s, d, {"Labetalol (MG)": "if(l_linenumber = 3, null, l_discount)", "Esmolol (MG)": "l_tax", "dose": "l_discount - 0.05"}
    )
    out = impute.positive_column(impute.beta_blocker_flag(rows), "dose", "given")
    return out.select("l_orderkey", "l_linenumber", "given", col("ACE_inhibitors(beta-blocker)").alias("beta_blocker"))


# ---- imputation ----------------------------------------------------------


def hourly_channels(s: SparkSession, d: str) -> DataFrame:
    st = stays(s, d).withColumnsRenamed({"admissionheight": "height", "admissionweight": "weight"})
    wide = tabular.tabularize(st, hold_streams(s, d, st), labels={"chart": CHART, "lab": LAB}, static=["height", "weight"])
    return channels.merge_channels(tabular.tabular_output(wide))


@query
def default_impute(s, d):
    out = impute.default_impute(impute.null_above(hourly_channels(s, d), "ABPs", 100))
    return out.select(
        STAY, "hour", r("ABPs").alias("ABPs"), "ABPs_fillna", r("Creatinine").alias("Creatinine"), "Creatinine_fillna",
        col("FIO2 (%)").alias("fio2"), col("FIO2 (%)_fillna").alias("fio2_fillna"), "pH", "Temperature",
    )


@query
def default_impute_all(s, d):
    """Every column that gets a constant, and its mark."""
    out = impute.default_impute(hourly_channels(s, d))
    names = [n for c in DEFAULTS for n in (c, f"{c}_fillna")]
    return out.select(STAY, "hour", *[r(n).alias(n) if n in DEFAULTS else col(n) for n in names])


@query
def derived_impute(s, d):
    out = impute.derived_impute(impute.default_impute(hourly_channels(s, d)))
    return out.select(
        STAY, "hour", "height_fillna", r("MAP").alias("MAP"), "MAP_fillna",
        r("Cardiac Output").alias("cardiac_output"), col("Cardiac Output_fillna").alias("cardiac_output_fillna"),
        r("PaO2/FiO2").alias("pf_ratio"),
    )


# ---- diagnoses -----------------------------------------------------------

INFECTION_9, INFECTION_10 = ["38", "4"], ["I44"]


def groups() -> dict[str, Column]:
    return diagnosis.diagnosis_groups(infection_icd9=INFECTION_9, infection_icd10=INFECTION_10)


@query
def dx_code_split(s, d):
    return diagnosis.split_codes(raw(s, d, "diagnosis")).select(STAY, "icd9", "icd10")


@query
def dx_prefix_match(s, d):
    return diagnosis.matched_codes(diagnosis.split_codes(raw(s, d, "diagnosis")), groups())


LONG_9 = [str(i) for i in range(100, 400)]
LONG_10 = [f"{letter}{i:02d}" for letter in "ABCDEFGHIJKL" for i in range(100)]


@query
def dx_long_list(s, d):
    """Matches against a list of 1,500 codes."""
    listed = diagnosis.diagnosis_groups(infection_icd9=LONG_9, infection_icd10=LONG_10)
    found = {"suspected_infection": listed["suspected_infection"]}
    return diagnosis.matched_codes(diagnosis.split_codes(raw(s, d, "diagnosis")), found)


@query
def dx_flags(s, d):
    flags = diagnosis.stay_flags(diagnosis.split_codes(raw(s, d, "diagnosis")), groups())
    orders = A.table(s, d, "orders").select(F.col("o_orderkey").alias(STAY))
    names = list(groups())
    out = diagnosis.attach_flags(orders, flags, [STAY], names, unique=True)
    return out.select(STAY, *[col(n).alias(n.replace("-", "_")) for n in names])


@query
def dx_prefix_table(s, d):
    """Infection codes as a table: a list of all parts' code stems, far longer
    than what a plan should hold, beside the fixed groups."""
    codes = diagnosis.split_codes(raw(s, d, "diagnosis"))
    listed = codes.select(
        F.lit(10).alias("icd_version"), F.concat_ws(", ", F.substring("icd10", 1, 4), F.concat(F.lit("Z."), "icd10")).alias("icd_code")
    ).where(F.col("icd10").like("I%") & (F.length("icd10") > 3) & (F.ascii(F.substring("icd10", 4, 1)) % 2 == 0))
    prefixes, names = diagnosis.prefix_table(diagnosis.infection_prefixes(listed))
    out = diagnosis.stay_flags_by_table(codes, prefixes, names)
    return out.select(STAY, *[col(n).alias(n.replace("-", "_")) for n in names])


@query
def treatment_flag(s, d):
    found = diagnosis.culture_stays(raw(s, d, "treatment"), ["t1"])
    return diagnosis.attach_flags(stays(s, d).select(STAY), found, [STAY], ["blood_culture"], unique=True)


# ---- scores and labels ---------------------------------------------------


@query
def score_gcs(s, d):
    rows = line_columns(
        s, d, {"Motor Response": "1 + l_quantity % 6", "Eye Opening": "1 + l_linenumber % 4", "Verbal Response": "1 + l_partkey % 5"}
    )
    return scores.gcs_score(rows).select("l_orderkey", "l_linenumber", "GCS_score")


SOFA_COLUMNS = {
    "PaO2/FiO2": "l_quantity * 10",
    "Ventilator": "l_linenumber % 2",
    "Platelets": "l_extendedprice % 200",
    "Total Bilirubin": "l_extendedprice % 14",
    "MAP": "50 + l_quantity",
    "Dopamine (MCG/KG/MIN)_Rate": "if(l_suppkey % 3 = 0, l_quantity / 2, 0)",
    "Dopamine (MG)": "if(l_suppkey % 3 = 0, l_tax, 0)",
    "Epinephrine (MCG/KG/MIN)_Rate": "if(l_suppkey % 5 = 0, l_tax * 2, 0)",
    "Norepinephrine (MCG/KG/MIN)_Rate": "if(l_suppkey % 7 = 0, l_tax * 2, 0)",
    "GCS_score": "3 + (l_partkey % 25) / 2",
    "Creatinine": "l_extendedprice % 6",
    "Urine output": "if(l_linenumber % 3 = 0, null, l_extendedprice % 700)",
}


@query
def score_sofa(s, d):
    out = scores.sofa_score(line_columns(s, d, SOFA_COLUMNS))
    return out.select("l_orderkey", "l_linenumber", *scores.COMPONENTS, "SoFa_score")


@query
def label_state(s, d):
    out = labels.annotate_states(state_inputs(s, d, (0, 0)), block_hours=100)
    return out.select(STAY, "hour", r("MAP").alias("MAP"), r("Lactate").alias("Lactate"), "Annotation")


@query
def label_next12h(s, d):
    states = labels.annotate_states(state_inputs(s, d, (0, 0)), block_hours=100)
    return labels.label_next12h(states, block_hours=100).select(STAY, "hour", "Annotation", "Shock_next_12h")


@query
def state_outlook(s, d):
    """Hourly state and 12-hour outlook per stay, with a single wide shuffle."""
    out = labels.label_states(state_inputs(s, d, (labels.BACK, labels.AHEAD)))
    return out.select(
        STAY, "hour", r("MAP").alias("MAP"), r("Lactate").alias("Lactate"),
        col("vasoactive/inotropic").alias("vasoactive"), "Annotation", "Shock_next_12h",
    )


@query
def label_crosstab(s, d):
    return labels.label_crosstab(labels.label_states(state_inputs(s, d, (labels.BACK, labels.AHEAD))))


def whole_table(s: SparkSession, d: str, mode: str) -> DataFrame:
    """Raw tables to the final labelled table, every column. Saline goes in as a
    dextrose infusion, so that the table has a real rate beside a volume."""
    names = {**A.DICTIONARIES, "ing": [(a, "Dextrose 10%" if a == "Saline" else b) for a, b in A.DICTIONARIES["ing"]]}
    out = final_dataset(
        A.raw_tables(s, d),
        {family: A.dictionary(s, pairs) for family, pairs in names.items()},
        (INFECTION_9, INFECTION_10),
        mode,
        crystalloid_label="c2",
        antibiotics=["c1"],
        cultures=["t5"],
    )
    digits = {name: 9 if name.endswith("(MG)") else 6 for name, kind in out.dtypes if kind == "double"}
    return out.select(*[r(name, digits[name]).alias(name) if name in digits else col(name) for name in out.columns])


@query
def pipeline_final(s, d):
    return whole_table(s, d, "corrected")


@query
def pipeline_published(s, d):
    return whole_table(s, d, "published")


@query
def final_table(s, d):
    """The main columns, with real rates and the published factors."""
    out = final_dataset(
        A.raw_tables(s, d),
        A.dictionaries(s),
        (INFECTION_9, INFECTION_10),
        Mode(rate_zero=False, si=False, strict_cardio=False, myocarditis_from_arrhythmia=False),
        crystalloid_label="c2",
        antibiotics=["c1"],
        cultures=["t5"],
    )
    return out.select(
        STAY,
        F.col("Time_since_ICU_admission").alias("hour"),
        "uniquepid",
        "Age",
        "gender",
        "ethnicity",
        "weight",
        "suspected_infection",
        col("Acute_Myocardial_Infarction").alias("infarction"),
        col("Blood culture").alias("blood_culture"),
        col("Dialysis").alias("dialysis"),
        r("Urine output").alias("urine"),
        r("MAP").alias("MAP"),
        "MAP_fillna",
        r("Lactate").alias("Lactate"),
        r("Creatinine").alias("Creatinine"),
        r("FIO2 (%)").alias("fio2"),
        r("Temperature").alias("Temperature"),
        r("HR").alias("HR"),
        r("Cardiac Output").alias("cardiac_output"),
        r("Norepinephrine (MG)", 9).alias("norepinephrine_mg"),
        r("Norepinephrine (MCG/KG/MIN)_Rate").alias("norepinephrine_rate"),
        r("Dopamine (MG)", 9).alias("dopamine_mg"),
        r("Dopamine (MCG/KG/MIN)_Rate").alias("dopamine_rate"),
        r("Fluids(ml)").alias("fluids"),
        "Antibiotics",
        col("vasoactive/inotropic").alias("vasoactive"),
        col("Ventilator").cast("int").alias("ventilated"),
        "Sofa_Respiration",
        "Sofa_Cardiovascular",
        "Sofa_Urine",
        "SoFa_score",
        "Annotation",
        "Shock_next_12h",
    )
