"""Hand-made cases for the rules that random data rarely meets."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bedhour import STAY
from bedhour.functions import age_years, hour_ceil, hour_round, last_parenthesised, to_number
from bedhour.operators import align, clean, cohort, diagnosis, extract, hours, impute, labels, scores, select, tabular, units
from bedhour.operators.tabular import Stream


def one(spark, expr, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr).first()[0]


@pytest.mark.parametrize("text, number", [("> 89", 89.0), ("45", 45.0), ("", None), (None, None)])
def test_age(spark, text, number):
    assert one(spark, age_years("x"), text) == number


@pytest.mark.parametrize(
    "minute, hour",
    [(-31, -1), (-30, 0), (-29, 0), (0, 0), (29, 0), (30, 0), (31, 1), (60, 1), (89, 1), (90, 2), (150, 2)],
)
def test_hour_round(spark, minute, hour):
    assert one(spark, hour_round("x"), minute, "bigint") == hour


def test_hour_ceil(spark):
    assert [one(spark, hour_ceil("x"), m, "bigint") for m in (0, 1, 60, 61, -1)] == [0, 1, 1, 2, 0]


@pytest.mark.parametrize(
    "text, number",
    [
        ("1e3", 1000.0),
        (" 1 ", 1.0),
        ("+5", 5.0),
        (".5", 0.5),
        ("OFF", None),
        ("1,000", None),
        ("1d", None),
        ("5f", None),
        ("nan", None),
        ("", None),
        (None, None),
        (">10", None),
        ("inf", math.inf),
    ],
)
def test_to_number(spark, text, number):
    assert one(spark, to_number("x"), text) == number


def test_last_parenthesised(spark):
    assert one(spark, last_parenthesised("x"), "Drug (a) (mcg/min)") == "mcg/min"
    assert one(spark, last_parenthesised("x"), "Drug") is None


@pytest.mark.parametrize(
    "rate, unit, stop",
    [(0.0, "mcg/min", 10), (7.0, "mcg/kg/min", 25), (7.0, "ml/hr", 868), (7.0, "ml", 25), (7.0, None, 0), (7.0, "other", 0)],
)
def test_infusion_stop(spark, rate, unit, stop):
    df = spark.createDataFrame([(10, rate, 100.0, unit)], "s bigint, r double, v double, u string")
    assert df.select(extract.infusion_stop("s", "r", "v", "u")).first()[0] == stop


def patient_rows(spark, rows):
    cols = (
        "uniquepid string, patientunitstayid bigint, patienthealthsystemstayid bigint, age string, gender string, "
        "ethnicity string, hospitaldischargeyear int, unitdischargeoffset bigint, unitdischargestatus string, "
        "admissionheight double, admissionweight double, dischargeweight double"
    )
    return spark.createDataFrame(rows, cols)


def test_cohort(spark):
    df = patient_rows(
        spark,
        [
            ("p1", 1, 1, "> 89", "F", "a", 2014, 1500, "Expired", 170.0, 70.0, None),
            ("p1", 2, 1, "45", "F", "a", 2014, 600, None, None, 0.0, None),
            ("p2", 3, 2, "17", "M", "b", 2014, 600, "Alive", 170.0, 70.0, 1.0),
            ("p3", 4, 3, "", "M", "b", 2014, 600, "Alive", 170.0, 70.0, 1.0),
            ("p4", 5, 4, "30", None, "b", 2014, None, "Alive", 170.0, 70.0, 1.0),
            ("p5", 6, 5, "30", "M", "b", 2014, 29, "Alive", 170.0, 70.0, 1.0),
        ],
    )
    valid, invalid = cohort.case_control_split(cohort.visit_table(df))
    got = {r[STAY]: (r.label, r.unitdischargestatus, r.admissionheight) for r in valid.collect()}
    assert got == {1: (1, "Expired", 170.0), 2: (0, "0", 0.0), 6: (0, "Alive", 170.0)}
    assert [r[STAY] for r in invalid.collect()] == [5]
    # 29 minutes round to 0 hours and the stay is dropped.
    assert sorted((r[STAY], r.los) for r in cohort.los_hours(valid).collect()) == [(1, 25), (2, 10)]
    assert cohort.summary_text(cohort.build_cohort(df)).first()[0].endswith("stays survived = 2")


STAYS = [(1, 10), (2, 3)]


def stay_table(spark, rows=STAYS):
    return spark.createDataFrame(rows, f"{STAY} bigint, los bigint")


def test_intervals_zero_length(spark):
    iv = spark.createDataFrame([(1, 70, 70), (1, 100, 100), (1, 500, 9000), (1, 601, 700)], f"{STAY} bigint, start_min bigint, stop_min bigint")
    got = sorted((r.start_hour, r.stop_hour) for r in align.align_intervals(iv, stay_table(spark)).collect())
    assert got == [(1, 2), (8, 10)]


@pytest.mark.parametrize("block", [1, 3, 672])
def test_interval_overlap(spark, block):
    iv = spark.createDataFrame(
        [(1, "a", 2, 10, 5.0), (1, "a", 4, 6, 1.0), (1, "b", 1, 5, 2.0), (1, "b", 1, 6, 4.0)],
        f"{STAY} bigint, label string, start_hour bigint, stop_hour bigint, dose double",
    )
    got = {(r.label, r.hour): r.dose for r in hours.expand_intervals(iv, "label", ["dose"], block).collect()}
    # The later start cuts the earlier one; equal starts are averaged (stop 5.5).
    assert got == {("a", 2): 5.0, ("a", 3): 5.0, ("a", 4): 1.0, ("a", 5): 1.0, **{("b", h): 3.0 for h in range(1, 6)}}
    streams = {"med": Stream(iv.withColumn("los", F.lit(10).cast("bigint")), "interval", {"med": "dose"})}
    wide = tabular.tabularize(stay_table(spark, [(1, 10)]), streams, block_hours=block)
    dense = {
        (lab, r.hour): r[f"med__{lab}"] for r in wide.collect() for lab in ("a", "b") if r[f"med__{lab}"]
    }
    assert dense == got


def test_vent(spark):
    rows = [
        (1, 1, 60, "Start"), (2, 1, 120, "Off"), (3, 1, 300, "Off"),
        (4, 2, 10, "Start"), (5, 2, 90, "Continued"),
        (6, 3, 10, "Off"),
    ]
    df = spark.createDataFrame(rows, f"respchartid bigint, {STAY} bigint, respchartoffset bigint, respchartvalue string")
    got = extract.vent_intervals(df.withColumn("respchartvaluelabel", F.lit("RT Vent On/Off"))).collect()
    assert sorted((r[STAY], r.start_min, r.stop_min) for r in got) == [(1, 60, 300), (2, 10, 90)]


def test_trim_and_winsorise(spark):
    df = spark.range(1, 102).select(F.lit("x").alias("label"), F.col("id").cast("double").alias("v"))
    bounds = clean.percentile_bounds(df, "label", "v")
    assert bounds.select("lo", "hi").first() == (3.0, 99.0)
    assert clean.outlier_trim(df, bounds, "label", "v").count() == 97
    clamped = clean.outlier_winsorize(df, bounds, "label", "v")
    assert (clamped.count(), clamped.agg(F.min("v"), F.max("v")).first()) == (101, (3.0, 99.0))


def test_dictionary(spark):
    names = spark.createDataFrame([("a", "first", 0), ("a", "last", 1), ("b", "last", 2)], "itemstring string, altername string, position bigint")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "unknown")], "id bigint, label string")
    assert sorted(map(tuple, select.select_features(df, names, "label").collect())) == [(1, "last"), (2, "last")]


def test_code_split(spark):
    df = spark.createDataFrame([(1, "428.0, I50.9"), (2, "428.0"), (3, None)], f"{STAY} bigint, icd9code string")
    assert [tuple(r) for r in diagnosis.split_codes(df).select(STAY, "icd9", "icd10").collect()] == [(1, "4280", "I509")]


def test_myocarditis_options():
    assert "Arrhythmia" in diagnosis.diagnosis_groups()
    assert "Arrhythmia" not in diagnosis.diagnosis_groups(myocarditis_from_arrhythmia=True)


@pytest.mark.parametrize(
    "fn, cases",
    [
        (scores.liver, {1.19: 0, 1.2: 1, 1.9: 1, 1.95: 0, 2.0: 2, 5.95: 0, 6.0: 3, 11.95: 0, 12.0: 4}),
        (scores.neurologic, {15.0: 0, 14.5: 0, 14.0: 1, 12.0: 2, 9.0: 3, 5.0: 4}),
        (scores.coagulation, {151.0: 0, 150.0: 1, 100.0: 2, 50.0: 3, 20.0: 4}),
    ],
)
def test_simple_scores(spark, fn, cases):
    df = spark.createDataFrame([(k,) for k in cases], "x double")
    assert {r[0]: r[1] for r in df.select("x", fn(F.col("x"))).collect()} == cases


def test_renal(spark):
    cases = {(1.0, 0.0): 0, (5.0, 600.0): 0, (5.0, 100.0): 4, (5.0, 300.0): 3, (1.95, 600.0): 0, (3.0, 100.0): 2}
    df = spark.createDataFrame(list(cases), "c double, u double")
    assert {(r[0], r[1]): r[2] for r in df.select("c", "u", scores.renal(F.col("c"), F.col("u"))).collect()} == cases


def test_respiration(spark):
    cases = {(150.0, True): 3, (150.0, False): 0, (100.0, True): 4, (300.0, True): 2, (301.0, False): 1, (400.0, True): 0}
    df = spark.createDataFrame(list(cases), "p double, v boolean")
    assert {(r[0], r[1]): r[2] for r in df.select("p", "v", scores.respiration(F.col("p"), F.col("v"))).collect()} == cases


def test_cardiovascular(spark):
    rows = [(80.0, 0.0, 0.0, 0.0, 0.0), (80.0, 16.0, 0.0, 0.0, 0.0), (80.0, 6.0, 0.0, 0.1, 0.0), (60.0, 0.0, 0.0, 0.0, 0.2)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    args = [F.col(c) for c in "abcde"]
    assert [r[0] for r in df.select(scores.cardiovascular(*args)).collect()] == [2, 4, 3, 4]
    assert df.select(scores.cardiovascular(*args, strict=True)).first()[0] == 0


def state_rows(spark, rows):
    return spark.createDataFrame(rows, f'{STAY} bigint, hour bigint, MAP double, `vasoactive/inotropic` int, Lactate double')


def test_annotation(spark):
    df = state_rows(
        spark,
        [(1, 0, 70.0, 0, 1.1), (2, 0, 60.0, 0, 2.0), (3, 0, 60.0, 0, 1.0), (4, 0, 70.0, 1, 2.0), (4, 1, 70.0, 0, 1.0),
         (5, 0, 60.0, 0, 2.0), (5, 2, 70.0, 0, 1.0)],
    )
    got = {(r[STAY], r.hour): r.Annotation for r in labels.annotate_states(df).collect()}
    assert got == {
        (1, 0): "no_circ", (2, 0): "circ", (3, 0): "ambiguous", (4, 0): "circ", (4, 1): "circ",
        (5, 0): "circ", (5, 2): "no_circ",
    }


@pytest.mark.parametrize("block", [1, 5, 672])
def test_outlook(spark, block):
    df = spark.range(20).select(F.lit(1).cast("bigint").alias(STAY), F.col("id").alias("hour"), F.when(F.col("id") == 12, "circ").otherwise("no_circ").alias("Annotation"))
    got = {r.hour: r.Shock_next_12h for r in labels.label_next12h(df, block).collect()}
    assert got == {h: int(h < 12) for h in range(20)}


def test_antibiotic_hours_do_not_fan_out(spark):
    intake = spark.createDataFrame([(1, 60, "x", "intake"), (1, 61, "x", "intake"), (1, 200, "y", "intake")], f"{STAY} bigint, intakeoutputoffset bigint, celllabel string, cellpath string")
    flags = diagnosis.label_hours(intake, ["x"], "given")
    grid = hours.hour_grid(stay_table(spark, [(1, 3)]))
    out = diagnosis.attach_flags(grid, flags, [STAY, "hour"], ["given"])
    assert sorted((r.hour, r.given) for r in out.collect()) == [(0, 0), (1, 1), (2, 0)]


def test_lost_columns_are_reported(spark):
    df = spark.createDataFrame([(1.0, 2.0, 70.0)], "`Dopamine (mg)` double, `Dopamine (ml)` double, weight double")
    totals, lost = units.drug_totals(df)
    assert lost == ["Dopamine (mg)"]
    assert totals.select(F.col("`Dopamine (MG)`")).first()[0] == pytest.approx(2 * 1.26 / 1000)


def test_si_units(spark):
    df = spark.createDataFrame([(6.0, 60.0)], "`Dopamine (mg)_rate` double, weight double")
    published, _ = units.drug_totals(df)
    corrected, _ = units.drug_totals(df, si=True)
    name = "`Dopamine (MCG/KG/MIN)_Rate`"
    assert published.select(name).first()[0] == pytest.approx(6000.0)
    assert corrected.select(name).first()[0] == pytest.approx(6 * 1000 / 60 / 60)


def test_impute_absent_column(spark):
    df = spark.createDataFrame([(None, 51.0)], "Lactate double, Temperature double")
    row = impute.default_impute(impute.null_above(df)).first()
    assert (row.Lactate, row.Lactate_fillna, row.Temperature, row.Temperature_fillna, row.pH) == (1.1, 1, 36.5, 1, 7.0)


@pytest.mark.parametrize("rate_zero, rate", [(False, 7.0), (True, 0.0)])
def test_infusion_rates(spark, rate_zero, rate):
    from bedhour.plans.dataset import event_streams

    ing = spark.createDataFrame(
        [(1, 5, "d", 1, 3, 2.0, 7.0)],
        f"{STAY} bigint, los bigint, drugname string, start_hour bigint, stop_hour bigint, amount double, infusionrate double",
    )
    wide = tabular.tabularize(stay_table(spark, [(1, 5)]), event_streams({"ing": ing}, rate_zero), labels={"ing": ["d"]})
    got = {r.hour: (r["ing__d"], r["rate__d"]) for r in wide.collect()}
    assert got == {0: (0.0, 0.0), 1: (2.0, rate), 2: (2.0, rate), 3: (0.0, 0.0), 4: (0.0, 0.0)}


@pytest.mark.parametrize("si", [False, True])
def test_factor_table_equals_the_column_rules(spark, si):
    """Labels of every rule, both families, any hours: the totals of the long
    table are those of the wide one."""
    from bedhour.operators import channels, factors

    drugs = ["Norepinephrine", "Epinephrine", "Dopamine", "Dobutamine", "Phenylephrine", "Vasopressin", "Labetalol", "Milrinone"]
    drugs = [f"{x} ({u})" for x in drugs for u in ("ml", "mcg", "mcg/kg", "mg", "ml/hr")] + ["Labetalol(mg)", "Norepinephrine STD (mcg)", "Nore STD (ml)"]
    other = ["Insulin (ml)", "Insulin X (mcg)", "Heparin (ml)", "Heparin flush", "Enteral Nutrition", "NaCl 0.9%", "NaCl 5%", "Dextrose 10%", "Water"]
    rng = random.Random(8)
    los = {1: 40, 2: 25, 3: 30}
    rows = []
    for _ in range(900):
        s, lab = rng.choice([1, 2, 3]), rng.choice(drugs + other)
        h = rng.randrange(los[s])
        rows.append((s, los[s], lab, h, min(h + rng.randint(1, 6), los[s]), float(rng.randint(0, 50)), rng.choice([None, float(rng.randint(1, 9))])))
    ing = spark.createDataFrame(rows, f"{STAY} bigint, los bigint, label string, start_hour bigint, stop_hour bigint, amount double, speed double")
    med = ing.where("label in ('Dopamine (ml)', 'NaCl 0.9%', 'Heparin (ml)')").withColumn("label", F.concat(F.lit("med_"), "label"))
    streams = {"med": Stream(med, "interval", {"med": "amount"}), "ing": Stream(ing, "interval", {"ing": "amount", "rate": "speed"})}
    stays = spark.createDataFrame([(1, 40, 70.0), (2, 25, 0.0), (3, 30, None)], f"{STAY} bigint, los bigint, weight double")
    wide = channels.merge_channels(tabular.tabular_output(tabular.tabularize(stays, streams, static=["weight"])))
    wide = units.group_sums(units.drug_totals(wide, si)[0])
    table = factors.default_factors(spark, si)
    names = [r[0] for r in table.select("total").distinct().collect()]
    got = {(r[STAY], r.hour, r.total): r.value for r in factors.hourly_totals(tabular.long_table(streams), stays, table).collect()}
    assert {k[2] for k in got} == set(names)
    for r in wide.collect():
        for name in names:
            assert got.get((r[STAY], r.hour, name), 0.0) == pytest.approx(r[name]), (r[STAY], r.hour, name)


def test_new_drugs_need_no_longer_plan(spark):
    from bedhour.operators import factors

    def size(n):
        rows = [(1, "ing", f"Drug{i} (ml)", 0, 2, 1.0) for i in range(n)]
        long = spark.createDataFrame(rows, f"{STAY} bigint, family string, label string, hour bigint, until bigint, value double")
        mine = spark.createDataFrame([(0, "drug", None, False, "(ml)", None, None, "all", 2.0, 0)], factors.SCHEMA)
        out = factors.hourly_totals(long, spark.createDataFrame([(1, 50.0)], f"{STAY} bigint, weight double"), mine)
        assert {(r.hour, r.value) for r in out.collect()} == {(0, 2.0 * n), (1, 2.0 * n)}
        return len(out._jdf.queryExecution().analyzed().toString())

    assert abs(size(2) - size(300)) < 100


def test_rates_are_not_volumes(spark):
    df = spark.createDataFrame(
        [(1.0, 100.0, 2.0, 50.0, 70.0)],
        "`Dextrose 10%` double, `Dextrose 10%_rate` double, `Enteral Nutrition` double, `Enteral Nutrition_rate` double, weight double",
    )
    sums = units.group_sums(df)
    row = sums.first()
    assert (row["Dextrose n% (sum)"], row["Nutrition (ml)"]) == (1.0, 2.0)
    assert not [c for c in sums.columns if c.endswith("_rate")]
    assert impute.fluids_total(sums).first()["Fluids(ml)"] == 3.0


def test_prefix_lists_of_any_length(spark):
    import time

    from bedhour.operators import diagnosis

    codes = [f"{a}{i:04d}" for a in "ABCDE" for i in range(1000)]
    df = spark.createDataFrame([("A0001x",), ("A000",), ("E999",), ("E19999",), ("F0001",)], "icd10 string")
    start = time.perf_counter()
    found = df.withColumn("hit", diagnosis.starts_with_any("icd10", [*codes, "E.99", "F'\\"]))
    found.schema
    assert time.perf_counter() - start < 2
    assert {r.icd10: r.hit for r in found.collect()} == {"A0001x": True, "A000": False, "E999": True, "E19999": False, "F0001": False}


def test_a_list_of_any_length_stays_a_table(spark):
    """200,000 prefixes: nothing is collected and no list gets into the plan."""
    from bedhour.operators import diagnosis

    listed = spark.range(200_000).select(
        (F.col("id") % 2 + 9).cast("int").alias("icd_version"), F.concat(F.lit("Q."), F.lpad(F.col("id").cast("string"), 6, "0")).alias("icd_code")
    )
    rows = [(1, "Q000002", "Q000003x"), (2, "Q000003", "Q000002"), (3, "Q00", "I21.1"), (4, None, "J931"), (4, "Q199998zz", "x"), (5, "", "S")]
    codes = spark.createDataFrame(rows, f"{STAY} bigint, icd9 string, icd10 string")
    spark.sparkContext.setJobGroup("listing", "a list becomes a table")
    prefixes, names = diagnosis.prefix_table(diagnosis.infection_prefixes(listed))
    flags = diagnosis.stay_flags_by_table(codes, prefixes, names)
    assert len(flags._jdf.queryExecution().analyzed().toString()) < 40_000
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {r[STAY]: (r.suspected_infection, r.Acute_Myocardial_Infarction, r.Tension_Pneumothorax, r.hypovolemia_external) for r in flags.collect()}
    assert got == {1: (1, 0, 0, 0), 2: (0, 0, 0, 0), 3: (0, 1, 0, 0), 4: (1, 0, 1, 0), 5: (0, 0, 0, 1)}


@pytest.mark.parametrize("swapped", [False, True])
def test_prefix_table_equals_the_conditions(spark, swapped):
    from bedhour.operators import diagnosis

    rng = random.Random(5)
    rows = [(s, rng.choice(["38", "41x", "9", None]), rng.choice("IJGST805") + str(rng.randint(10, 99)) + rng.choice(["", "4", "48"])) for s in range(300) for _ in range(2)]
    codes = spark.createDataFrame(rows, f"{STAY} bigint, icd9 string, icd10 string")
    listed = spark.createDataFrame([(9, "38, 4."), (10, "I.44,I45 ,"), (11, "J")], "icd_version int, icd_code string")
    groups = diagnosis.diagnosis_groups(swapped, ["38", "4"], ["I44", "I45"])
    prefixes, names = diagnosis.prefix_table(diagnosis.infection_prefixes(listed), swapped)
    assert names == list(groups)
    by_table = diagnosis.stay_flags_by_table(codes, prefixes, names).orderBy(STAY).collect()
    assert by_table == diagnosis.stay_flags(codes, groups).select(STAY, *names).orderBy(STAY).collect()


def test_published_mode(spark):
    """Rates of 0, and a score of 2 at a mean pressure of 80 without any drug."""
    from bedhour.operators import scores
    from bedhour.plans import MODES

    df = spark.createDataFrame([(80.0, 0.0)], "MAP double, `Dopamine (MCG/KG/MIN)_Rate` double")
    assert MODES["published"].rate_zero and not MODES["corrected"].rate_zero
    got = {m: scores.sofa_score(df, rules.strict_cardio).first()["Sofa_Cardiovascular"] for m, rules in MODES.items()}
    assert got == {"published": 2, "corrected": 0}
