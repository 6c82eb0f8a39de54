"""Properties that must hold at any size: row counts, block independence, hot
keys, and the shape of the plans."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bedhour import STAY
from bedhour.operators import clean, hours, joins, labels, tabular
from bedhour.operators.tabular import Stream
from bedhour.session import METHOD_LIMIT


@pytest.fixture(scope="module")
def events(spark):
    """Random cells; stay 0 is long and holds a third of all rows."""
    rng = random.Random(7)
    los = {0: 400, **{s: rng.randint(1, 60) for s in range(1, 30)}}
    rows = []
    for _ in range(3000):
        s = 0 if rng.random() < 0.34 else rng.randint(1, 29)
        h = rng.randrange(los[s])
        rows.append((s, los[s], rng.choice(["ABPs", "ABPd", "MAP", "ECMO"]), h, min(h + rng.randint(1, 9), los[s]), float(rng.randint(1, 99))))
    schema = f"{STAY} bigint, los bigint, label string, hour bigint, stop_hour bigint, value double"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(list(los.items()), f"{STAY} bigint, los bigint")


def streams_of(rows):
    med = rows.where("label <> 'MAP'").withColumnRenamed("hour", "start_hour")
    return {
        "chart": Stream(rows, "hold", {"chart": "value"}),
        "med": Stream(med, "interval", {"med": "value"}),
        "proc": Stream(rows, "flag", {"proc": "label"}),
        "out": Stream(rows, "hourly", {"out": "value"}),
    }


def brute(rows, stays):
    """The wide table, one cell at a time."""
    pdf, los = rows.toPandas(), stays.toPandas().set_index(STAY)["los"].to_dict()
    out = {}
    for s, n in los.items():
        mine = pdf[pdf[STAY] == s]
        for h in range(n):
            cell = {}
            for lab in ("ABPs", "ABPd", "MAP", "ECMO"):
                of = mine[mine.label == lab]
                now = of[of.hour == h]
                past = of[of.hour <= h]
                last = past[past.hour == past.hour.max()].value.mean() if len(past) else None
                cell[f"out__{lab}"] = now.value.mean() if len(now) else 0.0
                cell[f"proc__{lab}"] = float(len(now) > 0)
                cell[f"chart__{lab}"] = last
                if lab == "ECMO":
                    cell[f"chart__{lab}"] = float(len(now) > 0) if len(of) else None
                if lab != "MAP":
                    latest = past[past.hour == past.hour.max()]
                    on = len(past) and latest.stop_hour.mean() > h
                    cell[f"med__{lab}"] = latest.value.mean() if on else 0.0
            charted = mine[(mine.label == "MAP") & (mine.hour == h)]
            sys_, dia = cell["chart__ABPs"], cell["chart__ABPd"]
            derived = (sys_ + 2 * dia) / 3 if sys_ is not None and dia is not None else None
            cell["chart__MAP"] = charted.value.mean() if len(charted) else derived
            if not len(mine):
                cell = {k: 0.0 for k in cell}
            out[s, h] = cell
    return out


@pytest.mark.parametrize("block, halo", [(7, (0, 0)), (13, (1, 12)), (672, (1, 12))])
def test_tabularize_against_brute_force(spark, events, block, halo):
    rows, stays = events
    wide = tabular.tabular_output(tabular.tabularize(stays, streams_of(rows), block_hours=block, halo=halo)).toPandas()
    expected = brute(rows, stays)
    assert len(wide) == len(expected)
    assert not wide.duplicated([STAY, "hour"]).any()
    for r in wide.to_dict("records"):
        for k, v in expected[r[STAY], r["hour"]].items():
            got = None if pd.isna(r[k]) else r[k]
            assert (got is None) == (v is None) and (v is None or math.isclose(got, v)), (r[STAY], r["hour"], k, got, v)


def state_table(spark):
    rng = random.Random(3)
    rows = [
        (s, h, float(rng.randint(50, 80)), rng.randint(0, 1), rng.choice([1.0, 1.9, 2.0, 3.0]))
        for s, n in ((1, 100), (2, 13), (3, 1))
        for h in range(n)
        if rng.random() < 0.9
    ]
    return rows, spark.createDataFrame(rows, f"{STAY} bigint, hour bigint, MAP double, `vasoactive/inotropic` int, Lactate double")


@pytest.mark.parametrize("block", [5, 24, 672])
def test_labels_against_brute_force(spark, block):
    rows, df = state_table(spark)
    state = {}
    for s, h, *_ in rows:
        near = [r for r in rows if r[0] == s and h - 1 <= r[1] <= h]
        mean = sum(r[2] for r in near) / len(near)
        if mean > 65 and all(r[3] == 0 for r in near) and any(r[4] < 2 for r in near):
            state[s, h] = "no_circ"
        elif (mean <= 65 or any(r[3] == 1 for r in near)) and any(r[4] >= 2 for r in near):
            state[s, h] = "circ"
        else:
            state[s, h] = "ambiguous"
    expected = {
        k: (v, int(any(state.get((k[0], k[1] + i)) == "circ" for i in range(1, 13)))) for k, v in state.items()
    }
    got = {(r[STAY], r.hour): (r.Annotation, r.Shock_next_12h) for r in labels.label_states(df, block).collect()}
    assert got == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, events, how):
    rows, stays = events
    some = stays.where(F.col(STAY) % 3 != 1).withColumnRenamed("los", "l")
    plain = rows.join(some, [STAY], how)
    salted = joins.salted_join(rows, some, [STAY], how, rows_per_task=40)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_join_splits_a_hot_key(spark):
    hot = spark.range(10_000).select(F.lit(1).cast("bigint").alias(STAY), "id")
    keyed = spark.createDataFrame([(1, 5)], f"{STAY} bigint, los bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.balanced_join(hot, keyed, STAY, rows_per_task=500)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 10_000 and max(sizes) < 6_000


def test_lookup_join_beyond_the_broadcast_size(spark, events):
    rows, stays = events
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = stays.withColumnRenamed("los", "l")
        few = joins.lookup_join(rows, keyed, STAY, "left").count()
        many = joins.lookup_join(rows, keyed, STAY, "left", rows_per_task=100).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few == many == rows.count()


def test_only_hot_keys_are_salted(spark):
    """Equal rows of a hot key spread too, once something tells them apart."""
    rows = spark.range(9_000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).cast("bigint").alias(STAY), F.lit(7).alias("v"), "id")
    hot = spark.range(1).select(joins.hot_keys(rows, [STAY], 500), F.xxhash64(F.lit(1).cast("bigint"))).first()
    assert hot[0] == {hot[1]: 6}
    keyed = spark.range(9_000).select(F.col("id").alias(STAY), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(rows, keyed, [STAY], rows_per_task=500, spread=F.col("id"))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 9_000 and max(sizes) < 2 * 9_000 / 4


@pytest.mark.parametrize("parts", [clean.PARTS, 3, 1])
def test_percentiles_by_digits(spark, parts):
    rng = random.Random(11)
    rows = [("hot", round(rng.gauss(50, 20), 1)) for _ in range(6000)] + [("b", float(i)) for i in range(501)] + [("c", 4.0)] * 40
    rows += [("d", 1.0), ("e", 1.0), ("e", 2.0), ("f", float("inf")), ("f", 1.0), ("f", 3.0), ("h", -0.0), ("h", 0.0), ("h", -3.5)]
    rows += [("g", rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) * rng.random()) for _ in range(3000)]
    rows += [("i", 5e-324 * i) for i in range(100)] + [("j", 1.0 + i * 2.0**-52) for i in range(1000)] + [(None, 1.0), ("c", None)]
    df = spark.createDataFrame(rows, "label string, v double").repartition(5)
    got = {r.label: (r.n, r.lo, r.hi) for r in clean.percentile_bounds(df, "label", "v", parts=parts).collect()}
    assert got.pop("f")[0] == 3
    rows = [r for r in rows if r[0] not in ("f", None) and r[1] is not None]
    pdf = pd.DataFrame(rows, columns=["label", "v"])
    assert set(pdf.label) == got.keys()
    for label, g in pdf.groupby("label"):
        n, lo, hi = got[label]
        assert n == len(g)
        assert lo == pytest.approx(g.v.quantile(0.02)) and hi == pytest.approx(g.v.quantile(0.98))


def test_a_common_value_is_counted_before_any_shuffle(spark):
    df = spark.range(30_000).select(F.lit("hot").alias("label"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.rand(1)).alias("v"))
    plan = clean.percentile_bounds(df, "label", "v")._jdf.queryExecution().executedPlan().toString()
    lowest = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_count" in lowest and "Join" not in lowest


def test_codes_follow_sorted_order(spark):
    words = ["b", "ba", "a", "Z", "é", "a2", "b"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id bigint, w string")
    got = {r.w: r.code for r in tabular.label_codes(df, "w").collect()}
    ordered = sorted(set(words), key=lambda w: w.encode())
    assert got == {w: i for i, w in enumerate(ordered)}


def test_codes_that_start_alike_are_not_one_task(spark):
    df = spark.range(20_000).select(F.concat(F.lit("p123"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("w"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge such small ranges
    try:
        codes = tabular.label_codes(df, "w")
        ranges = [r["count"] for r in codes.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert codes.where("code <> cast(substring(w, 5) as int)").isEmpty()
    assert max(ranges) < 2 * 20_000 / 4


def test_many_labels(spark):
    """170 columns, and the same in long form."""
    rows = [(s, 60, f"l{k:03d}", (k * 7 + s) % 60, float(k)) for s in (1, 2) for k in range(170)]
    points = spark.createDataFrame(rows, f"{STAY} bigint, los bigint, label string, hour bigint, value double")
    stays = spark.createDataFrame([(1, 60), (2, 60)], f"{STAY} bigint, los bigint")
    streams = {"chart": Stream(points, "hold", {"chart": "value"})}
    wide = tabular.tabularize(stays, streams, store_cells=True)
    assert len([c for c in wide.columns if c.startswith("chart__")]) == 170 and wide.count() == 120
    table = wide.toPandas().set_index([STAY, "hour"])
    for r in tabular.long_table(streams).collect():
        for h in (r.hour, r.until - 1):
            assert table.loc[(r[STAY], h), f"chart__{r.label}"] == r.value


def test_long_form_of_intervals(spark):
    rows = [(1, 20, "a", 2, 9, 5.0, 1.0), (1, 20, "a", 6, 30, 7.0, 2.0), (1, 20, "b", 3, 3, 1.0, 1.0)]
    iv = spark.createDataFrame(rows, f"{STAY} bigint, los bigint, label string, start_hour bigint, stop_hour bigint, amount double, speed double")
    streams = {"ing": Stream(iv, "interval", {"ing": "amount", "rate": "speed"})}
    got = {(r.family, r.label, r.hour, r.until, r.value) for r in tabular.long_table(streams).collect()}
    assert got == {("ing", "a", 2, 6, 5.0), ("rate", "a", 2, 6, 1.0), ("ing", "a", 6, 20, 7.0), ("rate", "a", 6, 20, 2.0)}


def test_rows_outside_the_cohort_go_before_repeats_are_looked_for(spark):
    from bedhour.operators import extract

    nurse = spark.createDataFrame([(1, 1, 5, "ABPs", "3")] * 2 + [(2, 9, 5, "x", "3")], f"nursingchartid bigint, {STAY} bigint, nursingchartoffset bigint, nursingchartcelltypevallabel string, nursingchartvalue string")
    resp = spark.createDataFrame([], f"respchartid bigint, {STAY} bigint, respchartoffset bigint, respchartvaluelabel string, respchartvalue string")
    stays = spark.createDataFrame([("p", 1)], f"uniquepid string, {STAY} bigint")
    names = spark.createDataFrame([("ABPs",)], "itemstring string")
    out = extract.extract_chart(nurse, resp, stays, names)
    assert out.count() == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join")  # the join is below, so it runs first


def test_grid_of_a_very_long_stay(spark):
    stays = spark.createDataFrame([(1, 200_000), (2, 1), (3, 0)], f"{STAY} bigint, los bigint")
    grid = hours.hour_grid(stays)
    got = grid.groupBy(STAY).agg(F.count("*"), F.min("hour"), F.max("hour"), F.countDistinct("hour")).collect()
    assert sorted(map(tuple, got)) == [(1, 200_000, 0, 199_999, 200_000), (2, 1, 0, 0, 1)]


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_need_no_shuffle_of_their_own(spark, events):
    """Labels on a table with halo rows add no exchange to the tabularisation."""
    rows, stays = events
    wide = tabular.tabularize(stays, {"chart": Stream(rows, "hold", {"chart": "value"})}, labels={"chart": ["ABPs", "ABPd"]}, halo=(1, 12))
    inputs = wide.select(
        STAY, "block", "hour", "halo", F.col("chart__ABPs").alias("MAP"), F.lit(0).alias("vasoactive/inotropic"), F.lit(1.0).alias("Lactate")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        before = wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        after = labels.label_states(inputs)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert after == before


def test_clustered_write_spreads_a_hot_stay(spark):
    from bedhour.sources import write_stage

    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias(STAY), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge such small files
    back = write_stage(df, cluster_by=[STAY])
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = back.where(F.col(STAY) == 1).groupBy(F.input_file_name()).count().collect()
    assert back.count() == 20_000 and len(files) > 1


def test_the_shuffle_to_blocks_has_one_reader(spark, events):
    """What blocks need from earlier ones comes with the cells: the wide rows are
    shuffled once, pivoted once and joined with nothing but the stay's columns."""
    rows, stays = events
    wide = tabular.tabularize(stays, streams_of(rows), halo=(1, 12), block_hours=30)
    final = plan_of(wide).split("Initial Plan")[0]
    assert len([line for line in final.splitlines() if "REPARTITION_BY_NUM" in line]) == 1
    assert final.count("Pivot") <= 2 and final.count("Join") == 1


def test_what_blocks_get_from_earlier_ones(spark, events):
    """Values go to later blocks of the same stay only; every block learns which
    groups the stay has."""
    rows, stays = events
    cells = tabular.hourly_cells({"chart": Stream(rows, "hold", {"chart": "value"})})
    held = ["chart__ABPs", "chart__ABPd"]
    sent = tabular._sent_ahead(cells, held, {"_has": held}, 60, 1).collect()
    values = [r for r in sent if r.feature != "_has"]
    assert {r[STAY] for r in values} == {0} and {r.block for r in values} == set(range(1, 7))
    assert len(values) == len({(r.block, r.feature) for r in values}) == 12
    assert {(r[STAY], r.block) for r in sent if r.feature == "_has" and r[STAY]} == {(s, 0) for s in range(1, 30)}
    assert {r.block for r in sent if r.feature == "_has" and not r[STAY]} == set(range(7))


def test_methods_that_java_compiles(spark):
    """A wide table asks for methods that Java compiles, unless the session has a limit of its own."""
    rows = spark.createDataFrame([(1, 30, "a", 2, 5.0)], f"{STAY} bigint, los bigint, label string, hour bigint, value double")
    stays = spark.createDataFrame([(1, 30)], f"{STAY} bigint, los bigint")
    streams = {"chart": Stream(rows, "hold", {"chart": "value"})}
    before = spark.conf.get(METHOD_LIMIT)
    try:
        for own, then in (("65535", "8000"), ("20000", "20000")):
            spark.conf.set(METHOD_LIMIT, own)
            assert tabular.tabularize(stays, streams, labels={"chart": ["a"]}).count() == 30
            assert spark.conf.get(METHOD_LIMIT) == then
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def test_partitions_follow_the_hours(spark, monkeypatch):
    """Few cells that last for many hours are dealt to as many tasks as the hours ask for."""
    rows = spark.range(400).selectExpr(f"id as {STAY}", "200L as los", "'a' as label", "1L as hour", "1.0D as value")
    stays = spark.range(400).selectExpr(f"id as {STAY}", "200L as los").unionByName(
        spark.createDataFrame([(900, None), (901, -5)], f"{STAY} bigint, los bigint")
    )
    streams = {"chart": Stream(rows, "hold", {"chart": "value"})}
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(tabular, "HOUR_BYTES", 400 * 200 * 16 // (10 * few))
    wide = tabular.tabularize(stays, streams, store_cells=True)
    sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 * 200 and few < len(sizes) <= 10 * few
