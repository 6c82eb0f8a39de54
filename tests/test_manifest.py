"""Stages that know what they were made from, and what their write saw."""

import gzip

import pytest
from pyspark.sql import functions as F

from bedhour import STAY
from bedhour.operators import joins
from bedhour.operators.diagnosis import infection_codes
from bedhour.operators.select import dictionary_map
from bedhour.plans.run import DICTIONARY_FILES, main, run
from bedhour.sources import RAW_SCHEMAS, Stages, file_position, frequent_keys_of, hadoop_path, manifest, read_dictionary, read_observed, read_table, write_stage
from bedhour.testbed import adapter as A


@pytest.fixture
def numbers(spark, tmp_path):
    path = str(tmp_path / "numbers.parquet")
    spark.range(100).select(F.col("id"), (F.col("id") % 7).alias(STAY)).write.parquet(path)
    return path


def two_stages(spark, run_name, path, least=10, other=3):
    """A stage, one that depends on it through an unnamed one, and one that does not."""
    stages = Stages(spark, run_name)
    a = stages.write(spark.read.parquet(path).where(F.col("id") >= least), "a")
    between = write_stage(a.groupBy(STAY).count())
    b = stages.write(between.join(a, STAY), "b")
    c = stages.write(spark.read.parquet(path).where(F.col("id") < other), "c")
    return stages, a, b, c


def test_a_run_goes_on_where_it_was(spark, numbers):
    first, *_ = two_stages(spark, "goes-on", numbers)
    assert first.history == {"a": "new", "b": "new", "c": "new"}
    again, a, b, c = two_stages(spark, "goes-on", numbers)
    assert again.history == {"a": "reused", "b": "reused", "c": "reused"}
    assert (a.count(), b.count(), c.count()) == (90, 90, 3) and again.observed["a"]["rows"] == 90
    again.remove()
    files, at = hadoop_path(spark, again.folder)
    assert not files.exists(at)


def test_a_changed_option_reaches_what_depends_on_it(spark, numbers):
    two_stages(spark, "options", numbers)
    stages, a, b, c = two_stages(spark, "options", numbers, least=50)
    assert stages.history == {"a": "plan", "b": "inputs", "c": "reused"}
    assert (a.count(), b.count()) == (50, 50)
    stages, *_, c = two_stages(spark, "options", numbers, least=50, other=5)
    assert stages.history == {"a": "reused", "b": "reused", "c": "plan"} and c.count() == 5
    stages.remove()


def test_a_changed_input_reaches_everything(spark, numbers):
    two_stages(spark, "inputs", numbers)
    spark.range(200).select(F.col("id"), (F.col("id") % 7).alias(STAY)).write.mode("overwrite").parquet(numbers)
    stages, a, b, c = two_stages(spark, "inputs", numbers)
    assert stages.history == {"a": "inputs", "b": "inputs", "c": "inputs"}
    assert (a.count(), b.count(), c.count()) == (190, 190, 3)
    stages.remove()


def test_changed_code_and_settings(spark, numbers, monkeypatch):
    two_stages(spark, "code", numbers)
    monkeypatch.setattr(manifest, "code_version", lambda: "another")
    assert two_stages(spark, "code", numbers)[0].history == {"a": "code", "b": "code, inputs", "c": "code"}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stages = two_stages(spark, "code", numbers)[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert stages.history["a"] == "settings"
    stages.remove()


def test_a_stage_that_lost_a_file_is_written_again(spark, numbers):
    stages, *_ = two_stages(spark, "torn", numbers)
    files, at = hadoop_path(spark, stages.path("a"))
    part = next(p for p in spark.read.parquet(stages.path("a")).inputFiles())
    files.delete(hadoop_path(spark, part)[1], False)
    again, a, *_ = two_stages(spark, "torn", numbers)
    assert again.history["a"] == "new" and a.count() == 90
    again.remove()


def test_tables_in_memory_count_by_their_rows(spark):
    def history(rows):
        stages = Stages(spark, "memory")
        stages.write(spark.createDataFrame(rows, "a int, b string"), "m")
        return stages.history["m"], stages

    assert history([(1, "x")])[0] == "new"
    assert history([(1, "x")])[0] == "reused"
    changed, stages = history([(1, "y")])
    assert changed == "inputs"
    stages.remove()


# Frequent keys


def hot_stage(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).cast("bigint").alias(STAY), "id")
    return Stages(spark).write(rows, "facts")


def test_frequent_keys_are_known_from_the_write(spark, monkeypatch):
    facts = hot_stage(spark)
    kept = facts.where(F.col("id") % 2 == 0).select(STAY, F.lit(1).alias("one"))
    found = frequent_keys_of(kept.unionByName(kept), [STAY])
    hash_of_1 = spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint"))).first()[0]
    assert found[hash_of_1] == 6000
    assert frequent_keys_of(kept, ["one"]) is None
    monkeypatch.setattr(joins, "frequent_keys", lambda on: pytest.fail("counted again"))
    keyed = spark.range(9_000).select(F.col("id").alias(STAY), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.balanced_join(facts, keyed, STAY, rows_per_task=500)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 9_000 and max(sizes) < 2 * 9_000 / 4
        plain = joins.balanced_join(facts, keyed, STAY)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "_salt" not in plain._jdf.queryExecution().analyzed().toString()


def test_no_job_runs_while_a_join_is_planned(spark):
    rows = spark.range(100).select(F.lit(1).cast("bigint").alias(STAY), "id")
    keyed = spark.range(5).select(F.col("id").alias(STAY))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup("planning", "a join is planned")
    try:
        joined = joins.balanced_join(rows, keyed, STAY, rows_per_task=10)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 100


def test_equal_rows_of_a_hot_key_travel_as_one(spark):
    rows = spark.range(5_000).select(F.lit("hot").alias("label"), F.lit(1.0).alias("v"))
    keyed = spark.createDataFrame([("hot", 2.0), ("b", 3.0)], "label string, lo double")
    joined = joins.salted_join(rows, keyed, ["label"], "left", rows_per_task=100, equal_rows=True)
    assert joined.columns == ["label", "v", "lo"]
    assert joined.groupBy(*joined.columns).count().collect() == [("hot", 1.0, 2.0, 5_000)]


# Buckets


def bucketed_stages(spark, run_name=None, rows=9_000):
    stages = Stages(spark, run_name, buckets=6)
    facts = spark.range(rows).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias(STAY), "id")
    facts = stages.write(facts, "facts", by_stay=True)
    keyed = stages.write(spark.range(rows).select(F.col("id").alias(STAY), (F.col("id") * 2).alias("x")), "keyed", by_stay=True)
    return stages, facts, keyed


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_bucketed_stages_join_without_a_shuffle(spark, how):
    _, facts, keyed = bucketed_stages(spark)
    some = keyed.where(F.col("x") % 4 == 0)
    kept = facts.where(F.col("id") > 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.balanced_join(kept, some, STAY, how)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        apart = joins.balanced_join(kept, some, STAY, how, rows_per_task=500)
        plan = apart._jdf.queryExecution().executedPlan().toString()
        # Only the hot rows are dealt anew; the others are joined bucket by bucket.
        assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        plain = sorted(map(str, kept.join(some, STAY, how).collect()))
        assert sorted(map(str, joined.collect())) == sorted(map(str, apart.collect())) == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_stay_is_written_and_joined_by_several_tasks(spark, monkeypatch):
    from bedhour.sources import sinks

    monkeypatch.setattr(sinks, "HOT_ROWS", 500)
    first = Stages(spark).write(spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias(STAY), "id"), "raw")
    stages = Stages(spark, buckets=6)
    facts = stages.write(first, "facts", by_stay=True)
    keyed = stages.write(spark.range(9_000).select(F.col("id").alias(STAY)), "keyed", by_stay=True)
    assert facts.where(F.col(STAY) == 1).select(F.input_file_name()).distinct().count() > 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge such small partitions
    try:
        joined = joins.balanced_join(facts, keyed, STAY, rows_per_task=500)
        tasks = joined.where(F.col(STAY) == 1).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 3_001 and len(tasks) > 1 and joined.count() == 9_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_stages_are_reused(spark):
    first, facts, keyed = bucketed_stages(spark, "in-buckets")
    n = facts.join(keyed, STAY).count()
    from bedhour.sources.sinks import table_name

    for name in ("facts", "keyed"):  # as in another session
        spark.sql(f"DROP TABLE {table_name(first.path(name))}")
    again, facts, keyed = bucketed_stages(spark, "in-buckets")
    assert set(again.history.values()) == {"reused"} and facts.join(keyed, STAY).count() == n
    assert bucketed_stages(spark, "in-buckets", 90)[0].history == {"facts": "inputs, plan", "keyed": "inputs, plan"}
    again.remove()


# Observed reads, folders of files, order over several files


def lab_files(folder, parts):
    folder.mkdir()
    for i, rows in enumerate(parts):
        with gzip.open(folder / f"part-{i}.csv.gz", "wt") as f:
            f.write("labid,patientunitstayid,labresultoffset,labresult,labname,labmeasurenamesystem\n" + "".join(r + "\n" for r in rows))


def test_unreadable_values_are_counted(spark, tmp_path):
    lab_files(tmp_path / "lab.csv.gz", [["1,x7,5,3,a,", "2,8,late,3,a,", "3,,99999999,OFF,a,"], ["4,8,-3,,a,", ",8,1.5,,a,"]])
    table, seen = read_observed(spark, str(tmp_path / "lab.csv.gz"), "lab")
    stages = Stages(spark)
    rows = stages.write(table, "source-lab", observations=[seen])
    counts = {k: v for k, v in stages.observed["source-lab"].items() if isinstance(v, int) and v}
    assert counts == {"read": 5, "rows": 5, "bad patientunitstayid": 1, "bad labresultoffset": 2, "far labresultoffset": 1}
    assert sorted(rows.toPandas().labid.fillna(0)) == [0, 1, 2, 3, 4]


def test_a_folder_of_gzipped_parts_is_read_in_parallel(spark, tmp_path):
    lab_files(tmp_path / "lab.csv.gz", [[f"{i},1,1,1,a," + "x" * 50] * 3 for i in range(6)])
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        table = read_table(spark, str(tmp_path / "lab.csv.gz"), "lab")
        assert table.rdd.getNumPartitions() > 2 and table.count() == 18
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_dictionary_of_several_files(spark, tmp_path):
    """The last entry counts, in order of file names and lines, however the files are cut."""
    folder = tmp_path / "names.csv"
    folder.mkdir()
    want = {}
    for i in range(3):
        lines = [(f"l{n % 40}", f"{i}-{n}") for n in range(400)]
        want |= dict(lines)
        (folder / f"part-{i}.csv").write_text("itemstring,altername\n" + "".join(f"{a},{b}\n" for a, b in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        names = read_dictionary(spark, str(folder))
        assert names.rdd.getNumPartitions() > 3
        got = {r.itemstring: r.altername for r in dictionary_map(names).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


def test_first_infection_row_of_a_file(spark, tmp_path):
    (tmp_path / "codes.csv").write_text('icd_version,icd_code\n9,"38, 4"\n10,I44\n9,5\n')
    codes = spark.read.option("header", True).csv(str(tmp_path / "codes.csv")).withColumn("position", file_position())
    assert infection_codes(codes, first_row_only=True) == (["38", "4"], ["I44"])


# The whole run


@pytest.fixture(scope="module")
def raw_folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("files")
    raw = A.raw_tables(spark, "/root/testdata/sf0.001")
    for name in RAW_SCHEMAS:
        raw[name].write.option("header", True).csv(str(at / "raw" / f"{name}.csv"))
    (at / "names").mkdir()
    for file in set(DICTIONARY_FILES.values()):
        pairs = [p for f, of in DICTIONARY_FILES.items() if of == file for p in A.DICTIONARIES[f]]
        (at / "names" / file).write_text("itemstring,altername\n" + "".join(f'"{a}","{b}"\n' for a, b in pairs))
    (at / "names" / "suspected_infection.csv").write_text("icd_version,icd_code\n10,I44\n")
    return at


def test_a_run_with_other_options_does_over_what_they_reach(spark, raw_folder):
    out, reports = str(raw_folder / "out"), str(raw_folder / "reports")

    def history(*options):
        main([str(raw_folder / "raw"), str(raw_folder / "names"), out, "--suffix", ".csv", "--run", "kept", "--keep-stages", "--reports", reports, *options], spark)
        return spark.read.parquet(out).count()

    def stages(**options):
        return run(spark, str(raw_folder / "raw"), str(raw_folder / "names"), out, ".csv", "kept", keep_stages=True, **options)

    n = history()
    longest = spark.read.parquet(out).agg(F.max("Time_since_ICU_admission")).first()[0]
    assert spark.read.json(f"{reports}/counts").first()["rows"] == n
    table = spark.read.parquet(out)
    assert spark.read.json(f"{reports}/counts").first()["stays"] == table.select(STAY).distinct().count()
    pairs = {(r.Annotation, r.Shock_next_12h): r["rows"] for r in spark.read.json(f"{reports}/transitions").collect()}
    assert pairs == {(r.Annotation, r.Shock_next_12h): r["count"] for r in table.groupBy("Annotation", "Shock_next_12h").count().collect()}
    read = {r.table: r.value for r in spark.read.json(f"{reports}/sources").where("counter = 'read'").collect()}
    assert read["lab"] == spark.read.option("header", True).csv(str(raw_folder / "raw" / "lab.csv")).count()

    in_buckets = run(spark, str(raw_folder / "raw"), str(raw_folder / "names"), str(raw_folder / "out2"), ".csv", buckets=3)
    assert "stays" in in_buckets.history
    hashed = lambda p: spark.read.parquet(p).select(F.xxhash64(F.to_json(F.struct("*"))).alias("h")).orderBy("h").collect()
    assert hashed(str(raw_folder / "out2")) == hashed(out)

    same = stages()
    assert set(same.history.values()) == {"reused"}
    from bedhour.plans.stages import Outliers

    other = stages(clean_lab=Outliers(10, 90))
    rewritten = {k for k, v in other.history.items() if v != "reused"}
    assert "events-lab" in rewritten and "cells" in rewritten
    assert not rewritten & {"cohort", "selected-lab", "events-chart", *(k for k in other.history if k.startswith(("source-", "raw-")))}
    lab = spark.read.option("header", True).csv(str(raw_folder / "raw" / "lab.csv")).where("labid % 2 = 0")
    write_stage(lab, str(raw_folder / "half"))
    spark.read.parquet(str(raw_folder / "half")).write.mode("overwrite").option("header", True).csv(str(raw_folder / "raw" / "lab.csv"))
    new_lab = stages(clean_lab=Outliers(10, 90), min_hours=longest + 1)
    assert new_lab.history["stays"] != "reused" and 0 < spark.read.parquet(out).count() < n
    assert new_lab.history["source-lab"] == "inputs" and new_lab.history["events-lab"] == "inputs" and new_lab.history["cells"] != "reused"
    assert new_lab.history["source-patient"] == new_lab.history["events-chart"] == "reused"
    new_lab.remove()
