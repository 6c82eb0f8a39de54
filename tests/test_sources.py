"""Raw files in, stages out."""

import gzip

from pyspark.sql import functions as F

from bedhour import STAY
from bedhour.plans.run import DICTIONARY_FILES, main
from bedhour.sources import RAW_SCHEMAS, Stages, hadoop_path, read_dictionary, read_raw, read_table, shared_folder, write_stage
from bedhour.operators.diagnosis import infection_codes
from bedhour.plans import final_dataset
from bedhour.testbed import adapter as A


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "lab.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write('labname,extra,patientunitstayid,labid,labresultoffset,labresult,labmeasurenamesystem\n"a, b",x,7,1,-5,3.5,\n')
    row = read_table(spark, str(path), "lab").first()
    assert (row.labid, row[STAY], row.labresultoffset, row.labresult, row.labname, row.labmeasurenamesystem) == (1, 7, -5, "3.5", "a, b", None)


def test_nan_is_missing(spark, tmp_path):
    path = tmp_path / "intakeOutput.csv"
    path.write_text("patientunitstayid,intakeoutputoffset,cellpath,celllabel,cellvaluenumeric\n1,2,p,l,NaN\n1,2,p,l,4\n")
    assert sorted(r.cellvaluenumeric is None for r in read_table(spark, str(path), "intakeOutput").collect()) == [False, True]


def test_dictionary_order(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("itemstring,altername\na,1\nb,2\na,3\n")
    rows = read_dictionary(spark, str(path)).orderBy("position").collect()
    assert [(r.itemstring, r.altername) for r in rows] == [("a", "1"), ("b", "2"), ("a", "3")]


def test_stage_goes_to_the_named_folder(spark):
    df = spark.range(100).select((F.col("id") % 7).alias(STAY), "id")
    back = write_stage(df, cluster_by=[STAY])
    assert back.count() == 100 and back.columns == df.columns
    assert back.inputFiles()[0].startswith("file:" + ("//" if "file:///" in back.inputFiles()[0] else "") + shared_folder(spark))


def test_infection_list_of_several_rows(spark):
    rows = [(9, "38, 4"), (10, "I44"), (9, "5"), (10, "I45, I46"), (11, "x"), (10, None)]
    codes = spark.createDataFrame(rows, "icd_version int, icd_code string").coalesce(1)
    assert tuple(map(sorted, infection_codes(codes))) == (["38", "4", "5"], ["I44", "I45", "I46"])
    assert infection_codes(codes, first_row_only=True) == (["38", "4"], ["I44"])


def test_command_line(spark, tmp_path):
    """Every switch is read, the output and reports are written, the stages go."""
    raw = A.raw_tables(spark, "/root/testdata/sf0.001")
    for name in RAW_SCHEMAS:
        raw[name].write.option("header", True).csv(str(tmp_path / "raw" / f"{name}.csv"))
    folder = tmp_path / "names"
    folder.mkdir()
    for file in set(DICTIONARY_FILES.values()):
        pairs = [p for f, of in DICTIONARY_FILES.items() if of == file for p in A.DICTIONARIES[f]]
        (folder / file).write_text("itemstring,altername\n" + "".join(f'"{a}","{b}"\n' for a, b in pairs))
    (folder / "suspected_infection.csv").write_text("icd_version,icd_code\n10,I44\n")
    out = str(tmp_path / "out")
    main([str(tmp_path / "raw"), str(folder), out, "--suffix", ".csv", "--run", "cli-test", "--mode", "published", "--clean-chart",
          "--chart-percentiles", "1", "99", "--lab-impute", "--min-hours", "30", "--reports", str(tmp_path / "reports")], spark)
    table = spark.read.parquet(out)
    assert table.count() > 0 and "Arrhythmia" not in table.columns
    assert spark.read.json(str(tmp_path / "reports" / "counts")).first()["rows"] == table.count()
    assert spark.read.json(str(tmp_path / "reports" / "transitions")).count() > 0
    files, at = hadoop_path(spark, Stages(spark, "cli-test").folder)
    assert not files.exists(at)


def test_files_to_final_table(spark, tmp_path):
    """The whole way from CSV files, as the command line does it."""
    raw = A.raw_tables(spark, "/root/testdata/sf0.001")
    for name in RAW_SCHEMAS:
        raw[name].write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    for family, pairs in A.DICTIONARIES.items():
        lines = "".join(f'"{a}","{b}"\n' for a, b in pairs)
        (tmp_path / f"names_{family}.csv").write_text("itemstring,altername\n" + lines)
    (tmp_path / "codes.csv").write_text('icd_version,icd_code\n9,"38, 4"\n10,I44\n')
    codes = infection_codes(spark.read.option("header", True).csv(str(tmp_path / "codes.csv")))
    assert codes == (["38", "4"], ["I44"])
    names = {f: read_dictionary(spark, str(tmp_path / f"names_{f}.csv")) for f in DICTIONARY_FILES}
    options = dict(infection_codes=codes, crystalloid_label="c2", antibiotics=["c1"], cultures=["t5"])
    out = final_dataset(read_raw(spark, str(tmp_path), ".csv"), names, **options)
    direct = final_dataset(raw, A.dictionaries(spark), **options)
    plan = direct._jdf.queryExecution().optimizedPlan().toString()
    assert "event_id" not in plan  # nothing is read from the raw tables any more
    cols = [STAY, "Time_since_ICU_admission", "MAP", "Lactate", "SoFa_score", "Annotation", "Shock_next_12h", "Antibiotics"]
    quoted = [f"`{c}`" for c in cols]
    assert sorted(map(str, out.select(*quoted).collect())) == sorted(map(str, direct.select(*quoted).collect()))
    assert out.count() > 0
