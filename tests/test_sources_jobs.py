"""Sources, sinks, registry and the end-to-end jobs on a small sensor table."""

import pytest
from pyspark.sql import functions as F

from faultline.operators import registry, training
from faultline.plans import fixtures as fx
from faultline.plans import jobs
from faultline.sources import documents, files, reports
from faultline.spec import ColumnSpec
from tests.conftest import SF_CHECK


def test_preamble_csv_with_blank_lines(spark, tmp_uri):
    path = f"{tmp_uri}/raw.csv"
    with open(path, "w") as f:
        for i in range(10):
            f.write(f"preamble line {i}, with a comma\n")
            if i % 3 == 0:
                f.write("\n")
        for i in range(4):
            f.write(f"note {i}\n")
        f.write("class,aa_000,ab_000\n")
        f.write("neg,1,na\npos,na,3\n\nneg,5,6\n")
    df = files.read_preamble_csv(spark, path, header_line=14)
    assert df.columns == ["class", "aa_000", "ab_000"]
    assert sorted(tuple(r) for r in df.collect()) == [("neg", "1", None), ("neg", "5", "6"), ("pos", None, "3")]


def test_documents_roundtrip_counts(spark, tmp_uri):
    df = spark.range(12).select(F.col("id").cast("string").alias("aa_000"), F.lit("na").alias("ab_000"), F.lit(1).alias("_id"))
    n = documents.write_documents(df, f"{tmp_uri}/coll", batch_size=5)
    assert n == 12
    back = documents.read_documents(spark, f"{tmp_uri}/coll")
    assert back.count() == 12 and "_id" not in back.columns
    assert back.filter(F.col("ab_000").isNotNull()).count() == 0


def test_listed_collections_are_read_in_one_scan(spark, tmp_uri):
    df = spark.createDataFrame([("pos", 1, "na"), ("neg", 2, None), (None, 3, 'x"y')], "class string, aa_000 int, ab_000 string")
    assert documents.write_documents(df, f"{tmp_uri}/c", partition_by=["class"]) == 3
    back = documents.read_documents(spark, f"{tmp_uri}/c")
    assert back.columns == df.columns
    assert {tuple(r) for r in back.collect()} == {("pos", "1", None), ("neg", "2", None), (None, "3", 'x"y')}
    plan = back.filter("class = 'pos'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "= pos" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with open(f"{tmp_uri}/c/class=neg/broken.json", "w") as f:
        f.write("no record\n")
    assert [r["aa_000"] for r in documents.read_documents(spark, f"{tmp_uri}/c").filter("class = 'pos'").collect()] == ["1"]
    with pytest.raises(Exception, match="not a JSON object in .*broken.json"):  # read only where its folder is wanted
        documents.read_documents(spark, f"{tmp_uri}/c").collect()


def test_collection_edges(spark, tmp_uri):
    path = f"{tmp_uri}/c"
    one = spark.createDataFrame([("1", "2")], "a string, b string")
    documents.write_documents(one, path)
    documents.write_documents(one.withColumn("z", F.lit("9")), path, mode="append")  # a new column joins the list
    assert sorted(map(tuple, documents.read_documents(spark, path).fillna("").collect())) == [("1", "2", ""), ("1", "2", "9")]
    with pytest.raises(ValueError, match="partitioned"):
        documents.write_documents(one, path, mode="append", partition_by=["a"])
    documents.write_documents(one.limit(0), path)
    assert documents.read_documents(spark, path).columns == ["a", "b"] and documents.read_documents(spark, path).count() == 0
    for name, text, said in (("extra", '{"a": "1", "b": "2", "q": "3"}', "q in .*odd.json"), ("broken", '{"a": ', "not a JSON object")):
        documents.write_documents(one, f"{tmp_uri}/{name}")
        with open(f"{tmp_uri}/{name}/odd.json", "w") as f:
            f.write(text + "\n")
        with pytest.raises(Exception, match=said):
            documents.read_documents(spark, f"{tmp_uri}/{name}").collect()
    import os

    os.makedirs(f"{tmp_uri}/foreign")  # no list: columns come from the records
    with open(f"{tmp_uri}/foreign/x.json", "w") as f:
        f.write('{"_id": 1, "a": 2}\n{"a": "na", "b": 3.5}\n')
    assert sorted(map(str, documents.read_documents(spark, f"{tmp_uri}/foreign").collect())) == ["Row(a='2', b=None)", "Row(a=None, b='3.5')"]


def test_metrics_history_rejects_duplicate_timestamp(spark, tmp_uri):
    row = spark.createDataFrame([(100, 0.12345, 0.5, 0.5, 0.5, 0.5)], "timestamp long, f1_score double, precision_score double, recall_score double, cohen_kappa_score double, roc_auc_score double")
    assert reports.append_scores(spark, f"{tmp_uri}/hist", row) == 1
    assert reports.read_history(spark, f"{tmp_uri}/hist").first()["f1_score"] == 0.123
    with pytest.raises(reports.DuplicateTimestamp):
        reports.append_scores(spark, f"{tmp_uri}/hist", row)


def test_sample_grid_is_seeded_without_replacement():
    a = training.sample_grid(training.REFERENCE_GRID, 3, seed=1)
    assert a == training.sample_grid(training.REFERENCE_GRID, 3, seed=1)
    assert len({tuple(sorted(p.items())) for p in a}) == 3


def test_training_then_scoring_end_to_end(spark, tmp_uri):
    spec = ColumnSpec(features=tuple(fx.VEC_FEATURES), label="class", drop=("label",))
    vm = fx.vec_missing(spark, SF_CHECK).withColumn("label", F.lit("x"))
    raw = vm.select("class", *[F.coalesce(F.col(c).cast("string"), F.lit("na")).alias(c) for c in fx.VEC_FEATURES], "label")
    documents.write_documents(raw, f"{tmp_uri}/collection")
    res = jobs.run_training(
        spark, f"{tmp_uri}/collection", spec, f"{tmp_uri}/work", f"{tmp_uri}/models",
        grid={"learning_rate": [0.3], "max_depth": [3], "n_estimators": [5, 10]}, n_iter=2, n_folds=2,
        enforce_gates=False,
    )
    assert res.accepted and res.version is not None
    assert res.drift_report.count() == 1 + len(fx.VEC_FEATURES)
    reg = registry.ModelRegistry(spark, f"{tmp_uri}/models")
    assert reg.has_model()
    inp = raw.drop("class").limit(60)
    files.write_csv(inp, f"{tmp_uri}/incoming")
    out = jobs.run_scoring(spark, f"{tmp_uri}/incoming", spec, f"{tmp_uri}/models", f"{tmp_uri}/pred")
    assert out.columns[0] == "class" and out.count() == 60
    assert {r["class"] for r in out.select("class").distinct().collect()} <= {"pos", "neg"}
    # second run compares against the promoted champion and records scores
    res2 = jobs.run_training(
        spark, f"{tmp_uri}/collection", spec, f"{tmp_uri}/work2", f"{tmp_uri}/models",
        grid={"learning_rate": [0.3], "max_depth": [3], "n_estimators": [5]}, n_iter=1, n_folds=2,
        enforce_gates=False,
    )
    assert res2.evaluation.first()["best_f1_score"] is not None
    assert reports.read_history(spark, f"{tmp_uri}/models/_metrics_history").count() == 1


def test_etl_downsamples_and_replaces_collection(spark, tmp_uri):
    path = f"{tmp_uri}/raw.csv"
    vw = fx.vec_wide(spark, SF_CHECK).select("class", *fx.VEC_FEATURES).toPandas()
    with open(path, "w") as f:
        for i in range(14):
            f.write(f"licence text line {i}\n\n")
        vw.to_csv(f, index=False)
    n_pos = int((vw["class"] == "pos").sum())
    n_neg = int((vw["class"] == "neg").sum())
    out = f"{tmp_uri}/collection"
    n = jobs.run_etl(spark, path, out)
    assert n == n_pos + round(0.3 * n_neg)
    n_again = jobs.run_etl(spark, path, out)  # overwrite, same seeded rows
    back = documents.read_documents(spark, out)
    assert n_again == n and back.count() == n
    assert back.filter(F.col("class") == "pos").count() == n_pos


def _csv(folder, name, text):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_csv_columns_are_bound_by_each_files_header(spark, tmp_uri):
    _csv(f"{tmp_uri}/in", "a.csv", 'a,"b",drop1\n1,2,x\nna,4,y\n')
    _csv(f"{tmp_uri}/in", "b.csv", "drop1,b,a\nz,20,10\n")
    got = files.read_sensor_csv(spark, f"{tmp_uri}/in").select("a", "b", "drop1").collect()
    assert sorted(map(tuple, got), key=repr) == [("1", "2", "x"), ("10", "20", "z"), (None, "4", "y")]
    _csv(f"{tmp_uri}/in", "c.csv", "a,b\n5,6\n")
    with pytest.raises(ValueError, match="drop1"):
        files.read_sensor_csv(spark, f"{tmp_uri}/in")


def test_preamble_files_with_other_column_order(spark, tmp_uri):
    _csv(f"{tmp_uri}/pre", "a.csv", "licence\n\nmore\na,b\n1,2\n")
    _csv(f"{tmp_uri}/pre", "b.csv", "other\nlicence\n\nb,a\n20,10\n")
    got = files.read_preamble_csv(spark, f"{tmp_uri}/pre", header_line=2).select("a", "b").collect()
    assert sorted(map(tuple, got)) == [("1", "2"), ("10", "20")]
    with pytest.raises(ValueError):
        files.read_preamble_csv(spark, f"{tmp_uri}/pre", header_line=9)


def test_scoring_and_training_see_the_real_columns(spark, tmp_uri):
    from faultline.operators.validation import ValidationError

    spec = ColumnSpec(features=("a", "b"), label="class", drop=("drop1",))
    raw = spark.createDataFrame([("pos", "1", "2", "x"), ("neg", None, "4", "x")], "class string, a string, b string, drop1 string")
    documents.write_documents(raw, f"{tmp_uri}/full")
    assert set(documents.read_documents(spark, f"{tmp_uri}/full").columns) == {"class", "a", "b", "drop1"}
    documents.write_documents(raw.drop("b").withColumn("zz", F.lit("1")), f"{tmp_uri}/odd")
    with pytest.raises(ValidationError, match="b"):
        jobs.run_training(spark, f"{tmp_uri}/odd", spec, f"{tmp_uri}/w", f"{tmp_uri}/m")
    documents.write_documents(raw.drop("drop1"), f"{tmp_uri}/nodrop")
    with pytest.raises(KeyError, match="drop1"):
        jobs.run_training(spark, f"{tmp_uri}/nodrop", spec, f"{tmp_uri}/w2", f"{tmp_uri}/m")
    with pytest.raises(ValidationError, match="b"):
        jobs.score_frame(raw.drop("class", "b"), spec, None, None)


def test_row_keys_do_not_depend_on_layout(spark):
    from faultline.operators import clean

    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, "x")], "a int, b string")
    keys = [sorted(r["k"] for r in clean.with_row_key(df.repartition(n), "k").collect()) for n in (1, 4)]
    assert keys[0] == keys[1] and len(set(keys[0])) == 4


def test_folds_hold_every_class_in_equal_parts(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 7 else 0.0) for i in range(100)], "k long, label double")
    rows = training.stratified_folds(df, "label", ["k"], 3).groupBy("label", training.FOLD_COL).count().collect()
    assert sorted((r["label"], r["count"]) for r in rows) == [(0.0, 31)] * 3 + [(1.0, 2), (1.0, 2), (1.0, 3)]


def test_a_single_row_class_cannot_be_split(spark):
    from faultline.operators import sampling

    df = spark.createDataFrame([(i, "neg" if i else "pos") for i in range(9)], "k long, class string")
    with pytest.raises(ValueError):
        sampling.stratified_split(df, "class", ["k"])


def test_reads_raise_on_other_errors_than_a_missing_path(spark, tmp_uri):
    from py4j.protocol import Py4JJavaError

    _csv(f"{tmp_uri}/broken", "part-0.parquet", "this is no parquet file")
    assert reports.read_history(spark, f"{tmp_uri}/nowhere").count() == 0
    with pytest.raises(Py4JJavaError):
        reports.read_history(spark, f"{tmp_uri}/broken").count()


def test_drift_scans_its_table_once(spark):
    from faultline.operators import drift

    seen = fx.lineitem_sides(spark, SF_CHECK)
    plan = drift._ks_chain(seen, "late", fx.SENSOR_MEASURES, ["double"] * 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan  # only the written counts are read, by every branch


def _write(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_malformed_lines(spark, tmp_uri):
    """A surplus field is an error that names file and line; missing ones are NULL; quotes are no fields."""
    import pytest

    from faultline.sources import files

    top = "".join(f"text {i}\n\n" for i in range(3))
    for name, head, read in (
        ("plain", "", lambda p: files.read_sensor_csv(spark, p)),
        ("preamble", top, lambda p: files.read_preamble_csv(spark, p, 3)),
    ):
        _write(f"{tmp_uri}/{name}/ok/a.csv", head + 'a,b\n3\n4,na\n"x,y","z"\n\n5,6\n')
        _write(f"{tmp_uri}/{name}/ok/b.csv", head + "b,a\n8,7\n")
        got = sorted(map(tuple, read(f"{tmp_uri}/{name}/ok").select("a", "b").collect()), key=str)
        assert got == sorted([("3", None), ("4", None), ("x,y", "z"), ("5", "6"), ("7", "8")], key=str)
        assert read(f"{tmp_uri}/{name}/ok").count() == 5
        for k, line in enumerate(("4,5,6", "4,5,,7", '"4,4",5,6')):
            _write(f"{tmp_uri}/{name}/bad{k}/a.csv", head + f"a,b\n1,2\n{line}\n")
            with pytest.raises(Exception, match=r"a\.csv: a line has more than 2 fields") as e:
                read(f"{tmp_uri}/{name}/bad{k}").count()
            assert line.split(",")[-1] in str(e.value)
        _write(f"{tmp_uri}/{name}/short/a.csv", "\n")
        with pytest.raises(ValueError, match="header"):
            read(f"{tmp_uri}/{name}/short")


def test_headers_of_many_splits_and_one_scan(spark, tmp_uri):
    """A file of several splits and small files: one scan in the plan, every row once."""
    from faultline.sources import files

    for i, n in enumerate((5_000, 3, 0)):
        _write(f"{tmp_uri}/many/{i}.csv", "licence\n\na,b\n" + "".join(f"{i},{k}\n" for k in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = files.read_preamble_csv(spark, f"{tmp_uri}/many", 1)
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        got = sorted((r.a, int(r.b)) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted([("0", k) for k in range(5_000)] + [("1", k) for k in range(3)])


def test_row_keys_of_a_hot_row(spark):
    """A third of the rows are equal: they are numbered without a group in one task, whatever the layout."""
    from faultline.operators.clean import with_row_key

    rows = [(1, "x")] * 400 + [(None, "y")] * 3 + [(i, "z") for i in range(800)]
    keys = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "a int, b string").repartition(parts)
        out = with_row_key(df, "k")
        keys.append(sorted(r.k for r in out.collect()))
        assert out.columns == ["a", "b", "k"]
    assert keys[0] == keys[1] and len(set(keys[0])) == len(rows)
    hot = [k for k in keys[0] if k.split(":")[0] == max(keys[0], key=lambda k: int(k.split(":")[1])).split(":")[0]]
    assert sorted(int(k.split(":")[1]) for k in hot) == list(range(1, 401))


def test_two_writers_with_one_timestamp(spark, tmp_uri):
    from concurrent.futures import ThreadPoolExecutor

    from faultline.operators.metrics import SCORE_COLUMNS
    from faultline.sources import reports

    row = spark.createDataFrame([(7, *[0.5] * 5)], "timestamp long, " + ", ".join(f"{c} double" for c in SCORE_COLUMNS))

    def write(_):
        try:
            return reports.append_scores(spark, f"{tmp_uri}/history", row)
        except reports.DuplicateTimestamp:
            return 0

    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(write, range(4))) == [0, 0, 0, 1]
    assert reports.read_history(spark, f"{tmp_uri}/history").count() == 1
