import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.ids import ordered_id, previous_value
from ledgerloom.sources import tables
from ledgerloom.sources.workspace import Workspace, shared_folder
from tests.conftest import rows_of


def test_csv_rows_are_numbered_in_file_order_across_splits(spark, workspace, tmp_path):
    lines = "\n".join(f"a{i},{i}" for i in range(5000))
    for part in range(3):
        (tmp_path / f"part-{part}.csv").write_text("Action,Notes\n" + lines.replace("a", f"p{part}-") + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        schema = spark.createDataFrame([], "Action string, Notes string").schema
        got = tables.read_csv_numbered(spark, str(tmp_path), workspace, schema, start=1).orderBy("source_row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.source_row_id for r in got] == list(range(1, 15001))
    assert [r.Action for r in got] == [f"p{p}-{i}" for p in range(3) for i in range(5000)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_many_files_of_long_names_are_numbered_without_their_names(spark, workspace, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(tables, "small_side", lambda d, *bounds: d)
    sizes = [(i * 37) % 50 for i in range(100)]  # among them files without a row
    for i, n in enumerate(sizes):
        (tmp_path / f"{'long-name-' * 15}{i:03}.csv").write_text("Action,Notes\n" + "".join(f"f{i}-{k},x\n" for k in range(n)))
    schema = spark.createDataFrame([], "Action string, Notes string").schema
    got = tables.read_csv_numbered(spark, str(tmp_path), workspace, schema, start=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_file" not in plan and "_block" not in plan
    rows = got.orderBy("source_row_id").collect()
    assert [r.source_row_id for r in rows] == list(range(sum(sizes)))
    assert [r.Action for r in rows] == [f"f{i}-{k}" for i, n in enumerate(sizes) for k in range(n)]


def test_missing_table_or_column_skips_the_checks(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert tables.read_required(spark, path, ["id"]).count() == 3
    assert tables.read_required(spark, path, ["id", "gone"]) is None
    assert tables.read_required(spark, path + "-not", ["id"]) is None
    assert "gone" in capsys.readouterr().out
    assert tables.read_optional(spark, path + "-not", ["id"]) is None
    assert capsys.readouterr().out == ""


def test_csv_export_has_a_header_and_no_index(spark, tmp_path):
    tables.write_csv(spark.range(2).coalesce(1), str(tmp_path / "out"))
    [part] = list((tmp_path / "out").glob("*.csv"))
    assert part.read_text().splitlines() == ["id", "0", "1"]


def test_monthly_table_prunes_by_month(spark, tmp_path, frame):
    df = frame("d date;v int", ("2020-01-05", 1), ("2020-01-09", 2), ("2020-02-01", 3))
    tables.write_by_month(df, str(tmp_path / "m"), "d")
    back = spark.read.parquet(str(tmp_path / "m")).where("year_month = '2020-01'")
    assert rows_of(back, "v") == [(1,), (2,)]
    plan = back._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_a_busy_month_has_several_writers(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        ids = spark.range(0, 100_000, 1, 8)
        df = ids.selectExpr("if(id % 5 = 0, date'2020-01-05', date'2020-02-05') AS d", "xxhash64(id) AS v")
        tables.write_by_month(df, str(tmp_path / "m"), "d")
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "m" / "year_month=2020-02").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "m")).count() == 100_000


def test_overwriting_twice_leaves_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(5), path)
    assert tables.overwrite_table(spark.range(3), path).count() == 3


def test_seeding_adds_only_absent_keys(frame):
    target = frame("k int;v string", (1, "old"))
    new = frame("k int;v string", (1, "new"), (2, "new"))
    assert rows_of(tables.seed_if_absent(new, target, ["k"])) == [(1, "old"), (2, "new")]


@pytest.mark.parametrize("start", [0, 1])
def test_ordered_ids_are_consecutive_and_follow_the_order(spark, workspace, start):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), "id")
    got = ordered_id(rows.repartition(13), ["k"], "n", workspace, start).orderBy("n").collect()
    assert [r.n for r in got] == list(range(start, start + 20_000))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_ordered_ids_with_one_hot_key(spark, workspace):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = ordered_id(rows, ["k", "id"], "n", workspace).collect()
    assert sorted(r.n for r in got) == list(range(9000))
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == [
        i for _, i in sorted((0 if i % 3 == 0 else i, i) for i in range(9000))]


def test_previous_values_cross_partition_borders_inside_a_hot_group(spark, workspace):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("g"), "id")
    got = previous_value(rows.repartition(5), "g", ["id"], "id", "p", workspace).collect()
    last, want = {}, {}
    for i in range(9000):
        g = 1 if i % 3 else i % 50
        want[i], last[g] = last.get(g), i
    assert {r.id: r.p for r in got} == want


def test_layers_are_written_once_under_the_shared_folder(spark):
    space, calls = Workspace(spark), []
    build = lambda: calls.append(1) or spark.range(4)
    assert space.layer("x", build).count() == space.layer("x", build).count() == 4
    assert len(calls) == 1 and space.folder.startswith(shared_folder(spark))
    space.drop()
