import itertools

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from compare import plan_text
from siltstone.operators.cdc import scd1_batch
from siltstone.operators.project import fields, project
from siltstone.plans import raw
from siltstone.plans.pipeline import load_erp
from siltstone.sources.files import children
from siltstone.sources.tables import materialize, read_table, relational_reader
from siltstone.sources.stage import scratch_path, shared_dir, stage
from siltstone.streaming.ingest import LandingTable, csv_stream
from siltstone.streaming.upsert import LatestTable

CHANGES = [("k1", "3", "c"), ("k1", "1", "a"), ("k2", "9", "x"), ("k2", "10", "y"), ("k3", "5", "p"), ("k3", "5", "q"), ("k4", None, "n"), (None, "1", "no key")]
SCHEMA = "k string, seq string, v string"


def test_batch_rules(spark, rows):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    as_text = rows(scd1_batch(df, ["k"], "seq"))
    assert as_text == sorted([("k1", "3", "c"), ("k2", "9", "x"), ("k3", "5", "q"), (None, "1", "no key")], key=repr)
    as_number = rows(scd1_batch(df, ["k"], F.col("seq").cast("int")))
    assert ("k2", "10", "y") in as_number and len(as_number) == 4


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:4])
def test_stream_equals_batch_for_any_file_order_and_split(spark, rows, order):
    drop, latest = scratch_path(spark, "changes"), LatestTable(spark, scratch_path(spark, "latest"), ["k"], "seq", buckets=3)
    parts = [CHANGES[0:3], CHANGES[3:6], CHANGES[6:]]
    for i in order:
        spark.createDataFrame(parts[i], SCHEMA).coalesce(1).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(drop)
        latest.run(stream)
    want = rows(scd1_batch(spark.createDataFrame(CHANGES, SCHEMA), ["k"], "seq"))
    assert rows(latest.read()) == want
    latest.run(spark.readStream.schema(SCHEMA).parquet(drop))
    assert rows(latest.read()) == want
    assert rows(latest.run(spark.readStream.schema(SCHEMA).parquet(drop), full_refresh=True).read()) == want
    latest.vacuum()
    assert rows(latest.read()) == want


def test_few_changes_write_few_rows(spark, rows):
    drop, root = scratch_path(spark, "changes"), scratch_path(spark, "latest")
    latest = LatestTable(spark, root, ["k"], "seq")
    stream = lambda: spark.readStream.schema("k long, seq long, v string").parquet(drop)
    spark.range(5000).selectExpr("id AS k", "1L AS seq", "'old' AS v").write.mode("append").parquet(drop)
    latest.run(stream())
    spark.range(3).selectExpr("id AS k", "2L AS seq", "'new' AS v").write.mode("append").parquet(drop)
    latest.run(stream())
    assert spark.read.parquet(f"{root}/000001/changes/1").count() == 3
    written = [children(spark, f"{root}/000001/base/{n}") for n in (0, 1)]
    buckets = [[name for name in names if "=" in name] for names in written]
    assert len(buckets[0]) == 64 and len(buckets[1]) <= 3
    assert latest.read().count() == 5000 and latest.read().where("v = 'new'").count() == 3
    plan = plan_text(latest.read())
    assert "StateStore" not in plan and "Exchange" not in plan and "Aggregate" not in plan
    latest.run(stream())
    assert children(spark, f"{root}/000001/base") == ["0", "1"]  # nothing new, nothing written
    latest.vacuum()
    left = [name for n in (0, 1) for name in children(spark, f"{root}/000001/base/{n}") if "=" in name]
    assert sorted(left) == sorted(buckets[0]) and latest.read().count() == 5000
    with pytest.raises(ValueError, match="64|16"):
        LatestTable(spark, root, ["k"], "seq", buckets=16).run(stream())


def test_changes_without_a_sequence(spark):
    drop, latest = scratch_path(spark, "changes"), LatestTable(spark, scratch_path(spark, "latest"), ["k"], "seq")
    spark.createDataFrame([("k4", None, "n")], SCHEMA).write.mode("append").parquet(drop)
    assert latest.run(spark.readStream.schema(SCHEMA).parquet(drop)).read().collect() == []


def test_a_failed_fold_is_made_up_for(spark, rows, monkeypatch):
    """Readers see the table before the run; the next run, without new files, folds what it had left."""
    drop, root = scratch_path(spark, "changes"), scratch_path(spark, "latest")
    latest = LatestTable(spark, root, ["k"], "seq", buckets=2)
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(drop)
    spark.createDataFrame([("k1", "1", "a")], SCHEMA).coalesce(1).write.mode("append").parquet(drop)
    latest.run(stream())
    spark.createDataFrame([("k1", "2", "b"), ("k2", "1", "c")], SCHEMA).coalesce(1).write.mode("append").parquet(drop)
    with monkeypatch.context() as m:
        m.setattr(LatestTable, "_versions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            latest.run(stream())
    assert rows(latest.read()) == [("k1", "1", "a")]
    assert rows(latest.run(stream()).read()) == [("k1", "2", "b"), ("k2", "1", "c")]


def _failing(stream, poison):
    """The stream, with an error in the task that meets the value."""
    return stream.withColumn("v", F.when(F.col("v") == poison, F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("v")))


@pytest.mark.parametrize("kind", ["append", "latest"])
@pytest.mark.parametrize("poison", ["a", "b"])
def test_failed_refresh_leaves_the_old_rows(spark, rows, kind, poison):
    """A refresh that fails in its first or in a later batch is not seen; the next run ends it."""
    drop, root = scratch_path(spark, "files"), scratch_path(spark, "table")
    table = LandingTable(spark, root) if kind == "append" else LatestTable(spark, root, ["k"], "seq")
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(drop)
    for row in (("k1", "1", "a"), ("k2", "1", "b")):
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(drop)
        table.run(stream())
    want = rows(table.read())
    assert len(want) == 2
    with pytest.raises(Exception, match="stop"):
        table.run(_failing(stream(), poison), full_refresh=True)
    assert rows(table.read()) == want
    spark.createDataFrame([("k3", "1", "c")], SCHEMA).coalesce(1).write.mode("append").parquet(drop)
    table.run(stream())
    assert rows(table.read()) == sorted([*want, ("k3", "1", "c")], key=repr)
    assert table.newest(lambda folder: True).endswith("000002")


def _csv(spark, rows_, columns, path):
    spark.createDataFrame(rows_, ", ".join(f"`{c}` string" for c in columns)).coalesce(1).write.mode("append").option("header", True).csv(path)


def test_csv_ingest_reads_each_file_once(spark, rows):
    drop, table = scratch_path(spark, "csv"), LandingTable(spark, scratch_path(spark, "landing"))
    columns = ["MCH_CODE", "CF$_KW", "OBJID"]
    spec = "MCH_CODE\nCF$_KW : double\nOBJID -> _obj_id"
    run = lambda **kw: table.run(project(csv_stream(spark, drop), spec), **kw)
    with pytest.raises(FileNotFoundError):
        table.read()
    _csv(spark, [("m1", "1.5", "o1"), ("m2", "bad", "o2")], columns, drop)
    run()
    assert rows(run().read()) == [("m1", 1.5, "o1"), ("m2", None, "o2")]
    _csv(spark, [("m3", "3", "o3")], columns, drop)
    assert run().read().count() == 3
    refreshed = run(full_refresh=True)
    assert refreshed.read().count() == 3
    assert run().read().count() == 3


def test_csv_with_other_header_fails(spark):
    drop = scratch_path(spark, "csv")
    _csv(spark, [("1", "2")], ["a", "b"], drop)
    stream = csv_stream(spark, drop, "b string, a string")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        LandingTable(spark, scratch_path(spark, "landing")).run(stream)


RAGGED = "a,b,c\n1,2,3\n4,5\n6,7,8,9\n\"x,y\",,z\n,,\n\"unclosed,1,2\n"


def _drop(spark, path, text):
    """A file with these bytes, through Spark, so that it lands where the others do."""
    head, *lines = text.rstrip("\n").split("\n")
    spark.createDataFrame([(x,) for x in lines], f"`{head}` string").coalesce(1).write.mode("append").option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(path)


def test_malformed_rows_are_kept_apart(spark, rows):
    drop, table = scratch_path(spark, "csv"), LandingTable(spark, scratch_path(spark, "landing"))
    run = lambda **kw: table.run(project(csv_stream(spark, drop, "a string, b string, c string", keep_malformed=True), "a : int\nb\nc"), **kw)
    _drop(spark, drop, "a,b,c\n1,2,3\n2,,z")
    assert rows(run().read()) == [(1, "2", "3"), (2, None, "z")] and table.rejects().count() == 0
    _drop(spark, drop, RAGGED)
    assert table.read().columns == ["a", "b", "c"]
    want = [(1, "2", "3"), (1, "2", "3"), (2, None, "z"), (None, None, "z"), (None, None, None)]
    assert rows(run().read()) == sorted(want, key=repr)
    assert sorted(r.row for r in table.rejects().collect()) == ['"unclosed,1,2', "4,5", "6,7,8,9"]
    assert {r.file.rsplit("/", 1)[0].removeprefix("file:").removeprefix("//") for r in table.rejects().collect()} == {drop.removeprefix("file:").removeprefix("//")}
    assert rows(run(full_refresh=True).read()) == sorted(want, key=repr) and table.rejects().count() == 3
    follower = LandingTable(spark, scratch_path(spark, "sibling")).run(table.read_stream())
    assert rows(follower.read()) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="first run"):
        table.run(project(csv_stream(spark, drop, "a string, b string, c string"), "a : int\nb\nc"))


def test_malformed_rows_fail_a_plain_stream(spark):
    for text in ("a,b,c\n4,5", "a,b,c\n6,7,8,9"):
        drop = scratch_path(spark, "csv")
        _drop(spark, drop, text)
        stream = csv_stream(spark, drop, "a string, b string, c string")
        with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
            LandingTable(spark, scratch_path(spark, "landing")).run(stream.select("a"))


def test_erp_rejects(spark, rows):
    landing, target = scratch_path(spark, "erp-landing"), scratch_path(spark, "erp-raw")
    names = [f.source for f in fields(raw.ERP_CUSTOMER_INFO)]
    _drop(spark, f"{landing}/customer_info", ",".join(names) + "\n" + ",".join("x" * len(names)) + "\nx,y\n")
    assert load_erp(spark, landing, target)["erp.customer_info"].count() == 1
    assert [r.row for r in LandingTable(spark, f"{target}/customer_info").rejects().collect()] == ["x,y"]


def test_drained_files_go_to_the_archive(spark, rows):
    """The landing folder keeps the last batch, the archive has the rest, a full refresh reads all."""
    landing, archive, target = scratch_path(spark, "erp-landing"), scratch_path(spark, "erp-archive"), scratch_path(spark, "erp-raw")
    folder, names = f"{landing}/customer_info", [f.source for f in fields(raw.ERP_CUSTOMER_INFO)]
    files = lambda: [n for n in children(spark, folder) if n.endswith(".csv")]
    for i in range(3):
        _csv(spark, [(str(i),) * len(names)], names, folder)
        new = set(files())
        table = load_erp(spark, landing, target, archive=archive)["erp.customer_info"]
        assert table.count() == i + 1
    assert len(files()) == 1 and len(new) == 2  # each run met the file before its own, and its own
    kept = children(spark, f"{archive}/{folder.removeprefix('file:').strip('/')}")
    assert len(kept) == 2 and not set(kept) & set(files())
    assert load_erp(spark, landing, target, archive=archive)["erp.customer_info"].count() == 3
    assert load_erp(spark, landing, target, full_refresh=True, archive=archive)["erp.customer_info"].count() == 3


def test_company_person_headers_in_any_case(spark):
    df = spark.createDataFrame([("1", "p", "n", "o", "s", "id", "v")], "EMP_NO string, Person_ID string, internal_display_name string, Org_Code string, EMPLOYEE_STATUS string, OBJID string, ObjVersion string")
    assert raw.raw_table("erp", "company_person", df).columns == ["emp_no", "person_id", "internal_display_name", "org_code", "employee_status", "_obj_id", "_obj_version"]
    assert raw.company_person_changes(raw.raw_table("erp", "company_person", df)).columns == ["employee_id", "person_id", "full_name", "org_code", "status", "_obj_id", "_obj_version"]


def test_stage_uses_the_configured_folder(spark, rows):
    df = spark.range(5)
    staged = stage(df, "x")
    assert rows(staged) == rows(df)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == configured
    assert all(configured.removeprefix("file:") in f for f in staged.inputFiles())


def test_materialize(spark, rows):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string").withMetadata("v", {"comment": "value"})
    path = scratch_path(spark, "table")
    assert rows(materialize(df, path, cluster_by=("id",))) == [(1, "a"), (2, "b")]
    assert rows(materialize(df.limit(1), path)) == [(2, "b")]
    stored = materialize(df, scratch_path(spark, "table"), name="stored_rows", quality="curated", description="it's here")
    assert rows(stored) == [(1, "a"), (2, "b")]
    assert stored.schema["v"].metadata["comment"] == "value"
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES stored_rows").collect()}
    assert properties["quality"] == "curated" and properties["description"] == "it's here"
    spark.sql("DROP TABLE stored_rows")


def test_readers_find_old_or_new_rows(spark, rows, monkeypatch):
    """While a version is written, and after a write or a publication that fails, the old rows are there."""
    from siltstone.sources import tables

    path, name = scratch_path(spark, "table"), "published_rows"
    old, new = spark.range(3), spark.range(5)
    first = materialize(old, path, name=name)
    with monkeypatch.context() as m:
        m.setattr(tables, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            materialize(new, path, name=name)
    assert spark.read.table(name).count() == 3
    poisoned = new.select(F.when(F.col("id") == 4, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        materialize(poisoned, path, name=name)
    assert spark.read.table(name).count() == 3
    dropped = []
    plain = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **kw: dropped.append(text) or plain(text, *a, **kw))
    assert materialize(new, path, name=name).count() == 5 and spark.read.table(name).count() == 5
    assert not any("DROP" in text for text in dropped)
    assert first.count() in (3, 5)  # its files are still there
    monkeypatch.undo()
    wider = new.withColumn("v", F.lit("x"))
    assert rows(materialize(wider, path, name=name).limit(1).select("v")) == [("x",)]
    spark.sql(f"DROP TABLE {name}")


def test_versions_by_path(spark, rows):
    path = scratch_path(spark, "table")
    for n in (1, 2, 3, 4):
        materialize(spark.range(n), path)
        assert read_table(spark, path).count() == n
    assert children(spark, path) == ["000003", "000004"]
    plain = scratch_path(spark, "plain")
    spark.range(2).write.parquet(plain)
    assert read_table(spark, plain).count() == 2


def test_partitioned_table(spark, rows):
    path, name = scratch_path(spark, "table"), "partitioned_rows"
    df = spark.range(4).selectExpr("id", "id % 2 AS p")
    for _ in range(2):
        assert rows(materialize(df, path, name=name, partition_by=("p",)).select("id", "p")) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    spark.sql(f"DROP TABLE {name}")


def test_ranges_do_not_overlap(spark):
    """Files written in ranges follow each other, so a filter on the first column needs few of them."""
    path, df = scratch_path(spark, "table"), spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.lit("x" * 20).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = materialize(df, path, order_by=[F.desc("k")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = sorted((r.low, r.high) for r in stored.groupBy(F.input_file_name()).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect())
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    groups = [pq.read_metadata(f.removeprefix("file:").replace("///", "/")).row_group(0).column(0).statistics for f in stored.inputFiles()]
    assert sum(g.min <= 100 <= g.max for g in groups) == 1  # the statistics that prune are there


def test_relational_split_needs_all_bounds(spark):
    with pytest.raises(ValueError):
        relational_reader(spark, "jdbc:x", "t", split_on="id")
    relational_reader(spark, "jdbc:x", "t", {"user": "u"}, "id", 0, 100, 8)


def test_erp_load_lists_no_files(spark, monkeypatch):
    """The driver asks whether a folder has files, not which."""
    from siltstone.sources import files

    landing, target = scratch_path(spark, "erp-landing"), scratch_path(spark, "erp-raw")
    _csv(spark, [("n", "1", "c", None, "o", "v")], [f.source for f in fields(raw.ERP_CUSTOMER_INFO)], f"{landing}/customer_info")
    listed, plain = [], files.children
    for module in ("siltstone.sources.files", "siltstone.streaming.generations", "siltstone.streaming.upsert"):
        monkeypatch.setattr(f"{module}.children", lambda s, path: listed.append(path) or plain(s, path))
    assert load_erp(spark, landing, target)["erp.customer_info"].count() == 1
    assert not [path for path in listed if path.startswith(landing)]


def test_erp_files_must_have_the_declared_columns(spark):
    landing = scratch_path(spark, "erp-landing")
    _csv(spark, [("1", "n")], ["CUSTOMER_ID", "Name"], f"{landing}/customer_info")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load_erp(spark, landing, scratch_path(spark, "erp-raw"))


def test_erp_load_runs_again_without_change(spark, rows):
    landing, target = scratch_path(spark, "erp-landing"), scratch_path(spark, "erp-raw")
    columns = ["EMP_NO", "PERSON_ID", "Internal_Display_Name", "ORG_CODE", "EMPLOYEE_STATUS", "OBJID", "OBJVERSION"]
    _csv(spark, [("1", "p1", "old", "o", "A", "x1", "001"), ("2", "p2", "two", "o", "A", "x2", "001")], columns, f"{landing}/company_person")
    first = load_erp(spark, landing, target)
    assert set(first) == {"erp.company_person", "erp.company_person_last_change"}
    want = rows(first["erp.company_person_last_change"])
    assert rows(load_erp(spark, landing, target)["erp.company_person_last_change"]) == want
    _csv(spark, [("1", "p1", "new", "o", "A", "x1", "002"), ("2", "p2", "late", "o", "A", "x2", "000")], columns, f"{landing}/company_person")
    latest = load_erp(spark, landing, target)
    assert latest["erp.company_person"].count() == 4
    assert rows(latest["erp.company_person_last_change"].select("_obj_id", "full_name")) == [("x1", "new"), ("x2", "two")]
    again = load_erp(spark, landing, target, full_refresh=True)
    assert rows(again["erp.company_person_last_change"]) == rows(latest["erp.company_person_last_change"])
    assert again["erp.company_person"].count() == 4
