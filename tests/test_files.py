import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumbline import session
from plumbline.operators import cleaning, trips
from plumbline.sources import bindings, files, synthetic
from plumbline.streaming.append import append_new_pages


def numbers(spark, start, end):
    return spark.range(start, end).withColumn("square", F.col("id") * F.col("id"))


@pytest.fixture
def three_files(spark, folder):
    """Part files of 10, 5 and 20 rows, the last with one more column, and a file that is no Parquet."""
    target = Path(folder) / "table"
    target.mkdir()
    for name, df in {
        "a": numbers(spark, 0, 10),
        "b": numbers(spark, 10, 15),
        "c": numbers(spark, 15, 35).withColumn("extra", F.lit("x")),
    }.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}")
        part = next(Path(folder, name).glob("part-*.parquet"))
        (target / f"{name}.parquet").write_bytes(part.read_bytes())
    return str(target)


def test_read_parquet_joins_columns(spark, three_files):
    df = files.read_parquet(spark, three_files)
    assert df.count() == 35 and df.where("extra IS NOT NULL").count() == 20


def test_unreadable_file_is_an_error_and_can_be_named(spark, three_files):
    (Path(three_files) / "broken.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception, match="(?i)broken|magic|footer"):
        files.read_parquet(spark, three_files).count()
    table, left_out = files.read_parquet_without(spark, three_files, ["broken.parquet"])
    assert table.count() == 35
    assert [(r.path.rsplit("/", 1)[1], r.size) for r in left_out.collect()] == [("broken.parquet", 17)]


def test_damaged_middle_of_a_file_is_an_error(spark, folder):
    spark.range(200_000).withColumn("x", F.concat(F.lit("value number "), F.sha2(F.col("id").cast("string"), 256))).coalesce(1).write.parquet(f"{folder}/d")
    part = next(Path(folder, "d").glob("part-*.parquet"))
    data = bytearray(part.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 4000] = b"\xff" * 4000
    part.write_bytes(bytes(data))
    Path(folder, "d", f".{part.name}.crc").unlink()
    with pytest.raises(Exception):  # noqa: B017
        files.read_parquet(spark, f"{folder}/d").agg(F.max(F.length("x"))).collect()


def test_inventory_has_empty_files_csv_and_equal_names(spark, three_files):
    target = Path(three_files)
    numbers(spark, 0, 0).coalesce(1).write.parquet(f"{three_files}-none")
    (target / "empty.parquet").write_bytes(next(Path(f"{three_files}-none").glob("part-*.parquet")).read_bytes())
    for day in "12":
        (target / f"day={day}").mkdir()
        (target / f"day={day}" / "same name+.parquet").write_bytes((target / "b.parquet").read_bytes())
    (target / "lines.csv").write_text("x,y\n1,2\n3,4\n")
    rows = files.file_inventory(spark, three_files).collect()
    got = sorted((r.file_path.split("table/")[1], r.file_size, r.row_count) for r in rows)
    counts = {"a.parquet": 10, "b.parquet": 5, "c.parquet": 20, "empty.parquet": 0, "lines.csv": 2}
    counts |= {f"day={d}/same name+.parquet": 5 for d in "12"}
    assert got == sorted((name, (target / name).stat().st_size, n) for name, n in counts.items())
    assert {r.file_name for r in rows} == {name.rsplit("/")[-1] for name in counts}


def test_csv(spark, folder):
    files.write_csv(numbers(spark, 0, 50), f"{folder}/csv")
    back = files.read_csv(spark, f"{folder}/csv", "id bigint, square bigint")
    assert back.agg(F.sum("square")).first()[0] == sum(i * i for i in range(50))
    assert files.read_csv(spark, f"{folder}/csv").dtypes == [("id", "string"), ("square", "string")]


def test_cleaned_table_is_reused_unless_refreshed(spark, folder):
    path = f"{folder}/clean"
    assert files.write_cleaned(numbers(spark, 0, 5), path).count() == 5
    assert files.write_cleaned(numbers(spark, 0, 9), path).count() == 5
    assert files.write_cleaned(numbers(spark, 0, 9), path, force_refresh=True).count() == 9


def test_load_first(spark, folder):
    numbers(spark, 0, 4).write.parquet(f"{folder}/second")
    assert files.load_first(spark, [f"{folder}/first", f"{folder}/second"]).count() == 4
    with pytest.raises(FileNotFoundError):
        files.load_first(spark, [f"{folder}/first"])


def test_load_raw_prefers_parquet_then_all_csv_files(spark, folder):
    target = Path(folder) / "raw"
    target.mkdir()
    with pytest.raises(FileNotFoundError):
        files.load_raw(spark, str(target))
    (target / "b.csv").write_text("x,y\n9,9\n")
    (target / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (target / "c.csv").write_text("y,z\n7,8\n")
    (target / "d.csv").write_text("")
    got = {(r.x, r.y, r.z) for r in files.load_raw(spark, str(target)).collect()}
    assert got == {("1", "2", None), ("3", "4", None), ("9", "9", None), (None, "7", "8")}
    numbers(spark, 0, 4).coalesce(1).write.parquet(f"{folder}/p")
    part = next(Path(folder, "p").glob("part-*.parquet"))
    (target / "c.parquet").write_bytes(part.read_bytes())
    assert files.load_raw(spark, str(target)).count() == 4


def test_jsonl_skips_blank_and_malformed_lines(spark, folder):
    path = Path(folder) / "lines.jsonl"
    path.write_text('{"url": "a", "n": 1}\n\n{"url": "b", "n"\n   \n{"url": "c", "n": 3}\n')
    schema = "url string, n int"
    assert [tuple(r) for r in files.read_jsonl(spark, str(path), schema).orderBy("url").collect()] == [("a", 1), ("c", 3)]
    assert files.jsonl_line_count(spark, str(path)).first().line_count == 3
    assert files.read_jsonl(spark, f"{folder}/none", schema).count() == 0
    assert files.jsonl_line_count(spark, f"{folder}/none").first().line_count == 0


def test_jsonl_writer_keeps_nulls_and_modes(spark, folder):
    df = spark.createDataFrame([("a", None)], "url string, n int")
    for mode, rows in (("append", 1), ("append", 2), ("overwrite", 1)):
        files.write_jsonl(df, f"{folder}/j", mode)
        texts = [t for p in Path(folder, "j").glob("part-*") for t in p.read_text().splitlines()]
        assert [json.loads(t) for t in texts] == [{"url": "a", "n": None}] * rows


def test_append_new_keeps_known_pages(spark, folder):
    path, schema = f"{folder}/store", "url string, text string"
    first = spark.createDataFrame([("a", "1"), ("b", "9"), ("b", "2")], schema)
    second = spark.createDataFrame([("a", "changed"), ("c", "3")], schema)
    for batch in (first, second, second):
        files.append_new(batch, path)
    assert {tuple(r) for r in files.read_jsonl(spark, path, schema).collect()} in [
        {("a", "1"), ("b", text), ("c", "3")} for text in ("9", "2")
    ]
    assert files.jsonl_line_count(spark, path).first().line_count == 3


def test_append_new_is_the_same_however_often_it_runs(spark, folder):
    path, schema = f"{folder}/store", "url string, text string"
    batch = spark.createDataFrame([("x", "1"), ("y", "1"), ("y", "2"), ("z", None)], schema)
    for _ in range(3):
        files.append_new(batch.repartition(3), path)
        assert files.jsonl_line_count(spark, path).first().line_count == 3
    # Rows that an append wrote before it was cut off are known to the next one.
    files.write_jsonl(spark.createDataFrame([("w", "late")], schema), path)
    files.append_new(spark.createDataFrame([("w", "again"), ("v", "new")], schema), path)
    assert {r.url: r.text for r in files.read_jsonl(spark, path, schema).collect()}.items() >= {"w": "late", "v": "new", "x": "1"}.items()
    assert files.jsonl_line_count(spark, path).first().line_count == 5


def test_append_new_reads_no_row_of_known_files(spark, folder):
    path, schema = f"{folder}/store", "url string, text string"
    files.append_new(spark.createDataFrame([("a", "1")], schema), path)
    files.append_new(spark.createDataFrame([("b", "1")], schema), path)
    known = files._store_keys(spark, path, "url")
    assert {r.key for r in known.collect()} == {"a", "b"}
    text = known._jdf.queryExecution().toString()
    assert "parquet" in text.lower() and "json" not in text.lower()


def test_append_new_rejects_missing_keys(spark, folder):
    batch = spark.createDataFrame([(None, "x"), (None, "y"), ("a", "1")], "url string, text string")
    with pytest.raises(ValueError, match="2 rows have no url"):
        files.append_new(batch, f"{folder}/store")
    assert not Path(folder, "store").exists()


def test_stream_appends_each_page_once(spark, folder):
    schema = "url string, text string"
    store, source = f"{folder}/store", f"{folder}/in"
    batches = [[("a", "1"), ("b", "2")], [("b", "other"), ("c", "3")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema(schema).json(source)
        query = append_new_pages(stream, store, f"{folder}/checkpoint")
        assert query.awaitTermination(120)
    got = {tuple(r) for r in files.read_jsonl(spark, store, schema).collect()}
    assert got == {("a", "1"), ("b", "2"), ("c", "3")}


def test_report_tables(spark, folder):
    kpi = spark.sql("SELECT 3L AS total_orders, CAST(1.23456 AS double) AS avg_order_value")
    detail = spark.sql("SELECT 'x' AS region, CAST(1.23456 AS double) AS total_revenue")
    files.write_report({"summary_stats": kpi, "revenue_by_region": detail}, f"{folder}/report")
    assert spark.read.json(f"{folder}/report/summary_stats").first().asDict() == {"total_orders": 3, "avg_order_value": 1.2346}
    assert spark.read.json(f"{folder}/report/revenue_by_region").first().total_revenue == 1.23456


def test_register(spark):
    files.register(synthetic.synthetic_trips(spark, 10), "some_trips")
    assert spark.sql("SELECT count(*) AS n FROM some_trips").first().n == 10
    spark.catalog.dropTempView("some_trips")


def test_union_of_files_feeds_the_reports(spark, three_files):
    df = files.read_parquet(spark, three_files).select((F.col("id") % 24).cast("int").alias("hour_of_day"), F.col("square").cast("double").alias("fare_amount"))
    assert trips.hourly_revenue(df).agg(F.sum("trip_count")).first()[0] == 35


def test_malformed_lines_are_kept_and_all_lines_are_counted(spark, folder):
    target = Path(folder) / "store"
    target.mkdir()
    (target / "a.json").write_text('{"id": 1, "name": "x"}\n\n{"id": 2\n   \n{"id": "three", "name": "y"}\n')
    (target / "b.json").write_text('plain text\n{"id": 4}\n{"name": null, "other": 5}\n')
    rows, rejects, counts = files.read_jsonl_checked(spark, str(target), "id bigint, name string")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, "x"), (4, None), (None, None)], key=str)
    assert {(r.file.rsplit("/", 1)[1], r.line) for r in rejects.collect()} == {("a.json", '{"id": 2'), ("a.json", '{"id": "three", "name": "y"}'), ("b.json", "plain text")}
    got = {r.file.rsplit("/", 1)[1]: (r.lines, r.good, r.bad, r.blank) for r in counts.collect()}
    assert got == {"a.json": (5, 1, 2, 2), "b.json": (3, 2, 1, 0)}
    same = files.read_jsonl(spark, str(target), "id bigint, name string")
    assert same.exceptAll(rows).isEmpty() and rows.exceptAll(same).isEmpty()


def test_quarantine_adds_to_the_side_table(spark, folder):
    Path(folder, "x.json").write_text('{"id": 1}\nbroken\n')
    for run in (1, 2):
        assert files.quarantine_jsonl(spark, f"{folder}/x.json", "id bigint", f"{folder}/rejects").count() == 1
        assert [r.line for r in spark.read.parquet(f"{folder}/rejects").collect()] == ["broken"] * run
    rows, rejects, counts = files.read_jsonl_checked(spark, f"{folder}/nowhere", "id bigint")
    assert rows.count() == rejects.count() == counts.count() == 0


def test_an_unfinished_or_outdated_table_is_built_again(spark, folder):
    source, path = f"{folder}/source", f"{folder}/clean"
    numbers(spark, 0, 5).write.parquet(source)

    def write(version=""):
        return files.write_cleaned(spark.read.parquet(source), path, version=version).count()

    assert write() == 5 and files.read_manifest(spark, path)["rows"] == 5
    numbers(spark, 0, 3).write.mode("overwrite").parquet(path)
    assert write() == 5, "a table with other rows than its manifest says"
    session.remove_path(spark, f"{path}-manifest")
    numbers(spark, 50, 55).write.mode("overwrite").parquet(path)
    assert files.read_manifest(spark, path) is None
    assert write() == 5 and spark.read.parquet(path).agg(F.max("id")).first()[0] == 4, "a table without a manifest"
    numbers(spark, 5, 7).write.mode("append").parquet(source)
    assert write() == 7, "new input files"
    before = {f.name for f in Path(path).glob("part-*")}
    assert write() == 7 and {f.name for f in Path(path).glob("part-*")} == before, "reused"
    assert write("2") == 7 and {f.name for f in Path(path).glob("part-*")} != before, "another version"


def test_first_copy_in_file_order(spark, folder):
    for name, rows in {"b": [(1, "late"), (2, "only b")], "a": [(3, "x"), (1, "early"), (1, "again"), (3, "y")]}.items():
        spark.createDataFrame(rows, "order_id int, region string").coalesce(1).write.parquet(f"{folder}/{name}")
        part = next(Path(folder, name).glob("part-*.parquet"))
        (Path(folder) / "all").mkdir(exist_ok=True)
        (Path(folder) / "all" / f"{name}.parquet").write_bytes(part.read_bytes())
    raw = files.read_parquet(spark, f"{folder}/all").withColumn("revenue", F.lit(1.0)).withColumn("date", F.lit("2024-01-02"))
    cleaned = cleaning.clean_sales(raw, order=files.file_order())
    assert {(r.order_id, r.region) for r in cleaned.collect()} == {(1, "early"), (2, "only b"), (3, "x")}


def test_row_numbers_stay_when_a_scan_is_cut_otherwise(spark, folder):
    spark.range(20_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(3).write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    seen = {r.id: r.n for r in files.with_row_number(table, "n").select("id", "n").collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        again = files.with_row_number(table, "n")
        assert {r.id: r.n for r in again.select("id", "n").collect()} == seen and len(set(seen.values())) == 20_000
        assert again.columns == ["id", "x", "n"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert files.has_file_order(table) and not files.has_file_order(spark.range(3))


def test_first_copy_in_file_order_over_more_tasks(spark, folder, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 700).alias("order_id"), F.col("id").cast("string").alias("region"), F.lit(1.0).alias("revenue"), F.lit("2024-01-02").alias("date"))
    # One order has very many copies.
    rows.unionByName(rows.where("order_id < 400").withColumn("order_id", F.lit(5).cast("bigint"))).repartitionByRange(5, F.col("region")).write.parquet(f"{folder}/t")
    raw = files.read_parquet(spark, f"{folder}/t")
    plain = cleaning.clean_sales(raw, order=files.file_order())
    over = cleaning.clean_sales(raw, order=files.file_order(), tasks=40)
    assert over.columns == plain.columns and over.rdd.getNumPartitions() == 40
    assert {tuple(r) for r in over.collect()} == {tuple(r) for r in plain.collect()} and over.count() == 700


def test_tasks_follow_the_order_lines(spark, folder, monkeypatch):
    spark.range(900).select(F.col("id").alias("l_orderkey")).write.parquet(f"{folder}/lineitem.parquet")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bindings.line_tasks(spark, folder) is None
    monkeypatch.setattr(bindings, "TASK_LINES", 30)
    assert bindings.line_tasks(spark, folder) == 30 > partitions
    assert bindings._by_order(spark, folder).rdd.getNumPartitions() == 30
