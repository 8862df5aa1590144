import pytest
from pyspark.sql import functions as F

from furrow.operators import models, quality
from furrow.sources import files, shared, tables


@pytest.fixture
def schema(spark):
    path = shared.fresh_path(spark, "tables")
    return tables.ensure_schema(spark, f"t_{path[-12:]}", path)


def numbers(spark, *ids, **more):
    return spark.createDataFrame([(i,) for i in ids], "id int").withColumns({k: F.lit(v) for k, v in more.items()})


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared.shared_folder(spark) == named
    assert shared.fresh_path(spark, "x").startswith(named + "/")
    assert shared.fresh_path(spark, "x") != shared.fresh_path(spark, "x")


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    def __init__(self, master):
        self.master, self.applicationId, self.sparkContext, self.conf = master, f"app-{master}", self, self

    def getConf(self):
        return self

    def get(self, name, default=None):
        return default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared.shared_folder(Elsewhere("spark://head:7077"))
    local = Elsewhere("local[2]")
    assert shared.shared_folder(local) == shared.shared_folder(local)


def test_written_once_builds_once(spark, rows):
    built = []

    def build():
        built.append(1)
        return numbers(spark, 1, 2, day="d")

    for _ in range(2):
        assert rows(shared.written_once(spark, "once-test", build, ["day"]), "id") == [(1,), (2,)]
    assert built == [1]


def test_csv_types_and_padding(spark):
    path = shared.fresh_path(spark, "csv")
    keep = dict(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    spark.sql("SELECT 1 AS id, ' a ' AS name, 2.5 AS x").write.options(**keep).csv(path)
    inferred = files.scan_csv(spark, path)
    assert dict(inferred.dtypes) == {"id": "int", "name": "string", "x": "double"}
    assert inferred.first().name == " a "
    assert files.scan_csv(spark, path, trim=True).first().name == "a"
    given = files.scan_csv(spark, path, "id string, name string, x string")
    assert set(dict(given.dtypes).values()) == {"string"}
    audited = files.with_audit(given).first()
    assert audited._source_file.endswith(".csv") and audited._ingestion_timestamp is not None


def test_required_columns(spark):
    df = numbers(spark, 1)
    assert files.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="depth"):
        files.require_columns(df, ["id", "depth"])


def test_schema_profile(spark, rows):
    frame = spark.sql(
        "SELECT * FROM VALUES (1, 'b', 2.5D, array(1)), (NULL, 'a', double('NaN'), NULL), (3, NULL, NULL, NULL) AS t(id, name, x, `odd name`)"
    )
    assert rows(files.schema_profile(frame)) == [
        (1, "id", "int", True, 3, 2, 0, "1", "3", 2), (2, "name", "string", True, 3, 2, 0, "a", "b", 2),
        (3, "x", "double", True, 3, 1, 1, "2.5", "2.5", 1), (4, "odd name", "array<int>", True, 3, 1, 0, None, None, None)]
    empty = files.schema_profile(frame.limit(0)).collect()
    assert [(r["rows"], r.present, r.least, r.about_distinct) for r in empty] == [(0, 0, None, 0)] * 3 + [(0, 0, None, None)]


def test_profile_is_one_aggregate(spark):
    plan = files.schema_profile(numbers(spark, 1, name="x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def landing_file(spark, lines):
    path = shared.fresh_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_lines_that_do_not_fit(spark, rows):
    lines = ["id,name,x", "1, a ,2.5", "2,b", "3,c,1.0,more", "four,d,1.0", "5,e,wet", "", "6,\"q,r\",3", "7,,"]
    accepted, rejected = files.scan_checked(spark, landing_file(spark, lines), "id int, name string, x double")
    assert rows(accepted) == [(1, " a ", 2.5), (6, "q,r", 3.0), (7, None, None)]
    assert rows(rejected, "_line") == [("2,b",), ("3,c,1.0,more",), ("5,e,wet",), ("four,d,1.0",)]
    assert all("lines" in r._source_file for r in rejected.collect())


def test_another_header_is_refused(spark):
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_checked(spark, landing_file(spark, ["id,x,name", "1,2.5,a"]), "id int, name string, x double")


def test_all_lines_fit_or_none_are_there(spark):
    accepted, rejected = files.scan_checked(spark, landing_file(spark, ["id", "1"]), "id int")
    assert accepted.count() == 1 and rejected.count() == 0
    accepted, rejected = files.scan_checked(spark, landing_file(spark, ["id"]), "id int")
    assert accepted.count() == 0 and rejected.count() == 0


def test_replace_changes_rows_and_schema(spark, schema, rows):
    table = f"{schema}.r"
    tables.replace_table(numbers(spark, 1, 2, 3), table)
    tables.replace_table(numbers(spark, 9, name="x"), table)
    assert rows(spark.table(table)) == [(9, "x")]


def test_partitioned_table_prunes(spark, schema):
    table = f"{schema}.p"
    frame = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("day"))
    tables.replace_table(frame, table, ["day"])
    one = spark.table(table).filter("day = 2")
    assert one.count() == 25
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_empty_refresh(spark, schema):
    table = f"{schema}.e"
    frame = spark.range(10).select("id", F.lit("d").alias("day"))
    for part in ([], ["day"]):
        tables.replace_table(frame, table, part)
        assert tables.replace_table(frame.filter("id < 0"), table, part).count() == 0
        assert spark.table(table).columns == ["id", "day"]


def test_rewrite_from_itself(spark, schema, rows):
    table = f"{schema}.w"
    tables.replace_table(spark.sql("SELECT 1 AS id, CAST(NULL AS DOUBLE) AS t UNION ALL SELECT 2, 5.0D"), table)
    tables.rewrite_table(spark, table, lambda df: quality.fill_columns(df, {"t": 0.0}))
    assert rows(spark.table(table)) == [(1, 0.0), (2, 5.0)]


def test_failed_refresh_keeps_the_old_table(spark, schema, rows):
    table = f"{schema}.k"
    tables.replace_table(numbers(spark, 1), table)
    broken = numbers(spark, 2).withColumn("x", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        tables.replace_table(broken, table)
    assert rows(spark.table(table)) == [(1,)]


def test_refresh_by_columns_sql_cannot_name(spark, schema, rows):
    """Vectors round-trip; a frame that the catalog refuses leaves the old table."""
    table = f"{schema}.v"
    tables.replace_table(numbers(spark, 1), table)
    vectors = models.assemble(spark.sql("SELECT 1.0D AS a, 2.0D AS b"), ["a", "b"])
    assert list(tables.replace_table(vectors, table).first().features) == [1.0, 2.0]
    with pytest.raises(Exception):
        tables.replace_table(spark.sql("SELECT 1 AS a, 2 AS a"), table)
    assert spark.table(table).count() == 1


def test_census_goes_on_after_an_unreadable_file(spark, schema):
    tables.replace_table(numbers(spark, 1, 2), f"{schema}.fine")
    path = shared.fresh_path(spark, "broken")
    spark.sql("SELECT 'no parquet' AS value").write.text(path)
    spark.sql(f"CREATE TABLE {schema}.broken (id INT) USING parquet LOCATION '{path}'")
    found = {r.table_name: r for r in tables.census(spark, [f"{schema}.broken", f"{schema}.fine"]).collect()}
    assert found["fine"].record_count == 2 and found["broken"].record_count is None and found["broken"].error


def test_append_is_idempotent_and_evolves(spark, schema, rows):
    table = f"{schema}.a"
    first = spark.sql("SELECT 1 AS id, 'r' AS reason UNION ALL SELECT NULL, 'r' UNION ALL SELECT NULL, 'r'")
    tables.append_new(first, table, ["id", "reason"])
    tables.append_new(first, table, ["id", "reason"])
    assert rows(spark.table(table)) == [(None, "r"), (None, "r"), (1, "r")]
    wider = spark.sql(
        "SELECT 'Q' AS status, 1 AS id, 'r' AS reason, current_timestamp() AS at"
        " UNION ALL SELECT 'Q', 1, 's', current_timestamp() UNION ALL SELECT 'Q', 2, 'r', current_timestamp()")
    for _ in range(2):
        tables.append_new(wider, table, ["id", "reason"])
    assert rows(spark.table(table), "id", "reason", "status") == [
        (None, "r", None), (None, "r", None), (1, "r", None), (1, "s", "Q"), (2, "r", "Q")]
    tables.append_new(numbers(spark, 7), table, ["id", "reason"])
    assert (7, None, None) in rows(spark.table(table), "id", "reason", "status")


def test_append_tells_null_from_empty_and_column_borders(spark, schema):
    table = f"{schema}.f"
    tables.append_new(spark.sql("SELECT 'a' AS x, 'bc' AS y"), table, ["x", "y"])
    tables.append_new(spark.sql("SELECT 'ab' AS x, 'c' AS y UNION ALL SELECT '', '' UNION ALL SELECT NULL, ''"), table, ["x", "y"])
    assert spark.table(table).count() == 4


def test_census_reports_missing_tables(spark, schema, rows):
    tables.replace_table(numbers(spark, 1, 2), f"{schema}.here")
    found = tables.census(spark, [f"{schema}.here", f"{schema}.gone", "no_such_schema.t"])
    assert rows(found, "table_name", "record_count") == [("gone", None), ("here", 2), ("t", None)]
    errors = {r.table_name: r.error for r in found.collect()}
    assert errors["here"] is None and errors["gone"] == "TABLE_OR_VIEW_NOT_FOUND" and errors["t"]
    assert [r.tableName for r in tables.list_tables(spark, schema).collect()] == ["here"]


def data_files(spark, table):
    return {path for path in spark.table(table).inputFiles()}


def days(spark, *ids, add=0):
    return spark.createDataFrame([(i, f"2024-01-0{i % 4 + 1}", float(i + add)) for i in ids], "id int, day string, x double")


def test_refresh_of_partitions_leaves_other_files(spark, schema, rows):
    table = f"{schema}.d"
    tables.replace_table(days(spark, *range(20)), table, ["day"])
    before = data_files(spark, table)
    tables.refresh_partitions(days(spark, 2, 102, add=50).select("x", "day", "id"), table)
    after = data_files(spark, table)
    touched = lambda names: {n for n in names if "day=2024-01-03" in n}
    assert before - after == touched(before) and after - before == touched(after) and touched(after)
    expected = [(i, float(i)) for i in range(20) if i % 4 != 2] + [(2, 52.0), (102, 152.0)]
    assert rows(spark.table(table), "id", "x") == sorted(expected)
    tables.refresh_partitions(days(spark, 7).where("id < 0"), table)
    assert data_files(spark, table) == after


def test_partition_rewritten_from_itself_and_a_new_one(spark, schema, rows):
    table = f"{schema}.i"
    tables.replace_table(days(spark, *range(8)), table, ["day"])
    stored = spark.table(table)
    changed = stored.where("day = '2024-01-01'").withColumn("x", F.col("x") + 100)
    tables.refresh_partitions(changed.unionByName(spark.sql("SELECT 9 AS id, '2024-02-01' AS day, 9.0D AS x")), table)
    assert rows(spark.table(table).where("day IN ('2024-01-01', '2024-02-01')"), "id", "x") == [(0, 100.0), (4, 104.0), (9, 9.0)]
    assert spark.table(table).count() == 9


def test_failed_refresh_of_a_partition_changes_nothing(spark, schema):
    table = f"{schema}.g"
    tables.replace_table(days(spark, *range(8)), table, ["day"])
    before = data_files(spark, table)
    broken = days(spark, 1).withColumn("x", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception):
        tables.refresh_partitions(broken, table)
    assert data_files(spark, table) == before and spark.table(table).count() == 8
    tables.replace_table(numbers(spark, 1), f"{schema}.flat")
    with pytest.raises(ValueError):
        tables.refresh_partitions(numbers(spark, 1), f"{schema}.flat")


def test_readers_never_miss_a_table_that_is_refreshed(spark, schema):
    from threading import Event, Thread

    table, over, seen = f"{schema}.n", Event(), []
    tables.replace_table(days(spark, *range(40)), table, ["day"])

    def read():
        while not over.is_set():
            seen.append(spark.catalog.tableExists(table) and spark.table(table).where("day = '2024-01-01'").count())

    reader = Thread(target=read)
    reader.start()
    try:
        for add in range(4):
            tables.refresh_partitions(days(spark, 1, 5, add=add), table)
    finally:
        over.set()
        reader.join()
    assert seen and set(seen) == {10}


def test_append_reads_only_the_days_of_the_batch(spark, schema, rows):
    table, identity = f"{schema}.h", ["id", "at"]
    history = spark.range(400).select(F.col("id").cast("int"), F.timestamp_seconds(F.col("id") * 6000 + 1704067200).alias("at"))
    tables.append_new(history, table, identity, "at")
    batch = history.where("id BETWEEN 100 AND 120").unionByName(spark.sql("SELECT 900 AS id, timestamp'2024-01-09 01:00:00' AS at"))
    batch = batch.unionByName(spark.sql("SELECT 901 AS id, CAST(NULL AS TIMESTAMP) AS at"))
    stored = tables.in_days(spark.table(table), f"at{tables.DAY}", batch.withColumn(f"at{tables.DAY}", tables.day_of(F.col("at"))))
    assert "PartitionFilters: [at_day" in stored._jdf.queryExecution().executedPlan().toString()
    assert len(stored.inputFiles()) < len(spark.table(table).inputFiles()) / 5 and stored.count() < 60
    for _ in range(2):
        tables.append_new(batch, table, identity, "at")
    assert rows(spark.table(table), "id") == [(i,) for i in [*range(400), 900, 901]]
    with pytest.raises(ValueError):
        tables.append_new(batch, table, ["id"], "at")


def test_append_with_days_evolves_and_takes_older_tables(spark, schema, rows):
    table = f"{schema}.o"
    tables.replace_table(spark.sql("SELECT 1 AS id, timestamp'2024-01-01 00:00:00' AS at"), table)
    wider = spark.sql("SELECT 1 AS id, timestamp'2024-01-01 00:00:00' AS at, 'Q' AS status UNION ALL SELECT 2, timestamp'2024-01-01 00:00:00', 'Q'")
    for _ in range(2):
        tables.append_new(wider, table, ["id", "at"], "at")
    assert rows(spark.table(table), "id", "status") == [(1, None), (2, "Q")]


def test_census_counts_all_readable_tables_in_one_job(spark, schema):
    names = [f"{schema}.c{i}" for i in range(4)]
    for i, name in enumerate(names):
        tables.replace_table(numbers(spark, *range(i)), name) if i else tables.replace_table(numbers(spark, 1).limit(0), name)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("census", "census")
    try:
        found = {r.table_name: r.record_count for r in tables.census(spark, [*names, f"{schema}.gone"]).collect()}
        jobs = tracker.getJobIdsForGroup("census")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"c0": 0, "c1": 1, "c2": 2, "c3": 3, "gone": None} and len(jobs) <= 6
