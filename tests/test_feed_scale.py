import datetime as dt
import glob
import os
import re

import pytest
from helpers import base_row, feed, rows
from pyspark.sql import functions as F

from crashlake.functions import clean as C
from crashlake.operators import normalize as N
from crashlake.plans import catalog
from crashlake.session import ensure_checkpoint_dir, shuffles_end, small_methods
from crashlake.sources import fixtures as fx
from crashlake.sources.csv_records import read_lines, records


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture()
def source(spark, scratch):
    """Orders of no, two and seven lines; a line without a part counts for its order's collisions only."""
    day = dt.datetime(1997, 3, 5)
    parts = [(1, "red one", "B1", "T1"), (5, "blue five", "B5", "T5"), (7, "seven", "B7", "T7"), (8, "eight", "B8", "T8"), (9, "nine", "B9", "T9")]
    lines = [(3, p, 1, n, 1.0) for n, p in enumerate((1, 5, 7, 8, 9, 8, 1), start=1)]
    lines += [(20, 1, 1, 1, 1.0), (20, 8, 1, 2, 1.0), (20, 99, 1, 3, 1.0), (77, 1, 1, 1, 1.0)]
    made = {
        "region": spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.createDataFrame([(1, 0, "AUTO")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": spark.createDataFrame([(2, 1, day), (3, 1, day), (20, 1, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": spark.createDataFrame([(*r, day) for r in lines], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp"),
    }
    for name, df in made.items():
        df.write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def test_tables_that_grow_are_not_sent_to_the_driver(spark, source):
    for df in (fx.fx_lines(spark, source), fx.fx_raw(spark, source), fx.fx_collisions(spark, source)):
        for key in ("p_partkey", "c_custkey"):
            assert not any("BroadcastHashJoin" in x and key in x for x in _plan(df).splitlines())


def test_raw_slots_are_the_lines_of_each_collision(spark, source):
    pivot = fx.fx_lines(spark, source).groupBy("collision_id").agg(*[F.expr(sql).alias(name) for name, sql in fx.SLOT_PIVOT])
    texts = [(f"{t}{i}", f(f"s{i}")) for i in range(1, 6) for t, f in (("v", fx._vehicle_text), ("f", fx._factor_text))]
    want = fx._select(pivot, [("collision_id", "collision_id"), *texts])
    got = fx._raw_slots(spark, source).select(want.columns)
    assert "Aggregate" not in _plan(got)
    assert rows(got, "collision_id") == rows(want, "collision_id") and got.count() == 4
    # order 2 has no lines; order 20 comes twice, the first copy with a blank first slot
    raw = {r.src_seq: r for r in fx.fx_raw(spark, source).collect()}
    assert sorted(raw) == [4, 6, 40, 41, (3 + 2**40) * 2]
    assert (raw[40].vehicle_type_code1, raw[41].vehicle_type_code1) == (None, " T1 ")


def test_one_file_is_written_by_a_task_without_join_or_sort(spark, source):
    plan = _plan(catalog._one_partition(catalog.quoted_feed(spark, source)))
    assert "Coalesce" in plan and not any(x in plan for x in ("Join", "Sort", "Window", "Aggregate"))


def test_what_several_tables_are_made_of_is_staged_once(spark):
    raw = feed(spark, [base_row(1, zip_code="1" * 11), base_row(2), base_row(2, borough="QUEENS")])
    clean, seen = N.clean_feed(raw), []

    def write(df, label):
        seen.append(label)
        return df
    a, b = N.normalize_feed(clean, write=write), N.normalize_feed(clean)
    assert sorted(seen) == ["boroughs", "candidates", "factor-values", "factors", "repeated", "vehicle-types", "vehicle-values"]
    assert rows(a.rejects) == rows(b.rejects) == [(1, "zip_code_too_long")]
    assert rows(a.new.collisions.select("collision_id")) == [(2,)]


def test_cleaning_of_odd_texts(spark):
    texts = ["  a b ", "\t a ", "　x\x1c", " \n ", "", "é ", None, "a"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(C.strip_ws("t")).collect()
    assert [r[0] for r in got] == [t if t is None else t.strip() for t in texts]
    numbers = ["12", "12.7", "1e2", " 3 ", "+4", "1 2", "5d", "99999999999", "9007199254740993", "2.5", "", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(numbers)], "i int, t string").orderBy("i").select(C.parse_id("t"), C.parse_count("t")).collect()
    assert [r[0] for r in got] == [12, 12, 100, 3, 4, None, None, 99999999999, 9007199254740993, 2, None, None]
    assert [r[1] for r in got] == [12, 13, 100, 3, 4, None, None, None, None, 3, None, None]
    zips = ["11201.0", "11201", "a.0", "1.05", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(zips)], "i int, t string").orderBy("i").select(C.parse_zip("t")).collect()
    assert [r[0] for r in got] == ["11201", "11201", "a.0", "1.05", None]


def test_the_sessions_setting_comes_back(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), small_methods(spark):
        assert spark.conf.get(key) == "8000"
        raise ValueError
    assert spark.conf.get(key) == before


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write_that_made_them(spark, scratch):
    before, df = _shuffle_files(spark), spark.range(100).repartition(3)
    with shuffles_end(spark):
        df.write.parquet(f"{scratch}/a")
    assert not _shuffle_files(spark) - before
    df.write.parquet(f"{scratch}/b")
    assert _shuffle_files(spark) - before


def test_one_file_keeps_the_file_and_its_lines_only(spark, source):
    here = ensure_checkpoint_dir(spark).removeprefix("file://").rstrip("/")
    files, shuffles = set(glob.glob(f"{here}/**/part-*", recursive=True)), _shuffle_files(spark)
    got = catalog._read_one(spark, source)
    left = {os.path.relpath(f, here).split("/")[0].rsplit("-", 1)[0] for f in set(glob.glob(f"{here}/**/part-*", recursive=True)) - files}
    assert left == {"crashlake-feed", "crashlake-feed-lines", "crashlake-feed-headers"}
    assert len({f.split("_")[1] for f in _shuffle_files(spark) - shuffles}) <= 1  # of counting the headers
    want = catalog.quoted_feed(spark, source).select(*got.columns[:-1])
    assert sorted(map(str, rows(got.drop("broken")))) == sorted(map(str, rows(want))) and got.count() == 5


def test_lines_are_moved_once_and_only_those_of_records_that_run_on(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as f:
        f.write('collision_id,on_street_name\n1,"a\nb"\n2,c\n')
    lines, _ = read_lines(spark, f"{scratch}/a.csv")
    lines.write.parquet(f"{scratch}/lines")
    found, key = records(spark.read.parquet(f"{scratch}/lines")), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # however many lines there are
    try:
        plan = _plan(found)
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin [file" in plan and "SortMergeJoin" not in plan
    assert "Window" in plan and not re.search(r"Window .*\[file#\d+, block#\d+L?\]", plan)  # over one row a split only
    assert [r.value for r in found.orderBy("row").collect()] == ["collision_id,on_street_name", '1,"a\nb"', "2,c"]
