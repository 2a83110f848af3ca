"""Split text files read as quoted CSV, against Spark's own reader of whole files."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from crashlake import schema as S
from crashlake.plans.load import load_feed
from crashlake.sources import store
from crashlake.sources.csv_records import read_lines, records
from crashlake.sources.feed import CORRUPT_COL, CSV_OPTIONS, read_feed
from helpers import base_row
from test_load import write_csv


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k, None) for k in keys]
    yield lambda size: [spark.conf.set(k, str(size)) for k in keys]
    for k, v in zip(keys, old):
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plain(text):
    """Records by walking over the characters once."""
    out, field_start, quoted, at, i = [], True, False, 0, 0
    while i < len(text):
        c = text[i]
        if quoted:
            if c == '"' and text[i + 1:i + 2] == '"':
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"' and field_start:
            quoted = True
        elif c == "\n":
            out.append(text[at:i])
            at = i + 1
        field_start = not quoted and c in ",\n"
        i += 1
    return [r.removesuffix("\r") for r in [*out, text[at:]] if r.removesuffix("\r")]


@pytest.mark.parametrize("size", [7, 40, 300, 10**6])
def test_records_over_split_borders(spark, scratch, small_splits, size):
    rng = random.Random(size)
    texts = []
    for k in range(3):
        fields = ["a", "", "12", 'say "x"', "a,b", "two\nlines", '"\n"', "\n\n\n", ",\n,", "é\r\nü", 'in"ch', '""', "long " * 30 + "\n" + "z" * 90]
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        for _ in range(60):
            writer.writerow([rng.choice(fields) for _ in range(rng.randint(1, 4))])
        texts.append(out.getvalue() + ('5" pipe,x\n"tail",\n\n"open to the end\nof it' if k == 1 else ""))
        with open(os.path.join(scratch, f"{k}.csv"), "w", newline="", encoding="utf-8") as f:
            f.write(texts[-1])
    small_splits(size)
    lines, n = read_lines(spark, scratch)
    assert n == 3
    lines.write.parquet(os.path.join(scratch, "lines"))
    lines = spark.read.parquet(os.path.join(scratch, "lines"))
    if size <= 300:
        assert lines.select("file", "block").distinct().count() > 6
    got = records(lines).orderBy("file", "block", "row").collect()
    for k in range(3):
        assert [r.value for r in got if r.file.endswith(f"{k}.csv")] == plain(texts[k])


def test_rows_as_the_reader_of_whole_files(spark, scratch, small_splits):
    rng = random.Random(2)
    streets = ["MAIN ST", 'A "quoted", ST', "two\nlines", ",\n", "", None, "x" * 300 + '\n"', "plain"]
    rows = [base_row(i, on_street_name=rng.choice(streets), borough=rng.choice(["BRONX", "a,b", None])) for i in range(400)]
    path = os.path.join(scratch, "feed.csv")
    write_csv(path, rows)
    with open(path, "a", newline="") as f:
        f.write("1,too,few\r\n" + ",".join(["x"] * 40) + "\r\n")
    schema = ", ".join(f"{c} string" for c in [*S.FEED_COLUMNS, CORRUPT_COL])
    whole = spark.read.schema(schema).options(**CSV_OPTIONS).option("header", True).option("multiLine", True).csv(path)
    want = [tuple(r)[:-1] + (r[-1] is not None,) for r in whole.withColumn("i", F.monotonically_increasing_id()).orderBy("i").drop("i").collect()]
    small_splits(900)
    feed = read_feed(spark, path)
    got = [tuple(r[c] for c in S.FEED_COLUMNS) + (r[CORRUPT_COL] is not None,) for r in feed.orderBy("_order").collect()]
    assert got == want and sum(r[-1] for r in got) == 2
    assert feed.select("_order.block").distinct().count() > 20  # many tasks share the one file


def test_a_single_file_without_the_id_is_an_error(spark, scratch):
    path = os.path.join(scratch, "one.csv")
    write_csv(path, [base_row(1)], [c for c in S.FEED_COLUMNS if c != "collision_id"])
    with pytest.raises(ValueError, match="collision_id"):
        read_feed(spark, path)
    with pytest.raises(ValueError, match="collision_id"):
        load_feed(spark, path, os.path.join(scratch, "store"))


def test_the_feed_is_read_once(spark, scratch):
    path = os.path.join(scratch, "one.csv")
    write_csv(path, [base_row(i) for i in range(30)])
    plan = read_feed(spark, path)._jdf.queryExecution().toString()
    assert "one.csv" not in plan and "text" not in plan.split("== Physical Plan ==")[1].lower().split("parquet")[0]


def test_the_same_name_with_other_content_is_another_load(spark, scratch):
    path, root = os.path.join(scratch, "feed.csv"), os.path.join(scratch, "store")
    write_csv(path, [base_row(1, number_of_persons_killed="-1")])
    first = load_feed(spark, path, root)
    assert load_feed(spark, path, root) == first
    write_csv(path, [base_row(2, number_of_persons_killed="-1"), base_row(3)])
    os.utime(path, (1, 1))
    assert load_feed(spark, path, root) != first
    assert spark.read.parquet(os.path.join(root, "_rejects")).count() == 2
    assert store.read_tables(spark, root).collisions.count() == 1
