"""The command line on a small feed (it takes the session that is running)."""

import os

import pytest

from crashlake.__main__ import main
from helpers import base_row
from test_load import write_csv


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("cli"))
    feed = os.path.join(base, "feed.csv")
    write_csv(feed, [base_row(str(i), crash_date=f"2023-{1 + i // 28:02d}-{1 + i % 28:02d}", vehicle_type_code1="Sedan",
                              contributing_factor_vehicle_1="Speeding") for i in range(60)])
    main(["load", "--feed", feed, "--store", f"{base}/store"])
    return f"{base}/store"


def test_default_window_and_whole_results(root, capsys):
    main(["query", "kpi", "--store", root])
    assert "1 of 1 rows" in capsys.readouterr().out
    main(["query", "trend", "--store", root])  # 30 days back from the last crash date, both ends
    assert "31 of 31 rows" in capsys.readouterr().out
    main(["query", "latest", "--store", root, "--start", "2023-01-01", "--show", "5"])
    out = capsys.readouterr().out
    assert "5 of 60 rows" in out


def test_bucketed_tables_answer_alike(root, capsys):
    main(["bucket", "--store", root, "--database", "crashlake_cli", "--buckets", "4"])
    main(["query", "q2", "--store", root])
    plain = capsys.readouterr().out
    main(["query", "q2", "--database", "crashlake_cli"])
    assert capsys.readouterr().out == plain and "Speeding" in plain


def test_validate_and_star(root, capsys):
    main(["validate", "--store", root])
    main(["star", "--store", root, "--out", f"{root}-star"])
    assert "grain ok" in capsys.readouterr().out
