import pytest
from test_feed import HEADER, line, write

from tillroll.__main__ import main


@pytest.fixture
def lines():
    return [line("O1"), line("O2", "Bob", "Net"), line("O1")]


def test_load_validate_export(spark, tmp_path, capsys, lines):
    feed = write(tmp_path / "feed.csv", HEADER, *lines)
    root, clean, report, flat = (str(tmp_path / n) for n in ("warehouse", "clean", "report", "flat"))
    assert main(["load", feed, root, "--clean-csv", clean, "--report", report]) == 0
    assert main(["validate", root]) == 0
    out = capsys.readouterr().out
    assert out.count("[PASS]") == 8 and "8/8 checks passed." in out
    assert main(["export", root, flat]) == 0
    assert spark.read.csv(clean, header=True).count() == 2
    assert spark.read.csv(flat, header=True).count() == 2
    assert spark.read.text(report).where("value = 'duplicate_rows_removed        : 1'").count() == 1


def test_validate_fails_with_an_exit_code(spark, tmp_path, capsys, lines):
    twice = line("O1").replace(",1,2.00,", ",3,2.00,")
    feed = write(tmp_path / "feed.csv", HEADER, *lines, twice)
    root = str(tmp_path / "warehouse")
    assert main(["load", feed, root, "--single-line"]) == 0
    assert main(["validate", root]) == 1
    assert "[FAIL] No duplicate (order_id, product_key, date_key) lines (violations: 1)" in capsys.readouterr().out
