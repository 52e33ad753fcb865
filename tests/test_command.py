"""The command line, with the live readers replaced by small tables."""

from pathlib import Path

import pytest

from samples import two_members
from tallylake import __main__ as command
from tallylake.sources import documents, relational


def test_options():
    options = command.parse(
        ["--output-dir", "/x", "--parts", "4", "--no-csv", "--shuffle-partitions", "8", "--strict"]
    )
    assert (options.output_dir, options.parts, options.no_csv) == ("/x", 4, True)
    assert options.run_id is None and options.strict and not options.dashboards
    with pytest.raises(SystemExit):
        command.parse([])


def test_whole_command(spark, tmp_path, monkeypatch):
    tables = two_members(spark)
    asked = []

    def read_table(session, source, table, cut=None):
        if table.startswith("("):
            return session.sql("SELECT 1 AS lo, 9003 AS hi")
        asked.append((table, cut))
        return tables.by_name()[table]

    for name, value in {"DB_HOST": "h", "DB_PORT": "1", "DB_NAME": "d"}.items():
        monkeypatch.setenv(name, value)
    monkeypatch.setattr(relational, "read_table", read_table)
    monkeypatch.setattr(documents, "read_collection", lambda session: tables.interactions)
    monkeypatch.setattr(command, "build_session", lambda **options: spark)

    out = str(tmp_path / "out")
    kept = []
    monkeypatch.setattr(command, "new_folder", lambda session, label: kept.append(str(tmp_path / label)) or kept[0])
    line = ["--output-dir", out, "--parts", "7", "--shuffle-partitions", "8", "--dashboards"]
    done = command.main(line)
    assert done.flat_rows == 3
    assert kept and not (tmp_path / "snapshot").exists()
    run = Path(done.layout.root)
    assert run.parent == tmp_path / "out" / "runs"
    assert (run / "dashboard" / "chart_points.parquet").exists()
    assert (run / "data_quality_report.json").exists()
    assert dict(asked)["movimentacao"] == relational.KeyRange("id", 1, 9004, 7)
    assert {name for name, _ in asked} == {"associado", "conta", "cartao", "movimentacao"}


def test_empty_table_is_read_whole(spark, monkeypatch):
    source = relational.RelationalSource("jdbc:x")
    monkeypatch.setattr(
        relational,
        "read_table",
        lambda *a: spark.sql("SELECT cast(null AS int) AS lo, cast(null AS int) AS hi"),
    )
    assert relational.key_range(spark, source, "conta", 8) is None
