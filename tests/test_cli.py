"""Command-line argument handling (no Spark work)."""

import pytest

from pricelens.plans import cli


def test_help_exits_cleanly(capsys):
    with pytest.raises(SystemExit) as e:
        cli.main(["--help"])
    assert e.value.code == 0
    assert "refresh" in capsys.readouterr().out


def test_missing_inputs_are_reported():
    with pytest.raises(SystemExit, match="prepare needs"):
        cli.run(None, "prepare", None, None, "out", None)
    with pytest.raises(SystemExit, match="refresh needs"):
        cli.run(None, "refresh", None, "recipe.csv", "out", None, dates=None)
