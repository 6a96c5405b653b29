from __future__ import annotations

import sys

from gantry import LakePaths, read_table
from gantry.__main__ import main
from tests.helpers import FIVE, land, message


def test_job(spark, tmp_path, monkeypatch, capsys):
    base = str(tmp_path / "lake")
    land(f"{base}/landing_zone", FIVE)
    monkeypatch.setattr(sys, "argv", ["gantry", base])
    main()
    assert read_table(spark, LakePaths(base).fact).count() == 3
    other = land(tmp_path / "other", [message("m7", when=None)])
    monkeypatch.setattr(sys, "argv", ["gantry", base, "--landing", other, "--mode", "report", "--full"])
    main()
    assert "timestamp not_null 1" in capsys.readouterr().out
    assert read_table(spark, LakePaths(base).fact).count() == 4
