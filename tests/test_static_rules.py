"""Guard rails: no localCheckpoint, no cross joins, no row-at-a-time Python UDFs, UI off."""
import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1]
SRC = [p for p in (ROOT / "seriesflow").rglob("*.py")] + [ROOT / "__spark_entry__.py", ROOT / "bench.py"]


def test_forbidden_calls_absent():
    bad = re.compile(r"localCheckpoint|crossJoin|how=\"cross\"|@F\.udf|F\.udf\(|@udf\b|\.rdd\.")
    hits = [f"{p.name}:{i}" for p in SRC for i, line in enumerate(p.read_text().splitlines(), 1)
            if bad.search(line)]
    assert hits == []


def test_session_keeps_ui_off():
    assert '"spark.ui.enabled", "false"' in (ROOT / "seriesflow" / "session.py").read_text()
