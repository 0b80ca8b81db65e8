"""Every catalog query against its DuckDB oracle on the smallest scale factor."""

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_catalog_matches_oracles():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"), "--sf", SF_SMALL],
                         capture_output=True, text=True, timeout=3000)
    fails = [ln for ln in out.stdout.splitlines() if ln.startswith("FAIL")]
    assert not fails, "\n".join(fails)
    assert "passed" in out.stdout
