"""The command line runs the daily flow: export -> load -> run -> check."""

import os

from finsight.__main__ import main
from conftest import SF_SMOKE


def test_cli_flow(spark, scratch_dir):
    land, root = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "wh")
    assert main(["export-fixture", "--sf-dir", SF_SMOKE, "--out", land]) == 0
    assert main(["load", "--csv-dir", land, "--root", root]) == 0
    assert spark.read.parquet(os.path.join(root, "raw", "primes")).count() > 0
    # raw e-mails contain NULLs: the gated run stops after staging (exit code 1)
    assert main(["run", "--root", root]) == 1
    assert main(["check", "--root", root]) == 1  # no mart was written
    assert main(["run", "--root", root, "--no-tests", "--select", "churn"]) == 0
    assert main(["run", "--root", root, "--no-tests"]) == 0
    assert os.path.isdir(os.path.join(root, "marts", "fct_kpis_portefeuille"))
    assert main(["check", "--root", root]) == 0
