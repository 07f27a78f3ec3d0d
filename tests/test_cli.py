"""The command-line driver in its own process (its own Spark session)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    return subprocess.run([sys.executable, "-m", "payerlake.cli", *args], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)


def test_cli_tables_gate_drop():
    root = tempfile.mkdtemp(prefix="payerlake-cli-")
    out = run("--root", root, "--master", "local[2]", "tables")
    assert out.returncode == 0, out.stderr[-2000:]
    gate = run("--root", root, "--master", "local[2]", "gate")
    assert gate.returncode == 0 and '"passed": true' in gate.stdout      # no rows passes
    refused = run("--root", root, "--master", "local[2]", "drop")
    assert refused.returncode != 0                                       # needs --confirm
    dropped = run("--root", root, "--master", "local[2]", "--confirm", "drop")
    assert dropped.returncode == 0 and "silver.claims" in dropped.stdout


def test_cli_ingest_and_reports():
    import json
    from payerlake.operators import standardize as S
    root = tempfile.mkdtemp(prefix="payerlake-cli-")
    folder = f"{root}/raw/provider=payer_c/year=2015/month=3"
    os.makedirs(folder)
    cols = S.wire_columns("payer_c")
    row = dict(CLAIM_ID="c-1", SUBSCRIBER_ID="P1", RENDERING_PROVIDER_NPI="7", RECEIVED_DT="20150301", SVC_FROM_DT="20150225",
               SVC_TO_DT="20150226", DIAG_CD="E11.9", PROC_CD="99213", BILLED_AMT="100.00", ALLOWED_AMT="80.00",
               PAID_AMT="76.00", CLM_STATUS="PAID", CLM_TYPE="Outpatient")
    for name, header in (("good.csv", cols), ("bad.csv", [*cols[:-1], "OTHER"])):
        with open(f"{folder}/{name}", "w") as f:
            f.write(",".join(header) + "\n" + ",".join(row[c] for c in cols) + "\n")
    base = ("--root", root, "--master", "local[2]")
    assert run(*base, "bronze").returncode == 0
    out = run(*base, "--min-claim-date", "2010-01-01", "silver")
    assert out.returncode == 1 and '"failed": 1' in out.stdout       # a column is missing; the other file is in
    assert run(*base, "gold").returncode == 0
    out = run(*base, "report")
    rows = json.loads(out.stdout.strip().splitlines()[-1])
    assert rows["registry_list"] == 2 and rows["log_failed"] == 1 and rows["payer_compare"] == 1
    assert os.path.isdir(f"{root}/reports/claims_by_payer")
