"""Task code on executors that have no copy of this package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import helpers
import pytest

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from groundsill.session import build_session
import __spark_entry__ as contract
spark = build_session("travel", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                      spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("OFF")
def absent(rows):
    try:
        import groundsill
        yield 1
    except ImportError:
        yield 0
assert sum(spark.sparkContext.parallelize(range(4), 4).mapPartitions(absent).collect()) == 0
for key in {keys!r}:
    print(key, contract.queries()[key](spark, {sf!r}).count())
"""


@pytest.mark.parametrize("keys", [
    ["op2_html_extraction", "op3_minhash_near_dedup", "op4_token_counts", "op5_neighbours"],
    ["op6_decontaminate", "op8_warc", "op9_language_id", "op10_substring_dedup"],
    ["op11_fill_in_middle", "op12_phrase_collocations", "op13_personal_data", "pipeline"],
])
def test_queries_run_without_the_package_on_executors(tmp_path, keys):
    code = SCRIPT.format(repo=str(REPO), sf=helpers.SF_DIR, keys=keys)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line] == keys
