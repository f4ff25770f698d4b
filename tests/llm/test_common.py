"""Helpers shared by the operators: column names, written steps."""

import subprocess
import sys
from pathlib import Path

from lakemart.llm import common
from lakemart.llm.common import Steps, fresh_names


def test_fresh_names():
    assert fresh_names(["a", "B"], "c", "b", "a") == ["c", "b_", "a_"]
    assert fresh_names(["key", "KEY_"], "key", "key") == ["key__", "key___"]


def test_steps_are_kept_and_dropped(spark):
    steps, setting = Steps(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    one = steps.keep(spark.range(100))
    two = steps.keep(one.groupBy((one.id % 7).alias("k")).count())
    assert spark.conf.get(setting) == before
    paths = [Path(path) for path, _ in steps.kept]
    steps.drop_all_but(two)
    assert two.agg({"count": "sum"}).first()[0] == 100 and [path.exists() for path in paths] == [False, True]
    steps.drop_all_but()
    assert not paths[1].exists()


_HELD = r"""
import re
import pyarrow as pa
from lakemart.llm.common import chunks, words_of

def held():
    return sum(map(int, re.findall(r"Pss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) >> 10

rows = pa.record_batch({"text": pa.array([f"{k} " + "several words here " * 50 for k in range(20_000)])})
for batch in chunks(iter([rows]), 8 << 20):
    words_of(batch.column("text"))
del batch
after = held()
pa.default_memory_pool().release_unused()
print(after - held())
"""


def test_a_worker_holds_no_reserve_once_the_rows_are_read():
    run = subprocess.run(
        [sys.executable, "-c", _HELD],
        capture_output=True, text=True, check=True, cwd=Path(common.__file__).parents[2],
    )
    assert int(run.stdout) < 20
