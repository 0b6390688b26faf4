"""Python workers that cannot import this repository run the queries all the same."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from aerolith.session import build_session

spark = build_session(
    "foreign", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
    spark__checkpoint__dir={scratch!r},
)
spark.sparkContext.setLogLevel("ERROR")


def importable(batches):
    import importlib.util
    import pyarrow as pa

    for batch in batches:
        found = importlib.util.find_spec("aerolith") is not None
        yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows)], names=["found"])


assert not spark.range(1).mapInArrow(importable, "found boolean").first()["found"]
from __spark_entry__ import queries

for name in ("op2_warc_index", "op3_simhash", "op6_packing", "op7_neighbours", "op8_licences", "op10_toxicity",
             "op12_vector_codes", "op13_hard_negatives"):
    assert queries()[name](spark, "/root/testdata/sf0.001").count() >= 0, name
print("all of them")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = textwrap.dedent(SCRIPT).format(repo=REPO, scratch=str(tmp_path / "scratch"))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all of them" in done.stdout, done.stderr[-3000:]
