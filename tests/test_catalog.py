"""Registered queries against their SQL in DuckDB, and the entry point without the corpus part."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from geotide.plans import catalog

TABLES = "/root/testdata/sf0.001"
#: A cross-section; the driver runs all of them.
NAMES = ["latest_merge", "density_merge", "cell_parent", "event_id_fnv", "bgp_geo", "asn_centroid_join", "lpm_join", "maneuver_detect", "src_csv_quoted", "sorted_layout"]


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables here")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{TABLES}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = catalog.QUERIES[name](spark, TABLES)
    cols = sorted(df.columns)
    got = sorted(str(tuple(r[c] for c in cols)) for r in df.collect())
    rel = con.execute(catalog.ORACLES[name])
    at = [d[0] for d in rel.description]
    assert sorted(at) == cols
    assert got == sorted(str(tuple(r[at.index(c)] for c in cols)) for r in rel.fetchall())


def test_src_element_text_on_large_keys(spark, tmp_path):
    """Keys as larger tables have them: more than five digits, to the end of Alpha-5 and beyond."""
    keys = [0, 7, 99_999, 100_000, 119_999, 339_999, 340_000, 1_199_999, 5_000_000_007]
    spark.createDataFrame([(k, f"part {k}") for k in keys], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    rel = con.execute(catalog.ORACLES["src_element_text"])
    got = catalog.QUERIES["src_element_text"](spark, str(tmp_path)).select(*[d[0] for d in rel.description]).collect()
    assert sorted(tuple(r) for r in got) == sorted(rel.fetchall()) and len(got) == len(keys)


def test_entry_without_corpus_part(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys\nsys.modules['geotide.llm'] = None\nimport __spark_entry__ as e\nassert set(e.oracle_sql()) <= set(e.queries()) and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@pytest.mark.parametrize("left", ["corpus_pipeline.py", ""])
def test_entry_where_an_empty_folder_is_left(tmp_path, left):
    """Files deleted, but not their folder and its cache."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    gone = [".git", "tests", "llm"] + ([] if left else ["corpus_pipeline.py"])
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(*gone))
    (tmp_path / "repo/geotide/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e\nassert len(e.queries()) > 60 and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120)
