from __future__ import annotations

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["strain", "chrom", "cluster_start", "cluster_size", "cluster_end"]
    rows = df.collect()
    assert len(rows) == 71  # SURVEY regression target at sf0.001


def test_catalogue_consistent():
    qs = entry_mod.queries()
    oracles = entry_mod.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 100


def test_regression_targets(spark):
    q = entry_mod.queries()
    assert q["divergent_regions"](spark, "/root/testdata/sf0.01").count() == 547
    assert q["drop_deletions"](spark, "/root/testdata/sf0.01").select("chrom", "start_bin", "strain").count() == 11469


def test_pandas_steps_run_outside_the_repo():
    """Python workers must import the package whatever the driver's working
    directory is (it is shipped with addPyFile)."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', e.queries()['haplotype_components'](s, '/root/testdata/sf0.001').count())\n"
    ) % repo
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd="/tmp", env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS " in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS ")[1].split()[0]) > 0


def test_inventory_covers_survey_and_catalogue():
    from genoframe.plans.inventory import INVENTORY

    ids = set(INVENTORY)
    expected = (
        {f"A{i}" for i in range(1, 11)}
        | {f"B{i}" for i in range(1, 24)}
        | {f"C{i}" for i in range(1, 5)}
        | {f"D{i}" for i in range(1, 18)}
        | {f"E{i}" for i in range(1, 23) if i != 14}
        | {f"F{i}" for i in range(1, 9)}
        | {f"G{i}" for i in range(1, 10)}
    )
    assert ids == expected  # 92 operators (E14 is an unused number)
    named = {q for qs in INVENTORY.values() for q in qs}
    assert named == set(entry_mod.queries()) - set(entry_mod.LLM_QUERIES)
