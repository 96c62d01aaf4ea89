"""The four stages end to end through the command line."""

from locations import SF_SMALL
from sigflow.cli import main
from sigflow.sources.tables import events_as_raw, load_table


def test_cli_four_stages(spark, scratch):
    events_as_raw(load_table(spark, SF_SMALL, "events")).write.option("header", True).csv(f"{scratch}/csv")
    main(["publish", "--csv-dir", f"{scratch}/csv", "--out", f"{scratch}/msgs",
          "--checkpoint", f"{scratch}/ck1", "--available-now"])
    main(["consume", "--messages", f"{scratch}/msgs", "--lake", f"{scratch}/lake",
          "--checkpoint", f"{scratch}/ck2", "--available-now", "--partition-by-date",
          "--typed", "float,double"])
    main(["report", "--lake", f"{scratch}/lake", "--out", f"{scratch}/report",
          "--daily-out", f"{scratch}/daily", "--cast", "double"])
    main(["model", "--report", f"{scratch}/report", "--out", f"{scratch}/model", "--day", "2024-01-19"])
    lake = spark.read.parquet(f"{scratch}/lake")
    assert lake.count() == 1000
    assert "ActivePower_kW_float" in lake.columns and "WindDirection_deg_double" in lake.columns
    assert spark.read.parquet(f"{scratch}/daily").count() == 30
    report = spark.read.parquet(f"{scratch}/report")
    assert "generation_mapping" in report.columns
    assert spark.read.parquet(f"{scratch}/model/coefficients").count() == 5
    assert spark.read.parquet(f"{scratch}/model/metrics").first().n > 0
    assert spark.read.parquet(f"{scratch}/model/day_predictions").count() > 0


def test_module_entry_point(scratch):
    import os
    import subprocess
    import sys

    from locations import ROOT

    env = dict(os.environ, PYTHONPATH=ROOT)
    ok = subprocess.run([sys.executable, "-m", "sigflow", "--help"], cwd=ROOT, env=env,
                        capture_output=True, text=True, timeout=120)
    assert ok.returncode == 0 and "publish" in ok.stdout
    bad = subprocess.run([sys.executable, "-m", "sigflow", "--master", "local[1]", "report",
                          "--lake", f"{scratch}/missing", "--out", f"{scratch}/out"],
                         cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    assert bad.returncode != 0
    assert "sigflow report failed" in bad.stderr


def test_consume_splits_deduplicates_and_compacts(spark, scratch):
    """Rejected messages apart, replays added once, batch folders compacted: from the command line."""
    import os

    from sigflow.cli import main
    from sigflow.sources.generations import generations, read_table

    os.makedirs(f"{scratch}/messages")
    lines = [f'{{"Date/Time": "{d:02d} 01 2018 00:10", "Wind Speed (m/s)": "{d}"}}' for d in range(1, 11)]
    for k, part in enumerate((lines[5:], lines, ["junk", "{}", *lines[:2]])):
        with open(f"{scratch}/messages/{k}.txt", "w") as f:
            f.write("\n".join(part) + "\n")
    common = ["consume", "--messages", f"{scratch}/messages", "--available-now", "--max-files-per-trigger", "1"]
    main([*common, "--lake", f"{scratch}/all", "--rejected", f"{scratch}/rejected"])
    assert read_table(spark, f"{scratch}/all").count() == 17 and read_table(spark, f"{scratch}/rejected").count() == 2
    main([*common, "--lake", f"{scratch}/once", "--distinct"])
    timed = lambda: read_table(spark, f"{scratch}/once").filter("signal_ts is not null")
    assert timed().count() == 10
    main(["compact", "--lake", f"{scratch}/once", "--ended", "--drop"])
    assert generations(spark, f"{scratch}/once") == [1] and timed().count() == 10
    assert not [d for d in os.listdir(f"{scratch}/once") if d.startswith("app_id=") and os.listdir(f"{scratch}/once/{d}")]
