"""The command line builds every model from landed CSV files."""

import json
import os

from farelane import __main__ as cli
from farelane.sources import bridge as B
from farelane.sources.landing import land_csv, land_monthly_csv

from tests.conftest import SF_SMALL


def test_cli_build_and_ingest(spark, tmpdir_path, capsys):
    t = B.Tables(spark, SF_SMALL)
    paths = {}
    for svc in ("green", "yellow", "fhv"):
        paths[svc] = land_csv(B.raw_trips(t, svc), os.path.join(tmpdir_path, svc))
    zones = land_csv(B.zone_seed(t).toDF("LocationID", "Borough", "Zone", "service_zone"),
                     os.path.join(tmpdir_path, "zones"))
    rc = cli.main(["build", "--green", paths["green"], "--yellow", paths["yellow"], "--fhv", paths["fhv"],
                   "--zones", zones, "--target", os.path.join(tmpdir_path, "wh"), "--fhv-year", "1996",
                   "--year", "1996", "--previous-year", "1995", "--fare-month", "1996-04",
                   "--tt-month", "1996-01", "--tt-zones", "NATION_1,NATION_2,NATION_3"])
    assert rc == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["data_tests"] == 13 and counts["dim_zones"] == 25
    assert counts["fact_trips"] > 0 and counts["yoy_statement"] == 8

    landing = land_monthly_csv(B.raw_trips(t, "green"), "green", os.path.join(tmpdir_path, "landing"))
    args = ["ingest", "--service", "green", "--landing", landing,
            "--target", os.path.join(tmpdir_path, "target"), "--checkpoint", os.path.join(tmpdir_path, "ck")]
    assert cli.main(args) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows_in_target"]
    assert first == B.raw_trips(t, "green").count()
