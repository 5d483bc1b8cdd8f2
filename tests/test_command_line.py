import pytest
from pyspark.sql import functions as F

from meterline.__main__ import arguments, main
from meterline.operators.quality import Between, suite_to_json
from meterline.sources.warehouse import read_star


def test_every_stage_by_itself(spark, raw_trips, zones, tmp_path, capsys):
    base, lake, lookup = (str(tmp_path / n) for n in ("delivery", "lake", "zones"))
    for service in ("yellow", "green"):
        trips = raw_trips(service, {}, {"VendorID": 2}, {"PULocationID": 21})
        trips.coalesce(1).write.parquet(f"{base}/2024/{service}/{service}_2024-01.parquet")
    zones.write.csv(lookup, header=True)
    names = ["--staging", "stg_cli", "--production", "prd_cli", "--root", str(tmp_path / "wh")]
    try:
        assert main(["load-raw", "--base", base, "--lake", lake, "--years", "2024"]) == 0
        assert main(["clean", "--lake", lake, "--zones", lookup]) == 0
        assert main(["convert", "--lake", lake, "--format", "orc", "--target", f"{lake}/orc"]) == 0
        assert spark.read.orc(f"{lake}/orc").count() == 4
        assert main(["create", *names]) == 0
        assert main(["load-staging", "--lake", lake, "--years", "2024", *names]) == 0
        assert main(["validate", "--results", f"{lake}/report", *names]) == 0
        assert main(["star", *names]) == 0
        assert main(["test-star", *names]) == 0
        assert read_star(spark, "prd_cli")["factTrip"].count() == 4
        printed = capsys.readouterr().out
        assert printed.count("not_null") == 10 + 23
        update = ["update", "--base", base, "--lake", lake, "--zones", lookup, "--years", "2024"]
        assert main([*update, "--mirror", "--clustered", *names]) == 0
        assert read_star(spark, "prd_cli")["factTrip"].count() == 4
        assert capsys.readouterr().out.count("not_null") == 23

        strict = tmp_path / "suite.json"
        strict.write_text(suite_to_json([Between("fare_amount", 0, 5)]))
        assert main(["validate", "--suite", str(strict), *names]) == 1
        assert main(["inspect", "--path", f"{lake}/clean/service=green"]) == 0
        assert "pickup_latitude" in capsys.readouterr().out
    finally:
        spark.sql("DROP DATABASE IF EXISTS stg_cli CASCADE")
        spark.sql("DROP DATABASE IF EXISTS prd_cli CASCADE")


def test_all_stages_at_once(spark, raw_trips, zones, tmp_path):
    base, lake, lookup = (str(tmp_path / n) for n in ("delivery", "lake", "zones"))
    far = raw_trips("green", {"trip_distance": 101.0}).withColumn("ehail_fee", F.lit(None))
    far = far.withColumn("ehail_fee", F.col("ehail_fee").cast("double"))
    far.coalesce(1).write.parquet(f"{base}/2024/green/green_2024-01.parquet")
    zones.write.csv(lookup, header=True)
    try:
        code = main(
            ["all", "--base", base, "--lake", lake, "--zones", lookup, "--years", "2024"]
            + ["--staging", "stg_all", "--production", "prd_all", "--root", str(tmp_path / "wh")]
        )
        # The distance is out of range, so the run says that a check failed.
        assert code == 1
        assert read_star(spark, "prd_all")["factTrip"].count() == 1
    finally:
        spark.sql("DROP DATABASE IF EXISTS stg_all CASCADE")
        spark.sql("DROP DATABASE IF EXISTS prd_all CASCADE")


def test_jdbc_arguments():
    a = arguments(
        ["load-jdbc", "--lake", "l", "--url", "jdbc:x", "--table", "staging.trips"]
        + ["--property", "user=me", "--property", "password=a=b"]
    )
    assert dict(p.split("=", 1) for p in a.property) == {"user": "me", "password": "a=b"}
    with pytest.raises(SystemExit):
        arguments(["load-raw", "--lake", "l"])
