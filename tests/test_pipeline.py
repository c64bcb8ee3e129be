"""End to end: landed files -> bronze log -> silver -> gold; incremental streaming ingest."""

import os

from pyspark.sql import functions as F

from staylens.plans import domain, landed, pipeline, silver
from staylens.sources import csv, landing, metadata
from staylens.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_full_pipeline(spark, tmp_dir):
    land_dir = os.path.join(tmp_dir, "landing")
    landed.land(spark, SF, land_dir)
    lay = pipeline.Layout(land_dir, os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold"),
                          os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "runs"))
    city = silver.CityConfig(bounds=domain.CITY_BOUNDS)
    res = pipeline.run(spark, city, ["bronze", "silver", "gold"], lay, as_of=domain.AS_OF, partitions=4)
    assert {k: v["status"] for k, v in res.items()} == {"bronze": "success", "silver": "success", "gold": "success"}

    # silver listings equal the typed view's valid rows
    clean = spark.read.parquet(f"{lay.silver_dir}/listings.parquet")
    want = domain.listings(spark, SF)
    from staylens.operators import quality
    want_valid = quality.valid_subset(quality.apply_flags(want, quality.listing_rules(domain.CITY_BOUNDS, domain.AS_OF)))
    assert clean.count() == want_valid.count()
    assert clean.select("id").subtract(want_valid.select(F.col("id") + landed.ID_BASE)).count() == 0

    # gold marts exist; the calendar fact is partitioned by year/month
    dl = spark.read.parquet(f"{lay.gold_dir}/dim_listings")
    assert dl.count() == clean.count() and "listing_id" in dl.columns
    fc = spark.read.parquet(f"{lay.gold_dir}/fact_calendar")
    assert fc.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert any(d.startswith("year=") for d in os.listdir(f"{lay.gold_dir}/fact_calendar"))
    fr = spark.read.parquet(f"{lay.gold_dir}/fact_reviews")
    assert fr.groupBy("listing_id", "reviewer_id", "date").count().where("count > 1").count() == 0

    # log: silver datasets logged; a second bronze run skips every file
    log = metadata.read_log(spark, lay.log_path)
    assert log.where((F.col("layer") == "silver") & (F.col("status") == "success")).count() == 4
    res2 = pipeline.run(spark, city, ["bronze"], lay)
    assert res2["bronze"]["status"] == "success"
    summ = {(r.layer, r.status): r.events for r in metadata.ingestion_summary(metadata.read_log(spark, lay.log_path)).collect()}
    n_files = landing.landed_files(spark, land_dir, "*.csv*").count()
    assert summ[("bronze", "success")] == n_files and summ[("bronze", "skipped")] == n_files
    state = metadata.run_state(metadata.read_runs(spark, lay.runs_path)).collect()
    assert all(r.status == "success" and r.finished_at is not None for r in state)


def test_failed_phase_does_not_stop_later_phases(spark, tmp_dir):
    lay = pipeline.Layout(os.path.join(tmp_dir, "nothing"), os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "g"),
                          os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "runs"))
    res = pipeline.run(spark, silver.CityConfig(), ["bronze", "silver", "gold"], lay)
    assert res["bronze"]["status"] == "failed"
    assert res["silver"]["status"] in ("partial", "failed") and "gold" in res


def test_resolve_dataset_order(spark, tmp_dir):
    for name in ["b_listings.csv.gz", "a_listings.csv.gz", "listings_detailed_listings.csv.gz"]:
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("x\n1\n")
    pick = csv.resolve_dataset(spark, tmp_dir, ["listings_detailed_listings.csv.gz", "listings_listings.csv.gz"],
                               "listings", ".gz")
    assert pick.endswith("listings_detailed_listings.csv.gz")
    os.remove(os.path.join(tmp_dir, "listings_detailed_listings.csv.gz"))
    pick = csv.resolve_dataset(spark, tmp_dir, ["listings_detailed_listings.csv.gz"], "listings", ".gz")
    assert pick.endswith("a_listings.csv.gz")
    assert csv.resolve_dataset(spark, os.path.join(tmp_dir, "missing"), [], "x", ".csv") is None


def test_resolve_dataset_of_part_files(spark, tmp_dir):
    spark.range(100).repartition(4).write.option("header", True).csv(os.path.join(tmp_dir, "b_calendar.csv"))
    os.makedirs(os.path.join(tmp_dir, "a_calendar.csv"))  # holds no file
    pick = csv.resolve_dataset(spark, tmp_dir, ["none.csv"], "calendar", ".csv")
    assert pick.endswith("/b_calendar.csv")
    read = csv.read_landed_csv(spark, pick)
    assert read.count() == 100 and read.rdd.getNumPartitions() > 1


def test_landed_datasets_are_written_when_asked_for(spark, tmp_dir):
    assert list(landed.land(spark, SF, tmp_dir, names=["calendar"])) == ["calendar"] == os.listdir(tmp_dir)


def test_csv_reader_na_tokens_and_multiline(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    with open(p, "w") as f:
        f.write('id,comments,price\n1,"two\nlines, ""quoted""",N/A\n2,NA,$5\n3,,null\n')
    df = csv.read_landed_csv(spark, p).orderBy("id").collect()
    assert [tuple(r) for r in df] == [("1", 'two\nlines, "quoted"', None), ("2", None, "$5"), ("3", None, None)]
    counts = landing.file_record_counts(spark, [p]).first()
    assert counts.row_count == 3  # records, not physical lines


def test_streaming_incremental_ingest(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    schema = csv.header_schema
    head = "listing_id,date,available,price\n"
    with open(os.path.join(src, "cal1.csv"), "w") as f:
        f.write(head + "1,2024-06-01,t,$10.00\n1,2024-06-02,f,$0\n")
    from pyspark.sql.types import StringType, StructField, StructType

    st = StructType([StructField(c, StringType()) for c in ["listing_id", "date", "available", "price"]])
    target, ckpt = os.path.join(tmp_dir, "silver_cal"), os.path.join(tmp_dir, "ckpt")
    n1 = incremental.ingest_available(spark, src, st, silver.clean_calendar, target, ckpt)
    assert n1 >= 1 and spark.read.parquet(target).count() == 2
    # nothing new: no batch, nothing appended
    incremental.ingest_available(spark, src, st, silver.clean_calendar, target, ckpt)
    assert spark.read.parquet(target).count() == 2
    with open(os.path.join(src, "cal2.csv"), "w") as f:
        f.write(head + "2,2024-06-03,,N/A\n")
    incremental.ingest_available(spark, src, st, silver.clean_calendar, target, ckpt)
    out = spark.read.parquet(target)
    assert out.count() == 3 and out.where("is_valid").count() == 1


def test_flat_landing_layout(spark, tmp_dir):
    """Files landed flat under the source system's names are found by SRC-4 order."""
    import gzip

    land_dir = os.path.join(tmp_dir, "flat")
    os.makedirs(land_dir)
    with gzip.open(os.path.join(land_dir, "listings_detailed_listings.csv.gz"), "wt") as f:
        f.write('id,price,room_type,latitude,longitude,minimum_nights,availability_365\n'
                '1,"$1,200.00",entire home/apt,51.5,0.0,2,10\n2,N/A,Private room,51.5,0.0,2,10\n')
    with gzip.open(os.path.join(land_dir, "calendar_calendar.csv.gz"), "wt") as f:
        f.write("listing_id,date,available,price\n1,2024-06-01,t,$10.00\n")
    with gzip.open(os.path.join(land_dir, "reviews_reviews.csv.gz"), "wt") as f:
        f.write('listing_id,id,date,reviewer_id,comments\n1,5,2024-01-01,9,"nice\nplace"\n1,4,2024-01-01,9,dup\n')
    with open(os.path.join(land_dir, "neighbourhoods_csv_neighbourhoods.csv"), "w") as f:
        f.write("Neighbourhood Group,Neighbourhood\n,Camden\n")
    lay = pipeline.Layout(land_dir, os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "g"),
                          os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "runs"))
    res = pipeline.run(spark, silver.CityConfig(), ["silver"], lay, as_of="2024-06-01")
    assert res["silver"]["status"] == "success", res
    lst = spark.read.parquet(f"{lay.silver_dir}/listings.parquet").collect()
    assert [(r.id, r.price, r.room_type) for r in lst] == [(1, 1200.0, "Entire home/apt")]
    rev = spark.read.parquet(f"{lay.silver_dir}/reviews.parquet").collect()
    assert [(r.id, r.comments) for r in rev] == [(4, "dup")]
    nb = spark.read.parquet(f"{lay.silver_dir}/neighbourhoods.parquet")
    assert nb.columns == ["neighbourhood_group", "neighbourhood"]


def _bronze(spark, tmp_dir, land_dir):
    from staylens.plans import bronze

    log, runs = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "runs")
    out = bronze.ingest_bronze(spark, land_dir, log, runs, "london", source_url="https://example.org/data")
    return out, {r.file_name: r for r in metadata.read_log(spark, log).orderBy("ingested_at").collect()}


def test_bronze_sets_bad_files_apart(spark, tmp_dir):
    import gzip

    land_dir = os.path.join(tmp_dir, "landing")
    os.makedirs(land_dir)
    for name, text in (("good.csv", "a,b\n1,2\n3,4\n"), ("header.csv", "a,b\n"), ("empty.csv", "")):
        with open(os.path.join(land_dir, name), "w") as f:
            f.write(text)
    with gzip.open(os.path.join(land_dir, "fine file.csv.gz"), "wt") as f:
        f.write("a\n1\n")
    with open(os.path.join(land_dir, "broken.csv.gz"), "wb") as f:
        f.write(b"\x1f\x8b\x08\x00 not gzip at all")
    out, log = _bronze(spark, tmp_dir, land_dir)
    assert out["status"] == "partial"
    assert {n: (r.status, r.row_count) for n, r in log.items()} == {
        "good.csv": ("success", 2), "header.csv": ("success", 0), "empty.csv": ("failed", None), "fine file.csv.gz": ("success", 1), "broken.csv.gz": ("failed", None)}
    assert log["empty.csv"].error_message == "empty file" and log["broken.csv.gz"].error_message
    assert log["good.csv"].source_url == "https://example.org/data/good.csv" and log["good.csv"].duration_sec is not None

    # mended files: the next run ends well, whatever the earlier one met
    with open(os.path.join(land_dir, "empty.csv"), "w") as f:
        f.write("a\n1\n")
    with gzip.open(os.path.join(land_dir, "broken.csv.gz"), "wt") as f:
        f.write("a\n1\n2\n")
    out, log = _bronze(spark, tmp_dir, land_dir)
    assert out["status"] == "success" and log["broken.csv.gz"].row_count == 2


def test_missing_datasets_and_phase_alias(spark, tmp_dir):
    land_dir = os.path.join(tmp_dir, "landing")
    os.makedirs(land_dir)
    with open(os.path.join(land_dir, "empty.csv"), "w"):
        pass
    import gzip

    with gzip.open(os.path.join(land_dir, "listings_detailed_listings.csv.gz"), "wt") as f:
        f.write('id,price,room_type,latitude,longitude,minimum_nights,availability_365\n1,"$1,200.00",entire home/apt,51.5,0.0,2,10\n')
    lay = pipeline.Layout(land_dir, os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "g"), os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "runs"))
    res = pipeline.run(spark, silver.CityConfig(), ["all"], lay)
    assert list(res) == ["bronze", "silver", "gold"]
    assert res["bronze"]["status"] == "partial"  # the empty file
    detail = res["silver"]["detail"]
    assert {k: v["status"] for k, v in detail.items()} == {"listings": "success", "calendar": "failed", "reviews": "failed"}
    assert res["silver"]["status"] == "partial" and res["gold"]["status"] == "failed"
    states = {r.phases: r.status for r in metadata.run_state(metadata.read_runs(spark, lay.runs_path)).collect()}
    assert states["bronze,silver,gold"] == "partial"


def test_columns_by_name(spark, tmp_dir):
    src = os.path.join(tmp_dir, "parts")
    os.makedirs(src)
    for name, text in (("a.csv", "id,price\n1,$5\n"), ("b.csv", "price,id,more\n$7,2,x\n")):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    got = {(r["id"], r["price"], r["more"]) for r in csv.read_landed_csv(spark, src).collect()}
    assert got == {("1", "$5", None), ("2", "$7", "x")}


def test_replayed_batch_is_not_written_twice(spark, tmp_dir):
    src, target = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("listing_id,date\n1,2024-06-01\n")
    from pyspark.sql.types import StringType, StructField, StructType

    st = StructType([StructField(c, StringType()) for c in ["listing_id", "date"]])
    for ckpt in ("one", "two"):  # a lost checkpoint replays batch 0
        incremental.ingest_available(spark, src, st, silver.clean_calendar, target, os.path.join(tmp_dir, ckpt))
    assert spark.read.parquet(target).count() == 1


def test_long_ids_and_infinities(spark):
    from staylens.functions import parse

    rows = [("549880123456789013",), ("549880123456789012",), ("12.0",), (" 7 ",), ("1.5",), ("1e400",), ("99999999999999999999",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(parse.safe_long("t")).collect()] == [549880123456789013, 549880123456789012, 12, 7, None, None, None, None, None]
    assert df.select(parse.safe_double("t").alias("x")).where("t = '1e400'").first().x is None
    assert spark.createDataFrame([("$1e400",)], "t string").select(parse.parse_price("t").alias("x")).first().x is None


def test_replaced_input_is_noticed(spark, tmp_dir):
    from staylens.plans import queries as Q

    base = os.path.join(tmp_dir, "tables")
    for t in Q.GOLD_INPUTS:
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{base}/{t}.parquet")
    before = Q.dim_listings(spark, base).count()
    spark.read.parquet(f"{SF}/orders.parquet").limit(20).write.mode("overwrite").parquet(f"{base}/orders.parquet")
    assert Q.dim_listings(spark, base).count() < before


def test_file_names_are_decoded_once_a_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a b+c.csv")
    with open(path, "w") as f:
        f.write("id\n" + "1\n" * 50)
    counts = landing.file_record_counts(spark, [path])
    assert [(r["path"].split(":", 1)[1].lstrip("/"), r["row_count"]) for r in counts.collect()] == [(path.lstrip("/"), 50)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "decode" not in plan[plan.index("Project"):]  # below the aggregate


def test_resumed_phase_does_only_what_changed(spark, tmp_dir):
    from staylens.sources import snapshots

    land_dir = os.path.join(tmp_dir, "landing")
    landed.land(spark, SF, land_dir, partitions=1)
    lay = pipeline.Layout(land_dir, *(os.path.join(tmp_dir, n) for n in ("silver", "gold", "log", "runs")), store=snapshots.Snapshots)
    city = silver.CityConfig(bounds=domain.CITY_BOUNDS)

    def go(**more):
        done = pipeline.run(spark, city, ["silver", "gold"], lay, as_of=domain.AS_OF, **{"resume": True, **more})
        versions = {n: snapshots.current(spark, f"{lay.silver_dir}/{n}.parquet").version for n in ("listings", "calendar", "reviews")}
        versions |= {n: snapshots.current(spark, f"{lay.gold_dir}/{n}").version for n in ("dim_listings", "fact_calendar", "fact_reviews")}
        return [r["status"] for r in done.values()], versions

    assert go() == (["success"] * 2, dict.fromkeys(["listings", "calendar", "reviews", "dim_listings", "fact_calendar", "fact_reviews"], 1))
    landed.raw_review_text(spark, SF).withColumn("listing_id", F.col("listing_id") + 1).coalesce(1).write.mode("append").options(
        header=True, quote='"', escape='"', **landed.GZIP).csv(f"{land_dir}/reviews")
    before = snapshots.read(spark, f"{lay.gold_dir}/fact_reviews").count()
    statuses, versions = go()
    assert statuses == ["success"] * 2
    assert versions == {"listings": 1, "calendar": 1, "reviews": 2, "dim_listings": 1, "fact_calendar": 1, "fact_reviews": 2}
    assert snapshots.read(spark, f"{lay.gold_dir}/fact_reviews").count() > before
    # a build that failed, or never ended, is done again though its files are the same
    from staylens.sources import metadata

    for n, status in enumerate(("failed", "running")):
        made = metadata.finished_parts(spark, lay.phases_path, city.name, "silver")["calendar"]
        metadata.part_events(spark, lay.phases_path, "x", city.name, "silver", [("calendar", made, status)])
        metadata.phase_event(spark, lay.phases_path, "x", city.name, "silver", "", "failed")
        statuses, versions = go()
        assert statuses == ["success"] * 2 and versions["calendar"] == 2 + n and versions["listings"] == 1
    statuses, versions = go(resume=False)
    assert statuses == ["success"] * 2 and versions["listings"] == 2 and versions["dim_listings"] == 2
