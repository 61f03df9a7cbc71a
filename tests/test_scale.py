"""Hospital queries move and store narrow rows."""

from pyspark.sql import functions as F

from kinloom.plans import birth_cohort as BC
from kinloom.plans import birth_details as BD
from kinloom.plans.mothers import mothers_delivery_episode
from kinloom.plans.queries import cohort_stages
from kinloom.sources import fixtures as FX
from kinloom.sources import io as IO

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extracts_are_one_narrow_scan(spark):
    one = FX.extracts_by_year(spark, SF)
    text = plan(one.select("token_person_id", "reporting_year_start"))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<ck:bigint>" in text and "Exchange" not in text
    years = {y: df.count() for y, df in FX.yearly_extracts(spark, SF).items()}
    assert {r[0]: r[1] for r in one.groupBy("reporting_year_start").count().collect()} == years


def test_flags_are_made_before_the_semi_join(spark):
    episodes = FX.extracts_by_year(spark, SF).withColumnsRenamed({v: k for k, v in FX.RAW_EPISODE_NAMES.items()})
    got = BC.flagged_records(episodes, BC.infant_ids(episodes))
    want = BC.birth_record_flags(BC.clean_infant_records(BC.infant_records(episodes))).select(*BC.SUMMARY_INPUT_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_are_written_by_their_tasks(spark, tmp_path):
    df = spark.range(40).select("id", (F.col("id") % 9).cast("int").alias("year"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    path = IO.write_partitioned(df, str(tmp_path / "t"), "year", by_task=True)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "year").collect())) == [(i, i % 9) for i in range(40)]


def test_first_diagnoses_do_not_need_the_whole_store(spark):
    stages = cohort_stages(spark, SF)
    assert stages["cancer_coded"].deps == stages["congenital_coded"].deps == ("episodes",)


def test_the_method_limit_is_set_unless_the_user_chose_one(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        for given, want in (("65535", "8000"), ("12000", "12000")):
            spark.conf.set(name, given)
            cohort_stages(spark, SF)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)


def harmonised(spark):
    return FX.extracts_by_year(spark, SF).withColumnsRenamed({v: k for k, v in FX.RAW_EPISODE_NAMES.items()})


def rows(df):
    return sorted(map(str, df.collect()))


def test_the_timeline_takes_the_first_dates_that_come_with_the_persons(spark):
    episodes = harmonised(spark)
    persons = BC.infant_persons(episodes)
    assert rows(persons.select("token_person_id")) == rows(BC.infant_ids(episodes))
    flagged = BC.flagged_records(episodes, persons)
    got, want = BC.timeline_anchor(flagged), BC.timeline_anchor(BC.flagged_records(episodes, BC.infant_ids(episodes)))
    assert rows(got.select(*want.columns)) == rows(want)
    assert "Join" not in plan(BC.timeline_anchor(spark.createDataFrame([], flagged.schema), with_record_order=False))


def test_persons_details_are_aggregated_before_they_meet_the_ids(spark):
    episodes = harmonised(spark)
    links = FX.person_view(spark, SF, "fx_mb_links")
    ids, infants = BC.infant_ids(episodes), BC.infant_records(episodes)
    got = BD.birth_information(BC.completed(episodes), links, ids)
    assert rows(got) == rows(BD.birth_information(infants, links))
    got = BD.ethnicity_geo(BC.completed(episodes), ids)
    assert rows(got) == rows(BD.ethnicity_geo(infants))


def test_ethnicity_and_area_are_picked_in_one_pass(spark):
    text = plan(BD.ethnicity_geo(harmonised(spark)))
    assert text.count("FileScan") == 1 and "Window" not in text


def test_deliveries_meet_the_episodes_in_one_join(spark):
    df = mothers_delivery_episode(FX.person_view(spark, SF, "fx_mb_links"), harmonised(spark))
    assert "LeftSemi" not in df._jdf.queryExecution().optimizedPlan().toString()


def small_tables(spark, path):
    """Seven orders of four persons and one of none, nine lines; an order without lines, a line without order, missing dates."""
    day = lambda d: f"timestamp'{d} 10:00:00'" if d else "cast(null as timestamp)"
    orders = [(1, 4, "2000-01-31"), (2, 4, "1999-05-02"), (3, 7, "2001-02-28"), (4, 10, "2000-02-29"), (5, None, "1997-03-31"),
              (6, 11, "2005-01-01"), (7, 10, "1998-04-01")]
    lines = [(1, 1, "2000-02-01"), (1, 2, "1999-12-31"), (1, 2, "1999-12-31"), (2, 1, None), (3, 1, "2001-01-15"), (4, 1, "2000-03-01"),
             (5, 1, "1997-04-01"), (7, 1, "1998-03-01"), (99, 1, "1990-01-01")]
    null = lambda v: "null" if v is None else v
    spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}L, cast({null(c)} as bigint), {day(d)})" for k, c, d in orders)
              + " AS t(o_orderkey, o_custkey, o_orderdate)").write.parquet(f"{path}/orders.parquet")
    spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}L, {n}, 3L, 5L, 10.25D, {day(d)})" for k, n, d in lines)
              + " AS t(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)").write.parquet(f"{path}/lineitem.parquet")
    spark.range(1, 15).selectExpr("id AS c_custkey").write.parquet(f"{path}/customer.parquet")
    return str(path)


def test_pupil_queries_store_no_hospital_extracts(spark, tmp_path):
    from kinloom.plans.queries import QUERIES

    sf = small_tables(spark, tmp_path)
    for name in ("ks1_best", "ks5_best", "absence_summary", "registrations_summary"):
        QUERIES[name](spark, sf).collect()
    assert all(key[1] != sf for key in FX._stored_extracts)
    listed = FX.fixture_catalog(spark, sf).yearly("hospital")
    assert list(listed) == sorted(FX.yearly_extracts(spark, sf))


def test_dates_of_birth_come_from_all_lines_of_a_person(spark, tmp_path):
    sf = small_tables(spark, tmp_path)
    got = {r.ck: (str(r.dob), str(r.first_month)) for r in FX.person_dob(spark, sf).collect()}
    assert got == {4: ("2019-05-01", "2019-05-01"), 7: ("1996-01-01", "2001-01-01"), 10: ("2018-06-01", "2018-03-01"), None: ("1997-03-01", "1997-03-01")}
    rows = FX.fx_episodes(spark, sf).select("token_person_id", "epikey", "mydob").collect()
    assert len(rows) == 8 and sum(r.token_person_id is None for r in rows) == 1


def test_lines_are_shuffled_once_to_their_orders(spark, tmp_path):
    sf, name = small_tables(spark, tmp_path), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    FX.person_dob(spark, sf)
    try:
        spark.conf.set(name, "-1")
        text = plan(FX._episode_base(spark, sf))
    finally:
        spark.conf.set(name, before)
    joins = [x for x in text.splitlines() if "Join" in x]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1] and "l_extendedprice" not in text.split("Exchange")[1].splitlines()[0]


def test_infant_records_are_not_moved(spark, tmp_path):
    """The wide rows meet lists of the persons' ids where they are read."""
    from kinloom.plans.queries import QUERIES, end_run

    sf = small_tables(spark, tmp_path)
    df = QUERIES["infant_records"](spark, sf)
    text = plan(df)
    assert "LeftSemi" in text and "Exchange" not in text.split("BroadcastExchange")[0]
    episodes = harmonised_of(spark, sf)
    want = BC.completed(episodes).join(BC.infant_ids(episodes), "token_person_id", "left_semi")
    assert rows(df) == rows(want.select(*df.columns))
    end_run(spark, sf)


def harmonised_of(spark, sf):
    return FX.extracts_by_year(spark, sf).withColumnsRenamed({v: k for k, v in FX.RAW_EPISODE_NAMES.items()})


def test_rows_meet_lists_of_keys(spark, monkeypatch):
    """Null, repeated and composite keys, keys of another type, and more keys than lists hold, as a semi-join has them."""
    from kinloom.operators import link

    big = spark.createDataFrame([(None if i % 7 == 0 else f"P{i % 50}", i % 3 or None, i) for i in range(400)], "a string, b int, n int")
    keys = spark.createDataFrame([(f"P{i % 60}", i % 5, i % 60) for i in range(0, 120, 3)] + [(None, 1, 0), ("P1", None, 0)], "a string, b int, c long")
    for limit in (link.KEY_BYTES, 0):
        monkeypatch.setattr(link, "KEY_BYTES", limit)
        for on in ("a", ["a"], ["a", "b"]):
            got = link.semi_reduce(big, keys, on)
            want = big.join(keys, on, "left_semi")
            assert rows(got) == rows(want) and got.columns == want.columns
            assert ("array_contains" in plan(got)) == bool(limit)
    longs = big.withColumnRenamed("n", "c")
    assert sorted(r.c for r in link.semi_reduce(longs, keys, "c").collect()) == sorted({i % 60 for i in range(0, 120, 3)})
    assert link.semi_reduce(big, keys.limit(0), "a").count() == 0


def test_stages_free_their_shuffles(spark, tmp_path):
    from kinloom.plans.pipeline import Pipeline, Stage

    disk = spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager()
    files = lambda: {b.toString() for b in (disk.getAllBlocks().apply(i) for i in range(disk.getAllBlocks().size()))}
    old = files()
    stage = Stage(lambda: spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")), ())
    out = Pipeline(spark, {"s": stage}, workdir=str(tmp_path / "w")).get("s")
    assert not any(b.startswith("shuffle") for b in files() - old) and out.count() == 7


def test_cut_diagnoses_are_those_of_the_whole_list(spark):
    from kinloom.plans.diagnoses import diagnoses_long

    episodes = harmonised(spark)
    stems = {"C91", "Q21", "Q25"}
    whole = diagnoses_long(episodes).filter(F.col("diagnosis_3char").isin(*stems))
    got = diagnoses_long(episodes, None, stems)
    assert rows(got) == rows(whole.select(*got.columns))
    first = diagnoses_long(episodes, [1], stems)
    assert rows(first) == rows(whole.filter("diagnostic_position = 1").select(*first.columns))
    assert "Generate" not in plan(first)
    assert first.schema["diagnostic_position"].dataType == whole.schema["diagnostic_position"].dataType
