"""Ingestion: CSV quirks, ledger, failure isolation, dispositions, streaming."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from consentflow.sources import files, ingest as ing, ledger as led
from consentflow.sources.schemas import RAW_EVENT_SCHEMA, struct_from_json
from consentflow.streaming import file_stream

HEADER = ("EVENT_ID,USER_ID,TYPE,RATE,PARAMETERS,EVENT_TIME,WINDOW_START,APIKEY,CONSENT,COUNT,"
          "EXPERIMENT,SDK_TYPE,DOMAIN,DEPLOYMENT_ID,COUNTRY,REGION,BROWSER_FAMILY,DEVICE_TYPE\n")
ROW1 = ('e1,visitor-7,consent.given,1,"{""vendors"": {""list"": [""x"",\n""y""]}}",'
        '2031-03-09 17:40:05.125,2031-03-09 17:00:00.000,shop-a,full opt-in,1,,kit-one,shop.test,blue,'
        '"""NZ""","""OTA""",Lynx,console\n')
ROW2 = ('e2,visitor-7,pageview,0.25,,2031-03-09 17:41:00.000,2031-03-09 17:00:00.000,shop-a,empty,10,,'
        'kit-one,shop.test,blue,"""IS""","""GB""",Dillo,watch\n')


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_multiline_json_and_triple_quotes(spark, tmp_dir):
    p = f"{tmp_dir}/in/events-1.csv"
    write(p, HEADER + ROW1 + ROW2)
    df = files.read_events_csv(spark, p, RAW_EVENT_SCHEMA)
    rows = {r.EVENT_ID: r for r in df.collect()}
    assert len(rows) == 2
    assert rows["e1"].PARAMETERS == '{"vendors": {"list": ["x",\n"y"]}}'
    assert rows["e1"].COUNTRY == '"NZ"' and rows["e2"].PARAMETERS is None
    assert rows["e1"].EVENT_TIME == dt.datetime(2031, 3, 9, 17, 40, 5, 125000)


def test_schema_from_json():
    s = struct_from_json('{"columns": [{"name": "event_id", "type": "VARCHAR"},'
                         '{"name": "rate", "type": "DOUBLE PRECISION"},{"name": "count", "type": "BIGINT"},'
                         '{"name": "load_time", "type": "TIMESTAMP"}]}')
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "double", "bigint", "timestamp_ntz"]


def test_ledger_new_files_except(spark):
    cand = spark.createDataFrame([("f1", dt.datetime(2025, 1, 1), 10), ("f2", dt.datetime(2025, 1, 1), 10),
                                  ("f3", dt.datetime(2025, 1, 1), 10), ("f3", dt.datetime(2025, 1, 1), 10)],
                                 "filename string, modification_time timestamp, length long")
    ledger = spark.createDataFrame([
        ("f1", "events", "loaded", dt.datetime(2025, 1, 2), "a", dt.datetime(2025, 1, 1), 10),
        ("f2", "events", "failed", dt.datetime(2025, 1, 2), "a", dt.datetime(2025, 1, 1), 10),
        ("f3", "other", "loaded", dt.datetime(2025, 1, 2), "a", dt.datetime(2025, 1, 1), 10)],
        led.LEDGER_SCHEMA)
    assert sorted(r.filename for r in led.new_files(cand, ledger, "events").collect()) == ["f2", "f3"]
    assert led.new_files(cand, ledger, "events", force=True).count() == 3
    # a modified file (new mtime / size) counts as new (trap D14)
    changed = spark.createDataFrame([("f1", dt.datetime(2025, 2, 1), 11)],
                                    "filename string, modification_time timestamp, length long")
    assert led.new_files(changed, ledger, "events").count() == 1


def test_ingest_csv_and_parquet_with_ledger(spark, tmp_dir):
    write(f"{tmp_dir}/in/csv/events-1.csv", HEADER + ROW1 + ROW2)
    pq = files.read_events_csv(spark, f"{tmp_dir}/in/csv/events-1.csv", RAW_EVENT_SCHEMA) \
        .withColumn("EVENT_ID", F.concat(F.lit("p-"), "EVENT_ID"))
    pq.coalesce(1).write.parquet(f"{tmp_dir}/in/pq")
    pattern = f"{tmp_dir}/in/*/*[v0-9].*"
    table, ledger = f"{tmp_dir}/raw", f"{tmp_dir}/ledger"
    r1 = ing.ingest(spark, pattern, table, "events", ledger, schema=RAW_EVENT_SCHEMA)
    assert len(r1.loaded) == 2 and not r1.failed
    t = spark.read.parquet(table)
    assert t.count() == 4
    assert set(r.filename for r in t.select("filename").distinct().collect()) >= {"events-1.csv"}
    assert t.select("load_no").distinct().first()[0] == r1.load_no
    r2 = ing.ingest(spark, pattern, table, "events", ledger, schema=RAW_EVENT_SCHEMA)
    assert r2.loaded == [] and r2.skipped == 2
    r3 = ing.ingest(spark, pattern, table, "events", ledger, schema=RAW_EVENT_SCHEMA,
                    disposition="truncate_append", force=True)
    assert len(r3.loaded) == 2 and spark.read.parquet(table).count() == 4


def test_ingest_isolates_bad_file_and_retries(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", HEADER + ROW2)
    write(f"{tmp_dir}/in/b.csv", HEADER + 'e9,u1,pageview,not-a-number,,2025-09-05 01:15:00.000\n')
    table, ledger = f"{tmp_dir}/raw", f"{tmp_dir}/ledger"
    with pytest.raises(ing.IngestError):
        ing.ingest(spark, f"{tmp_dir}/in/*.csv", table, "events", ledger, schema=RAW_EVENT_SCHEMA)
    assert spark.read.parquet(table).count() == 1
    status = {os.path.basename(r.filename): r.status for r in led.read_ledger(spark, ledger).where("status <> 'loading'").collect()}
    assert status == {"a.csv": "loaded", "b.csv": "failed"}
    # fix the file: the next run retries only the failed one
    write(f"{tmp_dir}/in/b.csv", HEADER + ROW2.replace("e2", "e9"))
    r = ing.ingest(spark, f"{tmp_dir}/in/*.csv", table, "events", ledger, schema=RAW_EVENT_SCHEMA)
    assert [os.path.basename(p) for p in r.loaded] == ["b.csv"]
    assert spark.read.parquet(table).count() == 2


def test_no_files_raises(spark, tmp_dir):
    with pytest.raises(Exception):
        ing.ingest(spark, f"{tmp_dir}/nothing/*.csv", f"{tmp_dir}/t", "events", f"{tmp_dir}/l")


def test_stream_pickup_exactly_once(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    df = files.read_events_csv(spark, _csv(tmp_dir), RAW_EVENT_SCHEMA)
    df.coalesce(1).write.parquet(f"{src}/b1")
    target, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/ckpt"
    file_stream.stream_ingest(spark, f"{src}/*", RAW_EVENT_SCHEMA, target, ckpt)
    assert spark.read.parquet(target).count() == 2
    file_stream.stream_ingest(spark, f"{src}/*", RAW_EVENT_SCHEMA, target, ckpt)  # nothing new
    assert spark.read.parquet(target).count() == 2
    df.coalesce(1).write.parquet(f"{src}/b2")
    file_stream.stream_ingest(spark, f"{src}/*", RAW_EVENT_SCHEMA, target, ckpt)
    assert spark.read.parquet(target).count() == 4


def test_stream_upsert_is_key_replace(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    df = files.read_events_csv(spark, _csv(tmp_dir), RAW_EVENT_SCHEMA)
    df.coalesce(1).write.parquet(f"{src}/b1")
    df.withColumn("COUNT", F.lit(99).cast("long")).coalesce(1).write.parquet(f"{src}/b2")  # same keys
    # one file per micro-batch: the second batch replaces the first one's keys
    file_stream.stream_upsert_events(spark, f"{src}/*", RAW_EVENT_SCHEMA, f"{tmp_dir}/fct",
                                     f"{tmp_dir}/ck", max_files_per_trigger=1)
    fct = spark.read.parquet(f"{tmp_dir}/fct")
    assert fct.count() == 2  # replaced, not duplicated
    assert set(r.sample_count for r in fct.collect()) == {99}


def _csv(tmp_dir):
    p = f"{tmp_dir}/src.csv"
    write(p, HEADER + ROW1 + ROW2)
    return p


def test_inferred_schema_describe_export_and_empty_clone(spark, tmp_dir):
    p = f"{tmp_dir}/in/events-1.csv"
    write(p, HEADER + ROW1 + ROW2)
    inferred = ing.infer_schema(spark, p)
    assert "EVENT_ID" in inferred.fieldNames() and "COUNT" in inferred.fieldNames()
    df = files.read_events_csv(spark, p, RAW_EVENT_SCHEMA)
    desc = {r.column_name: r.column_type for r in files.describe(df).collect()}
    assert desc["RATE"] == "double" and desc["EVENT_TIME"] == "timestamp_ntz"
    empty = files.empty_like(df)
    assert empty.count() == 0 and empty.schema == df.schema
    files.export_csv(df.select("EVENT_ID", "PARAMETERS"), f"{tmp_dir}/out")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .csv(f"{tmp_dir}/out")
    assert sorted(r.EVENT_ID for r in back.collect()) == ["e1", "e2"]
    assert back.where("EVENT_ID = 'e1'").first().PARAMETERS.startswith('{"vendors"')


def test_synthetic_rows(spark):
    df = files.synthetic_rows(spark, 1000, seed=1)
    assert df.count() == 1000
    r = df.agg(F.min("col_e"), F.max("col_e"), F.countDistinct("id")).first()
    assert 0 <= r[0] and r[1] < 1000 and r[2] == 1000
    assert len(df.first().col_d) == 32


def test_default_window_is_yesterday_to_today(spark):
    from consentflow.operators.window_bounds import LoadWindow
    w = LoadWindow()
    r = spark.range(1).select(w.start_col().alias("s"), w.end_col().alias("e"),
                              F.current_date().alias("t")).first()
    assert r.e == r.t and (r.t - r.s).days == 1


@pytest.mark.parametrize("part", ["day", None])
def test_interrupted_load_is_not_duplicated(spark, tmp_dir, monkeypatch, part):
    """Data committed but the final ledger rows lost (driver died in between):
    the next run removes that batch's folders and loads the files once."""
    write(f"{tmp_dir}/in/a.csv", HEADER + ROW1 + ROW2)
    table, ledger = f"{tmp_dir}/raw", f"{tmp_dir}/ledger"
    part = ("EVENT_DATE", F.to_date("EVENT_TIME")) if part else None
    real_append = led.append_ledger
    calls = {"n": 0}

    def dies_on_final_rows(df, path):
        calls["n"] += 1
        if calls["n"] == 2:  # the 'loading' marker went through, the outcome does not
            raise RuntimeError("driver lost")
        real_append(df, path)
    monkeypatch.setattr(led, "append_ledger", dies_on_final_rows)
    with pytest.raises(RuntimeError):
        ing.ingest(spark, f"{tmp_dir}/in/*.csv", table, "events", ledger,
                   schema=RAW_EVENT_SCHEMA, partition=part)
    assert spark.read.parquet(table).count() == 2  # committed, but no outcome recorded
    monkeypatch.undo()
    # within the lease another loader may be at work: its data stay
    assert ing.drop_unrecorded_loads(spark, table, ledger, "events", lease_hours=1) == []
    assert spark.read.parquet(table).count() == 2
    r = ing.ingest(spark, f"{tmp_dir}/in/*.csv", table, "events", ledger,
                   schema=RAW_EVENT_SCHEMA, partition=part, lease_hours=0)
    assert len(r.loaded) == 1
    t = spark.read.parquet(table)
    assert t.count() == 2 and t.select("load_no").distinct().first()[0] == r.load_no
    statuses = sorted(x.status for x in led.read_ledger(spark, ledger).collect())
    assert statuses == ["aborted", "loaded", "loading", "loading"]
    # nothing left to clean up: a further check lists no folders
    assert ing.drop_unrecorded_loads(spark, table, ledger, "events") == []


def test_stream_consent_daily_matches_batch(spark, tmp_dir):
    """One file per micro-batch; events late by weeks, repeated events and
    events without a time: the fact equals the batch model's."""
    from consentflow.plans import staging as stg, mart as mrt
    src = f"{tmp_dir}/landing"
    df = files.read_events_csv(spark, _csv(tmp_dir), RAW_EVENT_SCHEMA)

    def moved(days, mark):
        return df.withColumns({"EVENT_ID": F.concat("EVENT_ID", F.lit(mark)), "EVENT_TIME": F.col("EVENT_TIME") + F.make_dt_interval(F.lit(days))})
    timeless = df.withColumn("EVENT_TIME", F.lit(None).cast("timestamp_ntz"))
    batches = [df, moved(30, "-b"), moved(-21, "-late").unionByName(df), timeless, moved(30, "-c").unionByName(timeless)]
    for i, b in enumerate(batches):
        b.coalesce(1).write.parquet(f"{src}/b{i}")
    file_stream.stream_consent_daily(spark, f"{src}/*", RAW_EVENT_SCHEMA, f"{tmp_dir}/fct_consent",
                                     f"{tmp_dir}/ck", max_files_per_trigger=1)
    got = spark.read.parquet(f"{tmp_dir}/fct_consent")
    allraw = batches[0]
    for b in batches[1:]:
        allraw = allraw.unionByName(b)
    allraw = allraw.select("*", F.current_timestamp().alias("load_time"), F.lit("x").alias("load_no"), F.lit("f").alias("filename"))
    want = mrt.fct_consent(stg.stg_consent(mrt.fct_event(stg.stg_event(allraw))))
    cols = ["consent_uq", "company_id", "event_dt", "event_count", "event_consent_given_count",
            "event_pageview_count", "consent_conversion_rate"]
    assert got.count() == want.count() == 4
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_files_with_other_column_orders_in_one_load(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", "EVENT_ID,DEVICE_TYPE,BROWSER_FAMILY\na1,tablet,Safari\n")
    write(f"{tmp_dir}/in/b.csv", "BROWSER_FAMILY,DEVICE_TYPE,EVENT_ID\nLynx,watch,b1\n")
    write(f"{tmp_dir}/in/c.csv", "")
    r = ing.ingest(spark, f"{tmp_dir}/in/*.csv", f"{tmp_dir}/raw", "events", f"{tmp_dir}/l", schema=RAW_EVENT_SCHEMA)
    assert not r.failed
    rows = {x.EVENT_ID: (x.DEVICE_TYPE, x.BROWSER_FAMILY) for x in spark.read.parquet(f"{tmp_dir}/raw").collect()}
    assert rows == {"a1": ("tablet", "Safari"), "b1": ("watch", "Lynx")}


def test_schema_that_lists_the_lineage_columns(spark, tmp_dir):
    schema = struct_from_json('{"columns": [{"name": "EVENT_ID", "type": "VARCHAR"}, {"name": "LOAD_TIME", "type": "TIMESTAMP"},'
                              '{"name": "load_no", "type": "VARCHAR"}, {"name": "filename", "type": "VARCHAR"}]}')
    write(f"{tmp_dir}/in/a.csv", "EVENT_ID\na1\n")
    r = ing.ingest(spark, f"{tmp_dir}/in/*.csv", f"{tmp_dir}/raw", "events", f"{tmp_dir}/l", schema=schema)
    row = spark.read.parquet(f"{tmp_dir}/raw").first()
    assert (row.EVENT_ID, row.filename, row.load_no) == ("a1", "a.csv", r.load_no)


def test_failed_reload_leaves_the_table(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", HEADER + ROW1)
    table, ledger = f"{tmp_dir}/raw", f"{tmp_dir}/l"
    ing.ingest(spark, f"{tmp_dir}/in/*.csv", table, "events", ledger, "truncate_append", schema=RAW_EVENT_SCHEMA)
    write(f"{tmp_dir}/in/a.csv", HEADER + "e9,u1,pageview,not-a-number,,2025-09-05 01:15:00.000\n")
    with pytest.raises(ing.IngestError):
        ing.ingest(spark, f"{tmp_dir}/in/*.csv", table, "events", ledger, "truncate_append", schema=RAW_EVENT_SCHEMA)
    assert [r.EVENT_ID for r in spark.read.parquet(table).collect()] == ["e1"]


def test_many_files_a_few_bad(spark, tmp_dir):
    for i in range(9):
        write(f"{tmp_dir}/in/f{i}.csv", f"EVENT_ID,RATE\ne{i},{'oops' if i in (2, 7) else 1}\n")
    r = ing.ingest(spark, f"{tmp_dir}/in/*.csv", f"{tmp_dir}/raw", "events", f"{tmp_dir}/l", schema=RAW_EVENT_SCHEMA, fail_on_error=False)
    assert sorted(os.path.basename(p) for p in r.failed) == ["f2.csv", "f7.csv"] and len(r.loaded) == 7
    assert sorted(x.EVENT_ID for x in spark.read.parquet(f"{tmp_dir}/raw").collect()) == [f"e{i}" for i in range(9) if i not in (2, 7)]


def test_bad_csv_files_cost_one_pass_and_one_job(spark, tmp_dir, monkeypatch):
    """Values that do not cast and records that do not parse, in several files."""
    import os
    os.makedirs(f"{tmp_dir}/in dir")
    for i in range(12):
        body = {3: "a,x,2024-01-01 00:00:00", 7: 'a,"1', 9: "a,1,not a time"}.get(i, f"e{i},{i}.5,2024-01-01 00:00:00\nf{i},,")
        order = "EVENT_ID,RATE,EVENT_TIME"
        with open(f"{tmp_dir}/in dir/{i:02d}.csv", "w") as f:
            f.write(f"{order}\n{body}\n")
    calls = []
    real = ing._append
    monkeypatch.setattr(ing, "_append", lambda *a: (calls.append(1), real(*a)))
    got = ing.ingest(spark, f"{tmp_dir}/in dir/*.csv", f"{tmp_dir}/t", "events", f"{tmp_dir}/l", schema=RAW_EVENT_SCHEMA, fail_on_error=False)
    assert {os.path.basename(p)[:2] for p in got.failed} == {"03", "07", "09"} and len(got.loaded) == 9
    assert len(calls) == 2
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 18


def test_changed_file_counts_once(spark, tmp_dir):
    from consentflow.warehouse import Warehouse
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    write(f"{tmp_dir}/in/a.csv", HEADER + ROW1 + ROW2)
    write(f"{tmp_dir}/in/b.csv", HEADER + ROW2.replace("e2", "e5"))
    wh.load_events(f"{tmp_dir}/in/*.csv", schema=RAW_EVENT_SCHEMA)
    write(f"{tmp_dir}/in/a.csv", HEADER + ROW1 + ROW2 + ROW2.replace("e2", "e3"))
    wh.load_events(f"{tmp_dir}/in/*.csv", schema=RAW_EVENT_SCHEMA)
    assert sorted(r.EVENT_ID for r in wh.raw_events().collect()) == ["e1", "e2", "e3", "e5"]


def test_country_seed_edge_cases(spark, tmp_dir):
    """The code NA is text, an empty quoted region is null, leading zeros parse."""
    write(f"{tmp_dir}/seed.csv", "name,alpha_2,alpha_3,country_code,iso_3166_2,region,sub_region,intermediate_region,"
          "region_code,sub_region_code,intermediate_region_code\n"
          'Nowhere,NA,NWH,007,ISO 3166-2:NA,"","",,002,,\n')
    r = files.read_country_seed(spark, f"{tmp_dir}/seed.csv").first()
    assert (r.alpha_2, r.country_code, r.region, r.region_code, r.sub_region_code) == ("NA", 7, None, 2, None)


def test_folder_of_one_machine_is_refused_on_a_cluster():
    from consentflow.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_csv_columns_are_matched_by_name(spark, tmp_dir):
    """A file with its columns in another order (and one column missing) maps
    by header name, not by position."""
    p = f"{tmp_dir}/reordered.csv"
    write(p, "TYPE,EVENT_ID,RATE,COUNT,EVENT_TIME,APIKEY\n"
             "pageview,e7,0.1,10,2025-09-05 01:15:00.000,c1\n")
    r = files.read_events_csv(spark, p, RAW_EVENT_SCHEMA).first()
    assert (r.EVENT_ID, r.TYPE, r.RATE, r.COUNT, r.APIKEY) == ("e7", "pageview", 0.1, 10, "c1")
    assert r.USER_ID is None and r.COUNTRY is None
    assert r.EVENT_TIME == dt.datetime(2025, 9, 5, 1, 15)


def test_csv_quoted_empty_number_is_null(spark, tmp_dir):
    p = f"{tmp_dir}/empty.csv"
    write(p, 'EVENT_ID,RATE,COUNT,EXPERIMENT\ne1,"",5,""\n')
    r = files.read_events_csv(spark, p, RAW_EVENT_SCHEMA).first()
    assert r.EVENT_ID == "e1" and r.RATE is None and r.COUNT == 5 and r.EXPERIMENT is None


def test_company_csv_by_name(spark, tmp_dir):
    p = f"{tmp_dir}/company.csv"
    write(p, "HQ_COUNTRY,PUBLIC_API_KEY,INDUSTRY_FRONT,INDUSTRY_BACK\n,k1,Sport,Gaming / Sport\n")
    r = files.read_company_csv(spark, p).first()
    assert (r.PUBLIC_API_KEY, r.INDUSTRY_BACK, r.INDUSTRY_FRONT, r.HQ_COUNTRY) == \
        ("k1", "Gaming / Sport", "Sport", None)


def test_stream_consent_daily_reads_earlier_events_once(spark, tmp_dir):
    """A micro-batch adds to the totals of its days: the events of an earlier one
    may be gone. A store without totals has them made of its events."""
    import shutil

    src, fact = f"{tmp_dir}/landing", f"{tmp_dir}/fct_consent"
    df = files.read_events_csv(spark, _csv(tmp_dir), RAW_EVENT_SCHEMA)
    days = "event_dt", "company_id"

    def run(i, rows):
        rows.coalesce(1).write.parquet(f"{src}/b{i}")
        file_stream.stream_consent_daily(spark, f"{src}/*", RAW_EVENT_SCHEMA, fact, f"{tmp_dir}/ck", max_files_per_trigger=1)
        return {tuple(r[c] for c in days): r for r in spark.read.parquet(fact).collect()}

    once = run(0, df)
    shutil.rmtree(f"{fact}_totals")
    timeless = df.withColumn("EVENT_TIME", F.lit(None).cast("timestamp_ntz"))
    twice = run(1, df.unionByName(timeless))
    for path in glob.glob(f"{fact}_events/event_dt=*/epoch=e0"):
        shutil.rmtree(path)
    thrice = run(2, df)
    assert set(once) < set(twice) == set(thrice)
    for key, r in once.items():
        for c in ("event_count", "event_pageview_count", "event_consent_given_count", "event_ui_action_count"):
            want = [None if r[c] is None else k * r[c] for k in (2, 3)]
            assert [twice[key][c], thrice[key][c]] == want
        assert thrice[key].consent_conversion_rate == r.consent_conversion_rate and thrice[key].consent_uq == r.consent_uq
