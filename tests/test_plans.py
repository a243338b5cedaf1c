"""Messages to gold for both data sets, as streams and as tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from smeltery.plans import demand, machine
from smeltery.sources import commits, readers, schemas, writers

NOW = dt.datetime(2024, 5, 1, 12)


def sale(n, **changes):
    return {
        "transaction_id": f"t{n}", "timestamp": (NOW + dt.timedelta(minutes=n)).isoformat(), "drug_id": "D1",
        "drug_name": " Name ", "drug_category": "C", "drug_type": "T", "region_id": "R1", "region_name": "City ",
        "zone": "North", "tier": "Tier 1", "channel": "Retail", "quantity_sold": 10 + n, "unit_price": 2.5,
        "returns": 1, "revenue": 20.25, "cold_chain_required": True, "is_generic": False, "manufacturer": "M",
        "ingestion_source": "s", "ingestion_timestamp": NOW.isoformat(), **changes,
    }


def sensor(n, **changes):
    return {
        "reading_id": f"r{n}", "machine_id": "M1", "machine_name": "Pump_1", "machine_type": "Pump", "location": "Plant-A",
        "timestamp": (NOW + dt.timedelta(seconds=30 * n)).isoformat(), "temperature": 70.0 + n, "vibration": 1.0,
        "pressure": 5.0, "rpm": 1500.0, "voltage": 230.0, "degradation_factor": 0.1, "is_degrading": False,
        "will_fail_in_4hrs": False, "ingestion_source": "s", "ingestion_timestamp": NOW.isoformat(), **changes,
    }


def put(folder, name, messages):
    folder.mkdir(exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n")


SALES = [
    sale(1), sale(2), sale(2, quantity_sold=99), sale(3, region_id=None), sale(4, timestamp="soon"),
    "{broken", sale(5, quantity_sold="many"), sale(6, drug_id="D9", returns=5),
]
READINGS = [
    sensor(1), sensor(2, temperature=106.0), sensor(2, temperature=106.0), sensor(3, pressure=None),
    sensor(4, machine_id=" M9 "), sensor(5, voltage=999.0), sensor(6, is_degrading=True), "nonsense",
]


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "drug_master.csv").write_text(
        "drug_id,drug_name,category,drug_type,shelf_life_months,cold_chain_required,is_generic,manufacturer,unit_price\n"
        "D1,Name,C,T,24,False,True,M,2.5\n"
    )
    (folder / "region_master.csv").write_text(
        "region_id,region_name,state,zone,tier,population_proxy,num_hospitals,num_clinics\nR1,City,S,North,Tier 1,1000,5,7\n"
    )
    (folder / "seasonal_events.csv").write_text(
        "event_id,event_name,event_type,demand_impact,affected_zones,affected_drug_categories,start_date,end_date\n"
        "E1,a,t,High,North,C,2024-04-28,2024-05-01\nE2,b,t,Low,South,C,2024-05-01,2024-05-03\n"
    )
    limits = ",".join(f"{s}_{b}" for s in ("temp", "vibration", "pressure", "rpm", "voltage") for b in ("min", "max", "critical"))
    (folder / "machine_master.csv").write_text(
        f"machine_id,machine_name,machine_type,location,manufacturer,installation_date,age_years,criticality,{limits}\n"
        "M1,Pump_1,Pump,Plant-A,K,2020-01-01,4.3,High,60,85,105,0.5,3,6,2,8,12,1200,1800,2200,210,240,260\n"
    )
    return folder


def run_bronze(spark, plan, tmp_path):
    messages = readers.json_lines_stream(spark, str(tmp_path / "in"))
    plan.start_bronze(messages, str(tmp_path / "bronze"), str(tmp_path / "c1"), every=None).awaitTermination()
    plan.start_quarantine(messages, str(tmp_path / "rejects"), str(tmp_path / "c2"), every=None).awaitTermination()


def run_silver(spark, plan, schema, dims, tmp_path):
    stream = readers.parquet_stream(spark, str(tmp_path / "bronze"), schema)
    plan.start_silver(stream, dims, str(tmp_path / "silver"), str(tmp_path / "c3"), every=None).awaitTermination()


def same(a, b, leave_out):
    names = sorted(set(a.columns) & set(b.columns) - set(leave_out))
    return a.select(names).exceptAll(b.select(names)).count() == 0 and a.count() == b.count()


def test_demand(spark, raw, tmp_path):
    put(tmp_path / "in", "1.json", SALES)
    run_bronze(spark, demand, tmp_path)
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == 6 and len(bronze.columns) == 24
    reasons = {r.reject_reason for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert reasons == {"malformed message", "unreadable time"}

    dims = demand.read_dimensions(spark, str(raw))
    run_silver(spark, demand, schemas.SALES_BRONZE, dims, tmp_path)
    silver = commits.read_table(spark, str(tmp_path / "silver"))
    rows = {r.transaction_id: r for r in silver.collect()}
    assert set(rows) == {"t1", "t2", "t6"} and silver.count() == 3
    one, other = rows["t1"], rows["t6"]
    assert (one.cold_chain_required, one.is_generic, one.shelf_life_months) == (False, True, 24)
    assert (other.cold_chain_required, other.shelf_life_months, other.num_clinics) == (True, None, 7)
    assert (one.drug_name, one.region_name, one.is_event_day) == ("Name", "City", True)
    assert (one.high_return_flag, other.high_return_flag) == (False, True)
    assert len(silver.columns) == 35
    table = demand.silver(bronze, dims).filter("transaction_id <> 't2'")
    assert same(table, silver.filter("transaction_id <> 't2'"), ["silver_processed_at"])

    report = demand.write_gold(silver, str(tmp_path / "gold"))
    assert report == {"rows": 2, "columns": 40}
    assert spark.read.parquet(str(tmp_path / "gold")).agg(F.sum("num_transactions")).first()[0] == 3


def test_a_second_run_adds_only_new_messages(spark, raw, tmp_path):
    dims = demand.read_dimensions(spark, str(raw))
    for name, messages in (("1.json", [sale(1), sale(2)]), ("2.json", [sale(2), sale(3)])):
        put(tmp_path / "in", name, messages)
        run_bronze(spark, demand, tmp_path)
        for _ in range(2):
            run_silver(spark, demand, schemas.SALES_BRONZE, dims, tmp_path)
    silver = commits.read_table(spark, str(tmp_path / "silver"))
    assert sorted(r.transaction_id for r in silver.collect()) == ["t1", "t2", "t3"]


def test_refresh_equals_full_gold(spark, tmp_path):
    rows = [(n, d, r, dt.date(2022 + m // 12, m % 12 + 1, 5), 5 + (n * m) % 7) for n, (d, r) in enumerate((("D1", "R1"), ("D2", "R1")), 1) for m in range(30)]
    base = spark.createDataFrame(rows, "n int, drug_id string, region_id string, transaction_date date, quantity_sold int").withColumns(
        {
            **{c: F.lit("x") for c in demand.ATTRIBUTES[:7]}, **{c: F.lit(True) for c in demand.ATTRIBUTES[7:9]},
            **{c: F.lit(1) for c in demand.ATTRIBUTES[9:]}, "transaction_id": F.lit("t"), "revenue": F.lit(1).cast("decimal(18,2)"),
            "returns": F.lit(0), "unit_price": F.lit(1.0), "channel": F.lit("Retail"), "is_event_day": F.lit(False),
            "year": F.year("transaction_date"), "month": F.month("transaction_date"),
        }
    )
    path = str(tmp_path / "gold")
    demand.write_gold(base, path, calendar_lags=True)
    late = base.unionByName(base.filter("year = 2023 AND month = 2").withColumn("quantity_sold", F.lit(100)))
    demand.refresh_gold(late, path, "2023-02", "2023-02")
    fresh = spark.read.parquet(path)
    demand.write_gold(late, str(tmp_path / "full"), calendar_lags=True)
    assert same(fresh, spark.read.parquet(str(tmp_path / "full")), ["gold_processed_at"])


def test_refresh_removes_a_month_that_became_empty(spark, tmp_path):
    names = "n int, drug_id string, region_id string, transaction_date date, quantity_sold int"
    rows = [(m, "D1", "R1", dt.date(2023, m, 5), 5) for m in (1, 2, 3, 5)]
    base = spark.createDataFrame(rows, names).withColumns(
        {
            **{c: F.lit("x") for c in demand.ATTRIBUTES[:7]}, **{c: F.lit(True) for c in demand.ATTRIBUTES[7:9]},
            **{c: F.lit(1) for c in demand.ATTRIBUTES[9:]}, "transaction_id": F.lit("t"), "revenue": F.lit(1).cast("decimal(18,2)"),
            "returns": F.lit(0), "unit_price": F.lit(1.0), "channel": F.lit("Retail"), "is_event_day": F.lit(False),
            "year": F.year("transaction_date"), "month": F.month("transaction_date"),
        }
    )
    path = str(tmp_path / "gold")
    demand.write_gold(base, path, calendar_lags=True)
    left = base.filter("month <> 3")
    assert demand.refresh_gold(left, path, "2023-03", "2023-03")["rows"] == 1
    demand.write_gold(left, str(tmp_path / "full"), calendar_lags=True)
    assert same(spark.read.parquet(path), spark.read.parquet(str(tmp_path / "full")), ["gold_processed_at"])


def test_silver_rejects_are_written(spark, tmp_path):
    put(tmp_path / "in", "1.json", SALES)
    run_bronze(spark, demand, tmp_path)
    stream = readers.parquet_stream(spark, str(tmp_path / "bronze"), schemas.SALES_BRONZE)
    demand.start_rejects(stream, str(tmp_path / "left-out"), str(tmp_path / "c4"), every=None).awaitTermination()
    rejects = spark.read.parquet(str(tmp_path / "left-out"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    complete = bronze.count() - rejects.count()
    assert rejects.count() > 0 and rejects.filter("reject_reason LIKE 'missing %'").count() == rejects.count()
    assert complete == demand.keep_required(demand.typed(bronze), demand.REQUIRED).count()


def test_machine(spark, raw, tmp_path):
    put(tmp_path / "in", "1.json", READINGS)
    run_bronze(spark, machine, tmp_path)
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == 7 and len(bronze.columns) == 19
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1

    master = machine.read_master(spark, str(raw))
    run_silver(spark, machine, schemas.SENSOR_BRONZE, master, tmp_path)
    silver = commits.read_table(spark, str(tmp_path / "silver"))
    rows = {r.reading_id: r for r in silver.collect()}
    assert set(rows) == {"r1", "r2", "r4", "r5", "r6"} and silver.count() == 5
    assert [rows[k].is_anomaly for k in ("r1", "r2", "r4", "r5", "r6")] == [False, True, False, False, True]
    assert (rows["r2"].temp_anomaly, rows["r2"].sensor_out_of_range) == (True, True)
    assert (rows["r5"].voltage_anomaly, rows["r5"].sensor_out_of_range) == (True, False)
    assert (rows["r4"].machine_id, rows["r4"].master_missing, rows["r1"].master_missing) == ("M9", True, False)
    assert len(silver.columns) == 37 + 2  # and the voltage flag and the missing-master flag
    assert same(machine.silver(bronze, master), silver, ["silver_processed_at"])

    report = machine.write_gold(silver, str(tmp_path / "gold"))
    assert report == {"rows": 5, "columns": 104}
    gold = {r.reading_id: r for r in spark.read.parquet(str(tmp_path / "gold")).collect()}
    assert (gold["r2"].temperature_lag1, gold["r6"].temperature_lag1) == (71.0, 75.0)
    assert (gold["r1"].anomaly_count_5m, gold["r6"].anomaly_count_5m) == (1 - 1, 2)
    assert gold["r2"].temperature_mean_5m == pytest.approx((71.0 + 106.0) / 2)


def test_normal_range_is_optional(spark, raw):
    row = spark.createDataFrame([("M1", "Pump", "Plant-A", 59.0, 1.0, 5.0, 1500.0, 230.0, False, dt.date(2024, 1, 1))],
        "machine_id string, machine_type string, location string, temperature double, vibration double, pressure double, rpm double, voltage double, is_degrading boolean, reading_date date")
    master = machine.read_master(spark, str(raw))
    out = machine.enrich(row, master, normal_range=True).first()
    assert (out.outside_normal_range, out.sensor_out_of_range) == (True, False)


def test_messages_carry_key_and_row(spark):
    df = spark.createDataFrame([(7, "a")], "id int, name string")
    message = writers.keyed_messages(df, "id").first()
    assert message.key == "7" and json.loads(message.value) == {"id": 7, "name": "a"}


def test_kafka_source_is_parameterised(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.kafka_stream(spark, "broker:9092", demand.TOPIC, max_offsets_per_trigger=10)
