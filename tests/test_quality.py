import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import quality as Q
from tidewater.session import work_dir
from tidewater.sources import landing as L


def results(df):
    return {r["rule"]: (r["passed"], r["failing"]) for r in df.collect()}


def test_suite_counts(spark):
    df = spark.createDataFrame(
        [(1, "a@b.c", 5.0, True), (1, "bad", 0.0, False), (2, None, -1.0, True), (None, "x@y.z", 9.0, True)],
        "id int, email string, price double, is_current boolean",
    )
    rules = [
        Q.exists("id"),
        Q.exists("nope"),
        Q.not_null("id"),
        Q.unique("id"),
        Q.regex("email", Q.EMAIL),
        Q.between("price", low=0, strict_low=True),
        Q.in_set("id", (1, 2)),
        Q.row_count(low=5),
    ]
    got = results(Q.run_suite(df, rules))
    assert got == {
        "exists(id)": (True, 0),
        "exists(nope)": (False, 1),
        "not_null(id)": (False, 1),
        "unique(id)": (False, 2),
        "regex(email)": (False, 1),
        "between(price)": (False, 2),
        "in_set(id)": (True, 0),
        "row_count": (False, 1),
    }
    assert results(Q.run_suite(df, [Q.unique("id", where="is_current = true")]))["unique(id)"][0]


def test_gate(spark):
    failed = Q.run_suite(spark.range(1), [Q.row_count(low=2)])
    assert Q.gate(failed, "bronze") == ["row_count"]
    for layer in ("silver", "gold"):
        with pytest.raises(Q.QualityGateError):
            Q.gate(failed, layer)
    assert Q.gate(Q.run_suite(spark.range(3), [Q.row_count(low=2)]), "gold") == []


def test_empty_table(spark):
    empty = spark.createDataFrame([], "order_id string, user_id string, status string, total_amount double, created_at timestamp")
    assert all(p for p, _ in results(Q.run_suite(empty, Q.SILVER_ORDERS)).values())
    assert Q.null_rates(empty).where("null_rate <> 0").count() == 0


def test_quarantine_and_drift(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    good, bad = Q.quarantine(df, [Q.not_null("id")])
    assert good.count() == 1 and bad.first()["failed_rules"] == ["not_null(id)"]
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("w", T.StringType())])
    assert Q.schema_drift(declared, df.schema) == [
        ("id", "retyped", "bigint", "int"),
        ("v", "added", None, "string"),
        ("w", "missing", "string", None),
    ]


def write(spark, root, name, lines):
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    out = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(fs_path)
    out.write(bytearray("\n".join(lines), "utf-8"))
    out.close()


def test_csv_files(spark):
    root = work_dir(spark, "landing")
    write(spark, root, "catalog/good.csv", ["product_id,title,category,price,available", "1,A,x,10.5,true", "2,B,y,3,false"])
    write(spark, root, "catalog/negative.csv", ["product_id,title,category,price,available", "3,C,x,-10.0,true", "4,D,x,1,true"])
    write(spark, root, "catalog/shuffled.csv", ["price,extra,title,product_id,category,available", "7.5,zzz,E,5,x,true"])
    write(spark, root, "catalog/short.csv", ["product_id,title", "6,F"])
    out = work_dir(spark, "bronze-csv")
    assert L.land_csv(spark, root, out, "catalog", "2024-01-01") == 2
    assert L.land_csv(spark, root, out, "campaigns", "2024-01-01") == 0
    rows = spark.read.parquet(f"{out}/catalog")
    assert sorted((r["product_id"], r["price"], str(r["event_date"])) for r in rows.collect()) == [
        ("1", 10.5, "2024-01-01"),
        ("2", 3.0, "2024-01-01"),
        ("5", 7.5, "2024-01-01"),
    ]
    assert "extra" not in rows.columns
    verdicts = {r["source_file"].rsplit("/", 1)[1]: r["accepted"] for r in L.file_verdicts(L.read_landing_csv(spark, f"{root}/catalog", L.CATALOG), "catalog").collect()}
    assert verdicts == {"good.csv": True, "negative.csv": False, "shuffled.csv": True, "short.csv": False}


def test_csv_files_without_rows_or_model(spark):
    root, out = work_dir(spark, "landing"), work_dir(spark, "bronze-csv")
    head = "product_id,title,category,price,available"
    write(spark, root, "catalog/good.csv", [head, "1,A,x,10.5,true"])
    write(spark, root, "catalog/header.csv", [head])
    assert L.land_csv(spark, root, out, "catalog", "2024-01-01") == 2
    later = work_dir(spark, "landing")
    write(spark, later, "catalog/quoted.csv", ['"price","title, long",title,product_id,category,available', '7.5,zzz,"E ""e""",5,x,true'])
    assert L.land_csv(spark, later, out, "catalog", "2024-01-01") == 1
    rows = spark.read.parquet(f"{out}/catalog").collect()
    assert sorted((r["product_id"], r["title"], r["checked"]) for r in rows) == [("1", "A", True), ("5", 'E "e"', True)]
    write(spark, root, "campaigns/a.csv", ["name,budget", "spring,n/a"])
    write(spark, root, "campaigns/b.csv", ["name,channel", "autumn,mail"])
    assert L.land_csv(spark, root, out, "campaigns", "2024-01-01") == 2
    rows = spark.read.parquet(f"{out}/campaigns").collect()
    assert sorted((r["name"], r["budget"], r["channel"], r["checked"]) for r in rows) == [("autumn", None, "mail", False), ("spring", "n/a", None, False)]


def test_rates_and_addresses(spark):
    root = work_dir(spark, "api")
    write(spark, root, "rates/a.json", ['{"result": "success", "base_code": "USD",', ' "rates": {"BRL": 5.1, "EUR": 0.9}}'])
    write(spark, root, "cep/a.json", ['[{"cep": "01310-100", "logradouro": "Avenida Paulista"}, {"cep": "20.040-020"}]'])
    assert sorted(map(tuple, L.load_rates(spark, f"{root}/rates").collect())) == [("USD", "BRL", 5.1), ("USD", "EUR", 0.9)]
    assert sorted(r["cep"] for r in L.load_addresses(spark, f"{root}/cep").collect()) == ["01310100", "20040020"]


def test_optional_and_named_tables(spark):
    from tidewater.sources.bronze import read_bronze, read_optional, read_table

    root = work_dir(spark, "tables")
    assert read_optional(spark, f"{root}/gold/none") is None
    df = spark.range(2).withColumn("event_date", F.lit("2024-01-01").cast("date"))
    df.where("id < 0").write.parquet(f"{root}/gold/empty")
    assert read_optional(spark, f"{root}/gold/empty") is None
    df.write.partitionBy("event_date").parquet(f"{root}/gold/t")
    assert read_table(spark, "gold", "t", root).count() == 2
    day = read_bronze(spark, f"{root}/gold/t", "2024-01-01")
    assert "event_date" in day.columns and day.count() == 2
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString()


def test_landed_columns_named_like_ours_are_kept(spark):
    root, out = work_dir(spark, "landing"), work_dir(spark, "bronze")
    rows = spark.createDataFrame([("1999-01-01", "kept?", "x")], "event_date string, checked string, other string")
    rows.coalesce(1).write.option("header", True).csv(f"{root}/campaigns")
    assert L.land_csv(spark, root, out, "campaigns", "2024-05-05") == 1
    row = spark.read.parquet(f"{out}/campaigns").first()
    assert (row["data_event_date"], row["data_checked"], row["other"]) == ("1999-01-01", "kept?", "x")
    assert (str(row["event_date"]), row["checked"]) == ("2024-05-05", False)


def test_a_day_without_accepted_files_has_no_rows(spark, tmp_path):
    from tidewater.queries import queries

    part = spark.createDataFrame([(7, "Brand#1", "a", 1.0, 20), (507, "Brand#2", "b", 2.0, 5)], "p_partkey long, p_brand string, p_name string, p_retailprice double, p_size int")
    part.write.parquet(f"{tmp_path}/part.parquet")
    assert queries()["landed_files"](spark, str(tmp_path)).collect() == []
    assert L.read_landed(spark, str(tmp_path), "catalog", "2024-01-01").count() == 0
