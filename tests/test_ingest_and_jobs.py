"""CSV ingest, scratch space, and the layered job from CSV to audited marts."""

import pytest
from compare import _sorted
from conftest import rows

from ordermill.operators import marts
from ordermill.operators.clean import CLEANERS
from ordermill.plans import medallion
from ordermill.plans.validation import ValidationError
from ordermill.sources import contracts, ingest
from ordermill.sources import tables as io


def test_free_text_stays_in_its_record(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"good","first line\nsecond, line with ""quotes""",2020-01-01 00:00:00,2020-01-02 00:00:00\n'
        "r2,o2,five,,,2020-01-01 00:00:00,\n"
        "r3,o3\n"
    )
    schema = contracts.local_time_contract("order_reviews")
    got = io.read_csv_permissive(spark, str(path), schema, multi_line=True, keep_corrupt=True).orderBy("review_id").collect()
    assert [r["review_id"] for r in got] == ["r1", "r2", "r3"]
    assert got[0]["review_comment_message"] == 'first line\nsecond, line with "quotes"'
    assert got[0][io.CORRUPT] is None
    assert got[1]["review_score"] is None and got[1]["order_id"] == "o2" and got[1][io.CORRUPT] is not None
    assert got[2]["review_creation_date"] is None and got[2][io.CORRUPT] is not None
    split = io.read_csv_permissive(spark, str(path), schema).count()
    assert split == 4  # without multi_line the first record breaks in two


def test_columns_in_another_order_raise(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_city,seller_id,seller_zip_code_prefix,seller_state\nNYC,s1,10001,NY\n")
    schema = contracts.contract("sellers")
    for read in (io.read_csv, io.read_csv_permissive):
        with pytest.raises(Exception, match="(?i)header"):
            read(spark, str(path), schema).collect()


def test_amounts_that_are_no_numbers_become_null_findings(spark):
    raw = spark.createDataFrame(
        [("o", 1, "p", "s", None, float("nan"), 1.0), ("o", 2, "p", "s", None, 2.5, float("-inf"))],
        contracts.contract("order_items"),
        verifySchema=False,
    )
    clean = CLEANERS["order_items"](raw)
    assert [(r["price"], r["freight_value"]) for r in clean.orderBy("order_item_id").collect()] == [(None, 1.0), (2.5, None)]
    assert clean.agg(marts.money_sum("price")).first()[0] == 2.5


def test_contract_columns_need_no_session():
    for table in contracts.SOURCE_TABLES:
        assert contracts.columns(table) == contracts.contract(table).fieldNames()


def test_csv_round_trip_keeps_padding_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(' a "b", c\\ ', "x\ny", None), ("é", " ", "z")], "a string, b string, c string")
    io.write_csv(df, str(tmp_path / "csv"))
    back = io.read_csv_permissive(spark, str(tmp_path / "csv"), df.schema, multi_line=True)
    assert rows(back, "a") == rows(df, "a")


def test_contracts_cover_the_tables():
    assert len(contracts.SOURCE_TABLES) == 9
    assert set(contracts.CRITICAL_COLUMNS) == set(contracts.SOURCE_TABLES) == set(CLEANERS)
    for table, columns in contracts.CRITICAL_COLUMNS.items():
        assert set(columns) <= set(contracts.contract(table).fieldNames())
    assert not contracts.contract("orders")["order_id"].nullable
    assert contracts.contract("orders")["order_approved_at"].dataType.simpleString() == "timestamp"


def test_missing_inputs_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="no raw path"):
        ingest.bronze_ingest(spark, {"orders": "x"}, str(tmp_path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest.bronze_ingest(spark, {t: str(tmp_path / "absent") for t in contracts.SOURCE_TABLES}, str(tmp_path / "b"))


def test_unreadable_table_raises(spark, tmp_path):
    bad = tmp_path / "orders"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        spark.read.parquet(str(bad)).count()


def test_scratch_paths_are_fresh_and_follow_the_setting(spark):
    assert io.scratch_path(spark, "x") != io.scratch_path(spark, "x")

    class Cluster:
        def __init__(self, **conf):
            self.conf = conf

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    def session(**conf):
        fake = Cluster()
        fake.conf = Conf(conf)
        return fake

    shared = session(**{"spark.checkpoint.dir": "hdfs://shared/scratch/", "spark.master": "yarn"})
    assert io.scratch_path(shared, "x").startswith("hdfs://shared/scratch/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        io.scratch_path(session(**{"spark.master": "yarn"}), "x")


@pytest.fixture(scope="module")
def layers(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    raw = {t: str(root / "raw" / t) for t in contracts.SOURCE_TABLES}
    for table, path in raw.items():
        io.write_csv(tables.raw(table), path)
    schemas = {t: contracts.local_time_contract(t) for t in contracts.SOURCE_TABLES}
    return raw, schemas, medallion.run_medallion(spark, raw, str(root / "lake"), schemas, strict=False)


def test_job_equals_direct_plans(layers, tables):
    gold = layers[2]["gold"]
    direct = {
        "orders": tables.gold_orders(),
        "customers": marts.gold_customers(tables.silver("customers"), tables.gold_orders()),
        "category": marts.gold_category(tables.silver("order_items"), tables.silver("products"), tables.silver("category_translation")),
        "geolocation": marts.gold_geolocation(tables.silver("geolocation")),
    }
    for name, df in direct.items():
        assert sorted(gold[name].columns) == sorted(df.columns)
        want = _sorted(df.columns, [tuple(r) for r in df.collect()])
        assert _sorted(gold[name].columns, [tuple(r) for r in gold[name].collect()]) == want, name


def test_job_audit_and_growth(layers, tables):
    findings = layers[2]["audit"]["findings"]
    assert findings.count() == 59
    failed = {(r["table"], r["column"]) for r in findings.filter("not passed").collect()}
    assert failed == {("reviews", "average_response_hours")}  # answers before the review are in the data
    counts = medallion.layer_row_counts({k: v for k, v in layers[2].items() if k != "audit"})
    growth = medallion.layer_growth(counts)
    assert growth.filter("increased").count() == 0
    assert growth.filter("bronze_rows <> silver_rows").count() == 0


def test_rejected_records_stay_beside_bronze(spark, tables, tmp_path):
    raw = {t: str(tmp_path / "raw" / t) for t in contracts.SOURCE_TABLES}
    for table, path in raw.items():
        io.write_csv(tables.raw(table).limit(5), path)
    (tmp_path / "raw" / "sellers" / "part-bad.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns9,none,Here,NY\n"
    )
    schemas = {t: contracts.local_time_contract(t) for t in contracts.SOURCE_TABLES}
    bronze = ingest.bronze_ingest(spark, raw, str(tmp_path / "bronze"), schemas)
    bad = bronze["sellers"].filter("seller_id = 's9'").first()
    assert bad["seller_zip_code_prefix"] is None and bad["seller_city"] == "Here"
    assert rows(ingest.rejected_records(spark, str(tmp_path / "bronze"))) == [("sellers", "s9,none,Here,NY")]
    assert bronze["sellers"].columns == contracts.columns("sellers")


def test_strict_job_raises(layers, spark, tmp_path):
    raw, schemas, _ = layers
    with pytest.raises(ValidationError, match="average_response_hours"):
        medallion.run_medallion(spark, raw, str(tmp_path), schemas)


def test_scratch_is_removed_when_asked(spark, monkeypatch):
    monkeypatch.setattr(io, "_scratch", [])
    table = io.materialize(spark.range(10), "some")
    path = io._scratch[0]
    assert table.count() == 10 and io.path_exists(spark, path)
    never_written = io.scratch_path(spark, "never")
    io.remove_scratch(spark)
    assert not io.path_exists(spark, path) and not io.path_exists(spark, never_written) and io._scratch == []
