import gzip
from datetime import date
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException

from shelfweek.schemas import CALENDAR, INVENTORY, STORE
from shelfweek.sinks.catalog import register_dimension
from shelfweek.sinks.writers import write_csv, write_landing, write_snapshot
from shelfweek.sources.files import load_tables, read_csv
from tests.fixtures import bag, micro, rows

STORE_ROW = {
    "store_key": 1,
    "store_num": "00042",
    "store_desc": 'Say "hi", twice',
    "addr": "1 Main Street, Unit 2",
    "postal_zip_cd": "00123",
    "frnchs_flg": True,
    "store_size": Decimal("12.500"),
    "latitude": Decimal("1.000001"),
}


@pytest.fixture
def stores(spark):
    return rows(spark, STORE, STORE_ROW, {"store_key": 2, "frnchs_flg": False})


def data_files(path):
    return [f for f in path.iterdir() if f.name.startswith("part-")]


def test_typed_scan_returns_what_was_written(spark, stores, tmp_path):
    path = write_csv(stores, str(tmp_path / "store"))
    back = read_csv(spark, path, STORE)
    assert back.schema == STORE
    assert bag(back) == bag(stores)


def test_inference_loses_leading_zeros_and_the_schema_keeps_them(spark, stores, tmp_path):
    path = write_csv(stores, str(tmp_path / "store"))
    inferred = read_csv(spark, path).filter("store_key = 1").first()
    assert (inferred.postal_zip_cd, inferred.store_num) == (123, 42)
    typed = read_csv(spark, path, STORE).filter("store_key = 1").first()
    assert (typed.postal_zip_cd, typed.store_num) == ("00123", "00042")


def test_flags_may_be_numbers(spark, tmp_path):
    file = tmp_path / "inventory.csv"
    file.write_text(
        ",".join(INVENTORY.fieldNames())
        + "\n2023-01-02,1,10,4.00,20.00,0,0.00,1,2023-01-09\n2023-01-03,1,10,,,,,0,\n"
    )
    back = read_csv(spark, str(file), INVENTORY).orderBy("cal_dt").collect()
    assert [r.promotion_flg for r in back] == [True, False]
    assert back[0].inventory_on_hand_qty == Decimal("4.00")
    assert back[1].next_delivery_dt is None


def test_header_must_match_the_schema(spark, tmp_path):
    file = tmp_path / "calendar.csv"
    file.write_text("2023-01-02,X,1,Mon,2023,1,202301,1,202301,1,20231\n" * 2)
    with pytest.raises(Py4JJavaError, match="header"):
        read_csv(spark, str(file), CALENDAR).collect()
    assert read_csv(spark, str(file), CALENDAR, header=False).count() == 2
    assert read_csv(spark, str(file)).columns[0] == "2023-01-02"


def test_a_value_that_does_not_parse_is_an_error(spark, tmp_path):
    file = tmp_path / "calendar.csv"
    file.write_text(",".join(CALENDAR.fieldNames()) + "\nsoon,X,1,Mon,2023,1,1,1,1,1,1\n")
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        read_csv(spark, str(file), CALENDAR).collect()


def test_fields_may_span_lines(spark, tmp_path):
    file = tmp_path / "store.csv"
    values = ["7", "1", '"two\nlines"'] + [""] * (len(STORE) - 3)
    file.write_text(",".join(STORE.fieldNames()) + "\n" + ",".join(values) + "\n")
    assert read_csv(spark, str(file), STORE, multi_line=True).first().store_desc == "two\nlines"


def test_gzip_is_read_by_its_extension(spark, tmp_path):
    text = ",".join(CALENDAR.fieldNames()) + "\n2023-01-02,X,1,Mon,2023,1,1,1,1,1,1\n"
    packed, mislabelled = tmp_path / "a.csv.gz", tmp_path / "b.csv.gz"
    packed.write_bytes(gzip.compress(text.encode()))
    mislabelled.write_text(text)
    assert read_csv(spark, str(packed), CALENDAR).first().cal_dt == date(2023, 1, 2)
    with pytest.raises(Py4JJavaError, match="not a gzip file"):
        read_csv(spark, str(mislabelled), CALENDAR).collect()


def test_load_tables_typed_and_inferred(spark, tmp_path):
    sales, calendar, inventory = micro(spark)
    frames = {"sales": sales, "calendar": calendar, "inventory": inventory}
    paths = {n: write_csv(f, str(tmp_path / n)) for n, f in frames.items()}
    loaded = load_tables(spark, paths)
    assert {n: bag(f) for n, f in loaded.items()} == {n: bag(f) for n, f in frames.items()}
    assert dict(load_tables(spark, paths, infer=True)["sales"].dtypes)["sales_qty"] == "double"


def test_csv_copy_is_one_file_or_one_per_task(spark, tmp_path):
    many = spark.range(100).repartition(4)
    write_csv(many, str(tmp_path / "one"))
    write_csv(many, str(tmp_path / "more"), single_file=False)
    assert len(data_files(tmp_path / "one")) == 1
    assert len(data_files(tmp_path / "more")) == 4
    assert bag(read_csv(spark, str(tmp_path / "more"))) == bag(many)


ODD_TEXTS = ["  007 ", " pad ", "", None, 'say "hi", twice', "two\nlines", "cr\r\nlf", "\\N", "null", ",", '"', "\t"]


def test_odd_texts_survive_landing_loading_snapshot_and_catalog(spark, tmp_path):
    stores = rows(spark, STORE, *[
        {"store_key": i, "store_desc": t, "addr": t, "frnchs_flg": None} for i, t in enumerate(ODD_TEXTS)
    ])
    path = write_landing(stores, str(tmp_path / "landing"), "store", date(2023, 2, 1))
    loaded = load_tables(spark, {"store": path})["store"]
    assert bag(loaded) == bag(stores)
    write_snapshot(loaded, str(tmp_path / "out"), "store", date(2023, 2, 1))
    register_dimension(spark, str(tmp_path / "out"), "store", "odd_store")
    assert bag(spark.table("odd_store").drop("date")) == bag(stores)


def test_quoted_empty_text_may_stand_for_null(spark, tmp_path):
    file = tmp_path / "store.csv"
    file.write_text(",".join(STORE.fieldNames()) + '\n7,"",x' + "," * (len(STORE) - 3) + "\n")
    assert read_csv(spark, str(file), STORE).first().store_num == ""
    assert read_csv(spark, str(file), STORE, empty_is_null=True).first().store_num is None
    assert read_csv(spark, str(file), STORE).first().addr is None


def test_landing_files_are_bounded_in_rows(spark, tmp_path):
    many = spark.range(100).repartition(1)
    write_landing(many, str(tmp_path), "sales", date(2023, 2, 1), file_rows=30)
    assert len(data_files(tmp_path / "sales" / "date=2023-02-01")) == 4


def test_csv_write_modes(spark, stores, tmp_path):
    path = write_csv(stores, str(tmp_path / "store"))
    write_csv(stores, path, "append")
    assert read_csv(spark, path, STORE).count() == 4
    write_csv(stores, path, "overwrite")
    assert read_csv(spark, path, STORE).count() == 2
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_csv(stores, path, "error")


def test_snapshots_are_found_by_date(spark, stores, tmp_path):
    for on in (date(2023, 1, 1), date(2023, 1, 2)):
        write_snapshot(stores, f"{tmp_path}//", "store", on)
    assert (tmp_path / "store" / "date=2023-01-02").is_dir()
    back = spark.read.option("header", True).csv(str(tmp_path / "store"))
    assert dict(back.dtypes)["date"] == "date"
    assert back.filter("date = '2023-01-02'").count() == 2


def test_landing_extract_is_gzip_with_header(spark, tmp_path):
    sales, _, _ = micro(spark)
    path = write_landing(sales, str(tmp_path), "sales", date(2023, 2, 1))
    assert path.endswith("sales/date=2023-02-01")
    part = data_files(tmp_path / "sales" / "date=2023-02-01")[0]
    assert gzip.open(part, "rt").readline().startswith("trans_id,prod_key")
