import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluiceway.functions.text import is_json_sql
from sluiceway.operators.parse import enrich_responses, explode_records, select_documents

# body, record ids, whether try_parse_json gives a value
TRUTH = [
    ('[{"id":1,"t":"a"},{"id":2,"t":null}]', ["1", "2"], True),
    ('{"id":7,"n":{"x":[1,2]},"f":1.50,"b":true}', ["7"], True),
    ("[]", [], True),
    ("{}", [None], True),
    ("[1,2]", [], True),
    ('"str"', [], True),
    ("42", [], True),
    ("null", [], True),
    ('[{"id":1},5]', [], True),
    ('[{"id":1},null,{"x":2}]', ["1", None], True),
    ('{"id":1,"id":2}', ["1"], False),
    ('[{"id":"1"},{"id":1.0}]', ["1", "1.0"], True),
    ('{"id":{"k":1}}', ['{"k":1}'], True),
    ("", [], False),
    ("   ", [], False),
    ("not json", [], False),
    ('{"a":1', [], False),
    ('[{"id":1},', [], False),
    (None, [], False),
]


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [(f"/{i}", f"{i}", 200, body, f"run{i}") for i, (body, _, _) in enumerate(TRUTH)]
    landing = spark.createDataFrame(
        rows, "endpoint string, url string, status_code int, response_body string, run_id string"
    ).withColumn("fetched_at", F.lit("2024-03-01 10:00:00").cast("timestamp"))
    return enrich_responses(landing, F.col("fetched_at"))


def test_records_follow_the_truth_table(bronze):
    found = {}
    for row in explode_records(bronze).collect():
        found.setdefault(row["endpoint"], []).append(row["record_id"])
    for i, (body, ids, _) in enumerate(TRUTH):
        assert found.get(f"/{i}", []) == ids, body


def test_documents_follow_the_truth_table(bronze):
    found = {row["endpoint"] for row in select_documents(bronze).select("endpoint").collect()}
    assert found == {f"/{i}" for i, (_, _, parsed) in enumerate(TRUTH) if parsed}


def test_record_json_keeps_nested_values_as_text(bronze):
    row = explode_records(bronze).filter("endpoint = '/1'").first()
    assert json.loads(row["record_json"]) == {"id": "7", "n": '{"x":[1,2]}', "f": "1.5", "b": "true"}
    second = explode_records(bronze).filter("endpoint = '/0' AND record_id = '2'").first()
    assert second["record_json"] == '{"id":"2","t":null}'


def test_enrich_keeps_the_raw_body_and_stamps_the_day(bronze):
    row = bronze.filter("endpoint = '/15'").first()
    assert row["response_body"] == "not json" and row["response_variant"] is None
    assert str(row["ingest_date"]) == "2024-03-01"


def test_variant_survives_parquet_and_cannot_be_grouped(spark, bronze, tmp_path):
    bronze.write.parquet(str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.selectExpr("response_variant:n.x[1]::int AS x").filter("x IS NOT NULL").collect() == [(2,)]
    with pytest.raises(AnalysisException):
        back.groupBy("response_variant").count()


def test_only_whole_texts_count_as_json(spark):
    texts = [
        # A repeated key is valid JSON, though no VARIANT can hold it.
        *[(body, parsed or body == '{"id":1,"id":2}') for body, _, parsed in TRUTH if body is not None],
        ("42 apples", False), ('{"a":1} x', False), ("[1] [2]", False), ("1,2", False), ("1] [2", False),
        ('{"a":1}{"b":2}', False), (" [1, {}] \n", True), ("-1.5e3", True), ('"a\\"b"', True), ("]", False),
    ]
    df = spark.createDataFrame(texts, "body string, whole boolean")
    wrong = df.filter(F.expr(is_json_sql("body")) != F.col("whole")).collect()
    assert wrong == []
