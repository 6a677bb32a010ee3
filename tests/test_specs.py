import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway.functions.text import json_value
from sluiceway.sources.control import control_slice, request_specs


@pytest.mark.parametrize("text", ['[{"path":"/a"}, 5]', '[{"path":"/a"}', "{", "5"])
def test_malformed_spec_arrays_are_errors(spark, text):
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED"):
        request_specs(spark, endpoints_json=text).collect()


def test_bodies_with_a_repeated_key_are_json(spark):
    bodies = spark.createDataFrame([('{"a":1,"a":2}',), ("42 apples",)], "body string")
    assert [r[0] for r in bodies.select(json_value("body")).collect()] == ['{"a":1,"a":2}', '"42 apples"']


def test_a_slice_reads_cells_as_the_compiler_does(spark):
    control = spark.createDataFrame([(" d", "on"), ("d ", " YES"), ("d", "1"), ("e", "true"), ("d", None)], "domain string, enabled string")
    assert control_slice(control, "d").select(F.trim("enabled")).collect() == [("YES",), ("1",)]
