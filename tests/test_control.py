import json

import pytest

from sluiceway.plans.control import (
    compile_domains,
    compile_specs,
    compile_stats,
    duplicate_endpoints,
    endpoint_parameters,
)
from sluiceway.sources.control import (
    read_control_csv,
    read_control_table,
    request_specs,
    specs_from_rows,
    with_control_columns,
)

# The demo control rows of FIXTURES.md, section 1.
SEVEN = "domain,endpoint_name,path,method,params,schedule,enabled"
DEMO = [
    "blog,posts,/posts,GET,,0 0 */4 * * ?,true",
    "blog,comments,/comments,GET,postId=1,0 0 */4 * * ?,true",
    "gallery,albums,/albums,GET,,0 30 2 * * ?,true",
    "gallery,photos,/photos,GET,,0 30 2 * * ?,true",
    "accounts,users,/users,GET,,0 0 6 * * ?,true",
    "accounts,todos,/todos,GET,,0 0 6 * * ?,false",
]


def csv_at(spark, tmp_path, header, lines):
    path = tmp_path / "control.csv"
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return read_control_csv(spark, str(path))


def by_domain(df):
    return {r["domain"]: r.asDict() for r in df.collect()}


def test_demo_table_compiles_as_documented(spark, tmp_path):
    control = csv_at(spark, tmp_path, SEVEN, DEMO)
    assert compile_stats(control).first().asDict() == {
        "rows": 6, "enabled_endpoints": 5, "domains": 3, "skipped_disabled": 1, "non_get_endpoints": 0,
    }
    specs = compile_specs(control)
    domains = by_domain(compile_domains(specs))
    assert {d: v["endpoints"] for d, v in domains.items()} == {"accounts": 1, "blog": 2, "gallery": 2}
    assert domains["blog"]["schedule"] == "0 0 */4 * * ?"
    assert domains["blog"]["auth_mode"] == "connection" and domains["blog"]["silver_shape"] == "records"
    parameters = by_domain(endpoint_parameters(specs))
    assert parameters["blog"]["api_endpoints"] == "/posts,/comments?postId=1"
    assert parameters["blog"]["api_endpoints_json"] is None


def test_rows_that_need_a_json_parameter(spark, tmp_path):
    lines = [
        'grid,export,/export,post,,,Yes,"{""a"": [1, 2]}",Basic_Secret,Document',
        "grid,raw,/raw,,,0 1 * * * ?,1,42 apples,other,records",
        "grid,none,,GET,,,true,,,",
        ",lost,/lost,GET,,,no,,,",
        'grid,comma,"/a,b",GET,,0 2 * * * ?, t ,,,',
        "plain,comma,\"/a,b\",GET,,,true,,,",
    ]
    control = csv_at(spark, tmp_path, SEVEN + ",body,auth_mode,silver_shape", lines)
    specs = compile_specs(control)
    domain = by_domain(compile_domains(specs))["grid"]
    assert (domain["endpoints"], domain["non_get_endpoints"]) == (3, 2)
    assert domain["auth_mode"] == "basic_secret" and domain["auth_mode_conflict"]
    assert domain["silver_shape"] == "document" and not domain["silver_shape_conflict"]
    assert domain["schedule"] == "0 1 * * * ?" and domain["schedule_conflict"]
    parameters = by_domain(endpoint_parameters(specs))
    assert json.loads(parameters["grid"]["api_endpoints_json"]) == [
        {"path": "/export", "method": "POST", "body": {"a": [1, 2]}},
        {"path": "/raw", "method": "GET", "body": "42 apples"},
        {"path": "/a,b", "method": "GET"},
    ]
    # A comma in a path would break the list form.
    assert json.loads(parameters["plain"]["api_endpoints_json"]) == [{"path": "/a,b", "method": "GET"}]
    stats = compile_stats(control).first()
    assert (stats["skipped_disabled"], stats["enabled_endpoints"]) == (0, 4)


@pytest.mark.parametrize(
    "cell,kept", [("true", 1), ("T", 1), ("1", 1), ("YES", 1), ("y ", 1), ("no", 0), ("0", 0), ("", 0), ("on", 0)]
)
def test_enabled_spellings(spark, cell, kept):
    row = ("d", "n", "/p", "GET", "", "", cell)
    control = with_control_columns(spark.createDataFrame([row + (1,)], SEVEN.split(",") + ["row_no"]))
    assert compile_specs(control).count() == kept


def test_catalog_table_with_booleans_and_seven_columns(spark):
    rows = [("d", "b", "/b", None, None, None, True), ("d", "a", "/a", "GET", "x=1", "s", True), ("d", "c", "/c", "", "", "", False)]
    ddl = "domain string, endpoint_name string, path string, method string, params string, schedule string, enabled boolean"
    spark.createDataFrame(rows, ddl).createOrReplaceTempView("control_rows")
    specs = compile_specs(read_control_table(spark, "control_rows"))
    assert endpoint_parameters(specs).first()["api_endpoints"] == "/a?x=1,/b"


def test_missing_required_column_is_named(spark):
    with pytest.raises(ValueError, match="schedule"):
        with_control_columns(spark.createDataFrame([("d",)], "domain string"))


def test_duplicates_are_flagged(spark, tmp_path):
    control = csv_at(spark, tmp_path, SEVEN, DEMO + ["blog,again,/posts,GET,,,true"])
    assert [tuple(r) for r in duplicate_endpoints(compile_specs(control)).collect()] == [("blog", "/posts", 2)]


def test_list_and_json_parameters(spark):
    listed = request_specs(spark, endpoints=" /a, ,/b?x=1,")
    assert [(r["path"], r["method"]) for r in listed.collect()] == [("/a", "GET"), ("/b?x=1", "GET")]
    given = [
        {"path": "/grid", "method": "post", "body": {"nested": {"a": 1}, "rows": [[1], []]}, "headers": {"h": "1"}, "name": "g"},
        {"path": "/plain", "body": "text"},
    ]
    rows = specs_from_rows(spark, given).collect()
    assert json.loads(rows[0]["body"]) == given[0]["body"] and rows[0]["headers"] == {"h": "1"}
    assert json.loads(rows[1]["body"]) == "text" and rows[1]["method"] is None
    assert request_specs(spark, endpoints="/a", endpoints_json='[{"path":"/j"}]').first()["path"] == "/j"
