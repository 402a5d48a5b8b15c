import json

import pytest
from pyspark.sql import functions as F

from blockmill.config import SourceSpec
from blockmill.operators.mixing import source_stats
from blockmill.functions import ByteTokenizer
from blockmill.sources import scan_sources, scan_text, source_specs, spec_list, validate_specs

ENTRY = {"name": "a", "dataset": "x", "config": None, "text_col": "text", "weight": 1.0, "token_cap": None}


def with_changes(**changes):
    return json.dumps([{**ENTRY, **changes}])


def test_specs_are_typed(spark):
    text = json.dumps([ENTRY, {**ENTRY, "name": "b", "config": "c", "weight": 2, "token_cap": 9}])
    rows = source_specs(spark, text).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [
        (0, "a", "x", None, "text", 1.0, None), (1, "b", "x", "c", "text", 2.0, 9)]


@pytest.mark.parametrize("text, error", [
    ("[]", ValueError),
    (with_changes(token_cap=0), ValueError),
    (with_changes(token_cap=-1), ValueError),
    (with_changes(weight=-0.1), ValueError),
    (with_changes(weight=0), ValueError),
    (with_changes(extra=1), TypeError),
    (json.dumps([{k: v for k, v in ENTRY.items() if k != "config"}]), TypeError),
    (json.dumps([ENTRY, ENTRY]), ValueError),
])
def test_bad_specs_are_refused(text, error):
    with pytest.raises(error):
        spec_list(text)


def test_weights_need_not_sum_to_one():
    validate_specs([SourceSpec(n, "", None, "t", w) for n, w in (("a", 0.88), ("b", 0.11))])


def test_scan_formats(spark, tmp_path):
    rows = [(5, "one", 1), (6, None, 2), (7, "", 3)]
    df = spark.createDataFrame(rows, "id long, body string, n int")
    df.coalesce(1).write.parquet(f"{tmp_path}/t/part")
    df.coalesce(1).write.json(f"{tmp_path}/t.json")
    (tmp_path / "docs.txt").mkdir()
    (tmp_path / "docs.txt" / "a").write_text("line 1\nline 2\n")

    def scan(name, dataset, column, config=None, **kw):
        return scan_text(spark, SourceSpec(name, dataset, config, column, 1.0), str(tmp_path), **kw)

    want = [("p", 5, "one"), ("p", 6, None), ("p", 7, "")]
    assert [tuple(r) for r in scan("p", "t", "body", "part", doc_id="id").orderBy("doc_id").collect()] == want
    assert [r["text"] for r in scan("p", "t.json", "body", doc_id="id").orderBy("doc_id").collect()] == ["one", None, ""]
    assert [r["text"] for r in scan("p", "docs.txt", "any").collect()] == ["line 1\nline 2\n"]
    (tmp_path / "c.csv").write_text('id,body\n5,"one ""a""\nsecond line"\n6,\n')
    assert [r["text"] for r in scan("p", "c.csv", "body", doc_id="id").orderBy("doc_id").collect()] == [
        'one "a"\nsecond line', None]
    specs = [SourceSpec("j", "t.json", None, "body", 1.0), SourceSpec("q", "t", "part", "body", 1.0)]
    both = scan_sources(spark, specs, str(tmp_path), {"j": "id", "q": "id"}, {"j": "json"})
    assert both.count() == 6
    keys = [r["doc_id"] for r in scan("p", "t", "body", "part").collect()]
    assert len(set(keys)) == 3
    again = [r["doc_id"] for r in scan("p", "t", "body", "part").collect()]
    assert keys == again
    # Records without an id are told apart by their content.
    assert len({r["doc_id"] for r in scan("p", "t.json", "body").collect()}) == 3
    # A missing column and a column that is no text read as null.
    for column in ("nothing", "n"):
        assert {r["text"] for r in scan("p", "t", column, "part", doc_id="id").collect()} == {None}


def test_scan_reads_only_what_it_needs(spark, small):
    spec = SourceSpec("d", "documents.parquet", None, "text", 1.0)
    plan = scan_text(spark, spec, small, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_unweighted_sources_are_not_read(spark, small):
    specs = [SourceSpec("d", "documents.parquet", None, "text", 1.0),
             SourceSpec("gone", "no-such-file.parquet", None, "text", 0.0)]
    assert scan_sources(spark, specs, small, {"d": "doc_id"}).count() == 200


def test_stats_count_records_before_the_filter(spark):
    docs = spark.createDataFrame([("a", 1, "xy"), ("a", 2, ""), ("a", 3, None), ("b", 1, None)],
                                 "source string, doc_id long, text string")
    rows = {r["source"]: r for r in source_stats(ByteTokenizer().sizes(docs)).collect()}
    assert tuple(rows["a"])[1:] == (3, 1, 3, 3, 3.0)
    assert tuple(rows["b"])[1:] == (1, 0, 0, 0, None)


def test_ids_of_any_kind(spark, tmp_path):
    rows = [("<urn:uuid:1>", "one"), ("<urn:uuid:2>", "two"), (None, "three"), (None, "four")]
    df = spark.createDataFrame(rows, "id string, text string").coalesce(1)
    for dump in ("a", "b"):
        df.write.parquet(f"{tmp_path}/web/dump={dump}")
    df.write.json(f"{tmp_path}/web.json")
    spec = SourceSpec("web", "web", None, "text", 1.0)
    named = scan_text(spark, spec, str(tmp_path), "id").collect()
    # Equal ids stay equal; rows without one are told apart by their text.
    assert len(named) == 8 and len({r["doc_id"] for r in named}) == 4 and None not in {r["doc_id"] for r in named}
    json_rows = scan_text(spark, SourceSpec("j", "web.json", None, "text", 1.0), str(tmp_path), "id").collect()
    assert len({r["doc_id"] for r in json_rows}) == 4


def test_equal_file_names_in_two_folders(spark, tmp_path):
    df = spark.createDataFrame([("one",), ("two",)], "text string").coalesce(1)
    for dump in ("a", "b"):
        df.write.parquet(f"{tmp_path}/web/{dump}")
        for path in (tmp_path / "web" / dump).glob("part-*.parquet"):
            path.rename(path.parent / "train-00000.parquet")
        for path in (tmp_path / "web" / dump).glob(".*.crc"):
            path.unlink()
    raw = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/web")
    assert raw.count() == 4
    spec = SourceSpec("web", "web/*", None, "text", 1.0)
    ids = [r["doc_id"] for r in scan_text(spark, spec, str(tmp_path)).collect()]
    assert len(ids) == len(set(ids)) == 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_is_read_once_in_splits_and_by_field(spark, tmp_path):
    lines = [{"id": k, "body": f"text {k} " * 40, "other": {"deep": [k] * 20}} for k in range(3000)]
    (tmp_path / "big.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\n")
    sc = spark.sparkContext
    sc.setJobGroup("json", "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = scan_text(spark, SourceSpec("j", "big.jsonl", None, "body", 1.0), str(tmp_path), "id * 10")
        assert not sc.statusTracker().getJobIdsForGroup("json")
        assert df.rdd.getNumPartitions() > 5
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        sc.setJobGroup("", "")
    assert plan_of(df).count("FileScan") == 1 and "other" not in plan_of(df)
    assert {(r["source"], r["doc_id"], r["text"]) for r in rows} == {("j", 10 * x["id"], x["body"]) for x in lines}


def test_json_of_every_shape(spark, tmp_path):
    lines = [
        '{"id": 1, "body": "one"}', '{"id": "2", "body": 5}', '{"id": "007", "body": "seven"}', '{"id": 7, "body": "\\u00e9\\n\\"q\\""}',
        '{"id": null, "body": "no id"}', '{"body": ["a"]}', '{"id": 8, "body": null}', '{"id": 9}', "broken {", "", "  ",
        '{"id": 1.5, "body": ""}', '{"id": 10, "body": {"x": "y"}}', '{"id": 11, "body": true}',
    ]
    (tmp_path / "t.json").write_text("\n".join(lines))
    spec = SourceSpec("j", "t.json", None, "body", 1.0)
    rows = scan_text(spark, spec, str(tmp_path), "id").collect()
    assert len(rows) == 12
    by_text = {r["text"]: r["doc_id"] for r in rows if r["text"]}
    assert set(by_text) == {"one", "seven", 'é\n"q"', "no id"}
    assert by_text["one"] == 1 and by_text['é\n"q"'] == 7 and by_text["seven"] not in (7, None)
    assert sorted(r["doc_id"] for r in rows if r["text"] is None and r["doc_id"] in (2, 8, 9, 10, 11)) == [2, 8, 9, 10, 11]
    placed = scan_text(spark, spec, str(tmp_path)).collect()
    assert len({r["doc_id"] for r in placed}) == 12


def test_json_with_column_ids(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"id": 4, "body": "one"}\n{"id": 5, "body": "two"}')
    spec = SourceSpec("j", "t.json", None, "body", 1.0)
    rows = scan_text(spark, spec, str(tmp_path), F.col("id") + 1).collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == [(5, "one"), (6, "two")]
