import json

import pytest
from conftest import rows

from streammart.functions.jsons import split_dirty
from streammart.operators import changes as ch
from streammart.schemas import RULES
from streammart.sources.dim_table import REMOVED, SET_COLUMNS, DimTable, dim_schema, dims_of_rules
from streammart.sources.topics import Topics
from streammart.streaming.jobs import rules_from_feed
from streammart.sources.tables import read_rules

ENVELOPES = [
    '{"database":"d","table":"base_trademark","type":"bootstrap-insert",'
    '"data":{"id":19,"tm_name":"acme","logo_url":"x"}}',
    '{"database":"d","table":"order_info","type":"insert",'
    '"data":{"id":1,"total_amount":30.50,"junk":1}}',
    '{"database":"d","table":"order_info","type":"delete","data":{"id":1}}',
    '{"database":"d","table":"unknown","type":"insert","data":{"id":1}}',
    '{"database":"d","table":"order_info","type":"insert","data":null}',
    '{"database":"d","table":"order_info","type":"insert"}',
]
RULE_ROWS = [
    ("base_trademark", "insert", "hbase", "dim_base_trademark", "id,tm_name", "id", None),
    ("base_trademark", "update", "hbase", "dim_base_trademark", "id,tm_name", None, None),
    ("order_info", "insert", "kafka", "dwd_order_info", "id,total_amount", "id", None),
]


@pytest.fixture()
def rules(spark):
    return spark.createDataFrame(RULE_ROWS, RULES)


def routed(spark, rules, **options):
    raw = spark.createDataFrame([(v, i) for i, v in enumerate(ENVELOPES)], "value STRING, n INT")
    good, _ = split_dirty(ch.parse_changes(raw))
    return ch.route_changes(ch.normalise_type(ch.with_data(good)), rules, **options)


def test_routes(spark, rules):
    to_topics, to_dims, rest = ch.split_routes(routed(spark, rules))
    assert rows(to_dims, "type", "sink_table", "data") == [
        ("insert", "dim_base_trademark", '{"id":19,"tm_name":"acme"}')
    ]
    (sent,) = rows(to_topics, "sink_table", "data")
    assert sent[0] == "dwd_order_info"
    assert json.loads(sent[1]) == {"id": 1, "total_amount": 30.5}
    assert rows(rest, "n") == [(2,), (3,)]


def test_pruning_can_be_turned_off(spark, rules):
    to_topics, _, _ = ch.split_routes(routed(spark, rules, prune=False))
    assert json.loads(rows(to_topics, "data")[0][0]) == {"id": 1, "total_amount": 30.5, "junk": 1}


def test_large_rule_tables_are_joined_by_shuffle(spark, rules):
    small = rows(routed(spark, rules), "n", "sink_table", "data")
    assert rows(routed(spark, rules, small_rules=False), "n", "sink_table", "data") == small


def test_rule_feed(spark):
    def state(table, sink):
        return {"source_table": table, "operate_type": "insert", "sink_type": "kafka",
                "sink_table": sink, "sink_columns": "id"}

    feed = [
        {"op": "r", "after": state("a", "one")},
        {"op": "c", "after": state("b", "two")},
        {"op": "u", "before": state("a", "one"), "after": state("a", "three")},
        {"op": "d", "before": state("b", "two"), "after": None},
        {"op": "c", "after": state("c", "four")},
    ]
    df = spark.createDataFrame(
        [("s.conf.rules", json.dumps(r), i) for i, r in enumerate(feed)],
        "topic STRING, value STRING, n INT",
    )
    flat = ch.flatten_feed(df)
    assert rows(flat, "database", "table", "type")[0] == ("conf", "rules", "create")
    assert {r["type"] for r in flat.collect()} == {"read", "create", "update", "delete"}
    last = ch.latest_rules(flat, ["n"])
    assert rows(last, "source_table", "sink_table") == [("a", "three"), ("c", "four")]


def test_rules_without_optional_columns(spark, rules):
    read = read_rules(spark, rules.drop("sink_extend"))
    assert read.columns == RULES.fieldNames() and read.count() == 3


def test_dim_table(spark, tmp_path, rules):
    tables = dims_of_rules(rules, str(tmp_path))
    assert list(tables) == ["dim_base_trademark"]
    dim = tables["dim_base_trademark"]
    assert dim.key == "id" and dim.read(spark).count() == 0
    dim.create(spark)
    dim.create(spark)

    def change(batch, *data):
        df = spark.createDataFrame(list(data), "id STRING, tm_name STRING, n INT")
        dim.upsert(df, ["n"], batch)

    change(0, ("1", "old", 1), ("1", "new", 2), ("2", "two", 3))
    before = dim.read(spark)
    assert rows(before) == [("1", "new"), ("2", "two")]
    change(1, ("2", None, 4), ("3", "three", 5), (None, "lost", 6))
    assert rows(dim.read(spark)) == [("1", "new"), ("2", None), ("3", "three")]
    change(1, ("9", "repeated batch", 7))
    assert rows(dim.read(spark), "id") == [("1",), ("2",), ("3",)]
    assert rows(before) == [("1", "new"), ("2", "two")], "a reader keeps its version"


def test_dim_table_keeps_columns_a_change_does_not_set(spark, tmp_path):
    dim = DimTable(str(tmp_path / "d"), dim_schema("id,name,gender"))
    schema = f"id STRING, name STRING, gender STRING, n INT, {SET_COLUMNS} ARRAY<STRING>"

    def change(batch, *data):
        dim.upsert(spark.createDataFrame(list(data), schema), ["n"], batch)

    change(0, ("1", "ann", "f", 1, ["id", "name", "gender"]))
    change(1, ("1", None, "x", 2, ["id", "gender"]), ("2", "bob", None, 3, ["id", "name"]))
    assert rows(dim.read(spark)) == [("1", "ann", "x"), ("2", "bob", None)]
    change(2, ("1", None, None, 4, ["id", "name"]), ("1", None, "y", 5, ["id", "gender"]))
    assert rows(dim.read(spark)) == [("1", None, "y"), ("2", "bob", None)]
    version = dim.version(spark)
    change(3)
    assert dim.version(spark) == version, "a batch without changes writes nothing"


def stored_files(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.parquet"))


def dim_changes(spark, *data):
    schema = f"id STRING, name STRING, gender STRING, n INT, {SET_COLUMNS} ARRAY<STRING>, {REMOVED} BOOLEAN"
    return spark.createDataFrame(list(data), schema)


BOTH = ["id", "name", "gender"]


def test_an_update_writes_to_the_buckets_it_touches(spark, tmp_path):
    dim = DimTable(str(tmp_path / "d"), dim_schema("id,name,gender"), buckets=8, max_changes=2)
    many = dim_changes(spark, *[(str(k), f"n{k}", "f", k, BOTH, None) for k in range(200)])
    dim.upsert(many, ["n"], 0)
    first = stored_files(tmp_path)
    assert len(first) == 8, "one file for each bucket"
    dim.upsert(dim_changes(spark, ("7", "seven", None, 1, ["name"], None)), ["n"], 1)
    second = stored_files(tmp_path)
    assert set(first) <= set(second) and len(second) == 9, "one key, one more file"
    dim.upsert(dim_changes(spark, ("7", "7b", None, 1, ["name"], None)), ["n"], 2)
    third = stored_files(tmp_path)
    assert len(third) == 11, "one more file, and the bucket compacted into one"
    expected = sorted((str(k), f"n{k}" if k != 7 else "7b", "f") for k in range(200))
    assert rows(dim.read(spark)) == expected
    dim.compact(spark)
    assert rows(dim.read(spark)) == expected
    assert rows(dim.lookup(spark, "7")) == [("7", "7b", "f")] and dim.lookup(spark, "none").count() == 0
    paths = dim.lookup(spark, "7").inputFiles()
    assert len(paths) == 1


def test_a_batch_number_counts_for_its_writer_only(spark, tmp_path):
    dim = DimTable(str(tmp_path / "d"), dim_schema("id,name,gender"))
    put = lambda batch, writer, *data: dim.upsert(dim_changes(spark, *data), ["n"], batch, writer)
    put(5, "job/one", ("1", "old", "f", 1, BOTH, None))
    put(5, "job/one", ("1", "repeated", "f", 1, BOTH, None), ("9", "x", "x", 1, BOTH, None))
    put(0, "job/two", ("1", "new", "f", 1, BOTH, None), ("2", "key", None, 1, BOTH, None))
    assert rows(dim.read(spark)) == [("1", "new", "f"), ("2", "key", None)]
    put(0, "job/two", ("1", "repeated", "f", 1, BOTH, None))
    put(6, "job/one", ("2", "later", None, 1, ["name"], None))
    assert rows(dim.read(spark)) == [("1", "new", "f"), ("2", "later", None)]


def test_removed_rows(spark, tmp_path):
    dim = DimTable(str(tmp_path / "d"), dim_schema("id,name,gender"), buckets=2, max_changes=3)
    put = lambda batch, *data: dim.upsert(dim_changes(spark, *data), ["n"], batch)
    put(0, ("1", "a", "f", 1, BOTH, None), ("2", "b", "m", 1, BOTH, False), ("3", "c", "m", 1, BOTH, None))
    put(1, ("1", None, None, 2, None, True), ("2", None, None, 2, None, True), ("2", "back", "zz", 3, ["name"], None))
    put(2, ("3", "set and removed", "f", 4, BOTH, None), ("3", None, None, 5, None, True))
    assert rows(dim.read(spark)) == [("2", "back", None)], "what was set before the removal is gone"
    put(3, ("1", None, "again", 6, ["gender"], None))
    assert rows(dim.read(spark)) == [("1", None, "again"), ("2", "back", None)]
    dim.compact(spark)
    assert rows(dim.read(spark)) == [("1", None, "again"), ("2", "back", None)]


def test_versions_are_kept_and_then_go(spark, tmp_path):
    dim = DimTable(str(tmp_path / "d"), dim_schema("id,name,gender"), buckets=2, max_changes=3, keep=4)
    counts = []
    for batch in range(20):
        dim.upsert(dim_changes(spark, (str(batch % 5), f"b{batch}", None, 1, BOTH, None)), ["n"], batch)
        counts.append(len(stored_files(tmp_path)))
    # Of each bucket: changes and whole rows of the newest version, and of the one before its compaction.
    assert max(counts) <= 2 * 2 * (3 + 2), "the number of files does not grow with the batches"
    newest = dim.version(spark)
    assert dim.read(spark, newest - 3).count() == 5
    with pytest.raises(ValueError, match="not kept"):
        dim.read(spark, 0)
    assert rows(dim.read(spark), "id", "name") == [(str(k), f"b{15 + k}") for k in range(5)]


def test_an_interrupted_update_leaves_no_trace(spark, tmp_path, monkeypatch):
    dim = DimTable(str(tmp_path / "d"), dim_schema("id,name,gender"))
    dim.upsert(dim_changes(spark, ("1", "a", "f", 1, BOTH, None)), ["n"], 0)
    with monkeypatch.context() as patch:
        patch.setattr(DimTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            dim.upsert(dim_changes(spark, ("1", "half", "f", 1, BOTH, None)), ["n"], 1)
    assert rows(dim.read(spark)) == [("1", "a", "f")]
    dim.upsert(dim_changes(spark, ("1", "whole", "f", 1, BOTH, None)), ["n"], 1)
    assert rows(dim.read(spark)) == [("1", "whole", "f")]


def test_dim_table_has_the_columns_of_all_its_rules(spark, tmp_path):
    rules = spark.createDataFrame(
        [("t", "insert", "hbase", "dim_t", "id,name,birthday", "id", None),
         ("t", "update", "hbase", "dim_t", "id,gender", "id", None)], RULES)
    dim = dims_of_rules(rules, str(tmp_path))["dim_t"]
    assert sorted(dim.schema.fieldNames()) == ["birthday", "gender", "id", "name"]


def test_rules_follow_the_number_of_the_batch(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"))
    for batch in range(12):
        rule = {"source_table": "a", "operate_type": "insert", "sink_table": f"from_{batch}"}
        value = json.dumps({"op": "u", "before": {}, "after": rule})
        feed = spark.createDataFrame([("x.y.table_process", value)], "topic STRING, value STRING")
        topics.put(feed, "cdc", batch)
    rules = rules_from_feed(topics, "x.y.table_process")(spark)
    assert rows(rules, "sink_table") == [("from_11",)]


def test_rules_follow_the_time_of_the_change(spark, tmp_path):
    topics = Topics(root=str(tmp_path / "t"))
    for batch, time in enumerate((20, 10)):
        rule = {"source_table": "a", "operate_type": "insert", "sink_table": f"at_{time}"}
        value = json.dumps({"op": "u", "before": {}, "after": rule, "ts_ms": time})
        feed = spark.createDataFrame([("x.y.table_process", value)], "topic STRING, value STRING")
        topics.put(feed, "cdc", batch)
    assert rows(rules_from_feed(topics, "x.y.table_process")(spark), "sink_table") == [("at_20",)]


def test_rule_columns_must_hold_the_key():
    assert dim_schema("id,name").fieldNames() == ["id", "name"]
    with pytest.raises(ValueError):
        DimTable("x", dim_schema("a,b", "c")).key
