"""The stored cell table that is updated where it stands, its followers, counters and ties."""

from __future__ import annotations

import hashlib
import json
import tempfile
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.operators import merge, records
from cellsmith.operators.backfill import backfill
from cellsmith.operators.cells import clean
from cellsmith.plans import specs
from cellsmith.plans.job import ModelCount, backfill_store, read_output, run_job, run_spec, update_store
from cellsmith.session import cut
from cellsmith.sources import views
from cellsmith.sources.pages import read_cells, read_history
from cellsmith.sources.sinks import write_cells
from cellsmith.sources.store import FOLDERS, KEY, _configured, create_store, open_store
from cellsmith.spec import TableSpec, parse_subfields
from conftest import detail_model, pages_df

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


def _new(spark, **options):
    return create_store(spark, tempfile.mkdtemp(prefix="cellsmith-store-") + "/s", **{"buckets": 4, **options})


def _event_cells(spark, name="events"):
    return clean(views.event_pages(spark, SF), list(specs.EVENTS[0].models)).cells.withColumn("output_table", F.lit(name))


def _files(root):
    return {str(p): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet")}


@pytest.fixture(autouse=True)
def _whole_plans(spark):
    with _configured(spark, **{"spark.sql.maxMetadataStringLength": "2000"}):
        yield


def _scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_update_has_one_exchange_and_prunes_folders(spark):
    store = _new(spark)
    cells = _event_cells(spark)
    store.upsert(cells)
    day = cells.where("download_time < 1704500000000")
    staged = merge.merge_cells(day, KEY).withColumn("period", store._period())
    folders = [tuple(r) for r in staged.where("family = 'amount'").select(*FOLDERS).distinct().collect()]
    with _configured(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        new = cut(staged.where("family = 'amount'"), "new")
        plan = store.merged(new, folders)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan  # the new cells
    stored = [s for s in _scans(plan) if store.table in s]
    assert len(stored) == 1 and "Bucketed: true" in stored[0]
    assert "amount" in stored[0].split("PartitionFilters:")[1]


def test_untouched_folders_keep_their_files(spark):
    store = _new(spark)
    m = detail_model({"v": {"name": "v", "type": "String"}})
    page = lambda i, v, t: (str(i), "m", json.dumps({"id": i, "v": v}), None, t)
    jan, feb = 1704500000000, 1707500000000
    spec = [TableSpec("s", "007", (m,)), TableSpec("t", "other", (m,))]
    update_store(store, {"s": pages_df(spark, [page(1, "a", jan), page(2, "b", feb)]),
                         "t": pages_df(spark, [page(1, "o", jan)])}, spec)
    before = _files(store.root + "/cells")
    update_store(store, {"s": pages_df(spark, [page(2, "c", feb), page(3, "d", feb)]),
                         "t": pages_df(spark, [])}, spec)
    after = _files(store.root + "/cells")
    kept = {k for k in before if "2024-01" in k or "output_table=other" in k}
    assert kept and all(after.get(k) == before[k] for k in kept)
    assert {k for k in before if "output_table=007" in k and ("2024-02" in k or "latest" in k)}.isdisjoint(after)
    got = {(r.row_key, r.qualifier): r.v_string for r in store.cells("007").where("family IN ('content', 'v')").collect()}
    assert got == {("1", "v"): "a", ("2", "v"): "c", ("3", "v"): "d", ("1", "2024-01-06"): "a",
                   ("2", "2024-02-09"): "c", ("3", "2024-02-09"): "d"}
    assert store.cells("other").count() == 3


def test_names_of_digits_alone_stay_texts(spark):
    m = detail_model({"v": {"name": "007", "type": "String"}})
    spec = [TableSpec("s", "007", (m,))]
    pages = {"s": pages_df(spark, [("1", "m", '{"id": "1", "v": "x"}')])}
    root = tempfile.mkdtemp(prefix="cellsmith-names-")
    run_job(spark, pages, spec, f"{root}/v1")
    run_job(spark, pages, spec, f"{root}/v2", f"{root}/v1")
    out = read_output(spark, f"{root}/v2", "007")
    assert out.count() == 3 and dict(out.dtypes)["family"] == "string"
    assert out.where("family = '007'").count() == 1
    write_cells(clean(pages["s"], [m]).cells.where("family = '007'"), f"{root}/cells")
    assert [r.family for r in read_cells(spark, f"{root}/cells").collect()] == ["007"]
    store = _new(spark)
    update_store(store, pages, spec)
    update_store(store, pages, spec)
    assert _rows(merge.cell_values(store.cells("007"))) == _rows(merge.cell_values(out))


def test_reopened_store_goes_on_and_can_be_rebuilt(spark):
    store = _new(spark, period=4)
    cells = _event_cells(spark)
    store.upsert(cells.where("download_time >= 1704500000000"))
    with pytest.raises(AnalysisException):  # a store is created once
        create_store(spark, store.root)
    spark.sql(f"DROP TABLE {store.table}")  # another session does not know the table
    store = open_store(spark, store.root)
    assert (store.buckets, store.period) == (4, 4) and store.last_batch() == 1
    store.upsert(cells.where("download_time < 1704500000000"))
    want = _rows(merge.cell_values(store.cells("events")))
    assert len(want) == merge.merge_cells(cells).count()
    store.rebuild()
    assert _rows(merge.cell_values(store.cells("events"))) == want


def test_empty_update_changes_nothing(spark):
    store = _new(spark)
    cells = _event_cells(spark)
    store.upsert(cells.where("false"))
    assert store.cells().count() == 0 and store.last_batch() == 0


def test_second_backfill_reads_later_updates_alone(spark):
    store = _new(spark)
    texts = views.token_history_cells(spark, SF).withColumn("output_table", F.lit("p"))
    subfields = parse_subfields(fixed.BACKFILL_SUBFIELDS)
    store.upsert(texts.where("qualifier < '2024-02'"))
    backfill_store(store, "p", fixed.SUBFIELD_ARRAY_KEY, subfields)
    assert store.mark("backfill p specfoods") == 1
    store.upsert(texts.where("qualifier >= '2024-02'"))
    new = store.changes(store.mark("backfill p specfoods")).where("family = 'specfoods' AND output_table = 'p'")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "batch" in plan.split("PartitionFilters:")[1].split("]")[0]
    # batch 2 holds what the first backfill wrote; 3 the new texts
    assert {r.b for r in new.select(F.regexp_extract(F.input_file_name(), "batch=(\\d+)", 1).alias("b")).distinct().collect()} == {"3"}
    assert new.count() == texts.where("qualifier >= '2024-02'").count()
    backfill_store(store, "p", fixed.SUBFIELD_ARRAY_KEY, subfields)
    whole = backfill(read_history(texts, fixed.SUBFIELD_ARRAY_KEY), subfields).cells
    assert _rows(merge.cell_values(store.cells("p").where("family <> 'specfoods'"))) \
        == _rows(merge.cell_values(merge.merge_cells(whole)))
    # nothing new: nothing is written
    last = store.last_batch()
    backfill_store(store, "p", fixed.SUBFIELD_ARRAY_KEY, subfields)
    assert store.cells("p").where("family <> 'specfoods'").count() == merge.merge_cells(whole).count()
    assert store.last_batch() == last


def test_lookup_of_many_rows(spark):
    store = _new(spark)
    cells = _event_cells(spark)
    store.upsert(cells)
    keys = spark.range(0, 2000).selectExpr("concat(id, 'click') AS row_key").unionByName(
        spark.createDataFrame([("0click",), (None,)], "row_key string"))
    hit = store.lookup("events", keys, "amount")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    scan = [s for s in _scans(plan) if store.table in s][0]
    assert "amount" in scan.split("PartitionFilters:")[1] and "BroadcastHashJoin" in plan
    want = merge.merge_cells(cells.where("family = 'amount' AND row_key LIKE '%click'"))
    assert hit.count() == want.count() > 0


def test_row_groups_without_a_row_are_left_out(spark):
    """A key between a file's least and greatest row keys: its bloom filter leaves the row group out."""
    store = _new(spark, buckets=1)
    rows = spark.range(0, 4000, 2).selectExpr("lpad(id, 6, '0') AS row_key", "'c' AS family", "'2024-01-01' AS qualifier",
                                              "'string' AS vtype", "'x' AS v_string", "id AS download_time", "'s' AS source_key")
    rows = rows.selectExpr("*", "CAST(NULL AS INT) AS v_int", "CAST(NULL AS BIGINT) AS v_long", "CAST(NULL AS FLOAT) AS v_float",
                           "CAST(NULL AS DOUBLE) AS v_double", "CAST(NULL AS BOOLEAN) AS v_bool", "0 AS item_pos",
                           "0 AS put_seq", "0 AS source_no", "'t' AS output_table")
    store.upsert(rows)

    def rows_read(key):
        df = store.cells("t").where(F.col("row_key") == key)
        n = df.count()
        it = df._jdf.queryExecution()
        it.toRdd().count()
        found = []

        def walk(p):
            if p.nodeName().startswith("Scan"):
                found.append(p.metrics().apply("numOutputRows").value())
            for i in range(p.children().size()):
                walk(p.children().apply(i))
        walk(it.executedPlan())
        return n, found

    assert rows_read("000100")[0] == 1 and rows_read("000100")[1][0] > 0
    assert rows_read("000101") == (0, [0])


def test_two_sources_alike_in_all_the_later_of_the_spec_wins(spark):
    m = detail_model({"v": {"name": "v", "type": "String"}})
    page = lambda v: pages_df(spark, [("k", "m", json.dumps({"id": 1, "v": v}))])
    pages = {"s1": page("from1"), "s2": page("from2")}
    spec = [TableSpec("s1", "o", (m,)), TableSpec("s2", "o", (m,))]
    for order, want in ((spec, "from2"), (spec[::-1], "from1")):
        for shuffled in (False, True):
            cells = run_spec(pages, order)["o"].cells
            cells = cells.repartition(7, "source_no") if shuffled else cells
            assert {r.v_string for r in merge.latest(cells).collect()} == {want}
    pages = {"event_pages": views.event_pages(spark, SF), "second_event_pages": views.second_event_pages(spark, SF)}
    one, two = (run_spec(pages, s)["events_clean"].cells for s in (specs.TWO_SITES, specs.TWO_SITES_TURNED))
    a, b = (_rows(merge.cell_values(merge.latest(c))) for c in (one, two))
    assert a != b and len(a) == len(b)


def test_counts_are_those_of_the_results(spark):
    pages = {"event_pages": views.event_pages(spark, SF), "dirty_pages": views.dirty_pages(spark, SF)}
    spec = [*specs.EVENTS, *specs.DIRTY]
    store = _new(spark)
    counts = update_store(store, pages, spec)
    lazy = run_spec(pages, spec)
    by_model = {r.page_model: r["count"] for r in pages["event_pages"].groupBy("page_model").count().collect()}
    for c in counts:
        if c.source == "event_pages":
            n = by_model.get(c.model, 0)
            assert c == ModelCount("event_pages", c.model, "events_clean", n, n, 9 * n, 0)
    dirty = counts[-1]
    assert (dirty.model, dirty.pages) == ("dirty", pages["dirty_pages"].count())
    assert dirty.cells == lazy["dirty_clean"].cells.count()
    assert dirty.rejects == lazy["dirty_clean"].rejects.count() \
        == spark.read.parquet(f"{store.root}/rejects").where("output_table = 'dirty_clean'").count()
    # too many rejects: nothing is written
    other = _new(spark)
    with pytest.raises(ValueError, match="dirty"):
        update_store(other, pages, spec, max_reject_share=0.001)
    assert other.cells().count() == 0 and other.last_batch() == 0
    update_store(other, pages, spec, max_reject_share=0.999)
    assert other.last_batch() == 1


def test_stable_sort_keeps_input_order_and_splits_ties(spark):
    root = tempfile.mkdtemp(prefix="cellsmith-sort-")
    spark.range(0, 200_000, 1, 4).selectExpr("id", "element_at(array('a', 'b', 'c'), CAST(id * 7919 % 3 AS INT) + 1) AS v") \
        .write.parquet(f"{root}/t")
    scan = spark.read.parquet(f"{root}/t")
    ids = [r.id for r in records.stable_sort(scan, "v", "desc").collect()]
    assert ids == sorted(range(200_000), key=lambda i: (-(i * 7919 % 3), i))
    placed = records.with_input_position(scan)
    order = records.stable_order("v")
    sizes = [r["count"] for r in placed.repartitionByRange(12, *order).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 2 * 200_000 / 12


@pytest.mark.parametrize("text,want", [
    ("2018年13月05日 12:00:00", "2019-01-05 12:00:00"), ("2018-02-30 25:61:61", "2018-03-03 02:02:01"),
    ("2018-01-00 00:00:00", "2017-12-31 00:00:00"), ("2018-00-10 00:00:00", "2017-12-10 00:00:00"),
    ("2019-02-29 00:00:00", "2019-03-01 00:00:00"), ("2020-02-29 23:59:60", "2020-03-01 00:00:00"),
    ("9999-12-31 23:59:60", None), ("0-01-01 00:00:00", None), ("1234567-01-01 00:00:00", None), ("x", None), (None, None),
    ("2018/06/05T12:00:00Z", "2018-06-05 12:00:00")])
def test_lenient_dates_roll_over(spark, text, want):
    from cellsmith.functions.text import normalize_timestamp
    df = spark.createDataFrame([(text,)], "t string")
    assert df.selectExpr(f"{normalize_timestamp('t', lenient=True)} AS r").first().r == want


def test_typed_wide_rows_keep_text_that_did_not_parse(spark):
    m = detail_model({"n": {"name": "n", "type": "int"}, "b": {"name": "b", "type": "boolean"}, "s": {"name": "s", "type": "String"}})
    rows = [("1", "m", '{"id": 1, "n": "12", "b": "true", "s": "7"}', None, 5), ("2", "m", '{"id": 1, "n": "many"}', None, 9),
            ("3", "m", '{"id": 2, "n": "x"}', None, 5), ("4", "m", '{"id": 2, "n": 4}', None, 9)]
    wide = merge.latest_wide_typed(clean(pages_df(spark, rows), [m]).cells, merge.wide_types([m]))
    assert wide.dtypes == [("row_key", "string"), ("n", "int"), ("n_text", "string"), ("b", "boolean"), ("b_text", "string"),
                           ("s", "string")]
    assert sorted(map(tuple, wide.collect())) == [("1", None, "many", True, None, "7"), ("2", 4, None, None, None, None)]
