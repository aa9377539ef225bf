"""Merge, upsert, sinks, streaming and invariants."""

from __future__ import annotations

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.operators import merge
from cellsmith.operators.cells import clean
from cellsmith.plans import specs
from cellsmith.plans.job import backfill_job, read_output, run_job, run_spec
from cellsmith.sources import views
from cellsmith.spec import TableSpec
from cellsmith.sources.sinks import upsert_snapshot, write_cells
from cellsmith.streaming.clean_stream import read_latest, read_page_stream, start_clean_stream
from conftest import detail_model, list_model, pages_df

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_last_write_wins_order(spark):
    m = detail_model({"v": {"name": "v", "type": "String"}})
    rows = [("a", "m", json.dumps({"id": 1, "v": "old"}), None, 10),
            ("b", "m", json.dumps({"id": 1, "v": "new"}), None, 20),
            ("a2", "m", json.dumps({"id": 1, "v": "tie-a2"}), None, 5),
            ("z", "m", json.dumps({"id": 1, "v": "tie-z"}), None, 5)]
    latest = merge.latest(clean(pages_df(spark, rows), [m]).cells).collect()
    assert [(r.qualifier, r.v_string) for r in latest] == [("v", "new")]
    hist = merge.history(clean(pages_df(spark, rows[2:]), [m]).cells).collect()
    assert {r.family: r.v_string for r in hist}["v"] == "tie-z"


def test_upsert_idempotent_and_repartition_invariant(spark):
    cells = clean(views.event_pages(spark, SF), list(specs.EVENTS[0].models)).cells
    once = merge.upsert_cells(merge.merge_cells(cells), cells)
    twice = merge.upsert_cells(once, cells)
    assert _rows(merge.cell_values(once)) == _rows(merge.cell_values(twice))
    spread = clean(views.event_pages(spark, SF).repartition(5), list(specs.EVENTS[0].models)).cells
    assert _rows(merge.cell_values(merge.merge_cells(spread))) == _rows(merge.cell_values(once))


def test_every_item_is_a_cell_source_or_a_reject(spark):
    from cellsmith.operators.cells import CELL_COLUMNS, REJECT_COLUMNS
    res = clean(views.dirty_pages(spark, SF), list(specs.DIRTY[0].models))
    assert res.cells.columns == CELL_COLUMNS and res.rejects.columns == REJECT_COLUMNS
    n_pages = views.dirty_pages(spark, SF).count()
    accepted = res.cells.select("source_key").distinct().count()
    assert accepted + res.rejects.count() == n_pages


def test_list_cells_cover_latest(spark):
    res = clean(views.line_pages(spark, SF), list(specs.LINES[0].models))
    assert res.cells.count() >= merge.latest(res.cells).count()


def test_snapshot_upsert_to_new_path(spark):
    cells = clean(views.event_pages(spark, SF), list(specs.EVENTS[0].models)).cells
    root = tempfile.mkdtemp(prefix="cellsmith-test-")
    first = cells.where(F.col("download_time") < 1704500000000)
    rest = cells.where(F.col("download_time") >= 1704500000000)
    write_cells(merge.merge_cells(first), f"{root}/v1")
    v2 = upsert_snapshot(spark, f"{root}/v1", rest, f"{root}/v2")
    assert _rows(merge.cell_values(v2)) == _rows(merge.cell_values(merge.merge_cells(cells)))
    hist = merge.lookup_history(v2, "0click", "amount")
    assert hist.count() == merge.lookup_history(cells, "0click", "amount").count()


def test_streaming_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="cellsmith-stream-")
    pages = views.event_pages(spark, SF)
    pages.where("download_time < 1704500000000").write.parquet(f"{root}/in/part1")
    pages.where("download_time >= 1704500000000").write.parquet(f"{root}/in/part2")
    stream = read_page_stream(spark, f"{root}/in/*", max_files_per_trigger=1)
    q = start_clean_stream(stream, list(specs.EVENTS[0].models), f"{root}/cells",
                           f"{root}/rejects", f"{root}/ckpt", available_now=True)
    q.awaitTermination(300)
    got = merge.cell_values(read_latest(spark, f"{root}/cells"))
    want = merge.cell_values(merge.latest(clean(pages, list(specs.EVENTS[0].models)).cells))
    assert _rows(got) == _rows(want)


def test_job_one_source_two_outputs(spark):
    both = views.directory_pages(spark, SF).unionByName(views.customer_pages(spark, SF))
    spec = [TableSpec("site", "directory", specs.CUSTOMERS[1].models),
            TableSpec("site", "customers", specs.CUSTOMERS[0].models)]
    root = tempfile.mkdtemp(prefix="cellsmith-spec-")
    run_job(spark, {"site": both}, spec, f"{root}/v1", period=4)
    lazy = run_spec({"site": both}, spec)
    for out in ("directory", "customers"):
        got = merge.cell_values(read_output(spark, f"{root}/v1", out))
        want = merge.cell_values(merge.merge_cells(lazy[out].cells))
        assert _rows(got) == _rows(want) and got.count() > 0


def test_job_keeps_names_apart_and_earlier_cells(spark):
    m = detail_model({"v": {"name": "v", "type": "String"}})
    page = lambda i, v, t: (str(i), "m", json.dumps({"id": i, "v": v}), None, t)
    names = ["店铺", "菜单", "a:b", "a_b", "1", "007"]
    spec = [TableSpec(f"s{n}", n, (m,)) for n in names]
    root = tempfile.mkdtemp(prefix="cellsmith-spec-")
    first = {f"s{n}": pages_df(spark, [page(1, n, 50), page(2, n, 50)]) for n in names}
    run_job(spark, first, spec, f"{root}/v1")
    # the next run writes an earlier time: it wins all the same, and row 2 stays
    run_job(spark, {f"s{n}": pages_df(spark, [page(1, "new " + n, 9)]) for n in names}, spec, f"{root}/v2", f"{root}/v1")
    for n in names:
        got = {r.row_key: r.v_string for r in read_output(spark, f"{root}/v2", n).where("family = 'content'").collect()}
        assert got == {"1": "new " + n, "2": n}
    with pytest.raises(ValueError):
        run_job(spark, first, spec, f"{root}/v2", f"{root}/v2")


def test_reclean_overwrites_whatever_the_values(spark):
    rows = [("p", "m", json.dumps({"id": 1, "v": "5"}))]
    old, new = (clean(pages_df(spark, rows), [detail_model({"v": {"name": "v", "type": t}})]).cells
                for t in ("String", "int"))
    out = merge.upsert_cells(merge.merge_cells(old), new).where("family = 'content'").collect()
    assert [(r.vtype, r.v_int, r.v_string) for r in out] == [("int", 5, None)]


def test_backfill_overwrites_the_table_it_read(spark):
    from cellsmith.spec import parse_subfields
    text = [("r", "specfoods", "2018-06-05", "string", "stock:9  price:x", None), ("r", "stock", "2018-06-05", "int", None, 5),
            ("q", "specfoods", "2018-06-05", "string", "stock:9", None), ("q", "stock", "2018-06-05", "int", None, 5)]
    cells = spark.createDataFrame(
        [(*t, 10, "s", 0, 0, "o") for t in text],
        "row_key string, family string, qualifier string, vtype string, v_string string, v_int int, "
        "download_time bigint, source_key string, item_pos int, put_seq int, output_table string").withColumn("source_no", F.lit(0))
    cells = cells.selectExpr("*", "CAST(NULL AS BIGINT) AS v_long", "CAST(NULL AS FLOAT) AS v_float",
                             "CAST(NULL AS DOUBLE) AS v_double", "CAST(NULL AS BOOLEAN) AS v_bool")
    root = tempfile.mkdtemp(prefix="cellsmith-fill-")
    write_cells(cells, f"{root}/v1/cells", by=["output_table"])
    backfill_job(spark, f"{root}/v1", "o", "specfoods", parse_subfields(fixed.BACKFILL_SUBFIELDS), f"{root}/v2")
    got = {(r.row_key, r.family): r.v_int for r in read_output(spark, f"{root}/v2", "o").collect()}
    assert got == {("q", "stock"): 9, ("r", "stock"): 5, ("q", "specfoods"): None, ("r", "specfoods"): None}
    assert spark.read.parquet(f"{root}/v2/rejects").count() == 1


def test_models_of_one_source_do_not_disturb_each_other(spark):
    rows = [("1", "a", '{"foods": [{"ID": "x", "id": "y"}], "shops": "n/a"}'),
            ("2", "b", '{"shops": [{"ID": "z", "id": "w"}], "foods": 5}')]
    spec = [TableSpec("s", "one", (list_model({"id": {"name": "v", "type": "String"}}, "a", "foods", rowkey=("ID",)),
                                   list_model({"id": {"name": "v", "type": "String"}}, "b", "shops", rowkey=("ID",)))),
            TableSpec("s", "two", (list_model({"ID": {"name": "u", "type": "String"}}, "a", "foods", rowkey=("id",)),))]
    out = run_spec({"s": pages_df(spark, rows)}, spec)
    cells = {o: sorted((c.row_key, c.qualifier, c.v_string) for c in r.cells.collect()) for o, r in out.items()}
    assert cells == {"one": [("x", "v", "y"), ("z", "v", "w")], "two": [("y", "u", "x")]}
    assert all(r.rejects.count() == 0 for r in out.values())
