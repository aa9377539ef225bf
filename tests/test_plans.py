"""Plan shape: model filter and column pruning reach the scan; one exchange."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from cellsmith.operators import merge
from cellsmith.operators.cells import clean
from cellsmith.plans import specs
from cellsmith.sources import views
from cellsmith.plans.job import run_spec
from cellsmith.sources.pages import read_cells, read_history, read_pages
from cellsmith.sources.sinks import write_cells


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_pruning_and_single_exchange(spark):
    root = tempfile.mkdtemp(prefix="cellsmith-plan-")
    views.event_pages(spark, "/root/testdata/sf0.001").write.parquet(f"{root}/pages")
    pages = read_pages(spark, f"{root}/pages")
    models = [m for m in specs.EVENTS[0].models if m.name in ("click", "view")]
    latest = merge.latest(clean(pages, models).cells)
    plan = _plan(latest)
    assert "PushedFilters: [In(page_model, [click,view])]" in plan
    # request_url is never read; detail pages do not read propertys either
    assert "ReadSchema: struct<source_key:string,page_model:string,data:string," \
           "download_time:bigint>" in plan
    assert plan.count("Exchange") == 1           # the merge only
    assert "partial_max_by" in plan                  # map-side combine before it
    assert latest.count() > 0


def test_history_read_prunes_to_one_family_folder(spark):
    root = tempfile.mkdtemp(prefix="cellsmith-plan-")
    write_cells(views.token_history_cells(spark, "/root/testdata/sf0.001"), f"{root}/cells")
    hist = read_history(read_cells(spark, f"{root}/cells"), "specfoods")
    plan = _plan(hist)
    assert "PartitionFilters: [isnotnull(family" in plan and "(family" in plan
    assert "specfoods" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert hist.count() == 2 * spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()


def test_lookup_reads_one_family_and_skips_files(spark):
    root = tempfile.mkdtemp(prefix="cellsmith-plan-")
    cells = clean(views.event_pages(spark, "/root/testdata/sf0.001"), list(specs.EVENTS[0].models)).cells
    write_cells(merge.merge_cells(cells), f"{root}/cells")
    hit = merge.lookup_history(read_cells(spark, f"{root}/cells"), "0click", "amount")
    plan = _plan(hit)
    assert "amount" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "EqualTo(row_key,0click)" in plan and "from_json" not in plan
    assert hit.count() == merge.lookup_history(cells, "0click", "amount").count()
    # files of a folder hold ranges of row keys that do not overlap
    write_cells(merge.merge_cells(cells), f"{root}/small", files=6)
    files = spark.read.parquet(f"{root}/small").where("family = 'amount'").groupBy(
        "period", F.input_file_name()).agg(F.min("row_key").alias("lo"), F.max("row_key").alias("hi")).collect()
    periods = {r.period for r in files}
    assert len(files) > len(periods)
    for p in periods:
        ranges = sorted((r.lo, r.hi) for r in files if r.period == p)
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_reject_plan_does_not_grow_with_columns(spark):
    from conftest import detail_model, pages_df
    pages = pages_df(spark, [("1", "m", '{"id": 1}')])
    counts = []
    for n in (3, 12):
        m = detail_model({f"c{k}": {"name": f"c{k}", "type": "int"} for k in range(n)})
        plan = clean(pages, [m]).rejects._jdf.queryExecution().optimizedPlan().toString()
        counts.append(plan.count("from_json"))
    assert counts[0] == counts[1] <= 2


def test_unwanted_cells_are_not_built(spark):
    from cellsmith.operators.cells import Wanted
    pages = {"line_pages": views.line_pages(spark, "/root/testdata/sf0.001")}
    only = Wanted(latest=frozenset(["isAvailable"]), history=frozenset())
    some, every = (run_spec(pages, specs.LINES, wanted=w)["parts"] for w in (only, Wanted()))
    cells = some.cells
    assert {r.qualifier for r in cells.select("qualifier").distinct().collect()} == {"isAvailable"}
    assert cells.count() == every.cells.where("qualifier = 'isAvailable' AND family = 'content'").count()
    assert some.rejects.count() == every.rejects.count()


def test_no_query_deals_rows_round_robin(spark):
    from cellsmith.plans.queries import QUERIES
    for name in ("clean_latest", "list_items", "model_fanin", "rejects"):
        assert "RoundRobin" not in _plan(QUERIES[name](spark, "/root/testdata/sf0.001")), name


@pytest.mark.parametrize("name", ["events", "part"])
def test_rows_of_a_large_row_group_are_dealt_to_tasks_of_bounded_size(spark, tmp_path, monkeypatch, name):
    rows = 4000
    key = {"events": "id AS event_id, TIMESTAMP_NTZ'2024-01-02 00:00:00' AS ts, id AS user_id, 'view' AS event_type, "
                     "1.5D AS value, '{}' AS props",
           "part": "id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, CAST(id % 50 AS INT) AS p_size, "
                   "2.5D AS p_retailprice"}[name]
    spark.range(rows).selectExpr(*key.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(views, "TASK_ROWS", 100)
    view = views.event_pages if name == "events" else views.token_history_cells
    sizes = view(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    made = rows if name == "events" else 2 * rows
    assert sum(r["count"] for r in sizes) == made and max(r["count"] for r in sizes) < 3 * made / (rows / 100)


@pytest.mark.parametrize("name", ["clean_history", "upsert_overwrites", "history_lookup", "backfill_tokens",
                                  "store_update", "history_lookup_many"])
def test_tasks_that_merge_follow_the_cells(spark, monkeypatch, name):
    from cellsmith.plans import queries
    sf = "/root/testdata/sf0.001"
    before = queries.QUERIES[name](spark, sf).collect()
    seen, dealt = [], merge.merge_cells

    def watched(cells, key=merge.CELL_KEY, before=(), tasks=None):
        out = dealt(cells, key, before, tasks)
        seen.append((tasks, _plan(out)))
        return out

    monkeypatch.setattr(merge, "TASK_CELLS", 300)
    for module in (merge, "cellsmith.plans.job", "cellsmith.sources.store"):
        monkeypatch.setattr(*((module, "merge_cells") if module is merge else (f"{module}.merge_cells",)), watched)
    after = queries.QUERIES[name](spark, sf).collect()
    assert sorted(map(str, before)) == sorted(map(str, after))
    # but for the lookup in the stored table, every merge is dealt to more tasks than the session's 8
    many = [p for n, p in seen if n and n > 8 and "REPARTITION_BY_NUM" in p]
    assert many and len(many) >= len(seen) - (name == "history_lookup")


def test_merges_are_dealt_where_joined_partitions_would_grow(spark, monkeypatch):
    monkeypatch.setattr(merge, "TASK_CELLS", 10)
    cores = spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(50 * cores))
        assert merge.tasks_for(spark, 10 * cores) is None
        assert merge.tasks_for(spark, 20 * cores) == 2 * cores  # Spark would join 50 partitions a core to one a core
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("name", ["store_update", "history_lookup_many"])
def test_written_cells_are_read_a_file_a_task(spark, monkeypatch, name):
    from cellsmith.plans import queries
    from cellsmith.sources.store import CellStore
    monkeypatch.setattr(merge, "TASK_CELLS", 300)
    seen, merged = [], CellStore.merged

    def watched(self, new, folders):
        seen.append((new.rdd.getNumPartitions(), len(new.inputFiles())))
        return merged(self, new, folders)

    monkeypatch.setattr(CellStore, "merged", watched)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert seen and all(tasks >= files > 8 for tasks, files in seen)


def test_items_of_a_job_are_read_a_file_a_task(spark, monkeypatch, tmp_path):
    from cellsmith.plans import job
    seen, write = [], job.write_cells

    def watched(cells, *args, **kwargs):
        seen.append(cells.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
        write(cells, *args, **kwargs)

    monkeypatch.setattr(job, "write_cells", watched)
    pages = views.event_pages(spark, "/root/testdata/sf0.001")
    job.run_job(spark, {"event_pages": pages}, specs.EVENTS, f"{tmp_path}/out")
    assert seen == [spark.conf.get("spark.sql.files.openCostInBytes")]


def test_tasks_of_token_texts_hold_fewer_parts(spark, monkeypatch, tmp_path):
    spark.range(3000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "CAST(id % 50 AS INT) AS p_size",
                                 "2.5D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(views, "TASK_ROWS", 300)
    sizes = views.token_history_cells(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 6000 and max(r["count"] for r in sizes) < 400  # two texts a part


@pytest.mark.parametrize("name", ["subfields", "list_items", "list_history", "list_properties", "string_items", "subfield_bool",
                                  "download_time_cells"])
def test_items_are_dealt_before_their_cells_are_made(spark, monkeypatch, name):
    from cellsmith.plans import queries
    sf = "/root/testdata/sf0.001"
    before = queries.QUERIES[name](spark, sf).collect()
    monkeypatch.setattr(merge, "TASK_CELLS", 300)
    df = queries.QUERIES[name](spark, sf)
    assert sorted(map(str, before)) == sorted(map(str, df.collect()))
    # one exchange between the cleaning and the merge, of items by row key; the cells are made behind it
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = [k for k, line in enumerate(lines) if "RepartitionByExpression [row_key" in line]
    made = [k for k, line in enumerate(lines) if "Generate posexplode(cells" in line]
    assert len(dealt) == 1 and made and max(made) < dealt[0]
    assert "qualifier" not in lines[dealt[0]]
    plan = _plan(df)
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning(row_key") == 1
