"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (through :mod:`cellsmith.sources.views`)
and runs the library's own operators over all of their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.functions import arrays
from cellsmith.functions import text as tx
from cellsmith.operators import merge, records
from cellsmith.operators.backfill import backfill
from cellsmith.operators.cells import Wanted
from cellsmith.operators.keys import regex_matches as _regex_matches
from cellsmith.plans import specs
from cellsmith.plans.job import backfill_job, backfill_store, read_output, run_job, run_spec, update_store
from cellsmith.session import work_path
from cellsmith.sources import views
from cellsmith.sources.pages import read_cells, read_history
from cellsmith.sources.store import create_store
from cellsmith.sources.sinks import write_cells
from cellsmith.spec import parse_subfields


def _events_clean(spark: SparkSession, sf_dir: str, spec=specs.EVENTS, wanted=Wanted()):
    pages = views.event_pages(spark, sf_dir)
    return run_spec({"event_pages": pages}, spec, wanted=wanted)["events_clean"]


def _only_latest(*names: str) -> Wanted:
    return Wanted(latest=frozenset(names) if names else None, history=frozenset())


def _only_history(*families: str) -> Wanted:
    return Wanted(latest=frozenset(), history=frozenset(families) if families else None)


def _both(*names: str) -> Wanted:
    return Wanted(latest=frozenset(names), history=frozenset(names))


def _merged(cells: DataFrame, tasks: int | None = None) -> DataFrame:
    return merge.cell_values(merge.merge_cells(cells, tasks=tasks))


def _merged_items(items: DataFrame, tasks: int | None) -> DataFrame:
    return merge.cell_values(merge.merge_items(items, tasks))


def _tasks(spark: SparkSession, sf_dir: str, cells_by_table: dict[str, int]) -> int | None:
    """Tasks that merge the cells of tables whose rows become at most so many each."""
    return merge.tasks_for(spark, sum(views.table(spark, sf_dir, t).count() * n for t, n in cells_by_table.items()))


def _buckets(spark: SparkSession, sf_dir: str, cells_by_table: dict[str, int]) -> int:
    """Buckets of a store for the cells of such tables: an update merges one in a task."""
    cells = sum(views.table(spark, sf_dir, t).count() * n for t, n in cells_by_table.items())
    return max(8, -(-cells // merge.TASK_CELLS))


def clean_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event pages (five models, one pass) -> merged latest cells."""
    return _merged(_events_clean(spark, sf_dir, wanted=_only_latest()).cells, _tasks(spark, sf_dir, {"events": 4}))


def clean_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event pages -> merged daily history cells (incl. download-time cells)."""
    return _merged(_events_clean(spark, sf_dir, wanted=_only_history()).cells, _tasks(spark, sf_dir, {"events": 5}))


def _dirty_clean(spark: SparkSession, sf_dir: str, wanted=Wanted()):
    pages = views.dirty_pages(spark, sf_dir)
    return run_spec({"dirty_pages": pages}, specs.DIRTY, wanted=wanted)["dirty_clean"]


def _coerced(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _merged(_dirty_clean(spark, sf_dir, _both(name)).cells, _tasks(spark, sf_dir, {"events": 2}))


def coerce_int(spark, sf_dir):
    """Dirty texts typed int: truncation at the dot, strict parse, text fallback."""
    return _coerced(spark, sf_dir, "asInt")


def coerce_long(spark, sf_dir):
    return _coerced(spark, sf_dir, "asLong")


def coerce_float(spark, sf_dir):
    return _coerced(spark, sf_dir, "asFloat")


def coerce_double(spark, sf_dir):
    return _coerced(spark, sf_dir, "asDouble")


def coerce_string(spark, sf_dir):
    return _coerced(spark, sf_dir, "asString")


def coerce_boolean(spark, sf_dir):
    """Boolean words by vocabulary (incl. a special key) on order pages."""
    pages = views.order_pages(spark, sf_dir)
    res = run_spec({"order_pages": pages}, specs.BOOL_WORDS, wanted=_both("statusFlag", "soldOut"))["order_flags"]
    return _merged(res.cells, _tasks(spark, sf_dir, {"orders": 4}))


def rejects(spark, sf_dir):
    """Items the cleaning contract cannot store, with their source text: malformed
    JSON, text after the object, two objects, no text, dots-only int text, unknown
    boolean word."""
    return _dirty_clean(spark, sf_dir).rejects


LINE_COLUMNS = ["lineNo", "discountRate", "pictureFile", "quantity", "flagPair", "taxedQuantity", "taxRate",
                "returnFlag", "supplierText", "title"]
LINE_PROPERTIES = ["supplier_no", "state", "flag", "note", "remark"]
SUBFIELD_NAMES = ["originalPrice", "packingFee", "recentRating", "promotionStock",
                  "currentPrice", "recentPopularity", "stock", "sku"]


def _line_clean(spark: SparkSession, sf_dir: str, wanted: Wanted, spec=specs.LINES):
    pages = views.line_pages(spark, sf_dir)
    return run_spec({"line_pages": pages}, spec, wanted=wanted)[spec[0].output_table]


def list_items(spark, sf_dir):
    """List pages exploded into items, keyed by regex, typed, merged (latest)."""
    return _merged_items(_line_clean(spark, sf_dir, _only_latest(*LINE_COLUMNS)).items, _tasks(spark, sf_dir, {"lineitem": 14}))


def list_history(spark, sf_dir):
    """History cells of the ``isMulti`` list columns only."""
    return _merged_items(_line_clean(spark, sf_dir, _only_history(*LINE_COLUMNS)).items, _tasks(spark, sf_dir, {"lineitem": 11}))


def list_properties(spark, sf_dir):
    """Page properties melted onto every item (empty texts dropped)."""
    return _merged_items(_line_clean(spark, sf_dir, _only_latest(*LINE_PROPERTIES)).items, _tasks(spark, sf_dir, {"lineitem": 6}))


def regex_key(spark, sf_dir):
    """Row key of every item: group 1 of the last regex match in the item text."""
    return _line_clean(spark, sf_dir, _both()).items.select("source_key", "item_pos", "row_key")


def string_items(spark, sf_dir):
    """Items that are objects and items that are strings holding one; the key regex
    reads a bare number in either."""
    wanted = _only_latest("lineNo", "title", "discountText")
    return _merged_items(_line_clean(spark, sf_dir, wanted, specs.LINES_BY_CODE).items, _tasks(spark, sf_dir, {"lineitem": 4}))


def subfields(spark, sf_dir):
    """Token sub-fields of the first ``specfoods`` text, strictly typed (latest and history)."""
    return _merged_items(_line_clean(spark, sf_dir, _both(*SUBFIELD_NAMES)).items, _tasks(spark, sf_dir, {"lineitem": 22}))


def subfield_bool(spark, sf_dir):
    """Negated boolean sub-field (``sold_out`` -> ``isAvailable``), latest and history."""
    return _merged_items(_line_clean(spark, sf_dir, _both("isAvailable")).items, _tasks(spark, sf_dir, {"lineitem": 3}))


def download_time_cells(spark, sf_dir):
    """``downloadTime:<day>`` cells: list pages with ``recordTime`` and detail pages."""
    wanted = _only_history(fixed.DOWNLOAD_TIME_FAMILY)
    lines = _line_clean(spark, sf_dir, wanted, specs.LINES_TIMED).items
    return _merged_items(lines.unionByName(_customer_clean(spark, sf_dir, wanted, specs.CUSTOMERS[:1]).items),
                         _tasks(spark, sf_dir, {"lineitem": 2, "customer": 1}))


def _customer_clean(spark: SparkSession, sf_dir: str, wanted=Wanted(), spec=specs.CUSTOMERS):
    pages = {"customer_pages": views.customer_pages(spark, sf_dir),
             "directory_pages": views.directory_pages(spark, sf_dir)}
    return run_spec(pages, spec, wanted=wanted)[spec[0].output_table]


def model_fanin(spark, sf_dir):
    """Customer detail and list pages (two sources, two models) -> one table, all cells."""
    return _merged(_customer_clean(spark, sf_dir).cells, _tasks(spark, sf_dir, {"customer": 35}))


def multi_output(spark, sf_dir):
    """One source whose model ``a`` feeds two output tables with other columns, two
    list paths, keys that differ by case only: the cells of both tables."""
    out = run_spec({"twin_pages": views.twin_pages(spark, sf_dir)}, specs.TWINS)
    parts = [_merged(r.cells).withColumn("output_table", F.lit(o)) for o, r in out.items()]
    return parts[0].unionByName(parts[1])


def cjk_key_md5(spark, sf_dir):
    """Composite key of the customer name; keys with CJK text become a 16-char MD5."""
    res = _customer_clean(spark, sf_dir, _both(), specs.CUSTOMERS_BY_NAME)
    return res.items.select("source_key", "row_key")


def _customer_column(spark, sf_dir, name: str) -> DataFrame:
    return _merged(_customer_clean(spark, sf_dir, _both(name), specs.CUSTOMERS[:1]).cells, _tasks(spark, sf_dir, {"customer": 2}))


def array_spaced(spark, sf_dir):
    """Array of texts -> every element followed by one space (empty array: no cell)."""
    return _customer_column(spark, sf_dir, "hours")


def array_names(spark, sf_dir):
    """Array of objects -> ``name`` of each joined by ``/`` (missing: ``null``)."""
    return _customer_column(spark, sf_dir, "tags")


def array_descriptions(spark, sf_dir):
    return _customer_column(spark, sf_dir, "promises")


WIDE_NAMES = ["displayName", "customerId", "street", "balance", "zone", "isVip", "isBuilder", "contact", "visits",
              "segment", "waitText", "never", "hours", "tags", "promises", "listName", "logoFile", "minutes", "offer"]


def latest_wide(spark, sf_dir):
    """What a reader of each customer row sees: one text column per latest name."""
    cells = _customer_clean(spark, sf_dir, Wanted(history=frozenset())).cells
    return merge.latest_wide(cells, WIDE_NAMES)


def backfill_tokens(spark, sf_dir):
    """Stored token-text history -> typed history cells on the same days."""
    hist = read_history(views.token_history_cells(spark, sf_dir), fixed.SUBFIELD_ARRAY_KEY)
    tasks = _tasks(spark, sf_dir, {"part": 2 * len(fixed.BACKFILL_SUBFIELDS)})
    return _merged(backfill(hist, parse_subfields(fixed.BACKFILL_SUBFIELDS)).cells, tasks)


MIDPOINT_MS = 1705622400000  # 2024-01-19 00:00:00 UTC: events before it form the snapshot


def upsert_merge(spark, sf_dir):
    """Snapshot of early events upserted with the later ones (all families)."""
    cells = _events_clean(spark, sf_dir).cells
    tasks = _tasks(spark, sf_dir, {"events": 9})
    old = merge.merge_cells(cells.where(F.col("download_time") < MIDPOINT_MS), tasks=tasks)
    new = cells.where(F.col("download_time") >= MIDPOINT_MS)
    return merge.cell_values(merge.upsert_cells(old, new, tasks=tasks))


def upsert_overwrites(spark, sf_dir):
    """Two runs of the job on stored tables. The first cleans all events, the second
    the early ones again with a column typed anew: same pages and times, and
    earlier ones than the table holds. Its cells overwrite, all others stay."""
    pages = views.event_pages(spark, sf_dir)
    one, two = work_path(spark, "first"), work_path(spark, "second")
    run_job(spark, {"event_pages": pages}, specs.EVENTS, one)
    early = pages.where(F.col("download_time") < MIDPOINT_MS)
    run_job(spark, {"event_pages": early}, specs.EVENTS_RETYPED, two, existing_root=one)
    return merge.cell_values(read_output(spark, two, "events_clean"))


def backfill_upsert(spark, sf_dir):
    """The backfill written back into the stored table that it read: its cells
    overwrite typed cells of the same days, whatever their download times."""
    stored = views.token_history_cells(spark, sf_dir).unionByName(views.typed_history_cells(spark, sf_dir))
    one, two = work_path(spark, "stored"), work_path(spark, "filled")
    write_cells(stored.withColumn("output_table", F.lit("parts")), f"{one}/cells", by=["output_table"],
                files=_tasks(spark, sf_dir, {"part": 4}))
    backfill_job(spark, one, "parts", fixed.SUBFIELD_ARRAY_KEY, parse_subfields(fixed.BACKFILL_SUBFIELDS), two)
    return merge.cell_values(read_output(spark, two, "parts"))


def store_update(spark, sf_dir):
    """The two runs of ``upsert_overwrites`` on a stored table that is updated where it
    stands: the second reads and writes the folders that it touches alone."""
    pages = views.event_pages(spark, sf_dir)
    store = create_store(spark, work_path(spark, "store"), _buckets(spark, sf_dir, {"events": 9}), period=4)
    update_store(store, {"event_pages": pages}, specs.EVENTS)
    update_store(store, {"event_pages": pages.where(F.col("download_time") < MIDPOINT_MS)}, specs.EVENTS_RETYPED)
    return merge.cell_values(store.cells("events_clean"))


def store_backfill(spark, sf_dir):
    """The backfill of a stored table in two runs, the second of the texts written since the first."""
    texts = views.token_history_cells(spark, sf_dir).withColumn("output_table", F.lit("parts"))
    typed = views.typed_history_cells(spark, sf_dir).withColumn("output_table", F.lit("parts"))
    subfields = parse_subfields(fixed.BACKFILL_SUBFIELDS)
    store = create_store(spark, work_path(spark, "store"), _buckets(spark, sf_dir, {"part": 2 * len(subfields) + 4}))
    first = F.col("qualifier") < "2024-02"
    store.upsert(typed.unionByName(texts.where(first)), _tasks(spark, sf_dir, {"part": 3}))
    backfill_store(store, "parts", fixed.SUBFIELD_ARRAY_KEY, subfields)
    store.upsert(texts.where(~first), _tasks(spark, sf_dir, {"part": 1}))
    backfill_store(store, "parts", fixed.SUBFIELD_ARRAY_KEY, subfields)
    return merge.cell_values(store.cells("parts"))


def history_lookup_many(spark, sf_dir):
    """Every day of one column for all rows that have a purchase above 20, from the stored table."""
    store = create_store(spark, work_path(spark, "store"), _buckets(spark, sf_dir, {"events": 9}))
    store.upsert(_events_clean(spark, sf_dir).cells.withColumn("output_table", F.lit("events")),
                 _tasks(spark, sf_dir, {"events": 9}))
    keys = views.table(spark, sf_dir, "events").where("event_type = 'purchase' AND value > 20") \
        .select(F.concat("user_id", "event_type").alias("row_key"))
    return merge.cell_values(store.lookup("events", keys, LOOKUP_COLUMN))


def fanin_ties(spark, sf_dir):
    """Two sites that write one table, alike in time and key for half of their pages: there
    the later one of the spec wins, elsewhere the greater source key."""
    pages = {"event_pages": views.event_pages(spark, sf_dir),
             "second_event_pages": views.second_event_pages(spark, sf_dir)}
    return _merged(run_spec(pages, specs.TWO_SITES)["events_clean"].cells, _tasks(spark, sf_dir, {"events": 18}))


def latest_wide_typed(spark, sf_dir):
    """The customer rows with every latest column in its type, and its text where that did not parse."""
    cells = _customer_clean(spark, sf_dir, Wanted(history=frozenset())).cells
    types = merge.wide_types([m for t in specs.CUSTOMERS for m in t.models])
    wide = merge.latest_wide_typed(cells, {n: types[n] for n in WIDE_NAMES})
    return wide.select(*[F.col(n).cast("double").alias(n) if t == "float" else F.col(n) for n, t in wide.dtypes])


def sort_stable(spark, sf_dir):
    """Orders sorted by status (three values, descending), equal ones in input order; global rank."""
    o = records.with_input_position(views.table(spark, sf_dir, "orders"))
    ranked = records.with_global_rank(o, records.stable_order("o_orderstatus", "desc"), "rank")
    return ranked.select("o_orderkey", "o_orderstatus", "rank")


def lenient_timestamp(spark, sf_dir):
    """Loose date-time text whose parts roll over."""
    t = views.order_date_texts(spark, sf_dir)
    late = F.concat_ws(" ", F.year("o_orderdate") , F.lit("14"), F.col("o_orderkey") % 400, F.lit("25:61:61"))
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", late.alias("late"))
    both = t.join(o, "o_orderkey")
    return both.select("o_orderkey", F.expr(tx.normalize_timestamp("text", lenient=True)).alias("ts"),
                       F.expr(tx.normalize_timestamp("late", lenient=True)).alias("late_ts"))


LOOKUP_KEY, LOOKUP_COLUMN = "0click", "amount"


def history_lookup(spark, sf_dir):
    """Every day of one column of one row, from the stored cell table."""
    path = work_path(spark, "cells")
    tasks = _tasks(spark, sf_dir, {"events": 9})
    write_cells(merge.merge_cells(_events_clean(spark, sf_dir).cells, tasks=tasks), path, files=tasks)
    return merge.cell_values(merge.lookup_history(read_cells(spark, path), LOOKUP_KEY, LOOKUP_COLUMN))


MATCH_REGEX = r"(\d+)"


def regex_matches(spark, sf_dir):
    """Every group-1 match of a regex over whole document texts."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    return _regex_matches(docs, "text", MATCH_REGEX).select(
        "doc_id", F.col("match_pos").cast("int").alias("match_pos"), "match")


def sort_records(spark, sf_dir):
    """Orders sorted by total price (descending), ties by key; global rank."""
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    order = records.sort_columns("o_totalprice", "desc", ["o_orderkey"])
    return records.with_global_rank(o, order, "rank")


def distinct_sorted(spark, sf_dir):
    """Distinct part names, ascending, with their rank."""
    return records.distinct_sorted(views.table(spark, sf_dir, "part"), "p_name")


def distinct_array(spark, sf_dir):
    """Distinct words of every document, ascending."""
    d = views.table(spark, sf_dir, "documents")
    return d.selectExpr("doc_id", f"{arrays.distinct_sorted("split(text, ' ')")} AS words")


def normalize_timestamp(spark, sf_dir):
    """Loose date-time text -> ``yyyy-MM-dd HH:mm:ss`` (NULL when invalid)."""
    t = views.order_date_texts(spark, sf_dir)
    return t.select("o_orderkey", tx.normalize_timestamp_col("text").alias("ts"))


def blank_tests(spark, sf_dir):
    """Blank / empty / whitespace / CJK tests where all kinds of blanks replace seven texts of eleven."""
    return _blank_tests(views.odd_texts(spark, sf_dir))


def blank_tests_whole(spark, sf_dir):
    """The same tests over every document's own text."""
    return _blank_tests(views.table(spark, sf_dir, "documents"))


def _blank_tests(d):
    return d.select("doc_id", tx.is_blank_col("text").alias("text_blank"),
                    tx.is_empty_col("text").alias("text_empty"),
                    tx.contains_blanks_col("text").alias("text_has_blanks"),
                    tx.contains_cjk_col("text").alias("text_has_cjk"),
                    tx.contains_blanks_col("source").alias("source_has_blanks"))


QUERIES = {
    "clean_latest": clean_latest,
    "clean_history": clean_history,
    "coerce_int": coerce_int,
    "coerce_long": coerce_long,
    "coerce_float": coerce_float,
    "coerce_double": coerce_double,
    "coerce_string": coerce_string,
    "coerce_boolean": coerce_boolean,
    "rejects": rejects,
    "list_items": list_items,
    "list_history": list_history,
    "list_properties": list_properties,
    "regex_key": regex_key,
    "string_items": string_items,
    "subfields": subfields,
    "subfield_bool": subfield_bool,
    "download_time_cells": download_time_cells,
    "model_fanin": model_fanin,
    "multi_output": multi_output,
    "cjk_key_md5": cjk_key_md5,
    "array_spaced": array_spaced,
    "array_names": array_names,
    "array_descriptions": array_descriptions,
    "latest_wide": latest_wide,
    "backfill_tokens": backfill_tokens,
    "upsert_merge": upsert_merge,
    "upsert_overwrites": upsert_overwrites,
    "backfill_upsert": backfill_upsert,
    "history_lookup": history_lookup,
    "store_update": store_update,
    "store_backfill": store_backfill,
    "history_lookup_many": history_lookup_many,
    "fanin_ties": fanin_ties,
    "latest_wide_typed": latest_wide_typed,
    "sort_stable": sort_stable,
    "lenient_timestamp": lenient_timestamp,
    "regex_matches": regex_matches,
    "sort_records": sort_records,
    "distinct_sorted": distinct_sorted,
    "distinct_array": distinct_array,
    "normalize_timestamp": normalize_timestamp,
    "blank_tests": blank_tests,
    "blank_tests_whole": blank_tests_whole,
}
