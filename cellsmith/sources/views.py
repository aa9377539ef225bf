"""Raw page shapes built from the driver tables.

These only *shape* input for the cleaning jobs: they give rows of the raw
page schema (``source_key, page_model, data, propertys, download_time,
request_url``) whose JSON texts are assembled with built-in functions. They do
none of the cleaning work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith.sources.pages import read_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(c: str) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ column (zone-free)."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def _obj(*fields: Column) -> Column:
    """JSON object text of named fields (nulls dropped)."""
    return F.to_json(F.struct(*fields))


def _with_raw(obj: Column, key: str, raw_json: Column) -> Column:
    """Append ``"key": <raw_json>`` to a JSON object text."""
    body = obj.substr(F.lit(1), F.length(obj) - 1)
    return F.concat(body, F.lit(f',"{key}":'), raw_json, F.lit("}"))


def _json_string(c: Column) -> Column:
    """A text as a JSON string literal (quoted, escaped)."""
    arr = F.to_json(F.array(c))
    return arr.substr(F.lit(2), F.length(arr) - 2)


#: Rows of a table that one task makes pages of. A row becomes up to some thirty cells, so the sort
#: before a merge holds a few hundred MB.
TASK_ROWS = 50_000


def _dealt(df: DataFrame, *keys: str, share: int = 1) -> DataFrame:
    """Rows dealt by ``keys`` to tasks of some :data:`TASK_ROWS` rows each, whatever the row groups of the
    files (a row group is one task, and may hold a million rows). ``share``: so many times fewer rows,
    where one becomes as many times more cells."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() * share // TASK_ROWS)), *keys)


def _pages(df: DataFrame, source_key: Column, model: Column, data: Column,
           propertys: Column, download_time: Column) -> DataFrame:
    """Rows of the raw page schema."""
    out = df.select(source_key.cast("string").alias("source_key"),
                    model.alias("page_model"), data.alias("data"),
                    propertys.cast("string").alias("propertys"),
                    download_time.cast("bigint").alias("download_time"),
                    F.lit(None).cast("string").alias("request_url"))
    return read_pages(df.sparkSession, out)


# ---------------------------------------------------------------------------
def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per event: model = event type, data = the event as JSON."""
    return _event_pages(spark, sf_dir, F.col("event_id"), F.col("value"))


def second_event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another site's pages of the same events with other values. Every second one has the same time and
    source key as in :func:`event_pages`, the others a key that sorts before it."""
    key = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.lit(""))
    return _event_pages(spark, sf_dir, key, F.col("value") + 1)


def _event_pages(spark: SparkSession, sf_dir: str, key: Column, value: Column) -> DataFrame:
    e = _dealt(table(spark, sf_dir, "events"), "event_id", "ts", "user_id").withColumn("_key", key).withColumn("value", value)
    e = e.withColumn("_base", _obj(F.col("user_id"), F.col("event_type"), F.col("value")))
    return _pages(e, F.col("_key"), F.col("event_type"),
                  _with_raw(F.col("_base"), "props", F.col("props")), F.lit(None), epoch_ms("ts"))


# Field texts of the dirty pages, picked by event_id % 19. None = JSON null.
def _dirty_text() -> Column:
    e = F.col("event_id") % 19
    v = F.col("value").cast("string")
    u = F.col("user_id").cast("string")
    cases = [
        (0, None, "number"), (1, F.lit("abc"), "text"), (2, F.concat(v, F.lit("元")), "text"),
        (3, F.lit("null"), "text"), (4, F.lit(""), "text"), (5, None, "null"),
        (6, F.concat(F.lit(" "), u), "text"), (7, F.lit("1e3"), "text"),
        (8, F.lit("-0.5"), "text"), (9, F.lit("NaN"), "text"), (10, F.lit("inf"), "text"),
        (11, (F.col("user_id") + F.lit(2147483648)).cast("string"), "text"),
        (12, F.lit("1.0"), "text"), (13, F.concat(F.lit("+"), u), "text"),
        (14, F.lit(".5"), "text"), (15, v, "text"),
        (16, F.lit("9223372036854775808"), "text"), (17, F.concat(F.lit(" "), v, F.lit(" ")), "text"),
        (18, F.lit("."), "text"),
    ]
    expr = None
    for k, txt, kind in cases:
        if kind == "number":
            j = v
        elif kind == "null":
            j = F.lit("null")
        else:
            j = _json_string(txt)
        expr = F.when(e == k, j) if expr is None else expr.when(e == k, j)
    return expr


_FLAG_WORDS = ["true", "True", "FALSE", "有货", "无货", "0", "1", "休息中", "自营", "maybe", "null"]


def dirty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event pages with deliberately dirty field texts (coercion and rejects).

    Every 97th event has a JSON text with its last brace missing, the next one
    text after the object, the next two a second object and no text at all.
    """
    e = _dealt(table(spark, sf_dir, "events"), "event_id", "ts", "user_id")
    words = F.array(*[F.lit(w) for w in _FLAG_WORDS])
    flag = F.element_at(words, (F.col("event_id") % len(_FLAG_WORDS) + 1).cast("int"))
    raw = _dirty_text()
    data = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"),
                    *[x for k in ("as_int", "as_long", "as_float", "as_double", "as_string")
                      for x in (F.lit(f',"{k}":'), raw)],
                    F.lit(',"flag":'), _json_string(flag))
    k = F.col("event_id") % 97
    out = F.when(k == 0, F.concat(data, F.lit(","))).when(k == 1, F.concat(data, F.lit("} x 1.50"))) \
        .when(k == 2, F.concat(data, F.lit('}{"id":2.50}'))).when(k == 3, F.lit(""))
    # brackets that close what the document did not open, texts that are no numbers, control characters
    for n, tail in enumerate(['}],"e":[{"id":7}', '}],"d":[{"id":7}', '}]}', ',"n":1-2}', ',"n":1.2.3}', ',"n":1e+}',
                              ',"n":"p\u0001q\u0002r\u0003s\u0004"'], 4):
        out = out.when(k == n, F.concat(data, F.lit(tail)))
    data = out.otherwise(F.concat(data, F.lit("}")))
    return _pages(e, F.col("event_id"), F.lit("dirty"), data, F.lit(None), epoch_ms("ts"))


_STATUS_WORDS = {"F": "有货", "O": "无货", "P": "营业中"}


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per order with boolean-ish words."""
    o = _dealt(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")
    word = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v))
                        for k, v in _STATUS_WORDS.items()], F.col("o_orderstatus"))
    sold = F.when(F.col("o_orderkey") % 3 == 0, F.lit("True")) \
            .when(F.col("o_orderkey") % 3 == 1, F.lit("休息中")).otherwise(F.lit("营业中"))
    data = _obj(F.col("o_orderkey").alias("id"), word.alias("status_word"), sold.alias("sold_out"))
    return _pages(o, F.col("o_orderkey"), F.lit("order"), data, F.lit(None), epoch_ms("o_orderdate"))


# ---------------------------------------------------------------------------
# line pages (list): one page per line item, one or two items
# ---------------------------------------------------------------------------
def _token_text() -> Column:
    """A ``key:value`` token text in the two-space format of menu items."""
    s = lambda c: F.col(c).cast("string")
    sold = F.when(F.col("l_linestatus") == "F", F.lit("False")).otherwise(F.lit("True"))
    stock = F.when(F.col("l_linenumber") == 7, F.lit("")) \
             .otherwise((F.col("l_linenumber") * 10).cast("string"))
    orig = F.when(F.col("l_discount") == 0, F.lit("")).otherwise(s("l_extendedprice"))
    parts = [
        F.concat(F.lit("original_price:"), orig),
        F.concat(F.lit("sku_id:"), s("l_suppkey")),
        F.concat(F.lit("name:food "), s("l_partkey")),
        F.concat(F.lit("virtual_food_id:"), s("l_suppkey")),
        F.concat(F.lit("food_id:"), s("l_partkey")),
        F.concat(F.lit("packing_fee:"), s("l_tax")),
        F.concat(F.lit("recent_rating:"), s("l_discount")),
        F.lit("promotion_stock:-1"),
        F.concat(F.lit("price:"), s("l_extendedprice")),
        F.concat(F.lit("sold_out:"), sold),
        F.concat(F.lit("recent_popularity:"), F.col("l_quantity").cast("int").cast("string")),
        F.lit("is_essential:False"),
        F.concat(F.lit("specs:    name:规格  value:"), F.col("l_returnflag")),
        F.lit("partial_reduce_activity_id:"),
        F.concat(F.lit("stock:"), stock),
    ]
    text = F.concat_ws("  ", *parts)
    # a repeated key: the later token wins
    return F.when(F.col("l_linenumber") == 2,
                  F.concat(text, F.lit("  sku_id:"), s("l_partkey"))).otherwise(text)


def line_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages ``{"lines": [item, ...]}``, one per line item and built from its
    row alone (no grouping, so an order of any size is no group). Every third
    line number's page has a second item: a *string* holding the JSON of a
    variant with the same key."""
    li = _dealt(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_linenumber").withColumn("_text", _token_text())

    def item(extra: int, title: str) -> Column:
        return _obj(
            F.col("l_partkey").alias("code"), (F.col("l_linenumber") + extra).alias("line_no"),
            F.col("l_discount").alias("discount"),
            F.concat(F.lit("img/"), F.col("l_partkey").cast("string"), F.lit(".jpg")).alias("picture"),
            (F.col("l_quantity") + extra).alias("qty"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("flags"),
            F.col("l_suppkey").alias("supplier"),
            F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("taxed_qty"),
            F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("return_flag"),
            F.concat(F.lit(title), F.col("l_partkey").cast("string")).alias("title"),
            F.array("_text").alias("specfoods"))

    # a column, so that the text is rendered once
    li = li.withColumn("_second", F.when(F.col("l_linenumber") % 3 == 0, F.to_json(F.array(item(100, "other ")))))
    inner = F.substring("_second", F.lit(2), F.length("_second") - 2)
    data = F.concat(F.lit('{"lines":['), item(0, "part "),
                    F.coalesce(F.concat(F.lit(","), inner), F.lit("")), F.lit("]}"))
    props = _obj(F.col("l_suppkey").alias("supplier_no"), F.col("l_linestatus").alias("state"),
                 F.col("l_returnflag").alias("flag"), F.lit("").alias("note"),
                 F.lit("null").alias("remark"))
    sk = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return _pages(li, sk, F.lit("line"), data, props, epoch_ms("l_shipdate"))


# ---------------------------------------------------------------------------
# customer pages: a detail page and a list page per customer
# ---------------------------------------------------------------------------
CUSTOMER_EPOCH_MS = 1704067200000
_VIP_WORDS = ["true", "false", "有货", "0", "1"]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _dealt(table(spark, sf_dir, "customer"), "c_custkey", "c_name")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"])


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per customer."""
    x = _customers(spark, sf_dir)
    key = F.col("c_custkey")
    name = F.when(key % 3 == 0, F.concat(F.lit("店铺"), F.col("c_name"))).otherwise(F.col("c_name"))
    hours = F.when(key % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(
        F.lit("08:00-12:00"),
        F.concat(F.lpad((F.col("c_nationkey") % 24).cast("string"), 2, "0"), F.lit(":00-22:00"))))
    flavors = F.array(F.create_map(F.lit("name"), F.col("n_name")),
                      F.when(key % 7 == 0, F.create_map(F.lit("other"), F.col("c_mktsegment")))
                      .otherwise(F.create_map(F.lit("name"), F.col("c_mktsegment"))))
    supports = F.array(F.create_map(F.lit("description"), F.col("c_mktsegment")),
                       F.create_map(F.lit("description"),
                                    F.concat(F.lit("fast "), F.col("c_nationkey").cast("string"))))
    words = F.array(*[F.lit(w) for w in _VIP_WORDS])
    data = _obj(
        key.alias("id"), name.alias("name"),
        F.concat(F.col("n_name"), F.lit(" road "), key.cast("string")).alias("street"),
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("zone"),
        F.element_at(words, (key % 5 + 1).cast("int")).alias("vip"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("自营")).otherwise(F.lit("false")).alias("builder"),
        F.concat(F.lit("+86-"), key.cast("string")).alias("phone"),
        (key % 1000).alias("visits"), F.col("c_mktsegment").alias("segment"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("分钟")).alias("wait"),
        hours.alias("opening_hours"), flavors.alias("flavors"), supports.alias("supports"))
    dt = F.lit(CUSTOMER_EPOCH_MS) + key * F.lit(3600000)
    return _pages(x, key, F.lit("customer"), data, F.lit(None), dt)


def directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list page per customer, ``{"members": [member]}``; its property ``street``
    has the clean name of a field of the detail pages."""
    x = _customers(spark, sf_dir)
    member = _obj(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                  F.concat(F.lit("logo/"), F.col("c_custkey").cast("string"), F.lit(".png")).alias("logo"),
                  (F.col("c_nationkey") + 30).alias("minutes"), F.col("c_mktsegment").alias("offer"))
    data = F.concat(F.lit('{"members":['), member, F.lit("]}"))
    props = _obj(F.concat(F.lit("nation "), F.col("n_name")).alias("street"))
    sk = F.concat(F.lit("list-"), F.col("c_custkey").cast("string"))
    dt = F.lit(CUSTOMER_EPOCH_MS) + F.col("n_nationkey") * F.lit(86400000)
    return _pages(x, sk, F.lit("directory"), data, props, dt)


def twin_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages of two models on one source: ``as`` pages with items under ``as``
    and a text under ``bs``, ``bs`` pages the other way round. An item has the
    keys ``ID`` and ``id``."""
    s = table(spark, sf_dir, "supplier")
    odd = F.col("s_suppkey") % 2 == 1
    item = _obj(F.col("s_suppkey").alias("ID"), F.col("s_nationkey").cast("string").alias("nation"))
    item = _with_raw(item, "id", _json_string(F.col("s_name")))
    two = lambda a, b: F.concat(F.lit('{"as":'), a, F.lit(',"bs":'), b, F.lit("}"))
    many, none = F.concat(F.lit("["), item, F.lit("]")), F.lit('"n/a"')
    data = F.when(odd, two(many, none)).otherwise(two(none, many))
    return _pages(s, F.col("s_suppkey"), F.when(odd, "a").otherwise("b"), data, F.lit(""),
                  F.lit(CUSTOMER_EPOCH_MS))


# ---------------------------------------------------------------------------
# token history (input of the backfill): stored history cells of `specfoods`
# ---------------------------------------------------------------------------
def _part_token_texts() -> tuple[Column, Column]:
    s = lambda c: F.col(c).cast("string")
    size = F.col("p_size")
    sold = F.when(size % 2 == 0, F.lit("False")).otherwise(F.lit("True"))
    stock = F.when(size == 13, F.lit("1.0")).otherwise(s("p_size"))
    a = F.concat_ws("  ",
                    F.concat(F.lit("original_price:"), s("p_retailprice")),
                    F.concat(F.lit("sku_id:"), s("p_partkey")),
                    F.concat(F.lit("name:"), F.col("p_name")),
                    F.concat(F.lit("packing_fee:"), (size % 3).cast("string")),
                    F.concat(F.lit("recent_rating:"), (size % 5).cast("string"), F.lit(".5")),
                    F.lit("promotion_stock:-1"),
                    F.concat(F.lit("price:"), s("p_retailprice")),
                    F.concat(F.lit("sold_out:"), sold),
                    F.concat(F.lit("recent_popularity:"), s("p_size")),
                    F.concat(F.lit("item_id:"), s("p_partkey")),
                    F.concat(F.lit("specs:    name:规格  value:"), F.col("p_type")),
                    F.concat(F.lit("stock:"), stock))
    a = F.when(size % 7 == 0, F.concat(a, F.lit("  price:1,2"))).otherwise(a)
    b = F.concat_ws("  ",
                    F.concat(F.lit("price:"), s("p_size")),
                    F.concat(F.lit("stock:"), (size + 1).cast("string")),
                    F.lit("sold_out:true"),
                    F.concat(F.lit("recent_rating:"), s("p_size")),
                    F.concat(F.lit("item_id:"), F.col("p_brand")))
    return a, b


def token_history_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored ``specfoods:<day>`` text cells per part (cell-table schema)."""
    p = _dealt(table(spark, sf_dir, "part"), "p_partkey", "p_name", share=3)  # up to 24 tokens a part
    a, b = _part_token_texts()
    day_a = F.concat(F.lit("2024-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"))
    rows = F.array(F.struct(day_a.alias("day"), a.alias("text")),
                   F.struct(F.lit("2024-02-01").alias("day"), b.alias("text")))
    x = p.select(F.col("p_partkey").cast("string").alias("row_key"), F.inline(rows))
    return x.select("row_key", F.lit("specfoods").alias("family"), F.col("day").alias("qualifier"),
                    F.lit("string").alias("vtype"), F.col("text").alias("v_string"),
                    F.lit(None).cast("int").alias("v_int"), F.lit(None).cast("bigint").alias("v_long"),
                    F.lit(None).cast("float").alias("v_float"),
                    F.lit(None).cast("double").alias("v_double"),
                    F.lit(None).cast("boolean").alias("v_bool"),
                    F.lit(None).cast("bigint").alias("download_time"),
                    F.col("row_key").alias("source_key"), F.lit(0).alias("item_pos"),
                    F.lit(0).alias("put_seq"), F.lit(0).alias("source_no"))


def typed_history_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored typed cells of parts on the first days of :func:`token_history_cells`,
    written later (by download time) than any backfill: ``stock`` of each part
    and ``shelf``, which no backfill writes."""
    p = _dealt(table(spark, sf_dir, "part"), "p_partkey", "p_name")
    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"))
    rows = F.array(*[F.struct(F.lit(n).alias("family"), (-F.col("p_size")).cast("int").alias("v"))
                     for n in ("stock", "shelf")])
    x = p.select(F.col("p_partkey").cast("string").alias("row_key"), day.alias("day"), F.inline(rows))
    none = lambda t, n: F.lit(None).cast(t).alias(n)
    return x.select("row_key", "family", F.col("day").alias("qualifier"), F.lit("int").alias("vtype"),
                    none("string", "v_string"), F.col("v").alias("v_int"), none("bigint", "v_long"),
                    none("float", "v_float"), none("double", "v_double"), none("boolean", "v_bool"),
                    F.lit(4102444800000).alias("download_time"), F.col("row_key").alias("source_key"),
                    F.lit(0).alias("item_pos"), F.lit(0).alias("put_seq"), F.lit(0).alias("source_no"))


def odd_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts, seven of every eleven replaced by a kind of blank or a CJK text."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 11
    text = F.when(k == 0, F.lit(None)).when(k == 1, "").when(k == 2, "null").when(k == 3, "　") \
        .when(k == 4, "\u00a0").when(k == 5, " ").when(k == 6, F.concat(F.lit("店"), F.col("source"))) \
        .otherwise(F.col("text"))
    return d.select("doc_id", text.alias("text"), "source")


def order_date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose date-time texts (``2018年06月05日 12:00:00`` style) per order."""
    o = table(spark, sf_dir, "orders")
    good = F.date_format(F.col("o_orderdate"), "yyyy年MM月dd日 HH:mm:ss")
    bad_month = F.concat(F.year("o_orderdate").cast("string"), F.lit("年13月05日 00:00:00"))
    text = (F.when(F.col("o_orderkey") % 10 == 0, bad_month)
            .when(F.col("o_orderkey") % 10 == 1, F.lit("x")).otherwise(good))
    return o.select("o_orderkey", text.alias("text"))
