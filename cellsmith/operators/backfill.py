"""Backfill: type the ``key:value`` token texts stored as history of one column.

Input is the long history of one family (``row_key, day, text`` — see
:func:`cellsmith.sources.pages.read_history`). Each text is split into
tokens (two spaces), tokens holding a comma are skipped, a token must split
into exactly two parts at ``:``, its key must be a configured sub-field; the
value is strictly typed and written as a *history* cell ``<name>:<same day>``
(no latest cell). A later token with the same key wins (``put_seq``). A text
with a value that does not parse is rejected whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellsmith.functions import coerce as co
from cellsmith.functions.arrays import map_tokens
from cellsmith.functions.sqltext import q
from cellsmith.operators.cells import CELL_FIELDS, CleanResult
from cellsmith.spec import SubField


def backfill(history: DataFrame, subfields: dict[str, SubField]) -> CleanResult:
    subs = list(subfields.values())

    def typed(k: str, v: str) -> str:
        return "CASE " + " ".join(
            f"WHEN {k} = {q(s.source)} THEN named_struct('name', {q(s.name)}, "
            f"'val', {co.strict_parse(v, s.type)}, 'key', {k}, 'raw', {v})" for s in subs) + " END"

    toks = f"filter({map_tokens('text', typed, skip_commas=True)}, x -> x IS NOT NULL)"
    dt = "download_time" if "download_time" in history.columns else "CAST(NULL AS BIGINT)"
    x = history.selectExpr("row_key", "day", "text", f"{dt} AS download_time",
                           f"{toks} AS toks")
    x = x.selectExpr("row_key", "day", "text", "download_time", "toks",
                     "filter(toks, t -> t.val IS NULL) AS bad")
    items = x.selectExpr(
        "row_key", "day", "download_time",
        "CASE WHEN size(bad) > 0 THEN named_struct('reason', 'bad_subfield', "
        "'source_field', bad[0].key, 'raw', bad[0].raw) END AS reject", "toks")
    cells = items.selectExpr(
        "row_key", "day", "download_time",
        "posexplode_outer(CASE WHEN reject IS NULL THEN toks END) AS (put_seq, t)")
    cells = cells.where("put_seq IS NOT NULL").selectExpr(
        "row_key", "t.name AS family", "day AS qualifier",
        *[f"t.val.{n} AS {n}" for n, _ in CELL_FIELDS[2:]],
        "download_time", "row_key AS source_key", "0 AS item_pos", "CAST(put_seq AS INT) AS put_seq",
        "0 AS source_no")
    rejects = items.where("reject IS NOT NULL").selectExpr(
        "row_key AS source_key", "day AS page_model", "0 AS item_pos",
        "reject.source_field AS source_field", "reject.raw AS raw", "reject.reason AS reason")
    return CleanResult(items=items, cells=cells, rejects=rejects)
