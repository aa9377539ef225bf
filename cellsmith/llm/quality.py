"""Quality rules with host-level verdicts (DataFrame functions only).

Each document is measured and held against rules. The share of a host's
documents that fail is shrunk towards all hosts' mean by a beta prior whose two
parameters come from the hosts themselves (method of moments). A host whose
shrunk rate exceeds ``max_host_rate`` is rejected with all its documents; of the
other hosts, the documents that fail a rule go.

Defined cases: a null text has no words (it fails); an empty text too; the null
host gathers documents that name none: it enters the prior but is never
rejected as a host; repeated rows are judged alike; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import WORD, cut

_REPEAT = 8


def measured(docs: DataFrame, text: Column, keep: dict[str, Column]) -> DataFrame:
    """``keep``'s columns and the measures of ``text``, one row a document.

    Every layer is a projection over the arrays of the layer before; there is
    no shuffle and nothing leaves the row.
    """
    names = list(keep)
    df = docs.select(*[c.alias(k) for k, c in keep.items()], F.coalesce(text, F.lit("")).alias("t"))
    df = df.select(
        *names,
        F.regexp_extract_all("t", F.lit(f"({WORD})"), F.lit(1)).alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
    df = df.select(
        *names, "n_symbols", "n_upper", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
    rest = [*names, "n_symbols", "n_upper", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    runs = F.transform(F.sequence(F.lit(0), F.size("wh") - _REPEAT),
                       lambda i: F.xxhash64(*[F.get("wh", i + j) for j in range(_REPEAT)]))
    df = df.select(*rest, F.when(F.size("wh") >= _REPEAT, runs).alias("runs"))
    twice = F.size("runs") > F.size(F.array_distinct("runs"))
    df = df.select(*rest, F.when(twice, F.sort_array(F.transform(
        "runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("by_hash"))
    repeated = F.filter("by_hash", lambda s, k: (F.get("by_hash", k - 1)["h"] == s["h"])
                        | (F.get("by_hash", k + 1)["h"] == s["h"]))
    df = df.select(*rest, F.sort_array(F.transform(repeated, lambda s: s["i"])).alias("at"))
    # a repeated run covers its words up to the next repeated run's start
    covered = F.aggregate(
        F.transform("at", lambda i, k: F.coalesce(F.least(F.get("at", k + 1) - i, F.lit(_REPEAT)), F.lit(_REPEAT))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(*rest, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_failed() -> Column:
    """The base rule, or symbols (over 3 in 10 words), capitals (over 2 in 5 of
    the words' characters) or repeated lines (over half of the lines)."""
    return (base_failed() | (10 * F.col("n_symbols") > 3 * F.col("n_words"))
            | (5 * F.col("n_upper") > 2 * F.col("word_chars"))
            | (2 * F.col("n_dup_lines") > F.col("n_lines")))


def host_rates(flags: DataFrame) -> DataFrame:
    """From (host, failed): host, n, k and ``rate``, the shrunk failure rate.

    Prior: mean m and between-host variance v of the rates, weighted by n, less
    the binomial noise expected at m; strength s = m(1-m)/v - 1 (all weight on
    the prior where v is 0). rate = (k + s*m) / (n + s). Documents are summed
    per host before the shuffle; only the prior's sums reach the driver.
    """
    hosts = cut(flags.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("k")), "hosts")
    r = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("h")).first()
    if not r["n"]:
        return hosts.withColumn("rate", F.lit(0.0))
    m = r["k"] / r["n"]
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - m, 2))).first()[0] / r["n"]
    v = max(spread - m * (1 - m) * r["h"] / r["n"], 0.0)
    if m in (0.0, 1.0) or v == 0.0:
        return hosts.withColumn("rate", F.lit(m))
    s = max(m * (1 - m) / v - 1, 0.0)
    return hosts.withColumn("rate", (F.col("k") + s * m) / (F.col("n") + s))


def judged(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           host_col: str = "source", max_host_rate: float = 0.6) -> DataFrame:
    """Per document: doc_id, the measures, base_failed, rule_failed, host_rate, kept."""
    m = measured(docs, F.col(text_col), {"doc_id": F.col(id_col), "host": F.col(host_col)})
    m = cut(m.withColumn("base_failed", base_failed()).withColumn("failed", rule_failed()), "measures")
    h = host_rates(m).select(F.col("host").alias("h"), "rate")
    out = m.join(h, m["host"].eqNullSafe(h["h"]))
    bad_host = F.col("h").isNotNull() & (F.col("rate") > max_host_rate)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("failed").alias("rule_failed"), F.col("rate").alias("host_rate"),
        (~F.col("failed") & ~bad_host).alias("kept"))


def keep_good(docs: DataFrame, *, text_col: str = "text", host_col: str = "source",
              max_host_rate: float = 0.6) -> DataFrame:
    """The documents that the rules keep, all columns.

    The flags of the first pass give the hosts' rates; the texts are read a
    second time and only rejected hosts are joined, so texts move only if that
    list is too long to broadcast.
    """
    flags = cut(measured(docs, F.col(text_col), {"host": F.col(host_col)})
                .select("host", rule_failed().alias("failed")), "flags")
    bad = cut(host_rates(flags).where(F.col("host").isNotNull() & (F.col("rate") > max_host_rate))
              .select("host"), "bad_hosts")
    rows = docs.select(F.struct("*").alias("row"))
    m = measured(rows, F.col(f"row.`{text_col}`"), {"row": F.col("row"), "host": F.col(f"row.`{host_col}`")})
    # The verdict goes through a generator and is filtered on its output: a filter on
    # the measures would be pushed below their layers and repeat all of them.
    good = m.select("host", F.explode_outer(F.when(~rule_failed(), F.array("row"))).alias("row"))
    return good.where(F.col("row").isNotNull()).join(bad, "host", "left_anti").select("row.*")
