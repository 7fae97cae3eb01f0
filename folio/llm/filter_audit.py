"""Filter interaction audit: what each filter removes, repeats and loses in every order of application.

Every filter has one stored table of the rows that it fails (its failing-id relation).  A prefix of an order
matters only as the set of its filters, so each set of filters is one relation, not each of the n! orders:

* survivors of a set: all rows left-anti the failing ids of its filters;
* removed by filter f after a set: the failing ids of f left-anti those of the set's filters;
* redundant at f after a set: the failing ids of f left-semi those of the set's filters.

Rows meet by row key, in partitions made once by that key and before the sets are expanded, so that no expanded
row is shuffled; parts are counted with partial aggregation, so a part with a third of all rows is no hot task.
The orders are read off the counted sets, a table of (parts x sets) rows.

Defined cases: null text is empty; a null part is the empty string.  Rows count as often as they occur, also
when they share an id: each is judged on its own text.  A null id is smaller than none and takes no label; no
row fails E because of it.  Of several label rows of an id, one with the value 1 is enough.  An empty table
gives no rows.  Other columns, of any name, are disregarded.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
COPIES = "E"  # fails rows whose text a smaller id has too; the others look at one text alone


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text: few words, repetitive, upper case, symbols."""
    words = F.array_remove(F.split(text, "[ \\t-\\r]+"), "")
    n = F.size(words).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           part_col: str = "source") -> DataFrame:
    """A row per document, stored: row key, id, part, labels, digest of the text and the text filters' findings."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    rows = rows.select(F.xxhash64("t", "id").alias("row"), "id", "part", F.sha2("t", 256).alias("sha"),
                       *[c.alias(f) for f, c in text_filters(F.col("t")).items()])
    one = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")]
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(*one)
    return stored(rows.join(known, "id", "left").fillna(0, ["quality", "toxic"]), "audit-judged")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One stored table for each filter: row key, id, part and labels of the rows that fail it."""
    out = {}
    # of each text the row with the least id passes E; rows meet it by row key, which no group of copies shares
    first = (rows.where(F.col("id").isNotNull()).groupBy("sha").agg(F.min(F.struct("id", "row")).alias("f"))
             .select(F.col("f.row").alias("r"), F.col("f.id").alias("i")))
    for f in FILTERS:
        if f == COPIES:
            known = rows.where(F.col("id").isNotNull())
            failing = known.join(first, (known.row == first.r) & (known.id == first.i), "left_anti")
        else:
            failing = rows.where(F.col(f))
        out[f] = stored(failing.select("row", "id", "part", "quality", "toxic"), f"audit-{f}")
    return out


def _meets(left: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """``left`` rows semi or anti the failing ids of the filters in their set ``done``."""
    m = marks.select(F.col("row").alias("r"), F.col("id").alias("i"), F.col("bit").alias("b"))
    same = (left.row == m.r) & left.id.eqNullSafe(m.i) & (left.done.bitwiseAND(m.b) != 0)
    return left.join(m, same, how)


def prefix_counts(rows: DataFrame, failing: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Stored counts: survivors by (part, done) and removals by (part, done, bit); sets are bit masks."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = [t.withColumn("bit", F.lit(1 << k)) for k, t in enumerate(failing.values())]
    fails = reduce(DataFrame.unionByName, tables).repartition(parts, "row")
    marks = fails.select("row", "id", "bit").dropDuplicates()
    sets = F.sequence(F.lit(0), F.lit((1 << len(failing)) - 1))

    every = (rows.select("row", "id", "part").repartition(parts, "row")
             .withColumn("done", F.explode(sets)))
    survivors = _meets(every, marks, "left_anti").groupBy("part", "done").agg(F.count(F.lit(1)).alias("n"))

    each = fails.withColumn("done", F.explode(F.filter(sets, lambda s: s.bitwiseAND(F.col("bit")) == 0)))
    by = ["part", "done", "bit"]
    removed = _meets(each, marks, "left_anti").groupBy(*by).agg(
        F.count(F.lit(1)).alias("removed"), F.sum("quality").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
    redundant = _meets(each, marks, "left_semi").groupBy(*by).agg(F.count(F.lit(1)).alias("redundant"))
    steps = removed.join(redundant, by, "full").fillna(0, ["removed", "good_lost", "toxic_lost", "redundant"])
    return stored(survivors, "audit-survivors"), stored(steps, "audit-steps")


def _orders(filters: str) -> Column:
    """Every order's steps as an array of (filter_order, step, bit, before, after)."""
    out = []
    for order in permutations(filters):
        before = 0
        for k, f in enumerate(order):
            bit = 1 << filters.index(f)
            out.append({"filter_order": "".join(order), "step": k + 1, "bit": bit, "before": before, "after": before | bit})
            before |= bit
    return F.from_json(F.lit(json.dumps(out)), "array<struct<filter_order:string,step:int,bit:int,before:int,after:int>>")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """A row for each part, order of the filters and step, zeros included."""
    rows = judged(docs, labels, id_col, text_col, part_col)
    survivors, steps = prefix_counts(rows, failing_ids(rows))
    n = len(FILTERS)
    others = F.lit((1 << n) - 1) - F.col("bit")
    size = F.bit_count("done")
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), size + 1)
    by_filter = steps.groupBy("part", "bit").agg(
        F.sum(F.when(F.col("done") == others, F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"))
    plan = (rows.select("part").distinct().select("part", F.inline(_orders(FILTERS))))
    out = (plan.join(survivors.select("part", F.col("done").alias("after"), F.col("n").alias("kept")), ["part", "after"], "left")
           .join(steps.withColumnRenamed("done", "before"), ["part", "before", "bit"], "left")
           .join(by_filter, ["part", "bit"], "left"))
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return out.select("part", "filter_order", "step",
                      *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in counts])
