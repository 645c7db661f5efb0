"""Mixing sources to target weights by capped water-filling.

Sources get shares of a word budget in proportion to their weights; a source
whose share exceeds ``max_epochs`` times its size is clamped there and the
excess goes to the others by weight, until no share is above its clamp.  A
source then takes every document floor(target / size) times, and a seeded
sample of its documents once more, whose sizes make up the rest.

Everything is a DataFrame plan.  Only the per-source totals meet in one place
(one row a source); documents are never gathered by source: the sample is a
threshold on a seeded hash, found from per-(source, hash bucket) sums, and
only the bucket that the threshold falls into is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotide.llm._frames import by_position, durable, project

WORD = r"[^\x20\x09-\x0D]+"
#: A bucket is named by as many hex digits of the seeded hash as leave about this many documents in each, LEAST_DIGITS at least.
BUCKET_ROWS, LEAST_DIGITS = 1 << 15, 3
#: Sources up to this many rows (one small row each) may be broadcast to the document scan.
BROADCAST_SOURCES = 20_000
#: Copies of each source's row when there are too many to broadcast: spreads a hot source's documents.
SALT = 32


def word_count(text: Column) -> Column:
    """Number of words as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Column, max_epochs: int = 3, budget: int | None = None) -> DataFrame:
    """Adds ``target`` (double) to a table of one row a source: source, source_size.

    Water-filling in the order in which sources saturate (clamp / weight): a
    source is clamped if its proportional share of what is left exceeds its
    clamp, and once one is not, none after it is.  Exact integers until the
    last division.
    """
    cap = F.col("source_size") * max_epochs
    all_, order = Window.partitionBy(), Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(all_) if budget is None else F.lit(budget)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    w_left = F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0))
    clamped = F.col("left").cast("decimal(38,0)") * F.col("w") >= F.col("cap").cast("decimal(38,0)") * F.col("w_left")
    out = sizes.select("source", "source_size", weights.cast("long").alias("w"), cap.cast("long").alias("cap"))
    out = out.withColumn("total", total).withColumn("left", left).withColumn("w_left", w_left).withColumn("clamped", clamped)
    # what the clamped ones leave to the others, and the others' weights
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(all_), F.lit(0))
    rest_w = F.coalesce(F.sum(F.when(~F.col("clamped"), F.col("w"))).over(all_), F.lit(1))
    share = (rest * F.col("w")).cast("double") / rest_w.cast("double")
    return out.withColumn("share", share).select(
        "source", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("share")).alias("target")
    )


def cyclic_weights() -> Column:
    """1, 2, 3, 1, ... over the sources in code point order, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return (rank - 1) % 3 + 1


def _onto(docs: DataFrame, small: DataFrame, n: int) -> DataFrame:
    """``docs`` with the columns of a one-row-a-source table; null is a source of its own."""
    cond = docs["source"].eqNullSafe(small["source"])
    if n <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(small), cond).drop(small["source"])
    salted = docs.withColumn("_salt", F.pmod(F.hash("doc_id", "u"), F.lit(SALT)))
    wide = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return salted.join(wide, salted["source"].eqNullSafe(wide["source"]) & (salted["_salt"] == wide["_salt"])).drop(wide["source"], "_salt")


def mix(docs: DataFrame, seed: int = 17, max_epochs: int = 3, weights: Column | None = None, budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken), one row for each input row.

    ``copies`` is how often the mix takes the document, ``taken`` its words
    times that.  The share of a source beyond whole copies goes to the
    documents with the smallest seeded hash of their id (ties: text hash),
    as many as fit, and then to the document that comes closest to what is
    still missing, if that brings the sum closer.  So a source misses its
    target by at most half of its largest document, and far less where it has
    small ones.  Null or empty texts have size 0 and are taken 0 words; a
    null source is one source; documents of size 0 are not taken; identical
    rows get the same place in the order and are told apart only by that
    order; null ids hash alike and are told apart by their texts.  Extra
    columns, with any names, are ignored; empty input gives no rows.
    """
    d = project(docs, {"doc_id": id_col, "text": text_col, "source": source_col})
    u = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    tie = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    d = d.select(F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size"), u.alias("u"), tie.alias("tie"))
    d = durable(d)
    digits = LEAST_DIGITS
    n_docs = d.count()
    while n_docs > BUCKET_ROWS * 16**digits:
        digits += 1
    d = d.withColumn("b", F.substring("u", 1, digits))

    buckets = durable(d.groupBy("source", "b").agg(F.sum("size").alias("b_size")))
    per_source = buckets.groupBy("source").agg(F.sum("b_size").alias("source_size"))
    plan = targets(per_source, cyclic_weights() if weights is None else weights, max_epochs, budget)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("rest", F.when(size > 0, F.col("target") - F.col("whole") * size).otherwise(F.lit(0.0)))
    plan = durable(plan)
    n = plan.count()

    # the bucket in which the running sum passes the rest
    up_to = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    run = buckets.withColumn("upto", F.sum("b_size").over(up_to))
    run = _onto(run.withColumn("u", F.col("b")).withColumn("doc_id", F.lit(0)), plan.select("source", "rest"), n)
    cut = run.groupBy("source").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.col("b"))).alias("cut_b"),
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))), F.lit(0)).alias("below"),
    )
    plan = durable(plan.join(cut, plan["source"].eqNullSafe(cut["source"]), "left").drop(cut["source"]))

    rich = _onto(d, plan, n)
    inside = rich.filter(F.col("b") == F.col("cut_b"))
    order = Window.partitionBy("source").orderBy("u", "tie", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("below") + F.sum("size").over(order)).withColumn("place", F.row_number().over(order))
    head = inside.filter(F.col("upto") <= F.col("rest")).groupBy("source").agg(F.max("upto").alias("got"), F.max("place").alias("places"))
    plan = plan.join(head, plan["source"].eqNullSafe(head["source"]), "left").drop(head["source"])
    plan = durable(plan.withColumn("got", F.coalesce("got", "below")).withColumn("places", F.coalesce("places", F.lit(0))))

    rich = _onto(d, plan, n)
    at_cut = F.coalesce(F.col("b") == F.col("cut_b"), F.lit(False))
    place = F.row_number().over(Window.partitionBy("source").orderBy("u", "tie", "size"))
    first = rich.filter(~at_cut).withColumn("extra", F.coalesce(F.col("b") < F.col("cut_b"), F.lit(True)) & (F.col("rest") > 0))
    first = first.unionByName(rich.filter(at_cut).withColumn("extra", place <= F.col("places")))
    gap = F.col("rest") - F.col("got")
    last = first.filter(~F.col("extra") & (F.col("size") > 0) & (F.abs(F.col("size") - gap) < gap)).groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("size") - gap).alias("off"), F.col("u"), F.col("tie"), F.col("size"))).alias("last")
    )
    last = durable(last)
    out = _onto_left(first, last, n)
    same = (F.col("last.u") == F.col("u")) & (F.col("last.tie") == F.col("tie")) & (F.col("last.size") == F.col("size")) & ~F.col("extra")
    out = out.withColumn("same", F.coalesce(same, F.lit(False)))
    once = F.row_number().over(Window.partitionBy("source", "u", "tie").orderBy("size")) == 1  # of identical rows one
    picked = out.filter("same").withColumn("one", once)
    out = out.filter(~F.col("same")).withColumn("one", F.lit(False)).unionByName(picked)
    copies = F.col("whole") + F.when(F.col("extra") | F.col("one"), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return out.select("doc_id", "size", "source", "source_size", "target", copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "tie")


def _onto_left(docs: DataFrame, small: DataFrame, n: int) -> DataFrame:
    cond = docs["source"].eqNullSafe(small["source"])
    if n <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(small), cond, "left").drop(small["source"])
    salted = docs.withColumn("_salt", F.pmod(F.hash("doc_id", "u"), F.lit(SALT)))
    wide = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return salted.join(wide, salted["source"].eqNullSafe(wide["source"]) & (salted["_salt"] == wide["_salt"]), "left").drop(wide["source"], wide["_salt"]).drop("_salt")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs``, all columns, as the mix has them: each row as often as it is taken.

    Null and empty texts have no words and are not taken; null ids and sources
    count as values.  Rows that agree in id and text are interchangeable, and
    their copies are shared out among them.  Extra columns may have any names,
    also ones that clash; an empty table gives no rows.
    """
    plain, (key, text, _) = by_position(docs, id_col, text_col, source_col)
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    plan = durable(plan.select(F.col("doc_id").alias("id"), "tie", "copies"))
    left = plain.withColumn("own_id", F.col(key).cast("long")).withColumn("own_tie", F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    cond = left["own_id"].eqNullSafe(plan["id"]) & (left["own_tie"] == plan["tie"])
    number = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(by[0]))
    if plan.groupBy("id", "tie").count().filter("count > 1").limit(1).count():
        left = left.withColumn("own_n", number("own_id", "own_tie"))
        plan = plan.withColumn("n", number("id", "tie"))
        cond = left["own_id"].eqNullSafe(plan["id"]) & (left["own_tie"] == plan["tie"]) & (left["own_n"] == plan["n"])
    joined = left.join(plan.filter("copies > 0"), cond)
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*plain.columns).toDF(*docs.columns)


def op1(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
