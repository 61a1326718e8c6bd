"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words its source has sent up to and with
it, in shuffled order, divided by the source's target. All documents are then range-sorted
by that time and the mix ends where its words reach the total budget. A source that is too
small for its target is sent again, in the same order, up to three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm.running import running_total
from hearthlake.llm.words import word_count
from hearthlake.session import Staging

#: A document is sent at most so often.
MOST_EPOCHS = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix"


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source of (source, source_size): place, weight, target.

    Sources share the total by weight; none is asked for more than ``MOST_EPOCHS`` times
    its size, and what it leaves is shared by the others. In order of size per weight the
    capped sources come first, so one pass of running sums finds them. The table has one
    row per source and is ordered in one place. All sizes 0: every target is 0.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(named).cast("bigint"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("bigint")).withColumn("most", F.col("source_size") * MOST_EPOCHS)
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before, after = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.sum("source_size").over(Window.partitionBy(F.lit(0))) - F.coalesce(F.sum("most").over(before), F.lit(0))
    ranked = ranked.withColumn("rest", rest).withColumn("rest_weight", F.sum("weight").over(after))
    full = F.col("most").cast("double") * F.col("rest_weight") <= F.col("rest").cast("double") * F.col("weight")
    shared = Window.partitionBy(F.lit(0))
    ranked = ranked.withColumn("full", full)
    ranked = ranked.withColumn("left", F.max(F.when(~F.col("full"), F.col("rest"))).over(shared))
    ranked = ranked.withColumn("left_weight", F.max(F.when(~F.col("full"), F.col("rest_weight"))).over(shared))
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        (F.col("left") * F.col("weight")).cast("double") / F.col("left_weight").cast("double")
    )
    return ranked.select("source", "source_size", "place", "weight", target.alias("target"))


def mix(staging: Staging, docs: DataFrame) -> DataFrame:
    """How often each document is in the mix.

    ``docs`` has doc_id, source and size (words). Returns one row per distinct (doc_id,
    source, size): these, ``rows`` (how many rows were equal), source_size, target and
    ``copies`` (0 to 3). Rows with the same id, source and size are sent one after the other and
    share their ``copies``; ids, sources or both may be null. Documents of size 0 take
    nothing and are kept as long as the mix runs when their turn comes. The order within a
    source is that of md5(seed, id), so reruns agree. Documents stay whole: a source ends
    within a document of its target. An empty table gives no row.
    """
    units = docs.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    units = units.withColumn("mass", F.col("size") * F.col("rows"))
    units = staging.keep(units, "units")
    targets = staging.keep(source_targets(units.groupBy("source").agg(F.sum("mass").alias("source_size"))), "targets")
    keyed = units.withColumn("turn", F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    sent = running_total(staging, keyed, ["source", "turn", "doc_id", "size"], "mass", "sent", group="source")
    timed = sent.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.doc_id", "d.source", "d.size", "d.rows", "d.mass", "d.turn", "t.source_size", "t.target", "t.place", "sent"
    )
    timed = staging.keep(timed, "timed")

    def finish(epoch):
        sent_then = (F.col("sent") + epoch * F.col("source_size")).cast("double")
        return F.when(F.col("target") > 0, sent_then / F.col("target")).otherwise(F.lit(0.0))

    epochs = F.when(F.col("target") > 0, F.ceil(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    queue = timed.withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.least(epochs, F.lit(MOST_EPOCHS)) - 1).cast("int"))))
    queue = queue.select(finish(F.col("epoch")).alias("finish"), "place", F.col("sent").alias("own"), "turn", "mass")
    total = running_total(staging, queue, ["finish", "place", "own", "turn"], "mass", "total")
    budget = targets.agg(F.round(F.sum("target")).cast("bigint")).first()[0] or 0
    cut = total.filter(F.col("total") <= budget).agg(F.max(F.struct("finish", "place", "own", "turn")).alias("cut")).first()[0]
    if cut is None:
        return timed.select("doc_id", "source", "size", "rows", "source_size", "target", F.lit(0).alias("copies"))

    last = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["place"]).alias("place"), F.lit(cut["own"]).alias("own"), F.lit(cut["turn"]).alias("turn"))
    taken = sum(
        F.when((epochs > e) & (F.struct(finish(F.lit(e)).alias("finish"), "place", F.col("sent").alias("own"), "turn") <= last), 1).otherwise(0)
        for e in range(MOST_EPOCHS)
    )
    return timed.select("doc_id", "source", "size", "rows", "source_size", "target", taken.alias("copies"))


def mix_report(staging: Staging, documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    mixed = mix(staging, documents.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    each = mixed.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(staging: Staging, documents: DataFrame) -> DataFrame:
    """The documents of the mix, all columns, repeated as often as the mix takes them."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    packed = documents.select(row, word_count(F.col("text")).alias("words"))
    units = packed.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.col("words").alias("size"))
    taken = mix(staging, units).filter("copies > 0").select("doc_id", "source", "size", "copies")
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    each = packed.join(taken, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("row.*")


SQL = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, 3 * source_size AS most FROM sources
), weighted AS (
  SELECT *, (place - 1) % 3 + 1 AS weight FROM ranked
), room AS (
  SELECT *,
    (sum(source_size) OVER ())::BIGINT
      - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
    (sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest_weight
  FROM weighted
), filled AS (
  SELECT *, most::DOUBLE * rest_weight <= rest::DOUBLE * weight AS is_full FROM room
), levels AS (
  SELECT *, max(CASE WHEN NOT is_full THEN rest END) OVER () AS left_words,
    max(CASE WHEN NOT is_full THEN rest_weight END) OVER () AS left_weight FROM filled
), targets AS (
  SELECT source, source_size, place,
    CASE WHEN is_full THEN most::DOUBLE ELSE (left_words * weight)::DOUBLE / left_weight::DOUBLE END AS target FROM levels
), sent AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place, md5('mix:' || d.doc_id::VARCHAR) AS turn,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id::VARCHAR), d.doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS sent
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), queue AS (
  SELECT doc_id, size, (sent + e * source_size)::DOUBLE / target AS finish, place, sent, turn
  FROM sent, (SELECT unnest([0, 1, 2]) AS e) WHERE e < ceil(target / source_size) AND target > 0
), total AS (
  SELECT *, (sum(size) OVER (ORDER BY finish, place, sent, turn ROWS UNBOUNDED PRECEDING))::BIGINT AS total FROM queue
), copies AS (
  SELECT doc_id, count(*) AS copies FROM total WHERE total <= (SELECT round(sum(target))::BIGINT FROM targets) GROUP BY doc_id
)
SELECT s.doc_id, s.size, s.source_size, s.target, (s.size * coalesce(c.copies, 0))::BIGINT AS taken
FROM sent s LEFT JOIN copies c ON s.doc_id = c.doc_id
"""
