"""A mixture of sources at target weights: each source is cut at its exact budget of words in a hash-random order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutlight.llm.scratch import materialise

#: Weights of the sources in code-point order, repeating; words of the mix for each word there is; most copies of a word.
WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2
#: Rows of one source that one range of keys should get.
RANGE_ROWS = 2_000
WORD = r"[^\x20\x09-\x0D]+"


def _tag(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size, key, tag (a hash of the text): size in words (null text: 0), key the hash-random place within the source."""
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), key.alias("key"), _tag(text_col).alias("tag"))


def targets(per_source: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """per_source (source, source_size) with target: the share of all words by weight, at most epochs times the source.

    What a source cannot take is shared among the others by weight until none is above its bound. In order of bound per
    weight, a source is at its bound exactly if giving all that is left at that rate would reach the bound. The rows are
    as many as there are sources, so these windows need no partitions.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (at + 1).cast("int"))
    x = per_source.withColumn("w", w).withColumn("bound", (epochs * F.col("source_size")).cast("double"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tightest = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    x = x.withColumn("total", F.sum("source_size").over(everything) * share)
    x = x.withColumn("before", F.coalesce(F.sum("bound").over(tightest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    x = x.withColumn("w_left", F.sum("w").over(tightest.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    x = x.withColumn("open", F.col("before") + F.col("bound") / F.col("w") * F.col("w_left") > F.col("total"))
    x = x.withColumn("level", F.min(F.when(F.col("open"), F.struct("before", "w_left"))).over(everything))
    target = F.when(F.col("open"), F.col("w") * ((F.col("total") - F.col("level.before")) / F.col("level.w_left"))).otherwise(F.col("bound"))
    return x.select("source", "source_size", F.least("bound", target).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """One row per row of docs: doc_id, source, tag, size, source_size, target, taken, full (whole copies), part (words of a last, cut copy).

    Each source is read in the order of hash-random keys, from the beginning again when it ends, up to its target. The
    prefix sums are distributed: keys are cut into equal ranges (they are uniform, so a hot source falls into as many
    even ranges as it needs), ranges are summed, and rows are summed within their range. Null texts have size 0 and are
    never taken; a null source is a source of its own; rows that repeat a doc_id are ordered by size among themselves.
    """
    rows = materialise(sizes(docs, id_col, text_col, source_col), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    most = per_source.agg(F.max("n")).first()[0] or 0
    ranges = max(1, min(1 << 20, -(-most // RANGE_ROWS)))
    goal = targets(per_source.select("source", "source_size"), **shares)

    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    rows = rows.withColumn("range", F.floor(place * ranges / (1 << 32)).cast("int"))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("range_size").over(upto), F.lit(0)))
    plan = sums.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(F.col("source").alias("of"), F.col("range").alias("of_range"), "offset", "source_size", "target")
    within = Window.partitionBy("source", "range").orderBy("key", "size", "tag").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range")))
    budget = F.round("target").cast("bigint")
    turns = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rows = rows.withColumn("turns", turns).withColumn("left", budget - F.col("turns") * F.col("source_size") - F.col("offset") - F.col("inside"))
    last = F.greatest(F.lit(0), F.least("size", "left"))
    whole = F.when((last == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)
    return rows.select(
        "doc_id", "source", "tag", "size", "source_size", "target", (F.col("turns") * F.col("size") + last).alias("taken"),
        F.when(F.col("size") > 0, F.col("turns") + whole).otherwise(F.lit(0)).alias("full"), F.when(whole == 1, F.lit(0)).otherwise(last).alias("part"),
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """The mixture itself: rows of docs with all their columns, once for each copy taken.

    The one row at which a source's budget ends keeps its first words only (n_chars follows, where docs has it). Rows are
    matched by doc_id, source and text; rows that agree in all three stand in for one another.
    """
    taken = materialise(mix(docs, id_col, text_col, source_col, **shares).where("full > 0 or part > 0"), "taken")
    # the row as it is in one column, so that its names cannot meet those of the columns beside it
    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row")
    keyed = docs.select(whole, docs[id_col].cast("bigint").alias("id"), docs[source_col].cast("string").alias("source"), _tag(text_col).alias("tag"))
    plan = taken.groupBy("doc_id", F.col("source").alias("of_source"), F.col("tag").alias("of_tag")).agg(F.sort_array(F.collect_list(F.struct("full", "part")), asc=False).alias("takes"))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("tag") == F.col("of_tag"))
    one = keyed.join(plan.where(F.size("takes") == 1), on).select("row", F.col("takes")[0].alias("take"))
    several = plan.where(F.size("takes") > 1)
    if not several.isEmpty():
        nth = F.row_number().over(Window.partitionBy("id", "source", "tag").orderBy(F.xxhash64("row")))
        more = keyed.join(several, on).withColumn("n", nth)
        one = one.unionByName(more.select("row", F.get("takes", F.col("n") - 1).alias("take")).where("take is not null"))
    copies = F.array_repeat(F.lit(False), F.col("take.full").cast("int"))
    cut = F.when(F.col("take.part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    out = one.withColumn("cut", F.explode(F.concat(copies, cut)))
    field = F.col("row").getField
    first = F.array_join(F.slice(F.regexp_extract_all(field(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), F.col("take.part").cast("int")), "")
    text = F.when(F.col("cut"), first).otherwise(field(text_col))
    as_it_is = {c: field(c) for c in docs.columns}
    as_it_is[text_col] = text
    if "n_chars" in docs.columns:
        as_it_is["n_chars"] = F.when(F.col("cut"), F.length(text).cast("bigint")).otherwise(field("n_chars"))
    return out.select(*[v.alias(c) for c, v in as_it_is.items()])


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][((i - 1) % 3) + 1] AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS b, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s
), l AS (
  SELECT *, coalesce(sum(b) OVER (ORDER BY b / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (ORDER BY b / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM w
), o AS (SELECT *, before + b / w * w_left > total AS open FROM l),
t AS (
  SELECT source, source_size, least(b, CASE WHEN open THEN w * ((total - (SELECT min(before) FROM o WHERE open)) / (SELECT max(w_left) FROM o WHERE open)) ELSE b END) AS target FROM o
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(target) AS BIGINT) AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size + greatest(0, least(size, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - p)) AS BIGINT) AS taken
FROM r
"""
