"""Requests, costs, stage states and what is left to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Dollars a million tokens: new input, cached input, output.
RATES = (0.10, 0.01, 0.50)


def cost(requests: DataFrame, rates: tuple[float, float, float] = RATES) -> DataFrame:
    """Tokens and dollars by title and provider, by title, and in all (rollup): cached tokens are part of the prompt and charged once."""
    fresh = F.greatest(F.col("prompt") - F.col("cached"), F.lit(0))
    x = requests.withColumn("usd", (fresh * rates[0] + F.col("cached") * rates[1] + F.col("output") * rates[2]) / 1e6)
    out = x.rollup("movie_id", "provider").agg(F.count(F.lit(1)).alias("requests"), F.sum("prompt").alias("prompt"), F.sum("cached").alias("cached"), F.sum("output").alias("output"), F.sum("usd").alias("usd"))
    return out


def dominant_failure(failures: DataFrame, keys: list[str]) -> DataFrame:
    """The commonest (code, message) of each group; of equals the one seen first. failures: keys, ord, code, message."""
    g = failures.groupBy(*keys, "code", "message").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    return g.groupBy(*keys).agg(F.max_by(F.struct("code", "message", "n"), F.struct("n", -F.col("first"))).alias("t")).select(*keys, "t.*")


def redact(text: Column, secrets: list[str] | None = None) -> Column:
    """text with sk- keys and the given secrets blotted out."""
    out = F.regexp_replace(text, r"sk-[A-Za-z0-9_-]+", "[REDACTED]")
    for s in secrets or []:
        out = F.replace(out, F.lit(s), F.lit("[REDACTED]"))
    return out


def classify_error(message: Column) -> Column:
    """struct(reason, retryable, retry_after, quota) of a provider's error message; its status and delay are read from the text."""
    status = F.regexp_extract(message, r"status (\d+)", 1).try_cast("int")
    delay = F.regexp_extract(message, r"retry after (\d+) s", 1)
    reason = F.when(status.isin(401, 403), "AUTHENTICATION").when(status == 429, "RATE_LIMIT").when(status >= 500, "SERVER").when(status >= 400, "INVALID_REQUEST").when(status.isNotNull(), "NONE").otherwise("UNKNOWN")
    again = status.isin(429) | (status >= 500)
    return F.struct(reason.alias("reason"), F.coalesce(again, F.lit(False)).alias("retryable"), F.when(again & (delay != ""), delay.try_cast("bigint")).alias("retry_after"), F.coalesce(status == 429, F.lit(False)).alias("quota"))


def capacity_batches(rows: DataFrame, order: list[str], limits: dict[str, int], most: int) -> DataFrame:
    """rows with batch, from 1: filled in order until the next row would exceed most rows or a limit; what exceeds a limit alone is batch 0.

    The fill depends on all rows before, so it is a fold over the rows of a title.
    """
    names = list(limits)
    over = F.greatest(*[F.coalesce((F.col(c) > limits[c]).cast("int"), F.lit(0)) for c in names], F.lit(0)) == 1
    key = F.struct(*order, *[F.col(c).cast("bigint").alias(f"_{c}") for c in names])
    fit = rows.where(~over).groupBy("movie_id").agg(F.sort_array(F.collect_list(key)).alias("rows"))
    fields = "".join(f",s{i}:bigint" for i in range(len(names)))
    kind = f"struct<b:int,n:int{fields},out:array<int>>"
    zeros = "".join(f',"s{i}":0' for i in range(len(names)))
    start = F.from_json(F.lit('{"b":1,"n":0' + zeros + ',"out":[]}'), kind)

    def step(s: Column, r: Column) -> Column:
        full = s["n"] + 1 > most
        for i, c in enumerate(names):
            full = full | (s[f"s{i}"] + r[f"_{c}"] > limits[c])
        b = F.when(full, s["b"] + 1).otherwise(s["b"])
        sums = [F.when(full, r[f"_{c}"]).otherwise(s[f"s{i}"] + r[f"_{c}"]).alias(f"s{i}") for i, c in enumerate(names)]
        return F.struct(b.alias("b"), F.when(full, 1).otherwise(s["n"] + 1).alias("n"), *sums, F.concat(s["out"], F.array(b)).alias("out"))

    got = fit.withColumn("f", F.aggregate("rows", start, step)).select("movie_id", F.explode(F.arrays_zip("rows", F.col("f.out").alias("out"))).alias("z"))
    last = order[-1]
    placed = got.select("movie_id", F.col(f"z.rows.{last}").alias(last), F.col("z.out").cast("bigint").alias("batch"))
    return rows.join(placed, ["movie_id", last], "left").withColumn("batch", F.coalesce("batch", F.lit(0).cast("bigint")))


def request_plan(batches: DataFrame, transports: int = 2) -> DataFrame:
    """Per title: batches, and the requests that retries and bisection can need: transports * sum(2 * size - 1)."""
    sizes = batches.where("batch > 0").groupBy("movie_id", "batch").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("movie_id").agg(F.count(F.lit(1)).alias("batches"), (transports * F.sum(2 * F.col("size") - 1)).alias("ceiling"), F.max("size").alias("largest"))


def stage_state(log: DataFrame, tie: list[str]) -> DataFrame:
    """The state of each stage of each event: what the latest row says, then corrected.

    log: movie_id, event_id, stage, ts_us, status, fingerprint. A COMPLETE stage whose fingerprint is not the event's
    latest one is STALE; one left RUNNING is FAILED_RETRYABLE. Ties of time are broken by the columns of tie.
    """
    at = F.struct("ts_us", *tie)
    latest = log.groupBy("movie_id", "event_id", "stage").agg(F.max_by(F.struct("status", "fingerprint"), at).alias("s"), F.max("ts_us").alias("ts_us"))
    now = log.groupBy("movie_id", "event_id").agg(F.max_by("fingerprint", at).alias("current"))
    x = latest.join(now, ["movie_id", "event_id"])
    status = F.when(F.col("s.status") == "RUNNING", "FAILED_RETRYABLE").when((F.col("s.status") == "COMPLETE") & (F.col("s.fingerprint") != F.col("current")), "STALE").otherwise(F.col("s.status"))
    return x.select("movie_id", "event_id", "stage", status.alias("status"), "ts_us")


def status_report(state: DataFrame) -> DataFrame:
    """Per title: events, stages by state, and events with nothing but COMPLETE stages."""
    per = state.groupBy("movie_id", "event_id").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("COMPLETE", "STALE", "PENDING", "FAILED_RETRYABLE", "FAILED_FINAL")])
    return per.groupBy("movie_id").agg(F.count(F.lit(1)).alias("events"), *[F.sum(s).alias(s) for s in ("complete", "stale", "pending", "failed_retryable", "failed_final")], F.count_if(F.col("complete") == F.col("n")).alias("done"))


def stage_matrix(state: DataFrame, stages: list[str]) -> DataFrame:
    """Per stage: rows in each state."""
    return state.groupBy("stage").pivot("status", ["COMPLETE", "FAILED_FINAL", "FAILED_RETRYABLE", "PENDING", "STALE"]).agg(F.count(F.lit(1))).na.fill(0)


def pipeline_stop(requests: DataFrame) -> DataFrame:
    """Per title: STOPPED_QUOTA, STOPPED_BLOCKED, PARTIAL or COMPLETE, and the events that wait."""
    e = classify_error(F.col("message"))
    x = requests.withColumn("e", e)
    g = x.groupBy("movie_id").agg(F.max(F.col("e.quota").cast("int")).alias("quota"), F.max((F.col("e.reason") == "AUTHENTICATION").cast("int")).alias("blocked"), F.array_sort(F.collect_list(F.when(F.col("e.retryable"), F.col("event_id")))).alias("pending"))
    status = F.when(F.col("quota") == 1, "STOPPED_QUOTA").when(F.col("blocked") == 1, "STOPPED_BLOCKED").when(F.size("pending") > 0, "PARTIAL").otherwise("COMPLETE")
    return g.select("movie_id", status.alias("status"), "pending")


def failure_streaks(log: DataFrame, order: list[str], least: int = 5) -> DataFrame:
    """Runs of at least so many identical failures in a title's log, unbroken by anything else: movie_id, status, started, n."""
    by = Window.partitionBy("movie_id").orderBy(*order)
    x = log.withColumn("_new", F.when(F.lag("status").over(by).eqNullSafe(F.col("status")), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(by))
    runs = x.where(F.col("status").startswith("FAILED")).groupBy("movie_id", "_run", "status").agg(F.count(F.lit(1)).alias("n"), F.min("ts_us").alias("started"))
    return runs.where(F.col("n") >= least).select("movie_id", "status", "started", "n")


def insert_only(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """key, action: what a merge that never changes a row does: INSERT, REUSE (same content), CONFLICT (other content), KEEP."""
    a = current.select("key", F.col("fingerprint").alias("old"))
    b = incoming.select("key", F.col("fingerprint").alias("new"))
    x = a.join(b, "key", "full_outer")
    action = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "KEEP").when(F.col("old") == F.col("new"), "REUSE").otherwise("CONFLICT")
    return x.select("key", action.alias("action"))
