"""Reports over mentions, runs and call logs. Rows that leave here are few; everything is map-side combined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.ranking import global_rank
from weftline.functions.text import half_up, strip

# Class bounds of the reports.
MENTION_CLASSES = ((0, 0), (1, 10), (11, 20), (21, 30), (31, 50), (51, 100), (101, None))
DIFFERENCE_CLASSES = ((None, -51), (-50, -21), (-20, -11), (-10, -6), (-5, -1), (0, 0), (1, 5), (6, 10), (11, 20), (21, 50), (51, None))
LOW_CONFIDENCE = 0.55
BIG_DIFFERENCE = 5
WINDOW_ROWS, JUMP, JUMP_BELOW, DROP, DROP_ABOVE, APART, APART_MERGED = 50, 15.0, 100.0, 2.0, 5.0, 100, 200
BUCKET = 100_000  # rows of a log in one task


def quality_histogram(assessed: DataFrame) -> DataFrame:
    return assessed.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "status")


def skill_frequency(mentions: DataFrame, min_count: int = 1) -> DataFrame:
    """``normalized_lower, n`` of the skill mentions, not canonicalized; nameless ones are left out."""
    candidate = F.col("normalized_candidate")
    name = F.lower(strip(F.coalesce(F.when(candidate != "", candidate), F.col("skill_span"), F.lit(""))))
    return mentions.where("is_skill").groupBy(name.alias("normalized_lower")).agg(F.count("*").alias("n")).where((F.col("normalized_lower") != "") & (F.col("n") >= min_count))


def job_skills(mentions: DataFrame) -> DataFrame:
    """A row per skill mention for the per-job summary."""
    candidate = F.col("normalized_candidate")
    return mentions.where("is_skill").select("job_id", F.coalesce("title_raw", F.lit("")).alias("title_norm"), F.coalesce(F.when(candidate != "", candidate), F.col("skill_span"), F.lit("")).alias("normalized_skill"), "final_confidence", F.coalesce("hard_soft", F.lit("")).alias("hard_soft"), F.coalesce("requirement_level", F.lit("")).alias("requirement_level"))


def low_confidence(mentions: DataFrame, threshold: float = LOW_CONFIDENCE) -> DataFrame:
    """Mentions to look at again: under the threshold, or with an unreadable verdict. A null confidence counts as 1."""
    return mentions.where((F.coalesce("final_confidence", F.lit(1.0)) < threshold) | F.coalesce(F.col("verifier_status") == "parse_failed", F.lit(False)))


def mentions_per_job(jobs: DataFrame, mentions: DataFrame) -> DataFrame:
    """``job_index, n`` of every job, those without mentions too."""
    counted = mentions.groupBy("job_index").agg(F.count("*").alias("n"))
    return jobs.select("job_index").distinct().join(counted, "job_index", "left").select("job_index", F.coalesce("n", F.lit(0)).alias("n"))


def extraction_summary(per_job: DataFrame) -> DataFrame:
    """Totals, mean, median, extremes, zeros, sample deviation and the quartiles by index (not interpolated)."""
    order = Window.partitionBy("one").orderBy("n")
    counts = per_job.groupBy("n").agg(F.count("*").alias("jobs")).withColumn("one", F.lit(1))
    # distinct counts are few, so the running sum over them is small whatever the number of jobs
    placed = counts.withColumn("upto", F.sum("jobs").over(order)).withColumn("total", F.sum("jobs").over(Window.partitionBy("one")))

    def at(index) -> F.Column:
        return F.min(F.when(F.col("upto") > index, F.col("n")))

    mean = F.sum(F.col("n") * F.col("jobs")) / F.sum("jobs")
    squares = F.sum(F.col("n") * F.col("n") * F.col("jobs"))
    total = F.sum("jobs")
    middle = (at(F.floor((F.col("total") - 1) / 2)) + at(F.floor(F.col("total") / 2))) / 2
    variance = (squares - F.sum(F.col("n") * F.col("jobs")) * mean) / F.nullif(total - 1, F.lit(0))
    return placed.agg(
        total.alias("total_jobs"),
        F.sum(F.col("n") * F.col("jobs")).alias("total_mentions"),
        F.round(mean, 4).alias("mean"),
        middle.alias("median"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
        F.coalesce(F.sum(F.when(F.col("n") == 0, F.col("jobs"))), F.lit(0)).alias("zero_jobs"),
        F.round(F.sqrt(variance), 4).alias("stdev"),
        at(F.floor(F.col("total") / 4)).alias("q1"),
        at(F.floor(F.col("total") * 3 / 4)).alias("q3"),
    )


def classes(df: DataFrame, value: str, bounds: tuple) -> DataFrame:
    """``class, low, n`` of every class that occurs."""
    label, low = F.lit(None).cast("string"), F.lit(None).cast("int")
    for i, (a, b) in enumerate(bounds):
        inside = (F.col(value) >= a if a is not None else F.lit(True)) & (F.col(value) <= b if b is not None else F.lit(True))
        name = f"{a}" if a == b else f"{a}+" if b is None else f"{b} or less" if a is None else f"{a} to {b}"
        label, low = F.when(inside, name).otherwise(label), F.when(inside, i).otherwise(low)
    return df.groupBy(label.alias("class"), low.alias("position")).agg(F.count("*").alias("n"))


def confidence_deciles(mentions: DataFrame, column: str = "raw_model_confidence") -> DataFrame:
    """``decile, n``; 1.0 has a class of its own, nulls are left out."""
    c = F.col(column)
    return mentions.where(c.isNotNull()).groupBy(F.when(c >= 1, 10).otherwise(F.floor(c * 10)).cast("int").alias("decile")).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int = 30) -> DataFrame:
    """``value, n, share, rank`` of the k most frequent values (a top-k report)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = df.where(F.col(column).isNotNull()).agg(F.count("*").alias("total"))
    top = counts.orderBy(F.desc("n"), "value").limit(k).crossJoin(F.broadcast(total))
    return top.select("value", "n", half_up(100 * F.col("n") / F.col("total")).alias("share"), F.row_number().over(Window.orderBy(F.desc("n"), "value")).alias("rank"))


def field_frequency(df: DataFrame, columns: list[str]) -> DataFrame:
    """``field, n_present, share``: how many rows have a value in each column, in one pass."""
    one = df.agg(F.count("*").alias("total"), *[F.count(c).alias(f"c_{c}") for c in columns])
    rows = one.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"c_{c}").alias("n_present")) for c in columns])).alias("f"))
    return rows.select("f.field", "f.n_present", half_up(100 * F.col("f.n_present") / F.greatest("total", F.lit(1))).alias("share"))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """``field, value, n`` of several categorical columns in one pass."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("value")) for c in columns])).alias("e"))
    return rows.groupBy("e.field", "e.value").agg(F.count("*").alias("n"))


# --- two runs ----------------------------------------------------------------------------------------------------------


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """``job_index, n_a, n_b, difference, side`` of the jobs of either run; side is both, only_a or only_b."""
    j = a.select("job_index", F.col("n").alias("n_a")).join(b.select("job_index", F.col("n").alias("n_b")), "job_index", "full")
    side = F.when(F.col("n_a").isNull(), "only_b").when(F.col("n_b").isNull(), "only_a").otherwise("both")
    return j.select("job_index", "n_a", "n_b", (F.col("n_b") - F.col("n_a")).alias("difference"), side.alias("side"))


def comparison_summary(compared: DataFrame) -> DataFrame:
    """One row: matches, gains, losses, zeros on either side, and deficits and surpluses of five or more."""
    d, both = F.col("difference"), F.col("side") == "both"
    return compared.agg(
        F.count_if(both).alias("common"),
        F.count_if(F.col("side") == "only_a").alias("only_a"),
        F.count_if(F.col("side") == "only_b").alias("only_b"),
        F.count_if(d == 0).alias("equal"),
        F.count_if(d > 0).alias("b_more"),
        F.count_if(d < 0).alias("a_more"),
        F.count_if((F.col("n_a") == 0) & (F.col("n_b") == 0)).alias("zero_both"),
        F.count_if((F.col("n_a") == 0) & (F.col("n_b") > 0)).alias("zero_a_only"),
        F.count_if((F.col("n_b") == 0) & (F.col("n_a") > 0)).alias("zero_b_only"),
        F.count_if(d <= -BIG_DIFFERENCE).alias("big_deficits"),
        F.coalesce(-F.sum(F.when(d <= -BIG_DIFFERENCE, d)), F.lit(0)).alias("deficit"),
        F.count_if(d >= BIG_DIFFERENCE).alias("big_surpluses"),
        F.coalesce(F.sum(F.when(d >= BIG_DIFFERENCE, d)), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum("difference"), F.lit(0)).alias("net"),
    )


def largest_differences(compared: DataFrame, k: int = 20) -> DataFrame:
    return compared.where("side = 'both'").orderBy(F.desc(F.abs("difference")), "job_index").limit(k)


def zero_jobs(per_job: DataFrame, k: int = 30) -> DataFrame:
    """The first k jobs without mentions, of ``job_index, n`` (a top-k report)."""
    return per_job.where("n = 0").select("job_index").orderBy("job_index").limit(k)


def top_overlap(a: DataFrame, b: DataFrame, column: str, k: int = 100) -> DataFrame:
    """``value, rank_a, rank_b, n_a, n_b, side`` of the union of both runs' k most frequent values."""
    x, y = (top_values(df, column, k).select("value", F.col("rank").alias(f"rank_{s}"), F.col("n").alias(f"n_{s}")) for df, s in ((a, "a"), (b, "b")))
    side = F.when(F.col("rank_a").isNull(), "only_b").when(F.col("rank_b").isNull(), "only_a").otherwise("both")
    return x.join(y, "value", "full").withColumn("side", side)


# --- call logs ---------------------------------------------------------------------------------------------------------


def call_stats(calls: DataFrame, by: list) -> DataFrame:
    """``calls, wall, tokens`` and means of a log ``ts, model, role, wall_time, eval_tokens, tok_s`` per group."""
    mean = lambda c: half_up(F.sum(F.col(c).cast("decimal(18,6)")).cast("double") / F.count(c))
    return calls.groupBy(*by).agg(F.count("*").alias("calls"), F.round(F.sum(F.col("wall_time").cast("decimal(18,6)")).cast("double"), 4).alias("wall"), F.sum("eval_tokens").alias("tokens"), mean("wall_time").alias("avg_wall"), mean("tok_s").alias("avg_tok_s"))


def hourly(calls: DataFrame) -> DataFrame:
    return call_stats(calls, [F.date_trunc("hour", "ts").alias("hour")])


def daily(calls: DataFrame) -> DataFrame:
    return call_stats(calls, [F.to_date("ts").alias("day")])


def role_timing(calls: DataFrame) -> DataFrame:
    """By role bucket and model: the extractor, and all others as verifier."""
    return call_stats(calls, [F.when(F.col("role") == "extractor", "extractor").otherwise("verifier").alias("bucket"), F.col("model")])


def last_hours(calls: DataFrame, hours: int = 24) -> DataFrame:
    """The calls of the last hours before the log's latest."""
    end = calls.agg(F.max("ts").alias("end"))
    return calls.join(F.broadcast(end), F.col("ts") >= F.col("end") - F.make_interval(hours=F.lit(hours))).drop("end")


def last_rows(calls: DataFrame, n: int = 100) -> DataFrame:
    """The last n calls (a top-k report)."""
    return calls.orderBy(F.desc("ts"), F.desc("call_id")).limit(n)


def positions(calls: DataFrame, by: str) -> DataFrame:
    """``calls`` with ``position`` in their log ``by``, from 0, and ``n``, the log's length; no log is brought into one task."""
    ranked = global_rank(calls.where(F.col(by).isNotNull()), [by, "ts", "call_id"], "_rank")
    logs = ranked.groupBy(by).agg(F.min("_rank").alias("_first"), F.count("*").alias("n"))
    return ranked.join(logs, by).withColumn("position", F.col("_rank") - F.col("_first")).drop("_rank", "_first")


def transitions(calls: DataFrame, by: str = "model", bucket: int = BUCKET) -> DataFrame:
    """``<by>, position, ts, before, after, kind`` where the speed jumps or the reply ratio drops, per log ``by``.

    Averages of WINDOW_ROWS calls before and from each call on. Logs are cut into buckets of positions, and the rows within
    WINDOW_ROWS of a bucket's edge go to the neighbour too, so a log of any length is many groups. Calls without ``by`` belong to no log.
    """
    w = WINDOW_ROWS
    placed = positions(calls, by).withColumn("ratio", F.col("resp_chars") / F.greatest("eval_tokens", F.lit(1))).select(by, "ts", "position", "n", "tok_s", "ratio")
    home = F.floor(F.col("position") / bucket)
    near = F.array_distinct(F.array(home, F.floor((F.col("position") - w) / bucket), F.floor((F.col("position") + w) / bucket)))
    spread = placed.select("*", home.alias("home"), F.explode(near).alias("bucket"))
    order = Window.partitionBy(by, "bucket").orderBy("position")
    back, ahead = order.rowsBetween(-w, -1), order.rowsBetween(0, w - 1)
    mean = lambda c, over: F.sum(F.col(c).cast("decimal(18,6)")).over(over).cast("double") / w
    averaged = spread.select(by, "ts", "position", "n", "home", "bucket", mean("tok_s", back).alias("speed_before"), mean("tok_s", ahead).alias("speed_after"), mean("ratio", back).alias("ratio_before"), mean("ratio", ahead).alias("ratio_after"))
    inside = averaged.where((F.col("home") == F.col("bucket")) & (F.col("position") >= w) & (F.col("position") < F.col("n") - w))

    def change(what: str, steep: Column) -> Column:
        return F.when(steep, F.struct(half_up(F.col(f"{what}_before")).alias("before"), half_up(F.col(f"{what}_after")).alias("after"), F.lit(what).alias("kind")))

    jump = change("speed", (F.col("speed_after") - F.col("speed_before") > JUMP) & (F.col("speed_before") < JUMP_BELOW))
    drop = change("ratio", (F.col("ratio_before") - F.col("ratio_after") > DROP) & (F.col("ratio_before") > DROP_ABOVE))
    return inside.select(by, "position", "ts", F.explode(F.array_compact(F.array(jump, drop))).alias("c")).select(by, "position", "ts", "c.*")


def keep_apart(found: DataFrame, by: list[str], apart: int = APART) -> DataFrame:
    """``found`` without those within ``apart`` rows of the last kept one; an ordered fold over a group's few transitions."""
    cols = [c for c in found.columns if c not in by]
    items = F.array_sort(F.collect_list(F.struct("position", *[c for c in cols if c != "position"])))
    grouped = found.groupBy(*by).agg(items.alias("items"))
    kept = F.aggregate("items", F.slice("items", 1, 1), lambda acc, x: F.when(x["position"] - F.element_at(acc, -1)["position"] > apart, F.concat(acc, F.array(x))).otherwise(acc))
    return grouped.select(*by, F.explode(kept).alias("k")).select(*by, "k.*")


def phases(calls: DataFrame, by: str = "model") -> DataFrame:
    """``<by>, phase, calls, from_position``: calls before, between and after the first two transitions; one transition makes phases 1 and 3."""
    apart = keep_apart(transitions(calls, by), [by, "kind"])
    merged = keep_apart(apart.select(by, "position", "ts"), [by], APART_MERGED)
    cuts = merged.groupBy(by).agg(F.slice(F.array_sort(F.collect_list("position")), 1, 2).alias("cuts"))
    placed = positions(calls, by).select(by, "position").join(cuts, by, "left")
    n = F.coalesce(F.size("cuts"), F.lit(0))
    phase = F.when((n == 0) | (F.col("position") < F.get("cuts", F.lit(0))), 1).when((n == 2) & (F.col("position") < F.get("cuts", F.lit(1))), 2).otherwise(3)
    return placed.groupBy(by, phase.alias("phase")).agg(F.count("*").alias("calls"), F.min("position").alias("from_position"))


def level_counts(lines: DataFrame) -> DataFrame:
    """Lines of a log ``value`` by what they say."""
    low = F.lower("value")
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.col("value").contains("WARN")).alias("warnings"), F.count_if(F.col("value").contains("ERROR")).alias("errors"), F.count_if(low.contains("timeout") | low.contains("timed out")).alias("timeouts"), F.count_if(low.contains("retry")).alias("retries"))
