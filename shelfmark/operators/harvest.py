"""State of periodic harvests: loading, planning, changed-since scans and saving."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.config import CORRECTED, REFERENCE, check_mode
from shelfmark.functions.times import from_bound, from_text, iso_utc, ntz, plus_seconds, token_valid
from shelfmark.operators.skew import salted_lookup

STATE_COLUMNS = ("source", "ts", "expiration_date", "resumption_token")
PUSHED_SOURCES = 1000


def load_last_run(raw: DataFrame) -> DataFrame:
    """Typed state per source from text. An empty date is null; a date that cannot be read empties the whole state."""
    ts, expiration = F.nullif(F.col("ts"), F.lit("")), F.nullif(F.col("expiration_date"), F.lit(""))
    broken = (ts.isNotNull() & iso_utc(ts).isNull()) | (expiration.isNotNull() & iso_utc(expiration).isNull())
    return raw.select(
        "source",
        F.when(~broken, iso_utc(ts)).alias("ts"),
        F.when(~broken, iso_utc(expiration)).alias("expiration_date"),
        F.when(~broken, F.col("resumption_token")).alias("resumption_token"),
    )


def plan_harvest(last_run: DataFrame, now, mode: str = REFERENCE, sources: DataFrame | None = None) -> DataFrame:
    """How each source is read next: RESUME with a token, INCREMENTAL from a bound, or FULL.

    ``from_text`` is the bound as sent; ``from_ts`` the instant it denotes. ``sources`` (``source``) are the configured sources:
    only these are planned, and one that never ran is read in full. Without it every source with a state is planned.
    """
    check_mode(mode)
    if sources is not None:
        last_run = sources.select("source").distinct().join(last_run, "source", "left")
    resume = token_valid(F.col("resumption_token"), F.col("expiration_date"), ntz(now))
    incremental = ~resume & F.col("ts").isNotNull()
    return last_run.select(
        "source",
        F.when(resume, "RESUME").when(incremental, "INCREMENTAL").otherwise("FULL").alias("action"),
        F.when(resume, F.col("resumption_token")).alias("token"),
        F.when(incremental, from_text(F.col("ts"), mode)).alias("from_text"),
        F.when(incremental, from_bound(F.col("ts"), mode)).alias("from_ts"),
    )


def changed_since(df: DataFrame, ts_col: str, plan, source_col: str = "source") -> DataFrame:
    """Rows modified at or after the bound.

    ``plan`` is one instant for all rows (a literal which reaches the file filters; ``None`` reads everything) or the result
    of ``plan_harvest``, one row per source. A plan without a bound reads its source whole; a source without plan is not read. Sources with
    a bound share a scan that the smallest bound reaches; sources read whole have one of their own.
    """
    if plan is None:
        return df
    if not isinstance(plan, DataFrame):
        return df.where(F.col(ts_col) >= ntz(plan))
    bounds = plan.select(F.col("source").alias("_source"), F.col("from_ts").alias("_from"))
    of_source = F.col(source_col) == F.col("_source")
    if plan.isStreaming or df.isStreaming:
        joined = df.join(bounds, of_source)
        return joined.where(F.col("_from").isNull() | (F.col(ts_col) >= F.col("_from"))).select(*df.columns)
    # Two scans, so that a source read in full does not take the bound from the others.
    first, n_full, n_bounded = bounds.agg(F.min("_from"), F.count_if(F.col("_from").isNull()), F.count("_from")).first()
    parts = []
    if n_bounded:
        recent = df.where(F.col(ts_col) >= ntz(first)).join(bounds.where(F.col("_from").isNotNull()), of_source)
        parts.append(recent.where(F.col(ts_col) >= F.col("_from")).select(*df.columns))
    if n_full:
        full = bounds.where(F.col("_from").isNull()).select("_source")
        whole = df
        if n_full <= PUSHED_SOURCES:  # few enough for a filter that reaches the scan as well
            whole = df.where(F.col(source_col).isin([r["_source"] for r in full.collect()]))
        parts.append(whole.join(full, of_source).select(*df.columns))
    return reduce(DataFrame.unionByName, parts) if parts else df.limit(0)


def next_run_at(last_run: DataFrame, now, interval_s: float) -> DataFrame:
    """When each source is read next: at a last run that lies ahead, 1 s from now while paging, else after the interval."""
    moment = ntz(now)
    paging = F.coalesce(F.col("resumption_token") != "", F.lit(False))
    return last_run.select(
        "source",
        F.when(F.col("ts") > moment, F.col("ts"))
        .when(paging, plus_seconds(moment, 1))
        .otherwise(plus_seconds(moment, interval_s))
        .alias("next_run_at"),
    )


def latest_page(states: DataFrame) -> DataFrame:
    """The last page read of each source, with the first request of the list it belongs to.

    ``list_start`` is that request as far as it lies among ``states``; ``new_list`` says that an earlier list ended there too.
    Everything is reduced per task before the shuffle; a source may have any number of pages.
    """
    page = F.struct("request_at", "page_no")
    columns = [c for c in states.columns if c != "source"]
    latest = states.groupBy("source").agg(F.max_by(F.struct(*columns), page).alias("s"), F.max(page).alias("_last"))
    finished = states.where(~F.col("failed") & (F.col("resumption_token") == "")).select("source", "page_no", page.alias("_end"))
    ended = (
        salted_lookup(finished, latest.select("source", "_last"), ["source"], spread=["page_no"])
        .where(F.col("_end") < F.col("_last"))
        .groupBy("source")
        .agg(F.max("_end").alias("_end"))
    )
    current = salted_lookup(states.where(~F.col("failed")), ended, ["source"], spread=["page_no"])
    starts = (
        current.where(F.col("_end").isNull() | (page > F.col("_end")))
        .groupBy("source")
        .agg(F.min("request_at").alias("list_start"), F.max(F.col("_end").isNotNull()).alias("new_list"))
    )
    return latest.join(starts, "source", "left").select(
        "source", "s.*", "list_start", F.coalesce("new_list", F.lit(False)).alias("new_list")
    )


def save_last_run(state: DataFrame, new: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """State after a run: ``new`` holds ``source, request_at, failed, resumption_token, expiration_date`` per source, and
    ``list_start, new_list`` when it stands for several pages (``latest_page``).

    ``reference`` stores the empty state after a failure and moves the time with every page. ``corrected`` keeps the previous
    state after a failure and the time of a list's first request while its pages are read.
    """
    check_mode(mode)
    several = "list_start" in new.columns
    began = F.coalesce(F.col("list_start"), F.col("request_at")) if several else F.col("request_at")
    result = new.select(
        "source", began.alias("_began"), (F.col("new_list") if several else F.lit(False)).alias("_new_list"), F.lit(True).alias("_ran"), "failed", "request_at", F.nullif("resumption_token", F.lit("")).alias("_token"),
        F.col("expiration_date").alias("_expiration"),
    )
    joined = state.join(result, "source", "full_outer")
    ok = F.col("_ran") & ~F.col("failed")
    ts = F.col("request_at")
    if mode == CORRECTED:
        continued = token_valid(F.col("resumption_token"), F.col("expiration_date"), F.col("_began")) & ~F.col("_new_list")
        ts = F.when(continued & F.col("ts").isNotNull(), F.col("ts")).otherwise(F.col("_began"))
        previous = F.col("_ran").isNull() | F.col("failed")
    else:
        previous = F.col("_ran").isNull()

    def chosen(value, old: str):
        return F.when(ok, value).when(previous, F.col(old)).alias(old)

    return joined.select(
        "source", chosen(ts, "ts"), chosen(F.col("_expiration"), "expiration_date"), chosen(F.col("_token"), "resumption_token")
    )
