"""Ingest health, module gates and magnitude drift; each is one aggregation over the rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import kernels as K
from .joins import written


def filled(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != ""


def fill_rates(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, fill_rate) rounded to four places; an empty table has rate 0."""
    columns = columns or rows.columns
    one = rows.agg(*(F.coalesce(F.round(F.avg(filled(c).cast("double")), 4), F.lit(0.0)).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("fill_rate")) for c in columns))).alias("x")).select("x.*")


def fill_drops(now: DataFrame, baseline: DataFrame, required: list[str]) -> DataFrame:
    """(column, drop, status): a required column fails on a large drop, any column degrades on a smaller one."""
    drop = F.round(F.col("base") - F.col("fill_rate"), 4)
    status = F.when(F.col("column").isin(*required) & (drop >= C.FILL_FAIL), "FAILED").when(drop >= C.FILL_WARN, "DEGRADED").otherwise("OK")
    return now.join(baseline.withColumnRenamed("fill_rate", "base"), "column").select("column", drop.alias("drop"), status.alias("status"))


def structural(rows: DataFrame, required: list[str], optional: list[str]) -> dict:
    have = set(rows.columns)
    missing = [c for c in required if c not in have]
    unknown = sorted(have - set(required) - set(optional) - set(C.FRAMEWORK_COLUMNS))
    return {"status": "FAILED" if missing else "DEGRADED" if unknown else "OK", "missing": missing, "unknown": unknown}


def renamed(missing: list[str], headers: list[str]) -> dict[str, str]:
    """The likeliest new name of each missing column, if it is likely enough."""
    out = {}
    for m in missing:
        best = max(headers, key=lambda h: K.indel_ratio(m.lower(), h.lower()), default=None)
        if best is not None and K.indel_ratio(m.lower(), best.lower()) >= 60:
            out[m] = best
    return out


def volume_status(rows: Column, baseline: Column) -> Column:
    return F.when(rows < baseline * C.ROW_FLOOR, "FAILED").otherwise("OK")


def shape_report(rows: DataFrame, patterns: dict[str, str], sets: dict[str, list[str]]) -> DataFrame:
    """(column, rule, rate, status) of values that break a pattern or leave a value set, among filled ones."""
    exprs, names = [], []
    for c, p in patterns.items():
        exprs.append(F.sum(F.when(filled(c) & ~F.col(c).cast("string").rlike(p), 1).otherwise(0)) / F.sum(filled(c).cast("int")))
        names.append((c, "pattern"))
    for c, values in sets.items():
        exprs.append(F.sum(F.when(filled(c) & ~F.lower(F.trim(F.col(c).cast("string"))).isin(*[v.lower() for v in values]), 1).otherwise(0)) / F.sum(filled(c).cast("int")))
        names.append((c, "value_set"))
    one = rows.agg(*(F.coalesce(F.round(e, 4), F.lit(0.0)).alias(f"_{i}") for i, e in enumerate(exprs)))
    out = one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"_{i}").alias("rate")) for i, (c, r) in enumerate(names)))).alias("x")).select("x.*")
    status = F.when((F.col("rule") == "pattern") & (F.col("rate") >= C.SHAPE_FAIL), "FAILED").when(F.col("rate") > C.SHAPE_WARN, "DEGRADED").otherwise("OK")
    return out.withColumn("status", status)


def worst(status: Column) -> Column:
    rank = F.max(F.when(status == "FAILED", 2).when(status == "DEGRADED", 1).otherwise(0))
    return F.when(rank == 2, "FAILED").when(rank == 1, "DEGRADED").otherwise("OK")


def gate(rows: DataFrame, invariants: list[tuple[str, str, Column]]) -> DataFrame:
    """(invariant, severity, violations, fraction, status); an invariant is (name, HARD or SOFT, what must hold)."""
    bad = [F.sum(F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(1)) for _, _, ok in invariants]
    one = rows.agg(F.count("*").alias("n"), *(b.alias(f"_{i}") for i, b in enumerate(bad)))
    cells = F.array(*(F.struct(F.lit(n).alias("invariant"), F.lit(s).alias("severity"), F.coalesce(F.col(f"_{i}"), F.lit(0)).alias("violations")) for i, (n, s, _) in enumerate(invariants)))
    out = one.select("n", F.explode(cells).alias("x")).select("n", "x.*")
    part = F.round(F.when(F.col("n") == 0, 0.0).otherwise(F.col("violations") / F.col("n")), 4)
    status = F.when(F.col("fraction") >= C.GATE_FAIL, "FAILED").when(F.col("fraction") >= C.GATE_WARN, "DEGRADED").otherwise("OK")
    return out.withColumn("fraction", part).withColumn("status", status).drop("n")


def gate_rows(rows: DataFrame, invariants: list[tuple[str, str, Column]]) -> DataFrame:
    """Hard violations become reject reasons, soft ones review flags, on the rows themselves."""
    pick = lambda kind: F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, s, ok in invariants if s == kind)))
    none = F.array().cast("array<string>")
    kinds = {s for _, s, _ in invariants}
    return rows.withColumn("gate_rejects", pick("HARD") if "HARD" in kinds else none).withColumn("gate_flags", pick("SOFT") if "SOFT" in kinds else none)


#: Values of one group that a task may hold, and bins of a pass over a larger group.
HELD, BINS = 1 << 20, 1024


def medians(rows: DataFrame, keys: list[str], value: str, held: int = HELD) -> DataFrame:
    """(keys…, median, n): exact medians of the values that aren't null, also of groups that no task could hold.

    Groups of over `held` values are narrowed first: a pass counts the values of the middle range in equal bins and goes on with those in which the
    middle lies, until few enough or only one value is left.  A pass needs `BINS` counts for each such group, and there are few such groups.
    """
    v = rows.select(*keys, F.col(value).cast("double").alias("_v")).where("_v is not null")
    sizes = v.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    sizes = written(sizes)
    small = v.join(sizes.where(F.col("n") <= held).select(*keys), keys, "left_semi") if not sizes.where(F.col("n") > held).isEmpty() else v
    out = small.groupBy(*keys).agg(F.percentile("_v", F.lit(0.5)).alias("median"), F.count("*").alias("n"))
    if small is v:
        return out
    at = sizes.where(F.col("n") > held).select(*keys, "n", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    first, last = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)  # ranks of the one or two values in the middle
    while not at.where((F.col("inside") > held) & (F.col("lo") < F.col("hi"))).isEmpty():
        span = F.col("hi") / 2 - F.col("lo") / 2  # halves, so that no difference overflows
        place = F.when(span > 0, F.least(F.floor((F.col("_v") / 2 - F.col("lo") / 2) / span * BINS), F.lit(BINS - 1))).otherwise(0)
        counts = v.join(at, keys).where("_v between lo and hi").groupBy(*keys, "n", "below", place.alias("_b")).agg(F.count("*").alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        before = F.col("below") + F.sum("c").over(Window.partitionBy(*keys).orderBy("_b")) - F.col("c")
        middle = counts.withColumn("_from", before).where((F.col("_from") <= last) & (F.col("_from") + F.col("c") > first))
        at = written(middle.groupBy(*keys, "n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("_from").alias("below"), F.sum("c").alias("inside")))
    one = at.where("lo = hi").select(*keys, F.col("lo").alias("median"), "n")
    rest = v.join(at.where("lo < hi"), keys).where("_v between lo and hi").groupBy(*keys, "n", "below").agg(F.sort_array(F.collect_list("_v")).alias("vs"))
    pick = lambda rank: F.get("vs", (rank - F.col("below")).cast("int"))
    return out.unionByName(one).unionByName(rest.select(*keys, (pick(first) * 0.5 + pick(last) * 0.5).alias("median"), "n"))


def magnitudes(rows: DataFrame, keys: list[str], value: str, held: int = HELD) -> DataFrame:
    """Exact median of the positive values of each group that has enough of them."""
    out = medians(rows.withColumn("_m", F.when(F.col(value) > 0, F.col(value))), keys, "_m", held)
    return out.where(F.col("n") >= C.DRIFT_MIN_ROWS).select(*keys, F.round("median", 4).alias("median"), "n")


def drift_status(now: Column, base: Column) -> Column:
    factor = F.greatest(now / base, base / now)
    return F.when(factor >= C.DRIFT_FAIL, "FAILED").when(factor >= C.DRIFT_WARN, "DEGRADED").otherwise("OK")


def clean_streak(events: DataFrame, source: str, at: list[str], clean: Column) -> DataFrame:
    """(source, streak): how many of the newest events in a row are clean."""
    w = Window.partitionBy(source).orderBy(*(F.desc(c) for c in at)).rowsBetween(Window.unboundedPreceding, 0)
    run = events.withColumn("_dirty", F.sum((~clean).cast("int")).over(w))
    return run.groupBy(source).agg(F.count_if(F.col("_dirty") == 0).alias("streak"))


def admission(streak: Column, certified: Column, drifted: Column) -> Column:
    """auto after enough clean runs with certification; a drift sends a source back to review."""
    return F.when(drifted, "review").when(certified & (streak >= C.CLEAN_RUNS), "auto").otherwise("review")
