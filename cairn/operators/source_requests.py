"""A batch of requests to the sources' configuration, as if each were made in turn.

A source is absent, active, paused or delisted, and has stock or not: eight states.  What a request answers and changes depends on the state
that it meets, so the batch is one walk of a state machine for each source (`machine.walked`).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import machine
from .joins import dealt_join, written

#: A source's lives, in the order in which states number them, and the requests.
LIVES = ("absent", "active", "paused", "delisted")
VERBS = ("put", "pause", "resume", "delist", "purge", "remove", "clean")
ASKED = {"source_code": "string", "ports": "array<string>", "enabled": "boolean"}


def _state(life: int, live: int) -> int:
    return 2 * life + live


def _move(verb: str):
    def change(s: int) -> int:
        life, live = divmod(s, 2)
        if verb == "put":
            return _state(life or 1, live)
        if life == 0:
            return s
        if verb in ("pause", "resume"):
            return _state(2 if verb == "pause" else 1, live)
        if verb == "delist":
            return _state(3, 0)
        return _state(0, 0) if verb == "remove" and not live else s

    return change


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def refused_puts(puts: DataFrame, sources: DataFrame, adapters: list[str]) -> DataFrame:
    """Adds `refusal` to puts (n, source, source_code, ports): no_adapter, no_port or code_taken, null for a sound one.

    A source needs an adapter (their list is code, not data), one port that isn't blank, and a code that no other source has, whatever its
    case; no code is no clash.  Codes are as the batch finds them; one that nobody has goes to the first sound put that asks for it.
    """
    code = F.lower(_text("source_code"))
    port = F.exists(F.coalesce("ports", F.array().cast("array<string>")), lambda p: F.coalesce(F.trim(p) != "", F.lit(False)))
    first = puts.withColumn("_code", code).withColumn("refusal", F.when(~F.col("source").isin(*adapters), "no_adapter").when(~port, "no_port"))
    held = sources.groupBy(code.alias("_code")).agg(F.min("source").alias("_least"), F.max("source").alias("_most"))
    asked = first.where("refusal is null").groupBy("_code").agg(F.min_by("source", "n").alias("_first"))
    owners = asked.join(held, "_code", "left").where("_code <> ''")
    out = dealt_join(first, owners, "_code", "left")
    name = F.col("source")
    taken = F.when(F.col("_least").isNotNull(), (F.col("_least") != name) | (F.col("_most") != name)).otherwise(F.col("_first") != name)
    return out.withColumn("refusal", F.coalesce("refusal", F.when(taken, "code_taken"))).drop("_code", "_least", "_most", "_first")


def apply_requests(tables: dict[str, DataFrame], requests: DataFrame, adapters: list[str], width: int = 256) -> tuple[dict[str, DataFrame], DataFrame]:
    """(changed tables, answers) after requests (n, source, verb, and for put source_code, ports, enabled), in the order of n: different whole numbers from 0 on.

    tables: sources (source, source_code, ports, enabled, lifecycle, …; a null lifecycle is active), removed (source), products (sku, source, qty).
    Changed: these three and `cleaned`, the sources whose scrapes go.  answers (n, source, verb, code, detail).

    put adds or replaces, keeps the lifecycle and takes back a removal; pause stops scraping; resume makes active and tells whether a delisted
    source needs a run to have stock again; delist also sets its stock to nothing; purge deletes products without stock; remove is refused
    while there is stock, else purges, deletes the source and remembers that it was removed; clean is refused for paused and delisted ones.
    404: no such source; 405: no such request.  A null source is an empty name, a null quantity no stock.
    """
    sources, removed, products = (tables[k] for k in ("sources", "removed", "products"))
    more = [(F.col(c) if c in requests.columns else F.lit(None)).cast(t).alias(c) for c, t in ASKED.items()]
    named = requests.select("n", F.coalesce("source", F.lit("")).alias("source"), "verb", *more)
    puts = refused_puts(named.where("verb = 'put'"), sources, adapters)
    told = puts.unionByName(named.where("verb is null or verb <> 'put'").withColumn("refusal", F.lit(None).cast("string")))
    states = 2 * len(LIVES)
    stay = machine.table(states, lambda s: s)
    by_verb = F.coalesce(*(F.when(F.col("verb") == v, machine.table(states, _move(v))) for v in VERBS), stay)
    moves = told.withColumn("move", F.when(F.col("refusal").isNull(), by_verb).otherwise(stay))

    life = F.coalesce(*(F.when(F.col("lifecycle") == x, F.lit(i)) for i, x in enumerate(LIVES) if i > 1), F.lit(1))
    live = products.where("qty > 0").select("source").distinct().withColumn("_live", F.lit(1))
    start = sources.select("source", life.alias("_life")).join(live, "source", "full_outer").select("source", (2 * F.coalesce("_life", F.lit(0)) + F.coalesce("_live", F.lit(0))).alias("state"))
    was, had = F.floor(F.col("before") / 2), F.col("before") % 2 == 1
    verb = F.col("verb")
    detail = (
        F.when(verb.isNull() | ~verb.isin(*VERBS), "no_such_request").when(F.col("refusal").isNotNull(), F.col("refusal")).when((verb != "put") & (was == 0), "unknown_source")
        .when((verb == "remove") & had, "live_products").when((verb == "clean") & (was > 1), "frozen").when((verb == "resume") & (was == 3), "restock_required")
    )
    codes = {"no_such_request": 405, "unknown_source": 404, "live_products": 409, "frozen": 409, "restock_required": 200}
    code = F.when(F.col("detail").isNull(), 200).otherwise(F.coalesce(*(F.when(F.col("detail") == d, F.lit(c)) for d, c in codes.items()), F.lit(400)))
    done = written(machine.walked(moves, start, "source", width).withColumn("detail", detail).withColumn("code", code).drop("move"))

    ok = F.col("code") == 200
    at = lambda *verbs: F.when(ok & verb.isin(*verbs), F.col("n"))
    body = F.struct("source_code", "ports", F.coalesce("enabled", F.lit(True)).alias("enabled"))
    runs = F.coalesce(F.when(verb == "put", F.coalesce("enabled", F.lit(True))), verb == "resume")
    last = done.groupBy("source").agg(
        F.max_by("after", "n").alias("_after"), F.max_by(body, at("put")).alias("_body"), F.max_by(runs, at("put", "pause", "resume", "delist")).alias("_runs"),
        F.max(at("remove")).alias("_removed"), F.max(at("put")).alias("_put"), F.min(at("delist")).alias("_delisted"),
        F.max(at("purge", "remove")).alias("_purged"), F.max(at("clean")).alias("_cleaned"),
    )
    summary = written(last)
    return {"sources": _sources(sources, summary), "removed": _removed(removed, summary), "products": _products(products, summary), "cleaned": summary.where("_cleaned is not null").select("source")}, done.select("n", "source", "verb", "code", "detail")


def _sources(sources: DataFrame, summary: DataFrame) -> DataFrame:
    kinds = dict(sources.dtypes)
    j = sources.withColumn("_there", F.lit(True)).join(summary, "source", "full_outer")
    left = j.where((F.col("_after").isNull() & F.col("_there")) | (F.col("_after") > 1))
    anew = F.col("_removed").isNotNull()  # what is there after a removal was put after it
    life = F.floor(F.col("_after") / 2)
    named = F.coalesce(*(F.when(life == i, F.lit(x)) for i, x in enumerate(LIVES)))
    own = {c: F.when(F.col("_put").isNotNull(), F.col(f"_body.{c}")).otherwise(F.col(c)) for c in ("source_code", "ports")}
    own |= {"source": F.col("source"), "enabled": F.coalesce("_runs", "enabled"), "lifecycle": F.when(F.col("_after").isNull(), F.col("lifecycle")).otherwise(named)}
    return left.select(*((own[c] if c in own else F.when(~anew, F.col(c))).cast(kinds[c]).alias(c) for c in sources.columns))


def _removed(removed: DataFrame, summary: DataFrame) -> DataFrame:
    back = summary.where("_put is not null and (_removed is null or _put > _removed)").select("source")
    gone = summary.where("_removed is not null and (_put is null or _removed > _put)").select("source")
    return removed.join(back, "source", "left_anti").select("source").unionByName(gone).distinct()


def _products(products: DataFrame, summary: DataFrame) -> DataFrame:
    j = dealt_join(products, summary.select("source", "_delisted", "_purged"), "source", "left")
    empty = ~F.coalesce(F.col("qty") > 0, F.lit(False))
    gone = F.col("_purged").isNotNull() & (empty | F.coalesce(F.col("_delisted") < F.col("_purged"), F.lit(False)))
    left = j.where(~gone)
    return left.withColumn("qty", F.when(F.col("_delisted").isNotNull(), F.lit(0).cast(dict(products.dtypes)["qty"])).otherwise(F.col("qty"))).select(*products.columns)
