"""Mixing sources to target weights by pivotal dependent rounding (operator 10).

Sizes are words (maximal runs of characters other than U+0009-000D and U+0020; a
null text has none). Sources, by code point and null last, weigh ``weights`` in
turn, repeating. Together they share ``share`` times all words by weight; a target
stops at ``cap`` times its source's words, and the excess is reshared by weight
until none is above.

Method. Every document of a source starts with target / size of the source copies:
the whole part is certain, the fraction is its probability of one copy more.
Pivotal rounding pairs two fractions and moves mass, in words, from one to the
other, up or down at random so that each keeps its expectation, until one of them
is 0 or 1. The sum of words never changes, so a source ends within one document of
its target. Pairs are formed in small groups; the one fraction that a group leaves
goes up a reduction tree whose groups again hold about ``GROUP`` of them, until one
is left in each source and is rounded by itself.

Distribution. Only (id, source, size) leave the scan, counted where equal, so
repeated rows are one row of the tree. Groups are by (source, hash), so a source
with a third of all rows is as spread as any. All steps are DataFrame functions;
random numbers are hashes of id, source, size, level and seed, so reruns agree.

Defined cases: null sources are a source of their own; null ids are allowed;
documents without words take nothing; repeated rows share their copies as evenly
as whole copies allow; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyload.llm import common as C

GROUP = 64
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, size, n`` (rows) per source in; ``source, source_size, target`` out.
    One row per source goes through a window: no more than that is ordered in one place.
    Sources are assumed to be some million at most; more give the same result, in a
    task that grows with their number."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.select("source", "source_size", F.element_at(
        table, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(cap)).alias("most"))
    ranked = ranked.withColumn("all", F.sum("source_size").over(total) * share).withColumn("ratio", F.col("most") / F.col("weight"))
    # by rising most / weight, sources are full until the level fits under the next one
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", (F.col("all") - before) / left)
    ranked = ranked.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(total)["level"])
    return ranked.select("source", "source_size", F.coalesce(
        F.least("most", F.col("weight") * F.col("level")), F.col("most")).alias("target"))


def _random(seed: int, level: int, *columns: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _round(units: Column, last: Column) -> Column:
    """Pivotal rounding of an array of units (id, size, n, sure, mass, u): the
    rounded ones, and the unit that is left. ``mass`` is the probability times
    the size; ``last`` tells whether the unit that is left is to be rounded too."""
    unit = "struct<id:bigint,size:bigint,n:bigint,sure:bigint,mass:double,u:double>"
    done = "array<struct<id:bigint,size:bigint,n:bigint,sure:bigint>>"

    def fixed(x: Column, extra: Column) -> Column:
        return F.struct(x["id"].alias("id"), x["size"].alias("size"), x["n"].alias("n"),
                        (x["sure"] + extra.cast("long")).alias("sure"))

    def holding(x: Column, mass: Column) -> Column:
        return F.struct(x["id"].alias("id"), x["size"].alias("size"), x["n"].alias("n"), x["sure"].alias("sure"),
                        mass.alias("mass"), x["u"].alias("u"))

    def step(state: Column, x: Column) -> Column:
        y = state["left"]
        rise, fall = F.least(y["size"] - y["mass"], x["mass"]), F.least(y["mass"], x["size"] - x["mass"])
        up = x["u"] * (rise + fall) < fall
        # y rises as x falls, or the other way round; one of the two becomes whole
        y_whole = F.when(up, y["size"] - y["mass"] <= x["mass"]).otherwise(y["mass"] <= x["size"] - x["mass"])
        both = x["mass"] + y["mass"]
        whole = F.when(y_whole, fixed(y, up)).otherwise(fixed(x, ~up))
        rest = F.when(y_whole, holding(x, F.when(up, both - y["size"]).otherwise(both))).otherwise(
            holding(y, F.when(up, both).otherwise(both - x["size"])))
        return F.struct(F.concat(state["done"], F.array(whole)).cast(done).alias("done"), rest.cast(unit).alias("left"))

    start = F.struct(F.array().cast(done).alias("done"), units[0].cast(unit).alias("left"))
    return F.aggregate(
        F.slice(units, 2, F.greatest(F.size(units), F.lit(1))), start, step,
        lambda s: F.struct(
            F.when(last, F.concat(s["done"], F.array(fixed(s["left"], s["left"]["u"] * s["left"]["size"] < s["left"]["mass"])))
                   ).otherwise(s["done"]).alias("done"),
            F.when(~last, s["left"]).alias("left")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 11) -> DataFrame:
    """``id_col``, ``source``, ``size``, ``source_size``, ``target``, ``copies``
    and ``taken`` (words the mix takes, repeats counted) for every row of ``docs``."""
    sized = C.written(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
        .groupBy("id", "source", "size").agg(F.count("*").alias("n")))
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aims = C.written(targets(totals, weights, share, cap))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    expected = sized.join(aims.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).select(
        "id", "source", "size", "n", F.least(ratio, F.lit(float(cap))).alias("ratio"))
    # n equal rows hold n * ratio copies: the whole ones are sure
    expected = expected.withColumn("held", F.col("n") * F.col("ratio")).withColumn("sure", F.floor("held").cast("long"))
    expected = expected.withColumn("part", F.col("held") - F.col("sure"))
    rows = C.written(expected.select("id", "source", "size", "n", "sure", F.when(
        F.col("size") > 0, F.col("part")).otherwise(F.lit(0.0)).alias("part")))
    settled = rows.where("part = 0").select("source", "id", "size", "n", "sure")

    units = rows.where("part > 0").select(
        "source", F.struct("id", "size", "n", "sure", (F.col("part") * F.col("size")).alias("mass"),
                           _random(seed, 0, F.col("id"), F.col("source"), F.col("size")).alias("u")).alias("unit"))
    groups = units.groupBy("source").agg(F.ceil(F.count("*") / F.lit(float(GROUP))).alias("groups"))
    most = groups.agg(F.max("groups")).first()[0] or 0
    held = units.join(groups.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).select(
        "source", "unit", "groups", F.pmod(F.xxhash64("unit.id", "unit.size", F.lit(seed)), F.col("groups")).alias("group"))
    level = 0
    while most:
        in_order = F.sort_array(F.collect_list(F.struct("unit.u", "unit")))
        gathered = held.groupBy("source", "groups", "group").agg(F.transform(in_order, lambda x: x["unit"]).alias("units"))
        rounded = C.written(gathered.select("source", "groups", "group", _round(F.col("units"), F.col("groups") == 1).alias("out")).select(
            "source", "groups", "group", "out.done", "out.left"))
        settled = settled.unionByName(rounded.select("source", F.inline("done")))
        if most == 1:
            break
        level += 1
        fewer = F.ceil(F.col("groups") / F.lit(float(GROUP)))
        held = rounded.where("left is not null").select(
            "source", F.col("left").withField("u", _random(seed, level, F.col("left.id"), F.col("source"), F.col("left.size"))).alias("unit"),
            fewer.alias("groups"), F.pmod(F.col("group"), fewer).alias("group"))
        most = -(-most // GROUP)

    each = settled.select("source", "id", "size", "n", "sure", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    copies = F.floor(F.col("sure") / F.col("n")) + (F.col("i") <= F.col("sure") % F.col("n")).cast("long")
    return each.join(aims.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))
