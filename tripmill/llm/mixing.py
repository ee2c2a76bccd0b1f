"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size takes every document floor(r) times; the rest is a probability of one more
copy, the same for all its documents. Two fractional documents meet, and mass moves from one to the other until one
of them is certain; which way it moves is drawn so that expectations hold, and the words expected do not change.
What is left fractional of a group of documents goes on to a group of such rests, and so up a tree of fixed fan-in:
a source ends with at most one open document, which is drawn, and the last
group then makes up for that draw as far as it can. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import WORD, written

MOST_COPIES = 3
#: Documents, or rests of groups, that meet in one group.
FAN_IN = 64
#: So many of a group's documents, spread over their sizes, go on to the next group untouched.
SPARES = 12
EPSILON = 1e-12


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def repeating_weights(sources: DataFrame, source: str) -> DataFrame:
    """``weight`` 1, 2, 3, repeating, for the sources in code point order, null last. One row for each source."""
    order = Window.orderBy(F.col(source).isNull(), source)
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))


def targets(sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Adds ``target`` to rows of ``source_size`` and ``weight``: shares of all sizes by weight, capped at ``most`` sizes.

    What a cap leaves over goes to the others by weight until none is above: the level at which the targets fill up
    is found among the sources in the order in which they reach their caps. A source of size 0 has target 0.
    """
    cap = F.col("source_size") * most
    filled = Window.orderBy(cap / F.col("weight"), "weight", "source_size").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = sources.select(
        "*",
        cap.alias("cap"),
        F.coalesce(F.sum(cap).over(filled), F.lit(0)).alias("capped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))).alias("open_weight"),
        F.sum("source_size").over(everything).alias("total"),
    )
    level = (F.col("total") - F.col("capped")) / F.col("open_weight")
    # The highest level at which the next source stays under its cap: counting more sources as full only lowers it.
    under = F.when(level * F.col("weight") <= F.col("cap"), level)
    ranked = ranked.withColumn("level", F.max(under).over(everything))
    return ranked.withColumn("target", F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double"))).drop(
        "cap", "capped", "open_weight", "total", "level"
    )


def _draw(*of: Column) -> Column:
    """A number in [0, 1) that is the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _certain(p: Column) -> Column:
    return F.when(p < EPSILON, 0.0).when(p > 1 - EPSILON, 1.0).otherwise(p)


def _meet(state: Column, item: Column, seed: int, level: int) -> Column:
    """One step: the open document of the state and the next one exchange mass; who is certain goes to ``done``."""
    open_, p, mass = state["open"], state["open"]["p"], state["open"]["mass"]
    step = F.struct(
        F.least((1 - p) * mass, item["p"] * item["mass"]).alias("up"),
        F.least(p * mass, (1 - item["p"]) * item["mass"]).alias("down"),
        _draw(F.lit(seed), F.lit(level), open_["id"], open_["size"], item["id"], item["size"], F.size(state["done"])).alias("draw"),
    )

    def exchanged(step: Column) -> Column:
        moved = F.when(step["draw"] * (step["up"] + step["down"]) < step["down"], step["up"]).otherwise(-step["down"])
        both = F.struct(
            open_.withField("p", _certain(p + moved / mass)).alias("old"),
            item.withField("p", _certain(item["p"] - moved / item["mass"])).alias("new"),
        )
        return _let(both, settled)

    def settled(both: Column) -> Column:
        pair = F.array(both["old"], both["new"])
        certain = F.filter(pair, lambda x: x["p"].isin(0.0, 1.0))
        still = F.filter(pair, lambda x: ~x["p"].isin(0.0, 1.0))
        return F.struct(F.get(still, F.lit(0)).alias("open"), F.concat(state["done"], certain).alias("done"))

    return F.when(open_.isNull(), F.struct(item.alias("open"), state["done"].alias("done"))).otherwise(_let(step, exchanged))


def _reduced(items: DataFrame, seed: int, level: int) -> DataFrame:
    """Each group's certain documents, and the rest of it; the last group of a source draws for its open one."""
    kind = items.schema["item"].dataType.simpleString()
    groups = items.groupBy("source_no", "group", "groups").agg(F.sort_array(F.collect_list("item"), asc=False).alias("all"))
    empty = F.array().cast(f"array<{kind}>")
    last = F.col("groups") <= 1
    step = F.ceil(F.size("all") / SPARES)
    # Some documents of all sizes go on as they are, so that the last group can come near the target.
    spare = F.when(last, empty).otherwise(F.filter("all", lambda item, at: at % step == step - 1))
    now = F.when(last, F.col("all")).otherwise(F.filter("all", lambda item, at: at % step != step - 1))
    start = F.struct(F.lit(None).cast(kind).alias("open"), empty.alias("done"))
    ends = groups.withColumn("spare", spare).withColumn("end", F.aggregate(now, start, lambda state, item: _meet(state, item, seed, level)))
    open_ = F.col("end.open")
    drawn = F.when(_draw(F.lit(seed), F.lit(-1), F.col("source_no"), open_["id"], open_["size"]) < open_["p"], 1.0).otherwise(0.0)
    closed = F.sort_array(F.concat("end.done", F.array(open_.withField("p", drawn))), asc=False)
    evened = F.aggregate(closed, F.struct(((drawn - open_["p"]) * open_["mass"]).alias("over"), empty.alias("done")), _even)
    done = F.when(last & open_.isNotNull(), evened["done"]).otherwise(F.col("end.done"))
    rest = F.when(last, empty).otherwise(F.concat(F.when(open_.isNull(), empty).otherwise(F.array(open_)), "spare"))
    return ends.select("source_no", "group", "groups", done.alias("done"), rest.alias("rest"))


def _even(state: Column, item: Column) -> Column:
    """Turns a document of a source's last group over, largest first, where that brings the source nearer to its target.

    Drawing for the one open document leaves its whole size as the error, which is much for a source of few documents.
    """
    turned = 1 - item["p"]
    over = state["over"] + (turned - item["p"]) * item["mass"]
    turn = F.abs(over) < F.abs(state["over"])
    kept = F.array(F.when(turn, item.withField("p", turned)).otherwise(item))
    return F.struct(F.when(turn, over).otherwise(state["over"]).alias("over"), F.concat(state["done"], kept).alias("done"))


def plan(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weigh=repeating_weights, most: int = MOST_COPIES, seed: int = 0
) -> DataFrame:
    """``id, source, size, n_rows, source_size, target, copies``: how often each document is taken.

    Rows that agree in key, source and number of words are one line of the plan, ``n_rows`` counts them, and all are
    taken equally often, from 0 to ``most`` times. A null text has size 0; documents without words are drawn as if
    they had one. Null keys and null sources are values like others. ``weigh`` adds a weight to each source's row;
    sources are the parts of a mix, some thousands at most, and only their totals are ordered in one task.
    Reruns agree: draws are hashes of keys and sizes.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
    units = written(rows.groupBy("id", "source", "size").agg(F.count("*").alias("n_rows")))
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count("*").alias("units"))
    sources = targets(weigh(sums, "source"), most)
    sources = sources.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = written(
        sources.select("source", "source_size", "target", "source_no", rate.alias("rate"), F.ceil(F.col("units") / FAN_IN).alias("groups"))
    )
    known = units.join(sources, units["source"].eqNullSafe(sources["source"])).select(units["*"], *[c for c in sources.columns if c != "source"])
    part = F.col("rate") - F.floor("rate")
    mass = F.greatest(F.col("size") * F.col("n_rows"), F.lit(1)).cast("double")
    item = F.struct(mass.alias("mass"), F.col("id"), F.col("size"), part.alias("p"))
    group = F.pmod(F.xxhash64(F.lit(seed), "id", "size"), "groups")
    items = known.where((part > EPSILON) & (part < 1 - EPSILON)).select("source_no", group.alias("group"), "groups", item.alias("item"))
    most_groups, level, settled = sources.agg(F.max("groups")).first()[0] or 0, 0, []
    while True:
        ends = written(_reduced(items, seed, level))
        settled.append(ends.select("source_no", F.explode("done").alias("one")))
        if most_groups <= 1:
            break
        most_groups, level = -(-most_groups // FAN_IN), level + 1
        higher = F.floor(F.col("group") / FAN_IN).alias("group"), F.ceil(F.col("groups") / FAN_IN).alias("groups")
        items = ends.select("source_no", *higher, F.explode("rest").alias("item"))
    certain = settled[0]
    for more in settled[1:]:
        certain = certain.unionByName(more)
    certain = certain.select(F.col("source_no").alias("no"), F.col("one.id").alias("one_id"), F.col("one.size").alias("one_size"), F.col("one.p").cast("int").alias("extra"))
    same = (F.col("source_no") == F.col("no")) & F.col("id").eqNullSafe(F.col("one_id")) & (F.col("size") == F.col("one_size"))
    whole = F.floor(F.col("rate") + EPSILON).cast("int")
    return known.join(certain, same, "left").select(
        "id", "source", "size", "n_rows", "source_size", "target", (whole + F.coalesce("extra", F.lit(0))).alias("copies")
    )


def taken(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """A row for each row of ``docs``: key, ``size``, ``source_size``, ``target`` and the words ``taken`` from it."""
    planned = plan(docs, key, source, text, **options)
    each = planned.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    return each.select(F.col("id").alias(key), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed documents: each row as often as the plan takes it, with its own columns only."""
    planned = written(plan(docs, key, source, text, **options).where("copies > 0").select("id", "source", "size", "copies"))
    planned = planned.select(*[F.col(c).alias(f"plan_{c}__") for c in planned.columns])
    same = F.col(key).eqNullSafe(F.col("plan_id__")) & F.col(source).eqNullSafe(F.col("plan_source__")) & (word_count(text) == F.col("plan_size__"))
    each = docs.join(planned, same).withColumn("plan_copy__", F.explode(F.sequence(F.lit(1), "plan_copies__")))
    return each.select(*docs.columns)
