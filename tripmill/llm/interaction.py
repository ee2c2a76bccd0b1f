"""Filter interaction audit: what each filter removes in each order of applying them.

Every document falls into a cell: its part and a mask with a bit for each filter that it fails. All that depends on
the documents is counted once, in those cells; a recursive query then extends prefixes of filters by unused letters
over the masks, and each level of it tells what that step does with a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import written

# Fixed values of the five filters.
LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SPACES, SIGNS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Prefixes of more filters than this times their masks would pass the row limit of recursive queries.
MOST_FILTERS = 6
COUNTS = ["docs", "good", "toxic"]


def text_failures(text: Column) -> list[Column]:
    """Failure of filters A to D, which depend on the text alone."""
    words = F.array_remove(F.split(text, SPACES), "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return [
        n_words < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n_words * LEAST_DISTINCT,
        capitals * 100 > F.length(text) * MOST_CAPITALS,
        text.rlike(SIGNS),
    ]


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``part, mask, docs, good, toxic``: how many documents fail just the filters of a mask, and how many of them are labelled.

    Bits 0 to 4 are filters A to E. A null text is empty, a null part is the empty one. Filter E fails a document whose
    text a smaller key has as well, anywhere in the table; rows of one key do not repeat each other, null keys are
    compared with nothing. Repeated rows count each; a key with several labels has all of them. Columns of other names are left alone.

    Texts are digested where they are read, so that shuffles carry short rows, and equal ones are added up before each:
    neither a text nor a key with a third of all rows comes together in one task.
    """
    narrow = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(text, F.lit("")).alias("text"))
    mask = sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(text_failures(F.col("text")))), F.lit(0))
    rows = narrow.select("key", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask")).groupBy("key", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = [F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(mark) for name, mark in (("quality", "is_good"), ("toxic", "is_toxic"))]
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("key")).agg(*marks)
    rows = rows.join(marked, "key", "left").fillna(False, ["is_good", "is_toxic"])
    same = ["digest", "part", "mask", "is_good", "is_toxic"]
    rows = rows.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("unkeyed"),
        F.min("key").alias("least"),
        F.min_by("n", "key").alias("n_least"),
    )
    # Of a text, a window sees a row for each part and label at most.
    rows = rows.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    new = F.col("unkeyed") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    repeat = 1 << LETTERS.index("E")
    counted = rows.select(*same, F.explode(F.array(F.struct("mask", new.alias("n")), F.struct((F.col("mask") + repeat).alias("mask"), (F.col("n") - new).alias("n")))).alias("of"))
    counted = counted.where("of.n > 0").groupBy("part", F.col("of.mask").alias("mask"))
    return counted.agg(
        F.sum("of.n").alias("docs"),
        F.sum(F.when(F.col("is_good"), F.col("of.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("of.n")).otherwise(0)).alias("toxic"),
    )


def steps(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``prefix, step, letter, mask, kept, removed, redundant, alone``: what the last filter of each prefix does with each mask.

    The recursion starts from the masks with nothing applied; a level appends each letter not yet used and carries
    the bits applied so far. Its size depends on the number of filters, not on the documents.
    """
    if len(letters) > MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"{letters}: at most {MOST_FILTERS} different filters")
    named = ", ".join(f"named_struct('letter', '{letter}', 'bit', {1 << bit})" for bit, letter in enumerate(letters))
    return masks.sparkSession.sql(
        f"""
        WITH RECURSIVE steps(prefix, step, letter, bit, before, mask) AS (
            SELECT CAST('' AS string), 0, CAST('' AS string), 0, 0, mask FROM {{masks}}
            UNION ALL
            SELECT concat(prefix, one.letter), step + 1, one.letter, one.bit, before | bit, mask
            FROM (SELECT *, explode(filter(array({named}), f -> (before | bit) & f.bit = 0)) AS one FROM steps)
        )
        SELECT prefix, step, letter, mask,
               mask & (before | bit) = 0 AS kept,
               mask & before = 0 AND mask & bit <> 0 AS removed,
               mask & before <> 0 AND mask & bit <> 0 AS redundant,
               mask = bit AS alone
        FROM steps WHERE step > 0
        """,
        masks=masks,
    )


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row for each part, order of all filters and step of it, zeros included; no rows without documents.

    ``kept`` after the step, ``removed`` in it, ``redundant`` fail its filter but went before, ``unique_fails`` fail
    nothing else, ``good_lost`` and ``toxic_lost`` are labelled ones among the removed, ``shapley`` is what the filter
    removes in all orders together.
    """
    counted = written(cells)
    over = counted.join(F.broadcast(steps(counted.select("mask").distinct(), letters)), "mask")
    count = lambda what, n="docs": F.sum(F.when(F.col(what), F.col(n)).otherwise(0))
    done = over.groupBy("part", "prefix", "step", "letter").agg(
        count("kept").alias("kept"), count("removed").alias("removed"), count("redundant").alias("redundant"),
        count("alone").alias("unique_fails"), count("removed", "good").alias("good_lost"), count("removed", "toxic").alias("toxic_lost"),
    )
    done = written(done)
    whole = done.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    each = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))).withColumn("prefix", F.expr("left(filter_order, step)"))
    rows = each.join(done.drop("step"), ["part", "prefix"])
    shares = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return rows.join(shares, ["part", "letter"]).select("part", "filter_order", F.col("step").cast("int").alias("step"), *[F.col(name).cast("long").alias(name) for name in names])


#: The same rows in plain SQL.
AUDIT_SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce("text", '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
           (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
           + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
           + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
           + (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
    FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
c AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM f GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
p AS (
    SELECT '' AS prefix, 0 AS step, 0 AS before, 0 AS bit, '' AS letter
    UNION ALL
    SELECT p.prefix || x.letter, p.step + 1, p.before | p.bit, x.bit, x.letter FROM p, letters x WHERE (p.before | p.bit) & x.bit = 0
),
s AS (
    SELECT c.part, p.prefix, p.step, p.letter,
           sum(CASE WHEN c.mask & (p.before | p.bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN c.mask & p.before = 0 AND c.mask & p.bit <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN c.mask & p.before <> 0 AND c.mask & p.bit <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN c.mask = p.bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN c.mask & p.before = 0 AND c.mask & p.bit <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN c.mask & p.before = 0 AND c.mask & p.bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, p WHERE p.step > 0 GROUP BY ALL
),
r AS (
    SELECT s.part, o.prefix AS filter_order, s.* EXCLUDE (part, prefix)
    FROM p o JOIN s ON starts_with(o.prefix, s.prefix) WHERE o.step = 5
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
