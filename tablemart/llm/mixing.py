"""Mixing sources to target weights by entropy balancing, rounded into whole copies of documents."""

from pyspark.sql import Window, functions as F

from tablemart.llm.tables import WORD, word_count
from tablemart.operators.ranking import number_rows
from tablemart.storage import via_table

#: No document and no source is taken more often than this.
MOST = 3
#: Sizes in words at which a new round of rounding begins, the longest documents first.
STEPS = (4096, 512, 64)
NEWTON_STEPS = 64
SOURCE = ("_source", "_no_source")


def target_shares(sizes, most=MOST):
    """_source, _no_source, source_size, weight, target: what each source should give, in words.

    sizes: _source, _no_source, source_size (long). Sources in code point order, null last, weigh
    1, 2, 3, 1, 2, 3, ... and share the sum of all sizes; a target stops at `most` times its source
    and the excess is shared again by weight. That ends at min(most * size, level * weight) with one
    level for all, found at the first source, by falling need, that the level does not fill. The
    windows run over one row per source.
    """
    order = Window.orderBy("_no_source", "_source")
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(0, Window.unboundedFollowing)
    rows = sizes.withColumn("number", F.row_number().over(order)).withColumn(
        "weight", (F.col("number") - 1) % 3 + 1
    ).withColumn("most", F.col("source_size") * most)
    rows = rows.withColumn("whole", F.sum("source_size").over(Window.partitionBy(F.lit(1))))
    rows = rows.withColumn("level", (F.col("whole") - F.coalesce(F.sum("most").over(before), F.lit(0))).cast(
        "double") / F.sum("weight").over(onward)).withColumn("place", F.row_number().over(by_need))
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("place", "level"))
    rows = rows.withColumn("level", F.min(open_level).over(Window.partitionBy(F.lit(1)))["level"])
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return rows.select(*SOURCE, "source_size", "weight", target.alias("target"))


def tilt(target, size, most=MOST):
    """exp(x) at the root x of size * exp(x) = target, held within 0 and `most`.

    That is the dual of entropy balancing with one token constraint per source: constraints of
    disjoint sources have a diagonal Hessian, size * exp(x), so each source takes its own Newton
    steps x - (size * exp(x) - target) / (size * exp(x)), all sources at once in their rows. Rounded
    to nine places so that reruns agree to the last digit.
    """
    share = F.greatest(target, F.lit(0.0)) / size
    root = F.aggregate(
        F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.lit(0.0), lambda x, _: x - (1 - share / F.exp(x))
    )
    return F.when(size > 0, F.least(F.lit(float(most)), F.round(F.exp(root), 9))).otherwise(0.0)


def mix_sources(documents, most=MOST, steps=STEPS):
    """doc_id, size, source_size, target, taken of every row; copies = taken / size.

    size: words of the text, null and empty texts 0. Every document of a source has the same tilted
    rate, and rates become copies so that copies of the K longest documents never stray more than
    half a copy from rate * K: floor(rate * K + 1/2) - floor(rate * (K - 1) + 1/2). Rounding goes
    from long to short documents in rounds (steps): after each round the dual is solved again for
    what is left, so a source ends within about half of its last round's longest document, or
    within its longest if it has no short ones. Where a round would take more than the whole target,
    or leave more than the shorter documents can give, and rounding down (without the 1/2) does less
    of that, it rounds down. No document is taken more than `most` times.

    Ranks come from one range sort over (source, size, doc_id), which splits a hot source and hot
    sizes; sums per source are pre-aggregated. The table of sources has one row each and is joined as
    a stored table, which Spark broadcasts only below its threshold. Null sources are one source.
    Empty tables give no rows; rows with equal doc_id, size and source are interchangeable; other
    columns are not looked at.
    """
    sizes = via_table(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"),
        F.coalesce(F.col("source"), F.lit("")).alias("_source"), F.col("source").isNull().alias("_no_source"),
    ), "sizes")
    step = F.lit(len(steps))
    for number, least in reversed(list(enumerate(steps))):
        step = F.when(F.col("size") >= least, F.lit(number)).otherwise(step)
    # Stored with their places: each round and the result read them as they are.
    ranked = via_table(number_rows(
        sizes.withColumn("step", step), ("_no_source", "_source", F.desc("size"), "doc_id"), "place", 1
    ), "ranked")
    # One row per source holds all that its rounds need and leave, so a round is one small table.
    rounds = range(len(steps) + 1)
    totals = ranked.groupBy(*SOURCE).agg(
        F.sum("size").alias("source_size"),
        *[F.min(F.when(F.col("step") == n, F.col("place"))).alias(f"first{n}") for n in rounds],
        *[F.coalesce(F.sum(F.when(F.col("step") == n, F.col("size"))), F.lit(0)).alias(f"words{n}") for n in rounds],
    )
    shares = target_shares(totals.select(*SOURCE, "source_size"), most)
    state = shares.join(totals.drop("source_size"), list(SOURCE)).drop("weight").withColumn(
        "left_target", F.col("target")
    ).withColumn("left_size", F.col("source_size").cast("double"))

    def rated(state, number):
        """The sources with the rate of the round that begins, stored."""
        rate = tilt(F.col("left_target"), F.col("left_size"), most)
        return via_table(state.withColumn(f"rate{number}", rate), "targets")

    def taken(rate, first, phase):
        rank = F.col("place") - first + 1
        return (F.floor(rate * rank + phase) - F.floor(rate * (rank - 1) + phase)) * F.col("size")

    for number in rounds:
        state, words = rated(state, number), F.col(f"words{number}")
        own = F.col(f"rate{number}"), F.col(f"first{number}")
        used = ranked.filter(F.col("step") == number).join(state, list(SOURCE)).groupBy(*SOURCE).agg(
            F.sum(taken(*own, F.lit(0.5))).alias("near"), F.sum(taken(*own, F.lit(0.0))).alias("below")
        )
        rest = F.col("left_size") - words

        def missed(words, rest=rest):
            over = F.col("left_target") - words
            return F.greatest(-over, over - most * rest, F.lit(0.0))

        nearer = missed(F.col("near")) <= missed(F.col("below"))
        state = state.join(used, list(SOURCE), "left").withColumn(
            f"phase{number}", F.when(nearer, 0.5).otherwise(0.0)
        ).withColumn("used", F.coalesce(F.when(nearer, F.col("near")).otherwise(F.col("below")), F.lit(0))).withColumn(
            "left_target", F.col("left_target") - F.col("used")
        ).withColumn("left_size", rest).drop("used", "near", "below")
    state = via_table(state, "rounded")

    def own_step(name):
        return F.coalesce(*[F.when(F.col("step") == n, F.col(f"{name}{n}")) for n in rounds])

    return ranked.join(state, list(SOURCE)).select(
        "doc_id", "size", "source_size", "target",
        taken(own_step("rate"), own_step("first"), own_step("phase")).alias("taken"),
    )


def mix_sql(table="documents", steps=STEPS, most=MOST):
    """The rows of mix_sources in DuckDB SQL; rates in closed form, where the operator iterates."""
    share = "CASE WHEN left_size > 0 THEN least({m}.0, round(greatest(left_target, 0) / left_size, 9)) ELSE 0 END"
    cases = " ".join(f"WHEN size >= {least} THEN {n}" for n, least in enumerate(steps))
    parts = [f"""
sized AS (
  SELECT doc_id, source, size, CASE {cases} ELSE {len(steps)} END AS step FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM {table})),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source, step ORDER BY size DESC, doc_id) AS place FROM sized),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * {most} AS most
  FROM totals),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER earlier, 0) AS DOUBLE) / sum(weight) OVER later AS level,
    row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS nth
  FROM weighed
  WINDOW earlier AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    later AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
state0 AS (
  SELECT source, source_size, target, target AS left_target, CAST(source_size AS DOUBLE) AS left_size FROM (
    SELECT source, source_size, least(CAST(most AS DOUBLE), coalesce(
      (SELECT arg_min(level, nth) FROM levels WHERE level * weight <= most), 0) * weight) AS target
    FROM levels))"""]
    for n in range(len(steps) + 1):
        rate = share.format(m=most)
        parts.append(f"""
rated{n} AS (
  SELECT doc_id, p.source, size, source_size, target, left_target, left_size,
    CAST((floor(rate * place + 0.5) - floor(rate * (place - 1) + 0.5)) * size AS BIGINT) AS near,
    CAST((floor(rate * place) - floor(rate * (place - 1))) * size AS BIGINT) AS below
  FROM placed p JOIN (SELECT *, {rate} AS rate FROM state{n}) s ON p.source IS NOT DISTINCT FROM s.source
  WHERE step = {n}),
used{n} AS (
  SELECT *, greatest(near - left_target, left_target - near - {most} * (left_size - gone), 0)
      <= greatest(below - left_target, left_target - below - {most} * (left_size - gone), 0) AS nearer
  FROM (SELECT source, left_target, left_size, sum(near) AS near, sum(below) AS below, sum(size) AS gone
    FROM rated{n} GROUP BY 1, 2, 3)),
taken{n} AS (
  SELECT doc_id, size, source_size, target, CASE WHEN nearer THEN r.near ELSE r.below END AS taken
  FROM rated{n} r JOIN used{n} u ON r.source IS NOT DISTINCT FROM u.source),
state{n + 1} AS (
  SELECT s.source, source_size, target,
    s.left_target - coalesce(CASE WHEN nearer THEN near ELSE below END, 0) AS left_target,
    s.left_size - coalesce(gone, 0) AS left_size
  FROM state{n} s LEFT JOIN used{n} u ON s.source IS NOT DISTINCT FROM u.source)""")
    rows = " UNION ALL ".join(
        f"SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken FROM taken{n}"
        for n in range(len(steps) + 1)
    )
    return "WITH" + ",".join(parts) + "\n" + rows
