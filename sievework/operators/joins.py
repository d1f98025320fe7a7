"""Joins that keep or check something besides the match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fits

#: Rows of one key beyond which it is joined apart, and keys that may be.
HOT, HOT_KEYS = 2_000, 100_000


def join_one(many: DataFrame, one: DataFrame, keys: list[str], rows: str = "rows", hot: int = HOT, most: int = HOT_KEYS) -> DataFrame:
    """many joined with a written side that has one row for each key and says how many rows of `many` the key has.

    Keys with more than `hot` rows meet these where they lie, by broadcast, so no task gets all rows of one; at most one
    row in `hot` names such a key. The others are joined by key, as are all if the hot side doesn't fit a broadcast.
    """
    above = one.where(F.col(rows) > hot)
    if above.limit(1).count() == 0 or not fits(above, most):
        return many.join(one, keys)
    rest = many.join(F.broadcast(above.select(*keys)), keys, "left_anti").join(one.where(F.col(rows) <= hot), keys)
    return many.join(F.broadcast(above), keys).unionByName(rest)


def carry_forward(candidates: DataFrame, decided: DataFrame, keys: list[str], carried: list[str], order: str) -> DataFrame:
    """Each candidate once for every decided row of its key, the parent (null order) first; undecided ones once with nulls."""
    old = decided.select(*keys, *carried, order)
    return candidates.join(old, keys, "left").withColumn("copy", F.row_number().over(Window.partitionBy(*candidates.columns).orderBy(F.col(order).asc_nulls_first(), *carried)))


def unique_match(batch: DataFrame, queue: DataFrame, keys: list[str]) -> DataFrame:
    """How each row of a batch meets the queue: none, one, or many (which is refused)."""
    found = queue.groupBy(*keys).agg(F.count("*").alias("found"))
    return batch.join(found, keys, "left").withColumn("status", F.when(F.col("found").isNull(), "none").when(F.col("found") == 1, "one").otherwise("many"))


def first_route(left: DataFrame, routes: list[tuple[str, DataFrame, Column, Column, str]], key: str) -> DataFrame:
    """Matches over several routes: for each left row the value of the first route that finds one (its least value), and the route's name.

    routes: (name, right side, key of the left side, key of the right side, value column of the right side); null keys find
    nothing. Each route's right side is brought to one row for each key first, so no pair of copies is ever made.
    """
    out, found = left, []
    values = [f"_v{rank}" for rank in range(len(routes))]
    for rank, (name, right, mine, theirs, value) in enumerate(routes):
        least = right.select(theirs.alias(f"_k{rank}"), F.col(value).alias(f"_v{rank}")).where(F.col(f"_k{rank}").isNotNull()).groupBy(f"_k{rank}").agg(F.min(f"_v{rank}").alias(f"_v{rank}"))
        out = out.withColumn(f"_m{rank}", mine).join(least, F.col(f"_m{rank}") == F.col(f"_k{rank}"), "left")
        found.append(F.when(F.col(f"_v{rank}").isNotNull(), F.struct(F.lit(name).alias("route"), F.col(f"_v{rank}").alias("match"))))
    best = out.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.min(v).alias(v) for v in values)).select(key, F.coalesce(*found).alias("_m"))
    return left.join(best, key, "left").select(*left.columns, F.col("_m.route").alias("route"), F.col("_m.match").alias("match"))


def unambiguous(lookup: DataFrame, name: str, identity: str, connectivity: Column) -> DataFrame:
    """name, identities, verdict, pick: the least identity, but only if all that the name finds agree in connectivity."""
    # One row for each name and identity first; that these agree takes no second distinct count.
    once = lookup.select(name, identity).distinct()
    out = once.groupBy(name).agg(F.count(identity).alias("identities"), (F.min(connectivity) == F.max(connectivity)).alias("agree"), F.min(identity).alias("least"))
    agree = F.coalesce("agree", F.lit(False))
    return out.select(name, "identities", F.when(agree, "accepted").otherwise("ambiguous").alias("verdict"), F.when(agree, F.col("least")).alias("pick"))


def previous_match(rows: DataFrame, partition: str, order: str, value: str, good: Column, window: int, stop: Column) -> DataFrame:
    """`antecedent`: the value of the nearest row before, within a window, that is good; rows behind one that stops are out of reach."""
    w = Window.partitionBy(partition).orderBy(order)
    found = F.lit(None).cast("string")
    blocked = F.lit(False)
    reach = rows.withColumns({"_good": good, "_stop": stop})
    out = None
    for k in range(1, window + 1):
        value_k, good_k, stop_k = (F.lag(c, k).over(w) for c in (value, "_good", "_stop"))
        hit = F.coalesce(good_k, F.lit(False)) & ~blocked & ~F.coalesce(stop_k, F.lit(False))
        found = F.coalesce(found, F.when(hit, value_k))
        blocked = blocked | F.coalesce(stop_k, F.lit(False))
        out = found
    return reach.withColumn("antecedent", out).drop("_good", "_stop")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def edit_plan(rows: DataFrame, edits: DataFrame, keys: list[str], expected: str, column: str, new: str, note: str) -> DataFrame:
    """Rows after content-addressed edits. An edit applies only if it finds exactly the expected number of rows; the old value goes to a note.

    edit_status: applied, refused or none.
    """
    found = rows.join(edits.select(*keys), keys).groupBy(*keys).agg(F.count("*").alias("_found"))
    plan = edits.join(found, keys, "left").select(*keys, F.col(new).alias("_new"), F.coalesce(F.col("_found") == F.col(expected), F.lit(False)).alias("_fits"))
    out = rows.join(plan, keys, "left")
    fits = F.coalesce("_fits", F.lit(False))
    return out.select(*(F.when(fits, F.col("_new")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in rows.columns), F.when(fits, F.concat(F.lit("was "), F.col(column).cast("string"))).alias(note), F.when(fits, "applied").when(F.col("_fits").isNotNull(), "refused").otherwise("none").alias("edit_status"))


def would_cross(forms: DataFrame, form: str, tagged: DataFrame, tag: str, entity: str, bar: int, most: int = 2, stem: int = 5) -> DataFrame:
    """For each form without a tag the first tags that it looks like, with uses, have, after, and whether the tag crosses the bar.

    forms: distinct (form, entity); tagged: distinct (tag, entity). They look alike if one holds the first letters of the
    other; what is joined on are pieces of distinct forms and tags, so no form is compared with every tag.
    """
    uses = forms.groupBy(form).agg(F.count("*").alias("uses"))
    have = tagged.groupBy(tag).agg(F.count("*").alias("have"))
    pieces = lambda x: F.flatten(F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.transform(F.sequence(F.lit(1), F.lit(stem)), lambda n: F.substring(x, i, n))))
    keys = lambda x, mine: F.explode(F.array_distinct(F.concat(F.transform(pieces(x), lambda p: F.concat(F.lit(mine), p)), F.array(F.concat(F.lit("<" if mine == ">" else ">"), F.substring(x, 1, stem))))))
    near = uses.where(F.length(form) > 0).select(form, keys(F.col(form), "<").alias("_k")).join(have.where(F.length(tag) > 0).select(tag, keys(F.col(tag), ">").alias("_k")), "_k").select(form, tag).distinct()
    near = near.withColumn("_n", F.row_number().over(Window.partitionBy(form).orderBy(tag))).where(F.col("_n") <= most).drop("_n")
    fresh = near.join(forms, form).join(tagged, [tag, entity], "left_anti").groupBy(form, tag).agg(F.count("*").alias("_fresh"))
    after = F.col("have") + F.coalesce("_fresh", F.lit(0))
    out = near.join(uses, form).join(have, tag).join(fresh, [form, tag], "left")
    return out.select(form, "uses", tag, "have", after.alias("after"), ((F.col("have") < bar) & (after >= bar)).alias("crosses"))


def hit_summary(hits: DataFrame, entity: str, doc: str, pos: str, text: str, compared: str, state: str, tags: str, most: int = 8, cut: int = 220) -> DataFrame:
    """One row for each entity: sentences, docs, both again without comparisons, review states, the most frequent tags of
    sentences without a comparison, and the first such sentence. A null state is undecided; null tags are none."""
    plain = ~F.coalesce(F.col(compared), F.lit(False))
    first = F.min(F.when(plain, F.struct(doc, pos, F.substring(text, 1, cut).alias("_t")))).alias("_first")
    per = hits.groupBy(entity, doc).agg(F.count("*").alias("_s"), F.count_if(plain).alias("_p"), first)
    per = per.groupBy(entity).agg(F.sum("_s").alias("sentences"), F.count("*").alias("docs"), F.sum("_p").alias("plain_sentences"), F.count_if(F.col("_p") > 0).alias("plain_docs"), F.min("_first").alias("_first"))
    states = hits.groupBy(entity, F.coalesce(state, F.lit("undecided")).alias("_state")).agg(F.count("*").alias("_n"))
    states = states.groupBy(entity).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "_state", F.col("_n").cast("string")))), ";").alias("states"))
    counted = hits.where(plain).select(entity, F.explode(tags).alias("_tag")).groupBy(entity, "_tag").agg(F.count("*").alias("_n"))
    counted = counted.withColumn("_r", F.row_number().over(Window.partitionBy(entity).orderBy(F.col("_n").desc(), "_tag"))).where(F.col("_r") <= most)
    best = F.transform(F.array_sort(F.collect_list(F.struct("_r", "_tag", "_n"))), lambda x: F.concat_ws(" ", x["_tag"], x["_n"].cast("string")))
    out = per.join(states, entity).join(counted.groupBy(entity).agg(F.array_join(best, ", ").alias("tags")), entity, "left")
    return out.select(entity, "sentences", "docs", "plain_sentences", "plain_docs", "states", F.coalesce("tags", F.lit("")).alias("tags"), F.col("_first._t").alias("example"))
