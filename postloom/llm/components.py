"""Connected groups of pairwise matches by hash-to-min.

Each vertex v holds a cluster set C(v), at first its neighbours and itself. In a round it sends C(v) to the smallest member m = min C(v),
and m to all members; C becomes what was received. In the end the smallest vertex of a component holds all of it and every other vertex
holds just that one. A round's messages (m, u) and (u, m) always go in pairs, so that u is in C(v) just when v is in C(u): the sets are kept as
undirected edges (a, b), a < b, never as arrays, and half of the rows suffice. The minimum is a grouped aggregate with a partial step, and
no task ever holds a cluster. Rounds are logarithmic in the length of chains; each is written to the shared folder.

Settled components leave: a vertex with one neighbour, a smaller one, marks their edge (leaf); when all edges of a vertex that is the
smallest of its set are marked, the component is a star around it, which further rounds would only repeat.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, drop_path, has_path, new_path, written
from .salted import HOT, lookup


def hash_to_min(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """vertex, group: for each vertex of the edges the smallest vertex linked with it directly or indirectly.

    Vertices are of any type with an order (text: by bytes); whole numbers are the cheapest. Self links give a group of one; edges with a
    null end are left out; repeated edges count once; no edges give no rows. Stops with an error if max_rounds don't suffice, rather than
    with wrong groups.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    own = e.where("a = b").select("a", "b")
    state = e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(False).alias("leaf"), F.lit(False).alias("done")).distinct()
    state = written(state)  # read twice by a round
    most = state.count()
    settled = [own]
    path = None
    for _ in range(max_rounds):
        before, path = path, new_path(spark)
        # one folder for the edges of settled components, one for the others; that it is absent says that there are none
        _round(state, most).write.partitionBy("done").parquet(path)
        if before:
            drop_path(spark, f"{before}/done=false")
        else:
            discard(state)
        part = lambda done: spark.read.schema(state.schema).parquet(f"{path}/done={done}").withColumn("done", F.lit(done == "true"))  # noqa: B023, E731
        if has_path(spark, f"{path}/done=true"):
            settled.append(part("true").select("a", "b"))
        if not has_path(spark, f"{path}/done=false"):
            stars = reduce(DataFrame.unionByName, settled)
            return stars.select(F.explode(F.array(F.struct(F.col("b").alias("vertex"), F.col("a").alias("group")), F.struct(F.col("a").alias("vertex"), F.col("a").alias("group")))).alias("x")).groupBy("x.vertex").agg(F.min("x.group").alias("group"))
        state = part("false")
        # an edge sends at most two on, so a count is needed only where that bound doesn't tell
        most = most * 2 if most * 2 <= HOT else state.count()
    raise RuntimeError(f"not stable after {max_rounds} rounds")


def _round(state: DataFrame, most: int) -> DataFrame:
    """The next state. No vertex has more than `most` neighbours: the number of edges, which tells that none is hot once few are left."""
    # the cluster sets: each edge is seen from both ends
    seen = state.select(F.explode(F.array(F.struct(F.col("b").alias("v"), F.col("a").alias("u")), F.struct(F.col("a").alias("v"), F.col("b").alias("u")))).alias("x"), "leaf").select("x.v", "x.u", "leaf")
    least = seen.groupBy("v").agg(F.least("v", F.min("u")).alias("m"), F.count("*").alias("n"), F.count_if(F.col("leaf") & (F.col("v") < F.col("u"))).alias("leaves"))
    least = least.withColumns({"settled": (F.col("m") == F.col("v")) & (F.col("leaves") == F.col("n")), "single": (F.col("n") == 1) & (F.col("m") < F.col("v"))}).drop("leaves")
    joined = lookup(seen, least, ["v"], "n", HOT) if most > HOT else seen.join(least.drop("n"), "v")
    row = lambda low, high, leaf, done: F.struct(low.alias("a"), high.alias("b"), leaf.alias("leaf"), done.alias("done"))
    v, u, m = F.col("v"), F.col("u"), F.col("m")
    sent = (
        F.when(m == v, row(v, u, F.col("leaf"), F.col("settled")))  # the smallest keeps its set
        .when(m < u, row(m, u, F.lit(False), F.lit(False)))
        .when(F.col("single") & ~F.col("leaf"), row(u, v, F.lit(True), F.lit(False)))  # u is m: nothing to send but that v is a leaf
    )
    out = joined.select(sent.alias("x")).where("x is not null").select("x.*")
    return out.groupBy("a", "b").agg(F.max("leaf").alias("leaf"), F.max("done").alias("done"))


def normal_label(c: Column) -> Column:
    """Lower-cased, trimmed, inner white space as one blank."""
    return F.btrim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def match_groups(matches: DataFrame, decision: str = "APPLY") -> DataFrame:
    """topic_domain, label, group_label of all labels in a table of matches with the columns of anchor_pattern_review.

    A group of labels is split at '|'. Blank, null and n/a aren't labels. Only rows with the decision (trimmed, any case) link their labels;
    a row's labels are linked with its smallest one, which gives the same groups as all pairs. A null domain is a domain of its own.

    Labels are numbered once, in the order of domain and bytes, so that the rounds carry whole numbers; the texts come back at the end.
    """
    rows = matches.select(
        F.monotonically_increasing_id().alias("r"),
        F.col("topic_domain").alias("d"),
        F.coalesce(F.upper(F.btrim("human_decision", F.lit(" \t\n\r"))) == decision, F.lit(False)).alias("links"),
        F.array_distinct(
            F.filter(
                F.transform(F.concat(F.split(F.coalesce("raw_label_or_group", F.lit("")), r"\|"), F.array(F.coalesce("proposed_canonical", F.lit("")))), normal_label),
                lambda x: (x != "") & (x != "n/a"),
            )
        ).alias("labels"),
    ).select("r", "d", "links", F.explode("labels").alias("label"))  # apart, as rows are numbered before they are exploded
    # a null domain sorts and joins as a struct's null field
    rows = rows.select("r", "links", F.struct(F.coalesce("d", F.lit("")).alias("d"), F.col("d").isNull().alias("no_d"), "label").alias("key"))
    rows = written(rows)  # parsed once
    named = rows.groupBy("key").agg(F.count_if("links").alias("n"))
    numbered = written(named.sort("key").select(F.monotonically_increasing_id().alias("v"), "key", "n"))
    linked = lookup(rows.where("links").select("r", "key"), numbered.where("n > 0"), ["key"], "n", HOT).groupBy("r").agg(F.collect_set("v").alias("vs"))  # one row's labels
    edges = linked.where(F.size("vs") > 1).select(F.array_min("vs").alias("a"), F.explode("vs").alias("b")).where("a <> b")
    groups = hash_to_min(edges)
    discard(rows)  # the rounds are written, and nothing else reads them
    found = numbered.select("v", "key").join(groups.withColumnRenamed("vertex", "v"), "v", "left")
    sizes = groups.groupBy(F.col("group").alias("v")).agg(F.count("*").alias("n"))
    heads = sizes.join(numbered.select("v", "key"), "v").select(F.col("v").alias("group"), F.col("key.label").alias("group_label"), "n")
    named_groups = lookup(found.where("group is not null"), heads, ["group"], "n", HOT).select("key", "group_label")
    alone = found.where("group is null").select("key", F.col("key.label").alias("group_label"))
    return named_groups.unionByName(alone).select(F.when(~F.col("key.no_d"), F.col("key.d")).alias("topic_domain"), F.col("key.label").alias("label"), "group_label")
