"""Queries over posts_filtered.raw_post_json."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.nested import Entity, flat_table, plan_for, schema_graph, shred
from ..session import table, written

#: Comments and replies in all layouts; the kind "more" marks comments that weren't loaded.
COMMENT = Entity(
    "comment",
    (("*", "comments"), ("*", "replies"), ("children", "data"), ("*", "discussion"), ("*", "children"), ("*", "items"), ("replies", "data")),
    key=("id", "cid", "comment_id"),
    unless=(("kind", "more"),),
)


def comment_tables(posts: DataFrame) -> DataFrame:
    """record, row, parent_row, table, comment_id, parent_ref: the flat tables of comments of all layouts, one below the other. parent_row is the
    row of the comment that encloses it; parent_ref the parent's id where the layout names it instead."""
    posts = posts.select("idx", "raw_post_json")
    rows = shred(posts, "idx", "raw_post_json", plan_for(posts, "raw_post_json"), entities=(COMMENT,), only_entities=True, columns={"parent_id"})
    return rows.select("record", "row", "parent_row", "table", F.col("entity_key").alias("comment_id"), F.col("cols")["parent_id"].alias("parent_ref"))


def comments(posts: DataFrame) -> DataFrame:
    """idx, comment_id, parent_id of the comments at any depth; parent_id is '' on the post itself. A comment present twice in a record
    is one row. Null and broken records have no rows. The parent's id comes through the foreign key (record, parent_row)."""
    rows = comment_tables(posts)
    # only comments that have replies are looked up, and only replies look up; the shredding is written once for both
    rows = written(rows)
    held = rows.where("parent_row is not null and parent_ref is null")
    above = rows.select(F.col("record"), F.col("row").alias("parent_row"), F.col("comment_id").alias("parent_id"))
    below = held.select("record", "parent_row", "comment_id").join(above, ["record", "parent_row"]).select("record", "comment_id", "parent_id")
    other = rows.where("parent_row is null or parent_ref is not null").select("record", "comment_id", F.coalesce("parent_ref", F.lit("")).alias("parent_id"))
    return below.unionByName(other).distinct().select(F.col("record").alias("idx"), "comment_id", "parent_id")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return comments(table(spark, d, "posts_filtered"))


def p1_schema_graph(spark: SparkSession, d: str) -> DataFrame:
    return schema_graph(table(spark, d, "posts_filtered"), "raw_post_json")


def p1_media(spark: SparkSession, d: str) -> DataFrame:
    """The table of media, whose rows hang below the post."""
    posts = table(spark, d, "posts_filtered")
    rows = shred(posts, "idx", "raw_post_json", plan_for(posts, "raw_post_json"), tables={"media"})
    return flat_table(rows, "media", {"media_id": "id", "kind": "kind"}).where("media_id is not null").select(F.col("record").alias("idx"), "ordinal", "media_id", "kind")


def p1_posts(spark: SparkSession, d: str) -> DataFrame:
    """The root table with the inlined singletons of all layouts side by side."""
    posts = table(spark, d, "posts_filtered")
    rows = shred(posts, "idx", "raw_post_json", plan_for(posts, "raw_post_json"), tables={"$"})
    c = lambda *paths: F.coalesce(*(F.col("cols")[p] for p in paths))
    return rows.select(
        F.col("record").alias("idx"), c("title", "post.title", "post_details.title").alias("title"), c("authorType", "author_type", "post.authorType", "observationType").alias("author_type"), c("meta.scraper").alias("scraper")
    )


def media_all(posts: DataFrame) -> DataFrame:
    """idx, layout (media or gallery), ordinal, media_id, kind: the media of all layouts. media_id is null where an item has none."""
    posts = posts.select("idx", "raw_post_json")
    rows = shred(posts, "idx", "raw_post_json", plan_for(posts, "raw_post_json"), tables={"media", "gallery"})
    # the object media that holds the gallery is a row of its table, too, but no item
    items = rows.where("table = 'gallery' or cols['id'] is not null or cols['kind'] is not null")
    return items.select(F.col("record").alias("idx"), F.col("table").alias("layout"), "ordinal", F.col("cols")["id"].alias("media_id"), F.col("cols")["kind"].alias("kind"))


def posts_all(posts: DataFrame) -> DataFrame:
    """idx, post_id, title, author, author_type, scraper: the root table with its author. author and data are tables of their own, as comments
    have them too; the post's rows are those that hang below the root. idx is a key of posts."""
    posts = posts.select("idx", "raw_post_json")
    rows = shred(posts, "idx", "raw_post_json", plan_for(posts, "raw_post_json"), tables={"$", "author", "data"})
    c = lambda m, *paths: F.coalesce(*(F.col(m)[p] for p in paths))
    # joined by (record, root's row) in one aggregation
    own = rows.where("table = '$' or parent_table = '$'").withColumn("root", F.coalesce("parent_row", "row"))
    j = own.groupBy("record", "root").agg(*(F.max_by("cols", F.when(F.col("table") == t, -F.col("row"))).alias(name) for t, name in (("$", "post"), ("author", "author"), ("data", "data"))))
    return j.select(
        F.col("record").alias("idx"), F.coalesce(c("post", "id", "post.id", "data.id"), c("data", "id")).alias("post_id"), c("post", "title", "post.title", "post_details.title").alias("title"), F.coalesce(c("author", "urn", "name"), c("post", "author.urn", "author.name", "author")).alias("author"),
        F.coalesce(c("post", "authorType", "author_type", "post.authorType", "observationType", "author.type"), c("author", "type")).alias("author_type"), c("post", "meta.scraper").alias("scraper"),
    )


def p1_media_all(spark: SparkSession, d: str) -> DataFrame:
    return media_all(table(spark, d, "posts_filtered"))


def p1_posts_all(spark: SparkSession, d: str) -> DataFrame:
    return posts_all(table(spark, d, "posts_filtered"))


QUERIES = {"p1_found": p1_found, "p1_schema_graph": p1_schema_graph, "p1_media": p1_media, "p1_posts": p1_posts, "p1_media_all": p1_media_all, "p1_posts_all": p1_posts_all}

_UNWRAPPED = """
with recursive once as (
  select idx, case when json_valid(raw_post_json) then cast(raw_post_json as json) end as j from posts_filtered
), twice as (
  select idx, case when json_type(j) = 'VARCHAR' then case when json_valid(j ->> '$') then cast(j ->> '$' as json) end
                   when json_type(j) = 'ARRAY' and json_array_length(j) = 1 then j -> 0 else j end as j from once
), records as (select idx, j from twice where json_type(j) = 'OBJECT')
"""

SQL = {
    "p1_posts": _UNWRAPPED
    + """
select idx, coalesce(j ->> '$.title', j ->> '$.post.title', j ->> '$.post_details.title') as title,
       coalesce(j ->> '$.authorType', j ->> '$.author_type', j ->> '$.post.authorType', j ->> '$.observationType') as author_type, j ->> '$.meta.scraper' as scraper
from records""",
    "p1_media": _UNWRAPPED
    + """
select idx, cast(i as int) as ordinal, m ->> '$.id' as media_id, m ->> '$.kind' as kind
from (select idx, generate_subscripts(a, 1) - 1 as i, unnest(a) as m from (select idx, cast(j -> '$.post_details.media' as json[]) as a from records))
where m ->> '$.id' is not null""",
    "p1_found": _UNWRAPPED
    + """, open(idx, parent_id, kind, c) as (
  select idx, '', 'list', unnest(case when json_type(j -> '$.comments') = 'OBJECT' then [j -> '$.comments'] else cast(j -> '$.comments' as json[]) end) from records where json_type(j -> '$.comments') in ('OBJECT', 'ARRAY')
  union all select idx, '', 'tree', unnest(cast(j -> '$.data.children' as json[])) from records where json_type(j -> '$.data.children') = 'ARRAY'
  union all select idx, '', 'map', unnest(json_extract(j, '$.discussion.*')) from records where json_type(j -> '$.discussion') = 'OBJECT'
  union all select idx, '', 'flat', unnest(cast(j -> '$.post.thread.items' as json[])) from records where json_type(j -> '$.post.thread.items') = 'ARRAY'
  union all
  select idx, case kind when 'list' then c ->> '$.id' when 'tree' then c ->> '$.data.id' else c ->> '$.cid' end, kind,
         unnest(case kind when 'list' then case when json_type(c -> '$.replies') = 'ARRAY' then cast(c -> '$.replies' as json[]) else [] end
                          when 'tree' then case when json_type(c -> '$.data.replies') = 'OBJECT' then cast(c -> '$.data.replies.data.children' as json[]) else [] end
                          when 'map' then case when json_type(c -> '$.children') = 'OBJECT' then json_extract(c, '$.children.*') else [] end else [] end)
  from open
), named as (
  select idx, case kind when 'list' then c ->> '$.id' when 'tree' then c ->> '$.data.id' when 'map' then c ->> '$.cid' else c ->> '$.comment_id' end as comment_id,
         case when kind = 'flat' then coalesce(c ->> '$.parent_id', '') else parent_id end as parent_id
  from open where json_type(c) = 'OBJECT' and coalesce(c ->> '$.kind', '') <> 'more'
)
select distinct idx, comment_id, parent_id from named where comment_id is not null""",
}


SQL["p1_posts_all"] = _UNWRAPPED + """
select idx, coalesce(j ->> '$.id', j ->> '$.post.id', j ->> '$.data.id') as post_id, coalesce(j ->> '$.title', j ->> '$.post.title', j ->> '$.post_details.title') as title,
       coalesce(j ->> '$.author.urn', j ->> '$.author.name', case when json_type(j -> '$.author') = 'VARCHAR' then j ->> '$.author' end) as author,
       coalesce(j ->> '$.authorType', j ->> '$.author_type', j ->> '$.post.authorType', j ->> '$.observationType', j ->> '$.author.type') as author_type, j ->> '$.meta.scraper' as scraper
from records"""
SQL["p1_media_all"] = _UNWRAPPED + """, lists as (
  select idx, 'media' as layout, j -> '$.post_details.media' as a from records union all select idx, 'gallery', j -> '$.media.gallery' from records
), items as (select idx, layout, cast(unnest(generate_series(0, cast(json_array_length(a) as bigint) - 1)) as int) as ordinal, unnest(cast(a as json[])) as m from lists where json_type(a) = 'ARRAY')
select idx, layout, ordinal, m ->> '$.id' as media_id, m ->> '$.kind' as kind from items
where json_type(m) <> 'NULL' and (layout = 'gallery' or m ->> '$.id' is not null or m ->> '$.kind' is not null)"""
