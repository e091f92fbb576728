"""SQL of the sequential groupings, as folds over lists, and a query of the split groups by their members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import grouping as G
from .similarity import _J, _tok
from .topics import _L, label_frequency


def split_group_members(spark: SparkSession, d: str) -> DataFrame:
    """domain, label, least, status: the groups of labels with one post, large ones split; least is the smallest label of the group."""
    rows = G.per_domain(label_frequency(spark, d).where("posts = 1"), lambda labels: G.split_groups(labels))
    return rows.select("domain", "label", F.min("label").over(Window.partitionBy("domain", "group_no")).alias("least"), "status")


QUERIES = {"split_group_members": split_group_members}

_REC = _L.replace("\nwith labelled", "\nwith recursive labelled")


def _closure(name: str, source: str, shared: int) -> str:
    """CTEs up to `name`(domain, path, group_no, members): closure groups with so many shared tokens of source (domain, path, label)."""
    return f""", {name}_in as (select domain, path, list({{'l': label, 'k': {_tok('label', 'cleanup')}}} order by label) as rest from {source} group by 1, 2),
{name}_step(domain, path, rest, cur, have, groups) as (
  select domain, path, rest, []::varchar[], []::varchar[], []::varchar[][] from {name}_in
  union all
  select domain, path,
         case when len(cur) = 0 then rest[2:] else list_filter(rest, lambda x: len(list_intersect(x.k, have)) < {shared}) end,
         case when len(cur) = 0 then [rest[1].l] when len(list_filter(rest, lambda x: len(list_intersect(x.k, have)) >= {shared})) > 0
              then list_concat(cur, list_transform(list_filter(rest, lambda x: len(list_intersect(x.k, have)) >= {shared}), lambda x: x.l)) else []::varchar[] end,
         case when len(cur) = 0 then rest[1].k else list_distinct(list_concat(have, flatten(list_transform(list_filter(rest, lambda x: len(list_intersect(x.k, have)) >= {shared}), lambda x: x.k)))) end,
         case when len(cur) > 1 and len(list_filter(rest, lambda x: len(list_intersect(x.k, have)) >= {shared})) = 0 then list_append(groups, cur) else groups end
  from {name}_step where len(cur) > 0 or len(rest) > 0
), {name} as (
  select domain, path, unnest(generate_series(0, len(groups) - 1)) as group_no, unnest(groups) as members from {name}_step where len(cur) = 0 and len(rest) = 0
)
"""


def _levels(most: int = 9, depth: int = 3) -> str:
    """CTEs up to members(domain, label, least, status): the split groups of lone (domain, path, label)."""
    out = _closure("g1", "lone", 1)
    for k in range(2, depth + 2):
        out += f", in{k} as (select domain, path || '/' || group_no as path, unnest(members) as label from g{k - 1} where len(members) > {most})" + _closure(f"g{k}", f"in{k}", k)
    parts = [f"select domain, unnest(members) as label, list_min(members) as least, 'OK' as status from g{k} where len(members) <= {most}" for k in range(1, depth + 2)]
    parts.append(f"select domain, unnest(members), list_min(members), 'MANUAL_REVIEW_REQUIRED' from g{depth + 1} where len(members) > {most}")
    parts += [f"select i.domain, i.label, i.label, 'SINGLETON_NO_GROUP' from in{k} i where not exists (select 1 from g{k} g where g.domain = i.domain and g.path = i.path and list_contains(g.members, i.label))" for k in range(2, depth + 2)]
    return out + ", members as (" + " union all ".join(parts) + ")\n"


_LONE = ", lone as (select domain, '' as path, label from freq where posts = 1)"


SQL = {
    "closure_groups_k2": _REC + _LONE + _closure("g", "lone", 2) + "select domain, unnest(members) as label, group_no, 'OK' as status from g",
    "greedy_overlap_groups": _REC
    + f""", ordered as (select domain, label, {_tok('label', 'wide')} as k, row_number() over (partition by domain order by label) as i, count(*) over (partition by domain) as n from freq where posts = 1),
fold(domain, i, n, groups) as (
  select distinct domain, 0::bigint, n, []::struct(t varchar[], l varchar[])[] from ordered
  union all
  select f.domain, o.i, f.n, case when len(o.k) = 0 then f.groups
      when coalesce(list_max(list_transform(f.groups, lambda g: len(list_intersect(g.t, o.k)))), 0) = 0 then list_append(f.groups, {{'t': o.k, 'l': [o.label]}})
      else list_transform(f.groups, lambda g, pos: case when pos = list_position(list_transform(f.groups, lambda h: len(list_intersect(h.t, o.k))), list_max(list_transform(f.groups, lambda h: len(list_intersect(h.t, o.k)))))
                                                 then {{'t': list_distinct(list_concat(g.t, o.k)), 'l': list_append(g.l, o.label)}} else g end) end
  from fold f join ordered o on f.domain = o.domain and o.i = f.i + 1
), ended as (select domain, unnest(generate_series(0, len(groups) - 1)) as group_no, unnest(groups) as g from fold where i = n)
select domain, unnest(g.l) as label, group_no, 'OK' as status from ended""",
    "split_group_members": _REC + _LONE + _levels() + "select domain, label, least, status from members",
    "split_groups": _REC + _LONE + _levels() + "select domain, label, dense_rank() over (partition by domain order by least) - 1 as group_no, status from members",
    "merge_proposals": _REC
    + f""", ck as (select domain, canonical as label, posts, {_tok('canonical', 'cleanup')} as k from canonicals),
syn as (select a.domain, a.label, b.label as canonical, {_J} as score, row_number() over (partition by a.domain, a.label order by {_J} desc, b.label) as r
        from ck a join ck b on a.domain = b.domain and a.posts = 1 and b.posts >= 2 and len(a.k) > 0 and len(b.k) > 0 and {_J} >= 0.5 - 1e-9),
lone as (select domain, '' as path, label from ck where posts = 1 and not exists (select 1 from syn where syn.domain = ck.domain and syn.label = ck.label))"""
    + _levels()
    + """select domain, 'synonym' as stage, label as raw_label_or_group, canonical as proposed_canonical, round(score, 3) as score, 'PENDING_REVIEW' as verdict from syn where r = 1
union all select domain, 'group', string_agg(label, ' | ' order by label), arg_max(label, (length(label), label)), null, case when status = 'OK' then 'PENDING_REVIEW' else status end from members where status <> 'SINGLETON_NO_GROUP' group by domain, least, status
union all select l.domain, 'single', l.label, null, null, 'NO_MATCH' from lone l where not exists (select 1 from members m where m.domain = l.domain and m.label = l.label and m.status <> 'SINGLETON_NO_GROUP')""",
}
