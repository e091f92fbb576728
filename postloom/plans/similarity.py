"""Queries of similar labels, seed vocabularies, groups and classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import CLEANUP_SHORT, CLEANUP_STOP, SMALL_STOP, WIDE_STOP
from ..operators import classes as C, grouping as G, seeds as S, similarity as M
from .filtering import _in
from .topics import _L, label_frequency


def jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    return M.similar_pairs(label_frequency(spark, d), "plain", 0.6)


def similar_label_links(spark: SparkSession, d: str) -> DataFrame:
    return M.set_links(label_frequency(spark, d), "plain", 0.6)


def best_synonym(spark: SparkSession, d: str) -> DataFrame:
    freq = label_frequency(spark, d)
    return M.best_matches(freq.where("posts = 1"), freq.where("posts >= 2"), "cleanup", 0.5).withColumn("score", F.round("score", 3))


def singleton_classes(spark: SparkSession, d: str) -> DataFrame:
    return C.singleton_classes(label_frequency(spark, d))


def label_classes(spark: SparkSession, d: str) -> DataFrame:
    return C.label_classes(label_frequency(spark, d)).select("domain", "label", "class")


def simulated_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    freq = label_frequency(spark, d)
    return C.simulated(freq, C.label_classes(freq))


def angle_strip_roots(spark: SparkSession, d: str) -> DataFrame:
    return label_frequency(spark, d).select("domain", "label", S.root(F.col("label")).alias("root"))


def word_order_groups(spark: SparkSession, d: str) -> DataFrame:
    return S.by_tokens(S.by_root(label_frequency(spark, d))).select("domain", "label", "canonical")


def seed_rank_pairs(spark: SparkSession, d: str) -> DataFrame:
    return S.rank_pairs(S.ranked(S.by_tokens(S.by_root(label_frequency(spark, d).where("posts >= 2"))))).select("domain", "label", "better")


def seed_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return S.seed_vocabulary(label_frequency(spark, d))


def token_components(spark: SparkSession, d: str) -> DataFrame:
    return G.token_components(label_frequency(spark, d).where("posts = 1"))


def closure_groups_k2(spark: SparkSession, d: str) -> DataFrame:
    return G.per_domain(label_frequency(spark, d).where("posts = 1"), lambda labels: [(g, "OK") for g in G.closure_groups(labels, 2)])


def split_groups(spark: SparkSession, d: str) -> DataFrame:
    return G.per_domain(label_frequency(spark, d).where("posts = 1"), lambda labels: G.split_groups(labels))


def greedy_overlap_groups(spark: SparkSession, d: str) -> DataFrame:
    return G.per_domain(label_frequency(spark, d).where("posts = 1"), lambda labels: [(g, "OK") for g in G.greedy_groups(labels)], "wide")


QUERIES = {
    f.__name__: f
    for f in (jaccard_pairs, similar_label_links, best_synonym, singleton_classes, label_classes, simulated_vocabulary, angle_strip_roots, word_order_groups, seed_rank_pairs, seed_vocabulary, token_components, closure_groups_k2, split_groups, greedy_overlap_groups)
}


def _tok(c: str, kind: str) -> str:
    pattern = r"[a-z0-9]+(?:\.[a-z0-9]+)*" if kind in ("wide", "small") else "[a-z0-9]+"
    keep = {
        "plain": "true",
        "cleanup": f"t not in {_in(CLEANUP_STOP)} and (length(t) > 2 or t in {_in(CLEANUP_SHORT)})",
        "wide": f"t not in {_in(WIDE_STOP)} and length(t) > 2",
        "small": f"t not in {_in(SMALL_STOP)} and length(t) > 1",
    }[kind]
    return f"list_sort(list_distinct(list_filter(regexp_extract_all(lower({c}), '{pattern}'), lambda t: {keep})))"


_J = "len(list_intersect(a.k, b.k)) / (len(a.k) + len(b.k) - len(list_intersect(a.k, b.k)))"
_ROOT = f"""(case when regexp_replace(array_to_string(regexp_extract_all(lower(label), '[a-z0-9]+(?:\\.[a-z0-9]+)*'), ' '), '(?:(?:^| )(?:{"|".join(S.ANGLES)}))+$', '') = '' then label
              else regexp_replace(array_to_string(regexp_extract_all(lower(label), '[a-z0-9]+(?:\\.[a-z0-9]+)*'), ' '), '(?:(?:^| )(?:{"|".join(S.ANGLES)}))+$', '') end)"""


def _passes(where: str) -> str:
    return f""", one as (select domain, label, posts, {_ROOT} as root, {_tok('label', 'small')} as k from freq where {where}),
p1 as (select *, first_value(label) over (partition by domain, root order by posts desc, length(label), label) as first from one),
p2 as (select *, case when len(k) = 0 then first else first_value(first) over (partition by domain, k order by posts desc, length(label), label) end as canonical from p1),
sums as (select domain, canonical as label, sum(posts) as posts from p2 group by 1, 2),
ranks as (select *, {_tok('label', 'small')} as k, row_number() over (partition by domain order by posts desc, label) as rank from sums),
better as (select b.domain, b.label, b.rank, a.label as better, a.rank as better_rank from ranks a join ranks b on a.domain = b.domain and a.rank < b.rank and len(a.k) > 0 and len(b.k) > 0 and {_J} >= 0.75)
"""


_SETS = ", sets as (select distinct domain, " + _tok("label", "plain") + " as k from freq), kept as (select * from sets where len(k) > 0)"
_PAIRS = f", pairs as (select a.domain, array_to_string(a.k, ' ') as set_a, array_to_string(b.k, ' ') as set_b, {_J} as score from kept a join kept b on a.domain = b.domain and a.k < b.k and {_J} >= 0.6)"
_BEST_B = f""", cl as (select *, {_tok('label', 'plain')} as k, regexp_matches(label, '{C.NAMED}') as named, len(list_filter(regexp_split_to_array(trim(label), '\\s+'), lambda w: w <> '')) >= 7 as noise from freq),
mm as (select a.domain, a.label, b.label as match, row_number() over (partition by a.domain, a.label order by {_J} desc, b.label) as r from cl a join cl b on a.domain = b.domain and a.posts = 1 and b.posts >= 2 and not a.noise and len(a.k) > 0 and len(b.k) > 0
        and (not a.named or b.named) and {_J} >= 0.3 - 1e-9),
classes as (select c.domain, c.label, case when noise then 'noise' when m.match is not null then 'fixable_synonym' when named then 'named_specific' else 'distinct' end as class, case when not noise then m.match end as match
            from cl c left join mm m on m.r = 1 and c.domain = m.domain and c.label = m.label where c.posts = 1)
"""

SQL = {
    "jaccard_pairs": _L + _SETS + _PAIRS + " select * from pairs",
    "similar_label_links": _L
    + _SETS
    + _PAIRS
    + f""", m as (select domain, label, array_to_string({_tok('label', 'plain')}, ' ') as set_key from freq)
select domain, label, set_key, (select count(*) from pairs p where p.domain = m.domain and (p.set_a = m.set_key or p.set_b = m.set_key)) as links from m""",
    "best_synonym": _L
    + f""", k as (select *, {_tok('label', 'cleanup')} as k from freq), m as (
  select a.domain, a.label, b.label as canonical, {_J} as score, row_number() over (partition by a.domain, a.label order by {_J} desc, b.label) as r
  from k a join k b on a.domain = b.domain and a.posts = 1 and b.posts >= 2 and len(a.k) > 0 and len(b.k) > 0 and {_J} >= 0.5)
select domain, label, canonical, round(score, 3) as score from m where r = 1""",
    "singleton_classes": _L
    + f""", k as (select *, {_tok('label', 'wide')} as k, regexp_matches(label, '\\b\\d+\\.\\d+\\b') or (len(list_filter(regexp_split_to_array(trim(label), '\\s+'), lambda w: w <> '')) <= 4 and ({" or ".join(f"contains(label, '{t}')" for t in C.TECHNOLOGIES)})) as named from freq),
m as (select a.domain, a.label, max({_J}) as score from k a join k b on a.domain = b.domain and a.posts = 1 and b.posts >= 2 and len(a.k) > 0 and len(b.k) > 0 group by 1, 2)
select k.domain, k.label, case when named then 'named_specific' when score >= 0.5 then 'fixable_synonym' when score >= 0.3 then 'weak_synonym' else 'distinct_concept' end as class
from k left join m on k.domain = m.domain and k.label = m.label where posts = 1""",
    "label_classes": _L + _BEST_B + " select domain, label, class from classes",
    "simulated_vocabulary": _L
    + _BEST_B
    + """ select f.domain, coalesce(c.match, f.label) as label, cast(sum(f.posts) as bigint) as posts from freq f left join classes c on f.domain = c.domain and f.label = c.label where coalesce(c.class, '') <> 'noise' group by 1, 2""",
    "angle_strip_roots": _L + f" select domain, label, {_ROOT} as root from freq",
    "word_order_groups": _L + _passes("true") + " select domain, label, canonical from p2",
    "seed_rank_pairs": _L + _passes("posts >= 2") + " select domain, label, better from better",
    "seed_vocabulary": _L.replace("\nwith labelled", "\nwith recursive labelled")
    + _passes("posts >= 2")
    + """, parents as (select domain, label, arg_min(better, better_rank) as parent from better group by 1, 2),
up(domain, label, seed) as (select domain, label, label from ranks union all select u.domain, u.label, p.parent from up u join parents p on u.domain = p.domain and u.seed = p.label),
tops as (select u.domain, u.label, u.seed from up u left join parents p on u.domain = p.domain and u.seed = p.label where p.label is null)
select t.domain, t.seed, cast(sum(p2.posts) as bigint) as posts, count(*) as labels from p2 join tops t on p2.domain = t.domain and p2.canonical = t.label group by 1, 2""",
    "token_components": _L.replace("\nwith labelled", "\nwith recursive labelled")
    + f""", parts as (select domain, label, unnest({_tok('label', 'cleanup')}) as token from freq where posts = 1),
reach(domain, label, other) as (select domain, label, label from parts union select r.domain, r.label, b.label from reach r join parts a on r.domain = a.domain and r.other = a.label join parts b on a.domain = b.domain and a.token = b.token)
select domain, label, min(other) as component from reach group by 1, 2""",
}
