"""Queries that build and audit a vocabulary with a model, and audits of columns and groups. The models here are stand-ins that judge nothing; they
show the runners, and SQL can say what they answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import number, strip, text_or_empty
from ..operators import audit as A, cells as C, documented as D, labels as L, merges as M, similarity as S, vocabulary as V
from ..operators.classes import label_classes, singleton_classes
from ..operators.grouping import token_components
from ..operators.labeling import batches_exact
from ..operators.topics import labels_of
from ..session import table
from .cells import _eligible
from .filtering import _in
from .similarity import _BEST_B, _J, _tok
from .topics import _L, canonical_frequency, label_frequency, self_map_repair


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tagged_posts_v2_clean")


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "vocabulary").select(F.col("topic_domain").alias("domain"), "topic")


def _mapped(spark: SparkSession, d: str, **more) -> DataFrame:
    return V.map_pass(label_frequency(spark, d), _seeds(spark, d), V.prefix_model(), pause=0.0, **more)


def seed_size_hints(spark: SparkSession, d: str) -> DataFrame:
    return V.size_hints(label_frequency(spark, d))


def seed_pass(spark: SparkSession, d: str) -> DataFrame:
    return V.seed_pass(label_frequency(spark, d), V.frequency_model(), pause=0.0)


def map_label_batches(spark: SparkSession, d: str) -> DataFrame:
    return V.label_batches(label_frequency(spark, d))


def growing_map(spark: SparkSession, d: str) -> DataFrame:
    """Labels by batches of 60 over a vocabulary that grows."""
    return _mapped(spark, d)


def growing_map_failures(spark: SparkSession, d: str) -> DataFrame:
    """As growing_map, where batches with a label about compliance aren't answered."""
    return V.map_pass(label_frequency(spark, d), _seeds(spark, d), V.prefix_model(fails="compliance"), tries=2, pause=0.0).select("domain", "label", "canonical", "batch", (F.col("kind") == "fallback").alias("fallback"))


def mapping_counters(spark: SparkSession, d: str) -> DataFrame:
    return V.mapping_counters(_mapped(spark, d))


def invention_alerts(spark: SparkSession, d: str) -> DataFrame:
    return V.invention_alerts(_mapped(spark, d), 8)


def mapping_projection(spark: SparkSession, d: str) -> DataFrame:
    """A trial of one batch a domain, and what it says of all labels."""
    return V.projection(_mapped(spark, d, first_batches=1), label_frequency(spark, d))


def invented_topics(spark: SparkSession, d: str) -> DataFrame:
    return V.invented(self_map_repair(spark, d), _seeds(spark, d))


def consistency_pairs(spark: SparkSession, d: str) -> DataFrame:
    return V.consistency(self_map_repair(spark, d), _seeds(spark, d))


def unknown_merge_labels(spark: SparkSession, d: str) -> DataFrame:
    """Single labels of the merge table that the vocabulary of their domain doesn't have."""
    rows = table(spark, d, "anchor_pattern_review").where(~F.contains(text_or_empty("raw_label_or_group"), F.lit("|"))).select(F.col("topic_domain").alias("domain"), F.lower(strip(text_or_empty("raw_label_or_group"))).alias("label")).distinct()
    return V.unknown_targets(rows, _seeds(spark, d).withColumnRenamed("topic", "canonical"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    freq = label_frequency(spark, d)
    return S.best_matches(freq.where("posts = 1"), freq.where("posts >= 2"), "cleanup", 0.5)


def synonym_audit(spark: SparkSession, d: str) -> DataFrame:
    return A.audit_pairs(_candidates(spark, d), A.shared_word_model(3), pause=0.0).select("domain", "label", "canonical", "verdict", "reason")


def synonym_audit_dry(spark: SparkSession, d: str) -> DataFrame:
    return A.audit_pairs(_candidates(spark, d), None).groupBy("domain", "verdict").agg(F.count("*").alias("pairs"))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    parts = token_components(label_frequency(spark, d).where("posts = 1"))
    sizes = parts.groupBy("domain", "component").agg(F.count("*").alias("n")).where("n between 2 and 9")
    # groups of more than nine labels aren't audited, as no prompt is for them
    return parts.join(sizes, ["domain", "component"]).groupBy("domain", "component").agg(F.sort_array(F.collect_list("label")).alias("labels")).withColumnRenamed("component", "group_no")


def group_audit(spark: SparkSession, d: str) -> DataFrame:
    return A.audit_groups(_groups(spark, d), A.common_word_model(), pause=0.0).select("domain", F.col("group_no").alias("component"), F.array_join("labels", " | ").alias("labels"), "verdict", F.array_join("outliers", " | ").alias("outliers"))


def review_disagreements(spark: SparkSession, d: str) -> DataFrame:
    """People's decisions that approve or reject against a second review by risk words."""
    rows = table(spark, d, "anchor_pattern_review").select(M.decision(F.col("human_decision")).alias("v"), F.when(F.size(M.risk_words(F.col("raw_label_or_group"), F.col("proposed_canonical"))) > 0, "REJECT").otherwise("APPROVE").alias("second"))
    return A.disagreements(rows.where("v in ('APPLY', 'REJECT')").select(F.when(F.col("v") == "APPLY", "APPROVE").otherwise("REJECT").alias("first"), "second"), "first", "second")


def _merges(spark: SparkSession, d: str) -> DataFrame:
    """Applied merges of single labels into a smaller one, so that none run in a circle."""
    low = lambda c: F.lower(strip(text_or_empty(c)))
    rows = table(spark, d, "anchor_pattern_review").where(M.decision(F.col("human_decision")) == "APPLY").select(F.col("topic_domain").alias("domain"), low("raw_label_or_group").alias("label"), low("proposed_canonical").alias("canonical"))
    return rows.where(~F.contains("label", F.lit("|")) & ~F.col("label").isin("", "n/a") & ~F.col("canonical").isin("", "n/a") & (F.col("canonical") < F.col("label")))


def merge_targets(spark: SparkSession, d: str) -> DataFrame:
    """Where each merged label ends when merges cascade."""
    return A.resolve_merges(_merges(spark, d))


def merged_map(spark: SparkSession, d: str) -> DataFrame:
    """A map of the merge table's own labels, with the merges applied."""
    m = _merges(spark, d)
    names = m.select("domain", "label").unionByName(m.select("domain", F.col("canonical").alias("label"))).distinct()
    return A.apply_merges(names.select("domain", F.col("label").alias("raw_label"), F.col("label").alias("canonical")), m)


def singleton_seed_scores(spark: SparkSession, d: str) -> DataFrame:
    """Of each label with one post the highest similarity to a topic of the vocabulary, from 0.3."""
    best = S.best_matches(label_frequency(spark, d).where("posts = 1"), _seeds(spark, d).select("domain", F.col("topic").alias("label")), "wide", 0.3)
    return best.select("domain", "label", F.round("score", 6).alias("score"))


def _distinct_groups(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    freq = label_frequency(spark, d)
    classes = singleton_classes(freq)
    return freq, classes, token_components(classes.where("class = 'distinct_concept'"), "wide")


def group_size_bands(spark: SparkSession, d: str) -> DataFrame:
    """Groups of distinct labels with one post, linked by shared words, by their size."""
    return D.group_bands(_distinct_groups(spark, d)[2])


def group_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Posts covered if such groups became topics, beside recurring labels and those that are synonyms of one."""
    freq, classes, groups = _distinct_groups(spark, d)
    synonyms = classes.where("class in ('fixable_synonym', 'weak_synonym')").select("domain", F.lit(1).cast("bigint").alias("posts"))
    base = freq.where("posts >= 2").select("domain", "posts").unionByName(synonyms).groupBy("domain").agg(F.sum("posts").alias("posts"))
    return D.group_coverage(groups, freq, base)


def simulated_viability(spark: SparkSession, d: str) -> DataFrame:
    freq = label_frequency(spark, d)
    posts = labels_of(_tagged(spark, d)).where(~F.col("label").isin("", "unclassified") & F.col("post_type").isin(*L.TRANSFER_TYPES) & F.lower("platform").isin("linkedin", "reddit"))
    posts = posts.select("domain", "label", C.audience(F.col("audience_room_name"), C.AUDIENCES).alias("audience"), F.when(F.lower("platform") == "linkedin", "li").otherwise("rd").alias("side"))
    return C.simulated_viability(posts, label_classes(freq))


def cell_shares(spark: SparkSession, d: str) -> DataFrame:
    """How sentiment, type and stance are spread over the posts of each both-sided cell."""
    return C.shares(C.eligible(_tagged(spark, d)))


def domain_case_repair(spark: SparkSession, d: str) -> DataFrame:
    return _tagged(spark, d).groupBy(text_or_empty("topic_broad").alias("topic_broad")).agg(F.count("*").alias("posts")).withColumn("repaired", L.repaired_case("topic_broad"))


def column_audit(spark: SparkSession, d: str) -> DataFrame:
    """Every column of the posts: how many rows have a value, and whether its name is that of a person's column."""
    return L.column_audit(table(spark, d, "posts_filtered"))


def author_id_audit(spark: SparkSession, d: str) -> DataFrame:
    """Posts and different authors of each room and platform, by the first author column that has a value."""
    posts = table(spark, d, "posts_filtered")
    rows = posts.select(strip(text_or_empty("audience_room_name")).alias("room"), F.lower(strip(text_or_empty("platform"))).alias("platform"), F.nullif(L.first_id(posts), F.lit("")).alias("who"))
    return rows.groupBy("room", "platform").agg(F.count("*").alias("posts"), F.countDistinct("who").alias("authors"))


def value_counts_marked(spark: SparkSession, d: str) -> DataFrame:
    return L.value_counts_marked(_tagged(spark, d), ("platform", "audience_room_name", "topic_broad", "sentiment", "stance", "post_type"))


def label_batches_exact(spark: SparkSession, d: str) -> DataFrame:
    """Posts of each batch of exactly 20, the last aside."""
    return batches_exact(table(spark, d, "posts_clean_v2")).groupBy("batch").agg(F.count("*").alias("posts"))


def true_coverage(spark: SparkSession, d: str) -> DataFrame:
    return D.true_coverage(canonical_frequency(spark, d))


def agreement_curve(spark: SparkSession, d: str) -> DataFrame:
    """Of decided matches by score, how many are applied."""
    v = M.decision(F.col("human_decision"))
    return D.agreement_curve(table(spark, d, "anchor_pattern_review").where(v != "NO_VERDICT").select(number("score_or_na").alias("score"), (v == "APPLY").alias("applied")), "score", "applied")


QUERIES = {
    f.__name__: f
    for f in (
        seed_size_hints, seed_pass, map_label_batches, growing_map, growing_map_failures, mapping_counters, invention_alerts, mapping_projection, invented_topics, consistency_pairs, unknown_merge_labels, synonym_audit, synonym_audit_dry, group_audit, review_disagreements, merge_targets, merged_map,
        singleton_seed_scores, group_size_bands, group_coverage, simulated_viability, cell_shares, domain_case_repair, column_audit, author_id_audit, value_counts_marked, label_batches_exact, true_coverage, agreement_curve,
    )
}

_V = "case when trim(coalesce(human_decision, '')) = '' then 'NO_VERDICT' else upper(trim(human_decision)) end"
_RISK = "list_filter([" + ", ".join(f"'{w}'" for w in M.RISK_WORDS) + "], lambda w: contains(lower(coalesce(raw_label_or_group, '')), w) and not contains(lower(coalesce(proposed_canonical, '')), w))"
_STRIP = lambda c: f"regexp_replace(coalesce({c}, ''), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
_BATCHED = (
    _L
    + """, numbered as (select domain, label, (row_number() over (partition by domain order by label) - 1) // 60 as batch from freq),
answered as (select *, trim(array_to_string(string_split(label, ' ')[1:2], ' ')) as canonical from numbered),
firsts as (select *, min(batch) over (partition by domain, canonical) as first, exists (select 1 from vocabulary v where v.topic_domain = domain and v.topic = canonical) as seeded from answered),
growing as (select domain, label, canonical, batch, case when seeded then 'seed' when canonical = label then 'self' when first = batch then 'invented' else 'seed' end as kind,
                   (select count(distinct g.canonical) from firsts g where g.domain = f.domain and g.batch = f.batch and g.first = g.batch and not g.seeded) as new_topics from firsts f)
"""
)
_BEST_SYNONYM = f""", k as (select *, {_tok('label', 'cleanup')} as k from freq), m as (
  select a.domain, a.label, b.label as canonical, row_number() over (partition by a.domain, a.label order by {_J} desc, b.label) as r
  from k a join k b on a.domain = b.domain and a.posts = 1 and b.posts >= 2 and len(a.k) > 0 and len(b.k) > 0 and {_J} >= 0.5 - 1e-9), best as (select * from m where r = 1)
"""
_REC = _L.replace("\nwith labelled", "\nwith recursive labelled")


def _components(labels: str, kind: str) -> str:
    """Components of labels linked by shared tokens, from a table of (domain, label)."""
    return f""", parts as (select domain, label, unnest({_tok('label', kind)}) as token from {labels}),
reach(domain, label, other) as (select domain, label, label from parts union select r.domain, r.label, b.label from reach r join parts a on r.domain = a.domain and r.other = a.label join parts b on a.domain = b.domain and a.token = b.token),
components as (select domain, label, min(other) as component from reach group by 1, 2)
"""


from ..operators.classes import TECHNOLOGIES  # noqa: E402

_SINGLES = f""", sk as (select *, {_tok('label', 'wide')} as k, regexp_matches(label, '\\b\\d+\\.\\d+\\b') or (len(list_filter(regexp_split_to_array(trim(label), '\\s+'), lambda w: w <> '')) <= 4 and ({" or ".join(f"contains(label, '{t}')" for t in TECHNOLOGIES)})) as named from freq),
sm as (select a.domain, a.label, max({_J}) as score from sk a join sk b on a.domain = b.domain and a.posts = 1 and b.posts >= 2 and len(a.k) > 0 and len(b.k) > 0 group by 1, 2),
singles as (select sk.domain, sk.label, case when named then 'named_specific' when score >= 0.5 then 'fixable_synonym' when score >= 0.3 then 'weak_synonym' else 'distinct_concept' end as class from sk left join sm on sk.domain = sm.domain and sk.label = sm.label where posts = 1),
distincts as (select * from singles where class = 'distinct_concept')
"""
_MERGES = f"""
with recursive steps0 as (select topic_domain as domain, lower({_STRIP('raw_label_or_group')}) as label, lower({_STRIP('proposed_canonical')}) as canonical from anchor_pattern_review where {_V} = 'APPLY'),
steps1 as (select * from steps0 where domain is not null and not contains(label, '|') and label not in ('', 'n/a') and canonical not in ('', 'n/a') and canonical < label),
steps as (select domain, label, min(canonical) as target from steps1 group by 1, 2),
walk(domain, label, target) as (select * from steps union all select w.domain, w.label, s.target from walk w join steps s on w.domain = s.domain and w.target = s.label),
ends as (select domain, label, min(target) as target from walk group by 1, 2)
"""
_COLUMNS = """idx audience_room_id audience_room_name platform profile_id post_id post_text post_date post_url num_likes num_comments num_shares subreddit label_useful label_personal label_off_domain label_low_content label_generic_advice
label_repost label_promo author_name author_headline author_profile_url share_audience lang raw_post_json""".split()

SQL = {
    "seed_size_hints": _L + "select domain, count(*) as labels, greatest(10, count(*) // 3) as low, greatest(15, count(*) // 2) as high from freq where posts >= 2 group by 1",
    "seed_pass": _L
    + """, r as (select domain, label, row_number() over (partition by domain order by posts desc, label) as rank, count(*) over (partition by domain) as n from freq where posts >= 2)
select domain, label as topic, cast(rank as int) as rank, 'ok' as status from r where rank <= least(50, greatest(15, n // 2))""",
    "map_label_batches": _L + "select domain, label, (row_number() over (partition by domain order by label) - 1) // 60 as batch from freq",
    "growing_map": _BATCHED + "select * from growing",
    "growing_map_failures": _L
    + """, numbered as (select domain, label, (row_number() over (partition by domain order by label) - 1) // 60 as batch from freq),
bad as (select *, bool_or(contains(label, 'compliance')) over (partition by domain, batch) as fallback from numbered)
select domain, label, case when fallback then label else trim(array_to_string(string_split(label, ' ')[1:2], ' ')) end as canonical, batch, fallback from bad""",
    "mapping_counters": _BATCHED + "select domain, count(*) as labels, count(*) filter (kind = 'seed') as seed_maps, count(*) filter (kind = 'invented') as invented, count(*) filter (kind = 'self') as self_maps, 0 as fallbacks from growing group by 1",
    "invention_alerts": _BATCHED + "select distinct domain, batch, new_topics from growing where new_topics > 8",
    "mapping_projection": _BATCHED
    + """, t as (select domain, count(*) as sampled, count(*) filter (kind = 'seed') as a, count(*) filter (kind = 'invented') as b, count(*) filter (kind = 'self') as c from growing where batch = 0 group by 1),
n as (select domain, count(*) as labels from freq group by 1)
select t.domain, sampled, labels, cast(floor(a / sampled * labels) as bigint) as seed_maps, cast(floor(b / sampled * labels) as bigint) as invented, cast(floor(c / sampled * labels) as bigint) as self_maps from t join n on t.domain = n.domain""",
    "invented_topics": _L + "select distinct domain, canonical as label from map where not exists (select 1 from vocabulary v where v.topic_domain = map.domain and v.topic = map.canonical)",
    "consistency_pairs": _L
    + f""", inv as (select distinct domain, canonical as label from map where not exists (select 1 from vocabulary v where v.topic_domain = map.domain and v.topic = map.canonical)),
sets as (select distinct domain, {_tok('label', 'plain')} as k from inv), kept as (select * from sets where len(k) > 0)
select a.domain, array_to_string(a.k, ' ') as set_a, array_to_string(b.k, ' ') as set_b, {_J} as score from kept a join kept b on a.domain = b.domain and a.k < b.k and {_J} >= 0.6 - 1e-9""",
    "unknown_merge_labels": f"""
with l as (select distinct topic_domain as domain, lower({_STRIP('raw_label_or_group')}) as label from anchor_pattern_review where not contains(coalesce(raw_label_or_group, ''), '|'))
select domain, label from l where not exists (select 1 from vocabulary v where v.topic_domain = l.domain and lower({_STRIP('v.topic')}) = l.label)""",
    "synonym_audit": _L
    + _BEST_SYNONYM
    + "select domain, label, canonical, case when len(list_distinct(list_intersect(string_split(label, ' '), string_split(canonical, ' ')))) >= 3 then 'APPROVED' else 'REJECTED' end as verdict, 'shared words' as reason from best",
    "synonym_audit_dry": _L + _BEST_SYNONYM + "select domain, 'PENDING_REVIEW' as verdict, count(*) as pairs from best group by 1",
    "group_audit": _REC
    + ", lone as (select domain, label from freq where posts = 1)"
    + _components("lone", "cleanup")
    + """, sized as (select *, count(*) over (partition by domain, component) as n from components), small as (select * from sized where n between 2 and 9),
w as (select domain, component, word, count(*) as c from (select distinct domain, component, label, unnest(string_split(label, ' ')) as word from small) where word <> '' group by all),
top as (select domain, component, arg_min(word, (-c, word)) as word from w group by 1, 2)
select s.domain, s.component, string_agg(label, ' | ' order by label) as labels, case when bool_and(list_contains(string_split(label, ' '), top.word)) then 'APPROVED' else 'REJECTED' end as verdict,
       coalesce(string_agg(label, ' | ' order by label) filter (not list_contains(string_split(label, ' '), top.word)), '') as outliers
from small s join top on s.domain = top.domain and s.component = top.component group by 1, 2""",
    "review_disagreements": f"""
with r as (select case {_V} when 'APPLY' then 'APPROVE' else 'REJECT' end as first_verdict, case when len({_RISK}) > 0 then 'REJECT' else 'APPROVE' end as second_verdict from anchor_pattern_review where {_V} in ('APPLY', 'REJECT'))
select first_verdict, second_verdict, count(*) as rows, first_verdict <> second_verdict as disagree from r group by 1, 2""",
    "merge_targets": _MERGES + "select domain, label, target from ends",
    "merged_map": _MERGES
    + """, names as (select domain, label from steps1 union select domain, canonical from steps1)
select n.domain, n.label as raw_label, coalesce(e.target, n.label) as canonical, e.target is not null as merged from names n left join ends e on n.domain = e.domain and n.label = e.label""",
    "singleton_seed_scores": _L
    + f""", a0 as (select domain, label, {_tok('label', 'wide')} as k from freq where posts = 1), b0 as (select topic_domain as domain, {_tok('topic', 'wide')} as k from vocabulary)
select a.domain, a.label, round(max({_J}), 6) as score from a0 a join b0 b on a.domain = b.domain and len(a.k) > 0 and len(b.k) > 0 and {_J} >= 0.3 - 1e-9 group by 1, 2""",
    "group_size_bands": _REC
    + _SINGLES
    + _components("distincts", "wide")
    + """, sizes as (select domain, component, count(*) as n from components group by 1, 2)
select domain, case when n <= 5 then cast(n as varchar) when n <= 9 then '6-9' when n <= 19 then '10-19' else '20+' end as band, count(*) as groups, cast(sum(n) as bigint) as labels, 100.0 * sum(n) / sum(sum(n)) over (partition by domain) as pct from sizes group by 1, 2""",
    "group_coverage": _REC
    + _SINGLES
    + _components("distincts", "wide")
    + """, sizes as (select domain, component, count(*) as n from components group by 1, 2),
totals as (select domain, sum(posts) as total, coalesce(sum(posts) filter (posts >= 2), 0) as b1 from freq group by 1), syn as (select domain, count(*) as b2 from singles where class in ('fixable_synonym', 'weak_synonym') group by 1),
bases as (select t.domain, total, b1 + coalesce(b2, 0) as base from totals t left join syn on t.domain = syn.domain), g as (
  select b.domain, cast(v.least as int) as least, count(*) filter (n >= v.least) as groups, cast(coalesce(sum(n) filter (n >= v.least), 0) as bigint) as collapsed, max(base) as base, max(total) as total
  from bases b, (values (2), (3), (5), (10)) v(least) left join sizes s on s.domain = b.domain group by 1, 2)
select domain, least, groups, collapsed, cast(base + collapsed as bigint) as covered, 100.0 * (base + collapsed) / total as pct from g""",
    "simulated_viability": _L
    + _BEST_B
    + f""", p as (select domain, label, coalesce(case trim(coalesce(audience_room_name, '')) {" ".join(f"when '{a}' then '{b}'" for a, b in C.AUDIENCES.items())} end, trim(coalesce(audience_room_name, ''))) as audience, lower(platform) = 'linkedin' as li from labelled
  where label not in ('', 'unclassified') and post_type in {_in(L.TRANSFER_TYPES)} and lower(platform) in ('linkedin', 'reddit')),
c2 as (select p.audience, p.domain, case when coalesce(c.class, '') <> 'noise' then coalesce(c.match, p.label) end as label, count(*) filter (li) as li, count(*) filter (not li) as rd from p left join classes c on p.domain = c.domain and p.label = c.label group by 1, 2, 3),
g as (select audience, domain, cast(sum(li) as bigint) as li_posts, cast(sum(rd) as bigint) as rd_posts, count(*) filter (label is not null and li >= 30 and rd >= 30) as viable, count(*) filter (label is not null and (li >= 10 or rd >= 10) and not (li >= 30 and rd >= 30)) as near_viable from c2 group by 1, 2)
select *, not (li_posts < 30 or rd_posts < 10 or (li_posts < 50 and rd_posts < 20)) as shown from g""",
    "cell_shares": _eligible()
    + """, more as (select posts.*, coalesce(t.post_type, '') as post_type, coalesce(t.stance, '') as stance from posts join (select idx, any_value(post_type) as post_type, any_value(stance) as stance from tagged_posts_v2_clean group by 1) t on posts.idx = t.idx),
long as (select audience, group_label, side, unnest([{'c': 'sentiment', 'v': sentiment}, {'c': 'post_type', 'v': post_type}, {'c': 'stance', 'v': stance}]) as x from more),
n as (select audience, group_label, side, x.c as column_name, x.v as value, count(*) as posts from long group by all union all select audience, group_label, 'all', x.c, x.v, count(*) from long group by all)
select n.audience, n.group_label, side, column_name, value, posts, round_even(100.0 * posts / sum(posts) over (partition by n.audience, n.group_label, side, column_name), 1) as pct
from n join both_sided b on n.audience = b.audience and n.group_label = b.group_label""",
    "domain_case_repair": f"""
with b as (select coalesce(topic_broad, '') as topic_broad, count(*) as posts from tagged_posts_v2_clean group by 1)
select topic_broad, posts, case lower({_STRIP('topic_broad')}) {" ".join(f"when '{x.lower()}' then '{x}'" for x in L.DOMAINS)}
       else array_to_string(list_transform(regexp_extract_all({_STRIP('topic_broad')}, '[\\p{{L}}]+|[^\\p{{L}}]+'), lambda p: upper(p[1]) || lower(p[2:])), '') end as repaired from b""",
    "column_audit": " union all ".join(
        f"select '{c}' as column_name, count(*) filter (length({_STRIP(f'cast({c} as varchar)')}) > 0) as filled, count(*) as rows, {str(any(x in c for x in ('profile', 'user', 'author'))).lower()} as names_person from posts_filtered" for c in _COLUMNS
    ),
    "author_id_audit": f"""
select {_STRIP('audience_room_name')} as room, lower({_STRIP('platform')}) as platform, count(*) as posts, count(distinct nullif({_STRIP('profile_id')}, '')) as authors from posts_filtered group by 1, 2""",
    "value_counts_marked": "with cells as ("
    + " union all ".join(f"select '{c}' as column_name, coalesce({c}, '') as value, {v} as marker from tagged_posts_v2_clean" for c, v in (
        ("platform", f"case when lower(coalesce(platform, '')) in {_in(L.PLATFORMS)} then 'valid' else 'invalid' end"), ("audience_room_name", "'open'"), *((c, f"case when coalesce({c}, '') in {_in(x)} then 'valid' else 'invalid' end") for c, x in L.VOCABULARIES.items())))
    + ") select column_name, value, marker, count(*) as rows from cells group by all",
    "label_batches_exact": "with n as (select count(*) as n from posts_clean_v2) select b as batch, least(20, n - 20 * b) as posts from n, lateral (select unnest(generate_series(0, (n - 1) // 20)) as b)",
    "true_coverage": _L + "select domain, cast(sum(posts) as bigint) as posts, cast(coalesce(sum(posts) filter (posts >= 2), 0) as bigint) as covered, 100.0 * coalesce(sum(posts) filter (posts >= 2), 0) / sum(posts) as pct from canonicals group by 1",
    "agreement_curve": f"""
with r as (select try_cast(trim(score_or_na) as double) as score, {_V} = 'APPLY' as applied from anchor_pattern_review where {_V} <> 'NO_VERDICT')
select t.threshold, count(*) as items, count(*) filter (applied) as agreed, 100.0 * count(*) filter (applied) / count(*) as pct from r join (values (0.0::double), (0.5), (0.55), (0.6), (0.65), (0.7), (0.75), (0.8), (0.9)) t(threshold) on score >= t.threshold group by 1""",
}
