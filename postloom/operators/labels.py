"""Repair of labels against controlled vocabularies, with a log, and their distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip, text_or_empty

# The vocabularies and the repairs of labels outside them.
DOMAINS = ("AI", "Software Engineering", "Career", "EdTech", "Healthcare", "Leadership & Management", "Security", "Data & Analytics", "Open Source", "Business & Strategy", "Other")
ACTIVE_DOMAINS = ("Software Engineering", "AI", "Security", "EdTech", "Career", "Business & Strategy", "Data & Analytics", "Leadership & Management", "Open Source")
SENTIMENTS = ("positive", "negative", "neutral", "mixed")
STANCES = ("assertive", "critical", "supportive", "questioning", "informational")
POST_TYPES = ("opinion", "news_reaction", "question", "personal_milestone", "promotional", "show_and_tell")
TRANSFER_TYPES = ("opinion", "news_reaction")
DOMAIN_REPAIRS = {
    "Hardware": "Other", "Product & Strategy": "Business & Strategy", "Product": "Business & Strategy", "Cloud & Infrastructure": "Software Engineering", "Design & Management": "Leadership & Management", "Promotional": "Other", "Customer Support": "Other",
    "Product Manager": "Business & Strategy", "Product Leadership": "Business & Strategy", "Product Leadership Audience Room": "Business & Strategy", "Engineering": "Software Engineering", "DevOps": "Software Engineering", "Product Management": "Business & Strategy",
}
STANCE_AS_SENTIMENT = {"questioning": "neutral", "critical": "negative", "assertive": "neutral", "supportive": "positive", "informational": "neutral"}
POST_TYPE_REPAIRS = {"informational": "show_and_tell"}
PLATFORMS = ("linkedin", "reddit", "twitter", "x")
KEPT_COLUMNS = tuple(
    """audience_room_id audience_room_name platform profile_id post_id post_text post_date post_url num_likes num_comments num_shares subreddit label_useful label_personal label_off_domain label_low_content
    label_generic_advice label_repost label_promo author_name author_headline author_profile_url share_audience topic_broad topic topic_narrow opinion_subtopics sentiment stance post_type""".split()
)


def _mapped(c: Column, repairs: dict[str, str], default: Column) -> Column:
    out = F.lit(None).cast("string")
    for a, b in repairs.items():
        out = F.when(c == a, b).otherwise(out)
    return F.coalesce(out, default)


def repair(df: DataFrame) -> DataFrame:
    """topic_broad, sentiment, stance and post_type within their vocabularies; blanks stay. All repairs read the labels as they came: a stance
    in the place of the sentiment gives the sentiment, and the stance where that is blank."""
    broad, sentiment, stance, kind = (strip(text_or_empty(c)) for c in ("topic_broad", "sentiment", "stance", "post_type"))
    bad_sentiment = (sentiment != "") & ~sentiment.isin(*SENTIMENTS)
    return df.withColumns({
        "topic_broad": F.when((broad == "") | broad.isin(*DOMAINS), broad).otherwise(_mapped(broad, DOMAIN_REPAIRS, F.lit("Other"))),
        "sentiment": F.when(bad_sentiment, _mapped(sentiment, STANCE_AS_SENTIMENT, F.lit("neutral"))).otherwise(sentiment),
        "stance": F.when(bad_sentiment & sentiment.isin(*STANCES) & (stance == ""), sentiment).otherwise(stance),
        "post_type": F.when((kind == "") | kind.isin(*POST_TYPES), kind).otherwise(_mapped(kind, POST_TYPE_REPAIRS, F.lit("show_and_tell"))),
    })


def corrections(df: DataFrame, id_col: str = "idx") -> DataFrame:
    """id_col, field, original, corrected of each label that repair() changes, white space aside."""
    fields = ("topic_broad", "sentiment", "stance", "post_type")
    before = df.select(id_col, *(strip(text_or_empty(c)).alias(f"_{c}") for c in fields), *fields)
    after = repair(before)
    changes = F.filter(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"_{c}").alias("original"), F.col(c).alias("corrected")) for c in fields)), lambda x: x["original"] != x["corrected"])
    return after.select(id_col, F.explode(changes).alias("x")).select(id_col, "x.*")


def validity(df: DataFrame) -> DataFrame:
    """The rows with a flag for each label within its vocabulary."""
    return df.withColumns({f"valid_{c}": text_or_empty(c).isin(*v) for c, v in (("sentiment", SENTIMENTS), ("stance", STANCES), ("post_type", POST_TYPES), ("topic_broad", DOMAINS))})


def sound_rows(df: DataFrame) -> DataFrame:
    """Rows whose platform is known and whose room name isn't a shifted cell."""
    room = text_or_empty("audience_room_name")
    return df.where(F.lower(strip(text_or_empty("platform"))).isin(*PLATFORMS) & (F.length(room) <= 100) & ~room.rlike(r'^[{"]'))


def value_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """column_name, value, rows of several columns in one pass."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), text_or_empty(c).alias("value")) for c in columns))).alias("x")
    return df.select(cells).groupBy("x.column_name", "x.value").agg(F.count("*").alias("rows"))


def bucket(c: Column, starts: tuple[int, ...]) -> Column:
    """The name of the bucket that a count is in; the last is open."""
    out = F.lit(f"{starts[-1]}+")
    for a, b in reversed(list(zip(starts, starts[1:]))):
        out = F.when(c < b, str(a) if b == a + 1 else f"{a}-{b - 1}").otherwise(out)
    return out


def frequency_buckets(df: DataFrame, keys: list[Column], starts: tuple[int, ...]) -> DataFrame:
    """bucket, labels, posts: how many labels occur how often, and how many posts they cover."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.groupBy(bucket(F.col("n"), starts).alias("bucket")).agg(F.count("*").alias("labels"), F.sum("n").alias("posts"))


def title(c: Column) -> Column:
    """Each run of letters with its first in upper and the others in lower case, as in ai-x: Ai-X."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"[\p{L}]+|[^\p{L}]+"), 0), F.initcap), "")


def repaired_case(c: Column | str) -> Column:
    """A domain's name in its own spelling whatever its case; other names in title case."""
    t = strip(text_or_empty(c))
    return _mapped(F.lower(t), {d.lower(): d for d in DOMAINS}, title(t))


#: The columns with a vocabulary, for value_counts_marked().
VOCABULARIES = {"topic_broad": DOMAINS, "sentiment": SENTIMENTS, "stance": STANCES, "post_type": POST_TYPES}


def value_counts_marked(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """As value_counts(), with a marker: valid or invalid, or open where the column has no vocabulary."""
    marker = F.lit("open")
    for c, v in {**VOCABULARIES, "platform": PLATFORMS}.items():
        known = (F.lower("value") if c == "platform" else F.col("value")).isin(*v)
        marker = F.when(F.col("column_name") == c, F.when(known, "valid").otherwise("invalid")).otherwise(marker)
    return value_counts(df, columns).withColumn("marker", marker)


def column_audit(df: DataFrame, parts: tuple[str, ...] = ("profile", "user", "author")) -> DataFrame:
    """column_name, filled, rows, names_person of every column: how many rows have more than white space in it, and whether its name has one of the
    parts. One pass, whatever the number of columns."""
    counts = df.agg(F.count("*").alias("_rows"), *(F.count_if(F.length(strip(F.coalesce(F.col(c).cast("string"), F.lit("")))) > 0).alias(c) for c in df.columns))
    one = lambda c: F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled"), F.col("_rows").alias("rows"), F.lit(any(p in c.lower() for p in parts)).alias("names_person"))
    return counts.select(F.explode(F.array(*map(one, df.columns))).alias("x")).select("x.*")


def first_id(df: DataFrame, columns: tuple[str, ...] = ("profile_id", "profile_uuid", "user_id")) -> Column:
    """The first of the columns that df has and that isn't empty, without white space at its ends; empty where there is none."""
    return strip(F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns if c in df.columns), F.lit("")))
