"""Texts cut off by a field limit or during transfer.

The corpus' vocabulary is kept as a trie in relational form: a node is a prefix, a row of the table of proper prefixes of known words. A
final token that is no known word but a node of the trie was cut within a word. Cuts between words show in the corpus' counts of how
often the last words of the text end a sentence, and in lengths piled up at a source's limit.

The endings come first: one short row a document, of which only those that end within words ask anything. All counts cover all distinct
texts, but of words in sequence only what some ending asks for is counted: a Bloom filter of what is asked saves the rest from being made and
shuffled, and an exact join follows. Every look-up is a join by the distinct endings, hot ones salted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import written
from . import bloom
from .salted import HOT, lookup

#: A word or CJK character; an end of sentence; a line break.
_TOKEN = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_぀-ヿ㐀-鿿]+(?:['’-][^\W_぀-ヿ㐀-鿿]+)*|[.!?。！？…]+|\n")
_CERTAIN_MARK = re.compile(r"\s*(?:\[\s*(?:\.\.\.|…|truncated|cut off|cut|continued|more)\s*\]|\(\s*(?:\.\.\.|…|truncated)\s*\)|(?:\.\.\.|…)\s*(?:(?:read|see|show|view)\s)?(?:more|continue reading)\W*|<truncated>)$", re.I)
#: What every certain mark has in it.
_MARKED = re.compile(r"[\[(<…]|\.\.\.")
_OPEN_MARK = re.compile(r"\s*(?:…|\.{3,})$")
_ENTITY = re.compile(r"&(?:a|am|amp|l|lt|g|gt|q|qu|quo|quot|n|nb|nbs|nbsp|ap|apo|apos|#x?[0-9a-f]*)$")
#: Of a single token: a link; the host of an address; a tag; an option; the beginning of a link.
_LINK = re.compile(r"https?://(\S*)$|(www\.\S*)$", re.I)
_MAIL = re.compile(r"[^\s@]@([^\s@]+)$")
_TAG = re.compile(r"([#@][^\s#@]+)$")
_OPTION = re.compile(r"--?[A-Za-z]\w[\w-]*$")
_SCHEME = re.compile(r"https?:/{0,2}$", re.I)
_SPECIAL = re.compile(r"://|[@#]|www\.|(?<!\S)--?[A-Za-z]", re.I)
_DASHED = re.compile(r"(?<!\S)--?[A-Za-z]")
_CLOSING = ".,;:!?)]}>\"'»”’。！？、"
_CODE_END = re.compile(r"[{};]$|\w\(\)$|(?<!\S)-[A-Za-z]$")
#: A row of a table that a bar opened and none closed; pipelines don't begin with a bar.
_OPEN_ROW = re.compile(r"(?:^|[.!?:。！？]\s+)\|[^|]+(?:\|[^|]*)*\|\s*[^|\s][^|]*$")
_COUNT = re.compile(r"\(?\d+\s*/\s*\d+\)?$")
_WORD_END = re.compile(r"[^\W_]$")
_WORD_CHAR = re.compile(r"\w")
_DANGLING = re.compile(r"[,;(/&+=<{\[–—-]$")
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
ORDERS = (4, 3, 2, 1)
_FLUSH = 200_000

#: ask: the last words from the start of their sentence, ^, at most four; or the key of a link, address, tag or option, which has no blank.
ENDINGS = "id bigint, source string, n_chars bigint, state string, ask string"


def _plain(token: str) -> str:
    t = token.lower().replace("’", "'")
    return "0" if t.isdigit() else t


def _grams(run: list[str]) -> list[str]:
    """The last words of a sentence so far, of each order; ^ is its start."""
    padded = ["^", *run]
    return [" ".join(padded[-n:]) for n in ORDERS]


def _key(token: str) -> str | None:
    """What stands for a link, address, tag or option in the vocabulary, None for other tokens. No key is a word."""
    t = token.rstrip(_CLOSING)
    if m := _LINK.search(t):
        return "//" + (m[1] if m[1] is not None else m[2]).lower().rstrip("/")
    if m := _MAIL.search(t):
        return "//" + m[1].lower()
    if m := _TAG.search(t):
        return m[1].lower()
    return t if _OPTION.match(t) else None


def _known_keys(text: str) -> Iterator[str]:
    """The keys a stripped text shows to be whole: hosts and their domains, the starts of paths up to each delimiter, tags and options. Of its
    last token only what a delimiter ends."""
    # plain tests first: most texts have none of these signs
    likely = "@" in text or "#" in text or "://" in text or "-" in text and _DASHED.search(text) or "www." in text.lower()
    tokens = text.split() if likely else []
    for k, token in enumerate(tokens, 1):
        if not _SPECIAL.search(token) or (key := _key(token)) is None:
            continue
        if not key.startswith("//"):
            if k < len(tokens):
                yield key
            continue
        stops = [d.start() for d in re.finditer(r"[/?#=&]", key)][2:]
        if stops or k < len(tokens):
            labels = key[2 : stops[0] if stops else None].split(".")
            for n in range(max(1, len(labels) - 1)):
                yield "//" + ".".join(labels[n:])
        for stop in stops:
            if start := key[: stop + 1].rstrip("/"):
                yield start


def ending(text: str) -> tuple[str, str | None, list[str]]:
    """(state, last word, grams) of a text that isn't blank. States: cut (a certain mark or a broken character), done (ends as texts may
    end), open (ends in a word), mark (a word and an ellipsis), hanging (ends in a comma or the like, in an open row of a table or in a link's
    beginning). If the last token is a link, address, tag or option, the state is done and the last word its key."""
    t = text.rstrip()
    # marks are at the very end: what is before the last 400 is looked at only if these hold no word
    end = t[-400:]
    if len(end) < len(t) and not _WORD_CHAR.search(end):
        end = t
    if t.endswith("�") or "&" in end and _ENTITY.search(end) or _MARKED.search(end) and _CERTAIN_MARK.search(end):
        return "cut", None, []
    state = "open"
    if end.endswith(("…", "...")) and (m := _OPEN_MARK.search(end)):
        t, state = t[: len(t) - len(end) + m.start()].rstrip(), "mark"
    line = t.rpartition("\n")[2]
    tail = line.split()[-1] if line.strip() else ""
    if _SCHEME.search(tail):
        return "hanging", None, []
    if line[-1:] in ")0123456789" and _COUNT.search(line[-80:]) or line.startswith("```") or (line.endswith("`") and line.count("`") % 2 == 0):
        return "done", None, []
    if key := _key(tail):
        return ("hanging" if key.startswith("//") and key[-1] in "=&" else "done"), key, []
    if "|" in line and _OPEN_ROW.search(line):
        above = t[: len(t) - len(line)].rstrip("\n").rpartition("\n")[2].strip()
        return ("done" if above.startswith("|") and not above.endswith("|") else "hanging"), None, []
    if _CODE_END.search(line[-4:]):
        return "done", None, []
    if not _WORD_END.search(t[-1:]):
        return ("hanging" if state == "open" and _DANGLING.search(t[-1:]) else "done"), None, []
    run: list[str] = []
    for token in _TOKEN.findall(line):
        run = run + [_plain(token)] if token[0].isalnum() else []
    return (state, run[-1], _grams(run)) if run else ("done", None, [])


def _endings(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, source, text in zip(batch.iloc[:, 0], batch.iloc[:, 1], batch.iloc[:, 2]):
                if text is not None and text.strip():
                    state, last, grams = ending(text)
                    out.append((i, source, len(text), state, grams[0] if grams else last))
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in ENDINGS.split(", ")])

    return docs.mapInPandas(run, ENDINGS)


class _Next(dict):
    """Of the words that follow one word: whether the pair is asked."""

    def __init__(self, first: str, asked: bloom.Bloom) -> None:
        super().__init__()
        self.first, self.asked = first, asked

    def __missing__(self, word: str) -> bool:
        found = self[word] = f"{self.first} {word}" in self.asked
        return found


class _Words(dict):
    """What is known of a token: None if it's no word, else (plain form, whether its counts are asked, what follows it, whether that is asked)."""

    def __init__(self, asked: bloom.Bloom) -> None:
        super().__init__()
        self.asked = asked
        self.start = _Next("^", asked), "<^" in asked

    def __missing__(self, token: str):
        found = None
        if token[0].isalnum():
            word = _plain(token)
            found = word, word in self.asked, _Next(word, self.asked), f"<{word}" in self.asked
        self[token] = found
        return found


class _Asked(dict):
    """Whether words in sequence are asked."""

    def __init__(self, asked: bloom.Bloom) -> None:
        super().__init__()
        self.asked = asked

    def __missing__(self, gram: str) -> bool:
        found = self[gram] = gram in self.asked
        return found


class _Found(dict):
    """gram: [inside, ends, last]."""

    def __missing__(self, gram: str) -> list[int]:
        found = self[gram] = [0, 0, 0]
        return found


def _count(text: str, words: _Words, asked: _Asked, found: _Found) -> None:
    """Adds what a stripped text shows to found."""
    for key in _known_keys(text):
        found[key][0] += 1
    infos = list(map(words.__getitem__, _TOKEN.findall(text)))
    ats = [1 if x is None else 0 for x in infos[1:]]
    ats.append(2)
    start = words.start
    one = two = three = None  # the words before; ^ and None at a start
    after, follows = start
    at_start = True
    for info, at in zip(infos, ats):
        if info is None:
            if not at_start:
                at_start, one, two, three = True, None, None, None
                after, follows = start
            continue
        word, word_asked, then, then_follows = info
        if at_start:
            one, at_start = "^", False
        if word_asked:
            found[word][at] += 1
        elif at != 2 and word not in found:
            found[word][0] = 1
        if after[word]:
            pair = f"{one} {word}"
            found[pair][at] += 1
            if two is not None and asked[longer := f"{two} {pair}"]:
                found[longer][at] += 1
                if three is not None and asked[longer := f"{three} {longer}"]:
                    found[longer][at] += 1
        elif follows and at != 2 and (pair := f"{one} {word}") not in found:
            found[pair][0] = 1
        three, two, one = two, one, word
        after, follows = then, then_follows


def _counts(docs: DataFrame, filter_of_asked: bytes) -> DataFrame:
    """gram, inside, ends, last: how often words were followed by more, by an end of sentence or line, and by the end of
    the text, over all distinct texts: copies of a text are no evidence for one another. Whole links, tags and options have rows by their
    keys. The counts are true for what the filter has; each other word that occurs before the end of a text has a row, and so has each pair
    whose first word the filter has after "<"."""
    bits = docs.sparkSession.sparkContext.broadcast(filter_of_asked)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = _Found()
        of = bloom.Bloom(bits.value)
        words, asked = _Words(of), _Asked(of)

        def flush() -> pd.DataFrame:
            frame = pd.DataFrame([(k, *v) for k, v in found.items()], columns=["gram", "inside", "ends", "last"])
            found.clear()
            return frame

        for batch in batches:
            for text in batch.iloc[:, 0]:
                if text is not None:
                    _count(text.rstrip(), words, asked, found)
                if len(found) > _FLUSH:
                    yield flush()
                    words, asked = _Words(of), _Asked(of)  # what is remembered is bounded, too
        if found:
            yield flush()

    distinct = docs.select(F.rtrim("text", F.lit(_SPACES)).alias("text")).distinct()
    parts = distinct.mapInPandas(run, "gram string, inside bigint, ends bigint, last bigint")
    return parts.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("inside", "ends", "last")))


def _prefixes(column: str):
    return F.explode(F.transform(F.sequence(F.lit(1), F.length(column) - 1), lambda n: F.substring(F.col(column), F.lit(1), n)))


def length_limits(docs: DataFrame, slack: int = 8, least: int = 10, times: float = 4.0) -> DataFrame:
    """source, full: the length of its longest texts, for sources whose lengths pile up there: at least `least` texts within slack of it
    and `times` as many as in the windows of that width below. Sources without a pile have no row."""
    lengths = docs.where("text is not null").select("source", F.length("text").cast("bigint").alias("n")).groupBy("source", "n").agg(F.count("*").alias("c"))
    top = lengths.groupBy(F.col("source").alias("of")).agg(F.max("n").alias("full"))
    near = lengths.join(top, F.col("source").eqNullSafe(F.col("of"))).where(F.col("n") > F.col("full") - 9 * slack)
    piles = near.groupBy("source", "full").agg(F.sum(F.when(F.col("n") > F.col("full") - slack, F.col("c")).otherwise(0)).alias("at"), F.sum(F.when(F.col("n") <= F.col("full") - slack, F.col("c")).otherwise(0)).alias("below"))
    return piles.where((F.col("at") >= least) & (F.col("at") >= times * F.col("below") / 8)).select("source", "full")


def find_truncated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", least_end: float = 0.2, slack: int = 8) -> DataFrame:
    """id_col, source, cut (boolean), reason for each document whose text isn't null or blank.

    Reasons: mark (a certain mark or a broken character), prefix (an unknown final token that begins a known word, host, path, tag or option), sentence (the last
    words end a sentence in less than least_end of their other occurrences), length (not at an end of sentence, at the source's limit), hanging
    (ends in a comma, dash or bracket, a table's open row or a link's beginning). Null sources are a source of their own. Texts of any length are read whole; ids may repeat.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    ends = written(_endings(docs))
    tail = lambda n: F.substring_index("ask", " ", -n)
    asked = written(ends.where("ask is not null").groupBy("ask").agg(F.count("*").alias("n")))
    in_words = asked.where(F.col("ask").contains(" "))
    # the start of a pair is told by "<", which no word has
    keys = in_words.select(F.explode(F.array_distinct(F.array(*(tail(n) for n in ORDERS), F.concat(F.lit("<"), F.substring_index(tail(2), " ", 1))))).alias("gram"))
    counts = written(_counts(docs, bloom.build(keys, strict=False)))
    before_end = F.col("inside") + F.col("ends") > 0
    pair = F.col("gram").rlike("^[^ ]+ [^ ]+$")
    words = counts.where(~F.col("gram").contains(" ") & before_end).select(F.col("gram").alias("word"))
    # the trie's nodes that matter: the prefixes that are final tokens
    finals = asked.select(tail(1).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    unknown = finals.select("word").join(words, "word", "left_anti").withColumn("is_unknown", F.lit(True))
    nodes = words.where(F.length("word") > 1).select(_prefixes("word").alias("word"))
    cut_words = unknown.select("word").join(nodes, "word", "left_semi").withColumn("is_prefix", F.lit(True))
    told_words = finals.join(unknown, "word", "left").join(cut_words, "word", "left")
    # the same one word deeper: the last word isn't known after the word before it, but begins one that is
    parted = lambda c: (F.substring_index(c, " ", 1).alias("before"), F.substring_index(c, " ", -1).alias("word"))
    pairs = counts.where(pair & before_end).select(*parted("gram"))
    final_pairs = in_words.select(tail(2).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    unknown_pairs = final_pairs.select(*parted("pair")).join(pairs, ["before", "word"], "left_anti")
    asked_pairs = pairs.where(F.length("word") > 1).join(unknown_pairs.select("before").distinct(), "before", "left_semi")
    pair_nodes = asked_pairs.select("before", _prefixes("word").alias("word"))
    cut_pairs = unknown_pairs.join(pair_nodes, ["before", "word"], "left_semi").select(F.concat_ws(" ", "before", "word").alias("pair"), F.lit(True).alias("is_pair_prefix"))
    told_pairs = final_pairs.join(cut_pairs, "pair", "left")
    # how often each document's last words end a sentence in other texts: its own end is taken off, which stands for all its copies
    long = in_words.select("ask", F.explode(F.array_distinct(F.array(*(tail(n) for n in ORDERS)))).alias("gram"))
    wanted = long.groupBy("gram").agg(F.count("*").alias("n"))
    told = counts.join(wanted, "gram").select("gram", "n", (F.col("inside") + F.col("ends") + F.col("last") - 1).alias("total"), (F.col("ends") + F.col("last") - 1).alias("done")).where("total > 0")
    best = lookup(long, told, ["gram"], "n", HOT).groupBy("ask").agg(F.max_by(F.col("done") / F.col("total"), F.length("gram")).alias("p_end"))
    # all of it by the distinct endings, then to the documents
    verdicts = lookup(asked.withColumnRenamed("n", "documents").withColumn("word", tail(1)), told_words, ["word"], "n", HOT)
    verdicts = lookup(verdicts.withColumn("pair", tail(2)), told_pairs, ["pair"], "n", HOT, "left").join(best, "ask", "left")
    verdicts = verdicts.select("ask", "documents", "is_unknown", "is_prefix", "is_pair_prefix", "p_end")
    none = ends.where("ask is null")
    for c, kind in verdicts.dtypes[2:]:
        none = none.withColumn(c, F.lit(None).cast(kind))
    j = lookup(ends.where("ask is not null"), verdicts, ["ask"], "documents", HOT).unionByName(none)
    limits = length_limits(docs, slack).select(F.col("source").alias("limited"), "full")
    j = j.join(limits, F.col("source").eqNullSafe(F.col("limited")), "left")
    full = F.coalesce(F.col("n_chars") > F.col("full") - slack, F.lit(False))
    in_word = F.col("state").isin("open", "mark")
    reason = (
        F.when(F.col("state") == "cut", "mark")
        .when(in_word & (F.col("is_prefix") | F.col("is_pair_prefix")), "prefix")
        .when((F.col("state") == "done") & F.col("is_prefix"), "prefix")
        .when((F.col("state") == "hanging"), F.lit("hanging"))
        .when(in_word & F.col("is_unknown").isNull() & (F.col("p_end") < least_end), "sentence")
        .when((F.col("state") == "open") & full & (F.coalesce("p_end", F.lit(0.0)) < 0.9), "length")
        .when((F.col("state") == "done") & full & F.col("is_unknown"), "length")
    )
    return j.select(F.col("id").alias(id_col), "source", reason.isNotNull().alias("cut"), reason.alias("reason"))


def truncation_rates(judged: DataFrame) -> DataFrame:
    """source, documents, cut, rate of find_truncated()."""
    return judged.groupBy("source").agg(F.count("*").alias("documents"), F.count_if("cut").alias("cut"), F.avg(F.col("cut").cast("double")).alias("rate"))
