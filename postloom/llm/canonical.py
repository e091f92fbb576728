"""Free-entered values to the entries of a canonical list.

Within the value's own domain, a multi-pattern automaton over canonical names and aliases finds embedded mentions, of which the longest
that don't overlap win. An entry has two parts, subject and aspect, and is meant only when both are mentioned. Values left over go
to token-set similarity: every word of an entry must have a word of the value within a few edits or of the same stem, and the entry with
the least cost wins; misspelled words find those of the list by their deletion neighbourhoods, and entries by their rarest word. The list is small by nature (checked); values are mapped where they lie, without a shuffle, and each distinct value
is worked out once in a task.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: A list longer than this isn't broadcast; see map_values().
MAX_ENTRIES = 200_000
_CACHE = 200_000

_EMPTY = re.compile(r"(?i)^\W*(?:unclassified)?\W*$")
_STOP = frozenset("a an and at by for from in into it its my of on or our s the their this to we with your".split())


def normal(text: str) -> str:
    """Lower-case words; words run together with capitals are parted, and words joined by signs too."""
    t = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ", text)
    words = re.findall(r"[^\W_]+", t.lower())
    if words and sum(len(w) == 1 for w in words) > len(words) / 2:  # capitals alone, as in SHOUTED text that was parted wrongly
        words = re.findall(r"[^\W_]+", text.lower())
    return " ".join(words)


def domain_key(text: str | None) -> str:
    """A domain's letters without "and", to compare its spellings."""
    return "".join(w for w in re.findall(r"[^\W_]+", (text or "").lower()) if w != "and")


def edits(a: str, b: str, most: int) -> int:
    """The number of insertions, deletions, changes and swaps of neighbours from a to b; most + 1 if it's more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, now[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        two, one = one, now
    return min(one[-1], most + 1)


def likeness(a: str, b: str) -> float | None:
    """The cost of taking word a for word b, or None: 0 if equal; the edits if few for their length; 1 for a shared stem."""
    if a == b:
        return 0.0
    n = min(len(a), len(b))
    if n >= 3:
        most = 1 if n <= 5 else 2
        if (d := edits(a, b, most)) <= most and (n > 3 or a[0] == b[0]):
            return 0.5 * d
    stem = 0
    while stem < n and a[stem] == b[stem]:
        stem += 1
    if stem >= 4 and stem >= n - 3 and stem >= 0.5 * max(len(a), len(b)):
        return 1.0
    if stem >= 4 and stem == n and n >= 4:
        return 1.2
    return None


class Near:
    """Which of some words are within a few edits of a word, by their deletion neighbourhoods: two words within d edits can be made equal by taking
    at most d letters from each, and so can their beginnings. What is looked at doesn't grow with the list but with the words alike."""

    def __init__(self, words, most: int, prefix: int = 8) -> None:
        self.most, self.prefix = most, prefix
        self.by: dict[str, list[str]] = defaultdict(list)
        for w in words:
            for x in self._less(w):
                self.by[x].append(w)

    def _less(self, word: str) -> set[str]:
        found = level = {word[: self.prefix]}
        for _ in range(self.most):
            level = {x[:i] + x[i + 1 :] for x in level for i in range(len(x))}
            found = found | level
        return found

    def candidates(self, word: str) -> set[str]:
        return {w for x in self._less(word) for w in self.by.get(x, ()) if abs(len(w) - len(word)) <= self.most}

    def within(self, word: str, most: int) -> list[tuple[int, str]]:
        """(edits, word) of all at most that far, nearest first."""
        return sorted((d, x) for x in self.candidates(word) if (d := edits(word, x, most)) <= most)


@dataclass
class Matcher:
    """The entries of one domain: (id, name) in order of rank."""

    entries: list[tuple[int, str]]
    phrases: dict[str, str] = field(default_factory=dict)
    short: dict[str, str] = field(default_factory=dict)
    others: frozenset[str] = frozenset()  #: words of other domains, which are no misspellings

    def __post_init__(self) -> None:
        heads, tails = Counter(), Counter()
        named = [(i, normal(n).split()) for i, n in self.entries]
        for _, w in named:
            for k in range(1, len(w)):
                heads[tuple(w[:k])] += 1
                tails[tuple(w[k:])] += 1
        self.pairs: dict[tuple[str, str], int] = {}
        self.wholes: dict[str, int] = {}
        patterns: dict[str, tuple[str, str]] = {}
        for i, w in named:
            name = " ".join(w)
            self.wholes.setdefault(name, i)
            patterns[name] = ("whole", name)
            patterns.setdefault("".join(w), ("whole", name))
            if len(w) > 1:
                # the split whose two parts recur most is that of subject and aspect
                k = max(range(1, len(w)), key=lambda k: (min(heads[tuple(w[:k])], tails[tuple(w[k:])]), heads[tuple(w[:k])] + tails[tuple(w[k:])]))
                subject, aspect = " ".join(w[:k]), " ".join(w[k:])
                self.pairs.setdefault((subject, aspect), i)
                for kind, part in (("subject", subject), ("aspect", aspect)):
                    patterns.setdefault(part, (kind, part))
                    p = part.split()
                    for j in range(len(p) - 1):
                        patterns.setdefault(" ".join([*p[:j], p[j] + p[j + 1], *p[j + 2 :]]), (kind, part))
                    patterns.setdefault("".join(p), (kind, part))
        self.automaton = ahocorasick.Automaton()
        for p, what in patterns.items():
            self.automaton.add_word(f" {p} ", (len(p), *what))
        self.automaton.make_automaton()
        self.sets = [(i, [x for x in w if x not in _STOP] or w) for i, w in named]
        self.words = sorted({x for _, w in self.sets for x in w})
        self.words_set = frozenset(self.words)
        self.near: dict[str, dict[str, float]] = {}
        self.close = Near(self.words, 2)
        self.stems: dict[str, list[str]] = defaultdict(list)
        for x in self.words:
            self.stems[x[:4]].append(x)
        # an entry is looked at only where its rarest word is near
        often = Counter(x for _, w in self.sets for x in set(w))
        self.by_rarest: dict[str, list[int]] = defaultdict(list)
        for at, (_, w) in enumerate(self.sets):
            self.by_rarest[min(w, key=lambda x: (often[x], x))].append(at)
        self.phrase_words = sorted({x for p in self.phrases for x in p.split() if len(x) > 3})
        self.known = {*self.words, *self.phrase_words, *self.short, *self.others}
        self.joined: dict[str, str] = {a + b: f"{a} {b}" for _, w in named for a, b in zip(w, w[1:])} | {"".join(w): " ".join(w) for _, w in named}

        self.close_joined = Near(self.joined, 2)
        self.wide_phrases = Near({x for x in self.phrase_words if len(x) > 3}, 3)
        self.wide = Near({x for x in (*self.words, *self.phrase_words) if len(x) > 3}, 3)

    def spelled(self, value: str) -> str:
        t = f" {normal(value)} "
        for a, b in self.phrases.items():
            if a in t:
                t = t.replace(f" {a} ", f" {b} ")
        return " ".join(self.short.get(w, w) if w not in self.words_set else w for w in t.split())

    def mentions(self, text: str) -> list[tuple[str, str]]:
        """The longest mentions that don't overlap, of which a longer one wins, then an earlier one."""
        t = f" {text} "
        found = sorted(((n, end - n - 1, kind, name) for end, (n, kind, name) in self.automaton.iter(t)), key=lambda x: (-x[0], x[1]))
        taken = bytearray(len(t))
        out = []
        for n, start, kind, name in found:
            if taken.find(1, start + 1, start + n + 1) < 0:
                taken[start + 1 : start + n + 1] = b"\1" * n
                out.append((start, kind, name))
        return [(kind, name) for _, kind, name in sorted(out)]

    def find(self, value: str) -> tuple[int, str]:
        """(id, how) of the entry meant, or (0, "none"). Where parting words at capitals finds none, capitals are taken for noise."""
        found = self._find(value)
        return found if found[0] or value in (value.lower(), value.upper()) else self._find(value.lower())

    def _find(self, value: str) -> tuple[int, str]:
        text = self.spelled(value)
        if text in self.wholes:
            return self.wholes[text], "exact"
        seen = self.mentions(text)
        for kind, name in seen:
            if kind == "whole":
                return self.wholes[name], "mention"
        subjects, aspects = [n for k, n in seen if k == "subject"], [n for k, n in seen if k == "aspect"]
        for s in subjects:
            for a in aspects:
                if (s, a) in self.pairs:
                    return self.pairs[s, a], "parts"
        words = [x for w in text.split() for x in self.joined.get(w, w).split()]
        found = self.similar(words)
        if not found[0] and (again := self.corrected(words)) != words:
            found = self.similar(self.spelled(" ".join(again)).split())
        return found

    def corrected(self, words: list[str]) -> list[str]:
        """Words that no list knows become the closest word of the phrases, or the one of the domain that is closest by half its letters,
        with "the" and the like cut off; if two are as close, they stay."""
        out = []
        for w in words:
            if w in self.known or len(w) < 4:
                out.append(w)
                continue
            for stop in ("the", "our", "a", "for", "in"):
                if w.startswith(stop) and w[len(stop) :] in self.known:
                    w = w[len(stop) :]
            best = (self.wide_phrases if self._near(w) else self.wide).within(w, min(3, len(w) // 2))
            ok = best and (len(best) == 1 or best[0][0] < best[1][0])
            out.append(best[0][1] if ok and w not in self.known and (not self._near(w) or best[0][0] <= 2) else w)
        return out

    def _near(self, word: str) -> dict[str, float]:
        if word not in self.near:
            if len(self.near) > _CACHE:
                self.near.clear()
            alike = {*self.close.candidates(word), *(self.stems[word[:4]] if len(word) >= 4 and word[:4] in self.stems else ()), *((word,) if word in self.words_set else ())}
            close = {b: c for b in sorted(alike) if (c := likeness(word, b)) is not None}
            self.near[word] = close
        return self.near[word]

    def similar(self, words: list[str]) -> tuple[int, str]:
        """The entry all of whose words are in the value, at least cost; each word of the value serves once."""
        close = [(w, self._near(w)) for w in dict.fromkeys(words) if w not in _STOP]
        joins = [(a + b, self._near(a + b)) for (a, _), (b, _) in zip(close, close[1:])]
        parts: list[tuple[str, dict[str, float]]] = []
        for w, c in close:
            if not c and len(w) >= 8:
                for d, j in self.close_joined.within(w, 2):
                    parts += [(f"{w}/{x}", {x: 0.5 * d}) for x in self.joined[j].split()]
        close = close + parts + [(w, {b: x + 0.3 for b, x in c.items()}) for w, c in joins if c]
        options: dict[str, list[tuple[float, int]]] = defaultdict(list)
        for k, (_, c) in enumerate(close):
            for x, cost in c.items():
                options[x].append((cost, k))
        for x in options.values():
            x.sort()
        best: tuple[float, int] | None = None
        for at in sorted({at for x in options for at in self.by_rarest.get(x, ())}):
            i, entry = self.sets[at]
            cost, used = 0.0, set()
            for x in entry:
                free = next((o for o in options.get(x, ()) if o[1] not in used), None)
                if free is None:
                    break
                used.add(free[1])
                cost += free[0]
            else:
                if cost <= 1.0 * len(entry) and (best is None or cost < best[0]):
                    best = (cost, i)
        return (best[1], "similar") if best else (0, "none")


def build_matchers(entries: list[tuple[str, int, str]], phrases: dict[str, str], short: dict[str, str]) -> dict[str, Matcher]:
    """A matcher for each domain from (domain, id, name), phrases and words written short."""
    by: dict[str, list] = defaultdict(list)
    for domain, i, name in entries:
        by[domain].append((i, name))
    words = frozenset(w for _, _, name in entries for w in normal(name).split())
    return {d: Matcher(e, phrases, short, words) for d, e in by.items()}


#: Spellings of domains that aren't close to their names. Fixed values.
DOMAINS = {"artificialintelligence": "ai", "machinelearning": "ai", "cybersecurity": "security", "infosec": "security", "itsecurity": "security", "softwareeng": "softwareengineering", "swe": "softwareengineering", "oss": "opensource", "foss": "opensource", "educationtechnology": "edtech", "educationaltechnology": "edtech", "bizstrategy": "businessstrategy"}


def find_domain(text: str | None, known: dict[str, str]) -> str | None:
    """The domain that a text names in any spelling; known has each domain by its key."""
    key = domain_key(text)
    key = DOMAINS.get(key, key)
    if key in known:
        return known[key]
    if key + "s" in known or key[:-1] in known and key.endswith("s"):
        return known.get(key + "s") or known[key[:-1]]
    if len(key) >= 6:
        near = sorted((d, k) for k in known if len(k) >= 6 and (d := edits(key, k, 2)) <= 2)
        if near and (len(near) == 1 or near[0][0] < near[1][0]):
            return known[near[0][1]]
    return None


def map_values(df: DataFrame, id_col: str, domain_col: str, value_col: str, vocabulary: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """id_col, vocab_id, how for each row whose value is neither null nor blank nor unclassified: vocab_id is 0 when no entry of the domain is
    meant or the domain isn't known. how is exact, mention, parts, similar, none or no_domain.

    vocabulary has topic_domain, topic, vocab_id, seed_rank; of equal names the first by rank and id counts. aliases has alias, meaning, kind: kind
    word for a word written short, phrase for words that mean others. Each must have at most MAX_ENTRIES rows, else this raises. Repeated rows are mapped each.
    """
    rows = vocabulary.select("topic_domain", "vocab_id", "topic", "seed_rank").where("topic_domain is not null and topic is not null").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the canonical list has more than {MAX_ENTRIES} entries")
    entries = [(r.topic_domain, r.vocab_id, r.topic) for r in sorted(rows, key=lambda r: (r.topic_domain, r.seed_rank if r.seed_rank is not None else 1 << 30, r.vocab_id))]

    told = [] if aliases is None else aliases.select("alias", "meaning", "kind").where("alias is not null and meaning is not null").limit(MAX_ENTRIES + 1).collect()
    if len(told) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} aliases")
    phrases, short = ({r.alias: r.meaning for r in told if (r.kind == "word") == word} for word in (False, True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers = build_matchers(entries, phrases, short)
        known = {domain_key(d): d for d in matchers}
        domains: dict = {}
        seen: dict = {}
        for batch in batches:
            out = []
            for i, domain, value in zip(batch.iloc[:, 0], batch.iloc[:, 1], batch.iloc[:, 2]):
                if value is None or _EMPTY.match(value) and (not value.strip() or "unclassified" in value.lower()):
                    continue
                if domain not in domains:
                    if len(domains) > _CACHE:
                        domains.clear()
                    domains[domain] = find_domain(domain, known)
                if (d := domains[domain]) is None:
                    out.append((i, 0, "no_domain"))
                    continue
                if (d, value) not in seen:
                    if len(seen) > _CACHE:
                        seen.clear()
                    seen[d, value] = matchers[d].find(value)
                out.append((i, *seen[d, value]))
            if out:
                yield pd.DataFrame(out, columns=[id_col, "vocab_id", "how"])

    lean = df.select(F.col(id_col), F.col(domain_col), F.col(value_col))
    return lean.mapInPandas(run, f"`{id_col}` {dict(lean.dtypes)[id_col]}, vocab_id bigint, how string")
