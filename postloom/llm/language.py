"""Languages of documents and of the segments of mixed ones, by error-correcting output codes.

Each language has a codeword of bits. Of each bit a binary classifier over hashed character n-grams gives a margin for a sentence; the
codeword of least weighted loss is nearest, its confidence comes from the losses, and a near second flags ambiguity. The classifiers are
trained on the sentences of seed_texts and on a bounded sample of labelled rows, of which a sentence serves only when the model of the
seeds agrees with the row's label. The model has a fixed size. Sentences of a batch are scored together, in one pass without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .residue import _CODE, _LIKELY, _PLACEHOLDER, LOREM
from .seed_texts import SEEDS

DIM = 1 << 16
BITS = 24
ORDERS = (1, 2, 3, 4, 5)
SCALE = 2.0
FLOOR = 0.05
WIDE_SLACK = 20.0
#: Labelled rows from which the model is refined, and sentences of one language among them.
SAMPLE_ROWS = 20_000
SAMPLE_PER_LANGUAGE = 3000
#: Sentences of one labelled row that may serve, and code points of a sentence; so the sample is bounded whatever the texts are.
SAMPLE_PER_ROW = 30
SAMPLE_LENGTH = 600
#: Codes of ISO 639 for text without prose and for prose of no language that is known.
NO_PROSE, UNDETERMINED = "zxx", "und"

#: Names of languages in labels, beside their ISO 639-1 codes. Fixed values.
NAMES = {
    "en": "eng english anglais inglés englisch", "de": "deu ger german deutsch allemand alemán", "nl": "nld dut dutch nederlands", "fr": "fra fre french français francais französisch", "es": "spa spanish español espanol castellano", "pt": "por portuguese português portugues",
    "it": "ita italian italiano", "sv": "swe swedish svenska", "pl": "pol polish polski", "tr": "tur turkish türkçe turkce", "ru": "rus russian русский", "uk": "ukr ukrainian українська", "zh": "zho chi chinese mandarin cmn 中文", "ja": "jpn japanese 日本語", "ko": "kor korean 한국어", "ar": "ara arabic العربية",
    "hi": "hin hindi", "el": "ell gre greek", "cs": "ces cze czech čeština", "fi": "fin finnish suomi", "da": "dan danish dansk", "no": "nor nob nno nb nn norwegian norsk", "ro": "ron rum romanian română", "hu": "hun hungarian magyar", "vi": "vie vietnamese", "id": "ind indonesian", "az": "aze azerbaijani", "ca": "cat catalan català",
    "gl": "glg galician", "af": "afr afrikaans", "be": "bel belarusian", "bg": "bul bulgarian", "sk": "slk slo slovak", "sl": "slv slovenian", "hr": "hrv croatian", "sr": "srp serbian", "he": "heb hebrew", "fa": "fas per persian", "th": "tha thai", "et": "est estonian", "lv": "lav latvian", "lt": "lit lithuanian", "is": "isl ice icelandic",
    "ms": "msa may malay", "sw": "swa swahili", "bn": "ben bengali", "ta": "tam tamil", "ur": "urd urdu", "kk": "kaz kazakh", "mk": "mkd mac macedonian", "eu": "eus baq basque", "ga": "gle gai irish", "cy": "cym wel welsh", "lb": "ltz luxembourgish", "la": "lat latin", "eo": "epo esperanto", "tl": "tgl tagalog filipino",
}
_BY_NAME = {n: code for code, names in NAMES.items() for n in (code, *names.split())}


def label_code(label: str | None) -> str | None:
    """The two-letter code that a label names in a common spelling; None for missing, unknown and unreadable labels."""
    if label is None:
        return None
    t = label.strip().lower().replace("_", "-")
    return _BY_NAME.get(t) or _BY_NAME.get(re.split(r"[-\s(]", t)[0]) if t else None


def folded(text: str) -> str:
    """Without accents, as typed on keyboards that lack them."""
    t = text.replace("ß", "ss").replace("ł", "l").replace("ı", "i").replace("ø", "o").replace("æ", "ae")
    return "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))


_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’»)\]]*\s+|\n+|(?<=[。！？])")
_NOT_TEXT = re.compile(r"https?://\S+|www\.\S+|\S+@\S+|(?<!\w)[#@]\w\S*|</?[A-Za-z][^<>\n]{0,200}>|\br/\w+", re.I)
_CODE_LINE = re.compile(r"^\s*(?:Traceback \(most|File \"|[\w.]*Error: |(?:select|insert|update|delete)\s.*(?:;|from)|(?:kubectl|git|docker|npm|pip|make|curl|for|def|import|print)\b.*[|(&:=-]).*$", re.I | re.M)
_CODE_MARKS = (" | ", ");", "Traceback", "Error:", " = ", "(*)", "&&", "File \"", "';", " -n ")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_KEYS = frozenset("asdf asdfasdf asdfgh qwerty qwer asd sdf dfg xxx xxxx blah foo bar baz lorem ipsum undefined null nan none nil object likes comments shares".split())
_BLANKS = re.compile(r" {2,}")
_CAPITAL = re.compile(r"[A-ZÀ-ÞА-Я\d]")
_NO_PROSE = LOREM | _KEYS
_FILLER = _NO_PROSE - frozenset("in do sit id est ad et ut sed non a qui sunt ex ea nisi anim".split())
_STATE: dict[str, np.ndarray] = {}


def _blanked(m: re.Match) -> str:
    return " " * len(m[0])


def _broken(m: re.Match) -> str:
    return "\n" + " " * (len(m[0]) - 1)


def sentence_spans(text: str | None, least: int = 3) -> list[tuple[str, int, int]]:
    """(sentence, start, end) of the sentences of prose in a text: without code, links, addresses, tags and placeholders, which are blanks in the
    sentence; of at least so many words (or twice as many wide characters), not mostly names or filler in no language. None for null and blank texts."""
    if not text or not text.strip():
        return []
    t = text
    if "`" in t:
        t = _CODE.sub(_broken, t)
    if _LIKELY.search(t):
        t = _PLACEHOLDER.sub(_blanked, t)
    if "@" in t or "#" in t or "<" in t or "r/" in t or "://" in t or "www." in t:
        t = _NOT_TEXT.sub(_blanked, t)
    if any(k in t for k in _CODE_MARKS):
        t = _CODE_LINE.sub(_broken, t)
    out = []
    changed = t is not text
    start = 0
    for stop, then in [*(m.span() for m in _SENTENCE.finditer(t)), (len(t), len(t))]:
        s, at, start = t[start:stop], start, then
        words = s.split()
        if changed:
            s = _BLANKS.sub(" ", s)
        if not s.isascii() and len(s) > least and len(_WIDE.findall(s)) >= 2 * least:
            out.append((s, at, stop))
            continue
        if len(words) < least:
            continue
        if len(words) > 5 and (s.isascii() or s.lower() != s.upper()) and len(_CAPITAL.findall(s)) <= 0.4 * len(words) and _FILLER.isdisjoint(words):
            out.append((s, at, stop))
            continue
        heads = "".join([w[0] if len(w) == 1 or w[0].isalpha() else w[1] for w in words])
        letters = sum(map(str.isalpha, heads))
        if letters < least or sum(map(str.isupper, heads)) > 0.6 * letters and not s.isupper():
            continue
        if not _FILLER.isdisjoint(words) or not _FILLER.isdisjoint(s.lower().split()[:3]):
            low = s.lower().split()
            if sum(w.strip(".,;:!?-") in _NO_PROSE for w in low) >= 0.6 * len(low):
                continue
        out.append((s, at, stop))
    return out


def sentences(text: str | None, least: int = 3) -> list[str]:
    """The sentences alone."""
    return [s for s, _, _ in sentence_spans(text, least)]


def _table() -> np.ndarray:
    """For each character of the basic plane its lower case, a blank for what is no letter; line breaks stay."""
    if "table" not in _STATE:
        out = np.full(0x10000, 32, dtype=np.uint32)
        for k in range(0x10000):
            if (c := chr(k)).isalpha():
                out[k] = ord(c.lower()[0])
        out[10] = 10
        _STATE["table"] = out
    return _STATE["table"]


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, starts) of each order: the hashed n-grams of the texts, one after the other; starts has where each text's begin and the end.
    Of scripts with blanks those at the start or end of a word, blank included; of wide characters, single ones and pairs."""
    c = np.frombuffer("\n".join([f" {t} " for t in texts]).encode("utf-32-le", "replace"), dtype=np.uint32)
    c = _table()[np.minimum(c, 0xFFFF)]
    blank = c == 32
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    c = c[keep]
    apart, blank, wide = c == 10, c == 32, (c >= 0x3040) & (c < 0xD7B0)
    number = np.cumsum(apart, dtype=np.int32)
    any_wide = wide.any()
    for n in ORDERS:
        if n < 3 and not any_wide:
            yield np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
            continue
        size = max(0, len(c) - n + 1)
        h = np.full(size, n, dtype=np.uint32)
        for k in range(n):
            h *= np.uint32(1_000_003)
            h += c[k : size + k]
        h *= np.uint32(0x9E3779B1)
        ok = wide[:size] & wide[n - 1 :] if n < 3 else blank[:size] | blank[n - 1 :]
        ok &= (number[:size] == number[n - 1 :]) & ~apart[:size]
        yield (h[ok] >> np.uint32(16)).astype(np.int64), np.searchsorted(number[:size][ok], np.arange(len(texts) + 1))


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  #: languages x bits, of 1 and -1
    weights: np.ndarray  #: DIM x bits
    trust: np.ndarray  #: weight of each bit's loss

    def margins(self, texts: list[str]) -> np.ndarray:
        """texts x bits: the mean log odds of the n-grams, scaled."""
        n = np.zeros(len(texts), dtype=np.int64)
        sums = np.zeros((len(texts), self.weights.shape[1]), dtype=np.float32)
        for h, starts in grams(texts):
            own = np.diff(starts)
            n += own
            for a in range(0, len(texts), 512):  # bounds the memory of the gathered rows
                b = min(a + 512, len(texts))
                rows = np.flatnonzero(own[a:b]) + a
                if len(rows):
                    sums[rows] += np.add.reduceat(self.weights[h[starts[a] : starts[b]]], starts[rows] - starts[a], axis=0)
        return SCALE * sums / np.maximum(n, 1)[:, None]

    def losses(self, texts: list[str]) -> np.ndarray:
        """texts x languages: the weighted loss of each codeword."""
        margins = self.margins(texts)
        pos, neg = np.logaddexp(0, -margins) * self.trust, np.logaddexp(0, margins) * self.trust
        up = (self.code > 0).astype(np.float32)
        return pos @ up.T + neg @ (1 - up).T


def codewords(n: int, bits: int = BITS, tries: int = 400, seed: int = 5) -> np.ndarray:
    """n codewords: of random balanced columns, those whose closest two rows are farthest apart."""
    rng = np.random.default_rng(seed)
    best, best_d = None, -1
    for _ in range(tries):
        m = np.stack([rng.permutation(np.where(np.arange(n) < (n + 1) // 2, 1, -1)) for _ in range(bits)], axis=1)
        d = (bits - m @ m.T) // 2
        np.fill_diagonal(d, bits)
        if d.min() > best_d:
            best, best_d = m, d.min()
    return best


def train(samples: list[tuple[str, str]], seed: int = 3) -> Model:
    """A model from (language, text): naive Bayes of each bit, its two classes being the languages whose codewords have 1 and -1, each
    language with the same weight. A share FLOOR of each distribution is uniform, so that unseen n-grams favour no language."""
    languages = sorted({x for x, _ in samples})
    code = codewords(len(languages), seed=seed)
    shares = np.empty((len(languages), DIM))
    for k, x in enumerate(languages):
        counts = np.zeros(DIM)
        for h, _ in grams([t for y, t in samples if y == x]):
            counts += np.bincount(h, minlength=DIM)
        shares[k] = (1 - FLOOR) * counts / max(1, counts.sum()) + FLOOR / DIM
    up = (code > 0).astype(float)
    w = np.log((up.T @ shares) / up.sum(axis=0)[:, None]) - np.log(((1 - up).T @ shares) / (1 - up).sum(axis=0)[:, None])
    model = Model(languages, code, np.ascontiguousarray(w.T, dtype=np.float32), np.ones(BITS, dtype=np.float32))
    # a bit's trust falls with its errors on the samples
    right = code[[languages.index(x) for x, _ in samples]]
    wrong = (np.sign(model.margins([t for _, t in samples])) != right).mean(axis=0)
    trust = np.clip(np.log((1 - wrong + 1e-3) / (wrong + 1e-3)), 0.2, 7.0)
    model.trust = (trust / trust.mean()).astype(np.float32)
    return model


def seed_samples() -> list[tuple[str, str]]:
    out = []
    for code, text in SEEDS.items():
        own = [s for s in re.split(r"(?<=[.!?])\s+|(?<=[。！？])", text) if s]
        for s in own:
            out += [(code, s)] + ([(code, folded(s))] if folded(s) != s else [])
            words = s.split()
            if len(words) > 7:
                out += [(code, " ".join(words[: len(words) // 2])), (code, " ".join(words[len(words) // 2 :]))]
    return out


def fit(df: DataFrame, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """The model of the seeds, refined by a sample of at most `rows` labelled rows (those of the smallest hash of the text, so that the
    sample is the same in any order of the rows)."""
    first = train(seed_samples())
    labelled = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"), F.xxhash64(text_col, F.lit(1)).alias("h"))
    # the spellings of the most frequent label: it fills most of any sample, so rows of other labels come first
    spellings = labelled.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(1000).collect()
    by_code: Counter = Counter()
    for r in spellings:
        by_code[label_code(r.l)] += r.n
    del by_code[None]
    if not by_code:
        return first
    usual = [r.l for r in spellings if label_code(r.l) == by_code.most_common(1)[0][0]]
    by_label = labelled.withColumn("other", ~F.col("l").isin(usual))
    sample = by_label.orderBy(F.desc("other"), "h").limit(rows // 2).unionByName(by_label.where("not other").orderBy("h").limit(rows // 10))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(h, code, k, s) for t, label, h in zip(batch["t"], batch["l"], batch["h"]) if (code := label_code(label)) for k, s in enumerate(sentences(t)[:SAMPLE_PER_ROW]) if len(s) <= SAMPLE_LENGTH]
            if out:
                yield pd.DataFrame(out, columns=["h", "code", "k", "s"])

    known = set(first.languages)
    parts = sample.select("t", "l", "h").mapInPandas(split, "h bigint, code string, k int, s string").collect()
    pairs = [(r.code, r.s) for r in sorted(parts, key=lambda r: (r.code, r.h, r.k)) if r.code in known]
    if not pairs:
        return first
    seeds = seed_samples()
    most = Counter(code for code, _ in pairs).most_common(1)[0][0]
    model = first
    # the language of most labels is right for nearly all their sentences, which serve unless another is far nearer; of the others' rows
    # many hold sentences of that one, so theirs serve only where the model agrees
    for _ in range(3):
        loss = model.losses([s for _, s in pairs])
        off = loss[np.arange(len(pairs)), [model.languages.index(code) for code, _ in pairs]] - loss.min(axis=1)
        count: Counter = Counter()
        more = []
        for (code, s), o in zip(pairs, off):
            if o <= (WIDE_SLACK if code == most else 0) and count[code] < per_language:
                count[code] += 1
                more += [(code, s)] + ([(code, folded(s))] if folded(s) != s else [])
        model = train(seeds + more)
    return model


def decode(model: Model, loss: np.ndarray, near: float = 10.0, temperature: float = 5.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language index, confidence, ambiguous) of each row of losses."""
    best = loss.argmin(axis=1)
    p = np.exp(-(loss - loss.min(axis=1, keepdims=True)) / temperature)
    two = np.partition(loss, 1, axis=1)
    return best, 1 / p.sum(axis=1), two[:, 1] - two[:, 0] < near


def _segments(model: Model, texts: list[str | None]) -> Iterator[tuple[int, int, str, float, bool, int, int, int, int]]:
    """(row, segment, language, confidence, ambiguous, sentences, words, start, end) of a batch of texts; neighbours of one language are one segment."""
    rows, flat, where = [], [], []
    for k, t in enumerate(texts):
        own = sentence_spans(t) or sentence_spans(t, 2)
        if not own:
            yield k, 0, NO_PROSE, 1.0, False, 0, 0, 0, len(t or "")
        flat += [s for s, _, _ in own]
        where += [(a, b) for _, a, b in own]
        rows += [k] * len(own)
    if not flat:
        return
    loss = model.losses(flat)
    best, sure, doubtful = decode(model, loss)
    best, sure, doubtful = best.tolist(), sure.tolist(), doubtful.tolist()
    names, end = model.languages, 0
    while end < len(flat):
        start = end
        while end < len(flat) and rows[end] == rows[start]:
            end += 1
        row, own = rows[start], range(start, end)
        if len(set(best[start:end])) == 1 and not any(doubtful[start:end]):  # the usual case
            yield row, 0, names[best[start]], sum(sure[start:end]) / len(own), False, len(own), sum([len(s.split()) for s in flat[start:end]]), where[start][0], where[end - 1][1]
            continue
        if max(sure[start:end]) < 0.45 and all(doubtful[start:end]) and sum([len(s.split()) for s in flat[start:end]]) < 8:
            # a few words that no language claims
            yield row, 0, UNDETERMINED, max(sure[start:end]), True, len(own), sum([len(s.split()) for s in flat[start:end]]), where[start][0], where[end - 1][1]
            continue
        total: Counter = Counter()
        for i in own:
            total[best[i]] += len(flat[i]) * sure[i]
        main = total.most_common(1)[0][0]
        firm = {best[i] for i in own if not doubtful[i] and sure[i] > 0.8} | {main}
        langs = []
        for i in own:
            b, c = best[i], sure[i]
            # a doubtful or very short sentence goes with a language that the document has for sure
            if b != main and (b not in firm or len(flat[i].split()) < 3 and not _WIDE.search(flat[i]) or doubtful[i]):
                other = min(firm, key=lambda x: loss[i, x])
                if loss[i, other] - loss[i, b] < 12:
                    b, c = other, float(np.exp(-(loss[i, other] - loss[i].min()) / 5.0)) * sure[i]
            langs.append((b, c))
        k = at = 0
        while at < len(own):
            to = at
            while to < len(own) and langs[to][0] == langs[at][0]:
                to += 1
            part = range(start + at, start + to)
            yield row, k, names[langs[at][0]], sum(c for _, c in langs[at:to]) / (to - at), all(doubtful[x] for x in part), to - at, sum(len(flat[x].split()) for x in part), where[start + at][0], where[start + to - 1][1]
            k, at = k + 1, to


def find_segments(df: DataFrame, id_col: str, text_col: str, lang_col: str, model: Model | None = None) -> DataFrame:
    """id_col, label (code of lang_col, null if missing or unknown), segment, lang_code, confidence, ambiguous, sentences, words, start, end: the
    stretches of prose of each text with their language and their place in it, in code points. A text without prose, also a null or blank one, has one row with the code NO_PROSE; a few words
    that no language claims have UNDETERMINED. Repeated rows are judged each; whole texts are read.
    """
    shipped = df.sparkSession.sparkContext.broadcast(model or fit(df, text_col, lang_col))  # DIM x BITS floats: 6 MB at any size of the corpus
    lean = df.select(F.col(id_col), F.col(text_col), F.col(lang_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shipped.value
        for batch in batches:
            ids, labels = batch.iloc[:, 0].tolist(), [label_code(x) for x in batch.iloc[:, 2]]
            out = [(ids[k], labels[k], *rest) for k, *rest in _segments(model, batch.iloc[:, 1].tolist())]
            if out:
                yield pd.DataFrame(out, columns=[id_col, "label", "segment", "lang_code", "confidence", "ambiguous", "sentences", "words", "start", "end"])

    return lean.mapInPandas(run, f"`{id_col}` {dict(lean.dtypes)[id_col]}, label string, segment int, lang_code string, confidence double, ambiguous boolean, sentences int, words int, start int, end int")


def wrong_labels(segments: DataFrame, id_col: str) -> DataFrame:
    """id_col, lang_code: the languages of each document whose label is missing, unknown, not among them, or but one of several.
    They are grouped by id and label; a document has no more languages than the model."""
    langs = segments.where(~F.col("lang_code").isin(NO_PROSE, UNDETERMINED)).groupBy(id_col, "label").agg(F.collect_set("lang_code").alias("langs"))  # no more than there are languages
    return langs.where(~((F.size("langs") == 1) & F.coalesce(F.col("label") == F.col("langs")[0], F.lit(False)))).select(id_col, F.explode("langs").alias("lang_code"))
