import random

import pytest
from pyspark.sql import functions as F

from postloom.llm import bloom as B, personal as P
from postloom.llm.canonical import Near, edits, map_values
from postloom.llm.language import codewords, fit, find_segments, label_code, seed_samples, sentences, train, wrong_labels
from postloom.llm.personal import Lexicon, author_parts, find_personal, letter23, luhn, mod97, name_lexicon, redacted, spans
from postloom.llm.residue import build_automaton, find_residue, judge
from postloom.llm.truncation import ending, find_truncated, truncation_rates


@pytest.mark.parametrize("text", ["404 Not Found", "Error 500 : une erreur interne est survenue, veuillez réessayer plus tard.", "Please enable JavaScript and cookies to continue.", "Hi {{first_name}}, welcome", "[Your Name]: <Insert City>", "undefined", "NaN likes, undefined comments", "Title goes here", "asdf asdf", "页面未找到", "%%role%%", "TBD_LINK", "Lorem ipsum dolor sit amet consectetur"])
def test_residue(text):
    assert judge(text, build_automaton())[0]


@pytest.mark.parametrize("text", [None, "", "  ", "[removed]", "https://a.example/404", "`{{ user.name }}` is fine in templates", "Prefer List<String> over arrays in that API.", "The route is /users/{id}/posts.", "printf with %s and %d is clear.", "Wrote [WIP] in the title.", "An honest access denied page should say whom to ask.", "```\nerror\n```", "Use ${VAR:-default} in scripts."])
def test_content(text):
    assert not judge(text, build_automaton())[0]


#: Written by hand, none taken from the tables; their author had seen rows of these before, and the single words are those that a review named.
HELD_RESIDUE = [
    "503 Service Unavailable\n\nNo server is available to handle this request.\nPlease try again later.", "HTTP 410 Gone", "Oops! Something went wrong. Please try again later.", "This site can't be reached\nexample-host took too long to respond.", "502 Bad Gateway\nnginx",
    'Exception in thread "main" java.lang.NullPointerException\n    at com.acme.app.Main.run(Main.java:42)\n    at com.acme.app.Main.main(Main.java:7)', 'Traceback (most recent call last):\n  File "/srv/app/views.py", line 88, in detail\nValueError: invalid literal for int() with base 10', "Please enable JavaScript to view this page.", "Checking your browser before accessing the site. This process is automatic. Your browser will redirect shortly.",
    "You must be logged in to view this content.", "Dear {{ recipient.first }}, thanks for joining us!", "Hello *|FNAME|*, here is your weekly digest.", "Hi [Insert Name], we reviewed your application for [Job Title].", "[object Object]", "None", "NaN", "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor.", "test post please ignore", "Your text here", "Click to edit this text",
    "Zugriff verweigert. Sie haben keine Berechtigung, diese Seite anzusehen.", "Veuillez vous connecter pour continuer", "Page introuvable", "Página no encontrada. La página que busca no existe.", "Ocorreu um erro. Tente novamente mais tarde.", "Произошла ошибка. Повторите попытку позже.", "您访问的页面不存在", "エラーが発生しました。しばらくしてからもう一度お試しください。", "%FIRST_NAME%, your trial ends soon", "${customerName}, we miss you",
]
HELD_CONTENT = [
    "Sorry!", "home", "help", "Likes", "Gone.", "Conflict", "Error", "Reference", "Coming soon", "Comments", "Menu", "Sign in", "Go back", "Draft", "None of this surprised me.", "Undefined behaviour in C keeps me employed.", "We finally fixed the 404 page.", "Our 503s came from one slow query, so we cached it.", "Tip: return 403 Forbidden, not 404, when a user lacks permission.", "Something went wrong with our launch, and it was entirely my fault.",
    "KeyError: how one missing field cost us a weekend", "Terror and error are one letter apart, I thought on call.", "I asked support for help and they told me to enable JavaScript. It was disabled by policy.", "The placeholder text stayed in production for a week.", "Today I learned what `{{ value }}` does in a template.", "Use f'{name}' rather than '%s' % name.", "Testing is not a phase.", "[removed]", "Home is where the wifi is.", "Please sign in at the front desk when you visit us on Monday.",
]


def test_held_out_texts():
    a = build_automaton()
    # one is missed: the sentence of one server's page that no phrase has
    assert len([t for t in HELD_RESIDUE if not judge(t, a)[0]]) <= 1 and [t for t in HELD_CONTENT if judge(t, a)[0]] == []


def test_residue_frame(spark):
    df = spark.createDataFrame([(1, "null", "x"), (1, "null", "x"), (2, None, "y"), (3, "a real text " * 20_000, "z")], "idx bigint, post_text string, reason string")
    assert [(r.idx, r.reason) for r in find_residue(df, "idx", "post_text").collect()] == [(1, "empty_value")] * 2
    assert find_residue(df.limit(0), "idx", "post_text").count() == 0


def test_checksums():
    assert luhn("4539 1488 0343 6467") and not luhn("4539 1488 0343 6468") and letter23("12345678Z") and not letter23("12345678A") and mod97("850730033" + f"{97 - 850730033 % 97:02d}")


def test_personal(spark):
    people = [(f"Mara Tollwick{'' if k % 2 else ', PhD'}",) for k in range(4)] + [("Ivo Brandel",)] * 3
    texts = [
        "Mail me: ivo (at) some-host dot example or +49-30-2312 5723", "Our SSN 123-45-6789 leaked", "Build 123-45-6789 failed", "Order 00944368221 shipped", "We meet at 12 Old Mill Road, Marfield 00418", "Then MARA TOLLWICK joined", "cc Ivo", "The gateway at 10.0.0.17 answers", "Section 23 Road map items",
        "Pin it to @scope/name@4.1.6 now", "call five five five zero one nine four", "P.O. Box 12, Marfield", "wohnt Lindenstraße 24a, 05176 Quellau", "Calle del Olmo 81", "18 rue des Bois, 00033 Valmorte", None, "", "x " * 50_000, "passport no. XQ1234567",
    ]
    df = spark.createDataFrame([(i, t, people[i % len(people)][0]) for i, t in enumerate(texts)] + [(90, "", "Veltrix Cloud"), (91, None, "quiet_otter12"), (92, "", "a.b@c.example"), (93, "", None)], "idx bigint, post_text string, author_name string")
    got = {}
    for r in find_personal(df.withColumnRenamed("idx", "idx"), "idx", "post_text", "author_name", name_lexicon(spark.createDataFrame(people, "author_name string"), "author_name")).collect():
        got.setdefault((r.idx, r.field_name), set()).add(r.kind)
    text = {i: got.get((i, "post_text"), set()) for i in range(len(texts))}
    assert text[0] == {"email", "phone"} and text[1] == {"national_id"} and text[4] == {"street_address"} and text[5] == text[6] == {"person_name"} and text[10] == {"phone"} and text[18] == {"national_id"}
    assert all(text[i] == {"street_address"} for i in (11, 12, 13, 14)) and all(not text[i] for i in (2, 3, 7, 8, 9, 15, 16, 17))
    assert got[(0, "author_name")] == {"person_name"} and (90, "author_name") not in got and (91, "author_name") not in got and got[(92, "author_name")] == {"email"} and (93, "author_name") not in got
    assert find_personal(df.limit(0), "idx", "post_text", "author_name").count() == 0


def test_bare_numbers_by_checksum():
    kinds = lambda t: {k for _, _, k in spans(t, Lexicon(None))}
    for t in ("529.982.247-25 is on the form", "he wrote 44051401359 on it", "her entry in the register: 86095742719", "her 10000000146 was printed", "SSN 123-45-6789", "It says 123-45-6789 there", "Ihre Steuer-ID 86095742719", "131052-308T", "BSN 111222333", "his id 2341 2341 2346"):
        assert kinds(t) == {"national_id"}, t
    for t in ("529.982.247-26 is on the form", "SSN 000-00-0000", "he wrote 44051401358 on it", "Order 44051401359 shipped", "build 123-45-6789 failed", "tracking number 10000000146", "131052-308U", "row 2341 2341 2347"):
        assert "national_id" not in kinds(t), t


def test_checksums_of_shapes():
    d = lambda t: [int(c) for c in t]
    for check, good in ((P.cpf, "52998224725"), (P.pesel, "44051401359"), (P.tax_id_de, "86095742719"), (P.kimlik, "10000000146"), (P.bsn, "111222333"), (P.verhoeff, "2363"), (P.ssn, "123456789")):
        assert check(d(good))
        if check is not P.ssn:
            assert not any(check(d(good[:-1] + str((int(good[-1]) + k) % 10))) for k in range(1, 10))
    # every error of one digit and every exchange of neighbours is caught by the dihedral check
    rng = random.Random(4)
    for _ in range(50):
        body = [rng.randrange(10) for _ in range(8)]
        full = next(body + [k] for k in range(10) if P.verhoeff(body + [k]))
        assert not any(P.verhoeff(full[:i] + [x] + full[i + 1 :]) for i in range(9) for x in range(10) if x != full[i])
        assert not any(P.verhoeff(full[:i] + [full[i + 1], full[i]] + full[i + 2 :]) for i in range(8) if full[i] != full[i + 1])


def test_filter_grows_with_the_names(spark):
    keys = spark.range(50_000).select(F.concat(F.lit("n"), "id").alias("k"))
    few, many = B.build(keys.where("id < 10"), strict=True), B.build(keys, strict=True)
    assert len(many) > len(few) and all(f"n{k}" in B.Bloom(many) for k in range(0, 50_000, 97))
    assert sum(f"x{k}" in B.Bloom(many) for k in range(20_000)) < 40 and "n1" not in B.Bloom(B.build(keys.limit(0), strict=True))
    with pytest.raises(ValueError):
        B.build(keys, strict=True, per_key=1 << 20)


def test_redaction():
    assert redacted("mail a@b.example now", [(5, 16, "email")]) == "mail <EMAIL> now" and redacted(None, []) is None
    assert author_parts("TOLLWICK, Mara") == ("Mara", "TOLLWICK") and author_parts("Tarn & Harrow Consulting") is None and author_parts("Dr. Mara O. Tollwick, PhD") == ("Mara", "Tollwick")


def test_canonical(spark):
    vocab = spark.createDataFrame([(1, "AI", "model serving cost control", 1), (2, "AI", "model serving rollout plan", 2), (3, "AI", "prompt caching cost control", 3), (4, "Data & Analytics", "model serving cost control", 1)], "vocab_id bigint, topic_domain string, topic string, seed_rank int")
    rows = ["Model Serving Cost Control!", "cost control for model serving at scale", "modelserving cost contorl", "#PromptCachingCostControl", "controlling the cost in prompt cachign", "model serving", "model serving market trends", "prompt caching rollout plan", "knitting cost control", "Unclassified", None, " ", "-"]
    df = spark.createDataFrame([(i, "A.I." if False else " ai", t) for i, t in enumerate(rows)] + [(50, "data and analytics", "model serving cost control"), (51, "Healthcare", "model serving cost control"), (52, None, "model serving cost control")], "idx bigint, topic_broad string, topic string")
    got = {r.idx: r.vocab_id for r in map_values(df, "idx", "topic_broad", "topic", vocab).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 3, 4: 3, 5: 0, 6: 0, 7: 0, 8: 0, 12: 0, 50: 4, 51: 0, 52: 0}
    assert edits("abcd", "abdc", 2) == 1 and edits("abc", "xyz", 2) == 3
    assert map_values(df.limit(0), "idx", "topic_broad", "topic", vocab).count() == 0


def test_near_loses_no_word():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 13))) for _ in range(300)})
    for most in (1, 2, 3):
        near = Near(words, most)
        for w in ("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 13))) for _ in range(60)):
            assert near.within(w, most) == sorted((d, x) for x in words if (d := edits(w, x, most)) <= most)


def test_aliases_are_a_table(spark):
    vocab = spark.createDataFrame([(1, "AI", "prompt caching cost control", 1), (2, "AI", "prompt caching failure analysis", 2)], "vocab_id bigint, topic_domain string, topic string, seed_rank int")
    df = spark.createDataFrame([(1, "AI", "prompt caching: why it breaks"), (2, "AI", "pc cost control")], "idx bigint, topic_broad string, topic string")
    aliases = spark.createDataFrame([("why it breaks", "failure analysis", "phrase"), ("pc", "prompt caching", "word"), (None, "x", "word")], "alias string, meaning string, kind string")
    assert {r.idx: r.vocab_id for r in map_values(df, "idx", "topic_broad", "topic", vocab, aliases).collect()} == {1: 2, 2: 1}
    assert {r.idx: r.vocab_id for r in map_values(df, "idx", "topic_broad", "topic", vocab).collect()} == {1: 0, 2: 0}
    long = spark.createDataFrame([(1, "AI", "prompt caching " * 20_000 + "cost control")], df.schema)
    assert map_values(long, "idx", "topic_broad", "topic", vocab).first().vocab_id == 1


def test_language_model():
    samples = seed_samples()
    held = samples[::7]
    model = train([s for k, s in enumerate(samples) if k % 7])
    right = sum(model.languages[b] == x for (x, _), b in zip(held, model.losses([t for _, t in held]).argmin(axis=1)))
    assert right >= 0.9 * len(held)
    code = codewords(25)
    assert min((code[a] != code[b]).sum() for a in range(25) for b in range(a)) >= 5


def test_segments(spark):
    de, en, ja = "Wir haben das System nach langem Zögern umgestellt und sparen jetzt Zeit.", "We keep a list of open questions about it on one page and read it often.", "それ以来、毎月およそ二十時間を節約できています。"
    rows = [(1, f"{en} {de}", "en"), (2, en, "English"), (3, de, "en"), (4, ja, None), (5, "https://a.example", "xx"), (6, None, "en"), (7, "", None), (8, "asdf asdf asdf", None), (9, "```\nfor row in rows:\n    print(row)\n```", "??"), (10, f"{en} {en}", "en_GB"), (11, "🚀 👉", "und")]
    df = spark.createDataFrame(rows, "idx bigint, post_text string, lang string")
    segments = find_segments(df, "idx", "post_text", "lang", train(seed_samples()))
    assert {(r.idx, r.lang_code) for r in wrong_labels(segments, "idx").collect()} == {(1, "en"), (1, "de"), (3, "de"), (4, "ja")}
    assert segments.where("idx = 10").count() == 1 and find_segments(df.limit(0), "idx", "post_text", "lang", train(seed_samples())).count() == 0
    assert label_code("pt-BR") == "pt" and label_code("?? ") is None and label_code("Russian") == "ru" and sentences("a " * 100_000)[:1]


def test_segments_have_their_place(spark):
    de, en = "Wir haben das System nach langem Zögern umgestellt und sparen jetzt Zeit.", "We keep a list of open questions about it on one page and read it often."
    text = f"#tag {en} `code here` {de} See https://a.example/x for the rest of the story we told."
    df = spark.createDataFrame([(1, text, "en"), (2, None, None), (3, " ", "en"), (4, "https://a.example", None), (5, "Zxq vrrk blorf", None)], "idx bigint, post_text string, lang string")
    rows = find_segments(df, "idx", "post_text", "lang", train(seed_samples())).orderBy("idx", "segment").collect()
    parts = {(r.idx, r.segment): (r.lang_code, text[r.start : r.end].strip()) for r in rows if r.idx == 1}
    assert parts[1, 0][0] == "en" and en in parts[1, 0][1] and parts[1, 1][0] == "de" and de in parts[1, 1][1]
    assert {r.idx: r.lang_code for r in rows if r.idx in (2, 3, 4)} == {2: "zxx", 3: "zxx", 4: "zxx"} and [r.ambiguous for r in rows if r.idx == 5] == [True]


def test_sample_of_any_usual_language(spark):
    de = "Wir haben das System nach langem Zögern umgestellt und sparen jetzt Zeit."
    df = spark.createDataFrame([(f"{de} {k}. " * 40, x) for k in range(20) for x in ("de", "German")] + [("We keep a list of open questions.", "en"), ("x", "??")], "post_text string, lang string")
    model = fit(df, "post_text", "lang")
    assert model.languages[model.losses([de]).argmin()] == "de"
    assert fit(df.limit(0), "post_text", "lang").languages == model.languages


def test_truncation(spark):
    whole = "The team moved the glossary to another quarter. Everything about the model is on one page. It was simple: measure first, then decide."
    rows = [(i, whole, "a") for i in range(20)] + [(50, whole + " The team moved the glos", "a"), (51, whole[:-1], "a"), (52, whole + " Everything about the", None), (53, whole + " The team […]", "b"), (54, None, "b"), (55, " ", "b"), (56, whole + "\n#tag", "b"), (57, "Caf�", "b"), (50, whole + " The team moved the glos", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 as last", "2 as gram4")
    got = find_truncated(df)
    assert {r.doc_id for r in got.where("cut").collect()} == {50, 52, 53, 57} and got.count() == 27
    assert {r.source: r.cut for r in truncation_rates(got).collect()} == {"a": 2, None: 1, "b": 2}
    assert find_truncated(df.limit(0)).count() == 0 and ending("see https://a.example/b")[0] == "done"


def test_truncation_inside_links_and_tables(spark):
    whole = "We read https://docs.veltrix.example/a/one and https://blog.northfen.example/two first. Ask #leadership or #teams about due dates. Run make with --verbose on staging."
    cut = [whole + x for x in (" More: https://docs.veltr", " Background at https://northf", " See https:", " | stage | owner | du", " Ask #leader", " Run make with --verb", " Use `make build` on stag", " Run make -n stag", " Write to ann@docs.velt")]
    done = [whole + x for x in (" More: https://docs.veltrix.example/a/three", " See https://docs.veltrix.example/a", " See https://blog.northfen.example", " Ask #teams", " kubectl get pods | wc -l", " Use `make build`", "\n| stage | owner |", " Run make with --verbose", " See https://other.example/x")]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate([*cut, *done, whole])], "doc_id bigint, text string, source string")
    assert sorted(r.doc_id for r in find_truncated(df).where("cut").collect()) == list(range(len(cut)))


def test_truncation_of_copies(spark):
    whole = "The team moved the glossary to another quarter. Everything about the model is on one page."
    inner = "Nobody asked why the glossary bot was slow last week."
    cut = "It was simple. Nobody asked why the glossary bot was"
    rows = [(i, f"{whole} Note {i} says it. {inner}", "a") for i in range(5)] + [(100 + i, cut + " " * (i % 3), "a") for i in range(60)] + [(200 + i, whole, "a") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {r.doc_id for r in find_truncated(df).where("cut").collect()} == set(range(100, 160))
