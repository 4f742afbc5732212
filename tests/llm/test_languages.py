import random

from quire.llm import languages as lg

TEXT = {
    "en": "the old {0} crossed the bridge and her brother watched the quiet harbour from the hill with a lantern",
    "fr": "le vieux {0} traversa le pont et son frère regardait la mer tranquille depuis la colline avec une lampe",
    "de": "der alte {0} ging über die Brücke und sein Bruder sah den stillen Hafen vom Hügel mit einer Lampe",
    "ru": "старый {0} перешёл через мост и его брат смотрел на тихую гавань с холма с фонарём в руке",
    "ja": "年老いた{0}は橋を渡った。その晩、弟は丘の上から静かな港を見つめていた。提灯を抱えていた。",
}


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(120):
        lang = rng.choice(list(TEXT))
        body = "\n".join(TEXT[lang].format(rng.choice(["Holm", "Varga", "Tull"])) for _ in range(3))
        rows.append((i, body, rng.choice([lang, lang, lang, None, "en"]), lang))
    return rows


def test_labels_in_any_spelling():
    assert [lg.label_language(x) for x in ("de-DE", "ENG", " Français ", "und", "", None, "None", "pt_BR")] == ["de", "en", "fr", None, None, None, None, None]


def test_units_of_both_kinds_of_script():
    units = lg.Units("Ça va, 漢字かな 12")
    assert len(units) == 6 and units.weight.sum() == 2 * 10 + 4 * 10 / lg.CHARS_PER_WORD
    assert len(lg.Units("1234 ...")) == 0 == len(lg.Units("")) == len(lg.Units())


def test_wrong_and_missing_labels_and_mixed_pages(spark):
    rows = corpus()
    mixed = TEXT["en"].format("x") + ". " + TEXT["fr"].format("y") + ". " + TEXT["en"].format("z")
    phrase = TEXT["en"].format("x") + " sur le pont " + TEXT["en"].format("z")
    rows += [(900, mixed, "en", None), (901, phrase, "en-GB", None), (902, None, "en", None), (903, " 12 ", None, None), (904, "", None, None)]
    df = spark.createDataFrame(rows, "page_id long, page_body string, lang string, truth string").selectExpr("*", "1 as k", "2 as t")
    segments = lg.segment_languages(df, "page_id", "page_body", "lang").cache()
    main = {r.key: (r.lang, r.confidence) for r in lg.page_languages(segments).collect()}
    for i, _, _, truth in rows[:120]:
        assert main[i][0] == truth and main[i][1] > 0.5
    found = {tuple(r) for r in lg.unnamed_languages(segments).collect()}
    assert (900, "fr") in found and not {x for x in found if x[0] in (901, 902, 903, 904)}
    assert {x for x in found if x[0] < 120} == {(i, truth) for i, _, label, truth in rows[:120] if lg.label_language(label) != truth}
    inner = sorted((r.start_char, r.end_char, r.lang) for r in segments.where("key = 900").collect())
    assert [x[2] for x in inner] == ["en", "fr", "en"]
    assert all(a[1] < b[0] for a, b in zip(inner, inner[1:]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, page_body string, lang string")
    assert lg.segment_languages(df, "page_id", "page_body", "lang").count() == 0
