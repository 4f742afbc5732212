import random

from quire.llm import sentences as st

STARTS = ["The old harbour slept", "A widow crossed the square", "Her brother counted the lanterns", "In the autumn the keeper wept"]
ENDS = ["beyond the mill", "near the inn with the keeper", "in the old square", "and a widow smiled at her brother"]


def corpus():
    """Paragraphs with their true sentence ends."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        text, ends = "", []
        for _ in range(rng.randint(1, 5)):
            a, b = rng.choice(STARTS), rng.choice(ENDS)
            shape = rng.randrange(6)
            s = {
                0: f"{a} {b}.",
                1: f"{a} {b} with Mr. {rng.choice(['Tull', 'Harker', 'Quill'])} at 7 a.m.",
                2: f"“Why did {a.lower()} {b}?” asked Dr. {rng.choice(['Moss', 'Reed'])}.",
                3: f"At 9.30 a.m. {rng.choice(['Anna', 'Moss'])} walked {b}!",
                4: f"“{a}.",
                5: f"{a}… and then it rained {b}.",
            }[shape]
            text += (" " if text else "") + s
            ends.append(len(text))
            if shape == 4:
                text += f" {rng.choice(STARTS)} {b}.”"
                ends.append(len(text))
        rows.append((i, text, ends))
    return rows


def test_english_held_out_accuracy(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "key long, text string, lang string")
    got = {}
    for r in st.split_sentences(df).collect():
        got.setdefault(r.key, set()).add(r.end_char)
    truth = {(i, e) for i, _, ends in rows for e in ends}
    found = {(i, e) for i, ends in got.items() for e in ends}
    assert len(truth & found) / len(truth) > 0.98 and len(truth & found) / len(found) > 0.98


def test_offsets_rebuild_the_text(spark):
    rows = [(1, "  One thing. Two things!\nThree ", "en"), (2, "", "en"), (3, None, None), (4, " \n", None), (1, "  One thing. Two things!\nThree ", "en"), (5, "x" * 50_000, None)]
    df = spark.createDataFrame(rows, "key long, text string, lang string").selectExpr("*", "1 as i", "2 as ends")
    out = sorted(map(tuple, st.split_sentences(df).select("key", "sent_no", "start_char", "end_char", "text").collect()))
    texts = {1: rows[0][1], 5: rows[5][1]}
    assert [x[:2] for x in out] == [(1, 1), (1, 2), (1, 3), (5, 1)]
    for key, _, start, end, text in out:
        assert texts[key][start - 1 : end] == text == text.strip()
    assert st.split_sentences(df.limit(0)).count() == 0


def test_scripts_without_capitals_or_stops():
    ends = lambda t: [e for e, rule, *_ in st.candidates(t) if rule in ("sure", "final")]
    ja = "「雨が降った？」と庭師が尋ねた。翌朝、晴れた。"
    assert ends(ja) == [16, len(ja)]
    zh = "“他来了？”老人说。天亮了！「走吧。回家。」"
    assert [zh[: e][-1] for e in ends(zh)] == ["。", "！", "。", "」"]
    hi = "उसने पूछा। “वह आया।” माली ने कहा। वह गया!"
    assert len(ends(hi)) == 3
    assert ends("«Что?» — спросил он. Дом.") == [25]
    assert ends("« Où ? » demanda-t-il. « Ici ! » Paul rit.") == [32, 42]


def test_thai_spaces(spark):
    agents = ["ชาวนา", "ครูเฒ่า", "หญิงม่าย"]
    rows = [(i, f"{agents[i % 3]}ซื้อบ้าน 15 หลัง ในคืนนั้น {agents[(i + 1) % 3]}ขายม้า", "th") for i in range(60)]
    df = spark.createDataFrame(rows, "key long, text string, lang string")
    out = st.split_sentences(df).where("key = 0").orderBy("sent_no").collect()
    assert [r.text for r in out] == ["ชาวนาซื้อบ้าน 15 หลัง ในคืนนั้น", "ครูเฒ่าขายม้า"]


def test_starters_are_learnt_from_what_follows_sentence_ends(spark):
    # "Abend" is never written small, "schloss" is seen small once and opens no sentence
    text = "Das Haus im Land war sehr alt. Abend kam über das Land. Die Leute gingen heim nach Wald. Abend war es, als alt und jung heim zum Wald ging."
    rows = [(i, text, "de") for i in range(60)] + [(100, "Da war ein Graf im schloss.", "de")]
    counts = st.learn_counts(spark.createDataFrame(rows, "key long, text string, lang string"))
    got = {r.next: r.starter for r in st.starters(st.statistics(counts)).collect()}
    assert got["abend"] and got["die"]
    assert not got.get("schloss") and not got.get("wald")


def test_short_sentences_end_at_numbers_and_common_letters(spark):
    text = "It was 1842. He left. So do I. He left and I saw that he was gone. Then he and I met them in the old town."
    df = spark.createDataFrame([(i, text, "en") for i in range(40)], "key long, text string, lang string")
    got = [r.text for r in st.split_sentences(df).where("key = 0").orderBy("sent_no").collect()]
    assert got[:3] == ["It was 1842.", "He left.", "So do I."]


def test_join_gives_the_same_as_sending_what_is_learnt(spark):
    thai = [(1000 + i, f"ชาวนาซื้อบ้าน 15 หลัง ในคืนนั้น {'ครูเฒ่า' if i % 2 else 'ชาวนา'}ขายม้า", "th") for i in range(30)]
    rows = [(i, t, "en") for i, t, _ in corpus()] + thai + [(2000, "It was 1842. He left. So do I. No. 7 is here.", None)]
    df = spark.createDataFrame(rows, "key long, text string, lang string")
    assert sorted(map(tuple, st.split_sentences(df).collect())) == sorted(map(tuple, st.split_sentences(df, max_learnt=0).collect()))


def test_rows_of_one_key_that_differ_give_the_least_text_every_time(spark):
    df = spark.createDataFrame([(1, "Beta came. He left.", "en"), (1, "Alpha came.", "en"), (2, "x", None)], "key long, text string, lang string")
    for parts in (1, 3):
        assert [r.text for r in st.split_sentences(df.repartition(parts)).orderBy("key").collect()] == ["Alpha came.", "x"]


def test_long_words_and_clauses_are_read_whole():
    word = "a" * 5000
    stop = [x for x in st.candidates(f"The {word}. Next one.") if x[1] == "stop"]
    assert stop[0][2] == word
    thai = "”" + "ช" * 300 + "กล่าว ครูขายม้า"
    assert st._reports(thai, 1)
