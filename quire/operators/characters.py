"""Characters of a book: mentions of persons, their names, genders and counts.

Mentions are (book_id, start_tok, end_tok, phrase), token numbers within the book, ends
included. Tokens are (book_id, tok_num, word).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.windows import islands
from quire.runtime import durable

# Honorifics and pronouns by what they show.
MALE_HONORIFICS = ("mr.", "mr", "mister.", "mister", "lord", "master", "sir", "sire")
FEMALE_HONORIFICS = ("miss.", "miss", "ms.", "ms", "mrs.", "mrs", "madam", "madame", "lady", "dame")
NEUTRAL_HONORIFICS = ("dr.", "dr", "doctor", "prof.", "prof", "professor")
HONORIFICS = MALE_HONORIFICS + FEMALE_HONORIFICS + NEUTRAL_HONORIFICS
MALE_PRONOUNS = ("he", "him", "his", "himself")
FEMALE_PRONOUNS = ("she", "her", "hers", "herself")
FIRST_PERSON = ("i", "me", "my", "mine", "myself")
SECOND_PERSON = ("you", "your", "yours", "yourself")
#: Mentions of a spelling that make it a name, and lead of one gender over the other.
FREQUENT, LEAD = 2, 1.1


def distinct_tokens(tokens: DataFrame) -> DataFrame:
    """(book_id, tok_num, word) of the token table; of a number given twice the first word by alphabet."""
    return tokens.where("tok_num_in_doc is not null").groupBy("book_id", F.col("tok_num_in_doc").alias("tok_num")).agg(F.min("word").alias("word"))


def person_mentions(entities: DataFrame) -> DataFrame:
    """Distinct spans that are tagged as persons."""
    persons = entities.where("ner = 'PERSON' and start_tok_num is not null")
    return persons.groupBy("book_id", F.col("start_tok_num").alias("start_tok"), F.col("end_tok_num").alias("end_tok")).agg(F.min("phrase").alias("phrase"))


def covered_tokens(spans: DataFrame) -> DataFrame:
    """(book_id, tok_num) of all tokens inside spans."""
    return spans.where("end_tok >= start_tok").select("book_id", F.explode(F.sequence("start_tok", "end_tok")).alias("tok_num")).distinct()


def absorb_honorifics(mentions: DataFrame, tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Extend a mention by the honorific right before it, unless that belongs to a span."""
    titles = tokens.where(F.lower("word").isin(*HONORIFICS)).join(covered_tokens(spans), ["book_id", "tok_num"], "left_anti")
    before = titles.select("book_id", (F.col("tok_num") + 1).alias("start_tok"), F.col("word").alias("title"))
    found = mentions.join(before, ["book_id", "start_tok"], "left")
    return found.select(
        "book_id",
        F.when(F.col("title").isNotNull(), F.col("start_tok") - 1).otherwise(F.col("start_tok")).alias("start_tok"),
        "end_tok",
        F.concat_ws(" ", "title", "phrase").alias("phrase"),
    )


def frequent_mentions(mentions: DataFrame, least: int = FREQUENT) -> DataFrame:
    """(book_id, phrase, n): spellings that occur ``least`` times or more in a book."""
    return mentions.where("phrase is not null").groupBy("book_id", "phrase").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def phrase_search(tokens: DataFrame, phrases: DataFrame) -> DataFrame:
    """Spans at which a phrase of the book stands word by word.

    A phrase meets the tokens by its rarest word in the book, and only where that stands
    are its other words looked for, by their places; so frequent words like "the" or "of"
    find no more than the phrases they are in. The last place of a book counts too.
    """
    wanted = phrases.select("book_id", "phrase", F.split("phrase", r"\s+").alias("words")).where("phrase <> ''").distinct()
    parts = wanted.select("book_id", "phrase", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    often = tokens.join(parts.select("book_id", "word").distinct(), ["book_id", "word"], "left_semi").groupBy("book_id", "word").agg(F.count(F.lit(1)).alias("c"))
    counted = parts.join(often, ["book_id", "word"])  # a word that the book lacks drops out, and with it the phrase
    rarest = counted.groupBy("book_id", "phrase", "n").agg(F.min(F.struct("c", "i", "word")).alias("r"), F.count(F.lit(1)).alias("k")).where("k = n")
    anchors = tokens.join(rarest.select("book_id", "phrase", "n", F.col("r.i").alias("at"), F.col("r.word").alias("word")), ["book_id", "word"])
    begun = anchors.select("book_id", "phrase", "n", (F.col("tok_num") - F.col("at")).alias("start_tok"))
    rest = begun.where("n > 1").join(parts.select("book_id", "phrase", "i", "word"), ["book_id", "phrase"]).withColumn("tok_num", F.col("start_tok") + F.col("i"))
    along = rest.join(tokens, ["book_id", "tok_num", "word"]).groupBy("book_id", "phrase", "n", "start_tok").agg(F.countDistinct("i").alias("k")).where("k = n")
    whole = begun.where("n = 1").unionByName(along.drop("k"))
    return whole.select("book_id", "start_tok", (F.col("start_tok") + F.col("n") - 1).cast("int").alias("end_tok"), "phrase").distinct()


def complete_entities(entities: DataFrame, tokens: DataFrame) -> DataFrame:
    """Spans (book_id, start_tok, end_tok, phrase, ner): all entities; those that equal a
    frequent person's spelling become persons, and its untagged occurrences are added.
    Occurrences that touch a span in part are left alone; of new ones that overlap the
    longer goes first, then the earlier. Of a span with several tags the first by alphabet counts."""
    from quire.operators.annotation import resolve_overlaps

    spans = entities.where("start_tok_num is not null and end_tok_num >= start_tok_num").groupBy(
        "book_id", F.col("start_tok_num").alias("start_tok"), F.col("end_tok_num").alias("end_tok")
    ).agg(F.min("phrase").alias("phrase"), F.min("ner").alias("ner"))
    persons = spans.where("ner = 'PERSON'")
    found = phrase_search(tokens, frequent_mentions(persons))
    cover = covered_tokens(spans).withColumn("_in", F.lit(1))
    inside = (
        found.withColumn("tok_num", F.explode(F.sequence("start_tok", "end_tok")))
        .join(cover, ["book_id", "tok_num"], "left")
        .groupBy("book_id", "start_tok", "end_tok", "phrase")
        .agg(F.sum(F.coalesce("_in", F.lit(0))).alias("k"), F.count(F.lit(1)).alias("n"))
    )
    fresh = resolve_overlaps(inside.where("k = 0").select("book_id", "start_tok", "end_tok", "phrase"), ["book_id"], "start_tok", "end_tok")
    known = inside.where("k = n").select("book_id", "start_tok", "end_tok", F.lit(1).alias("_person")).distinct()
    retyped = spans.join(known, ["book_id", "start_tok", "end_tok"], "left").select(
        "book_id", "start_tok", "end_tok", "phrase", F.when(F.col("_person") == 1, "PERSON").otherwise(F.col("ner")).alias("ner")
    )
    return retyped.unionByName(fresh.withColumn("ner", F.lit("PERSON")))


def consecutive_phrases(tokens: DataFrame) -> DataFrame:
    """Runs of consecutive token numbers as (book_id, start_tok, end_tok, phrase)."""
    w = Window.partitionBy("book_id").orderBy("tok_num")
    runs = islands(tokens, ["book_id"], ["tok_num"], F.col("tok_num") != F.lag("tok_num").over(w) + 1, "_run")
    per = runs.groupBy("book_id", "_run").agg(F.min("tok_num").alias("start_tok"), F.max("tok_num").alias("end_tok"), F.array_sort(F.collect_list(F.struct("tok_num", "word"))).alias("l"))
    return per.select("book_id", "start_tok", "end_tok", F.array_join("l.word", " ").alias("phrase"))


# names ---------------------------------------------------------------------------


def _initial(part: Column) -> Column:
    return part.rlike(r"^.\.?$")


def parse_names(df: DataFrame, name: str = "name") -> DataFrame:
    """Add honorific, generic_name, first/middle/last name or initial of a name: one word is
    generic, two are first and last, three first, middle and last, more are generic as a whole."""
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    has = F.lower(F.try_element_at("_w", F.lit(1))).isin(*HONORIFICS) & (F.size("_w") > 1)
    rest = F.when(has, F.slice("_w", 2, 100)).otherwise(F.col("_w"))
    split = df.withColumn("_w", words).withColumn("honorific", F.when(has, F.try_element_at("_w", F.lit(1)))).withColumn("_r", rest)
    n = F.size("_r")
    part = lambda i: F.try_element_at("_r", F.lit(i))
    full = n.isin(2, 3)
    last = F.when(n == 2, part(2)).when(n == 3, part(3))
    return split.withColumns(
        {
            "generic_name": F.when(n == 1, part(1)).when(n > 3, F.array_join("_r", " ")),
            "first_name": F.when(full & ~_initial(part(1)), part(1)),
            "first_initial": F.when(full & _initial(part(1)), F.substring(part(1), 1, 1)),
            "middle_name": F.when((n == 3) & ~_initial(part(2)), part(2)),
            "middle_initial": F.when((n == 3) & _initial(part(2)), F.substring(part(2), 1, 1)),
            "last_name": F.when(full & ~_initial(last), last),
            "last_initial": F.when(full & _initial(last), F.substring(last, 1, 1)),
        }
    ).drop("_w", "_r")


def honorific_gender(honorific: Column) -> Column:
    low = F.lower(honorific)
    return F.when(low.isin(*MALE_HONORIFICS), "male").when(low.isin(*FEMALE_HONORIFICS), "female")


def counted_gender(male: Column, female: Column) -> Column:
    """Gender of whichever pronouns lead by a tenth; null if none does."""
    return F.when(male > LEAD * female, "male").when(female > LEAD * male, "female")


def name_gender(df: DataFrame, genders: DataFrame) -> DataFrame:
    """Add ``gender_name`` from a table (name, gender) by first name, else by generic name."""
    known = genders.groupBy(F.lower("name").alias("_name")).agg(F.min("gender").alias("gender_name"), F.countDistinct("gender").alias("_n")).where("_n = 1").drop("_n")
    keyed = df.withColumn("_name", F.lower(F.coalesce("first_name", "generic_name")))
    return keyed.join(known, "_name", "left").drop("_name")


def _kind(low: Column) -> Column:
    return F.when(low.isin(*MALE_PRONOUNS), "male").when(low.isin(*FEMALE_PRONOUNS), "female").when(low.isin(*FIRST_PERSON), "first").when(low.isin(*SECOND_PERSON), "second")


def pronoun_references(tokens: DataFrame, mentions: DataFrame) -> DataFrame:
    """Pronouns and the nearest mention that begins before them: (book_id, tok_num, kind, phrase).
    Kinds: male, female, first, second. An as-of join by one sort of both."""
    said = tokens.select("book_id", "tok_num", _kind(F.lower("word")).alias("kind"), F.lit(None).cast("string").alias("phrase")).where("kind is not null")
    named = mentions.select("book_id", F.col("start_tok").alias("tok_num"), F.lit(None).cast("string").alias("kind"), "phrase")
    w = Window.partitionBy("book_id").orderBy("tok_num", F.col("kind").isNotNull(), "phrase")
    both = said.unionByName(named).withColumn("who", F.last("phrase", ignorenulls=True).over(w))
    return both.where("kind is not null and who is not null").select("book_id", "tok_num", "kind", F.col("who").alias("phrase"))


def reference_counts(references: DataFrame) -> DataFrame:
    """Per book and spelling: male, female, first and second person references."""
    count = lambda k: F.sum((F.col("kind") == k).cast("long")).alias(k)
    return references.groupBy("book_id", "phrase").agg(*[count(k) for k in ("male", "female", "first", "second")])


def nearest_honorific(named: DataFrame) -> DataFrame:
    """Give mentions (book_id, tok_num, name, honorific, gender) without honorific that of the
    nearest earlier, else nearest later, mention of the same name and an agreeing gender."""
    keys = ["book_id", "name", "_g"]
    w = Window.partitionBy(*keys).orderBy("tok_num")
    marked = named.withColumn("_g", F.coalesce("gender", F.lit("")))
    before = F.last("honorific", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("honorific", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return marked.withColumn("honorific", F.coalesce("honorific", before, after)).drop("_g")


#: Where a mention's gender comes from, strongest first.
SOURCES = ("gender_honorific", "gender_coref", "gender_name")


def _with_sources(named: DataFrame) -> DataFrame:
    """All three genders and the honorific; a plain ``gender`` counts as the honorific's."""
    known = F.col("gender") if "gender" in named.columns and "gender_honorific" not in named.columns else None
    given = {"gender_honorific": known} if known is not None else {}
    missing = [c for c in (*SOURCES, "honorific") if c not in named.columns and c not in given]
    return named.withColumns(given | {c: F.lit(None).cast("string") for c in missing})


def name_references(named: DataFrame, least: int = 2) -> DataFrame:
    """(book_id, key, tok_num, first_name, last_name, three genders, apart): mentions by first and
    last name that occur ``least`` times, under either of their names. ``apart`` are those
    whose honorific and given name show different genders ("Mrs John Wilson")."""
    full = _with_sources(named).where("first_name is not null and last_name is not null")
    often = full.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("book_id", "first_name", "last_name"))).where(F.col("_n") >= least)
    apart = F.coalesce(F.col("gender_honorific") != F.col("gender_name"), F.lit(False))
    return often.select("book_id", F.explode(F.array("first_name", "last_name")).alias("key"), "tok_num", "first_name", "last_name", *SOURCES, apart.alias("apart")).distinct()


def _fits(gender: str) -> dict[str, Column]:
    """Conditions under which a mention ``ref`` shows a gender, by the source that shows it:
    with no stronger source against it, whatever the others say, or with none against it."""
    h, c, n = (F.col(f"ref.{x}") for x in SOURCES)
    free = lambda x: x.isNull() | (x == gender)
    return {
        "honorific": h == gender,
        "coref": (c == gender) & free(h),
        "name": (n == gender) & free(h) & free(c),
        "any_coref": c == gender,
        "any_name": n == gender,
        "free": free(h) & free(c) & free(n),
    }


def resolve_generic(named: DataFrame, least: int = 2) -> DataFrame:
    """Full names for mentions of one name (book_id, tok_num, generic_name, genders): the
    nearest earlier, else later, mention under that name that agrees best.

    The gender of the honorific is asked for first, then that of the pronouns, then that
    of the name; each is looked for among the honorifics of the others, then their
    pronouns, then their names, where nothing stronger speaks against it. Then whoever
    shows the mention's strongest gender at all, then whoever has none against it, and
    for a mention without gender the nearest. "Mrs Wilson" without any goes to a "Mrs
    John Wilson", later ones first. A known gender of the full name replaces the
    mention's own, source by source. Unresolved ones keep nulls; ``hit_tok`` is the mention found.

    One sort per book and name; each tier is a running last or first value.
    """
    named = _with_sources(named)
    whole = F.struct("tok_num", "first_name", "last_name", *SOURCES, "apart")
    refs = name_references(named, least).select("book_id", "key", "tok_num", whole.alias("ref"), *[F.lit(None).cast("string").alias(c) for c in (*SOURCES, "honorific")], F.lit(0).alias("ask"))
    asks = named.where("generic_name is not null").select(
        "book_id", F.col("generic_name").alias("key"), "tok_num", F.lit(None).cast(refs.schema["ref"].dataType).alias("ref"), *SOURCES, "honorific", F.lit(1).alias("ask")
    )
    w = Window.partitionBy("book_id", "key").orderBy("tok_num", "ask")
    back, ahead = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    usual = F.col("ref").isNotNull() & ~F.col("ref.apart")
    wanted = {f"{g}_{k}": usual & c for g in ("male", "female") for k, c in _fits(g).items()} | {"one": usual, "apart": F.col("ref").isNotNull() & F.col("ref.apart")}
    columns = {}
    for name, holds in wanted.items():
        own = F.when(holds, F.col("ref"))
        columns[f"p_{name}"], columns[f"n_{name}"] = F.last(own, ignorenulls=True).over(back), F.first(own, ignorenulls=True).over(ahead)
    both = refs.unionByName(asks).withColumns(columns).where("ask = 1")

    def tiers(gender: Column, kinds: tuple[str, ...]) -> Column:
        return F.coalesce(*[F.when(gender == g, F.coalesce(*[F.col(f"{d}_{g}_{k}") for k in kinds for d in "pn"])) for g in ("male", "female")])

    strongest = F.coalesce(*SOURCES)
    pick = F.coalesce(
        *[tiers(F.col(c), ("honorific", "coref", "name")) for c in SOURCES],
        tiers(strongest, ("honorific", "any_coref", "any_name", "free")),
        F.when(strongest.isNull(), F.coalesce("p_one", "n_one")),
        F.when(F.lower("honorific").isin("mrs", "mrs."), F.coalesce("n_apart", "p_apart")),
    )
    found = both.withColumn("hit", pick)
    merged = [F.coalesce(F.col(f"hit.{c}"), F.col(c)).alias(c) for c in SOURCES]
    out = found.select("book_id", "tok_num", F.col("key").alias("generic_name"), *merged, *[F.col(c).alias(f"_{c}") for c in SOURCES], F.col("hit.first_name").alias("first_name"), F.col("hit.last_name").alias("last_name"), F.col("hit.tok_num").alias("hit_tok"))
    return out.withColumn("gender", F.coalesce(*SOURCES)).drop(*[f"_{c}" for c in SOURCES])


def pass_genders_back(named: DataFrame, resolved: DataFrame) -> DataFrame:
    """Give the full mentions that were found the genders they lack, source by source, from
    the earliest mention of one name that was resolved to them and has one."""
    own = named.where("generic_name is not null").select("book_id", F.col("tok_num").alias("_t"), *SOURCES)
    back = resolved.where("hit_tok is not null").select("book_id", F.col("tok_num").alias("_t"), F.col("hit_tok").alias("tok_num")).join(own, ["book_id", "_t"])
    first = back.groupBy("book_id", "tok_num").agg(*[F.min(F.when(F.col(c).isNotNull(), F.struct("_t", c)))[c].alias(f"_{c}") for c in SOURCES])
    given = F.col("generic_name").isNull()
    joined = named.join(first, ["book_id", "tok_num"], "left")
    return joined.withColumns({c: F.when(given, F.coalesce(F.col(c), F.col(f"_{c}"))).otherwise(F.col(c)) for c in SOURCES}).drop(*[f"_{c}" for c in SOURCES])


def chain_references(coref: DataFrame, people: DataFrame, tokens: DataFrame) -> DataFrame:
    """References by coreference: (book_id, tok_num, kind, start_tok, phrase), the pronoun and
    the mention it speaks of.

    ``coref`` are tokens with the span they refer to (book_id, tok_num, coref_start,
    coref_end), as of ``annotation.antecedents``; the first person in that span is meant.
    Tokens in a row that refer to one mention are one phrase; only a phrase that is a
    pronoun counts. From a phrase that holds a person on, the mention's references go to that person.
    """
    inside = people.where("end_tok >= start_tok").select("book_id", "start_tok", "phrase", F.explode(F.sequence("start_tok", "end_tok")).alias("at"))
    inside = inside.groupBy("book_id", "at").agg(F.max_by(F.struct("start_tok", "phrase"), F.struct("start_tok", "phrase")).alias("who"))
    meant = coref.withColumn("at", F.explode(F.sequence("coref_start", "coref_end"))).join(inside, ["book_id", "at"])
    meant = meant.groupBy("book_id", "tok_num").agg(F.min_by("who", "at").alias("who"))
    w = Window.partitionBy("book_id", "who").orderBy("tok_num")
    runs = islands(meant, ["book_id", "who"], ["tok_num"], F.col("tok_num") != F.lag("tok_num").over(w) + 1, "_run")
    own = inside.select("book_id", F.col("at").alias("tok_num"), F.col("who").alias("_own"))
    words = runs.join(tokens.select("book_id", "tok_num", "word"), ["book_id", "tok_num"]).join(own, ["book_id", "tok_num"], "left")
    phrases = words.groupBy("book_id", "who", "_run").agg(
        F.max("tok_num").alias("tok_num"),
        F.min(F.when(F.col("_own").isNotNull(), F.struct("tok_num", "_own")))["_own"].alias("_own"),
        F.lower(F.max_by("word", "tok_num")).alias("said"),
        F.count(F.lit(1)).alias("_n"),
    )
    order = Window.partitionBy("book_id", "who").orderBy("_run").rowsBetween(Window.unboundedPreceding, 0)
    aimed = phrases.withColumn("target", F.coalesce(F.last("_own", ignorenulls=True).over(order), F.col("who"))).where("_n = 1")
    return aimed.withColumn("kind", _kind(F.col("said"))).where("kind is not null").select("book_id", "tok_num", "kind", "target.start_tok", "target.phrase")


# roll-up -------------------------------------------------------------------------

_WHO = ["book_id", "last_name", "first_name", "generic_name"]


def _join_names(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on book and name, where a missing part equals a missing part."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in _WHO], *[c for c in right.columns if c not in _WHO])
    same = F.lit(True)
    for c in _WHO:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(renamed, same, how).drop(*[f"_{c}" for c in _WHO])


def fill_genders(rolled: DataFrame) -> DataFrame:
    """Give rows (…, gender, count) of unknown gender that of the most frequent row of the
    same name with one (of equal ones the first by alphabet), and add equal rows up."""
    known = rolled.where("gender is not null").groupBy(*_WHO).agg(F.max(F.struct("count", F.when(F.col("gender") == "female", 1).otherwise(0).alias("o"), "gender")).alias("_m"))
    joined = _join_names(rolled, known, "left").withColumn("_usual", F.col("_m.gender")).drop("_m")
    counts = [c for c in rolled.columns if c not in (*_WHO, "gender")]
    filled = joined.withColumn("gender", F.coalesce("gender", "_usual"))
    return filled.groupBy(*_WHO, "gender").agg(*[F.sum(c).alias(c) for c in counts])


def roll_up(mentions: DataFrame) -> DataFrame:
    """Counts per (book_id, last_name, first_name, generic_name, gender); with a first or last
    name known the generic one is dropped."""
    clear = F.when(F.col("first_name").isNull() & F.col("last_name").isNull(), F.col("generic_name"))
    return (
        mentions.withColumn("generic_name", clear)
        .groupBy(*_WHO, "gender")
        .agg(F.count(F.lit(1)).alias("count"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("gendered", "first", "second") if c in mentions.columns])
    )


def rank_characters(rolled: DataFrame, least: int = 2) -> DataFrame:
    """Rows with ``least`` mentions, numbered from 0 within the book: most frequent first, then
    by name from behind, then ascending."""
    w = Window.partitionBy("book_id").orderBy(F.col("count").desc(), F.col("last_name").desc_nulls_last(), F.col("first_name").desc_nulls_last(), F.col("generic_name").asc_nulls_last(), F.col("gender").asc_nulls_last())
    return rolled.where(F.col("count") >= least).withColumn("id", F.row_number().over(w) - 1)


def named_mentions(mentions: DataFrame, tokens: DataFrame, genders: DataFrame | None = None, coref: DataFrame | None = None) -> DataFrame:
    """Mentions with the parts of their names, honorifics passed on, references counted and
    three genders: of the honorific, of the pronouns, of the name. Pronouns are counted by
    coreference where it is given, else for the nearest mention before them."""
    usual = mentions.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("book_id", F.lower("phrase")))).where(F.col("_n") >= FREQUENT)
    parsed = parse_names(usual.withColumnRenamed("start_tok", "tok_num"), "phrase")
    references = pronoun_references(tokens, mentions) if coref is None else chain_references(coref, mentions, tokens)
    joined = parsed.join(reference_counts(references), ["book_id", "phrase"], "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("male", "female", "first", "second")})
    joined = joined.withColumn("gender_name", F.lit(None).cast("string")) if genders is None else name_gender(joined, genders)
    joined = joined.withColumn("gender_coref", counted_gender(F.col("male"), F.col("female")))
    # an honorific goes to other mentions of the name, of an agreeing gender
    joined = joined.withColumn("gender", F.coalesce(honorific_gender(F.col("honorific")), "gender_coref", "gender_name"))
    joined = nearest_honorific(joined.withColumn("name", F.coalesce("generic_name", F.concat_ws(" ", "first_name", "last_name"))))
    joined = joined.withColumn("gender_honorific", honorific_gender(F.col("honorific")))
    return joined.select("book_id", "tok_num", "end_tok", "phrase", "honorific", "generic_name", "first_name", "last_name", *SOURCES)


def characters(entities: DataFrame, tokens: DataFrame, genders: DataFrame | None = None, coref: DataFrame | None = None) -> DataFrame:
    """Character table of every book from its entities and tokens (the token table as given):
    id, names, gender, count, references by kind, and ``names`` with the counts of each spelling.
    ``genders`` (name, gender) are known given names, ``coref`` as in ``chain_references``."""
    words = distinct_tokens(tokens)
    # each of the cut points is read by several branches below
    spans = durable(complete_entities(entities, words))
    people = absorb_honorifics(spans.where("ner = 'PERSON'").drop("ner"), words, spans)
    people = durable(people)
    named = durable(named_mentions(people, words, genders, coref))
    resolved = durable(resolve_generic(named))
    named = pass_genders_back(named, resolved)
    full = resolved.select("book_id", "tok_num", "generic_name", F.col("first_name").alias("_f"), F.col("last_name").alias("_l"), F.col("gender").alias("_g"))
    joined = named.join(full, ["book_id", "tok_num", "generic_name"], "left").withColumns(
        {"first_name": F.coalesce("first_name", "_f"), "last_name": F.coalesce("last_name", "_l"), "gender": F.coalesce("_g", *SOURCES)}
    ).drop("_f", "_l", "_g", *SOURCES)
    placed = people.select("book_id", "start_tok", "end_tok", F.concat(F.lpad(F.col("start_tok").cast("string"), 12, "0"), F.lit("\x01"), "phrase").alias("phrase"))
    refs = pronoun_references(words, placed) if coref is None else chain_references(coref, placed, words)
    at = refs.select("book_id", F.split("phrase", "\x01")[0].cast("int").alias("tok_num"), "kind").groupBy("book_id", "tok_num").agg(
        F.sum(F.col("kind").isin("male", "female").cast("int")).alias("gendered"), F.sum((F.col("kind") == "first").cast("int")).alias("first"), F.sum((F.col("kind") == "second").cast("int")).alias("second")
    )
    mentions = durable(joined.join(at, ["book_id", "tok_num"], "left"))
    ranked = rank_characters(fill_genders(roll_up(mentions)))
    own = mentions.withColumn("generic_name", F.when(F.col("first_name").isNull() & F.col("last_name").isNull(), F.col("generic_name")))
    zero = lambda c, a: F.sum(F.coalesce(c, F.lit(0))).alias(a)
    spelt = own.groupBy(*_WHO, "phrase").agg(
        F.count(F.lit(1)).alias("n"), zero("gendered", "gendered_coref_count"), zero("first", "first_person_coref_count"), zero("second", "second_person_coref_count")
    )
    nested = spelt.groupBy(*_WHO).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "phrase", F.struct("gendered_coref_count", "first_person_coref_count", "second_person_coref_count").alias("counts")))).alias("l")
    )
    names = nested.select(*_WHO, F.map_from_arrays("l.phrase", "l.counts").alias("names"))
    return _join_names(ranked, names, "left").select(
        "book_id", "id", "first_name", "last_name", "generic_name", "gender", "count",
        F.col("gendered").alias("gendered_coref_count"), F.col("first").alias("first_person_coref_count"), F.col("second").alias("second_person_coref_count"), "names",
    )


def annotate_tokens(tokens: DataFrame, people: DataFrame) -> DataFrame:
    """Give tokens the character of the mention (book_id, start_tok, end_tok, character) they lie
    in; of several the one that begins last, then the last by alphabet."""
    inside = people.where("end_tok >= start_tok").select("book_id", "start_tok", "character", F.explode(F.sequence("start_tok", "end_tok")).alias("tok_num"))
    one = inside.groupBy("book_id", "tok_num").agg(F.max_by("character", F.struct("start_tok", "character")).alias("character"))
    return tokens.join(one, ["book_id", "tok_num"], "left")
