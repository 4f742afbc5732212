"""Variant spellings of names: a trie join on name words, then word-order permutations.

The words of all names of a book go into tries, sharded so that no task holds an
unbounded book. Every word walks through the tries with a Levenshtein automaton
(insertions, deletions, substitutions, swaps of neighbours), which gives its
neighbours within a bounded distance. Names are linked where surname and given
name are both neighbours, in either order; nicknames stand for their full names.
Initials, bare titles and single names are attached last, and only where one person fits.

A book of up to ``BOOK`` records is linked within one task; the words and names of a
larger one are joined over all tasks, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import names as nm
from quire.operators.graph import connected_components
from quire.runtime import balanced, durable

#: Records of a book that one task links, and words of one trie shard of a larger book.
BOOK, CELL = 5000, 4000
#: Distance of surname and given name together.
MAX_TOTAL = 2


def bound(n: int) -> int:
    """Admissible distance of a word of n letters: of one or two letters every other is another name."""
    return 0 if n < 3 else 1 if n < 9 else 2


class Trie:
    """Prefix tree walked by a Levenshtein automaton with transpositions."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word

    def within(self, word: str, most: int) -> list[tuple[str, int]]:
        """Words at optimal-string-alignment distance of at most ``most``.

        The state of the automaton is the row of distances to all prefixes of
        ``word``; a branch dies when no entry is within the bound.
        """
        n = len(word)
        out = []
        stack = [(self.root, "", list(range(n + 1)), None)]
        while stack:
            node, last, row, above = stack.pop()
            for c, child in node.items():
                if c == "":
                    if row[n] <= most:
                        out.append((child, row[n]))
                    continue
                new = [row[0] + 1]
                for i in range(1, n + 1):
                    d = min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (word[i - 1] != c))
                    if above is not None and i > 1 and word[i - 1] == last and word[i - 2] == c:
                        d = min(d, above[i - 2] + 1)
                    new.append(d)
                if min(new) <= most or min(row) < most:
                    stack.append((child, c, new, row))
        return out


_READ = (
    "uid long, book string, kind string, s string, g string, mid string, title string, gender string, swapped boolean, nick boolean"
)


_COLUMNS = ("char_uid", "book_id", "first_name", "last_name", "generic_name", "gender", "more")


def readings(uid: int, book: str, first: str | None, last: str | None, generic: str | None, gender: str | None, more, nicknames: dict) -> list[tuple]:
    """All readings of one record, as in ``_READ``."""
    own = gender if isinstance(gender, str) else ""
    typed = " ".join(x for x in (first, last) if isinstance(x, str) and x.strip())
    seen = [*nm.read_name(typed), *nm.read_name(generic if isinstance(generic, str) else None)]
    for name in more if more is not None else ():
        # what only the list of names says must be as full as the record's own name
        seen += [f for f in nm.read_name(name) if f.kind in ("full", "org", "title")]
    if any(f.kind in ("full", "org") for f in seen):
        seen = [f for f in seen if f.kind in ("full", "org")]
    if any(f.kind != "single" for f in seen):
        seen = [f for f in seen if f.kind != "single"]
    rows = []
    for f in dict.fromkeys(seen):
        sex = own or f.gender
        for g in nm.full_givens(f.given, nicknames) if f.kind == "full" else (f.given,):
            rows.append((uid, book, f.kind, f.surname, g, f.middle, f.title, sex, False, g != f.given))
        if f.kind == "full":
            for g in nm.full_givens(f.surname, nicknames):
                rows.append((uid, book, f.kind, f.given, g, f.middle, f.title, sex, True, g != f.surname))
    return rows


def read_records(characters: DataFrame, nicknames: dict[str, tuple[str, ...]] = nm.NICKNAMES) -> DataFrame:
    """One row per reading of every record: its fields, its generic name and all its ``names``.

    Fields in the wrong order give both orders; a nickname gives a row per full
    name. A single word counts where the record has no fuller name. Records without any
    readable name give none and are never linked.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([r for x in pdf.itertuples(index=False) for r in readings(*x, nicknames)], columns=[c.split()[0] for c in _READ.split(", ")])

    return characters.select(*_COLUMNS).mapInPandas(read, _READ).distinct()


def neighbours(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(book, t1, t2, d): all ordered pairs of words of a book within the bound, themselves included."""
    words = words.select("book", "word").where("word <> ''").distinct()
    sizes = words.groupBy("book").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("cells"))
    placed = words.join(sizes, "book").withColumn("p", F.pmod(F.xxhash64("word"), F.col("cells")).cast("int"))
    asks = placed.select("book", F.col("p").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("j"), "word", F.lit(True).alias("ask"))
    holds = placed.select("book", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("i"), F.col("p").alias("j"), "word", F.lit(False).alias("ask"))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        trie = Trie(pdf.loc[~pdf["ask"], "word"].tolist())
        rows = []
        for word in pdf.loc[pdf["ask"], "word"]:
            for other, d in trie.within(word, bound(len(word))):
                if d <= bound(len(other)):
                    rows.append((pdf["book"].iloc[0], word, other, d))
        return pd.DataFrame(rows, columns=["book", "t1", "t2", "d"])

    # little data, much work: the number of tasks is set, or they would be merged into one
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = asks.unionByName(holds).repartition(parts, "book", "i", "j")
    return cells.groupBy("book", "i", "j").applyInPandas(walk, "book string, t1 string, t2 string, d int")


def _agree(a: str, b: str) -> F.Column:
    """Equal or unknown on one side."""
    return (F.col(a) == F.col(b)) | (F.col(a) == "") | (F.col(b) == "")


def _same(a: str, b: str) -> bool:
    return a == b or not a or not b


class Sets:
    """Disjoint sets; a set is named by its first member in order."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def link_book(read: list[tuple]) -> dict[int, str]:
    """Entity of every record of one book, from its readings."""
    words = {w for _, _, kind, s, g, *_ in read if kind != "figure" for w in (s, g) if w and not w.startswith("#")}
    trie = Trie(sorted(words))
    near = {w: [(v, d) for v, d in trie.within(w, bound(len(w))) if d <= bound(len(v))] for w in words}
    sets = Sets()
    forms: dict[tuple, set] = {}
    for uid, _, kind, s, g, mid, _, sex, swapped, _ in read:
        if kind in ("full", "org"):
            form = ("f", s, g, mid, sex, swapped)
            forms.setdefault((s, g), set()).add(form)
            sets.union(("r", uid), form)
        elif kind == "figure":
            sets.union(("r", uid), ("g", s))
    for s, g in list(forms):
        for s2, ds in near.get(s, ()):
            for g2, dg in [(g, 0)] if g.startswith("#") else near.get(g, ()):
                if ds + dg > MAX_TOTAL or (s2, g2) not in forms:
                    continue
                for mine in forms[s, g]:
                    if mine[5]:
                        continue
                    for theirs in forms[s2, g2]:
                        if mine != theirs and _same(mine[3], theirs[3]) and _same(mine[4], theirs[4]):
                            sets.union(mine, theirs)
    singles: dict[str, set] = {}
    for _, _, kind, s, _, _, _, sex, *_ in read:
        if kind == "single":
            singles.setdefault(s, set()).add(sex)
    for s, mine in singles.items():
        for s2, _ in near.get(s, ()):
            for a, b in product(mine, singles.get(s2, ())):
                if _same(a, b):
                    sets.union(("s", s, a), ("s", s2, b))
    strong = {uid for uid, _, kind, *_ in read if kind in ("full", "org", "figure")}
    entity = {uid: sets.find(("r", uid)) for uid in strong}
    known: dict[str, set] = {}
    for uid, _, kind, s, g, _, title, sex, swapped, _ in read:
        if kind in ("full", "org") and not swapped and not g.startswith("#"):
            known.setdefault(s, set()).add((g[:1], sex, title, entity[uid], False))
            if kind == "full":
                known.setdefault(g, set()).add((g[:1], sex, title, entity[uid], True))
    out = {uid: repr(e) for uid, e in entity.items()}
    names: dict = {}
    for uid, _, kind, s, g, _, title, sex, *_ in read:
        if uid in strong:
            continue
        ranked: dict[int, set] = {}
        for w, d in near.get(s, ()):
            for initial, other, t, who, by_given in known.get(w, ()):
                if _same(sex, other) and (kind == "single" or not by_given and (kind == "title" or g == initial)):
                    ranked.setdefault(2 * d + (kind == "title" and t != title), set()).add(who)
        best = ranked[min(ranked)] if ranked else set()
        one = repr(next(iter(best))) if len(best) == 1 else None
        if kind == "single":
            names.setdefault(sets.find(("s", s, sex)), []).append((uid, one, len(best) > 1))
        else:
            out[uid] = min(out.get(uid, "~"), one or repr(("w", kind, s, g, sex)))
    for like, own in names.items():  # neighbouring single names stand or fall together
        who = {one for _, one, _ in own if one}
        for uid, *_ in own:
            out[uid] = min(out.get(uid, "~"), next(iter(who)) if len(who) == 1 and not any(x[2] for x in own) else repr(like))
    return out


_LINKED = "uid long, book string, entity string"


def link_names(characters: DataFrame, nicknames: dict[str, tuple[str, ...]] = nm.NICKNAMES, most: int = BOOK) -> DataFrame:
    """(uid, book, entity): every record with a readable name and the person or
    organisation it names within its book.

    Records of different books are never linked. Two different genders or middle
    initials never link. An initial or a bare title with a surname joins the one
    entity of its book that fits it; where several fit it stays with its like. Single names
    that are neighbours are alike, and join the one entity with such a surname or given
    name. ``nicknames`` gives the full names that a short one stands for.
    """
    source = characters.where("char_uid is not null and book_id is not null").select(*_COLUMNS[:-1], F.map_keys("names").alias("more"))
    large = durable(source.groupBy("book_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most))
    whole = large.isEmpty()
    small = source if whole else source.join(large, "book_id", "left_anti")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        rows = (r for pdf in batches for r in pdf[list(_COLUMNS)].itertuples(index=False))
        for book, own in groupby(rows, key=lambda r: r.book_id):
            read = list(dict.fromkeys(x for r in own for x in readings(*r, nicknames)))
            out += [(uid, book, e) for uid, e in link_book(read).items()]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["uid", "book", "entity"])
                out = []
        yield pd.DataFrame(out, columns=["uid", "book", "entity"])

    # by book and in order, so that a task holds one book at a time
    dealt = balanced(small, "book_id").sortWithinPartitions("book_id", "char_uid")
    linked = dealt.mapInPandas(link, _LINKED)
    if not whole:
        linked = linked.unionByName(_link_large(source.join(large, "book_id", "left_semi"), nicknames))
    # cut here: pairs and groups read the result twice
    return durable(linked)


def _link_large(characters: DataFrame, nicknames: dict[str, tuple[str, ...]]) -> DataFrame:
    """``link_book`` for books of any size, by joins over all tasks."""
    read = durable(read_records(characters, nicknames))
    near = durable(
        neighbours(
            read.where("kind <> 'figure'").select("book", F.explode(F.array("s", "g")).alias("word")).where("not startswith(word, '#')")
        )
    )
    same = read.where("startswith(g, '#')").select("book", F.col("g").alias("t1"), F.col("g").alias("t2"), F.lit(0).alias("d")).distinct()
    given = near.unionByName(same)

    strong = read.where("kind in ('full', 'org')")
    forms = strong.select("book", "s", "g", "mid", "gender", "swapped").distinct().withColumn(
        "form", F.concat(F.lit("f"), F.hex(F.xxhash64("book", "s", "g", "mid", "gender", "swapped")))
    )
    mine = forms.where("not swapped").select("book", F.col("s").alias("s1"), F.col("g").alias("g1"), F.col("mid").alias("m1"), F.col("gender").alias("x1"), F.col("form").alias("f1"))
    theirs = forms.select("book", F.col("s").alias("s2"), F.col("g").alias("g2"), F.col("mid").alias("m2"), F.col("gender").alias("x2"), F.col("form").alias("f2"))
    pairs = (
        mine.join(near.select("book", F.col("t1").alias("s1"), F.col("t2").alias("s2"), F.col("d").alias("ds")), ["book", "s1"])
        .join(given.select("book", F.col("t1").alias("g1"), F.col("t2").alias("g2"), F.col("d").alias("dg")), ["book", "g1"])
        .where(F.col("ds") + F.col("dg") <= MAX_TOTAL)
        .join(theirs, ["book", "s2", "g2"])
        .where(F.col("f1") != F.col("f2"))
        .where(_agree("m1", "m2") & _agree("x1", "x2"))
        .select("book", F.col("f1").alias("a"), F.col("f2").alias("b"))
    )
    holders = strong.join(forms, ["book", "s", "g", "mid", "gender", "swapped"]).select(
        F.concat(F.lit("r"), F.col("uid")).alias("a"), F.col("form").alias("b"), "uid", "book", "swapped"
    )
    figures = read.where("kind = 'figure'").select(
        "book", F.concat(F.lit("r"), F.col("uid")).alias("a"), F.concat(F.lit("g"), F.hex(F.xxhash64("book", "s"))).alias("b")
    )
    # a swapped reading counts only if it meets another record's straight one, which `pairs` says
    single = F.concat(F.lit("s"), F.hex(F.xxhash64("book", "s", "gender")))
    singles = read.where("kind = 'single'").select("book", "s", "gender", single.alias("node")).distinct()
    alike = (
        singles.select("book", F.col("s").alias("t1"), F.col("gender").alias("x1"), F.col("node").alias("a"))
        .join(near.select("book", "t1", "t2"), ["book", "t1"])
        .join(singles.select("book", F.col("s").alias("t2"), F.col("gender").alias("x2"), F.col("node").alias("b")), ["book", "t2"])
        .where((F.col("a") < F.col("b")) & _agree("x1", "x2"))
    )
    edges = pairs.unionByName(holders.select("book", "a", "b")).unionByName(figures).unionByName(alike.select("book", "a", "b"))
    whole = durable(connected_components(edges, "a", "b", within="book"))
    entities = whole.where("startswith(node, 'r')").select(F.expr("substring(node, 2)").cast("long").alias("uid"), F.col("component").alias("entity"))

    straight = strong.where("not swapped").join(entities, "uid")
    known = straight.select("book", "s", F.substring("g", 1, 1).alias("i"), "gender", "title", "entity", F.lit(False).alias("by_given"))
    by_given = straight.where("kind = 'full'").select("book", F.col("g").alias("s"), F.substring("g", 1, 1).alias("i"), "gender", "title", "entity", F.lit(True).alias("by_given"))
    known = known.unionByName(by_given).distinct()
    weak = read.where("kind in ('initial', 'title', 'single')").join(entities, "uid", "left_anti")
    shapes = weak.select("book", "kind", "s", "g", "title", "gender").distinct()
    fits = (
        shapes.withColumnRenamed("gender", "x1").withColumnRenamed("title", "t").withColumnRenamed("s", "s1")
        .join(near.select("book", F.col("t1").alias("s1"), F.col("t2").alias("s"), "d"), ["book", "s1"])
        .join(known, ["book", "s"])
        .where(_agree("x1", "gender") & F.expr("kind = 'single' or not by_given and (kind = 'title' or g = i)"))
        .where("not startswith(i, '#')")
        .withColumn("rank", F.col("d") * 2 + F.when((F.col("kind") == "title") & (F.col("t") != F.col("title")), 1).otherwise(0))
        .groupBy("book", "kind", F.col("s1").alias("s"), "g", F.col("t").alias("title"), F.col("x1").alias("gender"), "rank")
        .agg(F.min("entity").alias("least"), F.max("entity").alias("most"))
        .groupBy("book", "kind", "s", "g", "title", "gender")
        .agg(F.min(F.struct("rank", "least", "most")).alias("best"))
    )
    best = F.when(F.col("best.least") == F.col("best.most"), F.col("best.least"))
    found = weak.join(fits, ["book", "kind", "s", "g", "title", "gender"], "left").select(
        "uid", "book", "kind", single.alias("node"), "best", best.alias("one"), F.concat(F.lit("w"), F.hex(F.xxhash64("book", "kind", "s", "g", "gender"))).alias("like")
    )
    placed = found.where("kind <> 'single'").select("uid", "book", F.coalesce("one", "like").alias("entity"))
    # neighbouring single names stand or fall together
    names = found.where("kind = 'single'").join(whole.where("startswith(node, 's')"), "node", "left").withColumn("like", F.coalesce("component", "node"))
    fit = names.groupBy("like").agg(F.min("one").alias("least"), F.max("one").alias("most"), F.max(F.expr("best is not null and one is null")).alias("several"))
    joins = F.when((F.col("least") == F.col("most")) & ~F.col("several"), F.col("least"))
    placed = placed.unionByName(names.join(fit, "like").select("uid", "book", F.coalesce(joins, "like").alias("entity")))
    strong_books = read.select("uid", "book").distinct().join(entities, "uid")
    return strong_books.unionByName(placed).groupBy("uid", "book").agg(F.min("entity").alias("entity"))


def entity_pairs(linked: DataFrame) -> DataFrame:
    """All pairs of records of one entity, the smaller id first."""
    a = linked.select("book", "entity", F.col("uid").alias("a"))
    b = linked.select("book", "entity", F.col("uid").alias("b"))
    return a.join(b, ["book", "entity"]).where("a < b").select("a", "b").distinct()


def entity_groups(linked: DataFrame) -> DataFrame:
    """One row per record: its entity, named by its least record, and its number of links."""
    sizes = linked.groupBy("book", "entity").agg(F.min("uid").alias("group"), (F.count(F.lit(1)) - 1).alias("links"))
    return linked.join(sizes, ["book", "entity"]).select("uid", "book", "group", "links")
