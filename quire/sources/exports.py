"""Exports in the shapes that downstream tools read: tokens, entities, quotes, characters, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tokens_export(tokens: DataFrame) -> DataFrame:
    """Eleven columns per token; numbers within paragraph and sentence are counted from the
    first token of each. Of a token number given twice the least row is exported (by the
    columns in order, nulls first)."""
    columns = ("para_num", "sent_num", "word", "lemma", "pos_tag", "dependency_relation", "dependency_head_token_num", "ner")
    one = tokens.groupBy("book_id", "tok_num_in_doc").agg(F.min(F.struct(*columns)).alias("t")).select("book_id", "tok_num_in_doc", "t.*")
    first = lambda *keys: F.min("tok_num_in_doc").over(Window.partitionBy("book_id", *keys))
    return one.select(
        "book_id",
        "para_num",
        "sent_num",
        "tok_num_in_doc",
        (F.col("tok_num_in_doc") - first("para_num")).alias("tok_num_in_para"),
        (F.col("tok_num_in_doc") - first("para_num", "sent_num")).alias("tok_num_in_sent"),
        "word",
        "lemma",
        "pos_tag",
        "dependency_relation",
        "dependency_head_token_num",
        "ner",
    )


def entities_export(entity_tokens: DataFrame) -> DataFrame:
    """(book_id, start_tok_num, end_tok_num, phrase, ner) from tokens (book_id, entity, tok_num,
    word, ner) that carry an entity, whatever kind of key that is."""
    per = entity_tokens.where("entity is not null").groupBy("book_id", "entity").agg(
        F.min("tok_num").alias("start_tok_num"), F.max("tok_num").alias("end_tok_num"), F.array_sort(F.collect_list(F.struct("tok_num", "word"))).alias("l"), F.min_by("ner", "tok_num").alias("ner")
    )
    return per.select("book_id", "start_tok_num", "end_tok_num", F.array_join("l.word", " ").alias("phrase"), "ner")


def quotes_export(quotes: DataFrame) -> DataFrame:
    return quotes.select("book_id", "mention", "begin_tok_num", "end_tok_num", "begin_mention_tok_num", "end_mention_tok_num").distinct()


def characters_json(characters: DataFrame) -> DataFrame:
    """(book_id, json): one object per book, characters by id, unknown names left out."""
    entry = F.concat(F.lit('"'), F.col("id").cast("string"), F.lit('":'), F.to_json(F.struct(*[c for c in characters.columns if c not in ("book_id", "id")])))
    per = characters.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("id", entry.alias("e")))).alias("l"))
    return per.select("book_id", F.concat(F.lit("{"), F.array_join("l.e", ","), F.lit("}")).alias("json"))


def export_names(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of header attributes as the text ``None``, as in the exchanged files."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns})


def feature_lines(features: DataFrame) -> DataFrame:
    """(book_id, value): ``book TAB page TAB name=value …`` with features in order of name."""
    per = features.groupBy("book_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("feature", "value"))).alias("l"))
    pairs = F.array_join(F.transform("l", lambda x: F.concat(x["feature"], F.lit("="), x["value"].cast("string"))), " ")
    return per.select("book_id", F.concat_ws("\t", "book_id", F.col("page_no").cast("string"), pairs).alias("value"))


def write_csv(df: DataFrame, path: str) -> None:
    """One folder per book, with a header line."""
    df.write.mode("overwrite").partitionBy("book_id").option("header", True).csv(path)


def write_artefact(df: DataFrame, path: str, root: str = "books", row: str = "book") -> None:
    """Rows as XML elements."""
    df.write.mode("overwrite").format("xml").option("rootTag", root).option("rowTag", row).save(path)
