"""Rows of every supported shape, made from the given tables.

The tables hold plain documents and single turns, so each document is turned into
one JSON line whose shape depends on ``doc_id``.  Every document takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.sources import shared_dir

SYSTEM_PROMPT = "You are a careful assistant."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id`` and ``messages``.

    A conversation is one row in the data model, as it is one JSON line in a file;
    the table holds it as turns, so they are put back together.
    """
    turns = table(spark, sf_dir, "conversations")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    messages = F.transform(
        ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))
    )
    return turns.groupBy("conv_id").agg(messages.alias("messages"))


def _json(keep_nulls: bool = False, **fields: Column) -> Column:
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    row = F.struct(F.col("doc_id"), *[c.alias(k) for k, c in fields.items()])
    return F.to_json(row, options)


def _turn(role: str, content: Column, **extra: Column) -> Column:
    return F.struct(
        F.lit(role).alias("role"),
        content.alias("content"),
        *[c.alias(k) for k, c in extra.items()],
    )


def _pick(cases: list[Column], kind: Column | None = None) -> Column:
    kind = F.col("doc_id") % len(cases) if kind is None else kind
    picked = F.when(kind == 0, cases[0])
    for i, case in enumerate(cases[1:], start=1):
        picked = picked.when(kind == i, case)
    return picked


def sft_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id`` and ``value``: twenty kinds of SFT rows, good and bad."""
    text, lang, null = F.col("text"), F.col("lang"), F.lit(None).cast("string")
    note = F.lit("late")
    cases = [
        _json(messages=F.array(_turn("user", text), _turn("assistant", lang))),
        _json(instruction=F.lit("Name the language."), context=text, response=lang),
        _json(instruction=text, output=lang),
        _json(prompt=text, completion=lang),
        _json(
            messages=F.array(
                _turn("system", F.lit("Be exact.")), _turn("user", text), _turn("assistant", lang)
            )
        ),
        _json(instruction=text, context=F.lit(""), response=lang),
        _json(foo=text),
        _json(messages=F.array(_turn("user", lang), _turn("wizard", text))),
        _json(instruction=text),
        _json(messages=F.array(_turn(" user\t", text), _turn("assistant", lang))),
        _json(messages=F.array(), prompt=text, completion=lang),
        _json(keep_nulls=True, instruction=text, response=null, output=lang),
        _json(
            messages=F.array(
                _turn("user", text), _turn("assistant", F.when(F.col("doc_id") < 0, lang))
            )
        ),
        _json(prompt=text),
        _json(keep_nulls=True, prompt=null, completion=lang),
        F.concat(F.lit('{"prompt": '), F.to_json(F.array(text))),
        F.to_json(F.array(text)),
        _json(prompt=text, completion=F.col("n_chars") > 1000),
        _json(prompt=text, completion=F.col("n_chars")),
        _json(
            messages=F.array(
                _turn("user", text, x=lang), _turn("system", note, x=lang), _turn("assistant", lang, x=lang)
            )
        ),
    ]
    documents = table(spark, sf_dir, "documents")
    return documents.select(F.col("doc_id").alias("row_id"), _pick(cases).alias("value"))


def sft_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same idea as a typed table: four kinds of rows, other columns NULL."""
    kind = F.col("doc_id") % 4
    messages = F.array(_turn("user", F.col("text")), _turn("assistant", F.col("lang")))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.when(kind == 0, messages).alias("messages"),
        F.when(kind == 1, F.col("text")).alias("instruction"),
        F.when(kind == 1, F.col("lang")).alias("output"),
        F.when(kind >= 2, F.col("text")).alias("prompt"),
        F.when(kind == 2, F.col("n_chars")).alias("completion"),
    )


def preference_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id`` and ``value``: eight kinds of preference rows, good and bad."""
    text, lang = F.col("text"), F.col("lang")
    answers = {"chosen": text, "rejected": F.concat(text, F.lit(" Or not."))}
    cases = [
        _json(prompt=lang, **answers),
        _json(messages=F.array(_turn("user", lang)), **answers),
        _json(instruction=F.lit("Go on."), context=lang, **answers),
        _json(prompt=lang, instruction=F.lit("Go on."), **answers),
        _json(prompt=lang, chosen=text),
        _json(
            messages=F.array(
                _turn("system", F.lit("Be exact.")), _turn("user", lang), _turn("assistant", F.lit("Well,"))
            ),
            **answers,
        ),
        _json(foo=lang, **answers),
        _json(
            keep_nulls=True, prompt=lang, chosen=F.lit(None).cast("string"), rejected=text
        ),
    ]
    documents = table(spark, sf_dir, "documents")
    return documents.select(F.col("doc_id").alias("row_id"), _pick(cases).alias("value"))


def corpus_lines(spark: SparkSession, sf_dir: str, field: str = "text") -> DataFrame:
    """``row_id`` and ``value``: every document as a good row, and one more row for each.

    The further rows are of five kinds, none of which has a text worth the name; their
    ids are negative.
    """
    text, source = F.col("text"), F.col("source")
    cases = [
        _json(**{field: F.lit("")}, source=source),
        _json(**{field: F.lit(" ")}, source=source),
        _json(source=source),
        _json(**{field: F.col("n_chars")}, source=source),
        _json(keep_nulls=True, **{field: F.lit(None).cast("string")}, source=source),
    ]
    documents = table(spark, sf_dir, "documents")
    good = documents.select(F.col("doc_id").alias("row_id"), _json(**{field: text}, source=source).alias("value"))
    others = documents.withColumn("doc_id", -1 - F.col("doc_id"))
    picked = _pick(cases, kind=(-1 - F.col("doc_id")) % len(cases))
    return good.union(others.select(F.col("doc_id").alias("row_id"), picked.alias("value")))


def write_documents(lines: DataFrame) -> str:
    """Write the lines as JSON documents: each file is one array of up to 1,000 of them."""
    path = f"{shared_dir(lines.sparkSession)}/documents"
    chunks = lines.groupBy(F.floor(F.col("row_id") / 1000).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n "), F.lit("]")).alias("value")
    )
    # one row of text for each file
    chunks.write.partitionBy("file").text(path)
    return path


def write_lines(lines: DataFrame) -> str:
    """Write the lines as a JSON Lines dataset and return its path."""
    path = f"{shared_dir(lines.sparkSession)}/data.jsonl"
    lines.select("value").write.text(path)
    return path
