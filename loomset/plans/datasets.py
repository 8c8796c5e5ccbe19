"""Whole datasets: scan, transform, set bad rows aside, split."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions import render_chatml, template_renderer
from loomset.operators.corpus import corpus_text
from loomset.operators.preference import to_preference_examples
from loomset.operators.quality import fail_on_error
from loomset.operators.render import format_examples
from loomset.operators.split import (
    SPLIT_KEY,
    assign_split,
    check_val_split,
    find_cut,
    split_key,
)
from loomset.operators.rows import RESERVED, parsed_rows, path_of
from loomset.sources import exists, remove, scan_json_texts, scan_jsonl, shared_dir, stage

logger = logging.getLogger(__name__)

# Internal columns: the line, what it holds, why it was refused, its place in the split.
_LINE, _RAW = RESERVED + "line", RESERVED + "raw"
_REFUSED, _KEY = RESERVED + "refused", RESERVED + "key"
# The text, before it gets its final name.
_TEXT = RESERVED + "text_out"

PREFERENCE_COLUMNS = ("prompt", "chosen", "rejected")
QUARANTINE_COLUMNS = ("source_file", "row_id", "value", "error_code", "error_index")


class PreparedData(NamedTuple):
    """Train rows, eval rows (or None) and the rows that could not be used.

    ``quarantine`` is None when the job was told to fail on the first bad row.
    """

    train: DataFrame
    eval: DataFrame | None
    quarantine: DataFrame | None


@dataclass(frozen=True)
class ReadOptions:
    """How rows are read, told apart and checked.

    ``key_field`` names a JSON field that identifies the row and decides its place
    in the split; without it the row's whole text does.  ``on_error`` is
    ``quarantine`` or ``fail``.  ``json_documents`` reads files that hold one JSON
    array or object each instead of JSON Lines.
    """

    key_field: str | None = None
    on_error: str = "quarantine"
    json_documents: bool = False

    def __post_init__(self) -> None:
        if self.on_error not in ("quarantine", "fail"):
            raise ValueError("on_error must be 'quarantine' or 'fail'")


@dataclass(frozen=True)
class Recipe:
    """What one kind of dataset makes of its rows."""

    transform: Callable[[DataFrame], DataFrame]
    # The columns that transform makes, and what they are called in the end.  A text
    # column gets its own name last, so that it can be any name.
    columns: tuple[tuple[str, str], ...]
    # The text column that must not be empty, if there is one to test.
    non_empty: str | None = None


class Staging:
    """Staged folders; those of a ``with`` block are deleted at its end.

    A folder that an earlier run left whole is taken over; ``told`` hears of the folder
    before it is written.  When the block ends with an exception, the folders stay.
    """

    def __init__(
        self, spark: SparkSession, earlier: str | None = None, told: Callable[[str], None] | None = None
    ):
        self._spark, self._paths, self._told = spark, [], told
        if earlier and not exists(spark, f"{earlier}/_SUCCESS"):
            remove(spark, earlier)
            earlier = None
        self._earlier = earlier

    def stage(self, df: DataFrame) -> DataFrame:
        if self._earlier:
            path, self._earlier = self._earlier, None
            self._paths.append(path)
            logger.info("rows staged by an earlier run are taken over")
            return df.sparkSession.read.schema(df.schema).parquet(path)
        path = shared_dir(self._spark)
        self._paths.append(path)
        if self._told:
            self._told(path)
        return stage(df, path)

    def close(self) -> None:
        while self._paths:
            remove(self._spark, self._paths.pop())

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, kind: object, *exc: object) -> None:
        if kind is None or not self._told:
            self.close()


class LoadedData(PreparedData):
    """What ``load_*`` gives: read from staged rows, where a split was asked for.

    ``close()``, or the end of a ``with`` block, deletes these.
    """

    staging: Staging | None = None

    def close(self) -> None:
        if self.staging:
            self.staging.close()

    def __enter__(self) -> LoadedData:
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()


def sft_recipe(
    chat_template_fn: Callable[..., str] | None = None,
    system_prompt: str | None = None,
    text_field: str = "text",
) -> Recipe:
    renderer = template_renderer(chat_template_fn) if chat_template_fn else render_chatml
    return Recipe(
        lambda rows: format_examples(rows, renderer, system_prompt, text_field=_TEXT, value=_RAW),
        ((_TEXT, text_field),),
        # ChatML text always holds a turn marker; only a template can give "".
        non_empty=_TEXT if chat_template_fn else None,
    )


def corpus_recipe(text_field: str = "text") -> Recipe:
    return Recipe(
        lambda rows: corpus_text(rows, text_field, value=_RAW, into=_TEXT),
        ((_TEXT, text_field),),
        non_empty=_TEXT,
    )


def preference_recipe(
    chat_template_fn: Callable[..., str] | None = None, system_prompt: str | None = None
) -> Recipe:
    renderer = template_renderer(chat_template_fn) if chat_template_fn else render_chatml
    return Recipe(
        lambda rows: to_preference_examples(rows, renderer, system_prompt, value=_RAW),
        tuple((c, c) for c in PREFERENCE_COLUMNS),
    )


def load_sft_dataset(
    spark: SparkSession,
    data_path: str | list[str],
    chat_template_fn: Callable[..., str] | None = None,
    *,
    eval_path: str | list[str] | None = None,
    val_split: float = 0.0,
    system_prompt: str | None = None,
    text_field: str = "text",
    seed: int = 42,
    options: ReadOptions = ReadOptions(),
) -> LoadedData:
    """Chat, instruction or prompt/completion rows as one text column."""
    recipe = sft_recipe(chat_template_fn, system_prompt, text_field)
    return _load(spark, recipe, data_path, eval_path, val_split, seed, options)


def load_text_corpus(
    spark: SparkSession,
    data_path: str | list[str],
    *,
    eval_path: str | list[str] | None = None,
    val_split: float = 0.0,
    text_field: str = "text",
    seed: int = 42,
    options: ReadOptions = ReadOptions(),
) -> LoadedData:
    """Raw text rows as one text column, without any formatting."""
    recipe = corpus_recipe(text_field)
    return _load(spark, recipe, data_path, eval_path, val_split, seed, options)


def load_dpo_dataset(
    spark: SparkSession,
    data_path: str | list[str],
    chat_template_fn: Callable[..., str] | None = None,
    *,
    eval_path: str | list[str] | None = None,
    val_split: float = 0.0,
    system_prompt: str | None = None,
    seed: int = 42,
    options: ReadOptions = ReadOptions(),
) -> LoadedData:
    """Preference rows as ``prompt``, ``chosen`` and ``rejected``."""
    recipe = preference_recipe(chat_template_fn, system_prompt)
    return _load(spark, recipe, data_path, eval_path, val_split, seed, options)


def labelled_rows(
    spark: SparkSession,
    recipe: Recipe,
    data_path: str | list[str],
    eval_path: str | list[str] | None,
    val_split: float,
    seed: int,
    options: ReadOptions,
    staging: Staging | None = None,
) -> DataFrame:
    """All rows with ``split``: ``train``, ``eval`` or ``quarantine``.

    An eval file takes precedence over ``val_split``.  Without either, and with
    an eval file, this is one narrow pass over the input and stays lazy: each part
    that is read parses the input again, and one write of all parts parses it once.
    With ``val_split`` the transformed rows are staged first: finding the cut and
    reading the result would otherwise parse the input again each time.
    """
    check_val_split(val_split)
    train = _transformed(spark, recipe, data_path, options, seed if val_split and not eval_path else None)
    if eval_path:
        held_out = _transformed(spark, recipe, eval_path, options)
        return _with_split(train, "train").unionByName(_with_split(held_out, "eval"))
    if val_split == 0:
        return _with_split(train, "train")

    staged = (staging or Staging(spark)).stage(train)
    good = staged.where(F.col("error_code").isNull())
    if good.isEmpty():
        raise ValueError(f"no row is left to split; {_told_errors(staged)}")
    cut = find_cut(good, val_split)
    logger.info("%d of %d rows are held out", cut.n_eval, cut.n_rows)
    split = F.when(F.col("error_code").isNull(), F.col("split")).otherwise("quarantine")
    return assign_split(staged, cut).withColumn("split", split)


def _told_errors(rows: DataFrame) -> str:
    # One row per error code, of which there are few.
    counts = rows.groupBy("error_code").count().orderBy("error_code").collect()
    return ", ".join(f"{r['error_code']}: {r['count']}" for r in counts) or "the input is empty"


def _load(
    spark: SparkSession,
    recipe: Recipe,
    data_path: str | list[str],
    eval_path: str | list[str] | None,
    val_split: float,
    seed: int,
    options: ReadOptions,
) -> LoadedData:
    staging = Staging(spark)
    rows = labelled_rows(spark, recipe, data_path, eval_path, val_split, seed, options, staging)
    has_eval = bool(eval_path) or val_split > 0
    data = LoadedData(*by_split(rows, recipe.columns, has_eval, options.on_error))
    data.staging = staging
    return data


def by_split(
    rows: DataFrame, columns: tuple[tuple[str, str], ...], has_eval: bool, on_error: str
) -> PreparedData:
    """Take labelled rows apart, and give the columns their final names."""

    def part(split: str, *wanted: Column) -> DataFrame:
        return rows.where(F.col("split") == split).select(*wanted)

    texts = [F.col("`" + now.replace("`", "``") + "`").alias(final) for now, final in columns]
    return PreparedData(
        part("train", *texts),
        part("eval", *texts) if has_eval else None,
        part("quarantine", *map(F.col, QUARANTINE_COLUMNS)) if on_error == "quarantine" else None,
    )


def _transformed(
    spark: SparkSession,
    recipe: Recipe,
    path: str | list[str],
    options: ReadOptions,
    seed: int | None = None,
) -> DataFrame:
    """Transformed rows; with ``seed``, good ones have the key of their split."""
    rows = (scan_json_texts if options.json_documents else scan_jsonl)(spark, path)
    # A line is parsed here, once, and the row operators get a VARIANT.
    rows = parsed_rows(rows.select("source_file", "row_id", F.col("value").alias(_LINE)), _LINE, _RAW, _REFUSED)
    if seed is not None:
        key, content = F.col(_LINE), None
        if options.key_field:
            # Rows without the key fall back to their whole text.
            field = F.try_variant_get(_RAW, "$" + path_of(options.key_field), "string")
            key, content = F.coalesce(field, F.col(_LINE)), F.col(_LINE)
        hashed = split_key(key, seed, tie_break=F.col("row_id"), content=content)
        rows = rows.withColumn(_KEY, hashed)
    rows = recipe.transform(rows)
    refused = F.struct(F.col(_REFUSED).alias("code"), F.lit(None).cast("int").alias("index"))
    rows = rows.withColumn("error", F.when(F.col(_REFUSED).isNotNull(), refused).otherwise(F.col("error")))
    if options.on_error == "fail":
        rows = fail_on_error(rows)
    code = F.col("error.code")
    if recipe.non_empty:
        rows = rows.where(code.isNotNull() | (F.length(recipe.non_empty) > 0))
    keys = [F.when(code.isNull(), F.col(_KEY)).alias(SPLIT_KEY)] if seed is not None else []
    return rows.select(
        *(now for now, _ in recipe.columns),
        "source_file",
        "row_id",
        F.when(code.isNotNull(), F.col(_LINE)).alias("value"),
        code.alias("error_code"),
        F.col("error.index").alias("error_index"),
        *keys,
    )


def _with_split(rows: DataFrame, name: str) -> DataFrame:
    split = F.when(F.col("error_code").isNull(), name).otherwise("quarantine")
    return rows.withColumn("split", split)
