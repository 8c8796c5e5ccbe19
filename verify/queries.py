"""One query per operator; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset import (
    PreparedData,
    ReadOptions,
    SplitRoutes,
    accepted,
    calibration_sample,
    cap_preference_lengths,
    corpus_text,
    dataset_ready_count,
    discover_corpus,
    drop_empty_text,
    error_summary,
    fail_on_error,
    format_examples,
    holdout_split,
    length_grouped_batches,
    load_dpo_dataset,
    load_sft_dataset,
    load_text_corpus,
    pack_sequences,
    packed_tokens,
    prepend_system_prompt,
    profile_keys,
    python_tokenizer,
    quarantined,
    read_sessions,
    render_chatml,
    route_table,
    run_prep_job,
    scan_json,
    scan_jsonl,
    session_slices,
    template_renderer,
    to_chat_messages,
    to_preference_examples,
    token_counts,
    truncate_to_length,
    truncated_text,
    write_sessions,
)
from loomset.functions import py_strip, split_tokens, valid_role as is_valid_role
from loomset.sources import shared_dir, stage, write_jsonl_pair
from verify.rows import (
    SYSTEM_PROMPT,
    conversations,
    corpus_lines,
    preference_lines,
    sft_lines,
    sft_table,
    table,
    write_documents,
    write_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
BY_DOC = ReadOptions(key_field="doc_id")


def _labelled(data: PreparedData) -> DataFrame:
    train = data.train.withColumn("split", F.lit("train"))
    if data.eval is None:
        return train
    return train.unionByName(data.eval.withColumn("split", F.lit("eval")))


def _turns(df: DataFrame) -> DataFrame:
    """One row per turn: ``row_id``, ``turn``, ``role``, ``content``."""
    turns = df.select("row_id", F.posexplode("messages").alias("turn", "m"))
    return turns.select("row_id", F.col("turn").cast("bigint"), "m.role", "m.content")


def _two_turns(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id",
        F.col("messages")[0]["content"].alias("user"),
        F.col("messages")[1]["content"].alias("assistant"),
    )


def margin_template(messages, tokenize=False, add_generation_prompt=False):
    """A chat template as a caller would bring it: the speaker in the margin."""
    turns = [f"{m['role']:>9} > {m['content'].strip()}" for m in messages]
    return "\n".join(turns + ["assistant > "] * add_generation_prompt)


def margin_text(messages: Column, add_generation_prompt: bool = False) -> Column:
    """The same template as an expression."""
    turns = F.transform(
        messages,
        lambda m: F.concat(F.lpad(m["role"], 9, " "), F.lit(" > "), py_strip(m["content"])),
    )
    if add_generation_prompt:
        turns = F.concat(turns, F.array(F.lit("assistant > ")))
    return F.array_join(turns, "\n")


# Sources

def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lines = documents.select(F.to_json(F.struct("doc_id", "text", "source")).alias("value"))
    row = F.from_json("value", "doc_id bigint, text string, source string")
    scanned = scan_jsonl(spark, write_lines(lines))
    return scanned.select(row.alias("row")).select("row.doc_id", "row.text", "row.source")


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lines = documents.select(
        F.col("doc_id").alias("row_id"), F.to_json(F.struct("doc_id", "text", "source")).alias("value")
    )
    scanned = scan_json(spark, write_documents(lines))
    row = F.try_variant_get("value", "$", "struct<doc_id:bigint,text:string,source:string>")
    return scanned.select(row.alias("row")).select("row.doc_id", "row.text", "row.source")


def json_document_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_documents(corpus_lines(spark, sf_dir))
    options = ReadOptions(key_field="doc_id", json_documents=True)
    return _labelled(load_text_corpus(spark, path, val_split=0.05, options=options))


def json_document_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays in which some elements are too deep, and some no JSON: only these are refused."""
    doc = F.col("doc_id")
    number = F.format_string("%012d", doc)
    head = F.concat(F.lit('{"text":"'), number, F.lit('","x":'))
    value = (
        F.when(doc % 100 == 7, F.concat(head, F.lit("[" * 2500 + "]" * 2500 + "}")))
        .when(doc % 100 == 9, F.concat(head, F.lit("[1,]}")))
        .otherwise(F.concat(head, F.to_json(F.array("text")), F.lit("}")))
    )
    lines = table(spark, sf_dir, "documents").select(doc.alias("row_id"), value.alias("value"))
    data = load_text_corpus(spark, write_documents(lines), options=ReadOptions(json_documents=True))
    refused = data.quarantine.select(F.substring("value", 10, 12).cast("bigint").alias("doc_id"), "error_code")
    return data.train.select(F.col("text").cast("bigint").alias("doc_id"), F.lit("").alias("error_code")).union(refused)


def eval_file_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(
        F.to_json(
            F.struct(F.col("text").alias("prompt"), F.lit("done").alias("completion"))
        ).alias("value")
    )
    data = load_sft_dataset(
        spark,
        write_lines(sft_lines(spark, sf_dir)),
        eval_path=write_lines(items),
        val_split=0.5,
    )
    return _labelled(data)


def find_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(corpus_lines(spark, sf_dir))
    root, name = path.rsplit("/", 1)
    return load_text_corpus(spark, discover_corpus(spark, root, name)).train


def route_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    split = F.when(F.col("doc_id") % 10 == 0, "validation").otherwise("train")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("lang").alias("specialist"), split.alias("split")
    )
    documents.write.partitionBy("specialist", "split").parquet(path)
    return route_table(spark, path, "fr").select("doc_id", "text", "split")


def key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profile_keys(sft_lines(spark, sf_dir))
    keys = F.coalesce(F.array_join("keys", ","), F.lit("-"))
    return profile.select(keys.alias("keys"), "n_rows")


def key_profile_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered example of each key set, over rows that differ by their id alone."""
    rows = sft_lines(spark, sf_dir)
    shown = format_examples(rows.withColumn("line", F.col("value")), value="value")
    profile = profile_keys(shown.where("error.code is null"), "line", preview="text")
    return profile.select(F.array_join("keys", ",").alias("keys"), "n_rows", F.col("example").isNotNull().alias("shown"))


# Rows to messages

def detect_sft_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_chat_messages(sft_lines(spark, sf_dir))
    return rows.select("row_id", F.coalesce("schema_kind", F.lit("-")).alias("schema_kind"))


def normalize_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_chat_messages(sft_lines(spark, sf_dir))
    return _turns(rows.where(F.col("schema_kind") == "messages"))


def instruction_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(to_chat_messages(sft_lines(spark, sf_dir)))
    return _two_turns(rows.where(F.col("schema_kind") == "instruction"))


def output_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(to_chat_messages(sft_table(spark, sf_dir)))
    return _two_turns(rows.where(F.col("schema_kind") == "instruction"))


def prompt_completion_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(to_chat_messages(sft_lines(spark, sf_dir)))
    return _two_turns(rows.where(F.col("schema_kind") == "prompt_completion"))


def first_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = prepend_system_prompt(F.col("messages"), SYSTEM_PROMPT)
    rows = conversations(spark, sf_dir).select("conv_id", messages.alias("messages"))
    return rows.select(
        "conv_id",
        F.col("messages")[0]["role"].alias("role"),
        F.col("messages")[0]["content"].alias("content"),
        F.size("messages").cast("bigint").alias("n_turns"),
    )


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(to_chat_messages(sft_lines(spark, sf_dir), SYSTEM_PROMPT))


def typed_table_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(to_chat_messages(sft_table(spark, sf_dir), SYSTEM_PROMPT))


def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_sft_dataset(spark, write_lines(sft_lines(spark, sf_dir))).train


# Rendering

def chatml(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = prepend_system_prompt(F.col("messages"), SYSTEM_PROMPT)
    text = render_chatml(messages).alias("text")
    return drop_empty_text(conversations(spark, sf_dir).select("conv_id", text))


def generation_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    messages = prepend_system_prompt(F.array(user), SYSTEM_PROMPT)
    prompt = render_chatml(messages, add_generation_prompt=True)
    return table(spark, sf_dir, "benchmark").select("item_id", prompt.alias("prompt"))


def bracket_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = margin_text(F.col("messages"), add_generation_prompt=True)
    return conversations(spark, sf_dir).select("conv_id", text.alias("text"))


def template_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    render = template_renderer(margin_template)
    text = render(F.col("messages"), True)
    return conversations(spark, sf_dir).select("conv_id", text.alias("text"))


def format_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = format_examples(
        sft_lines(spark, sf_dir), system_prompt=SYSTEM_PROMPT, add_generation_prompt=True
    )
    return accepted(rows).select("row_id", "text")


# Preference rows

def preference_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_preference_examples(preference_lines(spark, sf_dir))
    return quarantined(rows).select("row_id", "error_code")


def detect_preference_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_preference_examples(preference_lines(spark, sf_dir))
    return rows.select("row_id", F.coalesce("schema_kind", F.lit("-")).alias("schema_kind"))


def preference_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_preference_examples(
        preference_lines(spark, sf_dir), margin_text, SYSTEM_PROMPT
    )
    return accepted(rows).select("row_id", "prompt")


def preference_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_preference_examples(
        preference_lines(spark, sf_dir), system_prompt=SYSTEM_PROMPT
    )
    return accepted(rows).select("row_id", "prompt", "chosen", "rejected")


# Corpus rows, filters and errors

def corpus_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(corpus_text(corpus_lines(spark, sf_dir))).select("row_id", "text")


def corpus_text_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus_text(corpus_lines(spark, sf_dir, "body"), "body")
    return accepted(rows).select("row_id", "body")


def non_empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = F.col("doc_id") % 2
    blank = documents.withColumn("text", F.when(kind == 0, "").otherwise(" "))
    return drop_empty_text(documents.union(blank))


def valid_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = [F.col("role"), F.upper("role"), F.concat(F.lit("\t"), "role", F.lit(" \n")), F.concat("role", F.lit("s"))]
    picked = F.element_at(F.array(*shapes), (F.col("turn") % 4 + 1).cast("int"))
    ok = is_valid_role(py_strip(picked)).cast("bigint")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", ok.alias("valid"))


def classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quarantined(to_chat_messages(sft_lines(spark, sf_dir)))
    index = F.coalesce("error_index", F.lit(-1)).cast("bigint")
    return bad.select("row_id", "error_code", index.alias("error_index"))


def errors_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_summary(to_chat_messages(sft_lines(spark, sf_dir)))


# Split and counts

def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return holdout_split(documents, 0.05, "doc_id")


def split_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text decides, and ``doc_id`` only between copies of one text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    tie = F.col("doc_id")
    return holdout_split(documents, 0.3, "text", tie_break=tie).select("doc_id", "split")


def split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other document has no key; they count like the others."""
    key = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id"))
    documents = table(spark, sf_dir, "documents").select("doc_id", key.alias("key"))
    tie = F.col("doc_id")
    return holdout_split(documents, 0.1, "key", tie_break=tie).select("doc_id", "split")


def split_of_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten documents share a key; whatever the files, the same ones are held out."""
    lines = table(spark, sf_dir, "documents").select(
        F.to_json(F.struct((F.col("doc_id") % 97).alias("key"), F.format_string("%012d", "doc_id").alias("text"), F.col("text").alias("body"))).alias("value"),
        "doc_id",
    )
    options = ReadOptions(key_field="key")
    parts = []
    for name, rows in (
        ("up", lines.orderBy("doc_id")),
        ("down", lines.repartition(7, "doc_id").sortWithinPartitions(F.desc("doc_id"))),
    ):
        data = load_text_corpus(spark, write_lines(rows), val_split=0.2, options=options)
        parts.append(data.eval.select("text", F.lit(name).alias("layout")))
    both = parts[0].union(parts[1]).groupBy("text").agg(F.count("*").alias("n"))
    return both.agg(F.count("*").alias("held_out"), F.min("n").alias("least"), F.max("n").alias("most"))


def ready_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return dataset_ready_count(holdout_split(documents, 0.07, "doc_id"))


# Whole datasets

def sft_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = load_sft_dataset(
        spark,
        write_lines(sft_lines(spark, sf_dir)),
        val_split=0.1,
        system_prompt=SYSTEM_PROMPT,
        options=BY_DOC,
    )
    return _labelled(data)


def text_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(corpus_lines(spark, sf_dir))
    return _labelled(load_text_corpus(spark, path, val_split=0.05, options=BY_DOC))


def dpo_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(preference_lines(spark, sf_dir))
    data = load_dpo_dataset(
        spark, path, val_split=0.2, system_prompt=SYSTEM_PROMPT, options=BY_DOC
    )
    return _labelled(data)


def prep_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = {
        "mode": "pretrain",
        "dataset": {
            "path": write_lines(corpus_lines(spark, sf_dir)),
            "val_split": 0.05,
        },
    }
    return _labelled(run_prep_job(spark, job, shared_dir(spark), options=BY_DOC))


def prep_job_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = {
        "path": write_lines(sft_lines(spark, sf_dir)),
        "val_split": 0.1,
        "system_prompt": SYSTEM_PROMPT,
    }
    return _labelled(run_prep_job(spark, {"dataset": dataset}, shared_dir(spark), options=BY_DOC))


def prep_job_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = {
        "path": write_lines(preference_lines(spark, sf_dir)),
        "val_split": 0.2,
        "system_prompt": SYSTEM_PROMPT,
    }
    job = {"mode": "preference", "dataset": dataset}
    return _labelled(run_prep_job(spark, job, shared_dir(spark), options=BY_DOC))


def all_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are all good pass the check that fails at a bad one."""
    text, lang = F.col("text"), F.col("lang")
    line = F.to_json(F.struct(text.alias("prompt"), lang.alias("completion")))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), line.alias("value"))
    return fail_on_error(format_examples(rows)).select("row_id", "text")


def field_called_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text field with the name of a column that the split uses."""
    path = write_lines(corpus_lines(spark, sf_dir, "split"))
    data = load_text_corpus(spark, path, val_split=0.05, text_field="split", options=BY_DOC)
    train = data.train.select(F.col("split").alias("text"), F.lit("train").alias("part"))
    return train.union(data.eval.select("split", F.lit("eval")))


def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark)
    documents = holdout_split(
        table(spark, sf_dir, "documents").select("doc_id", "text"), 0.05, "doc_id"
    )
    parts = [documents.where(F.col("split") == name).select("text") for name in ("train", "eval")]
    write_jsonl_pair(*parts, root, "docs")
    paths = SplitRoutes(default="docs").resolve(root)
    return _labelled(load_text_corpus(spark, paths.train, eval_path=paths.eval))


# Layout of training input

def word_lengths(texts: list[str]) -> list[list[int]]:
    """A tokenizer as a caller would bring it: the id of a token is its length."""
    return [[len(word) for word in text.split(" ")] for text in texts]


def counted(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with a text and their token counts, computed once."""
    documents = drop_empty_text(table(spark, sf_dir, "documents"))
    return stage(token_counts(documents).select("doc_id", "n_tokens", *columns))


def tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by the default tokenizer and by a Python function."""
    called = python_tokenizer(word_lengths)
    documents = table(spark, sf_dir, "documents")
    rows = token_counts(token_counts(documents), called, into="n_called")
    ids = called.tokens(F.col("text"))
    return rows.select("doc_id", "n_tokens", "n_called", F.aggregate(ids, F.lit(0), lambda s, x: s + x).cast("bigint").alias("id_sum"))


def truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = truncate_to_length(token_counts(drop_empty_text(table(spark, sf_dir, "documents"))), 64)
    text = truncated_text(F.col("text"), F.col("kept_tokens"))
    return rows.select("doc_id", "n_tokens", "was_truncated", text.alias("text"))


def preference_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a prompt, whose answers are half of it, and its language."""
    rows = counted(spark, sf_dir).select(
        "doc_id",
        F.col("n_tokens").alias("n_prompt"),
        F.floor(F.col("n_tokens") / 2).alias("n_chosen"),
        F.lit(1).alias("n_rejected"),
    )
    capped = cap_preference_lengths(rows, max_length=160, max_prompt_length=100)
    spans = [F.col(c).cast("bigint").alias(c) for c in ("prompt_from", "prompt_to", "chosen_to", "rejected_to")]
    return capped.select("doc_id", *spans, "was_capped")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(counted(spark, sf_dir), 512, row_id="doc_id").drop("seq_from")


def packing_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences without separators, short enough that most documents fill several."""
    return pack_sequences(counted(spark, sf_dir), 32, row_id="doc_id", separators=0, keep_last=False)


def packed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences themselves: their tokens joined by blanks."""
    rows = counted(spark, sf_dir, "text")
    spans = pack_sequences(rows.select("doc_id", "n_tokens"), 512, row_id="doc_id")
    tokens = rows.select("doc_id", split_tokens(F.col("text")).alias("tokens"))
    packed = packed_tokens(spans, tokens, F.lit("<end>"), row_id="doc_id")
    return packed.select("seq_id", F.size("tokens").cast("bigint").alias("n"), F.md5(F.array_join("tokens", " ").cast("binary")).alias("digest"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_grouped_batches(counted(spark, sf_dir), 8, row_id="doc_id")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of a long pass, written, and read back by their directories in one scan."""
    packed = pack_sequences(counted(spark, sf_dir), 256, row_id="doc_id")
    path = shared_dir(spark)
    write_sessions(session_slices(packed, effective_batch=4, max_steps=100), path)
    return read_sessions(spark, path).select(F.col("session_id").cast("bigint"), "step", "seq_id", "doc_id", "tok_from", "tok_to")


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return calibration_sample(documents, 64, row_key="doc_id").select("doc_id", "text")


def calibration_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of copies, which the text alone can't tell apart, the id decides."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return calibration_sample(documents, 20, row_key="text", content="doc_id", by=("lang",)).select("lang", "doc_id")


QUERIES: dict[str, Query] = {
    "scan_jsonl": scan_lines,
    "scan_json": scan_documents,
    "json_document_corpus": json_document_corpus,
    "json_document_errors": json_document_errors,
    "eval_file_precedence": eval_file_precedence,
    "discover_corpus": find_corpus,
    "route_split": route_split,
    "profile_keys": key_profile,
    "profile_keys_preview": key_profile_preview,
    "detect_sft_schema": detect_sft_schema,
    "normalize_messages": normalize_messages,
    "instruction_to_messages": instruction_to_messages,
    "output_alias": output_alias,
    "prompt_completion_to_messages": prompt_completion_to_messages,
    "prepend_system_prompt": first_turn,
    "to_chat_messages": chat_messages,
    "typed_table_messages": typed_table_messages,
    "prune_columns": prune_columns,
    "render_chatml": chatml,
    "render_generation_prompt": generation_prompt,
    "render_bracket_template": bracket_text,
    "render_with_template_fn": template_fn,
    "format_example": format_example,
    "preference_errors": preference_errors,
    "detect_preference_schema": detect_preference_schema,
    "render_preference_prompt": preference_prompt,
    "to_preference_example": preference_example,
    "corpus_project": corpus_project,
    "corpus_text_field": corpus_text_field,
    "drop_empty_text": non_empty_text,
    "valid_role": valid_role,
    "classify_errors": classify_errors,
    "error_summary": errors_by_code,
    "holdout_split": split_documents,
    "holdout_split_copies": split_by_text,
    "holdout_split_null_keys": split_null_keys,
    "holdout_split_layouts": split_of_layouts,
    "dataset_ready_count": ready_count,
    "sft_dataset": sft_dataset,
    "text_corpus": text_corpus,
    "dpo_dataset": dpo_dataset,
    "prep_job": prep_job,
    "prep_job_sft": prep_job_sft,
    "prep_job_preference": prep_job_preference,
    "fail_on_error": all_good,
    "text_field_called_split": field_called_split,
    "write_roundtrip": write_roundtrip,
    "token_counts": tokenizers,
    "truncate_to_length": truncation,
    "cap_preference_lengths": preference_lengths,
    "pack_sequences": packing,
    "pack_sequences_whole": packing_whole,
    "packed_tokens": packed_text,
    "length_grouped_batches": batches,
    "session_slices": sessions,
    "calibration_sample": calibration,
    "calibration_sample_by": calibration_by_group,
}
