"""Physical plans: what must not be in them, and streaming use."""

from pyspark.sql import functions as F

from verify.queries import QUERIES
from loomset import (
    ReadOptions,
    accepted,
    corpus_text,
    format_examples,
    load_text_corpus,
    to_chat_messages,
    to_preference_examples,
)
from loomset.plans.datasets import _transformed, corpus_recipe
from loomset.sources import write_split_table

SF_DIR = "/root/testdata/sf0.001"
PYTHON_ON_PURPOSE = {"render_with_template_fn"}
#: The parse of a line, as plans show it.
PARSE = "from_json(VariantType"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_queries_stay_in_the_jvm(spark):
    found = {name for name, query in QUERIES.items() if "EvalPython" in plan(query(spark, SF_DIR))}
    assert found == PYTHON_ON_PURPOSE


def test_row_operators_need_no_shuffle(spark, json_rows):
    rows = json_rows({"prompt": "p", "completion": "c"})
    for df in (accepted(format_examples(rows)), accepted(corpus_text(rows)), accepted(to_chat_messages(rows, "S"))):
        text = plan(df)
        assert "Exchange" not in text
        assert text.count(PARSE) == 1


def test_typed_tables_read_only_the_columns_they_need(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select(
        F.lit("p").alias("prompt"), F.lit("c").alias("completion"), F.lit("x").alias("other")
    ).write.parquet(path)
    text = plan(accepted(format_examples(spark.read.parquet(path))).select("text"))
    assert "ReadSchema: struct<prompt:string,completion:string>" in text


def test_each_side_reads_its_own_file(spark, tmp_path):
    paths = [tmp_path / name for name in ("train.jsonl", "eval.jsonl")]
    for path in paths:
        path.write_text('{"text":"a"}\n')
    data = load_text_corpus(spark, str(paths[0]), eval_path=str(paths[1]))
    for part, path in zip(data, paths):
        assert plan(part).count("FileScan") == 1
        assert [f.rsplit("/", 1)[1] for f in part.inputFiles()] == [path.name]


def test_generated_methods_are_short_enough_for_the_jit(spark, json_rows):
    """HotSpot never compiles a method of more than 8,000 bytes."""
    debug = spark._jvm.org.apache.spark.sql.execution.debug.package
    rows = json_rows({"prompt": "p", "completion": "c"})
    for df in (format_examples(rows), to_preference_examples(rows), corpus_text(rows)):
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert sizes and max(sizes) < 8000


def test_row_operators_work_on_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"prompt":"P","completion":"C"}\n{"foo":1}\n')
    lines = spark.readStream.text(str(source))
    query = (
        accepted(format_examples(lines)).select("text")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(120)
    got = [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == ["<|im_start|>user\nP<|im_end|>\n<|im_start|>assistant\nC<|im_end|>"]


def test_the_key_comes_from_the_one_parse(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"text":"a","id":1}\n{"text":"b","id":2}\n')
    rows = _transformed(spark, corpus_recipe(), str(path), ReadOptions(key_field="id"), seed=42)
    text = plan(rows)
    assert text.count(PARSE) == 1 and "get_json_object" not in text


def test_writing_by_split_needs_no_sort(spark, tmp_path):
    seen = []
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    df = spark.range(10).selectExpr("id", "if(id % 2 = 0, 'train', 'eval') as split")
    write_split_table(df, str(tmp_path / "t"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    store = spark._jsparkSession.sharedState().statusStore()
    last = store.executionsList(max(0, store.executionsCount() - 1), 1).head()
    seen.append(last.physicalPlanDescription())
    assert "Sort" not in seen[0] and "InsertIntoHadoopFs" in seen[0]
