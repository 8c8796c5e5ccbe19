"""NULLs, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomset.llm import decontaminate, language, licenses, pieces, pii, quality, quality_rules, repeats, simhash, warc
from loomset.llm.queries import model_bytes

SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Columns that operators use inside, or give back themselves.
CLASHES = (
    "key", "fp", "score", "Kept", "n_words", "n_removed", "ids", "d", "k", "m", "n", "root", "cuts",
    "text_key", "quality_score", "lang_pred", "pii_spans", "word", "place", "a.b",
)
PROSE = "the quick brown fox jumps over the lazy dog while twelve other animals look on and wonder why"
LONG = " ".join(f"w{i % 4001}x" for i in range(60_000))
ROWS = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (1, PROSE + " twice", "en", "a"),
    (2, None, None, None),
    (None, PROSE, None, "a"),
    (None, None, None, None),
    (3, "", "en", ""),
    (4, " \n\t \n", "en", "b"),
    (5, LONG, "en", "b"),
    (6, "x" * 200_000, "fr", "b"),
    (7, "!!! ??? 12", "fr", None),
]


@pytest.fixture(params=["rows", "empty", "clash"])
def docs(request, spark):
    df = spark.createDataFrame([] if request.param == "empty" else ROWS, SCHEMA).repartition(3)
    if request.param == "clash":
        for name in CLASHES:
            df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture()
def items(spark):
    rows = [(1, PROSE), (2, None), (3, ""), (None, PROSE), (4, "lazy dog")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture()
def labels(spark):
    rows = [(1, 1), (1, 1), (5, 0), (6, None), (None, 1), (9, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_decontamination(docs, items):
    found = decontaminate.contamination(docs, items)
    assert found.count() == docs.count()
    for r in found.collect():
        # two windows of the first item's words are one stretch
        if r.n_words in (18, 19):
            assert (r.n_hit, r.item_ids) == (18, ["1", "4"])
        else:
            assert (r.n_hit, r.item_ids) == (0, [])
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert left.count() == max(0, docs.count() - 4)


def test_decontamination_without_items(docs, items):
    found = decontaminate.contamination(docs, items.limit(0))
    assert found.agg(F.sum("n_hit")).first()[0] in (0, None)
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_licenses(docs):
    found = licenses.scan(docs)
    assert found.count() == docs.count()
    assert found.filter("n_base > 0 or score > 0 or first_word is not null").count() == 0
    assert found.filter("n_words is null or labels is null").count() == 0


def test_pieces(docs):
    coded = pieces.encode(docs, model_bytes())
    assert coded.count() == docs.count()
    assert coded.filter("text is null and (ids is not null or n_pieces <> 0)").count() == 0
    assert coded.filter("text is not null and not round_trip").count() == 0
    back = pieces.decode(coded, model_bytes())
    assert back.filter("not (decoded <=> text)").count() == 0


def test_repeats(docs):
    done = repeats.remove_repeats(docs)
    assert done.count() == docs.count()
    for r in done.collect():
        words = (r.text or "").split()
        assert r.n_words == len(words)
        assert r.n_removed == 0 and r.kept == " ".join(words)


def test_quality_rules(docs):
    done = quality_rules.judge(docs)
    assert done.count() == docs.count()
    assert done.filter("kept is null or base_failed is null").count() == 0
    assert done.filter("n_words < 20 and kept").count() == 0


def test_simhash(docs):
    found = _rows(simhash.near_duplicates(docs))
    assert len(found) == docs.count()
    zero = [r for r in found if r[1] == "0" * 16]
    # NULL, empty and blank texts have no word
    assert {r[2] for r in zero} <= {2} and len(zero) in (0, 4)
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    # two texts of one doc_id are two groups, though they share the smallest doc_id
    assert left.count() == len({r[1] for r in found})


def test_pii(docs):
    found = pii.spans(docs)
    assert found.count() == docs.count()
    assert found.filter("size(base) > 0 or size(terms) > 0").count() == 0
    assert _rows(pii.sanitise(docs)) == _rows(docs)


def test_language(docs):
    found = language.identify(docs.drop("lang"), language.fit(docs))
    assert found.count() == docs.count()
    for r in found.collect():
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has_letter)
        assert 0 <= r.score <= 1


def test_quality(docs, labels):
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    scored = quality.score(docs, quality.fit(docs, labels))
    assert scored.count() == docs.count()
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0


def test_quality_without_labels(docs, labels):
    model = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, model).collect()} <= {0.5}


def test_warc(docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"), F.lit(1).alias("sha"))
    read = warc.read_archives(warc.write_archives(pages))
    assert read.filter("error is not null").count() == 0
    assert read.count() == docs.count()
    want = pages.select("page_id", F.octet_length(F.coalesce("html", F.lit(""))).cast("bigint"), F.sha1(F.coalesce("html", F.lit(""))))
    assert _rows(read.select("page_id", "payload_bytes", "payload_digest")) == _rows(want)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, docs, items, labels, stage, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    mine = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    assert stage(spark, mine, str(tmp_path)).columns == mine.columns
