import math
import random
import re

import duckdb
import pytest
from conftest_llm import words
from oracle import connect, difference
from pyspark.sql import functions as F

from depotlens.llm import quality, queries
from depotlens.llm.quality import COMMON_WORDS, RESULTS, judge


def repeated(w):
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({p + k for at in seen.values() if len(at) > 1 for p in at for k in range(3)})


def test_awkward_rows(awkward, texts):
    judged = judge(awkward)
    assert judged.columns == [*awkward.columns, *RESULTS]
    rows = judged.collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]] or ""
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        n = repeated(w)
        failed = len(w) < 50 or 100 * n > 50 * len(w)
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n, failed)
        assert tuple(r[c] for c in RESULTS[:6]) == want, text[:60]
        assert not (failed and r["kept"])


def test_empty_table(nothing):
    assert judge(nothing).count() == 0


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(1)
    common = ["the", "of", "and", "to", "a", "in", "is", "that"]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.2 else f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[rng.randrange(10)]}" for k in range(200)) for _ in range(40)]
    junk = [" ".join(f"X{i}Q{k}!!##" for k in range(150)) for i in range(4)]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + junk)], "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in judge(frame).collect()}
    assert not any(kept[i] for i in range(len(texts), len(texts) + len(junk)))
    assert all(kept[i] for i in range(len(texts)))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None


def test_labels_agree(spark, sf_dir):
    """Documents labelled good that pass the plain rules stay."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.op4_quality_rules(spark, folder).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in found if r["quality"]], [r["kept"] for r in found if not r["quality"]]
    assert sum(good) == len(good) and sum(bad) < 0.3 * len(bad) and not math.isnan(len(bad))


def prose(rng, common, n=200):
    return " ".join(rng.choice(common) if rng.random() < 0.4 else f"wo{rng.choice('abcdef')}{rng.choice('klmnop')}" for _ in range(n))


def test_blank_languages_are_judged_by_the_nearest_reference(spark, sf_dir):
    """The labelled documents' verdicts hardly depend on whether their language is given, nor on that of the others."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    docs = queries.documents(spark, folder).select("doc_id", "text", "lang").join(labels, "doc_id", "left")

    def verdicts(lang):
        judged = judge(docs.withColumn("lang", lang)).where("quality is not null and not base_failed and n_words >= 100")
        return {r["doc_id"]: (r["quality"], r["kept"], r["word_distance"]) for r in judged.collect()}

    given = verdicts(F.col("lang"))
    assert all(kept for quality, kept, _ in given.values() if quality) and len(given) > 100
    for lang in (F.when(F.isnull("quality"), F.col("lang")), F.lit(None).cast("string"), F.lit(" ")):
        blank = verdicts(lang)
        assert blank.keys() == given.keys()
        assert all(kept for quality, kept, _ in blank.values() if quality)
        junk = [i for i, (quality, _, far) in given.items() if not quality and far > 0.27]
        assert sum(blank[i][2] > 0.27 for i in junk) >= 0.9 * len(junk) > 0


def test_unlisted_language_is_not_judged_by_lists_it_does_not_fit(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, COMMON_WORDS[lang]), lang) for i, lang in enumerate(["en", "de"] * 20)]
    rows += [(100 + i, prose(rng, ["ja", "on", "ei", "oli", "joka", "hän"]).replace("on ", "se "), "fi") for i in range(10)]
    rows += [(200 + i, prose(rng, COMMON_WORDS["de"]), "nl") for i in range(10)]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r["kept"] for r in found)
    assert all((r["word_distance"] is None) == (r["lang"] == "fi") for r in found)


def test_no_reference_gives_no_distance(spark):
    rows = [(i, f"{'qx ' * 60}{' '.join(f'z{k}' for k in range(90))}", None) for i in range(3)]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [(r["base_failed"], r["word_distance"], r["kept"]) for r in found] == [(False, None, True)] * 3


@pytest.mark.parametrize("unlisted", [("null", "fr"), ("blank", "en"), ("named", "de"), ("all", None)])
def test_documents_without_a_listed_language_equal_their_sql(spark, tmp_path, unlisted):
    """Languages blanked for some documents, named but not listed, or not known for any document of a language."""
    kind, whole = unlisted
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 3 = 0")
    some = (F.col("doc_id") % 2 == 0) | F.lit(kind == "all") | (F.col("lang") == F.lit(whole))
    other = {"null": F.lit(None).cast("string"), "blank": F.lit("  "), "named": F.lit("xx"), "all": F.lit(None).cast("string")}[kind]
    docs = docs.withColumn("lang", F.when(some, other).otherwise(F.col("lang")))
    docs.coalesce(1).write.parquet(str(tmp_path / "folder"))
    (file,) = (tmp_path / "folder").glob("*.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{file}'")
    got = judge(spark.read.parquet(str(tmp_path / "folder"))).select("doc_id", *RESULTS)
    assert difference(got, con, queries.ORACLES["op4_quality_rules"]) is None


def test_listed_words_and_word_characters_are_counted_without_a_pass_for_each(spark):
    rows = [(1, "de  la\tde xé 9 THE the\n\x0b\U0001f600 de", None), (2, "", "fr"), (3, None, "xx"), (4, "the of the The", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = quality.measure(docs)
    found = {r["doc_id"]: r for r in measured.collect()}
    for doc_id, text, lang in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
        assert found[doc_id]["word_chars"] == sum(map(len, words))
        lists = [quality.COMMON_WORDS[lang]] if lang in quality.COMMON_WORDS else list(quality.COMMON_WORDS.values())
        counts = [[words.count(c) for c in listed] for listed in lists]
        assert found[doc_id]["_common"] == [[*n, len(words) - sum(n)] for n in counts]
    plan = measured._jdf.queryExecution().analyzed().toString()
    assert "array_remove" in plan and r"regexp_replace(_text#, [\x20\x09-\x0D]+" not in re.sub(r"#\d+", "#", plan)
