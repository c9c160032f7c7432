"""Quality rules by distribution divergence, in DataFrame functions only.

A document's characters are counted by class and its words by a short list of its language's common words.
Both histograms are compared with the language's reference by the Jensen-Shannon distance (square root of the
divergence to base 2, so 0 to 1). The reference of a language is the sum over all its documents that pass the
plain rules and both length guards. A distance speaks only above its guard: short texts scatter around the
reference by chance.

A document without a listed language is compared with the reference of every listed one, each over its own
words, and has the smallest distance (for characters also to the sum over all such documents). A language that no
typical document names takes its reference from documents without language most of whose common words are its own.
Where ``lang`` is null or blank the smallest word distance decides; a language that is named but not listed is not
rejected by it: above the limit the word distance is null. Without any reference a distance is null, too.

Plain rules: fewer than ``min_words`` words fail, and so do texts more than half of whose words stand in
three-word windows that the text repeats. A null text counts as empty and fails. Repeated rows are documents
of their own, an empty table gives no rows, columns named like a result are replaced, others kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.literals import GAP, words_of
from depotlens.llm.names import keeps_columns
from depotlens.session import materialize

#: Sixteen of the commonest words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "una"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
}
OTHER = "other"
#: What is left of a text after taking out a class, from the most common class on; the rest is the last class.
CLASSES = {"lower": "[a-z]+", "space": GAP, "upper": "[A-Z]+", "digit": "[0-9]+", "beyond": r"[^\x00-\x7F]+"}
SPACE = list(CLASSES).index("space")
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "char_distance", "word_distance", "kept",
)


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    most_repeated_percent: int = 50
    #: The largest distances that pass, and the lengths from which they count.
    char_distance: float = 0.30
    char_guard: int = 300
    word_distance: float = 0.27
    word_guard: int = 100


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and wherever the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, size: int = 3) -> Column:
    """The number of words under ``size``-word windows found twice or more in the list."""

    def windows(w: Column) -> Column:
        last = F.size(w) - size
        return F.transform(
            F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(size)]).alias("h"), i.alias("i")),
        )

    def repeated(s: Column) -> Column:
        def mark(x: Column, k: Column) -> Column:
            near = [F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]]
            return F.when((near[0] == x["h"]) | (near[1] == x["h"]), x["i"])

        return F.sort_array(F.array_compact(F.transform(s, mark)))

    def covered(p: Column) -> Column:
        reach = F.transform(p, lambda i, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - i, F.lit(size))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    # Without an equal pair of hashes there is nothing to sort.
    def count(t: Column) -> Column:
        same = F.size(F.array_distinct(F.transform(t, lambda x: x["h"]))) == F.size(t)
        return F.when(same, F.lit(0)).otherwise(let(F.sort_array(t), lambda s: let(repeated(s), covered)))

    return let(let(words, windows), count).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """The documents with the base figures and their histograms (``_chars``, ``_common``, ``_group``).

    ``_common`` has a histogram by the words of the document's language, or one by each list in their order.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    group = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(F.lit(OTHER))
    rows = docs.withColumns({"_text": text, "_words": words_of(text), "_group": group})
    # Each class is taken out of what the one before has left; the lengths between tell the counts.
    left, lengths = F.col("_text"), [F.char_length("_text")]
    for pattern in CLASSES.values():
        left = F.regexp_replace(left, pattern, "")
        lengths.append(F.char_length(left))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    vocabulary = sorted({w for words in COMMON_WORDS.values() for w in words})
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            # Classes have no character in common, so what is left without lower case has all the gaps.
            "word_chars": (lengths[0] - lengths[SPACE] + lengths[SPACE + 1]).cast("long"),
            "n_symbols": F.char_length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "_lengths": F.array(*lengths),
            "_hits": F.filter("_words", lambda w: w.isin(*vocabulary)),
        }
    )
    steps = [F.get("_lengths", F.lit(i)) - F.get("_lengths", F.lit(i + 1)) for i in range(len(CLASSES))]
    listed = F.array(*[F.lit(words) for words in COMMON_WORDS.values()])
    for name, words in COMMON_WORDS.items():
        listed = F.when(F.col("_group") == name, F.array(F.lit(words))).otherwise(listed)
    times = lambda c: F.size("_hits") - F.size(F.array_remove("_hits", c))
    found = F.transform(listed, lambda words: F.transform(words, times))
    rest = lambda n: F.col("n_words").cast("int") - F.aggregate(n, F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("_found", found).withColumns(
        {
            "_chars": F.array(*steps, F.get("_lengths", F.lit(len(CLASSES)))).cast("array<long>"),
            "_common": F.transform("_found", lambda n: F.concat(n, F.array(rest(n)))).cast("array<array<long>>"),
        }
    )
    return rows.drop("_text", "_words", "_lengths", "_hits", "_found")


def distance(p: Column, q: Column) -> Column:
    """The Jensen-Shannon distance of two histograms; null where either is null or empty."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b).cast("double")
    share = lambda x: let(total(x), lambda t: F.transform(x, lambda v: v / F.when(t > 0, t)))

    def part(x: Column, y: Column) -> Column:
        side = lambda v: F.when(v > 0, v * F.log2(v * 2 / (x + y)) / 2).otherwise(F.lit(0.0))
        return side(x) + side(y)

    between = F.aggregate(F.zip_with(share(p), share(q), part), F.lit(0.0), lambda a, b: a + b)
    # greatest() would make 0 of a null.
    return let(between, lambda b: F.sqrt(F.when(b < 0, F.lit(0.0)).otherwise(b)))


def references(typical: DataFrame) -> DataFrame:
    """Per ``_group`` the histograms to compare with: ``ref_chars`` and ``ref_common``, which goes by ``_common``."""
    names, size = list(COMMON_WORDS), len(next(iter(COMMON_WORDS.values()))) + 1
    other, blank = F.col("_group") == OTHER, F.trim(F.coalesce("lang", F.lit(""))) == ""
    hits = lambda h, i: F.struct((F.col("n_words") - F.get(h, F.lit(size - 1))).alias("hits"), (-i).alias("i"))
    most = F.array_max(F.transform("_common", hits))
    at = F.when(~other, F.lit(0)).when(blank & (most["hits"] > 0), -most["i"])
    typical = typical.withColumn("_at", at).withColumn("_found", F.get("_common", F.col("_at")))
    name = F.when(other, F.get(F.lit(names), F.col("_at"))).otherwise(F.col("_group"))
    total = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)])
    sums = typical.groupBy("_group", name.alias("name")).agg(
        total("_chars", len(CLASSES) + 1).alias("chars"), total("_found", size).alias("common")
    )  # at most nine rows: one per list, and those without a listed language by list or none

    entries = lambda which: F.map_from_entries(F.collect_list(F.when(which, F.struct("name", F.struct("chars", "common")))))
    pool = F.transform(F.col("chars"), lambda v: F.when(other, v))
    one = sums.withColumn("pool", pool).agg(
        entries(~other).alias("named"), entries(other & F.isnotnull("name")).alias("guessed"), total("pool", len(CLASSES) + 1).alias("pool")
    )
    own = lambda n: F.try_element_at("named", n)
    every = F.transform(F.lit(names), lambda n: F.coalesce(own(n), F.try_element_at("guessed", n)))
    groups = one.select("*", F.explode(F.lit([*names, OTHER])).alias("_group"))
    groups = groups.withColumn("refs", F.when(other, every).otherwise(F.array(own(F.col("_group")))))
    part = lambda c: F.transform("refs", lambda r: r[c])
    chars = F.when(other, F.concat(part("chars"), F.array("pool"))).otherwise(part("chars"))
    return groups.select("_group", chars.alias("ref_chars"), part("common").alias("ref_common"))


@keeps_columns(("text", "lang"), RESULTS)
def judge(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents with the base figures, ``base_failed``, both distances and the verdict ``kept``."""
    repeated = 100 * F.col("n_repeat_words") > rules.most_repeated_percent * F.col("n_words")
    measured = measure(docs).withColumn("base_failed", (F.col("n_words") < rules.min_words) | repeated)
    measured = materialize(measured, "quality")

    n_chars = F.aggregate("_chars", F.lit(0).cast("long"), lambda a, b: a + b)
    speaks = {"char": n_chars >= rules.char_guard, "word": F.col("n_words") >= rules.word_guard}
    typical = measured.where(~F.col("base_failed") & speaks["char"] & speaks["word"])
    joined = measured.join(F.broadcast(references(typical)), "_group", "left")  # one row per list and one for the others
    by_chars = F.array_min(F.transform("ref_chars", lambda q: distance(F.col("_chars"), q)))
    by_words = F.array_min(F.zip_with("_common", "ref_common", distance))
    joined = joined.withColumns(
        {
            "char_distance": F.when(speaks["char"], F.round(by_chars, 6)),
            "word_distance": F.when(speaks["word"], F.round(by_words, 6)),
        }
    )
    unlisted = (F.col("_group") == OTHER) & (F.trim(F.coalesce("lang", F.lit(""))) != "")
    silent = unlisted & (F.col("word_distance") > rules.word_distance)
    joined = joined.withColumn("word_distance", F.when(F.coalesce(~silent, F.lit(True)), F.col("word_distance")))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= rules.char_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= rules.word_distance
    )
    return joined.withColumn("kept", ~F.col("base_failed") & near).select(*docs.columns, *RESULTS)
