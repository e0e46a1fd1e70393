"""Quality rules with adaptive thresholds.

Instead of fixed cutoffs, each rule's limit is taken from the corpus itself: every
rule value goes into a mergeable quantile sketch (counts of logarithmic buckets, relative
error ``SKETCH_ERROR``) of its (lang, source) group. Sketches merge by adding counts,
so the same rows also give the sketches of a language and of the corpus, which serve
groups of fewer than ``MIN_DOCS`` documents. A group's limit lies ``SPREADS`` times its
spread above the median. The spread is the distance from median to 90th percentile, but at
most a multiple of the distances to lower percentiles (``LEVELS``): where bad documents,
up to 40% of a group, hold the upper ones, these bound it. Rules are mostly zero in clean
groups, so the limit lies at least as far above the median as chance moves a document of
the group's median size (1 / sqrt of its words or lines: two standard deviations of a
share). No group's limit exceeds its language's. The limits are joined back and filter the
documents.

Defined cases: null text has no words; a null lang or source is a group of its own;
an empty table gives an empty result; repeated rows are judged alike; other columns
pass through ``filter_documents`` unchanged.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloss.llm.common import WS, materialize, maybe_broadcast, null_safe, sliced

AT_ONCE = 1 << 20  # bytes of text that a task holds as Python strings, unless one text is longer
SKETCH_ERROR = 0.02
MIN_DOCS = 200
SPREADS = 6.0
#: Percentile: how often its distance from the median bounds the spread (long-tailed clean values stay below).
LEVELS = {0.9: 1.0, 0.75: 3.0, 0.6: 10.0}
SYMBOLS = "#*$%&|<>"
#: Rule name: (numerator, denominator).
RULES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
}
SIZES = ("n_words", "n_lines")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Counts of one whole text, in the order of MEASURES."""
    if not text:
        return (0, 0, 0, 0, 0, 0)
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip(WS)]
    repeated = 0
    if n >= 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            found, end = Counter(windows), 0
            for i, w in enumerate(windows):
                if found[w] > 1:
                    repeated += i + 5 - max(i, end)
                    end = i + 5
    return (
        n,
        len(text) - sum(map(text.count, WS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
    )


def measured_texts(texts: pa.Array) -> pa.Array:
    """The counts of every text, as structs."""
    found = [[] for _ in MEASURES.split(", ")]
    for part in sliced(pa.RecordBatch.from_arrays([texts], ["text"]), AT_ONCE):
        for counts in map(measure, part.column(0).to_pylist()):
            for held, n in zip(found, counts):
                held.append(n)
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], [c.split()[0] for c in MEASURES.split(", ")])


def measures(column: str = "text") -> Column:
    """The counts of a text column, as a struct.

    Marked nondeterministic so that no filter on the counts is pushed below them: it would
    work them out a second time, in a second Python worker of every task.
    """

    @F.arrow_udf(MEASURES)
    def run(texts: pa.Array) -> pa.Array:
        return measured_texts(texts)

    return run.asNondeterministic()(F.col(column).cast("string"))


def rule_value(rule: str):
    top, below = (F.col(f"_m.{c}") for c in RULES[rule])
    return F.when(below > 0, top / below).otherwise(F.lit(0.0))


def sketches(measured: DataFrame) -> DataFrame:
    """Rows (lang, source, rule, bucket, n): the sketch of every group; bucket null is the value zero."""
    gamma = (1 + SKETCH_ERROR) / (1 - SKETCH_ERROR)
    each = {**{r: rule_value(r) for r in RULES}, **{c: F.col(f"_m.{c}").cast("double") for c in SIZES}}
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), v.alias("v")) for r, v in each.items()])).alias("x")
    return (
        measured.where(F.col("_m.n_words") > 0)
        .select("lang", "source", values)
        .select("lang", "source", "x.rule", F.when(F.col("x.v") > 0, F.ceil(F.log(gamma, "x.v"))).cast("int").alias("bucket"))
        .groupBy("lang", "source", "rule", "bucket")
        .agg(F.count("*").alias("n"))
    )


def limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys..., rule, docs, limit) from the sketches merged over ``keys``."""
    gamma = (1 + SKETCH_ERROR) / (1 - SKETCH_ERROR)
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")  # bounded by the number of buckets
    ranked = merged.select(
        *keys, "rule", "bucket", "n",
        F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first())).alias("upto"), F.sum("n").over(group).alias("docs"),
    )

    def at(q: float) -> Column:
        """The quantile, by its rank inside its bucket."""
        part = F.greatest((q * F.col("docs") - F.col("upto") + F.col("n")) / F.col("n"), F.lit(0.0))
        value = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(gamma), F.col("bucket") - 1 + part))
        return F.min(F.when(F.col("upto") >= q * F.col("docs"), value))

    found = ranked.groupBy(*keys, "rule").agg(
        F.max("docs").alias("docs"), at(0.5).alias("mid"), *[at(q).alias(f"q{q:g}".replace(".", "_")) for q in LEVELS],
        F.min(F.when(F.col("upto") >= 0.5 * F.col("docs"), F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(gamma), "bucket")))).alias("edge"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))  # a row a rule and size
    sizes = {c: F.greatest(F.max(F.when(F.col("rule") == c, F.col("mid"))).over(whole), F.lit(1.0)) for c in SIZES}
    spread = F.least(*[times * (F.col(f"q{q:g}".replace(".", "_")) - F.col("mid")) for q, times in LEVELS.items()])
    below = F.when(F.col("rule") == "duplicate_lines", sizes["n_lines"]).otherwise(sizes["n_words"])
    chance = F.when(F.col("rule") == "chars_per_word", F.col("mid")).otherwise(F.lit(1.0)) / F.sqrt(below)
    limit = F.greatest(F.col("mid") + F.greatest(SPREADS * spread, chance), F.col("edge"))  # the median itself always passes
    return found.select(*keys, "rule", "docs", limit.alias("limit")).where(F.col("rule").isin(*RULES))


def thresholds(measured: DataFrame) -> DataFrame:
    """One row (lang, source, limits: map of rule to limit) for each group with words."""
    sketch = materialize(sketches(measured.select("lang", "source", "_m")), "sketches")
    own, lang, whole = (limits(sketch, k) for k in (["lang", "source"], ["lang"], []))
    lang = lang.select("lang", "rule", F.col("docs").alias("lang_docs"), F.col("limit").alias("lang_limit"))
    whole = whole.select("rule", F.col("limit").alias("whole_limit"))
    joined = null_safe(own, lang, ["lang", "rule"]).join(F.broadcast(whole), "rule")  # one row a rule
    chosen = F.when(F.col("docs") >= MIN_DOCS, F.least("limit", "lang_limit")).when(F.col("lang_docs") >= MIN_DOCS, F.col("lang_limit")).otherwise(F.col("whole_limit"))
    pairs = joined.groupBy("lang", "source").agg(F.collect_list(F.struct("rule", chosen.alias("limit"))).alias("x"))  # one entry a rule
    return pairs.select("lang", "source", F.map_from_entries("x").alias("limits"))


def judge(measured: DataFrame, limit: DataFrame) -> DataFrame:
    """Add base_failed and kept to rows that hold lang, source and the measures in _m."""
    base = (F.col("_m.n_words") < 10) | (100 * F.col("_m.n_repeat_words") > 20 * F.col("_m.n_words"))
    high = F.lit(False)
    for r in RULES:
        high = high | F.coalesce(rule_value(r) > F.col("limits")[r], F.lit(False))
    renamed = measured.withColumns({"base_failed": base})
    joined = null_safe(renamed, maybe_broadcast(limit), ["lang", "source"], "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~high).drop("limits")


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, measures (_m), base_failed, kept."""
    measured = materialize(docs.select("doc_id", "lang", "source", measures().alias("_m")), "measures")
    return judge(measured, thresholds(measured))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their columns.

    The texts are measured a second time where they lie rather than shuffled to a
    join with the first pass's result.
    """
    limit = materialize(thresholds(docs.select("lang", "source", measures().alias("_m"))), "limits")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    measured = docs.select(row.alias("_row"), "lang", "source", measures().alias("_m"))
    return judge(measured, limit).where("kept").select("_row.*")
