"""Quality rules: a threshold table compiled into one Spark projection.

:func:`measures` computes the counts that the rules need with DataFrame
functions only, row by row, without any shuffle. :func:`judge` compiles a table
of (rule, measure, least, most) into one projection of boolean tests; a rule's
failure is listed by name, and a row is kept if its base check passes and no
rule fails.

Null text: no words, so the base check fails. Null doc_id and repeated rows:
each row is judged on its own. Very long texts: measured whole, in one row. Empty
table: no rows. Extra columns are ignored.
Windows of five words are compared by a 64-bit hash, within one text only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import WORD

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20

#: Frequent function words of the four languages.
STOP_WORDS = ("the of and to in a is that for it with as was on are be by this "
              "der die das und ist nicht mit von ein eine zu den auf für sich im "
              "le la les de des et un une est en que pour dans pas sur du "
              "el los las y una por con para se del al no").split()

#: (rule, measure, least, most); None: no bound on that side. One stop word is
#: taken as given, so a short text may do without any.
RULES = (
    ("word_length", "mean_word_length", 2.0, 12.0),
    ("symbols", "symbol_ratio", None, 0.05),
    ("stop_words", "stop_word_ratio", 0.02, None),
    ("repeated_lines", "dup_line_ratio", None, 0.34),
    ("bare_marks", "marked_line_ratio", None, 0.50),
)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts and ratios of every row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
                        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)]))
    counted = words.select(
        "doc_id", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[|*•>-]"))).cast("long").alias("n_marked_lines"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.when(n >= WINDOW, hashes).alias("hashes"))
    # only a text with some window twice needs to know which
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = F.when(twice, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    counted = counted.withColumn("ordered", ordered).drop("hashes")
    met = F.filter("ordered", lambda x, i: (F.get("ordered", i + 1)["h"] == x["h"]) | (F.get("ordered", F.when(i > 0, i - 1))["h"] == x["h"]))
    counted = counted.withColumn("at", F.sort_array(F.transform(met, lambda x: x["i"]))).drop("ordered")
    gaps = F.zip_with("at", F.slice("at", 2, F.size("at")), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    repeated = F.when(F.size("at") > 0, F.aggregate(gaps, F.lit(0), lambda s, x: s + x)).otherwise(0)
    counted = counted.withColumn("n_repeat_words", repeated.cast("long")).drop("at")
    # A one-element inline ends the counting here: a filter on a result (kept, say)
    # stays above it and isn't rewritten into the nested expressions below.
    counted = counted.select(F.inline(F.array(F.struct(*counted.columns))))

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return counted.select("*", share("word_chars", "n_words").alias("mean_word_length"), share("n_symbols", "word_chars").alias("symbol_ratio"),
                          F.when(F.col("n_words") > 0, (F.col("n_stop_words") + 1) / F.col("n_words")).otherwise(0.0).alias("stop_word_ratio"), share("n_dup_lines", "n_lines").alias("dup_line_ratio"),
                          share("n_marked_lines", "n_lines").alias("marked_line_ratio"))


def judge(measured: DataFrame, rules=RULES) -> DataFrame:
    """``measured`` with base_failed, failed_rules and kept."""
    tests = []
    for name, measure, least, most in rules:
        bad = F.lit(False)
        if least is not None:
            bad = bad | (F.col(measure) < least)
        if most is not None:
            bad = bad | (F.col(measure) > most)
        tests.append(F.when(bad, F.lit(name)))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    failed = F.array_compact(F.array(*tests))
    return measured.select("*", base.alias("base_failed"), failed.alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"))


def quality(docs: DataFrame, rules=RULES) -> DataFrame:
    return judge(measures(docs), rules)
