"""Quality rules with the frequency of lines across the documents of a host.

Built-in functions only. A word is a run of characters other than 0x20 and 0x09-0x0D.

Base rules, per document: too few words, or too many words in repeated 3-word windows.
Line rule: lines are normalised (A-Z folded, white space runs to one space, trimmed) and
hashed; a line that more than ``enough_docs`` distinct documents of a host hold is
removed there, however large the host. With ``least_docs`` below that, a line of a small
host also goes if more than ``least_docs`` documents and more than ``percent`` percent of
the host's hold it. Exact copies of a text count as one document, so a clean page is not
lost for having been copied. A document that would lose more than ``most_lost`` percent
of its words is depleted and rejected.

One pass over the texts takes the features and, of every line with a word, its hash and its
number of words; both are a written table. All that follows works on narrow rows: the lines
of distinct texts, counted by (host, line), joined with the frequent ones on both columns
and added up by (host, hash of the text). The joins are many-to-one, and Spark can split
them for a hot line, host or text. Texts are only touched again where a line has to go.

Defined cases: null text has no words and fails the base rules; null host is a host of
its own; lines without a word are never counted or removed; a null or repeated doc_id
changes nothing, every row is judged by itself. Extra columns pass through; those named
like the added ones are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.plans.scratch import scratch_dir

SEPARATORS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

LEAST_DOCS, PERCENT, MOST_LOST = 10, 10, 50
ENOUGH_DOCS = 10
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Texts with a frequent line, and such lines in all of them, that may be broadcast: about 64 MB.
MOST_TEXTS, MOST_TEXT_LINES = 500_000, 2_000_000


def words_of(text: Column) -> Column:
    """The words of a non-null text."""
    return F.filter(F.split(text, SEPARATORS), lambda w: w != "")


def normalised_line(line: Column) -> Column:
    folded = F.translate(line, UPPER, LOWER)
    return F.trim(F.regexp_replace(folded, SEPARATORS, " "))


def lines_of(text: Column) -> Column:
    """Hash and number of words of each line with a word, in order."""
    # folded as a whole, which is one call per text; line ends stay
    folded = F.regexp_replace(F.translate(text, UPPER, LOWER), "[\\x20\\x09\\x0B-\\x0D]+", " ")
    lines = F.filter(F.transform(F.split(folded, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    # words are one space apart
    n_words = lambda x: F.length(x) - F.length(F.translate(x, " ", "")) + 1
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), n_words(x).alias("words")))


def covered_words(windows: Column, n: Column) -> Column:
    """How many word positions lie in a window whose hash occurs twice or more.

    ``windows``: hash of the 3-word window at each position; ``n``: their number. The
    (hash, position) pairs are sorted, so equal windows are neighbours; the sorted
    positions of those then cover min(3, distance to the next) words each.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # compare each pair with its neighbours by zipping shifted arrays
    hash_only = F.transform(placed, lambda p: p["h"])
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice(hash_only, 1, F.greatest(n - 1, F.lit(0))))
    after = F.concat(F.slice(hash_only, 2, F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast("long")))
    marked = F.filter(
        F.arrays_zip(placed.alias("p"), before.alias("b"), after.alias("a")),
        lambda z: F.coalesce(z["p"]["h"] == z["b"], F.lit(False)) | F.coalesce(z["p"]["h"] == z["a"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(marked, lambda z: z["p"]["i"]))
    ended = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return ended.cast("long")


def with_base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the base features and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.drop(*FEATURES, "base_failed").withColumn("__text", text).withColumn("__words", words_of(F.col("__text")))
    w = F.col("__words")
    last = F.size(w) - 3
    tri = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(1), last + 1),
            lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.regexp_replace(x, SEPARATORS, "") != "")
    df = (
        df.withColumn("__windows", tri)
        .withColumn("__lines", lines)
        .withColumn("n_words", F.size(w).cast("long"))
    )
    t = F.col("__text")
    windows = F.col("__windows")
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    df = (
        df.withColumn("word_chars", F.length(F.regexp_replace(t, SEPARATORS, "")).cast("long"))
        .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
        .withColumn(
            "n_dup_lines",
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        )
        .withColumn(
            "n_repeat_words",
            F.when(repeated, covered_words(windows, F.size(windows))).otherwise(F.lit(0).cast("long")),
        )
    )
    return df.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    ).drop("__text", "__words", "__windows", "__lines")


def _host_and_copy(docs: DataFrame, host: str) -> list[Column]:
    return [F.col(host).alias("__host"), F.xxhash64("text").alias("__copy")]


def _measured(docs: DataFrame, host: str, carry: list[str]) -> DataFrame:
    """``carry`` in a struct, the base features, host, hash of the text and its lines, written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*(docs[c] for c in carry)).alias("__row"), "text", *_host_and_copy(docs, host), lines_of(text).alias("__lines_in")
    )
    return _staged(with_base_rules(rows).drop("text"), "measured-lines")


def _line_rows(measured: DataFrame) -> DataFrame:
    """(host, copy, nth, line, words): the lines of each distinct text of a host."""
    return measured.select(
        F.col("__host").alias("host"), F.col("__copy").alias("copy"), F.posexplode("__lines_in").alias("nth", "r")
    ).select("host", "copy", "nth", "r.line", "r.words").distinct()


def _frequent(
    lines: DataFrame, texts: DataFrame, least_docs: int, percent: int, enough_docs: int
) -> DataFrame:
    counted = lines.select("host", "copy", "line").distinct().groupBy("host", "line").agg(F.count("*").alias("docs"))
    counted = counted.where(F.col("docs") > min(least_docs, enough_docs))
    if enough_docs <= least_docs:  # the share adds nothing
        return counted.select("host", "line")
    total = texts.groupBy("host").agg(F.count_distinct("copy").alias("all_docs"))
    share = (F.col("docs") > least_docs) & (F.col("docs") * 100 > F.col("all_docs") * percent)
    return (
        counted.join(total, counted["host"].eqNullSafe(total["host"]))
        .where((F.col("docs") > enough_docs) | share)
        .select(counted["host"].alias("host"), "line")
    )


def frequent_lines(
    docs: DataFrame,
    host: str = "source",
    least_docs: int = LEAST_DOCS,
    percent: int = PERCENT,
    enough_docs: int = ENOUGH_DOCS,
) -> DataFrame:
    """(host, line): the hashes of lines that too many of a host's documents hold."""
    lines = lines_of(F.coalesce(F.col("text"), F.lit(""))).alias("__lines_in")
    rows = docs.select(*_host_and_copy(docs, host), lines)
    texts = rows.select(F.col("__host").alias("host"), F.col("__copy").alias("copy"))
    return _frequent(_line_rows(rows), texts, least_docs, percent, enough_docs)


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, so that its size is known when it is joined."""
    folder = scratch_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _judged(
    docs: DataFrame, host: str, least_docs: int, percent: int, most_lost: int, enough_docs: int, carry: list[str]
) -> DataFrame:
    """``carry`` in a struct, features, base_failed, removed_words, kept and the frequent lines held."""
    measured = _measured(docs, host, carry)
    lines = _staged(_line_rows(measured), "lines")
    texts = measured.select(F.col("__host").alias("host"), F.col("__copy").alias("copy"))
    often = _staged(_frequent(lines, texts, least_docs, percent, enough_docs), "frequent-lines")
    often = often.select(F.col("host").alias("__often_host"), F.col("line").alias("__often_line"))
    found = _staged(
        lines.join(often, lines["host"].eqNullSafe(F.col("__often_host")) & (lines["line"] == F.col("__often_line")))
        .groupBy(F.col("host").alias("__in_host"), F.col("copy").alias("__in_copy"))
        .agg(F.sum("words").cast("long").alias("removed"), F.collect_set("line").alias("__cut")),
        "frequent-by-text",
    )
    size = found.agg(F.count("*").alias("texts"), F.sum(F.size("__cut")).alias("lines")).first()
    if size["texts"] <= MOST_TEXTS and (size["lines"] or 0) <= MOST_TEXT_LINES:
        found = F.broadcast(found)
    same = F.col("__host").eqNullSafe(F.col("__in_host")) & (F.col("__copy") == F.col("__in_copy"))
    removed = F.coalesce("removed", F.lit(0).cast("long"))
    return measured.drop("__lines_in").join(found, same, "left").select(
        "__row",
        *FEATURES,
        "base_failed",
        removed.alias("removed_words"),
        (~F.col("base_failed") & (removed * 100 <= F.col("n_words") * most_lost)).alias("kept"),
        "__cut",
    )


def _clean_text() -> Column:
    text, cut = F.col("__row")["text"], F.col("__cut")
    keeps = lambda x: ~F.array_contains(cut, F.xxhash64(normalised_line(x))) | (normalised_line(x) == "")
    return F.when(cut.isNotNull(), F.array_join(F.filter(F.split(text, "\n"), keeps), "\n")).otherwise(text)


def verdicts(
    docs: DataFrame,
    carry: list[str],
    host: str = "source",
    least_docs: int = LEAST_DOCS,
    percent: int = PERCENT,
    most_lost: int = MOST_LOST,
    enough_docs: int = ENOUGH_DOCS,
) -> DataFrame:
    """Per row of ``docs`` the columns ``carry``, the base features, base_failed, removed_words and kept."""
    judged = _judged(docs, host, least_docs, percent, most_lost, enough_docs, carry)
    return judged.select(*(F.col("__row")[c].alias(c) for c in carry), *FEATURES, "base_failed", "removed_words", "kept")


def judge(
    docs: DataFrame,
    host: str = "source",
    least_docs: int = LEAST_DOCS,
    percent: int = PERCENT,
    most_lost: int = MOST_LOST,
    enough_docs: int = ENOUGH_DOCS,
) -> DataFrame:
    """``docs`` with the base features, base_failed, removed_words, clean_text and kept."""
    added = [*FEATURES, "base_failed", "removed_words", "clean_text", "kept"]
    judged = _judged(docs, host, least_docs, percent, most_lost, enough_docs, docs.columns)
    judged = judged.withColumn("clean_text", _clean_text())
    return judged.select(*(F.col("__row")[c].alias(c) for c in docs.columns if c not in added), *added)


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept documents with the frequent lines cut from their text; n_chars follows."""
    judged = _judged(docs, "source", LEAST_DOCS, PERCENT, MOST_LOST, ENOUGH_DOCS, docs.columns)
    kept = judged.where("kept").withColumn("clean_text", _clean_text())
    new = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*((new[c] if c in new else F.col("__row")[c]).alias(c) for c in docs.columns))
