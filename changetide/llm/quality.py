"""Quality rules: signs of junk within a text, and lines that many documents of a host share.

All of it is DataFrame functions. What a document says about itself is computed in its row. For the
lines, hashes of normalised lines are counted per host over distinct texts, so copies count once;
counts are combined before each shuffle. Lines above the limit are removed, and documents of which too
little is left are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from changetide.llm.common import stored, text_or_empty

#: White space between words, and signs that count as symbols.
SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rules:
    """Limits; the same at every size of the corpus.

    A line is common if more than `line_documents` distinct texts of its host have it, and these are
    more than `line_share` of them or more than `line_many`. The latter is for hosts so large that
    what very many pages share is a small part of them. A document is depleted if less than `left_share` of its words
    remain without its common lines; a line counts as often as the text has it.
    """

    least_words: int = 50
    repeat_percent: int = 50
    line_documents: int = 20
    line_share: float = 0.05
    left_share: float = 0.3
    line_many: int = 10_000


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def bound(value: Column, use) -> Column:
    """`use` with a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that the text has more than once, the first time included.

    Windows are compared by a 64-bit hash. Sorted by it, equal ones are neighbours; in texts without
    repetition that is not needed.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)),
    )

    def starts(ordered: Column) -> Column:
        same = lambda s, k: F.get(ordered, k)["h"].eqNullSafe(s["h"])
        twice = F.filter(ordered, lambda s, k: same(s, k - 1) | same(s, k + 1))
        return F.array_sort(F.transform(twice, lambda s: s["i"]))

    def covered(at: Column) -> Column:
        widths = F.transform(at, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(at, k + 1) - p), F.lit(3)))
        return F.aggregate(widths, F.lit(0), lambda total, w: total + w)

    def count(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = bound(bound(ordered, starts), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bound(windows, count)).cast("long")


def with_signs(docs: DataFrame, rules: Rules, text_column: str = "text") -> DataFrame:
    """Adds the struct `_signs`: text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text_or_empty(text_column)
    # A generator makes text and words once; a plain projection would make them again at each use.
    parts = F.struct(text.alias("_text"), split_words(text).alias("_words"))
    opened = docs.select("*", F.inline(F.array(parts)))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.translate(line, SPACE, "") != "")
    opened = opened.select(
        *docs.columns,
        text_key(F.col("_text")).alias("_key"),
        F.size("_words").cast("long").alias("_n"),
        F.length(F.translate("_text", SPACE, "")).cast("long").alias("_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("_dup"),
        repeated_words(F.col("_words")).alias("_repeat"),
    )
    failed = (F.col("_n") < rules.least_words) | (100 * F.col("_repeat") > rules.repeat_percent * F.col("_n"))
    return opened.select(
        *docs.columns,
        F.struct(
            F.col("_key").alias("text_key"),
            F.col("_n").alias("n_words"),
            F.col("_chars").alias("word_chars"),
            F.col("_symbols").alias("n_symbols"),
            F.col("_dup").alias("n_dup_lines"),
            F.col("_repeat").alias("n_repeat_words"),
            failed.alias("base_failed"),
        ).alias("_signs"),
    )


def normalised(line: Column) -> Column:
    """Lower case, runs of white space as one space, digits as 0."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), _SPACES, " "), "[0-9]", "0"))


def text_lines(docs: DataFrame, host_column: str, text_column: str) -> DataFrame:
    """Distinct lines with a word, by text: host, text_key, line (hash), n_words (of all its occurrences).

    Copies of a text in a host are one row a line; they multiply the words of all its lines alike, so
    shares of them stay. A null host is a host of its own, named ''.
    """
    text = docs.select(
        F.coalesce(F.col(host_column).cast("string"), F.lit("")).alias("host"), text_or_empty(text_column).alias("text")
    )
    lines = text.select("host", text_key(F.col("text")).alias("text_key"), F.explode(F.split("text", "\n", -1)).alias("line"))
    words = F.size(split_words(F.col("line")))
    lines = lines.select("host", "text_key", F.xxhash64(normalised(F.col("line"))).alias("line"), words.alias("words"))
    counted = lines.where(F.col("words") > 0).groupBy("host", "text_key", "line")
    return counted.agg(F.sum("words").alias("n_words"))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def common_lines(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines above the limits: host, line. `lines` has each line of a text once."""
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rules.line_documents)
    hosts = lines.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    above = (F.col("n") > rules.line_share * F.col("texts")) | (F.col("n") > rules.line_many)
    return counts.join(hosts, "host").where(above).select("host", "line")


def depleted_texts(docs: DataFrame, rules: Rules, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """Texts of which too little remains without common lines: host, text_key. Each text once a host.

    A line that a text repeats counts each time, on either side.
    """
    return depleted_by(*line_tables(docs, rules, host_column, text_column), rules)


def line_tables(docs: DataFrame, rules: Rules, host_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """`text_lines` and, of them, `common_lines`, both stored."""
    lines, _ = stored(text_lines(docs, host_column, text_column), "lines")
    common, _ = stored(common_lines(lines, rules), "common")
    return lines, common


def depleted_by(lines: DataFrame, common: DataFrame, rules: Rules) -> DataFrame:
    left = (
        lines.join(common.withColumn("common", F.lit(True)), ["host", "line"], "left")
        .groupBy("host", "text_key")
        .agg(F.sum("n_words").alias("all"), F.sum(F.when(F.col("common"), F.lit(0)).otherwise(F.col("n_words"))).alias("left"))
    )
    # A quotient is the same for any number of copies.
    return left.where(F.col("left") / F.col("all") < rules.left_share).select("host", "text_key")


def remove_common_lines(docs: DataFrame, rules: Rules = Rules(), host_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per id: its text without the lines above the limits (null text: empty; null ids: not included)."""
    named = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(host_column).cast("string"), F.lit("")).alias("host"),
        F.posexplode(F.split(text_or_empty(text_column), "\n", -1)).alias("place", "words"),
    ).withColumn("line", F.xxhash64(normalised(F.col("words"))))
    common = common_lines(text_lines(docs, host_column, text_column), rules)
    kept = named.join(common, ["host", "line"], "left_anti")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda x: x["words"]), "\n")
    return named.select("id").distinct().join(kept.groupBy("id").agg(joined.alias("t")), "id", "left").select(
        F.col("id").alias(id_column), F.coalesce("t", F.lit("")).alias(text_column)
    )


def judge(docs: DataFrame, rules: Rules = Rules(), host_column: str = "source", text_column: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with the structs `_signs` and the boolean `_kept`.

    Kept is what neither fails the base rules nor is depleted by common lines. Null and empty texts
    have no words and fail; a null host is a host of its own; copies and repeated rows are judged
    alike. Columns of `docs` may have any names but those beginning with an underscore used here.
    """
    depleted = depleted_by(*line_tables(docs, rules, host_column, text_column), rules)
    verdicts, _ = stored(depleted.withColumn("_depleted", F.lit(True)), "depleted")
    return judged_by(docs, verdicts, rules, host_column, text_column)


def judged_by(docs: DataFrame, verdicts: DataFrame, rules: Rules, host_column: str, text_column: str) -> DataFrame:
    """`docs` with `_signs`, `_kept` and the columns of `verdicts`: host, text_key, _depleted and maybe more, stored.

    The one move of the texts. It is a merge at every size, so that cost grows in proportion, and as both
    sides are read from storage, Spark splits what a text with very many copies makes skewed.
    """
    signs = with_signs(docs, rules, text_column)
    host = F.coalesce(F.col(host_column).cast("string"), F.lit(""))
    told = verdicts.withColumnsRenamed({"host": "_host", "text_key": "_text_key"}).hint("merge")
    joined = signs.join(told, (host == F.col("_host")) & (F.col("_signs.text_key") == F.col("_text_key")), "left")
    return joined.withColumn("_kept", ~F.col("_signs.base_failed") & F.col("_depleted").isNull())


def quality_rules(docs: DataFrame, rules: Rules = Rules(), id_column: str = "doc_id", host_column: str = "source", text_column: str = "text") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept; see `judge`."""
    only = docs.select(F.col(id_column).alias("id"), F.col(host_column).alias("host"), F.col(text_column).alias("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judge(only, rules, "host", "text").select(
        F.col("id").alias(id_column), *(F.col("_signs")[n].alias(n) for n in names), F.col("_kept").alias("kept")
    )


def keep_good(docs: DataFrame, rules: Rules = Rules(), **columns: str) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged."""
    return judge(docs, rules, **columns).where("_kept").select(*docs.columns)


def clean_good(docs: DataFrame, rules: Rules = Rules(), host_column: str = "source", text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """The rows of `docs` that the rules keep, their texts without the lines above the limits.

    Rows are judged by their whole texts. A column with the length of the text is kept right.
    """
    lines, common = line_tables(docs, rules, host_column, text_column)
    cut = lines.join(common, ["host", "line"]).groupBy("host", "text_key").agg(F.collect_list("line").alias("_lines"))
    depleted = depleted_by(lines, common, rules).withColumn("_depleted", F.lit(True))
    told = depleted.unionByName(cut, allowMissingColumns=True).groupBy("host", "text_key")
    verdicts, _ = stored(told.agg(F.first("_depleted", True).alias("_depleted"), F.first("_lines", True).alias("_lines")), "verdicts")
    joined = judged_by(docs, verdicts, rules, host_column, text_column).where("_kept")
    left = F.filter(
        F.split(text_or_empty(text_column), "\n", -1), lambda x: ~F.array_contains(F.col("_lines"), F.xxhash64(normalised(x)))
    )
    text = F.when(F.col("_lines").isNull(), F.col(text_column)).otherwise(F.array_join(left, "\n"))
    cleaned = joined.withColumn(text_column, text)
    if size_column in docs.columns:
        size = F.when(F.col("_lines").isNull(), F.col(size_column)).otherwise(F.length(text_column))
        cleaned = cleaned.withColumn(size_column, size.cast(docs.schema[size_column].dataType))
    return cleaned.select(*docs.columns)
