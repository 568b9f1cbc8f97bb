"""Quality rules with cross-document line frequency. DataFrame functions only.

Lines are lower-cased, their blanks and digits made alike, and hashed. For each host a line's documents are counted, copies of one
text once, as else a text with some copies in its host would be taken for boilerplate as a whole and all of its copies go. A line in more
documents than the limits allow is boilerplate and is taken out of the texts. A document that keeps too few words or too small a part of them
is depleted and rejected, as is one that fails the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANK, WORD, stored

_BLANKS = " \t\n\x0b\x0c\r"


def _bind(value: Column, body) -> Column:
    """body of value, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(hashes: Column, width: int) -> Column:
    """Words inside the windows, given by the hashes of all windows in order, that occur twice or more."""

    def count(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            alike = lambda i, j: s[i]["h"] == F.try_element_at(s, j + 1)["h"]
            again = F.filter(s, lambda x, i: F.coalesce(alike(i, i + 1), F.lit(False)) | ((i > 0) & F.coalesce(alike(i, F.greatest(i - 1, F.lit(0))), F.lit(False))))
            state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            step = lambda a, p: F.struct((p + width).alias("end"), (a["n"] + width - F.greatest(a["end"] - p, F.lit(0))).alias("n"))
            return F.aggregate(F.array_sort(F.transform(again, lambda x: x["p"])), state, step, lambda a: a["n"])

        return _bind(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), of_sorted)

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_bind(hashes, count))


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """docs with `windows`, the hashes of all runs of `width` words in order: those of twice as many words come from two neighbouring ones, so that a word is
    hashed once and joined a few times."""

    def joined(h: str, by: int) -> Column:
        return F.zip_with(h, F.slice(h, by + 1, F.greatest(F.size(h) - by, F.lit(0))), lambda x, y: F.xxhash64(x, y))

    docs, n = docs.withColumn("windows", F.transform("words", lambda w: F.xxhash64(w))), 1
    while n < width:
        by = min(n, width - n)
        docs, n = docs.withColumn("windows", joined("windows", by)), n + by
    return docs.withColumn("windows", F.slice("windows", 1, F.greatest(F.size("words") - width + 1, F.lit(0))))  # without those past the end


def measured(docs: DataFrame, width: int = 8) -> DataFrame:
    """Stored: uid, doc_id, host, text_key, counts of the base rules and lines (array of line hash, words and place in the text)."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.col("source").alias("host"), text.alias("text")).select(
        "*", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)).alias("words"),
        F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("row"), i.alias("pos"))), lambda x: x["row"].rlike(WORD)).alias("rows"),
    )
    plain = lambda x: F.lower(F.trim(F.regexp_replace(F.regexp_replace(x, "[0-9]+", "0"), f"{BLANK}+", " ")))
    base = base.withColumn("plain", F.transform("rows", lambda x: F.struct(plain(x["row"]).alias("line"), x["pos"].alias("pos"))))
    n = lambda line: F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    lines = F.transform("plain", lambda x: F.struct(F.xxhash64(x["line"]).alias("line"), n(x["line"]).alias("n"), x["pos"].alias("pos")))
    out = _windows(base, width).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "host", F.xxhash64("text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("rows") - F.size(F.array_distinct("rows.row"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("windows"), width).cast("long").alias("n_repeat_words"),
        lines.alias("lines"),
    )
    return stored(out, "measured")


def common_lines(rows: DataFrame, most_share: float, most_docs: int) -> DataFrame:
    """host, line: those in more than most_docs texts and more than most_share of the texts of a host. Stored."""
    texts = rows.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    each = rows.select("host", "text_key", F.explode("lines.line").alias("line")).distinct()
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > most_docs)
    over = counts.alias("c").join(texts.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host"))).filter(F.col("n") > most_share * F.col("texts"))
    return stored(over.select("c.host", "line"), "common-lines")


def _verdicts(docs: DataFrame, most_share: float = 0.01, most_docs: int = 10, least_words: int = 20, least_part: float = 0.3) -> DataFrame:
    """The rows of judged, and gone: the places of the boilerplate lines, null if there are none."""
    rows = measured(docs)
    common = common_lines(rows, most_share, most_docs)
    each = rows.select("uid", "host", F.explode("lines").alias("l")).select("uid", "host", "l.line", "l.n", "l.pos")
    cond = F.col("e.host").eqNullSafe(F.col("c.host")) & (F.col("e.line") == F.col("c.line"))
    found = each.alias("e").join(common.alias("c"), cond, "left_semi")
    removed = found.groupBy("uid").agg(F.sum("n").cast("long").alias("removed_words"), F.collect_list("pos").alias("gone"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left < least_words) | (left < least_part * F.col("n_words"))
    out = rows.drop("lines").join(removed, "uid", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def judged(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: uid, doc_id, host, text_key (xxhash64 of the text), the counts, base_failed, removed_words (in boilerplate lines) and kept.

    A null text has no words and fails; a null source is a host of its own. Repeated rows are rows of their own and count as one text.
    Texts are taken whole at any length, columns besides doc_id, text and source are not read, and no rows give no rows.
    base_failed: under 20 words, or over 30 % of the words in 8-word windows that the text repeats. removed_lines: the places of the
    boilerplate lines, from 0, joined by commas.
    limits: a line is boilerplate in over most_docs (10) texts of its host and over most_share (0.01) of them; least_words (20) and
    least_part (0.3) of the words must be left.
    """
    rows = _verdicts(docs, **limits)
    return rows.withColumn("removed_lines", F.coalesce(F.array_join(F.array_sort("gone"), ","), F.lit(""))).drop("gone")


def accepted(docs: DataFrame, **limits) -> DataFrame:
    """The rows of docs that are kept, with all columns of docs, their texts without the boilerplate lines. Lines without words stay; n_chars, if docs
    has it, follows the text. A verdict depends on the host and the text only, as do the lines that go, so repeated rows go or stay together."""
    touched = _verdicts(docs, **limits).filter("not kept or gone is not null").select(F.col("host").alias("__loom_host"), F.col("text_key").alias("__loom_text"), "kept", "gone")
    verdicts = touched.groupBy("__loom_host", "__loom_text").agg(F.first(F.struct("kept", "gone")).alias("__loom_verdict"))
    same = F.col("source").eqNullSafe(F.col("__loom_host")) & (F.col("__loom_key") == F.col("__loom_text"))
    marked = docs.withColumn("__loom_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    left = marked.join(stored(verdicts, "verdicts"), same, "left").filter(F.coalesce("__loom_verdict.kept", F.lit(True)))
    gone = F.col("__loom_verdict.gone")
    stays = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(gone, i))
    left = left.withColumn("text", F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(gone.isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return left.select(*docs.columns)
