"""Line dedup within one edit by a deletion neighbourhood. DataFrame functions only.

Lines are compared by their words, lower-cased. Two lines are within one edit if one word is replaced, put in or left
out. The bound on edits follows the line's length: one word in lines of `least_words` (8) words or more, of any length, and none in shorter ones, of which
one word is an eighth or more. Each line gives hashed keys: of itself, of itself with a gap in place of each word, and of itself less each
word. Lines with a gap alike are near one another; a line less one word is near the line that equals it. So for each key
only its earliest line matters, and a key with any number of lines costs one candidate for each of them.
Candidates are verified word by word.

The variants less one word are made only for lines that have a variant less a quarter in common: a line's words but for a
stretch of about a quarter, in four places, which together hold any edit; and only for the words of such a stretch. A variant's hash is
made of sums over blocks of words, so that a line of n words costs n times the root of n steps at most. Distinct lines are handled once, by the place where they first occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANK, WORD, stored


def _plain(low: Column) -> Column:
    """A lower-cased line with single blanks between words."""
    single = ~(low.contains("  ") | low.startswith(" ") | low.endswith(" "))
    for blank in "\t\x0b\x0c\r":
        single = single & ~low.contains(blank)
    return F.when(single, low).otherwise(F.trim(F.regexp_replace(low, f"{BLANK}+", " ")))


def _quarters(line: Column, n: Column) -> Column:
    """Hashes of the line without the stretch between its first i * b and its last (3 - i) * b words, i = 0 to 3; b is a quarter
    of the shorter line of a pair, so of this one's n words and of one word less."""

    def keys(b: Column) -> list[Column]:
        some = lambda k: F.call_function("substring_index", line, F.lit(" "), k)
        return [F.xxhash64(F.lit(i), b, some(b * i), some(b * (i - 3))) for i in range(4)]

    b, shorter = F.floor(n / 4).cast("int"), F.floor((n - 1) / 4).cast("int")
    return F.when(b == shorter, F.array(*keys(b))).otherwise(F.array(*keys(b), *keys(shorter)))


def _lane(plain: Column) -> Column:
    """The hash by which lines are grouped; equal ones are told apart by a second one, if they are not equal lines."""
    return F.xxhash64(plain)


def line_places(docs: DataFrame, least_words: int) -> DataFrame:
    """Stored: uid, doc_id, text_key, pos, line (hash of its words), twin (another hash) and quarters of each line with words, and of the first line of any document, with
    a null hash if that has none. Lines that are only compared as equal or not have no quarters."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("uid", "doc_id", F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("pos", "row"))
    full = F.col("row").rlike(WORD)
    rows = rows.filter((F.col("pos") == 0) | full).select("uid", "doc_id", "text_key", "pos", F.when(full, F.lower("row")).alias("low"))
    rows = rows.select("uid", "doc_id", "text_key", "pos", _plain(F.col("low")).alias("plain"))
    blanks = F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" "), F.lit("")))
    rows = rows.select("*", (blanks + 1).alias("n"))
    quarters = F.when(F.col("n") >= least_words - 1, _quarters(F.col("plain"), F.col("n")))
    return stored(rows.select("uid", "doc_id", "text_key", "pos", F.when(F.col("plain").isNotNull(), _lane(F.col("plain"))).alias("line"), F.xxhash64(F.lit(5), "plain").alias("twin"), quarters.alias("quarters")), "line-places")


def near(a: Column, b: Column) -> Column:
    """Whether two lists of words are equal but for one word replaced, put in or left out at most."""
    n, m = F.size(a), F.size(b)
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    at = F.coalesce(F.nullif(F.array_position(differ, True), F.lit(0).cast("long")), F.lit(2**30).cast("long")).cast("int")
    rest = lambda w, i: F.slice(w, i, F.greatest(F.size(w) - i + 1, F.lit(0)))
    return F.when(n == m, rest(a, at + 1) == rest(b, at + 1)).when(n == m + 1, rest(a, at + 1) == rest(b, at)).when(m == n + 1, rest(a, at) == rest(b, at + 1)).otherwise(False)


def _floor(x: Column) -> Column:
    return F.floor(x).cast("int")


def _xor(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))


def _near_lines(docs: DataFrame, first: DataFrame, least_words: int) -> DataFrame:
    """line: the distinct lines for which an earlier one is within one edit. first: line, place, quarters."""
    blocks = first.select("line", F.posexplode("quarters").alias("quarter", "block"))
    shared = blocks.groupBy("block").agg(F.min("line").alias("x"), F.max("line").alias("y")).filter("x != y").select("block")
    some = stored(blocks.join(shared, "block").groupBy("line").agg(F.collect_set("quarter").alias("without")), "lines-with-blocks")
    tried = stored(first.select("line", "place").join(some, "line"), "tried-lines")
    # the words are read again, of the documents with such lines, to which texts are moved once; by the same plan at any size
    wanted = tried.groupBy("place.doc_id", "place.text_key").agg(F.collect_list(F.struct("line", "place.pos")).alias("wanted"))
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.col("doc_id").alias("of_doc"), F.xxhash64(text).alias("of_text"), text.alias("text"))
    found = keyed.join(wanted.hint("merge"), F.col("of_doc").eqNullSafe(F.col("doc_id")) & (F.col("of_text") == F.col("text_key")))
    own = lambda x: F.struct(x["line"].alias("line"), F.try_element_at("rows", x["pos"] + 1).alias("row"))
    rows = found.select(F.split("text", "\n").alias("rows"), "wanted").select(F.explode(F.transform("wanted", own)).alias("x"))
    texts = rows.select("x.line", F.split(_plain(F.lower("x.row")), " ").alias("words")).groupBy("line").agg(F.first("words").alias("words"))
    lines = stored(texts.join(tried, "line"), "tried-words")
    hashed = lines.select("line", "place", "without", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("w"))
    hashed = hashed.withColumn("placed", F.transform("w", lambda w, i: F.xxhash64(i, w)))
    hashed = hashed.withColumn("whole", _xor(F.col("placed")))
    # only a word in a stretch that a shared quarter leaves out can be the one that differs
    b = lambda q: F.when(q < 4, F.floor(F.col("n") / 4)).otherwise(F.floor((F.col("n") - 1) / 4)).cast("int")
    stretches = F.transform("without", lambda q: F.struct(((q % 4) * b(q)).alias("after"), (F.col("n") - (3 - q % 4) * b(q)).alias("upto")))
    hashed = hashed.withColumn("stretches", stretches)
    hashed = hashed.withColumn("at", F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.exists("stretches", lambda r: (i > r["after"]) & (i <= r["upto"]))))
    # less a word: the words before it hashed with their places, and those after it with the places they then have
    sums = F.transform(F.sequence(F.lit(0), _floor((F.col("n") - 1) / F.col("b"))), lambda k: _xor(F.slice("turn", k * F.col("b") + 1, F.col("b"))))
    hashed = hashed.withColumn("moved", F.transform("w", lambda w, i: F.xxhash64(i - 1, w))).withColumn("b", F.ceil(F.sqrt("n")).cast("int"))
    hashed = hashed.withColumn("turn", F.zip_with("placed", "moved", lambda x, y: x.bitwiseXOR(y)))
    hashed = hashed.withColumn("sums", sums).withColumn("after", _xor(F.col("moved")))
    hashed = hashed.withColumn("before", F.transform("sums", lambda _, k: _xor(F.slice("sums", 1, k))))

    def less(i: Column) -> Column:
        block = _floor((i - 1) / F.col("b"))
        rest = _xor(F.slice("turn", block * F.col("b") + 1, i - 1 - block * F.col("b")))
        whole = F.element_at("before", block + 1).bitwiseXOR(rest).bitwiseXOR(F.col("after")).bitwiseXOR(F.element_at("moved", i))
        return F.xxhash64(F.col("n") - 1, whole)

    of_kind = lambda hashes, kind: F.transform(F.array_distinct(hashes), lambda h: F.struct(h.alias("key"), F.lit(kind).alias("kind")))
    gap = of_kind(F.transform("at", lambda i: F.xxhash64(i, F.col("n"), F.col("whole").bitwiseXOR(F.element_at("placed", i)))), 0)
    own = F.array(F.struct(F.xxhash64("n", "whole").alias("key"), F.lit(2).alias("kind")))
    edits = F.when(F.col("n") >= least_words, F.concat(gap, of_kind(F.transform("at", less), 1), own)).otherwise(own)
    keys = stored(hashed.select("line", "place", F.explode(edits).alias("k")).select("line", "place", "k.*"), "line-keys")
    # of a gap alike the earliest line; of a line less a word the earliest longer one, and the shorter one itself
    earliest = lambda test: F.min(F.when(test, F.struct("place", "line")))
    groups = keys.groupBy("key", (F.col("kind") > 0).alias("short")).agg(earliest(F.col("kind") != 2).alias("long_one"), earliest(F.col("kind") == 2).alias("own_one"), F.count("*").alias("n"))
    groups = stored(groups.filter("n > 1"), "earliest-lines")
    joined = keys.join(groups, (keys["key"] == groups["key"]) & ((F.col("kind") > 0) == F.col("short")))
    other = F.when(F.col("kind") == 1, F.col("own_one")).otherwise(F.col("long_one"))
    pairs = joined.select("line", "place", other.alias("o")).filter(F.col("o.place") < F.col("place")).select("line", F.col("o.line").alias("other")).distinct()
    of = lambda x: lines.select(F.col("line").alias(x), F.col("words").alias(f"words_{x}"))
    tested = pairs.join(of("line"), "line").join(of("other"), "other").filter(near(F.col("words_line"), F.col("words_other")))
    return stored(tested.select("line").distinct(), "near-lines")


def _first_lines(places: DataFrame) -> DataFrame:
    """Stored: line, place (of its first one), quarters, and whether lines of different twins meet in it."""
    place, met = F.struct("doc_id", "uid", "pos", "text_key"), (F.min("twin") != F.max("twin")).alias("met")
    return stored(places.groupBy("line").agg(F.min(place).alias("place"), F.first("quarters").alias("quarters"), met), "first-lines")


def line_verdicts(docs: DataFrame, least_words: int = 8) -> DataFrame:
    """Stored, a row per document: uid, doc_id, n_lines, n_equal, n_near, kept (places of the lines that stay, in order).

    docs: uid (unique; it is read once only), doc_id, text. A line with words goes if an earlier line, in the order of doc_id (null first), uid and place, has the
    same words (n_equal), or else if one is within one edit (n_near); lines without words are not counted. Lines of under least_words
    words are compared as equal or not only; of two lines within one edit one may have a word less than least_words.
    It does not matter whether the earlier line goes itself. Lines are equal if two hashes of 64 bits are.
    No rows give no rows.
    """
    rows = line_places(docs, least_words)
    first = _first_lines(rows.filter("line is not null"))
    met = first.filter("met").select(F.col("line").alias("of"))
    if not met.isEmpty():  # different lines with one hash: they get a hash of both
        both = F.when(F.col("of").isNotNull(), F.xxhash64("line", "twin")).otherwise(F.col("line"))
        rows = stored(rows.join(met, F.col("line") == F.col("of"), "left").withColumn("line", both).drop("of"), "line-places")
        first = _first_lines(rows.filter("line is not null"))
    places = rows.filter("line is not null")
    gone = _near_lines(docs, first, least_words).withColumn("near", F.lit(True))
    firsts = first.join(gone, "line", "left").select(F.col("place.uid").alias("uid"), F.col("place.pos").alias("pos"), F.coalesce("near", F.lit(False)).alias("near"))
    counts = places.groupBy("uid").agg(F.count("*").alias("n_lines"))
    kept = F.array_sort(F.collect_list(F.when(~F.col("near"), F.col("pos")))).alias("kept")
    own = firsts.groupBy("uid").agg(F.count("*").alias("firsts"), F.sum(F.col("near").cast("long")).alias("n_near"), kept)
    rows = rows.filter("pos = 0").select("uid", "doc_id").join(counts, "uid", "left").join(own, "uid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return stored(
        rows.select(
            "uid", "doc_id", zero(F.col("n_lines")).alias("n_lines"), (zero(F.col("n_lines")) - zero(F.col("firsts"))).alias("n_equal"),
            zero(F.col("n_near")).alias("n_near"), F.coalesce("kept", F.array().cast("array<int>")).alias("kept"),
        ), "line-verdicts",
    )


def deduplicated(docs: DataFrame, least_words: int = 8, with_text: bool = True) -> DataFrame:
    """docs with the lines that stay as text, and n_lines, n_equal, n_near and kept (see line_verdicts), which take the place of columns of these names.
    Lines without words stay. with_text False: doc_id and the verdicts only.

    A null text stays null and has no lines; an empty one stays empty. Of repeated rows the first keeps its lines and the others lose them; which one is
    first does not matter, as they are alike. Texts and lines of any length are taken whole.
    """
    if not with_text:
        return line_verdicts(docs.select("doc_id", "text").withColumn("uid", F.monotonically_increasing_id()), least_words).drop("uid")
    texts = stored(docs.withColumn("__loom_uid", F.monotonically_increasing_id()), "numbered")
    verdicts = line_verdicts(texts.select(F.col("__loom_uid").alias("uid"), "doc_id", "text"), least_words)
    verdicts = verdicts.drop("doc_id").withColumnRenamed("uid", "__loom_uid")
    stays = lambda x, i: ~x.rlike(WORD) | F.array_contains("kept", i)
    clashing = [c for c in ("n_lines", "n_equal", "n_near", "kept") if c in docs.columns]
    out = texts.drop(*clashing).join(verdicts, "__loom_uid")
    return out.withColumn("text", F.array_join(F.filter(F.split("text", "\n"), stays), "\n")).drop("__loom_uid")
