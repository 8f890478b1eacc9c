"""Quality rules with cross-document line frequency; DataFrame functions only.

Per document: words, symbols, repeated lines and repeated three-word windows, and the base rules on them.
Across documents: a line is normalised (lower case, outer and repeated blanks dropped, digits as one sign)
and hashed; the distinct documents that hold it are counted per host, here the source. Lines above
the limits are removed as boilerplate: a line of ``LONG_LINE`` words or more in at least ``MIN_DOCUMENTS`` distinct
documents, however large the host is; a shorter one, which texts may share by chance, if it is also in more than
``MAX_SHARE`` of the host's distinct documents. ``cleaned`` gives the texts without these lines. A document that loses more than ``MAX_LOSS``
of its words to them is depleted and rejected, like one that fails the base rules.

Documents with equal texts are one document of their host: copies do not make a line frequent, and
copies share their verdict. They become one row before any line is exploded, so a group of copies costs as
much as one document. Counting is a sum per (host, line), added up in the map tasks first, and lines
meet their counts in an equi-join which splits hot lines; no line or document goes to the driver.

Defined cases: a null text has no words and fails the base rules; lines without a word are neither
counted nor removed; a null source is a host; repeated rows get the same verdict each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.tables import text_or_empty

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_DOCUMENTS = 10
LONG_LINE = 8
MAX_SHARE = 0.02
MAX_LOSS = 0.5
WORD = r"[^\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """body(value) with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _BLANKS, "")) > 0)


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that the text holds twice or more, the first of them included."""
    n = F.size(words)
    # Places are read from the words themselves: no copies of them, no windows as texts.
    hashes = F.transform(
        F.slice(words, F.lit(1), n - 2),
        lambda w, i: F.xxhash64(w, F.lit(1), F.get(words, i + 1), F.lit(2), F.get(words, i + 2)),
    )

    def again(ordered: Column) -> Column:
        def same(place: Column, own: Column) -> Column:
            return F.coalesce(F.get(ordered, place)["hash"] == own["hash"], F.lit(False))

        alike = F.filter(ordered, lambda w, i: same(i - 1, w) | same(i + 1, w))
        return F.sort_array(F.transform(alike, lambda w: w["at"]))

    def covered(starts: Column) -> Column:
        # A window covers three words, less those that the next one covers as well.
        gaps = F.zip_with(
            starts, F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.lit(None).cast("int"))),
            lambda own, following: F.when(own.isNull(), 0).otherwise(F.least(F.lit(3), F.coalesce(following - own, F.lit(3)))),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def counted(own: Column) -> Column:
        placed = F.transform(own, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
        repeated = _let(_let(F.sort_array(placed), again), covered)
        return F.when(F.size(F.array_distinct(own)) == F.size(own), 0).otherwise(repeated)

    return F.when(n < 4, 0).otherwise(_let(hashes, counted)).cast("bigint")


def line_hash(line: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "), r"[0-9]+", "0")
    return F.xxhash64(F.trim(plain))


def text_digest(text: Column) -> Column:
    """128 bits, as equal texts have to be told from others."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, source, text, digest and the per-document counts of ``docs`` (doc_id, source, text)."""
    text = text_or_empty()
    lines = lines_with_words(text)
    counted = docs.select(
        "doc_id", "source", "text", text_digest(text).alias("digest"),
        _let(word_list(text), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words"),
        )).alias("w"),
        F.length(F.translate(text, _BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    )
    failed = (F.col("w.n_words") < MIN_WORDS) | (
        100 * F.col("w.n_repeat_words") > MAX_REPEATED_PERCENT * F.col("w.n_words")
    )
    return counted.select(
        "doc_id", "source", "text", "digest", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
        failed.alias("base_failed"),
    )


def removed_lines(docs: DataFrame) -> DataFrame:
    """(host, digest, removed, places): words in lines above the limits and the places of these lines, of every distinct text that has any."""
    text = text_or_empty()

    def numbered(line: Column, place: Column) -> Column:
        words = F.regexp_count(line, F.lit(WORD))
        # The last bit of a line's key says whether the line is long.
        key = F.shiftleft(F.shiftright(line_hash(line), 1), 1) + (words >= LONG_LINE).cast("bigint")
        return F.struct(key.alias("line"), words.alias("words"), place.alias("place"))

    lines = F.filter(F.transform(F.split(text, "\n"), numbered), lambda x: x["words"] > 0)
    texts = docs.select(_host().alias("host"), text_digest(text).alias("digest"), lines.alias("lines")).groupBy(
        "host", "digest"
    ).agg(F.first("lines").alias("lines"))
    # All three readers ask for whole lists of lines, which are never null: then they share one shuffle of the texts.
    limits = texts.groupBy("host").agg(F.greatest(F.lit(MIN_DOCUMENTS), F.floor(F.count("lines") * MAX_SHARE) + 1).alias("least"))
    frequent = (
        texts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("documents"))
        .where(F.col("documents") >= MIN_DOCUMENTS).join(limits, "host").where("documents >= least or line % 2 != 0")
        .select("host", "line")
    )
    own = texts.select("host", "digest", F.explode("lines").alias("l")).select("host", "digest", "l.*")
    return own.join(frequent, ["host", "line"]).groupBy("host", "digest").agg(
        F.sum("words").alias("removed"), F.collect_list("place").alias("places")
    )


def _host() -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1"))


def _judged(docs: DataFrame) -> DataFrame:
    """The base rules of every row of ``docs``, kept, n_removed_words, and the text without the lines above the limits."""
    docs = docs.select("doc_id", "source", "text")
    judged = base_rules(docs).withColumn("host", _host()).join(removed_lines(docs), ["host", "digest"], "left")
    removed = F.coalesce("removed", F.lit(0)).cast("bigint")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "places")
    rest = _let(lines, lambda own: F.array_join(F.transform(stay, lambda k: own[k]), "\n"))
    return judged.withColumn("text", F.when(F.col("places").isNull(), F.col("text")).otherwise(rest)).withColumn(
        "n_removed_words", removed
    ).withColumn("kept", ~F.col("base_failed") & (removed <= MAX_LOSS * F.col("n_words")))


def rate(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): counts, base_failed, kept, removed words."""
    return _judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words",
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id, source, text, n_removed_words of every kept row of ``docs``: its text without the lines above the limits."""
    return _judged(docs).where("kept").select("doc_id", "source", "text", "n_removed_words")
