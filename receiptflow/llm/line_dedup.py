"""Deletion of runs of lines that occur earlier in the corpus, by winnowing over line hashes. DataFrame only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from receiptflow.llm.shared import drop_written, inner_names, without, written

#: A word, in Java's regular expressions and in RE2.
WORD = r"[^\x20\x09-\x0D]+"
_DOC = ("id", "th")


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, pos, h, h2, words, start, past) of every line with a word; ``th`` is a hash of the whole text.

    ``h`` and ``h2`` are hashes of the line under two seeds; one of 64 bits alone is shared by chance among 10**12 lines.
    ``start`` and ``past`` count the words of the document before the line and up to its end. Rows with equal id and text
    are one document.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    rows = rows.select(*_DOC, "pos", F.xxhash64(F.trim("line")).alias("h"), F.xxhash64(F.lit(7), F.trim("line")).alias("h2"), F.regexp_count("line", F.lit(WORD)).alias("words"))
    rows = rows.filter("words > 0").repartition(*_DOC).dropDuplicates([*_DOC, "pos"])
    past = F.sum("words").over(Window.partitionBy(*_DOC).orderBy("pos"))
    return rows.withColumn("past", past).withColumn("start", F.col("past") - F.col("words"))


def _bounds(least_words: int) -> dict[str, Window]:
    """The minimal runs of lines with ``least_words`` words: from each line onwards, and up to each line."""
    doc = Window.partitionBy(*_DOC)
    return {
        "ahead": doc.orderBy("start").rangeBetween(0, least_words - 1),
        "back": doc.orderBy("past").rangeBetween(1 - least_words, 0),
    }


def fingerprints(lines: DataFrame, least_words: int) -> DataFrame:
    """(id, th, h, pos): the lines that are the least of a window, by hash and then by place.

    The windows are the minimal runs with ``least_words`` words from each line onwards. Any repeated run of so many words
    holds one whole, and equal windows choose the same line of theirs: such a run is sure to share a fingerprint, at the
    same place in it, with its earlier occurrence.
    """
    ahead = _bounds(least_words)["ahead"]
    least = F.when(F.sum("words").over(ahead) >= least_words, F.min(F.struct("h", "pos")).over(ahead))
    chosen = lines.select(*_DOC, least.alias("m")).filter("m IS NOT NULL")
    return chosen.select(*_DOC, "m.h", "m.pos").dropDuplicates([*_DOC, "pos"])


def shared_positions(prints: DataFrame) -> DataFrame:
    """(id, th, at): the positions, by document, whose fingerprint stands at another place, too.

    Positions are joined by fingerprint to its first place alone, which a grouped minimum finds, so a line that a third
    of all documents have costs a row for each of its places and no pairs.
    """
    place = F.xxhash64("id", "th", "pos")
    several = prints.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("h")
    met = prints.join(several, "h").groupBy(*_DOC).agg(F.collect_set("pos").alias("at"))
    return met


def extended(lines: DataFrame, met: DataFrame, least_words: int) -> DataFrame:
    """(id, th, first, last, w1, w2): all windows around shared positions.

    A match can only reach as far from a shared position as windows that hold one do. The windows from each
    line onwards and up to each line are the steps of the extension, to the right and to the left: neighbouring windows
    that both occur earlier overlap in all but a line, so their union grows line by line to the whole repeated run. Each
    is known by a 128-bit hash of its lines.
    """
    met = met.toDF("mid", "mth", "at")
    here = lines.join(met, F.col("id").eqNullSafe(F.col("mid")) & (F.col("th") == F.col("mth"))).drop("mid", "mth")
    line = F.struct("pos", "h", "h2")
    found = here.select(
        *_DOC,
        "at",
        *[F.collect_list(line).over(w).alias(k) for k, w in _bounds(least_words).items()],
        *[F.sum("words").over(w).alias(f"{k}_words") for k, w in _bounds(least_words).items()],
    )
    # a run that is minimal both ways comes once
    twice = (F.size("back") == 1) & (F.size("ahead") == 1)
    either = F.array(
        F.when(F.col("ahead_words") >= least_words, F.col("ahead")),
        F.when((F.col("back_words") >= least_words) & ~twice, F.col("back")),
    )
    runs = found.select(*_DOC, "at", F.explode(F.filter(either, lambda x: x.isNotNull())).alias("run"))
    runs = runs.filter(F.arrays_overlap("at", F.col("run.pos")))
    return runs.select(
        *_DOC,
        F.get("run.pos", F.lit(0)).alias("first"),
        F.element_at("run.pos", -1).alias("last"),
        F.xxhash64("run.h").alias("w1"),
        F.xxhash64("run.h2").alias("w2"),
    )


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50) -> DataFrame:
    """(id, th, spans): the runs of lines (first, last; from 0) of each document that occur earlier in the corpus.

    Window minima are the fingerprints; their positions are joined; matches are extended both ways; what equals an earlier
    run, in the order of id, text hash and line, is a repetition. What overlaps or touches is one span. Each step is a
    grouped minimum with partial aggregation or a join on its result, never a list of all places of a fingerprint.
    """
    lines = written(line_table(docs, id_col, text_col), "lines")
    prints = written(fingerprints(lines, least_words), "line-prints")
    met = written(shared_positions(prints), "line-positions")
    near = written(extended(lines, met, least_words), "line-matches")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("th"), F.col("first"))
    earliest = near.groupBy("w1", "w2").agg(F.min(place).alias("origin"), F.max(place).alias("latest"))
    # written, so that the next join deals out both sides itself and Spark may split the rows of a frequent run
    earliest = written(earliest.filter("origin <> latest").drop("latest"), "line-origins")
    later = near.join(earliest, ["w1", "w2"]).filter(place > F.col("origin")).select(*_DOC, "first", "last")
    order = Window.partitionBy(*_DOC).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.withColumn("new", (F.col("first") > F.coalesce(reach, F.lit(-2)) + 1).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy(*_DOC, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    spans = spans.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    spans = written(spans, "line-spans")
    for table in (lines, prints, met, near, earliest):
        drop_written(table)
    return spans


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50) -> DataFrame:
    """Each row of ``docs`` with ``clean_text`` and ``removed_spans``: its text without runs of lines met earlier.

    Lines are what stands between line feeds, equal if they are so without blanks around them; words are what stands
    between white space. A run of lines with at least ``least_words`` words that occurs earlier (at a smaller id; at equal
    ids, a smaller text hash; in the same text, an earlier line; a null id comes last) is deleted with the wordless lines
    inside it; the first occurrence stays. Shorter repetitions stay, so common short lines harm no text.

    A null text stays null and an empty one empty; a very long text is so many lines, or one long line, which is then a
    window by itself; rows with equal id and text are one document, treated alike, not repetitions of each other. An empty table gives an empty one; input columns named like outputs are replaced.
    """
    names = ["clean_text", "removed_spans"]
    key, hash_, own, cut_, lines_ = inner_names("id", "th", "h", "spans", "lines")
    spans = repeated_runs(docs, id_col, text_col, least_words).toDF(key, hash_, cut_)
    text = F.col(text_col).cast("string")
    out = without(docs, names).withColumn(own, F.xxhash64(text))
    out = out.join(spans.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(hash_)), "left")
    lines, cut = F.split(text, "\n"), F.col(cut_)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["last"] + 1)
    past = lambda i: F.coalesce(F.get(cut, i)["first"], F.size(lines_))
    parts = F.transform(F.sequence(F.lit(0), F.size(cut)), lambda i: F.slice(lines_, begin(i) + 1, past(i) - begin(i)))
    out = out.withColumn(lines_, F.when(cut.isNotNull(), lines))
    out = out.withColumn("clean_text", F.when(cut.isNull(), text).otherwise(F.array_join(F.flatten(parts), "\n")))
    out = out.withColumn("removed_spans", F.coalesce(cut, F.array().cast(spans.schema[cut_].dataType)))
    return out.drop(key, hash_, own, cut_, lines_)
