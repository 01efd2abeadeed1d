"""Line dedup by winnowing: later copies of runs of lines with 50 words or more are deleted.

1. Lines become hashes. From each line on, the shortest run of 25 words or more is a
   gram. Each shortest run of 50 words or more is a window, and the least gram hash in
   it is a fingerprint. A run that occurs twice holds a whole window, so the same
   fingerprint is selected in both places.
2. Fingerprints are joined by hash. Where none is found twice, nothing repeats.
3. A fingerprint found twice is extended both ways: the windows that begin at each line
   around it and those that end there are compared by content with all such windows.
   Every repeated run is the union of its windows of both kinds, so its whole length is
   found, and nothing but repeated runs.
4. Each window's first occurrence, in the order of key, text hash and line, stays; the
   lines of the later ones go.

Only DataFrame functions are used. Texts are shuffled once, for the deletion; all else
is a few numbers for each line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.llm.mixing import WORD
from samplewright.llm.shared import join_hot, written

DOC = ["key", "text_hash"]


def line_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each line with a word, of each different document: DOC, pos, h, v, w, begin, end, total.

    h and v are hashes of the line, w its words, begin and end the document's words
    before and up to it.
    """
    line = lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x).alias("h"), F.crc32(x).alias("v"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("w"))
    lines = F.filter(F.transform(F.split(F.col(text), "\n"), line), lambda x: x["w"] > 0)
    slim = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), lines.alias("lines"))
    # repeated rows are one document; after this exchange a document's lines lie together
    rows = slim.groupBy(*DOC).agg(F.first("lines").alias("lines")).select(*DOC, F.explode("lines").alias("l")).select(*DOC, "l.*")
    own = Window.partitionBy(*DOC)
    rows = rows.withColumn("end", F.sum("w").over(own.orderBy("pos"))).withColumn("begin", F.col("end") - F.col("w"))
    return rows.withColumn("total", F.sum("w").over(own))


def _content(frame, *salt: int) -> Column:
    """128 bits of the lines of a frame, in order."""
    listed = F.collect_list(F.struct("begin", "h", "v")).over(frame)
    return F.struct(F.xxhash64(listed["h"], *map(F.lit, salt)).alias("a"), F.xxhash64(listed["v"], F.size(listed), *map(F.lit, salt)).alias("b"))


def fingerprints(rows: DataFrame, run_words: int, gram_words: int) -> DataFrame:
    """DOC, pos, gram of the selected grams: the least of each window."""
    own = Window.partitionBy(*DOC).orderBy("begin")
    gram, window = own.rangeBetween(0, gram_words - 1), own.rangeBetween(0, run_words - 1)
    grams = rows.withColumn("gram", _content(gram)["a"]).withColumn("gram_end", F.max("end").over(gram))
    grams = grams.withColumn("gram_end", F.when(F.col("total") - F.col("begin") >= gram_words, F.col("gram_end")))
    held = F.collect_list(F.struct("gram", "pos", "gram_end")).over(window)
    chosen = grams.withColumn("held", held).withColumn("window_end", F.max("end").over(window)).where(F.col("total") - F.col("begin") >= run_words)
    inside = F.filter("held", lambda g: g["gram_end"] <= F.col("window_end"))
    least = F.array_min(F.transform(inside, lambda g: F.struct(g["gram"], g["pos"])))
    return chosen.select(*DOC, least.alias("f")).select(*DOC, "f.pos", "f.gram").distinct()


def repeated_runs(rows: DataFrame, run_words: int, gram_words: int) -> DataFrame:
    """DOC, low, high: places of lines that repeat an earlier run; they may overlap."""
    marks = written(fingerprints(rows, run_words, gram_words), "fingerprints")
    twice = marks.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("gram")
    found = marks.join(twice, "gram", "left_semi").select(*DOC, "pos").withColumn("hit", F.lit(1))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in [*DOC, "pos"]]
    near = rows.alias("l").join(found.alias("f"), on, "left").select("l.*", F.coalesce("f.hit", F.lit(0)).alias("hit"))
    ahead = Window.partitionBy(*DOC).orderBy("begin").rangeBetween(0, run_words - 1)
    behind = Window.partitionBy(*DOC).orderBy("end").rangeBetween(1 - run_words, 0)
    # both kinds of window, where a repeated fingerprint lies in it
    near = near.withColumn("_ahead", F.when((F.max("hit").over(ahead) > 0) & (F.col("total") - F.col("begin") >= run_words), F.struct(_content(ahead, 1).alias("c"), F.col("pos").alias("low"), F.max("pos").over(ahead).alias("high"))))
    near = near.withColumn("_behind", F.when((F.max("hit").over(behind) > 0) & (F.col("end") >= run_words), F.struct(_content(behind, 2).alias("c"), F.min("pos").over(behind).alias("low"), F.col("pos").alias("high"))))
    windows = near.select(*DOC, F.explode(F.array("_ahead", "_behind")).alias("w")).where("w is not null").select(*DOC, F.col("w.c.a").alias("a"), F.col("w.c.b").alias("b"), "w.low", "w.high")
    windows = written(windows, "windows")
    place = F.struct(F.col("key").isNull().alias("null"), "key", "text_hash", "low", "high")
    firsts = written(windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "first-windows")
    later = join_hot(windows, firsts, ["a", "b"], "_n")
    same = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("text_hash") == F.col("first.text_hash"))
    # in one document, lines of the first occurrence stay even if the later one overlaps it
    low = F.when(same, F.greatest("low", F.col("first.high") + 1)).otherwise(F.col("low"))
    return later.select(*DOC, low.alias("low"), "high").where("low <= high")


def deleted_lines(runs: DataFrame) -> DataFrame:
    """DOC, deleted: the places of a document's deleted lines, each once."""
    longest = runs.groupBy(*DOC, "low").agg(F.max("high").alias("high"))
    own = Window.partitionBy(*DOC).orderBy("low")
    # what lies beyond all runs that begin before
    after = F.coalesce(F.max("high").over(own.rowsBetween(Window.unboundedPreceding, -1)) + 1, F.col("low"))
    parts = longest.withColumn("low", F.greatest("low", after)).where("low <= high")
    return parts.select(*DOC, F.explode(F.sequence("low", "high")).alias("pos")).groupBy(*DOC).agg(F.collect_list("pos").alias("deleted"))


def dedup_lines(docs: DataFrame, run_words: int = 50, gram_words: int = 25, key: str = "doc_id", text: str = "text", n_deleted: str = "n_deleted") -> DataFrame:
    """`docs` with the text's repeated lines deleted and their number in `n_deleted`.

    A line goes if it lies in a run of whole lines, `run_words` words or more, that
    occurs earlier: in a document of smaller key (null last), in another text of the
    same key, or further up. Lines are parted by `\\n` and must be equal to the byte;
    lines without a word don't count, and go only inside a deleted run. Repeated rows
    (equal key and text) are one document and are treated alike. Null and empty texts
    stay as they are; so does every other column, but a column named `n_deleted` is
    replaced. An empty table stays empty. gram_words must not exceed run_words.
    """
    if not 0 < gram_words <= run_words:
        raise ValueError("0 < gram_words <= run_words")
    rows = written(line_rows(docs, key, text), "lines")
    gone = deleted_lines(repeated_runs(rows, run_words, gram_words)).select(F.col("key").alias("_gone_key"), F.col("text_hash").alias("_gone_hash"), F.col("deleted").alias("_deleted"))
    same = F.col(key).eqNullSafe(F.col("_gone_key")) & (F.xxhash64(text) == F.col("_gone_hash"))
    whole = docs.drop(n_deleted) if n_deleted in docs.columns else docs
    lines = F.split(F.col(text), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_deleted"))
    rest = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    joined = whole.join(gone, same, "left")
    return joined.withColumn(text, F.when(F.col("_deleted").isNull(), F.col(text)).otherwise(rest)).withColumn(n_deleted, F.coalesce(F.size("_deleted"), F.lit(0))).drop("_gone_key", "_gone_hash", "_deleted")
