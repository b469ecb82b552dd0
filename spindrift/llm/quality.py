"""Quality rules with cross-document line frequency, in DataFrame expressions only.

One pass over the texts gives a row of counts and the hashes of the normalised
lines (lower case, single spaces) for each document. A line is frequent on its
host if more than MIN_DOCUMENTS distinct documents hold it, and more than SHARE
of the host's documents. Frequent lines are removed. A document is rejected if the
base rules fail, or if fewer than MIN_WORDS words are left of it.

Counts are summed before they are shuffled, and frequent lines that very many
documents have are joined by broadcast, so that neither a large host nor a line
that every document has meets in one task.

Defined results: every row is a document, whatever its id; a line that a document
has twice counts once; null text has no words and fails; documents without a host
form one host; null ids are kept; repeated rows are judged alike, each for itself;
an empty table gives no rows. Texts have any length. Other columns are ignored by
judge() and passed on by keep_good(), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import joined
from .runtime import materialise, prepare

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
MIN_DOCUMENTS = 20
SHARE = 0.10

_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda x: x != "")


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, _SPACE, " ")))


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more: positions of such windows in order, each adding what the next does not cover."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = _let(
        placed,
        lambda s: F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))),
    )
    return _let(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0).cast("long"), lambda a, x: a + x),
    )


def repeat_words(w: Column) -> Column:
    """Words in WINDOW-word windows found twice or more in the text."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))
    return F.when(n > WINDOW, _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)))).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """doc_id, host, text_hash, the base counts, and lines array<struct<h, n>>."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_words = _let(
        words(F.col("text")),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeat_words(w).alias("n_repeat_words")),
    )
    by_lines = _let(
        lines,
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.transform(F.transform(x, normalised), lambda y: F.struct(F.xxhash64(y).alias("h"), (F.length(y) - F.length(F.replace(y, F.lit(" "), F.lit(""))) + 1).alias("n"))).alias("lines"),
        ),
    )
    return docs.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        by_words.alias("w"),
        by_lines.alias("l"),
    ).select("doc_id", "host", "text_hash", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.lines")


def frequent_lines(measures: DataFrame, min_documents: int = MIN_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """(host, h, documents): the lines above the limits."""
    hosts = measures.groupBy("host").agg(F.count("*").alias("host_documents"))
    lines = measures.select("host", F.explode(F.array_distinct("lines.h")).alias("h"))
    counted = lines.groupBy("host", "h").agg(F.count("*").alias("documents")).where(F.col("documents") > min_documents)
    return counted.join(hosts, "host").where(F.col("documents") > share * F.col("host_documents")).select("host", "h", "documents")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_documents: int = MIN_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """doc_id, host, counts, n_line_words (words in frequent lines), base_failed, kept, and frequent (hashes of the lines to remove, or null)."""
    prepare(docs.sparkSession)
    measures = materialise(measured(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()))
    common = materialise(frequent_lines(measures, min_documents, share))
    lines = measures.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.h", "l.n")
    hit = joined(lines, common, ["host", "h"], "documents")
    removed = hit.groupBy("row").agg(F.sum("n").cast("long").alias("n_line_words"), F.collect_set("h").alias("frequent"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    line_words = F.coalesce("n_line_words", F.lit(0).cast("long"))
    return measures.drop("lines").join(removed, "row", "left").select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", line_words.alias("n_line_words"),
        failed.alias("base_failed"), (~failed & (F.col("n_words") - line_words >= MIN_WORDS)).alias("kept"), "frequent",
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of docs that are kept, without their frequent lines; chars_col, if given, has the text's new length."""
    # a verdict depends on host and text alone, so rows that repeat have one; the id only spreads the rows
    keys = ["id", "host", "hash"]
    verdicts = judge(docs, id_col, text_col, host_col).where("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "host", F.col("text_hash").alias("hash"), "frequent").dropDuplicates(keys)
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("hash"),
    )
    out, doc = rows.join(verdicts, keys), lambda c: F.col("doc").getField(c)
    lines = F.filter(F.split(doc(text_col), "\n"), lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains("frequent", F.xxhash64(normalised(x)))))
    cut = F.col("frequent").isNotNull()
    out = out.select("doc", cut.alias("cut"), F.when(cut, F.array_join(lines, "\n")).otherwise(doc(text_col)).alias("left"))
    new = {c: doc(c) for c in docs.columns} | {text_col: F.col("left")}
    if chars_col:
        new[chars_col] = F.when(F.col("cut"), F.length("left")).otherwise(doc(chars_col)).cast(docs.schema[chars_col].dataType)
    return out.select(*(new[c].alias(c) for c in docs.columns))
