"""Tables, JSON Lines with one key a line, keyed changes, and enrichment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, condition: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows of a Parquet table; condition and columns reach the scan."""
    df = spark.read.parquet(path)
    df = df.where(condition) if condition else df
    return df.select(*columns) if columns else df


def raw_documents(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Raw documents (_id, data_source, source_url, data as JSON); the source is a partition column where the table has it as one."""
    df = spark.read.parquet(path)
    return df.where(F.col("data_source") == source) if source else df


def first_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_x")).select(key, "_x.*")


def existing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key the table has."""
    return rows.join(table.select(key).distinct(), key, "left_semi")


def one_for_each(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row of each key: the last by order, or the greatest of its other columns (maps by their JSON). A null key is a key."""
    columns = [c for c in rows.columns if c != key]
    by = F.col(order) if order else F.to_json(F.struct(*(F.col(c) for c in columns)))
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), by).alias("_x")).select(key, "_x.*") if columns else rows.distinct()


def upsert(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """old with the rows of new in place of those with their key; null keys match one another. Of rows of new that share a key, one counts: the last by order, without one the greatest by its columns' JSON."""
    fresh = one_for_each(new, key, order).select(*old.columns)
    gone = fresh.select(F.col(key).alias("_key"))
    return old.join(gone, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(fresh)


def update_columns(old: DataFrame, new: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """old with the named columns of the row in new that has its key, as upsert() chooses it; no row is added."""
    hit = one_for_each(new, key, order).select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    j = old.join(hit, F.col(key).eqNullSafe(F.col("_key")), "left")
    return j.select(*(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns))


def delete(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return old.join(keys.select(key), key, "left_anti")


def append(rows: DataFrame, path: str) -> None:
    """Adds rows to a table; for logs and results."""
    rows.write.mode("append").parquet(path)


def looked_up(rows: DataFrame, key: str, table: DataFrame, table_key: str, required: bool = True) -> DataFrame:
    """rows with the columns of their row in a table, one of a key's rows as upsert() chooses it; with required, a key that the table lacks, null included, fails the job."""
    hit = one_for_each(table, table_key).select(F.col(table_key).alias("_key"), *(c for c in table.columns if c != table_key))
    joined = rows.join(hit, F.col(key) == F.col("_key"), "left")
    if required:
        wrong = F.concat(F.lit("no row for key "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
        joined = joined.withColumn(key, F.when(F.col("_key").isNull(), F.raise_error(wrong)).otherwise(F.col(key)))
    return joined.drop("_key")


def ci_links(env: dict[str, str]) -> tuple[str | None, str | None]:
    """(address of the commit, address of the job's log) from a continuous-integration environment, or nulls outside one."""
    project, commit, job = env.get("CI_PROJECT_URL"), env.get("CI_COMMIT_SHA"), env.get("CI_JOB_URL")
    return (f"{project}/-/commit/{commit}" if project and commit else None), job


def without_payload(rows: DataFrame, *payload: str) -> DataFrame:
    """Metadata columns alone; the payload is never read."""
    return rows.drop(*(payload or ("data",)))


def upsert_provenance(old: DataFrame, new: DataFrame, key: str, stamp, by, log) -> DataFrame:
    """Keyed upsert that keeps created_* of rows that exist and refreshes last_updated_*; old and new share columns beside these."""
    was = old.select(key, *(F.col(c).alias(f"_{c}") for c in ("created_at", "created_by", "created_logs")))
    fresh = new.join(was, key, "left")
    for c, v in (("created_at", stamp), ("created_by", by), ("created_logs", log)):
        fresh = fresh.withColumn(c, F.coalesce(F.col(f"_{c}"), v))
    fresh = fresh.drop("_created_at", "_created_by", "_created_logs").withColumns({"last_updated_at": stamp, "updated_by": by, "updated_logs": log})
    return upsert(old, fresh.select(*old.columns), key)


def keyed_lines(lines: DataFrame, value_schema: str, line_col: str = "value", order_col: str = "line_no") -> DataFrame:
    """(key, value) of lines that are JSON objects with one or more keys: the last line of a key counts, unreadable lines are skipped."""
    x = lines.select(F.from_json(line_col, f"map<string, {value_schema}>").alias("m"), F.col(order_col).alias("o")).where("m IS NOT NULL")
    return x.select(F.explode("m").alias("key", "value"), "o").groupBy("key").agg(F.max_by("value", "o").alias("value"))


def read_keyed_lines(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """keyed_lines of files; lines are ordered by file and place."""
    lines = spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("line_no"))
    return keyed_lines(lines, value_schema)


def keyed_line(key: str, value: str) -> Column:
    """JSON object {key: value}."""
    return F.to_json(F.create_map(F.col(key), F.col(value)))


def object_to_lines(rows: DataFrame, json_col: str) -> DataFrame:
    """The keys of top-level JSON objects, one {key: value} a line, in column `value`; other JSON gives nothing."""
    whole = F.from_json(json_col, "map<string, variant>")
    return rows.select(F.explode(whole).alias("k", "v")).select(F.to_json(F.create_map("k", "v")).alias("value"))


def split_concatenated(rows: DataFrame, text_col: str) -> DataFrame:
    """Objects that were written one after another without a separator, one a line."""
    return rows.select(F.explode(F.split(F.regexp_replace(text_col, r"\}\s*\{", "}\u0000{"), "\u0000")).alias("value"))


def with_content(rows: DataFrame, url_col: str, content: DataFrame) -> DataFrame:
    """rows with what a table (url, kind, metadata, readme, html) has fetched for their address."""
    return rows.join(content.withColumnRenamed("url", url_col), url_col, "left")


def alive(rows: DataFrame, url_col: str, status: DataFrame) -> DataFrame:
    """rows with `works`: whether a table (url, status) has an answer below 400 for their address, https first, then http."""
    ok = status.where("status < 400").select(F.regexp_replace("url", "^https?://", "").alias("_u"), F.when(F.col("url").startswith("https"), 0).otherwise(1).alias("_o"), F.col("url").alias("works_at"))
    best = ok.groupBy("_u").agg(F.min_by("works_at", "_o").alias("works_at"))
    return rows.withColumn("_u", F.regexp_replace(url_col, "^https?://", "")).join(best, "_u", "left").drop("_u").withColumn("works", F.col("works_at").isNotNull())


def decisions_from_comments(comments: DataFrame, issue_col: str, order_col: str, body_col: str) -> DataFrame:
    """(issue, decision, explanation, confidence): the newest comment of an issue whose first fenced json block can be read."""
    block = F.regexp_extract(body_col, r"(?s)```json\s*(.*?)```", 1)
    parsed = comments.select(F.col(issue_col).alias("issue"), F.col(order_col).alias("o"), F.from_json(block, "decision string, explanation string, confidence string").alias("d"))
    return parsed.where("d.decision IS NOT NULL").groupBy("issue").agg(F.max_by("d", "o").alias("d")).select("issue", "d.*")
