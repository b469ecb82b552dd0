"""Entity resolution: blocks, recovery, conflicts, pairs, verdicts, records, rounds.

Blocks are long tables (block, entry), never nested rows. Where the outcome
depends on an order, the order is the column given for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.storage import materialise

from .components import components

#: Sources of entries that never take part in conflicts, and of one family. Fixed values.
METRIC_SOURCES = ["opeb_metrics", "bioconda"]
GALAXY_SOURCES = ["galaxy", "toolshed", "galaxy_metadata"]


def block_key(name: Column, kind: Column) -> Column:
    """lower-case name/type, with * for no or an undefined type."""
    return F.concat(F.lower(name), F.lit("/"), F.when(kind.isNull() | (kind == "undefined"), F.lit("*")).otherwise(kind))


def group_entities(entries: DataFrame, id_col: str, order_col: str, key: Column, links: DataFrame, link_id_col: str, link_col: str) -> DataFrame:
    """(block, entry): entries connected by a key or a link; the block is named by the key of its first entry by order_col.

    Keys and links are vertices beside the entries, so a hot link costs one edge
    for each entry and never pairs of entries.
    """
    rows = entries.select(F.col(id_col).alias("entry"), F.col(order_col).alias("ord"), key.alias("key"))
    here = F.concat(F.lit("e:"), F.col("entry").cast("string"))
    edges = rows.select(here.alias("a"), F.concat(F.lit("k:"), F.coalesce("key", F.concat(F.lit("\x00"), F.col("entry").cast("string")))).alias("b"))
    more = links.select(F.concat(F.lit("e:"), F.col(link_id_col).cast("string")).alias("a"), F.concat(F.lit("l:"), F.col(link_col)).alias("b")).where(F.col(link_col).isNotNull())
    found = components(edges.union(more), "a", "b").where("vertex LIKE 'e:%'").select(F.substr("vertex", F.lit(3)).alias("_id"), "component")
    rows = rows.join(found, F.col("entry").cast("string") == F.col("_id")).drop("_id")
    names = rows.groupBy("component").agg(F.min_by("key", F.struct("ord", "entry")).alias("block"))
    return rows.join(names, "component").select("block", "entry", "ord")


def link_index(rows: DataFrame, block_col: str, link_col: str, least: int = 2) -> DataFrame:
    """(link, blocks): sorted blocks of each link that `least` or more blocks have."""
    g = rows.where(F.col(link_col).isNotNull()).select(F.col(link_col).alias("link"), F.col(block_col).alias("block")).distinct()
    return g.groupBy("link").agg(F.array_sort(F.collect_list("block")).alias("blocks")).where(F.size("blocks") >= least)


def same_name_links(index: DataFrame) -> DataFrame:
    """Links whose blocks all have the same text before the first slash."""
    return index.where(F.size(F.array_distinct(F.transform("blocks", lambda b: F.get(F.split(b, "/"), F.lit(0))))) == 1)


def recovered_key(keys: Column) -> Column:
    """name/type if all blocks have one type other than *, else name/*."""
    kinds = F.array_distinct(F.transform(keys, lambda k: F.substring_index(k, "/", -1)))
    name = F.substring_index(F.get(keys, F.lit(0)), "/", 1)
    return F.concat(name, F.lit("/"), F.when((F.size(kinds) == 1) & (F.get(kinds, F.lit(0)) != "*"), F.get(kinds, F.lit(0))).otherwise(F.lit("*")))


def recover_blocks(members: DataFrame, links: DataFrame) -> DataFrame:
    """(block, entry) with blocks of one name that share a link merged and named anew; blocks that get one name are united.

    members has (block, entry), links has (block, link).
    """
    name = F.substring_index(F.col("block"), "/", 1)
    edges = links.where("link IS NOT NULL").select(F.concat(F.lit("b:"), F.col("block")).alias("a"), F.concat(F.lit("l:"), name, F.lit("\x00"), F.col("link")).alias("b"))
    found = components(edges, "a", "b").where("vertex LIKE 'b:%'").select(F.substr("vertex", F.lit(3)).alias("block"), "component")
    keys = found.groupBy("component").agg(F.array_sort(F.collect_list("block")).alias("keys"))
    renamed = found.join(keys, "component").select("block", F.when(F.size("keys") > 1, recovered_key(F.col("keys"))).otherwise(F.col("block")).alias("new"))
    return members.join(renamed, "block", "left").select(F.coalesce("new", "block").alias("block"), *(c for c in members.columns if c != "block")).distinct()


def detect_conflicts(entries: DataFrame, links: DataFrame, keep_linkless: bool = False, skipped: list[str] | None = None, family: list[str] | None = None) -> DataFrame:
    """(block, entry, role): 'remaining' and 'disconnected' entries of blocks in which any is disconnected.

    entries has block, entry, ord, name, source (array); links has block, entry,
    link. An entry with links remains if another of its block has one of them;
    one without remains with keep_linkless or if its source belongs to `family`.
    Entries of the family with the family's commonest name remain too. Blocks
    with one entry, and blocks of the family alone under one name, have no conflict.
    """
    skipped, family = METRIC_SOURCES if skipped is None else skipped, GALAXY_SOURCES if family is None else family
    low = F.transform("source", F.lower)
    of = lambda names: F.coalesce(F.arrays_overlap(low, F.array(*(F.lit(n) for n in names))), F.lit(False)) if names else F.lit(False)
    rows = entries.where(~of(skipped)).select("block", "entry", "ord", F.lower(F.trim("name")).alias("name"), of(family).alias("family"))
    linked = links.where("link IS NOT NULL").select("block", "entry", "link").distinct().join(rows.select("block", "entry"), ["block", "entry"], "left_semi")
    # counts are summed before they are shuffled, so a link that very many entries have is no task of its own
    several = linked.groupBy("block", "link").agg(F.count("*").alias("c")).where("c > 1").select("block", "link")
    sharing = linked.join(several, ["block", "link"], "left_semi").select("block", "entry", F.lit(True).alias("s"))
    shared = linked.select("block", "entry", F.lit(False).alias("s")).union(sharing).groupBy("block", "entry").agg(F.max("s").alias("shares"))
    per_name = rows.where("family").groupBy("block", "name").agg(F.count("*").alias("c"), F.min("ord").alias("first"))
    commonest = per_name.groupBy("block").agg(F.min_by("name", F.struct(-F.col("c"), F.col("first"))).alias("common"))
    sizes = rows.groupBy("block").agg(F.count("*").alias("size"), F.min("family").alias("all_family"), F.countDistinct("name").alias("names"))
    rows = rows.join(sizes, "block").where("size > 1 AND NOT (all_family AND names = 1)").join(shared, ["block", "entry"], "left").join(commonest, "block", "left")
    stays = F.when(F.col("shares").isNull(), F.lit(keep_linkless) | F.col("family")).otherwise(F.col("shares")) | (F.col("family") & F.coalesce(F.col("name") == F.col("common"), F.lit(False)))
    rows = rows.select("block", "entry", "ord", "name", stays.alias("stays"))
    some = rows.groupBy("block").agg(F.min("stays").alias("all_stay")).where("NOT all_stay").select("block")
    return rows.join(some, "block").select("block", "entry", "ord", "name", F.when(F.col("stays"), F.lit("remaining")).otherwise(F.lit("disconnected")).alias("role"))


def merge_by_source_name(conflicts: DataFrame) -> DataFrame:
    """Disconnected entries with the name of, and a source in common with, an entry that remained become remaining. conflicts has block, entry, ord, name, source, role; blocks stay even without a disconnected entry."""
    left = conflicts.where("role = 'remaining'").select("block", "name", F.explode("source").alias("s")).distinct()
    out = conflicts.where("role = 'disconnected'").select("block", "entry", "name", F.explode("source").alias("s"))
    moved = out.join(left, ["block", "name", "s"], "left_semi").select("block", "entry").distinct().withColumn("moved", F.lit(True))
    return conflicts.join(moved, ["block", "entry"], "left").withColumn("role", F.when(F.col("moved"), F.lit("remaining")).otherwise(F.col("role"))).drop("moved")


def build_pairs(conflicts: DataFrame) -> DataFrame:
    """(block, pair_no, entry, anchors): the disconnected entries of a block against what remains.

    All remaining entries together are the anchor. Without any, the first of two
    or more disconnected entries is; a single one has no pair.
    """
    ordered = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("ord", "entry")))), lambda x: x["entry"])
    g = conflicts.groupBy("block").agg(ordered("disconnected").alias("d"), ordered("remaining").alias("r"))
    anchors = F.when(F.size("r") > 0, F.col("r")).when(F.size("d") > 1, F.slice("d", 1, 1))
    others = F.when(F.size("r") > 0, F.col("d")).when(F.size("d") > 1, F.slice("d", F.lit(2), F.size("d") - 1))
    return g.select("block", anchors.alias("anchors"), F.posexplode(others).alias("pos", "entry")).select("block", (F.col("pos") + 1).alias("pair_no"), "entry", "anchors")


def agree(a: Column, b: Column) -> Column:
    """The verdict two annotators share, else 'disagreement'; also if both have none."""
    return F.when(a.isNotNull() & (a == b), a).otherwise(F.lit("disagreement"))


def caution(ids: Column) -> Column:
    """A note if the merged ids have several names."""
    names = F.array_distinct(F.transform(ids, lambda x: F.get(F.split(x, "/"), F.lit(1))))
    return F.when(F.size(names) > 1, F.lit("Entries with different names were merged. Please check."))


def resolution_records(conflicts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(block, resolution, merged, unmerged, source, confidence, notes) of conflicts.

    verdicts has block, pair_no, entry, anchors, verdict, confidence. A block with
    a disagreement is left for manual review, with all its entries unmerged.
    'same', in any case, merges an entry with the anchors; any other verdict keeps
    it apart. A block without pairs is merged from what remains, or partial if
    nothing does.
    """
    ids = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("ord", "entry")))), lambda x: x["entry"])
    blocks = conflicts.groupBy("block").agg(ids("remaining").alias("r"), ids("disconnected").alias("d"))
    same = F.lower("verdict") == "same"
    judged = verdicts.groupBy("block").agg(
        F.max(F.col("verdict") == "disagreement").alias("open"),
        F.first("anchors").alias("anchors"),
        F.transform(F.array_sort(F.collect_list(F.when(same, F.struct("pair_no", "entry")))), lambda x: x["entry"]).alias("same"),
        F.transform(F.array_sort(F.collect_list(F.when(~same, F.struct("pair_no", "entry")))), lambda x: x["entry"]).alias("other"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("entry"), F.coalesce("confidence", F.lit("")))))).alias("confidence"),
    )
    rows = blocks.join(judged, "block", "left")
    pairs, review = F.col("anchors").isNotNull(), F.coalesce("open", F.lit(False))
    none = F.array().cast("array<string>")
    merged = F.when(review, none).when(pairs, F.concat("anchors", "same")).otherwise(F.col("r"))
    unmerged = F.when(review, F.concat("r", "d")).when(pairs, F.col("other")).otherwise(F.when(F.size("r") > 0, none).otherwise(F.col("d")))
    rows = rows.select("block", review.alias("review"), pairs.alias("pairs"), merged.alias("merged"), unmerged.alias("unmerged"), "confidence")
    resolution = F.when(F.col("review"), F.lit("manual_review_pending")).when(F.size("unmerged") > 0, F.lit("partial")).otherwise(F.lit("merged"))
    source = F.when(F.col("review"), F.lit("manual")).when(F.col("pairs"), F.lit("auto:agreement")).otherwise(F.lit("auto:heuristic"))
    return rows.select("block", resolution.alias("resolution"), "merged", "unmerged", source.alias("source"), "confidence", caution(F.col("merged")).alias("notes"))


def no_conflict_records(blocks: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Records of the blocks (block, entry, ord) without a conflict: all entries merge."""
    rows = blocks.join(conflicts.select("block").distinct(), "block", "left_anti")
    ids = F.transform(F.array_sort(F.collect_list(F.struct("ord", "entry"))), lambda x: x["entry"])
    return rows.groupBy("block").agg(ids.alias("merged")).select(
        "block", F.lit("no_conflict").alias("resolution"), "merged", F.array().cast("array<string>").alias("unmerged"), F.lit("auto:no_conflict").alias("source"),
        F.lit(None).cast("map<string,string>").alias("confidence"), caution(F.col("merged")).alias("notes"),
    )


def secondary_conflicts(records: DataFrame) -> DataFrame:
    """(block, parent, entry, ord, role): a new block for every record with several unmerged entries that awaits no review; the first remains, the others are disconnected. A parent has one, so its name needs no global counter."""
    rows = records.where((F.size("unmerged") > 1) & (F.col("resolution") != "manual_review_pending")).select(F.col("block").alias("parent"), F.posexplode("unmerged").alias("ord", "entry"))
    role = F.when(F.col("ord") == 0, F.lit("remaining")).otherwise(F.lit("disconnected"))
    return rows.select(F.concat("parent", F.lit("_secondary_1")).alias("block"), "parent", "entry", "ord", role.alias("role"))


def resolve(blocks: DataFrame, conflicts: DataFrame, provider, solved: DataFrame | None = None, rounds: int = 1000) -> DataFrame:
    """Records of all blocks: conflicts are judged in rounds until no new ones arise.

    provider takes pairs (block, pair_no, entry, anchors) and returns them with
    verdict and confidence. Blocks of `solved` (block) are not judged again. Every
    round settles an entry of each block at least, so rounds end by themselves; a
    provider that brings more than `rounds` of them about fails, and nothing is lost.
    """
    if solved is not None:
        conflicts = conflicts.join(solved.select("block"), "block", "left_anti")
        blocks = blocks.join(solved.select("block"), "block", "left_anti")
    conflicts = materialise(conflicts)
    records = materialise(resolution_records(conflicts, provider(build_pairs(conflicts))))
    out = no_conflict_records(blocks, conflicts).unionByName(records)
    for _ in range(rounds):
        conflicts = materialise(secondary_conflicts(records))
        if conflicts.isEmpty():
            return out
        records = materialise(resolution_records(conflicts, provider(build_pairs(conflicts))))
        out = out.unionByName(records)
    raise RuntimeError(f"conflicts are left after {rounds} rounds")


def conflict_counts(entries: DataFrame, found: DataFrame, merged: DataFrame) -> DataFrame:
    """(measure, n): blocks, those with a conflict, and their disconnected entries before and after the merge by source and name."""
    row = lambda name, df, n: df.agg(n.alias("n")).select(F.lit(name).alias("measure"), "n")
    blocks, out = F.countDistinct("block"), F.count_if(F.col("role") == "disconnected")
    return row("blocks", entries, blocks).union(row("conflicts", found, blocks)).union(row("disconnected", found, out)).union(row("disconnected_after_merge", merged, out))


def human_key_check(human: DataFrame, records: DataFrame, key: str = "block") -> DataFrame:
    """(key, problem): human decisions about blocks without a record ('missing'), or with one that does not await review ('not pending')."""
    j = human.select(key).distinct().join(records.select(key, "resolution").distinct(), key, "left")
    problem = F.when(F.col("resolution").isNull(), F.lit("missing")).when(F.col("resolution") != "manual_review_pending", F.lit("not pending"))
    return j.select(F.col(key).alias("key"), problem.alias("problem")).where("problem IS NOT NULL")


def verdict_counts(verdicts: DataFrame, verdict: Column) -> DataFrame:
    """(verdict, n, share): how often annotators came to each verdict, cases apart; no verdict is 'none'."""
    counted = verdicts.groupBy(F.coalesce(F.lower(verdict), F.lit("none")).alias("verdict")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return counted.withColumn("share", F.col("n") / F.lit(total))


def unique_ids(conflicts: DataFrame) -> DataFrame:
    """(role, n_entries, n_unique): entries of conflicts and how many different ones there are."""
    return conflicts.groupBy("role").agg(F.count("*").alias("n_entries"), F.countDistinct("entry").alias("n_unique"))


def unresolved(conflicts: DataFrame, records: DataFrame, key: str = "block") -> DataFrame:
    """Keys of conflicts without a record."""
    return conflicts.select(key).distinct().join(records.select(key), key, "left_anti")


def last_decisions(log: DataFrame, key_col: str, order_col: str, columns: list[str]) -> DataFrame:
    """The last row of a log for each key."""
    return log.groupBy(key_col).agg(F.max_by(F.struct(*columns), order_col).alias("_x")).select(key_col, "_x.*")


def human_records(decisions: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Records by human decisions (block, decision, confidence): same merges all, different keeps the disconnected apart, unclear and others wait. Of two disconnected entries without a remaining one the second remains."""
    ids = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("ord", "entry")))), lambda x: x["entry"])
    g = conflicts.groupBy("block").agg(ids("remaining").alias("r0"), ids("disconnected").alias("d0")).join(decisions, "block")
    two = (F.size("r0") == 0) & (F.size("d0") == 2)
    g = g.withColumns({"r": F.when(two, F.slice("d0", 2, 1)).otherwise(F.col("r0")), "d": F.when(two, F.slice("d0", 1, 1)).otherwise(F.col("d0"))})
    none, word = F.array().cast("array<string>"), F.lower("decision")
    resolution = F.when(word == "same", F.lit("merged")).when(word == "different", F.lit("partial")).when(word == "unclear", F.lit("unclear")).otherwise(F.lit("manual_review_pending"))
    merged = F.when(word == "same", F.concat("r", "d")).when(word == "different", F.col("r")).otherwise(none)
    unmerged = F.when(word == "same", none).when(word == "different", F.col("d")).otherwise(F.concat("r", "d"))
    return g.select("block", resolution.alias("resolution"), merged.alias("merged"), unmerged.alias("unmerged"), F.lit("manual").alias("source"), "confidence")


def pair_estimates(sizes: DataFrame, n_col: str) -> DataFrame:
    """(n_first, n_pairs): comparisons of a first round, and of all pairs where more than one is left."""
    n = F.col(n_col)
    return sizes.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n_first"), F.coalesce(F.sum(F.when(n > 1, n * (n - 1) / 2)), F.lit(0)).cast("long").alias("n_pairs"))


def blocks_with_several(members: DataFrame, block_col: str, value: Column) -> DataFrame:
    """(block, n): blocks with more than one distinct value."""
    return members.groupBy(F.col(block_col).alias("block")).agg(F.countDistinct(value).alias("n")).where("n > 1")


def alias_blocks(members: DataFrame, prefix: str = "bioconductor-") -> DataFrame:
    """(block, name): names of a block (block, name) that also occur there with the prefix."""
    plain = members.select("block", "name").distinct()
    prefixed = plain.where(F.col("name").startswith(prefix)).select("block", F.substr("name", F.lit(len(prefix) + 1)).alias("name"))
    return plain.join(prefixed, ["block", "name"], "left_semi")


def drop_sources(members: DataFrame, sources: list[str]) -> tuple[DataFrame, DataFrame]:
    """(members without entries of the sources, counts of entries and of blocks that are empty now)."""
    gone = F.arrays_overlap("source", F.array(*(F.lit(s) for s in sources)))
    per = members.groupBy("block").agg(F.count_if(gone).alias("dropped"), F.count("*").alias("n"))
    counts = per.agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("n_entries"), F.count_if(F.col("dropped") == F.col("n")).alias("n_blocks"))
    return members.where(~gone), counts


def funnel(records: DataFrame) -> DataFrame:
    """(n_no_conflict, n_auto, n_pending, n_human, n_unclear) of first-round blocks."""
    r = records.where(~F.col("block").contains("_secondary_"))
    done = F.col("resolution").isin("merged", "partial")
    human = F.col("source") == "manual"
    return r.agg(
        F.count_if(F.col("resolution") == "no_conflict").alias("n_no_conflict"), F.count_if(done & ~human).alias("n_auto"),
        F.count_if(F.col("resolution") == "manual_review_pending").alias("n_pending"), F.count_if(done & human).alias("n_human"), F.count_if(F.col("resolution") == "unclear").alias("n_unclear"),
    )


def repeated_keys(rows: DataFrame, key: Column) -> DataFrame:
    """(key, n) of keys that occur more than once."""
    return rows.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1")
