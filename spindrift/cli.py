"""Command lines: python -m spindrift.cli transform|integrate|merge|statistics|keyed-lines ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spindrift.plans import integration
from spindrift.sources import documents


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spindrift")
    sub = p.add_subparsers(dest="command", required=True)
    t = sub.add_parser("transform", help="raw documents to entries, publications and rejected documents")
    t.add_argument("--raw", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--sources", nargs="*")
    i = sub.add_parser("integrate", help="entries and verdicts to records and merged tools")
    i.add_argument("--entries", required=True)
    i.add_argument("--verdicts", required=True, help="table (block, entry, verdict, confidence)")
    i.add_argument("--decisions", help="table (block, decision, confidence)")
    i.add_argument("--records", help="records of an earlier run, whose blocks are not judged again")
    i.add_argument("--out", required=True)
    m = sub.add_parser("merge", help="entries and records to merged tools, as after a change of records")
    m.add_argument("--entries", required=True)
    m.add_argument("--records", required=True)
    m.add_argument("--out", required=True)
    s = sub.add_parser("statistics", help="merged tools to results")
    s.add_argument("--tools", required=True)
    s.add_argument("--out", required=True)
    k = sub.add_parser("keyed-lines", help="JSON Lines with one key a line to a table, the last line of a key counts")
    k.add_argument("--lines", required=True)
    k.add_argument("--schema", required=True)
    k.add_argument("--out", required=True)
    return p


def verdicts_from(table):
    """A provider that looks pairs up in a table; a pair without a verdict is a disagreement."""

    def provider(pairs):
        return pairs.join(table.select("block", "entry", "verdict", "confidence"), ["block", "entry"], "left").withColumn("verdict", F.coalesce("verdict", F.lit("disagreement")))

    return provider


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("spindrift").getOrCreate()
    read = spark.read.parquet
    if a.command == "transform":
        for name, df in zip(("entries", "publications", "rejected"), integration.transform(read(a.raw), a.sources), strict=True):
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    elif a.command == "integrate":
        records, tools = integration.integrate(read(a.entries), verdicts_from(read(a.verdicts)), read(a.decisions) if a.decisions else None, stored=read(a.records) if a.records else None)
        records.write.mode("overwrite").parquet(f"{a.out}/records")
        tools.write.mode("overwrite").parquet(f"{a.out}/tools")
    elif a.command == "merge":
        integration.merged(read(a.entries), read(a.records)).write.mode("overwrite").parquet(f"{a.out}/tools")
    elif a.command == "statistics":
        for name, df in integration.tool_statistics(read(a.tools)).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    else:
        documents.read_keyed_lines(spark, a.lines, a.schema).write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    main()
